"""Frequencies with share, top lists, coverage matrices and faceted search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def count_values(values: DataFrame, column: str = "label", denominator: int | Column | None = None) -> DataFrame:
    """label, count, share; the share is of all values unless a denominator is given, and 0 where that is 0.

    values: one row per value; nulls are left out. The total is a one-row broadcast of partial sums, so values are counted in one shuffle."""
    counted = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count("*").alias("count"))
    if denominator is None:
        counted = counted.join(F.broadcast(counted.agg(F.sum("count").alias("_all"))))  # one row
    else:
        counted = counted.withColumn("_all", F.lit(denominator) if isinstance(denominator, int) else denominator)
    return counted.select("label", "count", F.when(F.coalesce(F.col("_all"), F.lit(0)) > 0, F.col("count") / F.col("_all")).otherwise(0.0).alias("share"))


def tag_values(records: DataFrame, field: str) -> DataFrame:
    """One row (label) per non-empty tag of a list field; repeats count."""
    return records.select(F.explode(field).alias("label")).where("label <> ''")


def top_values(values: DataFrame, limit: int = 10, locale: bool = False) -> DataFrame:
    """The most frequent values; ties by label, in binary order or as a reader would sort them."""
    return count_values(values).orderBy(F.desc("count"), locale_order(F.col("label")) if locale else F.col("label")).limit(limit)


def matrix_cells(records: DataFrame, row: str, column_field: str, columns: DataFrame) -> DataFrame:
    """label, column, count: records of each row label that hold the column label, once per record however often they repeat it.

    columns: label; a short list, put beside every row label as one array. All row labels appear with all columns."""
    rows = records.where(F.col(row).isNotNull())
    tags = rows.select(F.col(row).alias("label"), F.explode(F.array_distinct(column_field)).alias("column"))
    hits = tags.groupBy("label", "column").agg(F.count("*").alias("count"))
    wanted = F.broadcast(columns.agg(F.collect_set("label").alias("_columns")))  # one row
    spine = rows.select(F.col(row).alias("label")).distinct().join(wanted).select("label", F.explode("_columns").alias("column"))
    return spine.join(hits, ["label", "column"], "left").select("label", "column", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def matrix_columns(records: DataFrame, field: str, limit: int, by: str = "alphabetical", locale: bool = False) -> DataFrame:
    """label: the first `limit` tags by alphabet, or the most frequent ones (by='count'); locale: see top_values."""
    tags = tag_values(records, field)
    order = locale_order(F.col("label")) if locale else F.col("label")
    if by == "alphabetical":
        return tags.distinct().orderBy(order).limit(limit)
    return tags.groupBy("label").count().orderBy(F.desc("count"), order).limit(limit).select("label")


def matrix_totals(cells: DataFrame) -> DataFrame:
    """label, total: sums of a matrix's cells, so a record with several of the columns counts several times."""
    return cells.groupBy("label").agg(F.sum("count").alias("total"))


def locale_order(c: Column) -> Column:
    """A key to sort labels by as a reader would: letters before their accents and case, lower case first."""
    return F.collate(c, "UNICODE")


def ranked(rows: DataFrame, key: str, order: list[str], name: str = "rank") -> DataFrame:
    """rows with their number, from 1, within each key by `order`, however many rows a key has.

    Rows are cut into ranges of key and order, numbered within each, and each part of a key starts after the parts before it.
    Rows equal in key and order are numbered in any order; null keys are one key."""
    part = F.spark_partition_id().alias("_part")
    cut = materialize(rows.repartitionByRange(key, *order).select(*rows.columns, part), "ranges")
    within = Window.partitionBy("_part", key)
    sizes = cut.groupBy("_part", F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # parts of a key
    starts = sizes.select(F.col("_part").alias("_p"), "_key", before.alias("_before"))
    numbered = cut.withColumn("_i", F.row_number().over(within.orderBy(*order)))
    out = numbered.join(starts, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
    return out.select(*rows.columns, (F.col("_before") + F.col("_i")).alias(name))


def search_text() -> Column:
    """Lower-case text that a free search looks in; absent fields add nothing."""
    lists = [F.array_join(f, " ") for f in ("products_used", "technical_area", "use_case_category")]
    return F.lower(F.concat_ws(" ", "customer_name", "vendor", "industry", "solution_summary", *lists))


def facet_filter(records: DataFrame, text: str = "", vendor: str = "", industry: str = "", area: str = "") -> DataFrame:
    """Records that meet all facets; a blank facet sets no condition. The text is looked for as it stands, not as a pattern."""
    out = records
    if vendor:
        out = out.where(F.col("vendor") == vendor)
    if industry:
        out = out.where(F.col("industry") == industry)
    if area:
        out = out.where(F.array_contains("technical_area", area))
    if text.strip():
        out = out.where(search_text().contains(text.strip().lower()))
    return out


def bar_widths(counted: DataFrame) -> DataFrame:
    """counted (label, count) with width: percent of the greatest count, which is taken as at least 1."""
    most = counted.agg(F.greatest(F.coalesce(F.max("count"), F.lit(1)), F.lit(1)).alias("_most"))
    return counted.join(F.broadcast(most)).select(*counted.columns, (F.col("count") / F.col("_most") * 100).alias("width"))  # one row
