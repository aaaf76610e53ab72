"""Records: validation, scores, keyed merge and the multi-value child table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import filled, truthy

TEXT_FIELDS = "id slug vendor customer_name industry region company_size business_problem solution_summary business_outcome source_url published_date".split()
LIST_FIELDS = "products_used technical_area use_case_category outcome_category metrics architecture_clues evidence_quotes".split()
#: List fields and the kind under which their values stand in the child table (fixed values).
CHILD_KINDS = {
    "products_used": "product", "technical_area": "technical_area", "use_case_category": "use_case_category", "outcome_category": "outcome_category",
    "metrics": "metric", "architecture_clues": "architecture_clue", "evidence_quotes": "evidence_quote", "integration_points": "integration_point",
}
CHILD_FIELDS = list(CHILD_KINDS)
RECORD_DDL = (
    "id string, slug string, vendor string, customer_name string, industry string, region string, company_size string, business_problem string, solution_summary string, "
    "products_used array<string>, solution_components array<struct<name:string,role:string,layer:string>>, data_flow string, integration_points array<string>, "
    "technical_area array<string>, use_case_category array<string>, business_outcome string, outcome_category array<string>, metrics array<string>, architecture_clues array<string>, "
    "source_url string, published_date string, confidence_score double, maturity_score int, evidence_quotes array<string>, is_sample boolean"
)


def _sum(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def maturity_score() -> Column:
    """How many of six fields are there: 0 to 6."""
    return _sum([truthy(F.col("business_problem")), truthy(F.col("solution_summary")), filled(F.col("products_used")), filled(F.col("architecture_clues")), truthy(F.col("business_outcome")), filled(F.col("metrics"))])


def confidence_score() -> Column:
    """Share of twelve fields that are there, to two places."""
    texts = ["vendor", "customer_name", "industry", "region", "business_problem", "solution_summary", "business_outcome", "source_url", "published_date"]
    lists = ["products_used", "technical_area", "use_case_category"]
    return F.round(_sum([truthy(F.col(c)) for c in texts] + [filled(F.col(c)) for c in lists]) / 12.0, 2)


def maturity_label(score: Column) -> Column:
    return F.when(score >= 5, "Strong reference").when(score >= 3, "Useful but limited").otherwise("Marketing-level")


def fill_scores(records: DataFrame) -> DataFrame:
    """Scores of null or 0 are computed; others stay."""
    return records.withColumns({
        "confidence_score": F.coalesce(F.nullif("confidence_score", F.lit(0.0)), confidence_score()),
        "maturity_score": F.coalesce(F.nullif("maturity_score", F.lit(0)), maturity_score()),
    })


def violations() -> Column:
    """Names of the rules that a record breaks, in the order of the fields: blank required texts, missing lists, blank optional
    parts, components without name or role."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    tests = [F.when(blank(F.col(f)), F.lit(f"text:{f}")) for f in TEXT_FIELDS]
    tests += [F.when(F.col(f).isNull() | F.exists(f, lambda x: x.isNull()), F.lit(f"list:{f}")) for f in LIST_FIELDS]
    tests.append(F.when(F.trim("data_flow") == "", F.lit("optional:data_flow")))
    tests.append(F.when(F.exists("integration_points", lambda x: x.isNull()), F.lit("optional:integration_points")))
    parts = F.col("solution_components")
    tests.append(F.when(F.exists(parts, lambda c: c.isNull()), F.lit("component:object")))
    tests.append(F.when(F.exists(parts, lambda c: c.isNotNull() & blank(c["name"])), F.lit("component:name")))
    tests.append(F.when(F.exists(parts, lambda c: c.isNotNull() & blank(c["role"])), F.lit("component:role")))
    tests.append(F.when(F.exists(parts, lambda c: F.coalesce(F.trim(c["layer"]) == "", F.lit(False))), F.lit("component:layer")))
    return F.filter(F.array(*tests), lambda x: x.isNotNull())


def normalise(records: DataFrame, strict: bool = False) -> DataFrame:
    """Records with defaults for scores and the sample flag, and their violations; strict: a violation fails the query."""
    out = records.withColumn("violations", violations())
    if strict:
        message = F.concat(F.lit("invalid record: "), F.array_join("violations", ", "))
        out = out.where(F.when(F.size("violations") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return out.withColumns({
        "confidence_score": F.coalesce(F.col("confidence_score").cast("double"), F.lit(0.0)),
        "maturity_score": F.coalesce(F.col("maturity_score").cast("int"), F.lit(0)),
        "is_sample": F.coalesce("is_sample", F.lit(False)),
    })


def last_by_key(rows: DataFrame, key: str, order: str, position: str | None = None) -> DataFrame:
    """Per key the row with the greatest order; position: a column to add that keeps the least order, which decides ties
    between keys as the first appearance. One shuffle on the key, partial aggregates first; null keys are left out."""
    others = [c for c in rows.columns if c != key]
    out = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row"), F.min(order).alias("_first"))
    out = out.select(key, *[F.col("_row").getField(c).alias(c) for c in others], "_first").select(*rows.columns, "_first")
    return out.withColumnRenamed("_first", position) if position else out.drop("_first")


def merge_counts(samples: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """One row: samples and extracted rows with a key, repeated ones too, and total different keys."""
    both = samples.select(key, F.lit(1).alias("s"), F.lit(0).alias("r")).unionByName(records.select(key, F.lit(0).alias("s"), F.lit(1).alias("r"))).where(F.coalesce(key, F.lit("")) != "")
    per_key = both.groupBy(key).agg(F.sum("s").alias("s"), F.sum("r").alias("r"))
    return per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("s", "samples"), ("r", "extracted"))], F.count("*").alias("total"))


def sorted_json(records: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """A record as JSON text with its keys in order at every level; nulls are written, non-ASCII characters stay."""

    def ordered(kind: T.DataType, c: Column) -> Column:
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[ordered(kind[n].dataType, c[n]).alias(n) for n in sorted(kind.names)]))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.transform(c, lambda x: ordered(kind.elementType, x))
        return c

    names = sorted(set(records.columns) - set(but))
    return F.to_json(F.struct(*[ordered(records.schema[n].dataType, F.col(n)).alias(n) for n in names]), {"ignoreNullFields": "false"})


def merge_records(samples: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Union by key in which records win; a side has one row per key. A sample keeps its place by its own columns."""
    return samples.join(records.select(key), key, "left_anti").unionByName(records, allowMissingColumns=True)


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Stored rows without a match stay, incoming rows win; rows are never deleted."""
    return stored.join(incoming.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def child_rows(records: DataFrame) -> DataFrame:
    """case_study_id, kind, value: one row per list item; repeats stay, null lists and items give none."""
    wide = [F.transform(F.filter(F.coalesce(f, F.array().cast("array<string>")), lambda v: v.isNotNull()), _pair(kind)) for f, kind in CHILD_KINDS.items()]
    return records.select(F.col("id").alias("case_study_id"), F.inline(F.concat(*wide)))


def _pair(kind: str):
    return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))


def replace_children(stored: DataFrame, records: DataFrame) -> DataFrame:
    """The child table after the records' own rows replaced all stored ones of their ids."""
    ids = records.select(F.col("id").alias("case_study_id")).distinct()
    return stored.join(ids, "case_study_id", "left_anti").unionByName(child_rows(records))


def restore_lists(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents with every list rebuilt from the child table, sorted by value; absent lists become empty."""
    lists = children.groupBy("case_study_id").pivot("kind", list(CHILD_KINDS.values())).agg(F.sort_array(F.collect_list("value")))
    lists = lists.select("case_study_id", *[F.col(kind).alias(f) for f, kind in CHILD_KINDS.items()])
    out = parents.drop(*CHILD_FIELDS).join(lists.withColumnRenamed("case_study_id", "id"), "id", "left")
    return out.withColumns({f: F.coalesce(f, F.array().cast("array<string>")) for f in CHILD_FIELDS})


def duplicate_slugs(records: DataFrame) -> DataFrame:
    """slug, ids: slugs that several ids claim; a store with unique slugs must refuse them."""
    return records.groupBy("slug").agg(F.count_distinct("id").alias("ids")).where("ids > 1")


def components_by_layer(records: DataFrame, layers: DataFrame) -> DataFrame:
    """id, layer, layer_order, components: components of each record grouped by trimmed layer, blank ones under Uncategorized.

    layers: value, ordinal; unlisted layers come last by name. Items keep their place."""
    items = records.select("id", F.posexplode("solution_components").alias("pos", "c"))
    layer = F.coalesce(F.nullif(F.trim("c.layer"), F.lit("")), F.lit("Uncategorized"))
    grouped = items.groupBy("id", layer.alias("layer")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("c.name").alias("name")))), lambda x: x["name"]).alias("components"))
    known = layers.select(F.col("value").alias("layer"), F.col("ordinal").alias("layer_order"))
    return grouped.join(known, "layer", "left").select("id", "layer", F.coalesce("layer_order", F.lit(2**31 - 1)).alias("layer_order"), "components")
