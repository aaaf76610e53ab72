"""Items that stand together in records far more often than chance, by stripes.

Items too rare to be part of any reported pair are dropped first; what is left is bounded by the items per record over the
least share, and is numbered. Each partition builds one stripe per item, an associative array of its neighbours' counts over
all its records; a stripe travels as one row and stripes are merged array by array, FAN_IN partitions at a time, so that no
task holds more than FAN_IN stripes of an item. Pairs that chance explains at the level of SIGNIFICANT by their log-likelihood
ratio are not reported.

Records without an id are left out; an id counts once (its rows hold equal content). Null and blank values are no items and an
item counts once per record.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

FIELDS = ("products_used", "use_case_category", "technical_area")
LEAST, SHARE, LIFT = 5, 0.002, 3
#: Log-likelihood ratio that chance exceeds in one of twenty pairs (chi-squared, one degree of freedom).
SIGNIFICANT = 3.841
#: Entries that a partition's stripes may hold before they are handed on; partitions whose stripes are merged at a time.
FLUSH, FAN_IN = 1_000_000, 64
#: Items sent to the executors as one table; beyond it records are joined with the items instead.
MAX_KEPT = 1_000_000


def _named(field: str) -> Column:
    values = F.filter(F.coalesce(field, F.array().cast("array<string>")), lambda v: F.length(F.trim(v)) > 0)
    return F.transform(values, lambda v: F.concat(F.lit(f"{field}:"), v))


def record_items(case_studies: DataFrame) -> DataFrame:
    """id, items: one row per id, each item once, written field:value."""
    parts = [_named(f) for f in FIELDS]
    rows = case_studies.where("id is not null").select("id", F.array_sort(F.array_distinct(F.concat(*parts))).alias("items"))
    return rows.groupBy("id").agg(F.max("items").alias("items"))


def numbered(records: DataFrame, kept: DataFrame) -> DataFrame:
    """records (id, items) with items as numbers, only those of kept (item, no): looked up in place where kept is small enough."""
    if kept.count() > MAX_KEPT:
        rows = records.select("id", F.explode("items").alias("item")).join(kept.select("item", "no"), "item")
        return rows.groupBy("id").agg(F.collect_list("no").alias("items")).select("items")  # a record's items
    shared = records.sparkSession.sparkContext.broadcast({r["item"]: r["no"] for r in kept.select("item", "no").collect()})

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        no = shared.value
        for pdf in batches:
            yield pd.DataFrame({"items": pd.Series([[no[x] for x in items if x in no] for items in pdf["items"]], dtype=object)})

    return records.select("items").mapInPandas(look_up, "items array<int>")


STRIPE = "item int, others array<int>, n array<bigint>"


def stripes(records: DataFrame) -> DataFrame:
    """item, others, n: per partition one stripe for each item, with the greater items beside it (column items: numbers)."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Counter] = defaultdict(Counter)
        size = 0

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(a, list(s), list(s.values())) for a, s in held.items()], columns=["item", "others", "n"], dtype=object).astype({"item": np.int32})

        for pdf in batches:
            for items in pdf["items"]:
                items = sorted(items)
                for i, a in enumerate(items[:-1]):
                    held[a].update(items[i + 1 :])
                size += len(items) * (len(items) - 1) // 2
            if size > FLUSH:
                yield rows()
                held.clear()
                size = 0
        yield rows()

    return records.mapInPandas(build, STRIPE)


def merged(parts: DataFrame, partitions: int, bar: int) -> DataFrame:
    """The stripes of all partitions merged into one per item; entries below bar are left out at the end."""

    def merge(least: int):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            others, at = np.unique(np.concatenate(pdf["others"].to_list()), return_inverse=True)
            n = np.bincount(at, np.concatenate(pdf["n"].to_list())).astype(np.int64)
            return pd.DataFrame({"item": [pdf["item"].iloc[0]], "others": [others[n >= least]], "n": [n[n >= least]]})

        return one

    rows = parts.withColumn("part", F.spark_partition_id())
    while partitions > FAN_IN:
        partitions = -(-partitions // FAN_IN)
        group = F.pmod("part", F.lit(partitions)).alias("part")
        rows = rows.withColumn("part", group).groupBy("item", "part").applyInPandas(lambda key, pdf: merge(0)(pdf).assign(part=key[1]), f"{STRIPE}, part int")
    return rows.groupBy("item").applyInPandas(merge(bar), STRIPE)


def log_likelihood(k: str, a: str, b: str, n: str) -> Column:
    """Dunning's ratio of a pair's 2 x 2 table as a Column over count columns."""

    def part(x):
        return F.when(x > 0, x * F.log(x)).otherwise(0.0)

    k, a, b, n = (F.col(c).cast("double") for c in (k, a, b, n))
    cells = part(k) + part(a - k) + part(b - k) + part(n - a - b + k)
    return 2 * (cells - part(a) - part(n - a) - part(b) - part(n - b) + part(n))


def pair_statistics(case_studies: DataFrame, least: int = LEAST, share: float = SHARE, significant: float = SIGNIFICANT) -> DataFrame:
    """item_a, item_b, together, count_a, count_b, records, lift, llr of all pairs in at least `least` records and `share` of
    them whose log-likelihood ratio, to six places, is at least `significant`."""
    records = materialize(record_items(case_studies), "pair-records")
    total = records.count()
    bar = max(least, math.ceil(share * total - 1e-9))
    often = records.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= bar)
    kept = materialize(often.withColumn("no", F.row_number().over(Window.orderBy("item"))), "pair-items")  # at most items per record / share rows
    partitions = records._jdf.queryExecution().toRdd().getNumPartitions()
    whole = merged(stripes(numbered(records, kept)), partitions, bar)
    pairs = whole.select("item", F.explode(F.arrays_zip("others", "n")).alias("x")).select(F.col("item").alias("no_a"), F.col("x.others").alias("no_b"), F.col("x.n").alias("together"))
    a, b = (kept.select(F.col("no").alias(f"no_{s}"), F.col("item").alias(f"item_{s}"), F.col("n").alias(f"count_{s}")) for s in "ab")
    out = pairs.join(a, "no_a").join(b, "no_b").withColumn("records", F.lit(total).cast("bigint"))
    out = out.withColumn("lift", F.col("together") * F.col("records") / (F.col("count_a") * F.col("count_b"))).withColumn("llr", F.round(log_likelihood("together", "count_a", "count_b", "records"), 6))
    return out.where(F.col("llr") >= significant).drop("no_a", "no_b")


def frequent_pairs(case_studies: DataFrame) -> DataFrame:
    """The columns of p2_found: significant pairs LIFT times as frequent as chance. At LEAST records and that lift the ratio is
    4.3 or more, so significance takes none of the pairs asked for away."""
    strong = F.col("together") * F.col("records") >= LIFT * F.col("count_a") * F.col("count_b")
    return pair_statistics(case_studies).where(strong).select("item_a", "item_b")


COUNTED = """
with r as (select id, any_value(products_used) p, any_value(use_case_category) u, any_value(technical_area) t from case_studies where id is not null group by id),
i as (
  select distinct id, item from (
    select id, 'products_used:' || unnest(p) item from r union all
    select id, 'use_case_category:' || unnest(u) from r union all
    select id, 'technical_area:' || unnest(t) from r
  ) where length(trim(split_part(item, ':', 2))) > 0
),
n as (select count(*) n from r),
c as (select item, count(*) k from i group by item),
p as (select a.item item_a, b.item item_b, count(*) k from i a join i b on a.id = b.id and a.item < b.item group by 1, 2)
"""
SQL = f"""{COUNTED}
select p.item_a, p.item_b from p join c a on a.item = p.item_a join c b on b.item = p.item_b, n
where p.k >= 5 and p.k >= 0.002 * n.n and p.k * n.n >= 3 * a.k * b.k
"""
STATISTICS_SQL = f"""{COUNTED},
s as (select p.item_a, p.item_b, p.k::double k, a.k::double a, b.k::double b, n.n::double n from p join c a on a.item = p.item_a join c b on b.item = p.item_b, n where p.k >= 5 and p.k >= 0.002 * n.n),
l as (
  select *, round(2 * (k * ln(k) + if(a > k, (a - k) * ln(a - k), 0) + if(b > k, (b - k) * ln(b - k), 0) + if(n > a + b - k, (n - a - b + k) * ln(n - a - b + k), 0)
    - a * ln(a) - if(n > a, (n - a) * ln(n - a), 0) - b * ln(b) - if(n > b, (n - b) * ln(n - b), 0) + n * ln(n)), 6) llr from s
)
select item_a, item_b, k::bigint together, a::bigint count_a, b::bigint count_b, n::bigint records, k::bigint * n::bigint / (a::bigint * b::bigint) lift, llr from l where llr >= 3.841
"""
