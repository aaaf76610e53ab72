"""Sinks and sources on whole tables: written to the shared folder and read again."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import records as R
from ..session import shared_dir, table
from ..sinks import writers as W
from ..sources import readers as S
from .fixture_queries import rows_sql
from .record_queries import ONE, one_each
from .registry import query


def folder(spark) -> str:
    return f"{shared_dir(spark)}/io-{uuid.uuid4().hex}"


def files(spark, root: str, contents: dict[str, str]) -> str:
    """Small text files below root."""
    rows = spark.createDataFrame([(f"{root}/{name}", bytearray(text.encode())) for name, text in contents.items()], "path string, body binary")
    W.store_files(rows).count()
    return root


@query("io_ledger", "select vendor, url, discovered_at, source, lastmod from discovered_urls")
def io_ledger(spark, d):
    """A ledger appended to in two parts and read back."""
    path, rows = f"{folder(spark)}/ledger", table(spark, d, "discovered_urls")
    recent = F.coalesce(F.col("lastmod") >= "2026", F.lit(False))
    W.append_jsonl(rows.where(recent), path)
    W.append_jsonl(rows.where(~recent), path)
    return S.read_jsonl(spark, path, S.LEDGER_DDL).select("vendor", "url", "discovered_at", "source", "lastmod")


@query("io_manifest", "select vendor, url, raw_path, status, sha256, content_type, fetched_at, from_cache, error, final_url, retrieval_source, profile from fetch_manifest")
def io_manifest(spark, d):
    path = f"{folder(spark)}/manifest"
    W.append_jsonl(table(spark, d, "fetch_manifest"), path)
    names = [c.split()[0] for c in S.MANIFEST_DDL.split(", ")]
    return S.read_jsonl(spark, path, S.MANIFEST_DDL).select(*names)


@query("io_content", "select raw_path, sha256, coalesce(octet_length(encode(body)), 0)::bigint bytes, 1::bigint files from raw_pages qualify row_number() over (partition by vendor, sha256, content_type order by raw_path) = 1")
def io_content(spark, d):
    """Bodies stored by their digest, and found again under it."""
    root, pages = folder(spark), table(spark, d, "raw_pages")
    named = W.content_paths(pages.withColumn("sha256", F.sha2("body", 256)), root).select("raw_path", F.col("body").cast("binary").alias("body"))
    W.store_files(named.withColumnRenamed("raw_path", "path")).count()
    back = S.read_content(spark, root).select(F.regexp_extract("path", r"/([^/]+/[0-9a-f]{64})\.[a-z]+$", 1).alias("k"), "length", F.sha2("content", 256).alias("sha256"))
    first = pages.groupBy("vendor", "content_type", F.sha2("body", 256).alias("sha")).agg(F.min("raw_path").alias("raw_path"))
    first = first.withColumn("k", F.concat(T.slugify(F.col("vendor")), F.lit("/"), "sha"))
    return first.join(back, "k").groupBy("raw_path").agg(F.max("sha256").alias("sha256"), F.max("length").cast("bigint").alias("bytes"), F.count("*").alias("files"))


@query("io_record_tree", f"select id, slug, vendor, coalesce(len(products_used), 0) products, coalesce(len(solution_components), 0) components from {ONE} where id is not null and slug is not null")
def io_record_tree(spark, d):
    """One file per record, read as a tree and merged by id in the order of their paths."""
    root = folder(spark)
    W.write_records(one_each(table(spark, d, "case_studies").where("id is not null and slug is not null")), root).count()
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("bigint")
    return R.last_by_key(S.read_records(spark, root), "id", "path").select("id", "slug", "vendor", size("products_used").alias("products"), size("solution_components").alias("components"))


@query("io_record_levels", rows_sql("id vendor one_level", [("a", "late", True), ("b", "x", False), ("c", "x", True)]))
def io_record_levels(spark, d):
    """Records at one level and at any, broken files passed over, the last path of an id winning."""
    record = lambda i, v="x": json.dumps({"id": i, "vendor": v, "slug": i})
    root = files(spark, folder(spark), {"v/a.json": record("a"), "v/z.json": record("a", "late"), "v/deep/b.json": record("b"), "w/c.json": json.dumps([json.loads(record("c"))]), "w/broken.json": "{", "top.txt": "x"})
    near = S.read_records(spark, root, one_level=True).select("id").distinct().withColumn("one_level", F.lit(True))
    return R.last_by_key(S.read_records(spark, root), "id", "path").select("id", "vendor").join(near, "id", "left").select("id", "vendor", F.coalesce("one_level", F.lit(False)).alias("one_level"))


@query("io_lenient", rows_sql("source url lastmod", [("lines", "u", None), ("lines", "w", "2025"), ("object", "v", "s"), ("options", "storyloom/1.0", "1.0")]))
def io_lenient(spark, d):
    """Broken and blank lines, lines without an object, missing and broken files, falsy options, vendors in any case."""
    config = json.dumps({"user_agent": "", "default_delay_seconds": 0, "sources": [{"vendor": "v", "sitemaps": ["s"]}, {"vendor": "w"}]})
    root = files(spark, folder(spark), {"l.jsonl": '{"url": "u", "vendor": "v"}\n\n[1]\n{broken\n"text"\n{"url": "w", "lastmod": "2025"}\n', "c.json": config, "bad.json": "{"})
    lines = S.read_jsonl(spark, f"{root}/l.jsonl", S.LEDGER_DDL).unionByName(S.read_jsonl(spark, f"{root}/none.jsonl", S.LEDGER_DDL)).select(F.lit("lines").alias("source"), "url", "lastmod")
    sources = S.read_sources(spark, f"{root}/c.json", "V").select(F.lit("object").alias("source"), F.col("vendor").alias("url"), F.col("sitemaps")[0].alias("lastmod"))
    empty = S.read_json(spark, f"{root}/bad.json", S.CONFIG_DDL).unionByName(S.read_json(spark, f"{root}/no.json", S.CONFIG_DDL)).select(F.lit("wrong").alias("source"), F.col("user_agent").alias("url"), F.lit("").alias("lastmod"))
    agent, delay = S.fetch_options(spark, f"{root}/c.json")
    options = spark.createDataFrame([("options", agent, str(delay))], "source string, url string, lastmod string")
    return lines.unionByName(sources).unionByName(empty).unionByName(options)


@query("io_export", f"select row_number() over (order by vendor nulls first, customer_name nulls first, id nulls first)::bigint place, id from {ONE}")
def io_export(spark, d):
    """The exported array read back in its order."""
    path = re.sub(r"^file:/*", "/", f"{folder(spark)}.json")
    W.export_array(one_each(table(spark, d, "case_studies")), path)
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", "array<struct<id:string>>")).alias("place", "r")).select((F.col("place") + 1).cast("bigint").alias("place"), "r.id")


@query("io_bundles", "select vendor, sha256, count(*)::bigint - 1 again from (select distinct vendor, sha256 from raw_pages where vendor is not null) group by all")
def io_bundles(spark, d):
    """Bundles written once; a second writing leaves those that are there alone."""
    root = folder(spark)
    rows = table(spark, d, "raw_pages").where("vendor is not null").select("vendor", "sha256").distinct()
    W.write_bundles(rows.limit(10), root).count()
    W.write_bundles(rows, root).count()
    again = W.write_bundles(rows, root).agg(F.count_if("written").alias("again"))
    keys = W.bundle_keys(spark, root).select(F.col("vendor_slug").alias("slug"), "sha256")
    there = rows.withColumn("slug", T.slugify(F.col("vendor"))).join(keys, ["slug", "sha256"], "left_semi")
    return there.select("vendor", "sha256").join(F.broadcast(again))  # one row


@query("io_keyed", "select url, case when url < 'https://n' then 'new' else 'old' end kind from (select distinct url from discovered_urls where url is not null)")
def io_keyed(spark, d):
    """A keyed map in which incoming rows replace stored ones."""
    path = f"{folder(spark)}/map"
    urls = table(spark, d, "discovered_urls").where("url is not null").select("url").distinct()
    W.write_keyed(urls.withColumn("kind", F.lit("old")), urls.where("url < 'https://n'").withColumn("kind", F.lit("new")), "url", path)
    return spark.read.parquet(path).select("url", "kind")


@query("io_taxonomy", "select kind, value, ordinal::bigint ordinal from taxonomy where kind in ('vendors', 'industries', 'technical_areas', 'use_case_categories', 'outcome_categories', 'component_layers')")
def io_taxonomy(spark, d):
    """A taxonomy written as one object of lists and read back with the places of its values."""
    lists = table(spark, d, "taxonomy").groupBy("kind").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "value"))), lambda x: x["value"]).alias("v")).collect()  # a short list
    root = files(spark, folder(spark), {"t.json": json.dumps({r["kind"]: r["v"] for r in lists})})
    back, first = S.read_taxonomy(spark, f"{root}/t.json"), table(spark, d, "taxonomy").groupBy("kind").agg(F.min("ordinal").alias("first"))
    return back.join(first, "kind").select("kind", "value", (F.col("ordinal") + F.col("first")).cast("bigint").alias("ordinal"))
