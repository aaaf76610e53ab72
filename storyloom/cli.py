"""python -m storyloom.cli COMMAND: the steps of the pipeline on files. Ledgers are JSONL, results Parquet or JSON."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _ledgers(spark: SparkSession, args):
    from .operators.crawl import latest_attempts
    from .sources.readers import LEDGER_DDL, MANIFEST_DDL, read_jsonl

    manifest = read_jsonl(spark, args.manifest, MANIFEST_DDL)
    order = F.struct("source_file", "line_no")  # the last line of a url counts
    return read_jsonl(spark, args.discovered, LEDGER_DDL), latest_attempts(manifest, order)


def _lastmods(discovered):
    from .operators.records import last_by_key

    return last_by_key(discovered.where("url is not null").select("url", "lastmod", F.struct("source_file", "line_no").alias("o")), "url", "o")


def _web(spark, args):
    from .sources.readers import fetch_options
    from .sources.web import Web

    agent, delay = fetch_options(spark, args.sources) if args.sources else ("storyloom/1.0", 1.0)
    return Web(agent, args.timeout), delay


def discover(spark, args):
    from .operators.crawl import caching, discovered
    from .sinks.writers import append_jsonl
    from .sources.readers import LEDGER_DDL, read_jsonl, read_sources

    web, _ = _web(spark, args)

    def get(url):
        return web(url)[:3]

    if args.cache_dir:
        os.makedirs(args.cache_dir, exist_ok=True)
        place = lambda key: os.path.join(args.cache_dir, f"{key}.bin")

        def keep(key, body):
            with open(place(key), "wb") as f:
                f.write(body)

        def held(key):
            if not os.path.exists(place(key)):
                return None
            with open(place(key), "rb") as f:
                return f.read()

        get = caching(get, held, keep)
    known = read_jsonl(spark, args.out, LEDGER_DDL)
    sources = read_sources(spark, args.sources, args.vendor).collect()
    rows = discovered(sources, known.select("url"), get, args.max_sitemaps, args.limit_per_vendor, not args.skip_sitemaps, not args.skip_index)
    append_jsonl(rows, args.out)


def _queue(spark, args):
    from .operators.crawl import fetch_queue as queue
    from .operators.crawl import newest_first

    discovered, latest = _ledgers(spark, args)
    rows = queue(discovered, latest, args.vendor, args.since, args.refresh).orderBy(*newest_first(F.col("lastmod")), "source_file", "line_no")
    return rows.limit(args.limit) if args.limit is not None else rows


def fetch_queue(spark, args):
    _queue(spark, args).write.mode("overwrite").json(args.out)


def fetch(spark, args):
    from .operators.crawl import attempt_plan, fetch_with, host_strategies, manifest_rows
    from .session import materialize
    from .sinks.writers import append_jsonl, store_files
    from .sources.readers import read_json

    web, delay = _web(spark, args)
    queue = materialize(_queue(spark, args).select("vendor", "url").dropDuplicates(["url"]), "fetch-queue")
    known = read_json(spark, args.strategies, "hosts array<struct<host:string,strategy:string,kind:string>>").select(F.inline("hosts")) if args.strategies else spark.createDataFrame([], "host string, strategy string, kind string")
    year = spark.range(1).select(F.year(F.current_timestamp())).first()[0]
    got = materialize(fetch_with(attempt_plan(host_strategies(queue, known), year), web, delay), "fetched")
    rows = manifest_rows(queue, got, args.raw_root)
    store_files(rows.where("raw_path is not null").select("url", F.col("raw_path").alias("path")).join(got.select("url", "body"), "url")).count()
    append_jsonl(rows, args.manifest)


def probe(spark, args):
    from .operators.crawl import attempt_plan
    from .operators.crawl import probe as found
    from .sources.web import Web

    web = Web(timeout=args.timeout)
    year = spark.range(1).select(F.year(F.current_timestamp())).first()[0]
    plans = attempt_plan(spark.createDataFrame([(u, None, None) for u in args.urls], "url string, strategy string, kind string"), year).collect()
    tried = []
    for plan in plans:  # the urls of a command line
        for n, a in enumerate(x for x in plan["attempts"] if (x["profile"], x["source"]) != ("default", "origin")):
            try:
                status, body, _, _ = web(a["url"], a["profile"])
                tried.append((plan["url"], n, status, body.decode("utf-8", "replace"), None, a["profile"], a["source"]))
            except Exception as e:  # noqa: BLE001 - the next strategy is tried
                tried.append((plan["url"], n, 0, None, str(e), a["profile"], a["source"]))
    rows = found(spark.createDataFrame(tried, "url string, attempt_no int, status int, body string, transport_error string, profile string, source string"))
    known = {}
    if os.path.exists(args.out):
        with open(args.out, encoding="utf-8") as f:
            known = {h["host"]: h for h in json.load(f).get("hosts", [])}
    known.update((r["host"], r.asDict()) for r in rows.collect() if r["host"])  # others stay
    with open(args.out, "w", encoding="utf-8") as f:
        json.dump({"hosts": [known[h] for h in sorted(known)]}, f, ensure_ascii=False, indent=2, sort_keys=True)


def extract_queue(spark, args):
    from .operators.crawl import bundle
    from .operators.crawl import extract_queue as queue
    from .sources.readers import read_records

    discovered, latest = _ledgers(spark, args)
    bundle(queue(latest, _lastmods(discovered), read_records(spark, args.records, one_level=True))).write.mode("overwrite").json(args.out)


def extract(spark, args):
    from .operators.assets import with_assets
    from .operators.crawl import checked_limits, fetch_with, full_bundles, newest_first
    from .operators.crawl import extract_queue as queue
    from .session import materialize
    from .sinks.writers import bundle_keys, write_bundles
    from .sources.readers import read_records

    most, timeout, least = checked_limits(args.image_assets_limit, args.image_timeout_seconds, args.image_min_score)
    args.timeout = timeout
    discovered, latest = _ledgers(spark, args)
    rows = queue(latest, _lastmods(discovered), read_records(spark, args.records, one_level=True))
    if args.vendor:
        rows = rows.where(F.lower("vendor") == args.vendor.lower())
    if args.limit is not None:
        rows = rows.orderBy(*newest_first(F.col("lastmod")), "url").limit(args.limit)
    rows = materialize(rows, "extract-queue")
    # content is read from the paths of the queue: no other file is opened
    paths = [r["raw_path"] for r in rows.select("raw_path").distinct().collect() if os.path.exists(r["raw_path"])]  # files of one extraction
    content = spark.read.format("binaryFile").load(paths).select(F.regexp_replace("path", "^file:/*", "/").alias("at"), F.col("content").alias("body")) if paths else spark.createDataFrame([], "at string, body binary")
    named = spark.createDataFrame([(p, os.path.abspath(p)) for p in paths], "raw_path string, at string")
    skill, taxonomy = (open(p, encoding="utf-8").read() for p in (args.skill, args.taxonomy))
    done = None
    if not args.rebuild:
        from .functions.text import slugify

        slugs = rows.select("vendor", slugify(F.col("vendor")).alias("vendor_slug")).distinct()
        done = bundle_keys(spark, args.out).join(slugs, "vendor_slug")
    bundles = full_bundles(rows, content.join(named, "at"), skill, taxonomy, least, not args.no_css_background_images, most > 0, done)
    if most:
        web, delay = _web(spark, args)
        plain = F.array(F.struct("url", F.lit("default").alias("profile"), F.lit("origin").alias("source")))
        bundles = with_assets(materialize(bundles, "bundles"), args.out, lambda urls: fetch_with(urls.withColumn("attempts", plain), web, delay), most=most)
    bundles = materialize(bundles, "bundles")
    counts = write_bundles(bundles, args.out, args.rebuild).agg(F.count_if("written").alias("jobs")).first().asDict()
    counts["image_assets"] = bundles.select(F.explode("related_images").alias("i")).where("i.local_path is not null").count() if most else 0
    print(json.dumps(counts))


def clean(spark, args):
    from .functions.html import page_text

    with open(args.input, "rb") as f:
        body = bytearray(f.read())
    page = spark.createDataFrame([(body, args.content_type)], "body binary, content_type string")
    title, text, _ = page.select(page_text(F.col("body"), F.col("content_type")).alias("t")).select("t.*").first()
    with open(args.out, "w", encoding="utf-8") as f:
        f.write(f"# {title}\n\n{text}\n" if title else f"{text}\n")


def merge(spark, args):
    from .operators.records import last_by_key, merge_counts, merge_records
    from .sinks.writers import export_array
    from .sources.readers import read_records

    samples, records = (read_records(spark, p) for p in (args.samples, args.records))
    print(json.dumps(merge_counts(samples, records).first().asDict()))
    # the last path of an id counts, a merged record stands where its id first did: samples, then paths
    placed = [last_by_key(rows.where("coalesce(id, '') <> ''").withColumn("o", F.struct(F.lit(side).alias("side"), "path")), "id", "o", "place") for side, rows in enumerate((samples, records))]
    first = placed[0].unionByName(placed[1]).groupBy("id").agg(F.min("place").alias("place"))
    merged = merge_records(*(p.drop("place", "o", "path") for p in placed)).join(first, "id")
    names = merge_records(*(p.drop("place", "o", "path") for p in placed)).columns
    export_array(merged.select(*names, "place"), args.out, ("place", "id"), sort_keys=False, drop=("place",))


def validate(spark, args):
    from .operators.records import normalise
    from .sources.readers import read_records

    bad = normalise(read_records(spark, args.records)).where(F.size("violations") > 0).select("path", "id", "violations")
    bad.write.mode("overwrite").json(args.out)


def seed(spark, args):
    from .operators.records import normalise
    from .sinks.writers import RecordStore
    from .sources.readers import read_records

    store = RecordStore(spark, args.out)
    store.create()
    print(store.seed(normalise(read_records(spark, args.records), strict=True).drop("path", "violations")))


def export(spark, args):
    from .sinks.writers import RecordStore, export_array

    print(export_array(RecordStore(spark, args.store).export(), args.out))


def run(spark, args):
    from .plans.all_queries import QUERIES

    QUERIES[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="storyloom")
    commands = parser.add_subparsers(required=True)

    def command(f, *names, out="out"):
        p = commands.add_parser(f.__name__.replace("_", "-"))
        p.set_defaults(run=f)
        for n in (*names, *([out] if out else [])):
            p.add_argument(n if n == "name" else f"--{n}", **({} if n == "name" else {"required": True}))
        return p

    p = command(discover, "sources")
    p.add_argument("--vendor")
    p.add_argument("--limit-per-vendor", type=int)
    p.add_argument("--max-sitemaps", type=int, default=20)
    p.add_argument("--skip-sitemaps", action="store_true")
    p.add_argument("--skip-index", action="store_true")
    p.add_argument("--cache-dir")
    p.add_argument("--timeout", type=float, default=30.0)
    for f, out in ((fetch_queue, "out"), (fetch, None)):
        p = command(f, "discovered", "manifest", out=out)
        p.add_argument("--vendor")
        p.add_argument("--since")
        p.add_argument("--refresh", action="store_true")
        p.add_argument("--limit", type=int)
    p.add_argument("--raw-root", required=True)
    p.add_argument("--sources")
    p.add_argument("--strategies")
    p.add_argument("--timeout", type=float, default=30.0)
    p = command(probe)
    p.add_argument("urls", nargs="+")
    p.add_argument("--timeout", type=float, default=30.0)
    command(extract_queue, "discovered", "manifest", "records")
    p = command(extract, "discovered", "manifest", "records", "skill", "taxonomy")
    p.add_argument("--sources")
    p.add_argument("--vendor")
    p.add_argument("--limit", type=int)
    p.add_argument("--image-assets-limit", type=int, default=6)
    p.add_argument("--image-timeout-seconds", type=float, default=4.0)
    p.add_argument("--image-min-score", type=int, default=8)
    p.add_argument("--no-css-background-images", action="store_true")
    p.add_argument("--rebuild", action="store_true")
    command(clean, "input").add_argument("--content-type", default="text/html")
    command(merge, "samples", "records")
    command(validate, "records")
    command(seed, "records")
    command(export, "store")
    command(run, "name", "tables")
    args = parser.parse_args(argv)
    from .session import clear_work, get_spark

    spark = SparkSession.getActiveSession() or get_spark("*")
    args.run(spark, args)
    clear_work(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
