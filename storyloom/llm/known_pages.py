"""Urls of the newest discover run that name a page listed before."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, shared_dir
from . import pages, segments

#: Parameters that only track a visit or a session (fixed values); anything starting with utm_ is one too.
TRACKING = "dclid fbclid gbraid gclid gclsrc igshid jsessionid mc_cid mc_eid msclkid phpsessid ref ref_src referrer s_cid sessionid session_id sid spm twclid wbraid yclid _ga _gl _hsenc _hsmi".split()


def canonical_url(url: Column) -> Column:
    """The page that an address names: scheme, www, default ports, tracking, fragment, index files, doubled and closing
    slashes and the case of the host don't matter; path and other parameters do. Null stays null."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    site = F.regexp_extract(plain, r"^([^/?;]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(site), r"^.*@", ""), r":(80|443)?$", ""), r"^www\.|\.$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^/?;]*([^?]*)", 1), r"(?i);[^/?=]*(session|sid)[^/?=]*=[^/?;]*", "")
    path = F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), r"(?i)/(index|default)\.(html?|php|aspx?|jsp)$", "/")
    path = F.regexp_replace(path, "/+$", "")
    params = F.filter(F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "[&;]"), lambda p: (p != "") & ~F.lower(p).rlike(r"^utm_") & ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING))
    page = F.concat_ws("?", F.concat(host, path), F.nullif(F.array_join(F.array_sort(params), "&"), F.lit("")))
    return F.when(url.isNotNull(), F.coalesce(F.try_url_decode(F.replace(page, F.lit("+"), F.lit("%2B"))), page))


def listings(discovered: DataFrame, run_log: DataFrame) -> DataFrame:
    """Distinct url, is_new for the rows that belong to a discover run; is_new marks the newest run. Unreadable times belong to none."""
    runs = run_log.where(F.col("stage") == "discover").agg(F.max("started_at").alias("newest"), F.min("started_at").alias("oldest"))
    at = F.try_to_timestamp("discovered_at")
    rows = discovered.select("url", at.alias("at")).join(F.broadcast(runs), F.col("at") >= F.col("oldest"))  # one row
    return rows.where(F.length(F.trim("url")) > 0).groupBy("url").agg(F.max(F.col("at") >= F.col("newest")).alias("is_new"), F.min(F.col("at") >= F.col("newest")).alias("only_new"))


def pages_of_urls(manifest: DataFrame) -> DataFrame:
    """Distinct url, raw_path of the stored pages of each url."""
    return manifest.where("url is not null and raw_path is not null").select("url", "raw_path").distinct()


def page_keys(raw_pages: DataFrame) -> DataFrame:
    """raw_path, sha256 of pages, empty where there is none: what tells a page read before."""
    return raw_pages.select(F.coalesce("raw_path", F.lit("")).alias("raw_path"), F.coalesce("sha256", F.lit("")).alias("sha256"))


class Stories:
    """What is kept of stored pages between runs, below `state`: per batch the layout statistics and the stories (raw_path,
    sha256, id, s) of its pages, and per accepted batch the texts (id, s) and their segments.

    A batch counts once its mark is there, which is made last; what a run that died has left behind is never read."""

    def __init__(self, spark: SparkSession, state: str):
        self.spark, self.state = spark, state

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def batches(self, kind: str) -> list[str]:
        """Marked batches: one name per run."""
        fs, folder = self._fs(f"{self.state}/{kind}-marks")
        return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []

    def mark(self, kind: str, batch: str) -> None:
        fs, p = self._fs(f"{self.state}/{kind}-marks/{batch}")
        fs.createNewFile(p)

    def read(self, table: str, kind: str, ddl: str, more: str | None = None) -> DataFrame:
        """The table of all marked batches, and of one that is being made."""
        names = self.batches(kind) + ([more] if more else [])
        if not names:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(*[f"{self.state}/{table}/{b}" for b in names])

    def stories(self) -> DataFrame:
        return self.read("stories", "pages", STORIES)

    def texts(self) -> DataFrame:
        return self.read("texts", "texts", TEXTS)

    def segments(self) -> DataFrame:
        return self.read("segments", "texts", segments.SEGMENTS_DDL)

    def read_pages(self, raw_pages: DataFrame) -> None:
        """Read the stories of the pages that were not read before, by the layouts of all pages read so far and these.

        New pages are told by path and digest, without their bodies; pages read once are not read again."""
        fresh = raw_pages
        if self.batches("pages"):
            seen = self.read("pages", "pages", "raw_path string, sha256 string")
            keys = materialize(page_keys(raw_pages).join(seen, ["raw_path", "sha256"], "left_anti"), "new-pages")
            if keys.isEmpty():
                return
            fresh = raw_pages.join(keys.select("raw_path"), "raw_path", "left_semi")
        batch = uuid.uuid4().hex
        hosted = pages.host_pages(fresh)
        pages.path_statistics(hosted).write.parquet(f"{self.state}/layouts/{batch}")
        sums = [F.sum(c).alias(c) for c in pages.COUNTS]
        bits = [F.expr(f"bit_or(b{i})").alias(f"b{i}") for i in range(pages.N_LONGS)]
        layouts = self.read("layouts", "pages", pages.STATS_DDL, batch)
        if self.batches("pages"):
            layouts = materialize(layouts.groupBy("host", "container", "leaf").agg(*sums, *bits), "layouts")

        def work(host, body, rules, known):
            s = segments.symbols(" ".join(t for _, t in pages.story_lines(host, body, rules, known)))
            return [(s,)] if len(s) >= segments.MIN_WORDS else []

        found = pages.apply_rules(hosted, work, "raw_path string, s string", layouts)
        found.withColumn("id", F.xxhash64("s")).write.parquet(f"{self.state}/stories/{batch}")
        page_keys(fresh).write.parquet(f"{self.state}/pages/{batch}")
        self.mark("pages", batch)

    def accept(self, texts: DataFrame) -> None:
        """Add texts (id, s) that are not accepted yet, and their segments."""
        new = texts
        if self.batches("texts"):
            new = texts.join(self.texts().select("id"), "id", "left_anti")
        batch = uuid.uuid4().hex
        new.write.parquet(f"{self.state}/texts/{batch}")
        kept = self.spark.read.schema(TEXTS).parquet(f"{self.state}/texts/{batch}")
        segments.history_segments(kept, segments.common_segments(kept)).write.parquet(f"{self.state}/segments/{batch}")
        self.mark("texts", batch)


STORIES, TEXTS = "raw_path string, s string, id bigint", "id bigint, s string"


def known_urls(discovered: DataFrame, run_log: DataFrame, manifest: DataFrame, raw_pages: DataFrame, state: str | None = None) -> DataFrame:
    """Distinct url of the newest run's listings that name a page of an earlier run (columns of p5_found).

    state: a folder that keeps what was read of pages and the index of accepted texts from one run to the next; a run reads
    the pages and indexes the texts that are not in it. Without it a folder of its own is used."""
    spark = discovered.sparkSession
    kept = Stories(spark, state or f"{shared_dir(spark)}/stories-{uuid.uuid4().hex}")
    urls = materialize(listings(discovered, run_log).withColumn("page", canonical_url(F.col("url"))), "listings")
    earlier = urls.where(~F.col("only_new"))
    same = urls.where("is_new").join(earlier.select("page").distinct(), "page", "left_semi").select("url")
    rest = urls.where("is_new").join(earlier.select("page").distinct(), "page", "left_anti").select("url")

    kept.read_pages(raw_pages.select("raw_path", "vendor", "sha256", "body"))
    stories = kept.stories()
    stored = pages_of_urls(manifest).join(stories.select("raw_path", "id"), "raw_path").select("url", "id")
    stored = stored.join(urls.select("url", "only_new"), "url").groupBy("url", "id").agg(F.first("only_new").alias("only_new"))
    stored = materialize(stored, "url-stories")
    old_ids = materialize(stored.where(~F.col("only_new")).select("id").distinct(), "old-stories")
    asked = stored.where("only_new").join(rest, "url", "left_semi").select("url", "id")
    equal = asked.join(old_ids, "id", "left_semi").select("url")

    texts = stories.groupBy("id").agg(F.first("s").alias("s"))
    kept.accept(texts.join(old_ids, "id", "left_semi"))
    batch = materialize(texts.join(asked.join(equal, "url", "left_anti").select("id").distinct(), "id", "left_semi"), "batch")
    close = segments.matches(kept.texts(), batch, kept.segments()).join(old_ids.withColumnRenamed("id", "old"), "old", "left_semi")
    near = asked.join(close.select(F.col("new").alias("id")), "id", "left_semi").select("url")
    return same.unionByName(equal).unionByName(near).distinct()
