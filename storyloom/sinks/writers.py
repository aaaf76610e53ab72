"""Sinks: ledgers, content-addressed files, bundles, exports, keyed maps."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import raw_suffix, slugify
from ..operators import records as R
from ..session import materialize
from ..sources.readers import exists

#: The tables of a record store (fixed values).
PARENTS = (
    "id string, slug string, vendor string, customer_name string, industry string, region string, company_size string, business_problem string, solution_summary string, business_outcome string, "
    "source_url string, published_date string, confidence_score double, maturity_score int, is_sample boolean, raw_json string, updated_at timestamp"
)
CHILDREN = "case_study_id string, kind string, value string"


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines, nulls written out."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def content_paths(pages: DataFrame, root: str) -> DataFrame:
    """pages (vendor, sha256, content_type, ...) with raw_path: root/vendor slug/digest and suffix."""
    return pages.withColumn("raw_path", F.concat(F.lit(root.rstrip("/") + "/"), slugify(F.col("vendor")), F.lit("/"), F.col("sha256"), raw_suffix(F.col("content_type"))))


def store_files(files: DataFrame, replace: bool = False) -> DataFrame:
    """path, written of files (path, body: bytes), each path once; false: it was there already and replace is off.

    A file is written under a name of its own first and renamed when complete, so that it is there as a whole or not at all."""

    def store(batches):
        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            done = []
            for path, body in zip(pdf["path"], pdf["body"]):
                at, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                if not replace and at.get_file_info(name).type != fs.FileType.NotFound:
                    done.append(False)
                    continue
                at.create_dir(name.rpartition("/")[0], recursive=True)
                part = f"{name}.{uuid.uuid4().hex}.part"
                with at.open_output_stream(part) as f:
                    f.write(body)
                at.move(part, name)
                done.append(True)
            yield pd.DataFrame({"path": pdf["path"], "written": done})

    return files.dropDuplicates(["path"]).select("path", "body").mapInPandas(store, "path string, written boolean")


def write_content(pages: DataFrame, root: str) -> DataFrame:
    """Store each distinct body once as a file named by its digest; returns raw_path, written (false: it was there already).

    pages: vendor, content_type, body (bytes)."""
    named = content_paths(pages.withColumn("sha256", F.sha2("body", 256)), root)
    return store_files(named.select(F.col("raw_path").alias("path"), "body")).withColumnRenamed("path", "raw_path")


def write_records(records: DataFrame, root: str, replace: bool = True) -> DataFrame:
    """One JSON file per record: root/vendor slug/slug.json; returns path, written."""
    path = F.concat(F.lit(root.rstrip("/") + "/"), slugify(F.col("vendor")), F.lit("/"), F.col("slug"), F.lit(".json"))
    return store_files(records.select(path.alias("path"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).cast("binary").alias("body")), replace)


def write_bundles(bundles: DataFrame, root: str, rebuild: bool = False) -> DataFrame:
    """One JSON file per bundle: root/vendor slug/sha256.json; one that is there is left alone unless rebuild. Returns path, written."""
    path = F.concat(F.lit(root.rstrip("/") + "/"), slugify(F.col("vendor")), F.lit("/"), F.col("sha256"), F.lit(".json"))
    return store_files(bundles.select(path.alias("path"), F.to_json(F.struct(*bundles.columns), {"ignoreNullFields": "false"}).cast("binary").alias("body")), rebuild)


def bundle_keys(spark: SparkSession, root: str) -> DataFrame:
    """vendor_slug, sha256 of the bundles below root; their contents are not read."""
    ddl = "vendor_slug string, sha256 string"
    if not exists(spark, f"{root.rstrip('/')}/*/*.json"):
        return spark.createDataFrame([], ddl)
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*.json").select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+\.json$", 1).alias("vendor_slug"), F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("sha256"))


def export_array(records: DataFrame, path: str, order: tuple[str, ...] = ("vendor", "customer_name", "id"), sort_keys: bool = True, drop: tuple[str, ...] = ()) -> int:
    """A JSON array, two blanks to a level, in one file on the driver's file system; for exports of a few records.

    drop: columns that only give the order. Rows are streamed to the file one partition at a time."""
    n = 0
    ordered = records.orderBy(*order).select(F.to_json(F.struct(*(c for c in records.columns if c not in drop)), {"ignoreNullFields": "false"}).alias("j"))
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for n, row in enumerate(ordered.toLocalIterator(), 1):
            text = json.dumps(json.loads(row["j"]), ensure_ascii=False, sort_keys=sort_keys, indent=2)
            f.write(("," if n > 1 else "") + "\n  " + text.replace("\n", "\n  "))
        f.write("\n]\n" if n else "]\n")
    return n


class RecordStore:
    """The stored records: a parent table of PARENTS and a child table of list values, below one folder.

    A seeding writes both tables as a new version and then points to it, so that readers see the old tables or the new ones."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p)) if fs.exists(p) else []

    def create(self) -> None:
        """Empty tables, if there are none yet."""
        if not self.versions():
            self._write(self.spark.createDataFrame([], PARENTS), self.spark.createDataFrame([], CHILDREN), 0)

    def _write(self, parents: DataFrame, children: DataFrame, version: int) -> None:
        parents.write.mode("overwrite").parquet(f"{self.root}/tables/{version:06d}/case_studies")
        children.write.mode("overwrite").parquet(f"{self.root}/tables/{version:06d}/case_study_values")
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/{version:06d}")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(p):
            raise RuntimeError(f"{self.root}: version {version} was written by another run")

    def _table(self, name: str, ddl: str) -> DataFrame:
        last = self.versions()
        return self.spark.read.schema(ddl).parquet(f"{self.root}/tables/{last[-1]:06d}/{name}") if last else self.spark.createDataFrame([], ddl)

    def parents(self) -> DataFrame:
        return self._table("case_studies", PARENTS)

    def children(self) -> DataFrame:
        return self._table("case_study_values", CHILDREN)

    def seed(self, records: DataFrame) -> int:
        """Upsert records (one per id) and replace their list values; returns how many. Slugs that several ids claim are refused,
        stored ids that are not among the records stay."""
        scored = R.fill_scores(records)
        mine = scored.select(*[c.split()[0] for c in PARENTS.split(", ")[:14]], F.coalesce("is_sample", F.lit(False)).alias("is_sample"), R.sorted_json(scored).alias("raw_json"), F.current_timestamp().alias("updated_at"))
        parents = materialize(R.upsert(self.parents(), mine), "store-parents")
        clash = R.duplicate_slugs(parents).first()
        if clash:
            raise ValueError(f"slug {clash['slug']!r} is claimed by {clash['ids']} ids")
        self._write(parents, R.replace_children(self.children(), records), (self.versions() or [0])[-1] + 1)
        return mine.count()

    def export(self) -> DataFrame:
        """Records as stored, their lists rebuilt in the order of their values; absent ones are empty."""
        stored = self.parents().select(F.from_json("raw_json", R.RECORD_DDL).alias("r")).select("r.*")
        return R.restore_lists(stored, self.children())


def write_keyed(stored: DataFrame, incoming: DataFrame, key: str, path: str) -> None:
    """A keyed map in which incoming rows replace stored ones; written beside what stored reads from, so give another path."""
    stored.join(incoming.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True).write.mode("overwrite").parquet(path)


def page_document(title, text):
    """A cleaned page as one text: its title as heading, then the body."""
    return F.concat(F.lit("# "), title, F.lit("\n\n"), text, F.lit("\n"))
