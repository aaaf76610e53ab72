"""Sources: tolerant and strict JSON, JSONL ledgers, record trees, source configuration, taxonomy, stored content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.records import RECORD_DDL

LEDGER_DDL = "vendor string, url string, discovered_at string, source string, lastmod string"
MANIFEST_DDL = "vendor string, url string, raw_path string, status int, sha256 string, content_type string, fetched_at string, from_cache boolean, error string, final_url string, retrieval_source string, profile string"
CONFIG_DDL = "user_agent string, default_delay_seconds double, sources array<struct<vendor:string,sitemaps:array<string>,index_pages:array<string>,url_patterns:array<string>,exclude_patterns:array<string>>>"
TAXONOMY_KINDS = ("vendors", "industries", "technical_areas", "use_case_categories", "outcome_categories", "component_layers")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return bool(found) and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Objects of a JSONL file or folder with the given columns plus source_file and line_no (order within a file).

    A missing file is empty; blank and malformed lines and lines that hold no object are dropped; absent keys are null."""
    wanted = T.StructType.fromDDL(ddl)
    names = wanted.names
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*wanted, T.StructField("source_file", T.StringType()), T.StructField("line_no", T.LongType())]))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("line_no"))
    parsed = lines.where(F.trim("value").startswith("{")).withColumn("j", F.from_json("value", T.StructType([*wanted, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.where("j is not null and j._bad is null").select(*[F.col(f"j.`{c}`").alias(c) for c in names], "source_file", "line_no")


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One JSON document with a default of no rows: for a missing file or one that cannot be parsed."""
    schema = T.StructType.fromDDL(ddl)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return _whole(spark.read.text(path, wholetext=True), schema)


def _whole(files: DataFrame, schema: T.StructType, strict: bool = False, *more) -> DataFrame:
    """Objects of files read whole: one object or an array of them; what cannot be parsed is dropped, or fails the query."""
    parsed = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    rows = files.select(parsed.alias("rows"), *more)
    kept = [c for c in rows.columns if c != "rows"]
    return rows.select(F.explode("rows").alias("r"), *kept).where("r is not null").select("r.*", *kept)


def read_records(spark: SparkSession, path: str, strict: bool = False, one_level: bool = False) -> DataFrame:
    """Records of a tree of JSON files (an object or an array a file), with path: order by it where the order counts, as
    last_by_key(order="path") does for merging.

    one_level: only files in folders directly below path, not those at any depth. A missing tree is empty. Unreadable files are
    dropped, or fail the query if strict. Broken contents of readable ones are left to normalise()."""
    schema = T.StructType.fromDDL(RECORD_DDL)
    if not exists(spark, f"{path.rstrip('/')}/*/*.json" if one_level else path):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("path", T.StringType())]))
    if one_level:
        files = spark.read.text(f"{path.rstrip('/')}/*/*.json", wholetext=True)
    else:
        files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return _whole(files, schema, strict, F.col("_metadata.file_path").alias("path"))


def read_sources(spark: SparkSession, path: str, vendor: str | None = None) -> DataFrame:
    """vendor, sitemaps, index_pages, url_patterns, exclude_patterns of the configured sources; vendor in any case."""
    rows = read_json(spark, path, CONFIG_DDL).select(F.inline("sources"))
    return rows.where(F.lower("vendor") == vendor.lower()) if vendor else rows


def fetch_options(spark: SparkSession, path: str, agent: str = "storyloom/1.0", delay: float = 1.0) -> tuple[str, float]:
    """(user agent, delay) of a configuration; absent, empty and zero values mean the defaults."""
    row = read_json(spark, path, CONFIG_DDL).select("user_agent", "default_delay_seconds").first()
    return ((row["user_agent"] if row else None) or agent, (row["default_delay_seconds"] if row else None) or delay)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """kind, value, ordinal of a taxonomy file: an object of lists."""
    rows = read_json(spark, path, ", ".join(f"{k} array<string>" for k in TAXONOMY_KINDS))
    unpivoted = None
    for k in TAXONOMY_KINDS:
        part = rows.select(F.lit(k).alias("kind"), F.posexplode(k).alias("ordinal", "value")).select("kind", "value", "ordinal")
        unpivoted = part if unpivoted is None else unpivoted.unionByName(part)
    return unpivoted


def read_content(spark: SparkSession, root: str) -> DataFrame:
    """path, length, content of stored files below root at any depth."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "content")


def with_content(manifest: DataFrame, content: DataFrame) -> DataFrame:
    """manifest left-joined with its stored content by raw_path; rows without one keep nulls, to be counted, not to fail."""
    return manifest.join(content.select(F.col("path").alias("raw_path"), "content"), "raw_path", "left")
