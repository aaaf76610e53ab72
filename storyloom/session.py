"""Session set-up and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_WRITTEN: list[str] = []
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings case_studies "
    "discovered_urls fetch_manifest raw_pages run_log taxonomy eval_items mix_targets"
).split()


def get_spark(cpus: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings this library is tested under; on a cluster the session is the caller's.

    shuffle_partitions: two a core if not given. AQE joins small ones but can't go above, so a cluster wants as many as its
    largest shuffle has parts of about 200 MB."""
    cores = (os.cpu_count() or 8) if str(cpus) == "*" else int(cpus)
    shuffle_partitions = shuffle_partitions or 2 * cores
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("storyloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STORYLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset and the master is local, a folder that is
    removed when the process ends; on a cluster there is no such substitute."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="storyloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives the loss of an executor."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Delete what materialize has written in this process so far; call it once results are stored, as they may read from it."""
    while _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def hash_share(*columns: str) -> Column:
    """A number in [0, 1) from the hash of these columns, in steps of 2^-63: shares of any size can be drawn by it."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1) / F.lit(2.0**63)


def spread(scan: DataFrame) -> DataFrame:
    """A scan for work that costs far more than its bytes: shuffled only if its files give fewer tasks than there are cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan._jdf.queryExecution().toRdd().getNumPartitions() < cores else scan
