"""Processing only new or changed input files.

A manifest names every input file already processed, with size and checksum. A run lists the inputs, anti-joins the listing
with the manifest by path, size and checksum, writes the batch's output under its own identifier (a batch run again replaces
its output), and only then commits the manifest part of that batch. A run that dies before the commit leaves nothing that later
runs count; one that dies after it is complete. A file whose size or checksum has changed is processed again; its newer batch
supersedes the older one.

Commits are numbered and a number can be taken once: of two runs that process the same files at once the second finds its
number taken, and starts again from the manifest as it is then. Should two still commit one file, its rows count in the batch
of the higher number only. Many new files are worked off FILES_PER_BATCH at a time.
An empty folder gives no batch. Names of files are compared as full paths.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, size bigint, modified timestamp, checksum string, batch_id string, batch_no bigint"
CHUNK = 8 << 20
#: Files of one batch: what one reader call is given and one commit names.
FILES_PER_BATCH = 10_000
ATTEMPTS = 20


class Taken(RuntimeError):
    """Another run has committed under this number."""


def checksums(files: DataFrame) -> DataFrame:
    """files (path, size, modified) with the SHA-256 of their content, read in chunks on the executors."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            sums = []
            for path in pdf["path"]:
                at, name = fs.FileSystem.from_uri(path)
                h = hashlib.sha256()
                with at.open_input_stream(name) as f:
                    while block := f.read(CHUNK):
                        h.update(block)
                sums.append(h.hexdigest())
            yield pdf.assign(checksum=sums)

    return files.mapInPandas(digest, "path string, size bigint, modified timestamp, checksum string")


@dataclass
class IncrementalRun:
    """One consumer of a folder of input files; `state` holds its outputs and its manifest.

    trust_times: take a file of the size and time of its manifest entry as known without reading it for its checksum.
    keep_vanished: rows of files that are no longer listed go on counting, as where inputs are archived once they are read."""

    spark: SparkSession
    inputs: str
    state: str
    suffix: str = ".parquet"
    trust_times: bool = False
    keep_vanished: bool = False

    @property
    def manifest_path(self) -> str:
        return f"{self.state}/manifest"

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def manifest(self) -> DataFrame:
        """Files of all committed batches."""
        if not self._exists(self.manifest_path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self.manifest_path)

    def listing(self) -> DataFrame:
        """path, size, modified of the input files; contents are not read."""
        rows = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{self.suffix}").load(self.inputs)
        return rows.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))

    def latest(self) -> DataFrame:
        """The newest committed entry of each file."""
        return self.manifest().groupBy("path").agg(F.max_by(F.struct("size", "modified", "checksum", "batch_id"), "batch_no").alias("m")).select("path", "m.*")

    def pending(self) -> DataFrame:
        """path, size, modified, checksum of new and changed files."""
        known, files = self.latest(), self.listing()
        if self.trust_times:
            files = files.join(known.select("path", "size", "modified"), ["path", "size", "modified"], "left_anti")
        return checksums(files).join(known.select("path", "size", "checksum"), ["path", "size", "checksum"], "left_anti")

    def run(self, transform: Callable[[DataFrame], DataFrame], batch_id: str | None = None) -> list[str]:
        """Process the pending files, whose rows transform gets with input_path, their file (in place of a column of that name);
        what it returns must keep input_path. Returns the identifiers of the batches committed, none if nothing was pending.

        Give the identifier of a batch that failed to repeat it: its output is overwritten. It then takes all pending files."""
        done: list[str] = []
        for _ in range(ATTEMPTS):
            number = self.next_number()
            files = self.pending().orderBy("path")
            rows = (files if batch_id else files.limit(FILES_PER_BATCH + 1)).collect()  # one row per file, not per record
            more = not batch_id and len(rows) > FILES_PER_BATCH
            rows = rows[:FILES_PER_BATCH] if more else rows
            if not rows:
                return done
            name = batch_id or f"b{uuid.uuid4().hex}"  # never read as a number
            source = F.col("_metadata.file_path").alias("input_path")
            out = transform(self.spark.read.parquet(*[r["path"] for r in rows]).drop("input_path").select("*", source))
            out.write.mode("overwrite").parquet(f"{self.state}/batches/batch_id={name}")
            try:
                self.commit(name, rows, number)
            except Taken:
                continue  # what this run wrote is not counted; the files may be done by now
            done.append(name)
            if not more:
                return done
        raise Taken(f"{self.state}: other runs commit all the time")

    def next_number(self) -> int:
        """The first number above all that were ever taken; a run that died after taking one leaves a gap."""
        fs, folder = self._path(f"{self.state}/numbers")
        return 1 + max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0) if fs.exists(folder) else 1

    def commit(self, batch_id: str, rows: list, number: int) -> None:
        """Add the batch to the manifest under a number that nobody else has.

        The entry is written beside the manifest and renamed into it: it is there as a whole or not at all."""
        entry = self.spark.createDataFrame([(r["path"], r["size"], r["modified"], r["checksum"], batch_id, number) for r in rows], MANIFEST)
        fs, made = self._path(f"{self.state}/commits/{batch_id}")
        entry.coalesce(1).write.mode("overwrite").parquet(str(made))
        part = next(f.getPath() for f in fs.listStatus(made) if f.getPath().getName().startswith("part-"))
        fs.mkdirs(self._path(self.manifest_path)[1])
        if not fs.createNewFile(self._path(f"{self.state}/numbers/{number:09d}")[1]):
            raise Taken(f"batch number {number} is taken")
        if not fs.rename(part, self._path(f"{self.manifest_path}/{number:09d}.parquet")[1]):
            raise OSError(f"{self.manifest_path}: batch number {number} can't be committed")

    def output(self) -> DataFrame:
        """Rows of the committed batches; a row whose input file was processed again later counts in its newest batch only."""
        live = self.latest() if self.keep_vanished else self.latest().join(self.listing().select("path"), "path", "left_semi")
        batches = self.spark.read.parquet(f"{self.state}/batches")
        return batches.join(live.select(F.col("path").alias("input_path"), "batch_id"), ["input_path", "batch_id"], "left_semi")


def run_of(rows: DataFrame, run_log: DataFrame, stage: str, at: str, id_column: str = "run_id", status: str = "run_status") -> DataFrame:
    """rows with the run of the stage that was the last to start at or before column `at` (timestamp); none: nulls.

    The runs become one sorted array on every row's side of a broadcast of one row, and each row looks its run up in it."""
    runs = run_log.where(F.col("stage") == stage).agg(F.sort_array(F.collect_list(F.struct("started_at", "run_id", "status"))).alias("runs"))
    hit = F.element_at(F.filter("runs", lambda r: r["started_at"] <= F.col(at)), -1)
    joined = rows.join(F.broadcast(runs))  # one row, as long as the run log
    return joined.withColumn("_run", F.when(F.exists("runs", lambda r: r["started_at"] <= F.col(at)), hit)).select(*rows.columns, F.col("_run.run_id").alias(id_column), F.col("_run.status").alias(status))


def lastmod_day(lastmod):
    """The day that a lastmod text means by its first ten characters; YYYY-MM and YYYY mean their first day; else null."""
    head = F.substring(lastmod, 1, 10)
    full = F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head).when(head.rlike(r"^\d{4}-\d{2}$"), F.concat(head, F.lit("-01"))).when(head.rlike(r"^\d{4}$"), F.concat(head, F.lit("-01-01")))
    return F.to_date(F.try_to_timestamp(full, F.lit("yyyy-MM-dd")))


def due_urls(listings: DataFrame, attempts: DataFrame, run_log: DataFrame) -> DataFrame:
    """Distinct url that the next fetch run must take.

    listings: url, lastmod_day (latest_listings). attempts: url, at (good_attempts). A url is due if no attempt at it is done, or
    if its latest lastmod is a later day than the UTC day of its last done attempt. An attempt is done if it is good and its
    fetch run succeeded, as run_log has it now. Null urls are none."""
    listed = listings.where("url is not null").groupBy("url").agg(F.max("lastmod_day").alias("lastmod_day"))
    ok = run_of(attempts, run_log, "fetch", "at").where(F.col("run_status") == "success")
    done = ok.groupBy("url").agg(F.max("at").alias("done_at"))
    joined = listed.join(done, "url", "left")
    return joined.where(F.col("done_at").isNull() | (F.col("lastmod_day") > F.to_date("done_at"))).select("url")


def good_attempts(manifest: DataFrame) -> DataFrame:
    """Distinct url, at, input_path of the attempts with status 200 and no error; unreadable times belong to no run.

    Whether their run succeeded is not asked here: a run may still be going on when its rows are read."""
    good = manifest.where((F.col("status") == 200) & (F.coalesce(F.trim("error"), F.lit("")) == "") & F.col("url").isNotNull())
    return good.select("url", F.try_to_timestamp("fetched_at").alias("at"), "input_path").where("at is not null").distinct()


def latest_listings(discovered: DataFrame) -> DataFrame:
    """url, lastmod_day, input_path: the latest readable lastmod per url of each input file."""
    return discovered.where("url is not null").groupBy("url", "input_path").agg(F.max(lastmod_day(F.col("lastmod"))).alias("lastmod_day"))


def plan_fetch(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    """Bring the state of both ledgers up to date with their new or changed files, then list the urls due (column url).

    Only files that the state lacks are processed; what is kept of them is what later answers need, and runs are looked up when
    urls are listed."""
    ledgers = IncrementalRun(spark, f"{sf_dir}/discovered_urls.parquet", f"{state}/listings")
    attempts = IncrementalRun(spark, f"{sf_dir}/fetch_manifest.parquet", f"{state}/attempts")
    ledgers.run(latest_listings)
    attempts.run(good_attempts)
    return due_urls(ledgers.output(), attempts.output(), spark.read.parquet(f"{sf_dir}/run_log.parquet"))
