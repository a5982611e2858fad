"""Changed-file discovery for drop folders whose files get rewritten in place.

A file stream remembers paths, so a file overwritten under the same name is
never read again.  The ledger instead remembers ``(path, modificationTime,
length)`` of every file a published run has read; a listing anti-joined with
it yields the new *and* the rewritten files.  The listing uses the
``binaryFile`` source with its ``content`` column pruned, so only file
metadata is read, and it stays a DataFrame: nothing of its size reaches the
driver.

A run's files are written to ``pending/<run>``, dealt into batches, before any
is read.  When the catalog's table holds the run, that list becomes a part of the
committed table; the list of a run that died is taken up again, others are dropped
and their files read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import fs

KEY = ["path", "modificationTime", "length"]
SCHEMA = "path string, modificationTime timestamp, length long"
COMPACT_RUNS = 100      # committed runs are rewritten as one from so many on


def listing(spark: SparkSession, input_path: str, glob_filter: str | None = None) -> DataFrame:
    """Metadata of the files in a folder: path, modificationTime, length."""
    reader = spark.read.format("binaryFile")
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    return reader.load(input_path).select(*KEY)


class FileLedger:
    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")
        self.committed = f"{self.location}/committed"

    def _pending(self, run: str) -> str:
        return f"{self.location}/pending/{run}"

    def seen(self) -> DataFrame | None:
        runs = fs.list_names(self.spark, self.committed)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.committed}/*") if runs else None

    def changed(self, input_path: str, glob_filter: str | None) -> DataFrame:
        listed, seen = listing(self.spark, input_path, glob_filter), self.seen()
        return listed if seen is None else listed.join(seen, KEY, "left_anti")

    def record(self, files: DataFrame, run: str, batches: int) -> DataFrame:
        """Write a run's work list, dealt into batches by path."""
        numbered = files.select(*KEY, F.pmod(F.xxhash64("path"), F.lit(batches)).cast("long").alias("batch"))
        fs.mkdirs(self.spark, f"{self.location}/pending")
        fs.mkdirs(self.spark, f"{self.location}/resuming")
        numbered.write.mode("overwrite").parquet(self._pending(run))
        return self.spark.read.schema(numbered.schema).parquet(self._pending(run))

    def resume(self, run: str, done: set[int], input_path: str, glob_filter: str | None) -> DataFrame | None:
        """The work list of a run that died, or ``None``.  Batches in ``done``
        stay as they were read; of the others, files are taken as they are now
        (one that was rewritten meanwhile counts with its new time and length,
        one that is gone is left out)."""
        where = self._pending(run)
        if not fs.exists(self.spark, f"{where}/_SUCCESS"):
            return None
        work = self.spark.read.schema(f"{SCHEMA}, batch long").parquet(where)
        read = F.col("batch").isin(sorted(done))
        now = listing(self.spark, input_path, glob_filter).join(work.where(~read).select("path", "batch"), "path")
        fresh = work.where(read).unionByName(now.select(work.columns))
        fresh.write.mode("overwrite").parquet(f"{self.location}/resuming/{run}")
        fs.delete(self.spark, where)
        fs.rename(self.spark, f"{self.location}/resuming/{run}", where)
        return self.spark.read.schema(work.schema).parquet(where)

    def settle(self, published: str | None, keep: str | None = None) -> None:
        """Commit the pending run that was published, drop the others but ``keep``."""
        for run in fs.list_names(self.spark, f"{self.location}/pending"):
            if run == published:
                fs.mkdirs(self.spark, self.committed)
                fs.rename(self.spark, self._pending(run), f"{self.committed}/{run}")
            elif run != keep:
                fs.delete(self.spark, self._pending(run))
        runs = fs.list_names(self.spark, self.committed)
        if len(runs) >= COMPACT_RUNS:
            # dying between the two steps leaves rows twice, which the anti-join does not mind
            made = f"all-{uuid.uuid4().hex[:12]}"
            self.seen().distinct().write.parquet(f"{self.location}/compacting/{made}")
            fs.rename(self.spark, f"{self.location}/compacting/{made}", f"{self.committed}/{made}")
            for run in runs:
                fs.delete(self.spark, f"{self.committed}/{run}")

    def skip_existing(self, input_path: str, glob_filter: str | None) -> None:
        """First run of a feed that leaves out what is there already: all files count as read."""
        if not fs.exists(self.spark, f"{self.location}/started"):
            listing(self.spark, input_path, glob_filter).write.mode("overwrite").parquet(f"{self.committed}/existing")
            fs.write_text(self.spark, f"{self.location}/started", "")
