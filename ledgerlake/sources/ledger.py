"""Which landing files have been read: a table of files that is compared with a listing, not with the data."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import stage
from ledgerlake.sources.files import file_name, listing, plain

LEDGER = "ingest_ledger"
SOURCE_FILE = "_source_file"
BEGUN, DONE = "begun", "done"
_SCHEMA = "feed string, path string, length bigint, modified timestamp, run string, state string, noted_at timestamp"


class FileLedger:
    """Files of landing feeds that a database's Bronze tables hold.

    A run notes its files as begun, appends their rows, and notes them as done. A file that was begun and never done, because the
    run was lost, counts as read if the table holds rows of it: only then is the table looked at, and only its file names.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.name = spark, f"{database}.{LEDGER}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_SCHEMA}) USING parquet")

    def rows(self, feed: str) -> DataFrame:
        return self.spark.table(self.name).where(F.col("feed") == feed)

    def _note(self, files: DataFrame, feed: str, run: Column, state: str) -> None:
        noted = files.select(
            F.lit(feed).alias("feed"), "path", "length", "modified", run.alias("run"), F.lit(state).alias("state"), F.current_timestamp().alias("noted_at")
        )
        noted.coalesce(1).write.format("parquet").mode("append").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def settle(self, feed: str, table: str) -> None:
        """Note the files of lost runs as done where their rows arrived."""
        states = self.rows(feed).groupBy("path", "length", "modified", "run").agg(F.array_sort(F.collect_set("state")).alias("states"))
        lost = states.where(F.array_size("states") == 1).where(F.col("states")[0] == BEGUN)
        if lost.isEmpty() or not self.spark.catalog.tableExists(table):
            return
        held = self.spark.table(table).select(file_name(F.col(SOURCE_FILE)).alias("held")).distinct()
        arrived = lost.join(held, plain(F.col("path")) == F.col("held"), "left_semi")
        self._note(stage(arrived.drop("states"), "settled"), feed, F.col("run"), DONE)

    def new_files(self, feed: str, root: str) -> DataFrame:
        """``path, length, modified`` of the files below ``root`` that were never read.

        A file that was read and has another length or time since then is an error: its rows are in the table already.
        """
        read = self.rows(feed).where(F.col("state") == DONE).select("path", F.struct("length", "modified").alias("was")).groupBy("path").agg(F.max_by("was", "was.modified").alias("was"))
        found = listing(self.spark, root).join(read, "path", "left")
        changed = found.where("was is not null and not (was.length = length and was.modified = modified)").select("path").limit(5).collect()
        if changed:
            raise ValueError(f"files changed after they were read: {[r.path for r in changed]}")
        return found.where("was is null").select("path", "length", "modified")

    def begin(self, feed: str, files: DataFrame) -> str:
        run = uuid.uuid4().hex
        self._note(files, feed, F.lit(run), BEGUN)
        return run

    def finish(self, feed: str, run: str) -> None:
        begun = self.rows(feed).where((F.col("run") == run) & (F.col("state") == BEGUN))
        self._note(stage(begun.select("path", "length", "modified"), "finished"), feed, F.lit(run), DONE)

