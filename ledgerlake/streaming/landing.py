"""Incremental landing: the batch scan and Bronze append, run over new files only."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans.specs import SPECS
from ledgerlake.sources.feeds import FOLDER_DATE, add_audit, feed_schema, folder_date, reader_options


def land_new_files(spark: SparkSession, source: str, feed: str, target: str, checkpoint: str):
    """Append files that appeared since the last run to the Bronze folder ``target``, then stop.

    Same rows and columns as scan, audit columns and append in batch mode; the checkpoint remembers the files
    read, so a restarted run neither repeats nor skips any. Keep it in shared storage.
    """
    spec = SPECS[feed]
    options = {k: v for k, v in reader_options(spec).items() if k != "enforceSchema"}
    stream = spark.readStream.format(spec.file_format).schema(feed_schema(spec)).options(**options).load(source)
    if spec.dated:
        stream = stream.withColumn(FOLDER_DATE, folder_date(F.col("_metadata.file_path")))
    query = (
        add_audit(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    return spark.read.parquet(target)
