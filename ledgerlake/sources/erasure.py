"""Erasing rows from stored tables, file by file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import erase
from ledgerlake.sources.files import children, delete, exists, file_name, literal, move

MARK = "_erase-"


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def files_with(df: DataFrame, keys_df: DataFrame) -> list[str]:
    """Files of a file-based frame that hold a row with one of the keys."""
    keys = keys_df.columns
    hit = df.select(*keys, F.col("_metadata.file_path").alias("_file")).join(keys_df, keys, "left_semi")
    return sorted(r.path for r in hit.select(file_name(F.col("_file")).alias("path")).distinct().collect())


def finish_erasures(spark: SparkSession, location: str) -> int:
    """Complete erasures that were broken off; returns how many.

    One whose survivors and list of files are complete goes on where it stopped; anything less is taken away, the table's files are untouched then.
    """
    done = 0
    for folder in children(spark, location):
        if not folder.rsplit("/", 1)[1].startswith(MARK):
            continue
        if exists(spark, f"{folder}/files/_SUCCESS"):
            _swap(spark, location, folder)
            done += 1
        delete(spark, [folder])
    return done


def _swap(spark: SparkSession, location: str, folder: str) -> None:
    delete(spark, [r.value for r in spark.read.text(f"{folder}/files").collect()])
    number = folder.rsplit(MARK, 1)[1]
    rows = f"{folder}/rows"
    waiting = children(spark, rows)
    while waiting:
        path = waiting.pop()
        name = path.rsplit("/", 1)[1]
        if name.endswith(".parquet"):
            below = path[path.index(f"{MARK}{number}/rows/") + len(f"{MARK}{number}/rows/") :]
            move(spark, path, f"{location}/{below}")
        elif "=" in name:  # folder of a partition
            waiting += children(spark, path)


def erase_rows(spark: SparkSession, name: str, keys_df: DataFrame) -> list[str]:
    """Delete all rows of table ``name`` whose key is listed; returns the files that held any.

    Only these files are read in full and written anew without the rows; all others keep their names and content. Survivors
    are written to a hidden folder of the table first, then a list of the files to go, and only then files are deleted and survivors
    moved in: an erasure that breaks off is completed by the next one or by ``finish_erasures``. While files are swapped, readers may miss survivors, but they never
    see a row twice. No erased row is left below the table's folder. Keys that are null erase nothing. The list of files is on the driver, as every reader's listing is.
    """
    location = table_location(spark, name)
    if finish_erasures(spark, location):
        spark.catalog.refreshTable(name)
    table = spark.table(name)
    hit = files_with(table, keys_df)
    if not hit:
        return hit
    folder = f"{location}/{MARK}{uuid.uuid4().hex}"
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    data = [f for f in table.schema.fields if f.name not in partitions]
    rows = spark.read.schema(table.schema).option("basePath", location).parquet(*map(literal, hit))
    survivors = erase(rows, keys_df).select(*[f.name for f in data], *partitions)
    writer = survivors.write.partitionBy(*partitions) if partitions else survivors.write
    writer.parquet(f"{folder}/rows")
    spark.createDataFrame([(f,) for f in hit], "value string").coalesce(1).write.text(f"{folder}/files")
    _swap(spark, location, folder)
    delete(spark, [folder])
    spark.catalog.refreshTable(name)
    return hit
