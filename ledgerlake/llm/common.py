"""Pieces that several operators share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import stage

ROWS_PER_PART = 4_096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty. Needs no array of the words."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.regexp_replace(spaced, "^ | $", "")
    blanks = F.length(trimmed) - F.length(F.translate(trimmed, " ", ""))
    return F.when(F.length(trimmed) == 0, F.lit(0).cast("long")).otherwise((blanks + 1).cast("long"))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id's digits, modulo ``by``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by))


def staged(df: DataFrame, name: str) -> DataFrame:
    """A written table in the shared folder, read again."""
    return stage(df, name)


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``row_key, row``: ``docs`` written once, each row as one struct with a number of its own, so that no column can clash."""
    return staged(docs.select(F.monotonically_increasing_id().alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "keyed")


def unkeyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def hex_bucket(digest: Column, buckets: Column) -> Column:
    """Which of ``buckets`` equal ranges of hexadecimal digests a digest is in; keeps their order."""
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(share * buckets / F.lit(4294967296)).cast("long")


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what is sent to a Python worker at once by its bytes, for this session: rows with whole texts or sets are large."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def on_workers(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers' path.

    Workers on other machines get the package from ``--py-files`` or an installation; those of a local
    session may have been started from any folder.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(x for x in (root, environment.get("PYTHONPATH", "")) if x)
    return df.mapInArrow(function, schema)
