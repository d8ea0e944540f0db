"""Trailing-window transaction counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970. Zone-less timestamps are taken field by field: a conversion or difference
    would go through the session's time zone, which skips and repeats hours."""
    if dict(df.dtypes)[ts] != "timestamp_ntz":
        return F.unix_micros(ts)
    t = F.col(ts)
    seconds = F.unix_date(t.cast("date")).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def velocity_by_instant(
    df: DataFrame, key: str, ts: str, seconds: int, out: str, slice_seconds: int = 1
) -> DataFrame:
    """One row per (key, instant) with the key's rows in the trailing window, both ends included.

    Same numbers as ``count(*) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL .. PRECEDING
    AND CURRENT ROW)``. That frame recounts its content for every row and needs all rows of a key in
    one task. Here equal instants are counted before the shuffle; time is cut into buckets as long as
    the window, and each count also enters the next bucket as an expiry:

        velocity(q) = arrivals in the bucket up to q + expiries of the bucket at or after q

    Both are prefix sums, and taken on two levels: a bucket is cut into slices of ``slice_seconds``, totals of slices
    give the sum before each, and the rows of one slice are summed up by themselves. So a task holds one
    (key, slice), with two rows for each microsecond at most, or the totals of one bucket, at most one for each second of the
    window; a key whose rows all fall into one hour is spread over 3,600 slices.
    """
    width, step = seconds * 1_000_000, slice_seconds * 1_000_000
    counted = (
        df.select(F.col(key), _micros(df, ts).alias("_t"))
        .where(F.col(key).isNotNull() & F.col("_t").isNotNull())
        .groupBy(key, "_t")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    bucket = F.col("_t") - F.pmod(F.col("_t"), F.lit(width))  # start of the bucket
    arrival = F.struct(bucket.alias("b"), F.col("_t").alias("t"), F.lit(0).alias("expiry"), F.col("_n").alias("n"))
    expiry = F.struct((bucket + width).alias("b"), (F.col("_t") + width).alias("t"), F.lit(1).alias("expiry"), F.col("_n").alias("n"))
    moves = counted.select(key, F.inline(F.array(arrival, expiry))).withColumn(
        "s", F.floor((F.col("t") - F.col("b")) / F.lit(step)).cast("int")
    )
    delta = F.when(F.col("expiry") == 0, F.col("n")).otherwise(-F.col("n"))
    # sums of whole slices: what came before a slice, and all that leaves in its bucket
    bucket_rows = Window.partitionBy(key, "b")
    before = bucket_rows.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    totals = moves.groupBy(key, "b", "s").agg(
        F.sum(delta).alias("delta"), F.sum(F.when(F.col("expiry") == 1, F.col("n"))).alias("leaving"), F.count_if(F.col("expiry") == 0).alias("asked")
    )
    offsets = totals.select(
        key, "b", "s", "asked", (F.coalesce(F.sum("delta").over(before), F.lit(0)) + F.coalesce(F.sum("leaving").over(bucket_rows), F.lit(0))).alias("offset")
    ).where("asked > 0").drop("asked")  # slices in which nothing arrives have no rows to answer
    inside = Window.partitionBy(key, "b", "s").orderBy("t", "expiry").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    arrived = moves.withColumn("inside", F.sum(delta).over(inside)).where("expiry = 0")
    return arrived.join(offsets, [key, "b", "s"]).select(key, F.col("t").alias("_t"), (F.col("inside") + F.col("offset")).alias(out))


def velocity(
    df: DataFrame, key: str = "customer_id", ts: str = "tx_ts", seconds: int = 3600, out: str = "velocity_1h"
) -> DataFrame:
    """Add the trailing count to every row (NULL where key or timestamp is missing).

    ``df`` is read twice, so pass a stored table rather than a long plan.
    """
    per_instant = velocity_by_instant(df, key, ts, seconds, out).withColumn("_known", F.lit(True))
    t = _micros(df, ts)
    known = F.col(key).isNotNull() & t.isNotNull()
    # rows that match nothing get a join key of their own, so they do not meet in one task
    place = F.when(known, t).otherwise(F.xxhash64(*df.columns))
    rows = df.withColumns({"_t": place, "_known": known})
    return rows.join(per_instant, [key, "_t", "_known"], "left").drop("_t", "_known")
