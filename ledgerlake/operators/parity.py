"""Set operations: output parity, missing items, ordered unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus of ``a`` (negative: surplus of ``b``).

    Same answer as EXCEPT ALL in both directions, in one grouping with one signed count per row.
    """
    columns = a.columns
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.select(*columns).withColumn("_n", F.lit(-1)))
    return signed.groupBy(*columns).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag equality of two results: rows of each side, rows only on one side, verdict."""
    columns = a.columns
    signed = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.select(*columns).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    per_row = signed.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))

    def total(c) -> F.Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_row.agg(
        total("_a").alias("left_rows"),
        total("_b").alias("right_rows"),
        total(F.greatest(F.col("_a") - F.col("_b"), F.lit(0))).alias("only_left"),
        total(F.greatest(F.col("_b") - F.col("_a"), F.lit(0))).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def missing(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected items that are not there."""
    return expected.join(actual.select(*expected.columns), expected.columns, "left_anti")


def ordered_union(lists: Sequence[DataFrame], item: str, position: str) -> DataFrame:
    """Items of several lists without repetition, each with its first place.

    Lists come in precedence order; within a list ``position`` orders. The result holds ``item``,
    ``list_no`` and ``position``; its order is by the latter two.
    """
    firsts = [
        df.groupBy(item).agg(F.min(F.col(position).cast("bigint")).alias("position")).withColumn("list_no", F.lit(i))
        for i, df in enumerate(lists)
    ]
    out = firsts[0]
    for df in firsts[1:]:
        out = out.unionByName(df)
    place = F.min(F.struct("list_no", "position")).alias("place")
    return out.groupBy(item).agg(place).select(item, "place.list_no", "place.position")
