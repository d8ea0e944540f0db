"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import norm_key

BROADCAST_LIMIT = 10 * 1024 * 1024
PARTS = 10_000
LEAST_ROWS = 1_000_000


def plan_bytes(df: DataFrame) -> int | None:
    """Size of ``df`` as the optimizer estimates it, None when it cannot be asked."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT,
    parts: int = PARTS,
    least_rows: int = LEAST_ROWS,
    size: int | None = None,
) -> DataFrame:
    """Join a fact table to a dimension that has one row per key.

    The dimension is broadcast only when its estimated size is within ``limit``. Beyond that both sides
    are shuffled. A piece is one part in ``parts`` of all rows, ``least_rows`` at least; every key with more
    rows is cut into as many pieces as its count asks for by a hash of ``spread_by`` (row-identifying
    columns), and only its dimension row is repeated. Fewer than ``parts`` keys can be that frequent, so
    the table of them that is broadcast stays small whatever the size of the data.

    ``size`` is a bound of the dimension's size that the caller knows better than the optimizer, whose
    estimate of a joined dimension is the product of both sides.

    ``count_on`` is a cheaper frame with the same keys to count, such as the stored table ``fact`` was
    made from.
    """
    if how not in ("left", "inner"):
        raise ValueError("join_dim keeps facts: how must be left or inner")
    on = list(on)
    size = plan_bytes(dim) if size is None else size
    if size is not None and size <= limit:
        return fact.join(F.broadcast(dim), on, how)
    counted = fact if count_on is None else count_on
    total = counted.agg(F.count(F.lit(1))).scalar()
    piece = F.greatest(F.ceil(total / F.lit(parts)), F.lit(least_rows).cast("bigint"))
    hot = (
        counted.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).withColumn("_piece", piece)
        .where("_n > _piece").select(*on, F.ceil(F.col("_n") / F.col("_piece")).alias("_salts"))
    )
    spread = spread_by or [c for c in fact.columns if c not in on] or on
    no_key = F.lit(False)
    for k in on:  # rows without a key match nothing, but must not meet in one task either
        no_key = no_key | F.col(k).isNull()
    salts = F.coalesce(F.when(no_key, F.lit(parts)).otherwise(F.col("_salts")), F.lit(1)).cast("bigint")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
    salted = fact.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts)).drop("_salts")
    repeated = dim.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def left_preagg(fact: DataFrame, child: DataFrame, key: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Left join to a 1:N child that is first reduced to one row per key; misses become 0.

    Facts without a key match nothing; they get a join key of their own, so they do not meet in one task.
    """
    reduced = child.where(F.col(key).isNotNull()).groupBy(key).agg(*[e.alias(n) for n, e in aggs.items()])
    types = dict(reduced.dtypes)
    alone = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])).otherwise(F.lit(0).cast("bigint"))
    joined = fact.withColumn("_alone", alone).join(reduced.withColumn("_alone", F.lit(0).cast("bigint")), [key, "_alone"], "left").drop("_alone")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast(types[n])) for n in aggs})


def orphan_reports(feeds: Mapping[str, Sequence[tuple[str, Column, bool]]], frames: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows without a parent on every edge, before and after key normalisation.

    ``feeds`` gives for each frame its ends: ``(edge, key, is_child)``. A row of a frame becomes one row for each of its ends, so every frame is read once however
    many edges it has; children and parents of an edge then meet by counting, per spelling of the key and per normalised key, and no join is needed: a key has a parent if one was
    counted. Rows without a key are neither orphans nor parents.
    """
    spark = next(iter(frames.values())).sparkSession
    parts = [
        frames[name].select(F.inline(F.array(*[
            F.struct(F.lit(edge).alias("edge"), key.cast("string").alias("k"), F.lit(int(is_child)).cast("bigint").alias("n")) for edge, key, is_child in ends
        ])))
        for name, ends in feeds.items()
    ]
    ends = reduce(DataFrame.unionByName, parts).where("k is not null")
    spelled = ends.groupBy("edge", "k").agg(F.sum("n").alias("n"), F.bool_or(F.col("n") == 0).alias("found"))
    lost, used = ~F.col("found"), F.col("n") > 0
    per_key = spelled.groupBy("edge", norm_key("k").alias("k")).agg(
        F.sum("n").alias("n"), F.bool_or("found").alias("found"), F.sum(F.when(lost, F.col("n"))).alias("lost_n"), F.count_if(lost & used).alias("lost_keys")
    )
    totals = per_key.groupBy("edge").agg(
        F.sum("n").alias("n"), F.sum("lost_n").alias("before_n"), F.sum("lost_keys").alias("before_keys"),
        F.sum(F.when(lost, F.col("n"))).alias("after_n"), F.count_if(lost & used).alias("after_keys"),
    )
    names = list(dict.fromkeys(edge for ends in feeds.values() for edge, _, _ in ends))
    every = spark.createDataFrame([(n,) for n in names], "edge string").join(totals, "edge", "left").fillna(0)
    rows = [
        F.struct(
            F.lit(stage).alias("stage"), F.col("n").alias("child_rows"), F.col(f"{stage}_n").alias("orphan_rows"), F.col(f"{stage}_keys").alias("orphan_keys"),
        )
        for stage in ("before", "after")
    ]
    return every.select("edge", F.inline(F.array(*rows)))


def orphan_report(child: DataFrame, parent: DataFrame, fk: Column, pk: Column, edge: str) -> DataFrame:
    """``orphan_reports`` of a single edge."""
    return orphan_reports({"child": [(edge, fk, True)], "parent": [(edge, pk, False)]}, {"child": child, "parent": parent})


def hash_parity(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """How often two tables hold the same digest for the same key, as rows of ``a`` and a rate.

    ``b`` has one row per key. ``a`` is counted per (key, digest) before the join.
    """
    left = a.groupBy(key, F.col(column).alias("left_digest")).agg(F.count(F.lit(1)).alias("n"))
    both = left.join(b.select(key, F.col(column).alias("right_digest")), key, "inner")
    equal = F.coalesce(F.col("left_digest") == F.col("right_digest"), F.lit(False))
    return both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("compared_rows"),
        F.coalesce(F.sum(F.when(equal, F.col("n"))), F.lit(0)).alias("equal_rows"),
    ).withColumn("parity_rate", F.round(F.try_divide(F.col("equal_rows").cast("double"), F.col("compared_rows")), 6))


def fanout_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys have 1, 2, 3, … rows."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key"))
    return per_key.groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("keys"))


def fanout_inflation(fact: DataFrame, child: DataFrame, key: str, amount: str, child_amount: str) -> DataFrame:
    """Totals a direct 1:N join would report next to those of the pre-aggregated join.

    A fact row with n children appears max(n, 1) times in the direct join, so its totals follow from the
    counts; the inflated rows are never produced.
    """
    joined = left_preagg(fact, child, key, {"n": F.count(F.lit(1)), "child_total": F.sum(child_amount)})
    copies = F.greatest(F.col("n"), F.lit(1))
    return joined.agg(
        F.count(F.lit(1)).alias("preagg_rows"),
        F.sum(copies).alias("naive_rows"),
        F.sum(amount).cast("decimal(38,2)").alias("preagg_amount"),
        F.sum(F.col(amount) * copies).cast("decimal(38,2)").alias("naive_amount"),
        F.sum("child_total").cast("decimal(38,2)").alias("child_amount"),
    ).withColumn("inflation", (F.col("naive_amount") - F.col("preagg_amount")).cast("decimal(38,2)"))
