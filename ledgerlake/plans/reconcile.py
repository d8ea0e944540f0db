"""Proof that Gold still holds what Silver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import fixed2
from ledgerlake.plans.gold import MONEY, with_disputes


def silver_rollup(silver_tx: DataFrame, silver_disputes: DataFrame) -> DataFrame:
    """Silver totals by payment method, disputes joined pre-aggregated."""
    return with_disputes(silver_tx, silver_disputes).groupBy("payment_method").agg(
        F.count("transaction_id").alias("silver_tx_count"),
        F.sum("tx_amount").cast(MONEY).alias("silver_gross_usd"),
        F.sum("net_amount_after_discount").cast(MONEY).alias("silver_net_usd"),
        F.sum("dispute_count").alias("silver_dispute_count"),
        F.count_if(F.col("dispute_count") > 0).alias("silver_disputed_tx_count"),
        F.sum("disputed_amount").cast(MONEY).alias("silver_disputed_usd"),
    )


def gold_rollup(gold: DataFrame) -> DataFrame:
    return gold.groupBy("payment_method").agg(
        F.sum("total_tx_count").alias("gold_tx_count"),
        F.sum("total_tx_amount").cast(MONEY).alias("gold_gross_usd"),
        F.sum("total_net_amount").cast(MONEY).alias("gold_net_usd"),
        F.sum("disputed_tx_count").alias("gold_disputed_tx_count"),
        F.sum("total_disputed_amount").cast(MONEY).alias("gold_disputed_usd"),
    )


def reconcile_rollups(silver: DataFrame, gold: DataFrame, how: str = "full") -> DataFrame:
    """Side by side per payment method with differences, ordered by method.

    ``how='full'`` also reports a method that one side lacks (as zeros against its totals, and a
    missing method matches a missing method); ``'inner'`` shows only methods of both sides.
    """
    g = gold.withColumnRenamed("payment_method", "_method")
    both = silver.join(g, F.col("payment_method").eqNullSafe(F.col("_method")), how)
    counts = ["silver_tx_count", "gold_tx_count", "silver_dispute_count", "silver_disputed_tx_count", "gold_disputed_tx_count"]
    sums = [f"{side}_{m}_usd" for side in ("silver", "gold") for m in ("gross", "net", "disputed")]
    zero = {n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in counts}
    zero |= {n: F.coalesce(F.col(n), F.lit(0).cast(MONEY)) for n in sums}
    filled = both.withColumns(zero)
    columns = [
        F.coalesce("payment_method", "_method").alias("payment_method"),
        F.col("silver_tx_count"),
        F.col("gold_tx_count"),
        (F.col("silver_tx_count") - F.col("gold_tx_count")).alias("row_count_diff"),
    ]
    for m in ("gross", "net", "disputed"):
        s, g_ = F.col(f"silver_{m}_usd"), F.col(f"gold_{m}_usd")
        columns += [
            fixed2(s).alias(f"silver_{m}_usd"),
            fixed2(g_).alias(f"gold_{m}_usd"),
            fixed2(s - g_).alias(f"{m}_variance_usd"),
        ]
    columns += [
        F.col("silver_dispute_count"),
        F.col("silver_disputed_tx_count"),
        F.col("gold_disputed_tx_count"),
        (F.col("silver_disputed_tx_count") - F.col("gold_disputed_tx_count")).alias("disputed_tx_count_diff"),
    ]
    return filled.select(*columns).orderBy("payment_method")


def reconcile(silver_tx: DataFrame, silver_disputes: DataFrame, gold: DataFrame, how: str = "full") -> DataFrame:
    return reconcile_rollups(silver_rollup(silver_tx, silver_disputes), gold_rollup(gold), how)


def promotion_gate(recon: DataFrame, tolerance: str = "0.00") -> DataFrame:
    """One row: promote only when there are rows and every difference is within the tolerance."""
    limit = F.lit(tolerance).cast(MONEY)
    money_ok = [F.abs(F.col(f"{m}_variance_usd").cast(MONEY)) <= limit for m in ("gross", "net", "disputed")]
    ok = (F.col("row_count_diff") == 0) & (F.col("disputed_tx_count_diff") == 0) & money_ok[0] & money_ok[1] & money_ok[2]
    return recon.agg(
        F.count(F.lit(1)).alias("methods"),
        F.count_if(~ok).alias("failing_methods"),
        F.coalesce(F.bool_and(ok), F.lit(False)).alias("promote"),
    )
