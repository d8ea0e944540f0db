"""Silver to Gold: the feature mart, one row per customer and payment method."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import fill_defaults
from ledgerlake.functions.features import is_anomaly
from ledgerlake.operators.joins import join_dim
from ledgerlake.plans.specs import HIGH_RISK_CATEGORIES

MONEY = "decimal(38,2)"
GOLD_COLUMNS = (
    "customer_id", "payment_method", "loyalty_tier", "total_tx_count", "total_tx_amount", "total_net_amount",
    "high_risk_mcc_tx_count", "high_risk_mcc_amount", "ato_mfa_tx_count", "ato_mfa_tx_amount",
    "disputed_tx_count", "total_disputed_amount", "total_penalty_fee_usd",
)


def disputes_by_tx(disputes: DataFrame) -> DataFrame:
    """Disputes reduced to one row per transaction, before any join."""
    return disputes.groupBy("transaction_id").agg(
        F.count("dispute_id").alias("dispute_count"),
        F.round(F.sum("dispute_amount"), 2).cast(MONEY).alias("disputed_amount"),
        F.round(F.sum("penalty_fee_usd"), 2).cast(MONEY).alias("penalty_fee_usd"),
    )


def with_disputes(tx: DataFrame, disputes: DataFrame) -> DataFrame:
    """Transactions with their dispute totals, 0 where there are none."""
    joined = tx.join(disputes_by_tx(disputes), "transaction_id", "left")
    return fill_defaults(joined, {"dispute_count": 0, "disputed_amount": 0, "penalty_fee_usd": 0})


def build_gold(
    silver: Mapping[str, DataFrame],
    high_risk: Sequence[str] = HIGH_RISK_CATEGORIES,
    anomaly_velocity: int = 5,
    anomaly_km: float = 500.0,
) -> DataFrame:
    """Five-table join and roll-up.

    Each table is reduced before the join that could meet a hot key: disputes per transaction, device
    log-ins per (customer, device), transactions per (customer, method, device, flags), and customers
    only meet the finished rows. A transaction is an account-takeover suspect when it is anomalous and
    its customer logged in on its device without a second factor.
    """
    tx = silver["payment_transactions"].select(
        "transaction_id", "customer_id", "merchant_id", "device_id", "payment_method", "tx_amount",
        "net_amount_after_discount", is_anomaly(anomaly_velocity, anomaly_km).alias("anomaly"),
    )
    merchants = silver["merchants_stores"].select(
        "merchant_id", F.col("merchant_category").isin(*high_risk).alias("high_risk")
    )
    facts = join_dim(
        with_disputes(tx, silver["chargeback_disputes"]), merchants, ["merchant_id"], "left", ["transaction_id"], count_on=tx
    )
    per_device = facts.groupBy(
        "customer_id", "payment_method", "device_id", "anomaly",
        F.coalesce("high_risk", F.lit(False)).alias("high_risk"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("tx_amount").alias("amount"),
        F.sum("net_amount_after_discount").alias("net"),
        F.count_if(F.col("dispute_count") > 0).alias("disputed_n"),
        F.sum("disputed_amount").alias("disputed"),
        F.sum("penalty_fee_usd").alias("penalty"),
    )
    no_mfa = (
        silver["device_auth_logs"].groupBy("customer_id", "device_id")
        .agg(F.bool_or(F.col("mfa_method").isNull()).alias("no_mfa"))
    )
    rows = per_device.join(no_mfa, ["customer_id", "device_id"], "left")
    takeover = F.col("anomaly") & F.coalesce("no_mfa", F.lit(False))

    def money(value, name, condition=None):
        v = F.col(value) if condition is None else F.when(condition, F.col(value))
        return F.coalesce(F.sum(v), F.lit(0)).cast(MONEY).alias(name)

    def count(value, name, condition=None):
        v = F.col(value) if condition is None else F.when(condition, F.col(value))
        return F.coalesce(F.sum(v), F.lit(0)).alias(name)

    per_method = rows.groupBy("customer_id", "payment_method").agg(
        count("n", "total_tx_count"),
        money("amount", "total_tx_amount"),
        money("net", "total_net_amount"),
        count("n", "high_risk_mcc_tx_count", F.col("high_risk")),
        money("amount", "high_risk_mcc_amount", F.col("high_risk")),
        count("n", "ato_mfa_tx_count", takeover),
        money("amount", "ato_mfa_tx_amount", takeover),
        count("disputed_n", "disputed_tx_count"),
        money("disputed", "total_disputed_amount"),
        money("penalty", "total_penalty_fee_usd"),
    )
    tiers = silver["customers_crm"].select("customer_id", "loyalty_tier")
    gold = per_method.join(tiers, "customer_id", "left")
    return fill_defaults(gold, {"loyalty_tier": "UNASSIGNED"}).select(*GOLD_COLUMNS)
