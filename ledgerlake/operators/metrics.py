"""Counts and sums that certify a tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import MEASURE, fixed2
from ledgerlake.functions.features import features_valid, is_anomaly
from ledgerlake.functions.privacy import is_digest
from ledgerlake.operators.hygiene import benign_null
from ledgerlake.plans.specs import RING_DEVICE, FeedSpec

_ABSENT = -1


def _n(c) -> F.Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def bronze_audit(df: DataFrame) -> DataFrame:
    """Rows and filled audit columns; -1 where the table lacks the columns."""
    columns = ("_ingestion_timestamp", "_source_file")
    present = all(c in df.columns for c in columns)
    counts = [F.count(c) if present else F.lit(_ABSENT).cast("bigint") for c in columns]
    return df.agg(F.count(F.lit(1)).alias("cnt"), counts[0].alias("ts_cnt"), counts[1].alias("src_cnt"))


def ring_size_expr(device: str = RING_DEVICE) -> F.Column:
    return F.count_distinct(F.when(F.col("device_id") == device, F.col("customer_id")))


def ring_size(df: DataFrame, device: str = RING_DEVICE) -> DataFrame:
    """Different customers seen on one device."""
    return df.agg(ring_size_expr(device).alias("ring_cnt"))


def silver_metrics(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows, benign nulls, the two certified sums and, where the features exist, their counts."""
    def total(column: str) -> F.Column:
        """Measures are doubles, whose sum would depend on the order of rows."""
        return F.sum(F.col(column).cast("decimal(18,2)") if spec.roles.get(column) == MEASURE else F.col(column))

    secondary = total(spec.secondary)
    aggs = [
        F.count(F.lit(1)).alias("cnt"),
        F.count_if(benign_null(spec)).alias("n4_cnt"),
        fixed2(total(spec.metric)).alias("p_sum"),
        (secondary.cast("string") if spec.secondary_is_count else fixed2(secondary)).alias("s_sum"),
    ]
    if {"geo_distance_km", "velocity_1h"} <= set(df.columns):
        aggs += [
            F.count_if(features_valid()).alias("feat_cnt"),
            F.count_if(is_anomaly()).alias("anomaly_cnt"),
            ring_size_expr().alias("ring_cnt"),
        ]
    else:
        aggs += [F.lit(_ABSENT).cast("bigint").alias(n) for n in ("feat_cnt", "anomaly_cnt", "ring_cnt")]
    return df.agg(*aggs).select(F.lit(f"{spec.name}_silver").alias("table_name"), "*")


def hash_format_counts(df: DataFrame) -> DataFrame:
    """Rows and well-formed digests; -1 for a digest column the table lacks."""
    def valid(c: str) -> F.Column:
        return F.count_if(is_digest(c)) if c in df.columns else F.lit(_ABSENT).cast("bigint")

    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        valid("masked_ssn").alias("valid_ssn_cnt"),
        valid("masked_email").alias("valid_email_cnt"),
    )


def gold_totals(gold: DataFrame) -> DataFrame:
    """Grand totals of the mart, money as text with two decimals."""
    counts = ("total_tx_count", "high_risk_mcc_tx_count", "ato_mfa_tx_count", "disputed_tx_count")
    sums = (
        "total_tx_amount", "total_net_amount", "high_risk_mcc_amount", "ato_mfa_tx_amount",
        "total_disputed_amount", "total_penalty_fee_usd",
    )
    return gold.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        *[F.sum(c).alias(c) for c in counts],
        *[fixed2(F.sum(c)).alias(c) for c in sums],
    )


def spot_check(df: DataFrame, expected: DataFrame, key: str = "customer_id") -> DataFrame:
    """Compare digests of named rows with expected ones; a named row that is missing fails.

    ``expected`` holds the key and the columns to compare.
    """
    columns = [c for c in expected.columns if c != key]
    wanted = expected.select(key, *[F.col(c).alias(f"expected_{c}") for c in columns])
    # reduce the large table to the named rows first, then report every named row
    found = df.select(key, *columns).join(wanted.select(key), key, "left_semi")
    return wanted.join(found, key, "left").select(
        key, *[F.coalesce(F.col(c) == F.col(f"expected_{c}"), F.lit(False)).alias(f"{c}_ok") for c in columns]
    )


def layer_progression(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows and columns per (table, layer)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for (table, layer), df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
