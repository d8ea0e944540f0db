"""The stages in order: landing zone, Bronze, Silver, Gold, reconciliation, quality scan, gate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.gates import Rule, dq_scan
from ledgerlake.plans.gold import build_gold
from ledgerlake.plans.reconcile import promotion_gate, reconcile
from ledgerlake.plans.silver import build_silver
from ledgerlake.plans.specs import SPECS
from ledgerlake.session import new_path, stage_compact
from ledgerlake.sources.feeds import database_name, ingest, register_external, replace_table, write_clustered
from ledgerlake.sources.files import delete, scratch

GOLD_TABLE = "gold_fraud_features"
CLUSTERING = ("customer_id", "loyalty_tier")


class Run(NamedTuple):
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: DataFrame
    reconciliation: DataFrame
    quality: DataFrame
    gate: DataFrame


def table_store(spark: SparkSession, database: str) -> Callable[[DataFrame, str], DataFrame]:
    """Store for ``build_silver``: tables of the tier in their database, intermediate results as staged files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def store(df: DataFrame, name: str) -> DataFrame:
        return replace_table(df, f"{database}.{name}", keep_old=False) if name.endswith("_silver") else stage_compact(df, name)

    return store


def run_medallion(
    spark: SparkSession,
    root: str,
    rules: Sequence[Rule],
    unit: str = "fraud",
    env: str = "dev",
    folders: Mapping[str, str] | None = None,
    keep_landing: bool = True,
) -> Run:
    """Run every stage on the landing zone below ``root``.

    Bronze keeps all rows and clear-text identifiers, the latter under a policy tag; Silver and Gold
    hold digests only. The last three frames are evaluated when they are read. Without ``keep_landing``
    the landing zone is deleted as soon as Bronze holds its rows.
    """
    bronze = ingest(spark, root, folders or {f: f for f in SPECS}, unit, env)
    if not keep_landing:
        delete(spark, [root])
    with scratch(spark):  # cleaned transactions, which the Silver table repeats
        silver = build_silver(bronze, table_store(spark, database_name(unit, "silver", env)))
    gold_db = database_name(unit, "gold", env)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold_db}")
    path = new_path(spark, GOLD_TABLE)
    write_clustered(build_gold(silver), path, CLUSTERING)
    gold = register_external(spark, f"{gold_db}.{GOLD_TABLE}", path)
    recon = reconcile(silver["payment_transactions"], silver["chargeback_disputes"], gold)
    return Run(bronze, silver, gold, recon, dq_scan(gold, rules), promotion_gate(recon))
