"""Bronze to Silver: typed, repaired, deduplicated and de-identified tables with fraud features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import cleanse as c
from ledgerlake.functions.features import haversine_km, net_amount
from ledgerlake.functions.privacy import drop_pii, hash_email, hash_ssn
from ledgerlake.operators.dedup import dedup_latest, row_digest
from ledgerlake.operators.hygiene import METRIC, sound_keyed
from ledgerlake.operators.joins import join_dim
from ledgerlake.operators.velocity import velocity
from ledgerlake.plans.specs import SPECS, STATUS_PRIORITY, FeedSpec
from ledgerlake.session import stage_compact


def keyed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Normalised keys and parsed timestamp: what deduplication needs."""
    changes = {k: c.norm_key(k) for k in spec.keys}
    if spec.ts:
        changes[spec.ts] = c.parse_ts(spec.ts)
    return df.withColumns(changes)


def typed(df: DataFrame, spec: FeedSpec, done: Sequence[str] = ()) -> DataFrame:
    """The remaining per-column rules: numbers, categories, codes and names. Numbers of ``done`` are there already."""
    changes = {k: c.parse_number(k, t) for k, t in spec.roles.items() if k not in done}
    changes |= {k: c.norm_category(k) for k in spec.categories}
    changes |= {k: c.trim_text(k) for k in spec.texts}
    changes |= {k: c.norm_code(k) for k in spec.codes}
    return df.withColumns(changes)


def hashed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Digests instead of clear-text identifiers."""
    rules = {"ssn": ("masked_ssn", hash_ssn), "email": ("masked_email", hash_email)}
    added = {rules[p][0]: rules[p][1](p) for p in spec.pii}
    return drop_pii(df.withColumns(added) if added else df, spec.pii)


def clean(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows that pass the null contract, one per key, typed and hashed.

    Only the keys, the timestamp and the metric's number are worked out before the shuffle, as the null contract needs them; repeated records
    are gone by the time the other columns are parsed. The digest that decides between equal records is that of their text.
    """
    judged = sound_keyed(raw, spec)
    digest = row_digest(judged.drop(METRIC))
    kept = judged.select(*[F.col(METRIC if k == spec.metric else k).alias(k) for k in spec.columns], digest.alias("_digest"))
    order = [spec.ts] if spec.ts else []
    status = "tx_status" in spec.columns
    priority = (c.norm_category("tx_status"), STATUS_PRIORITY) if status else None
    unique = dedup_latest(kept, [spec.key], order, priority, by_hash=not spec.ts, tie="_digest").drop("_digest")
    return hashed(typed(unique, spec, [spec.metric]), spec)


def customers_silver(raw: DataFrame) -> DataFrame:
    return clean(raw, SPECS["customers_crm"])


def merchants_silver(raw: DataFrame) -> DataFrame:
    return clean(raw, SPECS["merchants_stores"])


def devices_silver(raw: DataFrame) -> DataFrame:
    return clean(raw, SPECS["device_auth_logs"])


def disputes_silver(raw: DataFrame) -> DataFrame:
    return c.fill_defaults(clean(raw, SPECS["chargeback_disputes"]), {"penalty_fee_usd": 0})


def with_net_amount(tx: DataFrame) -> DataFrame:
    """The discount only counts with a promotion code."""
    rate = F.when(F.col("promo_code").isNotNull(), F.col("discount_pct") / 100)
    return tx.withColumn("net_amount_after_discount", net_amount(F.col("tx_amount"), rate))


def with_distance(tx: DataFrame, customers: DataFrame) -> DataFrame:
    home = customers.select("customer_id", "home_lat", "home_lon")
    joined = join_dim(tx, home, ["customer_id"], "left", ["transaction_id"])
    distance = haversine_km(F.col("home_lat"), F.col("home_lon"), F.col("tx_lat"), F.col("tx_lon"))
    return joined.withColumn("geo_distance_km", distance).drop("home_lat", "home_lon")


def transactions_silver(
    raw: DataFrame,
    customers: DataFrame,
    store: Callable[[DataFrame, str], DataFrame] = stage_compact,
) -> DataFrame:
    """Clean transactions with net amount, distance from home and one-hour velocity.

    The cleaned rows are stored once: velocity needs them twice, as narrow counts and as full rows.
    """
    base = store(with_net_amount(clean(raw, SPECS["payment_transactions"])), "transactions_clean")
    return velocity(with_distance(base, customers), "customer_id", "tx_ts", 3600, "velocity_1h")


def build_silver(
    raw: Mapping[str, DataFrame], store: Callable[[DataFrame, str], DataFrame] = stage_compact
) -> dict[str, DataFrame]:
    """All five Silver tables, each written once; Gold and every check read the stored tables.

    Tables that do not depend on each other are submitted at the same time, so the last tasks of one do
    not leave the cluster idle. Transactions wait for customers.
    """

    def write(build: Callable[[DataFrame], DataFrame], feed: str) -> DataFrame:
        return store(build(raw[feed]), f"{feed}_silver")

    def customers_then_transactions() -> tuple[DataFrame, DataFrame]:
        customers = write(customers_silver, "customers_crm")
        return customers, write(lambda df: transactions_silver(df, customers, store), "payment_transactions")

    session = raw["customers_crm"].sparkSession
    with ThreadPoolExecutor(max_workers=4) as pool:

        def submit(f: Callable, *args):
            return pool.submit(inheritable_thread_target(session)(f), *args)

        both = submit(customers_then_transactions)
        merchants = submit(write, merchants_silver, "merchants_stores")
        devices = submit(write, devices_silver, "device_auth_logs")
        disputes = submit(write, disputes_silver, "chargeback_disputes")
        customers, transactions = both.result()
        return {
            "customers_crm": customers,
            "merchants_stores": merchants.result(),
            "device_auth_logs": devices.result(),
            "payment_transactions": transactions,
            "chargeback_disputes": disputes.result(),
        }
