"""The five raw feeds, derived from the provided tables.

Each column is one SQL expression that means the same in Spark and in ANSI engines, so a checking
engine can build the same input. Dirt (drift of key spelling, currency symbols, footnotes, empty and
repeated records) follows from arithmetic on the source key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.joins import plan_bytes


def _drift(key: str, text: str) -> str:
    return f"case when {key} % 7 = 0 then '  ' || lower({text}) || ' ' else {text} end"


def _padded(prefix: str, key: str, width: int) -> str:
    return f"'{prefix}-' || lpad(cast({key} as string),{width},'0')"


def _ssn(key: str) -> str:
    return (
        f"lpad(cast({key} % 900 + 100 as string),3,'0') || '-' || lpad(cast({key} % 90 + 10 as string),2,'0')"
        f" || '-' || lpad(cast({key} % 10000 as string),4,'0')"
    )


def _seconds(ts: str) -> str:
    return f"substring(cast({ts} as string),1,19)"


def _three_layouts(key: str, ts: str) -> str:
    t = _seconds(ts)
    us = (
        f"substring({t},6,2) || '/' || substring({t},9,2) || '/' || substring({t},1,4) || ' ' || substring({t},12,8)"
    )
    return f"case {key} % 3 when 0 then {t} when 1 then replace({t},' ','T') || 'Z' else {us} end"


_MONEY = "cast(cast(value as decimal(18,2)) as string)"
_PRICE = "cast(cast(l_extendedprice as decimal(18,2)) as string)"
# Parts that a feed's expressions repeat; they are worked out once for each source row.
_SHARED = {"_money": _MONEY, "_price": _PRICE, "_seconds": _seconds("ts")}


@dataclass(frozen=True)
class Derivation:
    source: str
    key: str
    columns: dict[str, str]
    repeated: bool = True
    repeat_overrides: tuple[tuple[str, str], ...] = ()


DERIVATIONS: dict[str, Derivation] = {
    "customers_crm": Derivation(
        "customer",
        "c_custkey",
        {
            "customer_id": _drift("c_custkey", _padded("CUST", "c_custkey", 7)),
            "full_name": "' ' || c_name || ' '",
            "ssn": _ssn("c_custkey"),
            "email": "case when c_custkey % 2 = 0 then ' USER' || cast(c_custkey as string) || '@EXAMPLE.COM' "
            "else 'user' || cast(c_custkey as string) || '@example.com ' end",
            "phone": "case when c_custkey % 9 = 0 then null else '555-' || lpad(cast(c_custkey as string),7,'0') end",
            "loyalty_tier": "case when c_custkey % 8 = 0 then null when c_custkey % 3 = 0 then 'GOLD*' "
            "when c_custkey % 3 = 1 then 'SILVER' else 'BRONZE!' end",
            "credit_limit_usd": "case when c_custkey % 103 = 0 then '0' when abs(c_acctbal) >= 1000 then "
            "'$' || cast(cast(floor(abs(c_acctbal)/1000) as bigint) as string) || ',' || "
            "lpad(cast(cast(floor(abs(c_acctbal)) as bigint) % 1000 as string),3,'0') || '.' || "
            "lpad(cast(cast(round(abs(c_acctbal)*100) as bigint) % 100 as string),2,'0') || ' USD' "
            "else cast(cast(abs(c_acctbal) as decimal(18,2)) as string) end",
            "reward_points": "cast(c_custkey % 5000 as string) || ' pts'",
            "home_lat": "cast(c_nationkey * 3 - 30 as string) || ' deg'",
            "home_lon": "cast(c_nationkey * 5 - 60 as string) || ' deg'",
        },
    ),
    "merchants_stores": Derivation(
        "supplier",
        "s_suppkey",
        {
            "merchant_id": _drift("s_suppkey", _padded("MER", "s_suppkey", 6)),
            "store_name": "'  ' || s_name",
            "merchant_category": "case s_suppkey % 4 when 0 then 'CRYPTO*' when 1 then 'GROCERY' "
            "when 2 then 'GAMBLING#' else 'TRAVEL' end",
            "terminal_monthly_fee_usd": "'$' || cast(s_suppkey % 40 + 10 as string) || '.50*'",
            "commission_rate_pct": "cast(s_suppkey % 5 + 1 as string) || '.25%'",
            "store_manager_code": "case when s_suppkey % 6 = 0 then null else 'MGR' || cast(s_suppkey as string) end",
            "region_notes": "case when s_suppkey % 5 = 0 then null else 'line one' || chr(10) || 'line two' end",
        },
        repeated=False,
    ),
    "device_auth_logs": Derivation(
        "events",
        "event_id",
        {
            "session_id": _drift("event_id", _padded("SES", "event_id", 9)),
            "device_id": "case when event_id % 40 = 0 then 'DEV-FRAUD-999' else 'DEV-' || cast(user_id as string) end",
            "customer_id": _padded("CUST", "user_id", 7),
            "auth_event": "upper(event_type) || case event_id % 4 when 0 then '*' when 1 then '!' else '' end",
            "auth_latency_ms": f"case when event_id % 103 = 0 then '0' else {_MONEY} || 'ms' end",
            "risk_score_raw": "cast(event_id % 100 as string) || chr(160) || '#'",
            "user_agent": "case when event_id % 10 = 0 then null else 'UA/' || cast(event_id % 7 as string) end",
            "mfa_method": "case when event_id % 12 = 0 then null when event_id % 2 = 0 then 'SMS' else 'TOTP' end",
            "event_ts": _three_layouts("event_id", "ts"),
        },
    ),
    "payment_transactions": Derivation(
        "events",
        "event_id",
        {
            "transaction_id": _drift("event_id", _padded("TX", "event_id", 9)),
            "customer_id": "case when event_id % 101 = 0 then null else "
            + _drift("event_id", _padded("CUST", "user_id", 7))
            + " end",
            "merchant_id": _padded("MER", "event_id % 10", 6),
            "device_id": "case when event_id % 40 = 0 then 'dev-fraud-999 ' else 'DEV-' || cast(user_id as string) end",
            "ssn": _ssn("user_id"),
            "payment_method": "cast(event_id % 3 as string) || case when event_id % 5 = 0 then '*' else '' end",
            "tx_amount": f"case when event_id % 103 = 0 then '(' || {_MONEY} || ')' "
            f"when event_id % 107 = 0 then '-$' || {_MONEY} when event_id % 109 = 0 then {_MONEY} || '-' "
            f"when event_id % 113 = 0 then '(USD ' || {_MONEY} || ')' when event_id % 127 = 0 then 'USD +' || {_MONEY} "
            f"when event_id % 5 = 0 then '$' || {_MONEY} || ' USD' else {_MONEY} end",
            "discount_pct": "cast(event_id % 4 * 5 as string) || '%'",
            "promo_code": "case when event_id % 6 = 0 then null else 'P' || cast(event_id % 9 as string) end",
            "device_ip": "case when event_id % 15 = 0 then null else '10.0.0.' || cast(event_id % 250 as string) end",
            "tx_lat": "cast(event_id % 60 - 30 as string) || ' deg'",
            "tx_lon": "cast(event_id % 120 - 60 as string) || ' deg'",
            "tx_status": "case event_id % 3 when 0 then 'SETTLED' when 1 then 'AUTHORIZED' else 'PENDING' end",
            "tx_ts": _three_layouts("event_id", "ts"),
        },
        repeat_overrides=(("tx_status", "'PENDING'"),),
    ),
    "chargeback_disputes": Derivation(
        "lineitem",
        "l_partkey",
        {
            "dispute_id": "'DSP-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
            "cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-' || "
            + _PRICE,  # numbers alone repeat with another price
            "transaction_id": _drift("l_partkey", _padded("TX", "l_orderkey", 9)),
            "reason_code": "'R' || cast(l_linenumber as string) || case when l_partkey % 3 = 0 then '#' else '' end",
            "dispute_amount": "case when l_partkey % 103 = 0 then '0' else "
            f"'$' || {_PRICE} end",
            "penalty_fee_usd": "case when l_partkey % 4 = 0 then null else cast(l_linenumber * 5 as string) || '.00 USD' end",
            "customer_statement": "case when l_partkey % 5 = 0 then null else 'not mine' end",
            "agent_notes": "case when l_partkey % 7 = 0 then null else 'open' end",
        },
    ),
}


# Row-identifying columns of the larger tables.
TABLE_KEYS = {
    "events": ("event_id",),
    "orders": ("o_orderkey",),
    "customer": ("c_custkey",),
    "lineitem": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
}
SPREAD_FROM_BYTES = 1024 * 1024
SPLIT_ROWS = 500_000


def _split_rows(df: DataFrame) -> DataFrame:
    """Rows of each split that holds any; no column is read for this."""
    return df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))


def filled_splits(df: DataFrame) -> int:
    """Splits that hold rows. A Parquet file is cut by its length, but a row group is read by one split only."""
    return _split_rows(df).count()


def spread(df: DataFrame, keys: Sequence[str], least: int = SPREAD_FROM_BYTES, rows: int = SPLIT_ROWS) -> DataFrame:
    """Use all cores on a table whose rows came in too few splits, such as large Parquet row groups, and bound the rows of a task.

    Splits grow with a table up to the reader's limit in bytes, which for packed numbers is millions of rows; derived and sorted as text they do not fit a
    task's memory. A table with rows in at least as many splits as the cluster has cores, none of them with more than twice ``rows``, or
    a small one, is left alone: no shuffle is added where files already spread the work.
    """
    size = plan_bytes(df)
    if size is None or size < least:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    filled, largest, total = _split_rows(df).agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    if not total or filled >= cores and largest <= 2 * rows:
        return df
    return df.repartition(max(cores, -(-total // rows)), *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TABLE_KEYS[name]) if name in TABLE_KEYS else df


def raw_feed(spark: SparkSession, sf_dir: str, feed: str, injected: bool = True) -> DataFrame:
    """All-string raw feed; ``injected`` adds retry copies (key % 13 = 0) and empty records (key % 211 = 0).

    One scan: a source row yields an array of one to three records, not a union of scans. What several expressions share is worked out
    once, below the columns. The records leave a generator, as they would leave a file: later filters cannot repeat their expressions. Its
    condition on the array ends the generated method, which the JVM would not compile together with the cleansing that follows.
    """
    d = DERIVATIONS[feed]
    df = table(spark, sf_dir, d.source)
    if not injected:
        return df.selectExpr(*[f"{e} as {c}" for c, e in d.columns.items()])

    columns = dict(d.columns)
    shared = {name: e for name, e in _SHARED.items() if any(e in text for text in columns.values())}
    for name, e in shared.items():
        columns = {c: text.replace(e, name) for c, text in columns.items()}
    plain = df.withColumns({name: F.expr(e) for name, e in shared.items()}).selectExpr(
        f"{d.key} as _key", *[f"{e} as {c}" for c, e in columns.items()]
    )
    changed = dict(d.repeat_overrides)
    copy = F.struct(*[F.expr(changed.get(c, c)).alias(c) for c in columns])
    records = [F.struct(*columns), F.when(F.col("_key") % 211 == 0, F.struct(*[F.lit(None).cast("string").alias(c) for c in columns]))]
    if d.repeated:
        records.append(F.when(F.col("_key") % 13 == 0, copy))
    found = plain.select(F.array(*records).alias("_records"))
    return found.select(F.inline(F.filter("_records", lambda r: r.isNotNull())))


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {feed: raw_feed(spark, sf_dir, feed) for feed in DERIVATIONS}
