"""Profiling of raw and Silver feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import NUMBER_UNITS, TS_FORMATS, TsFormat, norm_key, parse_number, ts_format_name
from ledgerlake.functions.features import net_amount
from ledgerlake.functions.privacy import is_digest
from ledgerlake.operators.dedup import dedup_latest
from ledgerlake.operators.hygiene import is_sound, null_class_expr
from ledgerlake.plans.gold import MONEY, with_disputes
from ledgerlake.plans.specs import HIGH_RISK_CATEGORIES, FeedSpec

# What makes a number, key or category dirty.
DIRTY_PATTERNS = {
    "currency_symbol": r"\$",
    "thousands_comma": r"[0-9],[0-9]{3}",
    "unit_suffix": rf"(?i)({'|'.join(NUMBER_UNITS)}|%)[*#!\s\p{{Z}}]*$",
    "footnote_mark": r"[*#!]",
    "unicode_space": r"[^\x{20}\P{Z}]",
    "parentheses": r"(?s)^[^(]*\([^0-9]*[0-9].*\)",
    "edge_space": r"^[\s\p{Z}]|[\s\p{Z}]$",
    "lower_case": r"[a-z]",
}
AUDIT_COLUMNS = ("_ingestion_timestamp", "_source_file")
SSN_PATTERN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
# one character before the @ decides as well as all of them, and in linear time
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def share(df: DataFrame, count: str, by: str, out: str = "share_pct") -> DataFrame:
    """Percentage of ``count`` within ``by``. ``df`` is already aggregated: few rows per ``by``."""
    total = F.sum(F.col(count)).over(Window.partitionBy(by)).cast("double")
    return df.withColumn(out, F.round(F.try_divide(F.lit(100.0) * F.col(count).cast("double"), total), 4))


def null_profile(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows per null class of one feed."""
    return (
        df.groupBy(null_class_expr(df, spec).alias("null_class")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(spec.name).alias("feed"), "null_class", "row_count")
    )


def dirty_profile(df: DataFrame, feed: str, columns: Sequence[str]) -> DataFrame:
    """Rows per column and dirt pattern, in one pass: columns become rows, then one count per pattern."""
    values = df.unpivot([], list(columns), "column_name", "value")
    wide = values.groupBy("column_name").agg(
        *[F.count_if(F.col("value").rlike(p)).alias(name) for name, p in DIRTY_PATTERNS.items()]
    )
    return wide.unpivot("column_name", list(DIRTY_PATTERNS), "pattern", "row_count").select(
        F.lit(feed).alias("feed"), "column_name", "pattern", "row_count"
    )


def ts_format_profile(df: DataFrame, feed: str, column: str, formats: Sequence[TsFormat] = TS_FORMATS) -> DataFrame:
    """Rows and share per timestamp layout."""
    counted = (
        df.groupBy(ts_format_name(column, formats).alias("format")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(feed).alias("feed"), "format", "row_count")
    )
    return share(counted, "row_count", "feed")


def surge_profile(df: DataFrame, feed: str, day: Column, is_clean: Column) -> DataFrame:
    """Raw and clean rows per day, with the day's share of the clean rows."""
    counted = (
        df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(is_clean).alias("clean_rows"))
        .select(F.lit(feed).alias("feed"), "day", "raw_rows", "clean_rows")
    )
    return share(counted, "clean_rows", "feed")


def feed_inventory(feeds: Mapping[str, DataFrame], specs: Mapping[str, FeedSpec]) -> DataFrame:
    """Per feed: files, raw rows, corrupt rows, surplus retry copies among the others, clean unique rows.

    Rows are counted per key, which one shuffle does; files are counted where the frame knows its
    source file, from that column alone.
    """
    parts = []
    for name, df in feeds.items():
        spec = specs[name]
        sound = is_sound(df, spec)
        per_key = df.groupBy(F.when(sound, norm_key(spec.key)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        has_key = F.col("k").isNotNull()  # every sound row has one
        good = F.coalesce(F.sum(F.when(has_key, F.col("n"))), F.lit(0))
        counts = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), good.alias("good"), F.count_if(has_key).alias("clean_rows")
        ).withColumn("files", F.lit(0).cast("bigint"))
        if "_source_file" in df.columns:
            files = df.select("_source_file").agg(F.count_distinct("_source_file").alias("files"))
            counts = counts.unionByName(files, allowMissingColumns=True).agg(
                *[F.sum(c).alias(c) for c in ("raw_rows", "good", "clean_rows", "files")]
            )
        parts.append(
            counts.select(
                F.lit(name).alias("feed"), "files", "raw_rows", (F.col("raw_rows") - F.col("good")).alias("corrupt_rows"),
                (F.col("good") - F.col("clean_rows")).alias("duplicate_rows"), "clean_rows",
            )
        )
    return _union(parts)


def device_rings(df: DataFrame, k: int = 5) -> DataFrame:
    """Devices used by at least ``k`` different customers."""
    return (
        df.where("device_id is not null").groupBy("device_id")
        .agg(F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("tx_count"))
        .where(F.col("customers") >= k)
    )


def mcc_concentration(
    tx: DataFrame, merchants: DataFrame, high_risk: Sequence[str] = HIGH_RISK_CATEGORIES
) -> DataFrame:
    """Transactions and amount per merchant category, with the share of all amount."""
    # the fact side meets the dimension as one row per merchant
    per_merchant = tx.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tx_amount").alias("amount"))
    joined = per_merchant.join(merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")
    category = F.coalesce("merchant_category", F.lit("UNKNOWN"))
    grouped = joined.groupBy(category.alias("merchant_category")).agg(
        F.sum("n").alias("tx_count"), F.sum("amount").cast(MONEY).alias("amount")
    )
    flagged = grouped.withColumn("high_risk", F.col("merchant_category").isin(*high_risk)).withColumn("all", F.lit(1))
    return share(flagged, "amount", "all", "amount_share_pct").drop("all")


def dim_rollups(tx: DataFrame, customers: DataFrame, disputes: DataFrame) -> DataFrame:
    """Counts and gross/net/disputed totals by payment method and by loyalty tier, in one result."""
    per_customer = with_disputes(tx, disputes).groupBy("customer_id", "payment_method").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("tx_amount").alias("gross"),
        F.sum("net_amount_after_discount").alias("net"),
        F.sum("disputed_amount").alias("disputed"),
    )
    rows = per_customer.join(customers.select("customer_id", "loyalty_tier"), "customer_id", "left").select(
        "n", "gross", "net", "disputed",
        F.col("payment_method").cast("string").alias("payment_method"),
        F.coalesce("loyalty_tier", F.lit("UNASSIGNED")).alias("loyalty_tier"),
    )
    by_method, by_tier = [F.col("payment_method")], [F.col("loyalty_tier")]
    grouped = rows.groupingSets([by_method, by_tier], "payment_method", "loyalty_tier").agg(
        F.grouping("payment_method").alias("g"),
        F.sum("n").alias("tx_count"),
        F.sum("gross").cast(MONEY).alias("gross_usd"),
        F.sum("net").cast(MONEY).alias("net_usd"),
        F.sum("disputed").cast(MONEY).alias("disputed_usd"),
    )
    return grouped.select(
        F.when(F.col("g") == 0, "payment_method").otherwise("loyalty_tier").alias("dimension"),
        F.when(F.col("g") == 0, F.col("payment_method")).otherwise(F.col("loyalty_tier")).alias("dimension_value"),
        "tx_count", "gross_usd", "net_usd", "disputed_usd",
    )


def _secondary(spec: FeedSpec, accounting: bool) -> Column:
    """The secondary metric as money out of dirty text; for transactions the net amount, which is worked out."""
    if spec.secondary in spec.roles:
        return parse_number(spec.secondary, spec.roles[spec.secondary], accounting).cast("decimal(18,2)")
    rate = F.when(F.col("promo_code").isNotNull(), parse_number("discount_pct", spec.roles["discount_pct"], accounting) / 100)
    return net_amount(parse_number(spec.metric, spec.roles[spec.metric], accounting), rate)


def bug_signatures(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Sums of the mandatory and the secondary metric as they should be and as named mistakes would make them.

    One row per key is kept first (retry copies are not part of these mistakes), then one pass. Sums are decimals, so they do not depend on the order of rows.
    """
    optional_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.optional])
    dtype = spec.roles[spec.metric]
    # a row that is corrupt under both readings can never be counted
    rows = df.select(
        norm_key(spec.key).alias("k"),
        parse_number(spec.metric, dtype).cast("decimal(18,2)").alias("value"),
        parse_number(spec.metric, dtype, accounting=False).cast("decimal(18,2)").alias("naive_value"),
        _secondary(spec, True).alias("second"),
        _secondary(spec, False).alias("naive_second"),
        is_sound(df, spec).alias("good"),
        is_sound(df, spec, accounting=False).alias("naive_good"),
        optional_missing.alias("benign"),
    ).where("good or naive_good")
    unique = dedup_latest(rows, ["k"])

    def total(condition: Column, value: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0).cast("decimal(18,2)")).cast(MONEY)

    readings = {
        "baseline": (F.col("good"), "value", "second"), "dropna": (F.col("good") & ~F.col("benign"), "value", "second"),
        "no_parentheses": (F.col("naive_good"), "naive_value", "naive_second"),
    }
    counts = [
        column for name, (condition, value, second) in readings.items() for column in (
            F.count_if(condition).alias(f"{name}_rows"), total(condition, value).alias(f"{name}_sum"), total(condition, second).alias(f"{name}_secondary_sum"),
        )
    ]
    return unique.agg(*counts).select(F.lit(spec.name).alias("feed"), "*")


def tier_audit(layers: Mapping[tuple[str, str], DataFrame], specs: Mapping[str, FeedSpec]) -> DataFrame:
    """``pii_audit`` of every table of the layers (by layer and name, as a catalog lists them), with the columns that each layer's tables must have.

    No table is named here: Bronze must have its audit columns, a Silver table of a feed with identifiers their digests, and a table nobody listed is
    audited like any other.
    """
    required: dict[str, list[str]] = {}
    for layer, table in layers:
        spec = specs.get(table.removesuffix(f"_{layer}"))
        if layer == "bronze":
            required[table] = list(AUDIT_COLUMNS)
        elif layer == "silver" and spec is not None:
            required[table] = [f"masked_{c}" for c in spec.pii]
    return pii_audit({table: df for (_, table), df in layers.items()}, required=required)


def pii_audit(
    tables: Mapping[str, DataFrame],
    forbidden: Sequence[str] = ("ssn", "email"),
    required: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Per table: clear-text columns, rows whose text still looks like a number or address, digest coverage.

    ``required`` names columns a table must have, for example its digests.
    """
    parts = []
    for name, df in tables.items():
        texts = [c for c, t in df.dtypes if t == "string"]
        def leaks(pattern: str) -> Column:
            hit = [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in texts]
            return F.count_if(reduce(lambda a, b: a | b, hit)) if hit else F.lit(0).cast("bigint")

        digests = [c for c in ("masked_ssn", "masked_email") if c in df.columns]
        covered = reduce(lambda a, b: a & b, [F.coalesce(is_digest(c), F.lit(False)) for c in digests], F.lit(True))
        clear = sorted(set(forbidden) & set(df.columns))
        missing = sorted(set((required or {}).get(name, ())) - set(df.columns))
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                leaks(SSN_PATTERN).alias("ssn_rows"),
                leaks(EMAIL_PATTERN).alias("email_rows"),
                (F.count_if(covered) if digests else F.lit(-1).cast("bigint")).alias("digest_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(clear)).alias("clear_columns"),
                F.lit(",".join(missing)).alias("missing_columns"),
                "row_count", "ssn_rows", "email_rows", "digest_rows",
            )
        )
    return _union(parts)
