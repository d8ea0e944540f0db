"""All registered queries: inventory id and short name to a function of (session, data folder).

Every query starts from the provided tables or from feeds, logs and job records derived from them, over
all their rows. Queries about files write the derived data to the shared folder first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions import cleanse as c
from ledgerlake.functions import features as feat
from ledgerlake.functions import privacy
from ledgerlake.operators import dedup, gates, hygiene, jobs, joins, metrics, orders, parity, plan_logs, profile, rules
from ledgerlake.operators.velocity import velocity
from ledgerlake.plans import silver as sv
from ledgerlake.plans.gold import build_gold, disputes_by_tx
from ledgerlake.plans.pipeline import run_medallion
from ledgerlake.plans.reconcile import gold_rollup, promotion_gate, reconcile, reconcile_rollups, silver_rollup
from ledgerlake.plans.specs import EDGES, SPECS
from ledgerlake.session import new_path, stage, stage_compact
from ledgerlake.sources import derived_logs, erasure, feeds, files, logs
from ledgerlake.sources.derived import raw_feed, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAY, CUS, MER, DEV, DIS = (
    "payment_transactions", "customers_crm", "merchants_stores", "device_auth_logs", "chargeback_disputes",
)
GOLD_RULES = (
    gates.Rule("customer_present", "not_null", ("customer_id",)),
    gates.Rule("grain_unique", "unique", ("customer_id", "payment_method")),
    gates.Rule("method_known", "set", ("payment_method",), (0, 1, 2)),
    gates.Rule("amount_not_negative", "range", ("total_tx_amount",), (0, None)),
    gates.Rule("customer_format", "regex", ("customer_id",), ("^CUST-[0-9]{7}$",)),
    gates.Rule("net_within_gross", "row", (), ("total_net_amount <= total_tx_amount",)),
    gates.Rule("tier_assigned", "set", ("loyalty_tier",), ("GOLD", "SILVER", "BRONZE"), 0.5),
)
ROI_RATES = {"silver": (2.0, 1.2), "gold": (1.5, 1.2)}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def _raws(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: raw_feed(spark, sf, n) for n in (names or SPECS)}


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return sv.customers_silver(raw_feed(spark, sf, CUS))


def _merchants(spark: SparkSession, sf: str) -> DataFrame:
    return sv.merchants_silver(raw_feed(spark, sf, MER))


def _devices(spark: SparkSession, sf: str) -> DataFrame:
    return sv.devices_silver(raw_feed(spark, sf, DEV))


def _disputes(spark: SparkSession, sf: str) -> DataFrame:
    return sv.disputes_silver(raw_feed(spark, sf, DIS))


def _clean_tx(spark: SparkSession, sf: str) -> DataFrame:
    """Clean transactions with net amount; the features that need other tables are left out."""
    return sv.with_net_amount(sv.clean(raw_feed(spark, sf, PAY), SPECS[PAY]))


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return sv.transactions_silver(raw_feed(spark, sf, PAY), _customers(spark, sf))


def _silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return sv.build_silver(_raws(spark, sf))


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.parse_jobs(derived_logs.job_records(spark, sf))


def _landing_day(feed: str):
    """Day on which a record of an event feed lands: its own, for a dispute one of three days by its order's number."""
    if SPECS[feed].ts:
        return c.parse_ts(SPECS[feed].ts).cast("date")
    number = F.regexp_extract("dispute_id", "DSP-([0-9]+)", 1).try_cast("bigint")
    return F.date_add(F.lit("2024-01-01").cast("date"), (number % 3).cast("int"))


def _land(spark: SparkSession, sf: str, root: str, *names: str) -> None:
    """Landing zone: event feeds in folders of their days, the others in two files.

    Feeds are landed at the same time: the last files of one, which few tasks write, do not leave the cluster idle.
    """
    def land(name: str) -> None:
        raw = raw_feed(spark, sf, name)
        if SPECS[name].dated:
            feeds.land_feed(raw, f"{root}/{name}", name, _landing_day(name))
        else:
            feeds.land_feed(raw.repartition(2), f"{root}/{name}", name)

    with ThreadPoolExecutor(max_workers=len(SPECS)) as pool:
        for landed in [pool.submit(inheritable_thread_target(spark)(land), name) for name in (names or SPECS)]:
            landed.result()


def _with_bronze(spark: SparkSession, sf: str, names: tuple[str, ...], result: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """A result over Bronze tables, which are ingested from a landing zone and dropped again."""
    unit, root = "q" + uuid.uuid4().hex, new_path(spark, "landing")
    try:
        with files.scratch(spark):
            _land(spark, sf, root, *names)
            bronze = feeds.ingest(spark, root, {n: n for n in names or SPECS}, unit)
        return stage(result(bronze), "result")
    finally:
        feeds.drop_layers(spark, unit)
        files.delete(spark, [root])


def _with_layers(spark: SparkSession, sf: str, result: Callable[[dict[tuple[str, str], DataFrame]], DataFrame]) -> DataFrame:
    """A result over all tables that the catalog lists for Bronze, Silver and Gold after a run from a landing zone."""
    unit, root = "q" + uuid.uuid4().hex, new_path(spark, "landing")
    try:
        _land(spark, sf, root)
        run_medallion(spark, root, GOLD_RULES, unit, keep_landing=False)
        return stage_compact(result(feeds.layer_tables(spark, unit)), "result")
    finally:
        feeds.drop_layers(spark, unit)
        files.delete(spark, [root])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- scans, sources, sinks ---------------------------------------------------------------------------


def _key_number(col: str):
    return F.regexp_extract(col, "([0-9]+)", 1).try_cast("bigint")


@query("s1_scan_feed")
def _(spark, sf):
    """JSON landing feed in which every 97th record is cut short."""
    raw = raw_feed(spark, sf, PAY)
    text = F.to_json(F.struct(*raw.columns))
    cut = F.coalesce(_key_number("transaction_id") % 97 == 0, F.lit(False))
    path = new_path(spark, "landing")
    short = F.substring(text, F.lit(1), F.length(text) - 5)
    raw.select(F.when(cut, short).otherwise(text).alias("value")).write.text(path)
    df = feeds.scan_feed(spark, path, PAY)
    return df.select(*SPECS[PAY].columns, F.col(hygiene.CORRUPT).isNotNull().alias("is_corrupt"))


@query("s1_scan_feed_csv")
def _(spark, sf):
    """CSV landing feed whose notes hold line breaks."""
    path = new_path(spark, "landing")
    feeds.land_feed(raw_feed(spark, sf, MER), path, MER)
    return feeds.scan_feed(spark, path, MER).select(*SPECS[MER].columns)


@query("s2_scan_dated")
def _(spark, sf):
    """All three event feeds, with the day of the folder."""
    root = new_path(spark, "landing")
    dated = [n for n in SPECS if SPECS[n].dated]
    _land(spark, sf, root, *dated)
    return _union([
        feeds.scan_dated(spark, f"{root}/{n}", n).select(F.lit(n).alias("feed"), F.col(SPECS[n].key).alias("id"), F.col(SPECS[n].metric).alias("value"), feeds.FOLDER_DATE)
        for n in dated
    ])


@query("s3_add_audit")
def _(spark, sf):
    path = new_path(spark, "landing")
    feeds.land_feed(raw_feed(spark, sf, DEV), path, DEV)
    return metrics.bronze_audit(feeds.add_audit(feeds.scan_feed(spark, path, DEV)))


@query("s4_write_bronze")
def _(spark, sf):
    """Landing to Bronze keeps every row, empty and repeated ones included."""
    path, target = new_path(spark, "landing"), new_path(spark, "bronze")
    feeds.land_feed(raw_feed(spark, sf, DIS), path, DIS)
    name = "bronze_" + target.rsplit("-", 1)[1]
    bronze = feeds.write_bronze(feeds.add_audit(feeds.scan_feed(spark, path, DIS)), name, target)
    files.delete(spark, [path])  # Bronze holds its rows
    return bronze.select(*SPECS[DIS].columns)


@query("s4_incremental_ingest")
def _(spark, sf):
    """The event feeds' even days land and are ingested, then the others; a third run finds nothing new."""
    unit, root = "q" + uuid.uuid4().hex, new_path(spark, "landing")
    dated = [n for n in SPECS if SPECS[n].dated]
    try:
        with files.scratch(spark):
            for late in (False, True, None):
                if late is not None:
                    for name, raw in _raws(spark, sf, *dated).items():
                        day = _landing_day(name)
                        first = F.coalesce(F.day(day) % 2 == 0, F.lit(False))
                        feeds.land_feed(raw.where(first != late), f"{root}/{name}/{'second' if late else 'first'}", name, day)
                bronze = feeds.ingest(spark, root, {n: n for n in dated}, unit)
        ledger = spark.table(f"{feeds.database_name(unit, 'bronze', 'dev')}.ingest_ledger").where("state = 'done'")
        runs = ledger.groupBy("feed").agg(F.count_distinct("run").alias("runs"))
        counts = _union([
            df.groupBy(F.lit(n).alias("feed"), F.col(feeds.FOLDER_DATE)).agg(F.count(F.lit(1)).alias("row_count")) for n, df in bronze.items()
        ])
        return stage(counts.join(runs, "feed"), "result")
    finally:
        feeds.drop_layers(spark, unit)
        files.delete(spark, [root])


@query("s5_scan_event_log")
def _(spark, sf):
    """Logs written plain and compressed, read back as one table."""
    lines = derived_logs.log_lines(spark, sf)
    plain, packed = new_path(spark, "logs"), new_path(spark, "logs")
    derived_logs.write_logs(lines.where("app < 'app-0020'"), plain)
    derived_logs.write_logs(lines.where("app >= 'app-0020'"), packed, "gzip")
    return logs.scan_event_log(spark, [plain, packed]).groupBy("app").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters")
    )


@query("s6_latest_event_log")
def _(spark, sf):
    """Log files of which some are archived, one is seeded, one is blank; the listing tells which to read."""
    root = new_path(spark, "logs")
    lines = derived_logs.log_lines(spark, sf).withColumn("number", F.substring("app", 5, 4).cast("int"))
    archived, seeded, blank = F.col("number") % 4 == 3, F.col("number") == 38, F.col("number") == 37
    derived_logs.write_logs(lines.where(~archived & ~seeded & ~blank), f"{root}/logs")
    derived_logs.write_logs(lines.where(archived), f"{root}/logs/archive")
    lines.where(seeded).select("value").write.text(f"{root}/logs/z/app-02-decelerated-udf.json")
    lines.where(blank).select(F.lit(" ").alias("value")).write.text(f"{root}/logs/app=app-0037")
    latest = logs.scan_latest_event_log(spark, root)
    return plan_logs.plan_events(latest, [""]).select("app", "position", F.col("event").alias("value"))


@query("s7_scan_qualification")
def _(spark, sf):
    """Qualification output as a tab-separated file, next to a file of lower precedence."""
    root = new_path(spark, "audit")
    result = plan_logs.qualify(derived_logs.log_lines(spark, sf)).select("app_id", "class", "recommend", "est_speedup")
    staged = stage(result, "qualification")
    for name, df in (("AppsRecommendedForBoost.tsv", staged), ("qualification.tsv", staged.where("false"))):
        df.write.csv(f"{root}/{name}", sep="\t", header=True)
    return logs.scan_qualification(spark, root)


@query("s8_scan_json_docs")
def _(spark, sf):
    """Job records of which some are broken or empty."""
    records = derived_logs.job_records(spark, sf).withColumn("n", _key_number("value"))
    text = (
        F.when(F.col("n") % 31 == 0, F.substring("value", 1, 20)).when(F.col("n") % 37 == 0, F.lit(" "))
        .otherwise(F.col("value"))
    )
    docs = logs.lenient_json(records.select("n", text.alias("raw")), "raw", '{"state":"UNKNOWN"}')
    return docs.select("n", "ok", F.variant_get("doc", "$.state", "string").alias("state"))


@query("s9_output_inventory")
def _(spark, sf):
    root = new_path(spark, "warehouse")
    enriched = orders.enrich_orders(table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "nation"))
    enriched.repartition(4, "o_orderkey").write.parquet(f"{root}/orders_enriched_nqe")
    table(spark, sf, "orders").repartition(2, "o_orderkey").write.parquet(f"{root}/orders_enriched")
    found = feeds.output_inventory(spark, root, ["orders_enriched_fixed", "orders_enriched_nqe", "orders_enriched"])
    return found.drop("bytes")


@query("s10_manifest_check")
def _(spark, sf):
    root = new_path(spark, "landing")
    _land(spark, sf, root)
    return feeds.manifest_check(spark, root)


@query("s11_register_external")
def _(spark, sf):
    path = new_path(spark, "merchants")
    _merchants(spark, sf).write.parquet(path)
    return feeds.register_external(spark, "ext_" + path.rsplit("-", 1)[1], path)


@query("s12_write_clustered")
def _(spark, sf):
    gold = build_gold(_silver(spark, sf))
    return feeds.write_clustered(gold, new_path(spark, "gold"), ["customer_id", "loyalty_tier"])


@query("s13_upsert")
def _(spark, sf):
    base = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.lit(1).alias("version")
    )
    newer = base.where("o_orderstatus = 'O'").withColumn("price", (F.col("price") * 2).cast("decimal(18,2)")).withColumn("version", F.lit(2))
    older = base.where("price < 100000").withColumn("o_orderstatus", F.lit("X")).withColumn("version", F.lit(0))
    added = base.where("price >= 400000").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    return dedup.upsert(base, _union([newer, older, added]), ["o_orderkey"], ["version"])


@query("s14_erase")
def _(spark, sf):
    """Customers in debt are erased from the stored table, file by file."""
    path = new_path(spark, "customers")
    name = "erase_" + path.rsplit("-", 1)[1]
    erased = table(spark, sf, "customer").where("c_acctbal < 0").select(
        F.concat(F.lit("CUST-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("customer_id")
    )
    feeds.write_clustered(_customers(spark, sf), path, ["customer_id"], 16)
    try:
        feeds.register_external(spark, name, path)
        erasure.erase_rows(spark, name, erased)
        return spark.read.parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- projections, filters, cleansing -----------------------------------------------------------------


@query("p1_norm_key")
def _(spark, sf):
    return raw_feed(spark, sf, PAY).select(
        c.norm_key("transaction_id").alias("transaction_id"), c.norm_key("customer_id").alias("customer_id"),
        c.norm_key("device_id").alias("device_id"), "tx_status",
    )


@query("p2_parse_number")
def _(spark, sf):
    parts = [
        raw_feed(spark, sf, f).select(
            F.lit(col).alias("column_name"), c.norm_key(SPECS[f].key).alias("id"), c.parse_number(col).alias("value")
        )
        for f, col in (
            (PAY, "tx_amount"), (PAY, "discount_pct"), (CUS, "credit_limit_usd"), (CUS, "reward_points"),
            (MER, "terminal_monthly_fee_usd"), (MER, "commission_rate_pct"), (DEV, "auth_latency_ms"),
            (DEV, "risk_score_raw"), (DIS, "penalty_fee_usd"),
        )
    ]
    return _union(parts)


@query("p3_cast_roles")
def _(spark, sf):
    roles = SPECS[CUS].roles
    return c.cast_roles(raw_feed(spark, sf, CUS), roles).select("customer_id", *roles)


@query("p4_parse_ts")
def _(spark, sf):
    return raw_feed(spark, sf, PAY).select("transaction_id", "tx_status", "tx_ts", c.parse_ts("tx_ts").alias("parsed"))


@query("p5_norm_category")
def _(spark, sf):
    parts = [
        raw_feed(spark, sf, f).select(F.lit(col).alias("column_name"), c.norm_category(col).alias("value"))
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
        for f, col in ((DEV, "auth_event"), (CUS, "loyalty_tier"), (MER, "merchant_category"), (DIS, "reason_code"))
    ]
    return _union(parts)


@query("p6_norm_code")
def _(spark, sf):
    return raw_feed(spark, sf, PAY).select("transaction_id", "tx_status", "payment_method", c.norm_code("payment_method").alias("code"))


@query("p7_trim_text")
def _(spark, sf):
    return _union([
        raw_feed(spark, sf, CUS).select(c.trim_text("full_name").alias("name")),
        raw_feed(spark, sf, MER).select(c.trim_text("store_name").alias("name")),
    ])


@query("p8_null_class")
def _(spark, sf):
    return _union([
        hygiene.null_class(raw, SPECS[n]).select(F.lit(n).alias("feed"), F.col(SPECS[n].key).alias("id"), "null_class")
        for n, raw in _raws(spark, sf).items()
    ])


@query("p9_drop_corrupt")
def _(spark, sf):
    return hygiene.drop_corrupt(raw_feed(spark, sf, PAY), SPECS[PAY])


@query("p10_benign_null")
def _(spark, sf):
    return _union([
        raw.select(F.lit(n).alias("feed"), F.col(SPECS[n].key).alias("id"), hygiene.benign_null(SPECS[n]).alias("benign"))
        for n, raw in _raws(spark, sf).items()
    ])


@query("p11_fill_defaults")
def _(spark, sf):
    joined = _clean_tx(spark, sf).join(disputes_by_tx(_disputes(spark, sf)), "transaction_id", "left").join(
        _customers(spark, sf).select("customer_id", "loyalty_tier"), "customer_id", "left"
    )
    filled = c.fill_defaults(joined, {"loyalty_tier": "UNASSIGNED", "disputed_amount": 0, "penalty_fee_usd": 0})
    return filled.select("transaction_id", "loyalty_tier", "disputed_amount", "penalty_fee_usd")


@query("p12_drop_pii")
def _(spark, sf):
    return privacy.drop_pii(sv.typed(raw_feed(spark, sf, CUS), SPECS[CUS]))


@query("p13_net_amount")
def _(spark, sf):
    return _clean_tx(spark, sf).select("transaction_id", "tx_amount", "discount_pct", "promo_code", "net_amount_after_discount")


@query("p14_haversine_km")
def _(spark, sf):
    # stored once, as the join beyond the broadcast limit counts its facts as well
    tx = stage(_clean_tx(spark, sf).select("transaction_id", "customer_id", "tx_lat", "tx_lon"), "transactions_clean")
    tx = sv.with_distance(tx, _customers(spark, sf))
    return tx.select("transaction_id", F.round("geo_distance_km", 4).alias("geo_distance_km"))


@query("p15_features_valid")
def _(spark, sf):
    return _tx(spark, sf).select("transaction_id", feat.features_valid().alias("valid"))


@query("p16_is_anomaly")
def _(spark, sf):
    return _tx(spark, sf).select("transaction_id", feat.is_anomaly(v=2).alias("anomaly"))


@query("p17_plan_events")
def _(spark, sf):
    return plan_logs.plan_events(derived_logs.log_lines(spark, sf)).select("app", "position", "event")


@query("p18_filter_jobs")
def _(spark, sf):
    found = jobs.filter_jobs(_jobs(spark, sf), "pure_sql_benchmark.py", ["gold"])
    return found.select("name", "state", "createTime")


@query("p19_runtime_conformance")
def _(spark, sf):
    return jobs.runtime_conformance(_jobs(spark, sf))


@query("p20_masked_view")
def _(spark, sf):
    """The stored Bronze table, whose columns carry their tags, for two readers."""
    return _with_bronze(spark, sf, (CUS,), lambda bronze: _union([
        privacy.masked_view(bronze[CUS], privileged, SPECS[CUS].pii).select(
            F.lit(reader).alias("reader"), "customer_id", "ssn", "email", "loyalty_tier"
        )
        for reader, privileged in (("auditor", True), ("analyst", False))
    ]))


@query("p21_hash_pii")
def _(spark, sf):
    return raw_feed(spark, sf, CUS).select(
        "customer_id", privacy.hash_ssn("ssn").alias("masked_ssn"), privacy.hash_email("email").alias("masked_email")
    )


def _enriched(spark, sf):
    return orders.enrich_orders(table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "nation"))


@query("p22_enrich_orders")
def _(spark, sf):
    return _enriched(spark, sf)


# --- joins -------------------------------------------------------------------------------------------


@query("j1_left_preagg")
def _(spark, sf):
    aggs = {"dispute_count": F.count(F.lit(1)), "disputed_amount": F.sum("dispute_amount").cast("decimal(38,2)")}
    tx = _clean_tx(spark, sf).select("transaction_id", "payment_method", "tx_amount")
    return joins.left_preagg(tx, _disputes(spark, sf), "transaction_id", aggs)


@query("j2_inner_rollups")
def _(spark, sf):
    s = _silver(spark, sf)
    gold = stage(build_gold(s), "gold")
    left = silver_rollup(s[PAY], s[DIS])
    return reconcile_rollups(left, gold_rollup(gold), how="inner").select("payment_method", "silver_tx_count", "gold_tx_count", "row_count_diff")


@query("j3_five_table_join")
def _(spark, sf):
    gold = build_gold(_silver(spark, sf))
    return gold.groupBy("loyalty_tier").agg(
        F.count(F.lit(1)).alias("gold_rows"), F.sum("total_tx_count").alias("tx_count"),
        F.sum("high_risk_mcc_tx_count").alias("high_risk"), F.sum("ato_mfa_tx_count").alias("ato"),
        F.sum("disputed_tx_count").alias("disputed"),
    )


@query("j4_dimension_join")
def _(spark, sf):
    return _enriched(spark, sf).groupBy("nation", "segment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price_usd").cast("decimal(38,2)").alias("price_usd")
    )


@query("j4_dimension_join_salted")
def _(spark, sf):
    """The way beyond the broadcast limit gives the same rows."""
    e = orders.enrich_orders(table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "nation"), limit=0)
    return e.groupBy("nation", "segment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price_usd").cast("decimal(38,2)").alias("price_usd")
    )


@query("j5_orphan_report")
def _(spark, sf):
    raws = _raws(spark, sf, PAY, CUS, MER, DEV, DIS)
    ends = {name: [] for name in raws}
    for child, fk, parent in EDGES:
        edge = f"{child}.{fk}->{parent}"
        ends[child].append((edge, F.col(fk), True))
        ends[parent].append((edge, F.col(SPECS[parent].key), False))
    return joins.orphan_reports({n: e for n, e in ends.items() if e}, raws)


@query("j6_hash_parity")
def _(spark, sf):
    return joins.hash_parity(_clean_tx(spark, sf), _customers(spark, sf), "customer_id", "masked_ssn")


@query("j7_metric_plan_join")
def _(spark, sf):
    return plan_logs.metric_plan_join(derived_logs.log_lines(spark, sf))


@query("j8_ab_compare")
def _(spark, sf):
    runs = jobs.filter_jobs(_jobs(spark, sf), "pure_sql_benchmark.py").select(
        (F.floor(_key_number("name") / 8) % 50).cast("bigint").alias("job"),
        F.when(_key_number("name") % 8 == 3, "standard").otherwise("accelerated").alias("arm"),
        F.when(_key_number("name") % 8 == 3, _key_number("name") % 100 + 50).otherwise(_key_number("name") % 100 + 10)
        .cast("double").alias("seconds"),
    )
    return jobs.ab_compare(runs)


# --- aggregations ------------------------------------------------------------------------------------


@query("a1_bronze_audit")
def _(spark, sf):
    """All Bronze tables, and a feed that never passed Bronze."""
    def audited(bronze):
        tables = {f"{n}_bronze": df for n, df in bronze.items()} | {"payment_transactions_raw": raw_feed(spark, sf, PAY)}
        return _union([metrics.bronze_audit(df).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()])

    return _with_bronze(spark, sf, (), audited)


@query("a2_silver_metrics")
def _(spark, sf):
    s = {CUS: _customers(spark, sf), MER: _merchants(spark, sf), DEV: _devices(spark, sf), DIS: _disputes(spark, sf), PAY: _tx(spark, sf)}
    return _union([metrics.silver_metrics(df, SPECS[n]) for n, df in s.items()])


@query("a3_feature_counts")
def _(spark, sf):
    return _tx(spark, sf).agg(
        F.count_if(feat.features_valid()).alias("feat_cnt"), F.count_if(feat.is_anomaly()).alias("anomaly_cnt"),
        F.count_if(feat.is_anomaly(v=2, km=1e9)).alias("burst_cnt"),
    )


@query("a4_ring_size")
def _(spark, sf):
    return metrics.ring_size(_clean_tx(spark, sf))


@query("a5_hash_format_counts")
def _(spark, sf):
    return _union([
        metrics.hash_format_counts(df).select(F.lit(n).alias("table_name"), "*")
        for n, df in (("customers_crm_silver", _customers(spark, sf)), ("payment_transactions_silver", _clean_tx(spark, sf)))
    ])


@query("a6_gold_totals")
def _(spark, sf):
    return metrics.gold_totals(build_gold(_silver(spark, sf)))


@query("a7_disputes_by_tx")
def _(spark, sf):
    return disputes_by_tx(_disputes(spark, sf))


@query("a8_silver_rollup")
def _(spark, sf):
    return silver_rollup(_clean_tx(spark, sf), _disputes(spark, sf))


@query("a9_gold_rollup")
def _(spark, sf):
    return gold_rollup(build_gold(_silver(spark, sf)))


@query("a10_reconcile")
def _(spark, sf):
    """Stored Silver against stored Gold."""
    s = _silver(spark, sf)
    gold = feeds.write_clustered(build_gold(s), new_path(spark, "gold"), ["customer_id", "loyalty_tier"])
    return reconcile(s[PAY], s[DIS], gold)


@query("a11_gold_mart")
def _(spark, sf):
    return build_gold(_silver(spark, sf))


@query("a12_dim_rollups")
def _(spark, sf):
    return profile.dim_rollups(_clean_tx(spark, sf), _customers(spark, sf), _disputes(spark, sf))


@query("a13_fanout_histogram")
def _(spark, sf):
    return joins.fanout_histogram(_disputes(spark, sf), "transaction_id")


@query("a14_fanout_inflation")
def _(spark, sf):
    return joins.fanout_inflation(_clean_tx(spark, sf), _disputes(spark, sf), "transaction_id", "tx_amount", "dispute_amount")


@query("a15_null_profile")
def _(spark, sf):
    return _union([profile.null_profile(raw, SPECS[n]) for n, raw in _raws(spark, sf).items()])


@query("a16_dirty_profile")
def _(spark, sf):
    return _union([
        profile.dirty_profile(raw, n, [*SPECS[n].keys, *SPECS[n].roles, *SPECS[n].categories, *SPECS[n].texts, *SPECS[n].codes])
        for n, raw in _raws(spark, sf).items()
    ])


@query("a17_ts_format_profile")
def _(spark, sf):
    return _union([profile.ts_format_profile(raw, n, SPECS[n].ts) for n, raw in _raws(spark, sf, PAY, DEV).items()])


@query("a18_surge_profile")
def _(spark, sf):
    dated = [n for n in SPECS if SPECS[n].dated]
    return _union([profile.surge_profile(raw, n, _landing_day(n), hygiene.is_sound(raw, SPECS[n])) for n, raw in _raws(spark, sf, *dated).items()])


@query("a19_duplicate_report")
def _(spark, sf):
    return _union([
        dedup.duplicate_report(raw, SPECS[n].key, c.norm_key(SPECS[n].key)).select(F.lit(n).alias("feed"), "*")
        for n, raw in _raws(spark, sf).items()
    ])


@query("a20_feed_inventory")
def _(spark, sf):
    return _with_bronze(spark, sf, (), lambda bronze: profile.feed_inventory(bronze, SPECS))


@query("a21_device_rings")
def _(spark, sf):
    return profile.device_rings(_clean_tx(spark, sf))


@query("a22_mcc_concentration")
def _(spark, sf):
    return profile.mcc_concentration(_clean_tx(spark, sf), _merchants(spark, sf))


@query("a23_bug_signatures")
def _(spark, sf):
    return _union([profile.bug_signatures(raw, SPECS[n]) for n, raw in _raws(spark, sf).items()])


@query("a24_pii_audit")
def _(spark, sf):
    """Every table of every layer, as the catalog lists them."""
    return _with_layers(spark, sf, lambda tables: profile.tier_audit(tables, SPECS))


@query("a25_plan_summary")
def _(spark, sf):
    return plan_logs.plan_summary(derived_logs.log_lines(spark, sf)).drop("path")


@query("a26_deceleration_gate")
def _(spark, sf):
    return plan_logs.deceleration_gate(derived_logs.log_lines(spark, sf))


@query("a27_qualify")
def _(spark, sf):
    return plan_logs.qualify(derived_logs.log_lines(spark, sf))


@query("a28_fleet_roi")
def _(spark, sf):
    apps = _jobs(spark, sf).select(
        F.col("name").alias("app_id"), F.regexp_extract("name", "/([a-z]+)-[0-9]+$", 1).alias("class"),
        ((_key_number("name") % 40 + 1) * F.lit(Decimal("0.25"))).alias("runtime_hours"),
    )
    return jobs.fleet_roi(apps, ROI_RATES, hourly_rate=2.5)


def _check_results(spark, sf):
    """Quality rules on Gold, one run per payment method, and reconciliation as one more check per run."""
    s = _silver(spark, sf)
    gold = stage(build_gold(s), "gold")
    run_id = F.concat(F.lit("run-"), F.coalesce(F.col("payment_method").cast("string"), F.lit("none")))
    checks = gates.check_results(gates.dq_scan(gold, GOLD_RULES, ["payment_method"]), run_id, "gold", 0.25)
    recon = reconcile(s[PAY], s[DIS], gold).select(
        run_id.alias("run_id"), F.lit("gold").alias("table_name"),
        F.lit("reconciled").alias("rule"), (~F.col("payment_method").eqNullSafe(2)).alias("required"),
        F.when((F.col("row_count_diff") == 0) & (F.col("gross_variance_usd") == "0.00"), F.lit(0)).otherwise(F.lit(2)).alias("exit_code"),
        F.lit(0.5).alias("elapsed"),
    )
    docs = recon.select("run_id", "table_name", F.lit("docs").alias("rule"), F.lit(True).alias("required"), F.lit(4).alias("exit_code"), F.lit(0.1).alias("elapsed"))
    return _union([checks, recon, docs])


@query("a29_gate_summary")
def _(spark, sf):
    return gates.gate_summary(_check_results(spark, sf))


# --- windows -----------------------------------------------------------------------------------------


@query("w1_dedup_latest")
def _(spark, sf):
    kept = sv.keyed(hygiene.drop_corrupt(raw_feed(spark, sf, PAY), SPECS[PAY]), SPECS[PAY])
    return dedup.dedup_latest(kept, ["transaction_id"], ["tx_ts"], ("tx_status", sv.STATUS_PRIORITY)).select(
        "transaction_id", "customer_id", "tx_ts", "tx_status", "tx_amount"
    )


@query("w2_velocity")
def _(spark, sf):
    """All events per user in the trailing hour, at microsecond timestamps."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return velocity(ev, "user_id", "ts", 3600, "velocity_1h").select("event_id", "velocity_1h")


@query("w2_velocity_silver")
def _(spark, sf):
    return _tx(spark, sf).select("transaction_id", "customer_id", "velocity_1h")


@query("w3_share")
def _(spark, sf):
    per_type = raw_feed(spark, sf, DEV).groupBy(
        c.norm_category("auth_event").alias("auth_event"), F.coalesce("mfa_method", F.lit("NONE")).alias("mfa_method")
    ).agg(F.count(F.lit(1)).alias("row_count"))
    return profile.share(per_type, "row_count", "auth_event")


@query("w4_latest_job")
def _(spark, sf):
    j = _jobs(spark, sf)
    return _union([jobs.latest_job(j, st).select(F.lit(st).alias("stage"), "name", "createTime") for st in ("Bronze", "Silver", "nowhere")])


# --- sorts, limits, set operations -------------------------------------------------------------------


@query("l1_ordered_reconcile")
def _(spark, sf):
    """Reconciliation in order of the payment method; the position is a column, as files keep no order."""
    by_method = Window.orderBy(F.col("payment_method").asc_nulls_last())  # one row per payment method
    return QUERIES["a10_reconcile"](spark, sf).withColumn("position", F.row_number().over(by_method)).orderBy("position")


@query("l2_spot_check")
def _(spark, sf):
    """Digests of all customers; the expectations for one market segment are wrong on purpose."""
    src = table(spark, sf, "customer")
    key = F.col("c_custkey")
    ssn = F.concat(
        F.lpad((key % 900 + 100).cast("string"), 3, "0"), F.lit("-"), F.lpad((key % 90 + 10).cast("string"), 2, "0"),
        F.lit("-"), F.lpad((key % 10000).cast("string"), 4, "0"),
    )
    expected = src.select(
        F.concat(F.lit("CUST-"), F.lpad(key.cast("string"), 7, "0")).alias("customer_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("wrong")).otherwise(F.sha2(ssn, 256)).alias("masked_ssn"),
        F.sha2(F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")), 256).alias("masked_email"),
    )
    return metrics.spot_check(_customers(spark, sf), expected)


@query("l3_recent_jobs")
def _(spark, sf):
    return jobs.recent_jobs(_jobs(spark, sf)).select("name", "createTime")


@query("u1_parity")
def _(spark, sf):
    """The enrichment against the same result as one SQL expression list, and against a faulty variant."""
    a = _enriched(spark, sf)
    o, cu, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    plain = o.join(cu, o.o_custkey == cu.c_custkey, "left").join(n, cu.c_nationkey == n.n_nationkey, "left").selectExpr(
        "o_orderkey", "o_custkey", "upper(trim(c_mktsegment)) as segment",
        "concat(upper(substring(n_name, 1, 1)), lower(substring(n_name, 2))) as nation",
        "cast(o_totalprice as decimal(18,2)) as price_usd",
        "case when o_totalprice >= 300000 then 'HIGH' when o_totalprice >= 100000 then 'MEDIUM' else 'LOW' end as price_band",
        "cast(substring(o_orderpriority, 1, 1) as int) as priority_rank",
        "substring(cast(o_orderdate as string), 1, 7) as order_month",
        "case o_orderstatus when 'F' then 'FULFILLED' when 'O' then 'OPEN' else 'PARTIAL' end as status",
    )
    faulty = a.where("not (status = 'PARTIAL' and priority_rank = 5)").unionByName(
        a.where("price_usd >= 450000 and status <> 'PARTIAL'")
    )
    return _union([
        parity.parity(a, df).select(F.lit(n).alias("variant"), "*") for n, df in (("refactored", plain), ("faulty", faulty))
    ])


@query("u2_missing")
def _(spark, sf):
    expected = table(spark, sf, "events").select(F.concat(F.lit("TX-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("transaction_id"))
    return parity.missing(expected, _clean_tx(spark, sf).select("transaction_id"))


@query("u3_ordered_union")
def _(spark, sf):
    ev = table(spark, sf, "events")
    lists = [ev.where(f"event_id % 3 = {m}").select(F.col("user_id").alias("item"), F.col("event_id").alias("place")) for m in (2, 0, 1)]
    return parity.ordered_union(lists, "item", "place")


# --- quality and governance --------------------------------------------------------------------------


def _rule_lines() -> list[str]:
    """The rules for Gold as the lines of a rule file."""
    out = []
    for r in GOLD_RULES:
        given = {"rule": r.name, "kind": r.kind, "threshold": r.threshold} | ({"columns": list(r.columns)} if r.columns else {})
        if r.kind == "range":
            given |= {k: v for k, v in zip(("low", "high"), r.args) if v is not None}
        elif r.kind == "set":
            given["values"] = list(r.args)
        elif r.kind == "regex":
            given["pattern"] = r.args[0]
        elif r.kind == "row":
            given["condition"] = {"left": {"column": "total_net_amount"}, "op": "<=", "right": {"column": "total_tx_amount"}}
        out.append(json.dumps(given))
    return out


@query("q1_dq_scan")
def _(spark, sf):
    """Gold judged by a rule file."""
    path = new_path(spark, "rules")
    spark.createDataFrame([(line,) for line in _rule_lines()], "value string").coalesce(1).write.text(path)
    return rules.scan_with_file(build_gold(_silver(spark, sf)), path)


@query("q2_promotion_gate")
def _(spark, sf):
    s = _silver(spark, sf)
    gold = stage_compact(build_gold(s), "gold")
    broken = gold.where("not (payment_method = 1 and customer_id = 'CUST-0000001')")
    totals = stage_compact(silver_rollup(s[PAY], s[DIS]), "silver-rollup")  # the same for both builds, a row per payment method
    return _union([
        promotion_gate(reconcile_rollups(totals, gold_rollup(g))).select(F.lit(n).alias("build"), "*")
        for n, g in (("complete", gold), ("row lost", broken))
    ])


@query("q3_layer_progression")
def _(spark, sf):
    """Raw feeds, and every table of Bronze, Silver and Gold as the catalog lists them."""
    raws = {(n, "raw"): raw for n, raw in _raws(spark, sf).items()}
    return _with_layers(
        spark, sf, lambda tables: metrics.layer_progression(raws | {(t.removesuffix(f"_{layer}"), layer): df for (layer, t), df in tables.items()})
    )
