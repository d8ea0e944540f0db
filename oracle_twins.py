"""The registered queries as ANSI SQL over the provided tables, for a checking engine.

Written from the operators' definitions, not from the Spark plans: correlated frames, direct 1:N joins
and window functions stand where the Spark side uses something else.
"""

from __future__ import annotations

from ledgerlake.plans.specs import EDGES, SPECS
from ledgerlake.sources import derived_logs as dl
from ledgerlake.sources.derived import DERIVATIONS

PAY, CUS, MER, DEV, DIS = (
    "payment_transactions", "customers_crm", "merchants_stores", "device_auth_logs", "chargeback_disputes",
)
EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
TWINS: dict[str, str] = {}


def raw(feed: str) -> str:
    d = DERIVATIONS[feed]
    cols = ", ".join(f"{e} as {c}" for c, e in d.columns.items())
    again = ", ".join(f"{e} as {c}" for c, e in {**d.columns, **dict(d.repeat_overrides)}.items())
    nulls = ", ".join(f"cast(null as varchar) as {c}" for c in d.columns)
    src = f"(select * from {d.source}) src"
    parts = [f"select {cols} from {src}"]
    if d.repeated:
        parts.append(f"select {again} from {src} where {d.key} % 13 = 0")
    parts.append(f"select {nulls} from {src} where {d.key} % 211 = 0")
    return "(" + " union all ".join(parts) + ")"


def trim(c: str) -> str:
    return f"regexp_replace({c}, '{EDGE}', '', 'g')"


def key(c: str) -> str:
    return f"upper({trim(c)})"


def num(c: str, t: str = "decimal(18,2)", accounting: bool = True) -> str:
    digits = f"regexp_replace({c}, '[^0-9.]', '', 'g')"
    minus = "-|\\(.*[0-9].*\\)" if accounting else "-"
    return f"try_cast(case when regexp_matches({c}, '{minus}') then '-' else '' end || {digits} as {t})"


def cat(c: str) -> str:
    return f"regexp_replace({trim(c)}, '[*!#\\s\\p{{Z}}]+$', '')"


def code(c: str) -> str:
    v = f"try_cast(nullif(regexp_replace({c}, '[^0-9]', '', 'g'), '') as integer)"
    return f"case when {v} in (0,1,2) then {v} end"


def ts(c: str) -> str:
    return (
        f"coalesce(try_strptime({c}, '%Y-%m-%d %H:%M:%S'), try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ'), "
        f"try_strptime({c}, '%m/%d/%Y %H:%M:%S'))"
    )


def ssn_hash(c: str) -> str:
    return f"sha256({trim(c)})"


def email_hash(c: str) -> str:
    return f"sha256(lower({trim(c)}))"


TYPES = {"decimal(18,2)": "decimal(18,2)", "bigint": "bigint", "double": "double"}


def cls(feed: str, accounting: bool = True) -> str:
    s = SPECS[feed]
    empty = " and ".join(f"{c} is null" for c in s.columns)
    nokey = " or ".join(f"coalesce({trim(k)}, '') = ''" for k in s.keys)
    if s.ts:
        nokey += f" or {ts(s.ts)} is null"
    return (
        f"case when {empty} then 'N1' when {nokey} then 'N3a' "
        f"when coalesce({num(s.metric, s.roles[s.metric], accounting)}, 0) <= 0 then 'N3b' "
        f"when {s.optional[0]} is null or {s.optional[1]} is null then 'N4' else 'CLEAN' end"
    )


PRIORITY = "case tx_status when 'SETTLED' then 3 when 'AUTHORIZED' then 2 when 'PENDING' then 1 else 0 end"


def typed_cols(feed: str) -> dict[str, str]:
    s = SPECS[feed]
    out = {}
    for c in s.columns:
        if c in s.pii:
            continue
        out[c] = (
            key(c) if c in s.keys else num(c, s.roles[c]) if c in s.roles else cat(c) if c in s.categories
            else trim(c) if c in s.texts else code(c) if c in s.codes else ts(c) if c == s.ts else c
        )
    if "ssn" in s.pii:
        out["masked_ssn"] = ssn_hash("ssn")
    if "email" in s.pii:
        out["masked_email"] = email_hash("email")
    return out


def clean(feed: str) -> str:
    """Silver of one feed without features."""
    s = SPECS[feed]
    cols = ", ".join(f"{e} as {c}" for c, e in typed_cols(feed).items())
    order = (f"{ts(s.ts)} desc" if s.ts else "1") + (f", {PRIORITY} desc" if feed == PAY else "")
    extra = ""
    if feed == PAY:
        extra = (
            ", cast(round(tx_amount * (1 - case when promo_code is not null then cast(discount_pct / 100 as decimal(10,4)) "
            "else 0 end), 2) as decimal(18,2)) as net_amount_after_discount"
        )
    penalty = " replace (coalesce(penalty_fee_usd, 0) as penalty_fee_usd)" if feed == DIS else ""
    return (
        f"(select *{penalty}{extra} from (select {cols} from (select *, row_number() over (partition by {key(s.key)} "
        f"order by {order}) as rn from {raw(feed)} where {cls(feed)} in ('N4','CLEAN')) where rn = 1))"
    )


DIST = (
    "2 * 6371.0 * asin(sqrt(greatest(0.0, least(1.0, pow(sin(radians(tx_lat - home_lat) / 2), 2) + "
    "cos(radians(home_lat)) * cos(radians(tx_lat)) * pow(sin(radians(tx_lon - home_lon) / 2), 2)))))"
)
SILVER_TX = (
    f"(select t.*, case when home_lat is not null then {DIST} end as geo_distance_km, "
    "count(*) over (partition by t.customer_id order by tx_ts range between interval 1 hour preceding and current row) as velocity_1h "
    "from tx t left join (select customer_id, home_lat, home_lon from cus) c on t.customer_id = c.customer_id)"
)
ANOMALY = "(coalesce(velocity_1h >= 5, false) or coalesce(geo_distance_km > 500.0, false))"
GOLD = (
    "(with d as (select transaction_id, count(dispute_id) as n, sum(dispute_amount) as amt, sum(penalty_fee_usd) as pen from dis group by 1), "
    "nomfa as (select customer_id, device_id, bool_or(mfa_method is null) as no_mfa from dev group by 1, 2), "
    "f as (select t.*, coalesce(d.n,0) as dn, coalesce(d.amt,0) as amt, coalesce(d.pen,0) as pen, "
    "coalesce(m.merchant_category in ('CRYPTO','GAMBLING'), false) as hr, "
    f"{ANOMALY} and coalesce(nm.no_mfa, false) as ato, coalesce(c.loyalty_tier, 'UNASSIGNED') as tier "
    "from stx t left join d on t.transaction_id = d.transaction_id left join mer m on t.merchant_id = m.merchant_id "
    "left join nomfa nm on t.customer_id = nm.customer_id and t.device_id = nm.device_id "
    "left join cus c on t.customer_id = c.customer_id) "
    "select customer_id, payment_method, max(tier) as loyalty_tier, count(*) as total_tx_count, "
    "cast(sum(tx_amount) as decimal(38,2)) as total_tx_amount, cast(sum(net_amount_after_discount) as decimal(38,2)) as total_net_amount, "
    "cast(count_if(hr) as bigint) as high_risk_mcc_tx_count, cast(coalesce(sum(case when hr then tx_amount end),0) as decimal(38,2)) as high_risk_mcc_amount, "
    "cast(count_if(ato) as bigint) as ato_mfa_tx_count, cast(coalesce(sum(case when ato then tx_amount end),0) as decimal(38,2)) as ato_mfa_tx_amount, "
    "cast(count_if(dn > 0) as bigint) as disputed_tx_count, cast(sum(amt) as decimal(38,2)) as total_disputed_amount, "
    "cast(sum(pen) as decimal(38,2)) as total_penalty_fee_usd from f group by 1, 2)"
)
CTE_ORDER = ("cus", "mer", "dev", "tx", "dis", "stx", "gold")
CTES = {
    "cus": clean(CUS), "mer": clean(MER), "dev": clean(DEV), "tx": clean(PAY), "dis": clean(DIS),
    "stx": SILVER_TX, "gold": GOLD,
}
NEEDS = {"stx": ("tx", "cus"), "gold": ("stx", "tx", "cus", "mer", "dev", "dis")}


def with_(names: str, body: str) -> str:
    """Prefix ``body`` with the named Silver/Gold relations and what they need."""
    wanted = set(names.split())
    for n in list(wanted):
        wanted |= set(NEEDS.get(n, ()))
    parts = ", ".join(f"{n} as {CTES[n]}" for n in CTE_ORDER if n in wanted)
    return f"with {parts} {body}"


def union(parts: list[str]) -> str:
    return " union all ".join(parts)


M = "decimal(38,2)"


def text2(e: str) -> str:
    return f"cast(cast({e} as {M}) as varchar)"


def big(e: str) -> str:
    return f"cast(coalesce({e}, 0) as bigint)"


# --- sources -----------------------------------------------------------------------------------------
_id = "try_cast(nullif(regexp_extract(transaction_id, '([0-9]+)', 1), '') as bigint)"
_cut = f"coalesce({_id} % 97 = 0, false)"
TWINS["s1_scan_feed"] = (
    "select " + ", ".join(f"case when {_cut} then null else {c} end as {c}" for c in SPECS[PAY].columns)
    + f", {_cut} as is_corrupt from {raw(PAY)}"
)
TWINS["s1_scan_feed_csv"] = f"select * from {raw(MER)}"
DATED = [f for f, s in SPECS.items() if s.dated]


def day(feed: str) -> str:
    if SPECS[feed].ts:
        return f"cast({ts(SPECS[feed].ts)} as date)"
    return "date '2024-01-01' + cast(try_cast(nullif(regexp_extract(dispute_id, 'DSP-([0-9]+)', 1), '') as bigint) % 3 as integer)"


TWINS["s2_scan_dated"] = union([
    f"select '{f}' as feed, {SPECS[f].key} as id, {SPECS[f].metric} as value, {day(f)} as folder_date from {raw(f)}" for f in DATED
])
TWINS["s4_incremental_ingest"] = union([
    f"select '{f}' as feed, day as folder_date, count(*) as row_count, cast(any_value(runs) as bigint) as runs from (select *, "
    f"max(case when coalesce(day(day) % 2 = 0, false) then 1 else 0 end) over () + max(case when coalesce(day(day) % 2 = 0, false) then 0 else 1 end) over () as runs "
    f"from (select {day(f)} as day from {raw(f)})) group by 2" for f in DATED
])
TWINS["s3_add_audit"] = f"select count(*) as cnt, count(*) as ts_cnt, count(*) as src_cnt from {raw(DEV)}"
TWINS["s4_write_bronze"] = f"select * from {raw(DIS)}"
_LOG = f"(select event_id, {dl.APP} as app, {dl.APP_NO} as app_no, {dl.BLOCK} as block, {dl.LINE} as value from events)"
TWINS["s5_scan_event_log"] = f"select app, count(*) as lines, {big('sum(length(value))')} as characters from {_LOG} group by app"
TWINS["s6_latest_event_log"] = (
    f"with k as (select * from {_LOG} where app_no % 4 <> 3 and app_no not in (37, 38)) "
    "select app, cast(row_number() over (order by event_id) as integer) as position, value from k where app = (select max(app) from k where trim(value) <> '')"
)
_CLS = (
    "case when app_no % 5 = 3 then 'rdd_heavy' when app_no % 5 = 1 then 'udf_decelerated' "
    "when app_no % 5 = 2 then 'unsupported_types' else 'pure_sql' end"
)
# at small scale an application may lack one of the eight kinds of line, hence the counts
_QUAL = (
    "(select app as app_id, app_no, "
    f"{big('count_if(event_id % 8 = 0)')} as sql_executions, "
    f"{big('count_if(event_id % 8 = 0 and app_no % 5 = 1)')} as python_plans, "
    f"{big('count_if(event_id % 8 in (0,1) and app_no % 5 = 2)')} as unsupported_plans, "
    f"{big('count_if(event_id % 8 = 5)')} as jobs, {big('count_if(event_id % 8 = 5 and app_no % 5 = 3)')} as rdd_jobs "
    f"from {_LOG} group by 1, 2)"
)
TWINS["s7_scan_qualification"] = (
    f"select app_id, {_CLS} as class, case when app_no % 5 in (0,4) then 'true' else 'false' end as recommend, "
    f"case when app_no % 5 in (0,4) then '2.0' else '1.0' end as est_speedup from {_QUAL}"
)
TWINS["s8_scan_json_docs"] = (
    "select event_id as n, event_id % 31 <> 0 and event_id % 37 <> 0 as ok, "
    f"case when event_id % 31 <> 0 and event_id % 37 <> 0 then {dl.JOB_STATE} else 'UNKNOWN' end as state from events"
)
TWINS["s9_output_inventory"] = (
    "select position, prefix, cast(files as bigint) as files, chosen from (values (0, 'orders_enriched_fixed', 0, false), "
    "(1, 'orders_enriched_nqe', 4, true), (2, 'orders_enriched', 2, false)) t(position, prefix, files, chosen)"
)
def _files(f: str) -> str:
    """Files in which a feed lands: one for each day, two for a feed without days."""
    return f"(select count(distinct coalesce(cast(d as varchar), 'none')) as n from (select {day(f)} as d from {raw(f)}))" if SPECS[f].dated else "(select 2 as n)"


_LANDED = " union all ".join(f"select '{f}' as feed, n from {_files(f)}" for f in SPECS)
TWINS["s10_manifest_check"] = (
    f"select feed, cast(n as bigint) as objects, n > 0 as present, cast(sum(n) over () as bigint) as total_objects, sum(n) over () >= 47 and min(n) over () > 0 as ok from ({_LANDED})"
)
TWINS["s11_register_external"] = with_("mer", "select * from mer")
TWINS["s12_write_clustered"] = with_("gold", "select * from gold")
_O = "select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as price, 1 as version from orders"
TWINS["s13_upsert"] = (
    f"with b as ({_O}), a as (select * from b union all select o_orderkey, o_orderstatus, cast(price * 2 as decimal(18,2)), 2 from b "
    "where o_orderstatus = 'O' union all select o_orderkey, 'X', price, 0 from b where price < 100000 "
    "union all select o_orderkey + 1000000000, o_orderstatus, price, version from b where price >= 400000) "
    "select * from a qualify row_number() over (partition by o_orderkey order by version desc) = 1"
)
TWINS["s14_erase"] = with_(
    "cus",
    "select * from cus where customer_id not in (select 'CUST-' || lpad(cast(c_custkey as varchar), 7, '0') from customer where c_acctbal < 0)",
)
# --- cleansing ---------------------------------------------------------------------------------------
TWINS["p1_norm_key"] = (
    f"select {key('transaction_id')} as transaction_id, {key('customer_id')} as customer_id, {key('device_id')} as device_id, tx_status from {raw(PAY)}"
)
TWINS["p2_parse_number"] = union([
    f"select '{c}' as column_name, {key(SPECS[f].key)} as id, {num(c)} as value from {raw(f)}"
    for f, c in (
        (PAY, "tx_amount"), (PAY, "discount_pct"), (CUS, "credit_limit_usd"), (CUS, "reward_points"),
        (MER, "terminal_monthly_fee_usd"), (MER, "commission_rate_pct"), (DEV, "auth_latency_ms"),
        (DEV, "risk_score_raw"), (DIS, "penalty_fee_usd"),
    )
])
TWINS["p3_cast_roles"] = (
    "select customer_id, " + ", ".join(f"{num(c, t)} as {c}" for c, t in SPECS[CUS].roles.items()) + f" from {raw(CUS)}"
)
TWINS["p4_parse_ts"] = f"select transaction_id, tx_status, tx_ts, {ts('tx_ts')} as parsed from {raw(PAY)}"
TWINS["p5_norm_category"] = union([
    f"select '{c}' as column_name, {cat(c)} as value, count(*) as row_count from {raw(f)} group by 1, 2"
    for f, c in ((DEV, "auth_event"), (CUS, "loyalty_tier"), (MER, "merchant_category"), (DIS, "reason_code"))
])
TWINS["p6_norm_code"] = f"select transaction_id, tx_status, payment_method, {code('payment_method')} as code from {raw(PAY)}"
TWINS["p7_trim_text"] = union([f"select {trim('full_name')} as name from {raw(CUS)}", f"select {trim('store_name')} as name from {raw(MER)}"])
TWINS["p8_null_class"] = union([f"select '{f}' as feed, {SPECS[f].key} as id, {cls(f)} as null_class from {raw(f)}" for f in SPECS])
TWINS["p9_drop_corrupt"] = f"select * from {raw(PAY)} where {cls(PAY)} in ('N4', 'CLEAN')"
TWINS["p10_benign_null"] = union([
    f"select '{f}' as feed, {s.key} as id, {s.optional[0]} is null or {s.optional[1]} is null as benign from {raw(f)}"
    for f, s in SPECS.items()
])
_D = "(select transaction_id, count(dispute_id) as dispute_count, cast(sum(dispute_amount) as decimal(38,2)) as disputed_amount, cast(sum(penalty_fee_usd) as decimal(38,2)) as penalty_fee_usd from dis group by 1)"
TWINS["p11_fill_defaults"] = with_(
    "tx dis cus",
    "select t.transaction_id, coalesce(c.loyalty_tier, 'UNASSIGNED') as loyalty_tier, coalesce(d.disputed_amount, 0) as disputed_amount, "
    f"coalesce(d.penalty_fee_usd, 0) as penalty_fee_usd from tx t left join {_D} d on t.transaction_id = d.transaction_id left join cus c on t.customer_id = c.customer_id",
)
_s = SPECS[CUS]
TWINS["p12_drop_pii"] = (
    "select " + ", ".join(f"{c if c in _s.keys else typed_cols(CUS)[c]} as {c}" for c in _s.columns if c not in _s.pii) + f" from {raw(CUS)}"
)
TWINS["p13_net_amount"] = with_("tx", "select transaction_id, tx_amount, discount_pct, promo_code, net_amount_after_discount from tx")
TWINS["p14_haversine_km"] = with_("stx", "select transaction_id, round(geo_distance_km, 4) as geo_distance_km from stx")
TWINS["p15_features_valid"] = with_("stx", "select transaction_id, geo_distance_km is not null and velocity_1h >= 1 as valid from stx")
TWINS["p16_is_anomaly"] = with_(
    "stx", "select transaction_id, velocity_1h >= 2 or coalesce(geo_distance_km > 500.0, false) as anomaly from stx"
)
_PLAN_LINE = (
    "event_id % 8 in (0, 1)"
)
TWINS["p17_plan_events"] = (
    f"select app, cast(position as integer) as position, value as event from (select *, row_number() over (partition by app order by event_id) as position "
    f"from {_LOG} where {_PLAN_LINE})"
)
TWINS["p18_filter_jobs"] = (
    f"select {dl.JOB_NAME} as name, {dl.JOB_STATE} as state, {dl.JOB_TIME} as createTime from events "
    "where (event_id % 9 <> 0 and event_id % 4 = 3) or event_id % 4 = 2"
)
_TIER = f"case when event_id % 10 <> 0 and event_id % 14 = 0 then 'premium' else {dl.JOB_TIER} end"
_ENGINE = f"case when event_id % 10 = 0 then 'default' else {dl.JOB_ENGINE} end"
TWINS["p19_runtime_conformance"] = (
    f"select {dl.JOB_STAGE} || '-' || cast(event_id as varchar) as batch_id, {_TIER} as tier, {_ENGINE} as engine, "
    f"'native' as lightning_engine_runtime, {_TIER} = 'premium' and {_ENGINE} = 'lightningEngine' as conforms from events"
)
TWINS["p20_masked_view"] = union([
    f"select 'auditor' as reader, customer_id, ssn, email, loyalty_tier from {raw(CUS)}",
    f"select 'analyst' as reader, customer_id, sha256(ssn) as ssn, sha256(email) as email, loyalty_tier from {raw(CUS)}",
])
TWINS["p21_hash_pii"] = f"select customer_id, {ssn_hash('ssn')} as masked_ssn, {email_hash('email')} as masked_email from {raw(CUS)}"
_ENRICHED = (
    "(select o_orderkey, o_custkey, upper(trim(c_mktsegment)) as segment, upper(substring(n_name,1,1)) || lower(substring(n_name,2)) as nation, "
    "cast(o_totalprice as decimal(18,2)) as price_usd, case when o_totalprice >= 300000 then 'HIGH' when o_totalprice >= 100000 then 'MEDIUM' else 'LOW' end as price_band, "
    "try_cast(substring(o_orderpriority,1,1) as integer) as priority_rank, strftime(o_orderdate, '%Y-%m') as order_month, "
    "case o_orderstatus when 'F' then 'FULFILLED' when 'O' then 'OPEN' else 'PARTIAL' end as status "
    "from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey)"
)
TWINS["p22_enrich_orders"] = f"select * from {_ENRICHED}"
# --- joins -------------------------------------------------------------------------------------------
TWINS["j1_left_preagg"] = with_(
    "tx dis",
    "select t.transaction_id, t.payment_method, t.tx_amount, coalesce(d.dispute_count, 0) as dispute_count, "
    f"coalesce(d.disputed_amount, 0) as disputed_amount from tx t left join {_D} d on t.transaction_id = d.transaction_id",
)
_SR = (
    f"(select payment_method, count(t.transaction_id) as silver_tx_count, cast(sum(tx_amount) as {M}) as silver_gross_usd, "
    f"cast(sum(net_amount_after_discount) as {M}) as silver_net_usd, {big('sum(coalesce(dispute_count,0))')} as silver_dispute_count, "
    f"{big('count_if(coalesce(dispute_count,0) > 0)')} as silver_disputed_tx_count, cast(sum(coalesce(disputed_amount,0)) as {M}) as silver_disputed_usd "
    f"from tx t left join {_D} d on t.transaction_id = d.transaction_id group by 1)"
)
_GR = (
    f"(select payment_method, {big('sum(total_tx_count)')} as gold_tx_count, cast(sum(total_tx_amount) as {M}) as gold_gross_usd, "
    f"cast(sum(total_net_amount) as {M}) as gold_net_usd, {big('sum(disputed_tx_count)')} as gold_disputed_tx_count, "
    f"cast(sum(total_disputed_amount) as {M}) as gold_disputed_usd from gold group by 1)"
)
TWINS["j2_inner_rollups"] = with_(
    "gold", f"select payment_method, silver_tx_count, gold_tx_count, silver_tx_count - gold_tx_count as row_count_diff from {_SR} s join {_GR} g using (payment_method)"
)
TWINS["j3_five_table_join"] = with_(
    "gold",
    f"select loyalty_tier, count(*) as gold_rows, {big('sum(total_tx_count)')} as tx_count, {big('sum(high_risk_mcc_tx_count)')} as high_risk, "
    f"{big('sum(ato_mfa_tx_count)')} as ato, {big('sum(disputed_tx_count)')} as disputed from gold group by 1",
)
TWINS["j4_dimension_join"] = TWINS["j4_dimension_join_salted"] = (
    f"select nation, segment, count(*) as orders, cast(sum(price_usd) as {M}) as price_usd from {_ENRICHED} group by 1, 2"
)


def _orphans(child: str, fk: str, parent: str, stage: str) -> str:
    w = key if stage == "after" else (lambda c: c)
    return (
        f"select '{child}.{fk}->{parent}' as edge, '{stage}' as stage, count(*) as child_rows, {big('count_if(not found)')} as orphan_rows, "
        f"count(distinct case when not found then k end) as orphan_keys from (select {w(fk)} as k, exists (select 1 from {raw(parent)} p "
        f"where {w('p.' + SPECS[parent].key)} = {w('c.' + fk)}) as found from {raw(child)} c where {fk} is not null)"
    )


TWINS["j5_orphan_report"] = union([_orphans(a, b, c, st) for a, b, c in EDGES for st in ("before", "after")])
TWINS["j6_hash_parity"] = with_(
    "tx cus",
    f"select count(*) as compared_rows, {big('count_if(t.masked_ssn = c.masked_ssn)')} as equal_rows, "
    "round(count_if(t.masked_ssn = c.masked_ssn)::double / count(*), 6) as parity_rate from tx t join cus c on t.customer_id = c.customer_id",
)
_NODES = (
    f"(select distinct app, app_no, block from {_LOG} where event_id % 8 in (0,1))"
)
_TR = "case app_no % 3 when 0 then 'ColumnarToRow' when 1 then 'VeloxColumnarToRow' else 'FilterExecTransformer' end"
_RT = "case when app_no % 5 = 1 then 'BatchEvalPython' else 'Project' end"
_UPD = (
    f"(select block, 1 as acc, event_id % 50 as u from {_LOG} where event_id % 8 = 2 union all "
    f"select block, 4, event_id % 3 from {_LOG} where event_id % 8 = 2 union all select block, 5, event_id % 900000 from {_LOG} where event_id % 8 = 2 union all "
    f"select block, 1, event_id % 7 from {_LOG} where event_id % 8 = 3 union all select block, 2, event_id % 11 from {_LOG} where event_id % 8 = 3 "
    f"union all select block, 1, event_id % 13 from {_LOG} where event_id % 8 = 4)"
)
_METRICS = (
    f"(select app, block, acc, {_TR} as node, metric from {_NODES}, (values (1, 'number of output rows'), (4, 'batches [in]'), (5, 'time')) v(acc, metric) "
    f"union all select app, block, 2, 'Scan parquet', 'number of output rows' from {_NODES} "
    f"union all select app, block, 3, {_RT}, 'data sent to workers' from {_LOG} where event_id % 8 = 0)"
)
TWINS["j7_metric_plan_join"] = (
    f"select m.app, m.node, m.metric, count(distinct m.block * 10 + m.acc) as metrics, {big('sum(coalesce(u.u, 0))')} as total_updates "
    f"from {_METRICS} m left join {_UPD} u on m.block = u.block and m.acc = u.acc group by 1, 2, 3"
)
TWINS["j8_ab_compare"] = (
    "with r as (select cast(floor(event_id / 8) as bigint) % 50 as job, event_id % 8 = 3 as std, "
    "case when event_id % 8 = 3 then event_id % 100 + 50 else event_id % 100 + 10 end as seconds from events where event_id % 4 = 3 and event_id % 9 <> 0), "
    "p as (select job, avg(case when std then seconds end) as s, avg(case when not std then seconds end) as a from r group by 1) "
    "select job, round(s, 4) as standard_sec, round(a, 4) as accelerated_sec, round(s / a, 4) as speedup from p"
)
# --- aggregations ------------------------------------------------------------------------------------
TWINS["a1_bronze_audit"] = union([
    *(f"select '{f}_bronze' as table_name, count(*) as cnt, count(*) as ts_cnt, count(*) as src_cnt from {raw(f)}" for f in SPECS),
    f"select 'payment_transactions_raw' as table_name, count(*) as cnt, -1 as ts_cnt, -1 as src_cnt from {raw(PAY)}",
])
_FEAT = (
    f"{big('count_if(geo_distance_km is not null and velocity_1h >= 1)')} as feat_cnt, {big('count_if(' + ANOMALY + ')')} as anomaly_cnt"
)
_RING = "count(distinct case when device_id = 'DEV-FRAUD-999' then customer_id end)"


def _metrics(feed: str, rel: str, extra: str) -> str:
    s = SPECS[feed]
    def exact(c: str) -> str:
        return f"cast({c} as decimal(18,2))" if s.roles.get(c) == "double" else c

    second = f"cast(cast(sum({s.secondary}) as bigint) as varchar)" if s.secondary_is_count else text2(f"sum({exact(s.secondary)})")
    return (
        f"select '{feed}_silver' as table_name, count(*) as cnt, {big(f'count_if({s.optional[0]} is null or {s.optional[1]} is null)')} as n4_cnt, "
        f"{text2(f'sum({exact(s.metric)})')} as p_sum, {second} as s_sum, {extra} from {rel}"
    )


_NONE = "-1 as feat_cnt, -1 as anomaly_cnt, -1 as ring_cnt"
TWINS["a2_silver_metrics"] = with_(
    "stx cus mer dev dis",
    union([_metrics(f, r, _NONE) for f, r in ((CUS, "cus"), (MER, "mer"), (DEV, "dev"), (DIS, "dis"))]
          + [_metrics(PAY, "stx", f"{_FEAT}, {_RING} as ring_cnt")]),
)
TWINS["a3_feature_counts"] = with_("stx", f"select {_FEAT}, {big('count_if(velocity_1h >= 2)')} as burst_cnt from stx")
TWINS["a4_ring_size"] = with_("tx", f"select {_RING} as ring_cnt from tx")
_HEX = "regexp_matches({}, '^[0-9a-f]{{64}}$')"
TWINS["a5_hash_format_counts"] = with_("cus tx", union([
    f"select 'customers_crm_silver' as table_name, count(*) as total_rows, {big('count_if(' + _HEX.format('masked_ssn') + ')')} as valid_ssn_cnt, "
    f"{big('count_if(' + _HEX.format('masked_email') + ')')} as valid_email_cnt from cus",
    f"select 'payment_transactions_silver' as table_name, count(*) as total_rows, {big('count_if(' + _HEX.format('masked_ssn') + ')')} as valid_ssn_cnt, -1 as valid_email_cnt from tx",
]))
TWINS["a6_gold_totals"] = with_(
    "gold",
    "select count(*) as row_count, count(distinct customer_id) as distinct_customers, "
    + ", ".join(f"{big(f'sum({c})')} as {c}" for c in ("total_tx_count", "high_risk_mcc_tx_count", "ato_mfa_tx_count", "disputed_tx_count"))
    + ", "
    + ", ".join(f"{text2(f'sum({c})')} as {c}" for c in (
        "total_tx_amount", "total_net_amount", "high_risk_mcc_amount", "ato_mfa_tx_amount", "total_disputed_amount", "total_penalty_fee_usd"))
    + " from gold",
)
TWINS["a7_disputes_by_tx"] = with_("dis", f"select * from {_D}")
TWINS["a8_silver_rollup"] = with_("tx dis", f"select * from {_SR}")
TWINS["a9_gold_rollup"] = with_("gold", f"select * from {_GR}")


def _recon(m: str) -> str:
    return (
        f"{text2(f'coalesce(silver_{m}_usd,0)')} as silver_{m}_usd, {text2(f'coalesce(gold_{m}_usd,0)')} as gold_{m}_usd, "
        f"{text2(f'coalesce(silver_{m}_usd,0) - coalesce(gold_{m}_usd,0)')} as {m}_variance_usd"
    )


TWINS["a10_reconcile"] = with_(
    "gold",
    "select coalesce(s.payment_method, g.payment_method) as payment_method, coalesce(silver_tx_count,0) as silver_tx_count, coalesce(gold_tx_count,0) as gold_tx_count, "
    f"coalesce(silver_tx_count,0) - coalesce(gold_tx_count,0) as row_count_diff, {_recon('gross')}, {_recon('net')}, {_recon('disputed')}, "
    "coalesce(silver_dispute_count,0) as silver_dispute_count, coalesce(silver_disputed_tx_count,0) as silver_disputed_tx_count, "
    "coalesce(gold_disputed_tx_count,0) as gold_disputed_tx_count, coalesce(silver_disputed_tx_count,0) - coalesce(gold_disputed_tx_count,0) as disputed_tx_count_diff "
    f"from {_SR} s full outer join {_GR} g on s.payment_method is not distinct from g.payment_method order by 1",
)
TWINS["a11_gold_mart"] = with_("gold", "select * from gold")
_ROLL = (
    f"count(*) as tx_count, cast(sum(tx_amount) as {M}) as gross_usd, cast(sum(net_amount_after_discount) as {M}) as net_usd, "
    f"cast(sum(coalesce(disputed_amount, 0)) as {M}) as disputed_usd from tx t left join {_D} d on t.transaction_id = d.transaction_id "
    "left join cus c on t.customer_id = c.customer_id group by 2"
)
TWINS["a12_dim_rollups"] = with_("tx cus dis", union([
    f"select 'payment_method' as dimension, cast(payment_method as varchar) as dimension_value, {_ROLL}",
    f"select 'loyalty_tier' as dimension, coalesce(loyalty_tier, 'UNASSIGNED') as dimension_value, {_ROLL}",
]))
TWINS["a13_fanout_histogram"] = with_(
    "dis", "select rows_per_key, count(*) as keys from (select count(*) as rows_per_key from dis group by transaction_id) group by 1"
)
TWINS["a14_fanout_inflation"] = with_(
    "tx dis",
    f"select (select count(*) from tx) as preagg_rows, count(*) as naive_rows, (select cast(sum(tx_amount) as {M}) from tx) as preagg_amount, "
    f"cast(sum(tx_amount) as {M}) as naive_amount, cast(sum(coalesce(dispute_amount, 0)) as {M}) as child_amount, "
    f"cast(sum(tx_amount) - (select sum(tx_amount) from tx) as {M}) as inflation from tx t left join dis d on t.transaction_id = d.transaction_id",
)
TWINS["a15_null_profile"] = union([f"select '{f}' as feed, {cls(f)} as null_class, count(*) as row_count from {raw(f)} group by 2" for f in SPECS])
# RE2 has no class difference: a Unicode space is any separator but the plain one
_DIRTY = {
    "currency_symbol": r"\$", "thousands_comma": "[0-9],[0-9]{3}", "unit_suffix": r"(?i)(USD|ms|pts|deg|%)[*#!\s\p{Z}]*$",
    "footnote_mark": "[*#!]", "unicode_space": r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]",
    "parentheses": r"\(.*[0-9].*\)", "edge_space": r"^[\s\p{Z}]|[\s\p{Z}]$", "lower_case": "[a-z]",
}


def _dirty(f: str) -> list[str]:
    s = SPECS[f]
    return [
        f"select '{f}' as feed, '{c}' as column_name, '{n}' as pattern, {big(f'''count_if(regexp_matches({c}, '{p}'))''')} as row_count from {raw(f)}"
        for c in dict.fromkeys([*s.keys, *s.roles, *s.categories, *s.texts, *s.codes]) for n, p in _DIRTY.items()
    ]


TWINS["a16_dirty_profile"] = union([q for f in SPECS for q in _dirty(f)])


def _fmt(f: str) -> str:
    c = SPECS[f].ts
    name = (
        f"case when {c} is null then 'missing' when try_strptime({c}, '%Y-%m-%d %H:%M:%S') is not null then 'iso' "
        f"when try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ') is not null then 'iso_z' when try_strptime({c}, '%m/%d/%Y %H:%M:%S') is not null then 'us' else 'unparseable' end"
    )
    return (
        f"select '{f}' as feed, format, count(*) as row_count, round(100.0 * count(*)::double / (sum(count(*)) over ())::double, 4) as share_pct "
        f"from (select {name} as format from {raw(f)}) group by 2"
    )


TWINS["a17_ts_format_profile"] = union([_fmt(PAY), _fmt(DEV)])


def _surge(f: str) -> str:
    return (
        f"select '{f}' as feed, day, raw_rows, clean_rows, round(100.0 * clean_rows::double / (sum(clean_rows) over ())::double, 4) as share_pct from "
        f"(select {day(f)} as day, count(*) as raw_rows, {big(f'''count_if({cls(f)} in ('N4','CLEAN'))''')} as clean_rows from {raw(f)} group by 1)"
    )


TWINS["a18_surge_profile"] = union([_surge(f) for f in DATED])
TWINS["a19_duplicate_report"] = union([
    f"select '{f}' as feed, '{s.key}' as key_column, {big('sum(n)')} as keyed_rows, {big('sum(n - 1)')} as duplicate_rows, "
    f"{big('count_if(n > 1)')} as repeated_keys, count(*) as surviving_rows from (select count(*) as n from {raw(f)} where {s.key} is not null group by {key(s.key)})"
    for f, s in SPECS.items()
])
TWINS["a20_feed_inventory"] = union([
    f"select '{f}' as feed, cast((select n from {_files(f)}) as bigint) as files, count(*) as raw_rows, {big('count_if(bad)')} as corrupt_rows, "
    f"{big('count_if(not bad) - count(distinct case when not bad then k end)')} as duplicate_rows, count(distinct case when not bad then k end) as clean_rows "
    f"from (select {key(s.key)} as k, {cls(f)} not in ('N4','CLEAN') as bad from {raw(f)})"
    for f, s in SPECS.items()
])
TWINS["a21_device_rings"] = with_(
    "tx", "select device_id, count(distinct customer_id) as customers, count(*) as tx_count from tx group by 1 having count(distinct customer_id) >= 5"
)
TWINS["a22_mcc_concentration"] = with_(
    "tx mer",
    "select merchant_category, tx_count, amount, merchant_category in ('CRYPTO','GAMBLING') as high_risk, "
    "round(100.0 * amount::double / (sum(amount) over ())::double, 4) as amount_share_pct from "
    f"(select coalesce(merchant_category, 'UNKNOWN') as merchant_category, count(*) as tx_count, cast(sum(tx_amount) as {M}) as amount "
    "from tx t left join mer m on t.merchant_id = m.merchant_id group by 1)",
)


def _bugs(f: str) -> str:
    s = SPECS[f]

    def metric(accounting: bool) -> str:
        return f"cast({num(s.metric, s.roles[s.metric], accounting)} as decimal(18,2))"

    def second(accounting: bool) -> str:
        if s.secondary in s.roles:
            return f"cast({num(s.secondary, s.roles[s.secondary], accounting)} as decimal(18,2))"
        rate = f"case when promo_code is not null then cast({num('discount_pct', 'double', accounting)} / 100 as decimal(10,4)) else 0 end"
        return f"cast(round({num(s.metric, s.roles[s.metric], accounting)} * (1 - {rate}), 2) as decimal(18,2))"

    ok = f"{cls(f)} in ('N4','CLEAN')"
    nok = f"{cls(f, False)} in ('N4','CLEAN')"

    def part(name: str, condition: str, v: str, w: str) -> str:
        return (
            f"{big(f'count_if({condition})')} as {name}_rows, cast(coalesce(sum(case when {condition} then {v} end),0) as {M}) as {name}_sum, "
            f"cast(coalesce(sum(case when {condition} then {w} end),0) as {M}) as {name}_secondary_sum"
        )

    return (
        f"select '{f}' as feed, {part('baseline', 'ok', 'v', 'w')}, {part('dropna', 'ok and not benign', 'v', 'w')}, {part('no_parentheses', 'nok', 'nv', 'nw')} from "
        f"(select distinct {key(s.key)} as k, {metric(True)} as v, {metric(False)} as nv, {second(True)} as w, {second(False)} as nw, {ok} as ok, {nok} as nok, "
        f"{s.optional[0]} is null or {s.optional[1]} is null as benign from {raw(f)} where {ok} or {nok})"
    )


TWINS["a23_bug_signatures"] = union([_bugs(f) for f in SPECS])
_SSN, _MAIL = "[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _pii(name: str, rel: str, texts: list[str], clear: str, missing: str, digest: str) -> str:
    def hit(p: str) -> str:
        return big("count_if(" + " or ".join(f"coalesce(regexp_matches({c}, '{p}'), false)" for c in texts) + ")")

    return (
        f"select '{name}' as table_name, '{clear}' as clear_columns, '{missing}' as missing_columns, count(*) as row_count, {hit(_SSN)} as ssn_rows, "
        f"{hit(_MAIL)} as email_rows, {digest} as digest_rows from {rel}"
    )


_h = _HEX.format
_REL = {CUS: "cus", MER: "mer", DEV: "dev", PAY: "stx", DIS: "dis"}


def _texts(f: str) -> list[str]:
    s = SPECS[f]
    return [c for c in typed_cols(f) if c not in s.roles and c not in s.codes and c != s.ts]


def _digests(f: str) -> str:
    found = [f"masked_{c}" for c in SPECS[f].pii]
    return big("count_if(" + " and ".join(f"coalesce({_h(c)}, false)" for c in found) + ")") if found else "-1"


TWINS["a24_pii_audit"] = with_("gold", union([
    *(_pii(f"{f}_bronze", raw(f), list(s.columns), ",".join(sorted(s.pii)), "", "-1") for f, s in SPECS.items()),
    *(_pii(f"{f}_silver", _REL[f], _texts(f), "", "", _digests(f)) for f in SPECS),
    _pii("gold_fraud_features", "gold", ["customer_id", "loyalty_tier"], "", "", "-1"),
]))
_OPS = (
    "VeloxHashAggregate", "ProjectExecTransformer", "FilterExecTransformer", "BroadcastHashJoinExecTransformer",
    "ColumnarToRowExec", "VeloxColumnarToRow",
)
TWINS["a25_plan_summary"] = (
    "select app, bool_or(case when trim(value) <> '' then contains(value, 'BatchEvalPython') end) as has_batch_eval_python, concat_ws(',', "
    + ", ".join(f"case when bool_or(contains(value, '{o}')) then '{o}' end" for o in _OPS)
    + f") as native_operators, {big('count_if(event_id % 8 in (0,1))')} as plan_event_count from {_LOG} group by app"
)
TWINS["a26_deceleration_gate"] = (
    f"with t as ({TWINS['j7_metric_plan_join']}), a as (select distinct app from {_LOG}) "
    f"select a.app, {big('''sum(case when metric = 'number of output rows' and node in ('ColumnarToRow','VeloxColumnarToRow') then total_updates end)''')} as row_transition_updates, "
    "coalesce(sum(case when metric = 'number of output rows' and node in ('ColumnarToRow','VeloxColumnarToRow') then total_updates end), 0) <= 500 as gate_passed from a left join t on a.app = t.app group by 1"
)
TWINS["a27_qualify"] = (
    f"select app_id, {_CLS} as class, app_no % 5 in (0,4) as recommend, case when app_no % 5 in (0,4) then 2.0::double else 1.0::double end as est_speedup, "
    f"sql_executions, python_plans, unsupported_plans, jobs, rdd_jobs from {_QUAL}"
)
_ROI = (
    f"(select {dl.JOB_STAGE} as class, cast((event_id % 40 + 1) * 0.25 * 2.5 as decimal(26,8)) as b, "
    "cast((event_id % 40 + 1) * 0.25 * 2.5 * case event_id % 4 when 1 then 0.6 when 2 then 0.8 else 1.0 end as decimal(26,8)) as p from events)"
)
_ROICOLS = (
    "count(*) as apps, cast(round(sum(b), 2) as decimal(38,2)) as baseline_cost, cast(round(sum(p), 2) as decimal(38,2)) as projected_cost, "
    "cast(round(sum(b) - sum(p), 2) as decimal(38,2)) as saving, round((sum(b) - sum(p))::double / sum(p)::double, 4) as roi"
)
TWINS["a28_fleet_roi"] = union([f"select class, {_ROICOLS} from {_ROI} group by 1", f"select 'TOTAL' as class, {_ROICOLS} from {_ROI}"])


def _rules(rel: str) -> list[tuple[str, str, str, str, float]]:
    """rule, kind, evaluated, passed, threshold"""
    n = "count(*)"
    return [
        ("customer_present", "not_null", n, "count(customer_id)", 1.0),
        ("grain_unique", "unique", "count_if(customer_id is not null and payment_method is not null)",
         "count(distinct case when customer_id is not null and payment_method is not null then customer_id || '|' || cast(payment_method as varchar) end)", 1.0),
        ("method_known", "set", "count(payment_method)", "count_if(payment_method in (0,1,2))", 1.0),
        ("amount_not_negative", "range", "count(total_tx_amount)", "count_if(total_tx_amount >= 0)", 1.0),
        ("customer_format", "regex", "count(customer_id)", "count_if(regexp_matches(customer_id, '^CUST-[0-9]{7}$'))", 1.0),
        ("net_within_gross", "row", n, "count_if(total_net_amount <= total_tx_amount)", 1.0),
        ("tier_assigned", "set", "count(loyalty_tier)", "count_if(loyalty_tier in ('GOLD','SILVER','BRONZE'))", 0.5),
    ]


def _scan() -> str:
    return union([
        f"select '{r}' as rule, '{k}' as kind, {big(e)} as evaluated, {big(p)} as passed, round(coalesce({p}::double / nullif({e}, 0), 1.0), 6) as ratio, "
        f"round(coalesce({p}::double / nullif({e}, 0), 1.0), 6) >= {t} as ok from gold"
        for r, k, e, p, t in _rules("gold")
    ])


def _scan_by_run() -> str:
    """Rules per payment method, a missing one included."""
    run = "'run-' || coalesce(cast(payment_method as varchar), 'none')"
    return union([
        f"select {run} as run_id, round(coalesce({p}::double / nullif({e}, 0), 1.0), 6) >= {t} as ok from gold group by 1"
        for _, _, e, p, t in _rules("gold")
    ])


TWINS["q1_dq_scan"] = with_("gold", _scan())
_RUNS = union([
    f"select run_id, count(*) as total, count_if(ok) as passed from ({_scan_by_run()}) group by 1"
])
TWINS["a29_gate_summary"] = with_(
    "gold",
    f"select run_id, {big("total + case when run_id <> 'run-2' then 1 else 0 end")} as required_total, "
    f"{big("passed + case when run_id <> 'run-2' then 1 else 0 end")} as required_passed, {big('total - passed')} as required_failed, "
    "cast(1 as bigint) as advisories, round(total * 0.25::double + 0.5 + 0.1, 2) as total_elapsed, total = passed as gate_passed "
    f"from ({_RUNS})",
)
# --- windows, sorts, sets ----------------------------------------------------------------------------
TWINS["w1_dedup_latest"] = (
    f"select transaction_id, customer_id, tx_ts, tx_status, tx_amount from (select {key('transaction_id')} as transaction_id, {key('customer_id')} as customer_id, "
    f"{ts('tx_ts')} as tx_ts, tx_status, tx_amount, row_number() over (partition by {key('transaction_id')} order by {ts('tx_ts')} desc, {PRIORITY} desc) as rn "
    f"from {raw(PAY)} where {cls(PAY)} in ('N4','CLEAN')) where rn = 1"
)
TWINS["w2_velocity"] = (
    "select event_id, count(*) over (partition by user_id order by ts range between interval 1 hour preceding and current row) as velocity_1h from events"
)
TWINS["w2_velocity_silver"] = with_("stx", "select transaction_id, customer_id, velocity_1h from stx")
TWINS["w3_share"] = (
    "select auth_event, mfa_method, row_count, round(100.0 * row_count::double / (sum(row_count) over (partition by auth_event))::double, 4) as share_pct from "
    f"(select {cat('auth_event')} as auth_event, coalesce(mfa_method, 'NONE') as mfa_method, count(*) as row_count from {raw(DEV)} group by 1, 2)"
)
_JOBS = f"(select {dl.JOB_NAME} as name, {dl.JOB_STATE} as state, {dl.JOB_TIME} as createTime from events)"
_DONE = f"(select name, createTime from {_JOBS} where state = 'SUCCEEDED')"
_TOP = f"(select name, createTime from {_DONE} order by createTime desc, name limit 10)"
TWINS["w4_latest_job"] = union([
    f"select * from (select '{s}' as stage, name, createTime from {_DONE} order by contains(lower(name), '{s.lower()}') desc, createTime desc, name limit 1)"
    for s in ("Bronze", "Silver", "nowhere")
])
TWINS["l1_ordered_reconcile"] = (
    f"select *, cast(row_number() over (order by payment_method nulls last) as integer) as position from ({TWINS['a10_reconcile']}) order by position"
)
TWINS["l2_spot_check"] = with_(
    "cus",
    "select 'CUST-' || lpad(cast(c_custkey as varchar), 7, '0') as customer_id, c_mktsegment <> 'BUILDING' and x.customer_id is not null as masked_ssn_ok, "
    "x.customer_id is not null as masked_email_ok from customer left join cus x on x.customer_id = 'CUST-' || lpad(cast(c_custkey as varchar), 7, '0')",
)
TWINS["l3_recent_jobs"] = f"select * from {_TOP}"
_lost, _twice = "o_orderstatus = 'P' and o_orderpriority = '5-LOW'", "o_totalprice >= 450000 and o_orderstatus <> 'P'"
TWINS["u1_parity"] = (
    "select 'refactored' as variant, count(*) as left_rows, count(*) as right_rows, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right, "
    "true as equal from orders union all "
    f"select 'faulty' as variant, count(*) as left_rows, {big(f'count(*) - count_if({_lost}) + count_if({_twice})')} as right_rows, "
    f"{big(f'count_if({_lost})')} as only_left, {big(f'count_if({_twice})')} as only_right, count_if(({_lost}) or ({_twice})) = 0 as equal from orders"
)
TWINS["u2_missing"] = with_(
    "tx", "select 'TX-' || lpad(cast(event_id as varchar), 9, '0') as transaction_id from events except all select transaction_id from tx"
)
TWINS["u3_ordered_union"] = (
    "select item, list_no, place as position from (select user_id as item, case event_id % 3 when 2 then 0 when 0 then 1 else 2 end as list_no, event_id as place from events) "
    "qualify row_number() over (partition by item order by list_no, place) = 1"
)
TWINS["q2_promotion_gate"] = with_(
    "gold",
    "select 'complete' as build, count(distinct payment_method) as methods, cast(0 as bigint) as failing_methods, true as promote from gold union all "
    "select 'row lost' as build, count(distinct payment_method) as methods, cast(case when count_if(payment_method = 1 and customer_id = 'CUST-0000001') > 0 then 1 else 0 end as bigint) as failing_methods, "
    "count_if(payment_method = 1 and customer_id = 'CUST-0000001') = 0 as promote from gold",
)
TWINS["q3_layer_progression"] = with_("gold", union(
    [f"select '{f}' as table_name, 'raw' as layer, count(*) as row_count, cast({len(s.columns)} as bigint) as column_count from {raw(f)}" for f, s in SPECS.items()]
    + [f"select '{f}' as table_name, 'bronze' as layer, count(*) as row_count, cast({len(s.columns) + (4 if s.dated else 3)} as bigint) as column_count from {raw(f)}" for f, s in SPECS.items()]
    + [f"select '{f}' as table_name, 'silver' as layer, count(*) as row_count, cast({len(s.columns) + (3 if f == PAY else 0)} as bigint) as column_count from {_REL[f]}" for f, s in SPECS.items()]
    + ["select 'gold_fraud_features' as table_name, 'gold' as layer, count(*) as row_count, cast(13 as bigint) as column_count from gold"]
))
