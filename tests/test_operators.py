"""Operators against brute force on small or skewed inputs, and the shape of their plans."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerlake.operators import dedup, gates, hygiene, jobs, joins, metrics, parity, plan_logs
from ledgerlake.operators.orders import enrich_orders
from ledgerlake.operators.velocity import velocity
from ledgerlake.plans.gold import disputes_by_tx
from ledgerlake.plans.reconcile import promotion_gate, reconcile
from ledgerlake.plans.registry import QUERIES
from ledgerlake.plans.specs import SPECS
from ledgerlake.sources.derived import raw_feed


def skewed_events(n=600, seed=1):
    """One key has half of all rows, instants repeat, and an hour boundary is hit exactly."""
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1, 22, 0, 0)
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}"
        out.append((i, k, start + timedelta(seconds=rnd.choice([0, 1800, 3600, 7200, rnd.randrange(20000)]))))
    return [*out, (n, None, start), (n + 1, "hot", None)]


@pytest.mark.parametrize("seconds", [1, 60, 3600, 86400])
def test_velocity_brute_force(spark, seconds):
    data = skewed_events()
    df = spark.createDataFrame(data, "id int, k string, t timestamp_ntz")
    got = {r.id: r.v for r in velocity(df, "k", "t", seconds, "v").select("id", "v").collect()}
    width = timedelta(seconds=seconds)
    for i, k, t in data:
        if k is None or t is None:
            assert got[i] is None
        else:
            assert got[i] == sum(1 for _, k2, t2 in data if k2 == k and t2 is not None and t - width <= t2 <= t)
    assert len(got) == len(data)


def test_velocity_on_zoned_timestamps_and_before_1970(spark):
    rows = [(1, "a", datetime(1969, 12, 31, 23, 30)), (2, "a", datetime(1970, 1, 1, 0, 15)), (3, "a", datetime(1970, 1, 1, 0, 30))]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, "id int, k string, t timestamp_ntz").withColumn("t", F.col("t").cast(kind))
        assert [r.v for r in velocity(df, "k", "t", 3600, "v").orderBy("id").collect()] == [1, 2, 3]


def test_velocity_ignores_session_zone_and_keeps_microseconds(spark):
    first = datetime(2024, 3, 10, 1, 30, 0, 1)
    rows = [(1, first), (2, first + timedelta(hours=1)), (3, first + timedelta(hours=2, microseconds=1)), (4, first + timedelta(hours=3))]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(i, "a", t) for i, t in rows], "id int, k string, t timestamp_ntz")
        assert [r.v for r in velocity(df, "k", "t", 3600, "v").orderBy("id").collect()] == [1, 2, 1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_velocity_counts_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame(skewed_events(), "id int, k string, t timestamp_ntz")
    text = plan_of(velocity(df, "k", "t", 3600, "v"))
    assert "partial_count" in text and "RangeFrame" not in text


def test_velocity_splits_a_hot_hour(spark, plan_of):
    """One key and one hour with 300,000 instants: rows meet by second, and a bucket's window sees totals of seconds only."""
    start = 1_700_000_000 // 3600 * 3_600_000_000
    rows = spark.range(300_000).selectExpr("id", "'hot' as k", f"timestamp_micros({start} + (id * 7919) % 3600000000 + id % 13) as t")
    df = rows.unionByName(spark.createDataFrame([(-1, "hot", datetime(2023, 11, 14, 23, 0, 0))], "id long, k string, t timestamp"))
    got = velocity(df, "k", "t", 3600, "v")
    seen = got.select(F.unix_micros("t").alias("t"), "v").toPandas().sort_values("t")
    t = seen["t"].to_numpy()
    assert (seen["v"].to_numpy() == t.searchsorted(t, "right") - t.searchsorted(t - 3_600_000_000, "left")).all() and len(t) == 300_001
    windows = [line for line in plan_of(got, "simple").splitlines() if "Window [" in line]
    per_row = [line for line in windows if "expiry" in line]
    assert per_row and all("s#" in line[line.index("windowspecdefinition") :].split("ASC")[0] for line in per_row)
    most = rows.groupBy((F.unix_micros("t") / 1_000_000).cast("long").alias("s")).count().agg(F.max("count")).first()[0]
    assert most < 300_000 / 100  # rows of one task's group


@pytest.mark.parametrize("slice_seconds", [1, 7, 100_000])
def test_velocity_does_not_depend_on_slices(spark, slice_seconds):
    from ledgerlake.operators.velocity import velocity_by_instant

    df = spark.createDataFrame(skewed_events(), "id int, k string, t timestamp_ntz")
    want = sorted(map(str, velocity_by_instant(df, "k", "t", 3600, "v").collect()))
    assert sorted(map(str, velocity_by_instant(df, "k", "t", 3600, "v", slice_seconds).collect())) == want


def test_dedup_limits_groups_before_the_shuffle(spark, plan_of):
    df = raw_feed(spark, SF, "payment_transactions")
    text = plan_of(dedup.dedup_latest(df, ["transaction_id"], ["tx_ts"], ("tx_status", {"SETTLED": 1})), "simple")
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert "Partial" in text


def test_dedup_does_not_depend_on_row_order(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", None, "q")] * 3
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, v string").repartition(4)
        seen.add(tuple(sorted(map(tuple, dedup.dedup_latest(df, ["k"], ["t"]).collect()), key=str)))
    assert len(seen) == 1
    assert {r[0] for r in next(iter(seen))} == {"a", "b"}


def test_upsert_and_erase(spark):
    base = spark.createDataFrame([(i, "old", 1) for i in range(6)], "k int, v string, ver int")
    changes = spark.createDataFrame([(1, "new", 2), (1, "newer", 3), (2, "late", 0), (9, "added", 1)], "k int, v string, ver int")
    out = {r.k: r.v for r in dedup.upsert(base, changes, ["k"], ["ver"]).collect()}
    assert out == {0: "old", 1: "newer", 2: "old", 3: "old", 4: "old", 5: "old", 9: "added"}
    left = dedup.erase(base, spark.createDataFrame([(1,), (77,)], "k int"))
    assert sorted(r.k for r in left.collect()) == [0, 2, 3, 4, 5]


def test_upsert_shuffles_each_side_once(spark, plan_of):
    base = spark.range(5_000).selectExpr("id as k", "'old' as v", "1 as ver")
    changes = spark.range(4_000, 6_000).selectExpr("id as k", "'new' as v", "2 as ver")
    out = dedup.upsert(base, changes, ["k"], ["ver"])
    text = plan_of(out, "simple")
    assert text.count("Join") == 1 and text.count("Exchange hashpartitioning") == 2  # one for each side
    assert text.count("Range (0, 5000") == 1 and text.count("Range (4000, 6000") == 1
    assert {(r.v, r.n) for r in out.groupBy("v").agg(F.count("*").alias("n")).collect()} == {("old", 4_000), ("new", 2_000)}


def test_upsert_ties_and_missing_values(spark):
    """Same winners as a dedup over both sides, whatever is null, and rows without a key stay."""
    draw = random.Random(8)
    schema = "k int, k2 string, v string, a int, b int"

    def row(k):
        return k, draw.choice(["x", "x", None]), draw.choice("pqr"), draw.choice([None, 1, 2]), draw.choice([None, 1])

    base = list({(r[0], r[1]): r for r in (row(k) for k in range(60))}.values())
    changes = [row(draw.choice([*range(80), None])) for _ in range(200)] + base[:10]
    b, c = spark.createDataFrame(base, schema), spark.createDataFrame(changes, schema)
    got = sorted(map(str, dedup.upsert(b, c.select("b", "v", "k2", "a", "k"), ["k", "k2"], ["a", "b"]).collect()))
    keyed = "k is not null and k2 is not null"
    want = dedup.dedup_latest(b.unionByName(c).where(keyed), ["k", "k2"], ["a", "b"])
    lone = b.where(f"not ({keyed})").unionByName(dedup.dedup_latest(c.where(f"not ({keyed})"), ["k", "k2"], ["a", "b"]))
    assert got == sorted(map(str, want.unionByName(lone).collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_dim_salted_equals_broadcast(spark, plan_of, how):
    fact = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(300, None), (301, "none")], "id int, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(7)], "k string, d int")
    small, big = joins.join_dim(fact, dim, ["k"], how), joins.join_dim(fact, dim, ["k"], how, ["id"], limit=0, least_rows=20)
    assert sorted(small.select("id", "k", "d").collect(), key=str) == sorted(big.select("id", "k", "d").collect(), key=str)
    assert "_salt" in plan_of(big)
    with pytest.raises(ValueError):
        joins.join_dim(fact, dim, ["k"], "full")


def test_join_dim_spreads_hot_and_missing_keys(spark):
    fact = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("k")
    )
    dim = spark.range(40000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    out = joins.join_dim(fact, dim, ["k"], "left", ["id"], limit=0, parts=20, least_rows=1)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30000 and max(sizes) < 9000
    wrong = out.where("(k is null and d is not null) or (k is not null and d is distinct from k * 2)")
    assert wrong.isEmpty()


def test_facts_without_a_key_do_not_meet(spark):
    fact = spark.range(4_000).selectExpr("id", "case when id % 3 = 0 then null else cast(id % 50 as string) end as k")
    child = spark.range(200).selectExpr("cast(id % 60 as string) as k", "id as v").unionByName(spark.createDataFrame([(None, 5)], "k string, v long"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = joins.left_preagg(fact, child, "k", {"n": F.count(F.lit(1)), "v": F.sum("v")})
        per_task = [r["count"] for r in out.where("k is null").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 1_334 and max(per_task) < 400
        want = {str(k): (len(range(k, 200, 60)), sum(range(k, 200, 60))) for k in range(50)}
        assert all((r.n, r.v) == (want[r.k] if r.k else (0, 0)) for r in out.collect()) and out.columns == ["k", "id", "n", "v"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_join_dim_asks_for_the_size(spark):
    assert 0 < joins.plan_bytes(spark.read.parquet(f"{SF}/nation.parquet")) < 10**6
    wide = spark.range(10**9).withColumn("x", F.lit("y" * 50))
    assert joins.plan_bytes(wide) > joins.BROADCAST_LIMIT


def test_parity_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(2, None), (1, "x"), (3, "z")], "a int, b string")
    r = parity.parity(a, b).first()
    assert (r.left_rows, r.right_rows, r.only_left, r.only_right, r.equal) == (3, 3, 1, 1, False)
    assert {(x.a, x.surplus) for x in parity.bag_difference(a, b).collect()} == {(1, 1), (3, -1)}
    assert parity.parity(a, a.repartition(3)).first().equal
    assert parity.parity(a.limit(0), a.limit(0)).first().equal


def test_ordered_union_and_missing(spark):
    one = spark.createDataFrame([("b", 1), ("a", 0)], "u string, p int")
    two = spark.createDataFrame([("c", 0), ("a", 1)], "u string, p int")
    got = [r.u for r in parity.ordered_union([one, two], "u", "p").orderBy("list_no", "position").collect()]
    assert got == ["a", "b", "c"]
    assert [r.u for r in parity.missing(two.select("u"), one.select("u")).collect()] == ["c"]


def test_silver_invariants(spark, silver):
    raw = raw_feed(spark, SF, "payment_transactions")
    kept = hygiene.drop_corrupt(raw, SPECS["payment_transactions"])
    tx = silver["payment_transactions"]
    assert tx.count() == tx.select("transaction_id").distinct().count() == kept.select(F.upper(F.trim("transaction_id"))).distinct().count()
    assert tx.where("velocity_1h < 1 or velocity_1h is null").isEmpty()
    assert tx.where(hygiene.benign_null(SPECS["payment_transactions"])).count() > 0
    types = dict(tx.dtypes)
    assert types["tx_amount"] == types["net_amount_after_discount"] == "decimal(18,2)"
    for name, df in silver.items():
        assert not {"ssn", "email"} & set(df.columns), name
    assert dict(silver["customers_crm"].dtypes)["reward_points"] == "bigint"
    for name in ("customers_crm", "payment_transactions"):
        assert silver[name].where("masked_ssn is null or not masked_ssn rlike '^[0-9a-f]{64}$'").isEmpty()


def test_dedup_prefers_the_status_over_the_retry(silver):
    # retry copies carry PENDING; the original wins wherever its status ranks higher
    rows = silver["payment_transactions"].select(F.substring("transaction_id", 4, 9).cast("int").alias("n"), "tx_status").collect()
    want = {0: "SETTLED", 1: "AUTHORIZED", 2: "PENDING"}
    assert all(r.tx_status == want[r.n % 3] for r in rows)


def test_naive_join_inflates_and_preaggregation_does_not(silver):
    tx, d = silver["payment_transactions"], silver["chargeback_disputes"]
    r = joins.fanout_inflation(tx, d, "transaction_id", "tx_amount", "dispute_amount").first()
    direct = tx.join(d, "transaction_id", "left").agg(F.count(F.lit(1)).alias("n"), F.sum("tx_amount").alias("s")).first()
    assert (r.naive_rows, r.naive_amount) == (direct.n, direct.s)
    assert r.preagg_rows == tx.count() < r.naive_rows and r.inflation > 0
    assert disputes_by_tx(d).count() == d.select("transaction_id").distinct().count()


def test_reconcile_finds_what_an_inner_join_hides(silver, gold):
    tx, d = silver["payment_transactions"], silver["chargeback_disputes"]
    lost = gold.where("payment_method <> 1")
    full = {r.payment_method: r for r in reconcile(tx, d, lost).collect()}
    assert full[1].gold_tx_count == 0 and full[1].row_count_diff > 0 and full[0].row_count_diff == 0
    assert {r.payment_method for r in reconcile(tx, d, lost, "inner").collect()} == {0, 2}
    assert promotion_gate(reconcile(tx, d, gold)).first().promote
    assert not promotion_gate(reconcile(tx, d, lost)).first().promote
    assert not promotion_gate(reconcile(tx.limit(0), d, gold.limit(0))).first().promote


def test_reconcile_matches_missing_methods(spark, silver, gold):
    tx = silver["payment_transactions"].withColumn("payment_method", F.when(F.col("payment_method") > 0, F.col("payment_method")))
    g = gold.withColumn("payment_method", F.when(F.col("payment_method") > 0, F.col("payment_method")))
    assert promotion_gate(reconcile(tx, silver["chargeback_disputes"], g)).first().promote


def test_spot_check_reports_missing_rows(spark, silver):
    expected = spark.createDataFrame([("CUST-0000001", "x"), ("CUST-9999999", "x")], "customer_id string, masked_ssn string")
    assert {(r.customer_id, r.masked_ssn_ok) for r in metrics.spot_check(silver["customers_crm"], expected).collect()} == {
        ("CUST-0000001", False), ("CUST-9999999", False)
    }


def test_gate_summary_codes(spark):
    rows = [
        ("good", "a", True, 0, 1.0), ("good", "b", False, 2, 1.0), ("good", "c", True, 4, 0.5),
        ("bad", "a", True, 0, 1.0), ("bad", "b", True, 3, 1.0), ("error", "a", True, 1, 1.0), ("only advice", "a", True, 4, 1.0),
    ]
    df = spark.createDataFrame(rows, "run_id string, rule string, required boolean, exit_code int, elapsed double")
    got = {r.run_id: (r.required_total, r.required_passed, r.required_failed, r.advisories, r.gate_passed) for r in gates.gate_summary(df).collect()}
    assert got == {
        "good": (1, 1, 0, 1, True), "bad": (2, 1, 1, 0, False), "error": (1, 0, 1, 0, False), "only advice": (0, 0, 0, 1, False)
    }
    names = spark.range(6).select(gates.outcome(F.col("id").cast("int")).alias("o")).collect()
    assert [r.o for r in names] == ["passed", "script error", "failed", "ungraded", "advisory", "script error"]


def test_dq_scan_kinds_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, -1)], "k int, s string, n int")
    rules = [
        gates.Rule("nn", "not_null", ("s",)), gates.Rule("uq", "unique", ("k",)), gates.Rule("uq2", "unique", ("k", "s")),
        gates.Rule("rg", "range", ("n",), (0, 10)), gates.Rule("st", "set", ("s",), ("a",), 0.5),
        gates.Rule("rx", "regex", ("s",), ("^[ab]$",)), gates.Rule("rw", "row", (), ("n > 0",)),
    ]
    got = {r.rule: (r.evaluated, r.passed, r.ok) for r in gates.dq_scan(df, rules).collect()}
    assert got == {
        "nn": (3, 2, False), "uq": (3, 2, False), "uq2": (2, 2, True), "rg": (2, 1, False), "st": (2, 1, True),
        "rx": (2, 2, True), "rw": (3, 1, False),
    }
    assert all(r.ok for r in gates.dq_scan(df.limit(0), rules).collect())


FORBIDDEN = {
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "pjwu" or n.startswith("a")])
def test_no_python_evaluation_and_no_cross_joins(spark, nodes_of, name):
    nodes = nodes_of(QUERIES[name](spark, SF))
    assert nodes and not nodes & FORBIDDEN


def test_node_names_are_seen(spark, nodes_of):
    df = spark.range(3).select(F.udf("long")(lambda x: x)("id"))
    assert "BatchEvalPython" in nodes_of(df)


def test_filters_and_columns_reach_the_scan(spark, plan_of):
    text = plan_of(QUERIES["a7_disputes_by_tx"](spark, SF))
    columns = "".join(line for line in text.splitlines() if "ReadSchema" in line)
    assert "l_extendedprice" in columns and "l_returnflag" not in columns and "l_shipdate" not in columns
    scan = plan_of(QUERIES["w2_velocity"](spark, SF))
    assert "value" not in "".join(line for line in scan.splitlines() if "ReadSchema" in line)


def test_injected_rows(spark):
    plain = Counter(raw_feed(spark, SF, "customers_crm", injected=False).collect())
    full = Counter(raw_feed(spark, SF, "customers_crm").collect())
    extra = full - plain
    assert not plain - full
    empty = sum(n for r, n in extra.items() if all(v is None for v in r))
    assert empty > 0 and sum(extra.values()) - empty == sum(1 for k in range(150) if k % 13 == 0)


def test_small_joined_dimension_is_broadcast(spark, plan_of):
    orders, customer, nation = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "customer", "nation"))
    plan = plan_of(enrich_orders(orders, customer, nation))
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
    assert "_salt" in plan_of(enrich_orders(orders, customer, nation, limit=0))


def test_latest_job_older_than_ten_others(spark):
    rows = [(f"silver-{i:02}", "SUCCEEDED", f"2024-01-{i + 10}") for i in range(12)] + [("bronze-1", "SUCCEEDED", "2024-01-01")]
    df = spark.createDataFrame(rows, "name string, state string, createTime string")
    assert jobs.latest_job(df, "Bronze").first().name == "bronze-1"


def test_plan_lines_are_whole(spark):
    rows = [("p", "a", 0, i, "Velox" + "x" * 5000) for i in range(40)]
    df = spark.createDataFrame(rows, "path string, app string, block_start long, seq long, value string")
    events = plan_logs.plan_events(df)
    assert events.count() == 40 and events.where("length(event) <> 5005").isEmpty()
    assert plan_logs.plan_events(df, limit=3, width=7).select("event").distinct().collect() == [("Veloxxx",)]
    assert plan_logs.plan_summary(df).first().plan_event_count == 40
