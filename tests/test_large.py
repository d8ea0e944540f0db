"""What keeps the feeds' work in proportion to their rows on large tables."""

import os
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerlake.functions import cleanse as c
from ledgerlake.operators import hygiene
from ledgerlake.operators.dedup import dedup_latest
from ledgerlake.plans import silver as sv
from ledgerlake.plans.registry import QUERIES, _land
from ledgerlake.plans.specs import SPECS
from ledgerlake.sources import derived, feeds
from ledgerlake.sources.derived import raw_feed

HUGE = 8000  # bytes of a method that the JVM does not compile


@pytest.mark.parametrize("feed", list(SPECS))
def test_generated_methods_are_compiled(spark, feed):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = sv.clean(raw_feed(spark, SF, feed), SPECS[feed])._jdf.queryExecution().executedPlan()
        parts = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < HUGE


def test_keys_behind_the_null_contract_are_compiled(spark):
    spec = SPECS["device_auth_logs"]
    plan = sv.keyed(hygiene.drop_corrupt(raw_feed(spark, SF, spec.name), spec), spec)._jdf.queryExecution()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan.executedPlan())
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < HUGE


def test_spread_looks_at_rows_not_at_splits(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    n = 200_000
    pq.write_table(pa.table({"event_id": list(range(n)), "text": [str(i * 7919 % 10**9) for i in range(n)]}), path, row_group_size=n)
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(path) // (2 * cores)))
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= cores and derived.filled_splits(df) == 1
        out = derived.spread(df, ["event_id"])
        assert derived.filled_splits(out) == cores and out.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_distances_read_stored_transactions(spark, plan_of):
    # beyond the broadcast limit the join counts its facts too; they must not be cleaned again for that
    assert "events.parquet" not in plan_of(QUERIES["p14_haversine_km"](spark, SF))


def test_dated_landing_is_compressed_and_whole(spark, tmp_path):
    raw = spark.createDataFrame(
        [(f"DSP-{i}", f"TX-{i}", None, "$5", None, "not\nmine", None) for i in range(50)], ", ".join(f"{c} string" for c in SPECS["chargeback_disputes"].columns)
    )
    root = str(tmp_path / "landing")
    feeds.land_feed(raw, root, "chargeback_disputes", F.lit("2024-01-01").cast("date"))
    names = [f for _, _, found in os.walk(root) for f in found if f.startswith("part-")]
    assert names and all(f.endswith(".json.gz") for f in names)
    back = feeds.scan_dated(spark, root, "chargeback_disputes").select(*raw.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, raw.collect()))


def test_spread_bounds_the_rows_of_a_split(spark, tmp_path):
    path, cores = str(tmp_path / "events"), spark.sparkContext.defaultParallelism
    os.makedirs(path)
    n, width = 1000 * 2 * cores, 40
    for i in range(2 * cores):
        rows = range(i * 1000, (i + 1) * 1000)
        pq.write_table(pa.table({"event_id": list(rows), "text": [str(r) * width for r in rows]}), f"{path}/{i}.parquet", compression="none", use_dictionary=False)
    df = spark.read.parquet(path)
    assert derived.filled_splits(df) >= cores
    kept, cut = derived.spread(df, ["event_id"], least=1, rows=n), derived.spread(df, ["event_id"], least=1, rows=200)
    assert kept.rdd.getNumPartitions() == df.rdd.getNumPartitions()
    assert cut.rdd.getNumPartitions() == n // 200 and cut.count() == n and cut.distinct().count() == n


def test_dedup_sorts_by_a_hash_of_the_key(spark, plan_of):
    # a sort compares eight bytes of its first column before whole rows, and those of TX-000000001 and its like are equal
    df = spark.createDataFrame([("TX-000000001", 1), ("TX-000000001", 2), (None, 3), (None, 4), ("TX-000000002", None)], "k string, t int")
    out = dedup_latest(df, ["k"], ["t"], by_hash=True)
    sorts = [line for line in plan_of(out, "simple").splitlines() if "Sort [" in line]
    assert len(sorts) == 2 and all("Sort [_w" in line for line in sorts)
    assert {tuple(r) for r in out.collect()} == {("TX-000000001", 2), (None, 4), ("TX-000000002", None)}
    assert {tuple(r) for r in dedup_latest(df, ["k"], ["t"]).collect()} == {tuple(r) for r in out.collect()}


def test_status_priority_as_before(spark):
    rows = [("a", "PENDING"), ("a", "SETTLED*"), ("b", "AUTHORIZED"), ("b", None), ("c", "odd"), ("c", "PENDING!"), ("d", None)]
    out = dedup_latest(spark.createDataFrame(rows, "k string, s string"), ["k"], (), (c.norm_category("s"), sv.STATUS_PRIORITY))
    assert {tuple(r) for r in out.collect()} == {("a", "SETTLED*"), ("b", "AUTHORIZED"), ("c", "PENDING!"), ("d", None)}


NUMBERS = [
    "12", "12.5", "$12.50", "-5", "$-5", "-$5", "+5", "12.", ".5", "12.5%", "12 %", "5ms", "5 ms", "5 MS", "$5 USD", "USD 5", "(5)", "5)", "$1,234.50 USD", "12,5", "1e5",
    "5 ", "-15 deg", "5\n", "5.678", "9" * 20, "--5", "$$5", "5 pts*", "1.2.3", "$ 5", "5USDUSD", "", "$", None,
]


def test_short_pattern_agrees_with_the_full_one(spark):
    df = spark.createDataFrame([(v,) for v in NUMBERS], "v string")
    for t in (c.CURRENCY, c.COUNT, c.MEASURE):
        full = F.translate(F.regexp_replace("v", c._NUMBER, "$1$3$4$6$2$5"), "(,", "-").try_cast(t)
        assert df.where(~c.parse_number("v", t).eqNullSafe(full)).collect() == []
    short = {r.v for r in df.where(F.col("v").rlike(c._PLAIN)).collect()}
    assert {"12", "$12.50", "$5 USD", "-15 deg", "12.5%", "5ms"} <= short  # most values of the feeds do not need the full one


def test_text_without_outer_spaces_is_not_trimmed(spark):
    texts = ["a", "TX-1", " tx-1 ", "\u3000a\u00a0", "a b", "\u00e9t\u00e9", "x\n", "\n", "", " ", "\u0085a", None]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    assert df.where(~c.trim_text("v").eqNullSafe(F.btrim("v", F.lit(c.SPACES)))).collect() == []
    assert {r.v for r in df.where(F.col("v").rlike(c._TRIMMED)).collect()} == {"a", "TX-1", "a b"}


def test_price_is_written_once_per_line(spark, plan_of):
    optimised = plan_of(raw_feed(spark, SF, "chargeback_disputes"), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimised.count("cast(l_extendedprice") == 1


@pytest.mark.parametrize("feed", list(SPECS))
def test_values_are_worked_out_once_and_then_judged(spark, plan_of, feed):
    # a filter behind a projection moves below it and repeats its expressions
    spec, raw = SPECS[feed], raw_feed(spark, SF, feed)
    out = hygiene.sound_keyed(raw, spec)
    optimised = plan_of(out, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimised.count("regexp_replace(") == 1 and optimised.count("try_cast(translate(") == 1  # the metric's
    assert optimised.count("translate(_text") == (1 if spec.ts else 0)
    before = sv.keyed(hygiene.drop_corrupt(raw, spec).select(*spec.columns), spec)
    assert out.drop("_metric").exceptAll(before).isEmpty() and before.exceptAll(out.drop("_metric")).isEmpty()


def test_sound_rows_with_odd_text(spark):
    spec = SPECS["device_auth_logs"]
    keys, times, numbers = ["k", " \u3000", "", None, "\u0085", "\u00a0a*"], ["2024-01-02 03:04:05", "\u00a001/02/2024 03:04 ", "1700000000", "x", None], ["5ms", "(5)", "0", "x", None]
    rows = [(k, "d", "c", "e*", n, "1", None, None, t) for k in keys for t in times for n in numbers]
    raw = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in spec.columns))
    out, before = hygiene.sound_keyed(raw, spec).drop("_metric"), sv.keyed(hygiene.drop_corrupt(raw, spec), spec)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, before.collect()))
    assert out.count() == 9  # three keys, three times and one number hold
    broken = raw.withColumn(hygiene.CORRUPT, F.when(F.col("session_id") == "k", "{"))
    assert {r.session_id for r in hygiene.sound_keyed(broken, spec).collect()} == {"\u0085", "A*"}


def test_category_without_marks_needs_no_pattern(spark):
    texts = ["a", "a*", "a *!", "*", "a\u0085", "a*\u0085", " a# ", "", None, "a\u2028", "*a"]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    full = F.regexp_replace(F.btrim("v", F.lit(c.SPACES)), r"(?<![*!#\s\p{Z}])[*!#\s\p{Z}]+$", "")
    assert df.where(~c.norm_category("v").eqNullSafe(full)).collect() == []


def test_equal_totals_are_rolled_up_once(spark, plan_of):
    # both builds are compared with the same stored totals of Silver
    assert "chargeback_disputes_silver" not in plan_of(QUERIES["q2_promotion_gate"](spark, SF))


def test_feeds_are_landed_at_the_same_time(spark, tmp_path, monkeypatch):
    all_there, landed = threading.Barrier(len(SPECS), timeout=60), []

    def land(df, path, feed, day=None):
        all_there.wait()
        landed.append((feed, path, day is not None))

    monkeypatch.setattr(feeds, "land_feed", land)
    _land(spark, SF, str(tmp_path))
    assert sorted(landed) == sorted((n, f"{tmp_path}/{n}", s.dated) for n, s in SPECS.items())
