"""File sources and sinks, event logs of a real session, incremental landing."""

import os

import pytest
import zstandard
from conftest import SF
from pyspark.sql import functions as F

from ledgerlake.operators import plan_logs
from ledgerlake.plans.specs import SPECS
from ledgerlake.sources import feeds, logs
from ledgerlake.sources.derived import raw_feed
from ledgerlake.streaming.landing import land_new_files


def test_json_feed_keeps_broken_records(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"dispute_id":"D1","dispute_amount":"$5"}\n{}\n{"dispute_id":"D2","dispu\n')
    rows = feeds.scan_feed(spark, str(tmp_path), "chargeback_disputes").collect()
    assert len(rows) == 3
    by = {(r.dispute_id, r._corrupt_record) for r in rows}
    assert by == {("D1", None), (None, None), (None, '{"dispute_id":"D2","dispu')}
    from ledgerlake.operators.hygiene import null_class

    classes = sorted(r.null_class for r in null_class(feeds.scan_feed(spark, str(tmp_path), "chargeback_disputes"), SPECS["chargeback_disputes"]).collect())
    assert classes == ["N1", "N2", "N3a"]


def test_csv_feed_with_line_breaks_quotes_and_blanks(spark, tmp_path):
    header = ",".join(SPECS["merchants_stores"].columns)
    (tmp_path / "m.csv").write_text(f'{header}\n" mer-1 ","Say ""hi""",CRYPTO*,$10,1%,,"line one\nline, two"\n')
    r = feeds.scan_feed(spark, str(tmp_path), "merchants_stores").first()
    assert (r.merchant_id, r.store_name, r.store_manager_code, r.region_notes) == (" mer-1 ", 'Say "hi"', None, "line one\nline, two")


def test_folder_date_is_the_innermost(spark):
    df = spark.createDataFrame([("/v/2020-01-01/feed/2024-02-03/f.json",), ("/v/day=2024-02-04/f",), ("/v/2024-02-05.json",)], "p string")
    assert [str(r[0]) for r in df.select(feeds.folder_date(F.col("p"))).collect()] == ["2024-02-03", "2024-02-04", "None"]


def test_ingest_keeps_every_row(spark, tmp_path):
    root = str(tmp_path)
    for feed in ("merchants_stores", "chargeback_disputes"):
        feeds.land_feed(raw_feed(spark, SF, feed), f"{root}/{feed}", feed)
    bronze = feeds.ingest(spark, root, {f: f for f in ("merchants_stores", "chargeback_disputes")}, env="test")
    for feed, table in bronze.items():
        raw = raw_feed(spark, SF, feed)
        assert table.select(raw.columns).exceptAll(raw).isEmpty() and raw.exceptAll(table.select(raw.columns)).isEmpty()
        assert table.where("_ingestion_timestamp is null or _source_file is null").isEmpty()
    from ledgerlake.operators.profile import feed_inventory

    got = {r.feed: r for r in feed_inventory(bronze, SPECS).collect()}
    for feed, table in bronze.items():
        assert got[feed].files == table.select("_source_file").distinct().count() > 0
        assert got[feed].raw_rows == table.count() == got[feed].corrupt_rows + got[feed].duplicate_rows + got[feed].clean_rows
    assert feeds.database_name("fraud", "bronze", "test") == "fraud_bronze_test"
    spark.sql("DROP DATABASE fraud_bronze_test CASCADE")


def test_incremental_landing_reads_each_file_once(spark, tmp_path):
    src, target, ck = (str(tmp_path / n) for n in ("src", "bronze", "ck"))
    raw = raw_feed(spark, SF, "device_auth_logs")
    feeds.land_feed(raw.limit(100), src + "/one", "device_auth_logs", F.lit("2024-02-01").cast("date"))
    first = land_new_files(spark, src, "device_auth_logs", target, ck)
    assert first.count() == 100 and first.where("folder_date <> date'2024-02-01' or folder_date is null").isEmpty()
    feeds.land_feed(raw.limit(30), src + "/two", "device_auth_logs")
    assert land_new_files(spark, src, "device_auth_logs", target, ck).count() == 130
    assert land_new_files(spark, src, "device_auth_logs", target, ck).count() == 130


def test_inventory_manifest_and_external_table(spark, tmp_path):
    root = str(tmp_path)
    spark.range(10).repartition(3).write.parquet(f"{root}/b")
    spark.range(10).repartition(2).write.parquet(f"{root}/c")
    got = {r.prefix: (r.files, r.chosen) for r in feeds.output_inventory(spark, root, ["a", "b", "c"]).collect()}
    assert got == {"a": (0, False), "b": (3, True), "c": (2, False)}
    check = feeds.manifest_check(spark, root, ["a", "b"], 5).collect()
    assert {(r.feed, r.objects, r.present, r.total_objects, r.ok) for r in check} == {("a", 0, False, 5, False), ("b", 3, True, 5, False)}
    assert all(r.ok for r in feeds.manifest_check(spark, root, ["b", "c"], 5).collect())
    assert not any(r.ok for r in feeds.manifest_check(spark, root, ["b", "c"], 6).collect())
    assert feeds.register_external(spark, "ext_test", f"{root}/b").count() == 10
    assert feeds.register_external(spark, "ext_test", f"{root}/c").count() == 10
    spark.sql("DROP TABLE ext_test")
    assert os.path.exists(f"{root}/b")


def test_erase_and_upsert_a_stored_table(spark):
    from ledgerlake.operators.dedup import erase, upsert

    base = spark.createDataFrame([(i, "old", 1) for i in range(5)], "k int, v string, ver int")
    table = feeds.replace_table(base, "stored")
    table = feeds.replace_table(erase(table, spark.createDataFrame([(3,)], "k int")), "stored")
    feeds.replace_table(upsert(table, spark.createDataFrame([(0, "new", 2)], "k int, v string, ver int"), ["k"], ["ver"]), "stored")
    assert {r.k: r.v for r in spark.table("stored").collect()} == {0: "new", 1: "old", 2: "old", 4: "old"}
    spark.sql("DROP TABLE stored")


def test_clustered_write_cuts_a_hot_key(spark, tmp_path):
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 100).alias("k"), "id")
    out = feeds.write_clustered(df, str(tmp_path / "t"), ["k"], partitions=8)
    per_file = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 20000 and len(per_file) == 8 and max(per_file) < 5000


def test_qualification_precedence(spark, tmp_path):
    root = tmp_path / "audit"
    (root / "deep").mkdir(parents=True)
    assert logs.scan_qualification(spark, str(root.parent)) is None
    (root / "x_qualification.tsv").write_text("app_id\tclass\nq\tz\n")
    assert logs.scan_qualification(spark, str(root)).first().app_id == "q"
    (root / "deep" / "AppsRecommendedForBoost.tsv").write_text("app_id\tclass\ndeep\tz\n")
    assert logs.scan_qualification(spark, str(root)).first().app_id == "deep"
    (root / "AppsRecommendedForBoost.tsv").write_text("")
    assert logs.scan_qualification(spark, str(root)).first().app_id == "deep"
    (root / "AppsRecommendedForBoost2.tsv").write_text("app_id\tclass\ntop\tz\n")
    assert logs.scan_qualification(spark, str(root)).first().app_id == "top"


def test_json_docs_fall_back(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"roi": 1.5,\n "n": [1]}')
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text("  \n")
    got = {r.name: (r.ok, r.roi) for r in logs.scan_json_docs(spark, str(tmp_path), '{"roi": 0.0}').select(
        F.regexp_extract("path", "([a-c]).json$", 1).alias("name"), "ok", F.variant_get("doc", "$.roi", "double").alias("roi")).collect()}
    assert got == {"a": (True, 1.5), "b": (False, 0.0), "c": (False, 0.0)}


@pytest.fixture(scope="module")
def small_logs(tmp_path_factory):
    root = tmp_path_factory.mktemp("logs")
    (root / "archive").mkdir()
    text = '{"Event":"SparkListenerSQLExecutionStart","p":"VeloxHashAggregate"}\nplain\n'
    (root / "app-1.json").write_text(text)
    (root / "app-2.zstd").write_bytes(zstandard.ZstdCompressor().compress((text + "BatchEvalPython \n").encode() + b"bad \xff byte\n"))
    (root / "app-9.json").write_text("\n  \n")
    (root / "app-02-decelerated-udf.json").write_text("seeded\n")
    (root / "archive" / "zz.json").write_text("archived\n")
    return str(root)


def test_event_log_scan_and_selection(spark, small_logs):
    lines = logs.scan_event_log(spark, small_logs)
    assert {r.app for r in lines.select("app").distinct().collect()} == {"app-1", "app-2", "app-9", "app-02-decelerated-udf", "zz"}
    assert any("�" in r.value for r in lines.where("app = 'app-2'").collect())
    assert {r.app for r in logs.latest_event_log(lines).select("app").distinct().collect()} == {"app-2"}
    got = {r.app: (r.has_batch_eval_python, r.native_operators, r.plan_event_count) for r in plan_logs.plan_summary(lines).collect()}
    assert got["app-1"] == (False, "VeloxHashAggregate", 1) and got["app-2"] == (True, "VeloxHashAggregate", 2)
    assert got["app-9"] == (None, "", 0)


def test_rolled_logs_belong_to_one_application(spark, tmp_path):
    d = tmp_path / "eventlog_v2_app-7"
    d.mkdir()
    for i in (1, 2):
        (d / f"events_{i}_app-7").write_text("x\n" * i)
    got = logs.scan_event_log(spark, str(tmp_path)).groupBy("app").count().collect()
    assert [(r.app, r["count"]) for r in got] == [("app-7", 3)]


def test_plan_events_in_file_order_over_splits(spark, tmp_path):
    (tmp_path / "app-1.json").write_text("".join(f"Velox {i:05d} {'x' * 5000}\n" for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        lines = logs.scan_event_log(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = plan_logs.plan_events(lines, limit=25, width=4000).orderBy("position").collect()
        every = plan_logs.plan_events(lines)
        assert every.count() > 25 and every.where("length(event) > 4000").count() > 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.event[:11] for r in got] == [f"Velox {i:05d}" for i in range(25)]
    assert {len(r.event) for r in got} == {4000}


def test_plan_fold_follows_nesting_of_any_depth(spark):
    def node(name, children, acc):
        metrics = ",".join(f'{{"name":"m [min, \\"med\\"]","accumulatorId":{a},"metricType":"sum"}}' for a in acc)
        return f'{{"nodeName":"{name}","simpleString":"s \\"nodeName\\":\\"fake\\" [x]","children":[{",".join(children)}],"metadata":{{}},"metrics":[{metrics}]}}'

    tree = node("Leaf", [], [0])
    for depth in range(1, 150):
        tree = node(f"N{depth}", [tree, node("ColumnarToRow", [], [1000 + depth])], [depth])
    df = spark.createDataFrame([(tree,)], "v string")
    got = {(m.acc, m.node) for m in df.select(plan_logs.plan_node_metrics(F.col("v")).alias("m")).first().m}
    want = {(0, "Leaf")} | {(d, f"N{d}") for d in range(1, 150)} | {(1000 + d, "ColumnarToRow") for d in range(1, 150)}
    assert got == want


def test_operators_read_this_sessions_own_log(spark, log_dir):
    """A Parquet query has columnar-to-row transitions, and a Python UDF shows in the plan."""
    @F.udf("long")
    def slow(x):
        return x + 1

    spark.read.parquet(f"{SF}/lineitem.parquet").select(slow("l_orderkey").alias("k")).agg(F.sum("k")).collect()
    lines = logs.scan_event_log(spark, log_dir)
    app = spark.sparkContext.applicationId
    summary = {r.app: r for r in plan_logs.plan_summary(lines).collect()}[app]
    assert summary.has_batch_eval_python and summary.plan_event_count >= 2
    nodes = {(r.node, r.metric): r.total_updates for r in plan_logs.metric_plan_join(lines).where(F.col("app") == app).collect()}
    assert nodes["ColumnarToRow", "number of output rows"] >= 6000 and ("ColumnarToRow", "number of input batches") in nodes
    gate = {r.app: r for r in plan_logs.deceleration_gate(lines).collect()}[app]
    assert gate.row_transition_updates >= 6000 and not gate.gate_passed
    assert plan_logs.deceleration_gate(lines, 10**15).where("not gate_passed").isEmpty()
    features = {r.app_id: r for r in plan_logs.qualify(lines).collect()}[app]
    assert features["class"] in ("udf_decelerated", "rdd_heavy") and features.python_plans > 0


def test_a_table_moves_to_new_files_without_a_gap(spark, tmp_path):
    name = "moved_table"
    try:
        paths = [str(tmp_path / p) for p in ("a", "b's", "c")]
        spark.range(3).write.parquet(paths[0])
        spark.range(5).write.parquet(paths[1])
        spark.range(2).selectExpr("id", "'x' as more").write.parquet(paths[2])
        assert feeds.register_external(spark, name, paths[0]).count() == 3
        assert feeds.register_external(spark, name, paths[1]).count() == 5
        assert spark.table(name).count() == 5
        assert feeds.register_external(spark, name, paths[2]).columns == ["id", "more"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


TEXT = "".join(f'{{"Event":"SparkListenerSQLExecutionStart","n":{i}}}\n' for i in range(30)) + "é   last\n"


@pytest.mark.parametrize("codec", ["zstd", "gzip", "bz2", "plain", "frames"])
def test_logs_without_a_suffix_are_known_by_their_first_bytes(spark, tmp_path, codec):
    import bz2
    import gzip

    def pack(text):
        data = text.encode()
        if codec == "frames":  # two frames in one file
            return zstandard.ZstdCompressor().compress(data[:500]) + zstandard.ZstdCompressor().compress(data[500:])
        return {"zstd": zstandard.ZstdCompressor().compress, "gzip": gzip.compress, "bz2": bz2.compress, "plain": bytes}[codec](data)

    plain, packed, rolled = (tmp_path / n for n in ("plain", "packed", "rolled"))
    for d in (plain, packed, rolled):
        d.mkdir()
    (plain / "app [1] +.json").write_text(TEXT)
    (packed / "app [1] +").write_bytes(pack(TEXT))
    (packed / "other.json").write_text("other\n")
    folder = rolled / "eventlog_v2_app-1"
    folder.mkdir()
    cut = [x + "\n" for x in TEXT.split("\n")[:-1]]
    for number, part in ((2, cut[7:20]), (10, cut[20:]), (1, cut[:7])):  # by number, not by name
        (folder / f"events_{number}_app-1").write_bytes(pack("".join(part)))

    def read(path, app):
        lines = logs.scan_event_log(spark, str(path)).where(F.col("app") == app)
        return [r.value for r in lines.orderBy("part", "block_start", "seq").collect()]

    want = read(plain, "app [1] +")
    assert want == [x.rstrip("\n") for x in cut]
    assert read(packed, "app [1] +") == want and read(packed, "other") == ["other"]
    assert read(rolled, "app-1") == want
    hidden = {r.path.rsplit("/", 1)[1]: r.codec for r in logs.hidden_codecs(spark, str(packed)).collect()}
    assert hidden == ({} if codec == "plain" else {"app [1] +": {"frames": "zstd"}.get(codec, codec)})
    events = plan_logs.plan_events(logs.scan_event_log(spark, str(rolled))).orderBy("position").collect()
    assert [(r.position, r.event) for r in events] == [(k + 1, x) for k, x in enumerate(want[:-1])]
    first = plan_logs.plan_events(logs.scan_event_log(spark, str(rolled)), limit=9).orderBy("position").collect()
    assert [r.event for r in first] == want[:9]
    summary = plan_logs.plan_summary(logs.scan_event_log(spark, str(rolled))).collect()
    assert [(r.app, r.plan_event_count) for r in summary] == [("app-1", 30)] and summary[0].path.endswith("eventlog_v2_app-1")


def test_lines_are_numbered_without_a_window_per_log(spark, plan_of):
    lines = spark.range(50_000).selectExpr(
        "'logs/app-1.json' as path", "'app-1' as app", "0L as part", "cast(floor(id / 1000) as bigint) * 1000 as block_start", "id as seq", "concat('Velox ', id) as value"
    )
    got = plan_logs.plan_events(lines)
    windows = [x for x in plan_of(got, "simple").splitlines() if "Window [" in x and "row_number" in x]
    assert windows and all("block_start" in x for x in windows)
    assert got.where("event <> concat('Velox ', position - 1)").isEmpty() and got.count() == 50_000


def test_the_listing_chooses_the_log(spark, small_logs, monkeypatch):
    opened = []
    scan = logs.scan_event_log
    monkeypatch.setattr(logs, "scan_event_log", lambda s, p: opened.append(p.rsplit("/", 1)[1]) or scan(s, p))
    lines = logs.scan_latest_event_log(spark, small_logs)
    assert opened == ["app-9.json", "app-2.zstd", "app-2.zstd"]  # a blank one first; the chosen one is looked at and read
    assert {r.app for r in lines.select("app").distinct().collect()} == {"app-2"}
    assert [f.rsplit("/", 1)[1] for f in lines.inputFiles()] == ["app-2.zstd"]


def test_no_log_at_all(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "a.json").write_text("x\n")
    (tmp_path / "b.json").write_text("\n")
    assert logs.scan_latest_event_log(spark, str(tmp_path)) is None
