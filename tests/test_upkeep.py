"""Incremental ingest by a file ledger, erasure by file, scratch tables."""

import os
import shutil

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerlake.session import STAGES, stage, work_root
from ledgerlake.sources import erasure, feeds, files
from ledgerlake.sources.derived import raw_feed
from ledgerlake.sources.ledger import FileLedger

PAY, DIS, MER = "payment_transactions", "chargeback_disputes", "merchants_stores"


@pytest.fixture
def database(spark, request):
    unit = "u" + str(abs(hash(request.node.name)) % 10**8)
    yield unit
    spark.sql(f"DROP DATABASE IF EXISTS {unit}_bronze_t CASCADE")
    shutil.rmtree(os.path.join(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), f"{unit}_bronze_t.db"), ignore_errors=True)


def land(root, feed, day, rows):
    folder = root / feed / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part [{day}] +1 %20.json").write_text("\n".join(rows) + "\n")


def scanned(monkeypatch):
    """Files that each scan of an event feed lists."""
    seen = []
    scan = feeds.scan_dated

    def watch(spark, root, feed):
        df = scan(spark, root, feed)
        seen.append((feed, sorted(os.path.basename(os.path.dirname(f)) for f in df.inputFiles())))
        return df

    monkeypatch.setattr(feeds, "scan_dated", watch)
    return seen


def test_a_run_reads_new_files_only(spark, tmp_path, database, monkeypatch):
    for feed, key in ((PAY, "transaction_id"), (DIS, "dispute_id")):
        for day in ("2024-01-01", "2024-01-02"):
            land(tmp_path, feed, day, [f'{{"{key}":"{day}-{k}"}}' for k in range(3)])
    seen = scanned(monkeypatch)

    def run():
        seen.clear()
        out = feeds.ingest(spark, str(tmp_path), {PAY: PAY, DIS: DIS}, database, "t")
        return {f: df.count() for f, df in out.items()}

    assert run() == {PAY: 6, DIS: 6}
    assert seen == [(PAY, ["2024-01-01", "2024-01-02"]), (DIS, ["2024-01-01", "2024-01-02"])]
    assert run() == {PAY: 6, DIS: 6} and seen == []
    land(tmp_path, DIS, "2024-01-03", ['{"dispute_id":"x"}'])
    assert run() == {PAY: 6, DIS: 7} and seen == [(DIS, ["2024-01-03"])]
    days = spark.table(f"{database}_bronze_t.{DIS}_bronze").groupBy("folder_date").count().collect()
    assert {(str(r.folder_date), r["count"]) for r in days} == {("2024-01-01", 3), ("2024-01-02", 3), ("2024-01-03", 1)}
    ledger = spark.table(f"{database}_bronze_t.ingest_ledger")
    assert ledger.where("state = 'done'").count() == 5 and ledger.groupBy("path", "state").count().where("count > 1").isEmpty()
    land(tmp_path, PAY, "2024-01-01", ['{"transaction_id":"other"}'])
    with pytest.raises(ValueError, match="2024-01-01"):
        run()


@pytest.mark.parametrize("arrived", [False, True])
def test_a_lost_run_is_neither_repeated_nor_skipped(spark, tmp_path, database, monkeypatch, arrived):
    land(tmp_path, PAY, "2024-01-01", ['{"transaction_id":"a"}'])
    lost = {"finish": lambda *a: 1 / 0} if arrived else {}
    with monkeypatch.context() as m:
        if arrived:  # rows arrive, but the run does not get to say so
            m.setattr(FileLedger, "finish", lost["finish"])
        else:
            m.setattr(feeds, "write_bronze", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feeds.ingest(spark, str(tmp_path), {PAY: PAY}, database, "t")
    land(tmp_path, PAY, "2024-01-02", ['{"transaction_id":"b"}'])
    for _ in range(2):
        got = feeds.ingest(spark, str(tmp_path), {PAY: PAY}, database, "t")[PAY]
        assert sorted(r.transaction_id for r in got.collect()) == ["a", "b"]


def test_a_feed_without_files_yet(spark, tmp_path, database):
    (tmp_path / PAY).mkdir()
    assert feeds.ingest(spark, str(tmp_path), {PAY: PAY}, database, "t")[PAY].count() == 0
    land(tmp_path, PAY, "2024-01-01", ['{"transaction_id":"a"}'])
    assert feeds.ingest(spark, str(tmp_path), {PAY: PAY}, database, "t")[PAY].count() == 1


def parquet_files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("partitioned", [False, True])
def test_erasure_rewrites_files_with_the_key_only(spark, tmp_path, partitioned):
    name, path = f"erased_{partitioned}".lower(), str(tmp_path / "t +1")
    df = spark.range(4_000).selectExpr("concat('C', lpad(id, 5, '0')) as customer_id", "id", "cast(id % 2 as int) as half").repartitionByRange(8, "id")
    writer = df.write.format("parquet").option("path", path)
    try:
        (writer.partitionBy("half") if partitioned else writer).saveAsTable(name)
        before = parquet_files(path)
        gone = spark.createDataFrame([("C00007",), ("C03999",), (None,), ("nobody",)], "customer_id string")
        hit = erasure.erase_rows(spark, name, gone)
        after = parquet_files(path)
        assert len(hit) == 2 and len(before - after) == 2 and before - after == {files_path(h) for h in hit}
        left = spark.read.parquet(*after) if not partitioned else spark.read.parquet(path)
        for rows in (spark.table(name), left):
            assert rows.count() == 3_998 and rows.join(gone, "customer_id", "left_semi").isEmpty()
        assert {r["count"] for r in spark.table(name).groupBy("half").count().collect()} == {2_000, 1_998}
        assert not [f for f in os.listdir(path) if f.startswith("_erase")]
        assert erasure.erase_rows(spark, name, gone) == [] and parquet_files(path) == after
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def files_path(uri):
    return uri.removeprefix("file:").replace("//", "/")


@pytest.mark.parametrize("broken", ["rows", "list", "deleted", "moved"])
def test_a_broken_erasure_is_completed_or_taken_back(spark, tmp_path, monkeypatch, broken):
    name, path = f"broken_{broken}", str(tmp_path / "t")
    spark.range(100).repartitionByRange(4, "id").write.option("path", path).saveAsTable(name)
    gone = spark.createDataFrame([(3,), (90,)], "id long")
    real = {f: getattr(erasure, f) for f in ("_swap", "delete", "move")}

    def fail_at(function, after=False):
        def f(*args):
            if after:
                real[function](*args)
            raise RuntimeError("driver lost")

        return f

    try:
        with monkeypatch.context() as m:
            if broken == "rows":
                m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
            elif broken == "list":
                m.setattr(erasure, "_swap", fail_at("_swap"))
            elif broken == "deleted":
                m.setattr(erasure, "move", fail_at("move"))
            else:
                m.setattr(erasure, "move", fail_at("move", after=True))
            with pytest.raises(RuntimeError):
                erasure.erase_rows(spark, name, gone)
        erasure.erase_rows(spark, name, gone)
        assert sorted(r.id for r in spark.table(name).collect()) == [k for k in range(100) if k not in (3, 90)]
        assert not [f for f in os.listdir(path) if f.startswith("_erase")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_nothing_of_an_erased_customer_stays(spark):
    """Neither the table's folder nor the work folder holds the key after the stages are gone and the table was replaced before."""
    raw = raw_feed(spark, SF, "customers_crm")
    name = "customers_to_erase"
    try:
        with files.scratch(spark):
            feeds.replace_table(stage(raw, "copy"), name)
            staged = STAGES[-1]
            assert files.exists(spark, staged)
            feeds.replace_table(spark.table(name).withColumn("again", F.lit(1)), name, keep_old=False)
        assert not files.exists(spark, staged) and staged not in STAGES
        place = erasure.table_location(spark, name)
        gone = spark.table(name).where("customer_id is not null").select("customer_id").limit(1)
        key = gone.first().customer_id
        erasure.erase_rows(spark, name, spark.createDataFrame([(key,)], "customer_id string"))
        everything = [f for f in parquet_files(work_root(spark).removeprefix("file:")) if f.startswith(files_path(place)) or "copy-" in f]
        assert everything and spark.read.parquet(*everything).where(F.col("customer_id") == key).isEmpty()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_an_unlisted_table_is_audited(spark, database):
    from ledgerlake.operators.profile import tier_audit
    from ledgerlake.plans.specs import SPECS

    db = f"{database}_silver_t"
    spark.sql(f"CREATE DATABASE {db}")
    try:
        spark.range(3).selectExpr("id", "'123-45-6789' as note").write.saveAsTable(f"{db}.somebodys_copy")
        spark.createDataFrame([("C1", "a@b.org")], "customer_id string, email string").write.saveAsTable(f"{db}.customers_crm_silver")
        found = {r.table_name: r for r in tier_audit(feeds.layer_tables(spark, database, "t"), SPECS).collect()}
        assert (found["somebodys_copy"].ssn_rows, found["somebodys_copy"].row_count) == (3, 3)
        bad = found["customers_crm_silver"]
        assert (bad.clear_columns, bad.missing_columns, bad.email_rows) == ("email", "masked_email,masked_ssn", 1)
    finally:
        feeds.drop_layers(spark, database, "t")
    assert not spark.catalog.databaseExists(db) and feeds.layer_tables(spark, database, "t") == {}
