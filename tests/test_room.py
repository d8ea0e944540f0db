"""What large tables leave on disk while a query runs: no shuffle of an ended write, no landing zone that Bronze holds, small files."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerlake import session
from ledgerlake.plans import pipeline, registry
from ledgerlake.plans.registry import QUERIES
from ledgerlake.plans.specs import SPECS
from ledgerlake.sources import feeds
from ledgerlake.sources.derived import raw_feed
from ledgerlake.sources.files import listing

DIS = "chargeback_disputes"


def shuffles(spark):
    """Shuffle files of the session and their bytes."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [found.apply(i).getPath() for i in range(found.size())]
    return {p: os.path.getsize(p) for p in paths if os.path.basename(p).startswith("shuffle_") and os.path.exists(p)}


def left(spark, before):
    """Bytes of shuffle files that are new; they are deleted a moment after the write."""
    for _ in range(50):
        new = sum(n for p, n in shuffles(spark).items() if p not in before)
        if not new:
            break
        time.sleep(0.1)
    return new


def written(spark, what):
    """Folders of the work folder by a name's beginning."""
    root = session.work_root(spark).removeprefix("file:")
    return {f"{root}/{f}" for f in os.listdir(root) if f.startswith(f"{what}-")} if os.path.isdir(root) else set()


def parts(folder):
    return [os.path.join(d, f) for d, _, found in os.walk(folder) for f in found if f.startswith("part-")]


def codecs(folder):
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in parts(folder) if pq.ParquetFile(f).metadata.num_row_groups}


@pytest.mark.parametrize("write", ["stage_compact", "replace_table", "write_clustered", "write_bronze", "land_feed", "land_feed by day"])
def test_a_write_frees_its_shuffles(spark, tmp_path, write):
    rows = spark.range(200_000).select(*[F.sha2(F.concat(F.lit(c), F.col("id")), 256).alias(c) for c in SPECS[DIS].columns]).repartition(4, "dispute_id")
    name, path, before = f"room_{write.replace(' ', '_')}", str(tmp_path / "out"), shuffles(spark)
    try:
        match write:
            case "stage_compact":
                session.stage_compact(rows, "room")
            case "replace_table":
                feeds.replace_table(rows, name)
            case "write_clustered":
                feeds.write_clustered(rows, path, ["dispute_id"], 3)
            case "write_bronze":
                feeds.write_bronze(rows, name, path)
            case "land_feed":
                feeds.land_feed(rows, path, DIS)
            case _:
                feeds.land_feed(rows, path, DIS, F.lit("2024-01-01").cast("date"))
        assert left(spark, before) == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_the_setting_goes_back(spark):
    was = spark.conf.get(session._FREE, None)
    with session.freed_shuffles(spark):
        with session.freed_shuffles(spark):
            assert spark.conf.get(session._FREE) == "true"
        assert spark.conf.get(session._FREE) == "true"
    assert spark.conf.get(session._FREE, None) == was

    def fails(i):
        with pytest.raises(KeyError), session.freed_shuffles(spark):
            time.sleep(0.01 * (i % 3))
            raise KeyError(i)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(fails, range(40)))
    assert spark.conf.get(session._FREE, None) == was and not session._WRITERS[spark._jsparkSession.sessionUUID()]


def test_a_frame_can_be_read_again_after_its_write(spark, tmp_path):
    rows = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    first = sorted(map(tuple, rows.collect()))
    session.write_compact(rows, str(tmp_path / "a"))
    session.write_compact(rows, str(tmp_path / "b"))
    assert sorted(map(tuple, rows.collect())) == first == [(k, 100) for k in range(10)]


@pytest.mark.parametrize("query", ["q3_layer_progression", "a24_pii_audit"])
def test_landing_goes_when_bronze_holds_it(spark, monkeypatch, query):
    before, at, build = written(spark, "landing"), {}, pipeline.build_silver
    kept = shuffles(spark)

    def silver(bronze, store):
        at["landing"] = [p for folder in written(spark, "landing") - before for p in parts(folder)]
        at["rows"] = {n: df.count() for n, df in bronze.items()}
        at["shuffles"] = left(spark, kept)
        return build(bronze, store)

    monkeypatch.setattr(pipeline, "build_silver", silver)
    QUERIES[query](spark, SF)
    assert at["landing"] == []
    assert at["rows"] == {n: raw_feed(spark, SF, n).count() for n in SPECS}
    assert at["shuffles"] < 20_000  # counts of the file ledger and of the rows above


def test_a_landing_zone_stays_unless_told(spark, tmp_path):
    root = str(tmp_path / "landing")
    registry._land(spark, SF, root)
    try:
        pipeline.run_medallion(spark, root, registry.GOLD_RULES, "room", "t")
        assert parts(root)
    finally:
        feeds.drop_layers(spark, "room", "t")


def test_promotion_gate_keeps_no_shuffle_and_small_tables(spark):
    before, tables = shuffles(spark), {f: written(spark, f"{f}_silver") for f in SPECS}
    out = QUERIES["q2_promotion_gate"](spark, SF)
    assert left(spark, before) < 20_000  # sizes of splits, totals
    new = {f: written(spark, f"{f}_silver") - tables[f] for f in SPECS}
    assert all(len(v) == 1 and codecs(*v) == {"ZSTD"} for v in new.values())
    assert {(r.build, r.promote) for r in out.collect()} == {("complete", True), ("row lost", False)}


def test_bronze_of_a_landing_in_small_files(spark, monkeypatch):
    before, at, write = written(spark, "landing"), {}, feeds.write_bronze

    def bronze(df, *args):
        (folder,) = written(spark, "landing") - before
        at.update(folder=folder, names=[os.path.basename(p) for p in parts(folder)], bytes=sum(map(os.path.getsize, parts(folder))), text=sum(len(r.t) + 1 for r in df.select(F.to_json(F.struct(*SPECS[DIS].columns)).alias("t")).collect()))
        return write(df, *args)

    monkeypatch.setattr(feeds, "write_bronze", bronze)
    got = QUERIES["s4_write_bronze"](spark, SF)
    raw = raw_feed(spark, SF, DIS)
    assert at["names"] and all(n.endswith(".json.lz4") for n in at["names"])
    assert at["bytes"] < at["text"] / 3
    assert not os.path.exists(at["folder"])
    assert got.exceptAll(raw).isEmpty() and raw.exceptAll(got).isEmpty()


def test_rows_of_a_compressed_landing_file_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "FILE_ROWS", 100)
    rows = spark.range(1000).select(F.concat(F.lit("é \n"), F.col("id")).alias("dispute_id"), *[F.lit(None).cast("string").alias(c) for c in SPECS[DIS].columns[1:]])
    path = str(tmp_path / "landing")
    feeds.land_feed(rows.coalesce(1), path, DIS)
    assert listing(spark, path).count() == 10
    back = feeds.scan_feed(spark, path, DIS).select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and back.count() == 1000
