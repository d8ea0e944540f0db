"""Landing feeds, Bronze tables and other file-based sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.privacy import tag_columns
from ledgerlake.operators.hygiene import CORRUPT
from ledgerlake.plans.specs import SPECS, FeedSpec
from ledgerlake.session import COMPACT, freed_shuffles, new_path, stage, work_root, write_compact
from ledgerlake.sources.erasure import table_location
from ledgerlake.sources.files import delete, listing, literal, scratch
from ledgerlake.sources.ledger import LEDGER, SOURCE_FILE, FileLedger

INGESTED_AT = "_ingestion_timestamp"
FOLDER_DATE = "folder_date"
# The five feeds and the number of objects a complete landing zone has at least.
LANDING_FEEDS = tuple(SPECS)
LANDING_MIN_OBJECTS = 47
LAYERS = ("bronze", "silver", "gold")
FILE_ROWS = 1_000_000  # of a compressed landing file that no rebalance bounds


def feed_schema(spec: FeedSpec) -> T.StructType:
    """All columns as text plus the corrupt-record column; nothing is inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (*spec.columns, CORRUPT)])


def reader_options(spec: FeedSpec) -> dict[str, str]:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "recursiveFileLookup": "true"}
    if spec.file_format == "csv":
        # quoted fields hold line breaks; blanks around values are data
        options |= {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}
    return options


def scan_feed(spark: SparkSession, path: str | list[str], feed: str) -> DataFrame:
    """All-string, permissive scan of a landing feed or of some of its files; broken records are kept in ``_corrupt_record``."""
    spec = SPECS[feed]
    return (
        spark.read.format(spec.file_format).schema(feed_schema(spec)).options(**reader_options(spec)).load(path)
    )


def folder_date(path: Column) -> Column:
    """Date of the innermost dated folder (``2024-01-31/`` or ``day=2024-01-31/``) of a file path."""
    text = F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    return text.try_cast("date")


def scan_dated(spark: SparkSession, root: str | list[str], feed: str) -> DataFrame:
    """All days of an event feed, or some of its files, with the folder's date, which is not the ingestion date."""
    df = scan_feed(spark, root, feed)
    return df.withColumn(FOLDER_DATE, folder_date(F.col("_metadata.file_path")))


def add_audit(df: DataFrame) -> DataFrame:
    """Ingestion time and source file of every row of a file-based frame."""
    return df.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")})


def write_bronze(df: DataFrame, table: str, path: str | None = None, mode: str = "append") -> DataFrame:
    """Append every row to a Bronze table, or replace its rows with ``mode="overwrite"``, and return the table."""
    writer = df.write.format("parquet").mode(mode).option("compression", COMPACT)
    with freed_shuffles(df.sparkSession):
        (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def land_feed(df: DataFrame, path: str, feed: str, day: Column | None = None) -> None:
    """Write a raw feed in its landing format, in dated folders when ``day`` is given.

    Rows of a day are brought together first, so a task does not write a file for every day; the
    rebalance lets a very large day use several tasks, which bounds their files. Files of event feeds are compressed, as JSON repeats every column's name in
    every row; without days their rows are bounded too, as such a file is read by one task.
    """
    spec = SPECS[feed]
    out = df.select(*spec.columns)
    if day is not None:
        out = df.select(*spec.columns, day.alias("day")).hint("rebalance", "day")
    writer = out.write.format(spec.file_format)
    if spec.file_format == "csv":
        writer = writer.options(header="true", quote='"', escape='"', quoteAll="true", nullValue="", emptyValue='""')
        writer = writer.options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    if day is not None:
        writer = writer.partitionBy("day").option("compression", "gzip")
    elif spec.dated:
        writer = writer.options(compression="lz4", maxRecordsPerFile=FILE_ROWS)
    with freed_shuffles(df.sparkSession):
        writer.save(path)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path``, ``name`` (the path below ``root``) and ``length`` of all files below a folder; contents are not read."""
    base = root.rstrip("/") + "/"
    name = F.expr("substring(path, instr(path, _base) + length(_base))")
    return listing(spark, root, glob).select("path", "length", F.lit(base).alias("_base")).select("path", name.alias("name"), "length")


def output_inventory(spark: SparkSession, root: str, prefixes: Sequence[str]) -> DataFrame:
    """Parquet part files per candidate folder below ``root``, in precedence order.

    ``chosen`` marks the first folder that holds any. Folders that do not exist count 0.
    """
    found = list_files(spark, root, "part-*.parquet").select(
        F.regexp_extract("name", r"^([^/]+)/[^/]+$", 1).alias("prefix"), "length"
    )
    per_prefix = found.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    wanted = spark.createDataFrame([(i, p) for i, p in enumerate(prefixes)], "position int, prefix string")
    counted = wanted.join(per_prefix, "prefix", "left").fillna(0, ["files", "bytes"])
    first = counted.where("files > 0").agg(F.min("position").alias("first"))
    return counted.join(first, F.col("position") == F.col("first"), "left").select(
        "position", "prefix", "files", "bytes", F.col("first").isNotNull().alias("chosen")
    )


def manifest_check(
    spark: SparkSession,
    root: str,
    feeds: Sequence[str] = LANDING_FEEDS,
    min_count: int = LANDING_MIN_OBJECTS,
) -> DataFrame:
    """One row per expected feed: its objects, whether it is present, and the verdict on the whole zone.

    An object belongs to a feed when the feed's folder is on its path below ``root``; objects outside
    the expected feeds count towards the total.
    """
    below = F.concat(F.lit("/"), F.col("name"))
    counts = list_files(spark, root).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(below.contains(f"/{f}/")).alias(f"n_{i}") for i, f in enumerate(feeds)]
    )
    ok = F.col("total") >= min_count
    for i in range(len(feeds)):
        ok = ok & (F.col(f"n_{i}") > 0)
    rows = [
        F.struct(
            F.lit(f).alias("feed"), F.col(f"n_{i}").alias("objects"), (F.col(f"n_{i}") > 0).alias("present"),
            F.col("total").alias("total_objects"), ok.alias("ok"),
        )
        for i, f in enumerate(feeds)
    ]
    return counts.select(F.inline(F.array(*rows)))


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Create or replace a table over existing Parquet files; the files stay where they are.

    An external table with the same columns gets the new location in one step, so that readers always find a table.
    """
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    if (
        spark.catalog.tableExists(name)
        and spark.catalog.getTable(name).tableType == "EXTERNAL"
        and spark.table(name).schema == spark.read.parquet(path).schema
    ):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return spark.table(name)


def replace_table(df: DataFrame, name: str, keep_old: bool = True) -> DataFrame:
    """Write ``df`` to new files and point the table at them.

    ``df`` may read the table itself, as an upsert does; readers see the old files or the
    new ones, never a mixture. Without ``keep_old`` the old files go, if they lie in the work folder; frames that still read them end then.
    """
    spark = df.sparkSession
    old = table_location(spark, name) if not keep_old and spark.catalog.tableExists(name) else None
    path = new_path(spark, name.rsplit(".", 1)[-1])
    write_compact(df, path)
    table = register_external(spark, name, path)
    if old and work_root(spark).split(":", 1)[-1].lstrip("/") in old:
        delete(spark, [old])
    return table


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Write range-clustered Parquet, so that min/max statistics skip files on ``keys``.

    A row hash closes the range key: the rows of one very frequent key can be cut into several ranges.
    """
    rest = [c for c in df.columns if c not in keys]
    spread = F.xxhash64(*rest) if rest else F.lit(0)
    ranges = [*[F.col(k) for k in keys], spread]
    by_range = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    write_compact(by_range.sortWithinPartitions(*keys), path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def layer_tables(
    spark: SparkSession, unit: str = "fraud", env: str = "dev", layers: Sequence[str] = LAYERS
) -> dict[tuple[str, str], DataFrame]:
    """Every table of the layers' databases, by (layer, table), as the catalog lists them; the file ledger is none of the data."""
    out = {}
    for layer in layers:
        db = database_name(unit, layer, env)
        if spark.catalog.databaseExists(db):
            names = sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary and t.name != LEDGER)
            out |= {(layer, n): spark.table(f"{db}.{n}") for n in names}
    return out


def drop_layers(spark: SparkSession, unit: str, env: str = "dev", layers: Sequence[str] = LAYERS) -> None:
    """Drop the layers' databases with their files, those in the work folder included."""
    for layer in layers:
        db = database_name(unit, layer, env)
        if spark.catalog.databaseExists(db):
            places = [table_location(spark, f"{db}.{t.name}") for t in spark.catalog.listTables(db) if t.tableType == "EXTERNAL"]
            spark.sql(f"DROP DATABASE {db} CASCADE")
            delete(spark, [p for p in places if work_root(spark).split(":", 1)[-1].lstrip("/") in p])


def database_name(unit: str, layer: str, env: str) -> str:
    """``<bu>_<layer>_<env>``."""
    return f"{unit}_{layer}_{env}"


def ingest(
    spark: SparkSession, root: str, feeds: Mapping[str, str], unit: str = "fraud", env: str = "dev"
) -> dict[str, DataFrame]:
    """Landing zone to Bronze: scan each feed folder, add audit columns and policy tags, write all rows.

    ``feeds`` maps feed names to folders below ``root``. Event feeds keep the date of their folder; a rerun lists the folder and reads only
    files that the ledger of the database does not hold, so its cost is that of the new files, and a run without any reads nothing. The other feeds are
    snapshots and replace the table's rows. Tags are stored with the table.
    """
    db = database_name(unit, "bronze", env)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    ledger = FileLedger(spark, db)
    out = {}
    for feed, folder in feeds.items():
        path, table = f"{root}/{folder}", f"{db}.{feed}_bronze"
        out[feed] = append_new_files(spark, path, feed, table, ledger) if SPECS[feed].dated else replace_snapshot(spark, path, feed, table)
    return out


def _bronze_rows(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return tag_columns(add_audit(df), {c: f"pii.{c}" for c in spec.pii})


def replace_snapshot(spark: SparkSession, root: str, feed: str, table: str) -> DataFrame:
    """Replace a Bronze table's rows by those of all files of a feed that lands as a whole."""
    return write_bronze(_bronze_rows(scan_feed(spark, root, feed), SPECS[feed]), table, mode="overwrite")


def append_new_files(spark: SparkSession, root: str, feed: str, table: str, ledger: FileLedger) -> DataFrame:
    """Append the rows of files that were never read to the Bronze table of an event feed."""
    with scratch(spark):
        ledger.settle(feed, table)
        files = stage(ledger.new_files(feed, root), "new-files")
        paths = [literal(r.path) for r in files.select("path").collect()]
        if paths or not spark.catalog.tableExists(table):
            run = ledger.begin(feed, files)
            write_bronze(_bronze_rows(scan_dated(spark, paths or root, feed), SPECS[feed]), table)
            ledger.finish(feed, run)
    return spark.table(table)
