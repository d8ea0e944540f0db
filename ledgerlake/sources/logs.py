"""Event logs, qualification tables and JSON documents as tables."""

from __future__ import annotations

import bz2
import gzip
import io
import re
from collections.abc import Collection, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.feeds import list_files
from ledgerlake.sources.files import file_name, listing, literal

# Seeded logs that do not count, and file patterns of the qualification output, the
# first with a non-empty file wins (patterns match the path below the root folder).
SEEDED_LOGS = ("current_event_log.json", "app-02-decelerated-udf.json", "app-02-remediated-nqe.json")
QUALIFICATION_PATTERNS = (
    r"^[^/]*AppsRecommendedForBoost[^/]*\.tsv$",
    r"^.*AppsRecommendedForBoost[^/]*\.tsv$",
    r"^[^/]*qualification[^/]*\.tsv$",
)


# Names of the parts of a rolled log, suffixes that the text reader decodes by itself, plain suffixes, and first bytes of compressed files.
ROLLED_PART = r"/events_([0-9]+)_[^/]*$"
DECODED_SUFFIXES = (".zstd", ".zst", ".gz", ".bz2", ".lz4", ".snappy", ".deflate")
PLAIN_SUFFIXES = (".json", ".txt", ".log", ".inprogress")
MAGIC = {"28b52ffd": "zstd", "1f8b": "gzip", "425a68": "bz2"}


def app_of(path: Column) -> Column:
    """Application of a log file: its ``app=<id>`` or ``eventlog_v2_<id>`` folder, else the file's bare name."""
    folder = F.regexp_extract(path, r"/(?:app=|eventlog_v2_)([^/]+)/", 1)
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(\.(json|zstd|zst|inprogress|txt))+$", "")
    return F.coalesce(F.nullif(folder, F.lit("")), name)


def log_of(path: Column) -> Column:
    """The log that a file belongs to: the folder of a rolled log (``eventlog_v2_<id>``), of one application's files (``app=<id>``) or of the
    part files of one ``.json`` log; else the file itself."""
    folder = F.regexp_extract(path, r"^(.*?/(?:app=[^/]+|eventlog_v2_[^/]+|[^/]+\.json))/", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), path)


def part_of(path: Column) -> Column:
    """Number of a file within a rolled log, 0 for others."""
    return F.coalesce(F.regexp_extract(path, ROLLED_PART, 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def _ends_with(name: Column, suffixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | name.endswith(s)
    return out


def hidden_codecs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, codec`` of compressed files whose names do not say so, by their first bytes.

    Only files with neither a codec's nor a plain suffix are opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path if isinstance(path, str) else list(path))
    unnamed = files.where(~_ends_with(F.col("path"), (*DECODED_SUFFIXES, *PLAIN_SUFFIXES))).where("length > 0")
    head = F.lower(F.hex(F.substring("content", 1, 4)))
    codec = F.lit(None).cast("string")
    for magic, name in MAGIC.items():
        codec = F.when(head.startswith(magic), F.lit(name)).otherwise(codec)
    return unnamed.select("path", codec.alias("codec")).where("codec is not null")


def _lines_of(codecs: dict[str, str]):
    """``path, content`` -> ``path, line, bytes`` of compressed files, decoded piece by piece."""

    def opened(content: bytes, codec: str):
        raw = io.BytesIO(content)
        if codec == "gzip":
            return gzip.open(raw)
        if codec == "bz2":
            return bz2.open(raw)
        import zstandard

        return io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = opened(content.as_py(), codecs[path])
                at = 0
                while block := lines.readlines(1 << 20):
                    values = [re.sub(rb"\r?\n$|\r$", b"", x) for x in block]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(values)), pa.array(range(at, at + len(values)), pa.int64()), pa.array(values, pa.binary())], names=["path", "line", "bytes"]
                    )
                    at += len(values)

    return run


def _text_lines(text: DataFrame) -> DataFrame:
    return text.select(
        file_name(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )


def scan_event_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of event logs, plain or compressed, with their place in the log.

    ``path, app, part, block_start, seq, value``: ``part`` orders the files of a rolled log, a large plain file is read in several splits, which
    ``block_start`` orders, and ``seq`` orders the lines within one. The text reader decodes compressed files by their suffix;
    files without any suffix are looked into, and those whose first bytes name a codec are decoded in tasks, a file at a time. Malformed UTF-8 becomes the replacement
    character.
    """
    hidden = {r.path: r.codec for r in hidden_codecs(spark, path).collect()}
    roots = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("recursiveFileLookup", "true")
    if not hidden:
        lines = _text_lines(reader.text(roots))
    else:
        named = [literal(p) for p in _others(spark, roots, hidden)]
        packed = spark.read.format("binaryFile").load([literal(p) for p in hidden]).select("path", "content")
        lines = packed.mapInArrow(_lines_of(hidden), "path string, line bigint, bytes binary").select(
            "path", F.lit(0).cast("bigint").alias("block_start"), F.col("line").alias("seq"), F.col("bytes").cast("string").alias("value")
        )
        if named:
            lines = lines.unionByName(_text_lines(reader.text(named)))
    return lines.select("path", app_of(F.col("path")).alias("app"), part_of(F.col("path")).alias("part"), "block_start", "seq", F.make_valid_utf8("value").alias("value"))


def _others(spark: SparkSession, roots: Sequence[str], hidden: Collection[str]) -> list[str]:
    """Files below ``roots`` that the text reader reads."""
    files = reduce(DataFrame.unionByName, [listing(spark, root) for root in roots])
    return [r.path for r in files.select("path").distinct().collect() if r.path not in hidden]


def event_logs(spark: SparkSession, root: str, seeded: Sequence[str] = SEEDED_LOGS) -> DataFrame:
    """``log, bytes`` of the logs below ``root`` that are neither archived nor seeded, from the listing alone."""
    files = listing(spark, root).select(log_of(F.col("path")).alias("log"), "path", "length")
    keep = ~F.col("path").contains("/archive/")
    for name in seeded:
        keep = keep & ~F.col("log").endswith(name)
    return files.where(keep).groupBy("log").agg(F.sum("length").alias("bytes"))


def latest_event_log_path(spark: SparkSession, root: str, seeded: Sequence[str] = SEEDED_LOGS) -> str | None:
    """The last log by name that has any content: names come from the listing, and logs are opened from the last one back until one has a line that is not blank."""
    before = None
    while True:
        logs = event_logs(spark, root, seeded).where("bytes > 0")
        last = (logs if before is None else logs.where(F.col("log") < before)).agg(F.max("log").alias("log")).first().log
        if last is None:
            return None
        if not scan_event_log(spark, literal(last)).where(F.btrim("value") != "").isEmpty():
            return last
        before = last


def scan_latest_event_log(spark: SparkSession, root: str, seeded: Sequence[str] = SEEDED_LOGS) -> DataFrame | None:
    """Lines of the last log by name that has any content, None where there is none. No other log is read, but for blank ones after it."""
    path = latest_event_log_path(spark, root, seeded)
    return None if path is None else scan_event_log(spark, literal(path))


def latest_event_log(df: DataFrame, seeded: Sequence[str] = SEEDED_LOGS) -> DataFrame:
    """Lines of the last log, by name, that has any content and is neither archived nor seeded, of lines at hand; ``scan_latest_event_log`` chooses among files."""
    skip = F.col("path").contains("/archive/") | F.col("path").endswith("/")
    for name in seeded:
        skip = skip | F.col("path").endswith(name)
    candidates = df.where(~skip)
    last = candidates.where(F.btrim("value") != "").agg(F.max("path").alias("path"))
    return candidates.join(F.broadcast(last), "path", "left_semi")


def qualification_path(spark: SparkSession, root: str, patterns: Sequence[str] = QUALIFICATION_PATTERNS) -> str | None:
    """The table to read: best pattern first, then by name, skipping empty files.

    A ``.tsv`` folder of part files counts as one table.
    """
    base = root.rstrip("/") + "/"
    unit = F.regexp_extract("name", r"^(.*?\.tsv)(?:/.*)?$", 1)
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns))):
        rank = F.when(F.col("unit").rlike(p), F.lit(i)).otherwise(rank)
    best = (
        list_files(spark, root).where("length > 0").select(unit.alias("unit"))
        .select("unit", rank.alias("rank")).where("rank is not null")
        .agg(F.min(F.struct("rank", "unit")).alias("best")).first()
    )
    return base + best["best"]["unit"] if best["best"] else None


def scan_qualification(
    spark: SparkSession, root: str, patterns: Sequence[str] = QUALIFICATION_PATTERNS
) -> DataFrame | None:
    """The qualification table as text columns, None when no pattern has a file."""
    path = qualification_path(spark, root, patterns)
    return None if path is None else spark.read.csv(path, sep="\t", header=True)


def scan_json_docs(spark: SparkSession, path: str, default: str = "{}") -> DataFrame:
    """One row per JSON file; bad or empty text yields ``default`` instead of an error.

    ``doc`` is a VARIANT, ``raw`` the text, ``ok`` tells whether it was valid.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return lenient_json(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw")), "raw", default)


def lenient_json(df: DataFrame, column: str, default: str = "{}") -> DataFrame:
    """Add ``doc`` (VARIANT) and ``ok`` for a text column."""
    parsed = F.try_parse_json(F.when(F.btrim(column) != "", F.col(column)))
    return df.withColumns({"doc": F.coalesce(parsed, F.parse_json(F.lit(default))), "ok": parsed.isNotNull()})
