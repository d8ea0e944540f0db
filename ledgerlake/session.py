"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_WORK: dict[str, str] = {}
STAGES: list[str] = []  # paths of staged tables, in the order in which they were written
COMPACT = "zstd"  # Parquet codec of large tables: text, digests above all, takes much less room than with snappy
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS: Counter[str] = Counter()  # sessions in which writes with freed shuffles are under way
_BEFORE: dict[str, str | None] = {}
_LOCK = threading.Lock()


def build_session(
    app: str, cores: int | str = "*", memory: str = "8g", extra: Mapping[str, str] | None = None
) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster the submitter owns these settings."""
    parallelism = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.catalogImplementation", "in-memory")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, which has no other
    machine to share with, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK:
        folder = tempfile.mkdtemp(prefix="ledgerlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_WORK[app] = folder
    return _LOCAL_WORK[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block delete their shuffle files when they end.

    Otherwise these stay until the driver's garbage collector meets their plans, and a query of several writes holds the shuffles of all of them. A
    write plans its frame anew, so no later action reads its shuffles. The setting goes back when the session's last such write ends.
    """
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        if not _WRITERS[session]:
            _BEFORE[session] = spark.conf.get(_FREE, None)
            spark.conf.set(_FREE, "true")
        _WRITERS[session] += 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITERS[session] -= 1
            if not _WRITERS[session]:
                before = _BEFORE.pop(session)
                spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


def write_compact(df: DataFrame, path: str) -> None:
    """Write a large table as Parquet that takes little room, and free its shuffles."""
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", COMPACT).parquet(path)


def stage(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a frame feeds two branches of a plan: the second branch then reads only its own
    columns instead of repeating the shuffle, and a lost executor re-reads files.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    STAGES.append(path)
    if compact:
        write_compact(df, path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_compact(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for large tables."""
    return stage(df, name, compact=True)
