"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import staged

LINKS_PER_FILE = 100_000


def _filled(links: DataFrame, most: int) -> DataFrame:
    """``links``, of which there are at most ``most``, in as many partitions as they fill. Adaptive execution may be told to leave small
    ones alone; each is a file then, and on a local file system a task starts two processes for every file."""
    return links.coalesce(max(1, -(-most // LINKS_PER_FILE)))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:  # neighbours above u are linked to u's least neighbour
        return moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # neighbours below u, and u itself, are linked to the least of them
    ends = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return ends.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, component``: the least node that each linked node reaches.

    Rounds repeat until the table of links stands still, after about log(diameter) of them. Each is
    written to the shared folder, so a lost executor costs a reread. Grouping keeps one minimum per node and
    task; the join's hot nodes are split by adaptive execution. Self-links and repeats are harmless.
    """
    edges = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if now == mark:
            return _filled(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            ), 2 * now.n)
        mark = now
        # a large star makes no more links than it gets, a small star twice as many at most
        edges = staged(_filled(_star(_star(edges, True), False), 2 * now.n), "links")
