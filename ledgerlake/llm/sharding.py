"""Minimax contiguous shards: the smallest capacity for which equal texts stay together.

Texts are ordered by their digest; all rows of one text are an atomic group. The smallest feasible
capacity is found by binary search with a greedy check, and the order is cut there. The driver never
sees the groups: it gets totals of 4,096 ranges of digests, and asks for the finer ranges of only those
in which a cut can fall, until the answer is exact. What it holds is bounded by
``shards * 4096 * levels`` numbers, whatever the size of the data.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROWS_PER_PART, hex_bucket, staged

STEP = 3  # hexadecimal digits by which a range is refined


def _greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cut positions if ``capacity`` is enough, each as far on as possible. ``ends``: sums after each cell."""
    cuts, at = [], 0
    total = ends[-1] if ends else 0
    while at < total and len(cuts) < shards:
        to = bisect_right(ends, at + capacity)
        if not to or ends[to - 1] <= at:
            return None
        at = ends[to - 1]
        cuts.append(at)
    return cuts if at >= total else None


def _relaxed(cells: list[tuple[str, int, int]], ends: list[int], capacity: int, shards: int) -> tuple[bool, set[int]]:
    """Greedy check where cells of several groups may be cut anywhere; the cells it cuts."""
    at, inside, total = 0, set(), ends[-1] if ends else 0
    for _ in range(shards):
        if at >= total:
            break
        reach = min(at + capacity, total)
        k = bisect_right(ends, reach)
        if k < len(cells) and ends[k] - cells[k][1] < reach and cells[k][2] > 1:
            inside.add(k)
            at = reach
        else:
            to = ends[k - 1] if k else 0
            if to <= at:
                return False, inside
            at = to
    return at >= total, inside


def smallest_capacity(cells_of, shards: int) -> tuple[int, list[str]]:
    """Smallest capacity, and the first digest prefix of each further shard.

    ``cells_of(prefixes, digits)`` returns ``(prefix, size, groups)`` of the ranges below ``prefixes``.
    """
    digits = STEP
    cells = sorted(cells_of(None, digits))
    while True:
        ends = list(accumulate(c[1] for c in cells))
        total = ends[-1] if ends else 0
        if not total:
            return 0, []
        low, high = 1, total
        while low < high:  # least capacity that the relaxed check accepts: no real one is below
            mid = (low + high) // 2
            low, high = (low, mid) if _relaxed(cells, ends, mid, shards)[0] else (mid + 1, high)
        bound = low
        cuts = _greedy(ends, bound, shards)
        if cuts is not None:  # the bound is reached by cutting between cells, but cuts must be the greedy ones
            _, inside = _relaxed(cells, ends, bound, shards)
        else:
            inside = _relaxed(cells, ends, bound, shards)[1]
        if not inside:
            return bound, [cells[ends.index(c) + 1][0] for c in cuts if c < total]
        digits_now = {k: len(cells[k][0]) for k in inside}
        fine = []
        for width in set(digits_now.values()):
            fine += cells_of([cells[k][0] for k in inside if digits_now[k] == width], width + STEP)
        cells = sorted([c for k, c in enumerate(cells) if k not in inside] + fine)


def shard_documents(docs: DataFrame, shards: int = 16, part_rows: int = ROWS_PER_PART) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, capacity`` for every row of ``docs`` (``doc_id``, ``text``).

    A row's size is its UTF-8 bytes plus 1. Null texts count as empty (size 1, checksum 0). Repeated rows each get a slot. Slots run from 0 in each shard, by range of digest and
    digest of the id. An empty table gives no rows. A group larger than the ideal shard makes its
    shard, and with it the capacity, as large as itself.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    rows = staged(
        docs.select(
            "doc_id", F.coalesce(F.octet_length("text") + 1, F.lit(1)).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.sha2(F.coalesce(text, F.lit("").cast("binary")), 256).alias("digest"),
        ), "shard-rows",
    )
    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("size")), "shard-groups")

    def cells_of(prefixes: list[str] | None, digits: int) -> list[tuple[str, int, int]]:
        chosen = groups if prefixes is None else groups.filter(F.substring("digest", 1, digits - STEP).isin(prefixes))
        counted = chosen.groupBy(F.substring("digest", 1, digits).alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("groups"))
        return [(r.cell, r["size"], r.groups) for r in counted.collect()]

    capacity, starts = smallest_capacity(cells_of, shards)
    shard = F.lit(0)
    for k, prefix in enumerate(starts, 1):
        shard = F.when(F.col("digest") >= prefix, k).otherwise(shard)
    # slots: cells of the digest, and ranges of the ids' digests inside a cell with many rows
    keyed = rows.select(
        "doc_id", "size", "text_crc32", "digest", shard.cast("int").alias("shard"), F.substring("digest", 1, STEP).alias("cell"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
    )
    counts = keyed.groupBy("shard", "cell").agg(F.count("*").alias("rows")).select(
        F.col("shard").alias("c_shard"), F.col("cell").alias("c_cell"), F.ceil(F.col("rows") / part_rows).cast("long").alias("parts")
    )  # at most 4096 + shards rows
    parted = keyed.join(F.broadcast(counts), (keyed.shard == counts.c_shard) & (keyed.cell == counts.c_cell)).withColumn(
        "part", hex_bucket(F.col("key"), F.col("parts"))
    ).drop("c_shard", "c_cell")
    sums = parted.groupBy("shard", "cell", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("shard", "cell", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "cell", "part").orderBy("key", "doc_id", "digest")
    return parted.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["shard", "cell", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("inside")).cast("long").alias("slot"),
        F.lit(capacity).cast("long").alias("capacity"),
    )
