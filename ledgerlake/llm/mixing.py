"""Mixing sources to target weights, exactly and without sorting a source in one task.

Every row gets a random key, the digest of its id. A source's keys are cut into ranges of about
``ROWS_PER_PART`` rows, which digests fill evenly however large the source is. Range totals give each
range's offset, a window inside the range gives each row's prefix sum of words, and the row takes what
of it lies before the source's budget. Budgets over the source's size repeat whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROWS_PER_PART, hex_bucket, keyed_rows, staged, unkeyed, word_count

MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, rows`` -> plus ``target``.

    Sources weigh ``weights`` in turn, by code point, null last, and share the sum of all sizes. A target
    stops at ``most`` times its source's size; the excess goes to the others by weight. That fixes one
    level L with target = min(most * size, L * weight): with sources in order of most * size / weight,
    the first k are stopped, k being the least number for which the others' L stops none of them.
    The table has one row per source and stays a DataFrame.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * most)
    fill = F.col("most") / F.col("weight")
    before = Window.orderBy(fill, "place").rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("shared"),
    ).withColumn("level", F.col("left") / F.col("shared"))
    # the level of the first source in that order which it does not stop
    found = levels.withColumn("free", F.when(fill >= F.col("level"), F.struct(fill.alias("fill"), "place", "level")))
    level = F.min("free").over(Window.partitionBy())["level"]
    return found.withColumn("found", level).select(
        "source", "source_size", "rows",
        F.when(F.col("found").isNull() | (fill < F.col("found")), F.col("most").cast("double"))
        .otherwise(F.col("found") * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS,
    part_rows: int = ROWS_PER_PART, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``source``, ``text``): what the mix takes of it.

    Returns ``doc_id, source, size, source_size, target, taken``. ``taken`` of a source sums up to its
    target, rounded; a document is taken ``floor(taken / size)`` times whole and, where the budget ends
    inside it, once in part. Null or empty texts have size 0 and are not taken. Repeated rows count each.
    Equal ids are ordered by their size, so ties do not matter. Other columns of ``docs`` are not looked at,
    but those of ``carry`` come along, and rows of equal id and size are in their order.
    """
    sized = staged(
        docs.select("doc_id", "source", (word_count(F.col("text")) if size is None else size).cast("long").alias("size"), *carry), "mix-sizes"
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(totals, weights, most).select(
        F.col("source").alias("of"), "source_size", "target", F.ceil(F.col("rows") / part_rows).cast("long").alias("parts")
    )
    # one row per source: small by its nature, and joined by the planner as it sees fit
    keyed = sized.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).join(
        targets, F.col("source").eqNullSafe(F.col("of"))
    ).select("doc_id", "source", "size", "source_size", "target", "key", *carry, hex_bucket(F.col("key"), F.col("parts")).alias("part"))
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    prefix = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = prefix.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("inside")))
    return placed.select("doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken"), *carry)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken. The one document of a source in which its budget
    ends comes whole if at least half of it is inside, else not at all. Rows with a null or repeated id are rows
    of their own; of those with the same id and size, the order is that of their content's hash."""
    rows = keyed_rows(docs)
    given = rows.select("row.doc_id", "row.source", "row.text", "row_key", F.xxhash64("row").alias("row_hash"))
    taken = mix_sources(given, weights=weights, most=most, carry=("row_hash", "row_key")).select(
        "row_key", F.floor(F.try_divide("taken", "size") + 0.5).cast("int").alias("times")
    ).filter("times > 0")
    return unkeyed(rows.join(taken, "row_key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))), docs.columns)
