"""Quality rules: a learned decision list over text statistics.

Sequential covering on labelled rows: a conjunction of thresholds grows, condition by condition, while that raises its
information gain; conditions are pruned on rows it has not seen; a rule that is precise on both parts joins the list, and what
it covers is set aside for the next. The list is a chain of ``when`` expressions, readable and free of Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, staged
from ledgerlake.llm.words import mix, slices, window_hash, words_of

SAMPLE_ROWS = 50_000
THRESHOLDS = 48  # candidate cuts of a feature
MOST_RULES = 16
MOST_CONDITIONS = 4
PRECISION = 0.95
LEAST_COVER = 5
SYMBOLS = b"#*$%&|<>"
WIDTH = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")


@dataclass(frozen=True)
class Rule:
    """Drops what meets all conditions ``(feature, above, threshold)``: above it, or at most it."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for feature, above, cut in self.conditions:
            out = out & (F.col(feature) > cut if above else F.col(feature) <= cut)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>' if above else '<='} {cut:g}" for f, above, cut in self.conditions)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol, upper, mark = (np.zeros(256, dtype=bool) for _ in range(3))
    symbol[list(SYMBOLS)] = True
    upper[65:91] = True
    mark[ord("!")] = True
    for batch in batches:
        for part in slices(batch):
            texts = part.column(part.schema.get_field_index("text"))
            w = words_of(texts, fold=False)
            n, doc = part.num_rows, w.text_of()

            def inside(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
                return total[high] - total[low]

            counts = np.diff(w.first)
            points = np.bincount(doc, weights=inside((w.data & 0xC0) != 0x80, w.start, w.end), minlength=n).astype(np.int64)
            repeats = np.zeros(n, dtype=np.int64)
            rolled = window_hash(w.hashes, WIDTH)
            if len(rolled):
                at = np.flatnonzero(doc[: len(rolled)] == doc[WIDTH - 1 :])
                _, group, size = np.unique(mix(rolled[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
                again = at[size[group] > 1]
                covered = np.zeros(len(doc), dtype=bool)
                for k in range(WIDTH):
                    covered[again + k] = True
                repeats = np.bincount(doc[covered], minlength=n)
            lines, doubles = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for k, text in enumerate(texts.to_pylist()):
                full = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
                lines[k], doubles[k] = len(full), len(full) - len(set(full))
            low, high = w.offsets[:-1], w.offsets[1:]
            columns = [counts, points, inside(symbol[w.data], low, high), doubles, repeats, inside(upper[w.data], low, high), inside(mark[w.data], low, high), lines]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), *(pa.array(np.asarray(c, dtype=np.int64)) for c in columns)], names=["doc_id", *STATISTICS]
            )


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and counts of each whole text: words, their code points, symbols, lines with a word that repeat an
    earlier one, words in five-word windows that occur twice or more, capitals, exclamation marks, lines with a word. Null is empty."""
    return on_workers(docs.select("doc_id", "text"), _measure, "doc_id long, " + ", ".join(f"{c} long" for c in STATISTICS))


def with_features(stats: DataFrame) -> DataFrame:
    """Adds what rules are made of: sizes, and shares per word or letter."""
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return stats.select(
        "*", (F.col("word_chars") / per_word).alias("word_length"), (F.col("n_symbols") / per_word).alias("symbols_per_word"),
        (F.col("n_repeat_words") / per_word).alias("repeated_share"), (F.col("n_marks") / per_word).alias("marks_per_word"),
        (F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("capital_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("double_line_share"),
    )


FEATURES = ("n_words", "word_length", "symbols_per_word", "repeated_share", "marks_per_word", "capital_share", "double_line_share")


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, bool, float]]:
    rows, conditions = np.ones(len(bad), dtype=bool), []
    while len(conditions) < MOST_CONDITIONS and rows.any() and not bad[rows].all():
        p0, n0 = int(bad[rows].sum()), int((~bad[rows]).sum())
        best: tuple[float, tuple[int, bool, float] | None] = (1e-9, None)
        for f in range(x.shape[1]):
            values = x[rows, f]
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS), method="lower")):
                over = values > cut
                p, n = int(bad[rows][over].sum()), int((~bad[rows][over]).sum())
                for above, gain in ((True, _gain(p, n, p0, n0)), (False, _gain(p0 - p, n0 - n, p0, n0))):
                    if gain > best[0]:
                        best = gain, (f, above, float(cut))
        if best[1] is None:
            break
        f, above, cut = best[1]
        over = x[rows, f] > cut
        # halfway to the nearest value on the other side, so that values in between need not be bad
        cut = float((x[rows, f][~over].max() + x[rows, f][over].min()) / 2) if over.any() and not over.all() else cut
        conditions.append((f, above, cut))
        rows &= (x[:, f] > cut) == above
    return conditions


def _covers(x: np.ndarray, conditions: list[tuple[int, bool, float]]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, above, cut in conditions:
        out &= (x[:, f] > cut) == above
    return out


def _worth(x: np.ndarray, bad: np.ndarray, conditions: list[tuple[int, bool, float]]) -> float:
    rows = _covers(x, conditions)
    p, n = int(bad[rows].sum()), int((~bad[rows]).sum())
    return (p - 10 * n) / max(1, p + n) if p + n else -10.0


def learn_rules(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = FEATURES) -> list[Rule]:
    """Ordered rules that drop rows like the ``bad`` ones. Every third row is for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < MOST_RULES:
        grow, prune = left & ~third, left & third
        if bad[grow].sum() < LEAST_COVER:
            break
        conditions = _grow(x[grow], bad[grow])
        while len(conditions) > 1:  # without its last condition, if unseen rows judge it no worse
            if _worth(x[prune], bad[prune], conditions[:-1]) < _worth(x[prune], bad[prune], conditions):
                break
            conditions = conditions[:-1]
        covered = _covers(x, conditions) & left
        precise = all(bad[covered & part].mean() >= PRECISION for part in (~third, third) if (covered & part).any())
        if not conditions or not precise or bad[covered].sum() < LEAST_COVER:
            break
        rules.append(Rule(tuple((names[f], above, cut) for f, above, cut in conditions)))
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False where a rule fits, the first one that does, else true."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(), F.lit(False))
    return out.otherwise(F.lit(True))


def fired(rules: list[Rule]) -> Column:
    """Text of the first rule that fits."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(rule.column(), F.lit(str(rule)))
    return out.otherwise(F.lit(None))


def fit(features: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from about ``most`` labelled rows at most, those with the least hashes of their ids.

    Of an id labelled twice the worse quality counts. Without labels there are no rules.
    """
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = marked.count()
    if not total:
        return []
    share = min(1.0, most / total)
    chosen = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = features.select("doc_id", *FEATURES).join(chosen, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(12)), "doc_id", *FEATURES).toPandas()
    return learn_rules(rows[list(FEATURES)].to_numpy(dtype=float), (rows["quality"] == 0).to_numpy())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every row of ``docs`` with ``base_failed``, ``kept`` and ``rule``.

    The base fails texts with under ten words or over a fifth of them in repeated windows; so null and empty
    texts fail. The list judges the others. Repeated rows are judged alike; an empty table gives no rows.
    """
    stats = staged(with_features(text_statistics(docs)), "text-statistics")
    rules = fit(stats, labels)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules)).withColumn("rule", fired(rules))
