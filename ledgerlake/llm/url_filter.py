"""URL filter: host words by unigram Viterbi, then multinomial naive Bayes on host and path tokens.

Word counts come from all pages' visible text and the parts of hyphenated host names. Every run of letters in a host is split
into its likeliest words; its substrings meet the counts in a join, so the dictionary is never sent anywhere whole.
Pages whose host holds a seed word teach the model what else blocked hosts and paths are made of. Tokens are
hashed to ``2 ** BITS`` places, which bounds the model whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, staged

BITS = 18
LONGEST = 20  # letters of a word
SALTS = 32
SMOOTHING = 0.5
#: Words that mark a host for blocking. A parameter.
SEEDS = (
    "adult", "porn", "xxx", "sex", "casino", "poker", "gambling", "bets", "betting", "pills", "viagra", "pharmacy", "spam", "malware",
    "phishing", "ads", "adserver", "tracker", "warez", "payday",
)
#: Rules ``(host, path, verdict)`` that come before the model. Fixed values.
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits a host or a subdomain and begins the path; else null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def word_counts(pages: DataFrame, hosts: DataFrame, seeds=SEEDS) -> DataFrame:
    """``word, n`` over visible text and hyphenated host names; seeds count at least as one in ten thousand."""
    visible = F.regexp_replace(F.translate(F.coalesce("html", F.lit("")), _UPPER, _LOWER), "(?s)<[^>]*>", " ")
    text = pages.select(F.explode(F.regexp_extract_all(visible, F.lit("[a-z]+"), F.lit(0))).alias("word"), F.lit(1).alias("n"))
    names = hosts.select(F.explode(F.split("host", r"[.]")).alias("label"), "n").filter(F.col("label").contains("-"))
    parts = names.select(F.explode(F.regexp_extract_all("label", F.lit("[a-z]+"), F.lit(0))).alias("word"), "n")
    counted = staged(text.unionByName(parts).filter(F.length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    floor = F.greatest(F.lit(1), (counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n or 0) / F.lit(10_000)).cast("long")
    known = pages.sparkSession.createDataFrame([(s,) for s in seeds], "word string").withColumn("n", floor)
    return counted.unionByName(known).groupBy("word").agg(F.max("n").alias("n"))


def segment(run: str, counts: dict[str, int], total: int) -> list[str]:
    """Likeliest split of a run of letters. An unknown word costs ten times more with every letter; ties go to the longer last word."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(run) + 1):
        tried = []
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(run[start:end])
            cost = log10(n / total) if n else 1 - log10(total) - (end - start)
            tried.append((best[start][0] + cost, -start))
        score, start = max(tried)
        best.append((score, -start))
    out, at = [], len(run)
    while at:
        out.append(run[best[at][1] : at])
        at = best[at][1]
    return out[::-1]


def _segmented(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, known = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [segment(r, {k["word"]: k["n"] for k in ks or []}, total) for r, ks in zip(runs, known)]
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    return run


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host`` -> ``host, words``: the words of all its runs of letters."""
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    runs_of = hosts.select("host", F.posexplode_outer(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))).alias("place", "run"))
    runs = staged(runs_of.select("run").filter("run is not null").distinct().withColumn("id", F.monotonically_increasing_id()), "runs")
    # all pieces of each length by one pass over the run; a run can be very long, so a number stands for it
    sized = runs.select("id", "run", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("run")))).alias("k"))
    pieces = sized.select("id", F.explode(F.expr("regexp_extract_all(run, concat('(?=([a-z]{', k, '}))'), 1)")).alias("word"))
    # bounded by the substrings of one run
    known = pieces.join(counts, "word").groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    split = on_workers(runs.join(known, "id", "left").select("run", "known"), _segmented(total), "run string, words array<string>")
    return runs_of.join(split, "run", "left").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: F.coalesce(x["words"], F.array().cast("array<string>")))).alias("words")
    )


def path_tokens(path: Column) -> Column:
    """Runs of letters and of digits; all numbers are one token."""
    lower = F.translate(path, _UPPER, _LOWER)
    return F.transform(F.regexp_extract_all(lower, F.lit("[a-z]+|[0-9]+"), F.lit(0)), lambda t: F.concat(F.lit("/"), F.regexp_replace(t, "^[0-9]+$", "0")))


def _scored(weights: np.ndarray, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(3)
            lengths = np.array([len(x) for x in places], dtype=np.int64)
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            odds = prior + np.bincount(owner, weights=weights[np.asarray(places.flatten())], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + [pa.array(odds)], names=["page_id", "host", "path", "odds"])

    return run


def filter_urls(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """``page_id, host, path, rule, verdict, odds`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    The verdict is the fitting rule's, else ``block`` where the model's log odds are above 0. Null urls and those without
    ``://`` have an empty host and path, no tokens, and the prior's verdict. Without any seeded page all else is allowed.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = staged(parsed.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    words = host_words(hosts, word_counts(pages, hosts, seeds)).select(
        "host", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(1 << BITS)).cast("int")).alias("host_places"),
        F.arrays_overlap("words", F.array(*map(F.lit, seeds))).alias("seeded"),
    )
    # a hot host's pages are spread over SALTS tasks; hosts are repeated for that
    salted = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = parsed.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    known = staged(spread.join(salted, ["host", "salt"]).select(
        "page_id", "host", "path", "seeded",
        F.concat("host_places", F.transform(path_tokens(F.col("path")), lambda t: F.pmod(F.xxhash64(t), F.lit(1 << BITS)).cast("int"))).alias("places"),
    ), "url-tokens")
    counted = known.select("seeded", F.explode("places").alias("place")).groupBy("seeded", "place").agg(F.count("*").alias("n")).collect()  # 2 * 2**BITS rows at most
    sides = {r.seeded: r.n for r in known.groupBy("seeded").agg(F.count("*").alias("n")).collect()}
    seen = np.zeros((2, 1 << BITS))
    for r in counted:
        seen[int(r.seeded), r.place] = r.n
    used = max(1, int(np.count_nonzero(seen.sum(axis=0))))
    chance = (seen + SMOOTHING) / (seen.sum(axis=1, keepdims=True) + SMOOTHING * used)
    weights = np.log(chance[1] / chance[0]) * (seen.sum(axis=0) > 0)
    prior = float(np.log((sides.get(True, 0) + SMOOTHING) / (sides.get(False, 0) + SMOOTHING)))
    if not sides.get(True):
        weights, prior = np.zeros(1 << BITS), -1.0
    odds = on_workers(known.select("page_id", "host", "path", "places"), _scored(weights, prior), "page_id long, host string, path string, odds double")
    found = rule_of(F.col("host"), F.col("path"), rules)
    return odds.withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"), "odds",
    )
