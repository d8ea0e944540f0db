"""FTRL-proximal against a plain version, and the bounded sample."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity as T


def plain_ftrl(rows, alpha, beta, l1, l2):
    """One coordinate at a time, in dictionaries."""
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for places, label in rows:
        total = max(-30, min(30, bias + sum(weight(i) for i in places)))
        g = 1 / (1 + math.exp(-total)) - label
        step = {i: (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * weight(i) for i in places}
        for i in places:
            z[i] = z.get(i, 0.0) + g - step[i]
            n[i] = n.get(i, 0.0) + g * g
        bias_n += g * g
        bias -= alpha * g / (beta + math.sqrt(bias_n))
    return bias, {i: weight(i) for i in z if weight(i)}


def test_ftrl_against_plain():
    draw = random.Random(5)
    rows = []
    for _ in range(600):
        places = draw.sample(range(64), draw.randrange(0, 12))
        rows.append((np.array(sorted(places), dtype=np.int64), int(draw.random() < (0.8 if 7 in places else 0.2))))
    for l1 in (0.0, 0.5, 2.0):
        got = T.fit_ftrl(iter(rows), bits=6, alpha=0.3, beta=1.0, l1=l1, l2=0.7)
        bias, weights = plain_ftrl([(list(map(int, p)), y) for p, y in rows], 0.3, 1.0, l1, 0.7)
        assert math.isclose(got.bias, bias, rel_tol=1e-9)
        assert got.places.tolist() == sorted(weights) and np.allclose(got.values, [weights[i] for i in sorted(weights)], rtol=1e-9)


def test_an_id_with_very_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.range(3_000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("bad words "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(6, "fine text here"), (7, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (7, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = T.train(docs, labels, F.lit(True))
    # the same three texts, in the order of their hashes, for every epoch
    texts = spark.createDataFrame([(5, "bad words 0", 1), (6, "fine text here", 0), (7, "", 0)], "doc_id long, text string, label int")
    order = [r for r in texts.withColumn("key", F.xxhash64("doc_id", F.lit(7))).orderBy("key").collect()]
    import pyarrow as pa

    rows = []
    for r in order * T.EPOCHS:
        _, place = T.features(pa.RecordBatch.from_pydict({"text": [r.text]}))
        rows.append((np.unique(place), r.label))
    want = T.fit_ftrl(iter(rows))
    assert got.bias == want.bias and got.places.tolist() == want.places.tolist() and got.values.tolist() == want.values.tolist()
