"""Host names of any length are segmented in time, with the words that a plain Viterbi finds."""

import math
import random
import time

from ledgerlake.llm.url_filter import filter_urls, host_words


def test_very_long_hosts_and_repeated_pages(spark):
    draw = random.Random(3)
    long = "".join(draw.choice("abcdefghij") for _ in range(100_000))
    rows = [(1, f"http://{long}.com/x", ""), (2, "http://shop.example.org/a", ""), (2, "http://shop.example.org/a", ""), (3, "http://" + "a" * 30_000 + "/", ""), (4, None, None), (5, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' as host", "'x' as word", "1 as odds")
    start = time.time()
    got = filter_urls(pages).collect()
    assert time.time() - start < 90
    assert sorted((r.page_id, len(r.host)) for r in got) == [(1, 100_004), (2, 16), (2, 16), (3, 30_000), (4, 0), (5, 0)]
    assert len({(r.verdict, r.odds) for r in got if r.page_id == 2}) == 1
    assert filter_urls(pages.limit(0)).count() == 0


def test_words_of_short_hosts(spark):
    counts = {"news": 50, "paper": 40, "newspaper": 3, "pap": 1, "er": 2, "on": 20, "line": 30, "online": 25}
    total = sum(counts.values())
    hosts = spark.createDataFrame([("newspaperonline", 1), ("on-line7news", 2), ("7", 1), ("", 1)], "host string, n long")
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.host: list(r.words) for r in host_words(hosts, words).collect()}
    assert got[""] == [] and got["7"] == [] and got["on-line7news"] == ["on", "line", "news"]

    def cost(split):
        return sum(-math.log10(counts[w] / total) for w in split)

    assert "".join(got["newspaperonline"]) == "newspaperonline" and cost(got["newspaperonline"]) <= min(
        cost(["newspaper", "online"]), cost(["news", "paper", "online"]), cost(["news", "paper", "on", "line"])
    )
