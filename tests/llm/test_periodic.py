"""Periodic runs of words against a plain search, and rows of every kind."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtab.llm import periodic, queries


def plain_runs(w):
    """Every lag by itself; a stretch that a divisor of the lag has too is left out."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            run = (i - q, j - i + q, q)
            if run[1] >= max(6, 4 * q) and not any((s, n) == run[:2] and q % p == 0 for s, n, p in out):
                out.append(run)
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(3_000):
        n, letters = rng.choice([0, 1, 5, 6, 7, 20, 60, 120]), rng.choice([1, 2, 2, 3, 6])
        w = []
        while len(w) < n:
            block = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
            w += (block * rng.randint(1, 7))[: rng.randint(1, 80)]
        assert periodic.runs(np.array(w, np.int64)) == plain_runs(w), w


@pytest.mark.parametrize("word", ["a", "a b", "a a b"])
def test_frequent_words_do_not_cost_a_square(word):
    n = 200_000
    w = [ord(c) for c in (word.split() * n)[:n]]
    assert periodic.runs(np.array(w)) == [(0, n, len(word.split()))]
    # A word that fills a third of all places between others, none of which repeats.
    w = [0 if i % 3 == 0 else i for i in range(n)]
    assert periodic.runs(np.array(w)) == []


def as_rows(df):
    return sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in df.collect()), key=str)


def test_rows_of_every_kind(spark):
    texts = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a a a a a"), (5, "x a a a a a a y"), (6, "a b a b"), (None, "p q p q p q p q p"), (5, "x a a a a a a y"), (7, "한 中 " * 5 + "end"), (8, "b " * 50_000)]
    docs = spark.createDataFrame([(*t, "r", "c", 1) for t in texts], "doc_id long, text string, runs string, collapsed string, _words int")
    assert as_rows(periodic.periodic_runs(docs)) == sorted([
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [], "a a a a a"), (5, [(1, 6, 1)], "x a y"), (5, [(1, 6, 1)], "x a y"), (6, [], "a b a b"),
        (None, [(0, 9, 2)], "p q"), (7, [(0, 10, 2)], "한 中 end"), (8, [(0, 50_000, 1)], "b"),
    ], key=str)
    assert periodic.digest(periodic.periodic_runs(periodic.planted(docs.limit(0)))).count() == 0
    assert periodic.digest(periodic.periodic_runs(periodic.planted(docs))).count() == len(texts)


def test_digest_takes_the_greatest_exponent_then_the_first(spark):
    rows = [(1, [(0, 8, 2), (9, 12, 3), (30, 6, 1)], "k"), (2, [(5, 8, 2), (1, 8, 2)], ""), (3, [], ""), (4, [(0, 9, 2), (0, 13, 3)], "")]
    found = {r["doc_id"]: r for r in periodic.digest(spark.createDataFrame(rows, f"doc_id long, runs {periodic.RUNS}, collapsed string")).collect()}
    assert [found[1][c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == [3, 30, 6, 1, 6000]
    assert [found[2][c] for c in ("start", "length", "period")] == [1, 8, 2]
    assert [found[3][c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == [0, None, None, None, None]
    assert [found[4][c] for c in ("start", "length", "period", "exponent_milli")] == [0, 9, 2, 4500]
    assert found[1]["runs_sha256"] == hashlib.sha256(b"0,8,2\n9,12,3\n30,6,1\n").hexdigest()
    assert found[3]["runs_sha256"] == found[3]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()


def test_planted_periods(spark, sf):
    import zlib

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    made = {r["doc_id"]: r["text"] for r in periodic.planted(docs).collect()}
    seen = 0
    for r in docs.collect():
        h, w = zlib.crc32(str(r["doc_id"]).encode()), (r["text"] or "").encode().split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert made[r["doc_id"]].encode().split() == [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            seen += 1
        else:
            assert made[r["doc_id"]] == (r["text"] or "")
    assert seen


def test_query_equals_sql(spark, sf):
    from oracle import compare, duck

    compare(spark, duck(sf), sf, queries.QUERIES["op13_periodic_runs"], queries.ORACLES["op13_periodic_runs"])
