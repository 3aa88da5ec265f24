"""Hard negatives against a plain search; bounds, ties, copies and rows of every kind."""

import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from voxtab.llm import negatives, queries


def plain(rows, anchors, positives=5, most=10, low=30, high=90):
    """Every anchor against every row, in whole numbers."""
    q = {i: [max(-(1 << 27), min(1 << 27, int(np.floor(256 * float(x))))) for x in v] for i, _, v in rows}
    label, out = {i: g for i, g, _ in rows}, []
    dot = lambda a, b: sum(x * y for x, y in zip(q[a], q[b]))
    for a in anchors:
        score = sorted(((-dot(a, b), b) for b in q if b != a))
        for s, p in [x for x in score if label[x[1]] == label[a]][:positives]:
            fit = [(t, b) for t, b in score if label[b] != label[a] and low * -s <= 100 * -t <= high * -s][:most]
            out += [(a, p, k, b, -s, -t) for k, (t, b) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, anchors, **more):
    d = spark.createDataFrame([(i, g, [float(x) for x in v], 0, 1) for i, g, v in rows], "vec_id long, label int, embedding array<double>, score int, `group` int")
    return sorted(tuple(r) for r in negatives.hard_negatives(d, F.col("vec_id").isin(*anchors), **more).collect())


def test_query_equals_sql(spark, sf):
    compare(spark, duck(sf), sf, queries.QUERIES["op11_angular_negatives"], queries.ORACLES["op11_angular_negatives"])


@pytest.mark.parametrize("kind", ["clusters", "random", "copies"])
def test_equals_a_plain_search(spark, monkeypatch, kind):
    for name, value in (("GROUP", 40), ("BLOCK", 2), ("RUN", 3), ("TILE_ROWS", 16), ("TILE_ANCHORS", 4), ("HELD", 50)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(len(kind))
    n, dim = 400, 8
    x = rng.normal(size=(n, dim))
    if kind == "clusters":
        x = rng.normal(size=(6, dim))[rng.integers(0, 6, n)] * 2 + 0.1 * x
    if kind == "copies":
        x[50:300] = x[50]  # ties by the hundred
        x[300:320] = 0
        x[320:330] *= 1e7
    rows = [(int(i), int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(np.float32(x))]
    anchors = list(range(0, n, 13))
    assert found(spark, rows, anchors) == plain(rows, anchors)
    assert found(spark, rows, anchors[:4], positives=2, negatives=3, low=0, high=100) == plain(rows, anchors[:4], 2, 3, 0, 100)


def test_bounds_hold_and_far_tiles_are_not_scored(monkeypatch):
    rng = np.random.default_rng(3)
    c = rng.normal(size=(4, 16))
    x = np.floor(256 * (np.repeat(c, 512, axis=0) + 0.02 * rng.normal(size=(2048, 16)))).astype(np.int32)
    norm, theta = negatives.angles(x, negatives.references(x[::64]))
    side = {"id": np.arange(2048), "label": np.zeros(2048, np.int64), "norm": norm, "q": x, "angles": theta.astype(np.float32)}
    score = x.astype(np.int64) @ x.T.astype(np.int64)
    some = {k: v[:8] for k, v in side.items()}
    low = np.sort(score[:8], axis=1)[:, -20][:, None]
    w = negatives.Windows(low.copy(), np.full((8, 1), negatives.BEYOND), 10)
    met = []
    whole = negatives._pairs
    monkeypatch.setattr(negatives, "_pairs", lambda a, these, b, rows, *r: (met.append(rows.start), whole(a, these, b, rows, *r)))
    negatives.search(some, side, w, True)
    assert set(met) <= {0, 256}  # the other three clusters lie beyond every window
    got = w.cut()
    for a in range(8):
        want = sorted((-int(s), k) for k, s in enumerate(score[a]) if k != a)[:10]
        assert [(-int(s), int(k)) for k, s in zip(got[2, got[0] == a], got[3, got[0] == a])] == want
    gap = np.abs(theta[:, None, :] - theta[None, :64, :]).max(axis=2)
    wide = np.minimum(theta[:, None, :] + theta[None, :64, :], 2 * np.pi - theta[:, None, :] - theta[None, :64, :]).min(axis=2)
    real = score[:, :64] / (norm[:, None] * norm[None, :64])
    assert (real <= np.cos(np.clip(gap - negatives.SLACK, 0, np.pi)) + 1e-9).all() and (real >= np.cos(np.clip(wide + negatives.SLACK, 0, np.pi)) - 1e-9).all()


def test_rows_of_every_kind(spark):
    v = lambda *x: list(x)
    rows = [
        (0, 1, v(1.0, 0.0)), (0, 1, v(1.0, 0.0)), (0, 2, v(9.0, 9.0)), (1, 1, v(1.0, 0.1)), (2, 2, v(0.5, 0.0)), (3, 2, v(0.5)), (4, 2, None), (5, None, v(1.0, 1.0)),
        (6, 2, v(0.5, None)), (7, 2, v(0.5, float("nan"))), (8, 2, v(float("inf"), 0.0)), (None, 2, v(0.5, 0.0)), (9, 3, []), (10, 4, v(-1.0, 0.0)), (11, 1, v(-1.0, 0.0)),
    ]
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = sorted(tuple(r) for r in negatives.hard_negatives(d, F.col("vec_id").isin(0, 10)).collect())
    assert out == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 3, 65536, 32768)]
    assert negatives.hard_negatives(d.limit(0), F.col("vec_id") == 0).count() == 0
    assert negatives.hard_negatives(d, F.col("vec_id") == 99).count() == 0
    text = d.withColumn("label", F.concat(F.lit("l"), F.col("label").cast("string")))
    assert sorted(tuple(r) for r in negatives.hard_negatives(text, F.col("vec_id").isin(0, 10)).collect()) == out
    huge = spark.createDataFrame([(0, 1, v(1e30, 0.0)), (1, 1, v(1e30, 0.0)), (2, 2, v(0.5e6 * 0.8, 0.0))], "vec_id long, label int, embedding array<double>")
    top = 1 << 27
    assert [tuple(r) for r in negatives.hard_negatives(huge, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2, top * top, top * int(256 * 0.4e6))]
