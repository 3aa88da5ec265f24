"""Hard negatives of embeddings by angular triangle filtering.

Scores are inner products of integer vectors. Each row stores its norm and its angles to a few
reference directions. The angle between an anchor and a row is at least the difference of their
angles to any reference and at most the sum of them, so each pair has a cosine interval, and with the
norms, rounded outwards, score bounds. A search is for the best scores within windows (for positives:
from the fifth best score known so far upwards; for negatives: between two shares of the score of each
positive, from the tenth best known so far upwards), and only pairs whose bounds overlap a window are
scored, in integers.

Rows lie in groups of neighbouring angles. Anchors are first searched in their own group, which
gives the scores that the windows start from. Then blocks of anchors meet runs of groups: bounds over
a whole block and group, from the least and greatest angles and norms, say which meet at all; a run
moves once to each block that needs it; a task goes through tiles of rows, bounds them as a whole, and
then pair by pair. The anchors are the query set; rows meet in groups of bounded size, whatever the
labels or directions, so that neither a frequent label nor a vector in many copies makes a large task.
"""

from __future__ import annotations

from math import ceil, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import chance, forget, shuffle_partitions, stored

#: Positives of an anchor, negatives of a positive, and the window of a negative's score in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Integer components beyond this are brought to it, so that no score leaves 64 bits.
LARGEST = 1 << 27
#: Reference directions, and about so many rows from which they are chosen.
REFERENCES, SAMPLE = 16, 4096
#: Rows to a group, groups whose anchors make a block, most groups to a run.
GROUP, BLOCK, RUN = 8192, 64, 8
#: Rows and anchors to a tile, and candidates that are held before they are cut to the best.
TILE_ROWS, TILE_ANCHORS, HELD = 256, 64, 50_000
#: Slack of angles (they are stored with 24 bits) and, as a share of the norms' product, of scores.
SLACK = 1e-5
#: No score is as far from 0.
BEYOND = 1 << 62

FOUND = "anchor_id bigint, place int, other bigint, score bigint"


def _vectors(t: pa.Table, column: str, kind) -> np.ndarray:
    values = t.column(column).combine_chunks()
    flat = values.flatten() if isinstance(values, pa.ListArray) else pa.concat_arrays([c.flatten() for c in values.chunks])
    return np.asarray(flat, kind).reshape(t.num_rows, -1) if t.num_rows else np.empty((0, 1), kind)


def references(sample: np.ndarray, most: int = REFERENCES) -> np.ndarray:
    """Up to ``most`` directions of the sample, each the farthest from those before; a zero row where there is none."""
    x = sample.astype(np.float64)
    x = x[np.abs(x).max(axis=1, initial=0) > 0]
    if not len(x):
        return np.zeros((1, sample.shape[1]))
    x /= np.linalg.norm(x, axis=1)[:, None]
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < most and near.min() < 1 - 1e-6:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a right angle for a zero vector, whose scores are 0 at any angle."""
    x = q.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return norm, np.arccos(np.clip(x @ refs.T / np.maximum(norm, 1e-300)[:, None], -1, 1))


class Windows:
    """The best scores of each anchor within its windows. ``low`` rises as better scores are found."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low, high, most
        self.held: list[np.ndarray] = []
        self.count = 0

    def add(self, anchor: np.ndarray, place: int, other: np.ndarray, score: np.ndarray) -> None:
        self.held.append(np.stack((anchor, np.full(len(anchor), place), other, score)))
        self.count += len(anchor)
        if self.count > HELD:
            self.cut()

    def cut(self) -> np.ndarray:
        """Keep the best of each window, ties by the smaller id; a full window starts at its last from now on."""
        if not self.held:
            return np.empty((4, 0), np.int64)
        a = np.concatenate(self.held, axis=1)
        a = a[:, np.lexsort((a[2], -a[3], a[1], a[0]))]
        key = a[0] * self.low.shape[1] + a[1]
        nth = np.arange(len(key)) - np.searchsorted(key, key)
        a, nth = a[:, nth < self.most], nth[nth < self.most]
        last = a[:, nth == self.most - 1]
        self.low[last[0], last[1]] = np.maximum(self.low[last[0], last[1]], last[3])
        self.held, self.count = [a], a.shape[1]
        return a


def search(x: dict[str, np.ndarray], y: dict[str, np.ndarray], windows: Windows, same: bool) -> None:
    """Score the anchors ``x`` against the rows ``y`` where bounds overlap a window; ``same``: of the anchor's label, else of others."""
    for b in range(0, len(y["id"]), TILE_ROWS):
        rows = slice(b, b + TILE_ROWS)
        theta, norm, label = y["angles"][rows], y["norm"][rows], y["label"][rows]
        if same:
            some = np.flatnonzero(np.isin(x["label"], label))
        else:
            some = np.arange(len(x["id"])) if (label != label[0]).any() else np.flatnonzero(x["label"] != label[0])
        # The tile as a whole.
        ta = x["angles"][some]
        gap = np.maximum(theta.min(axis=0) - ta, ta - theta.max(axis=0)).max(axis=1)
        wide = np.minimum(ta + theta.max(axis=0), 2 * pi - ta - theta.min(axis=0)).min(axis=1)
        most, least = np.cos(np.clip(gap - SLACK, 0, pi)), np.cos(np.clip(wide + SLACK, 0, pi))
        na = x["norm"][some]
        slack = SLACK * na * norm.max() + 1
        above = na * np.where(most >= 0, norm.max(), norm.min()) * most + slack
        below = na * np.where(least >= 0, norm.min(), norm.max()) * least - slack
        some = some[((above[:, None] >= windows.low[some]) & (below[:, None] <= windows.high[some])).any(axis=1)]
        for a in range(0, len(some), TILE_ANCHORS):
            these = some[a : a + TILE_ANCHORS]
            _pairs(x, these, y, rows, windows, same)
        if b == 0:
            windows.cut()


def _pairs(x, these: np.ndarray, y, rows: slice, windows: Windows, same: bool) -> None:
    ta, tb = x["angles"][these], y["angles"][rows]
    gap, wide = np.zeros((len(ta), len(tb)), np.float32), np.full((len(ta), len(tb)), pi, np.float32)
    for r in range(ta.shape[1]):
        u, v = ta[:, r, None], tb[None, :, r]
        np.maximum(gap, np.abs(u - v), out=gap)
        total = u + v
        np.minimum(wide, np.minimum(total, np.float32(2 * pi) - total), out=wide)
    norms = x["norm"][these][:, None] * y["norm"][rows][None, :]
    slack = SLACK * norms + 1
    above = norms * np.cos(np.maximum(gap.astype(np.float64) - SLACK, 0)) + slack
    below = norms * np.cos(np.minimum(wide.astype(np.float64) + SLACK, pi)) - slack
    low, high = windows.low[these], windows.high[these]
    fits = (x["label"][these][:, None] == y["label"][rows][None, :]) == same
    if same:
        fits &= x["id"][these][:, None] != y["id"][rows][None, :]
    near = np.zeros_like(fits)
    for w in range(low.shape[1]):
        near |= (above >= low[:, w, None]) & (below <= high[:, w, None])
    i, j = np.nonzero(fits & near)
    if not len(i):
        return
    qa, qb = x["q"][these], y["q"][rows]
    small = float(np.abs(qa).max(initial=0)) * float(np.abs(qb).max(initial=0)) * max(1, qa.shape[1]) < 2**53
    if small and 8 * len(i) > fits.size:  # all products of the tile at once; every sum is exact in 53 bits
        score = (qa.astype(np.float64) @ qb.astype(np.float64).T)[i, j].astype(np.int64)
    else:
        score = np.einsum("ij,ij->i", qa[i].astype(np.int64), qb[j].astype(np.int64))
    ids = y["id"][rows]
    for w in range(low.shape[1]):
        k = np.flatnonzero((score >= low[i, w]) & (score <= high[i, w]))
        if len(k):
            windows.add(these[i[k]], w, ids[j[k]], score[k])


def _side(t: pa.Table, codes: dict[str, int]) -> dict[str, np.ndarray]:
    t = t.rename_columns([c.removeprefix("r_") for c in t.column_names])
    label = np.array([codes.setdefault(v, len(codes)) for v in t.column("label").to_pylist()], np.int64)
    return {"id": np.asarray(t.column("vec_id"), np.int64), "label": label, "norm": np.asarray(t.column("norm"), np.float64), "q": _vectors(t, "q", np.int32), "angles": _vectors(t, "angles", np.float32)}


def _searcher(most: int, same: bool):
    """A function of one block of anchors (with their windows ``low`` and ``high``) and one run of rows: the best of each window."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        codes: dict[str, int] = {}
        x, y = _side(anchors, codes), _side(rows, codes)
        windows = Windows(_vectors(anchors, "low", np.int64).copy(), _vectors(anchors, "high", np.int64), most)
        if anchors.num_rows and rows.num_rows:
            search(x, y, windows, same)
        a = windows.cut()
        return pa.table({"anchor_id": pa.array(x["id"][a[0]], pa.int64()), "place": pa.array(a[1], pa.int32()), "other": pa.array(a[2], pa.int64()), "score": pa.array(a[3], pa.int64())})

    return run


def indexed(vectors: DataFrame, anchor: Column, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, anchor, q, norm, angles, group``: the rows that take part, stored by groups of neighbouring angles."""
    spark = vectors.sparkSession
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda v: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(v.cast("double") * scale))).cast("int"))
    d = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    d = d.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("q"))
    if not d.groupBy("vec_id").count().where("count > 1").isEmpty():
        first = F.min(F.struct("label", "q", "anchor"))
        d = d.groupBy("vec_id").agg(first.alias("_r")).select("vec_id", "_r.label", "_r.anchor", "_r.q")
    size = d.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("dim")).first()
    n, dim = size["n"], max(1, size["dim"] or 0)
    d = d.withColumn("q", F.concat("q", F.array_repeat(F.lit(0), F.lit(dim) - F.size("q"))))
    some = d.where(chance("vec_id", F.lit("reference")) < F.lit(SAMPLE / max(1, n))).select("vec_id", "q").collect()
    refs = references(np.array([r["q"] for r in sorted(some, key=lambda r: r["vec_id"])], np.int64).reshape(len(some), dim))

    def with_angles(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            norm, theta = angles(_vectors(t, "q", np.int32), refs)
            cell = theta.argmin(axis=1) if len(theta) else np.empty(0, np.int64)
            near = theta.min(axis=1) if len(theta) else np.empty(0)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, theta.size + 1, len(refs)), pa.int32()), pa.array(theta.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm), listed, pa.array(cell, pa.int32()), pa.array(near)], [*b.schema.names, "norm", "angles", "cell", "near"])

    d = d.mapInArrow(with_angles, "vec_id bigint, label string, anchor boolean, q array<int>, norm double, angles array<float>, cell int, near double")
    count = max(ceil(n / GROUP), min(shuffle_partitions(spark), ceil(n / 512)), 1)
    return stored(d.repartitionByRange(count, "cell", "near", "vec_id").drop("cell", "near").withColumn("group", F.spark_partition_id()))


def _ranges(d: DataFrame, by: str, more: dict[str, Column]) -> DataFrame:
    """The least and greatest angle to each reference and norm of all rows of a group or block."""
    refs = d.select(F.size("angles")).first()
    theta = [F.col("angles")[r].cast("double") for r in range(refs[0] if refs else 1)]
    low = F.array(*(F.min(t) for t in theta)).alias("least")
    return d.groupBy(by).agg(low, F.array(*(F.max(t) for t in theta)).alias("most"), F.min("norm").alias("short"), F.max("norm").alias("long"), *(c.alias(k) for k, c in more.items()))


def meetings(anchors: DataFrame, groups: DataFrame) -> DataFrame:
    """``block, group``: which blocks of anchors and groups of rows can have a pair within a window.

    Both tables have a row for thousands of rows; each group is laid beside each block's ranges.
    """
    window = {"low": F.min(F.array_min("low")), "high": F.max(F.array_max("high"))}
    a = stored(_ranges(anchors, "block", window).withColumnsRenamed({c: f"a_{c}" for c in ("least", "most", "short", "long")}))
    blocks = [r["block"] for r in a.select("block").collect()]
    g = groups.withColumn("block", F.explode(F.lit(sorted(blocks)) if blocks else F.array().cast("array<int>")))
    d = g.join(a, "block")
    gap = F.array_max(F.zip_with(F.zip_with("least", "a_most", lambda u, v: u - v), F.zip_with("a_least", "most", lambda u, v: u - v), lambda u, v: F.greatest(u, v)))
    wide = F.array_min(F.zip_with(F.zip_with("most", "a_most", lambda u, v: u + v), F.zip_with("least", "a_least", lambda u, v: u + v), lambda u, v: F.least(u, F.lit(2 * pi) - v)))
    d = d.withColumn("_up", F.cos(F.least(F.lit(pi), F.greatest(F.lit(0.0), gap - SLACK)))).withColumn("_down", F.cos(F.least(F.lit(pi), F.greatest(F.lit(0.0), wide + SLACK))))
    far, close = F.col("long") * F.col("a_long"), F.col("short") * F.col("a_short")
    above = F.when(F.col("_up") >= 0, far).otherwise(close) * F.col("_up") + far * SLACK + 1
    below = F.when(F.col("_down") >= 0, close).otherwise(far) * F.col("_down") - far * SLACK - 1
    return d.where((above >= F.col("low")) & (below <= F.col("high"))).select("block", "group")


def _best(found: DataFrame, most: int) -> DataFrame:
    order = W.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _searched(anchors: DataFrame, rows: DataFrame, groups: DataFrame, most: int, same: bool) -> DataFrame:
    """The ``most`` best rows in each window of each anchor: ``anchor_id, place, other, score, rank``."""
    spark = rows.sparkSession
    side = ["vec_id", "label", "norm", "q", "angles"]
    theirs = rows.select("group", *(F.col(c).alias(f"r_{c}") for c in side))
    one = _searcher(most, same)
    # Within the own group, for scores from which to search on.
    own = anchors.withColumnRenamed("group", "g").groupBy("g").cogroup(theirs.groupBy("group")).applyInArrow(lambda a, b: one(a, b) if a.num_rows else one(a, b.slice(0, 0)), FOUND)
    tenth = _best(own, most).where(F.col("rank") == most).groupBy(F.col("anchor_id").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("_known"))
    low = F.transform("low", lambda v, i: F.greatest(v, F.coalesce(F.try_element_at(F.col("_known"), i), v)))
    anchors = stored(anchors.join(tenth, "vec_id", "left").withColumn("low", low).drop("_known"))
    count = groups.count()
    run = max(1, min(RUN, count // max(1, shuffle_partitions(spark))))
    pairs = stored(meetings(anchors, groups).withColumn("run", F.floor(F.col("group") / run).cast("int")))
    right = theirs.join(pairs, "group")
    left = anchors.drop("group").join(pairs.select("block", "run").distinct(), "block").withColumnsRenamed({"block": "b", "run": "r"})
    found = left.groupBy("b", "r").cogroup(right.groupBy("block", "run")).applyInArrow(one, FOUND)
    out = stored(_best(found, most))
    forget(anchors, pairs)
    return out


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; the rows for which ``anchor`` holds are the queries.
    Components become ``floor(scale * x)`` and a score is the inner product. An anchor's positives are the
    best ``positives`` other rows of its label, a positive's negatives the best ``negatives`` rows of other
    labels with a score of ``low`` to ``high`` hundredths of the positive's; higher scores come first, of equals the
    smaller id. A positive without such rows has none, so has an anchor that is alone in its label.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part. Of rows
    that repeat an id one counts, that of the smallest label and vector. Shorter vectors end in zeros;
    zero vectors have score 0 with all. Integers beyond ``2 ** 27`` count as that. Other columns are not read.
    """
    rows = indexed(vectors, anchor, scale)
    groups = stored(_ranges(rows, "group", {}))
    a = rows.where("anchor").drop("anchor").withColumn("block", F.floor(F.col("group") / BLOCK).cast("int"))
    every = a.withColumns({"low": F.array(F.lit(-BEYOND)), "high": F.array(F.lit(BEYOND))})
    best = _searched(every, rows, groups, positives, True)
    # Windows of the positives in whole scores: the least s with 100 s >= low p, the greatest with 100 s <= high p.
    of = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_p"))
    part = lambda share, more: f"(p.score div 100) * {share} + ((p.score % 100) * {share} + {more}) div 100"
    least, most = (F.expr(f"transform(_p, p -> CASE WHEN p.score < 0 THEN {none} ELSE {part(share, more)} END)") for share, more, none in ((low, 99, BEYOND), (high, 0, -BEYOND)))
    fill = lambda v: F.array_repeat(F.lit(v), F.lit(positives) - F.size("_p"))
    windows = of.select("vec_id", F.concat(least, fill(BEYOND)).alias("low"), F.concat(most, fill(-BEYOND)).alias("high"))
    worst = _searched(a.join(windows, "vec_id"), rows, groups, negatives, False)
    forget(rows, groups)
    p = best.select("anchor_id", F.col("other").alias("positive_id"), (F.col("rank") - 1).alias("place"), F.col("score").alias("positive_score"))
    n = worst.select("anchor_id", "place", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    return p.join(n, ["anchor_id", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
