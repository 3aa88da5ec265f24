"""Exact near-duplicates of embeddings by dual traversal of cover trees.

On unit vectors a cosine of ``c`` or more is a chord of ``sqrt(2 - 2 c)`` or less, so the triangle
inequality holds: a pair of tree nodes whose centres are further apart than their covering radii and
that chord together has no pair to give, and a pair that is nearer than the chord less both radii
links all with all, which needs no comparison.

Levels are nested: the centre of a node is one of the centres among which the node is divided, the
others are further than ``R`` from it and from each other, each vector goes to the nearest, and ``R``
is a power of two that at least halves from level to level. Covering radii are measured. Spark makes
the levels of nodes with more than ``BLOCK`` vectors, with centres from a sample of the node; where
the sample is so spread that centres would hardly group it (or so dense that all are equal), the
node is a list of blocks under its own centre. Each block builds the rest of its tree once and
carries it. Pairs of nodes are expanded from the roots, level by level; a task then takes one pair
of blocks and walks down both trees. Tasks give link counts and the edges of a spanning forest,
never all pairs. Vectors that are equal are one class with a count from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, forget, stored
from .simhash import merge

#: Most vectors of a node that one task takes whole, about.
BLOCK = 1024
#: Most centres of a node that Spark divides, and about so many of its vectors from which they are chosen.
FANOUT, SAMPLE = 256, 1024
#: Rows that are dealt to the nearest centres by one task at a time, about.
PART = 4096
#: A lower node of so few vectors, or with too many children to gain from, is a leaf.
LEAF = 32
_SLACK = 1e-9


def _unit(flat: np.ndarray, rows: int) -> np.ndarray:
    x = np.asarray(flat, np.float64).reshape(rows, -1)
    x = x / np.abs(x).max(axis=1, initial=0)[:, None]  # else squares of very small or large numbers are lost
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _far(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def halved(radius: float) -> float:
    """The largest power of two below ``radius``."""
    return 2.0 ** (math.ceil(math.log2(radius)) - 1)


def net(x: np.ndarray, first: int, most: int, radius: float) -> list[int] | None:
    """Rows of ``x`` from ``first`` on, each the farthest from those before, until all are within ``radius``; none if that takes more than ``most``."""
    chosen = [first]
    near = _far(x, x[first])
    while near.max() > radius:
        if len(chosen) == most:
            return None
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _far(x, x[chosen[-1]]))
    return chosen


class Tree:
    """The tree of a block. Its rows are put in an order in which each node is a range."""

    __slots__ = ("lo", "hi", "centre", "radius", "kids", "kids_end")

    def __init__(self, table: np.ndarray, radius: np.ndarray):
        self.lo, self.hi, self.centre, self.kids, self.kids_end = table.reshape(5, -1)
        self.radius = radius

    def packed(self) -> bytes:
        return np.concatenate((np.concatenate((self.lo, self.hi, self.centre, self.kids, self.kids_end)).astype(np.int64), self.radius.view(np.int64))).tobytes()

    @classmethod
    def unpacked(cls, raw: bytes) -> Tree:
        a = np.frombuffer(raw, np.int64)
        n = len(a) // 6
        return cls(a[: 5 * n], a[5 * n :].view(np.float64))


def grow(x: np.ndarray, centre: int) -> tuple[np.ndarray, Tree]:
    """The order of the rows and the tree of unit vectors, with ``centre`` as the root's."""
    order = np.arange(len(x))
    nodes, at = [[0, len(x), centre, 0, 0, 0.0]], 0
    while at < len(nodes):
        lo, hi, c = nodes[at][:3]
        rows = order[lo:hi]
        far = _far(x[rows], x[c])
        nodes[at][5] = radius = float(far.max())
        if len(rows) > LEAF and radius > _SLACK:
            chosen = net(x[rows], int(np.flatnonzero(rows == c)[0]), len(rows) // 4, halved(radius))
            if chosen:
                near = np.argmax(x[rows] @ x[rows[chosen]].T, axis=1)
                near[chosen] = np.arange(len(chosen))
                new = np.argsort(near, kind="stable")
                centres, ends = rows[chosen], lo + np.cumsum(np.bincount(near, minlength=len(chosen)))
                order[lo:hi] = rows[new]
                nodes[at][3:5] = len(nodes), len(nodes) + len(chosen)
                nodes += [[a, b, int(k), 0, 0, 0.0] for a, b, k in zip([lo, *ends[:-1].tolist()], ends.tolist(), centres)]
        at += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    t = np.array([[n[0], n[1], place[n[2]], n[3], n[4]] for n in nodes], np.int64)
    return order, Tree(t.T.ravel(), np.array([n[5] for n in nodes]))


def walk(x, a: Tree, y, b: Tree, cosine: float, same: bool):
    """Yield ``(range of x, range of y, which of their pairs link)``, with None for all; with ``same`` each pair of one set once."""
    chord = math.sqrt(max(0.0, 2 - 2 * cosine))
    cx, cy = x[a.centre], y[b.centre]
    stack = [(0, 0, same)]
    while stack:
        p, q, own = stack.pop()
        rp, rq = (a.lo[p], a.hi[p]), (b.lo[q], b.hi[q])
        d = 0.0 if own else float(np.linalg.norm(cx[p] - cy[q]))
        if d > a.radius[p] + b.radius[q] + chord + _SLACK:
            continue
        if d + a.radius[p] + b.radius[q] <= chord - _SLACK:
            yield rp, rq, None
            continue
        kp, kq = a.kids_end[p] > a.kids[p], b.kids_end[q] > b.kids[q]
        if not kp and not kq:
            hit = x[slice(*rp)] @ y[slice(*rq)].T >= cosine
            if own:
                hit = np.triu(hit, 1)
            if hit.any():
                yield rp, rq, hit
        elif own:
            k = np.arange(a.kids[p], a.kids_end[p])
            stack += [(int(i), int(i), True) for i in k]
            far = np.sqrt(np.maximum(0, 2 - 2 * cx[k] @ cx[k].T))
            i, j = np.nonzero(np.triu(far <= a.radius[k][:, None] + a.radius[k] + chord + 1e-6, 1))
            stack += [(int(k[s]), int(k[t]), False) for s, t in zip(i, j)]
        else:
            split_p = kp and (not kq or a.radius[p] >= b.radius[q])
            t, c, other, r = (a, cx, cy[q], b.radius[q]) if split_p else (b, cy, cx[p], a.radius[p])
            n = p if split_p else q
            k = np.arange(t.kids[n], t.kids_end[n])
            k = k[_far(c[k], other) <= t.radius[k] + r + chord + _SLACK]
            stack += [(int(i), q, False) if split_p else (p, int(i), False) for i in k]


def _usable(e: Column) -> Column:
    """Not null, with finite components only, and not zero."""
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return e.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(e, lambda v: v != 0)


_CLASS = ["cid", "cid2"]
_NODE = ["label", "dim", "path"]
_KEPT = [*_CLASS, "rep", "n", "label", "dim", "x"]


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each different vector of a label: its key, ``rep`` (smallest id), ``n``, ``label, dim, x``."""
    own = rows.where("cid is not null").groupBy(*_CLASS).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("x").alias("x"))
    return own.select(*_CLASS, "rep", "n", "label", F.size("x").alias("dim"), "x")


def _centres(members: DataFrame) -> DataFrame:
    """Of each node ``centres`` (flat; its own centre only where it becomes a list of blocks), ``divided`` and ``size``, from a sample of its rows."""

    def choose(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(_CLASS)
        x = _unit(np.concatenate(f["x"].to_numpy()), len(f))
        own = f["centre"].iloc[0]
        if own is not None and len(own):
            x = np.concatenate((np.asarray(own, np.float64)[None], x))
        far = float(_far(x, x[0]).max())
        chosen = net(x, 0, FANOUT, halved(far)) if far > 1e-7 else None
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "path": [key[2]], "centres": [x[chosen or [0]].ravel().tolist()], "divided": [chosen is not None], "size": [f["size"].iloc[0]]})

    chance = F.pmod(F.xxhash64("cid", F.lit("centre")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = members.where(chance * F.col("size") < SAMPLE).select(*_CLASS, *_NODE, "x", "centre", "size")
    return part.groupBy(*_NODE).applyInPandas(choose, "label long, dim int, path string, centres array<double>, divided boolean, size long")


def _dealt(members: DataFrame, centres: DataFrame) -> DataFrame:
    """The rows with the path of their new node, and how far its centre is: the nearest centre's node, or a block of the list.

    A node's rows are dealt by parts of about ``PART``, each with the node's centres.
    """

    def run(f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({c: [] for c in (*_KEPT, "path", "far")})
        x = _unit(np.concatenate(f["x"].to_numpy()), len(f))
        c = np.asarray(g["centres"].iloc[0], np.float64).reshape(-1, x.shape[1])
        if g["divided"].iloc[0]:
            k, sign = np.argmax(x @ c.T, axis=1), "/"
            far = _far(x, c[k])
        else:
            blocks = -(-int(g["size"].iloc[0]) * 4 // (3 * BLOCK))
            k, far, sign = f["cid2"].to_numpy() % blocks, _far(x, c[0]), "#"
        return f[_KEPT].assign(path=[f"{p}{sign}{i}" for p, i in zip(f["path"], k)], far=far)

    parts = lambda: F.ceil(F.col("size") / F.lit(PART)).cast("long")
    rows = members.withColumn("part", F.pmod(F.xxhash64("cid", F.lit("part")), parts())).select(*_KEPT, "path", "part")
    given = centres.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts() - 1)))
    kinds = {f.name: f.dataType.simpleString() for f in members.schema.fields}
    by = [*_NODE, "part"]
    return rows.groupBy(*by).cogroup(given.groupBy(*by)).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in _KEPT) + ", path string, far double")


_INFO = ["centre", "radius", "weight", "least"]


def _top(classes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The rows with the path of their block, and for each level the nodes made on it: ``label, dim, parent, path`` and what ``_INFO`` names."""
    done, levels, centre = [], [], None
    work = stored(classes.withColumn("path", F.lit("")))
    passed = [work]
    while True:
        sizes = work.groupBy(*_NODE).agg(F.count("*").alias("size"))
        sizes = stored(sizes.withColumn("centre", F.lit(None).cast("array<double>")) if centre is None else sizes.join(centre, _NODE))
        large = sizes.where((F.col("size") > BLOCK) & ~F.col("path").contains("#"))
        done.append(work.join(large.select(*_NODE), _NODE, "left_anti").select(*_KEPT, "path"))
        if large.isEmpty():
            break
        members = work.join(large, _NODE)
        centres = stored(_centres(members))
        dealt = stored(_dealt(members, centres))
        made = dealt.groupBy(*_NODE).agg(F.max("far").alias("radius"), F.sum("n").alias("weight"), F.min("rep").alias("least"))
        made = made.withColumn("parent", F.regexp_replace("path", "[/#][0-9]+$", ""))
        place = F.when(F.col("path").rlike("/[0-9]+$"), F.regexp_extract("path", "([0-9]+)$", 1).cast("int") * F.col("dim")).otherwise(0)
        of = centres.select("label", "dim", F.col("path").alias("parent"), "centres")
        levels.append(stored(made.join(of, ["label", "dim", "parent"]).select("label", "dim", "parent", "path", F.slice("centres", place + 1, F.col("dim")).alias("centre"), "radius", "weight", "least")))
        centre = levels[-1].select(*_NODE, "centre")
        work = dealt.drop("far")
        passed.append(dealt)
    blocks = done[0]
    for x in done[1:]:
        blocks = blocks.unionByName(x)
    blocks = stored(blocks)
    forget(*passed)
    return blocks, levels


def _packed(rows: DataFrame, levels: list[DataFrame], single: bool) -> DataFrame:
    """One row for each block: its keys, ids, counts, vectors, and its tree."""
    kind = np.float32 if single else np.float64

    def pack(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(_CLASS)
        x = _unit(np.concatenate(f["x"].to_numpy()), len(f))
        own = f["centre"].iloc[0]
        middle = np.asarray(own, np.float64) if own is not None and len(own) else x.mean(axis=0)
        order, tree = grow(x, int(_far(x, middle).argmin()))
        f = f.iloc[order]
        out = {"label": key[0], "dim": key[1], "path": key[2], "tree": tree.packed(), "xs": np.concatenate(f["x"].to_numpy()).astype(kind).tobytes()}
        return pd.DataFrame({c: [v] for c, v in (out | {c: f[c].to_numpy(np.int64).tobytes() for c in (*_CLASS, "rep", "n")}).items()})

    centre = None
    for x in levels:
        own = x.select(*_NODE, "centre")
        centre = own if centre is None else centre.union(own)
    rows = rows.withColumn("centre", F.lit(None).cast("array<double>")) if centre is None else rows.join(centre, _NODE, "left")
    return rows.groupBy(*_NODE).applyInPandas(pack, "label long, dim int, path string, tree binary, xs binary, cid binary, cid2 binary, rep binary, n binary")


def _pairs(blocks: DataFrame, levels: list[DataFrame], cosine: float) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of blocks that the bounds leave (``label, dim, a, b`` with ``a <= b``), and pairs of nodes that link all with all, with weights and least ids."""
    chord = math.sqrt(max(0.0, 2 - 2 * cosine))
    kinds = ("array<double>", "double", "long", "long")
    pairs = blocks.select("label", "dim").distinct()
    pairs = pairs.select("label", "dim", F.lit("").alias("a"), F.lit("").alias("b"), *(F.lit(None).cast(t).alias(f"{c}_{s}") for s in "ab" for c, t in zip(_INFO, kinds)))
    whole = None
    for level in levels:
        for s in "ab":
            one = level.select("label", "dim", F.col("parent").alias(s), F.col("path").alias("path_"), *(F.col(c).alias(f"{c}_") for c in _INFO))
            rest = [c for c in pairs.columns if c not in ("label", "dim", s) and not c.endswith(f"_{s}")]
            pairs = pairs.join(one, ["label", "dim", s], "left").select("label", "dim", *rest, F.coalesce("path_", s).alias(s), *(F.coalesce(f"{c}_", f"{c}_{s}").alias(f"{c}_{s}") for c in _INFO))
        d2 = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
        far, both = F.sqrt(d2), F.col("radius_a") + F.col("radius_b")
        pairs = pairs.where("a <= b").withColumn("all", F.coalesce(far + both <= chord - _SLACK, F.lit(False)))
        pairs = stored(pairs.where(F.coalesce(far <= both + F.lit(chord + _SLACK), F.lit(True))))
        full = pairs.where("all").select("label", "dim", "a", "b", "weight_a", "weight_b", "least_a", "least_b")
        whole = full if whole is None else whole.union(full)
        pairs = pairs.where("not all").drop("all")
    return pairs.select("label", "dim", "a", "b"), whole


def _whole(blocks: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What node pairs that link all with all add to each block: ``add`` to each class's links, among them ``own`` times itself, and ``least`` to link with; and edges between ids."""
    own = (F.col("a") == F.col("b")).cast("long")
    one = whole.select("label", "dim", F.col("a").alias("node"), F.col("weight_b").alias("add"), F.col("least_b").alias("least"), own.alias("own"))
    two = whole.where("a <> b").select("label", "dim", F.col("b").alias("node"), F.col("weight_a").alias("add"), F.col("least_a").alias("least"), own.alias("own"))
    ends = F.filter(F.sequence(F.lit(0), F.length("path")), lambda k: (k == F.length("path")) | F.substring("path", k + 1, F.lit(1)).isin("/", "#"))
    up = blocks.select(*_NODE, F.explode(F.transform(ends, lambda k: F.substring("path", F.lit(1), k))).alias("node"))
    met = stored(up.join(one.union(two), ["label", "dim", "node"]))
    total = met.groupBy(*_NODE).agg(F.sum("add").alias("add"), F.min("least").alias("least"), F.sum("own").alias("own"))
    edges = met.join(total.select(*_NODE, F.col("least").alias("to")), _NODE).where("least <> to").select(F.col("least").alias("a"), F.col("to").alias("b")).distinct()
    return stored(total), edges


def _compared(blocks: DataFrame, pairs: DataFrame, cosine: float, single: bool) -> DataFrame:
    """``kind`` 0: ``a, a2`` (a class) and ``b`` links; ``kind`` 1: ``a, b`` ids that are joined."""
    kind = np.float32 if single else np.float64

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("side")
        get = lambda k, c: np.frombuffer(f[c].iloc[k], np.int64)
        same, last = len(f) == 1, len(f) - 1
        n = [get(k, "n") for k in range(len(f))]
        x = [_unit(np.frombuffer(f["xs"].iloc[k], kind), len(n[k])) for k in range(len(f))]
        trees = [Tree.unpacked(raw) for raw in f["tree"]]
        links = [np.zeros(len(v), np.int64) for v in n]
        shift = 0 if same else len(n[0])
        label = np.arange(sum(len(v) for v in n))
        for (lo, hi), (lo2, hi2), hit in walk(x[0], trees[0], x[last], trees[last], cosine, same):
            own, other = n[0][lo:hi], n[last][lo2:hi2]
            if hit is None:
                within = same and (lo, hi) == (lo2, hi2)
                links[0][lo:hi] += other.sum() - own if within else other.sum()
                if not within:
                    links[last][lo2:hi2] += own.sum()
                i, j = np.r_[np.arange(lo, hi), np.full(hi2 - lo2, lo)], np.r_[np.full(hi - lo, lo2), np.arange(lo2, hi2)]
            else:
                links[0][lo:hi] += hit @ other
                links[last][lo2:hi2] += hit.T @ own
                i, j = np.nonzero(hit)
                i, j = i + lo, j + lo2
            merge(label, i, j + shift)
        while (label[label] != label).any():
            label = label[label]
        cid, cid2, rep = (np.concatenate([get(k, c) for k in range(len(f))]) for c in (*_CLASS, "rep"))
        count = np.concatenate(links)
        hit, tied = count > 0, label != np.arange(len(label))
        return pd.DataFrame({
            "kind": np.r_[np.zeros(hit.sum(), np.int32), np.ones(tied.sum(), np.int32)], "a": np.r_[cid[hit], rep[tied]],
            "a2": np.r_[cid2[hit], np.zeros(tied.sum(), np.int64)], "b": np.r_[count[hit], rep[label[tied]]],
        })

    side = lambda k, c: F.struct(F.lit(k).alias("side"), F.col(c).alias("path"))
    sides = pairs.withColumn("pair", F.concat_ws("|", "label", "dim", "a", "b"))
    sides = sides.select("pair", "label", "dim", F.explode(F.when(F.col("a") == F.col("b"), F.array(side(0, "a"))).otherwise(F.array(side(0, "a"), side(1, "b")))).alias("s"))
    dealt = sides.select("pair", "label", "dim", "s.side", "s.path").join(blocks, _NODE).drop(*_NODE)
    return dealt.groupBy("pair").applyInPandas(one, "kind int, a long, a2 long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vectors`` (``vec_id, embedding, label``).

    Rows are compared where labels are equal and not null and vectors have one length, in double
    precision. Vectors that are null, zero, or hold null or non-finite components, and rows without
    ``vec_id`` link with nothing; they are components of their own. A repeated row counts as another
    vector. Of rows with one id and different vectors each has its own links; they share a component.
    Vectors of a label are one class if their lengths and 128 bits of hash are equal.
    """
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull)
    v = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("x"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("x"))
    size = F.size("x")
    rows = v.withColumn("cid", F.when(usable, F.xxhash64("label", size, "x"))).withColumn("cid2", F.when(usable, F.xxhash64(F.lit("again"), size, "label", "x")))
    classes = stored(_classes(rows))
    members, levels = _top(classes)
    blocks = stored(_packed(members, levels, single))
    pairs, whole = _pairs(blocks, levels, cosine)
    found = stored(_compared(blocks, pairs, cosine, single))
    counts, edges = found.where("kind = 0").select(F.col("a").alias("cid"), F.col("a2").alias("cid2"), F.col("b").alias("links")), found.where("kind = 1").select("a", "b")
    if whole is not None and not whole.isEmpty():
        total, joined = _whole(blocks, whole)
        within = members.join(total, _NODE)
        counts = counts.union(within.select(*_CLASS, F.col("add") - F.col("own") * F.col("n")))
        edges = edges.union(joined).union(within.select("rep", "least"))
    links = counts.groupBy(*_CLASS).agg(F.sum("links").alias("links"))
    reach = components(edges).withColumnRenamed("node", "rep")
    info = classes.select(*_CLASS, "rep", "n").join(links, _CLASS, "left").join(reach, "rep", "left")
    info = stored(info.select(*_CLASS, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.select("vec_id", *_CLASS).join(info, _CLASS, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
