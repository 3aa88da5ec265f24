"""Near-duplicates of word shingle sets: bit-sliced SimHash comparison, settled by the exact similarity.

Two texts are linked if their sets of five-word shingles are ``ALIKE`` (Jaccard) or more. Equal sets
become one node before anything else. Nodes meet by banded minimum hashes of their sets: a pair of
similarity s shares one of ``BANDS`` keys with probability ``1 - (1 - s ** ROWS) ** BANDS``, which is
0.99997 at 0.8 and depends neither on the size of the input nor on other texts. Nodes that meet are
compared by the SimHash of their sets, 256 bits in vertical planes (:func:`simhash.close_pairs`); at
similarity 0.8 two fingerprints differ by 39 bits in the mean, 48 for the smallest sets, with a
deviation of 6, so ``RADIUS`` loses less than one in a million; those of unlike sets differ by 128.
What is left is settled by whole sets.

All that meet need not be compared by whole sets, since links are wanted for their components only.
First each node is compared with the one of its neighbours that has most neighbours itself, then one
node of each component with those of the others; each of these rounds gives one pair a node and key
at most. Keys that still hold several components are then compared in full, in pairs of blocks of at
most ``BLOCK`` nodes with their sets, and a task gives back the edges of a forest. No key is left
out for its size, and no task or group grows with one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import components, forget, shuffle_partitions, stored

#: The least similarity of a link, as a fraction.
ALIKE = (4, 5)
#: Keys of a node, and minimum hashes in a key.
BANDS, ROWS = 20, 4
#: 64-bit words of a fingerprint, and bits in which fingerprints of alike sets may differ.
WORDS, RADIUS = 4, 80
#: Most nodes of one key that a task compares by fingerprints at once, and most that it compares by sets.
CROWD, BLOCK = 1024, 256
#: Rounds with one pair a node before keys are compared in full.
ROUNDS = 3
_COLUMNS = 8192


class _Digests(dict):
    """XXH64 of words, kept while there are not too many."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, self.seed)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def shingles(text: str | None, size: int, digests: _Digests) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, ascending; a shorter text is one run, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.array([digests[x] for x in words], np.uint64)
    size = min(size, len(w))
    run = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        run = run * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - size + 1 + k]
    return np.unique(_mixed(run))


_ODD = np.random.default_rng(1).integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
_TURN = np.random.default_rng(2).integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_MORE = np.random.default_rng(3).integers(0, 1 << 63, WORDS, np.uint64) << np.uint64(1) | np.uint64(1)


def band_keys(own: np.ndarray) -> np.ndarray:
    """One key for each band; sets of similarity s agree in a band with probability ``s ** ROWS``."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(own), 4096):
        np.minimum(least, ((own[at : at + 4096, None] ^ _TURN) * _ODD).min(axis=0), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least.reshape(BANDS, ROWS)[:, k])
    return keys.view(np.int64)


def wide_fingerprint(own: np.ndarray) -> np.ndarray:
    """``WORDS`` words, the majority of each bit over the set's shingles."""
    out = np.empty(WORDS, np.uint64)
    for k in range(WORDS):
        ones = sum((simhash.ones(_mixed(own[at : at + 65536] * _MORE[k])) for at in range(0, len(own), 65536)), np.zeros(64, np.int64))
        out[k] = np.packbits(ones * 2 > len(own), bitorder="little").view(np.uint64)[0]
    return out.view(np.int64)


def _groups(run, keys: list[str], rows: DataFrame, most: int, schema: str) -> DataFrame:
    """``run`` on Arrow tables of whole groups of ``keys``, of about ``most`` rows together."""

    def over(batches):
        def key(t):
            return np.stack([t.column(k).to_numpy() for k in keys])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                table = pa.Table.from_batches(held)
                own = key(table)
                new = np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0))
                cut = int(new[-1]) + 1 if len(new) else 0
                if cut:
                    yield run(table.slice(0, cut).combine_chunks(), own[:, :cut])
                held, n = table.slice(cut).to_batches(), table.num_rows - cut
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            yield run(table, key(table))

    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(over, schema)


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])


def _fingerprints(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(f"f{k}").to_numpy() for k in range(WORDS)], axis=1).view(np.uint64)


def _candidates(table: pa.Table, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group and two components whose sizes and fingerprints let them be alike."""
    p, q = ALIKE
    n, label = (table.column(c).to_numpy() for c in ("n", "label"))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for x, y in simhash.close_pairs(_fingerprints(table), group, RADIUS):
        ok = (label[x] != label[y]) & (np.minimum(n[x], n[y]) * q >= np.maximum(n[x], n[y]) * p)
        a.append(x[ok])
        b.append(y[ok])
    return np.concatenate(a), np.concatenate(b)


_FPS = [f"f{k}" for k in range(WORDS)]
_ROW = ["key", "node", "rep", "n", "label", *_FPS]


def _leading(rows: DataFrame) -> DataFrame:
    """``a, b, rep_a, rep_b``: each node with that of its neighbours in a key which has most neighbours, if more than itself."""

    def run(table, keys):
        a, b = _candidates(table, _numbered(keys))
        size = table.num_rows
        degree = np.bincount(a, minlength=size) + np.bincount(b, minlength=size)
        rank = np.empty(size, np.int64)
        rank[np.lexsort((np.arange(size), -degree))] = np.arange(size)
        best = np.arange(size)
        best_rank = rank.copy()
        for x, y in ((a, b), (b, a)):
            np.minimum.at(best_rank, x, rank[y])
        best = np.argsort(rank)[best_rank]
        own = np.flatnonzero(best != np.arange(size))
        node, rep = table.column("node"), table.column("rep")
        return pa.RecordBatch.from_arrays([c.take(pa.array(at)).combine_chunks() for c in (node, rep) for at in (own, best[own])], ["a", "b", "rep_a", "rep_b"])

    blocks = F.ceil(F.col("m") / F.lit(CROWD))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).select("block", *_ROW)
    found = _groups(run, ["key", "block"], dealt, 8192, "a binary, b binary, rep_a long, rep_b long")
    swap = F.col("a") > F.col("b")
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("rep_a", "rep_b"), ("rep_b", "rep_a"))]
    return found.select(*ends).distinct()


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``rep_a, rep_b`` of those of ``pairs`` whose sets are alike."""
    p, q = ALIKE

    def compare(batches):
        for batch in batches:
            ok = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(q * both >= p * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["rep_a", "rep_b"]).filter(pa.array(ok, pa.bool_()))

    first, second = (sets.select(F.col("node").alias(c), F.col("grams").alias(f"of_{c}")) for c in "ab")
    return pairs.join(first, "a").join(second, "b").select("rep_a", "rep_b", "of_a", "of_b").mapInArrow(compare, "rep_a long, rep_b long")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of ``sets`` share."""
    gram, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.cumsum(times > 1) - 1
    kept = times[at] > 1
    of, at = of[kept], column[at[kept]]
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int((times > 1).sum()), _COLUMNS):
        here = slice(*np.searchsorted(at, (lo, lo + _COLUMNS)))
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[of[here], at[here] - lo] = 1
        out += part @ part.T
    return out


def _in_full(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rep_a, rep_b``: a forest of the links between components within each key, by the components' smallest ids."""
    p, q = ALIKE

    def run(table, keys):
        group, own = _numbered(keys[:3]), table.column("own").to_numpy()
        a, b = _candidates(table, group)
        # Blocks of one pair meet each other; a block meets itself in a group of its own.
        ok = (own[a] != own[b]) | (keys[1][a] == keys[2][a])
        a, b = a[ok], b[ok]
        n, grams = table.column("n").to_numpy(), table.column("grams")
        # Components that are joined already stay one, so the forest is of components, not of nodes.
        known, part = np.unique(table.column("label").to_numpy(), return_inverse=True)
        label = np.arange(len(known))
        order = np.argsort(group[a], kind="stable")
        a, b = a[order], b[order]
        for at in np.split(np.arange(len(a)), np.flatnonzero(np.diff(group[a])) + 1) if len(a) else ():
            asked, ends = np.unique(np.concatenate((a[at], b[at])), return_inverse=True)
            both = _shared([np.frombuffer(x, np.uint64) for x in grams.take(pa.array(asked)).to_pylist()])[ends[: len(at)], ends[len(at) :]]
            alike = q * both >= p * (n[a[at]] + n[b[at]] - both)
            simhash.merge(label, part[a[at][alike]], part[b[at][alike]])
        while (label[label] != label).any():
            label = label[label]
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.record_batch([pa.array(known[far]), pa.array(known[label[far]])], ["rep_a", "rep_b"])

    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("long")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(*_ROW, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).join(sets, "node")
    return _groups(run, ["key", "lo", "hi"], dealt.select(*_ROW, "own", "lo", "hi", "grams"), 4 * BLOCK, "rep_a long, rep_b long")


def _relabelled(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``rep, label`` after new links: what is one component already is one node of the search for the larger ones."""
    for c in ("rep_a", "rep_b") if labels is not None else ():
        own = labels.select(F.col("rep").alias(c), F.col("label").alias("_label"))
        edges = edges.join(own, c, "left").withColumn(c, F.coalesce("_label", c)).drop("_label")
    found = components(edges, "rep_a", "rep_b")
    fresh = found.select(F.col("node").alias("rep"), F.col("component").alias("label"))
    if labels is None:
        return stored(fresh)
    known = labels.join(found, F.col("label") == F.col("node"), "left").select("rep", F.coalesce("component", "label").alias("label"))
    return stored(known.union(fresh.join(labels.select("rep"), "rep", "left_anti")))


def links(texts: DataFrame, classes: DataFrame, shingle: int, seed: int) -> DataFrame | None:
    """``rep_a, rep_b``: alike classes by their smallest ids, enough of them to join all that are, directly or through others."""

    def made(batches):
        digests = _Digests(seed)
        for batch in batches:
            own = [shingles(t, shingle, digests) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([_node(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], ["node", "grams"])

    keyed = classes.select("node", F.explode("bands").alias("key"))
    crowds = stored(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
    met = stored(keyed.join(crowds, "key").join(classes.select("node", "rep", "n", *_FPS), "node"))
    forget(crowds)
    asked = stored(met.select("node", "rep").distinct())
    sets = texts.join(asked.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text").mapInArrow(made, "node binary, grams binary")
    # An id can have several texts, and those can be anything.
    sets = stored(sets.join(asked.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    labels, done, searched = None, None, []
    for step in range(ROUNDS + 1):
        rows = met.withColumn("label", F.col("rep")) if labels is None else met.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        if labels is not None:
            rows = rows.join(rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key"), "key", "left_semi")
        if step < ROUNDS:
            if step:
                ones = rows.groupBy("key", "label").agg(F.min_by(F.struct("node", "rep", "n", *_FPS), F.xxhash64("node", F.lit(step))).alias("one"))
                rows = ones.select("key", "label", "one.*")
                rows = rows.join(rows.groupBy("key").agg(F.count("*").alias("m")), "key")
            pairs = _leading(rows)
            pairs = stored(pairs if done is None else pairs.join(done.select("a", "b"), ["a", "b"], "left_anti"))
            edges = stored(_alike(pairs, sets))
            done = pairs if done is None else done.union(pairs)
            searched.append(pairs)
        else:
            forget(*searched)
            rows = stored(rows)
            edges = stored(_in_full(rows, sets))
            forget(rows, sets, met, asked)
        if not edges.isEmpty():
            before, labels = labels, _relabelled(labels, edges)
            forget(before)
        forget(edges)
    return labels


def _node(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def near_duplicates(docs: DataFrame, shingle: int = 5, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, component_id`` of each row with an id; the component is the smallest ``doc_id`` reached by links.

    ``text_hash`` is ``xxhash64`` of the text (null: empty) and tells the texts of a repeated id apart.
    Texts without words are equal to each other. Repeated rows give repeated rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")

    def run(batches):
        digests = _Digests(seed)
        for batch in batches:
            sets = [shingles(t, shingle, digests) for t in batch.column(2).to_pylist()]
            prints = np.array([wide_fingerprint(x) for x in sets], np.int64).reshape(-1, WORDS)
            keys = [band_keys(x) if len(x) else np.empty(0, np.int64) for x in sets]
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate([*keys, np.empty(0, np.int64)])))
            own = [pa.array([_node(x) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int32()), *(pa.array(prints[:, k]) for k in range(WORDS)), bands]
            yield pa.record_batch([batch.column(0), batch.column(1), *own], ["doc_id", "text_hash", "node", "n", *_FPS, "bands"])

    schema = "doc_id long, text_hash long, node binary, n int, " + ", ".join(f"{f} long" for f in _FPS) + ", bands array<long>"
    marks = stored(texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema))
    firsts = [F.first(c).alias(c) for c in ("n", *_FPS, "bands")]
    classes = stored(marks.groupBy("node").agg(F.min("doc_id").alias("rep"), *firsts))
    labels = links(texts, classes, shingle, seed)
    mapped = classes.select("node", "rep")
    mapped = mapped.withColumn("component_id", F.col("rep")) if labels is None else mapped.join(labels, "rep", "left").withColumn("component_id", F.coalesce("label", "rep"))
    mapped = stored(mapped.select("node", "component_id"))
    forget(classes, labels)
    return marks.select("doc_id", "text_hash", "node").join(mapped, "node").select("doc_id", "text_hash", "component_id")


def _identified(docs: DataFrame) -> tuple[Column, Column]:
    """The id that rows are judged by, and their text's hash. Rows without an id get one from their text, above 2^62."""
    text_hash = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(1 << 62) + F.pmod(text_hash, F.lit(1 << 61))), text_hash


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that represent their group of near-duplicates: those whose ``doc_id`` is the smallest.

    Rows are judged one by one: of several texts under one id each goes or stays for itself. Rows
    that repeat both id and text are one document, of which one row stays; so do rows without an id
    that have equal texts. A row without an id gives way to any like row that has one.
    """
    own_id, text_hash = _identified(docs)
    ids = docs.select(own_id.alias("doc_id"), docs["text"])
    found = stored(near_duplicates(ids, **how))
    again = stored(found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    gone = stored(found.where("component_id < doc_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    forget(found)

    def among(other: DataFrame) -> Column:
        return (own_id == other["_id"]) & (text_hash == other["_hash"])

    kept = docs.join(gone, among(gone), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(again, among(again), "left_semi")
    number = F.row_number().over(Window.partitionBy(*(c for c in _identified(once))).orderBy(F.lit(1)))
    first = once.select(F.struct("*").alias("row"), number.alias("number")).where("number = 1").select("row.*")
    return kept.join(again, among(again), "left_anti").union(first)
