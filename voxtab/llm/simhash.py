"""Near-duplicates by SimHash fingerprints, compared on vertical bit planes.

Fingerprints within ``radius`` differing bits are linked. Equal fingerprints become one
class before anything else is shuffled, so a large group of copies costs one row for each
task. Two classes within the radius agree on at least ``r`` of ``2 r`` bit blocks; each
choice of ``r`` blocks is one key, and only classes with an equal key are compared. A key
with very many classes is divided again by the same rule on the bits that it leaves open,
until few bits are open, so that the size of a compared group has a bound that comes from
the number of open bits and not from the data. Within a group, 64 classes form one word
for each bit plane; the distances of a fingerprint to all 64 grow together in carry-save
counters, and a block is left as soon as all 64 have passed the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, shuffle_partitions, stored

BITS = 64
#: A key with more classes than this is divided again.
LARGE_KEY = 2048
_JOBS = 1 << 17


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """The majority of each bit over the XXH64 of all word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    total_ones, total, chunk = np.zeros(BITS, np.int64), 0, []
    for gram in grams:
        chunk.append(digest(gram, seed))
        if len(chunk) == 4096:
            total_ones += ones(np.array(chunk, np.uint64))
            total += len(chunk)
            chunk = []
    if chunk:
        total_ones += ones(np.array(chunk, np.uint64))
        total += len(chunk)
    return int(np.packbits(total_ones * 2 > total, bitorder="little").view(np.uint64)[0])


def ones(a: np.ndarray) -> np.ndarray:
    # Eight hashes are added at a time: byte lanes of a 64-bit word hold the counts of one bit position of each byte.
    lanes = np.empty((8, 8), np.int64)
    mask = np.uint64(0x0101010101010101)
    for k in range(8):
        bits = (a >> np.uint64(k)) & mask
        whole = np.add.reduceat(bits, np.arange(0, len(bits), 255))  # at most 255 to a byte lane
        lanes[:, k] = whole.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return lanes.reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) of each row; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.record_batch([batch.column(0), pa.array(np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def close_pairs(fp: np.ndarray, group: np.ndarray, radius: int):
    """Yield arrays of row pairs (later, earlier) of equal ``group`` within ``radius`` bits; ``group`` is sorted.

    ``fp`` holds one or more words of 64 bits for each row.
    """
    fp = fp.reshape(len(fp), -1)
    n = len(fp)
    if n < 2:
        return
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    start = np.repeat(first, size)
    within = np.arange(n) - start
    lane = (within % BITS).astype(np.uint64)
    block_first = np.flatnonzero(lane == 0)
    block_of = np.cumsum(lane == 0) - 1
    bits = BITS * fp.shape[1]
    one = lambda rows, p: (rows[:, p // BITS] >> np.uint64(p % BITS)) & np.uint64(1)
    planes = [np.bitwise_or.reduceat(one(fp, p) << lane, block_first) for p in range(bits)]
    ordinal = within // BITS
    jobs = np.where(np.repeat(size, size) > 1, ordinal + 1, 0)
    bounds = np.r_[0, np.cumsum(jobs)]
    at, full = 0, ~np.uint64(0)
    levels = int(radius + 1).bit_length()
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _JOBS, "right")) - 1)
        count = jobs[at:to]
        row = np.repeat(np.arange(at, to), count)
        at = to
        if not len(row):
            continue
        back = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        block = block_of[row] - back
        # Of its own block a row meets the earlier lanes; earlier blocks of the group are full.
        dead = np.where(back == 0, ~((np.uint64(1) << lane[row]) - np.uint64(1)), np.uint64(0))
        counters = [np.zeros(len(row), np.uint64) for _ in range(levels)]
        live = fp[row]
        for p in range(bits):
            carry = planes[p][block] ^ (np.uint64(0) - one(live, p))
            for k in range(levels):
                both = counters[k] & carry
                counters[k] ^= carry
                carry = both
            dead |= carry
            if p % 8 == 7:
                above, equal = np.zeros(len(row), np.uint64), np.full(len(row), full)
                for k in reversed(range(levels)):
                    if radius >> k & 1:
                        equal &= counters[k]
                    else:
                        above |= equal & counters[k]
                        equal &= ~counters[k]
                dead |= above
                alive = dead != full
                if not alive.all():
                    row, block, dead, live = row[alive], block[alive], dead[alive], live[alive]
                    counters = [c[alive] for c in counters]
                if not len(row):
                    break
        if len(row):
            job, bit = np.nonzero(np.unpackbits((~dead).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield row[job], block_first[block[job]] + bit


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of the pairs ``a``, ``b`` in ``label`` (each row points to a smaller row of its set)."""
    while len(a):
        while (label[label] != label).any():
            label[:] = label[label]
        x, y = label[a], label[b]
        far = x != y
        if not far.any():
            return
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def _choices(open_bits: list[int], radius: int) -> list[list[int]]:
    """For each choice of ``radius`` of ``2 radius`` blocks of the open bits: the bits of the chosen blocks."""
    blocks = [list(x) for x in np.array_split(np.array(open_bits), 2 * radius)]
    return [[int(p) for block in chosen for p in block] for chosen in combinations(blocks, radius)]


def _masks(radius: int) -> list[list[int]]:
    """Masks of the bits that must agree, by depth; the last depth leaves so few bits open that no key is large."""
    levels, now = [], [[]]
    while True:
        now = [fixed + more for fixed in now for more in _choices([p for p in range(BITS) if p not in fixed], radius)]
        levels.append([sum(1 << p for p in fixed) for fixed in now])
        if BITS - max(len(x) for x in now) <= 16 or len(now) > 300:
            return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _compared(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges between each class and the smallest row of its set, among classes of equal ``mask``, ``key``."""

    def run(batches):
        def solve(table):
            table = table.combine_chunks()
            rep, fp = table.column("rep").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
            mask, key = table.column("mask").to_numpy(), table.column("key").to_numpy()
            group = np.cumsum(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            # Sets are of classes, not of rows: a class that comes by several keys is joined once.
            reps, own = np.unique(rep, return_inverse=True)
            label = np.arange(len(reps))
            for a, b in close_pairs(fp, group, radius):
                merge(label, own[a], own[b])
            while (label[label] != label).any():
                label = label[label]
            far = label != np.arange(len(reps))
            return pa.record_batch([pa.array(reps[far]), pa.array(reps[label[far]])], ["a", "b"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 200_000:
                table = pa.Table.from_batches(held)
                mask, key = table.column("mask").to_numpy(), table.column("key").to_numpy()
                new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))
                cut = int(new[-1]) + 1 if len(new) else 0
                if cut:
                    yield solve(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield solve(pa.Table.from_batches(held))

    dealt = keyed.repartition(shuffle_partitions(keyed.sparkSession), "mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(run, "a long, b long")


def links(classes: DataFrame, radius: int = 2) -> DataFrame:
    """``a``, ``b``: edges that join all classes (``fp``, ``rep``) within ``radius`` bits, directly or through others."""
    levels, rest, found = _masks(radius), classes.select("rep", "fp"), None
    for depth, masks in enumerate(levels):
        if depth == 0:
            keyed = rest.select("rep", "fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
        else:
            finer = F.array(*(F.lit(_signed(m)) for m in masks))
            keyed = rest.select("rep", "fp", F.explode(F.filter(finer, lambda m: m.bitwiseAND(F.col("mask")) == F.col("mask"))).alias("mask"))
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        many = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        if depth < len(levels) - 1:
            many = stored(many)
            large = many.where(F.col("n") > LARGE_KEY).select("mask", "key")
            small = many.where(F.col("n") <= LARGE_KEY).select("mask", "key")
            edges = _compared(keyed.join(small, ["mask", "key"], "left_semi"), radius)
            found = edges if found is None else found.union(edges)
            if large.isEmpty():
                return found
            rest = stored(keyed.join(large, ["mask", "key"], "left_semi").select("rep", "fp", "mask"))
        else:
            return found.union(_compared(keyed, radius))
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """Fingerprint and component of each document.

    Returns ``doc_id``, ``fp`` (long), ``component_id`` (smallest ``doc_id`` reached by links).
    A null or empty text has fingerprint zero and is linked like any other; repeated rows give
    repeated rows; rows whose ``doc_id`` is null link with nothing and get a null component.
    """
    marks = stored(fingerprints(docs, shingle, seed))
    classes = stored(marks.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(links(classes, radius))
    mapped = stored(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id")))
    return marks.join(mapped, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
