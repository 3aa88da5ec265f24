"""Benchmark decontamination: rare n-gram seeds join training passages to items, Smith-Waterman scores them.

Seeds are pairs of neighbouring words of an item. All documents are counted first, and an item keeps
its rarest pairs: so many that no alignment which reaches the score can avoid them all. An alignment
of ``n`` words with score ``R`` (a match gives 2, any other step costs 1) takes at least
``(2 (R - 2) - (n - 1)) / 3`` of the ``n - 1`` pairs over into the document, next to each other or
with one word between: steps from match to match that skip nothing in the item and at most one word
in the document gain up to 2, those that skip one word of the item gain 1 and use two of its words,
and no other step gains anything. So the most frequent pairs, one fewer than that number, are left
out, and nothing is lost by it; no seed is dropped for being frequent beyond that.

Documents are mapped twice (counts, then passages that hold seeds) and never shuffled; what is
shuffled are seeds, their places, and the passages around them, once for each different text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, stored

#: An item is found where the alignment's score is this share of a full match or more.
SIMILARITY = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items of fewer words are not searched; an alignment has at least the score of LEAST_MATCHED words, or of the whole item.
LEAST_WORDS, LEAST_MATCHED = 3, 4
#: Words of a text that share a passage (more where items are longer).
PASSAGE_WORDS = 256
#: The filter of seeds that documents are read against: bits for each seed, and its bounds as powers of two (512 kB to 32 MB).
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 64, 22, 28
#: Up to so many seeds (32 bytes each) are broadcast to their places; more are joined by a shuffle.
SEEDS_BROADCAST = 1 << 18
#: Characters of texts that are cut into words together.
GROUP_CHARS = 1 << 20
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A number for each character of a word (zero for others), and one for each place in it."""

    def mixed(n: int) -> np.ndarray:
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)

    letters = np.fromiter((c == 95 or chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return np.where(letters, mixed(0x110000) | np.uint64(1), np.uint64(0)), mixed((1 << 16) + 0x110000)[0x110000:]


def _hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a lower-case text, and where they start."""
    letters, places = _tables()
    value = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    inside = np.concatenate([[False], value != 0])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    if not len(starts):
        return np.empty(0, np.int64), starts
    value = value[starts[0] :]
    place = np.arange(len(value)) - np.repeat(starts - starts[0], np.diff(starts, append=starts[0] + len(value)))
    value *= places[place & 0xFFFF] + (place >> 16).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD92)
    return np.add.reduceat(value, starts - starts[0]).view(np.int64), starts


def hashes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all ``texts`` as 64-bit hashes, and for each word the number of its text. Words are those of :func:`words_of`."""
    lower = [(t or "").lower() for t in texts]
    words, starts = _hashed("\n".join(lower))
    ends = np.cumsum([len(t) + 1 for t in lower])
    return words, np.searchsorted(ends, starts, "right")


def _pieces(*columns: pa.Array):
    """The rows of a batch in pieces whose texts (the last column) have some GROUP_CHARS characters."""
    begin, size = 0, 0
    texts = columns[-1].to_pylist()
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= GROUP_CHARS or k + 1 == len(texts):
            yield *(c.slice(begin, k + 1 - begin) for c in columns[:-1]), *hashes_of(texts[begin : k + 1])
            begin, size = k + 1, 0


def pair_codes(w: np.ndarray, skip: int = 0) -> np.ndarray:
    """Codes of the words ``i`` and ``i + 1 + skip``."""
    k = 1 + skip
    return w[:-k] * np.int64(-7046029254386353131) + w[k:] if len(w) > k else np.empty(0, np.int64)


def least_score(n: int, similarity: float) -> int:
    """The score from which an item of ``n`` words is found."""
    return max(int(np.ceil(MATCH * n * similarity - 1e-9)), MATCH * min(n, LEAST_MATCHED))


def seeds_of(n: int, similarity: float) -> int:
    """How many of the ``n - 1`` pairs have to be seeds so that no alignment with the least score avoids them."""
    shared = -(-(2 * (least_score(n, similarity) - 2) - (n - 1)) // 3)
    return n - 1 - shared + 1


def reach(n: int, similarity: float) -> int:
    """Words of a document that an alignment with the least score spans at most."""
    return n + MATCH * n - least_score(n, similarity)


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two arrays of words, and the first place in ``window`` where it is reached."""
    at = np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        t = np.zeros(len(window) + 1, np.int64)
        t[1:] = row[:-1] + np.where(window == word, MATCH, MISMATCH)
        np.maximum(t, row + GAP, out=t)
        np.maximum(t, 0, out=t)
        row = np.maximum.accumulate(t - GAP * at) + GAP * at
        top = int(row.argmax())
        if row[top] > best or row[top] == best and top < end:
            best, end = int(row[top]), top
    return best, end


def shared(item: np.ndarray, window: np.ndarray) -> int:
    """How many words the two share, with repeats: no alignment matches more."""
    kinds, count = np.unique(item, return_counts=True)
    at = np.searchsorted(kinds, window)
    at[at == len(kinds)] = 0
    return int(np.minimum(np.bincount(at[kinds[at] == window], minlength=len(kinds)), count).sum())


def _items(benchmark: DataFrame, similarity: float) -> DataFrame:
    """``item, item_id, words, least, reach, seeds``: one row for each different item that is searched."""
    b = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null").distinct()
    kinds = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("words", pa.list_(pa.int64())), ("least", pa.int32()), ("reach", pa.int32()), ("seeds", pa.int32())])

    def run(batches):
        for batch in batches:
            out = []
            for item, i, text in zip(*(c.to_pylist() for c in batch.columns)):
                w, _ = hashes_of([text])
                if (n := len(w)) >= LEAST_WORDS:
                    out.append({"item": item, "item_id": i, "words": w, "least": least_score(n, similarity), "reach": reach(n, similarity), "seeds": seeds_of(n, similarity)})
            yield pa.RecordBatch.from_pylist(out, kinds)

    b = b.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    return stored(b.mapInArrow(run, "item long, item_id long, words array<long>, least int, reach int, seeds int"))


def _pairs_of_items(items: DataFrame) -> DataFrame:
    """``item, at, gram`` of every pair of neighbouring words."""

    def run(batches):
        for batch in batches:
            out = [(i, k, c) for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k, c in enumerate(pair_codes(np.array(w, np.int64)).tolist())]
            yield pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.int64())], ["item", "at", "gram"])

    return items.select("item", "words").mapInArrow(run, "item long, at int, gram long")


class Filter:
    """Two bits for each gram in an array of bounded size; the array is put together by Spark, 64 bits to a row."""

    def __init__(self, grams: DataFrame):
        g = grams.select("gram").distinct()
        self.power = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_BITS * g.count()).bit_length()))
        mask = F.lit((1 << self.power) - 1)
        bit = g.select(F.explode(F.array(F.col("gram").bitwiseAND(mask), F.shiftrightunsigned("gram", 32).bitwiseAND(mask))).alias("bit"))
        words = bit.groupBy(F.shiftright("bit", 6).alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
        self.bits = np.zeros(1 << (self.power - 6), np.int64)
        self.bits[words["k"].to_numpy()] = words["bits"].to_numpy()

    def holds(self, codes: np.ndarray) -> np.ndarray:
        mask = np.int64((1 << self.power) - 1)
        a, b = codes & mask, codes.view(np.uint64) >> np.uint64(32)
        b = b.view(np.int64) & mask
        return (self.bits[a >> 6] >> (a & 63) & self.bits[b >> 6] >> (b & 63) & 1).astype(bool)


def _places(words: np.ndarray, row: np.ndarray, skip: int, known: Filter) -> np.ndarray:
    """Where pairs that the filter holds stand within one text."""
    at = np.flatnonzero(known.holds(pair_codes(words, skip)))
    return at[row[at] == row[at + 1 + skip]]


def _texts(docs: DataFrame) -> DataFrame:
    """``a, b, text``: the text and two hashes of it, by which it is known."""
    text = F.col("text").cast("string")
    return docs.select(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), text.alias("text"))


def _counts(texts: DataFrame, known: Filter) -> DataFrame:
    """``gram, places``: in how many places of all texts the pairs stand, next to each other or with a word between."""
    held = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        known = held.value
        for batch in batches:
            codes = [np.empty(0, np.int64)]
            for w, row in _pieces(batch.column(0)):
                for skip in (0, 1):
                    codes.append(pair_codes(w, skip)[_places(w, row, skip, known)])
            grams, places = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.record_batch([pa.array(grams, pa.int64()), pa.array(places, pa.int64())], ["gram", "places"])

    return texts.select("text").mapInArrow(run, "gram long, places long").groupBy("gram").agg(F.sum("places").alias("places"))


def _passages(texts: DataFrame, known: Filter, radius: int) -> DataFrame:
    """``a, b, block, first, words, hits``: passages with ``radius`` words around the places at which seeds may stand."""
    held = texts.sparkSession.sparkContext.broadcast(known)
    size = max(PASSAGE_WORDS, radius)
    hit = pa.struct([("gram", pa.int64()), ("place", pa.int32())])
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("block", pa.int32()), ("first", pa.int32()), ("words", pa.list_(pa.int64())), ("hits", pa.list_(hit))])

    def run(batches):
        known = held.value
        for batch in batches:
            out, n = [], 0
            for a, b, w, row in _pieces(*batch.columns):
                p, q = _places(w, row, 0, known), _places(w, row, 1, known)
                at, gram = np.concatenate([p, q]), np.concatenate([pair_codes(w)[p], pair_codes(w, 1)[q]])
                order = np.argsort(at, kind="stable")
                at, gram = at[order], gram[order]
                begins = np.searchsorted(row, np.arange(len(a) + 1))
                place = at - begins[row[at]]
                cut = np.flatnonzero(np.diff(row[at]) | np.diff(place // size)) + 1
                for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
                    if i == j:
                        continue
                    r, own = int(row[at[i]]), place[i:j]
                    first = max(0, int(own[0]) - radius)
                    words = w[begins[r] + first : min(begins[r + 1], at[j - 1] + radius + 2)]
                    hits = [{"gram": g, "place": k} for g, k in zip(gram[i:j].tolist(), own.tolist())]
                    out.append({"a": a[r].as_py(), "b": b[r].as_py(), "block": int(own[0]) // size, "first": first, "words": words, "hits": hits})
                    n += len(words) + len(hits)
                if n > 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, kinds)
                    out, n = [], 0
            yield pa.RecordBatch.from_pylist(out, kinds)

    return texts.mapInArrow(run, "a long, b long, block int, first int, words array<long>, hits array<struct<gram:long,place:int>>")


def _aligned(pairs: DataFrame) -> DataFrame:
    """``a, b, item_id, score, end_word`` of the rows of ``pairs`` whose alignment reaches the least score."""
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for a, b, lo, hi, first, words, i, item, least, far in zip(*batch.columns):
                own, far, first = item.values.to_numpy(), far.as_py(), first.as_py()
                begin = max(0, lo.as_py() - far - first)
                window = words.values.to_numpy()[begin : hi.as_py() + far + 2 - first]
                if MATCH * shared(own, window) >= least.as_py():
                    score, end = align(own, window)
                    if score >= least.as_py():
                        out.append({"a": a.as_py(), "b": b.as_py(), "item_id": i.as_py(), "score": score / (MATCH * len(own)), "end_word": first + begin + end})
            yield pa.RecordBatch.from_pylist(out, kinds)

    columns = pairs.select("a", "b", "lo", "hi", "first", "words", "item_id", "item_words", "least", "reach")
    return columns.mapInArrow(run, "a long, b long, item_id long, score double, end_word long")


def found_texts(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seeds_broadcast: int = SEEDS_BROADCAST) -> DataFrame:
    """``a, b, item_id, score, end_word``, stored: the best place of each item in each different text, where it is found."""
    if not 0.5 <= similarity <= 1:
        raise ValueError("below a similarity of one half no seeds are sure to meet, and above one nothing is found")
    texts = _texts(docs).where("text is not null")
    items = _items(benchmark, similarity)
    every = stored(_pairs_of_items(items))
    counts = stored(_counts(texts, Filter(every)))
    ranked = every.join(counts, "gram", "left").join(items.select("item", "seeds"), "item")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("places", F.lit(0)), "gram", "at"))
    seeds = stored(ranked.withColumn("rank", rank).where("rank <= seeds").select("item", "gram").distinct())
    radius = items.agg(F.max("reach")).first()[0] or 0
    passages = stored(_passages(texts, Filter(seeds), radius))
    hits = passages.select("a", "b", "block", F.inline("hits"))
    small = seeds.count() <= seeds_broadcast
    met = hits.join(F.broadcast(seeds) if small else seeds.hint("merge"), "gram").groupBy("a", "b", "block", "item").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
    once = passages.select("a", "b", "block", "first", "words").dropDuplicates(["a", "b", "block"])
    pairs = met.join(once, ["a", "b", "block"]).join(items.withColumnRenamed("words", "item_words"), "item")
    best = F.max(F.struct("score", (-F.col("end_word")).alias("end"))).alias("best")
    found = stored(_aligned(pairs).groupBy("a", "b", "item_id").agg(best).select("a", "b", "item_id", "best.score", (-F.col("best.end")).alias("end_word")))
    forget(items, every, counts, seeds, passages)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seeds_broadcast: int = SEEDS_BROADCAST) -> DataFrame:
    """``doc_id, item_id, score, end_word``: each benchmark item found in each document.

    The score is that of the best local alignment with the whole text, as a share of a full match, and
    ``end_word`` counts the words up to its first end. Items whose best alignment has at least
    ``similarity`` and the score of four matched words (a whole shorter item) are found, all of them.
    Null texts and items hold nothing; items of fewer than three words cannot be told from ordinary
    use and are not searched. Rows that repeat a document give repeated rows; an ``item_id`` with
    several texts gives its best one.
    """
    text = F.col("text").cast("string")
    keys = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    return keys.join(found_texts(docs, benchmark, similarity, seeds_broadcast), ["a", "b"]).select("doc_id", "item_id", "score", "end_word")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seeds_broadcast: int = SEEDS_BROADCAST) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns. Rows are judged by their own text, with or without an id."""
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct("*").alias("row")).select("row", F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    found = found_texts(docs, benchmark, similarity, seeds_broadcast)
    gone = stored(found.select("a", "b").distinct())
    forget(found)
    return rows.join(gone, ["a", "b"], "left_anti").select("row.*")
