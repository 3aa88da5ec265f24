"""Periodic runs of words by a sparse diagonal dynamic program.

A diagonal is a lag ``q``: on it word ``i`` is laid beside word ``i - q``. A run of period ``q`` and at
least four periods is a stretch of the diagonal on which at least ``3 q`` words in a row match. The
program reads the words once. For each word its earlier occurrences extend the match lengths of the
lags that are active; a lag that a word does not extend ends there, and if its matches suffice, the
run is emitted at that word.

Which earlier occurrences can matter is known beforehand, so that frequent words do not open one lag
for each time they occurred. A run whose period lies in the octave ``[L, 2 L)`` matches ``3 L`` words in
a row from each place at which its diagonal can begin, so only occurrences of the word together with
its ``3 L - 1`` followers count in that octave. Of these it is enough to take the last one: were there a
nearer one within the octave or below, at a distance ``d < q``, the gram would have the periods ``q - d``
and ``q`` (or ``d`` and ``q``), whose sum is at most its own length, hence their greatest common divisor, and
``q`` would not be the smallest period of the run. So each word has at most one earlier occurrence in
each octave, a document of ``n`` words takes O(n log n) steps whatever it repeats, and a stretch with a
smaller period never shows up under a multiple of it. Grams get numbers by doubling; one that occurs
once in its document is dropped, which leaves few places after the first octaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are handled together up to about so many bytes; a longer text alone.
TOGETHER = 4_000_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _numbered(keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for each key that occurs more than once, by place; -1 elsewhere."""
    out = np.full(size, -1, np.int64)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        first = np.r_[True, ~same]
        twice = np.r_[same, False] | np.r_[False, same]
        out[at[order[twice]]] = (np.cumsum(first) - 1)[twice]
    return out


def _pairs(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which ``a`` is followed by a ``b`` after ``step`` words, and keys of the two."""
    at = np.flatnonzero((a[:-step] >= 0) & (b[step:] >= 0)) if step < len(a) else np.empty(0, np.int64)
    return at, a[at] * (len(a) + 1) + b[at + step]


def occurrences(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place, lag, gram``: the earlier occurrences that can belong to a run, in the order of the places.

    ``gram`` is the number of words that are known to match from the place on.
    """
    size, found = len(words), []
    one, step = _numbered(words, np.arange(size), size), 1
    while (one >= 0).any():
        at, keys = _pairs(one, one, step)
        two = _numbered(keys, at, size)
        at, keys = _pairs(two, one, 2 * step)
        order = np.argsort(keys, kind="stable")
        lag = np.diff(at[order])
        near = np.flatnonzero((keys[order[1:]] == keys[order[:-1]]) & (lag >= step) & (lag < 2 * step))
        found.append((at[order[1:]][near], lag[near], np.full(len(near), 3 * step)))
        one, step = two, 2 * step
    place, lag, gram = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    order = np.argsort(place, kind="stable")
    return place[order], lag[order], gram[order]


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs in a sequence of word numbers, by start and period."""
    out: list[tuple[int, int, int]] = []
    active: dict[int, list[int]] = {}

    def end(lag: int) -> None:
        began, last, gram = active.pop(lag)
        matches = last - began + gram
        if matches + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            out.append((began - lag, matches + lag, lag))

    for i, lag, gram in zip(*(c.tolist() for c in occurrences(words))):
        for other in [q for q, diagonal in active.items() if diagonal[1] < i - 1]:
            end(other)
        diagonal = active.get(lag)
        if diagonal is None:
            active[lag] = [i, i, gram]
        else:
            diagonal[1] = i
    for lag in list(active):
        end(lag)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _together(texts: list[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words and the runs of each text. Words are numbered by text, and a word that occurs nowhere else stands between texts."""
    numbers, starts, words_of, base = [], [], [], 0
    for text in texts:
        words = text.split()
        known: dict[bytes, int] = {}
        starts.append(len(numbers))
        numbers += [known.setdefault(w, base + len(known)) for w in words]
        base += len(known) + 1
        numbers.append(base - 1)
        words_of.append(words)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    whole = runs(np.array(numbers, np.int64))
    for (start, length, period), k in zip(whole, np.searchsorted(starts, [r[0] for r in whole], side="right") - 1):
        found[k].append((start - starts[k], length, period))
    return list(zip(words_of, found))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without the repeats: of each run its first period stays, unless another run drops it."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if found else b" ".join(words)


def _of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    found, kept, group, size = [], [], [], 0
    for k, text in enumerate(texts):
        group.append(text)
        size += len(text)
        if size >= TOGETHER or k == len(texts) - 1:
            for words, of in _together(group):
                found.append([{"start": s, "length": n, "period": p} for s, n, p in of])
                kept.append(collapsed(words, of).decode())
            group, size = [], 0
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row of ``docs``.

    ``runs`` holds every maximal stretch of words with smallest period ``q`` that has at least
    ``max(6, 4 q)`` words, by start and period; ``collapsed`` the words that no run repeats, joined by one
    space. Words are runs of anything but ASCII white space. A null or empty text, or one of blanks
    only, has no runs and an empty ``collapsed``. Each row is judged by itself, so repeated rows and ids
    give repeated results, a null id stays null, and columns other than ``doc_id`` and ``text`` are not
    read. A text is held by one task; no text meets another.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Small pieces keep what a task holds small, however many rows Spark sends at once.
            for at in range(0, batch.num_rows, 1_000):
                yield _of_batch(batch.slice(at, 1_000))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(one, f"doc_id bigint, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a period written into every tenth text, as a test of the search on real words.

    Of a text of ``n`` words whose ``h = crc32(doc_id)`` is divisible by 10, the words from ``a = g mod n`` on
    become repeats of the ``p = 1 + (n - a) div (3 + g mod 8)`` words there, with ``g = h div 10``. Rows
    without an id and texts without words stay as they are.
    """
    words = F.when(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.regexp_extract_all(text_of(), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), words.alias("_words"))
    d = d.withColumn("_g", F.floor(F.crc32(F.col("doc_id").cast("string")) / 10)).withColumn("_n", F.size("_words"))
    d = d.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    d = d.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = F.col("_n") - F.col("_a")
    again = F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    made = F.array_join(F.concat(F.slice("_words", 1, F.col("_a")), F.slice(again, 1, rest)), " ")
    return d.select("doc_id", F.when(F.col("_n") > 0, made).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest exponent and checksums of what :func:`periodic_runs` gives."""
    better = "(a, b) -> CASE WHEN a.length * b.period <> b.length * a.period THEN CASE WHEN a.length * b.period > b.length * a.period THEN -1 ELSE 1 END WHEN a.start <> b.start THEN CASE WHEN a.start < b.start THEN -1 ELSE 1 END WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END"
    best = F.get(F.expr(f"array_sort(runs, {better})"), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
