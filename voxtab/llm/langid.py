"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams of one to three letters (words
padded with a blank). A document's own list is compared to each profile by the out-of-place
distance: the sum, over the document's n-grams, of how far their rank is from the rank in the
profile, or the length of a profile where it lacks the n-gram.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import chance, stored

RANKS = 300
#: About so many training documents of each language are counted; they are chosen by a hash of the id.
TRAINING_DOCUMENTS = 4000
_BLANK = 32
#: Bits of a code point; an n-gram is the code points of its letters, one after another.
_POINT = 21


@cache
def _letters() -> np.ndarray:
    """For each code point itself where it is a letter, else a blank."""
    points = np.arange(sys.maxunicode + 1, dtype=np.int64)
    return np.where([chr(p).isalpha() for p in points], points, _BLANK)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams and how often each occurs; empty for a text without letters."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.concatenate(([_BLANK], _letters()[raw], [_BLANK]))
    c = c[np.r_[True, (c[1:] != _BLANK) | (c[:-1] != _BLANK)]]
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = c[:-1] << _POINT | c[1:]
    codes = np.concatenate((c[c != _BLANK], two, two[:-1] << _POINT | c[2:]))
    codes.sort()
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.diff(np.r_[first, len(codes)])


def ranked(codes: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent codes, ties by code (which ascend)."""
    if len(codes) > ranks:
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:ranks]]


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def profiles(docs: DataFrame, ranks: int = RANKS, training_documents: int = TRAINING_DOCUMENTS) -> list[tuple[str, list[int]]]:
    """``(language, its codes by rank)`` by language, learned from the rows that are not held out.

    The driver gets ``ranks`` numbers for each language that occurs.
    """
    known = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    part = F.lit(training_documents) / F.count("*")
    share = stored(known.groupBy("lang").agg(part.alias("share")))
    part = known.join(share, "lang").where(chance("doc_id", F.lit("lang")) < F.col("share")).select("lang", "text")

    def run(batches):
        totals: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = totals.setdefault(lang, {})
                for code, n in zip(*(x.tolist() for x in ngrams(text))):
                    own[code] = own.get(code, 0) + n
        for lang, own in totals.items():
            yield pa.record_batch([pa.array([lang] * len(own)), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], ["lang", "code", "n"])

    counts = part.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    found: dict[str, list[int]] = {}
    for row in counts.withColumn("rank", rank).where(F.col("rank") <= ranks).orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["code"])
    return sorted(found.items())


def predict(docs: DataFrame, known: list[tuple[str, list[int]]], ranks: int = RANKS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from its whole text.

    ``und`` with score 0 for a null text, a text without letters, or where nothing was learned.
    The score is 1 less the distance as a share of the largest possible one. Ties go to the
    language that is first by code point.
    """
    names = [name for name, _ in known]
    codes = np.unique(np.concatenate([np.array(c, np.int64) for _, c in known])) if known else np.empty(0, np.int64)
    place = np.full((len(codes) + 1, len(names)), -1, np.int64)
    for k, (_, own) in enumerate(known):
        place[np.searchsorted(codes, own), k] = np.arange(len(own))

    def one(text):
        own, counts = ngrams(text)
        if not len(own) or not names:
            return "und", 0.0
        own = ranked(own, counts, ranks)
        at = np.searchsorted(codes, own)
        at[at == len(codes)] = 0
        at = np.where(codes[at] == own, at, len(codes))
        there = place[at]
        far = np.where(there < 0, ranks, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(far.argmin())
        return names[best], float(1 - far[best] / (ranks * len(own)))

    def run(batches):
        for batch in batches:
            out = [one(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
