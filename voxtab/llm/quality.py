"""Quality by co-training two classifiers: one of the text's content, one of the page's metadata.

The content view is a linear model over hashed byte trigrams. The metadata view holds the given
length, language and source and what a page's layout shows: shares of kinds of characters, lines,
word lengths, words that follow themselves; each is binned, so a linear model over the bins can
follow any shape. Both start from the labelled documents; over some rounds each labels the
documents of an unlabelled pool of which it is surest, for the other to learn from. At the end
each view is calibrated on labelled documents that neither learned from, and the views are
combined to score all documents. Training takes bounded samples, on the driver; scoring runs on
whole texts in tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, chance

#: About so many labelled documents of each class, pool documents, and bytes of the texts of each of the two.
TRAINING_DOCUMENTS, POOL_DOCUMENTS, TRAINING_BYTES = 1200, 2000, 12 << 20
ROUNDS, SURE = 3, 0.95
#: Share of the pool that a view labels in a round, at most, for each class.
GROWTH = 0.15
GRAM_BITS = 15
#: Bins of a number end at these shares of the training documents; the tails, where junk is, are cut finely.
CUTS = (0.01, 0.02, 0.04, 0.07, 0.12, 0.2, 0.35, 0.5, 0.65, 0.8, 0.88, 0.93, 0.96, 0.98, 0.99, 0.995)
#: and at these values, for shares that are 0 in most documents.
SHARES = (0.01, 0.03, 0.06, 0.12, 0.25, 0.5)
BINS = len(CUTS) + len(SHARES)
_CHUNK = 1_500_000
NUMBERS = ("length", "given", "upper", "digits", "marks", "lines", "words", "again", "letters", "bars", "bangs", "signs")
#: Buckets of the language and of the source.
LANGS, SOURCES = 32, 128

_KIND = np.zeros(256, np.int8)  # 1 blank, 2 upper case, 3 digit, 4 mark, 5 other letter
_KIND[33:127] = 4
_KIND[48:58] = 3
_KIND[65:91] = 2
_KIND[97:123] = 5
_KIND[128:] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_SIGN = np.isin(np.arange(256), list(b"#$%&*<>@[]^{}~"))


class Page:
    """Both views of a list of documents ``(text bytes, lang, source, n_chars)``."""

    def __init__(self, rows: list[tuple]):
        raws = [r[0] for r in rows]
        self.n = len(rows)
        buf = np.frombuffer(b"\n\n" + b"".join(r + b"\n\n" for r in raws), np.uint8)
        size = np.array([len(r) for r in raws], np.int64)
        off = 2 + np.cumsum(size + 2) - size - 2
        code = buf[:-2].astype(np.uint32) | buf[1:-1].astype(np.uint32) << np.uint32(8) | buf[2:].astype(np.uint32) << np.uint32(16)
        # Trigrams from the one that ends with the first byte; a text's grams number its bytes.
        self.gram = (code * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS)).astype(np.int32)
        self.first, self.size = off - 2, size
        kind = _KIND[buf]
        n = np.maximum(size, 1)

        def share(flag):
            total = np.r_[0, np.cumsum(flag)]
            return (total[off + size] - total[off]).astype(np.float64)

        begin = (kind != 1) & np.r_[True, kind[:-1] == 1]
        start = np.flatnonzero(begin)
        end = np.flatnonzero((kind != 1) & np.r_[kind[1:] == 1, True]) + 1
        # A word's hash by prefix sums: bytes times powers of their place, taken back to a common start.
        again = np.zeros(len(buf), bool)
        if len(start) > 1:
            place = np.arange(len(buf)) - np.repeat(start, np.diff(np.r_[start, len(buf)])) if start[0] == 0 else np.r_[np.zeros(start[0], np.int64), np.arange(start[0], len(buf)) - np.repeat(start, np.diff(np.r_[start, len(buf)]))]
            power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
            total = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(np.where(kind != 1, buf, 0).astype(np.uint64) * power[np.minimum(place, 63)], out=total[1:])
            word = total[end] - total[start]
            again[start[1:]] = word[1:] == word[:-1]
            # In the content view a word that repeats the one before stands as one mark, not as new text.
            mark = np.zeros(len(buf) + 1, np.int8)
            mark[start[again[start]]] += 1
            mark[end[again[start]]] -= 1
            self.gram[np.cumsum(mark[: len(self.gram)]) > 0] = 0
        words = share(begin)
        given = np.array([-1.0 if r[3] is None else float(r[3]) for r in rows])
        self.numbers = np.stack([
            np.log1p(size), np.log1p(np.maximum(given, -0.5)), share(kind == 2) / n, share(kind == 3) / n, share(kind == 4) / n,
            share(buf == 10) / n * 100, n / np.maximum(words, 1), share(again) / np.maximum(words, 1), share(kind == 5) / n,
            share(buf == 124) / n, share(buf == 33) / n, share(_SIGN[buf]) / n,
        ], axis=1) if self.n else np.empty((0, len(NUMBERS)))
        crc = lambda s, m: 0 if s is None else 1 + zlib.crc32(s.encode("utf-8", "surrogatepass")) % (m - 1)
        self.named = np.array([(crc(r[1], LANGS), LANGS + crc(r[2], SOURCES)) for r in rows], np.int64).reshape(-1, 2)

    def content(self, w: np.ndarray) -> np.ndarray:
        """The mean weight of each text's trigrams; 0 for an empty text."""
        if not self.n:
            return np.empty(0)
        total = np.r_[0.0, np.cumsum(w[self.gram], dtype=np.float64)]
        return (total[self.first + self.size] - total[self.first]) / np.maximum(self.size, 1)

    def counts(self):
        """Of each text its trigrams and their shares; one empty trigram for an empty text."""
        for f, s in zip(self.first.tolist(), self.size.tolist()):
            ids, n = np.unique(self.gram[f : f + s], return_counts=True)
            yield (ids, (n / s).astype(np.float32)) if s else (np.zeros(1, np.int32), np.zeros(1, np.float32))


def binned(named: np.ndarray, numbers: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The columns of each document's metadata that are 1."""
    parts = [named]
    for k in range(len(NUMBERS)):
        parts.append((LANGS + SOURCES + k * (BINS + 1) + np.searchsorted(edges[k], numbers[:, k], "right"))[:, None])
    return np.concatenate(parts, axis=1)


def pages(rows: list[tuple]):
    """The rows in pages of about ``_CHUNK`` bytes."""
    at = 0
    while at < len(rows):
        to, total = at, 0
        while to < len(rows) and (to == at or total + len(rows[to][0]) <= _CHUNK):
            total += len(rows[to][0])
            to += 1
        yield at, to, Page(rows[at:to])
        at = to


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class View:
    """A linear model over columns with values; ``rows`` are lists of columns of each document."""

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray], width: int, ridge: float, rate: float):
        self.size = np.array([len(r) for r in rows])
        self.first = np.cumsum(self.size) - self.size
        self.column, self.value = np.concatenate(rows), np.concatenate(values).astype(np.float32)
        self.w, self.b, self.ridge, self.rate, self.width = np.zeros(width), 0.0, ridge, rate, width

    def logit(self) -> np.ndarray:
        return np.add.reduceat(self.w.astype(np.float32)[self.column] * self.value, self.first, dtype=np.float64) + self.b

    def fit(self, y: np.ndarray, weight: np.ndarray, steps: int) -> None:
        """Some steps of Adam on the weighted log loss; ``weight`` 0 leaves a document out."""
        a, s = np.zeros(self.width), np.zeros(self.width)
        a0 = s0 = 0.0
        weight = weight / weight.sum()
        for k in range(1, steps + 1):
            d = weight * (_sigmoid(self.logit()) - y)
            g = np.bincount(self.column, weights=np.repeat(d.astype(np.float32), self.size) * self.value, minlength=self.width) + self.ridge * self.w
            a, s = 0.9 * a + 0.1 * g, 0.99 * s + 0.01 * g * g
            a0, s0 = 0.9 * a0 + 0.1 * d.sum(), 0.99 * s0 + 0.01 * d.sum() ** 2
            self.w -= self.rate * (a / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-9)
            self.b -= self.rate * (a0 / (1 - 0.9**k)) / (np.sqrt(s0 / (1 - 0.99**k)) + 1e-9)


def calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that make ``logit`` a log odds on held-out labels."""
    x = np.clip(logit, -20, 20)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 0.5, 0.0
    for _ in range(200):
        p = _sigmoid(a * x + b)
        r, s = p - t, np.maximum(p * (1 - p), 1e-3)
        ga, gb = (r * x).sum() + 0.1 * (a - 1), r.sum() + 0.1 * b
        haa, hab, hbb = (s * x * x).sum() + 0.1, (s * x).sum(), s.sum() + 0.1
        det = haa * hbb - hab * hab
        a, b = a - np.clip((hbb * ga - hab * gb) / det, -0.5, 0.5), b - np.clip((haa * gb - hab * ga) / det, -2, 2)
    return max(float(a), 0.0), float(b)


def co_train(labelled: list[tuple], y: list[int], pool: list[tuple], share: float | None = None, seed: int = 5) -> dict:
    """A model from labelled documents (1 good, 0 bad), a pool without labels, and the usual share of good ones.

    With labels of one class only, all documents are of that class; with none, all are good.
    """
    y_all = np.array(y, np.float64)
    prior = float(np.clip(share if share is not None else (y_all.mean() if len(y_all) else 1.0), 0.02, 0.98))
    if not len(y_all) or y_all.min() == y_all.max():
        one = 5.0 if not len(y_all) or y_all[0] else -5.0
        return {"gram": np.zeros(1 << GRAM_BITS, np.float32), "edges": np.zeros((len(NUMBERS), BINS)), "meta": np.zeros(LANGS + SOURCES + len(NUMBERS) * (BINS + 1)), "b": (0.0, 0.0), "cal": ((0.0, one), (0.0, one)), "weights": (0.5, 0.5), "prior": 0.0}
    rng = np.random.default_rng(seed)
    numbers, named, columns, values = [], [], [], []
    for _, _, page in pages(labelled + pool):
        numbers.append(page.numbers)
        named.append(page.named)
        for ids, n in page.counts():
            columns.append(ids)
            values.append(n)
    numbers, named = np.concatenate(numbers), np.concatenate(named)
    n, known = len(columns), len(labelled)
    held = np.zeros(n, bool)
    held[:known] = rng.permutation(known) % 4 == 0
    for c in (0, 1):  # both classes are learned from and calibrated on
        own = np.flatnonzero(y_all == c)
        if held[own].all() or not held[own].any():
            held[own[:1]] = len(own) > 1
            held[own[1:2]] = False
    edges = np.stack([np.sort(np.r_[np.quantile(numbers[:, k], CUTS), SHARES]) for k in range(len(NUMBERS))])
    meta = binned(named, numbers, edges)
    content = View(columns, values, 1 << GRAM_BITS, 1e-6, 2.0)
    layout = View(list(meta), [np.ones(meta.shape[1])] * n, LANGS + SOURCES + len(NUMBERS) * (BINS + 1), 1e-3, 0.1)
    views = (content, layout)
    target = [np.r_[y_all, np.zeros(n - known)] for _ in views]
    weight = [np.r_[np.where(held[:known], 0.0, 1.0), np.zeros(n - known)] for _ in views]
    for k in (0, 1):  # classes weigh alike
        for c in (0, 1):
            own = (target[k] == c) & (weight[k] > 0)
            weight[k][own] /= own.sum()
    for r in range(ROUNDS + 1):
        for k, view in enumerate(views):
            view.fit(target[k], weight[k], 200 if r == 0 else 60)
        if r == ROUNDS or known == n:
            break
        for k, view in enumerate(views):
            logit = view.logit()[known:] + np.log(prior / (1 - prior))
            other = 1 - k
            for c, sure in ((1, _sigmoid(logit)), (0, _sigmoid(-logit))):
                free = np.flatnonzero((sure >= SURE) & (weight[other][known:] == 0))
                most = max(1, int(GROWTH * (n - known) * (prior if c else 1 - prior)))
                picked = known + free[np.argsort(-sure[free], kind="stable")[:most]]
                target[other][picked] = c
                weight[other][picked] = 0.5 / max(1, ((target[other] == c) & (weight[other] > 0)).sum())
    # Where a class has one label, none is held out, and the views are calibrated on what they learned from.
    used = held[:known] if len(np.unique(y_all[held[:known]])) == 2 else np.ones(known, bool)
    hy = y_all[used]
    logits = [v.logit()[:known][used] for v in views]
    cal = [calibrated(x, hy) for x in logits]
    odds = [a * np.clip(x, -20, 20) + b for x, (a, b) in zip(logits, cal)]
    # How much of each calibrated view the combination takes.
    grid = [(i / 4, j / 4) for i in range(5) for j in range(5) if i + j >= 4]
    loss = lambda w: -np.log(_sigmoid(np.where(hy == 1, 1, -1) * (w[0] * odds[0] + w[1] * odds[1]))).mean()
    best = min(grid, key=lambda w: (round(float(loss(w)), 9), abs(w[0] - w[1])))
    base = float(np.log(y_all.mean() / (1 - y_all.mean())))
    return {"gram": content.w.astype(np.float32), "edges": edges, "meta": layout.w, "b": (content.b, layout.b), "cal": tuple(cal), "weights": best, "prior": float(np.log(prior / (1 - prior))) - base}


def odds_of(m: dict, rows: list[tuple]) -> np.ndarray:
    """Log odds of good quality of ``(text bytes, lang, source, n_chars)`` rows."""
    out = np.empty(len(rows))
    for at, to, page in pages(rows):
        views = (page.content(m["gram"]) + m["b"][0], m["meta"][binned(page.named, page.numbers, m["edges"])].sum(axis=1) + m["b"][1])
        out[at:to] = sum(w * (a * np.clip(x, -20, 20) + b) for w, x, (a, b) in zip(m["weights"], views, m["cal"])) + m["prior"]
    return out


_COLUMNS = ("text", "lang", "source", "n_chars")


def _rows(columns) -> list[tuple]:
    texts, lang, source, n = (c.to_pylist() for c in columns)
    return [((t or "").encode("utf-8", "surrogatepass"), a, s, k) for t, a, s, k in zip(texts, lang, source, n)]


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS, pool: int = POOL_DOCUMENTS, longest: int = TRAINING_BYTES) -> dict:
    """A model from about ``most`` labelled documents of each class and ``pool`` others, chosen by a hash of their ids.

    Texts of every length take part, those of the labelled and those of the others with about
    ``longest`` bytes. A document with several labels takes part with the better one; rows without
    an id or a label of 0 or 1 do not count as labelled.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = lambda c: F.lit(most / max(1, sizes.get(c, 0)))
    chosen = known.where(chance("doc_id", F.lit("quality")) < F.when(F.col("y") == 1, part(1)).otherwise(part(0)))
    d = docs.select(F.col("doc_id").cast("long"), *(F.col(c) for c in _COLUMNS))
    total = d.count()
    # About 2 * most rows of two numbers, and about ``pool`` documents, whatever the size of the input.
    rows = bounded(d.join(F.broadcast(chosen), "doc_id").select("doc_id", *_COLUMNS, "y"), longest)
    others = bounded(d.where(chance("doc_id", F.lit("pool")) < F.lit(pool / max(1, total))).select("doc_id", *_COLUMNS), longest)
    mine = {r["doc_id"] for r in rows}
    row = lambda r: ((r["text"] or "").encode("utf-8", "surrogatepass"), r["lang"], r["source"], r["n_chars"])
    order = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    rows, others = sorted(rows, key=order), sorted((r for r in others if r["doc_id"] not in mine), key=order)
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    return co_train([row(r) for r in rows], [r["y"] for r in rows], [row(r) for r in others], good / (good + bad) if good + bad else None)


def score(docs: DataFrame, m: dict) -> DataFrame:
    """``doc_id, quality, keep`` of every row: the combined probability of good quality, and whether it is at least a half.

    Null texts count as empty, and each null of the metadata as a value of its own. Repeated rows
    give repeated rows.
    """

    def run(batches):
        for batch in batches:
            p = _sigmoid(odds_of(m, _rows(batch.columns[1:])))
            yield pa.record_batch([batch.column(0), pa.array(p, pa.float64()), pa.array(p >= 0.5)], ["doc_id", "quality", "keep"])

    kinds = ("string", "string", "string", "long")
    return docs.select(F.col("doc_id").cast("long"), *(F.col(c).cast(k) for c, k in zip(_COLUMNS, kinds))).mapInArrow(run, "doc_id long, quality double, keep boolean")


def kept(docs: DataFrame, m: dict) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; each row is judged by itself."""

    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            p = odds_of(m, _rows([rows.field(c).cast(k) for c, k in zip(_COLUMNS, kinds)]))
            yield batch.filter(pa.array(p >= 0))

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, T.StructType([T.StructField("row", docs.schema)])).select("row.*")
