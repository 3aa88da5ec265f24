"""Toxicity with a bidirectional gated recurrent network and attention pooling, in numpy.

Each word enters as two vectors: one of the word itself (hashed) and the mean of those of its
character 4-grams (hashed), so that inflected or unseen forms of a known stem are recognised.
Two gated recurrent layers read a window of words from both ends; attention weighs the states
of the window's words and one output unit scores it. A document is scored by its worst
window; windows overlap by half and cover the whole text. Vectors and network are learned
together from the labels of documents: in each step the window that the network scores worst
stands for its document. The network is trained on a bounded sample of labelled documents, on
the driver, and calibrated on some that it did not learn from; scoring runs on all documents in
tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, chance

#: Words of a window and from one window's start to the next.
WINDOW, STRIDE = 48, 24
WORD_BITS, GRAM_BITS, WIDTH, HIDDEN = 18, 16, 8, 12
#: About so many labelled documents of each class are learned from, and so many bytes of their texts.
TRAINING_DOCUMENTS, TRAINING_BYTES = 2000, 16 << 20
#: Steps, documents in a step, windows of a document from which a step takes the worst (drawn anew in each step).
STEPS, BATCH, WINDOWS = 400, 48, 24
#: Learning rate of the vectors, share of inputs left out, share of the documents kept for calibration.
RATE, DROPPED, CALIBRATION = 0.2, 0.2, 0.1
_CHUNK = 1_500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[97:123] = True
_IS_WORD[128:] = True


def _parts(raws: list[bytes]):
    """Ranges of texts of about ``_CHUNK`` bytes together."""
    at = 0
    while at < len(raws):
        to, total = at, 0
        while to < len(raws) and (to == at or total + len(raws[to]) <= _CHUNK):
            total += len(raws[to])
            to += 1
        yield at, to
        at = to


class Words:
    """The words of texts laid end to end: their hashes, and those of their character 4-grams."""

    def __init__(self, raws: list[bytes]):
        buf = np.frombuffer(b"   " + b"   ".join(raws) + b"   ", np.uint8)
        buf = _LOWER[buf]
        word = _IS_WORD[buf]
        buf = np.where(word, buf, 32).astype(np.uint32)
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        size = np.array([len(r) + 3 for r in raws], np.int64)
        self.text = np.searchsorted(np.cumsum(size) + 3, start, "right").astype(np.int32)
        # A word's hash: its bytes times powers by place, summed; wrapping is part of it.
        at = np.flatnonzero(word)
        owner = np.repeat(np.arange(len(start)), end - start)
        first = np.cumsum(end - start) - (end - start)
        power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
        inside = np.minimum(at - start[owner], 63) if len(at) else at
        if len(start):
            h = np.add.reduceat(buf[at].astype(np.uint64) * power[inside], first)
        else:
            h = np.empty(0, np.uint64)
        h ^= h >> np.uint64(29)
        self.word = (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - WORD_BITS)).astype(np.int32)
        # 4-grams from the blank before a word to the blank after it.
        ok = (at + 2 <= end[owner]) | (at == start[owner])
        at, owner = at[ok], owner[ok]
        code = buf[at - 1] | buf[at] << np.uint32(8) | buf[at + 1] << np.uint32(16) | np.where(word[at + 1], buf[at + 2], 32).astype(np.uint32) << np.uint32(24)
        self.gram = (code * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS)).astype(np.int32)
        self.grams = np.bincount(owner, minlength=len(start))
        self.first = np.cumsum(self.grams) - self.grams

    @classmethod
    def of(cls, raws: list[bytes]) -> Words:
        """The words of very many texts, taken by parts, so that what lies beside them stays small."""
        parts, texts, grams = [], 0, 0
        for at, to in _parts(raws):
            w = cls(raws[at:to])
            w.text += texts
            w.first += grams
            texts, grams = to, grams + len(w.gram)
            parts.append(w)
        out = cls.__new__(cls)
        for c in ("text", "word", "gram", "grams", "first"):
            setattr(out, c, np.concatenate([getattr(w, c) for w in parts or [cls([])]]))
        return out

    def vectors(self, m: dict[str, np.ndarray]) -> np.ndarray:
        if not len(self.word):
            return np.empty((0, 2 * WIDTH), np.float32)
        mean = np.add.reduceat(m["gram"][self.gram], self.first) / self.grams[:, None].astype(np.float32)
        return np.concatenate((m["word"][self.word], mean), axis=1)


def windows(text: np.ndarray, texts: int, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of the overlapping windows that cover each text's words; ``text`` holds the text of each word."""
    n = np.bincount(text, minlength=texts)
    first = np.cumsum(n) - n
    count = np.where(n > 0, np.maximum(1, -(-(n - window) // stride) + 1), 0)
    of = np.repeat(np.arange(texts), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return of, first[of] + k * stride, np.minimum(window, n[of] - k * stride)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gru(x, mask, u, back: bool, keep: bool):
    """States of one direction. ``x``: (time, batch, 3 h) inputs of the gates; ``mask``: (time, batch, 1)."""
    steps, h = range(len(x)), u.shape[0]
    state = np.zeros((x.shape[1], h), x.dtype)
    out, kept = np.empty((len(x), x.shape[1], h), x.dtype), [None] * len(x)
    for t in reversed(steps) if back else steps:
        a = state @ u
        zr = _sigmoid(x[t, :, : 2 * h] + a[:, : 2 * h])
        z, r, an = zr[:, :h], zr[:, h:], a[:, 2 * h :]
        n = np.tanh(x[t, :, 2 * h :] + r * an)
        new = n + z * (state - n)
        if keep:
            kept[t] = (state, z, r, an, n)
        state = new * mask[t] + state * (1 - mask[t])
        out[t] = state
    return out, kept


def _gru_back(grad, kept, mask, u, back: bool):
    h = u.shape[0]
    steps = range(len(grad))
    dx, du = np.empty((*grad.shape[:2], 3 * h), grad.dtype), np.zeros_like(u)
    carry = np.zeros_like(grad[0])
    for t in steps if back else reversed(steps):
        state, z, r, an, n = kept[t]
        g = carry + grad[t]
        on = g * mask[t]
        dan = on * (1 - z) * (1 - n * n)
        daz = on * (state - n) * z * (1 - z)
        dar = dan * an * r * (1 - r)
        dx[t] = np.concatenate((daz, dar, dan), axis=1)
        da = np.concatenate((daz, dar, dan * r), axis=1)
        du += state.T @ da
        carry = g * (1 - mask[t]) + on * z + da @ u.T
    return dx, du


def forward(m, x, mask, keep: bool = False):
    """Logits of windows. ``x``: (time, batch, inputs); with ``keep`` also what the gradient needs."""
    gates = x @ m["wf"] + m["bf"], x @ m["wb"] + m["bb"]
    hf, kf = _gru(gates[0], mask, m["uf"], False, keep)
    hb, kb = _gru(gates[1], mask, m["ub"], True, keep)
    h = np.concatenate((hf, hb), axis=2)
    s = np.tanh(h @ m["att"])
    score = (s @ m["v"])[:, :, None] - 1e9 * (1 - mask)
    e = np.exp(score - score.max(axis=0))
    a = e / e.sum(axis=0)
    c = (a * h).sum(axis=0)
    return c @ m["out"] + m["b"][0], (kf, kb, h, s, a, c) if keep else None


def gradients(m, x, mask, y, weight):
    """Mean weighted log loss, its gradient by parameter, and by input."""
    logit, (kf, kb, h, s, a, c) = forward(m, x, mask, True)
    p = _sigmoid(logit)
    loss = float(-(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / weight.sum())
    d = (weight * (p - y) / weight.sum()).astype(x.dtype)
    g = {"out": c.T @ d, "b": np.array([d.sum()], x.dtype)}
    dc = d[:, None] * m["out"]
    dh = a * dc
    da = (h * dc).sum(axis=2, keepdims=True)
    dscore = a * (da - (a * da).sum(axis=0))
    g["v"] = (s * dscore).sum(axis=(0, 1))
    dpre = dscore * m["v"] * (1 - s * s)
    g["att"] = np.einsum("tbi,tbj->ij", h, dpre)
    dh = dh + dpre @ m["att"].T
    k = m["uf"].shape[0]
    dxf, g["uf"] = _gru_back(dh[:, :, :k], kf, mask, m["uf"], False)
    dxb, g["ub"] = _gru_back(dh[:, :, k:], kb, mask, m["ub"], True)
    for name, dx in (("f", dxf), ("b", dxb)):
        g[f"w{name}"] = np.einsum("tbi,tbj->ij", x, dx)
        g[f"b{name}"] = dx.sum(axis=(0, 1))
    return loss, g, dxf @ m["wf"].T + dxb @ m["wb"].T


def _gather(vectors: np.ndarray, start: np.ndarray, size: np.ndarray, window: int):
    """``(time, window, inputs)`` and its mask."""
    t = np.arange(window)[:, None]
    on = t < size
    x = vectors[np.where(on, start + t, start)]
    return x, on[:, :, None].astype(vectors.dtype)


def start_model(rng: np.random.Generator) -> dict[str, np.ndarray]:
    f = lambda *shape, s=0.3: (rng.standard_normal(shape) * s).astype(np.float32)
    h, d = HIDDEN, 2 * WIDTH
    m = {"wf": f(d, 3 * h), "wb": f(d, 3 * h), "uf": f(h, 3 * h), "ub": f(h, 3 * h), "bf": f(3 * h, s=0), "bb": f(3 * h, s=0)}
    return m | {"att": f(2 * h, h), "v": f(h), "out": f(2 * h), "b": f(1, s=0), "word": f(1 << WORD_BITS, WIDTH, s=0.05), "gram": f(1 << GRAM_BITS, WIDTH, s=0.05)}


def _one_score(y: np.ndarray) -> np.ndarray:
    """For a model without a network: the log odds of the labels, or near 0 where there are none."""
    return np.array([0.0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else -4.0])


def train(raws: list[bytes], labels: list[int], seed: int = 7, steps: int = STEPS) -> dict[str, np.ndarray]:
    """A model fitted on texts and their labels.

    Where a class has no text with words there is nothing to tell the classes by, and every text
    gets the share of toxic labels as its score.
    """
    rng = np.random.default_rng(seed)
    m = start_model(rng)
    y = np.array(labels, np.float64)
    m["scale"] = _one_score(y)
    w = Words.of(raws)
    of, start, size = windows(w.text, len(raws))
    count = np.bincount(of, minlength=len(raws))
    first = np.cumsum(count) - count
    check = rng.permutation(len(y)) < int(CALIBRATION * len(y))
    both = lambda own: all((own & (count > 0) & (y == c)).any() for c in (0, 1))
    if not (both(check) and both(~check)):
        check[:] = False
    bad, good = (np.flatnonzero(~check & (count > 0) & (y == c)) for c in (1, 0))
    if not len(bad) or not len(good):
        return m
    state: dict[str, tuple] = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items() if k not in ("word", "gram", "scale")}
    seen = {k: np.full(len(m[k]), 1e-3, np.float32) for k in ("word", "gram")}
    for step in range(steps):
        docs = np.concatenate((rng.choice(bad, BATCH // 2), rng.choice(good, BATCH - BATCH // 2)))
        some = [first[d] + (np.arange(count[d]) if count[d] <= WINDOWS else rng.choice(count[d], WINDOWS, replace=False)) for d in docs]
        own, some = np.repeat(np.arange(len(docs)), [len(x) for x in some]), np.concatenate(some)
        on = np.arange(WINDOW)[:, None] < size[some]
        ids, place = np.unique(np.where(on, start[some] + np.arange(WINDOW)[:, None], start[some]), return_inverse=True)
        place = place.reshape(on.shape)
        grams = w.grams[ids]
        of_word, begin = np.repeat(np.arange(len(ids)), grams), np.cumsum(grams) - grams
        gram = w.gram[np.repeat(w.first[ids] - begin, grams) + np.arange(grams.sum())]
        share = (1 / grams).astype(np.float32)[:, None]
        x = np.concatenate((m["word"][w.word[ids]], np.add.reduceat(m["gram"][gram], begin) * share), axis=1)
        logit, _ = forward(m, x[place], on[:, :, None].astype(np.float32))
        # At first the choice of the window is left to chance, more than to a network that knows nothing.
        logit = logit + max(0.0, 1 - step / (0.3 * steps)) * rng.gumbel(size=len(logit))
        order = np.lexsort((-logit, own))
        worst = order[np.r_[True, own[order][1:] != own[order][:-1]]]
        place, mask = place[:, worst], on[:, worst, None].astype(np.float32)
        # Words go missing at random, so that no single one decides.
        keep = (rng.random((len(ids), 2)) >= DROPPED).repeat(WIDTH, axis=1).astype(np.float32)
        _, g, dx = gradients(m, (x * keep)[place], mask, y[docs].astype(np.float32), np.ones(len(docs), np.float32))
        rate = 0.01 * (1 - step / steps) + 0.001
        for k, (a, b) in state.items():
            a *= 0.9
            a += 0.1 * g[k]
            b *= 0.999
            b += 0.001 * g[k] ** 2
            m[k] -= rate * (a / (1 - 0.9 ** (step + 1))) / (np.sqrt(b / (1 - 0.999 ** (step + 1))) + 1e-8)
        dv = np.zeros_like(x)
        np.add.at(dv, place, dx * mask)
        dv *= keep
        used = dv.any(axis=1)
        used_gram = used[of_word]
        for k, rows, grad in (("word", w.word[ids[used]], dv[used, :WIDTH]), ("gram", gram[used_gram], (dv[:, WIDTH:] * share)[of_word[used_gram]])):
            one, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(one), WIDTH), np.float32)
            np.add.at(total, back, grad)
            seen[k][one] += (total**2).sum(axis=1)
            m[k][one] -= RATE * total / np.sqrt(seen[k][one])[:, None]
    held = check if check.any() else np.ones(len(y), bool)
    m["scale"] = _platt(score_texts(m, [r for r, h in zip(raws, held) if h]), y[held])
    return m


def _platt(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept of the calibrated log odds; the classes weigh as they occur."""
    x = np.clip(logit, -15, 15)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 0.5, 0.0
    for _ in range(200):
        p = _sigmoid(a * x + b)
        r, s = p - t, np.maximum(p * (1 - p), 1e-3)
        ga, gb = (r * x).sum() + 0.1 * (a - 1), r.sum() + 0.1 * b
        haa, hab, hbb = (s * x * x).sum() + 0.1, (s * x).sum(), s.sum() + 0.1
        det = haa * hbb - hab * hab
        a, b = a - np.clip((hbb * ga - hab * gb) / det, -0.5, 0.5), b - np.clip((haa * gb - hab * ga) / det, -2, 2)
    return np.array([max(a, 0.05), b])


def score_texts(m: dict[str, np.ndarray], raws: list[bytes]) -> np.ndarray:
    """The logit of each text's worst window; -15 for a text without words."""
    out = np.full(len(raws), -15.0)
    for at, to in _parts(raws):
        w = Words(raws[at:to])
        v = w.vectors(m)
        of, start, size = windows(w.text, to - at)
        order = np.argsort(size, kind="stable")  # short windows need few steps
        for lo in range(0, len(order), 4096):
            p = order[lo : lo + 4096]
            logit, _ = forward(m, *_gather(v, start[p], size[p], int(size[p].max())))
            np.maximum.at(out, at + of[p], logit)
    return out


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAINING_DOCUMENTS, longest: int = TRAINING_BYTES) -> list:
    """About ``most`` labelled texts of each class that are not held out, and ``longest`` bytes together, chosen by a hash of the id.

    Texts of every length take part; a document with several labels takes part with one of them.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = lambda c: F.lit(most / max(1, sizes.get(c, 0)))
    chosen = known.where(chance("doc_id", F.lit(label)) < F.when(F.col("y") == 1, part(1)).otherwise(part(0)))
    # About 2 * most rows of two numbers, whatever the size of the input.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    return sorted(bounded(texts, longest), key=lambda r: (r["doc_id"], r["text"]))


def fit(docs: DataFrame, labels: DataFrame, **how) -> dict[str, np.ndarray]:
    rows = sample(docs, labels, **how)
    return train([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, m: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from all windows of its whole text.

    Null and empty texts and texts without letters get the score of no toxic window, near 0 (the
    share of toxic labels where the model has no network). Repeated rows give repeated rows.
    """

    def run(batches):
        for batch in batches:
            logit = score_texts(m, [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()])
            p = _sigmoid(m["scale"][0] * np.clip(logit, -15, 15) + m["scale"][1])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
