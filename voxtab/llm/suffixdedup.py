"""Removal of long repeated byte strings with suffix arrays over content-defined shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier, in a document of
smaller id or further left in the same one. Equal strings have to meet in one suffix array,
although texts are spread over the cluster, so texts are cut by content: the key of a string is
the smallest hash among its grams of ``GRAM`` bytes, and neighbouring strings with one key form a
segment. Equal strings have equal keys, so each shard, all segments of one key, decides alone.

1. Texts are cut into segments; of each only key, hash and place are shuffled. Equal segments of
   one batch of texts send their first place only. By key it is settled which segments equal an
   earlier one as a whole, which have a key of their own, and which need a shard.
2. For the last, the texts are joined in and the segments' bytes go to their shards. A shard's
   suffix array is built by induced sorting; runs of suffixes with a common prefix of ``LENGTH``
   bytes or more are the repeated strings. Keys with more than ``SHARD`` different segments (a
   line that very many documents share) send their strings one by one, by their own hash, so
   that no shard grows with the data. Keys that a sample of the texts shows to be of this kind
   are sent so from the start; this changes where strings meet, not what is found.
3. The removed strings of each document are joined with its text once more (the same exchange of
   the texts) and merged into runs.

Segments of one key are called equal if 64 bits of their hash are, single strings if 128 bits are.
Equal segments are known as such before any bytes move, so a suffix array sorts each different
segment of a shard once, however many copies of it there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored
from .sais import common_prefixes, suffix_arrays

LENGTH = 100
GRAM = 24
#: Strings of one segment at most, and different segments of one shard at most.
SEGMENT, SHARD = 512, 48
#: One text in so many is looked at for keys with very many different segments: at least
#: ``HEAVY_ROWS`` of the sample's, and more than ``HEAVY_SHARE`` of them, which bounds the list.
SAMPLED, HEAVY_ROWS, HEAVY_SHARE = 64, 20, 1e-5
#: Bytes that are cut or sorted in one go.
_CHUNK = 2_000_000
_SORT = 400_000
_ODD = 0x9E3779B97F4A7C15
_LAST = (1 << 63) - 1
WHOLE, SORTED, SINGLE = 1, 2, 3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def keys_of(buf: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The mixed hashes of all grams, and for each start the smallest of them in the string of ``length`` bytes."""
    n = len(buf)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers(n, _ODD), out=total[1:])
    hashes = _mixed((total[gram:] - total[:-gram]) * _powers(n - gram + 1, pow(_ODD, -1, 1 << 64)))
    width = length - gram + 1
    padded = np.full(-(-len(hashes) // width) * width, ~np.uint64(0), np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, width)
    right = np.minimum.accumulate(rows, axis=1).ravel()
    left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    k = n - length + 1
    return hashes, np.minimum(left[:k], right[width - 1 : width - 1 + k])


def _cut(raws: list[bytes], length: int, gram: int):
    """Of texts laid end to end: text, start within it, number of strings and key of each segment, and whether it may repeat itself.

    Two equal strings of one segment hold the smallest gram at the same offset, so it also stands
    where a string other than the last begins or where one other than the first ends.
    """
    size = np.array([len(r) for r in raws], np.int64)
    grams, keys = keys_of(np.frombuffer(b"".join(raws), np.uint8), length, gram)
    off = np.cumsum(size) - size
    text = np.repeat(np.arange(len(raws)), size)[: len(keys)]
    at = np.arange(len(keys)) - off[text]
    valid = at + length <= size[text]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
    s = np.flatnonzero(first)
    n = np.diff(np.r_[s, len(keys)])
    again = np.zeros(len(keys), bool)
    again[:-1] = (grams[: len(keys) - 1] == keys[:-1]) & ~first[1:]
    again |= (grams[length - gram : length - gram + len(keys)] == keys) & ~first
    loops = np.logical_or.reduceat(again, s) if len(s) else np.empty(0, bool)
    s, n, loops = s[valid[s]], n[valid[s]], loops[valid[s]]
    if len(n) and n.max() > SEGMENT:  # a long run of one key, as in periodic text
        parts = -(-n // SEGMENT)
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        s, n, loops = np.repeat(s, parts) + k * SEGMENT, np.minimum(SEGMENT, np.repeat(n, parts) - k * SEGMENT), np.repeat(loops, parts)
    return text[s], at[s], n, keys[s], loops


def _batches(sizes):
    """Ranges of items of about ``_CHUNK`` bytes together."""
    at = 0
    while at < len(sizes):
        to, total = at, 0
        while to < len(sizes) and (to == at or total + sizes[to] <= _CHUNK):
            total += sizes[to]
            to += 1
        yield at, to
        at = to


#: ``where`` holds a start (31 bits, a text is shorter), the number of strings from there (10 bits), and
#: 22 bits of the text's hash, which tell texts apart that repeat a ``doc_id``.
_START_AT, _STRINGS_AT, _TAGS = 32, 22, (1 << 22) - 1


def _where(start, n, tag):
    return np.asarray(start, np.int64) << _START_AT | np.asarray(n, np.int64) << _STRINGS_AT | tag


def _start(where):
    return where >> _START_AT


def _strings(where):
    return where >> _STRINGS_AT & 1023


def _tag(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) & _TAGS


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x).view(np.int64) if np.asarray(x).dtype == np.uint64 else np.asarray(x, np.int64))


def _bytes(column) -> list[bytes]:
    return [(x or "").encode("utf-8", "surrogatepass") for x in column.to_pylist()]


_PLACE = "key long, hash long, doc long, place long, kind int"


def heavy_keys(texts: DataFrame, length: int, gram: int) -> list[int]:
    """Keys that very many different segments share, by a sample of the texts; at most ``1 / HEAVY_SHARE``."""
    part = texts.where(F.pmod(F.xxhash64("doc", "text"), F.lit(SAMPLED)) == 0)
    keys = stored(_segments(part, length, gram).where(F.col("kind") != WHOLE).select("key", "hash").distinct().groupBy("key").agg(F.count("*").alias("n")))
    total = keys.agg(F.sum("n")).first()[0] or 0
    return [r["key"] for r in keys.where(F.col("n") >= F.lit(max(HEAVY_ROWS, HEAVY_SHARE * total))).select("key").collect()]


def _single(raws, text, start, n, length):
    """The strings of segments one by one: index of the segment, start, and both halves of a hash."""
    of = np.repeat(np.arange(len(n)), n)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    digest = xxhash.xxh3_128_digest
    halves = np.frombuffer(b"".join([digest(raws[i][s : s + length]) for i, s in zip(text[of].tolist(), at.tolist())]), "<u8").reshape(-1, 2)
    return of, at, halves[:, 0], halves[:, 1]


def _segments(texts: DataFrame, length: int, gram: int, heavy: list[int] = ()) -> DataFrame:
    """``key, hash, doc, place`` of the segments, first places of a batch; the other places with kind ``WHOLE``.

    Kind ``SORTED`` marks a segment that may repeat itself, and needs its strings compared even alone.
    Segments with a ``heavy`` key are sent as single strings.
    """
    heavy_ = np.sort(np.array(heavy, np.int64).view(np.uint64))

    def run(batches):
        for batch in batches:
            docs, raws = batch.column(0).to_numpy(), _bytes(batch.column(1))
            for lo, hi in _batches([len(r) for r in raws]):
                text, start, n, key, loops = _cut(raws[lo:hi], length, gram)
                if not len(key):
                    continue
                digest = xxhash.xxh3_64_intdigest
                hashed = np.array([digest(raws[lo + i][s : s + m + length - 1]) for i, s, m in zip(text.tolist(), start.tolist(), n.tolist())], np.uint64)
                doc = docs[lo:hi][text]
                tags = np.array([_tag(r) for r in raws[lo:hi]])
                if len(heavy_) and (many := np.isin(key, heavy_)).any():
                    of, at, k, h = _single(raws[lo:hi], text[many], start[many], n[many], length)
                    few = ~many
                    key, hashed = np.r_[key[few], k], np.r_[hashed[few], h]
                    loops, n = np.r_[loops[few], np.zeros(len(of), bool)], np.r_[n[few], np.ones(len(of), np.int64)]
                    text, start, doc = np.r_[text[few], text[many][of]], np.r_[start[few], at], np.r_[doc[few], doc[many][of]]
                place = _where(start, n, tags[text])
                order = np.lexsort((start, doc, hashed, key))
                k, h, d, s = key[order], hashed[order], doc[order], start[order]
                same = np.r_[False, (k[1:] == k[:-1]) & (h[1:] == h[:-1])]
                # A place that equals the first one in document and start is not later.
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(k))))
                later = same & ((d != d[lead]) | (s != s[lead]))
                # What is settled here goes to any partition.
                sent = np.where(later, _mixed(k + np.arange(len(k)).astype(np.uint64)), k)
                yield pa.record_batch([_long(sent), _long(h), _long(d), _long(place[order]), pa.array(np.where(later, WHOLE, np.where(loops[order], SORTED, 0)).astype(np.int32))], ["key", "hash", "doc", "place", "kind"])

    return texts.select("doc", "text").mapInArrow(run, _PLACE)


def _settled(places: DataFrame, shard: int) -> DataFrame:
    """Of the segments what is known by key: ``WHOLE`` (equals an earlier one), ``SORTED`` or ``SINGLE`` (needs its strings compared).

    The rows of a partition come by key and, within it, by hash and place; a key's rows are never
    held together: of each class only the first row waits, and none once the key has too many.
    """

    def run(batches):
        waiting: list[tuple] = []  # first rows of the open key's classes, while they are few
        key = hash_ = first = None
        many = False

        def closed(out):
            if len(waiting) > 1 or any(w[4] for w in waiting):
                out += [(*w[:4], SORTED) for w in waiting]

        for batch in batches:
            k, h, d, p, kind = (batch.column(i).to_numpy() for i in range(5))
            start = _start(p)
            done = kind == WHOLE
            new_key = np.r_[True, k[1:] != k[:-1]]
            new = new_key | np.r_[True, h[1:] != h[:-1]]
            if key is not None and len(k) and k[0] == key:
                new_key[0] = False
                new[0] = h[0] != hash_
            lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
            fd = np.where(lead < 0, first[0] if first else 0, d[lead])
            fs = np.where(lead < 0, first[1] if first else 0, start[lead])
            later = ~new & ((d != fd) | (start != fs))
            whole = later | done
            # Classes by key; keys that begin and end in this batch are settled at once.
            group = np.cumsum(new_key)
            classes = np.bincount(group[new & ~done], minlength=group[-1] + 1 if len(group) else 1)
            last = group[-1] if len(group) else 0
            inner = (group > 0) & (group < last) & ~whole
            size = classes[group]
            kinds = np.where(size > shard, SINGLE, SORTED)
            pick = whole | (inner & ((size > 1) | (kind == SORTED)))
            extra: list[tuple] = []
            for g in dict.fromkeys((0, int(last))):
                rows = np.flatnonzero((group == g) & ~whole)
                if g > 0 or not len(k) or new_key[0]:
                    if g == last or g > 0:
                        closed(extra)
                        waiting, many = [], False
                for i in rows.tolist():
                    row = (int(k[i]), int(h[i]), int(d[i]), int(p[i]), kind[i] == SORTED)
                    if many:
                        extra.append((*row[:4], SINGLE))
                        continue
                    waiting.append(row)
                    if len(waiting) > shard:
                        extra += [(*w[:4], SINGLE) for w in waiting]
                        waiting, many = [], True
            if len(k):
                key, hash_ = int(k[-1]), int(h[-1])
                if lead[-1] >= 0:
                    first = (int(d[lead[-1]]), int(start[lead[-1]]))
            yield pa.record_batch([_long(k[pick]), _long(h[pick]), _long(d[pick]), _long(p[pick]), pa.array(np.where(whole, WHOLE, kinds)[pick].astype(np.int32))], ["key", "hash", "doc", "place", "kind"])
            if extra:
                yield pa.record_batch([*(pa.array([e[i] for e in extra], pa.int64()) for i in range(4)), pa.array([e[4] for e in extra], pa.int32())], ["key", "hash", "doc", "place", "kind"])
        extra = []
        closed(extra)
        if extra:
            yield pa.record_batch([*(pa.array([e[i] for e in extra], pa.int64()) for i in range(4)), pa.array([e[4] for e in extra], pa.int32())], ["key", "hash", "doc", "place", "kind"])

    n = shuffle_partitions(places.sparkSession)
    dealt = places.repartition(n, "key").withColumn("start", F.shiftright("place", _START_AT)).sortWithinPartitions("key", "hash", "doc", "start")
    return dealt.select("key", "hash", "doc", "place", "kind").mapInArrow(run, _PLACE)


def _requests(joined: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments that need a shard, and the hashes of single strings."""

    def run(batches):
        names = ["key", "hash", "doc", "place", "kind", "bytes"]
        for batch in batches:
            docs, raws, wanted = batch.column(0).to_numpy(), _bytes(batch.column(1)), batch.column(2)
            out: list[list] = [[] for _ in names]
            single: dict[tuple[int, int], tuple[int, int]] = {}
            spent, tied = [], []
            for i, raw in enumerate(raws):
                tag = _tag(raw)
                for want in wanted[i].as_py() or ():
                    place = want["place"]
                    if place & _TAGS != tag:
                        continue
                    s, n = _start(place), _strings(place)
                    if want["kind"] == SORTED:
                        for column, value in zip(out, (want["key"], 0, int(docs[i]), place, SORTED, raw[s : s + n + length - 1])):
                            column.append(value)
                        continue
                    for j in range(s, s + n):
                        digest = xxhash.xxh3_128_digest(raw[j : j + length])
                        at = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                        mine = (int(docs[i]), j << _START_AT | 1 << _STRINGS_AT | tag)
                        other = single.setdefault(at, mine)
                        if (other[0], _start(other[1])) == (mine[0], _start(mine[1])):
                            if other[1] != mine[1]:  # another text of the same id: neither is the earlier one
                                tied.append((at, mine))
                            continue
                        if (mine[0], _start(mine[1])) < (other[0], _start(other[1])):
                            single[at], mine = mine, other
                        spent.append(mine)
                if len(out[0]) > 20_000 or len(single) + len(spent) + len(tied) > 200_000 or i + 1 == len(raws):
                    for (a, b), (d, p) in [*single.items(), *tied]:
                        for column, value in zip(out, (a, b, d, p, SINGLE, None)):
                            column.append(value)
                    for k, (d, p) in enumerate(spent):
                        for column, value in zip(out, (hash((d, p, k)), 0, d, p, WHOLE, None)):
                            column.append(value)
                    if out[0]:
                        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names)
                    out, single, spent, tied = [[] for _ in names], {}, [], []

    return joined.mapInArrow(run, _PLACE + ", bytes binary")


def repeated(shards: list[list[tuple[int, int, bytes]]], length: int):
    """``(doc, start, strings)`` runs of strings that start earlier in their shard, given as ``(doc, start, bytes)`` segments."""
    texts = []
    for shard in shards:
        parts = []
        for _, _, raw in shard:
            parts += [np.frombuffer(raw, np.uint8).astype(np.int64) + 2, np.ones(1, np.int64)]
        parts[-1] = np.zeros(1, np.int64)
        texts.append(np.concatenate(parts))
    order = sorted(range(len(shards)), key=lambda i: -len(texts[i]))
    size = np.array([len(texts[i]) for i in order])
    t = np.concatenate([texts[i] for i in order])
    segments = [s for i in order for s in shards[i]]
    lengths = np.array([len(s[2]) for s in segments])
    off = np.cumsum(lengths + 1) - lengths - 1
    segment = np.repeat(np.arange(len(segments)), lengths + 1)
    within = np.arange(len(t)) - off[segment]
    valid = within + length <= lengths[segment]
    sa = suffix_arrays(t, size)
    lcp = common_prefixes(t, size, sa)
    full = sa + np.repeat(np.cumsum(size) - size, size)
    # Places in order: by document, then start.
    ranks = np.unique(np.array([s[0] for s in segments], np.int64), return_inverse=True)[1]
    place = (ranks[segment] << 40) + np.array([s[1] for s in segments], np.int64)[segment] + within
    place = np.where(valid, place, np.int64(_LAST))
    run = np.flatnonzero(lcp < length)
    least = np.minimum.reduceat(place[full], run)
    gone = np.zeros(len(t), bool)
    gone[full] = place[full] > np.repeat(least, np.diff(np.r_[run, len(t)]))
    gone &= valid
    edge = np.flatnonzero(gone & ~np.r_[False, gone[:-1] & (segment[1:] == segment[:-1])])
    stop = np.flatnonzero(gone & ~np.r_[gone[1:] & (segment[1:] == segment[:-1]), False])
    for a, b in zip(edge.tolist(), stop.tolist()):
        doc, start, _ = segments[segment[a]]
        yield doc, start + int(within[a]), b - a + 1, int(segment[a])


def _solved(requests: DataFrame, length: int) -> DataFrame:
    """``doc, place`` of the removed strings, from shards and single strings."""

    def sort(shards):
        order = sorted(range(len(shards)), key=lambda i: -sum(len(r[2]) + 1 for r in shards[i]))
        tags = [r[3] for i in order for r in shards[i]]
        for doc, start, n, segment in repeated([[r[:3] for r in shards[i]] for i in order], length):
            yield doc, start << _START_AT | n << _STRINGS_AT | tags[segment]

    def packed(doc, place):
        return pa.record_batch([_long(doc), _long(place)], ["doc", "place"])

    def run(batches):
        # Shards of like size are sorted together, so that a long one does not hold up many short ones.
        pools: dict[int, list] = {}
        sizes: dict[int, int] = {}
        key, rows, total = None, [], 0
        last = (0, 0, 0, 0)
        any_single = False

        def closed(end: bool = False):
            if rows:
                pool = int(total).bit_length() // 2
                pools.setdefault(pool, []).append(rows)
                sizes[pool] = sizes.get(pool, 0) + total
            if end:  # the steps are those of the longest shard, so what is left of the long ones goes together
                for pool in [k for k in sizes if 5 <= k < max(sizes)]:
                    pools[max(sizes)] += pools.pop(pool)
                    sizes.pop(pool)
            for pool in [k for k, v in sizes.items() if v > (_SORT if k < 7 else 3 * _SORT) or (end and v)]:
                found = list(sort(pools.pop(pool)))
                sizes.pop(pool)
                if found:
                    yield packed(*zip(*found))

        for batch in batches:
            k, h, d, p, kind = (batch.column(i).to_numpy() for i in range(5))
            whole = kind == WHOLE
            if whole.any():
                yield packed(d[whole], p[whole])
            for i in np.flatnonzero(kind == SORTED).tolist():
                if k[i] != key:
                    yield from closed()
                    key, rows, total = k[i], [], 0
                raw = batch.column(5)[i].as_py()
                rows.append((int(d[i]), _start(int(p[i])), raw, int(p[i]) & _TAGS))
                total += len(raw)
            single = np.flatnonzero(kind == SINGLE)
            if len(single):
                k, h, d, p = k[single], h[single], d[single], p[single]
                start = _start(p)
                new = np.r_[not any_single or (k[0], h[0]) != last[:2], (k[1:] != k[:-1]) | (h[1:] != h[:-1])]
                lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
                first_d, first_s = np.where(lead < 0, last[2], d[lead]), np.where(lead < 0, last[3], start[lead])
                later = ~new & ((d != first_d) | (start != first_s))
                if later.any():
                    yield packed(d[later], p[later])
                last, any_single = (k[-1], h[-1], first_d[-1], first_s[-1]), True
        yield from closed(True)

    n = shuffle_partitions(requests.sparkSession)
    dealt = requests.repartition(n, "key").withColumn("start", F.shiftright("place", _START_AT)).sortWithinPartitions("kind", "key", "hash", "doc", "start")
    return dealt.drop("start").mapInArrow(run, "doc long, place long")


def spans_of(size: int, places: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings at ``places`` cover."""
    out: list[list[int]] = []
    for start, n in sorted((_start(int(p)), _strings(int(p))) for p in places):
        end = min(size, start + n + length - 1)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``doc_id, spans`` (half-open byte runs that go) and ``kept`` (the remaining bytes) of each row.

    A null text counts as empty. A row without an id comes after those with one (below 2^62), by a
    number that its text gives. Rows that repeat a ``doc_id`` are one document for order, as are rows
    without an id that have one text: of equal strings at one id and start none is earlier. Of
    different texts of one id each has its own runs. Texts shorter than ``length`` lose nothing.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    nameless = F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit((1 << 62) - 1))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), nameless).alias("doc"), text.alias("text"), F.col("doc_id").cast("long"))
    known = stored(_settled(_segments(texts, length, gram, heavy_keys(texts, length, gram)), shard))
    by_doc = lambda rows, *what: rows.groupBy("doc").agg(F.collect_list(F.struct(*what)).alias("places"))
    wanted = by_doc(known.where(F.col("kind") != WHOLE), "key", "place", "kind")
    base = texts.select("doc", "doc_id", "text")
    requests = _requests(base.join(wanted, "doc", "left").where("places is not null").select("doc", "text", "places"), length)
    gone = known.where(F.col("kind") == WHOLE).select("doc", "place").union(_solved(requests, length))
    joined = base.join(by_doc(gone, "place"), "doc", "left").select("doc_id", "text", F.col("places.place").alias("places"))

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            raws, places = _bytes(batch.column(1)), batch.column(2)
            spans, kept = [], []
            for i, raw in enumerate(raws):
                tag = _tag(raw)
                own = spans_of(len(raw), [p for p in places[i].as_py() or () if p & _TAGS == tag], length)
                spans.append([{"start": a, "end": b} for a, b in own])
                edges = [0, *(x for s in own for x in s), len(raw)]
                kept.append(b"".join(raw[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2)))
            yield pa.record_batch([batch.column(0), _long([len(r) for r in raws]), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def brute(rows: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same from a table of all strings; for tests."""
    first: dict[bytes, tuple[int, int]] = {}
    for doc, raw in sorted(rows):
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], (doc, i))
    out = {}
    for doc, raw in rows:
        own = spans_of(len(raw), [i << _START_AT | 1 << _STRINGS_AT for i in range(len(raw) - length + 1) if first[raw[i : i + length]] != (doc, i)], length)
        kept = bytes(b for i, b in enumerate(raw) if not any(s <= i < e for s, e in own))
        out[doc] = (len(raw), len(raw) - len(kept), len(own), hashlib.sha256(kept).hexdigest())
    return out
