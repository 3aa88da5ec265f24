"""Suffix arrays of many short texts at once, by induced sorting, and their common prefixes.

The texts of a batch are laid end to end. Each step of an induced sort is done for all texts
together (the longest first, so that the texts that still take part are a prefix of the list),
so that the work of a step is a few array operations over many texts.
"""

from __future__ import annotations

import numpy as np


def _runs_from_ends(group: np.ndarray) -> np.ndarray:
    """For each element of a sorted array, how many of its equals follow it."""
    n = len(group)
    last = np.flatnonzero(np.r_[group[1:] != group[:-1], True])
    return np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n)


def suffix_arrays(t: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Suffix arrays of texts laid end to end in ``t``; ``size`` falls, and each text ends with its only 0.

    The result holds, for each text in its place, its suffixes in order as places within the text.
    """
    n, g = len(t), len(size)
    off = np.cumsum(size) - size
    owner = np.repeat(np.arange(g), size)
    # Classify: a suffix is S if it is smaller than the next one; equal letters inherit from the right.
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:] - t[:-1])
    step[off + size - 1] = 1
    known = np.where(step != 0, np.arange(n), n)
    known = np.minimum.accumulate(known[::-1])[::-1]
    is_s = step[known] > 0
    lms = np.zeros(n, bool)
    lms[1:] = is_s[1:] & ~is_s[:-1]
    lms[off] = False
    # Buckets: one for each letter of each text.
    letters = np.maximum.reduceat(t, off) + 1
    base = np.cumsum(letters) - letters
    bucket = base[owner] + t
    count = np.bincount(bucket, minlength=int(letters.sum()))
    ends = np.cumsum(count)
    starts = ends - count

    # An empty place holds 0; the place before a text's first letter is another text's final 0, which is in neither.
    is_l, is_small = ~is_s, is_s.copy()
    is_small[off + size - 1] = False

    def induce(sa: np.ndarray) -> None:
        most = int(size[0])
        active = np.searchsorted(-size, -np.arange(most), "left").tolist()
        head, tail = starts.copy(), ends.copy()
        for i in range(most):
            o = off[: active[i]]
            j = o + sa[o + i]
            j -= 1
            ok = is_l[j].nonzero()[0]
            j = j[ok]
            b = bucket[j]
            h = head[b]
            sa[h] = j - o[ok]
            head[b] = h + 1
        for i in range(most - 1, -1, -1):
            o = off[: active[i]]
            j = o + sa[o + i]
            j -= 1
            ok = is_small[j].nonzero()[0]
            j = j[ok]
            b = bucket[j]
            h = tail[b] - 1
            sa[h] = j - o[ok]
            tail[b] = h

    def placed(at: np.ndarray) -> np.ndarray:
        """A new array with the suffixes ``at``, sorted by bucket, at the ends of their buckets."""
        sa = np.zeros(n, np.int64)
        b = bucket[at]
        sa[ends[b] - 1 - _runs_from_ends(b)] = at - off[owner[at]]
        sa[off] = size - 1  # the final 0 alone is the smallest suffix, also where it is the whole text
        return sa

    at = np.flatnonzero(lms)
    sa = placed(at[np.argsort(bucket[at], kind="stable")])
    induce(sa)
    # Name the leftmost-smaller substrings in their order; equal ones share a name.
    order = sa + off[owner]
    order = order[lms[order]]
    new = np.ones(len(order), bool)
    new[1:] = owner[order[1:]] != owner[order[:-1]]
    open_ = np.flatnonzero(~new)
    a, b, d = order[open_ - 1], order[open_], 0
    while len(open_):
        differ = (t[a + d] != t[b + d]) | (is_s[a + d] != is_s[b + d])
        if d:
            end_a, end_b = lms[a + d], lms[b + d]
            differ |= end_a != end_b
            done = end_a & end_b & ~differ
        else:
            done = np.zeros(len(a), bool)
        new[open_[differ]] = True
        on = ~(differ | done)
        open_, a, b, d = open_[on], a[on], b[on], d + 1
    per = np.bincount(owner[order], minlength=g)
    first = np.cumsum(per) - per
    rank = np.cumsum(new)
    name = rank - rank[first[owner[order]]]
    distinct = np.bincount(owner[order], weights=new, minlength=g).astype(np.int64)
    again = np.flatnonzero((distinct < per) & (per > 0))
    if len(again):
        # Sort the shorter texts of names, then read the order of the suffixes from theirs.
        names = np.zeros(n, np.int64)
        names[order] = name
        by_size = again[np.argsort(-per[again], kind="stable")]
        m = per[by_size]
        pick = np.repeat(first[by_size] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        inner = at[pick]  # ``at`` is in text order, text by text, as ``first`` and ``per`` count
        sub = suffix_arrays(names[inner], m)
        fixed = inner[sub + np.repeat(np.cumsum(m) - m, m)]
        order[pick] = fixed
    sa = placed(order)
    induce(sa)
    return sa


def common_prefixes(t: np.ndarray, size: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of ``sa``, how long a prefix its suffix shares with the suffix before it.

    Computed in text order. Where the letter before a suffix equals the one before its
    predecessor, its prefix is one shorter than that of the suffix to its left; only the others
    are compared letter by letter.
    """
    n = len(t)
    off = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    full = sa + off[owner]
    before = np.full(n, -1, np.int64)
    before[full[1:]] = np.where(owner[1:] == owner[:-1], full[:-1], -1)
    at = np.arange(n)
    left = np.zeros(n, bool)
    inside = (before >= 0) & (at > off[owner]) & (before > off[owner])
    left[inside] = t[at[inside] - 1] == t[before[inside] - 1]
    plcp = np.zeros(n, np.int64)
    open_ = np.flatnonzero((before >= 0) & ~left)
    a, b, d = open_, before[open_], 0
    while len(a):
        same = t[a + d] == t[b + d]
        plcp[open_[~same]] = d
        open_, a, b, d = open_[same], a[same], b[same], d + 1
    source = np.maximum.accumulate(np.where(left, 0, at))
    plcp = np.where(left, plcp[source] - (at - source), plcp)
    return plcp[full]
