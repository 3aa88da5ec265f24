"""Personal data by gradient boosting over candidate spans. DataFrame functions only.

Strict patterns with checks give the base spans, which always stay. Generators of high recall
propose further spans, which may overlap: written-out addresses, loose number groups, dotted
groups, long tokens. Each candidate gets small binned features of its format (in which the marks
that make a span strict, such as ``+`` and ``@``, do not show) and of the characters around it.

There are no labels, so the boosted trees learn from what the strict patterns confirm, told
otherwise: each base span is rewritten in loose forms at its place (``[at]`` for ``@``, no ``+``,
other separators), which are the positive examples; the negative ones are base spans that were
spoiled (a wrong check digit, no domain, digits regrouped as a date) and candidates that fail the
checks or belong to another kind. Candidates that hold but are not confirmed are not learned from;
they are what the trees decide. Secrets have no strict pattern: long tokens that a name such as
``token`` or ``password`` is assigned to are the positive examples; other long tokens, and quoted
ones as they would stand in prose, the negative ones; the name itself is no feature.

The trees are fitted on counts of (features, label), a table whose size is bounded by the number
of bins and that covers every candidate of the corpus. A threshold for each kind, calibrated on
the documents that the trees did not learn from, selects the spans that are added.

The patterns are written so that Java's matcher needs linear time and no recursion on long
runs: possessive repeats, and starts only where a run of the first class begins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:@|\[at\]|\(at\)|\{at\})", r"(?:\.|\[dot\]|\(dot\)|\{dot\})"
_POINT = r"(?:\.|\[\.\]|\(\.\)|:)"
#: Candidates beside the base spans.
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+\x20?{_AT}\x20?[A-Za-z0-9-]{{1,63}}+(?:\x20?{_DOT}\x20?[A-Za-z0-9-]{{1,63}}+){{0,8}}+",
    "ip": rf"(?<![0-9])[0-9]{{1,4}}+(?:{_POINT}[0-9]{{1,4}}+){{3,7}}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,22}+",
    "phone": r"(?<![0-9+])(?:\+|00|\()?[0-9](?:[\x20()./-]{0,2}[0-9]){6,16}+",
    "secret": r"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}+",
}
#: What a secret is assigned to, at the end of the text before it.
NAMED = r"(?:token|secret|passw(?:or)?d|pwd|api.?key|auth|bearer|credential|private.?key)[a-z_]*[\"']?\s*[:=]\s*[\"']?$"
CUE = "mail|phone|tel|call|fax|mobil|card|visa|konto|tarjeta|carte|addr|host|contact"
ROUNDS, RATE, RIDGE = 16, 0.4, 1.0
#: A kind's threshold keeps the share of positive examples above it at this or more.
PRECISION = 0.95
FEATURES = ("kind", "valid", "digits", "length", "first", "last", "parts", "shape", "left", "right", "cue")
_SPAN = "array<struct<kind:int,start:int,end:int,text:string>>"


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """All matches, left to right without overlap, with code-point places: the texts between them give the places."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["hit"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(hits, F.slice(between, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    back = F.reverse(digits)

    def add(total, k):
        d = F.substring(back, k, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(k % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"))
    if kind == "card":
        d = _digits(s)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _flags(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with what tells texts without any match of a kind, read once for all kinds."""
    return docs.withColumns({"_digit": text.rlike("[0-9]"), "_at": text.contains("@") | text.rlike(r"[\[({]at[\])}]")})


def _guarded(kind: str, spans: Column) -> Column:
    """The spans only where the text has a character without which the kind has no match."""
    return F.when(F.col("_at") if kind == "email" else F.col("_digit"), spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column, kind: str) -> Column:
    found = _matches(text, KINDS.index(kind), BASE[kind])
    return _guarded(kind, F.filter(found, lambda x: _valid(kind, x["text"])))


def _place(c: Column) -> Column:
    """Of a character: 0 none or blank, 1 letter, 2 digit, 3 other."""
    return F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).otherwise(3)


def _context(text: Column, start: Column) -> Column:
    return F.lower(F.substring(text, F.greatest(F.lit(1), start - 23), F.least(start, F.lit(24))))


def _plain(kind: Column, s: Column) -> Column:
    """A candidate's text with its usual marks in place of written-out ones."""
    email = F.regexp_replace(F.regexp_replace(s, rf"\x20?{_AT}\x20?", "@"), rf"\x20?{_DOT}\x20?", ".")
    ip = F.regexp_replace(s, r"\[\.\]|\(\.\)", ".")
    return F.when(kind == EMAIL, email).when(kind == IP, ip).otherwise(s)


def _holds(kind: Column, plain: Column) -> Column:
    """Whether the checks of its kind hold for a candidate, whatever form it has."""
    email = plain.rlike(rf"^[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}$")
    ip = plain.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$") & _valid("ip", plain)
    return F.when(kind == EMAIL, email).when(kind == IP, ip).when(kind == CARD, _valid("card", plain)).when(kind == PHONE, _valid("phone", plain)).otherwise(F.lit(True))


def _features(text: Column, kind: Column, s: Column, start: Column, end: Column) -> Column:
    plain = _plain(kind, s)
    digits = F.length(_digits(s))
    before = F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise(F.lit(""))
    after = F.substring(text, end + 1, F.lit(1))
    size = lambda c: F.when(c == 0, 0).when(c < 3, 1).when(c == 3, 2).when(c == 4, 3).otherwise(4)
    groups = F.size(F.split(F.regexp_replace(s, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+"))
    dots = F.length(plain) - F.length(F.replace(plain, F.lit("."), F.lit("")))
    hexa, cased = s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), s.rlike("[a-z]") & s.rlike("[A-Z]")
    return F.struct(
        kind.alias("kind"),
        F.when(_holds(kind, plain), 1).otherwise(0).alias("valid"),
        F.when(digits < 4, 0).when(digits < 9, 1).when(digits < 12, 2).when(digits < 13, 3).when(digits < 16, 4).when(digits < 17, 5).when(digits < 20, 6).otherwise(7).alias("digits"),
        F.least(F.floor(F.length(plain) / 8).cast("int"), F.lit(5)).alias("length"),
        size(F.length(F.regexp_extract(s, "[0-9]+", 0))).alias("first"),
        size(F.length(F.regexp_extract(s, "([0-9]+)[^0-9]*$", 1))).alias("last"),
        F.when(kind == SECRET, 0).otherwise(F.least(F.when(kind == EMAIL, dots).otherwise(groups), F.lit(5))).alias("parts"),
        F.when(kind == SECRET, F.when(hexa, 0).when(cased, 1).otherwise(2)).when((kind == IP) & s.contains(":"), 1).otherwise(0).alias("shape"),
        _place(before).alias("left"), _place(after).alias("right"),
        F.when(kind == SECRET, 0).when(_context(text, start).rlike(CUE), 1).otherwise(0).alias("cue"),
    )


def _retold(x: Column) -> Column:
    """A base span in loose forms, and spoiled: ``(text, y)``."""
    s, d = x["text"], _digits(x["text"])
    bare = F.regexp_replace(s, r"^\+", "")
    local = F.regexp_replace(bare, r"^[0-9]{1,3}[\x20.-]*(?=\(?[0-9])", "")
    joined = lambda c: F.regexp_replace(c, "([0-9]+)[^0-9]+([0-9]+)$", "$1$2")
    fours = lambda mark: F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{mark}")
    good = (
        (s, F.regexp_replace(F.replace(s, F.lit("@"), F.lit(" [at] ")), r"\.", " [dot] "), F.replace(s, F.lit("@"), F.lit("(at)"))),
        (s, F.regexp_replace(s, r"\.", "[.]")),
        (s, d, fours("."), fours("-")),
        (bare, F.concat(F.lit("00"), bare), F.regexp_replace(bare, "[^0-9]+", "."), local, joined(bare), joined(F.regexp_replace(local, "[()]", ""))),
    )
    wrong = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), F.translate(F.substring(d, -1, 1), "0123456789", "1234567890"))
    bad = (
        (F.regexp_replace(s, r"@([A-Za-z0-9-]+)\..*$", " (at) $1"), F.regexp_replace(s, r"@([A-Za-z0-9-]+)\..*$", "@$1")),
        (F.concat(F.lit("9"), F.lpad(s, 15, "7")), F.concat(s, F.lit(".1")), F.replace(s, F.lit("."), F.lit(":"))),
        (wrong, F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", "$1 ")),
        (d, F.regexp_replace(d, "^([0-9]{4})([0-9]{2})([0-9]{2})([0-9]*)$", "$1-$2-$3 $4"), F.concat(d, d)),
    )
    told = lambda k: F.array(*(F.struct(c.alias("text"), F.lit(y).alias("y")) for forms, y in ((good[k], 1), (bad[k], 0)) for c in forms))
    kind = x["kind"]
    return F.when(kind == EMAIL, told(EMAIL)).when(kind == IP, told(IP)).when(kind == CARD, told(CARD)).otherwise(told(PHONE))


def _found(docs: DataFrame) -> DataFrame:
    """``row`` (all of a row of ``docs``), its ``text``, ``base`` spans and ``loose`` candidates."""
    d = _flags(docs.select(F.struct("*").alias("row"), text_of().alias("text")), F.col("text"))
    text = F.col("text")
    base = F.concat(*(base_spans(text, k) for k in KINDS if k in BASE))
    loose = F.concat(*(_guarded(k, _matches(text, KINDS.index(k), LOOSE[k])) for k in KINDS))
    return d.select("row", "text", base.alias("base"), loose.alias("loose"))


def _described(x: Column) -> Column:
    """A candidate with its features, which are then one value that what follows refers to."""
    return F.struct(*(x[c].alias(c) for c in ("kind", "start", "end", "text")), _features(F.col("text"), x["kind"], x["text"], x["start"], x["end"]).alias("f"))


def _meets(x: Column, b: Column) -> Column:
    return (b["start"] < x["end"]) & (x["start"] < b["end"])


def examples(docs: DataFrame) -> DataFrame:
    """``held`` and ``e``, one row for each example: its features ``f`` and ``y``, 1 for data and 0 for what is none."""
    d = _found(docs)
    text = F.col("text")

    def of_base(x):
        return F.transform(_retold(x), lambda t: F.struct(_features(text, x["kind"], t["text"], x["start"], x["end"]).alias("f"), t["y"].alias("y")))

    def of_loose(x):
        own = F.exists("base", lambda b: (b["kind"] == x["kind"]) & _meets(x, b))
        other = F.exists("base", lambda b: (b["kind"] != x["kind"]) & _meets(x, b))
        named = F.when(other, 0).when(_context(text, x["start"]).rlike(NAMED), 1).otherwise(0)
        y = F.when(x["kind"] == SECRET, named).when(own, None).when(other | ~_holds(x["kind"], _plain(x["kind"], x["text"])), 0)
        f = x["f"]
        one = F.array(F.struct(f.alias("f"), y.alias("y")))
        prose = F.struct(f.withField("left", F.lit(0)).withField("right", F.lit(0)).alias("f"), F.lit(0).alias("y"))
        return F.when((x["kind"] == SECRET) & (named == 1) & (f["left"] == 3), F.concat(one, F.array(prose))).otherwise(one)

    told = F.concat(F.flatten(F.transform("base", of_base)), F.filter(F.flatten(F.transform(F.transform("loose", _described), of_loose)), lambda e: e["y"].isNotNull()))
    held = F.pmod(F.xxhash64("text", F.lit("pii")), F.lit(4)) == 0
    return d.where((F.size("base") > 0) | (F.size("loose") > 0)).select(held.alias("held"), F.explode(told).alias("e"))


def counts(docs: DataFrame) -> list[tuple[tuple[int, ...], int, bool, int]]:
    """``(features, y, held out, rows)``: at most as many as there are combinations of bins."""
    table = examples(docs).select("held", "e.y", "e.f.*").groupBy("held", "y", *FEATURES).agg(F.count("*").alias("n"))
    return [(tuple(int(r[f]) for f in FEATURES), int(r["y"]), r["held"], r["n"]) for r in table.collect()]


def _leaf(rows) -> float:
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    return RATE * g / (h + RIDGE)


def _split(rows):
    """The best ``(gain, feature, value)``: rows with ``feature <= value`` go left."""
    whole = sum(r[1] for r in rows) ** 2 / (sum(r[2] for r in rows) + RIDGE)
    best = (1e-6, None, None)
    for k in range(len(FEATURES)):
        bins: dict[int, list[float]] = {}
        for x, g, h in rows:
            b = bins.setdefault(x[k], [0.0, 0.0])
            b[0] += g
            b[1] += h
        gs, hs = sum(b[0] for b in bins.values()), sum(b[1] for b in bins.values())
        gl = hl = 0.0
        for v in sorted(bins)[:-1]:
            gl, hl = gl + bins[v][0], hl + bins[v][1]
            gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - whole
            if gain > best[0]:
                best = (gain, k, v)
    return best


def _tree(rows, depth: int):
    """``(feature, value, left, right)`` or a leaf's number."""
    gain, k, v = _split(rows) if depth else (0, None, None)
    if k is None:
        return _leaf(rows)
    return k, v, _tree([r for r in rows if r[0][k] <= v], depth - 1), _tree([r for r in rows if r[0][k] > v], depth - 1)


def _value(tree, x) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def fit(table, rounds: int = ROUNDS, depth: int = 3):
    """Trees and the threshold of each kind: half-way to the next lower score (infinite where no threshold is precise enough)."""
    forests, limits = [], []
    for kind in range(len(KINDS)):
        learn = [(x, y, n) for x, y, held, n in table if x[0] == kind and not held]
        sums = [0.0] * len(learn)
        trees = []
        for _ in range(rounds if learn else 0):
            rows = []
            for (x, y, n), s in zip(learn, sums):
                p = 1 / (1 + math.exp(-s))
                rows.append((x, n * (y - p), n * p * (1 - p)))
            tree = _tree(rows, depth)
            trees.append(tree)
            sums = [s + _value(tree, x) for (x, _, _), s in zip(learn, sums)]
        scored = sorted(((score(trees, x), y, n) for x, y, held, n in table if held and x[0] == kind), reverse=True)
        limit, hit, all_ = math.inf, 0, 0
        for k, (value, y, n) in enumerate(scored):
            hit, all_ = hit + y * n, all_ + n
            below = scored[k + 1][0] if k + 1 < len(scored) else value - 2
            if below < value and hit and hit >= PRECISION * all_:
                limit = (value + below) / 2
        forests.append(trees)
        limits.append(limit)
    return forests, limits


def score(trees, x) -> float:
    return sum(_value(t, x) for t in trees)


def _score(trees, f: Column) -> Column:
    def expr(tree):
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        k, v, left, right = tree
        return F.when(f[FEATURES[k]] <= v, expr(left)).otherwise(expr(right))

    total = F.lit(0.0)
    for tree in trees:
        total = total + expr(tree)
    return total


def with_spans(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``text``, ``base`` and ``spans``: base and added spans by kind, start and end, each once.

    A null text counts as empty. Rows that repeat each get their spans. A corpus without base spans
    of a kind (without assigned tokens, for secrets) gives no examples, and nothing of it is added.
    """
    forests, limits = fit(counts(docs))
    d = _found(docs)

    def added(x):
        f = x["f"]
        chosen = F.lit(False)
        for kind, (trees, least) in enumerate(zip(forests, limits)):
            if least < math.inf:
                chosen = F.when(x["kind"] == kind, _score(trees, f) >= F.lit(least)).otherwise(chosen)
        return ~F.exists("base", lambda b: _meets(x, b)) & chosen

    bare = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    every = F.concat(F.transform("base", bare), F.transform(F.filter(F.transform("loose", _described), added), bare))
    return d.select("row", "text", "base", F.array_sort(F.array_distinct(every)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind as listed and then start, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans by kind, the digest of the base spans, all spans, and how many those are."""
    d = with_spans(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    counted = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS) if name in BASE]
    return d.select(F.col("row.doc_id").cast("long").alias("doc_id"), *counted, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by the kind of its first, as in ``[EMAIL]``. Null texts stay null."""
    d = with_spans(docs)
    text = F.col("text")
    tags = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], kept, F.get(tags, x["kind"]))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"])))
    new = F.when(F.size("spans") > 0, done).otherwise(F.col("row.text"))
    return d.select(*(new.alias(c) if c == "text" else F.col(f"row.{q(c)}").alias(c) for c in docs.columns))


def q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
