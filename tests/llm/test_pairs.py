"""Near-duplicates: embeddings, fingerprints, components."""

import itertools
import math

import numpy as np
import pytest
import xxhash
from oracle import compare, duck
from pyspark.sql import functions as F

from voxtab.llm import common, covertree, queries, simhash, simhash_sets


def reach(nodes, links):
    """Smallest node reached, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x]
    return out


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)]
    df = spark.createDataFrame([*edges, (None, 3), (3, None), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == reach({n for e in real for n in e}, real)
    assert common.components(df.limit(0)).count() == 0


# Embeddings.
def brute_vectors(rows, cosine=0.98):
    ok = [(i, lab, np.array(v, float)) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(k, m) for (k, (_, la, a)), (m, (_, lb, b)) in itertools.combinations(enumerate(ok), 2) if la == lb and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine]
    n = {}
    for k, m in links:
        n[k], n[m] = n.get(k, 0) + 1, n.get(m, 0) + 1
    ids = {i for i, _, _ in rows if i is not None}
    comp = reach(ids, [(ok[k][0], ok[m][0]) for k, m in links if ok[k][0] != ok[m][0]])
    out = sorted((ok[k][0], n.get(k, 0), comp[ok[k][0]]) for k in range(len(ok)))
    used = [id(r) for r in rows if any(r[0] == i and r[2] == lab and r[1] == v.tolist() for i, lab, v in ok)]
    return sorted(out + [(r[0], 0, comp[r[0]]) for r in rows if id(r) not in used and r[0] is not None])


@pytest.mark.parametrize(("block", "fanout"), [(8, 4), (8, 64), (1024, 256)])
def test_cover_tree_equals_brute(spark, monkeypatch, block, fanout):
    for name, value in (("BLOCK", block), ("FANOUT", fanout), ("SAMPLE", 4 * fanout), ("PART", 16)):
        monkeypatch.setattr(covertree, name, value)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(150):
        v = rng.standard_normal(6)
        if rows and rng.random() < 0.5:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.standard_normal(6) * 0.1
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(0, 2))))
    same = rows[3][1]
    rows += [(200 + i, same, rows[3][2]) for i in range(40)]
    rows += [(300, None, 1), (301, [0.0] * 6, 1), (302, [float("nan")] * 6, 1), (303, same, None), (304, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (305, same[:5], rows[3][2]), (306, [float("inf")] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("component_id", F.lit("clash"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df).collect())
    assert got == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in covertree.near_duplicates(df).collect())
    assert covertree.near_duplicates(df.limit(0)).count() == 0


def test_scaled_copies_and_lines(spark):
    """Very many vectors of one direction, or of two, end and link all with all of their direction."""
    both = spark.range(20000).select(F.col("id").alias("vec_id"), F.array((F.col("id") + 1) * 0.37, (F.col("id") + 1) * 0.74).alias("embedding"), F.lit(1).alias("label"))
    got = covertree.near_duplicates(both).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(19999, 0, 20000)]
    line = spark.range(3000).select(F.col("id").alias("vec_id"), F.array((F.col("id") - 1000).cast("float")).alias("embedding"), F.lit(1).alias("label"))
    got = {tuple(r) for r in covertree.near_duplicates(line).groupBy("n_links", "component_id").count().collect()}
    assert got == {(999, 0, 1000), (0, 1000, 1), (1998, 1001, 1999)}


@pytest.mark.parametrize("block", [16, 1024])
def test_tight_groups_equal_brute(spark, monkeypatch, block):
    """Groups within half the chord, whose pairs the bounds settle, beside single vectors and wider groups."""
    monkeypatch.setattr(covertree, "BLOCK", block)
    rng = np.random.default_rng(11)
    middles = rng.standard_normal((5, 12))
    rows = []
    for k, (n, wide) in enumerate([(120, 0.01), (90, 0.03), (60, 0.08), (40, 0.3), (30, 1.0)]):
        rows += [(len(rows) + i, (middles[k] * 1.3**i + rng.standard_normal(12) * wide * 1.3**i).tolist(), 0) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df).collect())
    assert got == brute_vectors(rows)


def test_doubles_are_not_rounded(spark):
    """Pairs a little above and below the cosine, of components too small for single precision."""
    angle = math.acos(0.98)
    rows = [(0, 0.0), (1, angle - 1e-9), (2, -angle - 1e-9)]
    df = spark.createDataFrame([(i, [math.cos(a) * 1e-200, math.sin(a) * 1e-200], 1) for i, a in rows], "vec_id long, embedding array<double>, label int")
    assert [tuple(r)[:3] for r in covertree.near_duplicates(df).orderBy("vec_id").collect()] == [(0, 1, 0), (1, 1, 0), (2, 0, 2)]


def test_tree_is_nested(monkeypatch):
    x = np.random.default_rng(12).standard_normal((400, 3))
    x /= np.linalg.norm(x, axis=1)[:, None]
    order, t = covertree.grow(x, 17)
    x = x[order]
    assert sorted(order) == list(range(400)) and order[t.centre[0]] == 17
    for k in range(len(t.lo)):
        own = np.arange(t.lo[k], t.hi[k])
        assert t.centre[k] in own and np.isclose(np.linalg.norm(x[own] - x[t.centre[k]], axis=1).max(), t.radius[k])
        kids = np.arange(t.kids[k], t.kids_end[k])
        if len(kids):
            assert t.centre[kids[0]] == t.centre[k] and (t.radius[kids] <= covertree.halved(t.radius[k]) + 1e-12).all()
            assert [*t.lo[kids], t.hi[kids[-1]]] == [t.lo[k], *t.hi[kids]]


def test_repeated_vector_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5), (1, [1.0, 0.0], 5), (None, [1.0, 0.0], 5)], "vec_id long, embedding array<float>, label int")
    assert sorted((r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df).where("vec_id = 1").collect()) == [(1, 1), (1, 1)]
    assert covertree.near_duplicates(df).where("vec_id is null").first()["n_links"] == 0


def test_embeddings_equal_sql(spark, sf):
    compare(spark, duck(sf), sf, queries.QUERIES["op1_cover_tree"], queries.ORACLES["op1_cover_tree"])


# Fingerprints.
def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << p for p in range(64) if 2 * sum(x >> p & 1 for x in h) > len(h))


def test_fingerprint_equals_brute(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "Ä b\x1cc \x0bd", *(" ".join(rng.choice(["x", "yy", "Zz", "é"], n)) for n in (5, 300, 9000))]
    assert [simhash.fingerprint(t, 3, 42) for t in texts] == [brute_fingerprint(t) for t in texts]
    # Spark's own hash of one string is the same function.
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def near(fp, rng, bits):
    out = int(fp)
    for p in rng.choice(64, bits, replace=False):
        out ^= 1 << int(p)
    return out


@pytest.mark.parametrize("large", [2, 2048])
def test_links_equal_brute(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE_KEY", large)
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64)]
    for _ in range(200):
        fps.append(near(fps[rng.integers(len(fps))], rng, int(rng.integers(1, 5))))
    fps = list(dict.fromkeys(fps))
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "rep long, fp long")
    got = {r["node"]: r["component"] for r in common.components(simhash.links(df, 2)).collect()}
    want = reach(range(len(fps)), [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert [got.get(i, i) for i in range(len(fps))] == [want[i] for i in range(len(fps))]


def test_close_pairs_of_a_large_group():
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 63, dtype=np.uint64))
    fps = np.array([near(base, rng, int(rng.integers(0, 6))) for _ in range(300)], np.uint64)
    group = np.repeat([0, 1], [260, 40])
    got = {(int(j), int(i)) for a, b in simhash.close_pairs(fps, group, 2) for i, j in zip(a, b)}
    want = {(i, j) for i, j in itertools.combinations(range(300), 2) if group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 2}
    assert got == want


def test_documents_equal_brute(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    want = reach(rows, [(a, b) for a, b in itertools.combinations(rows, 2) if (rows[a] ^ rows[b]).bit_count() <= 2])
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in queries.QUERIES["op6_simhash"](spark, sf).collect()}
    assert got == {i: (rows[i], want[i]) for i in rows}


def test_simhash_odd_rows(spark):
    df = spark.createDataFrame([(5, None, 1), (3, "", 2), (None, "", 3), (4, "a b c d", 4), (4, "A B  c d", 5), (9, "a b c d", 6)], "doc_id long, text string, fp int")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, -1), (3, 3), (4, 4), (4, 4), (5, 3), (9, 4)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def edited(text, rng, share):
    words = text.split()
    for i in rng.choice(len(words), max(1, int(share * len(words))), replace=False):
        words[i] = f"zq{rng.integers(1e9)}"
    return " ".join(words)


def test_one_of_each(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(80, 400)))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, edited(texts[i], rng, 0.01)) for i in range(30)] + [(200 + i, f" {texts[5].upper()}\n") for i in range(20)]
    fresh = " ".join(rng.choice(vocabulary, 100))
    # Without an id: like a row that has one; two rows of one text; one text more. With one: a repeated row, two texts under one id.
    rows += [(None, texts[0]), (None, fresh), (None, fresh), (None, None), (3, texts[3]), (70, texts[9]), (70, " ".join(rng.choice(vocabulary, 90)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit(1)).withColumn("node", F.lit("x"))
    kept = simhash_sets.one_of_each(df)
    assert kept.columns == df.columns
    got = kept.collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i is not None) == [*range(60), 70]
    assert sorted(r["text"] or "" for r in got if r["doc_id"] is None) == ["", fresh]
    assert [r["text"] for r in got if r["doc_id"] == 70] == [rows[-1][1]]
    assert simhash_sets.one_of_each(df.limit(0)).count() == 0
    clashing = df.withColumns({c: F.lit(1) for c in ("_number", "number", "row", "_id", "_hash", "component_id")})
    assert sorted(r["doc_id"] or -1 for r in simhash_sets.one_of_each(clashing).collect()) == sorted(r["doc_id"] or -1 for r in kept.collect())


def brute_components(texts):
    """Smallest index of each text's component, by all pairs of five-word sets."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    alike = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
    return reach(range(len(texts)), [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if alike(sets[i], sets[j])])


@pytest.mark.parametrize(("crowd", "block", "rounds"), [(1024, 256, 3), (7, 5, 1), (1024, 256, 0)])
def test_set_join_equals_all_pairs(spark, monkeypatch, crowd, block, rounds):
    for name, value in (("CROWD", crowd), ("BLOCK", block), ("ROUNDS", rounds)):
        monkeypatch.setattr(simhash_sets, name, value)
    rng = np.random.default_rng(7)
    fresh = lambda n: [f"w{i}" for i in rng.integers(0, 3000, n)]
    texts = [" ".join(fresh(int(rng.integers(3, 250)))) for _ in range(60)]
    texts += [edited(texts[i % 60], rng, s) for i, s in enumerate(np.repeat([0.01, 0.02, 0.03, 0.05], 40))]
    texts += [edited(texts[1], rng, 0.02) for _ in range(150)]  # one text in many copies, about half of their pairs alike
    passage = fresh(60)
    texts += [" ".join([*passage, *fresh(int(rng.integers(1, 30)))]) for _ in range(150)]  # mostly a shared passage
    line = " ".join(fresh(12))
    texts += [" ".join([*[line] * 30, *fresh(40)]) for _ in range(20)] + ["", " \n", "a b", "A  b", "a b c"]  # a repeated line is one
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["component_id"] for r in simhash_sets.near_duplicates(df).collect()}
    assert got == brute_components(texts)
    assert simhash_sets.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize(("own", "shared"), [(45, 360), (1, 8), (2, 16)])
def test_band_keys_meet(own, shared):
    """Pairs at 0.8 exactly share a key and lie within the radius, however many texts there are."""
    rng = np.random.default_rng(8)
    met, near = 0, 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 63, shared + 2 * own, np.uint64))
        order = rng.permutation(len(x))
        a, b = np.sort(x[order[: shared + own]]), np.sort(x[np.r_[order[:shared], order[shared + own :]]])
        met += bool((simhash_sets.band_keys(a) == simhash_sets.band_keys(b)).any())
        near += bin(int.from_bytes((simhash_sets.wide_fingerprint(a) ^ simhash_sets.wide_fingerprint(b)).tobytes(), "little")).count("1") <= simhash_sets.RADIUS
    assert met == near == 400
