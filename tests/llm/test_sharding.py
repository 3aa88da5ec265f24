"""Rendezvous hashing: the law, weights, changes of the shards, places without gaps, rows of every kind."""

import zlib
from collections import Counter, defaultdict

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from voxtab.llm import queries, sharding


def test_query_equals_sql(spark, sf):
    compare(spark, duck(sf), sf, queries.QUERIES["op12_rendezvous"], queries.ORACLES["op12_rendezvous"])


def test_few_records_move(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    eight, nine = sharding.equal_weights(8), sharding.equal_weights(9)
    grown = sharding.moves(keys, eight, nine).collect()
    assert {r["target"] for r in grown} == {8} and abs(sum(r["n"] for r in grown) / 20_000 - 1 / 9) < 0.01
    lost = sharding.moves(keys, eight, {s: w for s, w in eight.items() if s != 3}).collect()
    assert {r["source"] for r in lost} == {3} and abs(sum(r["n"] for r in lost) / 20_000 - 1 / 8) < 0.01
    heavier = sharding.moves(keys, eight, eight | {2: 2.0}).collect()
    assert {r["target"] for r in heavier} == {2}
    assert sharding.moves(keys, eight, dict(eight)).count() == 0


def test_shares_by_weight(spark):
    keys = spark.range(30_000).withColumnRenamed("id", "doc_id")
    got = {r["shard"]: r["count"] for r in sharding.sharded(keys, {0: 1.0, 1: 2.0, 5: 3.0, 7: 0.0}).groupBy("shard").count().collect()}
    assert set(got) == {0, 1, 5}
    assert all(abs(got[s] / 30_000 - w / 6) < 0.012 for s, w in ((0, 1), (1, 2), (5, 3)))
    for bad in ({}, {0: 0.0}, {0: 1.0, 1: -1.0}):
        with pytest.raises(ValueError, match="weight"):
            sharding.shard_of(F.lit("a"), bad)


def test_rows_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 7)  # equal records in several pieces
    rows = [(k % 40, f"text {k % 11}" if k % 5 else None) for k in range(400)] + [(None, "a")] * 30 + [(None, None)] * 3 + [(7, "same")] * 100 + [(9, ""), (10, "é" * 20_000)]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, slot int, shard int, n string")
    out = sharding.placed(docs).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, 1 + len((t or "").encode()), crc(t)) for i, t in rows)
    places, of = defaultdict(list), defaultdict(set)
    for r in out:
        places[r["shard"]].append(r["slot"])
        of[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(s) == 1 for s in of.values())
    again = sharding.placed(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert sharding.placed(docs.limit(0)).count() == 0


def test_written_shards_hold_all_rows(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, {0: 1.0, 4: 2.0})
    back = spark.read.parquet(path)
    assert back.select("shard").distinct().count() == 2 and back.drop("shard").exceptAll(docs).isEmpty() and back.count() == docs.count()


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op12_rendezvous"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
