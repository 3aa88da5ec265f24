"""Sharding by rendezvous hashing of record keys over weighted shards. DataFrame functions only.

Each shard draws a number for each key, exponential with the shard's weight as its rate, and the
smallest draw takes the key: so a shard gets its share of the keys by weight, and the draws of the
others do not change when one comes, goes or changes its weight. A new shard takes keys into itself
only, a lost one gives up its own only, a change of weight moves keys to or from that shard only.

A place within a shard comes without sorting the shard: records are counted by shard and bin of
their digest, prefix sums over the bins say where each begins, and a window orders the records
of one bin. Equal records are counted before they are moved, so a hot one is one row until
the end, where its places are dealt out in pieces.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, text_of

#: Shards of the query, all of one weight.
SHARDS = 8
#: Hex digits of a record's digest that make its bin: a shard has 16 times as many bins for each.
BIN_DIGITS = 3
#: Most equal records in a row whose places are dealt out by one task at a time.
PIECE = 1 << 16


def equal_weights(count: int) -> dict[int, float]:
    """``count`` shards of weight 1, from 0 on."""
    return dict.fromkeys(range(count), 1.0)


def draw(key: Column, shard: int, seed: str = "shard") -> Column:
    """An exponential number of rate 1 from the first 52 bits of the MD5 of key and shard."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}:{seed}")).cast("binary"))
    return -F.log((F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52)))


def shard_of(key: Column, weights: Mapping[int, float], seed: str = "shard") -> Column:
    """The shard of a key: the smallest draw over weight, of equals the smaller number. Shards of weight 0 take nothing.

    A null key is one key, as the empty string is.
    """
    if not (taking := {s: float(w) for s, w in weights.items() if w > 0}) or min(weights.values()) < 0:
        raise ValueError("some shard needs a weight above 0, and none may have one below")
    key = F.coalesce(key.cast("string"), F.lit(""))
    return F.array_min(F.array(*(F.struct((draw(key, s, seed) / F.lit(w)).alias("d"), F.lit(s).alias("s")) for s, w in sorted(taking.items()))))["s"]


def sharded(docs: DataFrame, weights: Mapping[int, float], key: str = "doc_id", column: str = "shard", seed: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row, which takes the place of a column of that name. Nothing is shuffled."""
    return docs.withColumn(column, shard_of(F.col(key), weights, seed))


def moves(docs: DataFrame, before: Mapping[int, float], after: Mapping[int, float], key: str = "doc_id", seed: str = "shard") -> DataFrame:
    """``source, target, n``: how many rows each change of the shards moves from where to where; rows that stay are not counted."""
    both = docs.select(shard_of(F.col(key), before, seed).alias("source"), shard_of(F.col(key), after, seed).alias("target"))
    return both.where("source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


def write_shards(docs: DataFrame, path: str, weights: Mapping[int, float], key: str = "doc_id", seed: str = "shard") -> None:
    """The rows of ``docs`` as Parquet with one folder ``shard=…`` each. Every task writes what it holds, so no shard lies in one task."""
    sharded(docs, weights, key, "shard", seed).write.partitionBy("shard").parquet(path)


def records(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, n``: how often each record occurs. ``size`` is the text's UTF-8 bytes and one; a null text has none."""
    text = text_of()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return d.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))


def placed(docs: DataFrame, weights: Mapping[int, float] | None = None, grown: Mapping[int, float] | None = None, seed: str = "shard") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    The law is ``key``: the id and the shards decide. ``slot`` counts from 0 in each shard without a gap, in
    the order of a digest of the record, so reruns give the same rows however the input is split.
    ``grown_shard`` is the shard once the shards are ``grown`` (by default one more of weight 1, with the next
    number). Null texts have size 1; rows without an id share one key; repeated rows get slots of
    their own; an empty table gives none; further columns are not read.
    """
    weights = equal_weights(SHARDS) if weights is None else weights
    grown = {**weights, max(weights) + 1: 1.0} if grown is None else grown
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("text_crc32").cast("string")).cast("binary"))
    d = records(docs).withColumns({"digest": digest, "shard": shard_of(F.col("doc_id"), weights, seed), "grown_shard": shard_of(F.col("doc_id"), grown, seed)})
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PIECE).cast("long"))))
    d = stored(d.withColumn("n", F.least(F.col("n") - F.col("piece"), F.lit(PIECE))).withColumn("bin", F.substring("digest", 1, BIN_DIGITS)))
    upto = lambda by, order: W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    bins = d.groupBy("shard", "bin").agg(F.sum("n").alias("held"))
    bins = bins.select("shard", "bin", F.coalesce(F.sum("held").over(upto(["shard"], ["bin"])), F.lit(0)).alias("begin"))
    before = F.coalesce(F.sum("n").over(upto(["shard", "bin"], ["digest", "doc_id", "size", "text_crc32", "piece"])), F.lit(0))
    d = d.join(bins, ["shard", "bin"]).withColumn("first", F.col("begin") + before)
    # Pieces of a hot record leave the task of their bin before they become rows.
    d = d.repartition("shard", "first").withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    return d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))


__all__ = ["draw", "equal_weights", "moves", "placed", "records", "shard_of", "sharded", "write_shards"]
