"""Mixing sources to target weights with Efraimidis-Spirakis keys. DataFrame functions only.

Each document gets an exponential key ``-ln(u) / weight``, where ``u`` comes from a digest of
its id and ``weight`` is its quality weight, so that heavier documents tend to come first. A
source's target is met by whole epochs over the source and then by the documents of smallest
key until the token budget is spent. The prefix sums are taken in two steps, because one
source may hold a third of all rows: sizes are summed by narrow bins of the key (partial sums
before the shuffle), prefix sums over the bins find the one bin of each source in which the
budget ends, and only the documents of that bin are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, text_of, words_pattern

#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
#: A document or a source is taken this many times at most.
MOST_EPOCHS = 3
#: Bins to each factor e of the key, and fine bins to a bin: a fine bin holds some 0.37 / 256 / 4096 of a source's rows.
BINS, FINE = 256, 4096


def uniform(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) from the first 52 bits of the id's MD5 (of the text's where there is no id)."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), text), F.lit(f":{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def quality_weight(text: Column) -> Column:
    """1 for plain prose, down to 0.1 as marks of junk take the text over."""
    marks = F.length(text) - F.length(F.translate(text, "#$%&*|!@{}[]<>\\^~", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * marks / F.greatest(F.length(text), F.lit(1)))


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source``, ``source_size`` with the ``target`` of each.

    All sizes together are shared by weight; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. So with ``most * size / weight`` in ascending
    order, a prefix of the sources is at its limit and the rest get weight times one level. The
    tables here have one row for each source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*(F.lit(float(w)) for w in weights))
    s = sources.withColumn("weight", F.get(pattern, (F.row_number().over(order) - 1) % len(weights))).withColumn("limit", (F.col("source_size") * most).cast("double"))
    rise = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("rest", F.sum(F.col("source_size").cast("double")).over(W.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The first source that its share of the rest does not fill sets the level (later ones give a lower share); with only empty sources all is 0.
    s = s.withColumn("share", F.col("rest") / F.col("open"))
    level = F.max(F.when(F.col("limit") >= F.col("weight") * F.col("share"), F.col("share"))).over(W.partitionBy())
    return s.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * F.coalesce(level, F.lit(0.0))).alias("target"))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, key, bin, fine`` of each document; the text is not carried on."""
    text = text_of()
    key = -F.log(uniform(F.col("doc_id"), text, seed)) / quality_weight(text)
    return docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.regexp_count(text, F.lit(words_pattern())).cast("long").alias("size"), key.alias("key"),
    ).withColumn("bin", F.floor(F.log("key") * BINS).cast("long")).withColumn("fine", F.floor((F.log("key") * BINS - F.col("bin")) * FINE).cast("long"))


def _ends(rows: DataFrame, budgets: DataFrame, column: str) -> DataFrame:
    """``of, edge, left``: for each source the value of ``column`` at which its ``budget`` ends, and what is left of it there."""
    parts = rows.groupBy(F.col("source").alias("of"), column).agg(F.sum("size").alias("part"))
    upto = W.partitionBy("of").orderBy(column).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("part").over(upto), F.lit(0)))
    b = budgets.select(F.col("of").alias("_of"), "budget")
    parts = parts.join(b, F.col("of").eqNullSafe(F.col("_of"))).where("before <= budget and budget < before + part")
    return stored(parts.select("of", F.col(column).alias("edge"), (F.col("budget") - F.col("before")).alias("left")))


def mixture(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document.

    ``taken`` counts the words that the mix takes from the document, repeats included. Whole
    epochs come first; the document in which the remaining budget ends is taken for the words
    that are left, so each source's taken words are its target rounded down. Null and empty
    texts have size 0 and are never taken; a null source is a source of its own, the last in
    order. Rows that repeat a ``doc_id`` each count. Reruns give the same rows.
    """
    d = stored(sized(docs, seed))
    goal = targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = stored(goal.select(F.col("source").alias("of"), "source_size", "target", "epochs", (F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")).alias("budget")))
    # A source without an end has nothing left to take (its budget is 0) or is empty.
    ends = _ends(d, goal, "bin")
    within = ends.select(F.col("of").alias("_of"), F.col("edge").alias("edge_bin"), "left")
    last = d.join(within, d["source"].eqNullSafe(F.col("_of")) & (d["bin"] == F.col("edge_bin")))
    fine = _ends(last.select("source", "fine", "size"), ends.select("of", F.col("left").alias("budget")), "fine")
    marks = fine.select(F.col("of").alias("_end"), F.col("edge").alias("edge_fine"), F.col("left").alias("rest"))
    plan = goal.join(within.drop("left"), F.col("of").eqNullSafe(F.col("_of")), "left").join(marks, F.col("of").eqNullSafe(F.col("_end")), "left")
    plan = stored(plan.select("of", "source_size", "target", "epochs", "edge_bin", "edge_fine", "rest"))
    d = d.join(plan, d["source"].eqNullSafe(plan["of"]))
    whole = F.col("epochs") * F.col("size")
    here = (F.col("bin") == F.col("edge_bin")) & (F.col("fine") == F.col("edge_fine"))
    before = (F.col("bin") < F.col("edge_bin")) | ((F.col("bin") == F.col("edge_bin")) & (F.col("fine") < F.col("edge_fine")))
    sure = d.where(~F.coalesce(here, F.lit(False))).withColumn("taken", whole + F.when(before, F.col("size")).otherwise(F.lit(0)))
    run = W.partitionBy("of").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    end = d.where(here).withColumn("spent", F.coalesce(F.sum("size").over(run), F.lit(0)))
    end = end.withColumn("taken", whole + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("spent"))))
    out = ["doc_id", "size", "source_size", F.round("target", 6).alias("target"), F.col("taken").cast("long")]
    return sure.select(*out).union(end.select(*out))
