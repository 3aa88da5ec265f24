"""Colocalization of two channels within each object.

Objects of fewer than two voxels, and cases in which a measure is not defined, give null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..sources.tables import checkpointed
from .shape import KEYS, objects

BINS = 10
#: Voxels to a task that ranks them, about: sorts hold them several times over.
RANKED = 250_000
#: Objects of more voxels are ranked in many tasks each.
LARGE = 50_000


def _two(voxels: DataFrame, a: str, b: str, keys) -> DataFrame:
    return objects(voxels).select(*keys, F.col(names.q(a)).cast("double").alias("a"), F.col(names.q(b)).cast("double").alias("b")).where("a is not null and b is not null")


def pearson_of(a: str, b: str) -> Column:
    """Pearson's correlation as an aggregate; null where it is not defined."""
    x, y = (F.col(names.q(c)).cast("double") for c in (a, b))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.when((F.count(x) >= 2) & (F.min(x) != F.max(x)) & (F.min(y) != F.max(y)), F.corr(x, y))


def pearson(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    return objects(voxels).groupBy(*keys).agg(pearson_of(a, b).alias("value"))


def _counted(t: DataFrame, keys) -> DataFrame:
    """Equal pairs of values of an object as one row with their number ``n``."""
    return t.groupBy(*keys, "a", "b").agg(F.count("*").alias("n"))


def _out_of_order(cells: DataFrame, keys) -> DataFrame:
    """``cells`` once for each bit ``_l`` of b's rank, from 0; ``_w`` sums to the number of pairs of voxels out of order.

    Pairs are told by the highest bit in which two ranks of b differ: among the rows that agree above a bit, in
    order of a, each row without the bit comes after those with it that stand before.
    """
    of = W.partitionBy(*keys)
    t = cells.withColumn("_b", F.dense_rank().over(of.orderBy("b")).cast("long")).withColumn("_most", F.max("_b").over(of))
    level = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_most") + 1)).cast("int") - 1))
    bits = t.withColumn("_l", F.explode(level)).withColumns({"_bit": F.expr("shiftright(_b, _l) & 1"), "_above": F.expr("shiftright(_b, _l + 1)")}).drop("_b", "_most")
    before = W.partitionBy(*keys, "_l", "_above").orderBy("a", "b").rowsBetween(W.unboundedPreceding, W.currentRow)
    return bits.withColumn("_w", F.when(F.col("_bit") == 0, F.col("n") * F.sum(F.col("_bit") * F.col("n")).over(before)).otherwise(0))


def _pairs(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def _rho(ab: Column, aa: Column, bb: Column) -> Column:
    return ab / (F.sqrt(aa) * F.sqrt(bb))


def _tau(n: Column, a: Column, b: Column, ab: Column, wrong: Column) -> Column:
    """From the numbers of pairs: all, equal in a, in b, in both, and out of order."""
    return (n - a - b + ab - 2 * wrong) / (F.sqrt(n - a) * F.sqrt(n - b))


def _ranks(t: DataFrame, keys, metrics) -> DataFrame:
    """The rank correlations of ``a`` and ``b`` by key, as columns named by metric, of rows that lie by key."""
    of, n = W.partitionBy(*keys), F.col("n")
    t = _counted(t, keys)
    for c in "ab":
        t = t.withColumn(f"_to{c}", F.sum("n").over(of.orderBy(c))).withColumn(f"_s{c}", F.sum("n").over(W.partitionBy(*keys, c)))
    sums = {}
    if "SpearmanR" in metrics:  # equal values share the middle of their places; the mean of all ranks is taken off
        t = t.withColumn("_all", F.sum("n").over(of))
        x, y = (F.col(f"_to{c}") - (F.col(f"_s{c}") - 1) / 2.0 - (F.col("_all") + 1) / 2.0 for c in "ab")
        sums |= {"_ab": n * x * y, "_aa": n * x * x, "_bb": n * y * y}
    if "KendallTau" in metrics:  # a cell has its share of the pairs that are equal in a value
        sums |= {"_ta": n * (F.col("_sa") - 1) / 2, "_tb": n * (F.col("_sb") - 1) / 2, "_tab": _pairs(n)}
    t = t.select(*keys, "a", "b", "n", *(v.alias(k) for k, v in sums.items()))
    t = _out_of_order(t, keys) if "KendallTau" in metrics else t.withColumns({"_l": F.lit(0), "_w": F.lit(0)})
    once = {c: F.sum(F.when(F.col("_l") == 0, F.col(c))) for c in ("n", *sums)}
    value = {}
    if "SpearmanR" in metrics:
        value["SpearmanR"] = _rho(once["_ab"], once["_aa"], once["_bb"])
    if "KendallTau" in metrics:
        value["KendallTau"] = _tau(_pairs(once["n"]), once["_ta"], once["_tb"], once["_tab"], F.sum("_w"))
    defined = (F.min("a") != F.max("a")) & (F.min("b") != F.max("b"))
    return t.groupBy(*keys).agg(*(F.when(defined, value[m]).alias(m) for m in metrics))


def _ranks_of_large(t: DataFrame, keys, metrics, tasks: int) -> DataFrame:
    """As :func:`_ranks`, with the cells of an object dealt into many tasks, by ranges of its values.

    Of two cells out of order, either both lie in one range of (a, b), or in two of these and in one range of (b, a), or in two
    of each: so ranges take the place of a, then of b, and three sets of groups hold every pair of cells once. A range
    may part equal values, since those are in order by the other value.
    """
    def ranged(df: DataFrame, name: str, *by) -> DataFrame:
        return checkpointed(df.repartitionByRange(tasks, *keys, *by).withColumn(name, F.spark_partition_id()))

    def ranked(c: str) -> DataFrame:
        m = ranged(cells.groupBy(*keys, c).agg(F.sum("n").alias("_s")), "_i", c)
        parts = m.groupBy(*keys, "_i").agg(F.sum("_s").alias("_m")).withColumn("_before", F.sum("_m").over(W.partitionBy(*keys).orderBy("_i")) - F.col("_m"))
        m = m.repartition(tasks, *keys, "_i").withColumn("_to", F.sum("_s").over(W.partitionBy(*keys, "_i").orderBy(c))).join(parts, [*keys, "_i"])
        return m.select(*keys, c, (F.col("_before") + F.col("_to") - (F.col("_s") - 1) / 2.0).alias(f"_r{c}"))

    cells = ranged(ranged(_counted(t, keys), "i", "a", "b"), "j", "b", "a")
    out = cells.groupBy(*keys).agg(F.sum("n").alias("_n"), F.sum(_pairs(F.col("n"))).alias("_tab"), *(f(c).alias(f"_{k}{c}") for c in "ab" for k, f in (("lo", F.min), ("hi", F.max))))
    value, n = {}, F.col("_n")
    if "SpearmanR" in metrics:
        x, y = (F.col(f"_r{c}") - (n + 1) / 2.0 for c in "ab")
        w = cells.join(ranked("a"), [*keys, "a"]).join(ranked("b"), [*keys, "b"]).join(F.broadcast(out.select(*keys, "_n")), list(keys))
        out = out.join(w.groupBy(*keys).agg(*(F.sum(F.col("n") * v).alias(k) for k, v in (("_ab", x * y), ("_aa", x * x), ("_bb", y * y)))), list(keys))
        value["SpearmanR"] = _rho(*(F.col(c) for c in ("_ab", "_aa", "_bb")))
    if "KendallTau" in metrics:
        for c in "ab":
            out = out.join(cells.groupBy(*keys, c).agg(F.sum("n").alias("_s")).groupBy(*keys).agg(F.sum(_pairs(F.col("_s"))).alias(f"_t{c}")), list(keys))
        grid = cells.groupBy(*keys, "i", "j").agg(F.sum("n").alias("n"))
        groups = [(cells, 0, F.col("i"), "a", "b"), (cells, 1, F.col("j"), "i", "b"), (grid, 2, F.lit(0), "i", "j")]
        sets = [df.select(*keys, F.lit(k).alias("_set"), g.alias("_group"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"), "n") for df, k, g, a, b in groups]
        within = [*keys, "_set", "_group"]
        wrong = _out_of_order(reduce(DataFrame.unionByName, sets).repartition(tasks * 2, *within), within).groupBy(*keys).agg(F.sum("_w").alias("_wrong"))
        out = out.join(wrong, list(keys))
        value["KendallTau"] = _tau(_pairs(n), *(F.col(c) for c in ("_ta", "_tb", "_tab", "_wrong")))
    defined = (F.col("_loa") != F.col("_hia")) & (F.col("_lob") != F.col("_hib"))
    return out.select(*keys, *(F.when(defined, value[m]).alias(m) for m in metrics))


def _dealing(t: DataFrame, keys) -> tuple[int, DataFrame | None]:
    """The number of tasks that the rows need, and the keys of large objects, if any."""
    sizes = t.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    tasks = max(int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // RANKED))
    return tasks, sizes.where(F.col("_n") > LARGE).select(*keys) if (most or 0) > LARGE else None


def _dealt(t: DataFrame, keys, tasks: int | None = None) -> DataFrame:
    """``t`` dealt by object into as many tasks as its rows need, so that what a task sorts does not grow with the input."""
    return t.repartition(tasks or _dealing(t, keys)[0], *keys)


def _ranked(t: DataFrame, keys, metrics, dealing=None) -> DataFrame:
    """The rank correlations by key: objects are dealt into tasks, and large ones into many."""
    tasks, large = dealing or _dealing(t, keys)
    if large is None:
        return _ranks(_dealt(t, keys, tasks), keys, metrics)
    large = F.broadcast(large)
    rest = _ranks(_dealt(t.join(large, list(keys), "left_anti"), keys, tasks), keys, metrics)
    return rest.unionByName(_ranks_of_large(t.join(large, list(keys), "left_semi"), keys, metrics, tasks))


def spearman(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    return _ranked(_two(voxels, a, b, keys), keys, ("SpearmanR",)).withColumnRenamed("SpearmanR", "value")


def kendall(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    """Kendall's rank correlation, ties accounted for. Windows count the pairs out of order; no task holds a large object."""
    return _ranked(_two(voxels, a, b, keys), keys, ("KendallTau",)).withColumnRenamed("KendallTau", "value")


def _binned(t: DataFrame, keys) -> DataFrame:
    """Counts of each object's two-way histogram of ``BINS`` equal bins between its least and largest values."""
    ends = t.groupBy(*keys).agg(*(f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))))
    t = t.join(ends, list(keys))

    def at(c: str) -> Column:
        flat = F.col(f"hi_{c}") == F.col(f"lo_{c}")
        width = F.when(flat, F.lit(1.0)).otherwise(F.col(f"hi_{c}") - F.col(f"lo_{c}"))
        low = F.when(flat, F.col(f"lo_{c}") - 0.5).otherwise(F.col(f"lo_{c}"))
        return F.least(F.floor((F.col(c) - low) / width * BINS), F.lit(BINS - 1)).cast("int")

    return t.groupBy(*keys, at("a").alias("i"), at("b").alias("j")).agg(F.count("*").alias("n"))


def _cells(t: DataFrame, keys) -> DataFrame:
    """Counts of each object's pairs of raw values."""
    return t.groupBy(*keys, F.col("a").alias("i"), F.col("b").alias("j")).agg(F.count("*").alias("n"))


def _with_margins(cells: DataFrame, keys) -> DataFrame:
    return cells.withColumn("ni", F.sum("n").over(W.partitionBy(*keys, "i"))).withColumn("nj", F.sum("n").over(W.partitionBy(*keys, "j"))).withColumn("all", F.sum("n").over(W.partitionBy(*keys)))


def _histogram(t: DataFrame, keys, metrics=("Chi2Contingency", "MutualInfoBins")) -> DataFrame:
    """What the two-way histogram gives, as columns named by metric."""
    return _measured(_binned(t, keys), keys, metrics)


def _values(t: DataFrame, keys, metrics=("MutualInfo", "MutualInfoNormalized")) -> DataFrame:
    """What the pairs of raw values give, as columns named by metric."""
    return _measured(_cells(t, keys), keys, metrics)


def _measured(cells: DataFrame, keys, metrics) -> DataFrame:
    c = _with_margins(cells, keys)
    p = F.col("n") / F.col("all")
    mi = F.greatest(F.lit(0.0), F.sum(p * F.log(F.col("n") * F.col("all") / (F.col("ni") * F.col("nj")))))
    # A margin's entropy is summed over cells: each cell adds its share of the margin's term.
    both = -F.sum(p * F.log(F.col("ni") / F.col("all"))) - F.sum(p * F.log(F.col("nj") / F.col("all")))
    enough = F.max("all") >= 2
    whole = (F.count_distinct("i") == BINS) & (F.count_distinct("j") == BINS) & enough
    of = {
        "Chi2Contingency": lambda: F.when(whole, F.max("all") * (F.sum(F.col("n") * F.col("n") / (F.col("ni") * F.col("nj"))) - 1)),
        "MutualInfoBins": lambda: F.when(enough, mi), "MutualInfo": lambda: F.when(enough, mi),
        "MutualInfoNormalized": lambda: F.when(enough, F.when(both > 0, mi / (both / 2)).otherwise(F.lit(1.0))),
    }
    return c.groupBy(*keys).agg(*(of[m]().alias(m) for m in metrics))


def chi2(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    """The statistic of independence; null where a row or column of the histogram is empty."""
    return _histogram(_two(voxels, a, b, keys), keys, ("Chi2Contingency",)).withColumnRenamed("Chi2Contingency", "value")


def mutual_info(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    return _values(_two(voxels, a, b, keys), keys, ("MutualInfo",)).withColumnRenamed("MutualInfo", "value")


def mutual_info_bins(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    return _histogram(_two(voxels, a, b, keys), keys, ("MutualInfoBins",)).withColumnRenamed("MutualInfoBins", "value")


def mutual_info_normalized(voxels: DataFrame, a: str, b: str, keys=KEYS) -> DataFrame:
    return _values(_two(voxels, a, b, keys), keys, ("MutualInfoNormalized",)).withColumnRenamed("MutualInfoNormalized", "value")


METRICS = {
    "PearsonR": pearson, "SpearmanR": spearman, "KendallTau": kendall, "Chi2Contingency": chi2, "MutualInfo": mutual_info,
    "MutualInfoBins": mutual_info_bins, "MutualInfoNormalized": mutual_info_normalized,
}


def features(voxels: DataFrame, pairs, metrics=names.DEFAULT_COLOC_FEATURES, keys=KEYS) -> DataFrame:
    """``<a>|<b>_<Metric>`` of each object and pair of channels.

    Pearson's of all pairs come from sums, in one aggregation. For the others all pairs go through one
    exchange: a voxel is a row for each pair, dealt by object and pair, and every family of metrics (those
    that rest on one table) works within what lies there.
    """
    asked, pairs, at = names.requested(metrics, METRICS), list(pairs), [*keys, "_pair"]
    linear = [pearson_of(a, b).alias(names.coloc(a, b, "PearsonR")) for a, b in pairs if "PearsonR" in asked]
    ids = objects(voxels).groupBy(*keys).agg(*linear) if linear else objects(voxels).select(*keys).distinct()
    rest = [m for m in asked if m != "PearsonR"]
    if not (rest and pairs):
        return ids
    values = F.array(*(F.struct(F.lit(k).alias("_pair"), *(F.col(names.q(c)).cast("double").alias(n) for n, c in zip("ab", pair))) for k, pair in enumerate(pairs)))
    t = objects(voxels).select(*keys, F.explode(values).alias("_v")).select(*keys, "_v.*").where("a is not null and b is not null")
    ranks = [m for m in ("SpearmanR", "KendallTau") if m in rest]
    dealing = _dealing(t, at) if ranks else None
    parts = [_ranked(t, at, ranks, dealing)] if ranks else []
    t = _dealt(t, at, dealing[0]) if ranks else t.repartition(*at)
    for family, of in ((_histogram, ("Chi2Contingency", "MutualInfoBins")), (_values, ("MutualInfo", "MutualInfoNormalized"))):
        if mine := tuple(m for m in of if m in asked):
            parts.append(family(t, at, mine))
    wide = reduce(lambda x, y: x.join(y, at), parts)
    wide = wide.groupBy(*keys).agg(*(F.first(F.when(F.col("_pair") == k, F.col(m)), ignorenulls=True).alias(names.coloc(a, b, m)) for k, (a, b) in enumerate(pairs) for m in rest))
    return ids.join(wide, list(keys), "left")


def corrected(voxels: DataFrame, factors: dict[str, Column]) -> DataFrame:
    """The voxels with channels multiplied by their correction factors."""
    return voxels.withColumns({c: F.col(names.q(c)) * f for c, f in factors.items()})


__all__ = ["METRICS", "chi2", "corrected", "features", "kendall", "mutual_info", "mutual_info_bins", "mutual_info_normalized", "pearson", "spearman"]
