"""Intensity of channels per object, in one aggregation for all channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions import names
from . import shape
from .shape import KEYS, objects


_WEIGHTED = ("Weighted", "CenterOf")


def skewness(v: Column) -> Column:
    """Third central moment over the cubed sample deviation."""
    n = F.count(v)
    return F.skewness(v) * F.pow((n - 1) / n, F.lit(1.5))


def kurtosis(v: Column) -> Column:
    """Excess of the fourth central moment over the sample deviation to the fourth."""
    n = F.count(v)
    return (F.kurtosis(v) + 3) * F.pow((n - 1) / n, F.lit(2.0)) - 3


def first_extreme(v: Column, largest: bool) -> Column:
    """The voxel of the extreme value; of equals the first in raster order."""
    at = E.struct_of(x=F.col("x"), y=F.col("y"), z=F.col("z"))
    if largest:
        return F.max_by(at, F.struct(v, -F.col("z"), -F.col("y"), -F.col("x")))
    return F.min_by(at, F.struct(v, "z", "y", "x"))


def _simple(v: Column, feature: str) -> Column | None:
    made = {
        "Mean": lambda: F.avg(v), "Minimum": lambda: F.min(v), "Maximum": lambda: F.max(v), "Sum": lambda: F.sum(v),
        "Variance": lambda: F.var_samp(v), "StandardDeviation": lambda: F.stddev_samp(v), "Skewness": lambda: skewness(v), "Kurtosis": lambda: kurtosis(v),
        "MaximumIndex": lambda: first_extreme(v, True), "MinimumIndex": lambda: first_extreme(v, False),
    }
    return made[feature]() if feature in made else None


def sums(channels, want, scale) -> dict[str, Column]:
    """The aggregates of the wanted features by name; weighted ones as moment sums in ``_m_<channel>``.

    Medians are no sums: see :func:`medians`.
    """
    out = {names.intensity(c, f): _simple(F.col(names.q(c)), f) for c in channels for f in want if f != "Median" and not f.startswith(_WEIGHTED)}
    if any(f.startswith(_WEIGHTED) for f in want):
        out |= {f"_m_{c}": F.struct(*shape.moment_sums(scale, F.col(names.q(c)))) for c in channels}
    return out


def medians(voxels: DataFrame, channels, keys=KEYS) -> DataFrame:
    """``<channel>_Median`` of each object: the middle value, or the mean of the two.

    Equal values are counted before they are shuffled, and running counts by value tell which are in the
    middle. So an object of 16-bit voxels is 65,536 rows at most, and no task holds its values.
    """
    kinds = F.array(*(F.struct(F.lit(k).alias("_c"), F.col(names.q(c)).cast("double").alias("_v")) for k, c in enumerate(channels)))
    at = [*keys, "_c"]
    n = objects(voxels).select(*keys, F.explode(kinds).alias("_o")).select(*keys, "_o.*").where("_v is not null").groupBy(*at, "_v").agg(F.count("*").alias("_n"))
    w = W.partitionBy(*at)
    n = n.withColumns({"_upto": F.sum("_n").over(w.orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)), "_all": F.sum("_n").over(w)})
    least = lambda k, place: F.min(F.when((F.col("_c") == k) & (F.col("_upto") >= place), F.col("_v")))
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return n.groupBy(*keys).agg(*(((least(k, low) + least(k, high)) / 2).alias(names.intensity(c, "Median")) for k, c in enumerate(channels)))


def finished(df: DataFrame, channels, want, scale) -> DataFrame:
    """``df`` with the weighted features in place of their sums."""
    weighted = [f for f in want if f.startswith(_WEIGHTED)]
    for c in channels if weighted else ():
        df = _weighted(df, c, weighted, scale)
    return df


def features(voxels: DataFrame, channels, props=names.INTENSITY_FEATURES, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """``<channel>_<Feature>`` of each object. The median is exact."""
    want = names.requested(props, names.INTENSITY_FEATURES)
    made = [v.alias(k) for k, v in sums(channels, want, scale).items()]
    out = objects(voxels).groupBy(*keys).agg(*made) if made else objects(voxels).select(*keys).distinct()
    if "Median" in want:
        out = out.join(medians(voxels, channels, keys), list(keys), "left")
    return finished(out, channels, want, scale).select(*keys, *(names.q(names.intensity(c, f)) for c in channels for f in want))


def _weighted(df: DataFrame, channel: str, want, scale) -> DataFrame:
    """Moments with the channel as weight, from the sums in ``_m_<channel>``."""
    held = df.columns
    m = df.select("*", f"{names.q(f'_m_{channel}')}.*")
    p = m.withColumn("_p", shape.principal(*shape.central(scale)))
    moments = F.col("_p.moments")
    made = {
        "WeightedElongation": shape.elongation(moments), "WeightedFlatness": shape.flatness(moments),
        "CenterOfGravity": F.struct(*(E.safe_divide(F.col(f"_{c}"), F.col("_w")).alias(c) for c in "xyz")),
        "WeightedPrincipalAxes": shape.named_axes(F.col("_p.axes")), "WeightedPrincipalMoments": F.struct(*(moments[i].alias(n) for i, n in enumerate("abc"))),
    }
    return p.select(*(names.q(c) for c in held if c != f"_m_{channel}"), *(made[f].alias(names.intensity(channel, f)) for f in want))
