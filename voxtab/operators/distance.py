"""Distances of objects to and along another object's mask."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..sources.tables import checkpointed
from . import intensity
from .shape import KEYS, objects

#: Lines that one task takes at a time.
LINES = 32
_ENDS = [f"{n}_{c}" for c in "zyx" for n in ("lo", "hi")]
_AXIS = {"DistanceAlongZ": "z", "DistanceAlongY": "y", "DistanceAlongX": "x"}


def along(voxels: DataFrame, function: str, mask: str, scale=(1.0, 1.0, 1.0)) -> DataFrame:
    """The voxels with ``d``: mask voxels so far along the axis, the own one included, times their size."""
    c = _AXIS[function]
    size = dict(zip("zyx", scale))[c]
    line = W.partitionBy("ROI", *(a for a in "zyx" if a != c)).orderBy(c).rowsBetween(W.unboundedPreceding, W.currentRow)
    return voxels.withColumn("d", F.sum(F.col(names.q(mask)).cast("boolean").cast("long")).over(line) * F.lit(float(size)))


def _parabolas(f: np.ndarray, size: float) -> np.ndarray:
    """Lower envelope of parabolas of each row: ``min_j f[j] + (size (i - j))²``, exact, with candidates taken in order of distance."""
    out = f.copy()
    for k in range(1, f.shape[1]):
        step = (size * k) ** 2
        if step >= out.max(initial=0.0):
            break
        np.minimum(out[:, k:], f[:, :-k] + step, out=out[:, k:])
        np.minimum(out[:, :-k], f[:, k:] + step, out=out[:, :-k])
    return out


def _pass(rows: DataFrame, axis: str, size: float) -> DataFrame:
    """One of the three passes: along the lines of an axis, ``to_out`` and ``to_in`` grow by the way along it.

    A task gets the lines of ``LINES`` places across. Places without a row are outside, with none inside on
    the lines taken so far; they get a row once there is one.
    """
    across = [c for c in "zyx" if c != axis]

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        low, n = int(f[f"lo_{axis}"].iloc[0]), int(f[f"hi_{axis}"].iloc[0] - f[f"lo_{axis}"].iloc[0]) + 1
        line, of = np.unique(f[across[1]].to_numpy(), return_inverse=True)
        at = f[axis].to_numpy() - low
        to_out, to_in, there = np.zeros((len(line), n)), np.full((len(line), n), np.inf), np.zeros((len(line), n), bool)
        to_out[of, at], to_in[of, at], there[of, at] = f["to_out"], f["to_in"], f["there"]
        to_out, to_in = _parabolas(to_out, size), _parabolas(to_in, size)
        i, j = np.nonzero(there | np.isfinite(to_in))
        made = {"ROI": f["ROI"].iloc[0], across[0]: f[across[0]].iloc[0], across[1]: line[i], axis: j + low, "to_out": to_out[i, j], "to_in": to_in[i, j], "there": there[i, j]}
        return pd.DataFrame(made | {c: f[c].iloc[0] for c in _ENDS})[list(kinds)]

    kinds = dict(rows.dtypes)
    # Lines are few bytes but long work, which partitions joined by their bytes would hide.
    tasks, by = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["ROI", across[0], F.floor(F.col(across[1]) / LINES)]
    return rows.repartition(tasks, *by).groupBy(*by).applyInPandas(run, ", ".join(f"{c} {t}" for c, t in kinds.items()))


def to_border(voxels: DataFrame, mask: str, scale=(1.0, 1.0, 1.0)) -> DataFrame:
    """``ROI, z, y, x, d``: distance to the mask's border, positive inside, null where the region has no border.

    Exact, by one pass over the lines of each axis; no task holds more than ``LINES`` lines. Absent voxels
    of a region's box count as outside.
    """
    kinds = dict(voxels.dtypes)
    inside = F.coalesce(F.col(names.q(mask)).cast("boolean"), F.lit(False))
    v = voxels.select("ROI", *(F.col(c).cast("long").alias(c) for c in "zyx"), inside.alias("inside"))
    ends = v.groupBy("ROI").agg(*(f(c).alias(f"{n}_{c}") for c in "zyx" for n, f in (("lo", F.min), ("hi", F.max))))
    away = F.lit(float("inf"))
    d = v.select("ROI", *"zyx", F.when(F.col("inside"), away).otherwise(0.0).alias("to_out"), F.when(F.col("inside"), 0.0).otherwise(away).alias("to_in"), F.lit(True).alias("there")).join(ends, "ROI")
    for c, size in reversed(list(zip("zyx", scale))):
        d = _pass(d, c, float(size))
    far = F.when(F.col("to_in") == 0, F.sqrt("to_out")).otherwise(-F.sqrt("to_in"))
    d = d.where("there").withColumn("d", F.when(F.abs(far) < away, far))
    return d.select(F.col("ROI").cast(kinds["ROI"]).alias("ROI"), *(F.col(c).cast(kinds[c]).alias(c) for c in "zyx"), "d")


def map_of(voxels: DataFrame, function: str, mask: str, scale=(1.0, 1.0, 1.0)) -> DataFrame:
    if function == "DistanceToBorder":
        return voxels.join(to_border(voxels, mask, scale), ["ROI", "z", "y", "x"])
    return along(voxels, function, mask, scale)


def at_centroid(mapped: DataFrame, keys=KEYS, maps=("d",)) -> DataFrame:
    """``Centroid`` (``<map>_Centroid`` of several maps): the value at the voxel nearest to each object's centre (halves go up)."""
    nearest = [F.floor(F.avg(c) + 0.5).cast("long").alias(c) for c in "zyx"]
    centre = objects(mapped).groupBy(*keys).agg(*nearest)
    named = [F.col(names.q(m)).alias("Centroid" if len(maps) == 1 else f"{m}_Centroid") for m in maps]
    return centre.join(mapped.select("ROI", "z", "y", "x", *(names.q(m) for m in maps)), ["ROI", "z", "y", "x"], "left").select(*keys, *named)


def features(voxels: DataFrame, label_to: str, mask: str, props=names.DEFAULT_DISTANCE_FEATURES, functions=names.DEFAULT_DISTANCE_FUNCTIONS, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """``<label_to>_<Feature><Function>`` of each object. The maps of all functions lie beside each other and are summed up together."""
    mapped, maps = voxels.select(*dict.fromkeys((*keys, "ROI", "label", "z", "y", "x", names.q(mask)))), {}
    for k, function in enumerate(functions):
        maps[function] = f"_d{k}"
        mapped = map_of(mapped, function, mask, scale).withColumnRenamed("d", maps[function])
    # Read for sums, medians and centres, so the passes over the lines are made once.
    mapped = checkpointed(mapped) if "DistanceToBorder" in maps else mapped
    stats = [p for p in names.requested(props, names.DISTANCE_FEATURES) if p != "Centroid"]
    parts = [intensity.features(mapped, list(maps.values()), stats, scale, keys)] if stats and maps else []
    if "Centroid" in props and maps:
        middle = at_centroid(mapped, keys, tuple(maps.values()))
        parts.append(middle.withColumnRenamed("Centroid", "_d0_Centroid"))
    out = objects(voxels).select(*keys).distinct()
    for part in parts:
        renamed = [F.col(names.q(f"{m}_{p}")).alias(names.distance(label_to, p, function)) for function, m in maps.items() for p in (*stats, "Centroid") if f"{m}_{p}" in part.columns]
        out = out.join(part.select(*keys, *renamed), list(keys), "left")
    return out
