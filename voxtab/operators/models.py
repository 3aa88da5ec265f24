"""Decay models: fit by group, predict, correct.

Models live in a parameter table ``model, channel, feature_names, loss, params, y_intercept,
converged``. Fits with the linear loss in one feature come from sums; the others take steps, in one
task for a small group and by one aggregation each for a large one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions.names import q
from ..sources.tables import checkpointed
from . import fitting

MODELS = ("Linear", "LogLinear", "ExpFitLinear", "ExpNoOffset", "Exp")
PARAMS = "model string, feature_names array<string>, loss string, params array<double>, y_intercept double, converged boolean"
#: Groups of more rows than this are fitted by aggregations, smaller ones in one task each.
IN_TASK = 200_000


@dataclass(frozen=True)
class Spec:
    """What to fit. ``str`` gives the name under which a model is stored."""

    model: str
    features: tuple[str, ...]
    loss: str = "linear"
    pos_offset: bool = False

    def __post_init__(self):
        if self.model not in MODELS:
            raise ValueError(f"unknown model {self.model!r}")
        if self.loss not in ("linear", "huber"):
            raise ValueError(f"unknown loss {self.loss!r}")

    def __str__(self) -> str:
        return f"{self.model}(features={';'.join(self.features)}, loss={self.loss}{', pos_offset=True' if self.pos_offset else ''})"


def parse(name: str) -> Spec:
    """The spec of a stored name."""
    m = re.fullmatch(r"(\w+)\(features=(.*), loss=(\w+?)(, pos_offset=True)?\)", name)
    if not m:
        raise ValueError(f"not a model name: {name!r}")
    return Spec(m[1], tuple(m[2].split(";")), m[3], bool(m[4]))


def fit(spec: Spec, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, bool]:
    """Parameters of a spec on plain arrays. Each exponential starts from the simpler one."""
    return fitting.in_task(spec.model, spec.loss, spec.pos_offset, x, y)


def y_intercept(model: str, p: np.ndarray) -> float:
    """The prediction at 0."""
    return float({"Linear": lambda: p[0], "LogLinear": lambda: np.exp(p[0]), "Exp": lambda: p[0] + p[-1]}.get(model, lambda: p[0])())


def has_closed_form(spec: Spec) -> bool:
    return spec.loss == "linear" and len(spec.features) == 1 and spec.model in ("Linear", "LogLinear", "ExpFitLinear")


def _fit_by_sums(d: DataFrame, specs: Sequence[Spec], by: Sequence[str]) -> DataFrame:
    """Fits that follow from a group's means, variance and covariance; with one ``x`` only, the smallest parameters that fit."""
    sums, rows = [F.count("*").alias("_n")], []
    for k, s in enumerate(specs):
        x, y = F.col(q(s.features[0])), F.col("_y") if s.model == "Linear" else F.log(F.greatest("_y", F.lit(fitting.FLOOR)))
        sums += [F.avg(x).alias(f"_x{k}"), F.avg(y).alias(f"_y{k}"), F.var_pop(x).alias(f"_v{k}"), F.covar_pop(x, y).alias(f"_c{k}")]
        x, y, v, c = (F.col(f"_{n}{k}") for n in "xyvc")
        slope = F.when(v > 0, c / v).otherwise(y * x / (1 + x * x))
        first = F.when(v > 0, y - slope * x).otherwise(y / (1 + x * x))
        first, at_0 = (F.exp(first), F.exp(first)) if s.model == "ExpFitLinear" else (first, F.exp(first) if s.model == "LogLinear" else first)
        ok = (F.col("_n") >= 2) & (F.abs(first) < float("inf")) & (F.abs(slope) < float("inf"))
        given = (F.lit(str(s)), F.array(*(F.lit(f) for f in s.features)), F.lit(s.loss), F.when(ok, F.array(first, slope)), F.when(ok, at_0), F.coalesce(ok, F.lit(False)))
        rows.append(F.struct(*(c.alias(n.split()[0]) for c, n in zip(given, PARAMS.split(", ")))))
    return d.groupBy(*by).agg(*sums).select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.*")


def fit_groups(df: DataFrame, specs: Sequence[Spec], y: str, by: Sequence[str] = ("channel",), sample: int | None = None) -> DataFrame:
    """Every spec on every group: ``by``, ``PARAMS``. Rows with a null in ``y`` or a feature are left out.

    What has a closed form comes from sums. For the others, groups of up to ``IN_TASK`` rows are fitted
    in one task each, from their numbers (``y`` and the features); larger ones by one aggregation for each
    step (:mod:`.fitting`), which gives the same. ``sample`` fits so many rows of each group.
    """
    columns = list(dict.fromkeys(f for s in specs for f in s.features))
    for c in (*columns, y, *by):
        if c not in df.columns:
            raise ValueError(f"no column {c!r}")
    d = df.select(*by, F.col(q(y)).cast("double").alias("_y"), *(F.col(q(c)).cast("double").alias(c) for c in columns)).dropna()
    if sample:
        d = d.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(F.xxhash64(F.lit(42), "_y", *(q(c) for c in columns))))).where(F.col("_n") <= sample).drop("_n")
    kinds = dict(d.dtypes)
    rest = [s for s in specs if not has_closed_form(s)]
    if not rest:
        return _fit_by_sums(d, specs, by)
    # The rows are read for sums, for sizes and for fits, so they are made once.
    d = checkpointed(d)
    parts = [_fit_by_sums(d, closed, by)] if (closed := [s for s in specs if has_closed_form(s)]) else []
    large = checkpointed(d.groupBy(*by).count().where(F.col("count") > IN_TASK).select(*by))

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for s in rest:
            p, ok = fit(s, f[list(s.features)].to_numpy(), f["_y"].to_numpy())
            rows.append((*key, str(s), list(s.features), s.loss, p.tolist() if ok else None, y_intercept(s.model, p) if ok else None, ok))
        return pd.DataFrame(rows, columns=[*by, "model", "feature_names", "loss", "params", "y_intercept", "converged"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + ", " + PARAMS
    if large.isEmpty():
        parts.append(d.groupBy(*by).applyInPandas(one, schema))
    else:
        parts.append(d.join(large, list(by), "left_anti").groupBy(*by).applyInPandas(one, schema))
        rows = d.join(large, list(by), "left_semi").select(*by, "_y", F.array(*(F.col(q(c)) for c in columns)).alias("_x"))
        fits = [(s.model, s.loss, s.pos_offset, [columns.index(f) for f in s.features]) for s in rest]
        found = fitting.by_steps(rows, fits, by, len(columns))
        whole = F.array(*(_described(s, len(columns)) for s in rest))
        parts.append(found.select(*by, F.get(whole, F.col("fit")).alias("_r")).select(*by, "_r.*"))
    return reduce(DataFrame.unionByName, parts)


def _described(s: Spec, features: int) -> Column:
    """``PARAMS`` of a settled state ``p, ok``."""
    at = [*range(len(s.features) + 1), *([features + 1] if s.model == "Exp" else [])]
    p = [F.get("p", k) for k in at]
    given = (F.lit(str(s)), F.array(*(F.lit(f) for f in s.features)), F.lit(s.loss), F.when(F.col("ok"), F.array(*p)), F.when(F.col("ok"), intercept(s.model, p)), F.col("ok"))
    return F.struct(*(c.alias(n.split()[0]) for c, n in zip(given, PARAMS.split(", "))))


def fit_closed(df: DataFrame, model: str, x: str, y: str, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Linear, LogLinear and ExpFitLinear in one feature with the linear loss, by regression aggregates: ``by``, ``b0, b1``."""
    value = F.col(q(y)) if model == "Linear" else F.log(F.greatest(F.col(q(y)), F.lit(fitting.FLOOR)))
    d = df.select(*by, F.col(q(x)).cast("double").alias("_x"), value.cast("double").alias("_y"))
    out = d.groupBy(*by).agg(F.regr_intercept("_y", "_x").alias("b0"), F.regr_slope("_y", "_x").alias("b1"))
    return out.withColumn("b0", F.exp("b0")) if model == "ExpFitLinear" else out


def predicted(model: str, params: Sequence[Column], x: Sequence[Column]) -> Column:
    p, x = list(params), list(x)
    if model == "Linear":
        return E.linear(p, x)
    if model == "LogLinear":
        return F.exp(E.linear(p, x))
    if model == "Exp":
        return E.exponential_offset(p, x)
    return E.exponential(p, x)


def intercept(model: str, params: Sequence[Column]) -> Column:
    p = list(params)
    return F.exp(p[0]) if model == "LogLinear" else p[0] + p[-1] if model == "Exp" else p[0]


def correction_factor(model: str, params: Sequence[Column], x: Sequence[Column]) -> Column:
    """What brings a value at ``x`` to the level at 0; null where the prediction is 0."""
    return E.safe_divide(intercept(model, params), predicted(model, params, x))


def with_factors(df: DataFrame, params: DataFrame, factors: dict[str, Spec], by: Sequence[str] = ("channel",)) -> DataFrame:
    """``df`` with a column for each spec: the factor of each row, NaN where the model of its group did not settle.

    The parameters of all models come as one row for each group and are joined once.
    """
    mine = params.where(F.col("model").isin(*(str(s) for s in factors.values()))).groupBy(*by).agg(*(F.first(F.when(F.col("model") == str(s), F.col("params")), ignorenulls=True).alias(f"_p{k}") for k, s in enumerate(factors.values())))
    out = df.join(mine, list(by), "left")
    made = {}
    for k, (name, s) in enumerate(factors.items()):
        p = [F.get(f"_p{k}", i) for i in range(len(s.features) + 1 + (s.model == "Exp"))]
        made[name] = F.coalesce(correction_factor(s.model, p, [F.col(q(f)).cast("double") for f in s.features]), F.lit(float("nan")))
    return out.withColumns(made).drop(*(f"_p{k}" for k in range(len(factors))))


def with_factor(df: DataFrame, params: DataFrame, spec: Spec, name: str, by: Sequence[str] = ("channel",)) -> DataFrame:
    """``df`` with ``name``: the factor of each row by one spec."""
    return with_factors(df, params, {name: spec}, by)


def grid_predicted(params: DataFrame, spec: Spec, grid: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """The prediction of each group's model at each row of a grid of features.

    The models are few; the grid may be any table, so it goes to the models' side group by group.
    """
    mine = params.where((F.col("model") == str(spec)) & F.col("converged")).select(*by, F.col("params").alias("_p"))
    n = len(spec.features) + 1 + (spec.model == "Exp")
    out = predicted(spec.model, [F.get("_p", i) for i in range(n)], [F.col(q(f)).cast("double") for f in spec.features])
    return grid.join(mine, list(by)).withColumn("predicted", out).drop("_p")


def corrected(df: DataFrame, params: DataFrame, spec: Spec, value: str, by: Sequence[str] = ("channel",)) -> DataFrame:
    """``df`` with ``corrected``: its ``value`` brought to the level at 0 by the model of its group.

    The rows may be measured objects or a grid of features with a value at each place. Rows of a
    group without a model that settled are left out, as they are from :func:`grid_predicted`.
    """
    out = with_factor(df, params.where("converged"), spec, "_factor", by)
    return out.where(~F.isnan("_factor")).withColumn("corrected", F.col(q(value)) * F.col("_factor")).drop("_factor")


def paths(voxels: DataFrame, mask: str, scale=(1.0, 1.0, 1.0)) -> DataFrame:
    """``MediumPath`` and ``EmbryoPath``: how far each voxel lies behind others outside and inside the mask, along z."""
    line = W.partitionBy("ROI", "y", "x").orderBy("z").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = (F.col(q(mask)) != 0).cast("long")
    size = F.lit(float(scale[0]))
    return voxels.withColumns({"EmbryoPath": F.sum(inside).over(line) * size, "MediumPath": F.sum(1 - inside).over(line) * size})


def clipped(factor: Column, low: float = 0.0, high: float = 50.0) -> Column:
    """Factors outside the range, on either side, become its upper end."""
    return F.when((factor < low) | (factor > high), F.lit(high)).otherwise(factor)


def apply_z_model(voxels: DataFrame, channel: str, spec: Spec, params: Sequence[float] | None, mask: str | None = None, scale=(1.0, 1.0, 1.0)) -> DataFrame:
    """The channel times its factor; a model that did not settle leaves it as it is."""
    if params is None:
        return voxels
    p = [F.lit(float(v)) for v in params]
    if spec.features == ("Centroid-z",):
        factor, v = correction_factor(spec.model, p, [F.col("z") * F.lit(float(scale[0]))]), voxels
    elif spec.features == ("MediumPath", "EmbryoPath"):
        if mask is None:
            raise ValueError("a model on paths needs a mask")
        v = paths(voxels, mask, scale)
        at = [F.col("MediumPath"), F.col("EmbryoPath")]
        # Where the prediction is 0 the factor is beyond all bounds, so it is clipped too.
        endless = (predicted(spec.model, p, at) == 0) & (intercept(spec.model, p) != 0)
        factor = clipped(F.when(endless, F.lit(float("inf"))).otherwise(correction_factor(spec.model, p, at)))
    else:
        raise ValueError(f"unknown features {spec.features}")
    return v.withColumn(channel, F.col(q(channel)) * factor).select(*(q(c) for c in voxels.columns))


def apply_t_factor(voxels: DataFrame, channel: str, factors: DataFrame, keep_type: bool = True) -> DataFrame:
    """The channel times ``correctionFactor`` of its ROI. A factor that is missing, repeated or NaN is an error."""
    mine = factors.where(F.col("channel") == channel).select(F.col("ROI").cast("int").alias("_roi"), F.col("correctionFactor").cast("double").alias("_f"))
    if not mine.groupBy("_roi").count().where("count > 1").isEmpty():
        raise ValueError(f"several factors for one ROI of {channel}")
    kind = dict(voxels.dtypes)[channel]
    v = voxels.join(mine, F.col("ROI").cast("int") == F.col("_roi"), "left")
    sound = F.when(F.col("_f").isNull() | F.isnan("_f"), F.raise_error(F.concat(F.lit(f"no factor for {channel} in ROI "), F.col("ROI").cast("string")))).otherwise(F.col("_f"))
    out = F.col(q(channel)) * sound
    if keep_type and kind not in ("double", "float"):
        out = F.when(out >= 0, F.floor(out)).otherwise(F.ceil(out))
    return v.withColumn(channel, out.cast(kind) if keep_type else out).select(*(q(c) for c in voxels.columns))
