"""Least squares with a plain or robust loss, one pass over the rows for each step.

A fit goes through phases: straight lines by reweighted normal equations, then, for exponentials,
Levenberg-Marquardt steps without and with an offset, each from the result before. All that a step
needs of the rows are sums at a trial point (:data:`SUMS`): the weighted normal matrix, its right-hand
side and the cost. :func:`advanced` takes the sums to the next trial. So the rows may lie in one task
(:func:`in_task`) or anywhere (:func:`by_steps`), where each step is one aggregation over the rows of
the groups that have not settled.

Parameters are laid out as ``a, b1 … bF, c`` for at most ``F`` features; what a model lacks is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import checkpointed

FLOOR = 1e-6
#: Most steps of a phase, and most steps that are tried and turned down in a row.
MOST_LINES, MOST_STEPS, MOST_TRIES = 200, 500, 40
#: Up to so many fits, of less than 1 kB each, are sent to all tasks.
SENT = 10_000
STATE = "fit int, model string, loss string, pos boolean, at array<int>, phase string, trial array<double>, p array<double>, cost double, h array<double>, g array<double>, damp double, turn int, tries int, ok boolean"


def _weights(r: np.ndarray, loss: str) -> np.ndarray:
    """Weights under which least squares has the robust loss's gradient; the loss turns linear beyond a residual of 1."""
    return np.ones(len(r)) if loss == "linear" else 1 / np.maximum(1.0, np.abs(r))


def begun(model: str, loss: str, pos: bool, at: Sequence[int], rows: int, sound: bool) -> dict:
    """A fit at its start. Too few rows, or rows that are not finite, are not fitted."""
    enough = sound and rows >= len(at) + 1 + (model == "Exp")
    return {
        "model": model, "loss": loss, "pos": pos, "at": list(at), "phase": "line" if enough else "done", "trial": None, "p": None,
        "cost": 0.0, "h": None, "g": None, "damp": 1e-3, "turn": 0, "tries": 0, "ok": False,
    }


def _used(s: dict, width: int) -> np.ndarray:
    return np.array([*range(len(s["at"]) + 1), *([width - 1] if s["phase"] == "offset" else [])])


def _solved(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The solution of the normal equations; the smallest where there are several."""
    d = np.sqrt(np.maximum(np.diag(h), 1e-300))
    scaled = h / np.outer(d, d)
    if np.isfinite(scaled).all() and np.linalg.cond(scaled) < 1e11:
        return np.linalg.solve(scaled, g / d) / d
    return np.linalg.lstsq(h, g, rcond=None)[0]


def _stepped(s: dict, width: int) -> dict:
    """The next trial from the last accepted point."""
    at, p = _used(s, width), np.array(s["p"])
    h, g = np.array(s["h"]).reshape(width, width), np.array(s["g"])
    free = np.array([k for k in at if not (k == width - 1 and s["pos"] and p[k] <= 0 and g[k] < 0)])
    hf = h[np.ix_(free, free)]
    step = np.zeros(width)
    step[free] = _solved(hf + s["damp"] * np.diag(np.maximum(np.diag(hf), 1e-12)), g[free])
    new = p + step
    if s["phase"] == "offset" and s["pos"]:
        new[-1] = max(0.0, new[-1])
    steep = np.abs(g[free]).max() > 1e-6 * max(1.0, np.abs(h).max())
    return s | {"trial": new.tolist(), "steep": bool(steep)}


def _next_phase(s: dict, p: np.ndarray, ok: bool) -> dict:
    after = {"line": {"Linear": "done", "LogLinear": "done", "ExpFitLinear": "done"}.get(s["model"], "bare"), "bare": "offset" if s["model"] == "Exp" else "done", "offset": "done"}[s["phase"]]
    if s["phase"] == "line" and s["model"] not in ("Linear", "LogLinear"):
        p = np.r_[np.exp(p[0]), p[1:]]
    if after == "done":
        return s | {"phase": "done", "p": p.tolist(), "ok": ok, "trial": None, "h": None, "g": None}
    return s | {"phase": after, "trial": p.tolist(), "p": None, "damp": 1e-3, "turn": 0, "tries": 0}


def advanced(s: dict, h: np.ndarray, g: np.ndarray, cost: float) -> dict:
    """The fit after the sums at its trial point."""
    width = len(g)
    at = _used(s, width)
    if s["phase"] == "line":
        new = np.zeros(width)
        new[at] = _solved(h[np.ix_(at, at)], g[at])
        still = s["trial"] is not None and np.allclose(new, s["trial"], rtol=1e-10, atol=1e-14)
        if s["loss"] == "linear" or still or s["turn"] >= MOST_LINES:
            return _next_phase(s, new, bool(np.isfinite(new).all()))
        return s | {"trial": new.tolist(), "turn": s["turn"] + 1}
    new = np.array(s["trial"])
    if s["p"] is None:
        if not np.isfinite(cost):
            return _next_phase(s, new, False)
        return _stepped(s | {"p": s["trial"], "cost": cost, "h": h.ravel().tolist(), "g": g.tolist()}, width)
    p = np.array(s["p"])
    if not (np.isfinite(cost) and cost <= s["cost"]):
        tried = _stepped(s | {"damp": s["damp"] * 4, "tries": s["tries"] + 1}, width)
        return _next_phase(s, p, not tried["steep"]) if tried["tries"] >= MOST_TRIES else tried
    settled = s["cost"] - cost <= 1e-14 * max(s["cost"], 1e-300) and np.abs(new - p).max() <= 1e-9 * (1e-9 + np.abs(p).max())
    if settled or cost < 1e-28 or s["turn"] + 1 >= MOST_STEPS:
        return _next_phase(s, new, bool(settled or cost < 1e-28))
    accepted = {"p": s["trial"], "cost": cost, "h": h.ravel().tolist(), "g": g.tolist(), "damp": max(s["damp"] / 5, 1e-12), "turn": s["turn"] + 1, "tries": 0}
    return _stepped(s | accepted, width)


def _sums(s: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The sums at the trial point over rows held as arrays."""
    rows, features = x.shape
    j, p = np.zeros((rows, features + 2)), s["trial"]
    if s["phase"] == "line":
        t = y if s["model"] == "Linear" else np.log(np.maximum(y, FLOOR))
        j[:, 0], j[:, 1:-1] = 1, x
        w = _weights(t - j @ np.array(p), s["loss"]) if p is not None else np.ones(rows)
        return j.T @ (w[:, None] * j), j.T @ (w * t), 0.0
    with np.errstate(over="ignore", invalid="ignore"):
        e = np.exp(np.clip(x @ np.array(p[1:-1]), -700, 700))
        j[:, 0], j[:, 1:-1], j[:, -1] = e, p[0] * e[:, None] * x, s["phase"] == "offset"
        r = y - p[0] * e - p[-1]
        z, w = r * r, _weights(r, s["loss"])
        return j.T @ (w[:, None] * j), j.T @ (w * r), float(0.5 * (z if s["loss"] == "linear" else np.where(z <= 1, z, 2 * np.sqrt(z) - 1)).sum())


def in_task(model: str, loss: str, pos: bool, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, bool]:
    """Parameters and whether they settled, from rows held as arrays; NaN where there is nothing to fit."""
    x = x.reshape(len(y), -1).astype(float)
    s = begun(model, loss, pos, range(x.shape[1]), len(y), bool(np.isfinite(x).all() and np.isfinite(y).all()))
    while s["phase"] != "done":
        s = advanced(s, *_sums(s, x, y))
    return laid_out(s["p"], x.shape[1], model), s["ok"]


def laid_out(p: Sequence[float] | None, features: int, model: str) -> np.ndarray:
    """The parameters that a model has."""
    n = features + 1 + (model == "Exp")
    return np.full(n, np.nan) if p is None else np.array([*p[: features + 1], *([p[-1]] if model == "Exp" else [])])


def _row_sums(width: int) -> list[Column]:
    """The sums at the trial points, as aggregates over rows ``_x, _y`` beside their fit's state."""
    line = F.col("phase") == "line"
    p = [F.coalesce(F.get("trial", k), F.lit(0.0)) for k in range(width)]
    x = [F.coalesce(F.get("_x", F.get("at", k)), F.lit(0.0)) for k in range(width - 2)]
    t = F.when(line & (F.col("model") != "Linear"), F.log(F.greatest("_y", F.lit(FLOOR)))).otherwise(F.col("_y"))
    inner = sum((a * b for a, b in zip(p[1:-1], x)), F.lit(0.0))
    e = F.when(line, F.lit(1.0)).otherwise(F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), inner))))
    d = [e, *(F.when(line, v).otherwise(p[0] * e * v) for v in x), F.when(F.col("phase") == "offset", F.lit(1.0)).otherwise(F.lit(0.0))]
    r = F.when(F.col("trial").isNull(), F.lit(0.0)).otherwise(t - F.when(line, p[0] + inner).otherwise(p[0] * e + p[-1]))
    w = F.when(F.col("loss") == "linear", F.lit(1.0)).otherwise(1 / F.greatest(F.lit(1.0), F.abs(r)))
    cost = F.when((F.col("loss") == "linear") | (F.abs(r) <= 1), r * r / 2).otherwise(F.abs(r) - 0.5)
    aim = F.when(line, t).otherwise(r)
    h = [F.sum(w * d[a] * d[b]).alias(f"_h{a}{b}") for a in range(width) for b in range(a, width)]
    return [*h, *(F.sum(w * d[a] * aim).alias(f"_g{a}") for a in range(width)), F.sum(cost).alias("_cost")]


def by_steps(rows: DataFrame, fits: Sequence[tuple[str, str, bool, Sequence[int]]], by: Sequence[str], features: int) -> DataFrame:
    """``by, fit, p, ok`` of every group and fit (``model, loss, pos, places of its features``), from rows ``by, _x, _y``.

    A task holds rows of state only, one for each group and fit. Groups leave as they settle.
    """
    width = features + 2
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", " + STATE
    names = [c.split()[0] for c in STATE.split(", ")]
    finite = F.forall("_x", lambda v: F.abs(v) < float("inf")) & (F.abs("_y") < float("inf"))
    groups = rows.groupBy(*by).agg(F.count("*").alias("_rows"), F.min(finite).alias("_sound"))

    def start(batches):
        for b in batches:
            made = [{**{c: r[c] for c in by}, "fit": k, **begun(*f, r["_rows"], r["_sound"])} for r in b.to_dict("records") for k, f in enumerate(fits)]
            yield pd.DataFrame(made, columns=[*by, *names])

    def step(batches):
        for b in batches:
            made = []
            for r in b.to_dict("records"):
                h, g = np.zeros((width, width)), np.array([r[f"_g{a}"] for a in range(width)])
                for a in range(width):
                    for c in range(a, width):
                        h[a, c] = h[c, a] = r[f"_h{a}{c}"]
                s = {c: r[c] if not isinstance(r[c], np.ndarray) else r[c].tolist() for c in [*by, *names]}
                made.append(advanced(s, h, g, float(r["_cost"])))
            yield pd.DataFrame(made, columns=[*by, *names])

    key = [*by, "fit"]
    rows, state, settled = checkpointed(rows), checkpointed(groups.mapInPandas(start, schema)), None
    while True:
        done = state.where("phase = 'done'").select(*key, "p", "ok")
        settled = done if settled is None else settled.union(done)
        state = state.where("phase <> 'done'")
        left = state.count()
        if not left:
            return settled
        point = state.select(*key, "model", "loss", "at", "phase", "trial")
        sums = rows.join(F.broadcast(point) if left <= SENT else point, list(by)).groupBy(*key).agg(*_row_sums(width))
        state = checkpointed(state.join(sums, key).mapInPandas(step, schema))
