"""Shape of labelled objects: one aggregation over their voxels gives most features.

Voxels are rows ``ROI, label, z, y, x``; ``scale`` is the physical size of a voxel along
``(z, y, x)``. Background (label 0) is left out. An object's voxels are summed before the
shuffle, so a large object costs one row for each task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations, product
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as E
from ..functions import names

KEYS = ("ROI", "label")
#: Components of a unit vector that differ by less are equal, whatever a solver's last digits say.
ALIKE = 1e-9
_AXES = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("moments", "axes")])


def objects(voxels: DataFrame) -> DataFrame:
    return voxels.where(F.col("label") != 0)


def centroid(scale) -> Column:
    sz, sy, sx = scale
    return E.struct_of(x=F.avg("x") * sx, y=F.avg("y") * sy, z=F.avg("z") * sz)


def bounding_box() -> Column:
    """Half-open index ranges."""
    low = [F.min(c).cast("long").alias(f"lower-{c}") for c in "xyz"]
    return F.struct(*low, *((F.max(c) + 1).cast("long").alias(f"upper-{c}") for c in "xyz"))


def moment_sums(scale, weight: Column | None = None) -> list[Column]:
    """The weight and the first and second moments in physical units, as ``_w, _x, _xy, …``."""
    at = {c: F.col(c) * F.lit(float(s)) for c, s in zip("zyx", scale)}
    w = F.lit(1.0) if weight is None else weight.cast("double")
    first = [F.sum(w * at[c]).alias(f"_{c}") for c in "xyz"]
    second = [F.sum(w * at[a] * at[b]).alias(f"_{a}{b}") for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")]
    return [F.sum(w).alias("_w"), *first, *second]


def central(scale) -> list[Column]:
    """The six central second moments by pair of axes; each voxel's own extent adds a twelfth of its squared size."""
    size = dict(zip("zyx", scale))
    out = []
    for a, b in ("xx", "xy", "xz", "yy", "yz", "zz"):
        own = size[a] ** 2 / 12 if a == b else 0.0
        # The sums of voxels are exact, so their product is rounded once.
        out.append(E.safe_divide(F.col(f"_{a}{b}"), F.col("_w")) - E.safe_divide(F.col(f"_{a}") * F.col(f"_{b}"), F.col("_w") * F.col("_w")) + F.lit(own))
    return out


def _first(m: np.ndarray, axis: int, size: np.ndarray) -> int:
    return int((size >= size.max() - ALIKE).argmax())


def _foremost(m: np.ndarray, axis: int, size: np.ndarray) -> int:
    """Which of an axis' equal components counts as the largest: the one that the closed solution makes larger.

    Its few steps round alike in every engine, unlike a solver's: the roots of the characteristic polynomial,
    and the longest cross product of two rows of ``m`` less its root. Without such a product it is the first.
    """
    (xx, xy, xz), (_, yy, yz), (_, _, zz) = m.tolist()
    mean = (xx + yy + zz) / 3
    s = math.sqrt((math.pow(xx - mean, 2) + math.pow(yy - mean, 2) + math.pow(zz - mean, 2) + 2 * (xy * xy + xz * xz + yz * yz)) / 6)
    if (cube := 2 * s * s * s) == 0:
        return _first(m, axis, size)
    det = (xx - mean) * ((yy - mean) * (zz - mean) - yz * yz) - xy * (xy * (zz - mean) - yz * xz) + xz * (xy * yz - (yy - mean) * xz)
    phi = math.acos(max(-1.0, min(1.0, det / cube))) / 3
    e = mean + 2 * s * math.cos((phi + 2 * pi / 3, phi - 2 * pi / 3, phi)[axis])
    rows = ((xx - e, xy, xz), (xy, yy - e, yz), (xz, yz, zz - e))
    products = [(u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]) for u, v in combinations(rows, 2)]
    x, y, z = (abs(v) for v in max(products, key=lambda w: w[0] * w[0] + w[1] * w[1] + w[2] * w[2]))
    picked = 0 if x >= max(y, z) else 1 if y >= z else 2
    # Where two roots are nearly one, the product may lie along another axis.
    return picked if size[picked] >= size.max() - ALIKE else _first(m, axis, size)


def _principal(parts: tuple[pd.Series, ...], foremost: Callable[[np.ndarray, int, np.ndarray], int]) -> pd.DataFrame:
    xx, xy, xz, yy, yz, zz = parts
    m = np.stack([xx, xy, xz, xy, yy, yz, xz, yz, zz], axis=1).astype(np.float64).reshape(-1, 3, 3)
    bad = ~np.isfinite(m).all(axis=(1, 2))
    m[bad] = 0
    values, vectors = np.linalg.eigh(m)
    axes = np.swapaxes(vectors, 1, 2)
    size = np.abs(axes)
    first = size.argmax(axis=2)
    for i, a in zip(*np.nonzero((size >= size.max(axis=2, keepdims=True) - ALIKE).sum(axis=2) > 1)):
        first[i, a] = foremost(m[i], a, size[i, a])
    largest = np.take_along_axis(axes, first[:, :, None], axis=2)
    axes = axes * np.where(largest < 0, -1.0, 1.0)
    moments = [None if b else v.tolist() for b, v in zip(bad, np.maximum(values, 0))]
    return pd.DataFrame({"moments": moments, "axes": [None if b else a.ravel().tolist() for b, a in zip(bad, axes)]})


@F.pandas_udf(_AXES)
def principal(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.DataFrame:
    """Ascending moments and their axes, row by row; an axis points so that its largest component is positive, of equal ones the first."""
    return _principal((xx, xy, xz, yy, yz, zz), _first)


@F.pandas_udf(_AXES)
def principal_by_root(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.DataFrame:
    """As :func:`principal`; of equal components that of :func:`_foremost` is positive, as in SQL that solves for the root."""
    return _principal((xx, xy, xz, yy, yz, zz), _foremost)


def elongation(m: Column) -> Column:
    return F.sqrt(E.safe_divide(m[2], m[1]))


def flatness(m: Column) -> Column:
    return F.sqrt(E.safe_divide(m[1], m[0]))


def named_axes(a: Column) -> Column:
    return F.struct(*(a[3 * i + j].alias(f"{n}-{c}") for i, n in enumerate("abc") for j, c in enumerate("xyz")))


def extents(voxels: DataFrame) -> DataFrame:
    """The last index of each ROI along each axis, from all voxels, background too."""
    return voxels.groupBy("ROI").agg(*(F.min(c).alias(f"_low_{c}") for c in "zyx"), *(F.max(c).alias(f"_high_{c}") for c in "zyx"))


def border_faces(voxels: DataFrame, scale) -> DataFrame:
    """Objects' voxels with ``on_border`` and ``border_area``: the physical faces on their ROI's image border."""
    sz, sy, sx = scale
    area = {"z": sy * sx, "y": sz * sx, "x": sz * sy}
    v = objects(voxels).join(extents(voxels), "ROI")
    faces = [F.when(F.col(c) == F.col(f"_{side}_{c}"), F.lit(float(area[c]))).otherwise(F.lit(0.0)) for c in "zyx" for side in ("low", "high")]
    total = reduce(lambda a, b: a + b, faces)
    return v.withColumn("border_area", total).withColumn("on_border", (total > 0).cast("long"))


def basic_sums(scale) -> dict[str, Column]:
    sz, sy, sx = scale
    n = F.count("*")
    volume = n * F.lit(float(sz * sy * sx))
    r = E.sphere_radius(volume)
    return {
        "NumberOfPixels": n, "PhysicalSize": volume, "Centroid": centroid(scale), "BoundingBox": bounding_box(),
        "EquivalentSphericalRadius": r, "EquivalentSphericalPerimeter": F.lit(4 * pi) * r * r,
    }


def basic(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """Count, size, centroid, bounding box and the sphere of equal size."""
    return objects(voxels).groupBy(*keys).agg(*(v.alias(k) for k, v in basic_sums(scale).items()))


def border(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """Voxels and face area on the image border."""
    return border_faces(voxels, scale).groupBy(*keys).agg(F.sum("on_border").alias("NumberOfPixelsOnBorder"), F.sum("border_area").alias("PerimeterOnBorder"))


def with_moments(df: DataFrame, scale, solve=principal) -> DataFrame:
    """The features of the moment sums in ``df`` (and of the count ``_n``), in place of them."""
    sz, sy, sx = scale
    held = [c for c in df.columns if not c.startswith("_")]
    p = df.withColumn("_p", solve(*central(scale)))
    m, r = F.col("_p.moments"), E.sphere_radius(F.col("_n") * F.lit(float(sz * sy * sx)))
    mean = F.pow(m[0] * m[1] * m[2], F.lit(1 / 3))
    diameters = F.struct(*((2 * r * F.sqrt(E.safe_divide(m[i], mean))).alias(n) for i, n in enumerate("abc")))
    made = {
        "PrincipalMoments": F.struct(*(m[i].alias(n) for i, n in enumerate("abc"))), "PrincipalAxes": named_axes(F.col("_p.axes")),
        "Elongation": elongation(m), "Flatness": flatness(m), "EquivalentEllipsoidDiameter": diameters,
    }
    temporary = {f"_{c}" for c in ("w", "x", "y", "z", "xx", "xy", "xz", "yy", "yz", "zz", "n", "p")}
    rest = [c for c in df.columns if c.startswith("_") and c not in temporary]
    return p.select(*(names.q(c) for c in held), *(v.alias(k) for k, v in made.items()), *(names.q(c) for c in rest))


def moments(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS, solve=principal) -> DataFrame:
    """Principal moments and axes, elongation, flatness and the ellipsoid of equal size; ``solve``: :func:`principal` or :func:`principal_by_root`."""
    return with_moments(objects(voxels).groupBy(*keys).agg(F.count("*").alias("_n"), *moment_sums(scale)), scale, solve)


def perimeter(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """Surface, what of it lies on the image border, and how close the object is to a sphere."""
    return fused(voxels, scale, _PERIMETER, keys=keys)


#: The thirteen directions from a voxel to its neighbours, one of each opposite pair, as steps along ``(z, y, x)``.
DIRECTIONS = tuple(d for d in product((-1, 0, 1), repeat=3) if d > (0, 0, 0))
#: Planes that one task reduces to the corners of their hulls.
SLICES = 16
#: Side of the bricks in which voxels meet their neighbours.
BRICK = 32


def intercept_weights(scale) -> list[float]:
    """For each direction the area that one entry of a line into an object stands for.

    A body's surface is four times its mean projected area. Lines of a direction lie one voxel's
    volume over one step apart; a direction counts for the share of the sphere that is closest to it.
    """
    steps = np.array(DIRECTIONS, float) * np.array(scale, float)
    length = np.linalg.norm(steps, axis=1)
    n = 100_000
    k = np.arange(n) + 0.5
    height, turn = 1 - 2 * k / n, k * np.pi * (1 + 5**0.5)
    flat = np.sqrt(1 - height**2)
    sphere = np.stack([height, flat * np.sin(turn), flat * np.cos(turn)], axis=1)
    nearest = np.abs(sphere @ (steps / length[:, None]).T).argmax(axis=1)
    share = np.bincount(nearest, minlength=len(steps)) / n
    return (4 * share * float(np.prod(scale)) / length).tolist()


def surface(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """``Perimeter``: the surface of each object, from how often lines along thirteen directions enter it.

    Voxels are dealt once, by brick; those on a brick's rim go to its neighbours too. What lies
    outside the image counts as background.
    """
    weights, kinds = intercept_weights(scale), dict(voxels.dtypes)
    side = lambda c: F.explode(F.array_distinct(F.array(*(F.floor((F.col(c) + o) / BRICK).cast("long") for o in (-1, 0, 1)))))
    v = voxels.select("ROI", "label", *(F.col(c).cast("long").alias(c) for c in "zyx"))
    for c in "zyx":
        v = v.withColumn(f"_b{c}", side(c))

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        box = np.zeros((BRICK + 2,) * 3, np.int64)
        box[tuple(f[c].to_numpy() - (b * BRICK - 1) for c, b in zip("zyx", key[1:]))] = f["label"].to_numpy()
        own = box[1:-1, 1:-1, 1:-1]
        total = np.zeros(own.shape)
        for (dz, dy, dx), w in zip(DIRECTIONS, weights):
            before = box[1 - dz : BRICK + 1 - dz, 1 - dy : BRICK + 1 - dy, 1 - dx : BRICK + 1 - dx]
            total += w * (own != before)
        labels, at = np.unique(own, return_inverse=True)
        sums = np.bincount(at.ravel(), weights=total.ravel(), minlength=len(labels))
        return pd.DataFrame({"ROI": [key[0]] * len(labels), "label": labels, "area": sums})[labels != 0]

    parts = v.groupBy("ROI", "_bz", "_by", "_bx").applyInPandas(one, f"ROI {kinds['ROI']}, label {kinds['label']}, area double")
    return parts.groupBy(*keys).agg(F.sum("area").alias("Perimeter"))


def _corners(p: np.ndarray) -> list[int]:
    """Rows of ``p`` (two columns, sorted) that are corners of its convex hull, by one chain on either side."""
    out: list[int] = []
    for order in (range(len(p)), range(len(p) - 1, -1, -1)):
        chain: list[int] = []
        for k in order:
            while len(chain) > 1:
                (y0, x0), (y1, x1), (y2, x2) = p[chain[-2]], p[chain[-1]], p[k]
                if (y1 - y0) * (x2 - x0) - (x1 - x0) * (y2 - y0) > 0:
                    break
                chain.pop()
            chain.append(k)
        out += chain
    return sorted(set(out))


def feret(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    """The largest distance between two voxels of an object.

    Only the ends of a line along x can be the farthest, and of these only corners of the hull of
    their plane. Planes are reduced to them in tasks of ``SLICES`` planes, before an object's corners
    meet in one task.
    """
    ends = objects(voxels).groupBy(*keys, "z", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    ends = ends.select(*keys, *(F.col(c).cast("long").alias(c) for c in "zy"), F.explode(F.array_distinct(F.array(F.col("a").cast("long"), F.col("b").cast("long")))).alias("x"))
    kinds = dict(ends.dtypes)

    def planes(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["z", "y", "x"], ignore_index=True)
        p = f[["y", "x"]].to_numpy().tolist()
        first = np.flatnonzero(np.r_[True, np.diff(f["z"].to_numpy()) > 0, True])
        return f.iloc[[lo + k for lo, hi in zip(first[:-1], first[1:]) for k in _corners(p[lo:hi])]][list(kinds)]

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        p = f[["z", "y", "x"]].to_numpy(np.float64) * np.array(scale)
        best = 0.0
        for at in range(0, len(p), 256):
            d = ((p[at : at + 256, None] - p[None, at:]) ** 2).sum(axis=2)
            best = max(best, float(d.max()))
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, "FeretDiameter": [best**0.5]})

    corners = ends.groupBy(*keys, F.floor(F.col("z") / SLICES)).applyInPandas(planes, ", ".join(f"{c} {t}" for c, t in kinds.items()))
    return corners.groupBy(*keys).applyInPandas(one, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", FeretDiameter double")


def oriented_box(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS, solve=principal) -> DataFrame:
    """Extent along the principal axes: direction, origin, size and the eight corners."""
    axes = moments(voxels, scale, keys, solve).select(*keys, "PrincipalAxes")
    at = dict(zip("zyx", scale))
    v = objects(voxels).join(axes, list(keys))
    sides = []
    for n in "abc":
        along = reduce(lambda s, t: s + t, [F.col(c) * F.lit(float(at[c])) * F.col(f"PrincipalAxes.{names.q(f'{n}-{c}')}") for c in "xyz"])
        half = reduce(lambda s, t: s + t, [F.abs(F.col(f"PrincipalAxes.{names.q(f'{n}-{c}')}")) * F.lit(at[c] / 2) for c in "xyz"])
        sides += [F.min(along - half).alias(f"_l{n}"), F.max(along + half).alias(f"_h{n}")]
    b = v.groupBy(*keys).agg(F.first("PrincipalAxes").alias("OrientedBoundingBoxDirection"), *sides)

    def corner(pick: dict[str, str]) -> Column:
        axis = lambda n, c: F.col(f"OrientedBoundingBoxDirection.{names.q(f'{n}-{c}')}")
        return F.struct(*(reduce(lambda s, t: s + t, [F.col(f"_{pick[n]}{n}") * axis(n, c) for n in "abc"]).alias(c) for c in "xyz"))

    corners = [corner({"a": i, "b": j, "c": k}) for i in "lh" for j in "lh" for k in "lh"]
    return b.select(*keys, "OrientedBoundingBoxDirection", corners[0].alias("OrientedBoundingBoxOrigin"), F.struct(*((F.col(f"_h{n}") - F.col(f"_l{n}")).alias(n) for n in "abc")).alias("OrientedBoundingBoxSize"), F.array(*corners).alias("OrientedBoundingBoxVertices"))


_BASIC = ("NumberOfPixels", "PhysicalSize", "Centroid", "BoundingBox", "EquivalentSphericalRadius", "EquivalentSphericalPerimeter")
_MOMENTS = ("PrincipalMoments", "PrincipalAxes", "Elongation", "Flatness", "EquivalentEllipsoidDiameter")
_PERIMETER = ("Perimeter", "NumberOfPixelsOnBorder", "PerimeterOnBorder", "PerimeterOnBorderRatio", "Roundness")
_BOX = ("OrientedBoundingBoxDirection", "OrientedBoundingBoxOrigin", "OrientedBoundingBoxSize", "OrientedBoundingBoxVertices")


def fused(voxels: DataFrame, scale, wanted, more: dict[str, Column] | None = None, keys=KEYS) -> DataFrame:
    """Features that follow from sums, and ``more`` aggregates of the same voxels, in one pass over them.

    Only surfaces take another look at the voxels, for what lies next to them.
    """
    wanted, more = tuple(wanted), more or {}
    outer = [f for f in wanted if f in _PERIMETER]
    v = border_faces(voxels, scale) if outer else objects(voxels)
    aggs = [c.alias(k) for k, c in basic_sums(scale).items() if k in wanted] + [c.alias(k) for k, c in more.items()]
    if any(f in _MOMENTS for f in wanted):
        aggs += [F.count("*").alias("_n"), *moment_sums(scale)]
    if outer:
        aggs += [F.sum("on_border").alias("NumberOfPixelsOnBorder"), F.sum("border_area").alias("PerimeterOnBorder"), basic_sums(scale)["EquivalentSphericalPerimeter"].alias("_sphere")]
    out = v.groupBy(*keys).agg(*aggs)
    if any(f in _MOMENTS for f in wanted):
        out = with_moments(out, scale)
    if outer:
        total = F.col("Perimeter")
        out = out.join(surface(voxels, scale, keys), list(keys), "left").withColumns({"PerimeterOnBorderRatio": E.safe_divide(F.col("PerimeterOnBorder"), total), "Roundness": E.safe_divide(F.col("_sphere"), total)})
    return out.select(*keys, *wanted, *(names.q(k) for k in more))


def features(voxels: DataFrame, scale=(1.0, 1.0, 1.0), props=names.DEFAULT_LABEL_FEATURES, keys=KEYS, more: dict[str, Column] | None = None) -> DataFrame:
    """The requested label features, one row for each object; ``props`` are prefixes of feature names.

    ``more`` are further aggregates by name, taken in the same pass.
    """
    sums = names.requested(props, _BASIC + _MOMENTS + _PERIMETER)
    box, far = names.requested(props, _BOX), names.requested(props, ("FeretDiameter",))
    if not (sums or box or far or more):
        raise ValueError(f"no feature begins with any of {list(props)}")
    out = fused(voxels, scale, sums, more, keys) if sums or more else objects(voxels).select(*keys).distinct()
    for make, have in ((oriented_box, box), (feret, far)):
        if have:
            out = out.join(make(voxels, scale, keys).select(*keys, *have), list(keys), "left")
    return out


def centroids(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    return features(voxels, scale, ("Centroid",), keys)


def position_and_orientation(voxels: DataFrame, scale=(1.0, 1.0, 1.0), keys=KEYS) -> DataFrame:
    return features(voxels, scale, names.POSITION_FEATURES, keys)


def masked(voxels: DataFrame, mask_label: str = "mask_label") -> DataFrame:
    """Within a region named after its masking object, labels and values outside the mask become 0; rows stay."""
    inside = F.col(mask_label) == F.col("ROI").cast("int")
    keep = {"ROI", "z", "y", "x", mask_label}
    return voxels.select(*(F.col(names.q(c)) if c in keep else F.when(inside, F.col(names.q(c))).otherwise(F.lit(0).cast(t)).alias(c) for c, t in voxels.dtypes))
