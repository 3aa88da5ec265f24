"""The registered queries over the star-schema views, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions.names import q
from ..operators import aggregate as A
from ..operators import coloc, distance, hierarchy, intensity, models, reshape, shape
from ..operators import neighbors as N
from ..sources import metadata, views
from ..sources.views import SCALE
from . import flows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_VIEWS = {
    "vox": "SELECT l_partkey % 4 AS ROI, l_partkey + 1 AS label, l_suppkey AS parent, l_linenumber AS z, l_quantity AS ch0, l_extendedprice AS ch1, l_discount AS ch2 FROM lineitem",
    "grid": """SELECT 0 AS ROI, o_orderkey // 2500 AS z, (o_orderkey // 50) % 50 AS y, o_orderkey % 50 AS x, o_totalprice AS v,
        CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 0 ELSE 1 + (o_orderkey % 50) // 10 + 5 * (((o_orderkey // 50) % 50) // 10) + 25 * ((o_orderkey // 2500) // 3) END AS label FROM orders""",
    "pts": "SELECT label AS ROI, vec_id AS label, CAST(embedding[3] AS DOUBLE) * 100 AS z, CAST(embedding[2] AS DOUBLE) * 100 AS y, CAST(embedding[1] AS DOUBLE) * 100 AS x FROM embeddings",
    "times": "SELECT event_type AS acquisition, user_id % 8 AS well, user_id % 4 AS ROI, ts AS acquisitionTime, value AS Mean FROM events",
    "hier": "SELECT p_brand AS well, p_size AS ROI, p_type AS object FROM part",
}


def query(name: str, view: str | None = None, sql: str | None = None):
    """Register a function of ``(spark, sf_dir)``; its SQL sees the named views."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            with_ = ", ".join(f"{v} AS ({_VIEWS[v]})" for v in (view or "").split())
            SQL[name] = (f"WITH {'RECURSIVE ' if 'UNION ALL SELECT i + 1' in sql else ''}{with_}{', ' if with_ and sql.lstrip().startswith('--') else ' '}{sql}") if with_ else sql
        return f

    return add


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded, so that engines that sum in another order agree; negative zero becomes zero."""
    return F.round(F.col(q(c)) if isinstance(c, str) else c, digits) + F.lit(0.0)


def fields(df: DataFrame, *keys: str, digits: int = 4) -> DataFrame:
    """Keys as long, all other numbers rounded, structs flattened."""
    structs = [c for c, t in df.dtypes if t.startswith("struct")]
    df = reshape.unnest(df, structs) if structs else df
    return df.select(*(F.col(k).cast("long").alias(k) for k in keys), *(r(c, digits).alias(c) if t in ("double", "float") else F.col(q(c)) for c, t in df.dtypes if c not in keys))


# Voxels per object.
@query("feature_table", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, count(*) AS "NumberOfPixels", round(count(*) * 1.0, 4) AS "PhysicalSize", round(avg(z), 4) AS "Centroid-z",
    round(avg(ch0), 4) AS "ch0_Mean", round(min(ch0), 4) AS "ch0_Minimum", round(max(ch0), 4) AS "ch0_Maximum", round(sum(ch0), 4) AS "ch0_Sum", round(var_samp(ch0), 4) AS "ch0_Variance", round(stddev_samp(ch0), 4) AS "ch0_StandardDeviation",
    round(avg(ch2), 4) AS "ch2_Mean", round(sum(ch2), 4) AS "ch2_Sum", round(corr(ch0, ch2), 4) AS "ch0|ch2_PearsonR" FROM vox GROUP BY ROI, label""")
def feature_table(spark, sf_dir):
    """The flagship: shape, intensity and correlation in one pass over the voxels."""
    v = views.vox(spark, sf_dir)
    more = intensity.sums(["ch0"], ("Mean", "Minimum", "Maximum", "Sum", "Variance", "StandardDeviation"), (1.0, 1.0, 1.0)) | intensity.sums(["ch2"], ("Mean", "Sum"), (1.0, 1.0, 1.0))
    out = shape.fused(v.withColumns({"y": F.lit(0), "x": F.lit(0)}), (1.0, 1.0, 1.0), ("NumberOfPixels", "PhysicalSize", "Centroid"), more | {"ch0|ch2_PearsonR": coloc.pearson_of("ch0", "ch2")})
    return fields(out.withColumn("Centroid-z", F.col("Centroid.z")).drop("Centroid"), "ROI", "label")


@query("shape_basic", "grid", """SELECT CAST(ROI AS BIGINT) AS "ROI", label, count(*) AS "NumberOfPixels", round(count(*) * 0.5, 4) AS "PhysicalSize", round(avg(x) * 0.5, 4) AS "Centroid-x", round(avg(y) * 0.5, 4) AS "Centroid-y", round(avg(z) * 2.0, 4) AS "Centroid-z",
    min(x) AS "BoundingBox-lower-x", min(y) AS "BoundingBox-lower-y", min(z) AS "BoundingBox-lower-z", max(x) + 1 AS "BoundingBox-upper-x", max(y) + 1 AS "BoundingBox-upper-y", max(z) + 1 AS "BoundingBox-upper-z",
    round(pow(3 * count(*) * 0.5 / (4 * pi()), 1.0 / 3), 4) AS "EquivalentSphericalRadius", round(4 * pi() * pow(pow(3 * count(*) * 0.5 / (4 * pi()), 1.0 / 3), 2), 4) AS "EquivalentSphericalPerimeter"
    FROM grid WHERE label <> 0 GROUP BY ROI, label""")
def shape_basic(spark, sf_dir):
    return fields(shape.basic(views.grid(spark, sf_dir), SCALE), "ROI", "label")


@query("shape_border", "grid", """SELECT CAST(g.ROI AS BIGINT) AS "ROI", label,
    CAST(sum(CASE WHEN z IN (z0, z1) OR y IN (y0, y1) OR x IN (x0, x1) THEN 1 ELSE 0 END) AS BIGINT) AS "NumberOfPixelsOnBorder",
    round(sum(0.25 * (CAST(z = z0 AS INT) + CAST(z = z1 AS INT)) + 1.0 * (CAST(y = y0 AS INT) + CAST(y = y1 AS INT)) + 1.0 * (CAST(x = x0 AS INT) + CAST(x = x1 AS INT))), 4) AS "PerimeterOnBorder"
    FROM grid g JOIN (SELECT ROI, min(z) z0, max(z) z1, min(y) y0, max(y) y1, min(x) x0, max(x) x1 FROM grid GROUP BY ROI) e ON g.ROI = e.ROI WHERE label <> 0 GROUP BY g.ROI, label""")
def shape_border(spark, sf_dir):
    return fields(shape.border(views.grid(spark, sf_dir), SCALE), "ROI", "label")


_FACES = """d AS (SELECT label, lead(label) OVER (PARTITION BY z, y ORDER BY x) AS n, lead(x) OVER (PARTITION BY z, y ORDER BY x) = x + 1 AS ok, 1.0 AS a FROM grid
    UNION ALL SELECT label, lead(label) OVER (PARTITION BY z, x ORDER BY y), lead(y) OVER (PARTITION BY z, x ORDER BY y) = y + 1, 1.0 FROM grid
    UNION ALL SELECT label, lead(label) OVER (PARTITION BY y, x ORDER BY z), lead(z) OVER (PARTITION BY y, x ORDER BY z) = z + 1, 0.25 FROM grid),
    f AS (SELECT label, n AS neighbor, sum(a) AS area FROM (SELECT label, n, a FROM d WHERE ok AND n <> label UNION ALL SELECT n, label, a FROM d WHERE ok AND n <> label) GROUP BY 1, 2)"""


# What one entry along each of the thirteen directions (dz, dy, dx) stands for on voxels of 2.0 by 0.5 by 0.5:
# four times the share of the sphere closest to the direction, times the voxel's volume over the step's length.
_WEIGHTS = {
    (0, 0, 1): 0.59256, (0, 1, -1): 0.40124067, (0, 1, 0): 0.5928, (0, 1, 1): 0.40109925, (1, -1, -1): 0.07050326, (1, -1, 0): 0.02698936, (1, -1, 1): 0.07051269,
    (1, 0, -1): 0.02699907, (1, 0, 0): 0.00953, (1, 0, 1): 0.02705727, (1, 1, -1): 0.07039955, (1, 1, 0): 0.02707668, (1, 1, 1): 0.07049383,
}


def _entries() -> str:
    """Entries of lines into objects, for each direction by the voxel before along it, weighted."""
    parts = []
    for (dz, dy, dx), w in _WEIGHTS.items():
        parts.append(f"SELECT a.label, CAST({w!r} AS DOUBLE) AS w FROM grid a LEFT JOIN grid b ON b.z = a.z - ({dz}) AND b.y = a.y - ({dy}) AND b.x = a.x - ({dx}) WHERE a.label <> 0 AND a.label <> coalesce(b.label, 0)")
    return f"s AS (SELECT label, sum(w) AS s FROM ({' UNION ALL '.join(parts)}) GROUP BY label)"


@query("shape_perimeter", "grid", f"""-- , {_entries()}, b AS (SELECT label, sum(0.25 * (CAST(z = z0 AS INT) + CAST(z = z1 AS INT)) + CAST(y = y0 AS INT) + CAST(y = y1 AS INT) + CAST(x = x0 AS INT) + CAST(x = x1 AS INT)) AS border,
    4 * pi() * pow(pow(3 * count(*) * 0.5 / (4 * pi()), 1.0 / 3), 2) AS sphere
    FROM grid, (SELECT min(z) z0, max(z) z1, min(y) y0, max(y) y1, min(x) x0, max(x) x1 FROM grid) WHERE label <> 0 GROUP BY label)
    SELECT CAST(0 AS BIGINT) AS "ROI", label, round(s, 4) AS "Perimeter", round(border / s, 4) AS "PerimeterOnBorderRatio", round(sphere / s, 4) AS "Roundness" FROM b JOIN s USING (label)""")
def shape_perimeter(spark, sf_dir):
    return fields(shape.perimeter(views.grid(spark, sf_dir), SCALE).select("ROI", "label", "Perimeter", "PerimeterOnBorderRatio", "Roundness"), "ROI", "label")


def _eigen(weight: str) -> str:
    """Axes ``v`` (largest component positive) and moments ``e`` by label: the roots of the characteristic polynomial, and the longest cross product of two rows left without each."""
    at = {"x": "x * 0.5", "y": "y * 0.5", "z": "z * 2.0"}
    sums = ", ".join(f"sum({weight} * {at[i]} * {at[j]}) / sum({weight}) - sum({weight} * {at[i]}) * sum({weight} * {at[j]}) / pow(sum({weight}), 2){' + %r' % ({'x': 0.25, 'y': 0.25, 'z': 4.0}[i] / 12) if i == j else ''} AS {i}{j}" for i, j in ("xx", "xy", "xz", "yy", "yz", "zz"))
    less = {"xx": "(xx - e)", "yy": "(yy - e)", "zz": "(zz - e)"}
    row = [[less.get(f"{min(i, j)}{max(i, j)}", f"{min(i, j)}{max(i, j)}") for j in "xyz"] for i in "xyz"]
    cross = lambda u, v: "[" + ", ".join(f"{u[i]} * {v[j]} - {u[j]} * {v[i]}" for i, j in ((1, 2), (2, 0), (0, 1))) + "]"
    return f"""m AS (SELECT label, count(*) AS n, {sums} FROM grid WHERE label <> 0 GROUP BY label), o AS (SELECT *, (xx + yy + zz) / 3 AS q FROM m),
    p AS (SELECT *, sqrt((pow(xx - q, 2) + pow(yy - q, 2) + pow(zz - q, 2) + 2 * (xy * xy + xz * xz + yz * yz)) / 6) AS s FROM o),
    r AS (SELECT *, acos(greatest(-1, least(1, ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / (2 * s * s * s)))) / 3 AS phi FROM p),
    f AS (SELECT *, unnest(['a', 'b', 'c']) AS axis, unnest([q + 2 * s * cos(phi + 2 * pi() / 3), q + 2 * s * cos(phi - 2 * pi() / 3), q + 2 * s * cos(phi)]) AS e FROM r),
    g AS (SELECT label, n, axis, e, unnest([{cross(row[0], row[1])}, {cross(row[0], row[2])}, {cross(row[1], row[2])}]) AS w FROM f),
    h AS (SELECT label, n, axis, e, arg_max(w, list_dot_product(w, w)) AS w FROM g GROUP BY ALL),
    i AS (SELECT label, n, axis, e, list_transform(w, lambda t: t / sqrt(list_dot_product(w, w)) * sign(CASE WHEN abs(w[1]) >= greatest(abs(w[2]), abs(w[3])) THEN w[1] WHEN abs(w[2]) >= abs(w[3]) THEN w[2] ELSE w[3] END)) AS v FROM h),
    ev AS (SELECT label, n, {", ".join(f"max(e) FILTER (axis = '{x}') AS e{x}, any_value(v) FILTER (axis = '{x}') AS v{x}" for x in "abc")} FROM i GROUP BY label, n)"""


def _axes(name: str) -> str:
    return ", ".join(f'round(v{a}[{k}], 4) + 0.0 AS "{name}-{a}-{c}"' for a in "abc" for k, c in enumerate("xyz", 1))


@query("shape_moments", "grid", f"""-- , {_eigen('1.0')} SELECT CAST(0 AS BIGINT) AS "ROI", label, {", ".join(f'round(e{a}, 4) AS "PrincipalMoments-{a}"' for a in "abc")}, {_axes("PrincipalAxes")}, round(sqrt(ec / eb), 4) AS "Elongation", round(sqrt(eb / ea), 4) AS "Flatness",
    {", ".join(f'round(2 * pow(3 * n * 0.5 / (4 * pi()), 1.0 / 3) * sqrt(e{a} / pow(ea * eb * ec, 1.0 / 3)), 4) AS "EquivalentEllipsoidDiameter-{a}"' for a in "abc")} FROM ev""")
def shape_moments(spark, sf_dir):
    return fields(shape.moments(views.grid(spark, sf_dir), SCALE, solve=shape.principal_by_root), "ROI", "label")


@query("principal_moments", "grid", """-- , c AS (SELECT label, var_pop(z * 2.0) + 4.0 / 12 AS a, var_pop(y * 0.5) + 0.25 / 12 AS b, var_pop(x * 0.5) + 0.25 / 12 AS c, covar_pop(z * 2.0, y * 0.5) AS d, covar_pop(z * 2.0, x * 0.5) AS e, covar_pop(y * 0.5, x * 0.5) AS f FROM grid WHERE label <> 0 GROUP BY label),
    t AS (SELECT *, (a + b + c) / 3 AS q FROM c), u AS (SELECT *, sqrt((pow(a - q, 2) + pow(b - q, 2) + pow(c - q, 2) + 2 * (d * d + e * e + f * f)) / 6) AS p FROM t),
    v AS (SELECT *, CASE WHEN p > 0 THEN acos(greatest(-1, least(1, ((a - q) * ((b - q) * (c - q) - f * f) - d * (d * (c - q) - f * e) + e * (d * f - (b - q) * e)) / (2 * p * p * p)))) / 3 ELSE 0 END AS phi FROM u)
    SELECT CAST(0 AS BIGINT) AS "ROI", label, round(q + 2 * p * cos(phi + 2 * pi() / 3), 4) AS "PrincipalMoments-a", round(q - 2 * p * cos(phi + 2 * pi() / 3) - 2 * p * cos(phi), 4) AS "PrincipalMoments-b", round(q + 2 * p * cos(phi), 4) AS "PrincipalMoments-c" FROM v""")
def principal_moments(spark, sf_dir):
    return fields(shape.moments(views.grid(spark, sf_dir), SCALE).select("ROI", "label", "PrincipalMoments"), "ROI", "label")


@query("shape_feret", "grid", """-- , e AS (SELECT DISTINCT label, z, y, x FROM (SELECT label, z, y, min(x) AS x FROM grid WHERE label <> 0 GROUP BY ALL UNION ALL SELECT label, z, y, max(x) FROM grid WHERE label <> 0 GROUP BY ALL))
    SELECT CAST(0 AS BIGINT) AS "ROI", a.label, round(sqrt(max(pow((a.z - b.z) * 2.0, 2) + pow((a.y - b.y) * 0.5, 2) + pow((a.x - b.x) * 0.5, 2))), 4) AS "FeretDiameter" FROM e a JOIN e b USING (label) GROUP BY a.label""")
def shape_feret(spark, sf_dir):
    return fields(shape.feret(views.grid(spark, sf_dir), SCALE), "ROI", "label")


_ALONG = {a: (f"(x * 0.5 * v{a}[1] + y * 0.5 * v{a}[2] + z * 2.0 * v{a}[3])", f"(0.25 * abs(v{a}[1]) + 0.25 * abs(v{a}[2]) + abs(v{a}[3]))") for a in "abc"}


@query("shape_oriented_box", "grid", f"""-- , {_eigen('1.0')}, j AS (SELECT ev.label, {", ".join(f"any_value(v{a}) AS v{a}, min({p} - {h}) AS l{a}, max({p} + {h}) AS h{a}" for a, (p, h) in _ALONG.items())} FROM grid JOIN ev ON ev.label = grid.label GROUP BY ev.label)
    SELECT CAST(0 AS BIGINT) AS "ROI", label, {_axes("OrientedBoundingBoxDirection")}, {", ".join(f'round(h{a} - l{a}, 4) AS "OrientedBoundingBoxSize-{a}"' for a in "abc")},
    {", ".join(f'round({" + ".join(f"{end}{a} * v{a}[{k}]" for a in "abc")}, 4) + 0.0 AS "{name}-{c}"' for name, end in (("OrientedBoundingBoxOrigin", "l"), ("far", "h")) for k, c in enumerate("xyz", 1))}, CAST(8 AS INT) AS corners FROM j""")
def shape_oriented_box(spark, sf_dir):
    b = shape.oriented_box(views.grid(spark, sf_dir), SCALE, solve=shape.principal_by_root)
    vertices = F.col("OrientedBoundingBoxVertices")
    return fields(b.withColumns({"far": vertices[7], "corners": F.size(vertices)}).drop("OrientedBoundingBoxVertices"), "ROI", "label")


@query("shape_all")
def shape_all(spark, sf_dir):
    from ..functions import names

    return shape.features(views.grid(spark, sf_dir), SCALE, names.LABEL_FEATURES)


@query("intensity_moments", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, round(median(ch0), 4) AS "ch0_Median",
    round((avg(ch0 * ch0 * ch0) - 3 * avg(ch0) * avg(ch0 * ch0) + 2 * pow(avg(ch0), 3)) / nullif(pow(stddev_samp(ch0), 3), 0), 4) AS "ch0_Skewness",
    round((avg(pow(ch0, 4)) - 4 * avg(ch0) * avg(pow(ch0, 3)) + 6 * pow(avg(ch0), 2) * avg(ch0 * ch0) - 3 * pow(avg(ch0), 4)) / nullif(pow(stddev_samp(ch0), 4), 0) - 3, 4) AS "ch0_Kurtosis" FROM vox GROUP BY ROI, label""")
def intensity_moments(spark, sf_dir):
    return fields(intensity.features(views.vox(spark, sf_dir), ["ch0"], ("Median", "Skewness", "Kurtosis")), "ROI", "label")


@query("intensity_extrema", "grid", """SELECT CAST(ROI AS BIGINT) AS "ROI", label, arg_max(x, row(v, -z, -y, -x)) AS "v_MaximumIndex-x", arg_max(y, row(v, -z, -y, -x)) AS "v_MaximumIndex-y", arg_max(z, row(v, -z, -y, -x)) AS "v_MaximumIndex-z",
    arg_min(x, row(v, z, y, x)) AS "v_MinimumIndex-x", arg_min(y, row(v, z, y, x)) AS "v_MinimumIndex-y", arg_min(z, row(v, z, y, x)) AS "v_MinimumIndex-z" FROM grid WHERE label <> 0 GROUP BY ROI, label""")
def intensity_extrema(spark, sf_dir):
    return fields(intensity.features(views.grid(spark, sf_dir), ["v"], ("MaximumIndex", "MinimumIndex")), "ROI", "label")


@query("center_of_gravity", "grid", """SELECT CAST(ROI AS BIGINT) AS "ROI", label, round(sum(v * x * 0.5) / sum(v), 4) AS "v_CenterOfGravity-x", round(sum(v * y * 0.5) / sum(v), 4) AS "v_CenterOfGravity-y", round(sum(v * z * 2.0) / sum(v), 4) AS "v_CenterOfGravity-z" FROM grid WHERE label <> 0 GROUP BY ROI, label""")
def center_of_gravity(spark, sf_dir):
    return fields(intensity.features(views.grid(spark, sf_dir), ["v"], ("CenterOfGravity",), SCALE), "ROI", "label")


@query("intensity_weighted_shape", "grid", f"""-- , {_eigen('v')} SELECT CAST(0 AS BIGINT) AS "ROI", label, round(sqrt(ec / eb), 4) AS "v_WeightedElongation", round(sqrt(eb / ea), 4) AS "v_WeightedFlatness", {_axes("v_WeightedPrincipalAxes")}, {", ".join(f'round(e{a}, 4) AS "v_WeightedPrincipalMoments-{a}"' for a in "abc")} FROM ev""")
def intensity_weighted_shape(spark, sf_dir):
    return fields(intensity.features(views.grid(spark, sf_dir), ["v"], ("Weighted",), SCALE), "ROI", "label")


@query("masked_features", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CASE WHEN parent % 4 = ROI THEN label ELSE 0 END AS label, count(*) AS n, round(sum(CASE WHEN parent % 4 = ROI THEN ch0 ELSE 0 END), 4) AS total FROM vox GROUP BY 1, 2""")
def masked_features(spark, sf_dir):
    v = views.vox(spark, sf_dir).withColumn("mask_label", (F.col("parent") % 4).cast("int"))
    m = shape.masked(v.select("ROI", "label", "z", "ch0", "mask_label"))
    return m.groupBy("ROI", "label").agg(F.count("*").alias("n"), r(F.sum("ch0")).alias("total"))


# Colocalization.
def _coloc(name, metric, a, b, keys, body):
    @query(name, "vox", body)
    def run(spark, sf_dir):
        df = coloc.METRICS[metric](views.vox(spark, sf_dir), a, b, keys)
        return df.select(*(F.col(k).cast("long").alias(k) for k in keys), r("value").alias("value"))


_OBJ = ("ROI", "label")
_RAW = 'SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label'
_coloc("coloc_pearson", "PearsonR", "ch0", "ch1", _OBJ, f"{_RAW}, round(CASE WHEN count(*) >= 2 AND min(ch0) <> max(ch0) AND min(ch1) <> max(ch1) THEN corr(ch0, ch1) END, 4) + 0.0 AS value FROM vox GROUP BY ROI, vox.label")
_coloc("coloc_spearman", "SpearmanR", "ch0", "ch2", _OBJ, """-- , k AS (SELECT ROI, label, rank() OVER (PARTITION BY ROI, label ORDER BY ch0) + (count(*) OVER (PARTITION BY ROI, label, ch0) - 1) / 2.0 AS a, rank() OVER (PARTITION BY ROI, label ORDER BY ch2) + (count(*) OVER (PARTITION BY ROI, label, ch2) - 1) / 2.0 AS b FROM vox)
    SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, round(CASE WHEN count(*) >= 2 AND min(a) <> max(a) AND min(b) <> max(b) THEN corr(a, b) END, 4) + 0.0 AS value FROM k GROUP BY ROI, k.label""")
_coloc("coloc_kendall", "KendallTau", "ch0", "ch2", _OBJ, """-- , n AS (SELECT row_number() OVER () AS i, * FROM vox),
    p AS (SELECT a.ROI, a.label, sum(sign(a.ch0 - b.ch0) * sign(a.ch2 - b.ch2)) AS s, sum(abs(sign(a.ch0 - b.ch0))) AS x, sum(abs(sign(a.ch2 - b.ch2))) AS y FROM n a JOIN n b ON a.ROI = b.ROI AND a.label = b.label AND a.i < b.i GROUP BY 1, 2)
    SELECT CAST(v.ROI AS BIGINT) AS "ROI", CAST(v.label AS BIGINT) AS label, round(CASE WHEN x > 0 AND y > 0 THEN s / sqrt(CAST(x AS DOUBLE) * y) END, 4) + 0.0 AS value FROM (SELECT DISTINCT ROI, label FROM vox) v LEFT JOIN p ON v.ROI = p.ROI AND v.label = p.label""")
_BINNED = """-- , e AS (SELECT parent, ch0 AS a, ch2 AS b, min(ch0) OVER w AS la, max(ch0) OVER w AS ha, min(ch2) OVER w AS lb, max(ch2) OVER w AS hb FROM vox WINDOW w AS (PARTITION BY parent)),
    g AS (SELECT parent, least(floor((a - CASE WHEN ha = la THEN la - 0.5 ELSE la END) / CASE WHEN ha = la THEN 1 ELSE ha - la END * 10), 9) AS i, least(floor((b - CASE WHEN hb = lb THEN lb - 0.5 ELSE lb END) / CASE WHEN hb = lb THEN 1 ELSE hb - lb END * 10), 9) AS j, count(*) AS n FROM e GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY parent, i) AS ni, sum(n) OVER (PARTITION BY parent, j) AS nj, sum(n) OVER (PARTITION BY parent) AS al FROM g)"""
_PAR = "SELECT CAST(parent AS BIGINT) AS parent"
_coloc("coloc_chi2", "Chi2Contingency", "ch0", "ch2", ("parent",), f"{_BINNED} {_PAR}, round(CASE WHEN count(DISTINCT i) = 10 AND count(DISTINCT j) = 10 AND max(al) >= 2 THEN max(al) * (sum(CAST(n AS DOUBLE) * n / (CAST(ni AS DOUBLE) * nj)) - 1) END, 4) + 0.0 AS value FROM c GROUP BY c.parent")
_coloc("coloc_mi_bins", "MutualInfoBins", "ch0", "ch2", ("parent",), f"{_BINNED} {_PAR}, round(CASE WHEN max(al) >= 2 THEN greatest(0, sum(n / CAST(al AS DOUBLE) * ln(CAST(n AS DOUBLE) * al / (CAST(ni AS DOUBLE) * nj)))) END, 4) + 0.0 AS value FROM c GROUP BY c.parent")
_CELLS = """-- , g AS (SELECT parent, ch0 AS i, ch2 AS j, count(*) AS n FROM vox GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY parent, i) AS ni, sum(n) OVER (PARTITION BY parent, j) AS nj, sum(n) OVER (PARTITION BY parent) AS al FROM g)"""
_MI = "greatest(0, sum(n / CAST(al AS DOUBLE) * ln(CAST(n AS DOUBLE) * al / (CAST(ni AS DOUBLE) * nj))))"
_coloc("coloc_mi", "MutualInfo", "ch0", "ch2", ("parent",), f"{_CELLS} {_PAR}, round(CASE WHEN max(al) >= 2 THEN {_MI} END, 4) + 0.0 AS value FROM c GROUP BY c.parent")
_H = "(-sum(n / CAST(al AS DOUBLE) * ln(ni / CAST(al AS DOUBLE))) - sum(n / CAST(al AS DOUBLE) * ln(nj / CAST(al AS DOUBLE))))"
_coloc("coloc_nmi", "MutualInfoNormalized", "ch0", "ch2", ("parent",), f"{_CELLS} {_PAR}, round(CASE WHEN max(al) >= 2 THEN CASE WHEN {_H} > 0 THEN {_MI} / ({_H} / 2) ELSE 1 END END, 4) + 0.0 AS value FROM c GROUP BY c.parent")


# Hierarchy.
@query("parent_assignment", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, arg_max(parent, row(n, parent)) AS "parent.supplier" FROM (SELECT ROI, label, parent, count(*) AS n FROM vox GROUP BY ALL) GROUP BY ROI, label""")
def parent_assignment(spark, sf_dir):
    return fields(hierarchy.parents(views.vox(spark, sf_dir), "parent", "supplier"), "ROI", "label")


@query("hierarchy_counts", "hier", """SELECT well, ROI AS "ROI", count(*) FILTER (object = 'PROMO') AS "PROMO_Count", count(*) FILTER (object = 'STANDARD') AS "STANDARD_Count" FROM hier GROUP BY well, ROI""")
def hierarchy_counts(spark, sf_dir):
    return hierarchy.counts(views.hier(spark, sf_dir), ("PROMO", "STANDARD"))


@query("object_metadata", "hier", """SELECT well, ROI AS "ROI", substr(well, 1, 1) AS "row", substr(well, 2) AS col, well IN ('Brand#11', 'Brand#22') AS is_control_well, count(*) FILTER (object = 'ECONOMY') AS "ECONOMY_Count",
    round(CASE WHEN count(*) FILTER (object = 'ECONOMY') > 0 THEN CAST(CAST(log2(count(*) FILTER (object = 'ECONOMY')) AS FLOAT) AS DOUBLE) END, 3) AS "log2_ECONOMY_Count" FROM hier GROUP BY well, ROI""")
def object_metadata(spark, sf_dir):
    m = hierarchy.metadata(views.hier(spark, sf_dir), ("ECONOMY",), ("Brand#11", "Brand#22"))
    return m.withColumn("log2_ECONOMY_Count", F.round(F.col("log2_ECONOMY_Count").cast("double"), 3))


# Distances.
def _along(name, function, axis, others, size):
    @query(name, "grid", f"""-- , d AS (SELECT *, sum(CASE WHEN label % 2 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY ROI, {others} ORDER BY {axis} ROWS UNBOUNDED PRECEDING) * CAST({size} AS DOUBLE) AS d FROM grid)
        SELECT CAST(ROI AS BIGINT) AS "ROI", label, round(max(d), 4) AS "host_Maximum{function}", round(min(d), 4) AS "host_Minimum{function}", round(median(d), 4) AS "host_Median{function}" FROM d WHERE label <> 0 GROUP BY ROI, d.label""")
    def run(spark, sf_dir):
        g = views.grid(spark, sf_dir).withColumn("mask", F.col("label") % 2 == 1)
        return fields(distance.features(g, "host", "mask", ("Maximum", "Minimum", "Median"), (function,), SCALE).select("ROI", "label", *(f"host_{s}{function}" for s in ("Maximum", "Minimum", "Median"))), "ROI", "label")


_along("dist_along_z", "DistanceAlongZ", "z", "y, x", 2.0)
_along("dist_along_y", "DistanceAlongY", "y", "z, x", 0.5)
_along("dist_along_x", "DistanceAlongX", "x", "z, y", 0.5)


@query("dist_at_centroid", "grid", """-- , d AS (SELECT *, sum(CASE WHEN label % 2 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY ROI, y, x ORDER BY z ROWS UNBOUNDED PRECEDING) * 2.0 AS d FROM grid),
    c AS (SELECT label, CAST(floor(avg(z) + 0.5) AS BIGINT) AS z, CAST(floor(avg(y) + 0.5) AS BIGINT) AS y, CAST(floor(avg(x) + 0.5) AS BIGINT) AS x FROM grid WHERE label <> 0 GROUP BY label)
    SELECT CAST(0 AS BIGINT) AS "ROI", c.label, round(d.d, 4) AS "host_CentroidDistanceAlongZ" FROM c LEFT JOIN d USING (z, y, x)""")
def dist_at_centroid(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("mask", F.col("label") % 2 == 1)
    return fields(distance.features(g, "host", "mask", ("Centroid",), ("DistanceAlongZ",), SCALE), "ROI", "label")


@query("dist_to_border", "grid", """-- , k AS (SELECT *, label % 2 = 1 AS m FROM grid), d AS (SELECT a.z, a.y, a.x, a.label, CASE WHEN a.m THEN 1 ELSE -1 END * sqrt(min(pow((a.z - b.z) * 2.0, 2) + pow((a.y - b.y) * 0.5, 2) + pow((a.x - b.x) * 0.5, 2))) AS d FROM k a JOIN k b ON a.m <> b.m GROUP BY a.z, a.y, a.x, a.label, a.m),
    c AS (SELECT label, CAST(floor(avg(z) + 0.5) AS BIGINT) AS z, CAST(floor(avg(y) + 0.5) AS BIGINT) AS y, CAST(floor(avg(x) + 0.5) AS BIGINT) AS x FROM grid WHERE label <> 0 GROUP BY label)
    SELECT CAST(0 AS BIGINT) AS "ROI", o.label, round(o.h, 4) AS "host_MaximumDistanceToBorder", round(o.l, 4) AS "host_MinimumDistanceToBorder", round(o.n, 4) AS "host_MedianDistanceToBorder", round(d.d, 4) AS "host_CentroidDistanceToBorder"
    FROM (SELECT label, max(d) AS h, min(d) AS l, median(d) AS n FROM d WHERE label <> 0 GROUP BY label) o JOIN c ON c.label = o.label LEFT JOIN d ON d.z = c.z AND d.y = c.y AND d.x = c.x""")
def dist_to_border(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("mask", F.col("label") % 2 == 1)
    stats = ("Maximum", "Minimum", "Median", "Centroid")
    out = distance.features(g, "host", "mask", stats, ("DistanceToBorder",), SCALE)
    return fields(out.select("ROI", "label", *(f"host_{s}DistanceToBorder" for s in stats)), "ROI", "label")


# Neighbourhoods.
_DIST = "sqrt(pow(a.z - b.z, 2) + pow(a.y - b.y, 2) + pow(a.x - b.x, 2))"
_PAIRS = f"p AS (SELECT a.ROI, a.label AS focal, b.label AS neighbor, {_DIST} AS w FROM pts a JOIN pts b ON a.ROI = b.ROI AND a.label <> b.label)"
_KNN = "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ROI, focal ORDER BY w, neighbor) AS n FROM p) WHERE n <= 5)"
_ROI = 'CAST(pts.ROI AS BIGINT) AS "ROI", pts.label'


@query("radius_count", "pts", f"""-- , {_PAIRS} SELECT {_ROI}, count(w) FILTER (w <= 10) AS "RAD:10_Count", count(w) FILTER (w <= 20) AS "RAD:20_Count" FROM pts LEFT JOIN p ON p.ROI = pts.ROI AND p.focal = pts.label GROUP BY pts.ROI, pts.label""")
def radius_count(spark, sf_dir):
    return fields(A.Neighborhoods(views.pts(spark, sf_dir)).radius((10, 20)).aggregate(), "ROI", "label")


@query("radius_count_bucketed", "pts", f"""-- , {_PAIRS} SELECT {_ROI}, count(w) FILTER (w <= 15) AS "RAD:15_Count" FROM pts LEFT JOIN p ON p.ROI = pts.ROI AND p.focal = pts.label GROUP BY pts.ROI, pts.label""")
def radius_count_bucketed(spark, sf_dir):
    p = views.pts(spark, sf_dir)
    return fields(A.counts(N.radius(p, 15, bucket=True), p, "RAD:15"), "ROI", "label")


@query("radius_mean", "pts", f"""-- , {_PAIRS} SELECT {_ROI}, round(avg(b.x) FILTER (w <= 20), 4) AS "RAD:20_Mean__x", round(coalesce(sum(b.x) FILTER (w <= 20), 0), 4) AS "RAD:20_Sum__x", round(stddev_pop(b.x) FILTER (w <= 20), 4) AS "RAD:20_Std__x",
    round(median(b.x) FILTER (w <= 20), 4) AS "RAD:20_Median__x", round(quantile_cont(b.x, 0.25) FILTER (w <= 20), 4) AS "RAD:20_Q0.25__x", round(min(b.x) FILTER (w <= 20), 4) AS "RAD:20_Min__x", round(max(b.x) FILTER (w <= 20), 4) AS "RAD:20_Max__x", round(var_pop(b.x) FILTER (w <= 20), 4) AS "RAD:20_Var__x"
    FROM pts LEFT JOIN p ON p.ROI = pts.ROI AND p.focal = pts.label LEFT JOIN pts b ON b.ROI = p.ROI AND b.label = p.neighbor GROUP BY pts.ROI, pts.label""")
def radius_mean(spark, sf_dir):
    p = views.pts(spark, sf_dir)
    return fields(A.radius_features(p, p, ["x"], 20, ["Mean", "Sum", "Std", "Median", A.quantile(0.25), "Min", "Max", "Var"], "RAD:20"), "ROI", "label")


@query("knn_distance", "pts", f"""-- , {_PAIRS}, {_KNN} SELECT {_ROI}, round(avg(w) FILTER (n <= 2), 4) AS "KNNd:2_Mean", round(max(w) FILTER (n <= 2), 4) AS "KNNd:2_Max", round(avg(w), 4) AS "KNNd:5_Mean", round(max(w), 4) AS "KNNd:5_Max" FROM pts LEFT JOIN k ON k.ROI = pts.ROI AND k.focal = pts.label GROUP BY pts.ROI, pts.label""")
def knn_distance(spark, sf_dir):
    return fields(A.Neighborhoods(views.pts(spark, sf_dir)).knn((2, 5), distance=True).aggregate_weights(("Mean", "Max")), "ROI", "label")


@query("knn_bucketed", "pts", f"""-- , {_PAIRS}, {_KNN} SELECT {_ROI}, round(avg(w), 4) AS "KNNd:5_Mean", round(max(w), 4) AS "KNNd:5_Max" FROM pts LEFT JOIN k ON k.ROI = pts.ROI AND k.focal = pts.label GROUP BY pts.ROI, pts.label""")
def knn_bucketed(spark, sf_dir):
    p = views.pts(spark, sf_dir)
    return fields(A.weights(N.knn(p, 5, bucket=True), p, ("Mean", "Max"), "KNNd:5"), "ROI", "label")


@query("knn_mode", "pts", f"""-- , {_PAIRS}, {_KNN}, m AS (SELECT k.ROI, focal, neighbor % 3 AS v, count(*) AS n FROM k GROUP BY ALL)
    SELECT {_ROI}, arg_max(v, row(n, v)) AS "KNN:5_Mode__third" FROM pts LEFT JOIN m ON m.ROI = pts.ROI AND m.focal = pts.label GROUP BY pts.ROI, pts.label""")
def knn_mode(spark, sf_dir):
    p = views.pts(spark, sf_dir).withColumn("third", F.col("label") % 3)
    return fields(A.features(N.knn(p, 5), p, ["third"], ["Mode"], "KNN:5"), "ROI", "label")


@query("circular_stats", "pts", f"""-- , {_PAIRS}, {_KNN} SELECT {_ROI}, round(atan2(sum(sin(b.x)), sum(cos(b.x))), 4) AS "KNN:5_CircMean__x", round(sqrt(pow(sum(sin(b.x)), 2) + pow(sum(cos(b.x)), 2)) / count(b.x), 4) AS "KNN:5_CircR__x", round(1 - sqrt(pow(sum(sin(b.x)), 2) + pow(sum(cos(b.x)), 2)) / count(b.x), 4) AS "KNN:5_CircVar__x"
    FROM pts JOIN k ON k.ROI = pts.ROI AND k.focal = pts.label JOIN pts b ON b.ROI = k.ROI AND b.label = k.neighbor GROUP BY pts.ROI, pts.label""")
def circular_stats(spark, sf_dir):
    p = views.pts(spark, sf_dir)
    return fields(A.features(N.knn(p, 5), p, ["x"], ["CircMean", "CircR", "CircVar"], "KNN:5"), "ROI", "label")


@query("neighbor_lists", "pts", f"""-- , {_PAIRS} SELECT {_ROI}, coalesce(array_to_string(list_sort(list(neighbor) FILTER (w <= 10)), ','), '') AS neighbors FROM pts LEFT JOIN p ON p.ROI = pts.ROI AND p.focal = pts.label GROUP BY pts.ROI, pts.label""")
def neighbor_lists(spark, sf_dir):
    out = A.Neighborhoods(views.pts(spark, sf_dir)).radius(10).aggregate(("Neighbors",))
    return out.select(F.col("ROI").cast("long").alias("ROI"), "label", F.concat_ws(",", F.transform(F.col(q("RAD:10_Neighbors")), lambda x: x.cast("string"))).alias("neighbors"))


@query("neighbor_indices", "pts", f"""-- , {_PAIRS}, i AS (SELECT ROI, label, row_number() OVER (PARTITION BY ROI ORDER BY label) - 1 AS i FROM pts)
    SELECT {_ROI}, coalesce(array_to_string(list_sort(list(i) FILTER (w <= 10)), ','), '') AS indices FROM pts LEFT JOIN p ON p.ROI = pts.ROI AND p.focal = pts.label LEFT JOIN i ON i.ROI = p.ROI AND i.label = p.neighbor GROUP BY pts.ROI, pts.label""")
def neighbor_indices(spark, sf_dir):
    out = A.Neighborhoods(views.pts(spark, sf_dir)).radius(10).aggregate(("NeighborIndices",))
    return out.select(F.col("ROI").cast("long").alias("ROI"), "label", F.concat_ws(",", F.transform(F.col(q("RAD:10_NeighborIndices")), lambda x: x.cast("string"))).alias("indices"))


@query("weighted_features", "pts", f"""-- , {_PAIRS}, {_KNN} SELECT {_ROI}, round(avg(b.x * k.w), 4) AS "KNNd:5_Mean__x", round(coalesce(sum(b.x * k.w), 0), 4) AS "KNNd:5_Sum__x" FROM pts LEFT JOIN k ON k.ROI = pts.ROI AND k.focal = pts.label LEFT JOIN pts b ON b.ROI = k.ROI AND b.label = k.neighbor GROUP BY pts.ROI, pts.label""")
def weighted_features(spark, sf_dir):
    p = views.pts(spark, sf_dir)
    return fields(A.features(N.knn(p, 5), p, ["x"], ["Mean", "Sum"], "KNNd:5", weighted=True), "ROI", "label")


_EDGE = 'CAST(ROI AS BIGINT) AS "ROI", focal, neighbor'


@query("kernel_radius", "pts", f"""-- , l AS (SELECT ROI, focal, neighbor, w FROM (SELECT a.ROI, a.label AS focal, b.label AS neighbor, {_DIST} AS w FROM pts a JOIN pts b ON a.ROI = b.ROI) WHERE w <= 15)
    SELECT {_EDGE}, round((1 - w / 15) / sum(1 - w / 15) OVER (PARTITION BY ROI, focal), 4) AS weight FROM l""")
def kernel_radius(spark, sf_dir):
    return fields(N.radius_kernel(views.pts(spark, sf_dir), 15), "ROI")


@query("kernel_knn", "pts", f"""-- , {_PAIRS}, {_KNN}, l AS (SELECT ROI, focal, neighbor, w / max(w) OVER (PARTITION BY ROI, focal) AS z FROM k) SELECT {_EDGE}, round(exp(-z * z / 2) / sqrt(2 * pi()), 4) AS weight FROM l""")
def kernel_knn(spark, sf_dir):
    return fields(N.knn_kernel(views.pts(spark, sf_dir), 5, "gaussian", False, False), "ROI")


@query("two_step_walk", "pts", f"""-- , {_PAIRS}, e AS (SELECT ROI, focal, neighbor FROM p WHERE w <= 8) SELECT DISTINCT CAST(a.ROI AS BIGINT) AS "ROI", a.focal, b.neighbor, 1.0::DOUBLE AS weight FROM e a JOIN e b ON a.ROI = b.ROI AND a.neighbor = b.focal WHERE a.focal <> b.neighbor""")
def two_step_walk(spark, sf_dir):
    return fields(N.radius_walks(views.pts(spark, sf_dir), 8), "ROI")


@query("edge_threshold", "grid", f"""-- , {_FACES}, s AS (SELECT label AS focal, neighbor, area / sum(area) OVER (PARTITION BY label) AS weight FROM f WHERE label <> 0) SELECT CAST(0 AS BIGINT) AS "ROI", focal, neighbor, round(weight, 4) AS weight FROM s WHERE neighbor <> 0 AND weight >= 0.1""")
def edge_threshold(spark, sf_dir):
    return fields(N.threshold(N.touch(views.grid(spark, sf_dir), SCALE), 0.1), "ROI")


@query("touch_matrix", "grid", f"""-- , {_FACES} SELECT CAST(0 AS BIGINT) AS "ROI", label, neighbor, round(area, 4) AS area FROM f""")
def touch_matrix(spark, sf_dir):
    return fields(N.faces(views.grid(spark, sf_dir), SCALE), "ROI")


@query("touch_fraction", "grid", f"""-- , {_FACES}, s AS (SELECT label AS focal, neighbor, area / sum(area) OVER (PARTITION BY label) AS weight FROM f WHERE label <> 0) SELECT CAST(0 AS BIGINT) AS "ROI", focal, neighbor, round(weight, 4) AS weight FROM s WHERE neighbor <> 0""")
def touch_fraction(spark, sf_dir):
    return fields(N.touch(views.grid(spark, sf_dir), SCALE), "ROI")


@query("touch_count", "grid", f"""-- , {_FACES} SELECT CAST(0 AS BIGINT) AS "ROI", g.label, count(f.neighbor) AS "TOUCH:1_Count" FROM (SELECT DISTINCT label FROM grid WHERE label <> 0) g LEFT JOIN f ON f.label = g.label AND f.neighbor <> 0 GROUP BY g.label""")
def touch_count(spark, sf_dir):
    return fields(A.Neighborhoods.from_voxels(views.grid(spark, sf_dir), SCALE).touch().aggregate(), "ROI", "label")


#: Four points of a region span a tetrahedron of the graph if no point lies in their sphere; its centre follows from their differences.
_TETRAHEDRA = """b AS (SELECT ROI, label, z - min(z) OVER w AS z, y - min(y) OVER w AS y, x - min(x) OVER w AS x FROM pts WINDOW w AS (PARTITION BY ROI)),
    q AS (SELECT a.ROI, a.label AS a, b.label AS b, c.label AS c, d.label AS d, a.z AS oz, a.y AS oy, a.x AS ox, b.z - a.z AS uz, b.y - a.y AS uy, b.x - a.x AS ux, c.z - a.z AS vz, c.y - a.y AS vy, c.x - a.x AS vx, d.z - a.z AS wz, d.y - a.y AS wy, d.x - a.x AS wx
        FROM b a JOIN b ON a.ROI = b.ROI AND a.label < b.label JOIN b c ON c.ROI = b.ROI AND b.label < c.label JOIN b d ON d.ROI = c.ROI AND c.label < d.label),
    n AS (SELECT *, uz * uz + uy * uy + ux * ux AS u, vz * vz + vy * vy + vx * vx AS v, wz * wz + wy * wy + wx * wx AS w, 2 * (uz * (vy * wx - vx * wy) - uy * (vz * wx - vx * wz) + ux * (vz * wy - vy * wz)) AS e FROM q),
    s AS (SELECT ROI, a, b, c, d, oz, oy, ox, (u * (vy * wx - vx * wy) + v * (wy * ux - wx * uy) + w * (uy * vx - ux * vy)) / e AS cz, (u * (vx * wz - vz * wx) + v * (wx * uz - wz * ux) + w * (ux * vz - uz * vx)) / e AS cy, (u * (vz * wy - vy * wz) + v * (wz * uy - wy * uz) + w * (uz * vy - uy * vz)) / e AS cx FROM n WHERE e <> 0),
    t AS (SELECT s.* FROM s WHERE NOT EXISTS (FROM b o WHERE o.ROI = s.ROI AND o.label NOT IN (s.a, s.b, s.c, s.d) AND pow(o.z - s.oz - cz, 2) + pow(o.y - s.oy - cy, 2) + pow(o.x - s.ox - cx, 2) < cz * cz + cy * cy + cx * cx)),
    h AS (SELECT ROI, unnest([a, a, a, b, b, c]) AS i, unnest([b, c, d, c, d, d]) AS j FROM t), g AS (SELECT ROI, i AS focal, j AS neighbor FROM h UNION SELECT ROI, j, i FROM h)"""


@query("delaunay_count", "pts", f"""-- , {_TETRAHEDRA}, k AS (SELECT DISTINCT g.ROI, g.focal, o.neighbor FROM g JOIN g o ON o.ROI = g.ROI AND o.focal = g.neighbor WHERE g.focal <> o.neighbor)
    SELECT pts.ROI AS "ROI", pts.label, (SELECT count(*) FROM g WHERE g.ROI = pts.ROI AND g.focal = pts.label) AS "DELAUNAY:1_Count", (SELECT count(*) FROM k WHERE k.ROI = pts.ROI AND k.focal = pts.label) AS "DELAUNAY:2_Count" FROM pts""")
def delaunay_count(spark, sf_dir):
    return A.Neighborhoods(views.pts(spark, sf_dir)).delaunay((1, 2)).aggregate()


@query("delaunay_mask_share")
def delaunay_mask_share(spark, sf_dir):
    g = views.grid(spark, sf_dir)
    hood = A.Neighborhoods.from_voxels(g, SCALE, g.where(F.col("label") != 0))
    return N.mask_share(N.delaunay(hood.points), hood.points, hood.mask, 10, SCALE)


@query("delaunay_threshold")
def delaunay_threshold(spark, sf_dir):
    """Edges of which at least half lies in objects, by the mask's own scale."""
    g = views.grid(spark, sf_dir)
    return A.Neighborhoods.from_voxels(g, SCALE, g.where(F.col("label") != 0)).delaunay(threshold=0.5).aggregate()


@query("neighborhood_preset", "pts", f"""-- , {_PAIRS}, {_TETRAHEDRA}, k AS (SELECT *, row_number() OVER (PARTITION BY ROI, focal ORDER BY w, neighbor) AS n FROM p) SELECT {_ROI}, {", ".join(f'count(w) FILTER (w <= {x}) AS "RAD:{x}_Count"' for x in (10, 20, 30, 40, 50, 80, 100, 150, 200, 250))}, round(max(w) FILTER (n <= 1), 4) AS "KNNd:1_Max", {", ".join(f'round(avg(w) FILTER (n <= {x}), 4) AS "KNNd:{x}_Mean", round(max(w) FILTER (n <= {x}), 4) AS "KNNd:{x}_Max"' for x in (2, 5, 10, 20, 50, 100, 200))}, any_value((SELECT count(*) FROM g WHERE g.ROI = pts.ROI AND g.focal = pts.label)) AS "DELAUNAY:1_Count"
    FROM pts LEFT JOIN k ON k.ROI = pts.ROI AND k.focal = pts.label GROUP BY pts.ROI, pts.label""")
def neighborhood_preset(spark, sf_dir):
    """Points have no faces that could touch; the preset of voxels counts those too."""
    return fields(A.preset(A.Neighborhoods(views.pts(spark, sf_dir)), touch=False), "ROI", "label")


@query("neighborhood_preset_voxels")
def neighborhood_preset_voxels(spark, sf_dir):
    return A.preset(A.Neighborhoods.from_voxels(views.grid(spark, sf_dir), SCALE))


# Reshaping.
def _feat(spark, sf_dir) -> DataFrame:
    return shape.objects(views.vox(spark, sf_dir)).groupBy("ROI", "label").agg(F.avg("ch0").alias("ch0_Mean"), F.avg("ch1").alias("ch1_Mean"), F.max("ch0").alias("ch0_Maximum"), F.struct(F.avg("z").alias("z"), F.min("z").cast("double").alias("y")).alias("Centroid"), F.corr("ch0", "ch1").alias("c_0|c_0_PearsonR"), F.corr("ch0", "ch2").alias("c_1|c_0_PearsonR"))


_FEAT = "-- , feat AS (SELECT CAST(ROI AS BIGINT) AS ROI, CAST(label AS BIGINT) AS label, avg(ch0) AS m0, avg(ch1) AS m1, max(ch0) AS x0, avg(z) AS cz, CAST(min(z) AS DOUBLE) AS cy, corr(ch0, ch1) AS r0, corr(ch0, ch2) AS r1 FROM vox GROUP BY ROI, vox.label)"


@query("unpivot_channels", "vox", f"""{_FEAT} SELECT ROI AS "ROI", label, 'ch0' AS channel, round(m0 + 0.000003, 4) AS "Mean", round(x0, 4) AS "Maximum" FROM feat WHERE m0 IS NOT NULL AND x0 IS NOT NULL UNION ALL SELECT ROI, label, 'ch1', round(m1 + 0.000003, 4), NULL FROM feat WHERE m1 IS NOT NULL""")
def unpivot_channels(spark, sf_dir):
    out = reshape.stack(_feat(spark, sf_dir).select("ROI", "label", "ch0_Mean", "ch1_Mean", "ch0_Maximum"), "channel")
    # Means of two-digit prices often end in a 5 after the last digit kept; the shift keeps both engines off it.
    return fields(out.withColumn("Mean", F.col("Mean") + 0.000003), "ROI", "label")


@query("unpivot_correlation", "vox", f"""{_FEAT} SELECT ROI AS "ROI", label, 0 AS acquisition, round(r0, 4) + 0.0 AS "alignmentScore" FROM feat UNION ALL SELECT ROI, label, 1, round(r1, 4) + 0.0 FROM feat""")
def unpivot_correlation(spark, sf_dir):
    f = _feat(spark, sf_dir)
    return fields(reshape.stack_correlations(f, reshape.correlation_acquisitions(f), ("ROI", "label")), "ROI", "label")


@query("unnest_structs", "vox", f"""{_FEAT} SELECT ROI AS "ROI", label, round(cz, 4) AS "Centroid-z", round(cy, 4) AS "Centroid-y" FROM feat""")
def unnest_structs(spark, sf_dir):
    return fields(reshape.unnest(_feat(spark, sf_dir).select("ROI", "label", "Centroid"), "Centroid"), "ROI", "label")


@query("tall_first_non_null", "vox", """-- , u AS (SELECT label, CASE WHEN z < 4 THEN ch0 END AS a, CASE WHEN z >= 4 THEN ch1 END AS b, CASE WHEN z = 1 THEN ROI END AS roi FROM vox) SELECT CAST(label AS INT) AS label, 'o' || label AS key, round(min(a), 4) AS a, round(min(b), 4) AS b, coalesce(CAST(min(roi) AS BIGINT), -1) AS roi FROM u GROUP BY u.label""")
def tall_first_non_null(spark, sf_dir):
    v = views.vox(spark, sf_dir)
    u = v.select(F.concat(F.lit("o"), F.col("label").cast("string")).alias("key"), "label", F.when(F.col("z") < 4, F.col("ch0")).alias("a"), F.when(F.col("z") >= 4, F.col("ch1")).alias("b"), F.when(F.col("z") == 1, F.col("ROI")).alias("roi"))
    return reshape.to_tall(u, "key").select("label", "key", r("a").alias("a"), r("b").alias("b"), F.coalesce(F.col("roi").cast("long"), F.lit(-1).cast("long")).alias("roi"))


@query("split_channel_pair", None, """SELECT c_custkey AS label, split_part(p, '|', 1) AS first, split_part(p, '|', 2) AS second, CASE WHEN split_part(p, '|', 1) = 'BUILDING_1' THEN split_part(p, '|', 2) ELSE split_part(p, '|', 1) END AS channel, CASE WHEN split_part(p, '|', 2) = 'BUILDING_1' THEN split_part(p, '|', 2) ELSE split_part(p, '|', 1) END AS channel_ref,
    split_part(CASE WHEN split_part(p, '|', 1) = 'BUILDING_1' THEN split_part(p, '|', 2) ELSE split_part(p, '|', 1) END, '_', 1) AS stain, split_part(CASE WHEN split_part(p, '|', 1) = 'BUILDING_1' THEN split_part(p, '|', 2) ELSE split_part(p, '|', 1) END, '_', 2) AS acquisition
    FROM (SELECT c_custkey, c_mktsegment || '_1|' || 'N' || c_nationkey || '_2' AS p FROM customer)""")
def split_channel_pair(spark, sf_dir):
    c = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("label"), F.concat(F.col("c_mktsegment"), F.lit("_1|N"), F.col("c_nationkey").cast("string"), F.lit("_2")).alias("channel_pair"))
    out = reshape.split_channel_pair(c, ("label",), "BUILDING_1")
    plain = reshape.split_column(c, "channel_pair", ("first", "second"), "|", ("label",)).select("label", "first", "second")
    return plain.join(out.select("label", "channel", "channel_ref", "stain", "acquisition"), "label")


@query("diagonal_union", None, """SELECT s_suppkey AS key, s_name AS name, CAST(s_nationkey AS DOUBLE) AS v, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, NULL, round(c_acctbal, 4), c_mktsegment FROM customer""")
def diagonal_union(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("v"))
    c = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), r("c_acctbal").alias("v"), F.col("c_mktsegment").alias("segment"))
    return reshape.union_diagonal(s, c)


@query("pad_align", "grid", """-- , a AS (SELECT z, y, x, label FROM grid WHERE x < 40), b AS (SELECT z, y, x, label FROM grid WHERE y < 30) SELECT coalesce(a.z, b.z) AS z, coalesce(a.y, b.y) AS y, coalesce(a.x, b.x) AS x, coalesce(a.label, 0) AS a, coalesce(b.label, 0) AS b FROM a FULL JOIN b ON a.z = b.z AND a.y = b.y AND a.x = b.x""")
def pad_align(spark, sf_dir):
    g = views.grid(spark, sf_dir)
    return reshape.padded(g.where("x < 40"), g.where("y < 30"), "label")


@query("align_features", "vox", """-- , a AS (SELECT ROI, label, count(*) AS n FROM vox WHERE z < 3 GROUP BY ALL), b AS (SELECT ROI, label, max(ch0) AS m FROM vox WHERE z > 5 GROUP BY ALL) SELECT CAST(coalesce(a.ROI, b.ROI) AS BIGINT) AS "ROI", CAST(coalesce(a.label, b.label) AS BIGINT) AS label, coalesce(n, 0) AS n, round(m, 4) AS m FROM a FULL JOIN b ON a.ROI = b.ROI AND a.label = b.label""")
def align_features(spark, sf_dir):
    v = views.vox(spark, sf_dir)
    return fields(hierarchy.aligned([v.where("z < 3").groupBy("ROI", "label").agg(F.count("*").alias("n")), v.where("z > 5").groupBy("ROI", "label").agg(F.max("ch0").alias("m"))]).fillna(0, ["n"]), "ROI", "label")


@query("pyramid_level", "grid", """SELECT 0 AS "ROI", z, y // 2 AS y, x // 2 AS x, arg_min(label, row(z, y, x)) AS label, round(avg(v), 4) AS v FROM grid GROUP BY z, y // 2, x // 2""")
def pyramid_level(spark, sf_dir):
    from ..sources import tables

    return tables.level(views.grid(spark, sf_dir)).withColumn("v", r("v"))


@query("iqr_bounds", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", round(quantile_cont(ch1, 0.25), 4) AS ql, round(quantile_cont(ch1, 0.75), 4) AS qu, round(quantile_cont(ch1, 0.75) - quantile_cont(ch1, 0.25), 4) AS iqr, round(quantile_cont(ch1, 0.25) - 0.25 * (quantile_cont(ch1, 0.75) - quantile_cont(ch1, 0.25)), 4) AS lower, round(quantile_cont(ch1, 0.75) + 0.25 * (quantile_cont(ch1, 0.75) - quantile_cont(ch1, 0.25)), 4) AS upper FROM vox GROUP BY ROI""")
def iqr_bounds(spark, sf_dir):
    return fields(reshape.iqr(views.vox(spark, sf_dir), "ch1", keys=("ROI",)), "ROI")


@query("sample_rows", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, CAST(z AS INT) AS z, CAST(parent AS BIGINT) AS parent, CAST(round(ch1 * 100) AS BIGINT) AS cents FROM vox
    ORDER BY md5(concat_ws('|', ROI, label, z, parent, CAST(round(ch1 * 100) AS BIGINT), '42')), ROI, label, z, parent, CAST(round(ch1 * 100) AS BIGINT) LIMIT 10000""")
def sample_rows(spark, sf_dir):
    """The sampling operator: its limit is what it is for."""
    v = views.vox(spark, sf_dir).select("ROI", "label", "z", "parent", F.round(F.col("ch1") * 100).cast("long").alias("cents"))
    return reshape.sampled(v, 10_000, ["ROI", "label", "z", "parent", "cents"])


@query("folded_features", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, max(ch0) FILTER (z <= 2) AS a, min(ch0) FILTER (z >= 4) AS b, count(*) FILTER (ch2 > 0.05) AS c FROM vox WHERE z <= 2 OR z >= 4 OR ch2 > 0.05 GROUP BY ROI, vox.label""")
def folded_features(spark, sf_dir):
    v = views.vox(spark, sf_dir)
    by = lambda where, agg: v.where(where).groupBy("ROI", "label").agg(agg)
    out = hierarchy.folded([by("z <= 2", F.max("ch0").alias("a")), by("z >= 4", F.min("ch0").alias("b")), by("ch2 > 0.05", F.count("*").alias("c"))], ["ROI", "label"])
    return fields(out.fillna(0, ["c"]), "ROI", "label")


@query("labelled_queries", "vox", """-- , f AS (SELECT ROI, label, count(*) AS n FROM vox WHERE ch2 > 0.05 GROUP BY ALL) SELECT CAST(v.ROI AS BIGINT) AS "ROI", CAST(v.label AS BIGINT) AS label, v.z, n FROM (SELECT DISTINCT ROI, label, CAST(z AS BIGINT) AS z FROM vox) v LEFT JOIN f ON f.ROI = v.ROI AND f.label = v.label""")
def labelled_queries(spark, sf_dir):
    v = views.vox(spark, sf_dir)
    f = v.where("ch2 > 0.05").groupBy("ROI", "label").agg(F.count("*").alias("n"))
    return reshape.labelled(f, v.select("ROI", "label", F.col("z").cast("long").alias("z")).distinct()).select(F.col("ROI").cast("long").alias("ROI"), F.col("label").cast("long").alias("label"), "z", "n")


@query("strict_union", None, """SELECT s_nationkey AS nation, s_acctbal AS balance FROM supplier UNION ALL SELECT c_nationkey, c_acctbal FROM customer""")
def strict_union(spark, sf_dir):
    s, c = (views.table(spark, sf_dir, t).select(F.col(f"{t[0]}_acctbal").alias("balance"), F.col(f"{t[0]}_nationkey").alias("nation")) for t in ("supplier", "customer"))
    return reshape.union_strict(s.select("nation", "balance"), c)


@query("coloc_corrected", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, round(CASE WHEN count(*) >= 2 AND min(ch0 * (1 + z * 0.1)) <> max(ch0 * (1 + z * 0.1)) AND min(ch1) <> max(ch1) THEN corr(ch0 * (1 + z * 0.1), ch1) END, 4) + 0.0 AS "ch0|ch1_PearsonR" FROM vox GROUP BY ROI, vox.label""")
def coloc_corrected(spark, sf_dir):
    """Correlation after the channels were corrected for depth."""
    v = coloc.corrected(views.vox(spark, sf_dir), {"ch0": 1 + F.col("z") * 0.1})
    return fields(coloc.features(v, [("ch0", "ch1")], ("PearsonR",)), "ROI", "label")


@query("power_laws", None, """SELECT p_partkey, round(2.0 * pow(p_size, 0.5) * pow(p_retailprice, -0.25), 4) AS law, round(2.0 * pow(p_size, 0.5) * pow(p_retailprice, -0.25) + 3.0, 4) AS with_offset FROM part""")
def power_laws(spark, sf_dir):
    x = [F.col("p_size").cast("double"), F.col("p_retailprice")]
    p = [F.lit(v) for v in (2.0, 0.5, -0.25, 3.0)]
    return views.table(spark, sf_dir, "part").select("p_partkey", r(E.power_law(p[:3], x)).alias("law"), r(E.power_law_offset(p, x)).alias("with_offset"))


_OBJECTS = "l_partkey % 4 AS ROI, 'cell' AS object, l_partkey AS label, 'W' || l_partkey % 3 AS well, 'p' || l_partkey % 2 AS path_in_well FROM lineitem"


@query("z_inputs", None, f"""WITH o AS (SELECT DISTINCT {_OBJECTS}), i AS (SELECT l_returnflag AS channel, max(l_quantity) AS "Mean", {_OBJECTS} GROUP BY ALL), c AS (SELECT l_linestatus AS channel_pair, CASE WHEN max(l_discount) > 0.09 THEN NULL ELSE max(l_discount) END AS "PearsonR", {_OBJECTS} WHERE l_linenumber > 3 GROUP BY ALL), d AS (SELECT 'host' AS object_to, max(l_tax) AS "MaximumDistanceToBorder", {_OBJECTS} WHERE l_linenumber = 2 GROUP BY ALL)
    SELECT CAST(o.ROI AS BIGINT) AS "ROI", o.object, o.label, o.well, o.path_in_well, channel, "Mean", channel_pair, coalesce("PearsonR", 1.0) AS "PearsonR", object_to, "MaximumDistanceToBorder" FROM o LEFT JOIN i USING (ROI, object, label, well, path_in_well) LEFT JOIN c USING (ROI, object, label, well, path_in_well) LEFT JOIN d USING (ROI, object, label, well, path_in_well)""")
def z_inputs(spark, sf_dir):
    k = F.col("l_partkey")
    t = views.table(spark, sf_dir, "lineitem").withColumns({"ROI": k % 4, "object": F.lit("cell"), "label": k, "well": F.concat(F.lit("W"), (k % 3).cast("string")), "path_in_well": F.concat(F.lit("p"), (k % 2).cast("string"))})
    key = flows.OBJECT_KEY
    i = t.groupBy(*key, F.col("l_returnflag").alias("channel")).agg(F.max("l_quantity").alias("Mean"))
    c = t.where("l_linenumber > 3").groupBy(*key, F.col("l_linestatus").alias("channel_pair")).agg(F.when(F.max("l_discount") <= 0.09, F.max("l_discount")).alias("PearsonR"))
    d = t.where("l_linenumber = 2").groupBy(*key, F.lit("host").alias("object_to")).agg(F.max("l_tax").alias("MaximumDistanceToBorder"))
    return flows.z_inputs(t.select(*key).distinct(), i, c, d)


@query("identified_objects", None, """SELECT c_custkey || '_' || c_nationkey AS "index", CAST(c_custkey AS BIGINT) AS label, CAST(c_nationkey AS SMALLINT) AS "ROI", substr(c_name, 1, 1) AS "row", CASE WHEN c_custkey % 5 > 0 THEN '0' || c_custkey % 5 END AS "column", c_custkey % 7 || '_' || c_mktsegment AS path_in_well, 'cell' AS object, CAST(2 AS INT) AS acquisition, substr(c_name, 1, 1) || CASE WHEN c_custkey % 5 > 0 THEN '0' || c_custkey % 5 END AS well, CAST(c_custkey % 7 AS INT) AS acquisition_path FROM customer""")
def identified_objects(spark, sf_dir):
    k, text = F.col("c_custkey"), lambda c: c.cast("string")
    column = F.when(k % 5 > 0, F.concat(F.lit("0"), text(k % 5)))
    t = views.table(spark, sf_dir, "customer").select(k.alias("index"), k.alias("label"), F.col("c_nationkey").alias("ROI"), F.substring("c_name", 1, 1).alias("row"), column.alias("column"), F.concat_ws("_", text(k % 7), F.col("c_mktsegment")).alias("path_in_well"))
    return flows.identified(t, "cell", 2)


# Times and cohorts.
_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_DELTA = "d AS (SELECT *, CAST(floor(epoch_us(acquisitionTime - min(acquisitionTime) OVER (PARTITION BY acquisition)) / 1000000.0) / 60.0 AS FLOAT) AS minutes FROM times)".replace("epoch_us(acquisitionTime - min(acquisitionTime) OVER (PARTITION BY acquisition))", "(epoch_us(acquisitionTime) - min(epoch_us(acquisitionTime)) OVER (PARTITION BY acquisition))")


@query("time_delta", "times", f"""-- , {_DELTA} SELECT acquisition, well, ROI AS "ROI", strftime(acquisitionTime, '%Y-%m-%d %H:%M:%S.%f') AS "acquisitionTime", round(CAST(minutes AS DOUBLE), 2) AS minutes FROM d""")
def time_delta(spark, sf_dir):
    return flows.time_deltas(views.times(spark, sf_dir)).select("acquisition", "well", "ROI", F.date_format("acquisitionTime", _TIME).alias("acquisitionTime"), F.round(F.col("timeDeltaMinutes").cast("double"), 2).alias("minutes"))


def _sites(spark, sf_dir) -> DataFrame:
    return flows.site_means(flows.time_deltas(views.times(spark, sf_dir)).withColumn("channel", F.concat(F.lit("c"), (F.col("well") % 2).cast("string"))))


_SITES = f"-- , {_DELTA}, m AS (SELECT ROI, 'c' || (well % 2) AS channel, acquisition, well, avg(Mean) AS mean, avg(CAST(minutes AS DOUBLE)) AS t FROM d GROUP BY ALL), s AS (SELECT *, (mean - avg(mean) OVER (PARTITION BY channel)) / stddev_samp(mean) OVER (PARTITION BY channel) AS z, (mean - avg(mean) OVER w) / stddev_samp(mean) OVER w AS cz, mean / avg(mean) OVER w AS cn FROM m WINDOW w AS (PARTITION BY channel, acquisition))"


@query("cohort_zscores", "times", f"""{_SITES} SELECT ROI AS "ROI", channel, acquisition, well, round(mean, 4) AS "Mean", round(t, 2) AS "timeDeltaMinutes", round(z, 4) AS "Mean_ZScore", round(cz, 4) AS "Mean_CycleZScore", round(cn, 4) AS "Mean_CycleMeanNorm" FROM s""")
def cohort_zscores(spark, sf_dir):
    return _sites(spark, sf_dir).select("ROI", "channel", "acquisition", "well", r("Mean").alias("Mean"), r("timeDeltaMinutes", 2).alias("timeDeltaMinutes"), *(r(c).alias(c) for c in ("Mean_ZScore", "Mean_CycleZScore", "Mean_CycleMeanNorm")))


@query("cohort_filters", "vox", """-- , f AS (SELECT ROI, label, avg(ch0) AS m, corr(ch0, ch1) AS s, ROI % 2 AS acq, 'W' || ROI AS well FROM vox GROUP BY ROI, vox.label) SELECT CAST(ROI AS BIGINT) AS "ROI", CAST(label AS BIGINT) AS label, round(m, 4) AS "EquivalentSphericalRadius", round(s, 4) AS "alignmentScore" FROM f WHERE s > 0.1 AND m BETWEEN 20 AND 30 AND well NOT IN ('W3') AND acq <> 1 AND label IN (SELECT label FROM vox WHERE ch2 > 0.09)""")
def cohort_filters(spark, sf_dir):
    v = views.vox(spark, sf_dir)
    f = v.groupBy("ROI", "label").agg(F.avg("ch0").alias("EquivalentSphericalRadius"), F.corr("ch0", "ch1").alias("alignmentScore"), (F.first("ROI") % 2).alias("acquisition"), F.concat(F.lit("W"), F.first("ROI").cast("string")).alias("well"))
    kept = flows.cohort(reshape.members(f, v.where("ch2 > 0.09")), 0.1, True, ["W3"], radius=(20, 30), not_acquisition=1)
    return fields(kept.drop("acquisition", "well"), "ROI", "label")


@query("control_wells", "hier", """SELECT well, ROI AS "ROI", object FROM hier WHERE well NOT IN ('Brand#11', 'Brand#12')""")
def control_wells(spark, sf_dir):
    return flows.cohort(views.hier(spark, sf_dir), control_wells=["Brand#11", "Brand#12"])


# Models.
def _closed(name, model, b0, y):
    @query(name, "times", f"""{_SITES} SELECT acquisition, channel, round({b0.format('regr_intercept(%s, t)' % y)}, 4) AS b0, round(regr_slope({y}, t), 8) + 0.0 AS b1 FROM s GROUP BY acquisition, channel""")
    def run(spark, sf_dir):
        p = models.fit_closed(_sites(spark, sf_dir), model, "timeDeltaMinutes", "Mean_CycleMeanNorm", ("acquisition", "channel"))
        return p.select("acquisition", "channel", r("b0").alias("b0"), r("b1", 8).alias("b1"))


_closed("fit_linear", "Linear", "{}", "cn")
_closed("fit_loglinear", "LogLinear", "{}", "ln(greatest(cn, 1e-6))")
_closed("fit_expfitlinear", "ExpFitLinear", "exp({})", "ln(greatest(cn, 1e-6))")


@query("correction_factors", "times", f"""{_SITES}, p AS (SELECT acquisition, channel, regr_intercept(cn, t) AS b0, regr_slope(cn, t) AS b1 FROM s GROUP BY acquisition, channel) SELECT ROI AS "ROI", well, s.acquisition, s.channel, round(b0 / (b0 + b1 * t), 4) AS "correctionFactor-Linear" FROM s JOIN p ON s.acquisition = p.acquisition AND s.channel = p.channel""")
def correction_factors(spark, sf_dir):
    s = _sites(spark, sf_dir)
    p = models.fit_closed(s, "Linear", "timeDeltaMinutes", "Mean_CycleMeanNorm", ("acquisition", "channel"))
    f = models.correction_factor("Linear", [F.col("b0"), F.col("b1")], [F.col("timeDeltaMinutes")])
    return s.join(p, ["acquisition", "channel"]).select("ROI", "well", "acquisition", "channel", r(f).alias("correctionFactor-Linear"))


@query("grid_corrected", "times", f"""{_SITES}, p AS (SELECT channel, regr_intercept(cn, t) AS b0, regr_slope(cn, t) AS b1 FROM s GROUP BY channel), g AS (SELECT CAST(p_size * 100 AS DOUBLE) AS t, CAST(p_partkey % 97 AS DOUBLE) AS v, p_partkey FROM part)
    SELECT p_partkey, channel, round(v * b0 / (b0 + b1 * g.t), 4) AS corrected FROM g CROSS JOIN p""")
def grid_corrected(spark, sf_dir):
    """A grid of times with a value at each place, brought to the level at 0 by each channel's model."""
    spec = models.Spec("Linear", ("timeDeltaMinutes",))
    p = models.fit_groups(_sites(spark, sf_dir), [spec], "Mean_CycleMeanNorm", ("channel",))
    grid = views.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 100).cast("double").alias("timeDeltaMinutes"), (F.col("p_partkey") % 97).cast("double").alias("v"), F.explode(F.array(F.lit("c0"), F.lit("c1"))).alias("channel"))
    return models.corrected(grid, p, spec, "v").select("p_partkey", "channel", r("corrected").alias("corrected"))


@query("fit_exp")
def fit_exp(spark, sf_dir):
    return models.fit_groups(_sites(spark, sf_dir), [models.Spec("Exp", ("timeDeltaMinutes",), "linear", True)], "Mean_CycleMeanNorm", ("acquisition", "channel"))


def _fitted(params: DataFrame, scale: float = 1e3) -> DataFrame:
    """Parameters as columns, slopes by ``1 / scale`` of a unit, so that rounding keeps their digits."""
    return params.select("acquisition", "channel", "model", F.col("converged").alias("settled"), r(F.get("params", 0)).alias("b0"), r(F.get("params", 1) * scale).alias("b1"), r("y_intercept").alias("at_0"))


# Steps of Gauss and Newton from the straight line through the logarithms.
@query("fit_exp_no_offset", "times", f"""{_SITES}, v AS (SELECT acquisition, channel, t / 1000 AS t, cn FROM s),
    f AS (SELECT 0 AS i, acquisition, channel, exp(regr_intercept(ln(greatest(cn, 1e-6)), t)) AS a, regr_slope(ln(greatest(cn, 1e-6)), t) AS b FROM v GROUP BY acquisition, channel
        UNION ALL SELECT i + 1, acquisition, channel, any_value(a) + (sum(e * r) * sum(j * j) - sum(j * r) * sum(e * j)) / (sum(e * e) * sum(j * j) - pow(sum(e * j), 2)), any_value(b) + (sum(j * r) * sum(e * e) - sum(e * r) * sum(e * j)) / (sum(e * e) * sum(j * j) - pow(sum(e * j), 2))
        FROM (SELECT f.*, exp(b * t) AS e, a * t * exp(b * t) AS j, cn - a * exp(b * t) AS r FROM f JOIN v ON v.acquisition = f.acquisition AND v.channel = f.channel WHERE i < 40) GROUP BY i, acquisition, channel)
    SELECT acquisition, channel, 'ExpNoOffset(features=timeDeltaMinutes, loss=linear)' AS model, true AS settled, round(a, 4) AS b0, round(b, 4) + 0.0 AS b1, round(a, 4) AS at_0 FROM f WHERE i = 40""")
def fit_exp_no_offset(spark, sf_dir):
    return _fitted(models.fit_groups(_sites(spark, sf_dir), [models.Spec("ExpNoOffset", ("timeDeltaMinutes",))], "Mean_CycleMeanNorm", ("acquisition", "channel")))


def _huber(y: str, model: str, at_0: str) -> str:
    """Reweighted lines of the values ``y``; the last of many rounds."""
    w = f"1 / greatest(1, abs({y} - b0 - b1 * v.t))"
    return f"""{model} AS (SELECT 0 AS i, acquisition, channel, regr_intercept({y}, t) AS b0, regr_slope({y}, t) AS b1 FROM v GROUP BY acquisition, channel
        UNION ALL SELECT i + 1, acquisition, channel, (sum(w * y) - slope * sum(w * t)) / sum(w), slope FROM (SELECT *, (sum(w) OVER g * sum(w * t * y) OVER g - sum(w * t) OVER g * sum(w * y) OVER g) / (sum(w) OVER g * sum(w * t * t) OVER g - pow(sum(w * t) OVER g, 2)) AS slope
            FROM (SELECT i, m.acquisition, m.channel, v.t, {y} AS y, {w} AS w FROM {model} m JOIN v ON v.acquisition = m.acquisition AND v.channel = m.channel WHERE i < 60) WINDOW g AS (PARTITION BY acquisition, channel)) GROUP BY i, acquisition, channel, slope),
        {model}_out AS (SELECT acquisition, channel, '{model}(features=timeDeltaMinutes, loss=huber)' AS model, true AS settled, round(b0, 4) AS b0, round(b1, 4) + 0.0 AS b1, round({at_0}, 4) AS at_0 FROM {model} WHERE i = 60)"""


@query("fit_huber", "times", f"""{_SITES}, v AS (SELECT acquisition, channel, t / 1000 AS t, cn * 10 AS cn FROM s), {_huber('cn', 'Linear', 'b0')}, {_huber('ln(greatest(cn, 1e-6))', 'LogLinear', 'exp(b0)')}
    SELECT * FROM Linear_out UNION ALL SELECT * FROM LogLinear_out""")
def fit_huber(spark, sf_dir):
    """The values are ten times as large as norms, so that some lie where the loss is straight."""
    s = _sites(spark, sf_dir).withColumn("Mean_CycleMeanNorm", F.col("Mean_CycleMeanNorm") * 10)
    return _fitted(models.fit_groups(s, [models.Spec("Linear", ("timeDeltaMinutes",), "huber"), models.Spec("LogLinear", ("timeDeltaMinutes",), "huber")], "Mean_CycleMeanNorm", ("acquisition", "channel")))


def _decay_inputs(spark, sf_dir):
    t = views.times(spark, sf_dir).withColumn("key", F.xxhash64("acquisitionTime"))
    i = t.select("well", "ROI", F.lit("cell").alias("object"), F.col("key").alias("label"), "acquisition", F.lit("c1").alias("channel"), "Mean")
    sites = t.groupBy("well", "ROI", "acquisition").agg(F.min("acquisitionTime").alias("acquisitionTime"))
    return i, sites


@query("time_decay_flow")
def time_decay_flow(spark, sf_dir):
    return flows.time_decay(*_decay_inputs(spark, sf_dir))[1]


@query("time_decay_linear", "times", """-- , st AS (SELECT well, ROI, acquisition, min(acquisitionTime) AS first FROM times GROUP BY ALL), dl AS (SELECT well, ROI, acquisition, CAST(floor((epoch_us(first) - min(epoch_us(first)) OVER (PARTITION BY acquisition)) / 1000000.0) / 60.0 AS FLOAT) AS minutes FROM st),
    m AS (SELECT ROI, acquisition, well, avg(Mean) AS mean, avg(CAST(minutes AS DOUBLE)) AS t FROM times JOIN dl USING (well, ROI, acquisition) GROUP BY ALL), s AS (SELECT *, mean / avg(mean) OVER (PARTITION BY acquisition) AS cn FROM m),
    p AS (SELECT acquisition, regr_intercept(cn, t) AS a, regr_slope(cn, t) AS b, regr_slope(ln(greatest(cn, 1e-6)), t) AS c FROM s GROUP BY acquisition)
    SELECT ROI AS "ROI", well, acquisition, round(cn, 4) AS "Mean_CycleMeanNorm", round(a / (a + b * t), 4) AS "correctionFactor-Linear", round(exp(-c * t), 4) AS "correctionFactor-LogLinear" FROM s JOIN p USING (acquisition)""")
def time_decay_linear(spark, sf_dir):
    """The whole flow with the models that have a closed form."""
    out = flows.time_decay(*_decay_inputs(spark, sf_dir), [s for s in flows.TIME_SPECS if s.model in ("Linear", "LogLinear")])[1]
    return out.select("ROI", "well", "acquisition", *(r(c).alias(c) for c in ("Mean_CycleMeanNorm", "correctionFactor-Linear", "correctionFactor-LogLinear")))


@query("time_decay_aligned", None, """WITH i AS (SELECT user_id % 8 AS well, user_id % 4 AS ROI, event_id AS label, event_type AS acquisition, value AS mean, ts FROM events),
    st AS (SELECT well, ROI, acquisition, min(ts) AS first FROM i GROUP BY ALL), dl AS (SELECT well, ROI, acquisition, CAST(floor((epoch_us(first) - min(epoch_us(first)) OVER (PARTITION BY acquisition)) / 1000000.0) / 60.0 AS FLOAT) AS minutes FROM st),
    k AS (SELECT * FROM i WHERE label % 5 <> 0 AND label % 100 > 30 AND label % 3 <> 2 AND well NOT IN (6)),
    m AS (SELECT ROI, acquisition, well, avg(mean) AS mean, avg(CAST(minutes AS DOUBLE)) AS t, count(*) AS n FROM k JOIN dl USING (well, ROI, acquisition) GROUP BY ALL), s AS (SELECT *, mean / avg(mean) OVER (PARTITION BY acquisition) AS cn FROM m),
    p AS (SELECT acquisition, regr_intercept(cn, t) AS a, regr_slope(cn, t) AS b FROM s GROUP BY acquisition)
    SELECT ROI AS "ROI", well, acquisition, round(mean, 4) AS "Mean", round(cn, 4) AS "Mean_CycleMeanNorm", round(a / (a + b * t), 4) AS "correctionFactor-Linear" FROM s JOIN p USING (acquisition)""")
def time_decay_aligned(spark, sf_dir):
    """The flow on kept objects with a score of alignment each, without a control well; scores at the cutoff go, objects without a score too."""
    e = views.table(spark, sf_dir, "events")
    key = {"well": F.col("user_id") % 8, "ROI": F.col("user_id") % 4, "object": F.lit("cell"), "label": F.col("event_id"), "acquisition": F.col("event_type")}
    i = e.select(*(c.alias(n) for n, c in key.items()), F.lit("c1").alias("channel"), F.col("value").alias("Mean"), F.col("ts").alias("_ts"))
    times = i.groupBy("well", "ROI", "acquisition").agg(F.min("_ts").alias("acquisitionTime"))
    score = i.where("label % 3 <> 2").select(*key, ((F.col("label") % 100) / 100).alias("alignmentScore"))
    keep = i.where("label % 5 <> 0").select("well", "ROI", "object", "label")
    out = flows.time_decay(i.drop("_ts"), times, [models.Spec("Linear", ("timeDeltaMinutes",))], score, keep, 0.3, control_wells=[6])[1]
    return out.select("ROI", "well", "acquisition", *(r(c).alias(c) for c in ("Mean", "Mean_CycleMeanNorm", "correctionFactor-Linear")))


@query("z_decay_flow")
def z_decay_flow(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("host", F.col("label") % 3 != 0)
    f = flows.measure(g.withColumnRenamed("v", "c1"), ["c1"], SCALE, ("Centroid",), ("Mean",), distance_to=("host", "host"))
    return flows.z_decay(f, "host")


@query("measure_values", "grid", f"""-- , {_FACES}, e AS (SELECT *, v % 100 AS w, CAST(label % 3 <> 0 AS INT) AS host FROM grid), l AS (SELECT *, sum(host) OVER (PARTITION BY y, x ORDER BY z ROWS UNBOUNDED PRECEDING) * 2.0 AS d FROM e),
    k AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY v) + (count(*) OVER (PARTITION BY label, v) - 1) / 2.0 AS a, rank() OVER (PARTITION BY label ORDER BY w) + (count(*) OVER (PARTITION BY label, w) - 1) / 2.0 AS b FROM l WHERE label <> 0),
    o AS (SELECT label, count(*) * 0.5 AS size, avg(v) AS m, median(v) AS mid, sum(w) AS total, corr(v, w) AS p, corr(a, b) AS s, max(host) AS host, max(d) AS far, CAST(floor(avg(z) + 0.5) AS BIGINT) AS z, CAST(floor(avg(y) + 0.5) AS BIGINT) AS y, CAST(floor(avg(x) + 0.5) AS BIGINT) AS x, avg(z) * 2.0 AS cz, avg(y) * 0.5 AS cy, avg(x) * 0.5 AS cx FROM k GROUP BY label),
    n AS (SELECT a.label, sqrt(pow(a.cz - b.cz, 2) + pow(a.cy - b.cy, 2) + pow(a.cx - b.cx, 2)) AS w FROM o a JOIN o b ON a.label <> b.label)
    SELECT CAST(0 AS BIGINT) AS "ROI", o.label, round(size, 4) AS "PhysicalSize", round(m, 4) AS "v_Mean", round(mid, 4) AS "v_Median", round(total, 4) AS "w_Sum", round(p, 4) + 0.0 AS "v|w_PearsonR", round(s, 4) + 0.0 AS "v|w_SpearmanR", CAST(o.host AS BIGINT) AS "parent.host", round(far, 4) AS "host_MaximumDistanceAlongZ", round(l.d, 4) AS "host_CentroidDistanceAlongZ",
        (SELECT count(*) FROM f WHERE f.label = o.label AND f.neighbor <> 0) AS "TOUCH:1_Count", (SELECT count(*) FROM n WHERE n.label = o.label AND n.w <= 10) AS "RAD:10_Count", round((SELECT min(n.w) FROM n WHERE n.label = o.label), 4) AS "KNNd:1_Max"
    FROM o LEFT JOIN l ON l.z = o.z AND l.y = o.y AND l.x = o.x""")
def measure_values(spark, sf_dir):
    """One value of each kind from the whole flow."""
    picked = ("PhysicalSize", "v_Mean", "v_Median", "w_Sum", "v|w_PearsonR", "v|w_SpearmanR", "parent.host", "host_MaximumDistanceAlongZ", "host_CentroidDistanceAlongZ", "TOUCH:1_Count", "RAD:10_Count", "KNNd:1_Max")
    return fields(measure_flow(spark, sf_dir).select("ROI", "label", *(q(c) for c in picked)), "ROI", "label")


@query("measure_flow")
def measure_flow(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("host", F.when(F.col("label") % 3 != 0, 1).otherwise(0)).withColumn("w", F.col("v") % 100)
    from .validate import NeighborhoodInput

    return flows.measure(g, ["v", "w"], SCALE, pairs=[("v", "w")], parent="host", distance_to=("host", "host"), neighborhood=NeighborhoodInput(True, "host"))


@query("apply_time_decay", "vox", """SELECT CAST(ROI AS BIGINT) AS "ROI", label, count(*) AS n, round(sum(trunc(ch0 * (1 + ROI * 0.1))), 4) AS total FROM vox GROUP BY ROI, vox.label""")
def apply_time_decay(spark, sf_dir):
    v = views.vox(spark, sf_dir).withColumn("ch0", F.col("ch0").cast("long"))
    f = v.select("ROI").distinct().select(F.lit("ch0").alias("channel"), "ROI", (1 + F.col("ROI") * 0.1).alias("correctionFactor"))
    return models.apply_t_factor(v, "ch0", f).groupBy("ROI", "label").agg(F.count("*").alias("n"), r(F.sum("ch0").cast("double")).alias("total"))


@query("apply_z_decay", "grid", """-- , p AS (SELECT *, sum(CASE WHEN label % 2 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY y, x ORDER BY z ROWS UNBOUNDED PRECEDING) * 2.0 AS e, sum(CASE WHEN label % 2 = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY y, x ORDER BY z ROWS UNBOUNDED PRECEDING) * 2.0 AS m FROM grid), f AS (SELECT *, 100.0 / (100.0 - 0.5 * m - 1.0 * e) AS k FROM p)
    SELECT CAST(ROI AS BIGINT) AS "ROI", label, round(sum(v * CASE WHEN k < 0 OR k > 50 THEN 50 ELSE k END) / count(*), 2) AS mean FROM f GROUP BY ROI, f.label""")
def apply_z_decay(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("mask", F.col("label") % 2)
    out = models.apply_z_model(g, "v", models.Spec("Linear", ("MediumPath", "EmbryoPath")), (100.0, -0.5, -1.0), "mask", SCALE)
    return out.groupBy("ROI", "label").agg(r(F.sum("v") / F.count("*"), 2).alias("mean")).withColumn("ROI", F.col("ROI").cast("long"))


# Catalogues and sites.
@query("well_ids", None, """SELECT p_partkey, chr(65 + (p_size - 1) // 4) || lpad(CAST((p_partkey % 24) // 4 + 1 AS VARCHAR), 2, '0') || '.' || chr(97 + (p_size - 1) % 4) || ((p_partkey % 24) % 4 + 1) AS well_1536, chr(64 + p_size % 16 + 1) || lpad(CAST(p_partkey % 24 + 1 AS VARCHAR), 2, '0') AS well_384 FROM part""")
def well_ids(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    col = F.col("p_partkey") % 24 + 1
    return p.select("p_partkey", E.well_id(F.col("p_size"), col, 1536).alias("well_1536"), E.well_id(F.col("p_size") % 16 + 1, col, 384).alias("well_384"))


@query("site_metadata", None, """-- ""
    WITH m AS (SELECT user_id % 8 AS w, user_id % 4 AS f, min(ts) AS t, count(*) AS n FROM events GROUP BY ALL) SELECT 'A' || lpad(CAST(w + 1 AS VARCHAR), 2, '0') AS well_id, f AS "FieldIndex", CAST(f * 10 AS DOUBLE) AS x_micrometer, CAST(-f AS DOUBLE) AS y_micrometer, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS "Time", n AS images FROM m""")
def site_metadata(spark, sf_dir):
    e = views.table(spark, sf_dir, "events")
    records = e.select(F.lit(1).alias("Row"), (F.col("user_id") % 8 + 1).alias("Column"), (F.col("user_id") % 4).alias("FieldIndex"), (F.col("user_id") % 4 * 10).cast("double").alias("X"), (F.col("user_id") % 4).cast("double").alias("Y"), F.col("ts").cast("timestamp").cast("string").alias("Time"), F.lit("IMG").alias("Type"), F.lit("image.tif").alias("MeasurementRecord"))
    img, _ = metadata.images(records, 96)
    keys = ["well_id", "FieldIndex"]
    metadata.check_consistent(img, keys, ["X", "Y"], "stage positions")
    sites = img.groupBy(*keys).agg(F.avg("X").alias("x_micrometer"), F.avg("Y").alias("y_micrometer"), F.count("*").alias("images"))
    return sites.join(metadata.earliest(img), keys).withColumn("Time", F.date_format("Time", _TIME))


@query("z_step_sizes", "vox", """SELECT 'W' || ROI AS well_id, CAST(0 AS INT) AS "FieldIndex", 2.0::DOUBLE AS pixel_size_z, CAST(max(z) - min(z) + 1 AS INT) AS z_pixel FROM vox GROUP BY ROI""")
def z_step_sizes(spark, sf_dir):
    v = views.vox(spark, sf_dir).select("ROI", "z").distinct()
    records = v.select(F.concat(F.lit("W"), F.col("ROI").cast("string")).alias("well_id"), F.lit(0).alias("FieldIndex"), F.lit(1).alias("ActionIndex"), F.lit(1).alias("Ch"), (F.col("z") * 2.0).alias("Z"), F.col("z").alias("order"))
    return metadata.z_steps(records)


@query("consistency_check", "vox", """SELECT round(sum(s), 4) AS spread FROM (SELECT max(ch0) - min(ch0) AS s FROM vox GROUP BY ROI, vox.label)""")
def consistency_check(spark, sf_dir):
    s = views.vox(spark, sf_dir).groupBy("ROI", "label").agg((F.max("ch0") - F.min("ch0")).alias("s"))
    return s.agg(r(F.sum("s")).alias("spread"))


@query("registration_pairs", None, """SELECT a.well, a.acquisition, a.path, b.path AS reference_path FROM (SELECT n_regionkey AS well, n_nationkey // 5 AS acquisition, 'plate/' || chr(n_regionkey + 65) || '/' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || '/' || n_nationkey AS path FROM nation) a JOIN (SELECT n_regionkey AS well, n_nationkey // 5 AS acquisition, 'plate/' || chr(n_regionkey + 65) || '/' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || '/' || n_nationkey AS path FROM nation) b ON a.well = b.well AND b.acquisition = 2 WHERE a.acquisition <> 2""")
def registration_pairs(spark, sf_dir):
    return flows.image_pairs(views.catalog(spark, sf_dir), 2)


@query("wells_of_paths", None, """SELECT n_nationkey, chr(n_regionkey + 65) || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS well FROM nation""")
def wells_of_paths(spark, sf_dir):
    c = views.catalog(spark, sf_dir)
    return c.select(F.element_at(F.split("path", "/"), -1).cast("int").alias("n_nationkey"), E.well_of_path(F.col("path")).alias("well"))


@query("registration_quality", "grid", """-- , m AS (SELECT z, y, x, v * 2 + (x % 7) * 1000 AS w FROM grid WHERE x > 2), k AS (SELECT row_number() OVER () AS i, label, v, w, rank() OVER (PARTITION BY label ORDER BY v) + (count(*) OVER (PARTITION BY label, v) - 1) / 2.0 AS a, rank() OVER (PARTITION BY label ORDER BY w) + (count(*) OVER (PARTITION BY label, w) - 1) / 2.0 AS b FROM grid JOIN m USING (z, y, x) WHERE label <> 0),
    t AS (SELECT a.label, sum(sign(a.v - b.v) * sign(a.w - b.w)) AS s, sum(abs(sign(a.v - b.v))) AS x, sum(abs(sign(a.w - b.w))) AS y FROM k a JOIN k b ON a.label = b.label AND a.i < b.i GROUP BY a.label)
    SELECT CAST(0 AS BIGINT) AS "ROI", k.label, round(corr(v, w), 4) AS "a|b_PearsonR", round(corr(a, b), 4) AS "a|b_SpearmanR", round(max(s / sqrt(CAST(x AS DOUBLE) * y)), 4) AS "a|b_KendallTau" FROM k JOIN t ON t.label = k.label GROUP BY k.label""")
def registration_quality(spark, sf_dir):
    g = views.grid(spark, sf_dir)
    moving = g.where("x > 2").select("ROI", "z", "y", "x", (F.col("v") * 2 + (F.col("x") % 7) * 1000).alias("b"))
    return fields(flows.registration_quality(g.withColumnRenamed("v", "a"), moving, [("a", "b")]), "ROI", "label")


@query("sanitized_names", None, """SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9_.-]+', '_', 'g') AS name, regexp_matches(p_name, '^.*a.*$') AS has_a FROM part""")
def sanitized_names(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", E.sanitize(F.col("p_name")).alias("name"), E.glob(F.col("p_name"), "*a*").alias("has_a"))


def _fix() -> None:
    """SQL that goes on with further named parts is written after a leading ``-- ,``."""
    for k, v in SQL.items():
        v = v.replace('-- ""\n', "")
        SQL[k] = v.replace(") , -- , ", "), ").replace("), -- , ", "), ")


_fix()
