"""Operators against closed forms and plain loops."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtab.functions import expressions as E
from voxtab.functions import names, selectors
from voxtab.operators import aggregate as A
from voxtab.operators import coloc, distance, fitting, models, reshape, shape
from voxtab.operators import neighbors as N
from voxtab.plans import flows, validate
from voxtab.sources import metadata, tables


@pytest.fixture(scope="module")
def box(spark):
    """A 3 by 4 by 6 object of label 1 with a single voxel of label 2 beside it, in a sea of background."""
    rows = []
    for z, y, x in itertools.product(range(5), range(6), range(9)):
        label = 1 if 1 <= z < 4 and 1 <= y < 5 and 1 <= x < 7 else 2 if (z, y, x) == (2, 2, 7) else 0
        rows.append((7, z, y, x, label, float(x + 10 * y + 100 * z)))
    return spark.createDataFrame(rows, "ROI int, z int, y int, x int, label int, c double")


SCALE = (2.0, 1.0, 0.5)


def test_basic_shape(box):
    r = {x["label"]: x for x in shape.features(box, SCALE, names.LABEL_FEATURES).collect()}
    one = r[1]
    assert one["NumberOfPixels"] == 72 and one["PhysicalSize"] == 72.0
    assert (one["Centroid"]["x"], one["Centroid"]["y"], one["Centroid"]["z"]) == (1.75, 2.5, 4.0)
    assert one["BoundingBox"]["lower-x"] == 1 and one["BoundingBox"]["upper-x"] == 7
    assert one["FeretDiameter"] == pytest.approx(math.sqrt(4**2 + 3**2 + 2.5**2))
    assert one["Roundness"] == pytest.approx(one["EquivalentSphericalPerimeter"] / one["Perimeter"])
    assert r[2]["FeretDiameter"] == 0 and r[2]["Elongation"] == pytest.approx(2.0) and r[2]["Flatness"] == pytest.approx(2.0)


def test_surface_of_a_ball(spark, monkeypatch):
    at = [(z, y, x) for z in range(-9, 10) for y in range(-15, 16) for x in range(-15, 16)]
    rows = [(1, z + 20, y + 20, x + 20, int(4 * z * z + y * y + x * x <= 14.3**2)) for z, y, x in at]
    ball = spark.createDataFrame(rows, "ROI int, z int, y int, x int, label int")
    got = shape.surface(ball, (2.0, 1.0, 1.0)).first()["Perimeter"]
    assert got == pytest.approx(4 * math.pi * 14.3**2, rel=0.03)
    assert sum(shape.intercept_weights((1.0, 1.0, 1.0))) == pytest.approx(3.0, abs=0.02)
    # One plane of voxels has no other neighbours; bricks of any size give the same.
    monkeypatch.setattr(shape, "BRICK", 5)
    assert shape.surface(ball, (2.0, 1.0, 1.0)).first()["Perimeter"] == pytest.approx(got)


def test_moments_equal_numpy(box):
    p = np.array([(x, y, z) for z, y, x in itertools.product(range(1, 4), range(1, 5), range(1, 7))]) * np.array([0.5, 1.0, 2.0])
    want = np.linalg.eigvalsh(np.cov(p.T, bias=True) + np.diag(np.array([0.5, 1.0, 2.0]) ** 2 / 12))
    got = shape.moments(box, SCALE).where("label = 1").first()
    assert [got["PrincipalMoments"][k] for k in "abc"] == pytest.approx(want.tolist())
    sides = shape.oriented_box(box, SCALE).where("label = 1").first()["OrientedBoundingBoxSize"]
    assert sorted(sides) == pytest.approx([3.0, 4.0, 6.0])


def test_feret_equals_all_pairs(spark):
    rng = np.random.default_rng(7)
    rows = sorted({(0, int(z), int(y), int(x), int(k)) for k in range(1, 6) for z, y, x in rng.normal(0, 3 + k, (40 * k, 3)).round()} | {(0, 50, 3, 3, 6), *((0, 60, y, 2 * y, 7) for y in range(9))})
    want = {k: max(math.dist(np.array(a[1:4]) * SCALE, np.array(b[1:4]) * SCALE) for a in rows for b in rows if a[4] == b[4] == k) for k in range(1, 8)}
    got = {r["label"]: r["FeretDiameter"] for r in shape.feret(spark.createDataFrame(rows, "ROI int, z int, y int, x int, label int"), SCALE).collect()}
    assert got == pytest.approx(want)


def test_masked_keeps_rows(spark):
    df = spark.createDataFrame([(3, 0, 0, 0, 5, 9.0, 3), (3, 0, 0, 1, 6, 8.0, 4)], "ROI int, z int, y int, x int, label int, c double, mask_label int")
    assert [(r["label"], r["c"]) for r in shape.masked(df).orderBy("x").collect()] == [(5, 9.0), (0, 0.0)]


def test_tau_equals_pairs(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for k, n in enumerate((1, 2, 3, 10, 57, 200)):
        a, b = rng.integers(0, 5 + n // 4, n).astype(float), rng.integers(0, 7 + n // 3, n).astype(float)
        rows += [(0, k + 1, x, y) for x, y in zip(a.tolist(), b.tolist())]
        s = sum(np.sign(a[i] - a[j]) * np.sign(b[i] - b[j]) for i in range(n) for j in range(i))
        x, y = (sum(v[i] != v[j] for i in range(n) for j in range(i)) for v in (a, b))
        want[k + 1] = pytest.approx(s / math.sqrt(x * y)) if x and y else None
    rows += [(0, 9, 1.0, 2.0), (0, 9, 3.0, 2.0), (0, 9, None, 5.0)]
    df = spark.createDataFrame(rows, "ROI int, label int, a double, b double")
    assert {r["label"]: r["value"] for r in coloc.kendall(df, "a", "b").collect()} == want | {9: None}


def test_ranks_of_large_objects_in_many_tasks(spark, monkeypatch):
    """Ties across ranges, one value throughout, and objects on either side of the limit give the same both ways and as all pairs."""
    monkeypatch.setattr(coloc, "RANKED", 60)
    rng = np.random.default_rng(5)
    rows, want = [(1, 9, float(i), 2.0) for i in range(300)], {(1, 9): None}
    for k, n in enumerate((20, 300, 400)):
        a = rng.integers(0, 3 + n // 4, n).astype(float)
        b = np.where(rng.random(n) < 0.3, a, rng.integers(0, 5 + n // 20, n)).astype(float)
        a[: n // 2 * (k == 2)] = 7.0
        rows += [(0, k + 1, x, y) for x, y in zip(a.tolist(), b.tolist())]
        x, y = (np.sign(v[:, None] - v) for v in (a, b))
        want[0, k + 1] = pytest.approx((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()))
    df = spark.createDataFrame(rows, "ROI int, label int, a double, b double")
    whole = coloc.spearman(df, "a", "b").collect()
    monkeypatch.setattr(coloc, "LARGE", 100)
    assert {(r["ROI"], r["label"]): r["value"] for r in coloc.kendall(df, "a", "b").collect()} == want
    parts = {(r["ROI"], r["label"]): r["value"] for r in coloc.spearman(df, "a", "b").collect()}
    assert parts == {(r["ROI"], r["label"]): None if r["value"] is None else pytest.approx(r["value"]) for r in whole}


def test_ranks_of_pairs_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(coloc, "RANKED", 10)
    df = spark.range(170).selectExpr("0 ROI", "cast(id % 40 as int) + 1 label", "id * 1.0D a", "id * 7 % 5 * 1.0D b")
    plan = coloc.features(df, [("a", "b"), ("b", "a")], ("KendallTau", "MutualInfo"))._jdf.queryExecution().executedPlan().toString()
    assert "34), REPARTITION_BY_NUM" in plan and "8), REPARTITION" not in plan


@pytest.mark.parametrize("lines", [2, 32])
def test_distance_to_border_equals_brute(spark, monkeypatch, lines):
    monkeypatch.setattr(distance, "LINES", lines)
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for roi in range(2):
        kind = {}
        for at in itertools.product(range(5, 9), range(-2, 3), range(6)):
            there = rng.random() < (0.3 if at[0] == 6 else 0.8)
            kind[at] = bool(there and rng.random() < 0.6)
            if there:
                rows.append((roi, *at, kind[at]))
        mine = [r[1:] for r in rows if r[0] == roi]
        box = itertools.product(*(range(min(r[i] for r in mine), max(r[i] for r in mine) + 1) for i in range(3)))
        places = {at: kind[at] for at in box}
        for *at, inside in mine:
            far = min(math.dist(np.array(at) * SCALE, np.array(o) * SCALE) for o, k in places.items() if k != inside)
            want[(roi, *at)] = pytest.approx(far if inside else -far)
    rows += [(7, 0, 0, i, True) for i in range(3)]
    got = {tuple(r)[:4]: r["d"] for r in distance.to_border(spark.createDataFrame(rows, "ROI int, z int, y long, x long, m boolean"), "m", SCALE).collect()}
    assert got == want | {(7, 0, 0, i): None for i in range(3)}


def test_delaunay_is_empty_sphere():
    p = np.random.default_rng(3).random((40, 3))
    cells = N.tetrahedra(p)
    volume = sum(abs(np.linalg.det(p[t[1:]] - p[t[0]])) / 6 for t in cells)
    assert 0.3 < volume < 1
    for t in cells:
        m = 2 * (p[t[1:]] - p[t[0]])
        c = np.linalg.solve(m, (p[t[1:]] ** 2).sum(axis=1) - (p[t[0]] ** 2).sum())
        r = ((p[t[0]] - c) ** 2).sum()
        assert (((p - c) ** 2).sum(axis=1) >= r * (1 - 1e-4)).all()
    assert len(N.tetrahedra(p[:4])) == 0


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 2, i, *map(float, rng.random(3) * 10)) for i in range(60)]
    return spark.createDataFrame(rows, "ROI int, label long, z double, y double, x double")


def test_bucketed_plans_agree(points):
    pairs = lambda df: {(r["ROI"], r["focal"], r["neighbor"]) for r in df.collect()}
    assert pairs(N.radius(points, 3, bucket=True)) == pairs(N.radius(points, 3, bucket=False))
    assert pairs(N.knn(points, 4, bucket=True)) == pairs(N.knn(points, 4, bucket=False))
    assert pairs(N.knn(points, 100, bucket=True)) == pairs(N.knn(points, 100, bucket=False))


def test_neighborhood_names_and_empties(spark, points):
    hood = A.Neighborhoods(points).radius((0.0001, 5)).knn(2, self_loops=True)
    out = hood.aggregate(("Count", "Neighbors"))
    assert {"RAD:0.0001_Count", "RAD:5_Count", "KNN:2s_Count"} <= set(out.columns)
    first = out.first()
    assert first["RAD:0.0001_Count"] == 0 and first["RAD:0.0001_Neighbors"] == [] and first["KNN:2s_Count"] == 3
    assert str(N.Delaunay(2, True, 0.5)) == "DELAUNAY:th=0.5:2s" and str(N.Knn(1, distance=True)) == "KNNd:1"
    with pytest.raises(ValueError):
        A.Neighborhoods(points).touch().aggregate()
    lone = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0)], "ROI int, label long, z double, y double, x double")
    assert A.Neighborhoods(lone).delaunay().knn(3).aggregate().first()["DELAUNAY:1_Count"] == 0


def test_custom_aggregate(points):
    def spread(v):
        return float(v.max() - v.min())

    out = A.features(N.knn(points, 3), points, ["x"], [spread], "KNN:3").orderBy("label").first()
    near = sorted((r["weight"], r["neighbor"]) for r in N.knn(points, 3).where("focal = 0").collect())
    x = {r["label"]: r["x"] for r in points.collect()}
    values = [x[n] for _, n in near]
    assert out["KNN:3_spread__x"] == pytest.approx(max(values) - min(values))


def test_nan_and_mode(spark):
    e = spark.createDataFrame([(0, 1, 2, 1.0), (0, 1, 3, 1.0), (0, 1, 4, 1.0), (0, 1, 5, 1.0)], "ROI int, focal long, neighbor long, weight double")
    f = spark.createDataFrame([(0, i, v) for i, v in ((1, 0.0), (2, 3.0), (3, 5.0), (4, 3.0), (5, 5.0))], "ROI int, label long, v double")
    assert A.features(e, f, ["v"], ["Mode"], "Q").where("label = 1").first()["Q_Mode__v"] == 5.0
    g = f.withColumn("v", F.when(F.col("label") == 3, float("nan")).otherwise(F.col("v")))
    r = A.features(e, g, ["v"], ["Min", "Max", "Mean"], "Q").where("label = 1").first()
    assert all(math.isnan(r[f"Q_{a}__v"]) for a in ("Min", "Max", "Mean"))


@pytest.mark.parametrize("loss", ["linear", "huber"])
def test_fits_recover_parameters(loss):
    x = np.linspace(0, 4, 60)
    two = np.column_stack([x, np.cos(x)])
    for model, p, f in (
        ("Linear", [3.0, -0.4], lambda: 3 - 0.4 * x),
        ("LogLinear", [1.0, -0.4], lambda: np.exp(1 - 0.4 * x)),
        ("ExpFitLinear", [2.0, -0.4], lambda: 2 * np.exp(-0.4 * x)),
        ("ExpNoOffset", [2.0, -0.4], lambda: 2 * np.exp(-0.4 * x)),
        ("Exp", [2.0, -0.9, 0.5], lambda: 2 * np.exp(-0.9 * x) + 0.5),
    ):
        got, ok = models.fit(models.Spec(model, ("x",), loss), x, f())
        assert ok and got == pytest.approx(p, abs=1e-6)
    got, ok = models.fit(models.Spec("Linear", ("x", "w"), loss), two, 1 + two @ np.array([2.0, -1.0]))
    assert ok and got == pytest.approx([1, 2, -1], abs=1e-8)
    got, ok = models.fit(models.Spec("Exp", ("x",), loss, True), x, 2 * np.exp(-0.3 * x) - 0.2)
    assert ok and got[-1] >= 0


def test_huber_resists_an_outlier():
    x = np.arange(30.0)
    y = 2 + 0.5 * x
    y[3] += 1000
    plain, _ = models.fit(models.Spec("Linear", ("x",)), x, y)
    robust, _ = models.fit(models.Spec("Linear", ("x",), "huber"), x, y)
    assert abs(robust[1] - 0.5) < 0.02 < abs(plain[1] - 0.5)


def test_model_names_and_tables(spark, tmp_path):
    s = models.Spec("Exp", ("MediumPath", "EmbryoPath"), "huber", True)
    assert str(s) == "Exp(features=MediumPath;EmbryoPath, loss=huber, pos_offset=True)" and models.parse(str(s)) == s
    d = spark.createDataFrame([("a", float(i), 2.0 + i) for i in range(9)] + [("b", 1.0, 1.0)], "channel string, x double, y double")
    p = models.fit_groups(d, [models.Spec("Linear", ("x",))], "y")
    tables.write_models(p, str(tmp_path / "m"))
    back = {r["channel"]: r for r in tables.read_models(spark, str(tmp_path / "m")).collect()}
    assert back["a"]["params"] == pytest.approx([2, 1]) and back["b"]["params"] is None
    with pytest.raises(Exception, match="already exists"):
        tables.write_models(p, str(tmp_path / "m"))
    f = models.with_factor(d, p, models.Spec("Linear", ("x",)), "f").where("channel = 'b'").first()
    assert math.isnan(f["f"])


def test_time_factor_errors(spark):
    v = spark.createDataFrame([(1, 5), (2, 7)], "ROI int, c int")
    good = spark.createDataFrame([("c", 1, 1.5), ("c", 2, 2.0)], "channel string, ROI int, correctionFactor double")
    assert [r["c"] for r in models.apply_t_factor(v, "c", good).orderBy("ROI").collect()] == [7, 14]
    with pytest.raises(ValueError):
        models.apply_t_factor(v, "c", good.union(good))
    with pytest.raises(Exception, match="no factor"):
        models.apply_t_factor(v, "c", good.withColumn("correctionFactor", F.lit(float("nan")))).collect()


def test_clip_goes_to_the_upper_bound(spark):
    r = spark.range(1).select(models.clipped(F.lit(-3.0)).alias("a"), models.clipped(F.lit(80.0)).alias("b"), models.clipped(F.lit(2.0)).alias("c")).first()
    assert tuple(r) == (50.0, 50.0, 2.0)


def test_selectors():
    columns = ["ROI", "label", "Centroid-x", "DAPI_2_Mean", "DAPI_2|DAPI_3_PearsonR", "embryo_CentroidDistanceAlongZ", "RAD:10_Count", "KNNd:5_Mean", "parent.nuclei", "Roundness", "other"]
    s = selectors
    assert s.index.expand(columns) == ["ROI", "label", "parent.nuclei"]
    assert s.label.expand(columns) == ["Centroid-x", "Roundness"]
    assert s.intensity.expand(columns) == ["DAPI_2_Mean"]
    assert s.correlation.expand(columns) == ["DAPI_2|DAPI_3_PearsonR"]
    assert s.distance.expand(columns) == ["embryo_CentroidDistanceAlongZ"]
    assert s.density.expand(columns) == ["RAD:10_Count", "KNNd:5_Mean"]
    assert s.obj_index.expand(columns) == ["ROI", "label"]
    assert s.meta.expand(columns) == ["ROI", "label", "parent.nuclei", "other"]
    assert (s.features & ~s.density).expand(columns)[-1] == "Roundness"
    assert names.requested(("Perimeter",), names.LABEL_FEATURES) == ("Perimeter", "PerimeterOnBorder", "PerimeterOnBorderRatio")
    assert names.pascal("CHI2_CONTINGENCY") == "Chi2Contingency"


def test_well_ids_and_globs(spark):
    r = spark.createDataFrame([(1, 1), (5, 10), (8, 12)], "r int, c int").select(E.well_id(F.col("r"), F.col("c"), 96).alias("a"), E.well_id(F.col("r"), F.col("c"), 1536).alias("b")).collect()
    assert [tuple(x) for x in r] == [("A01", "A01.a1"), ("E10", "B03.a2"), ("H12", "B03.d4")]
    g = spark.createDataFrame([("x_C01.tif",), ("x_C02.tif",)], "n string").where(E.glob(F.col("n"), "*C0[!2].*"))
    assert [x["n"] for x in g.collect()] == ["x_C01.tif"]


MRF = """<?xml version="1.0" encoding="utf-8"?>
<bts:MeasurementDetail bts:RowCount="8" bts:ColumnCount="12" xmlns:bts="urn:x">
{}
</bts:MeasurementDetail>"""
CHANNEL = '<bts:MeasurementChannel bts:Ch="{}" bts:HorizontalPixelDimension="0.3" bts:VerticalPixelDimension="0.3" bts:HorizontalPixels="20" bts:VerticalPixels="20" bts:InputBitDepth="16" bts:CameraNumber="1" bts:FilterPosition="1" />'
RECORD = '<bts:MeasurementRecord bts:Type="{t}" bts:Row="2" bts:Column="3" bts:FieldIndex="{f}" bts:ActionIndex="1" bts:Ch="{c}" bts:X="1.5" bts:Y="2.5" bts:Z="{z}" bts:Time="2024-04-08T16:0{z}:00.5+02:00">p_F{f}Z{z}C{c}.tif</bts:MeasurementRecord>'


def test_metadata_files(spark, tmp_path):
    (tmp_path / "a.mrf").write_text(MRF.format("\n".join(CHANNEL.format(c) for c in (1, 2, 3))))
    records = "\n".join(RECORD.format(t="IMG", f=f, c=c, z=z) for f in (1, 2) for c in (1, 2) for z in (0, 2, 4)) + RECORD.format(t="ERR", f=1, c=1, z=6)
    (tmp_path / "a.mlf").write_text(MRF.format(records).replace("MeasurementDetail", "MeasurementData"))
    mrf, mlf = str(tmp_path / "a.mrf"), str(tmp_path / "a.mlf")
    sites, wells = metadata.parse(spark, mrf, mlf)
    one = sites.orderBy("FieldIndex").first()
    assert (one["well_id"], one["y_micrometer"], one["pixel_size_z"], one["z_pixel"], one["x_pixel"]) == ("B03", -2.5, 2.0, 3, 20)
    assert one["Time"].isoformat() == "2024-04-08T14:00:00.500000"
    assert wells.first()["images"] == 12
    channels, plate = metadata.read_mrf(spark, mrf)
    img, errors = metadata.images(metadata.read_mlf(spark, mlf), plate, ["*F1*"], ["*C2*"])
    assert plate == 96 and errors == 1 and img.count() == 3
    assert metadata.imaged_channels(channels, img).count() == 1
    with pytest.raises(ValueError):
        metadata.chosen(metadata.read_mlf(spark, mlf), ["nothing*"])
    with pytest.raises(ValueError):
        metadata.check_consistent(img, ["well_id"], ["Z"], "z")


def test_inputs_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        validate.NeighborhoodInput(False, "embryo")
    with pytest.raises(ValueError):
        validate.Channel()
    with pytest.raises(ValueError):
        validate.Channel("A01_C01", "DAPI")
    with pytest.raises(ValueError):
        validate.TimeDecayInput(None, "t")
    with pytest.raises(ValueError):
        validate.check_labels(70_000)
    with pytest.raises(ValueError):
        validate.check_masking(["FOV_1"], True)
    df = spark.range(3)
    flows.measure_to(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="already exists"):
        flows.measure_to(df, str(tmp_path / "t"))
    flows.measure_to(df, str(tmp_path / "t"), overwrite=True)


def test_catalog_checks(spark):
    c = spark.createDataFrame([("B03", 2, "p/B/03/0", ["DAPI"]), ("B03", 3, "p/B/03/1", ["GFP"]), ("B04", 3, "p/B/04/0", ["GFP"])], "well string, acquisition int, path string, channels array<string>")
    assert tables.image_with_channel(c, "B03", "GFP") == "p/B/03/1"
    with pytest.raises(ValueError):
        tables.image_with_channel(c, "B04", "DAPI")
    assert tables.reference_image(c, "B03", 2) == "p/B/03/0"
    with pytest.raises(ValueError):
        tables.reference_image(c.union(c), "B03", 2)
    with pytest.raises(ValueError):
        flows.image_pairs(c, 2)
    with pytest.raises(ValueError):
        flows.image_pairs(c.union(c), 3)
    assert flows.image_pairs(c.where("well = 'B03'"), 2).first()["reference_path"] == "p/B/03/0"


def test_decay_flows(spark):
    rows, times = [], []
    for a, (well, roi) in itertools.product((1, 2), (("B03", 1), ("B03", 2), ("B04", 1), ("B04", 2))):
        minute = (roi - 1) * 30 + (20 if well == "B04" else 0)
        times.append((well, roi, a, f"2024-01-0{a} 10:{minute:02d}:00"))
        rows += [(well, roi, "cell", i, a, "c1", 100 * math.exp(-0.01 * minute)) for i in range(3)]
    i = spark.createDataFrame(rows, "well string, ROI int, object string, label int, acquisition int, channel string, Mean double")
    t = spark.createDataFrame(times, "well string, ROI int, acquisition int, t string").withColumn("acquisitionTime", F.to_timestamp("t")).drop("t")
    params, sites = flows.time_decay(i, t)
    assert params.where("converged").count() == 8
    for r in sites.collect():
        assert r["correctionFactor-LogLinear"] == pytest.approx(math.exp(0.01 * r["timeDeltaMinutes"]), rel=1e-6)


def test_whole_measurement(box):
    out = flows.measure(box.withColumn("host", (F.col("label") > 0).cast("int")), ["c"], SCALE, parent="host", distance_to=("host", "host"), neighborhood=validate.NeighborhoodInput(True))
    assert {r["label"] for r in out.collect()} == {1, 2}
    assert {"c_Mean", "Roundness", "parent.host", "host_MaximumDistanceToBorder", "TOUCH:1_Count", "DELAUNAY:1_Count", "KNNd:200_Max"} <= set(out.columns)
    assert len(flows.measure(box, ["c"], SCALE, is_reference=False).columns) == 2 + len(names.INTENSITY_FEATURES)


def test_iqr_sides(spark):
    d = spark.createDataFrame([(float(i),) for i in range(5)], "v double")
    row = lambda **k: tuple(reshape.iqr(d, "v", **k).select("lower", "upper").first())
    assert row() == (0.5, 3.5)
    assert row(low=None) == (0.0, 4.5)
    assert row(high=None) == (-0.5, 4.0)
    assert reshape.iqr(d, "v", interpolate=False).first()["ql"] == 1.0


def test_query_names_are_neighborhood_features():
    queries = [*N.build(N.Radius, (10, 2.5), (False, True), (False, True)), *N.build(N.Knn, 5, (False, True), (False, True)), *N.build(N.Delaunay, (1, 2), (False, True), (None, 0.5)), *N.build(N.Touch, 1, (False, True), (None, 0.1))]
    for query in queries:
        assert selectors.neighborhood.test(f"{query}_Mean__x") and selectors.neighborhood.test(f"{query}_Count") and not selectors.meta.test(f"{query}_Count")
        assert selectors.density.test(f"{query}_Count") or isinstance(query, N.Knn)


def test_delaunay_threshold_keeps_the_scale(spark):
    """Objects in two arms of an L of physical size: an edge across the gap lies outside the mask."""
    arms = [(z, y, x) for z in range(2) for y in range(12) for x in range(12) if y < 3 or x < 3]
    rows = [(0, z, y, x, 1 + z + 2 * (y // 3) + 10 * (x // 3)) for z, y, x in arms]
    g = spark.createDataFrame(rows, "ROI int, z int, y int, x int, label int")
    hood = A.Neighborhoods.from_voxels(g, (2.0, 0.5, 0.5), g)
    got = hood.edges(N.Delaunay(threshold=0.9))
    want = N.threshold(N.mask_share(N.delaunay(hood.points), hood.points, g, 50, (2.0, 0.5, 0.5)), 0.9)
    pairs = lambda e: {(r["focal"], r["neighbor"]) for r in e.collect()}
    assert pairs(got) == pairs(want) and 0 < len(pairs(got)) < N.delaunay(hood.points).count()


def test_fits_by_sums_equal_arrays(spark):
    rng = np.random.default_rng(9)
    rows = [("a", float(t), 5 * math.exp(-0.1 * t) + rng.normal() * 0.1) for t in rng.random(50) * 10] + [("b", 2.0, 3.0), ("b", 2.0, 4.0), ("c", 1.0, 1.0), ("d", 1.0, float("inf")), ("d", 2.0, 1.0), ("e", None, 1.0)]
    specs = [models.Spec(m, ("t",)) for m in ("Linear", "LogLinear", "ExpFitLinear", "ExpNoOffset")]
    got = {(r["channel"], r["model"]): r for r in models.fit_groups(spark.createDataFrame(rows, "channel string, t double, y double"), specs, "y").collect()}
    assert len(got) == 4 * 4
    for k in "abcd":
        x, y = (np.array([r[i] for r in rows if r[0] == k]) for i in (1, 2))
        for s in specs:
            p, ok = models.fit(s, x, y)
            r = got[k, str(s)]
            assert r["converged"] == ok and (r["params"] == pytest.approx(p.tolist(), rel=1e-6) and r["y_intercept"] == pytest.approx(models.y_intercept(s.model, p), rel=1e-6) if ok else r["params"] is None)


def test_sums_of_rows_equal_sums_of_arrays(spark):
    """At trial points of every phase, for both losses, one and two features."""
    rng = np.random.default_rng(12)
    x = rng.random((40, 2)) * 3
    y = 4 * np.exp(-0.5 * x[:, 0]) + rng.normal(size=40) * 2
    rows = spark.createDataFrame([(u.tolist(), float(v)) for u, v in zip(x, y)], "_x array<double>, _y double")
    states = []
    for model, phases in (("Linear", ("line",)), ("LogLinear", ("line",)), ("ExpNoOffset", ("line", "bare")), ("Exp", ("line", "bare", "offset"))):
        for phase, loss, at in itertools.product(phases, ("linear", "huber"), ([0], [1], [0, 1])):
            p = [2.0, -0.3, 0.1 if len(at) == 2 else 0.0, 0.7 if phase == "offset" else 0.0]
            states += [fitting.begun(model, loss, False, at, 40, True) | {"phase": phase, "trial": t} for t in ([None, p] if phase == "line" else [p])]
    df = spark.createDataFrame([(k, s["model"], s["loss"], s["at"], s["phase"], s["trial"]) for k, s in enumerate(states)], "fit int, model string, loss string, at array<int>, phase string, trial array<double>")
    got = {r["fit"]: r for r in rows.crossJoin(df).groupBy("fit").agg(*fitting._row_sums(4)).collect()}
    for k, s in enumerate(states):
        mine = np.zeros((40, 2))
        mine[:, : len(s["at"])] = x[:, s["at"]]
        h, g, cost = fitting._sums(s, mine, y)
        assert [got[k][f"_h{a}{b}"] for a in range(4) for b in range(a, 4)] == pytest.approx([h[a, b] for a in range(4) for b in range(a, 4)], abs=1e-9), s
        assert [got[k][f"_g{a}"] for a in range(4)] == pytest.approx(g.tolist(), abs=1e-9), s
        assert s["phase"] == "line" or got[k]["_cost"] == pytest.approx(cost)


def test_fits_by_steps_equal_fits_in_tasks(spark, monkeypatch):
    """Large groups, whose rows are summed for each step, beside small ones and ones that are not fitted."""
    rng = np.random.default_rng(12)
    rows = []
    for c, noise in (("a", 0.05), ("b", 0.1)):
        for u, v in rng.random((150, 2)) * 4:
            rows.append((c, float(u), float(v), float(6 * math.exp(-0.4 * u - 0.1 * v) + 0.3 + noise * rng.normal())))
    rows += [("few", 1.0, 2.0, 3.0), *(("odd", float(k), float(k % 3), float("inf") if k == 3 else 1.0) for k in range(120)), ("gap", None, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "channel string, u double, v double, y double")
    specs = [models.Spec("Linear", ("u", "v"), "huber"), models.Spec("LogLinear", ("u",)), models.Spec("ExpNoOffset", ("u", "v"), "huber"), models.Spec("Exp", ("u",), "linear", True)]
    whole = {(r["channel"], r["model"]): r for r in models.fit_groups(d, specs, "y").collect()}
    monkeypatch.setattr(models, "IN_TASK", 100)
    parts = {(r["channel"], r["model"]): r for r in models.fit_groups(d, specs, "y").collect()}
    assert set(parts) == set(whole) and len(whole) == 4 * len(specs)
    for k, a in whole.items():
        b = parts[k]
        assert (a["feature_names"], a["loss"], a["converged"]) == (b["feature_names"], b["loss"], b["converged"]), (a, b)
        assert a["converged"] == (k[0] in "ab" or (k[0] == "few" and a["params"] is not None)), a
        if a["converged"]:
            assert b["params"] == pytest.approx(a["params"], rel=1e-5, abs=1e-7) and b["y_intercept"] == pytest.approx(a["y_intercept"], rel=1e-5, abs=1e-7), (a, b)


def _points(spark, groups):
    return spark.createDataFrame([(roi, i, *map(float, v)) for roi, at in enumerate(groups) for i, v in enumerate(at)], "ROI int, label long, z double, y double, x double")


def test_delaunay_in_tiles_equals_the_whole(spark, monkeypatch):
    """Even, clustered, hollow and regular regions; one in a plane and one too small."""
    rng = np.random.default_rng(21)
    ball = rng.normal(size=(150, 3))
    ball /= np.linalg.norm(ball, axis=1)[:, None]
    lattice = np.array(list(itertools.product(range(5), repeat=3)), float)
    clusters = np.concatenate([rng.normal(size=(70, 3)) + m for m in ([0, 0, 0], [30, 2, 1])])
    plane = np.column_stack([np.zeros(90), rng.random((90, 2))])
    p = _points(spark, [rng.random((250, 3)) * 10, clusters, ball * (1 + 0.01 * rng.random((150, 1))), lattice, plane, rng.random((4, 3))])
    edges = lambda: {(r["ROI"], r["focal"], r["neighbor"]) for r in N.delaunay(p).collect()}
    whole = edges()
    monkeypatch.setattr(N, "TILE", 40)
    parts = edges()
    assert parts == whole and {e[0] for e in whole} == {0, 1, 2, 3}
    assert all((roi, b, a) in parts for roi, a, b in parts)


def test_each_point_has_a_reach_of_its_own(spark):
    """A lonely point, a dense clump, equal points, a region with fewer points than neighbours."""
    rng = np.random.default_rng(22)
    one = np.concatenate([rng.normal(size=(300, 3)) * 0.01, [[1e5, 0, 0]], np.zeros((9, 3)), rng.random((50, 3)) * 100])
    p = _points(spark, [one, rng.random((3, 3)), [[1.0, 1.0, 1.0]], np.ones((6, 3))])
    for k in (1, 5, 40):
        a, b = ({(r["ROI"], r["focal"], r["neighbor"]): r["weight"] for r in N.knn(p, k, bucket=bucket).collect()} for bucket in (True, False))
        assert a == pytest.approx(b)


def test_walks_by_doubling(spark):
    rows = [(0, a, b, 1.0) for a in range(12) for b in range(12) if (b - a) % 12 in (1, 4) or (a, b) == (0, 7)]
    e = spark.createDataFrame(rows, "ROI int, focal long, neighbor long, weight double")
    m = np.zeros((12, 12), int)
    for _, a, b, _ in rows:
        m[a, b] = 1
    for n in range(1, 8):
        want = {(a, b) for a, b in zip(*np.nonzero(np.linalg.matrix_power(m, n))) if a != b}
        assert {(r["focal"], r["neighbor"]) for r in N.steps(e, n).collect()} == want


def test_tables_by_object_are_joined_in_place(spark, tmp_path):
    from voxtab.operators import hierarchy

    d = spark.range(500).select((F.col("id") % 5).alias("ROI"), F.col("id").alias("label"), (F.col("id") * 2).alias("a"))
    parts = [d, d.where("label % 3 = 0").withColumnRenamed("a", "b"), d.where("label > 100").withColumnRenamed("a", "c")]
    for k, p in enumerate(parts):
        tables.save_by_object(p, f"by_object_{k}", str(tmp_path / f"t{k}"), 4)
    with pytest.raises(Exception, match="already exists"):
        tables.save_by_object(d, "by_object_0", str(tmp_path / "t0"), 4)
    tables.save_by_object(d, "by_object_0", str(tmp_path / "t0"), 4, overwrite=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [spark.table(f"by_object_{k}") for k in range(3)]
        joined = hierarchy.folded(stored, ["ROI", "label"], "left")
        for df in (joined, hierarchy.aligned(stored[:2])):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in stored[0].groupBy("ROI", "label").agg(F.max("a"))._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, hierarchy.folded(parts, ["ROI", "label"], "left").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for k in range(3):
            spark.sql(f"DROP TABLE IF EXISTS by_object_{k}")


def test_medians_by_counts(spark):
    rng = np.random.default_rng(31)
    rows = [(0, int(rng.integers(1, 6)), float(rng.integers(0, 9)), None if rng.random() < 0.2 else float(rng.random())) for _ in range(300)] + [(0, 9, None, None), (0, 0, 1.0, 1.0), (1, 1, 5.0, None)]
    d = spark.createDataFrame(rows, "ROI int, label int, a double, b double")
    from voxtab.operators import intensity

    got = {(r["ROI"], r["label"]): r for r in intensity.features(d, ["a", "b"], ("Median",)).collect()}
    want = {(r["ROI"], r["label"]): r for r in d.where("label <> 0").groupBy("ROI", "label").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect()}
    assert set(got) == set(want)
    for k, r in want.items():
        assert (got[k]["a_Median"], got[k]["b_Median"]) == (pytest.approx(r["a"]) if r["a"] is not None else None, pytest.approx(r["b"]) if r["b"] is not None else None)


def test_pairs_of_channels_come_from_one_exchange(spark):
    rng = np.random.default_rng(33)
    rows = [(int(k % 2), int(k % 7), *(None if rng.random() < 0.05 else float(rng.integers(0, 6)) for _ in range(3))) for k in range(400)] + [(0, 99, 1.0, None, None)]
    v = spark.createDataFrame(rows, "ROI int, label int, a double, b double, c double")
    pairs = [("a", "b"), ("a", "c"), ("c", "b")]
    wide = {(r["ROI"], r["label"]): r for r in coloc.features(v, pairs, tuple(coloc.METRICS)).collect()}
    assert len(wide) == v.where("label <> 0").select("ROI", "label").distinct().count()
    for x, y in pairs:
        for metric, of in coloc.METRICS.items():
            alone = {(r["ROI"], r["label"]): r["value"] for r in of(v, x, y).collect()}
            for k, r in wide.items():
                want = alone.get(k)
                assert r[f"{x}|{y}_{metric}"] == (pytest.approx(want, nan_ok=True) if want is not None else None), (x, y, metric, k)


def test_a_prediction_of_zero_is_clipped(spark):
    """The light's path of 4 in the medium takes the prediction to 0, and the factor to its upper end."""
    v = spark.createDataFrame([(0, z, 0, 0, 0, 1.0, 0) for z in range(3)], "ROI int, z int, y int, x int, label int, v double, mask int")
    got = models.apply_z_model(v, "v", models.Spec("Linear", ("MediumPath", "EmbryoPath")), (4.0, -1.0, -1.0), "mask", (2.0, 1.0, 1.0))
    assert [x["v"] for x in got.orderBy("z").collect()] == [2.0, 50.0, 50.0]


def test_equal_components_of_an_axis_point_by_the_first():
    import pandas as pd

    for noise in (-1e-14, 0.0, 1e-14):
        m = {"xx": 6.0 + noise, "xy": 0.03, "xz": -0.06, "yy": 6.0 - noise, "yz": 0.06, "zz": 7.2}
        a = np.reshape(shape.principal.func(*(pd.Series([v]) for v in m.values()))["axes"][0], (3, 3))
        assert [abs(v[0]) == pytest.approx(abs(v[1])) and v[0] > 0 for v in a[:2]] == [True, True], (noise, a)


def test_moments_far_from_the_origin(spark):
    """Exact sums, rounded as a quotient and a quotient: an object has the same moments in every engine."""
    rng = np.random.default_rng(3)
    z = [[float(v) for v in 2 * (7000 + k + rng.integers(0, 3, 260 + k % 40))] for k in range(100)]
    rows = [(k, float(len(v)), *[0.0] * 2, sum(v), *[0.0] * 5, sum(x * x for x in v)) for k, v in enumerate(z)]
    df = spark.createDataFrame(rows, "k int, _w double, _x double, _y double, _z double, _xx double, _xy double, _xz double, _yy double, _yz double, _zz double")
    got = [r["zz"] for r in df.orderBy("k").select(shape.central(SCALE)[5].alias("zz")).collect()]
    assert got == [r[10] / r[1] - r[4] * r[4] / (r[1] * r[1]) + 4.0 / 12 for r in rows]


def test_boxes_of_objects_alike_along_two_axes(spark):
    """Objects that do not change when x and y are swapped have axes with equal components, which point up along x."""
    rng, rows = np.random.default_rng(11), []
    for k in range(1, 61):
        half = rng.integers(0, 2, (3, 8, 8))
        rows += [(0, int(z) + 3 * k, int(y), int(x), k) for z, y, x in np.argwhere(half + half.transpose(0, 2, 1))]
    got = shape.oriented_box(spark.createDataFrame(rows, "ROI int, z int, y int, x int, label int"), SCALE[:1] + (0.5, 0.5)).collect()
    for b in got:
        d = b["OrientedBoundingBoxDirection"]
        axes = [[d[f"{n}-{c}"] for c in "xyz"] for n in "abc"]
        tied = [a for a in axes if abs(abs(a[0]) - abs(a[1])) < 1e-9 and abs(a[0]) > abs(a[2])]
        assert tied and all(a[0] > 0 for a in tied), (b["label"], axes)


def test_walks_in_blocks(spark, monkeypatch):
    """Walks joined in blocks of objects are those of the adjacency matrix, whatever the blocks."""
    monkeypatch.setattr(N, "SIDE", 16)
    rng = np.random.default_rng(2)
    p = spark.createDataFrame([(k % 2, k, *map(float, rng.uniform(0, 10, 3))) for k in range(90)] + [(5, 900, 0.0, 0.0, 0.0)], "ROI int, label long, z double, y double, x double")
    e = N.radius(p, 3.0)
    one = np.zeros((901, 901), bool)
    for r in e.collect():
        one[r["focal"], r["neighbor"]] = True
    for n in (2, 3, 5):
        walks = np.linalg.matrix_power(one.astype(float), n) > 0
        got = [(r["focal"], r["neighbor"]) for r in N.steps(e, n, points=p).collect()]
        assert len(got) == len(set(got)) and set(got) == {(int(a), int(b)) for a, b in np.argwhere(walks) if a != b}


def test_walks_of_few_edges_are_not_sent_to_blocks(spark, monkeypatch):
    """Blocks are for walks that outnumber the edges sent to them; a long chain has two walks for each of its edges, however many sides."""
    monkeypatch.setattr(N, "SIDE", 8)
    called = []
    monkeypatch.setattr(N, "_then", lambda a, b, sides, then=N._then: called.append(sides) or then(a, b, sides))
    chain = [(0, k, k + d, 1.0) for k in range(64) for d in (-1, 1) if 0 <= k + d < 64]
    dense = [(0, a, b, 1.0) for a in range(64) for b in range(64) if a != b]
    p = spark.createDataFrame([(0, k) for k in range(64)], "ROI int, label long")
    for rows, blocks in ((chain, []), (dense, [8])):
        got = [(r["focal"], r["neighbor"]) for r in N.steps(spark.createDataFrame(rows, "ROI int, focal long, neighbor long, weight double"), 2, points=p).collect()]
        m = np.zeros((64, 64), int)
        for _, a, b, _ in rows:
            m[a, b] = 1
        assert len(got) == len(set(got)) and set(got) == {(int(a), int(b)) for a, b in np.argwhere(m @ m) if a != b} and called == blocks


@pytest.fixture
def cloud(spark, monkeypatch):
    """Two regions of points, a lone one, and blocks so small that regions take several."""
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "HELD", 100)
    rng = np.random.default_rng(8)
    rows = [(k % 2, k, *map(float, rng.uniform(0, 10, 3)), None if k % 7 == 0 else float("nan") if k == 5 else float(k)) for k in range(120)] + [(5, 900, 0.0, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(rows, "ROI int, label long, z double, y double, x double, v double")


def _same(a, b, keys):
    a, b = ({tuple(r[k] for k in keys): r.asDict() for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], nan_ok=True), k


def test_walks_of_points(spark, cloud, monkeypatch):
    """Walks made where points meet are those joined by edges, also at odd places and with labels that are not unique."""
    for name, v in {"WALK_BLOCKS": 4, "CELL": 8, "CELLS": 8, "STARTS": 5}.items():
        monkeypatch.setattr(N, name, v)
    nan, inf = float("nan"), float("inf")
    odd = [(0, 901, nan, 1.0, 1.0), (0, 902, 5.0, None, 5.0), (0, 903, inf, 5.0, 5.0), (0, 904, -inf, 5.0, 5.0), (0, None, 5.0, 5.0, 5.0), (None, 905, 5.0, 5.0, 5.0), (None, 906, 5.0, 5.0, 5.0), (1, 907, 5.0, 5.0, 5.0), (1, 908, 5.0, 5.0, 5.0)]
    odd += [(7, 910 + k, 2.0 * k, 0.0, 0.0) for k in range(3)] + [(8, 920, 0.0, 0.0, 0.0), (8, 921, 0.0, 0.0, 1.0)]
    p = cloud.drop("v").union(spark.createDataFrame(odd, "ROI int, label long, z double, y double, x double"))
    more = p.union(spark.createDataFrame([(0, 2, 9.0, 9.0, 9.0), (7, 910, 50.0, 0.0, 0.0), (7, 915, 51.0, 0.0, 0.0)], p.schema))
    for points, radii in ((p, (0.0, 0.5, 2.0, 4.0, 30.0)), (more, (2.0,)), (p.where("false"), (2.0,))):
        for r in radii:
            want = {tuple(e)[:3] for e in N.steps(N.radius(points.where("label is not null"), r, bucket=False), 2).collect()}
            got = [tuple(e) for e in N.radius_walks(points, r).collect()]
            assert len(got) == len(set(got)) and set(got) == {(*e, 1.0) for e in want}, r
    assert {(7, 910, 912), (7, 912, 910)} == {tuple(e)[:3] for e in N.radius_walks(p.where("ROI in (7, 8)"), 2.0).collect()}
    own = {tuple(e)[:3] for e in N.radius_walks(p, 2.0, self_loops=True).collect()} - {tuple(e)[:3] for e in N.radius_walks(p, 2.0).collect()}
    assert own == {(r["ROI"], r["label"], r["label"]) for r in p.where("ROI is not null and label is not null").collect()}


def test_walks_of_repeated_rows(cloud, monkeypatch):
    """Rows that repeat points at their places are no reason to join edges."""
    want = {tuple(e) for e in N.radius_walks(cloud, 2.0).collect()}
    monkeypatch.setattr(N, "steps", None)
    got = [tuple(e) for e in N.radius_walks(cloud.union(cloud.where("label % 3 = 0")), 2.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_walks_shuffle_points_only(spark, tmp_path):
    """No edge and no walk is exchanged, and each point is sent to a few blocks, however many there are."""
    from voxtab.plans import queries

    rng = np.random.default_rng(4)
    for n in (1_000, 4_000):
        at = rng.uniform(0, 1, (n, 3))
        rows = [(k, [float(v) for v in at[k]], 3) for k in range(n)]
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / f"{n}/embeddings.parquet"))
        plan = queries.QUERIES["two_step_walk"](spark, str(tmp_path / str(n)))._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange" in x]
        assert exchanges and not any(c in x for x in exchanges for c in ("focal", "neighbor")), plan
        points = queries.views.pts(spark, str(tmp_path / str(n)))
        dealt = N._dealt(points, 16, blocks=N.WALK_BLOCKS)
        assert dealt.count() <= N.WALK_BLOCKS * n and dealt.where("own").count() == n


def test_kernel_in_blocks(cloud):
    for name in ("uniform", "triangular", "gaussian"):
        for own in (False, True):
            e = N.radius(cloud, 4.0, own).withColumn("weight", E.kernel(name, F.col("weight") / 4.0))
            _same(N.radius_kernel(cloud, 4.0, name, True, own), N.normalized(e), ("ROI", "focal", "neighbor"))
    with pytest.raises(ValueError, match="unknown kernel"):
        N.radius_kernel(cloud, 4.0, "none")


def test_values_within_radius_in_blocks(cloud):
    aggs = ["Mean", "Sum", "Std", "Median", A.quantile(0.25), "Min", "Max", "Var"]
    want = A.features(N.radius(cloud, 4.0), cloud, ["v", "x"], aggs, "R")
    _same(A.radius_features(cloud, cloud, ["v", "x"], 4.0, aggs, "R"), want, ("ROI", "label"))


def test_counts_and_nearest_in_blocks(cloud):
    got = N.near(cloud, (2, 5), (2, 80)).withColumnRenamed("focal", "label")
    hood = A.Neighborhoods(cloud)
    counts = hood.radius((2, 5)).aggregate()
    far = hood.knn((2, 80), distance=True).aggregate_weights(("Mean", "Max")).join(hood.knn(1, distance=True).aggregate_weights(("Max",)), ["ROI", "label"])
    _same(got, counts.join(far, ["ROI", "label"]), ("ROI", "label"))


def test_ranks_take_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(coloc, "RANKED", 100)
    v = spark.range(5000).select(F.lit(0).alias("ROI"), (1 + F.col("id") % 50).alias("label"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    assert coloc._dealt(v, ("ROI", "label")).rdd.getNumPartitions() == 50


#: Second moments (xx, xy, xz, yy, yz, zz) of objects of random orders, and the axis in question.
TIED = (
    ((2.0787524539861884, 0.06270344744055478, -0.02990204242269101, 2.0787524539861884, 0.029902042423600506, 2.9459391260073367), 0),
    ((2.0849657064471976, -0.010428669410160296, 0.006529492457048036, 2.0849657064471905, -0.006529492455229047, 2.996488340276604), 1),
    ((2.0699713490160057, 0.011723407538283936, 0.011474421015009284, 2.0699713490160057, -0.0114744210295612, 3.0597006579240165), 0),
    ((2.075645436182301, -0.008931953036231732, 0.03589614105931105, 2.075645436182318, -0.035896141052944586, 3.044438833681246), 1),
    ((2.072026364516281, 0.027458654210306577, -0.03951521272392711, 2.072026364516224, 0.03951521272392711, 3.014476285626491), 0),
)


def test_of_equal_components_the_one_of_the_closed_solution_points_up():
    """Moments of objects alike along x and y whose axes the SQL lets point up along y, by the last digits of its root."""
    import pandas as pd

    for (xx, xy, xz, yy, yz, zz), axis in TIED:
        a = np.reshape(shape.principal_by_root.func(*(pd.Series([v]) for v in (xx, xy, xz, yy, yz, zz)))["axes"][0], (3, 3))[axis]
        assert abs(abs(a[0]) - abs(a[1])) < 1e-9 and a[1] > 0 > a[0], (axis, a)


def test_tiles_of_a_long_region_are_about_as_long_as_wide(spark):
    p = np.random.default_rng(5).uniform(0, 1, (4000, 3)) * (400, 10, 10)
    t = N._tiles(spark.createDataFrame([(0, i, *map(float, v)) for i, v in enumerate(p)], "ROI int, label long, z double, y double, x double")).toPandas()
    size = t.groupby("tile").agg(**{c: (f"_{c}", lambda v: v.max() - v.min()) for c in "zyx"})
    assert len(size) == 8 and (size.max(axis=1) * 400 < 100).all() and (t.groupby("tile").size() == 500).all()


def test_blocks_of_a_long_region_see_what_is_near(spark, monkeypatch):
    """Counts and nearest distances of a region far longer than wide, of which a block sees a part."""
    import pyarrow as pa

    monkeypatch.setattr(N, "BLOCK", 32)
    p = np.random.default_rng(6).uniform(0, 1, (1500, 3)) * (5, 3000, 5)
    df = spark.createDataFrame([(0, i, *map(float, v)) for i, v in enumerate(p)], "ROI int, label long, z double, y double, x double")
    seen, meet = [], N.meet

    def counted(points, visit, made, *rest, **more):
        seen.append(meet(points, lambda t, i, d: (i, [pa.array([len(t)] * len(i))]), {"seen": N.T.LongType()}, *rest, **more))
        return meet(points, visit, made, *rest, **more)

    monkeypatch.setattr(N, "meet", counted)
    got = N.near(df, (10, 50), (2, 20)).toPandas().sort_values("focal")
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    closest = np.sort(d, axis=1)
    for r in (10, 50):
        assert (got[f"RAD:{r}_Count"].to_numpy() == (d <= r).sum(axis=1)).all()
    for k in (2, 20):
        assert np.allclose(got[f"KNNd:{k}_Max"], closest[:, k - 1]) and np.allclose(got[f"KNNd:{k}_Mean"], closest[:, :k].mean(axis=1))
    assert seen[0].agg({"seen": "max"}).first()[0] < 300
