"""Whole flows: measuring features, time and depth decay, registration quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions import names, selectors
from ..functions.names import q
from ..operators import aggregate, coloc, distance, hierarchy, intensity, models, reshape, shape
from ..sources import tables
from . import validate


# Registration.
def image_pairs(catalog: DataFrame, reference: int) -> DataFrame:
    """``well, acquisition, path, reference_path``: each image beside its well's image of the reference acquisition.

    A well with two images of one acquisition, or without the reference, is an error.
    """
    if not catalog.groupBy("well", "acquisition").count().where("count > 1").isEmpty():
        raise ValueError("a well has several images of one acquisition")
    has = catalog.groupBy("well").agg(F.max(F.col("acquisition") == reference).alias("has"))
    if (row := has.where(~F.col("has")).first()) is not None:
        raise ValueError(f"well {row['well']} has no image of acquisition {reference}")
    ref = catalog.where(F.col("acquisition") == reference).select("well", F.col("path").alias("reference_path"))
    return catalog.where(F.col("acquisition") != reference).join(ref, "well").select("well", "acquisition", "path", "reference_path")


def registration_quality(reference: DataFrame, moving: DataFrame, channels: Sequence[tuple[str, str]], metrics=names.DEFAULT_COLOC_FEATURES) -> DataFrame:
    """Colocalization of each reference channel with the moving one of its wavelength, within the reference's objects.

    The images meet voxel by voxel; what lies in one of them only is left out.
    """
    at = ["ROI", "z", "y", "x"]
    a = reference.select(*at, "label", *(F.col(q(c)).alias(f"ref_{c}") for c, _ in channels))
    b = moving.select(*at, *(F.col(q(c)).alias(f"mov_{c}") for _, c in channels))
    out = coloc.features(a.join(b, at), [(f"ref_{x}", f"mov_{y}") for x, y in channels], metrics)
    new = {names.coloc(f"ref_{x}", f"mov_{y}", m): names.coloc(x, y, m) for x, y in channels for m in names.requested(metrics, coloc.METRICS)}
    return out.withColumnsRenamed(new)


# Measuring.
def measure(
    voxels: DataFrame,
    channels: Sequence[str],
    scale=(1.0, 1.0, 1.0),
    label_props=names.DEFAULT_LABEL_FEATURES,
    intensity_props=names.INTENSITY_FEATURES,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    pairs: Sequence[tuple[str, str]] = (),
    metrics=names.DEFAULT_COLOC_FEATURES,
    parent: str | None = None,
    distance_to: tuple[str, str] | None = None,
    neighborhood: validate.NeighborhoodInput = validate.NeighborhoodInput(),
    is_reference: bool = True,
    time_factors: DataFrame | None = None,
    z_models: dict[str, tuple[models.Spec, Sequence[float] | None]] | None = None,
    mask: str | None = None,
) -> DataFrame:
    """The feature table of all objects: one aggregation for what sums can give, joined with the rest.

    Other families than intensity are measured on the reference image only. Channels are corrected
    for depth and time first, where models or factors are given.
    """
    used = selectors.channels(channels, include, exclude)
    validate.check_labels(voxels.agg(F.max("label")).first()[0])
    v = voxels
    for c in used:
        if z_models and c in z_models:
            v = models.apply_z_model(v, c, *z_models[c], mask, scale)
        if time_factors is not None:
            v = models.apply_t_factor(v, c, time_factors)
    want = names.requested(intensity_props, names.INTENSITY_FEATURES)
    values = [names.intensity(c, f) for c in used for f in want]
    sums = intensity.sums(used, want, scale)
    if not is_reference:
        return intensity.features(v, used, intensity_props, scale)
    by_sum = [(a, b) for a, b in pairs if "PearsonR" in names.requested(metrics, coloc.METRICS)]
    sums |= {names.coloc(a, b, "PearsonR"): coloc.pearson_of(a, b) for a, b in by_sum}
    # Everything that sums give comes from one pass; the rest is joined to it.
    one = shape.features(v, scale, label_props, more=sums)
    if "Median" in want:
        one = one.join(intensity.medians(v, used), ["ROI", "label"], "left")
    one = intensity.finished(one, used, want, scale)
    shapes = [c for c in one.columns if c not in sums and c not in values]
    parts = [one.select(*(q(c) for c in [*shapes, *values, *(names.coloc(a, b, "PearsonR") for a, b in by_sum)]))]
    if parent:
        parts.append(hierarchy.parents(v, parent))
    if distance_to:
        parts.append(distance.features(v, distance_to[0], distance_to[1], scale=scale))
    ranks = [m for m in names.requested(metrics, coloc.METRICS) if m != "PearsonR"]
    if pairs and ranks:
        parts.append(coloc.features(v, pairs, ranks))
    if neighborhood.measure:
        m = v.where(F.col(q(neighborhood.label_img_mask)) != 0) if neighborhood.label_img_mask else None
        parts.append(aggregate.preset(aggregate.Neighborhoods.from_voxels(v, scale, m)))
    return hierarchy.aligned(parts)


def measure_to(df: DataFrame, path: str, overwrite: bool = False) -> None:
    tables.write_table(df, path, overwrite, ())


# Time decay.
def time_deltas(times: DataFrame) -> DataFrame:
    """``timeDelta`` since each acquisition's first time, and in minutes of whole seconds."""
    first = F.min("acquisitionTime").over(W.partitionBy("acquisition"))
    seconds = E.duration_seconds(F.col("acquisitionTime"), first)
    return times.withColumn("timeDelta", F.col("acquisitionTime") - first).withColumn("timeDeltaMinutes", (seconds / F.lit(60.0)).cast("float"))


def z_score(c: Column, over: W) -> Column:
    """Null where all values are equal."""
    return E.safe_divide(c - F.avg(c).over(over), F.stddev_samp(c).over(over))


def site_means(df: DataFrame) -> DataFrame:
    """Mean and time of each site and channel, with scores within the channel and within its acquisition."""
    m = df.groupBy("ROI", "channel", "acquisition", "well").agg(F.avg("Mean").alias("Mean"), F.avg("timeDeltaMinutes").alias("timeDeltaMinutes"))
    channel, cycle = W.partitionBy("channel"), W.partitionBy("channel", "acquisition")
    c = F.col("Mean")
    return m.withColumns({"Mean_ZScore": z_score(c, channel), "Mean_CycleZScore": z_score(c, cycle), "Mean_CycleMeanNorm": E.safe_divide(c, F.avg(c).over(cycle))})


def cohort(df: DataFrame, alignment: float | None = None, strict: bool = True, control_wells: Sequence[str] = (), roundness: tuple[float, float] | None = None, radius: tuple[float, float] | None = None, not_acquisition: int | None = None) -> DataFrame:
    """The filters of the decay flows, each on its own. ``strict`` leaves out scores equal to the cutoff."""
    if alignment is not None:
        df = df.where(F.col("alignmentScore") > alignment if strict else F.col("alignmentScore") >= alignment)
    if control_wells:
        df = df.where(~F.col("well").isin(*control_wells))
    if roundness is not None:
        df = df.where(F.col("Roundness").between(*roundness))
    if radius is not None:
        df = df.where(F.col("EquivalentSphericalRadius").between(*radius))
    if not_acquisition is not None:
        df = df.where(F.col("acquisition") != not_acquisition)
    return df


TIME_SPECS = tuple(models.Spec(m, ("timeDeltaMinutes",)) for m in ("Exp", "ExpNoOffset", "Linear", "LogLinear"))


def time_decay(intensities: DataFrame, times: DataFrame, specs: Sequence[models.Spec] = TIME_SPECS, alignment: DataFrame | None = None, keep: DataFrame | None = None, cutoff: float | None = None, **filters) -> tuple[DataFrame, DataFrame]:
    """The model parameters by acquisition and channel, and ``correctionFactor-<Model>`` of each site.

    ``intensities``: ``well, ROI, object, label, acquisition, channel, Mean``; ``times``: ``well, ROI,
    acquisition, acquisitionTime``; ``alignment``: ``well, ROI, object, label, acquisition,
    alignmentScore``, of which those above ``cutoff`` stay; ``keep``: objects to keep; ``filters``: those of :func:`cohort`.
    """
    key = ["well", "ROI", "object", "label"]
    d = intensities
    if keep is not None:
        d = reshape.members(d, keep, key)
    if alignment is not None:
        d = d.join(alignment, [*key, "acquisition"])
    d = d.join(time_deltas(times).select("well", "ROI", "acquisition", "timeDeltaMinutes"), ["well", "ROI", "acquisition"])
    # A row for each site and channel: made once for the fits and for the factors.
    sites = tables.checkpointed(site_means(cohort(d, cutoff, **filters)))
    params = models.fit_groups(sites, specs, "Mean_CycleMeanNorm", ("acquisition", "channel"))
    return params, models.with_factors(sites, params, {f"correctionFactor-{s.model}": s for s in specs}, ("acquisition", "channel"))


# Depth decay.
def z_specs(loss: str = "huber") -> list[models.Spec]:
    one, two = ("Centroid-z",), ("MediumPath", "EmbryoPath")
    return [models.Spec(m, f, loss, pos) for f in (one, two) for m, pos in (("Linear", False), ("LogLinear", False), ("Exp", True), ("Exp", False))]


OBJECT_KEY = ("ROI", "object", "label", "well", "path_in_well")


def z_inputs(labels: DataFrame, intensities: DataFrame, correlations: DataFrame, distances: DataFrame) -> DataFrame:
    """Stored tables of one kind of feature each, joined for the depth models.

    Every row of ``labels`` stays; rows of the others repeat it for each channel, pair of channels and
    object measured to. An object without a correlation counts as aligned: ``PearsonR`` is 1.
    """
    out = labels
    for other in (intensities, correlations, distances):
        out = out.join(other, list(OBJECT_KEY), "left")
    return out.fillna(1.0, ["PearsonR"])


def identified(features: DataFrame, object_name: str, acquisition: int) -> DataFrame:
    """An acquisition's feature table with its ``object``, ``acquisition`` and ``well``, and an index that no other region has.

    Names are joined from columns and are null where one of them is.
    """
    return features.withColumns({
        "object": F.lit(object_name), "acquisition": F.lit(acquisition).cast("int"), "well": F.concat("row", "column"),
        "index": F.concat(F.col("index").cast("string"), F.lit("_"), F.col("ROI").cast("string")), "ROI": F.col("ROI").cast("smallint"),
    }).withColumn("acquisition_path", F.split("path_in_well", "_")[0].cast("int"))


def z_table(features: DataFrame, label_to: str) -> DataFrame:
    """A wide feature table with centroids unnested and the two paths of light: inside the object's host and above it."""
    d = features
    structs = [c for c, t in d.dtypes if t.startswith("struct")]
    d = reshape.unnest(d, structs) if structs else d
    inside = F.col(q(f"{label_to}_CentroidDistanceAlongZ"))
    return d.withColumn("EmbryoPath", inside).withColumn("MediumPath", F.col(q("Centroid-z")) - inside)


def z_decay(features: DataFrame, label_to: str, specs: Sequence[models.Spec] | None = None, acquisition_of: Column | None = None, sample: int | None = None, **filters) -> DataFrame:
    """Parameters of all depth models by channel, from a wide feature table of objects."""
    d = cohort(z_table(features, label_to), strict=False, **filters)
    wide = [c for c in d.columns if c.endswith("_Mean")]
    index = [*(c for c in ("well", "ROI", "object", "label") if c in d.columns), "Centroid-z", "MediumPath", "EmbryoPath"]
    tall = reshape.stack(d.select(*(q(c) for c in [*index, *wide])), "channel", "_", index)
    return models.fit_groups(tall, specs or z_specs(), "Mean", ("channel",), sample)
