"""Microscope metadata: detail (``.mrf``) and record (``.mlf``) XML files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expressions as E

CHANNEL = {"Ch": "int", "HorizontalPixelDimension": "double", "VerticalPixelDimension": "double", "HorizontalPixels": "int", "VerticalPixels": "int", "InputBitDepth": "int", "CameraNumber": "int", "FilterPosition": "int"}
RECORD = {"Type": "string", "Row": "int", "Column": "int", "FieldIndex": "int", "ActionIndex": "int", "Ch": "int", "X": "double", "Y": "double", "Z": "double", "Time": "string"}


def _xml(spark: SparkSession, path: str, tag: str, fields: dict[str, str], value: str | None = None) -> DataFrame:
    schema = ", ".join([*(f"`_bts:{c}` string" for c in fields), *(["_VALUE string"] if value else [])])
    df = spark.read.format("xml").option("rowTag", f"bts:{tag}").schema(schema).load(path)
    return df.select(*([F.col("_VALUE").alias(value)] if value else []), *(F.col(f"`_bts:{c}`").cast(t).alias(c) for c, t in fields.items()))


def read_mrf(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Channels of a measurement, and the number of wells of its plate."""
    plate = _xml(spark, path, "MeasurementDetail", {"RowCount": "int", "ColumnCount": "int"}).first()
    return _xml(spark, path, "MeasurementChannel", CHANNEL), plate["RowCount"] * plate["ColumnCount"]


def read_mlf(spark: SparkSession, path: str) -> DataFrame:
    """Records in the order of the file: ``MeasurementRecord`` (file name), its fields, and ``order``."""
    r = _xml(spark, path, "MeasurementRecord", RECORD, "MeasurementRecord")
    return r.withColumn("order", F.monotonically_increasing_id())


def chosen(records: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> DataFrame:
    """Records whose file name matches all ``include`` patterns and no ``exclude`` pattern.

    A pattern to include that matches nothing is an error, and so is a choice that leaves nothing.
    """
    if not include and not exclude:
        return records
    name, keep = F.col("MeasurementRecord"), F.lit(True)
    if include:
        found = records.agg(*(F.count_if(E.glob(name, p)).alias(str(i)) for i, p in enumerate(include))).first()
        for i, p in enumerate(include):
            if not found[i]:
                raise ValueError(f"no image file name matches {p!r}")
            keep = keep & E.glob(name, p)
    for p in exclude or ():
        keep = keep & ~E.glob(name, p)
    out = records.where(keep)
    if out.isEmpty():
        raise ValueError(f"nothing matches {list(include or ())} and not {list(exclude or ())}")
    return out


def images(records: DataFrame, plate_type: int, include=None, exclude=None) -> tuple[DataFrame, int]:
    """Image records with ``well_id`` and y upwards, and the number of error records."""
    r = chosen(records, include, exclude).withColumn("well_id", E.well_id(F.col("Row"), F.col("Column"), plate_type)).withColumn("Y", -F.col("Y"))
    return r.where(F.col("Type") == "IMG"), r.where(F.col("Type") == "ERR").count()


def imaged_channels(channels: DataFrame, records: DataFrame) -> DataFrame:
    return channels.join(records.select("Ch").distinct(), "Ch", "left_semi")


def check_consistent(df: DataFrame, keys: Sequence[str], columns: Sequence[str], message: str) -> None:
    """An error unless each column is constant within each group, up to rounding, all spreads together."""
    spread = df.groupBy(*keys).agg(*((F.max(c) - F.min(c)).alias(c) for c in columns))
    total = spread.agg(*(F.sum(c).alias(c) for c in columns)).first()
    if abs(sum(v or 0 for v in total)) > 1e-8:
        raise ValueError(f"{message}: values differ within a group: {total.asDict()}")


def earliest(records: DataFrame, keys=("well_id", "FieldIndex")) -> DataFrame:
    """The first time of each site, in UTC."""
    return records.groupBy(*keys).agg(F.min(F.to_timestamp("Time")).alias("Time"))


def z_steps(records: DataFrame, keys=("well_id", "FieldIndex")) -> DataFrame:
    """``pixel_size_z, z_pixel`` of each site. Steps must agree within a stack and planes between channels; one plane has spacing 1."""
    stack = [*keys, "ActionIndex", "Ch"]
    r = records.withColumn("step", F.col("Z") - F.lag("Z").over(W.partitionBy(*stack).orderBy("order")))
    s = r.groupBy(*stack).agg(F.avg("step").alias("step"), F.max(F.abs(F.col("step"))).alias("_h"), F.min(F.abs(F.col("step"))).alias("_l"), F.count("*").alias("n"))
    if not s.where(F.col("_h") - F.col("_l") > F.lit(1e-8) + 1e-5 * F.abs("_l")).isEmpty():
        raise NotImplementedError("a stack has steps of different size in z")
    single = s.agg(F.max("n")).first()[0] == 1
    if single:
        s = s.withColumn("step", F.lit(1.0))
    check_consistent(s, keys, ["step"], "z steps between channels")
    check_consistent(s, keys, ["n"], "number of planes between channels")
    return s.groupBy(*keys).agg(F.avg("step").alias("pixel_size_z"), F.avg("n").cast("int").alias("z_pixel"))


def site_metadata(channels: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Position, z steps, time and image size of each site; and the number of images of each well."""
    keys = ["well_id", "FieldIndex"]
    check_consistent(records, keys, ["X", "Y"], "stage positions")
    size = ["HorizontalPixelDimension", "VerticalPixelDimension", "HorizontalPixels", "VerticalPixels", "InputBitDepth"]
    check_consistent(channels, [], size, "image dimensions")
    top = channels.agg(*(F.max(c).alias(c) for c in size)).first()
    sites = records.groupBy(*keys).agg(F.avg("X").alias("x_micrometer"), F.avg("Y").alias("y_micrometer")).withColumn("z_micrometer", F.lit(0))
    sites = sites.join(z_steps(records), keys).join(earliest(records), keys)
    sites = sites.withColumns(dict(zip(("pixel_size_x", "pixel_size_y", "x_pixel", "y_pixel", "bit_depth"), (F.lit(top[c]) for c in size))))
    return sites, records.groupBy("well_id").agg(F.count("*").alias("images"))


def parse(spark: SparkSession, mrf: str, mlf: str, include=None, exclude=None) -> tuple[DataFrame, DataFrame]:
    channels, plate = read_mrf(spark, mrf)
    records, _ = images(read_mlf(spark, mlf), plate, include, exclude)
    return site_metadata(imaged_channels(channels, records), records)
