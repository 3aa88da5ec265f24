"""Feature tables, generic tables and model trees as Parquet."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, **partition) -> DataFrame:
    """A table with the columns of its folders (``well=…/acquisition=…``); ``partition`` values prune them."""
    df = spark.read.parquet(path)
    for k, v in partition.items():
        df = df.where(F.col(k) == v)
    return df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, in the folder of ``spark.checkpoint.dir``; in one of our own only where a local session names none."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def write_table(df: DataFrame, path: str, overwrite: bool = False, partition_by=()) -> None:
    """Without ``overwrite`` a table that exists is an error."""
    df.write.partitionBy(*partition_by).mode("overwrite" if overwrite else "errorifexists").parquet(path)


def save_by_object(df: DataFrame, name: str, path: str | None = None, buckets: int = 64, keys=("ROI", "label"), overwrite: bool = False) -> None:
    """A table of the catalogue whose rows lie in ``buckets`` by object, in order within each.

    Tables with as many buckets by the same keys are joined and summed up by object without an exchange,
    however often: the rows are dealt once, here (a full outer join gives new keys, so only the first of
    several is free). Each bucket is one file. ``path`` puts the table elsewhere than in the warehouse.
    """
    w = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite" if overwrite else "errorifexists")
    (w.option("path", path) if path else w).saveAsTable(name)


def write_models(params: DataFrame, path: str, overwrite: bool = False) -> None:
    """A parameter table by model and channel. Models that did not settle are stored without parameters."""
    write_table(params, path, overwrite, ("model", "channel"))


def read_models(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", "false").parquet(path)
    return df if model is None else df.where(F.col("model") == model)


def level(voxels: DataFrame, factors=(1, 2, 2)) -> DataFrame:
    """The next level of an image pyramid: means of blocks, and each block's first label in raster order."""
    at = [F.floor(F.col(c) / f).cast("long").alias(c) for c, f in zip("zyx", factors)]
    values = [c for c in voxels.columns if c not in ("ROI", "z", "y", "x", "label")]
    return voxels.groupBy("ROI", *at).agg(F.min_by("label", F.struct("z", "y", "x")).alias("label"), *(F.avg(c).alias(c) for c in values))


def crop(voxels: DataFrame, roi, z=None, y=None, x=None) -> DataFrame:
    """One region, with half-open ranges of indices; the ROI prunes partitions."""
    out = voxels.where(F.col("ROI") == roi)
    for c, r in (("z", z), ("y", y), ("x", x)):
        if r is not None:
            out = out.where((F.col(c) >= r[0]) & (F.col(c) < r[1]))
    return out


def image_with_channel(catalog: DataFrame, well: str, channel: str, suffix: str | None = None) -> str:
    """The path of a well's first image with a channel (``well, path, channels``); none is an error."""
    c = catalog.where((F.col("well") == well) & F.array_contains("channels", channel))
    if suffix is not None:
        c = c.where(F.col("path").endswith(suffix))
    row = c.agg(F.min("path").alias("path")).first()
    if row["path"] is None:
        raise ValueError(f"no image of well {well} has channel {channel}")
    return row["path"]


def reference_image(catalog: DataFrame, well: str, acquisition: int, suffix: str | None = None) -> str:
    """The path of a well's image of the reference acquisition; none, or several without a suffix, is an error."""
    c = catalog.where((F.col("well") == well) & (F.col("acquisition") == acquisition))
    if suffix is not None:
        c = c.where(F.col("path").endswith(suffix))
    rows = [r["path"] for r in c.select("path").orderBy("path").limit(2).collect()]
    if not rows:
        raise ValueError(f"well {well} has no image of acquisition {acquisition}")
    if len(rows) > 1:
        raise ValueError(f"well {well} has several images of acquisition {acquisition}; give a suffix")
    return rows[0]
