"""Logical views that read star-schema tables as voxels, points, times and catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Physical size of a grid voxel along z, y and x.
SCALE = (2.0, 0.5, 0.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as voxels of parts: ``ROI, label, parent, z, ch0, ch1, ch2``. Rows are not unique voxels."""
    t = table(spark, sf_dir, "lineitem")
    return t.select((F.col("l_partkey") % 4).alias("ROI"), (F.col("l_partkey") + 1).alias("label"), F.col("l_suppkey").alias("parent"), F.col("l_linenumber").alias("z"), F.col("l_quantity").alias("ch0"), F.col("l_extendedprice").alias("ch1"), F.col("l_discount").alias("ch2"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a dense raster of 50 by 50 planes: ``ROI, z, y, x, label, v``; label 0 is background."""
    k = F.col("o_orderkey")
    t = table(spark, sf_dir, "orders").select(F.lit(0).alias("ROI"), F.floor(k / 2500).cast("long").alias("z"), (F.floor(k / 50) % 50).cast("long").alias("y"), (k % 50).cast("long").alias("x"), "o_orderstatus", k.alias("k"), F.col("o_totalprice").alias("v"))
    of = 1 + F.floor(F.col("x") / 10) + 5 * F.floor(F.col("y") / 10) + 25 * F.floor(F.col("z") / 3)
    hole = (F.col("o_orderstatus") == "P") & (F.col("k") % 3 == 0)
    return t.select("ROI", "z", "y", "x", F.when(hole, F.lit(0)).otherwise(of).cast("long").alias("label"), "v")


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as labelled points: ``ROI, label, z, y, x``."""
    at = lambda i: (F.col("embedding")[i].cast("double") * 100)
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("ROI"), F.col("vec_id").alias("label"), at(2).alias("z"), at(1).alias("y"), at(0).alias("x"))


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as acquisition times: ``acquisition, well, ROI, acquisitionTime, Mean``."""
    t = table(spark, sf_dir, "events")
    return t.select(F.col("event_type").alias("acquisition"), (F.col("user_id") % 8).alias("well"), (F.col("user_id") % 4).alias("ROI"), F.col("ts").alias("acquisitionTime"), F.col("value").alias("Mean"))


def hier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as objects by site: ``well, ROI, object``."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("well"), F.col("p_size").alias("ROI"), F.col("p_type").alias("object"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as images: ``well, acquisition, path``."""
    t = table(spark, sf_dir, "nation")
    return t.select(F.col("n_regionkey").alias("well"), F.floor(F.col("n_nationkey") / 5).cast("int").alias("acquisition"), F.concat(F.lit("plate/"), F.char((F.col("n_regionkey") + 65).cast("int")), F.lit("/"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0"), F.lit("/"), F.col("n_nationkey").cast("string")).alias("path"))
