"""Shared helpers: tables written to the shared folder, and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    own = sc._jsc.sc().getCheckpointDir()
    if own.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        own = sc._jsc.sc().getCheckpointDir()
    return own.get().rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage: a lost executor costs no recomputation before this point, and
    the reader learns the true sizes. :func:`forget` removes the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Remove :func:`stored` tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "stored_path", None) if table is not None else None
        if path:
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_pattern() -> str:
    """A word: a run of characters other than the ASCII white space U+0020 and U+0009 to U+000D."""
    return r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def chance(*columns) -> Column:
    """A number from 0 to 1 that a hash of the columns gives."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded(rows: DataFrame, most_bytes: int) -> list:
    """``rows`` (with ``doc_id`` and ``text``), or so many of them that their texts are about ``most_bytes``, on the driver.

    Texts of every length have the same chance, by a hash of the id.
    """
    rows = stored(rows)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return rows.where(chance("doc_id", F.lit("bytes")) < F.lit(most_bytes / max(1, total))).collect()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges``: ``node``, ``component`` (smallest node reached).

    Labels spread along the edges and then jump to the label of their label, so that
    long chains halve in each round. Each table that a join reads is stored first: both
    sides are then plain exchanges, which adaptive execution can split where one node
    has very many neighbours. Null ends and loops link nothing.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    both = stored(e.union(e.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        hooked = stored(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = stored(hooked.join(up, "label").select("node", "old", F.least("label", "above").alias("label")))
        forget(labels, hooked)
        labels = after
        if labels.where("old <> label").isEmpty():
            forget(both)
            return labels.select("node", F.col("label").alias("component"))
