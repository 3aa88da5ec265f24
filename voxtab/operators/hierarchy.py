"""Objects within objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions import names
from .shape import KEYS, objects


def parents(voxels: DataFrame, parent: str = "parent", name: str | None = None, keys=KEYS) -> DataFrame:
    """The label of ``parent`` that is most frequent under each object, background 0 included; of equals the largest."""
    n = objects(voxels).groupBy(*keys, F.col(names.q(parent)).alias("_p")).agg(F.count("*").alias("_n"))
    return n.groupBy(*keys).agg(F.max_by("_p", F.struct("_n", "_p")).cast("long").alias(f"parent.{name or parent}"))


def counts(objects_: DataFrame, kinds=None, keys=("well", "ROI")) -> DataFrame:
    """``<object>_Count`` of each site, 0 where a site has none of a kind."""
    kinds = kinds or [r[0] for r in objects_.select("object").distinct().orderBy("object").collect()]
    return objects_.groupBy(*keys).agg(*(F.count_if(F.col("object") == k).alias(f"{k}_Count") for k in kinds))


def metadata(objects_: DataFrame, kinds=None, control_wells=(), keys=("well", "ROI")) -> DataFrame:
    """Counts with their binary logarithms, the well's row and column, and whether it is a control."""
    c = counts(objects_, kinds, keys)
    logs = [E.log2_float(F.col(names.q(n))).alias(f"log2_{n}") for n in c.columns if n.endswith("_Count")]
    control = F.col("well").isin(*control_wells) if control_wells else F.lit(False)
    return c.select("*", *logs, F.substring("well", 1, 1).alias("row"), F.substring("well", 2, 100).alias("col"), control.alias("is_control_well"))


def aligned(parts: list[DataFrame]) -> DataFrame:
    """Feature tables side by side: full outer joins on the columns that two neighbours share."""
    return reduce(lambda a, b: a.join(b, [c for c in a.columns if c in b.columns], "full"), parts)


def folded(parts: list[DataFrame], on, how: str = "full") -> DataFrame:
    """All tables joined on ``on``; no table is an error."""
    if not parts:
        raise ValueError("nothing to join")
    return reduce(lambda a, b: a.join(b, on, how), parts)
