"""What several operators need of the cluster: tables written once in its shared folder, and numbering without a single task."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def once(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that spark.checkpoint.dir names (a temporary one only where none is named): computed once, read by all that follows."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        sc.setCheckpointDir(named or f"file://{tempfile.mkdtemp(prefix='checkpoint-')}")
    return df.checkpoint()


def counted(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` numbered from 1 in the order of their partitions: counts by partition, one row each, become offsets that are joined back."""
    tagged = rows.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    starts = F.broadcast(sizes.select("_part", before.alias("_before")))
    out = tagged.withColumn("_part", part).join(starts, "_part")
    return out.withColumn(name, F.col("_before") + F.col("_id") - F.shiftleft("_part", 33) + 1).drop("_id", "_part", "_before")


def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` numbered from 1 in this order, by range partitions."""
    return counted(once(df.orderBy(*order)), name)
