"""Small helpers on DataFrames that several operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: inside lambdas Catalyst would repeat it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one only where none is named."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        named = sc.getCheckpointDir() or f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: computed once, lost executors don't matter."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def keyed(rows: DataFrame, facts: DataFrame, key: str | list[str], total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner or left) with the one row of ``facts`` for their key, whose column _n (dropped) says how many of ``total`` rows have it.

    A key of more than a 2,000th of the rows gets its facts by a broadcast of at most 2,000 rows, wherever its
    rows are; only the other keys are shuffled. So no task gathers the rows of a hot key.
    """
    key = [key] if isinstance(key, str) else key
    most = max(200, total // 2000)
    hot, cool = facts.where(F.col("_n") > most).drop("_n"), facts.where(F.col("_n") <= most).drop("_n")
    near = rows.join(F.broadcast(hot), key)
    return near.unionByName(rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cool, key, how))


def aside(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...], Callable[[DataFrame], DataFrame]]:
    """``docs`` under names that no operator uses, these names, and the way back to the columns of ``docs``."""
    names = tuple(f"_c{i}" for i in range(len(docs.columns)))
    back = lambda df: df.select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
    return docs.toDF(*names), names, back
