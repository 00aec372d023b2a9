"""Shared plumbing of the classifiers: bounded labelled samples, feature collection, map over Arrow batches.

A model is fitted on the driver from at most ``rows_per_class`` labelled rows of
each class, picked by a hash of the document id (the bound is a parameter and the
pick doesn't depend on partitioning). Features are made on the executors by the
same code that scores, and only the sample's features reach the driver: those that fit into
``bytes``, a parameter too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; an id of null counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(labels: DataFrame, label: str, rows_per_class: int, id_col: str = "doc_id", where=None) -> DataFrame:
    """(id, y) of at most ``rows_per_class`` ids of either class, smallest hashes first.

    Ids or labels of null are ignored, as are ids with contradicting labels; repeated rows count once.
    """
    one = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    if where is not None:
        one = one.where(where(F.col("id")))
    one = one.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").drop("most")
    picked = [one.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows_per_class) for y in (0, 1)]
    return picked[0].unionByName(picked[1])


def class_counts(labels: DataFrame, label: str, id_col: str = "doc_id", where=None) -> tuple[int, int]:
    """Numbers of labelled ids with 0 and 1, over all rows."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    if where is not None:
        rows = rows.where(where(F.col("id")))
    got = rows.agg(F.count_if(F.col("y") == 0).alias("a"), F.count_if(F.col("y") == 1).alias("b")).first()
    return int(got["a"]), int(got["b"])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], schema: T.StructType) -> DataFrame:
    """Rows of ``df`` through ``fn``, a batch at a time; ``fn`` returns the columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([x.cast(f.type) if x.type != f.type else x for x, f in zip(fn(b), out, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def shipped(spark: SparkSession, model):
    """Broadcast a fitted model; its size is fixed by its parameters, not by the data."""
    return spark.sparkContext.broadcast(model)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope (0.2 to 5) and offset of the log odds by damped Newton steps on smoothed labels."""
    y = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x, theta = np.stack([np.clip(margin, -12, 12), np.ones_like(margin)]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(theta @ x)
        gradient = x @ (weight * (p - y)) + 1e-3 * (theta - [1, 0])
        hessian = (x * (weight * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    return float(np.clip(theta[0], 0.2, 5)), float(theta[1])


def distinct(features: DataFrame, key: str) -> DataFrame:
    """One row for each key: of rows that share it, the one with the smallest h (a hash of the text), whatever their partitions."""
    rest = [c for c in features.columns if c not in (key, "h")]
    return features.groupBy(key).agg(F.min(F.struct("h", *rest)).alias("r")).select(key, *(f"r.{c}" for c in ("h", *rest)))


def within(rows: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Of a checkpointed sample, the rows that fit into ``limit`` bytes: smallest hashes of the key first, a row that doesn't fit any more is left out.

    Only keys and sizes reach the driver, as many as the sample's bound in rows.
    """
    if (rows.agg(F.sum(size)).first()[0] or 0) <= limit:
        return rows
    order = rows.select(key, size.cast("long").alias("_size"), F.xxhash64(key).alias("_hash")).toArrow().sort_by([("_hash", "ascending"), ("_size", "ascending")])
    left, kept = limit, []
    for k, n in zip(order.column(key).to_pylist(), order.column("_size").to_pylist(), strict=True):
        if n <= left:
            left -= n
            kept.append((k,))
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(kept, rows.select(key).schema)), key, "left_semi")
