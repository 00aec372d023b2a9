"""Connected components of an edge table by alternating large and small stars (DataFrame functions only), of a small one by one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import cut, keyed

#: Edges that a task takes at least.
TASK_EDGES = 20_000
#: Edges of a table that one task takes alone (16 MB): the rounds of stars are hundreds of stages, which the driver has to plan and remember.
ALONE = 1_000_000


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): roots hook on to smaller roots that an edge leads to, which at least halves them, and paths are cut short."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        a, b = a[open_], b[open_]
        np.minimum.at(root, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if held:
        node, root = least_nodes(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, alone: int = ALONE) -> DataFrame:
    """(node, root) of every node of the edges; root is the least node of its component.

    At most ``alone`` edges between nodes of type long are one task. Of more, or of other types,
    each round works on checkpointed tables of at most as many edges as there were. A hub's
    edges meet its least neighbour by a broadcast (see ``keyed``), so nothing is gathered; it
    ends when a round changes no edge. Loops and repeated edges don't matter; null ends must not occur.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen, n = None, e.count()
    if n <= alone and dict(e.dtypes)["u"] == "bigint":
        return cut(e.coalesce(1).mapInArrow(_in_one_task, "node long, root long")).repartition("node")
    few = lambda df: df.coalesce(max(2, -(-n // TASK_EDGES)))  # noqa: E731  small tables need no more tasks; large ones keep theirs
    e = few(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("_n"))
        large = keyed(both.where("v > u"), least, "u", n).where("v <> m")
        large = cut(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().transform(few))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        small = keyed(large, least, "u", n)
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.*")
        e = cut(small.where("u <> v").distinct().transform(few))
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components didn't settle")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return out.repartition("node")  # what joins by node meets an even table
