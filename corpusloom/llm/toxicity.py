"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes (``bits`` wide) of its lower-cased words, of
neighbouring pairs and of pairs with one word between, each present or not. The
learner keeps the usual z and n per coordinate, so each has its own rate, and L1
leaves most weights at exactly zero: what is broadcast is the list of non-zero ones.

Defined cases: a null, empty or wordless text gets the score of the intercept
alone; repeated rows get equal scores; of a labelled id's different texts the one with the
smallest hash trains; any text is used whole; an empty table gives
no rows; without labelled rows of both classes every score is the base rate.
Columns of the input other than the id and the text are not read.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytetext import ALNUM, Slice, mix, slices, unique_pairs, words
from corpusloom.llm.learning import class_counts, distinct, labelled_sample, map_batches, platt, shipped, sigmoid, within
from corpusloom.llm.tables import cut


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.5
    epochs: int = 3
    #: Bounds of the training sample: labelled rows of either class, and bytes of their features.
    rows_per_class: int = 6000
    bytes: int = 512 << 20
    seed: int = 17
    #: Every so many rows of the sample calibrate the score and don't train the model that they calibrate.
    calibrate_every: int = 4


@dataclass
class Weights:
    """The non-zero coordinates of a fitted model."""

    bits: int
    intercept: float
    index: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.value
        return out


def grams(s: Slice, bits: int):
    """(document, bucket) arrays of words, of pairs and of pairs with one word between."""
    w = words(s, ALNUM)
    doc, down = w.docs(), np.uint64(64 - bits)
    for gap in (0, 1, 2):
        if not gap:
            yield doc, (mix(w.hash) >> down).astype(np.int64)
        elif len(doc) > gap:
            same = doc[gap:] == doc[:-gap]
            h = mix(w.hash[:-gap] * np.uint64(2 * gap + 1) + (w.hash[gap:] >> np.uint64(gap)))
            yield doc[gap:][same], (h >> down).astype(np.int64)[same]


def presence(s: Slice, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs of all features."""
    parts = list(grams(s, bits))
    doc, key, _ = unique_pairs(np.concatenate([d for d, _ in parts]), np.concatenate([k for _, k in parts]), bits)
    return doc, key


class Shelf:
    """Features of the sample's rows in a temporary file of the driver, which reads one row at a time."""

    def __init__(self) -> None:
        self.file, self.ends = tempfile.TemporaryFile(), [0]

    def add(self, row: bytes) -> None:
        self.file.write(row)
        self.ends.append(self.ends[-1] + len(row))

    def __getitem__(self, i: int) -> np.ndarray:
        self.file.flush()
        return np.frombuffer(os.pread(self.file.fileno(), self.ends[i + 1] - self.ends[i], self.ends[i]), np.uint32)


def fit(features: Shelf | list[np.ndarray], order: np.ndarray, y: np.ndarray, cfg: Settings, base_rate: float) -> Weights:
    """Fit on all rows, of which ``order`` says where their features are; slope and offset of the log odds come from rows that a first model hasn't seen."""
    last = np.arange(len(y)) % cfg.calibrate_every == 0
    slope, offset = 1.0, 0.0
    if len(set(y[last])) == 2 == len(set(y[~last])):
        first = _ftrl(features, order[~last], y[~last], cfg, base_rate)
        table = first.dense()
        margin = np.array([first.intercept + table[features[i]].sum() for i in order[last]])
        share = y[last].mean()
        weight = np.where(y[last] == 1, base_rate / share, (1 - base_rate) / (1 - share))
        slope, offset = platt(margin, y[last], weight)
    out = _ftrl(features, order, y, cfg, base_rate)
    return Weights(out.bits, out.intercept * slope + offset, out.index, (out.value * slope).astype(np.float32))


def _ftrl(features: Shelf | list[np.ndarray], order: np.ndarray, y: np.ndarray, cfg: Settings, base_rate: float) -> Weights:
    """FTRL-proximal over the rows in a seeded order; the intercept is moved to ``base_rate``."""
    size = 1 << cfg.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, cfg.l1)
        w = -(z[at] - np.sign(z[at]) * l1) / ((cfg.beta + np.sqrt(n[at])) / cfg.alpha + cfg.l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    rng = np.random.default_rng(cfg.seed)
    for _ in range(cfg.epochs):
        for i in rng.permutation(len(order)):
            at = np.append(features[order[i]], size).astype(np.int64)
            w = weight(at)
            g = sigmoid(w.sum()) - y[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / cfg.alpha
            z[at] += g - step * w
            n[at] += g * g
    all_w = weight(np.arange(size + 1))
    kept = np.flatnonzero(all_w[:size])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    moved = np.log(base_rate / (1 - base_rate)) - np.log(share / (1 - share))
    return Weights(cfg.bits, float(all_w[size] + moved), kept, all_w[kept].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", where=None, cfg: Settings = Settings()) -> Weights:
    """Fit on the labelled rows that ``where`` (a function of the id column) admits."""
    counts = class_counts(labels, label, where=where)
    base = min(max((counts[1] + 0.5) / (sum(counts) + 1), 1e-4), 1 - 1e-4)
    if not all(counts):
        return Weights(cfg.bits, float(np.log(base / (1 - base))))
    sample = labelled_sample(labels, label, cfg.rows_per_class, where=where)
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text")).join(F.broadcast(sample), "id")
    bits = cfg.bits

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        out: list[bytes] = []
        for s in slices(b.column("text")):
            doc, key = presence(s, bits)
            cut = np.searchsorted(doc, np.arange(len(s) + 1))
            out += [key[cut[i] : cut[i + 1]].astype(np.uint32).tobytes() for i in range(len(s))]
        return [b.column("id"), b.column("h"), b.column("y"), pa.array(out, pa.binary())]

    schema = T.StructType([T.StructField("id", sample.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("f", T.BinaryType())])
    got = cut(distinct(map_batches(rows.select("id", "h", "y", "text"), make, schema), "id"))
    shelf, ids, y = Shelf(), [], []
    for r in within(got, "id", F.octet_length("f"), cfg.bytes).select("id", "y", "f").toLocalIterator():
        shelf.add(r["f"])
        ids.append(r["id"])
        y.append(r["y"])
    if not ids:
        return Weights(cfg.bits, float(np.log(base / (1 - base))))
    order = np.array(sorted(range(len(ids)), key=ids.__getitem__))
    return fit(shelf, order, np.array(y, float)[order], cfg, base)


def score(docs: DataFrame, weights: Weights, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` and ``score`` of every row: one narrow pass, no shuffle."""
    held = shipped(docs.sparkSession, weights)
    table: list[np.ndarray] = []

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        m = held.value
        if not table:
            table.append(m.dense())
        out = np.empty(b.num_rows)
        for s in slices(b.column("_text")):
            docs_hit, keys_hit = [], []
            for doc, key in grams(s, m.bits):
                hit = np.flatnonzero(table[0][key])  # few features carry weight
                docs_hit.append(doc[hit])
                keys_hit.append(key[hit])
            doc, key, _ = unique_pairs(np.concatenate(docs_hit), np.concatenate(keys_hit), m.bits)
            out[s.lo : s.hi] = sigmoid(m.intercept + np.bincount(doc, table[0][key], len(s)))
        return [*(b.column(c) for c in columns), pa.array(out)]

    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField("score", T.DoubleType())])
    return map_batches(docs.select(*columns, F.col(text).cast("string").alias("_text")), make, schema)
