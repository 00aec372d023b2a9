"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: each distinct lower-cased word (hashed, value log(1 + tf)
scaled to unit length), one indicator for the level of each structure statistic, and
one for each metadata value. The margin is

    b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

so all pairwise interactions cost one pass over the features. Structure statistics:
length, distinct share of the words, share of the most frequent word, shares of upper
case, digits, symbols and punctuation among the bytes, mean word length, and shares of
repeated lines and of words per line.

Defined cases: a null or empty text has no words and the lowest levels, and is scored
like any other; a null metadata value is a level of its own and an absent metadata column
counts as null; repeated rows get equal scores; of a labelled id's different rows the one with
the smallest hash of text and metadata trains; an empty table gives no rows; without
labelled rows of both classes every score is the base rate. Other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytetext import NOT_SPACE, Slice, mix, slices, sums, unique_pairs, words
from corpusloom.llm.learning import class_counts, distinct, labelled_sample, map_batches, platt, shipped, sigmoid, within
from corpusloom.llm.tables import cut


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    factors: int = 6
    epochs: int = 6
    batch: int = 128
    rate: float = 0.08
    l2: float = 1e-4
    #: Bounds of the training sample: labelled rows of either class, and bytes of their features.
    rows_per_class: int = 4000
    bytes: int = 256 << 20
    calibrate_every: int = 4
    seed: int = 29


@dataclass
class Machine:
    bits: int
    intercept: float
    linear: np.ndarray
    pairs: np.ndarray  # (1 << bits) + levels rows of factors
    slope: float = 1.0
    offset: float = 0.0


#: Levels of every statistic and of every metadata value.
LEVELS = 24
STATISTICS = 10
METADATA = 4
_UPPER, _DIGIT, _SYMBOL, _POINT = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), range(48, 58), b"#$%&*+/<=>@\\^_`{|}~", b"!\"'(),-.:;?[]"))
_NEWLINE = np.isin(np.arange(256), [10], invert=True)


def structure(s: Slice, tf: tuple[np.ndarray, np.ndarray, np.ndarray], n_words: np.ndarray) -> np.ndarray:
    """The level of each statistic, one row per document."""
    size = np.diff(s.off)
    byte, word = np.maximum(size, 1), np.maximum(n_words, 1)
    doc, _, count = tf
    top = np.zeros(len(s))
    np.maximum.at(top, doc, count)
    lines = words(s, _NEWLINE, lower=False)
    n_lines = np.diff(lines.ptr)
    ld, lk, lc = unique_pairs(lines.docs(), mix(lines.hash) >> np.uint64(32), 32)
    again = n_lines - np.bincount(ld, minlength=len(s))
    share = [np.bincount(doc, minlength=len(s)) / word, top / word, *(sums(c[s.buf], s) / byte for c in (_UPPER, _DIGIT, _SYMBOL, _POINT)), again / np.maximum(n_lines, 1)]
    levels = [np.minimum(np.ceil(np.sqrt(np.clip(x, 0, 1)) * (LEVELS - 1)), LEVELS - 1) for x in share]
    levels += [np.minimum(np.log2(1 + x) * m, LEVELS - 1) for x, m in ((n_words, 1.2), (size / word, 4), (n_words / np.maximum(n_lines, 1), 2.5))]
    return np.stack(levels, 1).astype(np.int64)


def features(s: Slice, bits: int, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value); ``metadata`` has one column of levels per metadata column."""
    w = words(s, NOT_SPACE)
    tf = unique_pairs(w.docs(), mix(w.hash) >> np.uint64(64 - bits), bits)
    doc, key, count = tf
    value = np.log1p(count)
    value /= np.sqrt(np.maximum(np.bincount(doc, value * value, len(s)), 1e-9))[doc]
    level = np.concatenate([structure(s, tf, np.diff(w.ptr)), metadata], 1)
    level += (1 << bits) + LEVELS * np.arange(level.shape[1])
    n, m = level.shape
    return np.concatenate([doc, np.repeat(np.arange(n), m)]), np.concatenate([key, level.ravel()]), np.concatenate([value, np.full(n * m, 0.5)]).astype(np.float32)


def metadata_levels(b: pa.RecordBatch, columns: int) -> np.ndarray:
    """Numbers by their magnitude, other values by hash, null as 0."""
    out = np.zeros((b.num_rows, columns), np.int64)
    for k in range(columns):
        x = b.column(f"_m{k}")
        if pa.types.is_integer(x.type) or pa.types.is_floating(x.type):
            v = np.nan_to_num(x.cast(pa.float64()).to_numpy(zero_copy_only=False), nan=-1.0)
            out[:, k] = np.where(v < 0, 0, 1 + np.minimum(np.log2(1 + np.maximum(v, 0)), LEVELS - 2))
        else:
            h = np.concatenate([np.zeros(0, np.int64)] + [_whole_hash(s) for s in slices(x.cast(pa.string()))])
            out[:, k] = np.where(x.is_null().to_numpy(zero_copy_only=False), 0, 1 + h % (LEVELS - 1))
    return out


def _whole_hash(s: Slice) -> np.ndarray:
    w = words(s, np.ones(256, bool), lower=False)
    out = np.zeros(len(s), np.int64)
    out[np.diff(w.ptr) > 0] = (w.hash >> np.uint64(8)).astype(np.int64)
    return out


def margins(m: Machine, doc: np.ndarray, key: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Linear time by the sum-of-squares identity."""
    out = m.intercept + np.bincount(doc, m.linear[key] * x, n)
    for f in range(m.pairs.shape[1]):
        v = m.pairs[:, f][key] * x
        s = np.bincount(doc, v, n)
        out += 0.5 * (s * s - np.bincount(doc, v * v, n))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cfg: Settings, weight: np.ndarray) -> Machine:
    """Minibatch Adagrad on the log loss; the order and the start are seeded."""
    rng = np.random.default_rng(cfg.seed)
    size = (1 << cfg.bits) + LEVELS * (STATISTICS + METADATA)
    w, v = np.zeros(size), rng.normal(0, 0.03, (size, cfg.factors))
    gw, gv, b, gb = np.full(size, 1e-2), np.full((size, cfg.factors), 1e-2), 0.0, 1e-2
    for _ in range(cfg.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), cfg.batch):
            at = order[lo : lo + cfg.batch]
            doc = np.repeat(np.arange(len(at)), [len(rows[i][0]) for i in at])
            key, x = np.concatenate([rows[i][0] for i in at]), np.concatenate([rows[i][1] for i in at]).astype(float)
            used, of = np.unique(key, return_inverse=True)
            vx = v[key] * x[:, None]
            total = np.stack([np.bincount(doc, vx[:, f], len(at)) for f in range(cfg.factors)], 1)
            square = np.stack([np.bincount(doc, vx[:, f] ** 2, len(at)) for f in range(cfg.factors)], 1)
            z = b + np.bincount(doc, w[key] * x, len(at)) + 0.5 * (total**2 - square).sum(1)
            d = (sigmoid(z) - y[at]) * weight[at] / len(at)
            dx = d[doc] * x
            g = np.bincount(of, dx, len(used)) + cfg.l2 * w[used]
            gw[used] += g * g
            w[used] -= cfg.rate * g / np.sqrt(gw[used])
            for f in range(cfg.factors):
                g = np.bincount(of, dx * (total[doc, f] - vx[:, f]), len(used)) + cfg.l2 * v[used, f]
                gv[used, f] += g * g
                v[used, f] -= cfg.rate * g / np.sqrt(gv[used, f])
            gb += d.sum() ** 2
            b -= cfg.rate * d.sum() / np.sqrt(gb)
    return Machine(cfg.bits, float(b), w.astype(np.float32), v.astype(np.float32))


def _prepared(docs: DataFrame, columns: tuple[str, ...], text: str, metadata: tuple[str, ...]) -> DataFrame:
    assert len(metadata) <= METADATA, f"at most {METADATA} metadata columns"
    extra = [(F.col(c) if c in docs.columns else F.lit(None).cast("string")).alias(f"_m{k}") for k, c in enumerate(metadata)]
    return docs.select(*columns, F.col(text).cast("string").alias("_text"), *extra)


def _padded(b: pa.RecordBatch, n: int) -> np.ndarray:
    level = metadata_levels(b, n)
    return np.concatenate([level, np.zeros((len(level), METADATA - n), np.int64)], 1)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", where=None, metadata: tuple[str, ...] = ("n_chars",), cfg: Settings = Settings()) -> Machine:
    """Fit on the labelled rows that ``where`` (a function of the id column) admits."""
    counts = class_counts(labels, label, where=where)
    base = min(max((counts[1] + 0.5) / (sum(counts) + 1), 1e-4), 1 - 1e-4)
    size = (1 << cfg.bits) + LEVELS * (STATISTICS + METADATA)
    flat = Machine(cfg.bits, float(np.log(base / (1 - base))), np.zeros(size, np.float32), np.zeros((size, cfg.factors), np.float32))
    if not all(counts):
        return flat
    sample = labelled_sample(labels, label, cfg.rows_per_class, where=where)
    n, bits = len(metadata), cfg.bits
    rows = _prepared(docs, ("doc_id",), "text", metadata).withColumnRenamed("doc_id", "id").withColumn("h", F.xxhash64("_text", *(f"_m{k}" for k in range(n)))).join(F.broadcast(sample), "id")

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        keys, values, level = [], [], _padded(b, n)
        for s in slices(b.column("_text")):
            doc, key, x = features(s, bits, level[s.lo : s.hi])
            order = np.argsort(doc, kind="stable")
            cut = np.searchsorted(doc[order], np.arange(len(s) + 1))
            for i in range(len(s)):
                at = order[cut[i] : cut[i + 1]]
                keys.append(key[at].astype(np.uint32).tobytes())
                values.append(x[at].astype(np.float32).tobytes())
        return [b.column("id"), b.column("h"), b.column("y"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())]

    schema = T.StructType([T.StructField("id", sample.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("k", T.BinaryType()), T.StructField("x", T.BinaryType())])
    got = cut(distinct(map_batches(rows.select("id", "h", "y", "_text", *(f"_m{k}" for k in range(n))), make, schema), "id"))
    got = within(got, "id", F.octet_length("k") + F.octet_length("x"), cfg.bytes).toArrow().sort_by("id")
    if not got.num_rows:
        return flat
    y = got.column("y").to_numpy().astype(float)
    if len(set(y)) < 2:
        return flat
    rows = [(np.frombuffer(k.as_buffer(), np.uint32).astype(np.int64), np.frombuffer(x.as_buffer(), np.float32)) for k, x in zip(got.column("k"), got.column("x"), strict=True)]
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    last = np.arange(len(y)) % cfg.calibrate_every == 0
    m = fit([r for r, x in zip(rows, last, strict=True) if not x], y[~last], cfg, weight[~last])
    held = [r for r, x in zip(rows, last, strict=True) if x]
    z = margins(m, np.repeat(np.arange(len(held)), [len(k) for k, _ in held]), np.concatenate([k for k, _ in held]), np.concatenate([x for _, x in held]), len(held))
    if len(set(y[last])) == 2:
        m.slope, m.offset = platt(z, y[last], np.where(y[last] == 1, base / y[last].mean(), (1 - base) / (1 - y[last].mean())))
    return m


def score(docs: DataFrame, machine: Machine, columns: tuple[str, ...] = ("doc_id",), text: str = "text", metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """``columns`` and ``score`` of every row: one narrow pass, no shuffle."""
    held, n = shipped(docs.sparkSession, machine), len(metadata)

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        m, out, level = held.value, np.empty(b.num_rows), _padded(b, n)
        for s in slices(b.column("_text")):
            z = margins(m, *features(s, m.bits, level[s.lo : s.hi]), len(s))
            out[s.lo : s.hi] = sigmoid(m.slope * np.clip(z, -12, 12) + m.offset)
        return [*(b.column(c) for c in columns), pa.array(out)]

    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField("score", T.DoubleType())])
    return map_batches(_prepared(docs, columns, text, metadata), make, schema)
