"""Language ID: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

Subwords are the 3- and 4-byte windows of the lower-cased text in which every run of
bytes that aren't letters counts as one blank; windows with a blank inside are left
out, so they are the windows of the words with their borders. A document's vector is
the mean of its subwords' embeddings. After training, embeddings and softmax fold into one
table of logits by bucket, which is what scoring reads. A temperature and a rejection
threshold are set on rows that training hasn't seen.

Defined cases: null text, or text without a letter, gets ``und`` with score 1 (there
is nothing to tell); a text of letters without a subword of a known kind gets the
prior's best language; texts are used whole; repeated rows get equal results and train once; an empty
table gives no rows; more languages than the bound are an error; without any language to learn all rows get ``und`` with score 0.
Columns other than the id, the text and (in training) the language aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytetext import LETTER, LOWER, Slice, slices
from corpusloom.llm.learning import distinct, map_batches, shipped, within
from corpusloom.llm.tables import cut

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    size: int = 16
    epochs: int = 6
    rate: float = 0.5
    #: Bounds of the training sample: about so many rows of each language (smallest hashes of id and text), and bytes of their features.
    rows_per_language: int = 1500
    bytes: int = 512 << 20
    #: More languages than this are an error, as the model that is broadcast has a column for each: raise it, or clean the labels.
    languages: int = 2000
    #: Of right predictions on unseen rows, the share that the rejection threshold may refuse.
    refused: float = 0.005
    calibrate_every: int = 4
    seed: int = 5


@dataclass
class Model:
    bits: int
    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


_NORMAL = np.where(LETTER, LOWER, 32).astype(np.uint8)


def subwords(s: Slice, bits: int):
    """(document, bucket) of the 3- and 4-byte windows."""
    plain = _NORMAL[s.buf]
    blank = plain == 32
    n, down = len(plain), np.uint32(32 - bits)
    doc = np.repeat(np.arange(len(s), dtype=np.int32), np.diff(s.off))
    wide = plain.astype(np.uint32)
    for k in (3, 4):
        m = n - k + 1
        if m <= 0:
            continue
        ok = ~blank[1 : m + 1] & (doc[:m] == doc[k - 1 :])
        if k == 4:
            ok &= ~blank[2 : m + 2]
        at = np.flatnonzero(ok)
        code = np.zeros(len(at), np.uint32)
        for j in range(k):
            code = (code << np.uint32(8)) | wide[at + j]
        code = (code + np.uint32(k)) * np.uint32(2654435761)
        code ^= code >> np.uint32(15)
        yield doc[at], ((code * np.uint32(2246822519)) >> down).astype(np.int32)


def has_letter(s: Slice) -> np.ndarray:
    """Whether each text has a letter; bytes beyond ASCII are decoded only where no ASCII letter decides."""
    ascii_letter = (s.buf | 32) - 97 < 26
    total = np.concatenate(([0], np.cumsum(ascii_letter)))
    out = total[s.off[1:]] > total[s.off[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in s.buf[s.off[i] : s.off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, languages: list[str], cfg: Settings) -> Model:
    """SGD over single documents in a seeded order with a falling rate."""
    rng = np.random.default_rng(cfg.seed)
    k = len(languages)
    e, w, b = rng.normal(0, 0.05, (1 << cfg.bits, cfg.size)), np.zeros((cfg.size, k)), np.zeros(k)
    w += rng.normal(0, 0.3, w.shape)
    total, done = cfg.epochs * len(rows), 0
    for _ in range(cfg.epochs):
        for i in rng.permutation(len(rows)):
            key, share = rows[i]
            rate = cfg.rate * (1 - done / total)
            done += 1
            h = share @ e[key]
            p = _softmax((h @ w + b)[None])[0]
            p[y[i]] -= 1
            g = w @ p
            w -= rate * np.outer(h, p)
            b -= rate * 0.1 * p
            e[key] -= rate * 20 * share[:, None] * g
    return Model(cfg.bits, languages, (e @ w).astype(np.float32), b)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def calibrate(m: Model, z: np.ndarray, y: np.ndarray, cfg: Settings) -> None:
    """The temperature with the least log loss, and the threshold that refuses few right answers."""
    grid = np.geomspace(0.1, 10, 41)
    m.temperature = float(min(grid, key=lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()))
    p = _softmax(z / m.temperature)
    right = p.max(1)[p.argmax(1) == y]
    m.threshold = float(np.quantile(right, cfg.refused)) if len(right) else 0.0


def train(docs: DataFrame, where=None, lang: str = "lang", cfg: Settings = Settings()) -> Model | None:
    """Fit on text and non-null language of the rows that ``where`` (a function of the id column) admits."""
    rows = docs.select(F.col("doc_id").alias("id"), F.col(lang).cast("string").alias("y"), F.col("text").cast("string").alias("text")).where("y is not null and id is not null")
    if where is not None:
        rows = rows.where(where(F.col("id")))
    counts = rows.groupBy("y").count().limit(cfg.languages + 1).collect()
    if not counts:
        return None
    if len(counts) > cfg.languages:
        raise ValueError(f"more than {cfg.languages} languages to learn")
    languages = sorted(r["y"] for r in counts)
    shares = rows.sparkSession.createDataFrame([(r["y"], min(1.0, cfg.rows_per_language / r["count"])) for r in counts], "y string, share double")
    hashed = rows.withColumn("h", F.xxhash64("id", "text", F.lit(cfg.seed))).join(F.broadcast(shares), "y")
    picked = hashed.where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("id", "h", "y", "text")
    bits = cfg.bits

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        keys, shares = [], []
        for s in slices(b.column("text")):
            parts = list(subwords(s, bits))
            doc, key = (np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, np.int32) for j in (0, 1))
            both, count = np.unique(doc.astype(np.int64) << bits | key, return_counts=True)
            cut = np.searchsorted(both >> bits, np.arange(len(s) + 1))
            for i in range(len(s)):
                c = count[cut[i] : cut[i + 1]]
                keys.append((both[cut[i] : cut[i + 1]] & ((1 << bits) - 1)).astype(np.uint32).tobytes())
                shares.append((c / max(1, c.sum())).astype(np.float32).tobytes())
        return [b.column("key"), b.column("id"), b.column("h"), b.column("y"), pa.array(keys, pa.binary()), pa.array(shares, pa.binary())]

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", picked.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("y", T.StringType()), T.StructField("k", T.BinaryType()), T.StructField("x", T.BinaryType())])
    keyed = picked.select(F.xxhash64("h", "y").alias("key"), "id", "h", "y", "text")  # repeated rows count once
    got = cut(distinct(map_batches(keyed, make, schema), "key"))
    got = within(got, "key", F.octet_length("k") + F.octet_length("x"), cfg.bytes).toArrow().sort_by([("id", "ascending"), ("h", "ascending"), ("y", "ascending")])
    of = {x: i for i, x in enumerate(languages)}
    data = [(np.frombuffer(k.as_buffer(), np.uint32).astype(np.int64), np.frombuffer(x.as_buffer(), np.float32).astype(float)) for k, x in zip(got.column("k"), got.column("x"), strict=True)]
    y = np.array([of[x] for x in got.column("y").to_pylist()], np.int64)
    if not len(y):
        return None
    last = np.arange(len(y)) % cfg.calibrate_every == 0 if len(y) >= 8 * cfg.calibrate_every else np.zeros(len(y), bool)
    m = fit([d for d, x in zip(data, last, strict=True) if not x], y[~last], languages, cfg)
    if last.any():
        z = np.array([x @ m.logits[k] + m.bias for (k, x), t in zip(data, last, strict=True) if t])
        calibrate(m, z, y[last], cfg)
    return m


def predict(docs: DataFrame, model: Model | None, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns``, lang_pred, score and rejected (the score is below the calibrated threshold) of every row."""
    if model is None:
        return docs.select(*columns, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    held = shipped(docs.sparkSession, model)

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        m = held.value
        best, top, letters = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
        for s in slices(b.column("_text")):
            z, n = np.zeros((len(s), len(m.languages))), np.zeros(len(s))
            for doc, key in subwords(s, m.bits):
                n += np.bincount(doc, minlength=len(s))
                for j in range(z.shape[1]):
                    z[:, j] += np.bincount(doc, m.logits[:, j][key], len(s))
            p = _softmax((z / np.maximum(n, 1)[:, None] + m.bias) / m.temperature)
            best[s.lo : s.hi], top[s.lo : s.hi], letters[s.lo : s.hi] = p.argmax(1), p.max(1), has_letter(s)
        names = np.array([*m.languages, UNDETERMINED], object)
        return [*(b.column(c) for c in columns), pa.array(names[np.where(letters, best, len(m.languages))], pa.string()), pa.array(np.where(letters, top, 1.0)), pa.array(~letters | (top < m.threshold))]

    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return map_batches(docs.select(*columns, F.col(text).cast("string").alias("_text")), make, schema)
