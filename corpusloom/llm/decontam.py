"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``k`` consecutive words of an item (a shorter item is one window). It is
contained in a document only if each of its ``g``-word shingles is. Shingles are ordered
by rarity, i.e. by how often they occur in all documents (a counted pass over the
corpus), and of each window only the necessary prefix is joined: for exact containment
that is its single rarest shingle, the anchor. A document position that holds an anchor
proposes the windows that have it; the length bound (the window must fit between the
document's ends) and the positional bound (anchor position minus its offset fixes the
window's only possible start) leave one start for each, where the hashes of the first
and the last part of the window are compared, then all words, byte for byte.

The benchmark is the query set: its items are cut into pieces that overlap by ``k`` - 1 words, so
no window is lost, and the pieces are read in blocks of about ``block_words`` words, a
bound on what is broadcast whatever the length of an item; beyond one block, each block passes over the documents and
the hits of a document's rows are united by a join. Nothing else moves, so a source or a
group of copies of any size stays where it was read.

Defined cases: null text has no words; null or wordless items are ignored; an item id
that occurs in several rows is one item with all their windows; item ids are compared as
strings; repeated document rows each get their row; empty tables give no rows or no
hits; other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytetext import ALNUM, LOWER, Slice, Words, slices, windows, words
from corpusloom.llm.learning import map_batches, shipped
from corpusloom.llm.tables import cut, keyed

ANCHOR_WORDS = 3
#: Words of a piece of an item.
PIECE_WORDS = 50_000


@dataclass
class Item:
    """Words of one benchmark row as bytes, with the name that reports use."""

    name: str
    words: list[bytes]


@dataclass
class Block:
    """Windows of some items. Anchors are sorted; ``first[a]:first[a + 1]`` are the windows of anchor a, sorted by length."""

    g: int
    anchor: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    head: np.ndarray  # hash of the first g words
    tail: np.ndarray  # hash of the last g words
    text: list[bytes]
    names: list[list[str]]


def item_words(texts: pa.Array) -> list[list[bytes]]:
    out = []
    for s in slices(texts):
        w = words(s, ALNUM)
        low = LOWER[s.buf].tobytes()
        out += [[low[w.start[i] : w.end[i]] for i in range(w.ptr[d], w.ptr[d + 1])] for d in range(len(s))]
    return out


def item_windows(items: list[Item], k: int) -> dict[tuple[bytes, ...], list[str]]:
    """Distinct windows with the items that have them."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for it in items:
        for i in range(max(1, len(it.words) - k + 1) if it.words else 0):
            found.setdefault(tuple(it.words[i : i + k]), set()).add(it.name)
    return {w: sorted(names) for w, names in found.items()}


def _hashes(rows: list[tuple[bytes, ...]], g: int) -> list[np.ndarray]:
    """Hashes of the g-word shingles of each row, as ``windows`` makes them."""
    out = []
    for lo in range(0, len(rows), 4096):
        for s in slices(pa.array([b" ".join(r) for r in rows[lo : lo + 4096]], pa.binary())):
            h, at = windows(w := words(s, ALNUM), g)
            cut = np.searchsorted(at, w.ptr)
            out += [h[cut[d] : cut[d + 1]] for d in range(len(s))]
    return out


def shingles_of(items: list[Item], k: int) -> dict[int, np.ndarray]:
    """By shingle length: the sorted hashes of the shingles of all windows."""
    by: dict[int, list] = {}
    for w in item_windows(items, k):
        by.setdefault(min(ANCHOR_WORDS, len(w)), []).append(w)
    return {g: np.unique(np.concatenate(_hashes(rows, g))) for g, rows in by.items()}


def build(items: list[Item], k: int, frequency: dict[int, dict[int, int]]) -> list[Block]:
    """One index for each shingle length in use; rarity is (count over the documents, hash)."""
    found, out = item_windows(items, k), []
    for g in sorted({min(ANCHOR_WORDS, len(w)) for w in found}):
        rows = [w for w in found if min(ANCHOR_WORDS, len(w)) == g]
        hashes, count = _hashes(rows, g), frequency.get(g, {})
        offset = np.array([min(range(len(h)), key=lambda i, h=h: (count.get(int(h[i]), 0), int(h[i]), i)) for h in hashes], np.int64)
        anchor = np.array([h[o] for h, o in zip(hashes, offset, strict=True)], np.uint64)
        order = np.argsort(anchor, kind="stable")
        distinct, first = np.unique(anchor[order], return_index=True)
        out.append(Block(g, distinct, np.append(first, len(order)), offset[order], np.array([len(rows[i]) for i in order]), np.array([hashes[i][0] for i in order], np.uint64), np.array([hashes[i][-1] for i in order], np.uint64), [b" ".join(rows[i]) for i in order], [found[rows[i]] for i in order]))
    return out


def _found(sorted_set: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``h`` of members of ``sorted_set``, and which members."""
    bits = 16
    seen = np.zeros(1 << bits, bool)
    seen[(sorted_set >> np.uint64(64 - bits)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(h >> np.uint64(64 - bits)).astype(np.int64)])
    where = np.minimum(np.searchsorted(sorted_set, h[at]), len(sorted_set) - 1)
    ok = sorted_set[where] == h[at]
    return at[ok], where[ok]


def matches(s: Slice, w: Words, blocks: list[Block]) -> list[tuple[int, int, int, int]]:
    """(index of the first word, length, block, window) of every contained window."""
    out, low = [], None
    last = np.repeat(w.ptr[1:], np.diff(w.ptr))
    begin = np.repeat(w.ptr[:-1], np.diff(w.ptr))
    for b, x in enumerate(blocks):
        h, at = windows(w, x.g)
        pos, anchor = _found(x.anchor, h)
        if not len(pos):
            continue
        of = np.full(len(w.hash), -1, np.int64)  # shingle index by first word
        of[at] = np.arange(len(at))
        many = x.first[anchor + 1] - x.first[anchor]
        word = np.repeat(at[pos], many)
        win = np.concatenate([np.arange(x.first[a], x.first[a + 1]) for a in anchor])
        start = word - x.offset[win]
        ok = (start >= begin[word]) & (start + x.length[win] <= last[word])  # positional and length bounds
        start, win = start[ok], win[ok]
        ok = (h[of[start]] == x.head[win]) & (h[of[start + x.length[win] - x.g]] == x.tail[win])
        for i, j in zip(start[ok].tolist(), win[ok].tolist(), strict=True):
            low = LOWER[s.buf].tobytes() if low is None else low
            n = int(x.length[j])
            if b" ".join([low[w.start[t] : w.end[t]] for t in range(i, i + n)]) == x.text[j]:
                out.append((i, n, b, j))
    return out


def _pieces(benchmark: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(name, i, n, words): each item's words in pieces that overlap by k - 1 words, joined by blanks."""

    def run(batches):
        for b in batches:
            out = {"name": [], "i": [], "n": [], "words": []}
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
                (w,) = item_words(pa.array([text], pa.string()))
                step = max(1, PIECE_WORDS - k + 1)
                for i, lo in enumerate(range(0, max(1, len(w) - k + 1), step) if w else ()):
                    part = w[lo : lo + step + k - 1]
                    for c, x in zip(out.values(), (name, i, len(part), b" ".join(part)), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("name", pa.string()), ("i", pa.int32()), ("n", pa.int64()), ("words", pa.binary())]))

    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return items.mapInArrow(run, "name string, i int, n long, words binary")


def _collect(rows: DataFrame) -> list[Item]:
    got = rows.select("name", "words").toArrow()
    return [Item(n, w.split(b" ")) for n, w in zip(got.column("name").to_pylist(), got.column("words").to_pylist(), strict=True)]


def corpus_frequency(docs: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """Occurrences in all documents of the wanted shingles: counted per batch, then summed."""
    held = shipped(docs.sparkSession, wanted)

    def count(batches):
        total = {g: np.zeros(len(x), np.int64) for g, x in held.value.items()}
        for b in batches:
            for s in slices(b.column("_text")):
                w = words(s, ALNUM)
                for g, x in held.value.items():
                    _, which = _found(x, windows(w, g)[0])
                    total[g] += np.bincount(which, minlength=len(x))
        for g, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"g": pa.array(np.full(len(at), g), pa.int32()), "i": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})

    rows = docs.mapInArrow(count, "g int, i long, n long").groupBy("g", "i").agg(F.sum("n").alias("n")).collect()
    out: dict[int, dict[int, int]] = {g: {} for g in wanted}
    for r in rows:
        out[r["g"]][int(wanted[r["g"]][r["i"]])] = r["n"]
    return out


def _block_hits(docs: DataFrame, items: list[Item], k: int, keep: list[str]) -> DataFrame:
    """``keep``, n_words, and of one block: hit intervals (start, end by word) and names of items, for every row."""
    text = docs.select(F.col("_text"))
    blocks = build(items, k, corpus_frequency(text, shingles_of(items, k))) if items else []
    held = shipped(docs.sparkSession, blocks)

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        n, spans, names = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)], [set() for _ in range(b.num_rows)]
        for s in slices(b.column("_text")):
            w = words(s, ALNUM)
            n[s.lo : s.hi] = np.diff(w.ptr)
            for i, length, block, j in matches(s, w, held.value):
                d = int(np.searchsorted(w.ptr, i, "right")) - 1
                spans[s.lo + d].append((int(i - w.ptr[d]), int(i - w.ptr[d]) + length))
                names[s.lo + d].update(held.value[block].names[j])
        flat = [[x for span in _united(row) for x in span] for row in spans]
        return [*(b.column(c) for c in keep), pa.array(n), pa.array([sum(x[1::2]) - sum(x[::2]) for x in flat], pa.int64()), pa.array(flat, pa.list_(pa.int64())), pa.array([sorted(x) for x in names], pa.list_(pa.string()))]

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])
    return map_batches(docs.select(*keep, "_text"), make, schema)


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find(docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """``columns`` of every document row with n_words, n_hit (words in hits), hits (flat, disjoint [start, end) word ranges) and items (sorted names)."""
    items = cut(_pieces(benchmark, item_id, item_text, k))
    size = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_words))
    docs = docs.select(*columns, F.col(text).cast("string").alias("_text"))
    if blocks == 1:
        return _block_hits(docs, _collect(items), k, list(columns))
    body = docs.withColumn("_row", F.sha2(F.to_json(F.struct(*columns, "_text"), {"ignoreNullFields": "false"}), 256))  # equal rows have equal hits
    parts = [_block_hits(body, _collect(items.where(F.pmod(F.xxhash64("name", "i"), F.lit(blocks)) == i)), k, ["_row"]) for i in range(blocks)]
    some = parts[0].where("size(items) > 0")
    for p in parts[1:]:
        some = some.unionByName(p.where("size(items) > 0"))
    found = cut(some.groupBy("_row").agg(F.flatten(F.collect_set("hits")).alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.count(F.lit(1)).alias("_n")))
    base = keyed(_block_hits(body, [], k, [*columns, "_row"]).drop("n_hit", "hits", "items"), found, "_row", docs.count(), "left")

    def unite(b: pa.RecordBatch) -> list[pa.Array]:
        flat = [[x for span in _united(list(zip((h or [])[::2], (h or [])[1::2], strict=True))) for x in span] for h in b.column("h").to_pylist()]
        return [*(b.column(c) for c in (*columns, "n_words")), pa.array([sum(x[1::2]) - sum(x[::2]) for x in flat], pa.int64()), pa.array(flat, pa.list_(pa.int64())), b.column("items")]

    base = base.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    schema = T.StructType([*(docs.schema[c] for c in columns), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])
    return map_batches(base.select(*columns, "n_words", "h", "items"), unite, schema)


def digest(found: DataFrame, *columns: str) -> DataFrame:
    """The digest of ``find``: counts and a hash of the item names."""
    return found.select(
        *columns,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without a hit, with all their columns; the verdict travels with the row, so nothing is joined back."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names).withColumn("_body", F.col(names[docs.columns.index("text")]))
    found = find(inner, benchmark, columns=tuple(names), text="_body", **settings)
    return found.where("size(items) = 0").select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
