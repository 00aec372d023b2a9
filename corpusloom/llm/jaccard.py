"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Texts link when their sets of distinct ``k``-word shingles have Jaccard similarity of at
least ``percent`` / 100. The result is exact up to 64-bit hashes of sets, and of shingles from 256 partitions
on (below, up to 56 bits and the partition):

1. A pass digests every text to (size, set hash); equal sets are one class from here on.
   It also counts shingles within batches; those in at least 1 of ``HOT`` documents overall
   are hot (at most HOT times the mean set size many, which bounds their broadcast).
2. A second pass deals the shingles of each class by hash to the owners of the inverted
   lists, packed by batch; classes of very many rows are dealt by the rows with the least
   hash of the id only. An owner finds the lists of two classes or more, and answers each
   class with its shared shingles and their list lengths; hot ones need no owner. Shingles
   that one class alone has can't overlap with anything, so they never travel again.
3. A class with fewer shared shingles than any partner must share is done. The others
   order shingles by rarity (list length) and join on their necessary prefixes: a prefix list is
   cut into bands of sizes, each links its members to its smallest class, and bands
   next to each other link if their sizes allow it. Components of these candidate edges are
   blocks: all links lie within blocks.
4. A block builds inverted lists over its classes and searches for each class by
   T-occurrence with DivideSkip: the L longest lists are set aside, the others are merged by a
   heap, classes found T - L times remain, and the long lists are probed by binary search.
   Classes lie by what is already connected, so a class skips its own group, as a range
   of every list; a group of near copies costs little more than its members.
5. A block with more to merge than ``task_work`` is many tasks. Its classes first search a
   few representatives of the block in chunks, which connects groups of near copies. What is left is
   searched list by list or as a whole, whichever has less to merge: lists whose members are
   all connected are done, others are cut into fragments, of which only those
   outside the largest connected group meet all fragments.
6. Components of the links found are the result.

Defined cases: text without words has an empty set and is linked with nothing; fewer than
k words are one shingle; repeated rows and equal texts link; null ids are kept with a null
component unless something links them to an id; texts are used whole; empty tables give no
rows; extra columns aren't read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytetext import Slice, mix, slices, windows, words
from corpusloom.llm.components import components
from corpusloom.llm.learning import shipped
from corpusloom.llm.tables import cut, keyed

#: A shingle in one of so many documents is hot.
HOT = 500
#: A class with one of so many documents, and 64 at least, is dealt by few of its rows.
POPULAR = 100_000
#: Shingles in a shuffle partition of owners, about.
OWNED = 2_000_000
#: Shingles that are dealt to owners at once, about; entries that are gathered before repeated ones go.
DEALT, GATHERED = 1_000_000, 4_000_000
#: Cost of a probe against that of a step of the merge, for the number of lists that DivideSkip sets aside.
MU = 0.001
#: Long lists that are probed at once.
PROBED = 64
#: Representatives of a large block.
SEEDS = 32


def shingle_sets(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (document, shingle) pairs."""
    w = words(s)
    h, at = windows(w, k)
    doc = w.docs()[at]
    n = np.diff(w.ptr)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([_sequence(w.hash[w.ptr[d] : w.ptr[d + 1]]) for d in short], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc)) if len(short) else _by_runs(doc, h, len(s))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[first], h[first]


def _by_runs(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Like lexsort((h, doc)) for ascending doc: each run is sorted on its own."""
    cut_at = np.searchsorted(doc, np.arange(n + 1))
    out = np.empty(len(h), np.int64)
    for a, b in zip(cut_at[:-1].tolist(), cut_at[1:].tolist(), strict=True):
        if b > a:
            out[a:b] = np.argsort(h[a:b]) + a
    return out


def _sequence(h: np.ndarray) -> np.uint64:
    x = np.array([len(h)], np.uint64)
    for y in h:
        x = mix(x * np.uint64(31) + y)
    return x[0]


def digests(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(size, set hash) of each document, and the pairs of ``shingle_sets``."""
    doc, h = shingle_sets(s, k)
    ptr = np.searchsorted(doc, np.arange(len(s) + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))))
    n = np.diff(ptr)
    return n, mix(total[ptr[1:]] - total[ptr[:-1]] + n.astype(np.uint64)).view(np.int64), doc, h


def _needed(n, percent: int):
    """The least overlap of a set of n with any partner."""
    return -((-percent * n) // 100)


def _digest_pass(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, all_h = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
            for s in slices(b.column("_text")):
                n[s.lo : s.hi], fp[s.lo : s.hi], _, h = digests(s, k)
                all_h.append(h)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n), pa.array(fp), pa.array(np.zeros(b.num_rows, bool))], ["id", "n", "fp", "hot"])
            h = np.concatenate(all_h) if all_h else np.zeros(0, np.uint64)
            h.sort()
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(h)))
            often = count >= max(8, b.num_rows // HOT)
            m = int(often.sum())
            yield pa.RecordBatch.from_arrays([pa.nulls(m, b.column("_id").type), pa.array(count[often]), pa.array(h[first[often]].view(np.int64)), pa.array(np.ones(m, bool))], ["id", "n", "fp", "hot"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, fp long, hot boolean")


_PACKED = "key int, owner int, fp binary, count binary, token binary, df binary"
_COLUMNS = ("key", "owner", "fp", "count", "token", "df")
#: Owners of entries that come straight from the documents: hot shingles, and sizes of classes.
IS_HOT, IS_SIZE = -2, -1
_LOW = np.uint64((1 << 56) - 1)


class Owners:
    """Shingle hashes by equal ranges to ``n`` owners. Seven bytes and the owner tell them apart: by 64 bits from 256 owners on, by 56 and the owner's number below."""

    def __init__(self, n: int):
        self.n = n

    def of(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)).astype(np.int64)

    def whole(self, low: np.ndarray, owner: int) -> np.ndarray:
        """The only hash of an owner's range that ends in these seven bytes; with fewer than 256 owners, what stands for all of them."""
        if self.n < 256:
            return low | np.uint64(owner << 56)
        least = np.uint64(-(-(owner << 32) // self.n) << 32)
        h = low | (least & ~_LOW)
        return np.where(h < least, h + (_LOW + np.uint64(1)), h)


def _seven(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_seven(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 7)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :7] = raw
    return out.view(np.uint64).ravel()


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _pack(key: np.ndarray, owner: np.ndarray | int, fp: np.ndarray, token: np.ndarray, df: np.ndarray | None = None) -> pa.RecordBatch:
    """Entries sorted by (key, owner, fp) as a row for each key and owner: set hashes, their numbers of entries (255 at most, else again), shingles (seven bytes), list lengths."""
    owner = np.broadcast_to(np.asarray(owner), key.shape)
    at = _firsts(key, owner)
    cols: list[list[bytes]] = [[], [], [], []]
    for a, b in zip(at.tolist(), np.append(at[1:], len(key)).tolist(), strict=True):
        f = fp[a:b]
        run = _firsts(f)
        size = np.diff(np.append(run, b - a))
        if size.max() > 255:
            run = np.concatenate([np.arange(r, r + m, 255) for r, m in zip(run, size, strict=True)])
            size = np.diff(np.append(run, b - a))
        for c, x in zip(cols, (f[run].tobytes(), size.astype(np.uint8).tobytes(), _seven(token[a:b]), b"" if df is None else df[a:b].astype(np.uint8).tobytes()), strict=True):
            c.append(x)
    return pa.RecordBatch.from_arrays([pa.array(key[at].astype(np.int32)), pa.array(owner[at].astype(np.int32)), *(pa.array(c, pa.binary()) for c in cols)], list(_COLUMNS))


def _sizes(key: np.ndarray, fp: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each key with set hashes and sizes; sorted by key."""
    at = _firsts(key)
    spans = list(zip(at.tolist(), np.append(at[1:], len(key)).tolist(), strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(key[at].astype(np.int32)), pa.array(np.full(len(at), IS_SIZE, np.int32)), pa.array([fp[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([n[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary()), *(pa.array([b""] * len(at), pa.binary()) for _ in range(2))],
        list(_COLUMNS),
    )


class Gathered:
    """What packed rows of a key say; repeated entries go whenever many more have come than were left before."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size: list[tuple[np.ndarray, np.ndarray]] = []
        self.done: list[tuple[np.ndarray, ...]] = []
        self.come = self.kept = 0

    def add(self, owner: int, fp: bytes, count: bytes, token: bytes, df: bytes) -> None:
        if owner == IS_SIZE:
            self.size.append((np.frombuffer(fp, np.int64), np.frombuffer(count, np.uint32)))
            return
        self.rows.append((owner, fp, count, token, df))
        self.come += len(token) // 7
        if self.come > GATHERED + self.kept:
            fp, owner, token, df = self.entries()
            order = np.lexsort((token, owner, fp))
            order = order[_firsts(fp[order], owner[order], token[order])]
            self.done, self.rows, self.come, self.kept = [tuple(x[order] for x in (fp, owner, token, df))], [], 0, len(order)

    def entries(self) -> tuple[np.ndarray, ...]:
        """(set hash, owner, seven bytes of the shingle, list length) of all entries, in any order and some repeated."""
        parts = list(self.done)
        for owner in sorted({r[0] for r in self.rows}):
            mine = [r for r in self.rows if r[0] == owner]
            fp = np.repeat(np.frombuffer(b"".join(r[1] for r in mine), np.int64), np.frombuffer(b"".join(r[2] for r in mine), np.uint8))
            df = np.frombuffer(b"".join(r[4] for r in mine), np.uint8)
            parts.append((fp, np.full(len(fp), owner), _from_seven([r[3] for r in mine]), df.astype(np.int64) if len(df) else np.zeros(len(fp), np.int64)))
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else none


def _groups(batches: Iterator[pa.RecordBatch], to: int = 1 << 31, past=None) -> Iterator[tuple[int, Gathered]]:
    """What is gathered for each key below ``to`` of batches sorted by key; rows of other keys go to ``past``."""
    held, last = Gathered(), None
    for b in batches:
        m = int(np.searchsorted(b.column("key").to_numpy(), to))
        for key, *row in zip(*(b.column(c).slice(0, m).to_pylist() for c in _COLUMNS), strict=True):
            if key != last and last is not None:
                yield last, held
                held = Gathered()
            last = key
            held.add(*row)
        if m < b.num_rows:
            past.append(b.slice(m))
    if last is not None:
        yield last, held


def _gathered(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``digests`` of runs of about DEALT shingles, made slice by slice: the work space of a slice is many times its text."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = total = 0
    for s in slices(texts):
        n, fp, doc, h = digests(s, k)
        held.append((n, fp, doc + rows, h))
        rows, total = rows + len(n), total + len(h)
        if total >= DEALT:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, rows, total = [], 0, 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _among(x: np.ndarray, sorted_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in the set, and where."""
    if not len(sorted_set):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)
    return sorted_set[at] == x, at


def _deal(docs: DataFrame, k: int, owners: Owners, homes: int, hot: np.ndarray, popular: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Shingles by owner (keys from 0); sizes and hot shingles straight home (keys from ``owners.n``); once for each set of a slice."""
    held = shipped(docs.sparkSession, (hot, *popular))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, sets, deals = held.value
        for b in batches:
            seen, row, ids = np.zeros(0, np.int64), 0, b.column("_rid").to_numpy()
            for n, fp, doc, h in _gathered(b.column("_text"), k):
                often, which = _among(fp, sets)
                mine = np.flatnonzero((n > 0) & (~often | (ids[row : row + len(n)] == deals[which] if len(deals) else ~often)) & ~np.isin(fp, seen))
                row += len(n)
                mine = mine[np.unique(fp[mine], return_index=True)[1]]
                new = np.zeros(len(n), bool)
                new[mine] = True
                seen = np.concatenate([seen, fp[mine]])
                if not len(mine):
                    continue
                home = owners.n + (fp.view(np.uint64) % np.uint64(homes)).astype(np.int64)
                mine = mine[np.argsort(home[mine], kind="stable")]
                yield _sizes(home[mine], fp[mine], n[mine])
                ok = new[doc]
                doc, h = doc[ok], h[ok]
                is_hot, at = _among(h, hot)
                d = doc[is_hot]
                order = np.lexsort((d, home[d]))
                if len(order):
                    yield _pack(home[d][order], IS_HOT, fp[d][order], at[is_hot][order].astype(np.uint64))
                doc, h = doc[~is_hot], h[~is_hot]
                key = owners.of(h)
                order = np.argsort(key * len(n) + doc, kind="stable")
                key, doc, h = key[order], doc[order], h[order]
                if len(key):
                    yield _pack(key, 0, fp[doc], h)

    return docs.mapInArrow(run, _PACKED)


def _answers(held: Gathered, owner: int, first_home: int, homes: int) -> Iterator[pa.RecordBatch]:
    """What an owner tells the homes: the entries of its lists with two classes or more, and how long the lists are."""
    fp, _, token, _ = held.entries()
    order = np.argsort(token, kind="stable")
    t = token[order]
    same = np.zeros(len(t) + 1, bool)
    same[1:-1] = t[1:] == t[:-1]
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((fp[order], token[order]))]
    order = order[_firsts(token[order], fp[order])]  # a class may come from several slices
    t, f = token[order], fp[order]
    first = _firsts(t)
    df = np.repeat(length := np.diff(np.append(first, len(t))), length)
    t, f, df = t[df > 1], f[df > 1], df[df > 1]
    if len(t):
        key = first_home + (f.view(np.uint64) % np.uint64(homes)).astype(np.int64)
        by = np.lexsort((f, key))
        yield _pack(key[by], owner, f[by], t[by], np.minimum(df[by], 255))


def _owned(dealt: DataFrame, owners: Owners, homes: int) -> DataFrame:
    """Owners' answers; what goes straight home passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past: list[pa.RecordBatch] = []
        for owner, held in _groups(batches, owners.n, past):
            yield from _answers(held, owner, owners.n, homes)
            yield from past
            past.clear()
        yield from past

    return dealt.mapInArrow(run, _PACKED)


def _home(held_hot, owners: Owners, percent: int):
    """Classes whose shared shingles suffice, rarest shingles first; p of them are in the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, ranks = held_hot.value
        for _, held in _groups(batches):
            full, at = np.unique(np.concatenate([f for f, _ in held.size]), return_index=True)
            n = np.concatenate([x for _, x in held.size])[at].astype(np.int64)
            fp, owner, token, rank = held.entries()
            if not len(fp):
                continue
            rank, token = rank.copy(), token.copy()
            for o in np.unique(owner).tolist():
                mine = owner == o
                if o == IS_HOT:
                    at = token[mine].astype(np.int64)
                    rank[mine], token[mine] = ranks[at], hot[at]
                else:
                    token[mine] = owners.whole(token[mine], o)
            order = np.lexsort((token, rank, fp))
            order = order[_firsts(fp[order], token[order])]
            fp, token = fp[order], token[order]
            first = _firsts(fp)
            shared = np.diff(np.append(first, len(fp)))
            who = np.searchsorted(full, fp[first])
            size = n[who]
            ok = shared >= _needed(size, percent)
            p = np.maximum(0, shared - _needed(size, percent) + 1)[ok]
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(shared[ok])).astype(np.int32), pa.array(token[np.repeat(ok, shared)].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(full[who[ok]]), pa.array(size[ok]), pa.array(p.astype(np.int32)), lists], ["fp", "n", "p", "tokens"])

    return run


class Block:
    """Inverted lists over some classes; ``search`` unites each with those before it that link.

    Classes lie group by group: first the groups of several, which ``group`` or a probe of the next class
    in a rare list has connected, then single ones by size. A posting is list * classes + class,
    so that all lists are one sorted array and any range of a list is found by binary search.
    ``part``: classes of one part, unless it's negative, aren't compared.
    """

    def __init__(self, size: np.ndarray, tokens: list[np.ndarray], percent: int, group: np.ndarray | None = None, part: np.ndarray | None = None):
        self.percent, self.n, self.links = percent, len(size), []
        self.parent = np.arange(self.n)
        length = np.array([len(t) for t in tokens], np.int64)
        ident = np.unique(np.concatenate(tokens), return_inverse=True)[1].astype(np.int64) if self.n else np.zeros(0, np.int64)
        doc, ptr = np.repeat(np.arange(self.n), length), np.concatenate(([0], np.cumsum(length)))
        self.size, self.part, self.ident = size, np.full(self.n, -1) if part is None else part, [np.sort(ident[a:b]) for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
        if group is not None:
            _, first, of = np.unique(group, return_index=True, return_inverse=True)
            self.parent = first[of]
        self.posting = np.sort(ident * self.n + doc)
        self._neighbours(ident, doc)
        root = self.roots(np.arange(self.n))
        many = np.bincount(root, minlength=self.n)[root] > 1
        order = np.lexsort((self.size, np.where(many, root, self.n)))
        place = np.empty(self.n, np.int64)
        place[order] = np.arange(self.n)
        self.links = [(int(place[a]), int(place[b])) for a, b in self.links]
        self.order, self.size, self.part, self.ident = order, size[order], self.part[order], [self.ident[i] for i in order]
        self.parent = place[_least_place(root, place)[order]]
        self.posting = np.sort(ident * self.n + place[doc])
        self.singles = int(many.sum())
        self.start = np.where(many[order], self.parent, np.arange(self.n))  # where the own group begins
        self.grouped_sizes = np.sort(self.size[: self.singles])

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.parent[i]
        while (self.parent[r] != r).any():
            r = self.parent[r]
        self.parent[i] = r
        return r

    def need(self, a, b):
        """The least overlap of linked sets of these sizes."""
        return -((-self.percent * (a + b)) // (100 + self.percent))

    def allowed(self, q, c):
        a, b = self.part[q], self.part[c]
        return ((a != b) | (a < 0)) & (100 * np.minimum(self.size[q], self.size[c]) >= self.percent * np.maximum(self.size[q], self.size[c]))

    def unite(self, q: int, c: int) -> None:
        a, b = self.roots(np.array([q, c])).tolist()
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((q, c))

    def _neighbours(self, ident: np.ndarray, doc: np.ndarray, tries: int = 3) -> None:
        """Probe for each class the class before it in its rarest lists, of some size order."""
        if self.n < 3:
            return
        order = np.lexsort((np.bincount(ident)[ident], doc))
        at = np.searchsorted(self.posting, (ident * self.n + doc)[order])
        before = np.maximum(at - 1, 0)
        some = (at > 0) & (self.posting[before] // self.n == ident[order])
        who, prior = doc[order][some], (self.posting[before] % self.n)[some]
        for t in range(tries):
            first = _firsts(who)
            at = first + t
            at = at[at < np.append(first[1:], len(who))]
            q, c = who[at], prior[at]
            ok = (self.roots(q) != self.roots(c)) & self.allowed(q, c)
            q, c = q[ok], c[ok]
            if not len(q):
                continue
            lists = [self.ident[i] for i in q]
            many = np.array([len(x) for x in lists])
            hit = self.has(np.concatenate(lists), np.repeat(c, many))
            got = np.bincount(np.repeat(np.arange(len(q)), many), hit, len(q))
            for i in np.flatnonzero(got >= self.need(self.size[q], self.size[c])):
                self.unite(int(q[i]), int(c[i]))

    def has(self, lists: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Binary probes: whether each list has the class."""
        want = lists * self.n + classes
        return self.posting[np.minimum(np.searchsorted(self.posting, want), len(self.posting) - 1)] == want

    def search(self) -> list[tuple[int, int]]:
        """The links that connect the classes, as positions of the input; the last class of a group searches like all others."""
        for q in range(self.n):
            n = int(self.size[q])
            least = -((-self.percent * n) // 100)
            if self.start[q]:
                k = int(np.searchsorted(self.grouped_sizes, least))
                if k < len(self.grouped_sizes):
                    self._search(q, 0, min(int(self.start[q]), self.singles), max(least, int(self.grouped_sizes[k])), False)
            if q > self.singles:
                lo = self.singles + int(np.searchsorted(self.size[self.singles : q], least))
                if lo < q:
                    self._search(q, lo, q, int(self.size[lo]), True)
        return [(int(self.order[a]), int(self.order[b])) for a, b in self.links]

    def _search(self, q: int, lo: int, hi: int, smallest: int, by_size: bool) -> None:
        """T-occurrence of q's lists among classes lo to hi, the smallest of which has this size."""
        n, ids = int(self.size[q]), self.ident[q]
        need = int(self.need(n, smallest))
        start = np.searchsorted(self.posting, ids * self.n + lo)
        while True:
            length = np.searchsorted(self.posting, ids * self.n + hi) - start
            lists = int((length > 0).sum())
            if lists < need:
                return
            largest = lists * (100 + self.percent) // self.percent - n  # larger partners would need more lists
            end = lo + int(np.searchsorted(self.size[lo:hi], largest, "right")) if by_size else hi
            if end == hi:
                break
            hi = end
        some = np.flatnonzero(length)
        by = some[np.argsort(length[some], kind="stable")]
        aside = min(need - 1, int(need / (MU * math.log2(max(2, int(length[by[-1]]))) + 1)))
        short, far = by[: lists - aside], ids[by[lists - aside :]]
        merged = heapq.merge(*((self.posting[a : a + m] % self.n).tolist() for a, m in zip(start[short].tolist(), length[short].tolist(), strict=True)))
        found, times, last = [], [], -1
        for c in merged:
            if c != last:
                found.append(c)
                times.append(0)
                last = c
            times[-1] += 1
        cand, got = np.array(found, np.int64), np.array(times, np.int64)
        want = self.need(n, self.size[cand])
        ok = (got >= need - aside) & (got + aside >= want) & self.allowed(q, cand) & (self.roots(cand) != self.roots(np.array([q])))
        cand, got, want = cand[ok], got[ok], want[ok]
        if len(cand) > 4:  # of each group the likeliest first: one link is enough
            by = np.lexsort((-got, self.roots(cand)))
            best = by[_firsts(self.roots(cand[by]))]
            if 2 * len(best) < len(cand):
                self._probe(q, cand[best], got[best], want[best], far)
                rest = np.setdiff1d(np.arange(len(cand)), best)
                rest = rest[self.roots(cand[rest]) != self.roots(np.array([q]))]
                cand, got, want = cand[rest], got[rest], want[rest]
        self._probe(q, cand, got, want, far)

    def _probe(self, q: int, cand: np.ndarray, got: np.ndarray, want: np.ndarray, far: np.ndarray) -> None:
        """Probe the long lists for all candidates until they have enough or can't."""
        left, got = len(far), got.copy()
        for at in range(0, len(far) + PROBED, PROBED):
            done = got >= want
            for c in cand[done].tolist():
                self.unite(q, c)
            live = ~done & (got + left >= want)
            if done.any():
                live &= self.roots(cand) != self.roots(np.array([q]))
            cand, got, want = cand[live], got[live], want[live]
            if not len(cand) or at >= len(far):
                return
            ids = np.sort(far[at : at + PROBED])
            got += self.has(np.repeat(ids, len(cand)), np.tile(cand, len(ids))).reshape(len(ids), len(cand)).sum(0)
            left -= len(ids)


def _least_place(root: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each class the member of its group that comes first."""
    first = np.full(len(root), len(root))
    np.minimum.at(first, root, place)
    order = np.empty(len(root), np.int64)
    order[place] = np.arange(len(root))
    return order[first[root]]


def _solve(percent: int):
    """Links between the classes of each task (key, x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def done() -> pa.RecordBatch:
            held.sort(key=lambda r: (r[1], r[0]))
            fp, n, part, group = (np.array([r[j] for r in held], np.int64) for j in (0, 1, 3, 4))
            links = Block(n, [r[2] for r in held], percent, group, part).search()
            a, b = (np.array([x[j] for x in links], np.int64) for j in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

        for b in batches:
            tokens = b.column("tokens")
            flat, off = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            for i, (key, x, y, part, group, fp, n) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key", "x", "y", "part", "grouped", "fp", "n")), strict=True)):
                if (key, x, y) != last and held:
                    yield done()
                    held = []
                last = (key, x, y)
                held.append((fp, n, flat[off[i] : off[i + 1]].copy(), part, group))
        if held:
            yield done()

    return run


def _links(tasks: DataFrame, survivors: DataFrame, percent: int, n: int) -> DataFrame:
    """Links within tasks: (key, x, y) with the part and the group of each class (fp); in ``n`` partitions."""
    rows = tasks.join(survivors.select("fp", "n", "tokens"), "fp").select("key", "x", "y", "part", "grouped", "fp", "n", "tokens")
    return rows.repartition(n, "key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(_solve(percent), "a long, b long")


def _mates(part: Column, inner: Column, outer: Column) -> Column:
    """The tasks (x, y) of a class: one of the ``inner`` parts meets all parts, others meet the inner ones."""
    last = F.when(part < inner, inner + outer).otherwise(inner) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(F.least(part, j).alias("x"), F.greatest(part, j).alias("y")))


def _fragments(groups: DataFrame, total: int, task_work: int) -> DataFrame:
    """Tasks of groups (key, fp, t, comp): each pair of classes that isn't connected yet meets in one, by fragments of bounded work.

    Groups of one component are done. The classes of the largest component meet those outside it only.
    """
    each = groups.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("t").alias("t"))
    stats = each.groupBy("key").agg(F.sum("c").alias("_n"), F.max(F.struct("t", "c", "comp")).alias("big"), F.sum("t").alias("t"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    cuts = lambda c, t: F.greatest(F.ceil(F.sqrt(4.0 * c * t / task_work)), F.ceil(2.0 * t / OWNED), F.lit(1)).cast("int")
    stats = stats.select("key", "_n", F.col("big.comp").alias("main"), cuts(F.col("_n") - F.col("big.c"), F.col("t") - F.col("big.t")).alias("inner"), cuts(F.col("big.c"), F.col("big.t")).alias("outer"))
    rows = keyed(groups, stats, "key", total)
    hashed = F.xxhash64("fp", F.lit(1))
    rows = rows.withColumn("part", F.when(F.col("comp") == F.col("main"), F.col("inner") + F.pmod(hashed, F.col("outer"))).otherwise(F.pmod(hashed, F.col("inner"))).cast("int"))
    rows = rows.select("key", "fp", "comp", "part", F.inline(_mates(F.col("part"), F.col("inner"), F.col("outer"))))
    return rows.select("key", "x", "y", F.when(F.col("x") == F.col("y"), -1).otherwise(F.col("part")).alias("part"), F.col("comp").alias("grouped"), "fp")


def _large_blocks(big: DataFrame, lists: DataFrame, survivors: DataFrame, total: int, percent: int, task_work: int, n: int) -> DataFrame:
    """Links within large blocks; ``big`` has block, fp, t and the block's _n and block_t, ``lists`` has token, band and fp of prefixes."""
    chunks = F.ceil(F.col("block_t") * SEEDS / task_work).cast("int")
    seed = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("block_n")) < SEEDS
    chunk = F.when(seed, F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(F.pmod(F.xxhash64("fp"), chunks).cast("int")))
    first = big.select(F.col("block").alias("key"), F.explode(chunk).alias("x"), F.lit(-1).alias("y"), F.when(seed, -1).otherwise(0).alias("part"), F.col("fp").alias("grouped"), "fp")
    found = cut(_links(first, survivors, percent, n))
    comp = components(found).withColumnRenamed("node", "fp").withColumnRenamed("root", "comp")
    big = cut(big.join(comp, "fp", "left").withColumn("comp", F.coalesce("comp", "fp")))
    of_list = lists.join(big, "fp").select("block", F.explode(F.transform(F.array("band", F.col("band") - 1), lambda b: F.xxhash64("token", b))).alias("key"), "fp", "t", "comp").distinct()
    # what there is to merge in lists with something to find, against the block as a whole
    by_list = of_list.groupBy("block", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("t").alias("t"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    by_list = by_list.groupBy("block").agg(F.sum(F.col("c") * F.col("t")).alias("work"))
    whole = big.groupBy("block").agg(F.count(F.lit(1)).alias("_n"), F.sum("t").alias("t"))
    listwise = whole.join(by_list, "block", "left").select("block", "_n", (F.coalesce("work", F.lit(0)) < F.col("_n") * F.col("t")).alias("listwise"))
    as_lists = keyed(of_list, listwise, "block", total).where("listwise").select("key", "fp", "t", "comp")
    as_blocks = keyed(big.select("block", "fp", "t", "comp"), listwise, "block", total).where("not listwise").select(F.col("block").alias("key"), "fp", "t", "comp")
    groups = cut(as_lists.unionByName(as_blocks))
    return found.unionByName(_links(_fragments(groups, total, task_work), survivors, percent, n))


def _candidates(lists: DataFrame, total: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect all classes that share a prefix token and have sizes that allow a link; ``lists`` has token, band, fp, n."""
    heads = lists.groupBy("token", "band").agg(F.min(F.struct("n", "fp")).alias("head"), F.max("n").alias("most"), F.count(F.lit(1)).alias("_n"))
    heads = cut(heads.select("token", "band", F.col("head.fp").alias("head"), F.col("head.n").alias("least"), "most", "_n"))
    within = keyed(lists.select("token", "band", "fp"), heads.where("_n > 1").select("token", "band", "head", "_n"), ["token", "band"], total).select(F.col("head").alias("a"), F.col("fp").alias("b"))
    above = heads.select("token", (F.col("band") - 1).alias("band"), F.col("head").alias("b"), F.col("least").alias("least_b"))
    across = heads.join(above, ["token", "band"]).where(100 * F.col("most") >= percent * F.col("least_b")).select(F.col("head").alias("a"), "b")
    return within.unionByName(across)


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, task_work: int = 200_000_000) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    body = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    first = cut(_digest_pass(body, k))
    rows = first.where("not hot").select("id", "n", "fp")
    size = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n")).first()
    # at most HOT times the mean size of a set, and POPULAR sets
    hot = sorted((r["t"] & (2**64 - 1), r["c"]) for r in first.where("hot").groupBy(F.col("fp").alias("t")).agg(F.sum("n").alias("c")).where(F.col("c") >= max(50, size["docs"] // HOT)).collect())
    often = rows.where("n > 0").groupBy("fp").agg(F.count(F.lit(1)).alias("c"), F.min(F.xxhash64("id")).alias("r")).where(F.col("c") > max(64, size["docs"] // POPULAR))
    often = sorted((r["fp"], r["r"]) for r in often.collect())
    tokens, ranks = np.array([t for t, _ in hot], np.uint64), np.array([256 + c for _, c in hot], np.int64)
    popular = np.array([x for x, _ in often], np.int64), np.array([x for _, x in often], np.int64)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    homes = max(parts, -(-int(size["n"] or 0) // OWNED))
    owners = Owners(homes)

    dealt = _deal(body.select(F.xxhash64("_id").alias("_rid"), "_text"), k, owners, homes, tokens, popular).repartitionById(homes, F.col("key") % homes).sortWithinPartitions("key")
    answered = _owned(dealt, owners, homes)
    survivors = cut(answered.repartitionById(homes, F.col("key") % homes).sortWithinPartitions("key").mapInArrow(_home(shipped(spark, (tokens, ranks)), owners, percent), "fp long, n long, p int, tokens array<bigint>"))

    band = F.floor(F.log("n") / math.log(100 / percent * 1.000001)).cast("int")  # sizes that allow a link lie in one band or in neighbours
    lists = survivors.select(F.explode(F.slice("tokens", F.lit(1), F.col("p"))).alias("token"), band.alias("band"), "fp", "n")
    count = survivors.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("p"), F.lit(0)).alias("entries"), F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("tokens")).first()
    n = max(parts, -(-count["tokens"] // OWNED))
    blocks = components(_candidates(lists, count["entries"], percent))
    member = cut(survivors.select("fp", F.size("tokens").alias("t")).join(blocks.withColumnRenamed("node", "fp").withColumnRenamed("root", "block"), "fp"))
    stats = member.groupBy("block").agg(F.count(F.lit(1)).alias("_n"), F.sum("t").alias("block_t")).withColumn("block_n", F.col("_n"))
    member = cut(keyed(member, stats, "block", count["classes"]))
    large = (F.col("block_n") * F.col("block_t") > task_work) & (F.col("block_n") > 2)
    whole = member.where(~large).select(F.col("block").alias("key"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(-1).alias("part"), F.col("fp").alias("grouped"), "fp")
    links, big = _links(whole, survivors, percent, n), member.where(large)
    if not big.isEmpty():
        links = links.unionByName(_large_blocks(big, lists.select("token", "band", "fp"), survivors, count["entries"], percent, task_work, n))
    linked = components(links)

    sets = rows.where("n > 0").groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    roots = cut(sets.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    named = cut(keyed(roots.select("fp", "root", "copies"), least, "root", size["docs"]).select("fp", "component_id", F.col("copies").alias("_n")))
    out = keyed(rows.where("n > 0"), named, "fp", size["docs"]).unionByName(rows.where("n = 0").withColumn("component_id", F.lit(None).cast(docs.schema[id_col].dataType)))
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
