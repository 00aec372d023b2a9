"""WARC archives with a two-level capture index.

``write`` makes one WARC/1.1 record a row, each its own gzip member: a response with the
payload or, for every payload but the first of equal ones (smallest id), a revisit that names the
first. Each task writes archives of its own under a fresh name and reports its records
once the file is closed, so files of lost or repeated tasks are never referred to.

``index`` sorts the records by reversed-host URL key and capture, writes each range
partition's lines as gzip blocks of ``block_lines`` lines into one file, and keeps of each block
its first key, place and length: the sparse directory, one small file a partition. A
manifest names the partitions' first and last keys. ``captures`` finds keys by binary searches in the manifest, then,
partition by partition, in its directory and in the one or few blocks that can have the key; ``payloads`` reads
the found ranges of the archives, neighbouring ones at once. ``read`` and ``lookup`` are the two
in turn, for the keys of all pages or of some URLs.

A payload that many pages share is told of by a broadcast (see ``keyed``), so its pages stay where
they are; the captures of one key are found in as many tasks as partitions hold them.
Files go through pyarrow's file systems, under the shared folder of the cluster.

Defined cases: a null html is an empty payload; equal payloads of at least
``least_bytes`` bytes share one response (smallest id, then smallest URL); null URLs have the
empty key and come last among equal ids; null ids come last among equal payloads; repeated rows are
records of their own, the first a response if any is; tabs and line ends in keys are blanks;
an empty table makes an empty index; other columns aren't read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import cut, keyed, shared_dir

BLOCK_LINES = 3000
ARCHIVE_BYTES = 512 << 20
#: Ranges of one archive nearer than this are read as one; at most READ_BYTES at once.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Revisits of rows that are equal in everything, written by one row of a task.
RUN = 10_000
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
_RECORDS = "id long, url string, key string, file string, offset long, length long"


@dataclass(frozen=True)
class Index:
    """Where the parts of an index are; parts.parquet in ``root`` is the manifest."""

    root: str


def surt(url: str | None) -> str:
    """Reversed-host key: 'https://www.a.b.com:443/x?y#z' is 'com,b,a)/x?y'."""
    m = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)", url or "")
    if not m:
        return (url or "").lower()
    host = m[1].lower().removeprefix("www.")
    port = f":{m[2]}" if m[2] and m[2] not in ("80", "443") else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (m[3] if m[3].startswith("/") else "/" + m[3]).lower()


def key_of(url: str | None) -> str:
    """The key under which the index has a URL."""
    return re.sub(r"[\t\n\r]", " ", surt(url))


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if re.match(r"^[a-z0-9]+:", root) else f"file://{root}")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, sha: str, size: int, twin: bool = False, refers_to=None) -> bytes:
    """The bytes of one record: a response, or for a ``twin`` a revisit of the page ``refers_to`` (its payload isn't needed). ``sha`` is hexadecimal."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if twin else http + payload
    head = {
        "WARC-Type": "revisit" if twin else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\r\n]", "", url or ""),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(sha)).decode()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(body),
        "WARC-Page-ID": "" if page_id is None else page_id,
        "WARC-Payload-Length": size,
    }
    if twin:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To-Page-ID": "" if refers_to is None else refers_to}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return text.encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def roles(pages: DataFrame, least_bytes: int, id_col: str, url: str, html: str) -> DataFrame:
    """(id, url, body, sha, bytes, twin, first): a response with its body, or for a ``twin`` the id of the response, without a body."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("sha", F.sha1("body")).withColumn("bytes", F.octet_length("body"))
    each = cut(rows.where(F.col("bytes") >= least_bytes).groupBy("sha", "id", "url").agg(F.count(F.lit(1)).alias("copies")))
    total = each.agg(F.sum("copies")).first()[0] or 0
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("url").isNull().alias("no_url"), "url", "copies")
    first = each.groupBy("sha").agg(F.min(order).alias("f"), F.sum("copies").alias("_n")).where("_n > 1").select("sha", "f", "_n")
    told = keyed(rows, first, "sha", total, "left").withColumn("equal", F.col("f").isNotNull() & (F.col("bytes") >= least_bytes))
    is_first = F.col("id").eqNullSafe(F.col("f.id")) & F.col("url").eqNullSafe(F.col("f.url"))
    again = F.col("equal") & is_first & (F.col("f.copies") > 1)
    named = lambda df, twin: df.select("id", "url", F.when(~twin, F.col("body")).alias("body"), "sha", "bytes", twin.alias("twin"), F.when(twin, F.col("first")).alias("first"))
    told = told.withColumn("first", F.col("f.id"))
    out = named(told.where(~again), F.col("equal") & ~is_first)
    if first.where("f.copies > 1").isEmpty():
        return out
    # rows that are equal in everything: one of them is the response, the others are counted and written from the count
    one = told.where(again).groupBy("sha", "id", "url").agg(F.first("body").alias("body"), F.first("bytes").alias("bytes"), F.first("first").alias("first"), F.count(F.lit(1)).alias("copies"))
    runs = one.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))))
    runs = runs.withColumn("body", F.when(F.col("run") == 0, F.col("body"))).repartition("sha", "run")
    ks = F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("copies")) - 1)
    return out.unionByName(named(runs.withColumn("k", F.explode(ks)), F.col("k") > 0))


def write(pages: DataFrame, root: str, least_bytes: int = 0, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives; the checkpointed records (id, url, key, file, offset, length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(root)
        out, name, place, done = None, "", 0, []

        def flush() -> pa.RecordBatch:
            out.close()
            got = pa.RecordBatch.from_pylist(done, pa.schema([("id", pa.int64()), ("url", pa.string()), ("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
            done.clear()
            return got

        for b in batches:
            for i, u, body, sha, size, twin, first in zip(*(b.column(c).to_pylist() for c in ("id", "url", "body", "sha", "bytes", "twin", "first")), strict=True):
                if out is None:
                    name, place = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                data = gzip.compress(record(i, u, body, sha, size, twin, first), LEVEL, mtime=0)
                out.write(data)
                done.append({"id": i, "url": u, "key": key_of(u), "file": name, "offset": place, "length": len(data)})
                place += len(data)
                if place >= ARCHIVE_BYTES:
                    yield flush()
                    out = None
        if out is not None:
            yield flush()

    system, path = _opened(root)
    system.create_dir(path, recursive=True)
    return cut(roles(pages, least_bytes, id_col, url, html).mapInArrow(run, _RECORDS))


def index(records: DataFrame, root: str, block_lines: int = BLOCK_LINES, parts: int | None = None) -> Index:
    """Sort the records by key, write blocks and directories, and the manifest of parts."""
    n = parts or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "id", "file", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(root)
        name, place, directory, lines, out, key = uuid.uuid4().hex, 0, [], [], None, ""

        def block() -> None:
            nonlocal place, out
            if out is None:
                out = system.open_output_stream(f"{path}/{name}.cdx.gz", compression=None)
            data = gzip.compress("".join(lines).encode("utf-8", "surrogatepass"), LEVEL, mtime=0)
            out.write(data)
            directory.append([lines[0].split("\t", 1)[0], place, len(data), len(lines)])
            place += len(data)
            lines.clear()

        for b in batches:
            for key, i, file, offset, length in zip(*(b.column(c).to_pylist() for c in (*order, "length")), strict=True):
                lines.append(key + "\t" + json.dumps([i, file, offset, length]) + "\n")
                if len(lines) == block_lines:
                    block()
        if lines:
            block()
        if out is not None:
            out.close()
            with system.open_output_stream(f"{path}/{name}.idx", compression=None) as f:
                f.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "last": [key], "part": [name], "blocks": [len(directory)], "records": [sum(d[3] for d in directory)]})

    made = records.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*order, "length").mapInArrow(run, "first string, last string, part string, blocks long, records long")
    made.write.mode("overwrite").parquet(f"{root}/parts.parquet")
    return Index(root)


def _directory(system: fs.FileSystem, path: str, part: str) -> list[list]:
    with system.open_input_stream(f"{path}/{part}.idx", compression=None) as f:
        return json.loads(f.read())


def _block(f, entry: list) -> list[tuple[str, list]]:
    """Lines of the block of one directory entry, by a range read."""
    f.seek(entry[1])
    text = gzip.decompress(f.read(entry[2])).decode("utf-8", "surrogatepass")
    return [(k, json.loads(v)) for k, v in (x.split("\t", 1) for x in text.split("\n")[:-1])]


def _keys(urls: DataFrame, url: str) -> DataFrame:
    """(url, key) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([key_of(u) for u in given], pa.string())], ["url", "key"])

    return urls.select(F.col(url).cast("string").alias("url")).mapInArrow(run, "url string, key string")


def captures(spark, at: Index, keys: DataFrame) -> DataFrame:
    """(key, id, file, offset, length) of every capture of each of the distinct ``keys``, by binary searches in manifest, directories and blocks."""
    parts = sorted(tuple(r) for r in spark.read.parquet(f"{at.root}/parts.parquet").select("first", "last", "part").collect())  # one entry a partition of the index
    held, root = spark.sparkContext.broadcast(parts), at.root
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = [x[0] for x in held.value], [x[1] for x in held.value]
        for b in batches:
            given = b.column(0).to_pylist()
            spans = [range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k)) for k in given]
            yield pa.RecordBatch.from_arrays([pa.array([p for s in spans for p in s], pa.int32()), pa.array([k for k, s in zip(given, spans, strict=True) for _ in s], pa.string())], ["part", "key"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(root)
        part, block, f, directory, firsts, lines, names = None, None, None, [], [], [], []
        for b in batches:
            got = []
            for p, key in zip(b.column("part").to_pylist(), b.column("key").to_pylist(), strict=True):
                if p != part:  # sorted: each directory is read once
                    part, block = p, None
                    if f is not None:
                        f.close()
                    f = system.open_input_file(f"{path}/{held.value[p][2]}.cdx.gz")
                    directory = _directory(system, path, held.value[p][2])
                    firsts = [d[0] for d in directory]
                for e in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
                    if e != block:
                        block, lines = e, _block(f, directory[e])
                        names = [k for k, _ in lines]
                    for i in range(bisect.bisect_left(names, key), bisect.bisect_right(names, key)):
                        got.append((key, *lines[i][1]))
                    if len(got) >= BLOCK_LINES:
                        yield _batch(got)
                        got = []
            if got:
                yield _batch(got)
        if f is not None:
            f.close()

    wanted = keys.mapInArrow(placed, "part int, key string").repartition(n, "part").sortWithinPartitions("part", "key")
    return wanted.mapInArrow(found, "key string, id long, file string, offset long, length long")


_CAPTURE = pa.schema([("key", pa.string()), ("id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _CAPTURE, strict=True)], schema=_CAPTURE)


def payloads(spark, at: Index, found: DataFrame) -> DataFrame:
    """Captures read by their ranges: (key, id, payload_bytes, payload_digest, record_type, refers_to, payload)."""
    root = at.root
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(root)
        kept = pa.schema([("key", pa.string()), ("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for file, run in _runs(batches):
            with system.open_input_file(f"{path}/{file}") as f:
                start = run[0][0]
                f.seek(start)
                data = f.read(run[-1][0] + run[-1][1] - start)
            out = []
            for offset, length, key in run:
                head, payload = parse(gzip.decompress(data[offset - start : offset - start + length]))
                name, kind = head["WARC-Page-ID"], head["WARC-Type"]
                want = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and digest(payload) != want:
                    raise ValueError(f"record at {offset} of {file} is damaged")
                to = head.get("WARC-Refers-To-Page-ID")
                out.append({"key": key, "id": int(name) if name else None, "payload_bytes": int(head["WARC-Payload-Length"]), "payload_digest": want, "record_type": kind, "refers_to": int(to) if to else None, "payload": payload if kind == "response" else None})
            yield pa.RecordBatch.from_pylist(out, schema=kept)

    spread = F.floor(F.col("offset") / (4 * READ_BYTES))
    lines = found.repartition(n, "file", spread).sortWithinPartitions("file", "offset")
    return lines.mapInArrow(ranges, "key string, id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def read(spark, at: Index, pages: DataFrame, url: str = "url") -> DataFrame:
    """Every record of the URLs of ``pages``, by way of the index."""
    return payloads(spark, at, captures(spark, at, _keys(pages, url).select("key").distinct()))


def lookup(spark, at: Index, urls: DataFrame, url: str = "url") -> DataFrame:
    """(url, id, payload, record_type) of every capture of each URL."""
    asked = _keys(urls.where(F.col(url).isNotNull()).select(url).distinct(), url)
    return asked.join(payloads(spark, at, captures(spark, at, asked.select("key").distinct())), "key").select("url", "id", "payload", "record_type")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """Neighbouring records (offset, length, key) of an archive, as ranges to read at once."""
    file, run = None, []
    for b in batches:
        for f, offset, length, key in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "key")), strict=True):
            if run and (f != file or offset - run[-1][0] - run[-1][1] > GAP_BYTES or offset + length - run[0][0] > READ_BYTES):
                yield file, run
                run = []
            file = f
            run.append((offset, length, key))
    if run:
        yield file, run


def archive(pages: DataFrame, root: str | None = None, **settings) -> Index:
    """Write archives and index of ``pages`` into a fresh folder of the shared one."""
    root = root or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return index(write(pages, root, **settings), root)
