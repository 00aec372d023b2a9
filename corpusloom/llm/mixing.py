"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (DataFrame functions only).

Sources in code point order (null last) weigh 5, 2, 1 in turn and share ``budget`` times
all words in proportion; a target stops at ``most`` times its source's size and the
excess goes to the others by weight (the water level is found in closed form from sorted
cap-to-weight ratios). A source's documents fall by keyed hash into up to ``max_blocks``
blocks. Its exact quota is the whole passes over all blocks that fit in the target, then
blocks in a keyed random order until the words are met; the last block, and in it the
last document, is taken in part. The tree then halves the set of output shards again and
again: each node hands its left half an exact number of block draws from each source,
drawn multivariate-hypergeometrically (source by source, by inverse distribution function
at a keyed uniform). A leaf's draws are the next, hence disjoint, run of its sources'
permuted blocks. Each shard is cut into files by a keyed hash of about ``FILE_ROWS`` draws, and
``shards`` shuffles every file locally: its draws lie in the order of that hash.

Only (id, source, size) rows move, by source and block and then by shard and file; the block and source tables
are small against them (at most ``max_blocks`` rows a source), so a hot source is spread
over its blocks. The tree holds a number per source in a row, and sources are ranked in one task:
their number is bounded by memory, some millions.

Defined cases: null text has size 0; a document of size 0 is taken with 0 words; null is
a source of its own; repeated rows are documents of their own (which of equal rows is cut
doesn't show); an empty table gives no rows; extra columns travel only if named.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.tables import cut, let

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Draws in a file of a shard, about.
FILE_ROWS = 250_000


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, sid, target) of every source of ``sized`` (source, size)."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by = by.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    by = by.withColumn("weight", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), F.pmod("sid", F.lit(len(weights))) + 1))
    by = by.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = W.orderBy("ratio", "sid")
    whole = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    by = by.withColumn("left", budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    by = by.withColumn("open", F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
    by = by.withColumn("at", F.row_number().over(order)).withColumn("level", F.col("left") / F.col("open"))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(whole)
    by = by.withColumn("found", first)
    share = F.least(F.col("weight") * F.col("found.level"), F.col("cap"))
    return by.select("source", "source_size", "n_docs", "sid", F.when(F.col("found").isNull(), F.col("cap")).otherwise(share).alias("target"))


def uniform(*keys: Column) -> Column:
    """A number in (0, 1) that depends on the keys alone."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52)


def _log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series at k + 9."""
    z = k + 9.0
    low = F.lit(0.0)
    for j in range(1, 9):
        low = low + F.log(k + float(j))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) - low


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """The number of good ones among ``drawn`` of ``total``, as the u-quantile; the sum runs 12 deviations about the mean."""
    mean = drawn * good / F.greatest(total, F.lit(1.0))
    width = 12 * F.sqrt(F.greatest(mean * (1 - good / F.greatest(total, F.lit(1.0))), F.lit(1.0))) + 3
    low = F.greatest(F.lit(0.0), drawn - (total - good), F.floor(mean - width).cast("double"))
    high = F.least(good, drawn, F.ceil(mean + width).cast("double"))

    def weight(x: Column) -> Column:
        return F.exp(-_log_factorial(x) - _log_factorial(good - x) - _log_factorial(drawn - x) - _log_factorial(total - good - drawn + x) + peak(mean))

    def peak(x: Column) -> Column:  # keeps the weights near 1
        return _log_factorial(x) + _log_factorial(good - x) + _log_factorial(drawn - x) + _log_factorial(F.greatest(total - good - drawn + x, F.lit(0.0)))

    xs = F.transform(F.sequence(low.cast("long"), F.greatest(low, high).cast("long")), lambda x: x.cast("double"))
    pairs = let(xs, lambda a: F.transform(a, lambda x: F.struct(x.alias("x"), weight(x).alias("w"))))

    def search(p: Column) -> Column:
        mass = F.aggregate(p, F.lit(0.0), lambda acc, e: acc + e["w"])
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1.0).alias("x"))
        return let(
            mass * u,
            lambda goal: F.aggregate(p, start, lambda acc, e: F.when(acc["x"] >= 0, acc).otherwise(F.struct((acc["sum"] + e["w"]).alias("sum"), F.when(acc["sum"] + e["w"] >= goal, e["x"]).otherwise(F.lit(-1.0)).alias("x"))), lambda acc: F.when(acc["x"] >= 0, acc["x"]).otherwise(high)),
        )

    return F.when(low >= high, low).otherwise(let(pairs, search))


def _side(k: int, quota) -> Column:
    """A child node: its number and its quotas."""
    return F.struct((F.col("node") * 2 + k).alias("node"), F.zip_with("s", "l", lambda e, v: F.struct(e["sid"].alias("sid"), quota(e, v).alias("q"))).alias("s"))


def splitting_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(sid, bounds): for each source the ends, shard by shard, of its runs of draws; from (sid, quota)."""
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col("sid").cast("long").alias("sid"), F.col("quota").cast("double").alias("q")))).alias("s")).withColumn("node", F.lit(1).cast("long"))
    zero = F.lit(0.0)
    kind = "struct<total:double,drawn:double,left:array<double>>"
    for _ in range(levels):
        total = F.aggregate("s", zero, lambda a, e: a + e["q"])

        def draw(acc: Column, e: Column) -> Column:
            x = hypergeometric(acc["total"], e["q"], acc["drawn"], uniform(F.lit(seed), F.col("node"), e["sid"]))
            return let(x, lambda v: F.struct((acc["total"] - e["q"]).alias("total"), (acc["drawn"] - v).alias("drawn"), F.concat(acc["left"], F.array(v)).alias("left")).cast(kind))

        start = F.struct(total.alias("total"), F.floor(total / 2).cast("double").alias("drawn"), F.array().cast("array<double>").alias("left")).cast(kind)
        node = cut(node.withColumn("l", F.aggregate("s", start, draw, lambda acc: acc["left"])))
        sides = F.array(_side(0, lambda e, v: v), _side(1, lambda e, v: e["q"] - v))
        node = node.select(F.inline(sides))
    leaf = node.select(F.col("node"), F.inline("s"))
    w = W.partitionBy("sid").orderBy("node")
    return leaf.withColumn("end", F.sum("q").over(w)).groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "end"))), lambda e: e["end"].cast("long")).alias("bounds"))


def mix(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0, levels: int = 3, max_blocks: int = 4096, block_docs: int = 64, seed: int = 11) -> DataFrame:
    """Every row with ``columns``, a number _row, size, source, source_size, target, taken and draws (epoch, shard, file, words, place)."""
    names = {c: f"_c{i}" for i, c in enumerate(columns)}
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = cut(docs.select(*(F.col(c).alias(n) for c, n in names.items()), F.xxhash64(F.lit(seed), F.col(id_col)).alias("key"), F.col(source).cast("string").alias("source"), size.alias("size"), F.monotonically_increasing_id().alias("_row")))
    src = targets(sized, weights, budget, most)
    src = src.withColumn("blocks", F.least(F.greatest(F.ceil(F.col("n_docs") / block_docs), F.lit(1)), F.lit(max_blocks)))
    src = cut(src.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")))
    files = max(1, -(-int((src.agg(F.sum("n_docs")).first()[0] or 0) * most) // (FILE_ROWS << levels)))
    placed = sized.join(src.withColumnRenamed("source", "_source"), sized["source"].eqNullSafe(F.col("_source"))).drop("_source").withColumn("block", F.pmod(F.col("key"), F.col("blocks")))

    block = placed.groupBy("sid", "block").agg(F.sum("size").alias("words"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
    block = block.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    turn = W.partitionBy("sid", "epoch").orderBy(F.xxhash64(F.lit(seed), "sid", "epoch", "block"), "block")
    block = block.withColumn("rank", F.row_number().over(turn)).withColumn("before", F.sum("words").over(turn.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("words"))
    last = F.col("epoch") == F.col("passes")
    block = block.withColumn("part", F.when(last, F.greatest(F.least(F.col("rest") - F.col("before"), F.col("words")), F.lit(0))).otherwise(F.col("words")))
    block = cut(block.where(~last | (F.col("part") > 0)).withColumn("draw", F.row_number().over(W.partitionBy("sid").orderBy("epoch", "rank")) - 1))
    bounds = splitting_tree(block.groupBy("sid").agg(F.count(F.lit(1)).alias("quota")), levels, seed)
    drawn = block.join(bounds, "sid").withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("draw"))))
    drawn = drawn.groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "part"))).alias("of_block"))

    inside = W.partitionBy("sid", "block").orderBy("key", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = placed.withColumn("before", F.sum("size").over(inside) - F.col("size")).join(drawn, ["sid", "block"], "left")
    words = lambda d: F.greatest(F.least(d["part"] - F.col("before"), F.col("size")), F.lit(0))
    draws = F.transform(F.coalesce("of_block", F.array().cast("array<struct<epoch:bigint,shard:int,part:bigint>>")), lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), words(d).alias("words"), F.xxhash64(F.lit(seed), d["shard"], d["epoch"], F.col("key")).alias("place")))
    draws = F.transform(draws, lambda d: d.withField("file", F.pmod(F.xxhash64(d["place"], F.lit(seed)), F.lit(files)).cast("int")))
    draws = F.filter(draws, lambda d: (d["words"] > 0) | (F.col("size") == 0))
    rows = rows.withColumn("draws", draws).withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
    return rows.select(*(F.col(n).alias(c) for c, n in names.items()), "_row", "size", "source_size", "target", "taken", "draws")


def shards(mixed: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each draw with its rank in its file: dealt by shard and file, in the file's local order; ready for write.partitionBy('shard')."""
    rows = mixed.select(*columns, "_row", F.inline("draws"))
    rank = F.row_number().over(W.partitionBy("shard", "file").orderBy("place", "epoch", "_row"))
    return rows.withColumn("rank", rank)


def digest(mixed: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with ``columns``, size, source_size, target, the words that its draws take in the shards, and where these lie (shard, file, rank)."""
    names = {c: f"_c{i}" for i, c in enumerate(columns)}
    mixed = cut(mixed.select(*(F.col(c).alias(n) for c, n in names.items()), "_row", "size", "source_size", "target", "draws"))
    laid = shards(mixed, ()).groupBy("_row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.struct("shard", "file", "rank"))).alias("places"))  # at most one draw a pass
    out = mixed.drop("draws").join(laid, "_row", "left")
    none = F.array().cast("array<struct<shard:int,file:int,rank:int>>")
    return out.select(*(F.col(n).alias(c) for c, n in names.items()), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("places", none).alias("places"))
