"""URL filters by a temporal list join.

Lists are dated entries (list, kind, value, action, at): ``add`` puts a value on a list from
``at`` on, ``remove`` takes it off. Per (list, kind, value) they become validity intervals
[valid_from, valid_to), and every capture is judged against those that hold at its fetch
time. Kinds: ``host`` (the host itself), ``domain`` (the host or any host below it), ``prefix``
(host and path, up to a slash). A capture asks for each key its URL has that is no deeper than some
entry; the as-of join is by key, time bucket and salt. Buckets are a ``buckets``-th of the time that the captures span,
whatever its unit, so an entry that came and went a thousand times meets each capture in one
bucket only, and one that stands is in ``buckets`` of them. A key that many captures share is
dealt over as many salts as it needs (at most 2,000 such keys are broadcast, with the number), and
lists of any size are joined by shuffle (Spark broadcasts one only under its size limit).

Defined cases: null URL or fetch time: nothing is active; of actions at the same time the
removal wins; a removal of what isn't listed, or a second addition, changes nothing;
entries with a null part are ignored; repeated captures are judged each; empty tables give
no rows, or verdicts without lists; other columns aren't read. ``at`` is a whole number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.tables import cut

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, valid_from, valid_to) of dated entries; valid_to is null while an entry stands."""
    e = entries.select("list", "kind", F.lower("value").alias("value"), "action", F.col("at").cast("long").alias("at")).dropna()
    e = e.groupBy("list", "kind", "value", "at").agg((F.max((F.col("action") == "remove").cast("int")) == 0).alias("on"))
    by = W.partitionBy("list", "kind", "value").orderBy("at")
    e = e.withColumn("was", F.coalesce(F.lag("on").over(by), F.lit(False))).where("on <> was")  # changes only
    return e.withColumn("valid_to", F.lead("at").over(by)).where("on").select("list", "kind", "value", F.col("at").alias("valid_from"), "valid_to")


def keys(url: Column, labels: int = 128, slashes: int = 1000) -> Column:
    """All (kind, value) that an entry of at most so many labels or slashes could list this URL by."""
    h = host(url)
    names = F.split(h, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(max(1, labels)))), lambda i: F.array_join(F.slice(names, -i, i), "."))
    steps = F.split(F.lower(F.regexp_extract(url, PATH, 1)), "/", slashes + 1)
    paths = F.when(F.size(steps) > 1, F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.concat(h, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))))
    kind = lambda k, a: F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda v: F.struct(F.lit(k).alias("kind"), v.alias("value")))
    parts = [kind("host", F.array(h))] + [kind("domain", domains)] * (labels > 0) + [kind("prefix", paths)] * (slashes > 0)
    return F.when(h != "", F.concat(*parts))


def evaluate(captures: DataFrame, entries: DataFrame, columns: tuple[str, ...] = ("page_id",), url: str = "url", at: str = "fetched_at", buckets: int = 32) -> DataFrame:
    """``columns`` and the fetch time of every capture, with lists (sorted, distinct) and blocked."""
    names = {c: f"_c{i}" for i, c in enumerate(columns)}
    rows = cut(captures.select(*(F.col(c).alias(n) for c, n in names.items()), F.col(url).cast("string").alias("_url"), F.col(at).cast("long").alias("_at")).withColumn("_row", F.monotonically_increasing_id()))
    span = rows.agg(F.min("_at").alias("a"), F.max("_at").alias("b")).first()
    lo, hi = (span["a"] or 0), (span["b"] or 0)
    width = max(1, -(-(hi - lo + 1) // buckets))
    v = cut(intervals(entries).where((F.col("valid_from") <= hi) & F.coalesce(F.col("valid_to") > lo, F.lit(True))))
    deep = v.agg(F.max(F.when(F.col("kind") == "domain", F.size(F.split("value", r"\.")))).alias("labels"), F.max(F.when(F.col("kind") == "prefix", F.regexp_count("value", F.lit("/")))).alias("slashes")).first()
    part = lambda x: F.floor((x - lo) / width)
    asked = rows.where("_url is not null and _at is not null").select("_row", "_at", F.explode(keys(F.col("_url"), deep["labels"] or 0, deep["slashes"] or 0)).alias("k"))
    asked = asked.select("_row", "_at", "k.kind", "k.value", part(F.col("_at")).alias("_bucket"))
    counts = asked.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    most = max(200, (asked.count() if deep["labels"] or deep["slashes"] else rows.count()) // 2000)
    hot = F.broadcast(counts.where(F.col("n") > most).select("kind", "value", F.ceil(F.col("n") / most).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    asked = asked.join(hot, ["kind", "value"], "left").withColumn("_salt", F.pmod(F.xxhash64("_row"), salts).cast("int"))
    v = v.withColumn("_bucket", F.explode(F.sequence(part(F.greatest("valid_from", F.lit(lo))), part(F.least(F.coalesce("valid_to", F.lit(hi)), F.lit(hi))))))
    v = v.join(hot, ["kind", "value"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    hits = asked.join(v.drop("_salts"), ["kind", "value", "_bucket", "_salt"]).where((F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))))
    lists = hits.groupBy("_row").agg(F.array_sort(F.collect_set("list")).alias("lists"))  # at most one of each list
    out = rows.join(lists, "_row", "left").withColumn("lists", F.coalesce("lists", F.array().cast("array<string>")))
    return out.select(*(F.col(n).alias(c) for c, n in names.items()), F.col("_at").alias(at), "lists", (F.size("lists") > 0).alias("blocked"))
