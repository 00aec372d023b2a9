"""The thin queries ``opN_<name>`` over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, hostrules, jaccard, langid, mixing, pii, quality, toxicity, urlfilter, warc
from corpusloom.llm.learning import remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged(scored: DataFrame, held_out, threshold: float) -> DataFrame:
    """The digest of a classifier: doc_id, held_out, score, predicted."""
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op5_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.train(docs, labels, where=lambda i: remainder(i, 3) != 1)
    return judged(toxicity.score(docs, weights), remainder(F.col("doc_id"), 3) == 1, 0.7)


@query
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels, where=lambda i: remainder(i, 5) != 0)
    return judged(quality.score(docs, machine), remainder(F.col("doc_id"), 5) == 0, 0.3)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, where=lambda i: remainder(i, 4) != 2)
    return langid.predict(docs, model).select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found, "doc_id")


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


@query
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hostrules.judge(hostrules.measured(table(spark, sf_dir, "documents")), hostrules.base_failed())
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: Stands where the session names no key in spark.corpusloom.pii.key: reruns agree, but what it makes must not be published.
PII_TEST_KEY = "corpusloom test key"


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get("spark.corpusloom.pii.key", PII_TEST_KEY)


@query
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.replace(table(spark, sf_dir, "documents"), pii_key(spark))
    rows = rows.withColumn("kinds", F.transform(pii.entities(), lambda e: e["kind"]))
    return rows.select("doc_id", "text", F.size("kinds").alias("n_entities"), F.array_sort(F.array_distinct("kinds")).alias("kinds"))


@query
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.read(spark, warc.archive(pages), pages).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _hex(i: int):
    """The i-th hexadecimal digit of the md5 of the value, as a number."""
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.col("value").cast("binary")), i, 1)) - 1


def list_entries(pages: DataFrame) -> DataFrame:
    """The dated lists of the query: no table has any, so hosts, domains and paths of the pages get entries by their md5.

    A value is listed if its first digit is below 8, from day 16 d2 + d3 on; if d4 < 12 it is
    removed 10 (d5 + 1) days later, and if also d6 < 6 listed again 30 days after that.
    """
    hosts = pages.select(urlfilter.host(F.col("url")).alias("value")).where("value <> ''").distinct()
    domains = hosts.select(F.regexp_extract("value", r"([^.]+\.[^.]+)$", 1).alias("value")).where("value <> ''").distinct()
    paths = hosts.select(F.concat("value", F.lit("/en/")).alias("value"))
    named = [x.select(F.lit(n).alias("list"), F.lit(k).alias("kind"), "value") for n, k, x in (("spam", "host", hosts), ("adult", "domain", domains), ("mirror", "prefix", paths))]
    rows = named[0].unionByName(named[1]).unionByName(named[2]).where(_hex(1) < 8)
    on = (_hex(2) * 16 + _hex(3)) * 1440
    off = on + (_hex(5) + 1) * 14400
    back = off + 43200
    event = lambda a, at, when: F.when(when, F.struct(F.lit(a).alias("action"), at.cast("long").alias("at")))
    events = F.array(event("add", on, F.lit(True)), event("remove", off, _hex(4) < 12), event("add", back, (_hex(4) < 12) & (_hex(6) < 6)))
    return rows.select("list", "kind", "value", F.explode(events).alias("e")).where("e is not null").select("list", "kind", "value", "e.*")


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged at its fetch time, in minutes of 2024 made from its id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.pmod(F.col("page_id") * 7919, F.lit(525_600)).alias("fetched_at"))
    out = urlfilter.evaluate(pages, list_entries(pages))
    return out.select("page_id", "fetched_at", F.array_join("lists", ",").alias("lists"), "blocked")


ORACLE_SQL["op9_url_filters"] = r"""
with p as (
  select page_id, (page_id * 7919) % 525600 as fetched_at,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) as host,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1)) as path
  from pages
), hosts as (select distinct host as value from p where host <> ''),
v as (
  select 'spam' as list, 'host' as kind, value from hosts
  union all select distinct 'adult', 'domain', regexp_extract(value, '([^.]+\.[^.]+)$', 1) from hosts where regexp_extract(value, '([^.]+\.[^.]+)$', 1) <> ''
  union all select 'mirror', 'prefix', value || '/en/' from hosts
), d as (
  select *, instr('0123456789abcdef', substr(md5(value), 1, 1)) - 1 as d1, instr('0123456789abcdef', substr(md5(value), 2, 1)) - 1 as d2,
         instr('0123456789abcdef', substr(md5(value), 3, 1)) - 1 as d3, instr('0123456789abcdef', substr(md5(value), 4, 1)) - 1 as d4,
         instr('0123456789abcdef', substr(md5(value), 5, 1)) - 1 as d5, instr('0123456789abcdef', substr(md5(value), 6, 1)) - 1 as d6
  from v
), t as (select *, (d2 * 16 + d3) * 1440 as a, (d2 * 16 + d3) * 1440 + (d5 + 1) * 14400 as b from d where d1 < 8),
i as (
  select list, kind, value, a as lo, case when d4 < 12 then b end as hi from t
  union all select list, kind, value, b + 43200, null from t where d4 < 12 and d6 < 6
), m as (
  select distinct p.page_id, i.list from p join i on p.fetched_at >= i.lo and (i.hi is null or p.fetched_at < i.hi)
   and ((kind = 'host' and p.host = value) or (kind = 'domain' and (p.host = value or ends_with(p.host, '.' || value))) or (kind = 'prefix' and starts_with(p.host || p.path, value)))
)
select p.page_id, p.fetched_at, coalesce(string_agg(m.list, ',' order by m.list), '') as lists, count(m.list) > 0 as blocked
from p left join m on p.page_id = m.page_id group by p.page_id, p.fetched_at
"""


ORACLE_SQL["op10_host_rules"] = r"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
p as (select rid, unnest(range(1, len(w) - 6)) as i from w where len(w) > 8),
g as (select p.rid, i, array_to_string(w[i:i + 7], ' ') as g from p join w using (rid)),
dup as (select rid, i from (select *, count(*) over (partition by rid, g) as c from g) where c > 1),
cov as (select rid, count(distinct pos) as n from (select rid, unnest(range(i, i + 8)) as pos from dup) group by rid),
m as (select w.rid, doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words from w left join cov using (rid)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m),
h as (select source, count(*)::double as n, count(*) filter (base_failed)::double as f from b group by source),
s as (select (sum(f) + 0.5) / (sum(n) + 1) as mean, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 as spread, count(*) / sum(n) as hosts from h),
q as (select mean, case when spread - mean * (1 - mean) * hosts > 1e-9 then least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * hosts) - 1, 2.0), 1000.0) else 1000.0 end as k from s),
bad as (select source from h, q where (f + mean * k) / (n + k) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not exists (select 1 from bad where bad.source is not distinct from b.source) as kept from b
"""

ORACLE_SQL["op4_decontaminate"] = r"""
with lo as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as a, 'abcdefghijklmnopqrstuvwxyz' as b),
iw as (select item_id::varchar as item, regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark, lo where text is not null),
ii as (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0),
win as (select distinct item, array_to_string(w[i:i + 9], ' ') as g, len(w[i:i + 9]) as m from ii),
dw as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents, lo),
pos as (select rid, m, unnest(range(1, len(w) - m + 2)) as i from dw, (select distinct m from win)),
hit as (select rid, i, item, win.m from (select pos.rid, i, m, array_to_string(w[i:i + m - 1], ' ') as g from pos join dw using (rid)) p join win on p.g = win.g and p.m = win.m),
n as (select rid, count(distinct k) as n_hit from (select rid, unnest(range(i, i + m)) as k from hit) group by rid),
it as (select rid, list_sort(list(distinct item)) as items from hit group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, items is not null as contaminated
from dw left join n using (rid) left join it using (rid)
"""
