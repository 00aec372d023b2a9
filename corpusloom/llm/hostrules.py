"""Quality rules at host level (DataFrame functions only).

Each document is measured by base rules; failures are counted by host, each host's rate
is shrunk towards the overall rate with an empirical beta prior (its strength from the
method of moments on the rates between hosts), and documents of hosts whose shrunk rate
passes ``max_rate`` are dropped along with the documents that fail themselves.

A measured row is a few numbers, checkpointed once; counting by host has partial sums, and
only failing hosts are joined back, so a host with a third of all rows is never gathered.

Defined cases: null text has no words (and fails the length rule); null hosts are one
host; repeated rows count each; very long texts are measured whole, in time n log n at
most; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import cut, let

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
SPAN = 8


@dataclass(frozen=True)
class Prior:
    alpha: float
    beta: float


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in windows of ``SPAN`` words found twice or more.

    Windows are compared by 64-bit hashes. Only a text with equal hashes sorts them: equal
    neighbours are repeats, and the union of their spans is added up from left to right.
    """
    spans = F.transform(F.sequence(F.lit(1), F.size(words) - (SPAN - 1)), lambda i: F.xxhash64(F.slice(words, i, SPAN)))

    def covered(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(order, lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))))
        starts = F.array_sort(F.transform(again, lambda e: e["i"]))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        step = lambda a, p: F.struct((a["n"] + p + SPAN - F.greatest(a["end"], p)).cast("long").alias("n"), (p + SPAN).alias("end"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    none = F.lit(0).cast("long")
    return F.when(F.size(words) <= SPAN, none).otherwise(let(spans, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))))


def measured(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: Column | str = "source") -> DataFrame:
    """doc id, host and the base measures of every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.col(host) if isinstance(host, str) else host).alias("host"),
        let(words_of(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        F.regexp_count(body, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )
    return rows.select("doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def fit_prior(hosts: DataFrame) -> Prior:
    """Beta prior from (n, failed) of each host: mean by rows, strength by the variance between hosts beyond chance."""
    n, f = F.sum("n"), F.sum("failed")
    s = hosts.agg(n.alias("n"), f.alias("f"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("square")).first()
    if not s["n"]:
        return Prior(1.0, 1.0)
    m = (s["f"] + 0.5) / (s["n"] + 1)
    between = s["square"] / s["n"] - (s["f"] / s["n"]) ** 2 - m * (1 - m) * s["hosts"] / s["n"]
    strength = min(max(m * (1 - m) / between - 1, 2.0), 1000.0) if between > 1e-9 else 1000.0
    return Prior(m * strength, (1 - m) * strength)


def judge(rows: DataFrame, failed: Column, max_rate: float = 0.5) -> DataFrame:
    """``rows`` (with host) plus base_failed, host_failed and kept."""
    rows = cut(rows.withColumn("base_failed", failed))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed"))
    prior = fit_prior(hosts)
    rate = (F.col("failed") + prior.alpha) / (F.col("n") + prior.alpha + prior.beta)
    bad = hosts.where(rate > max_rate).select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    rows = rows.join(bad, rows["host"].eqNullSafe(F.col("_host")), "left").withColumn("host_failed", F.col("_bad").isNotNull()).drop("_host", "_bad")
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
