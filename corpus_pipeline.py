"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``. Equal ids, null texts and extra columns
pass as the operators define; see their docstrings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, jaccard, mixing, pii, toxicity
from corpusloom.llm.queries import pii_key
from corpusloom.llm.tables import aside, cut, shared_dir

#: A document with at least this toxicity goes.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents of the input and drop the rejected ones; the score is made beside the row."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(docs, labels)
    inner, names, back = aside(docs)
    text = names[docs.columns.index("text")]
    return back(toxicity.score(inner, weights, columns=names, text=text).where(F.col("score") < TOXIC))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links connect, one row stays: the smallest id's (ids of null last), of its texts the one with the smallest hash; wordless documents are no group and all stay.

    What goes is decided by id and text, so a text that no link reaches stays whatever else its id has.
    """
    inner, names, back = aside(docs)
    doc, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    keyed = inner.withColumn("_key", F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("doc"), F.xxhash64(F.col(text).cast("string")).alias("hash")))
    found = jaccard.classes(keyed, id_col="_key", text=text).where("n_shingles > 0")
    marks = found.groupBy(F.col("id").alias("_key")).agg(F.bool_or(F.col("id") != F.col("component_id")).alias("gone"), F.count(F.lit(1)).alias("rows"))
    marks = cut(marks.where("gone or rows > 1"))  # read up to four times below: the driver would plan the join as often
    gone, again = marks.where("gone").select("_key"), marks.where("not gone").select("_key")
    kept = _without(keyed, gone)
    if again.isEmpty():
        return back(kept)
    twice = kept.join(again, _same(kept, again), "left_semi")  # repeated rows: one of each
    return back(_without(kept, again).unionByName(twice.dropDuplicates(["_key"])))


def _same(rows: DataFrame, keys: DataFrame):
    """Equal keys, part by part; nulls are equal."""
    a, b = rows["_key"], keys["_key"]
    return (a["hash"] == b["hash"]) & a["doc"].eqNullSafe(b["doc"])


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return rows.join(keys, _same(rows, keys), "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in the text; n_chars follows a text that has changed."""
    inner, names, back = aside(docs)
    text = names[docs.columns.index("text")]
    rows = pii.replace(inner, pii_key(spark), text=text)
    if "n_chars" in docs.columns:
        size = names[docs.columns.index("n_chars")]
        rows = rows.withColumn(size, F.when(F.size(pii.entities()) > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size)))
    return back(rows)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(docs))


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", keep_one_of_each), ("benchmark decontamination", drop_benchmark_leaks), ("PII", replace_pii), ("mixing sources", mix_sources)]
#: Trained and keyed stages aren't SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}.parquet")
        docs = spark.read.parquet(f"{root}/{i}.parquet")
    return docs
