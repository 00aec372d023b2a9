"""Documents to units, units to entity occurrences, and their list and registry status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X


def spread(df: DataFrame) -> DataFrame:
    """Deal an input of fewer partitions than cores over all cores; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(rows: DataFrame, dataset: str, limit: int | None = None) -> DataFrame:
    """Numbered lines to documents: blank or missing texts go, the first ``limit`` (one at least) stay."""
    kept = rows.where(F.col("text").isNotNull() & ~X.is_blank(F.col("text")))
    if limit is not None:
        kept = kept.orderBy("source_line_no").limit(max(limit, 1))
    return kept.select("source_line_no", F.format_string(f"{dataset}:%010d", "source_line_no").alias("doc_id"), "text", "source_file")


def units(docs: DataFrame) -> DataFrame:
    """Offset-exact units; a narrow map."""
    one = docs.select("doc_id", "source_file", "source_line_no", F.posexplode(X.split_units("text")).alias("i", "u"))
    seq = (F.col("i") + 1).cast("int")
    return one.select("doc_id", F.format_string("%s:u%04d", "doc_id", seq).alias("unit_id"), seq.alias("unit_seq"), "u.char_start", "u.char_end", "u.text", "source_file", "source_line_no")


def empty_analysis() -> Column:
    from corpusloom import schemas

    return F.from_json(F.lit('{"mechanical": {}, "llm": {}, "human_review": {}}'), schemas.ANALYSIS)


def tokens(units: DataFrame) -> DataFrame:
    return units.select("unit_id", "unit_seq", F.posexplode(X.extract_tokens("text")).alias("i", "t")).select("unit_id", "unit_seq", (F.col("i") + 1).alias("token_seq"), "t.*")


def occurrences(units: DataFrame, strict_max: int = X.STRICT_CASE_MAX_LENGTH) -> DataFrame:
    """One row for each entity of each unit, in order, without list status."""
    e = units.select("doc_id", "unit_id", "unit_seq", F.posexplode(X.extract_entities("text")).alias("i", "e"))
    e = e.withColumn("occurrence_seq", (F.col("i") + 1).cast("int")).withColumn("normalized", X.normalize_entity(F.col("e.text"))).withColumn("strict_case", X.is_strict(F.col("e.words"), F.col("e.text"), strict_max))
    return e.select(
        F.format_string("%s:a%04d", "unit_id", "occurrence_seq").alias("occurrence_id"), "doc_id", "unit_id", "unit_seq", "occurrence_seq", F.col("e.text").alias("entity_text"),
        F.when(F.col("strict_case"), F.col("e.text")).otherwise(F.col("normalized")).alias("entity_key"), "normalized", "e.char_start", "e.char_end", F.col("e.words").alias("component_texts"), "strict_case",
    )


def classify(occ: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """base_list_status: blacklisted before whitelisted, else unknown.

    ``lists`` has whitelist, blacklist (case-insensitive, lower-cased), cs_whitelist and cs_blacklist;
    they are settings of the driver, so they enter as literals.
    """

    def member(name: str) -> Column:
        insensitive, exact = (sorted(set(lists.get(k, []))) for k in (name, f"cs_{name}"))
        in_exact = F.col("entity_text").isin(*exact) if exact else F.lit(False)
        in_any = F.col("normalized").isin(*[x.lower() for x in insensitive]) if insensitive else F.lit(False)
        return in_exact | (~F.col("strict_case") & in_any)

    return occ.withColumn("base_list_status", F.when(member("blacklist"), F.lit("blacklist")).when(member("whitelist"), F.lit("whitelist")).otherwise(F.lit("unknown")))


def resolve(occ: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """resolved_status: a decision of any status overrides the list status. Spark picks the join by size."""
    if decisions is None:
        return occ.withColumn("resolved_status", F.col("base_list_status"))
    d = decisions.select("entity_key", F.col("status").alias("_decided"))
    return occ.join(d, "entity_key", "left").withColumn("resolved_status", F.coalesce("_decided", "base_list_status")).drop("_decided").select(*occ.columns, "resolved_status")
