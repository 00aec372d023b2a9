"""Ledgers: replace by batch, last line wins, upserts, and the rewrite after a review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_batches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of batches that come in again are replaced; an empty input replaces nothing."""
    return old.join(new.select("batch_name").distinct(), "batch_name", "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def append_partitions(new: DataFrame, path: str) -> None:
    """The same on disk: only the partitions of the incoming batches are rewritten."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_name").parquet(path)


def latest_decisions(lines: DataFrame) -> DataFrame:
    """Of numbered registry lines, the last of each key; ``token_key`` is read where ``entity_key`` is missing."""
    have = set(lines.columns)
    key = F.coalesce(*(F.col(c) for c in ("entity_key", "token_key") if c in have))
    value = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in have else F.lit(default)
    row = F.struct(value("strict_case", False).alias("strict_case"), value("status", "unknown").alias("status"), value("source", "manual").alias("source"), value("note", "").alias("note"))
    return lines.select(key.alias("entity_key"), row.alias("r"), "line_no").groupBy("entity_key").agg(F.max_by("r", "line_no").alias("r")).select("entity_key", "r.*")


def upsert(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` win over registry rows of their keys; sorted by key."""
    kept = registry.join(rows.select("entity_key"), "entity_key", "left_anti").select(*registry.columns)
    return kept.unionByName(rows.select(*registry.columns)).orderBy("entity_key")


def rewrite_with_promotions(registry: DataFrame, promoted: DataFrame) -> DataFrame:
    """All earlier review decisions go (those of other packs too), then the promoted ones come in."""
    return upsert(registry.where(~F.col("source").startswith("review:")), promoted)
