"""Named exports of readings: JSON lines and text for each variant, and a pair of texts to compare."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import readings
from corpusloom.sources import tables

#: Extension point: variants by name, with their strategies.
VARIANTS = {"aligned_hybrid": "aligned_hybrid_v1", "sudachi_only": "sudachi_only_v1"}


def export(rows: DataFrame, variant: str, folder: str, kinds: tuple[str, ...] = ("jsonl", "txt")) -> dict[str, str]:
    """Write units (with tokens and candidates) by a variant; the text reuses the renderings of the JSON lines."""
    if variant not in VARIANTS:
        raise ValueError(f"Unknown variant: {variant}; known: {', '.join(sorted(VARIANTS))}")
    out = {k: f"{folder}/units.{variant}.{k}" for k in kinds}
    if "jsonl" in out:
        made = readings.apply(rows, VARIANTS[variant])
        tables.write_json_lines(made, out["jsonl"])
        stored = rows.sparkSession.read.schema("unit_id string, reading struct<rendered: string>").json(out["jsonl"])
        rows = rows.drop("rendered").join(stored.select("unit_id", F.col("reading.rendered").alias("rendered")), "unit_id", "left")
    if "txt" in out:
        rows = rows if "rendered" in rows.columns else rows.withColumn("rendered", F.lit(None).cast("string"))
        readings.export_text(rows, VARIANTS[variant]).write.mode("overwrite").text(out["txt"])
    return out


def debug_texts(spark: SparkSession, rows: DataFrame, folder: str, out: str) -> dict[str, dict[str, str]]:
    """Texts of both variants side by side; the hybrid's JSON lines must be there."""
    stored = f"{folder}/units.aligned_hybrid.jsonl"
    if not Path(stored).exists():
        raise FileNotFoundError(f"Hybrid JSONL not found for debug export: {stored}")
    have = spark.read.schema("unit_id string, reading struct<rendered: string>").json(stored).select("unit_id", F.col("reading.rendered").alias("rendered"))
    return {"aligned_hybrid": export(rows.drop("rendered").join(have, "unit_id", "left"), "aligned_hybrid", out, ("txt",)), "sudachi_only": export(rows.drop("rendered"), "sudachi_only", out, ("txt",))}
