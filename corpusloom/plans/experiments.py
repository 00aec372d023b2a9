"""Prompt and reading experiments: run, score, summarise, compare."""

from __future__ import annotations

import subprocess
from collections.abc import Callable
from dataclasses import asdict, replace
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import prompts, readings, responses
from corpusloom.plans.jobs import PARSED
from corpusloom.sources.tables import write_json



def git_commit() -> str | None:
    """The commit that is checked out, if there is one."""
    try:
        return subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=10).stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        return None


def matched(results: DataFrame, rows: DataFrame, key: str = "item_id") -> DataFrame:
    """Results with the rows that they answer; one without a row is an error that names some."""
    lost = [r[0] for r in results.join(rows, key, "left_anti").select(key).limit(5).collect()]
    if lost:
        raise KeyError(f"results without a row: {', '.join(map(str, lost))}")
    return results.join(rows, key)


def run_prompts(rows: DataFrame, task: prompts.Task, backend: Callable, pricing: DataFrame, folder: str | Path, tier: str = "standard", now: Callable[[], int] = lambda: 0, **overrides) -> dict:
    """Ask a model for each numbered evaluation row, score the answers, write results, summary and manifest."""
    task = replace(task, **{k: v for k, v in overrides.items() if v is not None})
    items = prompts.items(rows, task)
    path = str(Path(folder) / "results.parquet")
    responses.ask(items, backend).write.mode("overwrite").parquet(path)  # asked once
    got = responses.parse(rows.sparkSession.read.parquet(path), PARSED, parser=task.parser).withColumn("usage", responses.usage(F.col("usage_json")))
    expected = items.select("item_id", *(F.col(f"metadata.source_row.{c}").alias(c) for c in ("expected_status", "expected_rendered") if c in rows.columns))
    scored = responses.score(matched(got, expected), task.task_name)
    scored.write.mode("overwrite").parquet(str(Path(folder) / "scored.parquet"))
    scored = rows.sparkSession.read.parquet(str(Path(folder) / "scored.parquet"))
    priced = responses.priced(scored.withColumns({"model": F.lit(task.model), "tier": F.lit(tier)}), pricing)
    if missing := responses.unpriced(priced.select("model", "tier", "usage"), pricing).collect():
        raise KeyError(f"no price for {[tuple(r) for r in missing]}")
    failed = [r[0] for r in scored.where("not passed").select("item_id").orderBy("item_id").collect()]
    summary = {"task_name": task.task_name, "effective_config": asdict(task), "processing_tier": tier, "git_commit": git_commit(), "created_at_epoch": now(), "score": responses.score_summary(scored).first().asDict(), "usage": responses.usage_summary(priced).first().asDict(), "fail_item_ids": failed}
    write_json(Path(folder) / "summary.json", summary)
    write_json(Path(folder) / "manifest.json", {"run_schema": 1, "task_name": task.task_name, "effective_config": asdict(task), "processing_tier": tier, "created_at_epoch": now()})
    return summary


def run_readings(rows: DataFrame, strategy: str) -> tuple[DataFrame, DataFrame]:
    """(rows with rendered and certain, one-row summary) of evaluation rows with tokens and candidates."""
    done = readings.apply(rows, strategy).select("item_id", "text", "expected_rendered", "reading.rendered", "reading.certain", "reading.signals")
    return done, readings.experiment_summary(done)


def job_summary(manifest: dict, status: dict, results: DataFrame | None, pricing: DataFrame) -> dict:
    """Totals of a batch job: from its results (with usage) if they are there, else zeros."""
    out = {"scope": "batch_job", "processing_tier": "batch"} | {k: manifest.get(k) for k in ("task_name", "model")} | {k: status.get(k) for k in ("state", "remote_status", "batch_id")}
    if results is None:
        zero = dict.fromkeys(("input_tokens", "cached_input_tokens", "output_tokens", "reasoning_tokens", "total_tokens"), 0)
        return out | {"item_count": int(manifest.get("item_count", 0)), "priced_item_count": 0, "estimated_cost_usd": 0.0} | zero
    priced = responses.priced(results.withColumns({"model": F.lit(manifest["model"]), "tier": F.lit("batch")}), pricing)
    return out | responses.usage_summary(priced).first().asDict()
