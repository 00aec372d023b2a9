"""Model responses: text, strict JSON, usage, cost, scores and comparisons."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE = "output_text string, body struct<output_text: string, output: array<struct<type: string, content: array<struct<text: string>>>>, usage: string>, output array<struct<type: string, content: array<struct<text: string>>>>, usage string"
_FENCED = re.compile(r"```(?:json)?\s*(\{.*\})\s*```", re.DOTALL)


def strict_json(text: str | None) -> tuple[str | None, str | None]:
    """(canonical JSON, error) of a model's answer: an object, bare or fenced; nothing may follow it, the last of equal keys wins."""
    if text is None:
        return None, None
    bare = text.strip()
    found = bare if bare.startswith("{") else (m[1] if (m := _FENCED.search(bare)) else None)
    if found is None:
        return None, "Expected a JSON object in model output."
    try:
        return json.dumps(json.loads(found), ensure_ascii=False), None
    except ValueError as e:
        return None, str(e)


def json_object():
    """UDF text -> (json, error). No SQL function has these rules: they take trailing text, or refuse repeated keys and NaN."""

    @F.pandas_udf(T.StructType([T.StructField("json", T.StringType()), T.StructField("error", T.StringType())]))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([strict_json(t) for t in texts], columns=["json", "error"], dtype=object)

    return run


PARSERS: dict[str, Callable] = {"json_object": json_object}


def parse(rows: DataFrame, schema: str, text: str = "raw_text", parser: str = "json_object") -> DataFrame:
    """parsed (by ``schema``) and parse_error; both null where there is no text."""
    if parser not in PARSERS:
        raise ValueError(f"Unsupported parser: {parser}")
    out = rows.withColumn("_j", PARSERS[parser]()(text))
    return out.withColumn("parsed", F.from_json("_j.json", schema)).withColumn("parse_error", F.col("_j.error")).drop("_j")


def output_text(r: Column) -> Column:
    """Text of a response: its own, its body's, else the first of the last message blocks that have one (body first)."""

    def blocks(out: Column) -> Column:
        texts = F.transform(F.filter(F.reverse(out), lambda b: b["type"] == "message"), lambda b: F.get(F.filter(F.transform(b["content"], lambda c: c["text"]), lambda t: F.coalesce(t != "", F.lit(False))), 0))
        return F.get(F.filter(texts, lambda t: t.isNotNull()), 0)

    said = lambda c: F.when(c != "", c)
    return F.coalesce(said(r["output_text"]), said(r["body"]["output_text"]), blocks(r["body"]["output"]), blocks(r["output"]))


def usage(raw: Column) -> Column:
    """Token counts from a JSON usage object of either naming; all zero is null."""

    def number(*paths: str) -> Column:
        return F.coalesce(*(F.get_json_object(raw, f"$.{p}").try_cast("double").cast("long") for p in paths), F.lit(0).cast("long"))

    i, o, total = number("input_tokens", "prompt_tokens"), number("output_tokens", "completion_tokens"), number("total_tokens")
    cached, reasoning = number("input_tokens_details.cached_tokens", "prompt_tokens_details.cached_tokens"), number("output_tokens_details.reasoning_tokens", "completion_tokens_details.reasoning_tokens")
    total = F.when(total != 0, total).otherwise(i + o)
    some = (i != 0) | (o != 0) | (cached != 0) | (reasoning != 0) | (total != 0)
    return F.when(some, F.struct(i.alias("input_tokens"), cached.alias("cached_input_tokens"), o.alias("output_tokens"), reasoning.alias("reasoning_tokens"), total.alias("total_tokens")))


def item_usage(r: Column) -> Column:
    return F.coalesce(usage(r["body"]["usage"]), usage(r["usage"]))


def priced(rows: DataFrame, pricing: DataFrame, model: str = "model", tier: str = "tier") -> DataFrame:
    """estimated_cost_usd of rows with ``usage``; null without usage. ``pricing`` has a row for each model and tier; see ``unpriced``."""
    p = pricing.select(F.col("model").alias("_m"), F.col("tier").alias("_t"), "input_per_1m", "cached_input_per_1m", "output_per_1m")
    out = rows.join(p, (F.col(model) == F.col("_m")) & (F.col(tier) == F.col("_t")), "left")
    u = F.col("usage")
    cost = lambda n, rate: n / F.lit(1_000_000.0) * F.col(rate)
    total = cost(F.greatest(u["input_tokens"] - u["cached_input_tokens"], F.lit(0)), "input_per_1m") + cost(u["cached_input_tokens"], "cached_input_per_1m") + cost(u["output_tokens"], "output_per_1m")
    return out.withColumn("estimated_cost_usd", F.when(u.isNotNull(), total)).drop("_m", "_t", *p.columns[2:])


def unpriced(rows: DataFrame, pricing: DataFrame) -> DataFrame:
    """(model, tier) of rows with usage that the table doesn't price: a caller should refuse them."""
    return rows.where("usage is not null").select("model", "tier").distinct().join(pricing, ["model", "tier"], "left_anti")


def usage_summary(rows: DataFrame) -> DataFrame:
    u = ("input_tokens", "cached_input_tokens", "output_tokens", "reasoning_tokens", "total_tokens")
    return rows.agg(F.count(F.lit(1)).alias("item_count"), F.count("estimated_cost_usd").alias("priced_item_count"), *(F.coalesce(F.sum(f"usage.{c}"), F.lit(0)).alias(c) for c in u), F.round(F.coalesce(F.sum("estimated_cost_usd"), F.lit(0.0)), 10).alias("estimated_cost_usd"))


STATUS_TASKS = ("alphabetic_entity_judge", "classical_japanese_judge", "yomi_check")


def score(rows: DataFrame, task_name: str) -> DataFrame:
    """passed, expected, actual: equal statuses (or renderings); two missing values are equal, an empty error is none."""
    if task_name not in (*STATUS_TASKS, "yomi_repair"):
        raise ValueError(f"Unsupported scoring task: {task_name}")
    field = "status" if task_name in STATUS_TASKS else "rendered"
    failed = F.coalesce("parse_error", F.lit("")) != ""
    actual = F.when(~failed, F.col(f"parsed.{field}"))
    out = rows.withColumn("expected", F.col(f"expected_{field}")).withColumn("actual", actual)
    return out.withColumn("passed", ~failed & F.col("actual").eqNullSafe(F.col("expected"))).withColumn("parse_error", F.when(failed, F.col("parse_error")))


def score_summary(rows: DataFrame) -> DataFrame:
    """Counts, accuracy and the histograms of expected and actual values (one row; maps sorted by key)."""
    base = rows.agg(F.count(F.lit(1)).alias("item_count"), F.count_if("passed").alias("pass_count"), F.count_if(~F.col("passed")).alias("fail_count"), F.count("parse_error").alias("parse_error_count"), F.coalesce(F.avg(F.col("passed").cast("int")), F.lit(0.0)).alias("accuracy"))
    for c in ("expected", "actual"):
        counts = rows.where(f"coalesce({c}, '') <> ''").groupBy(c).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "count")))).alias(f"{c}_status_counts"))
        base = base.join(counts)  # one row each
    return base


def compare(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Items of two scored runs whose outcome differs: missing_case, fixed, regressed or changed_prediction."""
    a, b = (x.select("item_id", F.struct("passed", "actual", "parse_error").alias(n)) for x, n in ((base, "a"), (candidate, "b")))
    rows = a.join(b, "item_id", "full")
    change = (
        F.when(F.col("a").isNull() | F.col("b").isNull(), "missing_case")
        .when(~F.col("a.passed") & F.col("b.passed"), "fixed")
        .when(F.col("a.passed") & ~F.col("b.passed"), "regressed")
        .when(~F.col("a.actual").eqNullSafe(F.col("b.actual")) | ~F.col("a.parse_error").eqNullSafe(F.col("b.parse_error")), "changed_prediction")
    )
    return rows.withColumn("change", change).where("change is not null").select("item_id", "change", F.col("a.actual").alias("base_actual"), F.col("b.actual").alias("candidate_actual"), F.col("a.passed").alias("base_passed"), F.col("b.passed").alias("candidate_passed"))


def score_delta(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Differences of two summaries (one row each)."""
    names = ("item_count", "pass_count", "fail_count", "parse_error_count", "accuracy")
    a, b = (x.select(*(F.col(c).alias(f"{p}_{c}") for c in names)) for x, p in ((base, "a"), (candidate, "b")))
    return a.join(b).select(*((F.col(f"b_{c}") - F.col(f"a_{c}")).alias(f"{c}_delta") for c in names))


def ask(prompts: DataFrame, backend: Callable[[], Callable[[str], dict]]) -> DataFrame:
    """Send each prompt to a model: ``backend`` makes a client once a partition; the client returns text and usage.

    Transport errors end the job; what can't be parsed is the parser's matter.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = backend()
        for f in frames:
            got = [client(p) for p in f["prompt"]]
            yield pd.DataFrame({"item_id": f["item_id"], "raw_text": [g.get("text") for g in got], "usage_json": [json.dumps(g.get("usage") or {}) for g in got]})

    return prompts.select("item_id", "prompt").mapInPandas(run, "item_id string, raw_text string, usage_json string")


def join_batch_results(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Result lines (custom_id, response) with the text, usage and metadata of their items."""
    r = F.col("response")
    rows = lines.select(F.col("custom_id").alias("item_id"), output_text(r).alias("raw_text"), item_usage(r).alias("usage"))
    return rows.join(items.select("item_id", "metadata"), "item_id", "left")
