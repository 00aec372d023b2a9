"""Judgments to promotion candidates, packs, replayed submissions, promoted decisions, manifests, issue texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators.aggregate import first_distinct
from corpusloom.sources.shared import numbered

CANDIDATE_STAGE = "alphabetic_candidate_review"
SIDES = ("in_scope", "out_of_scope")
WORKING, DEV = "working", "dev"


def judgments(results: DataFrame, batch_name: str, source_path: str = "") -> DataFrame:
    """Parsed model results to judgments: failed ones and other statuses go; missing fields take defaults."""
    row = F.col("metadata.source_row")
    kept = results.where((F.coalesce("parse_error", F.lit("")) == "") & F.col("parsed.status").isin(*SIDES))
    text = lambda c: F.coalesce(c, F.lit(""))
    none = F.array().cast("array<string>")
    return kept.select(
        F.lit(batch_name).alias("batch_name"), F.coalesce(row["entity_key"], F.col("item_id")).alias("entity_key"), F.coalesce(row["strict_case"], F.lit(False)).alias("strict_case"),
        F.col("parsed.status").alias("llm_status"), text(F.col("parsed.confidence")).alias("confidence"), text(F.col("parsed.note")).alias("note"),
        *(F.coalesce(row[c], F.lit(0)).cast("long").alias(c) for c in ("occurrence_count", "unit_count")),
        *(F.coalesce(row[c], none).alias(c) for c in ("surface_forms", "example_unit_ids", "example_texts")), F.lit(source_path).alias("source_path"),
    )


def candidates(rows: DataFrame, decided: DataFrame | None = None, threshold: int = 3, max_examples: int = 3, max_notes: int = 3) -> DataFrame:
    """Keys whose observations all point one way, ``threshold`` of them at least. ``rows`` carry their order as ``line_no``."""
    rows = rows.where(F.col("llm_status").isin(*SIDES))
    if decided is not None:
        rows = rows.join(decided.select("entity_key"), "entity_key", "left_anti")
    side = lambda s: F.col("llm_status") == s
    base = rows.groupBy("entity_key").agg(
        F.min_by("strict_case", "line_no").alias("strict_case"),
        *(F.sum(F.when(side(s), F.col("occurrence_count")).otherwise(0)).alias(s) for s in SIDES),
        *(F.array_sort(F.collect_set(F.when(side(s), F.col("batch_name")))).alias(f"{s}_batches") for s in SIDES),
    )

    def listed(values: Column, name: str, limit: int | None) -> DataFrame:
        one = rows.select("entity_key", "line_no", F.posexplode(values).alias("i", "v")).groupBy("entity_key", "v").agg(F.min(F.struct("line_no", "i")).alias("at"))
        return one.groupBy("entity_key").agg(first_distinct(F.collect_list(F.struct("at", "v")), limit).alias(name))

    note = X.strip(F.col("note"))
    counts = rows.where("confidence <> ''").groupBy("entity_key", "confidence").count().groupBy("entity_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("confidence", "count")))).alias("confidence_counts"))
    parts = [listed(F.col("surface_forms"), "surface_forms", None), listed(F.col("example_texts"), "example_texts", max_examples), listed(F.when(note != "", F.array(note)), "note_samples", max_notes), counts]
    a, b = SIDES
    white = (F.col(a) >= threshold) & (F.col(b) == 0)
    black = (F.col(b) >= threshold) & (F.col(a) == 0)
    out = base.where(white | black)
    for p in parts:
        out = out.join(p, "entity_key", "left")
    pick = lambda x, y: F.when(white, x).otherwise(y)
    none = F.array().cast("array<string>")
    return out.select(
        "entity_key", "strict_case", pick(F.lit("whitelist"), F.lit("blacklist")).alias("proposed_decision"), F.lit(threshold).cast("long").alias("threshold_observations"),
        pick(F.col(a), F.col(b)).alias("supporting_observations"), pick(F.col(b), F.col(a)).alias("opposing_observations"),
        pick(F.size(f"{a}_batches"), F.size(f"{b}_batches")).cast("long").alias("supporting_batch_count"), pick(F.size(f"{b}_batches"), F.size(f"{a}_batches")).cast("long").alias("opposing_batch_count"),
        pick(F.col(f"{a}_batches"), F.col(f"{b}_batches")).alias("source_batches"), F.coalesce("confidence_counts", F.create_map().cast("map<string,bigint>")).alias("confidence_counts"),
        *(F.coalesce(c, none).alias(c) for c in ("surface_forms", "example_texts", "note_samples")),
    ).orderBy(F.desc("supporting_observations"), "proposed_decision", "entity_key")


def pack_items(rows: DataFrame) -> DataFrame:
    """Candidates as numbered items of a pack: sorted by ranges, numbered by partition."""
    facts = ("threshold_observations", "supporting_observations", "opposing_observations", "supporting_batch_count", "opposing_batch_count", "source_batches", "confidence_counts")
    rows = numbered(rows, "seq", F.desc("supporting_observations"), "proposed_decision", "entity_key")
    return rows.select(F.concat(F.lit("entity:"), "entity_key").alias("item_id"), F.col("seq").cast("int").alias("seq"), "entity_key", "strict_case", F.col("proposed_decision").alias("proposed_action"), "surface_forms", "example_texts", "note_samples", F.struct(*facts).alias("evidence"))


def pack_header(items: DataFrame, pack_id: str, stage: str, created_at_epoch: int) -> DataFrame:
    """The pack as one row; the clock is the caller's."""
    return items.agg(F.lit(1).alias("schema_version"), F.lit(stage).alias("review_stage"), F.lit(pack_id).alias("pack_id"), F.lit(created_at_epoch).cast("long").alias("created_at_epoch"), F.count(F.lit(1)).cast("int").alias("item_count"), F.array_sort(F.collect_list(F.struct("seq", "item_id"))).alias("items"))


def effective_submission(draft: DataFrame) -> DataFrame:
    """What a review page submits: ends within [1, item_count] and in order, overrides within them; an empty pack has no range."""
    lo, hi = (F.greatest(F.lit(1), F.least(F.col(c), F.col("item_count"))) for c in ("from_seq", "to_seq"))
    rows = draft.withColumn("_lo", F.least(lo, hi)).withColumn("_hi", F.greatest(lo, hi))
    ranges = F.when(F.col("item_count") > 0, F.array(F.struct(F.col("_lo").alias("from_seq"), F.col("_hi").alias("to_seq")))).otherwise(F.array().cast("array<struct<from_seq:int,to_seq:int>>"))
    inside = F.filter("overrides", lambda o: (F.col("item_count") > 0) & (o["seq"] >= F.col("_lo")) & (o["seq"] <= F.col("_hi")) & (o["decision"] != "accept"))
    return rows.withColumn("reviewed_ranges", ranges).withColumn("overrides", inside).drop("_lo", "_hi")


#: A range of places as the few nodes of a binary tree that cover it exactly, and a place as all nodes above it: (level, number).
_RANGE_NODES = """filter(flatten(transform(sequence(0, {levels}), k -> transform(array(shiftright(lo + shiftleft(1L, k) - 1, k)), l -> array(
  if(l < shiftright(hi + 1, k) and l % 2 = 1, struct(k as level, l as node), null),
  if(l < shiftright(hi + 1, k) and shiftright(hi + 1, k) % 2 = 1, struct(k as level, shiftright(hi + 1, k) - 1 as node), null)))[0])), x -> x is not null)"""
_PLACE_NODES = "transform(sequence(0, {levels}), k -> struct(k as level, shiftright(cast(seq as bigint), k) as node))"


def replay(items: DataFrame, submissions: DataFrame) -> DataFrame:
    """Effective state of each item: the last submission (epoch, id, path) whose ranges cover it, with its override if it has one.

    A covering range first accepts and then applies the submission's overrides again, so the last covering
    submission alone decides. Accepted items have no note (null). A range meets its items by tree nodes,
    some tens for each range and item, so no pair of a range and an item is made. Items are numbered from 0 or 1 on; a
    range without an end covers nothing; empty tables give no states.
    """
    path = F.col("source_path") if "source_path" in submissions.columns else F.lit("")
    sub = submissions.select(F.struct(F.coalesce("generated_at_epoch", F.lit(0)).cast("long").alias("e"), F.coalesce("submission_id", F.lit("")).alias("id"), path.alias("p")).alias("s"), "reviewed_ranges", "overrides")
    ranges = sub.select("s", F.explode("reviewed_ranges").alias("r")).select("s", F.least("r.from_seq", "r.to_seq").alias("lo"), F.greatest("r.from_seq", "r.to_seq").alias("hi"))
    top = items.agg(F.max("seq")).first()[0] or 0
    levels = int(top + 1).bit_length()
    ranges = ranges.where((F.col("hi") >= 0) & (F.col("lo") <= top)).select("s", F.greatest(F.col("lo"), F.lit(0)).cast("long").alias("lo"), F.least(F.col("hi"), F.lit(top)).cast("long").alias("hi"))
    last = ranges.select("s", F.inline(F.expr(_RANGE_NODES.format(levels=levels)))).groupBy("level", "node").agg(F.max("s").alias("s"))
    covered = items.select("item_id", F.inline(F.expr(_PLACE_NODES.format(levels=levels)))).join(last, ["level", "node"]).groupBy("item_id").agg(F.max("s").alias("s"))
    changes = sub.select("s", F.posexplode("overrides").alias("pos", "o")).select("s", "pos", "o.*").groupBy("s", "item_id").agg(F.max_by(F.struct("decision", "note"), "pos").alias("o"))
    out = covered.join(changes, ["s", "item_id"], "left")
    changed = F.col("o").isNotNull()
    return out.select("item_id", F.when(changed, F.coalesce("o.decision", F.lit(""))).otherwise("accept").alias("status"), F.when(changed, X.strip(F.coalesce("o.note", F.lit("")))).alias("note"), F.col("s.id").alias("submission_id"), F.col("s.e").alias("generated_at_epoch"))


def promoted(items: DataFrame, states: DataFrame, pack_id: str) -> DataFrame:
    """Accepted items as registry decisions."""
    rows = items.where(F.col("proposed_action").isin("whitelist", "blacklist")).join(states.where("status = 'accept'"), "item_id")
    return rows.select("entity_key", F.coalesce("strict_case", F.lit(False)).alias("strict_case"), F.col("proposed_action").alias("status"), F.lit(f"review:{CANDIDATE_STAGE}").alias("source"), F.concat(F.lit(f"pack={pack_id};submission="), "submission_id").alias("note")).orderBy("status", "entity_key")


def import_summary(states: DataFrame, decisions: DataFrame) -> DataFrame:
    a = states.agg(*(F.count_if(F.col("status") == s).alias(f"{n}_count") for s, n in (("accept", "accepted"), ("reject", "rejected"), ("defer", "deferred"))))
    b = decisions.agg(*(F.count_if(F.col("status") == s).alias(f"promoted_{s}_count") for s in ("whitelist", "blacklist")), F.array_sort(F.collect_list("entity_key")).alias("promoted_entities"))
    return a.join(b)  # one row each


def route_submissions(rows: DataFrame, packs: DataFrame, submission_type: str = "review_submission", stage: str = CANDIDATE_STAGE) -> DataFrame:
    """``reason`` for turning a submission away, null if it is taken; checks in a fixed order, ``line_no`` says which twin came first."""
    checked = F.when(~F.col("submission_type").eqNullSafe(F.lit(submission_type)), "wrong_submission_type").when(~F.col("review_stage").eqNullSafe(F.lit(stage)), "wrong_review_stage").when(F.coalesce("submission_id", F.lit("")) == "", "missing_submission_id")
    rows = rows.withColumn("reason", checked)
    twin = F.row_number().over(W.partitionBy("submission_id", F.col("reason").isNull()).orderBy("line_no")) > 1
    known = packs.select("pack_id", F.lit(True).alias("_known")).distinct()
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(twin, "duplicate_submission_id"))).join(known, "pack_id", "left")
    return rows.withColumn("reason", F.coalesce("reason", F.when(F.col("_known").isNull(), "unknown_pack_id"))).drop("_known")


def manifest_packs(entries: DataFrame) -> DataFrame:
    """Pack rows of the site's manifest: status, and the default pack of each stage (working's latest, else the latest)."""
    e = entries.withColumn("track_name", F.coalesce("track_name", F.lit(WORKING))).withColumn("_at", F.struct("created_at_epoch", "pack_id"))
    last = F.max("_at").over(W.partitionBy("review_stage", "track_name")) == F.col("_at")
    overall, working = (F.max(F.when(c, F.col("_at"))).over(W.partitionBy("review_stage")) for c in (F.lit(True), F.col("track_name") == WORKING))
    status = F.when(last & (F.col("track_name") == WORKING), "active-working").when(last & (F.col("track_name") == DEV), "active-dev").otherwise("archived")
    return e.select("review_stage", X.stage_label(F.col("review_stage")).alias("label"), "pack_id", "title", F.concat(F.lit("./packs/"), "site_filename").alias("path"), "track_name", "created_at_epoch", "item_count", status.alias("status"), F.coalesce(working, overall)["pack_id"].alias("latest_pack_id"), last.alias("is_latest_of_track"))


def current_tracks(packs: DataFrame) -> DataFrame:
    """The latest pack of each track over all stages (the first stage wins a tie)."""
    best = F.struct("created_at_epoch", "pack_id")
    w = W.partitionBy("track_name").orderBy(best.desc(), "review_stage")
    return packs.where("is_latest_of_track").withColumn("r", F.row_number().over(w)).where("r = 1").select("track_name", "review_stage", "label", "pack_id", "title", "path", "created_at_epoch", "item_count")


def default_stage(packs: DataFrame) -> DataFrame:
    """One row: the working track's current stage, else the first stage."""
    current = current_tracks(packs).where(F.col("track_name") == WORKING).agg(F.max("review_stage").alias("a"))
    return current.join(packs.agg(F.min("review_stage").alias("b"))).select(F.coalesce("a", "b").alias("default_stage"))


def review_target(targets: DataFrame) -> DataFrame:
    """Which pack a page opens: what the query asks for, else working's, dev's, or the default."""
    return targets.withColumn("target_pack_id", F.coalesce("query_pack_id", "working_pack_id", "dev_pack_id", "default_pack_id"))


# Where attachments live, and a fenced block of JSON.
ATTACHMENT = r"https://github\.com/user-attachments/files/[0-9]+/[A-Za-z0-9._-]+\.json"
FENCE = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"


def attachments(bodies: DataFrame, pattern: str = ATTACHMENT) -> DataFrame:
    """Attachment addresses of issue and comment bodies (ordered by ``line_no``), each once an issue."""
    rows = bodies.select("number", "line_no", F.posexplode(F.regexp_extract_all("body", F.lit(pattern), F.lit(0))).alias("i", "url"))
    return rows.groupBy("number", "url").agg(F.min(F.struct("line_no", "i")).alias("at")).select("number", "url", "at.line_no")


def inline_json(bodies: DataFrame) -> DataFrame:
    """JSON objects that a body consists of or has in fences, in order; a repeated submission id of a body counts once."""
    from corpusloom.operators.responses import json_object

    whole = X.strip(F.col("body"))
    whole = F.when(whole.startswith("{") & whole.endswith("}"), F.array(whole)).otherwise(F.array().cast("array<string>"))
    found = F.concat(whole, F.regexp_extract_all("body", F.lit(FENCE), F.lit(1)))
    rows = bodies.select("number", "line_no", F.posexplode(found).alias("i", "json")).withColumn("json", X.strip(F.col("json"))).where(json_object()("json")["error"].isNull())
    rows = rows.withColumn("submission_id", F.coalesce(F.get_json_object("json", "$.submission_id"), F.lit("")))
    seen = F.row_number().over(W.partitionBy("number", "line_no", "submission_id").orderBy("i"))
    return rows.withColumn("_n", seen).where("_n = 1 or submission_id = ''").drop("_n")
