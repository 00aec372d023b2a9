"""Review imports: a submission is stored, all of its pack are replayed, accepted items rewrite the registry."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import text as X
from corpusloom.operators import ledgers, review
from corpusloom.sources import tables


@dataclass
class Store:
    """Folders of packs and submissions, and the registry table."""

    spark: SparkSession
    packs: str
    submissions: str
    registry: str

    def decisions(self) -> DataFrame:
        path = Path(self.registry)
        return self.spark.read.schema(schemas.DECISION).parquet(self.registry) if path.exists() else self.spark.createDataFrame([], schemas.DECISION)

    def _replace_registry(self, rows: DataFrame) -> None:
        """Written beside and swapped: the old table is being read."""
        new = Path(f"{self.registry}.new")
        rows.write.mode("overwrite").parquet(str(new))
        old = Path(self.registry)
        if old.exists():
            import shutil

            shutil.rmtree(old)
        new.rename(old)

    def apply(self, submission: dict, all_packs: bool = False) -> dict:
        """Store one submission and bring its pack's promotions in.

        The registry then holds the review decisions of this pack alone, as earlier ones are dropped;
        ``all_packs`` replays every pack that has submissions instead.
        """
        if submission.get("submission_type") != "review_submission" or submission.get("review_stage") != review.CANDIDATE_STAGE:
            raise ValueError("not a submission of this stage")
        pack_id = str(submission["pack_id"])
        tables.find_pack(self.spark, self.packs, schemas.PACK, pack_id)
        name = X.safe_name(str(submission["submission_id"]))
        tables.write_json(Path(self.submissions) / f"{name}.json", submission)
        states, promoted = self._promoted(pack_id)
        new = promoted
        if all_packs:
            others = [r[0] for r in self.spark.read.schema("pack_id string").option("multiLine", True).json(self.submissions).distinct().collect() if r[0] and r[0] != pack_id]
            for p in sorted(others):
                new = new.unionByName(self._promoted(p)[1].join(new.select("entity_key"), "entity_key", "left_anti").select(*new.columns))
        self._replace_registry(ledgers.rewrite_with_promotions(self.decisions(), new))
        return review.import_summary(states, promoted).first().asDict() | {"submission_id": submission["submission_id"], "pack_id": pack_id}

    def _promoted(self, pack_id: str) -> tuple[DataFrame, DataFrame]:
        items = tables.find_pack(self.spark, self.packs, schemas.PACK, pack_id).select(F.inline("items"))
        given = tables.submissions(self.spark, self.submissions, schemas.SUBMISSION, review.CANDIDATE_STAGE, pack_id)
        states = review.replay(items, given)
        return states, review.promoted(items, states, pack_id)

    def inbox(self, bodies: DataFrame, fetch: Callable[[str], dict]) -> DataFrame:
        """Import what issues hold: attachments (``fetch`` loads an address) first, then inline submissions.

        Returns a row for each with the reason why it was turned away, null if it was taken; one that
        can't be loaded or applied is turned away too, and the others go on.
        """
        found, reasons = [], []
        for r in review.attachments(bodies).orderBy("number", "line_no", "url").collect():
            try:
                found.append(dict(fetch(r["url"])))
                reasons.append(None)
            except (OSError, ValueError, TypeError, KeyError) as e:
                found.append({})
                reasons.append(f"not_loaded: {e}")
        found += [json.loads(r["json"]) for r in review.inline_json(bodies).orderBy("number", "line_no", "i").collect()]
        reasons += [None] * (len(found) - len(reasons))
        schema = "line_no int, submission_type string, review_stage string, submission_id string, pack_id string"
        rows = [(i, s.get("submission_type"), s.get("review_stage"), str(s.get("submission_id") or ""), str(s.get("pack_id"))) for i, (s, why) in enumerate(zip(found, reasons, strict=True)) if why is None]
        known = self.spark.read.schema("pack_id string").option("multiLine", True).option("recursiveFileLookup", True).json(self.packs)
        routed = review.route_submissions(self.spark.createDataFrame(rows, schema), known)
        done = {r["line_no"]: r.asDict() for r in routed.orderBy("line_no").collect()}
        for i, r in sorted(done.items()):
            if r["reason"] is None:
                try:
                    self.apply(found[i])
                except (OSError, ValueError, TypeError, KeyError) as e:
                    r["reason"] = f"not_applied: {e}"
        none = dict.fromkeys(routed.columns)
        return self.spark.createDataFrame([tuple((done.get(i) or none | {"line_no": i, "reason": why}).values()) for i, why in enumerate(reasons)], routed.schema)


def manifest(spark: SparkSession, packs: str) -> dict:
    """The site's manifest from the packs of a folder."""
    rows = tables._json_files(spark, packs, schemas.PACK, True)
    stem = F.regexp_extract("source_path", r"([^/]*)\.json$", 1)
    rows = rows.select("pack_id", X.pack_title(F.col("review_stage"), F.col("pack_id"), stem).alias("title"), "review_stage", X.pack_track(F.col("track_name"), F.col("pack_id"), stem).alias("track_name"), F.coalesce("created_at_epoch", F.lit(0)).alias("created_at_epoch"), F.coalesce("item_count", F.size("items")).alias("item_count"), F.concat("pack_id", F.lit(".json")).alias("site_filename"))
    made = review.manifest_packs(rows)
    stages: dict[str, dict] = {}
    for r in made.orderBy("review_stage", "created_at_epoch", "pack_id").collect():
        s = stages.setdefault(r["review_stage"], {"review_stage": r["review_stage"], "label": r["label"], "latest_pack_id": r["latest_pack_id"], "latest_pack_ids_by_track": {}, "packs": []})
        s["packs"].append({k: r[k] for k in ("pack_id", "title", "path", "track_name", "created_at_epoch", "item_count", "status")})
        if r["is_latest_of_track"]:
            s["latest_pack_ids_by_track"][r["track_name"]] = r["pack_id"]
    current = {r["track_name"]: r.asDict() for r in review.current_tracks(made).collect()}
    return {"schema_version": 1, "default_stage": review.default_stage(made).first()[0], "current_tracks": current, "stages": stages}
