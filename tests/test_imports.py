import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import prompts, review
from corpusloom.plans import experiments, imports

STAGE = review.CANDIDATE_STAGE


def pack(pack_id, keys, track=None, epoch=1):
    return {"review_stage": STAGE, "pack_id": pack_id, "created_at_epoch": epoch, "track_name": track, "items": [{"item_id": f"entity:{k}", "seq": i, "entity_key": k, "strict_case": False, "proposed_action": a} for i, (k, a) in enumerate(keys, 1)]}


def submission(sid, pack_id, epoch, lo, hi, overrides=()):
    return {"submission_type": "review_submission", "review_stage": STAGE, "submission_id": sid, "pack_id": pack_id, "generated_at_epoch": epoch, "reviewed_ranges": [{"from_seq": lo, "to_seq": hi}], "overrides": [{"item_id": i, "decision": d} for i, d in overrides]}


def test_importing_a_pack(spark, tmp_path):
    packs = tmp_path / "packs"
    packs.mkdir()
    (packs / "alphabetic_candidates_batch_0001_v1.json").write_text(json.dumps(pack("p1", [("a", "whitelist"), ("b", "blacklist"), ("c", "whitelist")])))
    (packs / "dev_batch_0001.json").write_text(json.dumps(pack("p2", [("z", "whitelist")], epoch=5)))
    (packs / "broken.json").write_text("{")
    store = imports.Store(spark, str(packs), str(tmp_path / "subs"), str(tmp_path / "registry"))
    spark.createDataFrame([("m", False, "whitelist", "manual", ""), ("c", False, "blacklist", "manual", "")], schemas.DECISION).write.parquet(store.registry)
    got = store.apply(submission("s/1", "p1", 1, 3, 1, [("entity:b", "reject")]))
    assert (got["accepted_count"], got["rejected_count"], got["promoted_whitelist_count"]) == (2, 1, 2) and (tmp_path / "subs/s_1.json").exists()
    rows = {r["entity_key"]: (r["status"], r["source"]) for r in store.decisions().collect()}
    assert rows == {"m": ("whitelist", "manual"), "a": ("whitelist", f"review:{STAGE}"), "c": ("whitelist", f"review:{STAGE}")}
    store.apply(submission("s2", "p2", 2, 1, 1))
    assert {r["entity_key"] for r in store.decisions().collect()} == {"m", "z"}  # other packs' promotions go
    store.apply(submission("s3", "p2", 3, 1, 1), all_packs=True)
    assert {r["entity_key"] for r in store.decisions().collect()} == {"m", "a", "c", "z"}
    bodies = spark.createDataFrame([(1, 0, json.dumps(submission("s4", "p1", 4, 1, 3))), (1, 1, json.dumps(submission("s4", "p1", 4, 1, 3))), (1, 2, json.dumps(submission("s5", "nope", 4, 1, 3)))], "number int, line_no int, body string")
    assert [r["reason"] for r in store.inbox(bodies, lambda url: {}).orderBy("line_no").collect()] == [None, "duplicate_submission_id", "unknown_pack_id"]
    url = "https://github.com/user-attachments/files/{}/s.json"

    def fetch(address):
        if "/1/" in address:
            raise OSError("gone")
        return submission("s6", "p1", 6, 1, 3) if "/2/" in address else submission("s7", "p1", 7, 1, 1) | {"reviewed_ranges": [{"from_seq": "x"}]}

    found = spark.createDataFrame([(1, 0, " ".join(url.format(k) for k in (1, 2))), (1, 1, json.dumps(submission("s8", "p1", 8, 1, 1)))], "number int, line_no int, body string")
    assert [(r["submission_id"], r["reason"]) for r in store.inbox(found, fetch).orderBy("line_no").collect()] == [(None, "not_loaded: gone"), ("s6", None), ("s8", None)]
    m = imports.manifest(spark, str(packs))
    assert m["default_stage"] == STAGE and set(m["current_tracks"]) == {"working", "dev"}
    s = m["stages"][STAGE]
    assert s["latest_pack_id"] == "p1" and [p["status"] for p in s["packs"]] == ["active-working", "active-dev"] and s["packs"][0]["title"] == "Alphabetic candidates / batch_0001 / v1"


def test_manifest_ties_and_default(spark):
    rows = spark.createDataFrame([("b", "t", "s1", None, 1, 1, "b.json"), ("c", "t", "s1", "dev", 1, 1, "c.json"), ("a", "t", "s1", None, 1, 1, "a.json"), ("d", "t", "s2", "dev", 9, 1, "d.json")], "pack_id string, title string, review_stage string, track_name string, created_at_epoch long, item_count int, site_filename string")
    made = {r["pack_id"]: r for r in review.manifest_packs(rows).collect()}
    assert {k: r["status"] for k, r in made.items()} == {"a": "archived", "b": "active-working", "c": "active-dev", "d": "active-dev"}
    assert made["a"]["latest_pack_id"] == "b" and made["d"]["latest_pack_id"] == "d"


def test_prompt_experiment(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u1", "x", "in_scope"), (2, "u2", "y", "out_of_scope"), (3, "u3", "z", None)], "line_no int, unit_id string, text string, expected_status string")

    def backend():
        return lambda prompt: {"text": '{"status": "in_scope"}' if "x" in prompt else "?" if "z" in prompt else '```{"status": "in_scope"}```', "usage": {"input_tokens": 100, "output_tokens": 10}}

    prices = spark.createDataFrame([("m", "standard", 1.0, 0.5, 2.0)], schemas.PRICING)
    task = prompts.Task("classical_japanese_judge", "other", "{text}", "classical_japanese_judge")
    out = experiments.run_prompts(rows, task, backend, prices, tmp_path / "run", model="m")
    assert (out["score"]["pass_count"], out["score"]["parse_error_count"], out["fail_item_ids"]) == (1, 1, ["u2", "u3"])
    assert out["usage"]["estimated_cost_usd"] == round(3 * (100 / 1e6 + 20 / 1e6), 10)
    assert json.loads((tmp_path / "run/summary.json").read_text())["effective_config"]["model"] == "m"
    with pytest.raises(KeyError):
        experiments.matched(rows.withColumnRenamed("unit_id", "item_id"), rows.limit(1).withColumnRenamed("unit_id", "item_id").select("item_id"))
    assert experiments.job_summary({"item_count": 4}, {"state": "fetched"}, None, prices)["item_count"] == 4


def test_drafts(spark):
    rows = spark.createDataFrame([(5, 9, -2, [("a", 3, "reject"), ("b", 4, "accept"), ("c", 6, "reject")]), (0, 1, 1, [])], "item_count int, from_seq int, to_seq int, overrides array<struct<item_id:string,seq:int,decision:string>>")
    got = review.effective_submission(rows).orderBy(F.desc("item_count")).collect()
    assert [tuple(r) for r in got[0]["reviewed_ranges"]] == [(1, 5)] and [o["item_id"] for o in got[0]["overrides"]] == ["a"] and got[1]["reviewed_ranges"] == []
