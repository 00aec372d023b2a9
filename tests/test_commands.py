"""The command line from documents to a registry, over folders of JSON lines."""

import json

import pytest

from corpusloom import __main__ as command


def run(capsys, *argv):
    command.main([str(x) for x in argv])
    return json.loads(capsys.readouterr().out)


def test_every_command_has_a_method():
    assert all(callable(getattr(command.Commands, c.replace("-", "_"))) for c in command.COMMANDS)
    with pytest.raises(SystemExit):
        command.parsed(["report"])


def test_from_documents_to_the_registry(spark, tmp_path, capsys):
    t = lambda name: str(tmp_path / name)
    (tmp_path / "docs.jsonl").write_text("".join(json.dumps({"text": x}) + "\n" for x in ("Zebra and Okapi。Zebra", "", "Okapi Android")))
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists/whitelist.txt").write_text("android\n")
    assert run(capsys, "first-batch", "--source", t("docs.jsonl"), "--dataset", "d", "--documents", 5, "--output", t("units"))["rows"] == 3
    done = run(capsys, "analyze", "--units", t("units"), "--lists", t("lists"), "--output", t("made"))
    assert done["occurrences"]["rows"] == 3 and done["types"]["rows"] == 3 and done["units"]["rows"] == 3
    report = run(capsys, "report", "--types", t("made/types.jsonl"), "--output", t("report"))
    assert report["rows"] == 3 and len(spark.read.text(t("report.tsv")).collect()) == 3
    types = [json.loads(r[0]) for r in spark.read.text(t("made/types.jsonl")).collect()]
    results = [{"item_id": x["entity_key"], "parsed": {"status": "in_scope", "confidence": "high", "note": "n"}, "parse_error": None, "metadata": {"source_row": x | {"occurrence_count": 5}}} for x in types]
    (tmp_path / "results.jsonl").write_text("".join(json.dumps(x) + "\n" for x in results))
    for batch in ("b1", "b2", "b2"):  # a batch that comes again replaces itself
        ledger = run(capsys, "ingest", "--results", t("results.jsonl"), "--batch-name", batch, "--ledger", t("ledger"))
    assert ledger["rows"] == 6
    assert run(capsys, "upsert", "--decisions", t("decisions"), "--entity-key", types[0]["entity_key"], "--status", "whitelist")["rows"] == 1
    assert run(capsys, "candidates", "--ledger", t("ledger"), "--decisions", t("decisions"), "--threshold", 9, "--output", t("candidates"))["rows"] == 2
    (tmp_path / "packs").mkdir()
    assert run(capsys, "pack", "--candidates", t("candidates"), "--pack-id", "p1", "--output", t("packs/p1.json"))["item_count"] == 2
    pack = json.loads((tmp_path / "packs/p1.json").read_text())
    assert [i["seq"] for i in pack["items"]] == [1, 2] and pack["items"][0]["evidence"]["source_batches"] == ["b1", "b2"]
    (tmp_path / "s.json").write_text(json.dumps({"submission_type": "review_submission", "review_stage": pack["review_stage"], "submission_id": "s1", "pack_id": "p1", "generated_at_epoch": 1, "reviewed_ranges": [{"from_seq": 1, "to_seq": 2}], "overrides": []}))
    assert run(capsys, "apply-submission", "--submission", t("s.json"), "--packs", t("packs"), "--submissions", t("subs"), "--registry", t("registry"))["accepted_count"] == 2
    assert run(capsys, "publish", "--packs", t("packs"), "--assets", t("none"), "--output", t("site"))["default_stage"] == pack["review_stage"]
    assert (tmp_path / "site/review/packs/p1.json").exists() and (tmp_path / "site/index.html").exists()


def test_tasks_readings_and_usage(spark, tmp_path, capsys):
    t = lambda name: str(tmp_path / name)
    (tmp_path / "p.txt").write_text("Say {text}")
    (tmp_path / "task.toml").write_text('task_name = "yomi_check"\ninput_builder = "yomi_check"\nparser = "json_object"\nmodel = "m"\nprompt_template = "p.txt"\n')
    (tmp_path / "prices.toml").write_text('[models."m".batch]\ninput_per_1m = 1\ncached_input_per_1m = 0.5\noutput_per_1m = 2.0\n')
    (tmp_path / "in.jsonl").write_text('{"unit_id": "u1", "text": "x"}\n{"unit_id": "u2", "text": "y"}\n')
    assert run(capsys, "task", "--mode", "prepare_batch_job", "--task-config", t("task.toml"), "--input", t("in.jsonl"), "--job", t("jobs/j1"))["state"] == "prepared"
    assert run(capsys, "task", "--mode", "batch_prepare", "--task-config", t("task.toml"), "--input", t("in.jsonl"), "--output", t("requests"))["item_count"] == 2
    assert run(capsys, "task", "--mode", "list_batch_jobs", "--jobs", t("jobs"))[0]["item_count"] == 2
    assert run(capsys, "usage", "--job", t("jobs/j1"), "--pricing", t("prices.toml"))["item_count"] == 2
    (tmp_path / "units.jsonl").write_text(json.dumps({"doc_id": "d", "unit_id": "u1", "unit_seq": 1, "text": "a", "source_line_no": 1}) + "\n")
    assert run(capsys, "read", "--units", t("units.jsonl"), "--limit", 1, "--output", t("read"))["rows"] == 1
    made = run(capsys, "export", "--units", t("units.jsonl"), "--output", t("out"))
    assert spark.read.text(made["txt"]).count() == 1
    (tmp_path / "eval.jsonl").write_text('{"item_id": "i", "text": "a", "expected_rendered": ""}\n')
    for name in ("r1", "r2"):
        assert run(capsys, "reading-experiment", "--input", t("eval.jsonl"), "--run", t(name))["exact_match_count"] == 1
    assert run(capsys, "compare-readings", "--base", t("r1"), "--candidate", t("r2")) == []
