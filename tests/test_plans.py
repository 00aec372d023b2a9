import gzip
import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import prompts
from corpusloom.plans.batches import GATES, Workspace
from corpusloom.plans.jobs import Job, local_state
from corpusloom.sources import service, tables
from corpusloom.sources.shared import numbered
from corpusloom.streaming import units as stream


def tokenize(rows):
    t = F.array(F.struct(F.col("text").alias("surface"), F.lit("名詞,").alias("pos"), F.col("text").alias("dictionary_form"), F.col("text").alias("normalized_form"), F.lit("r").alias("reading")))
    return rows.withColumn("tokens", t).withColumn("candidates", F.from_json(F.lit("[]"), f"array<struct<{schemas.CANDIDATE}>>"))


def test_a_batch_goes_through_its_stages(spark, tmp_path):
    src = tmp_path / "d.jsonl.gz"
    with gzip.open(src, "wt", encoding="utf-8") as f:
        f.writelines(json.dumps(x, ensure_ascii=False) + "\n" for x in ({"text": "Android。foo", "source_file": "s"}, {"text": 5}, {"text": " "}, {"text": "bar"}))
    docs = tables.json_documents(spark, str(src))
    assert [(r[0], r[1]) for r in docs.collect()] == [(1, "Android。foo"), (2, None), (3, " "), (4, "bar")]
    ws = Workspace(spark, tmp_path / "w", {"whitelist": ["android"]}, tokenize, lambda: "2024-01-01T00:00:00Z")
    assert ws.status()["current_batch_name"] is None and not ws.advance()["advanced"]
    assert (made := ws.prepare(docs, "d", 10))["batch_name"] == "batch_0001" and made["docs_written"] == 2 and made["units_written"] == 3
    for stage in ("alphabetic_analyzed", "alphabetic_reported", "yomi_generated"):
        assert ws.advance()["current_stage"] == stage
    assert not ws.advance()["advanced"]
    assert ws.advance(force="yomi_generated")["requires_confirmation"] and ws.advance(force="yomi_generated", overwrite=True)["forced"]
    assert not ws.advance(force="prepared")["advanced"]
    (tmp_path / "w/state/batches/batch_0001.json").unlink()
    assert ws.batch("batch_0001")["current_stage"] == "yomi_generated"  # inferred from artifacts
    assert ws.prepare(docs, "d", 1, "dev")["batch_name"] == "dev_batch_0001" and ws.advance("dev")["skipped_review_gates"] == GATES
    with pytest.raises(ValueError):
        ws.status("other")


class Fake:
    def submit(self, requests, endpoint, window):
        return {"id": "b1", "status": "validating"}

    def retrieve(self, batch_id):
        return {"status": "completed", "output_file_id": "o1"}

    def download(self, file_id, to):
        said = [{"custom_id": "u1", "response": {"body": {"output_text": '{"status": "in_scope"}', "usage": {"input_tokens": 3, "output_tokens": 1}}}}, {"custom_id": "u2", "response": {"output_text": "no"}}, {"custom_id": "lost"}]
        open(to, "w").write("".join(json.dumps(x) + "\n" for x in said) + "\n")


def test_batch_jobs(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u1", "t"), (2, "u2", "v")], "line_no int, unit_id string, text string")
    job = Job(tmp_path / "j", lambda: 7)
    job.prepare(rows, prompts.Task("classical_japanese_judge", "gpt-5.4", "{text}", "classical_japanese_judge", verbosity="low"))
    with pytest.raises(ValueError):
        job.poll(Fake())
    assert job.submit(Fake())["state"] == "running"  # the service is validating
    with pytest.raises(ValueError):
        job.submit(Fake())
    with pytest.raises(ValueError):
        job.fetch(Fake(), spark)
    assert job.poll(Fake())["state"] == "completed" and job.fetch(Fake(), spark)["fetched_at_epoch"] == 7 and job.status["state"] == "fetched"
    got = {r["item_id"]: r for r in job.results(spark).collect()}
    assert got["u1"]["parsed"]["status"] == "in_scope" and got["u1"]["usage"]["total_tokens"] == 4 and got["u1"]["metadata"]["source_row"]["text"] == "t"
    assert got["u2"]["parsed"] is None and got["u2"]["parse_error"] and (got["lost"]["raw_text"], got["lost"]["parse_error"], got["lost"]["metadata"]) == ("", None, None)
    line = json.loads(spark.read.text(str(tmp_path / "j/requests")).where("value like '%u1%'").first()[0])
    assert line["custom_id"] == "u1" and line["body"]["text"] == {"verbosity": "low"} and "reasoning" not in line["body"]
    assert tables.batch_jobs(spark, str(tmp_path), "item_count long", "state string").first()["state"] == "fetched"


def test_states_of_a_job():
    said = "submitted validating in_progress finalizing completed failed expired cancelling cancelled".split()
    assert [local_state(x) for x in said] == "submitted running running running completed failed expired cancelled cancelled".split()
    assert local_state("anything") == local_state(None) == "submitted"


def test_service_and_configs(spark, tmp_path):
    """Requests of the client as a service sees them, and tasks and prices from their files."""
    asked = []

    def send(request):
        path = request.full_url.removeprefix("http://s")
        asked.append((request.get_method(), path, request.data))
        return json.dumps({"/v1/responses": {"output": [{"type": "message", "content": [{"text": ""}, {"text": "hi"}]}], "usage": {"input_tokens": 1}}, "/v1/files": {"id": "f1"}, "/v1/batches": {"id": "b1", "status": "validating"}, "/v1/batches/b1": {"id": "b1", "status": "completed", "output_file_id": "o1"}}.get(path, {"custom_id": "u1"})).encode()

    (tmp_path / "prompt.txt").write_text("Say {text}")
    (tmp_path / "task.toml").write_text('task_name = "yomi_check"\ninput_builder = "yomi_check"\nparser = "json_object"\nmodel = "gpt-5.4"\nprompt_template = "prompt.txt"\nverbosity = "low"\n')
    task = tables.task_config(tmp_path / "task.toml")
    assert (task.max_output_tokens, task.endpoint, task.reasoning_effort, task.prompt_template) == (512, "/v1/responses", None, "Say {text}")
    (tmp_path / "prices.toml").write_text('[models."m".batch]\ninput_per_1m = 1\ncached_input_per_1m = 0.5\noutput_per_1m = 2.0\n')
    assert [tuple(r) for r in tables.pricing(spark, tmp_path / "prices.toml").collect()] == [("m", "batch", 1.0, 0.5, 2.0)]
    client = service.Responses("k", "http://s/", send)
    assert client.answer(task, "x") == {"text": "hi", "usage": {"input_tokens": 1}}
    body = json.loads(asked[0][2])
    assert body["text"] == {"verbosity": "low"} and "reasoning" not in body and body["max_output_tokens"] == 512
    job = Job(tmp_path / "j", lambda: 1)
    job.prepare(spark.createDataFrame([(1, "u1", "t", "")], "line_no int, unit_id string, text string, rendered string"), task)
    assert job.submit(client)["state"] == "running" and b'"custom_id":"u1"' in asked[1][2]
    assert job.poll(client)["state"] == "completed" and job.fetch(client, spark)["state"] == "fetched"
    with pytest.raises(ValueError):
        service.Responses("k", "http://s", lambda r: b"{}").answer(task, "x")


def test_lines_are_numbered_over_partitions(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for i in range(5):
        (tmp_path / "t" / f"{i}.txt").write_text("".join(f"{i}:{j}\n" for j in range(40)))
    rows = tables.numbered_lines(spark, str(tmp_path / "t")).collect()
    assert sorted(r["line_no"] for r in rows) == [*range(1, 201)] and len({r["value"] for r in rows}) == 200
    made = numbered(spark.range(1000).repartition(7).withColumn("k", -F.col("id")), "n", "k").collect()
    assert all(r["n"] == 1000 - r["id"] for r in made) and numbered(spark.range(0), "n", "id").count() == 0


def test_word_lists_and_streams(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# c\n Foo \n\nbar\n")
    assert tables.word_list(tmp_path / "w.txt", True) == ["foo", "bar"]
    spark.createDataFrame([(1, "d:1", "Foo x。Bar", "")], schemas.DOCUMENT).write.parquet(str(tmp_path / "in"))
    stream.drain(stream.occurrences(stream.read(spark, str(tmp_path / "in"), schemas.DOCUMENT), {"whitelist": ["bar"]}), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted((r["entity_key"], r["base_list_status"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("Bar", "unknown"), ("foo x", "unknown")]
