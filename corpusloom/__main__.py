"""Command line: ``python -m corpusloom COMMAND ...``, results printed as JSON. Tables are JSON lines (files or folders); ``--help`` of a command lists its options."""

from __future__ import annotations

import argparse
import json
import os
import time
from pathlib import Path

LISTS = ("whitelist", "blacklist", "cs_whitelist", "cs_blacklist")
#: Options of the commands: names end in ! if they are required, values are defaults.
COMMANDS: dict[str, dict] = {
    "prepare": {"track": "working", "source!": None, "dataset!": None, "documents": 100},
    "next": {"track": "working", "force_stage": None, "yes": False, "reader": None},
    "status": {"track": "working"},
    "first-batch": {"source!": None, "dataset!": None, "documents": 100, "output!": None},
    "analyze": {"units!": None, "lists": "lists", "decisions": None, "batch_name": "batch", "output!": None},
    "report": {"types!": None, "output!": None, "min_occurrences": 1, "max_examples": 3, "max_chars": 160},
    "ingest": {"results!": None, "batch_name!": None, "ledger!": None},
    "candidates": {"ledger!": None, "decisions": None, "threshold": 3, "output!": None},
    "pack": {"candidates!": None, "pack_id!": None, "output!": None},
    "upsert": {"decisions!": None, "entity_key!": None, "status!": None, "strict_case": False, "source": "manual", "note": ""},
    "apply-submission": {"submission!": None, "packs!": None, "submissions!": None, "registry!": None},
    "import-issue": {"url!": None, "numbers": "", "token": None, "packs!": None, "submissions!": None, "registry!": None},
    "import-inbox": {"url!": None, "token": None, "packs!": None, "submissions!": None, "registry!": None},
    "manifest": {"packs!": None},
    "publish": {"packs!": None, "assets!": None, "output!": None},
    "task": {"mode!": None, "task_config": None, "input": None, "output": None, "job": None, "jobs": "runs/llm", "url": "https://api.openai.com", "key_file": None},
    "prompt-experiment": {"task_config!": None, "input!": None, "run!": None, "pricing!": None, "tier": "standard", "model": None, "verbosity": None, "reasoning_effort": None, "max_output_tokens": 0, "url": "https://api.openai.com", "key_file": None},
    "compare-prompts": {"base!": None, "candidate!": None},
    "reading-experiment": {"input!": None, "strategy": "aligned_hybrid_v1", "reader": None, "run!": None},
    "compare-readings": {"base!": None, "candidate!": None},
    "read": {"units!": None, "strategy": "aligned_hybrid_v1", "reader": None, "limit": 0, "output!": None},
    "export": {"units!": None, "variant": "aligned_hybrid", "reader": None, "output!": None},
    "export-text": {"units!": None, "strategy": "aligned_hybrid_v1", "reader": None, "output!": None},
    "debug-compare": {"units!": None, "folder!": None, "reader": None, "output!": None},
    "count-tokens": {"text": None, "file": None, "task_config": None, "input": None, "encoding": "o200k_base"},
    "usage": {"job": None, "results": None, "model": None, "tier": "standard", "pricing!": None},
}
MODES = ("sync", "batch_prepare", "prepare_batch_job", "submit_batch_job", "poll_batch_job", "fetch_batch_job", "list_batch_jobs")


def parsed(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    p.add_argument("--root", default=".")
    sub = p.add_subparsers(dest="command", required=True)
    for command, options in COMMANDS.items():
        s = sub.add_parser(command)
        for name, default in options.items():
            flag = f"--{name.rstrip('!').replace('_', '-')}"
            if isinstance(default, bool):
                s.add_argument(flag, action="store_true")
            else:
                s.add_argument(flag, required=name.endswith("!"), default=default, type=int if isinstance(default, int) else str, choices=MODES if name == "mode!" else ("working", "dev") if name == "track" else None)
    return p.parse_args(argv)


class Commands:
    """One method a command; each returns what is printed."""

    def __init__(self, a: argparse.Namespace) -> None:
        from pyspark.sql import SparkSession

        self.a, self.spark = a, SparkSession.builder.getOrCreate()

    # ---- tables

    def _read(self, path: str, schema: str, missing_ok: bool = False):
        from corpusloom.sources import tables

        return tables.json_lines(self.spark, path, schema, missing_ok)

    def _write(self, df, path: str, order: tuple[str, ...] = ()) -> dict:
        """A folder of JSON lines, written beside and moved, so a table may replace what it was read from."""
        import shutil

        from corpusloom.sources import tables

        new = f"{path}.new"
        tables.write_json_lines(df.orderBy(*order) if order else df, new)
        shutil.rmtree(path, ignore_errors=True) if Path(path).is_dir() else Path(path).unlink(missing_ok=True)
        Path(new).rename(path)
        return {"output": path, "rows": self.spark.read.text(path).count()}

    def _units(self):
        from corpusloom import schemas

        return self._read(self.a.units, schemas.UNIT)

    def _annotated(self, rows):
        """With tokens and candidates of the configured analyser and decoder; without one, units have none."""
        from pyspark.sql import functions as F

        from corpusloom import schemas
        from corpusloom.sources import annotators, tables

        if self.a.reader:
            config = tables.toml(self.a.reader)
            return annotators.annotate(rows, lambda: annotators.Both(config))
        empty = lambda kind: F.from_json(F.lit("[]"), f"array<struct<{kind}>>")
        return rows.withColumn("tokens", empty(schemas.TOKEN)).withColumn("candidates", empty(schemas.CANDIDATE))

    def _lists(self, folder: str) -> dict:
        from corpusloom.sources import tables

        return {k: tables.word_list(f, not k.startswith("cs_")) for k in LISTS if (f := Path(folder) / f"{k}.txt").exists()}

    def _client(self):
        from corpusloom.sources.service import Responses

        key = Path(self.a.key_file).read_text(encoding="utf-8").strip() if self.a.key_file else os.environ["OPENAI_API_KEY"]
        return Responses(key, self.a.url)

    def _numbered(self, path: str):
        """Rows of JSON lines with any columns, numbered."""
        from pyspark.sql import functions as F

        from corpusloom.sources import tables

        lines = tables.numbered_lines(self.spark, path)
        schema = self.spark.read.json(path).schema
        return lines.select("line_no", F.from_json("value", schema).alias("r")).select("line_no", "r.*")

    # ---- batches

    def _workspace(self):
        from corpusloom.plans.batches import Workspace

        if not hasattr(self.a, "reader"):
            self.a.reader = None
        return Workspace(self.spark, self.a.root, self._lists(str(Path(self.a.root) / "lists")), self._annotated, lambda: time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))

    def prepare(self):
        from corpusloom.sources import tables

        return self._workspace().prepare(tables.json_documents(self.spark, self.a.source), self.a.dataset, self.a.documents, self.a.track, self.a.source)

    def next(self):
        return self._workspace().advance(self.a.track, self.a.force_stage, self.a.yes)

    def status(self):
        return self._workspace().status(self.a.track)

    def first_batch(self):
        from corpusloom.operators import units
        from corpusloom.sources import tables

        rows = units.units(units.documents(tables.json_documents(self.spark, self.a.source), self.a.dataset, self.a.documents))
        return self._write(rows, self.a.output, ("source_line_no", "unit_seq"))

    # ---- entities and review

    def analyze(self):
        from corpusloom import schemas
        from corpusloom.operators import aggregate, units

        one = self._units()
        decisions = self._read(self.a.decisions, schemas.DECISION, True) if self.a.decisions else None
        occ = units.resolve(units.classify(units.occurrences(one), self._lists(self.a.lists)), decisions)
        done = {"occurrences": self._write(occ, f"{self.a.output}/occurrences.jsonl")}
        occ = self._read(f"{self.a.output}/occurrences.jsonl", schemas.OCCURRENCE + ", occurrence_seq int")
        types = aggregate.attach_examples(aggregate.entity_types(occ), one)
        return done | {"types": self._write(types, f"{self.a.output}/types.jsonl", ("entity_key",)), "evidence": self._write(aggregate.evidence(types, self.a.batch_name), f"{self.a.output}/evidence.jsonl", ("entity_key",)), "units": self._write(aggregate.unit_verdicts(one, occ), f"{self.a.output}/units.jsonl", ("unit_id",))}

    def report(self):
        from corpusloom.operators import aggregate
        from corpusloom.sources import tables

        types = self._read(self.a.types, "entity_key string, strict_case boolean, resolved_status string, base_list_status string, occurrence_count long, unit_count long, surface_forms array<string>, example_unit_ids array<string>, example_texts array<string>")
        rows = aggregate.unresolved_report(types, self.a.min_occurrences, self.a.max_examples, self.a.max_chars)
        tables.write_lines(tables.report_lines(rows), f"{self.a.output}.tsv")
        return self._write(rows, self.a.output) | {"tsv": f"{self.a.output}.tsv", "header": tables.REPORT_HEADER}

    def ingest(self):
        from corpusloom import schemas
        from corpusloom.operators import ledgers, review

        row = "entity_key string, strict_case boolean, occurrence_count long, unit_count long, surface_forms array<string>, example_unit_ids array<string>, example_texts array<string>"
        results = self._read(self.a.results, f"item_id string, parsed struct<status: string, confidence: string, note: string>, parse_error string, metadata struct<source_row: struct<{row}>>")
        new = review.judgments(results, self.a.batch_name, self.a.results)
        return self._write(ledgers.replace_batches(self._read(self.a.ledger, schemas.LLM_JUDGMENT, True), new), self.a.ledger)

    def candidates(self):
        from corpusloom import schemas
        from corpusloom.operators import review

        decided = self._read(self.a.decisions, schemas.DECISION, True) if self.a.decisions else None
        ledger = self._numbered(self.a.ledger)
        return self._write(review.candidates(ledger, decided, self.a.threshold), self.a.output)

    def pack(self):
        from corpusloom.operators import review
        from corpusloom.sources import tables

        facts = "threshold_observations long, supporting_observations long, opposing_observations long, supporting_batch_count long, opposing_batch_count long, source_batches array<string>, confidence_counts map<string, long>"
        rows = self._read(self.a.candidates, f"entity_key string, strict_case boolean, proposed_decision string, surface_forms array<string>, example_texts array<string>, note_samples array<string>, {facts}")
        items = [json.loads(r) for r in review.pack_items(rows).orderBy("seq").toJSON().collect()]  # a pack is what one person reviews
        tables.write_json(self.a.output, {"schema_version": 1, "review_stage": review.CANDIDATE_STAGE, "pack_id": self.a.pack_id, "created_at_epoch": int(time.time()), "item_count": len(items), "items": items})
        return {"output": self.a.output, "item_count": len(items)}

    def upsert(self):
        from corpusloom import schemas
        from corpusloom.operators import ledgers

        row = self.spark.createDataFrame([(self.a.entity_key, self.a.strict_case, self.a.status, self.a.source, self.a.note)], schemas.DECISION)
        return self._write(ledgers.upsert(self._read(self.a.decisions, schemas.DECISION, True), row), self.a.decisions)

    def _store(self):
        from corpusloom.plans import imports

        return imports.Store(self.spark, self.a.packs, self.a.submissions, self.a.registry)

    def apply_submission(self):
        return self._store().apply(json.loads(Path(self.a.submission).read_text(encoding="utf-8")))

    def import_issue(self):
        from corpusloom.sources import issues
        from corpusloom.sources.service import fetch_json

        numbers = [int(x) for x in getattr(self.a, "numbers", "").split(",") if x]
        bodies = issues.bodies(self.spark, lambda url: fetch_json(url, token=self.a.token), self.a.url, numbers or None)
        return [r.asDict() for r in self._store().inbox(bodies, fetch_json).orderBy("line_no").collect()]

    import_inbox = import_issue

    def manifest(self):
        from corpusloom.plans import imports

        return imports.manifest(self.spark, self.a.packs)

    def publish(self):
        from corpusloom.sources import tables

        made = self.manifest()
        tables.publish_site(self.a.packs, self.a.assets, self.a.output, made)
        return made

    # ---- models

    def task(self):
        from corpusloom.operators import prompts
        from corpusloom.plans.jobs import Job
        from corpusloom.sources import tables

        mode = self.a.mode
        if mode == "list_batch_jobs":
            return [r.asDict() for r in tables.batch_jobs(self.spark, self.a.jobs, "task_name string, model string, item_count long", "state string, remote_status string, batch_id string").collect()] if Path(self.a.jobs).exists() else []
        job = Job(self.a.job, lambda: int(time.time())) if self.a.job else None
        if mode == "submit_batch_job":
            return job.submit(self._client())
        if mode == "poll_batch_job":
            return job.poll(self._client())
        if mode == "fetch_batch_job":
            return job.fetch(self._client(), self.spark)
        task, rows = tables.task_config(self.a.task_config), self._numbered(self.a.input)
        if mode == "prepare_batch_job":
            return job.prepare(rows, task)
        items = prompts.items(rows, task)
        if mode == "batch_prepare":
            prompts.requests(items, task).write.mode("overwrite").text(self.a.output)
            return {"task_name": task.task_name, "model": task.model, "mode": mode, "input_builder": task.input_builder, "parser": task.parser, "requests": self.a.output, "item_count": rows.count()}
        return self._write(self._answered(items, task), self.a.output)

    def _answered(self, items, task):
        from pyspark.sql import functions as F

        from corpusloom.operators import responses
        from corpusloom.plans.jobs import PARSED
        from corpusloom.sources.shared import once

        client = self._client()
        said = once(responses.ask(items, lambda: lambda prompt: client.answer(task, prompt)))
        rows = responses.parse(said, PARSED, parser=task.parser).withColumn("usage", responses.usage(F.col("usage_json"))).drop("usage_json")
        return rows.join(items.select("item_id", "metadata"), "item_id")

    def prompt_experiment(self):
        from corpusloom.plans import experiments
        from corpusloom.sources import tables

        client, task = self._client(), tables.task_config(self.a.task_config)
        changed = {k: getattr(self.a, k) or None for k in ("model", "verbosity", "reasoning_effort", "max_output_tokens")}
        return experiments.run_prompts(self._numbered(self.a.input), task, lambda: lambda prompt: client.answer(task, prompt), tables.pricing(self.spark, self.a.pricing), self.a.run, self.a.tier, lambda: int(time.time()), **changed)

    def compare_prompts(self):
        from corpusloom.operators import responses

        base, other = (self.spark.read.parquet(f"{d}/scored.parquet") for d in (self.a.base, self.a.candidate))
        score = [responses.score_summary(x) for x in (base, other)]
        return {"delta": responses.score_delta(*score).first().asDict(), "items": [r.asDict() for r in responses.compare(base, other).orderBy("item_id").collect()]}

    def count_tokens(self):
        import tiktoken

        from corpusloom.functions import text as X
        from corpusloom.operators import prompts
        from corpusloom.sources import tables

        name = self.a.encoding
        if self.a.task_config:
            items = prompts.items(self._numbered(self.a.input), tables.task_config(self.a.task_config))
            return prompts.size_summary(items, X.token_counts(lambda t: tiktoken.get_encoding(name).encode(t))).first().asDict()
        text = self.a.text if self.a.text is not None else Path(self.a.file).read_text(encoding="utf-8")
        return {"encoding": name, "token_count": len(tiktoken.get_encoding(name).encode(text)), "character_count": len(text)}

    def usage(self):
        from pyspark.sql import functions as F

        from corpusloom.operators import responses
        from corpusloom.plans import experiments
        from corpusloom.plans.jobs import Job
        from corpusloom.schemas import USAGE
        from corpusloom.sources import tables

        prices = tables.pricing(self.spark, self.a.pricing)
        if self.a.job:
            job = Job(self.a.job, lambda: int(time.time()))
            return experiments.job_summary(job._json("manifest.json"), job.status, job.results(self.spark), prices)
        rows = self._read(self.a.results, f"item_id string, usage struct<{USAGE}>").withColumns({"model": F.lit(self.a.model), "tier": F.lit(self.a.tier)})
        return responses.usage_summary(responses.priced(rows, prices)).first().asDict()

    # ---- readings

    def read(self):
        from corpusloom.operators import readings

        rows = self._annotated(self._units())
        if not self.a.limit:
            return self._write(readings.apply(rows, self.a.strategy), self.a.output)
        from corpusloom.sources.shared import numbered

        return self._write(readings.limited(numbered(rows, "line_no", "source_line_no", "unit_seq"), self.a.strategy, self.a.limit).drop("line_no"), self.a.output)

    def export(self):
        from corpusloom.plans import exports

        return exports.export(self._annotated(self._units()), self.a.variant, self.a.output)

    def export_text(self):
        from pyspark.sql import functions as F

        from corpusloom.operators import readings

        readings.export_text(self._annotated(self._units()).withColumn("rendered", F.lit(None).cast("string")), self.a.strategy).write.mode("overwrite").text(self.a.output)
        return {"output": self.a.output}

    def debug_compare(self):
        from corpusloom.plans import exports

        return exports.debug_texts(self.spark, self._annotated(self._units()), self.a.folder, self.a.output)

    def reading_experiment(self):
        from corpusloom.plans import experiments
        from corpusloom.sources import tables

        rows = self._annotated(self._read(self.a.input, "item_id string, text string, expected_rendered string, note string"))
        done, summary = experiments.run_readings(rows, self.a.strategy)
        done.write.mode("overwrite").parquet(f"{self.a.run}/rows.parquet")
        out = summary.first().asDict() | {"strategy": self.a.strategy}
        tables.write_json(f"{self.a.run}/summary.json", out)
        return out

    def compare_readings(self):
        from corpusloom.operators import readings

        base, other = (self.spark.read.parquet(f"{d}/rows.parquet") for d in (self.a.base, self.a.candidate))
        return [r.asDict() for r in readings.compare_runs(base, other).orderBy("item_id").collect()]


def main(argv: list[str] | None = None) -> None:
    a = parsed(argv)
    out = getattr(Commands(a), a.command.replace("-", "_"))()
    print(json.dumps(out, ensure_ascii=False, indent=2, default=str))


if __name__ == "__main__":
    main()
