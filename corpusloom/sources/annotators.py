"""External tokenizer and decoder: one long-lived worker a partition instead of two processes a unit."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import readings

#: text -> (analyser lines, decoder JSON); null where a side isn't there. A ``close`` of it is called at the end.
Annotator = Callable[[str], tuple[str | None, str | None]]


def annotate(units: DataFrame, start: Callable[[], Annotator]) -> DataFrame:
    """``units`` (text and more) plus tokens and candidates; ``start`` runs once a partition, on the executor. A narrow map: the answers stay beside their rows."""
    rows = units.drop("tokens", "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = start()
        try:
            for b in batches:
                got = [worker(t) if t is not None else (None, None) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([g[j] for g in got], pa.string()) for j in (0, 1))], [*b.schema.names, "_tokens", "_candidates"])
        finally:
            getattr(worker, "close", lambda: None)()

    said = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("_tokens", T.StringType()), T.StructField("_candidates", T.StringType())]))
    return said.withColumns({"tokens": readings.parse_tokens(F.col("_tokens")), "candidates": readings.parse_candidates(F.col("_candidates"))}).drop("_tokens", "_candidates")


class LineWorker:
    """A process that answers each input line with lines up to ``end``."""

    def __init__(self, command: list[str], end: str = "EOS") -> None:
        self.process, self.end = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, encoding="utf-8"), end

    def __call__(self, text: str) -> str:
        self.process.stdin.write(text.replace("\n", " ") + "\n")
        self.process.stdin.flush()
        lines = []
        for line in self.process.stdout:
            if line.rstrip("\n") == self.end:
                break
            lines.append(line)
        return "".join(lines)

    def close(self) -> None:
        self.process.stdin.close()
        self.process.wait(10)
        self.process.stdout.close()


def line_worker(command: list[str], end: str = "EOS") -> Callable[[], LineWorker]:
    return lambda: LineWorker(command, end)


class Both:
    """Analyser and decoder of a configuration (sections ``sudachi`` and ``decoder``): the analyser stays, the decoder is called for each text."""

    def __init__(self, config: dict) -> None:
        self.analyser = LineWorker([config["sudachi"]["command"], *config["sudachi"].get("args", [])])
        d = config.get("decoder")
        self.decoder = d and [d.get("python", "python"), d["script"], "--config", d["config"], "--json", "--nbest", str(d.get("nbest", 1)), *(["--original-segments"] if d.get("original_segments") else []), *(["--beam", str(d["beam"])] if d.get("beam") is not None else [])]

    def __call__(self, text: str) -> tuple[str, str | None]:
        said = subprocess.run([*self.decoder, "--text", text], text=True, capture_output=True, check=True).stdout if self.decoder else None
        return self.analyser(text), said

    def close(self) -> None:
        self.analyser.close()
