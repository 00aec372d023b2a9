import json

import pytest

from corpusloom.operators import readings
from corpusloom.plans import exports
from corpusloom.sources import annotators

DECODED = {"results": [{"rank": 1, "score": -1.5, "entries": [{"surface": "東京", "reading": "トウキョウ", "final_order": 1}, {"surface": "へ", "reading": "エ"}]}]}


def test_annotate_and_export(spark, tmp_path):
    decoded = json.dumps(DECODED)

    def start():
        return lambda text: ("東京\t名詞,固有名詞\t東京\t東京\tトウキョウ\nshort\n\nへ\t助詞,格助詞\tへ\tへ\tヘ\nEOS\n", decoded if text == "東京へ" else None)

    one = spark.createDataFrame([("u1", "東京へ"), ("u2", "東京へ ")], "unit_id string, text string")
    rows = annotators.annotate(one, start)
    assert [t["surface"] for t in rows.where("unit_id = 'u1'").first()["tokens"]] == ["東京", "へ"]
    with pytest.raises(FileNotFoundError):
        exports.debug_texts(spark, rows, str(tmp_path), str(tmp_path / "debug"))
    made = exports.export(rows, "aligned_hybrid", str(tmp_path))
    assert sorted(r[0] for r in spark.read.text(made["txt"]).collect()) == ["u1\t東京/トウキョウ へ/ヘ", "u2\t東京/トウキョウ へ/ヘ"]
    both = exports.debug_texts(spark, rows, str(tmp_path), str(tmp_path / "debug"))
    assert spark.read.text(both["sudachi_only"]["txt"]).count() == 2
    with pytest.raises(ValueError):
        exports.export(rows, "other", str(tmp_path))


def test_line_worker():
    ask = annotators.line_worker(["python3", "-u", "-c", "import sys\nfor x in sys.stdin: print(x.strip().upper()); print('EOS')"])()
    assert ask("a b") == "A B\n" and ask("c") == "C\n"


def test_limited_passes_the_rest(spark):
    s = readings.schemas
    rows = spark.createDataFrame([(i, f"u{i}", "x", [], []) for i in range(3)], f"line_no int, unit_id string, text string, tokens array<struct<{s.TOKEN}>>, candidates array<struct<{s.CANDIDATE}>>")
    got = {r["line_no"]: r["reading"] for r in readings.limited(rows, "sudachi_only_v1", 2).collect()}
    assert got[2] is None and got[0]["strategy"] == "sudachi_only_v1"
