import pytest
from pyspark.sql import functions as F

from corpusloom.operators import prompts, readings, responses


@pytest.mark.parametrize(("text", "ok"), [('{"a":1}', True), ('say ```json\n{"a": {"b": 2}}\n```', True), ('{"a":1} x', False), ("no", False), ('{"a":1,"a":2}', True), ('{"a":NaN}', True), (None, None)])
def test_strict_json(text, ok):
    got, error = responses.strict_json(text)
    assert (None if ok is None else error is None) == ok and (ok is not None or got is None)


def test_prompt_templates(spark):
    rows = spark.createDataFrame([(1, "u1", "t", None)], "line_no int, unit_id string, text string, rendered string")
    task = prompts.Task("yomi_check", "m", "A {{x}} {text}|{rendered}\r\n\r\n", "yomi_check")
    assert [tuple(r)[:2] for r in prompts.items(rows, task).collect()] == [("u1", "A {x} t|\n")]
    with pytest.raises(KeyError):
        prompts.items(rows, prompts.Task("yomi_check", "m", "{other}", "yomi_check"))
    with pytest.raises(ValueError):
        prompts.items(rows, prompts.Task("x", "m", "", "nothing"))


def test_usage_and_text(spark):
    line = '{"output_text": "", "body": {"output": [{"type": "message", "content": [{"text": "old"}]}, {"type": "message", "content": [{"text": ""}, {"text": "new"}]}, {"type": "other"}], "usage": {"prompt_tokens": 5, "completion_tokens": 2}}}'
    row = spark.range(1).select(F.from_json(F.lit(line), responses.RESPONSE).alias("r"))
    got = row.select(responses.output_text(F.col("r")).alias("t"), responses.item_usage(F.col("r")).alias("u")).first()
    assert got["t"] == "new" and got["u"].asDict() == {"input_tokens": 5, "cached_input_tokens": 0, "output_tokens": 2, "reasoning_tokens": 0, "total_tokens": 7}
    assert spark.range(1).select(responses.usage(F.lit('{"input_tokens": 0}')).alias("u")).first()["u"] is None


def test_scores_treat_missing_as_equal(spark):
    rows = spark.createDataFrame([(None, None, ""), ("a", "b", None), ("a", "a", "bad")], "expected_status string, s string, parse_error string").select("expected_status", F.struct(F.col("s").alias("status")).alias("parsed"), "parse_error")
    assert [r["passed"] for r in responses.score(rows, "yomi_check").collect()] == [True, False, False]


def token(surface, reading="", pos="名詞,普通名詞"):
    return {"surface": surface, "pos": pos, "dictionary_form": surface, "normalized_form": surface, "reading": reading}


def entry(surface, reading, segments=()):
    return {"surface": surface, "reading": reading, "final_order": 0, "piece_orders": [], "original_segments": [{"surface": s, "reading": r} for s, r in segments]}


def candidate(*entries):
    return {"rank": 1, "score": 0.0, "entries": list(entries)}


def test_hybrid_rules():
    h = readings.hybrid
    out = h("東京 に。", [token("東京", "トウキョウ"), token(" ", "", "空白,*"), token("に", "ニ", "助詞,"), token("。", "。", "補助記号,句点")], [candidate(entry("東京", "トウキョウ"), entry("に", "ニ"), entry("。", "x"))])
    assert out == {"rendered": "東京/トウキョウ に/ニ 。/。", "certain": True, "signals": ["strategy:aligned_hybrid_v1", "sudachi_decoder_exact_token_agreement", "skip_whitespace_token", "normalize_punctuation_surface"]}
    two = [candidate(entry("方", "カタ")), candidate(entry("方", "カタ")), candidate(entry("方", "ホウ"))]
    assert h("方", [token("方", "ホウ")], two)["rendered"] == "方/カタ"
    assert h("方", [token("方", "ホウ")], two[1:])["rendered"] == "方/ホウ"  # one vote isn't enough
    assert h("外国人", [token("外国人", "ガイコクジン")], [candidate(entry("外国", "ガイコク"), entry("人", "ジン"))])["rendered"] == "外国/ガイコク 人/ジン"
    assert h("外国人", [token("外国人", "ガイコクジン")], [candidate(entry("外国", "ガイコク"), entry("人", "ニン"))])["signals"][-1] == "fallback_sudachi_token"
    assert h("食べる", [token("食べ", "タベ"), token("る", "ル")], [candidate(entry("食べる", "タベル", [("食べ", "タベ"), ("る", "ル")]))])["signals"][-1] == "use_decoder_original_segments"
    assert h("a", [token("a")], [])["signals"][-1] == "fallback_sudachi"
    with pytest.raises(ValueError):
        h("a", [token("b")], [candidate()])


def test_all_strategies_run(spark):
    rows = spark.createDataFrame([("東京", [token("東京", "トウキョウ")], [candidate(entry("東京", "ヒガシ"))]), ("東京", [token("東京", "")], [])], f"text string, tokens array<struct<{readings.schemas.TOKEN}>>, candidates array<struct<{readings.schemas.CANDIDATE}>>")
    got = {s: [r["reading"]["rendered"] for r in readings.apply(rows, s).collect()] for s in readings.STRATEGIES}
    assert got["decoder_only_v1"] == ["東京/ヒガシ", "東京/東京"] and got["agreement_prefer_decoder_v1"][0] == "東京/ヒガシ"
    assert got["agreement_prefer_sudachi_v1"][0] == got["sudachi_only_v1"][0] == got["aligned_hybrid_v1"][0] == "東京/トウキョウ"
    with pytest.raises(ValueError):
        readings.apply(rows, "nothing")
