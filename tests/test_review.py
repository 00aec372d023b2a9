import random

from pyspark.sql import functions as F

from corpusloom.operators import aggregate, ledgers, review, units

SUB = "submission_id string, generated_at_epoch long, source_path string, reviewed_ranges array<struct<from_seq:int,to_seq:int>>, overrides array<struct<item_id:string,decision:string,note:string>>"


def naive_replay(n, subs):
    state = {}
    for sid, epoch, _, ranges, overrides in sorted(subs, key=lambda s: (s[1], s[0], s[2])):
        last = {i: (d, note) for i, d, note in overrides}
        for a, b in ranges:
            a, b = sorted((a, b))
            for seq in range(a, b + 1):
                if 1 <= seq <= n:
                    d, note = last.get(f"i{seq}", ("accept", None))
                    state[f"i{seq}"] = (d, None if note is None else note.strip(), sid, epoch)
    return state


def test_replay_agrees_with_a_loop(spark):
    rng = random.Random(5)
    subs = [(f"s{k}", rng.randrange(4), f"p{k}", [(rng.randrange(-2, 14), rng.randrange(-2, 14)) for _ in range(rng.randrange(3))], [(f"i{rng.randrange(1, 13)}", rng.choice(["accept", "reject", "defer"]), " n ") for _ in range(rng.randrange(4))]) for k in range(40)]
    items = spark.createDataFrame([(f"i{s}", s) for s in range(1, 11)], "item_id string, seq int")
    got = {r["item_id"]: (r["status"], r["note"], r["submission_id"], r["generated_at_epoch"]) for r in review.replay(items, spark.createDataFrame(subs, SUB)).collect()}
    assert got == naive_replay(10, subs)


def decision(key, status="whitelist", source="manual"):
    return (key, False, status, source, "")


DEC = "entity_key string, strict_case boolean, status string, source string, note string"


def test_ledgers(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "batch_name string, n int")
    assert sorted(map(tuple, ledgers.replace_batches(old, spark.createDataFrame([("b", 9)], "batch_name string, n int")).collect())) == [("a", 1), ("b", 9)]
    assert ledgers.replace_batches(old, old.limit(0)).count() == 2  # an empty batch replaces nothing
    reg = spark.createDataFrame([decision("x"), decision("y", source="review:old"), decision("z")], DEC)
    new = spark.createDataFrame([decision("z", "blacklist", "review:new")], DEC)
    assert [(r["entity_key"], r["status"]) for r in ledgers.rewrite_with_promotions(reg, new).collect()] == [("x", "whitelist"), ("z", "blacklist")]
    lines = spark.createDataFrame([("k", "whitelist", 1), ("k", "unknown", 2)], "token_key string, status string, line_no long")
    assert [tuple(r) for r in ledgers.latest_decisions(lines).collect()] == [("k", False, "unknown", "manual", "")]


def test_verdicts_and_overrides(spark):
    one = spark.createDataFrame([("d", "u1", 1, "Android"), ("d", "u2", 2, "concerts and Android"), ("d", "u3", 3, "NHK"), ("d", "u4", 4, "日本")], "doc_id string, unit_id string, unit_seq int, text string")
    lists = {"whitelist": ["android"], "blacklist": ["concerts and android"]}
    occ = units.classify(units.occurrences(one), lists)
    got = {r["unit_id"]: r["verdict"] for r in aggregate.unit_verdicts(one, units.resolve(occ)).collect()}
    assert (got["u1"]["value"], got["u1"]["signals"]) == (False, ["all_entities_in_scope", "entity_level_lookup"])
    assert (got["u2"]["value"], got["u2"]["matches"]) == (True, ["concerts and Android"])
    assert (got["u3"]["value"], got["u3"]["certain"], got["u3"]["signals"]) == (None, False, ["unresolved_latin_entity_types", "strict_case_entity_present"])
    assert got["u4"]["signals"] == ["no_latin_entity_tokens"]
    unlisted = units.resolve(occ, spark.createDataFrame([decision("android", "unknown")], DEC)).where("unit_id = 'u1'").first()
    assert unlisted["resolved_status"] == "unknown"


def test_candidates_sum_observations(spark):
    rows = [("b1", "k", "in_scope", "high", " n ", 2, ["K"], ["t"], 1), ("b2", "k", "in_scope", "", "n", 1, ["k", "K"], ["t", "u"], 2), ("b1", "m", "out_of_scope", "low", "", 9, [], [], 3), ("b1", "x", "in_scope", "low", "", 9, [], [], 4), ("b1", "x", "out_of_scope", "low", "", 1, [], [], 5)]
    df = spark.createDataFrame(rows, "batch_name string, entity_key string, llm_status string, confidence string, note string, occurrence_count long, surface_forms array<string>, example_texts array<string>, line_no long").withColumn("strict_case", F.lit(False))
    got = [r.asDict() for r in review.candidates(df).collect()]
    assert [(g["entity_key"], g["proposed_decision"], g["supporting_observations"]) for g in got] == [("m", "blacklist", 9), ("k", "whitelist", 3)]
    assert got[1]["surface_forms"] == ["K", "k"] and got[1]["note_samples"] == ["n"] and got[1]["confidence_counts"] == {"high": 1} and got[1]["source_batches"] == ["b1", "b2"]
    decided = spark.createDataFrame([("m",)], "entity_key string")
    assert [r["entity_key"] for r in review.candidates(df, decided).collect()] == ["k"]


def test_issue_texts(spark):
    url = "https://github.com/user-attachments/files/1/a.json"
    body = 'see ```json\n{"submission_id": "a"}\n``` and ```\n{"submission_id": "a"}\n``` and ```\n{bad}\n```'
    rows = spark.createDataFrame([(1, 0, f"{url} {url}"), (1, 1, f"again {url}"), (1, 2, body), (1, 3, '{"submission_id": "b"}')], "number int, line_no int, body string")
    assert [(r["url"], r["line_no"]) for r in review.attachments(rows).collect()] == [(url, 0)]
    assert sorted(r["submission_id"] for r in review.inline_json(rows).collect()) == ["a", "b"]
