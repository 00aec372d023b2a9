"""Readings: morphological tokens aligned with n-best reading candidates.

Rendering and the four plain strategies are column expressions; the aligned hybrid walks
two token sequences with a variable stride and is one Arrow UDF.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas

# Part-of-speech prefixes, and the surface whose reading the candidates may override.
BLANK_POS, MARK_POS, COMPOUND_POS, NUMERAL = "空白", "補助記号", ("名詞,", "接頭辞,"), "数詞"
OVERRIDE_SURFACES = frozenset({"方"})
RESULT = "rendered string, certain boolean, signals array<string>"


def parse_tokens(output: Column) -> Column:
    """Analyser lines (surface, part of speech, dictionary form, normalised form, reading by tab) to token structs."""
    lines = F.filter(F.split(output, "\n"), lambda x: (F.trim(x) != "") & (F.trim(x) != "EOS") & (F.size(F.split(x, "\t")) >= 5))
    names = ("surface", "pos", "dictionary_form", "normalized_form", "reading")
    return F.transform(lines, lambda x: F.struct(*(F.split(x, "\t")[i].alias(n) for i, n in enumerate(names))))


def parse_candidates(output: Column) -> Column:
    """Decoder JSON (its list of ``results``) to ranked candidates; what an entry lacks is empty or 0."""
    found = F.from_json(output, f"struct<results: array<struct<{schemas.CANDIDATE}>>>")["results"]
    none = lambda kind: F.array().cast(f"array<{kind}>")
    segment = lambda x: F.struct(x["surface"].alias("surface"), F.coalesce(x["reading"], F.lit("")).alias("reading"))
    entry = lambda e: F.struct(e["surface"].alias("surface"), e["reading"].alias("reading"), F.coalesce(e["final_order"], F.lit(0)).alias("final_order"), F.coalesce(e["piece_orders"], none("int")).alias("piece_orders"), F.transform(F.coalesce(e["original_segments"], none(f"struct<{schemas.SEGMENT}>")), segment).alias("original_segments"))
    each = lambda c: F.struct(c["rank"].alias("rank"), c["score"].alias("score"), F.transform(F.coalesce(c["entries"], none(f"struct<{schemas.ENTRY}>")), entry).alias("entries"))
    return F.when(output.isNotNull(), F.transform(F.coalesce(found, none(f"struct<{schemas.CANDIDATE}>")), each))


def _blank(t: Column) -> Column:
    return t["surface"].rlike(r"^[\p{IsWhite_Space}\x1c-\x1f]+$") | t["pos"].startswith(BLANK_POS)


def _pair(t: Column) -> Column:
    mark = t["pos"].startswith(MARK_POS) | (F.coalesce(t["reading"], F.lit("")) == "")
    return F.concat(t["surface"], F.lit("/"), F.when(mark, t["surface"]).otherwise(t["reading"]))


def render_tokens(tokens: Column) -> Column:
    return F.array_join(F.transform(F.filter(tokens, lambda t: ~_blank(t)), _pair), " ")


def render_entries(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda e: F.concat(e["surface"], F.lit("/"), F.when(F.coalesce(e["reading"], F.lit("")) == "", e["surface"]).otherwise(e["reading"]))), " ")


def _result(rendered: Column, certain, *signals) -> Column:
    return F.struct(rendered.alias("rendered"), (certain if isinstance(certain, Column) else F.lit(certain)).alias("certain"), F.filter(F.array(*(s if isinstance(s, Column) else F.lit(s) for s in signals)), lambda s: s.isNotNull()).alias("signals"))


def tokens_only(text: Column, tokens: Column, candidates: Column) -> Column:
    full = F.forall(tokens, lambda t: F.coalesce(t["reading"], F.lit("")) != "")
    return _result(render_tokens(tokens), False, "strategy:sudachi_only_v1", F.when(full, "all_sudachi_tokens_have_readings"))


def candidates_only(text: Column, tokens: Column, candidates: Column) -> Column:
    none = F.coalesce(F.size(candidates), F.lit(0)) <= 0
    name = "strategy:decoder_only_v1"
    return F.when(none, _result(render_tokens(tokens), False, name, "decoder_no_candidates", "fallback_sudachi")).otherwise(_result(render_entries(F.get(candidates, 0)["entries"]), False, name, "decoder_top_candidate"))


def agreement(prefer: str) -> Callable[[Column, Column, Column], Column]:
    """Equal renderings are certain; with equal surfaces the preferred side's readings win; else the tokens' stand."""

    def run(text: Column, tokens: Column, candidates: Column) -> Column:
        name = f"strategy:agreement_prefer_{prefer}_v1"
        said = [name] + ["decoder_top_candidate"] * (prefer == "decoder")
        entries = F.get(candidates, 0)["entries"]
        none = F.coalesce(F.size(candidates), F.lit(0)) <= 0
        a, b = render_tokens(tokens), render_entries(entries)
        surfaces = F.transform(tokens, lambda t: t["surface"]) == F.transform(entries, lambda e: e["surface"])
        winner = {"decoder": b, "sudachi": a}[prefer]
        return (
            F.when(none, _result(a, False, name, "decoder_no_candidates", "fallback_sudachi"))
            .when(a == b, _result(a, True, *said, "sudachi_decoder_exact_agreement"))
            .when(surfaces, _result(winner, False, *said, "sudachi_decoder_surface_agreement", f"prefer_{prefer}_readings"))
            .otherwise(_result(a, False, *said, "sudachi_decoder_surface_disagreement", "fallback_sudachi"))
        )

    return run


def placed(text: str, surfaces: list[str]) -> list[tuple[int, int]]:
    """Code point ranges of consecutive surfaces, each searched from the end of the one before."""
    out, at = [], 0
    for s in surfaces:
        i = text.find(s, at)
        if i < 0:
            raise ValueError(f"can't align {s!r} in {text!r}")
        at = i + len(s)
        out.append((i, at))
    return out


def hybrid(text: str, tokens: list[dict], candidates: list[dict]) -> dict:
    """Left to right: blank, exact span, compound refined by entries, run covered by an entry's original segments, fallback.

    Surfaces that the text doesn't have are an error. Without text, tokens or entries there is nothing to render.
    """
    signals = ["strategy:aligned_hybrid_v1"]
    is_blank = lambda t: t["surface"].isspace() or t["pos"].startswith(BLANK_POS)
    own = lambda t: (t["surface"], t["surface"] if t["pos"].startswith(MARK_POS) else t["reading"] or t["surface"])
    if not candidates:
        pairs = [own(t) for t in tokens if not is_blank(t)]
        return {"rendered": " ".join("/".join(p) for p in pairs), "certain": False, "signals": [*signals, "decoder_no_candidates", "fallback_sudachi"]}
    spans = placed(text, [t["surface"] for t in tokens])
    ranked = [list(zip(placed(text, [e["surface"] for e in c["entries"] or []]), c["entries"] or [], strict=True)) for c in candidates]
    exact = {span: e for span, e in ranked[0]}
    by_start = {}
    for (lo, hi), e in ranked[0]:
        by_start.setdefault(lo, ((lo, hi), e))

    def exactly(t: dict, span: tuple[int, int]) -> tuple[str, str]:
        e = exact[span]
        if t["pos"].startswith(MARK_POS):
            signals.append("normalize_punctuation_surface")
        elif e["reading"] and e["reading"] == t["reading"]:
            signals.append("sudachi_decoder_exact_token_agreement")
        elif e["reading"] and t["surface"] in OVERRIDE_SURFACES:
            votes = Counter(r for c in ranked if (r := next((x["reading"] for s, x in c if s == span and x["reading"]), None)))
            best = max(votes, key=lambda r: (votes[r], r))
            if best == e["reading"] and votes[best] >= 2:
                signals.append("use_decoder_contextual_override")
                return t["surface"], e["reading"]
        elif (e["reading"] or "") == (t["reading"] or ""):
            signals.append("sudachi_decoder_exact_token_agreement")
        return own(t)

    def refined(t: dict, lo: int, hi: int) -> list[dict]:
        inside = [(s, e) for s, e in ranked[0] if s[1] > lo and s[0] < hi]
        tiles = len(inside) > 1 and inside[0][0][0] == lo and inside[-1][0][1] == hi and all(a[0][1] == b[0][0] for a, b in zip(inside, inside[1:], strict=False))
        words = [e for _, e in inside]
        fits = tiles and t["pos"].startswith(COMPOUND_POS) and NUMERAL not in t["pos"] and t["reading"] and all(e["reading"] and e["surface"].strip() for e in words)
        return words if fits and "".join(e["reading"] for e in words) == t["reading"] else []

    def run_under(i: int, hi: int) -> int:
        """Index after the tokens from i on that end exactly at hi without a blank; i if there are none."""
        for j in range(i, len(tokens)):
            if spans[j][0] >= hi or is_blank(tokens[j]) or spans[j][1] > hi:
                return i
            if spans[j][1] == hi:
                return j + 1
        return i

    pairs, i = [], 0
    while i < len(tokens):
        t, span = tokens[i], spans[i]
        if is_blank(t):
            signals.append("skip_whitespace_token")
        elif span in exact:
            pairs.append(exactly(t, span))
        elif words := refined(t, *span):
            pairs += [(e["surface"], e["reading"]) for e in words]
            signals.append("refine_single_sudachi_compound_with_decoder")
        else:
            cover = by_start.get(span[0])
            end = run_under(i, cover[0][1]) if cover else i
            segments = (cover[1]["original_segments"] if cover else None) or []
            if end - i > 1 and segments and all(s["reading"] for s in segments) and [s["surface"] for s in segments] == [x["surface"] for x in tokens[i:end]]:
                pairs += [(s["surface"], s["reading"]) for s in segments]
                signals.append("use_decoder_original_segments")
                i = end
                continue
            pairs.append(own(t))
            signals.append("fallback_sudachi_token")
        i += 1
    return {"rendered": " ".join("/".join(p) for p in pairs), "certain": "fallback_sudachi_token" not in signals, "signals": list(dict.fromkeys(signals))}


def _plain(x):
    """Arrow's nested rows as dicts and lists; missing strings stay None."""
    if isinstance(x, dict):
        return {k: _plain(v) for k, v in x.items()}
    if hasattr(x, "tolist"):
        x = x.tolist()
    return [_plain(v) for v in x] if isinstance(x, list) else x


@F.pandas_udf(T.StructType([T.StructField("rendered", T.StringType()), T.StructField("certain", T.BooleanType()), T.StructField("signals", T.ArrayType(T.StringType()))]))
def hybrid_udf(text: pd.Series, tokens: pd.Series, candidates: pd.Series) -> pd.DataFrame:
    rows = [hybrid(t or "", _plain(s) or [], _plain(c) if c is not None else []) for t, s, c in zip(text, tokens, candidates, strict=True)]
    return pd.DataFrame(rows, columns=["rendered", "certain", "signals"])


#: Extension point: strategies by name.
STRATEGIES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "sudachi_only_v1": tokens_only,
    "decoder_only_v1": candidates_only,
    "agreement_prefer_decoder_v1": agreement("decoder"),
    "agreement_prefer_sudachi_v1": agreement("sudachi"),
    "aligned_hybrid_v1": lambda text, tokens, candidates: hybrid_udf(text, tokens, candidates),
}


def apply(rows: DataFrame, strategy: str) -> DataFrame:
    """``rows`` (text, tokens, candidates) plus reading: strategy, rendered, certain, signals."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}; known: {', '.join(sorted(STRATEGIES))}")
    out = rows.withColumn("reading", STRATEGIES[strategy](F.col("text"), F.col("tokens"), F.col("candidates")))
    return out.withColumn("reading", F.struct(F.lit(strategy).alias("strategy"), "reading.rendered", "reading.certain", "reading.signals"))


def limited(rows: DataFrame, strategy: str, n: int) -> DataFrame:
    """The strategy on the first ``n`` rows by line_no; the rest pass with what they had. Two branches, so that the UDF runs on its rows only."""
    first = rows.orderBy("line_no").limit(n)
    return apply(first, strategy).unionByName(rows.join(first.select("line_no"), "line_no", "left_anti").withColumn("reading", F.lit(None).cast(f"struct<strategy: string, {RESULT}>")))


def export_text(rows: DataFrame, strategy: str) -> DataFrame:
    """unit_id and rendering by tab; a stored rendering is used, others are made."""
    have = F.coalesce("rendered", F.lit("")) != ""
    made = apply(rows.where(~have), strategy).select("unit_id", F.col("reading.rendered").alias("rendered"))
    return rows.where(have).select("unit_id", "rendered").unionByName(made).select(F.concat_ws("\t", "unit_id", "rendered").alias("value"))


def experiment_summary(rows: DataFrame) -> DataFrame:
    """Exact matches of rendered with expected_rendered where one is given; accuracy null if none is."""
    comparable = F.col("expected_rendered").isNotNull()
    match = comparable & (F.col("rendered") == F.col("expected_rendered"))
    return rows.agg(F.count(F.lit(1)).alias("item_count"), F.count_if(comparable).alias("comparable_count"), F.count_if(match).alias("exact_match_count"), F.avg(F.when(comparable, match.cast("int"))).alias("exact_match_accuracy"))


def compare_runs(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Items of two runs (item_id, rendered, certain) that differ."""
    a, b = (x.select("item_id", F.col("rendered").alias(f"{p}_rendered"), F.col("certain").alias(f"{p}_certain")) for x, p in ((base, "base"), (candidate, "candidate")))
    return a.join(b, "item_id", "full").where(~F.col("base_rendered").eqNullSafe(F.col("candidate_rendered")) | ~F.col("base_certain").eqNullSafe(F.col("candidate_certain")))
