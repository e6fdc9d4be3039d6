import re

import pytest
from pyspark.sql import functions as F

from corpuslathe.operators import facts as E


def facts(spark, text):
    df = spark.createDataFrame([("k", text)], "k string, t string")
    return [r.asDict() for r in E.extract_facts(df, "k", "t").orderBy("ordinal").collect()]


def of(rows, kind):
    return [r for r in rows if r["kind"] == kind]


def test_dialogue_and_duration(spark):
    text = 'Duration: ~4s\nSHE:\n"Are you kidding me?"\nShe says nothing.'
    got = facts(spark, text)
    d = of(got, "declared_duration")
    assert [(x["value"], x["subtype"]) for x in d] == [('{"approximate":true,"seconds":4.0}', "prompt_label")]
    q = of(got, "dialogue")
    assert [text[x["start"] : x["end"]] for x in q] == ['"Are you kidding me?"']
    assert q[0]["value"] == '{"line":"Are you kidding me?","speaker":"SHE"}'


def test_numbers_that_are_no_durations(spark):
    got = facts(spark, "A blend of light 60:30:10, 3/4 turn, 60fps, 24-70mm lens, at 00:12 the door opens")
    assert not of(got, "declared_duration") and not of(got, "declared_aspect_ratio") and not of(got, "dialogue")
    assert [x["value"] for x in of(got, "timestamp")] == ["00:12"]


def test_json_settings(spark):
    text = '{"duration":8,"aspect_ratio":"16 : 9","model":"m_2","mode":true}'
    got = facts(spark, text)
    assert [x["value"] for x in of(got, "declared_duration")] == ['{"approximate":false,"seconds":8.0}']
    assert "16:9" in [x["value"] for x in of(got, "declared_aspect_ratio")]
    m = of(got, "declared_model")[0]
    assert text[m["start"] : m["end"]] == '"model":"m_2"' and m["value"] == "m_2"
    assert not of(got, "generation_mode")


def test_markers_headings_references(spark):
    text = "# Opening\n<<<hero>>>: a man in the rain\nsecond line\n\nSHOT 1 wide. CUT TO close, T2V\n[STYLE]\nuse @cam1 and <Picture 2> no music\n"
    got = facts(spark, text)
    assert [x["value"] for x in of(got, "heading")] == ["# Opening", "[STYLE]"]
    assert [x["value"] for x in of(got, "shot_marker")] == ["SHOT"] and [x["subtype"] for x in of(got, "cut_marker")] == ["cut_to"]
    assert [x["value"] for x in of(got, "reference_tag")] == ["hero", "cam1", '{"kind":"Picture","number":2}']
    b = of(got, "reference_block")[0]
    assert text[b["start"] : b["end"]] == "<<<hero>>>: a man in the rain\nsecond line"
    assert of(got, "entity_reference_span")[0]["subtype"] == "character"
    assert [x["subtype"] for x in of(got, "audio")] == ["negative_music"]
    assert [x["value"] for x in of(got, "generation_mode")] == ["T2V"]


@pytest.mark.parametrize("name", ["LABELED_DURATION", "TIMECODE", "RANGE", "POINT", "SINGLE", "MULTI", "AT_TAG", "TRIPLE", "MODE", "LANGUAGE"])
def test_patterns_match_as_in_python(spark, name):
    import pandas as pd

    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"].tolist() + ["duration - 3,5 секунды 😀 12-14s at 3 s 1:02:03.5 no cuts, @a.b-c <<<x>>> R2V spoken English; 3 cuts 5 to 7秒"]
    p = getattr(E, name)
    flags = re.I if p.startswith("(?i") else 0
    want = [[(m.start(), m.end()) for m in re.finditer(re.sub(r"^\(\?\w+\)", "", p), t, flags)] for t in docs]
    from corpuslathe.functions.text import spans

    df = spark.createDataFrame(list(enumerate(docs)), "i int, t string")
    got = {r["i"]: [(s["start"], s["end"]) for s in r["s"]] for r in df.select("i", spans("t", p).alias("s")).collect()}
    assert [got[i] for i in range(len(docs))] == want


def test_structure_issues_strata(spark):
    data = [("a", "single shot, no cuts", 20), ("f", "single shot. HARD CUT here", 26), ("b", "A fight in the street � now", 27), ("c", "{broken}", 8), ("d", "", 0), ("e", 'SFX only "hello there" she says', 31)]
    t = spark.createDataFrame(data, "k string, t string, n bigint")
    f = E.extract_facts(t, "k", "t")
    s = E.structure(t, f, "k")
    assert {r["k"]: r["take_structure"] for r in s.collect()} == {"a": "single", "f": "conflict", "b": "not_declared", "c": "not_declared", "d": "not_declared", "e": "not_declared"}
    i = E.issues(t, s, f, "k", "t")
    assert {(r["k"], r["code"]) for r in i.collect()} == {("f", "take_structure_conflict"), ("b", "unicode_replacement_character"), ("c", "invalid_json_prompt"), ("e", "audio_dialogue_scope_ambiguity")}
    got = {r["k"]: r for r in E.stratify(t, s, i, "k", "t", "n").collect()}
    assert {k: r["complexity_queue"] for k, r in got.items()} == {"a": "simple", "f": "complex", "b": "manual_review", "c": "complex", "d": "simple", "e": "complex"}
    assert got["b"]["scene_tags"] == ["action_interaction", "environment_establishing", "mixed_scene"]
    assert got["d"]["scene_tags"] == ["unspecified_scene"] and got["e"]["dialogue_state"] == "ambiguous"


def test_same_twice(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/prompts.parquet")
    from corpuslathe.functions.hashing import table_digest

    run = lambda d: table_digest(E.extract_facts(E.distinct_texts(d, "prompt_sha256", "prompt_text"), "prompt_sha256", "prompt_text")).first()
    assert run(df) == run(df.unionByName(df).repartition(3).withColumn("x", F.rand()).drop("x"))


def test_second_sign_needs_an_edge(spark):
    assert [x["value"] for x in of(facts(spark, "Output 5秒 and 7秒钟"), "declared_duration")] == ['{"approximate":false,"seconds":5.0}']


def test_equal_facts_once_and_nulls(spark):
    t = spark.createDataFrame([("a", "no cuts, no cut"), ("b", None), (None, "no cuts")], "k string, t string")
    got = E.extract_facts(t, "k", "t").collect()
    assert sorted((str(r["k"]), r["ordinal"], r["start"]) for r in got) == [("None", 0, 0), ("a", 0, 0), ("a", 1, 9)]


def test_failures_stay_with_their_text(spark):
    def words(t):
        if "bad" in t:
            raise ValueError(t)
        return [(w, len(w)) for w in t.split()]

    t = spark.createDataFrame([("a", "x yy"), ("b", "one bad"), ("c", None), ("d", "")], "k string, t string")
    rows, failed = E.safely(t, "k", "t", words, "word string, n int")
    assert sorted(tuple(r) for r in rows.collect()) == [("a", 0, "x", 1), ("a", 1, "yy", 2)]
    assert sorted(tuple(r) for r in failed.collect()) == [("b", "parser_exception", "ValueError"), ("c", "parser_exception", "TypeError")]


def test_json_setting_issues(spark):
    t = spark.createDataFrame([("a", '{"duration":"eight","model":"m"}'), ("b", '{"dur\\u0061tion":8}'), ("c", '{"model":null,"mode":"x","duration":1}')], "k string, t string")
    f = E.extract_facts(t, "k", "t")
    i = E.issues(t, E.structure(t, f, "k"), f, "k", "t")
    assert {(r["k"], r["code"]) for r in i.collect()} == {("a", "unsupported_json_setting_value"), ("b", "json_field_span_not_found")}
