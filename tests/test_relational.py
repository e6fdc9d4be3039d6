import collections
import random

import pytest
from pyspark.sql import functions as F

from corpuslathe.functions import text as T
from corpuslathe.operators import contracts as C
from corpuslathe.operators import relational as R


def test_percentiles(spark):
    df = spark.createDataFrame([(v,) for v in (10, 20, 30, 40, 50, None)], "v int")
    assert {r["fraction"]: r["value"] for r in R.nearest_index_percentiles(df, "v", [0.0, 0.5, 1.0]).collect()} == {0.0: 10, 0.5: 30, 1.0: 50}
    four = df.where("v < 50")  # index 1.5 goes to the even 2
    assert R.nearest_index_percentiles(four, "v", [0.5]).first()["value"] == 30
    assert R.nearest_index_percentiles(df.limit(0), "v", [0.5]).count() == 0


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    n = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (3, "w")], "k int, v string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(R.insert_or_ignore(t, n, ["k"], F.col("v"))) == [(1, "a"), (2, "b"), (3, "w")]
    assert rows(R.upsert(t, n, ["k"], F.col("v"))) == [(1, "a"), (2, "y"), (3, "z")]
    assert rows(R.replace_keys(t, n, ["k"])) == [(1, "a"), (2, "x"), (2, "y"), (3, "w"), (3, "z")]
    assert rows(R.repeats(n, ["k"], F.col("v")).select("k", "v")) == [(2, "y"), (3, "z")]


def test_incremental(spark):
    src = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, input_digest string")
    old = spark.createDataFrame([("a", "1", "v1", "c"), ("b", "0", "v1", "c"), ("c", "3", "v0", "c")], "k string, input_digest string, version string, config string")
    todo, kept = R.incremental(src, old, "k", "v1", "c")
    assert {r["k"] for r in todo.collect()} == {"b", "c"} and {r["k"] for r in kept.collect()} == {"a"}


def test_neardup_normalizer(spark):
    df = spark.createDataFrame([("a", "Cut 1"), ("b", "cut  2"), ("c", "cut x"), ("d", None)], "k string, t string")
    assert R.normalized_groups(df, "k", "t", T.format_normalize).count() == 0
    assert [tuple(r)[1:] for r in R.normalized_groups(df, "k", "t", T.numeric_normalize).collect()] == [(2, "a")]


def test_direct_counts(spark):
    df = spark.createDataFrame([("r", None, "r", 2), ("c", "r", "r/c", 3), ("x", "gone", None, 1)], "folder_id string, parent_id string, path string, reported_asset_count bigint")
    got = {r["folder_id"]: (r["derived_direct"], r["issue"], r["path_depth"]) for r in R.direct_counts(df).collect()}
    assert got == {"r": (-1, "negative_derived_direct_count", 0), "c": (3, None, 1), "x": (1, "missing_parent", 0)}


def test_sample_is_stable(spark):
    df = spark.range(24).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.when(F.col("id") == 5, "manual").otherwise(F.concat(F.lit("q"), (F.col("id") % 3).cast("string"))).alias("q"))
    run = lambda d: sorted(r["key"] for r in R.hash_sample(d, "k", ["q"], 2, "v", d.where("q = 'manual'").select("k")).collect())
    assert run(df) == run(df.repartition(3)) and len(run(df)) == 7


def test_greedy(spark):
    df = spark.createDataFrame([("a", "f", ["g"], 9), ("b", "f", ["g"], 8), ("c", "f", None, 7), ("d", "f", [], 6), ("a", "f", [], 5), ("e", "h", ["g2"], 1)], "k string, fam string, b array<string>, score int")
    want = sorted([("a", "selected"), ("b", "blocked"), ("c", "selected"), ("d", "quota_reached"), ("a", "duplicate_key"), ("e", "selected")])
    for chunk in (1, 2, 20_000):
        assert sorted(tuple(r)[::2] for r in R.greedy_quota(df, "k", "fam", "b", 2, F.col("score").desc(), F.col("k"), chunk=chunk).collect()) == want


def test_greedy_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, f"k{rng.randrange(60)}", f"f{rng.randrange(4)}", [f"g{rng.randrange(40)}" for _ in range(rng.randrange(3))]) for i in range(300)]
    keys, groups, n, want = set(), set(), collections.Counter(), []
    for _, k, f, bs in rows:
        d = "duplicate_key" if k in keys else "blocked" if set(bs) & groups else "quota_reached" if n[f] >= 5 else "selected"
        if d == "selected":
            keys.add(k)
            groups |= set(bs)
            n[f] += 1
        want.append((k, f, d))
    df = spark.createDataFrame(rows, "i int, k string, f string, b array<string>").repartition(7)
    got = [tuple(r) for r in R.greedy_quota(df, "k", "f", "b", 5, F.col("i"), chunk=4).collect()]
    assert sorted(got) == sorted(want)


def test_running_and_members(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(500)], "i int, n int").repartition(9)
    run, total = R.running(df, [F.col("i")], F.col("n"))
    got = {r["i"]: r["upto"] for r in run.collect()}
    assert total == 1000 and all(got[i] == sum(j % 5 for j in range(i + 1)) for i in range(500))
    m = R.numbered_members(spark.createDataFrame([("x", f"{i:03d}") for i in range(200)] * 2 + [("y", "b"), ("y", "a"), (None, "c")], "g string, m string"), "g", "m")
    assert {(r["g"], r["m"]): r["ordinal"] for r in m.collect()} == {**{("x", f"{i:03d}"): i for i in range(200)}, ("y", "a"): 0, ("y", "b"): 1}
    assert R.numbered(df.limit(0), F.col("i")).count() == 0 and R.nearest_index_percentiles(df.limit(0), "i", [0.5]).count() == 0


def test_small_operators(spark):
    j = spark.createDataFrame([('[{"a":1},{"b":2},{"a":"x"}]',), ("{}",), ("no",), (None,), ('[1, {"a":1}]',)], "j string")
    assert {r["value"]: r["rows"] for r in R.object_key_counts(j, "j", "a").collect()} == {"1": 2, "<null>": 1, "x": 1}
    c = spark.createDataFrame([("p", "f"), ("q", "f"), ("r", "g")], "k string, fam string")
    assert [tuple(r)[2:] for r in R.case_numbers(c, "fam", F.col("fam"), F.col("k")).orderBy("rank").collect()] == [("scene-case-f-01", 1), ("scene-case-f-02", 2), ("scene-case-g-01", 3)]
    assert R.member_counts(spark.createDataFrame([(["a", "a"],), (["b", "a"],), (None,)], "x array<string>"), "x").orderBy("value").collect() == [("a", 2), ("b", 1)]
    g = spark.createDataFrame([("p", "format", "1"), ("p", "format", "1"), ("p", "numeric", "2")], "k string, group_type string, fingerprint string")
    assert sorted(map(str, (tuple(r) for r in R.group_memberships(c.select("k"), g, "k").collect()))) == sorted(map(str, [("p", "format", "1"), ("p", "numeric", "2"), ("q", None, None), ("r", None, None)]))


def test_families(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("b", "y", 3), ("c", "y", 1)], "k string, fam string, s int")
    got = {(r["family"], r["rank"]): r["k"] for r in R.families_in_turn(df, "k", "fam", ["x", "y"], 2, F.col("s").desc(), F.col("k")).collect()}
    assert got == {("x", 1): "a", ("y", 1): "b", ("y", 2): "a"}


def test_nested_export(spark):
    keys = spark.createDataFrame([(0, "p2"), (1, "p1"), (2, "no")], "ordinal int, prompt_sha256 string")
    p = spark.createDataFrame([("p1",), ("p2",)], "prompt_sha256 string")
    a = spark.createDataFrame([("a1", "p1"), ("a1", "p1"), ("a2", "p1")], "asset_id string, prompt_sha256 string")
    m = spark.createDataFrame([("a1", "B"), ("a1", "A")], "asset_id string, folder_id string")
    got = {r["ordinal"]: r for r in R.nested_export(keys, p, a, m).collect()}
    assert [(x["asset_id"], x["folders"]) for x in got[1]["assets"]] == [("a1", ["A", "B"]), ("a2", [])]
    assert got[0]["assets"] == [] and not got[2]["found"]


def test_contracts(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (4,), (100_007,)], "n int")
    assert sorted(tuple(r) for r in C.gaps(df, "n").collect()) == [(2, 4), (4, 100_007)]
    assert C.gaps(df.where("n < 3"), "n").count() == 0
    rng = spark.createDataFrame([(1, 2), (2, 4), (7, 7)], "first int, last int")
    assert sorted(tuple(r) for r in C.line_coverage(rng, 5).collect()) == [(2, 2), (5, 0), (7, 1)]
    rep = C.check_report(spark.range(3).agg(*C.checks(small=F.col("id") < 3, positive=F.col("id") > 0)))
    assert {r["check"]: r["passed"] for r in rep.collect()} == {"small": True, "positive": False, "all": False}
    ev = spark.createDataFrame([("k", 0, 2, "x"), ("k", 1, 9, "x"), ("no", 0, 1, "x")], "k string, start int, end int, sha256 string")
    tx = spark.createDataFrame([("k", "abc")], "k string, t string")
    assert sorted(r["fault"] for r in C.evidence_faults(ev, tx, "k", "t").collect()) == ["hash", "no_text", "outside"]
    s = spark.createDataFrame([("k", ["b", "a"]), ("l", ["a", "b"])], "k string, a array<string>")
    assert [r["k"] for r in C.unsorted_sets(s, "k", "a").collect()] == ["k"]
    sig = spark.createDataFrame([(["x", "b", "a"],), (["skip"],), ([],)], "s array<string>")
    assert [tuple(r["r"]) for r in sig.select(C.retrieval("s", ["a", "b"], "skip").alias("r")).collect()] == [(True, "a"), (False, "skip"), (False, "no_retrieval_trigger")]
    leak = spark.createDataFrame([("see https://x @cam 5 s <Video 1>",)], "t string").select(C.leaks("t", F.lit("seedance")).alias("l"), C.leaks("t", F.lit("h3")).alias("m")).first()
    assert leak["l"] == ["media_url", "historical_at_tag", "historical_duration", "h3_syntax:<Video 1>"] and leak["m"] == leak["l"][:3]


def test_leaves_and_handoffs(spark):
    deep = "[" * 200 + '"x"' + "]" * 200
    d = spark.createDataFrame([(1, '{"task_id":"https://a","b":{"c":["u", 1, {"d":"Context-IR"}]}}', "seedance"), (2, "no", "h3"), (3, None, "h3"), (4, '["at 5 s", "@source_tag"]', "h3"), (5, deep, "h3")], "k int, doc string, target string")
    got = {(r["key"], r["path"]): r["value"] for r in C.string_leaves(d, "k", "doc").collect()}
    assert {k: v for k, v in got.items() if k[0] < 5} == {(1, "$.task_id"): "https://a", (1, "$.b.c[0]"): "u", (1, "$.b.c[2].d"): "Context-IR", (4, "$[0]"): "at 5 s", (4, "$[1]"): "@source_tag"} and len(got) == 6
    assert {tuple(r) for r in C.handoff_faults(d, "k", "doc", "target").collect()} == {(1, "h3_syntax:Context-IR"), (4, "historical_duration"), (4, "historical_at_tag"), (4, "seedance_syntax:@source_tag")}
    s = spark.createDataFrame([([" a", "b"], ["b ", "a", "c"]), (None, ["x"])], "x array<string>, y array<string>")
    assert [r[0] for r in s.select(C.shared_fragments("x", "y")).collect()] == [["a", "b"], []]
    assert C.forbidden_columns(spark.createDataFrame([], "a int, s struct<asset_count:int, x:array<struct<word_frequency:int>>>"), ("frequency", "asset_count")) == ["s.asset_count", "s.x[].word_frequency"]
    dec = spark.createDataFrame([("k", "f", 0), ("k", "f", 1), ("k", "g", None)], "k string, field string, evidence_ordinal int")
    ev = spark.createDataFrame([("k", "f", 0)], "k string, field string, ordinal int")
    assert {(r["field"], r["evidence_ordinal"]) for r in C.unlinked_decisions(dec, ev, "k").collect()} == {("f", 1), ("g", None)}
    m = spark.createDataFrame([("k", "a"), ("k", "b"), ("l", "a")], "k string, m string")
    assert [tuple(r) for r in C.missing_members(m, "k", "m", ["b", "a"]).collect()] == [("l", ["b"])]
    r = spark.createDataFrame([("c", True), ("c", False), ("e", True)], "check string, passed boolean")
    assert {tuple(x) for x in C.check_counters(r).collect()} == {("c", 2, 1, 1), ("e", 1, 1, 0)}


def test_schema_validator(spark):
    schema = {"$defs": {"n": {"type": "integer", "minimum": 1}}, "type": "object", "required": ["a", "z"], "additionalProperties": False, "properties": {"a": {"$ref": "#/$defs/n"}, "b": {"enum": ["x"]}, "c": {"type": "array", "prefixItems": [{"type": "string", "pattern": "^q"}], "items": {"const": 1}, "maxItems": 3, "minItems": 1}, "d": {"type": ["string", "null"], "minLength": 2}}}
    docs = ['{"a":0,"b":"y","c":["p",1,2,1],"d":"s","e":1}', "{", None, '{"a":1,"z":2}', '{"a":true,"d":null}']
    df = spark.createDataFrame(list(enumerate(docs)), "k int, doc string")
    got = {}
    for r in C.schema_faults(df, "k", "doc", schema).collect():
        got.setdefault(r["key"], set()).add((r["code"], r["path"]))
    assert got[0] == {("required", "$.z"), ("minimum", "$.a"), ("enum", "$.b"), ("pattern", "$.c[0]"), ("const", "$.c[2]"), ("maxItems", "$.c"), ("minLength", "$.d"), ("additionalProperties", "$.e")}
    assert got[1] == got[2] == {("invalid_json", "$")}
    assert got[3] == {("additionalProperties", "$.z")} and got[4] == {("required", "$.z"), ("type", "$.a")}


def test_audits(spark):
    r = spark.createDataFrame([("a", "x"), ("b", "see https://y"), ("b", " ")], "asset_id string, prompt_text string")
    e = spark.createDataFrame([("c",)], "code string")
    got = {x["check"]: x["passed"] for x in C.crawl_audit(r, e, 4, True).collect()}
    assert got == {"run_complete": True, "api_item_count": True, "unique_asset_count": False, "non_empty_prompt_count": False, "duplicate_asset_count": False, "record_error_count": False, "prompt_urls_remaining": False, "all": False}
    assert not any(x["passed"] for x in C.crawl_audit(r.limit(0), e.limit(0), 0, False).where("check in ('run_complete', 'api_item_count', 'unique_asset_count')").collect())
    assert all(x["passed"] for x in C.crawl_audit(r.limit(0), e.limit(0), 0, True).collect())
    b = spark.createDataFrame([("k", 1, 0.0, 2.0), ("k", 2, 2.0, 3.0), ("k", 3, 4.0, 5.0), ("l", 1, 1.0, 2.0), ("l", 3, 2.0, 3.0), ("m", 1, 0.0, 2.0), ("m", 2, 1.0, 4.0), ("m", 3, 4.0, 4.0), ("n", 1, None, 1.0)], "k string, order int, start double, end double")
    assert {tuple(x) for x in C.timeline_faults(b, "k").collect()} == {("k", 3, "gap"), ("l", 1, "starts_late"), ("l", 3, "order"), ("m", 2, "overlap"), ("m", 3, "empty"), ("n", 1, "no_time")}
    d = spark.createDataFrame([("p/a.md", {"name": "x"}, ["b.md", "../c.md#h", "#here", "https://o", "gone.md"]), ("p/b.md", {"name": "X!", "description": "d"}, [])], "path string, front_matter map<string,string>, links array<string>")
    f = spark.createDataFrame([("p/a.md",), ("p/b.md",), ("c.md",)], "path string")
    assert {tuple(x) for x in C.package_faults(d, f, {"name": "^[a-z]+$", "description": "."}).collect()} == {("p/a.md", "front_matter", "description"), ("p/a.md", "broken_link", "gone.md"), ("p/b.md", "front_matter", "name")}
    c = C.checked(spark.createDataFrame([(1, True), (2, None)], "k int, x boolean"), "k", x=F.col("x"), one=F.col("k") == 1)
    assert {tuple(r) for r in C.check_counters(c).collect()} == {("x", 2, 1, 1), ("one", 2, 1, 1)}


def test_command(spark, tmp_path, capsys):
    from corpuslathe.__main__ import main

    assert main(["--list"]) == 0 and "exact_clusters" in capsys.readouterr().out
    assert main(["nothing", "--data", "x"]) == 2 and main(["exact_clusters"]) == 2
    out = str(tmp_path / "o")
    assert main(["exact_clusters", "--data", "/root/testdata/sf0.001", "--out", out]) == 0 and spark.read.parquet(out).count() > 0
    assert main(["corpus_checks", "--data", "/root/testdata/sf0.001", "--out", out]) == 1
