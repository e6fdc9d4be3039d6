from pyspark.sql import functions as F

from corpuslathe.operators import contracts as C
from corpuslathe.operators import facts as E
from corpuslathe.operators import neutral as U


def test_fields_evidence_and_sharing(spark):
    lines = [f"The camera pans over street {i}." for i in range(14)]
    t = spark.createDataFrame([("a", "\n".join([*lines, lines[0].upper(), "He must run <<<x>>> fast."])), ("b", ""), ("c", None)], "k string, t string")
    f = U.neutral_fields(t, "k", "t")
    got = {(r["k"], r["field"]): r for r in f.collect()}
    cam = got[("a", "camera_result")]
    assert len(cam["segments"]) == 10 and cam["compressed"] and cam["segments"][0]["start"] == 0 and cam["segments"][-1]["text"] == lines[13]
    assert [s["text"] for s in got[("a", "constraints")]["segments"]] == ["He must run fast."]
    assert not got[("b", "camera_result")]["segments"] and ("c", "camera_result") not in got
    ev = U.field_evidence(f.where("k = 'a'"), t, "k", "t")
    assert C.evidence_faults(ev, t, "k", "t").count() == 0
    assert {(r["k"], r["field"]) for r in U.shared_only_fields(f, "k").collect()} == {("a", "action_summary"), ("a", "constraints")}
    d = {(r["k"], r["field"]): r["decision"] for r in U.field_decisions(f, "k").collect()}
    assert d[("a", "camera_result")] == "compressed" and d[("a", "objective")] == "missing" and d[("a", "constraints")] == "kept"
    assert U.presence(f, "k").where("k = 'a'").first()["present"] == 3


def test_strata_evidence_and_dialogue(spark):
    t = spark.createDataFrame([("a", 'SHOT 1\nSHOT 2\nSHOT 3\nSHOT 4\nshe says "m" and "go @cam" and "run now"'), ("b", "plain")], "k string, t string")
    f = E.extract_facts(t, "k", "t")
    ev = U.strata_evidence(t, f, "k", "t", {"structure": ["shot_marker"], "duration": ["declared_duration"]}).collect()
    assert sorted((r["k"], r["dimension"], r["kind"]) for r in ev) == [("a", "duration", "full_scan"), *[("a", "structure", "shot_marker")] * 3, ("b", "duration", "full_scan"), ("b", "structure", "full_scan")]
    assert [(r["line"], r["rejected"]) for r in U.dialogue_lines(f, "k").orderBy("ordinal").collect()] == [("m", "too_short"), ("go @cam", "label_inside"), ("run now", None)]


def test_registers_and_chains(spark):
    st = spark.createDataFrame([("x", 1, "passed", "0", "1"), ("y", 2, "failed", "1", "2"), ("z", 3, "passed", "2", "3"), ("w", 4, "passed", "9", "4")], "stage string, ordinal int, status string, input_digest string, output_digest string")
    assert {r["stage"]: r["fault"] for r in C.digest_chain(st).collect()} == {"z": "input_not_passed", "w": "input_digest"}
    a, b = spark.createDataFrame([("n", "1"), ("m", None)], "name string, value string"), spark.createDataFrame([("n", "2"), ("m", None)], "name string, value string")
    assert [tuple(r) for r in C.changed_settings(a, b).collect()] == [("n", "1", "2")]
    kids = spark.createDataFrame([(1, 0, "p", "f", "p"), (1, 1, "p", "f", "p"), (1, 2, "p", "g", None)], "page_number int, item_index int, asked_parent string, folder_id string, parent_id string")
    assert {(r["folder_id"], r["code"]) for r in C.children_faults(kids).collect()} == {("f", "duplicate_folder_in_page"), ("g", "parent_mismatch")}
    r = spark.createDataFrame([("ok", ["a", "b"]), ("ok", []), ("bad", ["a"])], "s string, c array<string>")
    assert {(x["status"], x["code"]): x["rows"] for x in C.issue_register(r, "s", "c").collect()} == {("ok", "a"): 1, ("ok", "b"): 1, ("ok", "<none>"): 1, ("bad", "a"): 1}
    t = spark.createDataFrame([("t", ["a"]), ("t", ["b"]), ("u", ["a"]), ("v", None)], "t string, s array<string>")
    assert {x["t"]: x["missing"] for x in C.signal_coverage(t, "t", "s", ["b", "a"]).collect()} == {"u": ["b"], "v": ["a", "b"]}
    assert t.select(F.count("*")).first()[0] == 4


def test_roles_and_references(spark):
    r = spark.createDataFrame([("a transform x", "", "character_transformation"), ("Person", "", "character_identity"), (None, "an old sword", "prop"), (None, "the man's sword", "character_identity"), ("", "sky", "environment"), ("styled", "man", "style")], "c string, d string, want string")
    assert all(x["got"] == x["want"] for x in r.select("want", U.reference_role("c", "d").alias("got")).collect())
    d = spark.createDataFrame([("<<<hero>>>: a  man <<<hero>>>", "<<<hero>>>"), ("[x] y", None), ("@cam", "@cam")], "r string, l string")
    assert [x[0] for x in d.select(U.reference_description("r", "l")).collect()] == ["a man", "y", ""]
    t = spark.createDataFrame([("a", "<<<hero>>>: a man in rain\n\n<<<hero>>>: again\n\n@room - a dark hall"), ("b", "Use the Reference  Image here"), ("c", "none"), ("d", None)], "k string, t string")
    f = E.extract_facts(t, "k", "t")
    got = {(x["k"], x["ordinal"]): (x["source_label"], x["role"], x["description"], x["is_subject"]) for x in U.references(t, f, "k", "t").collect()}
    assert got == {("a", 0): ("<<<hero>>>", "character_identity", "a man in rain", True), ("a", 1): ("@room", "environment", "a dark hall", False), ("b", 0): (None, "environment", "Implicit image reference described in the Prompt; exact pixels are unavailable.", False)}
    fields = U.neutral_fields(t, "k", "t")
    tags = spark.createDataFrame([("c", ["environment_establishing"])], "k string, scene_tags array<string>")
    miss = {(x["k"], x["field"]) for x in U.missing_fields(fields, U.references(t, f, "k", "t"), tags, "k").collect()}
    assert ("b", "subjects") in miss and ("a", "subjects") not in miss and ("c", "subjects") not in miss and ("c", "sound") in miss
    assert {x["k"]: x["status"] for x in U.transferability(t.where("t is not null"), "k", "t", t.where("k = 'b'")).collect()} == {"a": "portable_scene_intent", "b": "blocked_needs_manual_review", "c": "portable_scene_intent"}


def test_stems_and_beats(spark):
    t = spark.createDataFrame([("a", "Leftover stages are nearly done. The hero turns left. Then she runs.")], "k string, t string")
    got = {x["field"]: [s["text"] for s in x["segments"]] for x in U.neutral_fields(t, "k", "t").collect()}
    assert got["objective"] == [] and got["spatial_relations"] == ["The hero turns left."] and got["action_summary"] == ["The hero turns left.", "Then she runs."]
    b = U.beats(U.neutral_fields(t, "k", "t"), "k").orderBy("order").collect()
    assert [(x["order"], x["causal_link"].split()[0]) for x in b] == [(1, "source"), (2, "explicit")]
    rec = U.failure_records(spark.createDataFrame([("x", "ValueError")], "k string, reason string"), "k").first()
    assert rec["status"] == "needs_manual_review" and len(rec["missing"]) == 11


def test_conflicts_and_uncertainty(spark):
    t = spark.createDataFrame([("a", "Duration: 4s\nsingle shot\nHARD CUT\nshe says \"stay here\"")], "k string, t string")
    f = E.extract_facts(t, "k", "t")
    s = E.structure(t, f, "k", spark.createDataFrame([("a", [5.0])], "k string, durations array<double>"))
    i = E.issues(t, s, f, "k", "t")
    assert {x["field"] for x in U.source_conflicts(s, i, "k").collect()} == {"duration", "take_structure"}
    fields, refs = U.neutral_fields(t, "k", "t"), U.references(t, f, "k", "t")
    tags = spark.createDataFrame([], "k string, scene_tags array<string>")
    kinds = {x["kind"] for x in U.uncertainty(U.missing_fields(fields, refs, tags, "k"), i, U.dialogue_lines(f, "k"), refs, "k").collect()}
    assert kinds == {"missing_field", "processing_issue", "dialogue_speaker"}
