import json
import os

import pytest
from pyspark.sql import functions as F

from corpuslathe.operators.contracts import same_files
from corpuslathe.sources import api, files, pages
from corpuslathe.streaming import ingest as I


def job(i, prompt="p", folder="f1", **params):
    return {"type": "job", "job": {"id": i, "folder_id": folder, "status": "completed", "job_set_type": "t", "created_at": 1.5, "params": {"prompt": prompt, "model": "m", "width": 10, "height": 5, "duration": 4, "resolution": "720p", **params}, "results": {"raw": {"type": "video"}}}}


def land(folder, n, items, cursor=None, raw=None):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/page-{n:06d}.json", "w") as f:
        f.write(raw if raw is not None else json.dumps({"items": items, "cursor": cursor}))


def test_parse_items(spark, tmp_path):
    d = str(tmp_path / "raw")
    land(d, 1, [job("a", "Use https://x.test/y now"), job("b", " "), 5, {"type": "other"}, job("", "q"), {"type": "job", "job": {"id": "c"}}], cursor=7)
    land(d, 2, [], raw="{oops")
    land(d, 3, None, cursor=None)
    p = {r["page_number"]: r for r in pages.with_page(pages.read_pages(spark, d)).collect()}
    assert p[1]["next_cursor"] == "int:7" and p[2]["page_issue"] == "page_not_json" and p[3]["page_issue"] == "items_not_a_list"
    got = {r["item_index"]: r for r in pages.parse_items(pages.with_page(pages.read_pages(spark, d)).where("page_issue is null")).collect()}
    codes = {i: [x["code"] for x in r["issues"]] for i, r in got.items()}
    assert codes == {0: ["prompt_url_redacted"], 1: ["empty_prompt"], 2: ["item_not_object"], 3: ["unsupported_item_type"], 4: ["missing_asset_id"], 5: ["missing_folder_id", "missing_job_params", "empty_prompt"]}
    assert got[0]["prompt"]["prompt_text"] == "Use <URL_REDACTED> now" and got[0]["prompt"]["source_prompt_chars"] == 24
    assert got[1]["asset"]["asset_id"] == "b" and got[1]["asset"]["prompt_sha256"] is None and got[4]["asset"] is None
    good, bad = pages.strict_records(pages.parse_items(pages.with_page(pages.read_pages(spark, d)).where("page_issue is null")))
    assert good.count() == 1 and {r["error"] for r in bad.collect()} == {"empty_prompt", "item_not_object", "unsupported_item_type", "missing_asset_id", "missing_folder_id"}


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    raw, root, ck = (str(tmp_path / x) for x in ("raw", "root", "ck"))
    land(raw, 1, [job("a", "one"), job("b", "one"), job("a", "one", "f2")], cursor="x")
    land(raw, 2, [job("c", "two"), 9], cursor="y")
    assert I.ingest(spark, raw, root, ck, max_files=1) == 2
    land(raw, 3, [job("a", "three", "f3"), job("d", "two")])
    assert I.ingest(spark, raw, root, ck) == 1
    assert I.ingest(spark, raw, root, ck) == 0  # nothing landed since
    t = I.corpus(spark, root)
    assert {r["asset_id"]: r["source_page"] for r in t["assets"].collect()} == {"a": 1, "b": 1, "c": 2, "d": 3}
    assert {(r["asset_id"], r["folder_id"]) for r in t["memberships"].collect()} >= {("a", "f1"), ("a", "f2"), ("a", "f3")}
    assert t["prompts"].count() == 3 and t["issues"].where("code = 'duplicate_asset_id'").count() == 2
    rec = I.reconciliation(t).first()
    assert rec["closed"] and rec["status"] == "passed" and rec["items"] == 7
    one = str(tmp_path / "batch")
    I.commit_batch(one)(pages.read_pages(spark, raw), 0)
    I.commit_batch(one)(pages.read_pages(spark, raw), 0)  # a repeated batch counts once
    for name in ("assets", "prompts", "memberships", "occurrences"):
        a, b = t[name], I.corpus(spark, one)[name]
        assert a.select(*b.columns).exceptAll(b).count() == 0 and b.exceptAll(a.select(*b.columns)).count() == 0, name


def test_cursor_faults(spark):
    rows = [(1, None, "str:a", 2), (2, "str:a", "str:b", 2), (3, "str:x", "str:b", 1), (5, "str:b", "str:c", 0)]
    df = spark.createDataFrame(rows, "page_number bigint, requested_cursor string, next_cursor string, n int").withColumn("items", F.array_repeat(F.lit(1), F.col("n").cast("int"))).drop("n")
    assert {r["page_number"]: r["fault"] for r in pages.cursor_faults(df).collect()} == {3: "cursor_mismatch", 5: "page_missing"}


def test_folders(spark):
    u = "0f8fad5b-d9cb-469f-a165-70867728950e"
    docs = [json.dumps({"id": u, "name": "n", "count": 1, "subfolders_count": 0, "url": "x"}), json.dumps({"id": "x"}), json.dumps({"id": u, "name": "n", "count": True, "subfolders_count": 0}), "[1]", json.dumps({"id": u, "name": "", "count": 1})]
    got = [r["fault"] for r in pages.sanitized_folders(spark.createDataFrame([(x,) for x in docs], "raw string")).collect()]
    assert got == [None, "invalid_id", "invalid_count", "not_object", "invalid_name"]


def test_files(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"at":"1","level":"info","code":"a","x":1}\nbad\n{"level":"w"}\n\n')
    got = [(r["code"], r["fault"]) for r in files.events(spark, str(tmp_path / "e.jsonl")).collect()]
    assert got == [("a", None), (None, "invalid_json"), (None, "no_code")]
    (tmp_path / "m.md").write_text("---\ntitle: A b\nkind: x\n---\n# Head\n[l](a.md) text\n## Two\n")
    m = files.markdown(spark, str(tmp_path / "m.md")).first()
    assert m["front_matter"] == {"title": "A b", "kind": "x"} and m["headings"] == ["Head", "Two"] and m["links"] == ["a.md"]
    a, b = files.manifest(spark, str(tmp_path)), files.manifest(spark, str(tmp_path)).where("path not like '%e.jsonl'")
    assert [r["fault"] for r in same_files(a, b).collect()] == ["missing"]
    (tmp_path / "o.json").write_text("[1]")
    assert files.json_objects(spark, str(tmp_path / "o.json")).first()["fault"] == "not_object"
    assert [r["number"] for r in files.numbered_lines(spark, str(tmp_path / "m.md")).where("line like '#%'").collect()] == [5, 7]


def test_api_lands_and_goes_on(tmp_path):
    served = {None: {"items": [1], "cursor": "a"}, "a": {"items": [2], "cursor": 3}, "3": {"items": [4], "cursor": ""}}
    asked = []

    def get(url):
        c = url.split("cursor=")[1] if "cursor=" in url else None
        asked.append(c)
        return json.dumps(served[c])

    d = str(tmp_path / "p")
    assert api.land("http://h", d, {"size": "1"}, max_pages=1, get=get, sleep=lambda _: None) == (1, False)
    assert api.land("http://h", d, {"size": "1"}, get=get, sleep=lambda _: None) == (2, True)
    assert api.land("http://h", d, {"size": "1"}, get=get, sleep=lambda _: None) == (0, True) and asked == [None, "a", "3"]
    served["a"]["cursor"] = "a"
    with pytest.raises(ValueError, match="again"):
        api.land("http://h", str(tmp_path / "q"), {}, get=get, sleep=lambda _: None)


def test_retries():
    import urllib.error

    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        raise urllib.error.HTTPError(url, 503, "busy", None, None)

    with pytest.raises(urllib.error.HTTPError):
        api.fetch("http://h", opener=opener, sleep=waits.append)
    assert len(calls) == 4 and waits == [1.0, 2.0, 4.0]


def test_sqlite(spark, tmp_path):
    import sqlite3

    from corpuslathe.sources import sqlite

    path = str(tmp_path / "a.db")
    con = sqlite3.connect(path)
    con.executescript("CREATE TABLE p (k TEXT PRIMARY KEY, n INTEGER, x REAL, b BLOB); CREATE TABLE c (p TEXT REFERENCES p(k)); CREATE TABLE e (k TEXT)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?)", [(f"k{i}", i, i / 2, b"z") for i in range(25)] + [("bad", "text", None, None)])
    con.commit()
    got = sqlite.read_table(spark, path, "p", rows_per_task=7)
    assert got.dtypes == [("k", "string"), ("n", "bigint"), ("x", "double"), ("b", "binary")] and got.count() == 26
    assert got.where("k = 'k3'").first()["x"] == 1.5 and got.where("k = 'bad'").first()["n"] is None
    assert {r["name"]: r["rows"] for r in sqlite.row_counts(sqlite.read_tables(spark, path, ["p", "e"])).collect()} == {"p": 26, "e": 0}
    with pytest.raises(ValueError, match="no table"):
        sqlite.read_table(spark, path, "q")
    con.execute("INSERT INTO c VALUES ('gone')")
    con.commit()
    con.close()
    with pytest.raises(ValueError, match="foreign key"):
        sqlite.read_table(spark, path, "p")


def test_folder_tree(spark):
    schema = "parent_id string, page_number int, requested_cursor string, next_cursor string, item_index int, folder struct<folder_id:string,parent_id:string,name:string,path:string,reported_asset_count:bigint,reported_subfolders_count:bigint>"
    f = lambda i, p, subs=0: (i, p, i.upper(), None, 1, subs)
    rows = [("r", 1, None, "str:2", 0, f("a", "r", 2)), ("r", 2, "str:2", None, 0, f("a", "r", 2)), ("r", 2, "str:2", None, 1, f("b", "r")), ("a", 1, None, None, 0, f("c", "a")), ("a", 1, None, None, 1, f("d", "x")), ("c", 1, None, "str:9", 0, None)]
    df = spark.createDataFrame(rows, schema)
    root = spark.createDataFrame([("0", 1, None, None, 0, f("r", None, 2))], schema)
    folders, faults = pages.folder_tree(df.unionByName(root), "r")
    got = {r["folder_id"]: (r["depth"], r["derived_path"]) for r in folders.collect()}
    assert got == {"r": (0, "R"), "a": (1, "R/A"), "b": (1, "R/B"), "c": (2, "R/A/C")}
    assert {(r["parent_id"], r["folder_id"], r["code"]) for r in faults.collect()} == {("r", "a", "duplicate_folder_across_pages"), ("a", "d", "parent_mismatch"), ("x", "d", "not_below_root"), ("0", "r", "parent_mismatch"), ("c", None, "empty_page_with_cursor")}
    assert {r["folder_id"] for r in pages.pending_parents(folders, df, "r").collect()} == set()


def test_event_faults_and_cleaning(spark, tmp_path):
    from corpuslathe import runtime
    from corpuslathe.sources import files

    (tmp_path / "e.jsonl").write_text('{"code":"x"}\n\nbroken\n[1]\n{"at":"1"}\n')
    assert {(r["line_number"], r["fault"]) for r in files.event_faults(spark, str(tmp_path)).collect()} == {(3, "event_log_parse_error"), (4, "event_log_parse_error"), (5, "no_code")}
    with runtime.cleaning(spark):
        path = runtime.materialize(spark.range(3), "t").inputFiles()[0].rsplit("/", 1)[0]
        assert runtime.exists(spark, path)
    assert not runtime.exists(spark, path)
