import __spark_entry__ as entry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["prompt_sha256", "members", "first_member"] and df.count() > 0


def test_sql_belongs_to_queries():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q) and {"p4_found", "p6_found"} <= set(q)


def test_core_queries_against_sql(spark):
    import collections
    import os

    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in os.listdir(d):
        con.execute(f"create view {t.split('.')[0]} as select * from '{d}/{t}'")
    sql = entry.oracle_sql()
    for name in ("exact_clusters", "p4_found", "p4_descendants", "p6_found", "p6_report", "length_percentiles", "nested_export", "stratified_sample", "duration_states", "folder_direct_counts", "corpus_checks", "numeric_neardup_groups", "category_dimensions", "table_digest"):
        df = entry.queries()[name](spark, d)
        cols = sorted(df.columns)
        got = collections.Counter(tuple(r[c] for c in cols) for r in df.collect())
        want = collections.Counter(map(tuple, con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({sql[name]})").fetchall()))
        assert got == want, name


def test_references_agree_with_the_bitmaps(spark):
    d = "/root/testdata/sf0.01"
    q = entry.queries()
    found = q["p6_found"](spark, d).cache()
    folders = {(r["from_key"], r["missing_key"]) for r in found.where("ref_field = 'assets.folder_id'").collect()}
    assert {(r["asset_id"], r["folder_id"]) for r in q["unknown_folders"](spark, d).collect()} == folders and len(folders) == 20
    prompts = {r["missing_key"] for r in found.where("ref_field = 'assets.prompt_sha256'").collect()}
    assert {r["key"] for r in q["fk_orphans"](spark, d).collect()} == prompts and len(prompts) == 9
