import re

import pytest
from pyspark.sql import functions as F

from corpuslathe.functions import hashing
from corpuslathe.functions import numbers as N
from corpuslathe.functions import text as T


def one(spark, c, **cols):
    df = spark.range(1)
    for k, v in cols.items():
        df = df.withColumn(k, v if hasattr(v, "_jc") else F.lit(v))
    return df.select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(("a", "b", "same"), [("Shot 1 lasts 3.5 seconds", "Shot 2 lasts 4.0 seconds", True), ("Image1 moves", "Image2 moves", False), ("v1.5", "v1.6", False), ("up 20%", "up 30%", True)])
def test_numeric_normalize(spark, a, b, same):
    assert (one(spark, T.numeric_normalize("a"), a=a) == one(spark, T.numeric_normalize("a"), a=b)) is same


def test_format_normalize(spark):
    assert one(spark, T.format_normalize("a"), a="  Shot  ONE\n\nAction ") == "shot one action"
    assert one(spark, T.format_normalize("a"), a=" Straße　X ") == "strasse x"
    assert one(spark, T.format_normalize("a"), a=F.lit(None).cast("string")) is None


def test_redaction_and_clip(spark):
    assert one(spark, T.redact_urls("a"), a="Use [r](https://cdn.example.test/r.webp) now.") == "Use [r](<URL_REDACTED> now."
    assert one(spark, T.url_count("a"), a="http://a HTTPS://b x") == 2
    assert one(spark, T.clip("a", 5), a=" -abcdefgh: ") == "abcd..."
    assert one(spark, T.clean_syntax("a"), a="<<<hero>>> runs, @cam H3 mode: fast") == "runs"
    assert one(spark, T.slug("a"), a="  Ärger & Co ") == "rger-co"
    assert one(spark, T.slug("a"), a="!!") == "item"


@pytest.mark.parametrize("text", ["", "a1b22c", "😀 12 é 3", "12", "x" * 300 + "7", "1 2\n3"])
def test_spans_are_python_positions(spark, text):
    got = [(s["start"], s["end"], s["match"]) for s in one(spark, T.spans("a", r"\d+"), a=text)]
    assert got == [(m.start(), m.end(), m[0]) for m in re.finditer(r"\d+", text)]


def test_lines_and_segments(spark):
    text = "TITLE:\nOne two. Three!\n---\n  four; five"
    assert [(x["line"], x["start"]) for x in one(spark, T.lines("a"), a=text)] == [("TITLE:", 0), ("One two. Three!", 7), ("---", 23), ("  four; five", 27)]
    segs = [(x["text"], x["start"], x["end"]) for x in one(spark, T.segments("a"), a=text)]
    assert segs == [("One two.", 7, 15), ("Three!", 16, 22), ("four; five", 29, 39)]
    long = ";".join(["word " * 30] * 8)
    assert len(one(spark, T.segments("a"), a=long)) == 8


def test_contexts_and_endpoints(spark):
    got = one(spark, T.context_matches("a", ["cam"], radius=2), a="xxCamyycamzz")
    assert [(g["offset"], g["context"]) for g in got] == [(2, "xxCamyy"), (7, "yycamzz")]
    ends = one(spark, T.endpoint_candidates("a", "https://h.test"), a="fetch('/api/x') https://h.test/project/1), '/img/folder.png' https://o.test/none")
    assert ends == ["https://h.test/api/x", "https://h.test/project/1"]


def test_numbers(spark):
    assert one(spark, N.decimal_comma("a"), a="3,5") == 3.5
    assert [one(spark, N.length_band("a"), a=v) for v in (1000, 1001, 12000, 12001)] == ["short", "standard", "long", "very_long"]
    assert [one(spark, N.reference_band("a"), a=v) for v in (0, 4, 5)] == ["none", "light", "dense"]
    assert [one(spark, N.backoff("a"), a=v) for v in (1, 2, 3, 9)] == [1.0, 2.0, 4.0, 8.0]
    assert one(spark, N.spread("a", 4), a=F.sequence(F.lit(0), F.lit(9))) == [0, 3, 6, 9]
    assert one(spark, N.spread("a", 1), a=F.sequence(F.lit(0), F.lit(9))) == [0]
    assert one(spark, N.clamp(F.lit(9), 0, 4)) == 4


@pytest.mark.parametrize(("d", "m", "state", "disjoint", "provenance"), [([4], [5.0], "conflict", True, "unresolved_conflict"), ([4], [4.0, None], "consistent", False, "prompt_and_asset_agree"), ([4, 5], [], "multiple_declared", False, "unresolved_conflict"), ([], [4.0, 5.0], "multiple_metadata", False, "unresolved_conflict"), ([], [], "missing", False, "missing"), ([4, 5], [5.0], "conflict", False, "unresolved_conflict"), ([], [None], "missing", False, "missing")])
def test_durations(spark, d, m, state, disjoint, provenance):
    df = spark.createDataFrame([(d, m)], "d array<int>, m array<double>")
    r = df.select(N.duration_state("d", "m").alias("s"), N.durations_disjoint("d", "m").alias("j"), N.duration_observation("d", "m").alias("o")).first()
    assert (r["s"], r["j"], r["o"]["provenance"]) == (state, disjoint, provenance)


def test_digests(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    b = a.orderBy(F.col("k").desc())
    assert hashing.table_digest(a).first() == hashing.table_digest(b).first()
    assert hashing.table_digest(a).first() != hashing.table_digest(a.distinct()).first()
    assert hashing.ordered_digest(a, "k", ["k", "v"]).first() == hashing.ordered_digest(b, "k", ["k", "v"]).first()
    n = spark.createDataFrame([(None, "a"), ("", "a")], "k string, v string"), spark.createDataFrame([("a", None), ("a", "")], "k string, v string")
    assert hashing.table_digest(n[0]).first() != hashing.table_digest(n[1]).first()
    assert a.select(hashing.canonical("v", "k").alias("j")).first()["j"] == '{"k":1,"v":"x"}'


def test_folding_and_urls(spark):
    from urllib.parse import urljoin, urlsplit

    words = ["Straße", "STRASSE", "ΣΊΣΥΦΟΣ", "σίσυφος", "ﬁn", "ı", "I", "İ", "ǅ", "ẞ", "µ", "K", "ſ", "ΐ"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(T.fold("w")).collect()] == [w.casefold() for w in words]
    base = "https://h.test:8/a/b/c?x=1#f"
    paths = ["/p", "q", "../r/s", "./t?y=/../", "//o.test/z", "https://k.test/", "?n=2", "#g", "", "..", "../../../u", "mailto:x@y", "v/./w/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(T.join_url(base, "p")).collect()] == [urljoin(base, p) if p else base.split("#")[0] for p in paths]
    urls = ["https://a.h.test/x", "http://h.test", "https://user@H.TEST:1/", "https://xh.test/", "h.test", "https://o/?u=https://h.test"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    host = lambda u: urlsplit(u).hostname or ""
    assert [r[0] for r in df.select(T.host_is("u", "h.test")).collect()] == [host(u) == "h.test" or host(u).endswith(".h.test") for u in urls]
    assert [r[0] for r in spark.createDataFrame([("https://x/a.PNG?z",), ("https://x/png",)], "u string").select(T.is_media("u")).collect()] == [True, False]


def test_keys(spark):
    from corpuslathe.functions.keys import key

    rows = [("\u00a0 Ab\t\u3000", "ab"), ("  ", None), ("", None), (None, None), ("x y", "x y")]
    assert all(r["k"] == r["want"] for r in spark.createDataFrame(rows, "v string, want string").select("want", key("v").alias("k")).collect())
