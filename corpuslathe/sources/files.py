"""Files as tables: manifests with hashes, JSON documents, event lines, marked-up text, HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions import text as T


def manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of the files below a folder, without their times, so that equal trees give equal manifests."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return f.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """(path, doc, fault): whole files as variants; what is no JSON object has a fault and no doc."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("doc"))
    ok = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False))
    return raw.select("path", F.when(ok, F.col("doc")).alias("doc"), F.when(F.col("doc").isNull(), "not_json").when(~ok, "not_object").alias("fault"))


def event_faults(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_number, fault) of event files: lines that are no JSON object or have no code, with their number from 1. Blank lines are none. Event files are split by file here."""
    n = numbered_lines(spark, path).where(F.length(T.strip("line")) > 0).withColumn("v", F.try_parse_json("line"))
    fault = F.when(~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), "event_log_parse_error").when(F.try_variant_get("v", "$.code", "string").isNull(), "no_code")
    return n.select("path", F.col("number").alias("line_number"), fault.alias("fault")).where("fault is not null")


def events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(at, level, code, line, fault) of files with a JSON object a line; bad lines stay as rows with a fault."""
    r = spark.readStream if stream else spark.read
    v = F.try_parse_json("value")
    get = lambda p: F.try_variant_get("v", p, "string")
    rows = r.text(path).where(F.length(T.strip("value")) > 0).select(F.col("value").alias("line"), v.alias("v"))
    return rows.select(get("$.at").alias("at"), get("$.level").alias("level"), get("$.code").alias("code"), "line", F.when(F.col("v").isNull(), "invalid_json").when(get("$.code").isNull(), "no_code").alias("fault"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, number, line) of text files, numbers from 1; a file is one row until it is split, so files should be of moderate size."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n", -1)).alias("n", "line")).select("path", (F.col("n") + 1).alias("number"), "line")


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, front_matter, headings, links, sections) of marked-up files; front matter as a map of its `key: value` lines."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("t"))
    front = F.regexp_extract("t", r"(?s)^---\r?\n(.*?)\r?\n---", 1)
    keys = F.regexp_extract_all(front, F.lit(r"(?m)^([A-Za-z_][\w-]*):[ \t]*(.*)$"), F.lit(1))
    vals = F.regexp_extract_all(front, F.lit(r"(?m)^([A-Za-z_][\w-]*):[ \t]*(.*)$"), F.lit(2))
    return raw.select(
        "path",
        F.map_from_arrays(F.array_distinct(keys), F.transform(F.array_distinct(keys), lambda k: F.btrim(F.get(vals, F.array_position(keys, k).cast("int") - 1), F.lit(" \"'\r")))).alias("front_matter"),
        F.transform(F.regexp_extract_all("t", F.lit(r"(?m)^(#{1,6}\s+.+)$"), F.lit(1)), lambda h: T.strip(F.regexp_replace(h, r"^#+\s+", ""))).alias("headings"),
        F.regexp_extract_all("t", F.lit(r"\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1)).alias("links"),
        F.regexp_extract_all("t", F.lit(r"(?s)```[a-z]*\s*(.*?)\s*```"), F.lit(1)).alias("sections"),
    )


def html_resources(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, title, scripts, preloads) of HTML texts: script sources, preloaded links and the title."""
    tag = lambda name: F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b([^>]*)>"), F.lit(1))
    attr = lambda t, a: F.regexp_extract(t, rf"(?is)\b{a}\s*=\s*[\"']?([^\"'\s>]+)", 1)
    full = lambda xs: F.filter(xs, lambda x: x != "")
    return pages.select(
        key,
        T.collapse(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        full(F.transform(tag("script"), lambda t: attr(t, "src"))).alias("scripts"),
        full(F.transform(F.filter(tag("link"), lambda t: F.contains(F.lower(F.regexp_extract(t, r"(?is)\brel\s*=\s*[\"']?([^\"'>]+)", 1)), F.lit("preload"))), lambda t: attr(t, "href"))).alias("preloads"),
    )


def recovered(committed: DataFrame, raw: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, origin): of each key the committed row, else the raw file's; what neither has must still be fetched."""
    j = committed.select(key, F.col(value).alias("_c")).join(raw.select(key, F.col(value).alias("_r")), key, "full_outer")
    return j.select(key, F.coalesce("_c", "_r").alias(value), F.when(F.col("_c").isNotNull(), "committed").when(F.col("_r").isNotNull(), "raw").otherwise("missing").alias("origin"))
