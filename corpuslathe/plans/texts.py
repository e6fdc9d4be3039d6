"""Queries of text functions, facts and strata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions import numbers as N
from corpuslathe.functions import text as T
from corpuslathe.operators import contracts as C
from corpuslathe.operators import facts as E
from corpuslathe.operators import relational as R
from corpuslathe.plans import tables as V
from corpuslathe.plans.registry import Registry, table
from corpuslathe.runtime import materialize

REG = Registry()
q = REG.query

#: Groups of signals that describe a prompt, with their patterns.
SIGNALS = {
    "action": [r"\bfight(?:ing)?\b", r"\bpunch(?:es|ed|ing)?\b", r"\bkick(?:s|ed|ing)?\b", r"\bstrike(?:s|n)?\b", r"\battack(?:s|ed|ing)?\b", r"\bdodg(?:e|es|ed|ing)\b", r"\bgrappl(?:e|es|ed|ing)\b", r"\bslam(?:s|med|ming)?\b", r"\bblade\b", r"\bsword\b", r"\bweapon\b"],
    "camera": [r"\bcamera\b", r"\blens\b", r"\bshot\b", r"\bframing\b", r"\bfield of view\b", r"\bclose-up\b"],
    "spatial": [r"\bscreen[- ]left\b", r"\bscreen[- ]right\b", r"\bforeground\b", r"\bmidground\b", r"\bbackground\b", r"\bfac(?:e|es|ing)\b", r"\bgaze\b", r"\bwithin \d+(?:\.\d+)? (?:meter|metre|foot|feet)\b"],
    "physics": [r"\bimpact\b", r"\binertia\b", r"\bweight transfer\b", r"\bground contact\b", r"\bcollision\b", r"\bfriction\b", r"\bgravity\b", r"\bfollow-through\b", r"\bdebris\b"],
    "dialogue": [r"\bdialogue\b", r"\b(?:says|speaks|shouts|whispers|asks|replies|murmurs)\b", r"\blip[- ]sync\b", r"\bspoken line\b", r"\bvoice\b"],
    "quoted_speech": [r"<d>\s*\[[^\]]+\][\s\S]{2,}?</d>", r"[\"“][^\"”\r\n]{3,}[\"”]"],
    "performance": [r"\bsubtext\b", r"\breaction\b", r"\beyes?\b", r"\bbreath(?:es|ing)?\b", r"\bhesitat(?:e|es|ed|ing|ion)\b", r"\bexpression\b", r"\bposture\b", r"\bgesture\b"],
    "environment": [r"\bestablishing\b", r"\baerial\b", r"\benvironment\b", r"\bexterior\b", r"\binterior\b", r"\blandscape\b", r"\barchitecture\b", r"\blocation\b", r"\bgeography\b"],
    "lighting": [r"\blighting\b", r"\bbacklight\b", r"\brim light\b", r"\bshadow\b", r"\bexposure\b", r"\bsunlight\b", r"\bmoonlight\b", r"\bneon\b"],
    "atmosphere": [r"\brain\b", r"\bfog\b", r"\bsmoke\b", r"\bdust\b", r"\bsnow\b", r"\bwind\b", r"\bmist\b", r"\bambience\b"],
}
#: The signals that count for each category of scene, and the folder names that speak for it.
DIMENSIONS = {
    "action_fight": (["action", "camera", "spatial", "physics"], "action_folder", r"fight|attack|battle|\bvs\b|bomb"),
    "dialogue_performance": (["dialogue", "quoted_speech", "performance", "camera", "spatial"], None, None),
    "environment_establishing": (["environment", "camera", "lighting", "atmosphere", "spatial"], "environment_folder", r"aerial|opening|museum|orphanage|pizzeria|sanctum|roof|environment|location"),
}


def _sql_any(c: str, ps: list[str]) -> str:
    return f"regexp_matches({c}, '{'|'.join(ps)}', 'i')"


def _edged(ps: list[str]) -> list[str]:
    """Word edges and classes as the SQL side has them."""
    return [f"(?-U:{p})" for p in ps]


@q("SELECT doc_id, CASE WHEN n_chars <= 1000 THEN 'short' WHEN n_chars <= 6000 THEN 'standard' WHEN n_chars <= 12000 THEN 'long' ELSE 'very_long' END AS band FROM documents")
def text_length_bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", N.length_band("n_chars").alias("band"))


@q("SELECT doc_id FROM documents WHERE length(text) <> n_chars")
def length_faults(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.length("text") != F.col("n_chars")).select("doc_id")


# stored texts are redacted already: each is given its own key as an address before it goes through
@q("""SELECT prompt_sha256, sha256(regexp_replace('See https://h.example/' || prompt_sha256 || '?x=1 and HTTP://b.example, ' || prompt_text, '(?i)https?://[^\\s<>"'']+', '<URL_REDACTED>', 'g')) AS redacted_sha256,
 2 + len(regexp_extract_all(prompt_text, '(?i)https?://[^\\s<>"'']+')) AS urls, len(string_split(prompt_text, '<URL_REDACTED>')) - 1 AS markers FROM prompts""")
def url_redaction(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("See https://h.example/"), "prompt_sha256", F.lit("?x=1 and HTTP://b.example, "), "prompt_text")
    return table(spark, d, "prompts").select("prompt_sha256", F.sha2(T.redact_urls(t), 256).alias("redacted_sha256"), T.url_count(t).alias("urls"), F.regexp_count("prompt_text", F.lit(T.URL_MARKER)).alias("markers"))


_SIG_SQL = ", ".join(f"{_sql_any('text', ps)} AS {n}" for n, ps in SIGNALS.items())


@q(f"SELECT doc_id, concat_ws(',', {', '.join(f'CASE WHEN {n} THEN {chr(39)}{n}{chr(39)} END' for n in SIGNALS)}) AS signals FROM (SELECT doc_id, {_SIG_SQL} FROM documents)")
def signal_matrix(spark: SparkSession, d: str) -> DataFrame:
    groups = {n: _edged(ps) for n, ps in SIGNALS.items()}
    return table(spark, d, "documents").select("doc_id", F.array_join(T.signals("text", groups), ",").alias("signals"))


@q(f"SELECT doc_id FROM documents WHERE {_sql_any('text', SIGNALS['camera'])} AND {_sql_any('text', SIGNALS['lighting'])}")
def qualifying_documents(spark: SparkSession, d: str) -> DataFrame:
    groups = {n: _edged(SIGNALS[n]) for n in ("camera", "lighting")}
    return table(spark, d, "documents").where(F.size(F.array_except(F.array(F.lit("camera"), F.lit("lighting")), T.signals("text", groups))) == 0).select("doc_id")


@q("""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'item') AS slug FROM part""")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("slug"))


@q()
def clipped_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompts").select("prompt_sha256", T.clip("prompt_text").alias("clipped"), T.clip(T.clean_syntax("prompt_text"), 240).alias("neutral"), T.excerpt("prompt_text").alias("excerpt"))


@q()
def text_segments(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "prompts").select("prompt_sha256", F.posexplode(T.segments("prompt_text")).alias("ordinal", "s"))
    return s.select("prompt_sha256", "ordinal", "s.text", "s.start", "s.end")


@q()
def term_contexts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents").select("doc_id", F.explode(T.context_matches("text", ["camera", "lantern", "lens"], radius=40)).alias("m"))
    return m.select("doc_id", "m.term", "m.offset", "m.context")


_METADATA = "SELECT prompt_sha256, list_sort(list_distinct(list(duration_seconds) FILTER (duration_seconds IS NOT NULL))) AS m FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY 1"
_DECLARED = "SELECT prompt_sha256, list_sort(list_distinct([CAST(x AS DOUBLE) FOR x IN regexp_extract_all(prompt_text, '(?:^|[^0-9.])([0-9]+) s[) ,.;]', 1)])) AS d FROM p"


def _durations(spark: SparkSession, d: str) -> DataFrame:
    return V.assets(spark, d, "prompt_sha256", "duration_seconds").where("prompt_sha256 is not null").groupBy("prompt_sha256").agg(F.array_sort(F.collect_set("duration_seconds")).alias("durations"))


@q(V.sql(f"""WITH x AS (SELECT prompt_sha256, d, coalesce(m, []) AS m FROM ({_DECLARED}) LEFT JOIN ({_METADATA}) USING (prompt_sha256))
SELECT prompt_sha256, CASE WHEN len(d) > 0 AND len(m) > 0 AND d <> m THEN 'conflict' WHEN len(d) > 1 THEN 'multiple_declared' WHEN len(m) > 1 THEN 'multiple_metadata' WHEN len(d) > 0 AND len(m) > 0 THEN 'consistent' WHEN len(d) > 0 THEN 'prompt_only' WHEN len(m) > 0 THEN 'asset_metadata_only' ELSE 'missing' END AS state,
 len(d) > 0 AND len(m) > 0 AND NOT list_has_any(d, m) AS disjoint,
 CASE WHEN (len(d) > 0 AND len(m) > 0 AND d <> m) OR len(d) > 1 OR len(m) > 1 THEN 'unresolved_conflict' WHEN len(d) > 0 AND len(m) > 0 THEN 'prompt_and_asset_agree' WHEN len(d) > 0 THEN 'prompt_only' WHEN len(m) > 0 THEN 'asset_metadata_only' ELSE 'missing' END AS provenance FROM x"""))
def duration_states(spark: SparkSession, d: str) -> DataFrame:
    p = V.prompts(spark, d).select("prompt_sha256", F.regexp_extract_all("prompt_text", F.lit(r"(?:^|[^0-9.])([0-9]+) s[) ,.;]"), F.lit(1)).cast("array<double>").alias("d"))
    p = p.join(_durations(spark, d), "prompt_sha256", "left").withColumn("m", F.coalesce("durations", F.array().cast("array<double>")))
    return p.select("prompt_sha256", N.duration_state("d", "m").alias("state"), N.durations_disjoint("d", "m").alias("disjoint"), N.duration_observation("d", "m")["provenance"].alias("provenance"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return E.distinct_texts(V.prompts(spark, d), "prompt_sha256", "prompt_text")


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return E.extract_facts(_texts(spark, d), "prompt_sha256", "prompt_text")


def written_facts(spark: SparkSession, d: str) -> DataFrame:
    """The facts, evaluated once for all that is derived from them."""
    return materialize(_facts(spark, d), "facts")


def structure_of(spark: SparkSession, d: str, facts: DataFrame) -> DataFrame:
    return E.structure(V.prompts(spark, d).where("prompt_text is not null").select("prompt_sha256").distinct(), facts, "prompt_sha256", _durations(spark, d))


def issues_of(spark: SparkSession, d: str, facts: DataFrame, structure: DataFrame) -> DataFrame:
    t = V.prompts(spark, d).select("prompt_sha256", "prompt_text", "url_redaction_count")
    return E.issues(t, structure, facts, "prompt_sha256", "prompt_text", "url_redaction_count")


@q()
def fact_spans(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d)


#: Kinds of facts whose rule is one pattern that needs no look-around, so that SQL can count them.
_COUNTED = {("reference_tag", "triple"): E.TRIPLE, ("generation_mode", "natural_language"): E.MODE_WORDS, ("take_declaration", "single"): E.SINGLE, ("take_declaration", "multi"): E.MULTI, **{("audio", n): E.AUDIO[n] for n in ("negative_music", "negative_voiceover", "negative_subtitles", "sfx_only")}}
_COUNTED_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, '{n}' AS subtype, prompt_sha256, len(regexp_extract_all(prompt_text, '{'(?i)' if p.startswith('(?i') else ''}{p.replace('(?iU)', '')}')) AS n FROM p" for (k, n), p in _COUNTED.items())


@q(V.sql(f"SELECT kind, subtype, CAST(sum(n) AS BIGINT) AS facts, count(*) AS prompts FROM ({_COUNTED_SQL}) WHERE n > 0 GROUP BY 1, 2"))
def fact_pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = F.lit(False)
    for k, n in _COUNTED:
        counted = counted | ((F.col("kind") == k) & (F.col("subtype") == n))
    per = _facts(spark, d).where(counted).groupBy("kind", "subtype", "prompt_sha256").agg(F.count("*").alias("n"))
    return per.groupBy("kind", "subtype").agg(F.sum("n").alias("facts"), F.count("*").alias("prompts"))


@q()
def fact_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    per = _facts(spark, d).groupBy("kind", "subtype", "prompt_sha256").agg(F.count("*").alias("n"))
    return per.groupBy("kind", "subtype").agg(F.sum("n").alias("facts"), F.count("*").alias("prompts"))


@q("SELECT CAST(NULL AS VARCHAR) AS prompt_sha256, CAST(NULL AS INTEGER) AS start, CAST(NULL AS INTEGER) AS \"end\", CAST(NULL AS VARCHAR) AS fault WHERE false")
def fact_evidence_faults(spark: SparkSession, d: str) -> DataFrame:
    return C.evidence_faults(_facts(spark, d), _texts(spark, d), "prompt_sha256", "prompt_text")


@q()
def structure_rollup(spark: SparkSession, d: str) -> DataFrame:
    s = structure_of(spark, d, written_facts(spark, d))
    return s.select(*(F.col(c).cast("string").alias(c) if t.startswith("array") else F.col(c) for c, t in s.dtypes))


@q()
def fact_issues(spark: SparkSession, d: str) -> DataFrame:
    f = written_facts(spark, d)
    return issues_of(spark, d, f, structure_of(spark, d, f))


@q()
def derived_strata(spark: SparkSession, d: str) -> DataFrame:
    f = written_facts(spark, d)
    s = materialize(structure_of(spark, d, f), "structure")
    t = V.prompts(spark, d).select("prompt_sha256", "prompt_text", "source_prompt_chars", "url_redaction_count")
    out = E.stratify(t, s, issues_of(spark, d, f, s), "prompt_sha256", "prompt_text", "source_prompt_chars")
    return out.select(*(F.array_join(c, ",").alias(c) if x.startswith("array") else F.col(c) for c, x in out.dtypes))


_SCENE_WORDS = {k: v.replace("(?iU)", "") for k, v in E.SCENES.items()}


@q("SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {n} THEN '{n}' END" for n in _SCENE_WORDS) + ", CASE WHEN CAST(action_interaction AS INT) + CAST(character_performance AS INT) + CAST(environment_establishing AS INT) > 1 THEN 'mixed_scene' WHEN NOT action_interaction AND NOT character_performance AND NOT environment_establishing THEN 'unspecified_scene' END) AS tags FROM (SELECT doc_id, " + ", ".join(f"regexp_matches(text, '{p}', 'i') AS {n}" for n, p in _SCENE_WORDS.items()) + " FROM documents)")
def scene_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(E.scene_tags(F.col("text"), F.lit(False)), ",").alias("tags"))


@q(r"""SELECT source, count(*) AS texts, count(*) FILTER (u) AS source_asset_id, count(*) FILTER (m) AS media_url, count(*) FILTER (t) AS historical_duration, count(*) FILTER (a) AS historical_at_tag, count(*) FILTER (h) AS foreign_syntax FROM (SELECT source,
 regexp_matches(text, '(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b') AS u, regexp_matches(text, '(?i)https?://') AS m, regexp_matches(text, '(^|[^0-9A-Za-z_@])@[A-Za-z]') AS a,
 regexp_matches(text, '(?i)\b\d+(?:\.\d+)?\s*(?:s|sec|secs|second|seconds)\b|\d+(?:\.\d+)?\s*秒') AS t, contains(text, 'Context-IR') OR contains(text, '<Picture 1>') OR contains(text, '<Video 1>') OR contains(text, '<Audio 1>') AS h FROM documents) GROUP BY 1""")
def handoff_leaks(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("source", C.leaks("text", F.lit("seedance")).alias("l"))
    return x.groupBy("source").agg(F.count("*").alias("texts"), *(F.count_if(F.array_contains("l", n)).alias(n) for n in C.LEAKS), F.count_if(F.exists("l", lambda c: F.contains(c, F.lit(":")))).alias("foreign_syntax"))


@q("""SELECT user_id, CASE WHEN list_contains(s, 'error') THEN true WHEN list_contains(s, 'purchase') THEN true ELSE false END AS retrieve,
 CASE WHEN list_contains(s, 'error') THEN 'error' WHEN list_contains(s, 'purchase') THEN 'purchase' WHEN list_contains(s, 'view') THEN 'view' ELSE 'no_retrieval_trigger' END AS reason
FROM (SELECT user_id, list(DISTINCT event_type) AS s FROM events GROUP BY 1)""")
def retrieval_decision(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))
    return s.select("user_id", C.retrieval("s", ["error", "purchase"], "view").alias("r")).select("user_id", "r.retrieve", "r.reason")


FAMILIES = ["manual_review", "simple", "standard", "complex", "<null>"]
_FAMILY = """c AS (SELECT DISTINCT p.prompt_sha256, coalesce(s.complexity_queue, '<null>') AS family, p.source_prompt_chars AS n FROM s JOIN p USING (prompt_sha256)),
k AS (SELECT family, row_number() OVER (PARTITION BY family ORDER BY n DESC, prompt_sha256) AS rank, prompt_sha256 FROM c), t AS (SELECT * FROM k WHERE rank <= 20 AND family IN ('manual_review', 'simple', 'standard', 'complex', '<null>'))"""


@q(V.sql(f"WITH {_FAMILY} SELECT family, rank, prompt_sha256 FROM t"))
def family_topk(spark: SparkSession, d: str) -> DataFrame:
    s = V.strata(spark, d, "complexity_queue").withColumn("complexity_queue", R.shown("complexity_queue")).join(V.prompts(spark, d).select("prompt_sha256", "source_prompt_chars"), "prompt_sha256")
    return R.families_in_turn(s, "prompt_sha256", "complexity_queue", FAMILIES, 20, F.col("source_prompt_chars").desc(), F.col("prompt_sha256"))


def _selection(spark: SparkSession, d: str) -> DataFrame:
    """All prompts as candidates, longest first; prompts that numbers alone tell apart block each other."""
    s = V.strata(spark, d, "complexity_queue").withColumn("complexity_queue", R.shown("complexity_queue"))
    s = s.join(V.prompts(spark, d).select("prompt_sha256", "source_prompt_chars", F.array(F.sha2(T.numeric_normalize("prompt_text"), 256)).alias("b")), "prompt_sha256")
    return R.greedy_quota(s, "prompt_sha256", "complexity_queue", "b", 3, F.col("source_prompt_chars").desc(), F.col("prompt_sha256"))


@q()
def final_selection(spark: SparkSession, d: str) -> DataFrame:
    return _selection(spark, d)


@q()
def decision_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return _selection(spark, d).groupBy("family", "decision").agg(F.count("*").alias("rows"))


@q()
def rendered_cases(spark: SparkSession, d: str) -> DataFrame:
    from corpuslathe.sinks import rendered

    s = _selection(spark, d).where("decision = 'selected'").join(V.prompts(spark, d).select(F.col("prompt_sha256").alias("key"), "prompt_text"), "key")
    s = R.case_numbers(s, "family", F.col("family"), F.col("key"))
    return rendered(s, "# {title}\n\nFamily: {family}\n\n{body}\n", title=F.col("case_id"), family=F.col("family"), body=T.bullets(F.transform(F.slice(T.segments("prompt_text"), F.lit(1), F.lit(3)), lambda x: x["text"]))).select("key", "family", "rank", "case_id", "document")


def _category_sql(name: str) -> str:
    signals, flag, folder = DIMENSIONS[name]
    cases = [f"CASE WHEN {_sql_any('prompt_text', SIGNALS[n])} THEN '{n}' END" for n in signals] + ([f"CASE WHEN regexp_matches(names, '{folder}', 'i') THEN '{flag}' END"] if flag else [])
    return f"SELECT prompt_sha256, '{name}' AS category, array_to_string(list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)), ',') AS dimensions, {len(cases)} AS possible FROM b"


_BOUNDS = "source_prompt_chars BETWEEN 100 AND 12000"


@q(V.sql(f"""WITH b AS (SELECT p.prompt_sha256, p.prompt_text, coalesce(string_agg(DISTINCT f.name, ' | ' ORDER BY f.name), '') AS names FROM p LEFT JOIN a USING (prompt_sha256) LEFT JOIN f ON a.folder_id = f.folder_id WHERE {_BOUNDS} GROUP BY 1, 2)
SELECT prompt_sha256, category, dimensions, CASE WHEN dimensions = '' THEN 0 ELSE len(string_split(dimensions, ',')) END = possible AS qualifies FROM ({' UNION ALL '.join(map(_category_sql, DIMENSIONS))})"""))
def category_dimensions(spark: SparkSession, d: str) -> DataFrame:
    pairs = V.assets(spark, d, "prompt_sha256", "folder_id").select("prompt_sha256", "folder_id").distinct().join(V.folders(spark, d).select("folder_id", "name"), "folder_id")
    names = pairs.groupBy("prompt_sha256").agg(F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("names"))
    b = V.prompts(spark, d).where(_BOUNDS).select("prompt_sha256", "prompt_text").join(names, "prompt_sha256", "left")
    per = []
    for name, (signals, flag, folder) in DIMENSIONS.items():
        own = T.signals("prompt_text", {n: _edged(SIGNALS[n]) for n in signals})
        if flag:
            own = F.concat(own, F.when(F.coalesce(F.col("names"), F.lit("")).rlike(f"(?i){folder}"), F.array(F.lit(flag))).otherwise(F.array().cast("array<string>")))
        per.append(F.struct(F.lit(name).alias("category"), F.array_sort(own).alias("dims"), F.lit(len(signals) + bool(flag)).alias("possible")))
    e = b.select("prompt_sha256", F.explode(F.array(*per)).alias("c"))
    return e.select("prompt_sha256", "c.category", F.array_join("c.dims", ",").alias("dimensions"), (F.size("c.dims") == F.col("c.possible")).alias("qualifies"))


@q("""SELECT event_id, event_type AS title, '/api/' || user_id || '.js' AS scripts, '/p.js' AS preloads, 'https://h.example/api/' || user_id || '.js' AS endpoints FROM events""")
def html_resources(spark: SparkSession, d: str) -> DataFrame:
    from corpuslathe.sources.files import html_resources as scan

    e = table(spark, d, "events").select("event_id", F.concat(F.lit("<html><head><title> "), "event_type", F.lit(" </title><script src='/api/"), F.col("user_id").cast("string"), F.lit(".js'></script><link rel=\"modulepreload\" href=\"/p.js\"></head></html>")).alias("html"))
    r = scan(e, "event_id", "html").join(e, "event_id")
    return r.select("event_id", "title", F.array_join("scripts", ",").alias("scripts"), F.array_join("preloads", ",").alias("preloads"), F.array_join(T.endpoint_candidates("html", "https://h.example"), ",").alias("endpoints"))
