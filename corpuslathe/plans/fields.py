"""Queries of neutral fields and of what is checked about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions import numbers as N
from corpuslathe.functions import text as T
from corpuslathe.operators import contracts as C
from corpuslathe.operators import facts as E
from corpuslathe.operators import neutral as U
from corpuslathe.plans import tables as V
from corpuslathe.plans import texts as X
from corpuslathe.plans.registry import Registry, table
from corpuslathe.runtime import materialize

REG = Registry()
q = REG.query


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return E.distinct_texts(V.prompts(spark, d), "prompt_sha256", "prompt_text")


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return U.neutral_fields(_texts(spark, d), "prompt_sha256", "prompt_text")


@q()
def neutral_fields(spark: SparkSession, d: str) -> DataFrame:
    return _fields(spark, d).select("prompt_sha256", "field", F.array_join(F.transform("segments", lambda s: s["text"]), "\n").alias("kept"), "compressed")


@q()
def field_decisions(spark: SparkSession, d: str) -> DataFrame:
    return U.field_decisions(_fields(spark, d), "prompt_sha256").groupBy("field", "decision").agg(F.count("*").alias("prompts"), F.sum("kept").alias("segments"))


@q()
def field_evidence_faults(spark: SparkSession, d: str) -> DataFrame:
    return C.evidence_faults(U.field_evidence(_fields(spark, d), _texts(spark, d), "prompt_sha256", "prompt_text"), _texts(spark, d), "prompt_sha256", "prompt_text")


@q()
def shared_only_fields(spark: SparkSession, d: str) -> DataFrame:
    return U.shared_only_fields(_fields(spark, d), "prompt_sha256")


@q()
def field_presence(spark: SparkSession, d: str) -> DataFrame:
    return U.presence(_fields(spark, d), "prompt_sha256")


@q()
def strata_evidence(spark: SparkSession, d: str) -> DataFrame:
    f = X.written_facts(spark, d)
    return U.strata_evidence(_texts(spark, d), f, "prompt_sha256", "prompt_text", {"structure": ["take_declaration", "shot_marker", "cut_marker"], "dialogue": ["dialogue", "audio", "language"], "duration": ["declared_duration"], "marker_density": ["shot_marker", "cut_marker", "timestamp"], "reference_density": ["reference_tag", "reference_block"]})


@q()
def dialogue_utterances(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id"), "text")
    return U.dialogue_lines(E.extract_facts(docs, "doc_id", "text"), "doc_id").select("doc_id", "speaker", "line", "rejected").distinct()


def _references(spark: SparkSession, d: str, facts: DataFrame) -> DataFrame:
    return materialize(U.references(_texts(spark, d), facts, "prompt_sha256", "prompt_text"), "references")


@q()
def material_references(spark: SparkSession, d: str) -> DataFrame:
    return U.references(_texts(spark, d), X.written_facts(spark, d), "prompt_sha256", "prompt_text")


@q()
def action_beats(spark: SparkSession, d: str) -> DataFrame:
    return U.beats(_fields(spark, d), "prompt_sha256")


@q()
def source_conflicts(spark: SparkSession, d: str) -> DataFrame:
    f = X.written_facts(spark, d)
    s = materialize(X.structure_of(spark, d, f), "structure")
    return U.source_conflicts(s, X.issues_of(spark, d, f, s), "prompt_sha256")


@q()
def uncertainty(spark: SparkSession, d: str) -> DataFrame:
    f = X.written_facts(spark, d)
    s = materialize(X.structure_of(spark, d, f), "structure")
    i = materialize(X.issues_of(spark, d, f, s), "issues")
    r, fields = _references(spark, d, f), materialize(_fields(spark, d), "fields")
    tags = _texts(spark, d).select("prompt_sha256", E.scene_tags(F.col("prompt_text"), F.lit(False)).alias("scene_tags"))
    return U.uncertainty(U.missing_fields(fields, r, tags, "prompt_sha256"), i, U.dialogue_lines(f, "prompt_sha256"), r, "prompt_sha256")


@q(V.sql("SELECT prompt_sha256, CASE WHEN contains(prompt_text, '�') THEN 'blocked_needs_manual_review' ELSE 'portable_scene_intent' END AS status, 'none' AS media_binding, regexp_matches(prompt_text, '(?i)<<<[^<>\\r\\n]{1,150}>>>|<(?:Picture|Subject|Video|Audio)\\s+\\d+>|(?:^|[^0-9A-Za-z_@])@[A-Za-z][A-Za-z0-9_.-]*') AS syntax_removed FROM p WHERE prompt_text IS NOT NULL"))
def transferability(spark: SparkSession, d: str) -> DataFrame:
    t = _texts(spark, d)
    return U.transferability(t, "prompt_sha256", "prompt_text", t.where(F.contains("prompt_text", F.lit("�"))))


@q("SELECT CAST(NULL AS VARCHAR) AS prompt_sha256, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS INTEGER) AS evidence_ordinal WHERE false")
def unlinked_decisions(spark: SparkSession, d: str) -> DataFrame:
    fields = materialize(_fields(spark, d), "fields")
    evidence = U.field_evidence(fields, _texts(spark, d), "prompt_sha256", "prompt_text")
    decisions = U.field_decisions(fields, "prompt_sha256").select("prompt_sha256", "field", F.lit(0).alias("evidence_ordinal"))
    return C.unlinked_decisions(decisions, evidence, "prompt_sha256").select("prompt_sha256", "field", "evidence_ordinal")


@q(V.sql("""SELECT coalesce(processing_status, '<null>') AS status, coalesce(r, '<none>') AS code, count(*) AS rows, count(*) FILTER (failure_code IS NOT NULL) AS failed FROM (
 SELECT processing_status, failure_code, unnest(CASE WHEN len(x) > 0 THEN x ELSE ['<none>'] END) AS r FROM (SELECT DISTINCT prompt_sha256, processing_status, failure_code, coalesce(TRY_CAST(from_json(CASE WHEN json_valid(queue_reasons_json) THEN queue_reasons_json ELSE '[]' END, '["VARCHAR"]') AS VARCHAR[]), []) AS x FROM s)) GROUP BY 1, 2"""))
def issue_register(spark: SparkSession, d: str) -> DataFrame:
    codes = F.coalesce(F.try_variant_get(F.try_parse_json("queue_reasons_json"), "$", "array<string>"), F.array().cast("array<string>"))
    s = V.strata_rows(spark, d).select("prompt_sha256", F.coalesce("processing_status", F.lit("<null>")).alias("status"), codes.alias("codes"), F.col("failure_code").isNotNull().alias("failed")).distinct()
    return C.issue_register(s, "status", "codes", "failed")


@q(V.sql("""SELECT folder_id AS target, array_to_string(list_sort(list_filter(['video', 'image'], lambda x: NOT list_contains(t, x))), ',') AS missing FROM (SELECT folder_id, coalesce(list(DISTINCT asset_type) FILTER (asset_type IS NOT NULL), []) AS t FROM a GROUP BY 1)
WHERE NOT (list_contains(t, 'video') AND list_contains(t, 'image'))"""))
def signal_coverage(spark: SparkSession, d: str) -> DataFrame:
    a = V.assets(spark, d, "folder_id", "asset_type").select(F.col("folder_id").alias("target"), F.array("asset_type").alias("s"))
    return C.signal_coverage(a, "target", "s", ["video", "image"]).select("target", F.array_join("missing", ",").alias("missing"))


@q()
def quality_audit(spark: SparkSession, d: str) -> DataFrame:
    """Families of checks on what was derived from each prompt, evaluated, passed and failed."""
    f = X.written_facts(spark, d)
    s = materialize(X.structure_of(spark, d, f), "structure")
    fields, p = materialize(_fields(spark, d), "fields"), V.prompts(spark, d)
    evidence = materialize(U.field_evidence(fields, _texts(spark, d), "prompt_sha256", "prompt_text"), "evidence")
    bad = C.evidence_faults(evidence, _texts(spark, d), "prompt_sha256", "prompt_text").select("prompt_sha256").distinct().withColumn("_bad", F.lit(True))
    tail = evidence.groupBy("prompt_sha256").agg(F.max("end").alias("_end"))
    neutral = fields.groupBy("prompt_sha256").agg(F.bool_or(F.exists("segments", lambda x: x["text"].rlike(T.SYNTAX) | F.contains(x["text"], F.lit("<<<")))).alias("_syntax"))
    text = p.select("prompt_sha256", F.length("prompt_text").alias("_n"), "analysis_prompt_chars", (F.sha2("prompt_text", 256) == F.col("prompt_sha256")).alias("_hash"), (F.col("url_redaction_count") > 0).alias("_red"))
    tags = V.strata(spark, d, "text_length_band")
    j = text.join(s.select("prompt_sha256", F.lit(True).alias("_s")), "prompt_sha256", "left").join(bad, "prompt_sha256", "left").join(tail, "prompt_sha256", "left").join(neutral, "prompt_sha256", "left").join(tags, "prompt_sha256", "left")
    rows = C.checked(
        j, "prompt_sha256", source_length=F.col("_n") == F.col("analysis_prompt_chars"), source_hash=F.col("_hash") | F.col("_red"), structure_present=F.col("_s"), evidence_ranges_and_hashes=F.col("_bad").isNull(),
        model_syntax_isolation=~F.coalesce("_syntax", F.lit(False)), long_prompt_tail_coverage=(F.col("_n") <= 12_000) | (F.col("_end") == F.col("_n")), stratum_present=F.col("text_length_band").isNotNull(), stratum_alignment=F.col("text_length_band") == N.length_band("_n"),
    )
    return C.check_counters(rows)
