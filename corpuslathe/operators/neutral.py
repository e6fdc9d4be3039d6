"""From texts to neutral fields: the segments that speak of a field, spread over the text, with evidence for what was kept and a decision for each field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslathe.functions import numbers as N
from corpuslathe.functions import text as T

#: Per field the most segments kept, the words that speak of it, and whether longer words that begin with them do too.
FIELDS = {
    "objective": (2, "objective|goal|purpose|narrative\\s+summary|scene\\s+context|establish|show|stage|connect|edit|transform|presents?|holds?", False),
    "spatial_relations": (12, "screen[- ]?left|screen[- ]?right|left|right|front|behind|near|center|west|east|north|south|above|below|across|between|inside|outside|toward|away|diagonal|ground floor|side of|height|distance", False),
    "action_summary": (14, "fight|fighting|attack|strike|punch|kick|dodge|block|parry|grab|throw|slam|chase|run|walk|jump|fall|rise|turn|look|glide|cross|move|hold|rain|connect|edit|transform|shoot|says?|speaks?|react|reaction|deliver|stands?|standing|appears?|clears?|threads?|crawls?", True),
    "performance_dialogue_reaction": (10, "performance|perform|reaction|reacts?|expression|emotion|gaze|eye contact|looks?|listens?|speaks?|says?|whispers?|shouts?|breathes?|hesitates?|smirk|blink|eyebrow|delivery|register|tone|voice|grin", True),
    "camera_result": (10, "camera|lens|framing|shot|close[- ]?up|wide|angle|viewpoint|handheld|locked|stabilized|gimbal|zoom|drift|dolly|pan|tilt|focus|depth of field|reframe|parallax|shutter|focal", True),
    "lighting": (10, "light|lighting|lit|illumination|sconce|amber|sodium|daylight|night|black sky|shadow|backlit|edge-lit|practical|haze|glow|neon|exposure|contrast|palette", True),
    "sound": (10, "audio|sound|sfx|music|dialogue|voice|rumble|traffic|rain|thunder|hum|breath|rustle|creak|noise|ambience|ambient|mechanical", True),
    "physics": (12, "force|momentum|gravity|friction|impact|fall|speed|steady|weight|mass|height|rail|road|wind|rain|motion|parallax|damage|intact|floor|collision|pressure|direction", True),
    "continuity": (16, "throughout|remain|remains|always|never|fixed|consistent|same|one character|one train|one continuous|no cuts|no change|persist|returns|normal speed|slow motion", True),
    "constraints": (20, "no|not|never|do not|must|only|without|exclude|excluded|avoid|prohibit|keep|lock|hard lock|negative", True),
}
#: Roles of references, by parts of the role an extractor proposed, then by words of the description; and words that join causes and times.
_ROLE_PARTS = [("character_transformation", ["transform"]), ("character_identity", ["character", "person"]), ("environment", ["environment", "location"]), ("prop", ["prop", "object"]), ("style", ["style"])]
_ROLE_WORDS = [("character_identity", "man|woman|person|character|fighter|demon|creature|human|face|body"), ("prop", "weapon|sword|gun|prop|object|vehicle")]
_SUBJECT_ROLES = ["character_identity", "character_transformation", "prop"]
_CAUSAL = r"(?iU)\b(?:after|before|because|therefore|so|then|until|while|when|as)\b"
_IMPLICIT = r"(?iU)\b(?:reference\s+image|uploaded\s+image)\b"


def field_candidates(segments: Column, words: str, most: int, stems: bool = True) -> tuple[Column, Column]:
    """(kept segments (text, start, end, folded), whether some were left out): those with one of the words, each text once, at most `most` spread from first to last."""
    end = r"\w*\b" if stems else r"\b"
    hit = F.filter(segments, lambda s: s["text"].rlike(rf"(?iU)\b(?:{words}){end}"))
    first = lambda h: F.filter(h["a"], lambda s, i: F.array_position(h["folded"], s["folded"]) == i + 1)
    once = T.let(first, a=hit, folded=F.transform(hit, lambda s: s["folded"]))
    return N.spread(once, most), F.size(once) > most


def neutral_fields(texts: DataFrame, key: str, text: str, fields: dict[str, tuple[int, str, bool]] = FIELDS) -> DataFrame:
    """(key, field, segments, compressed): per text and field what was kept (text, start, end), in order of the text. Null texts have no rows."""
    seg = texts.where(F.col(text).isNotNull()).select(key, F.explode(F.array(F.struct(T.segments(text).alias("s")))).alias("x"))
    fold = lambda s: F.struct(s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end"), T.fold(s["text"]).alias("folded"))
    seg = seg.select(key, F.explode(F.array(F.struct(F.transform("x.s", fold).alias("s")))).alias("x")).select(key, "x.s")  # once for all fields
    per = []
    for name, (most, words, stems) in fields.items():
        kept, more = field_candidates(F.col("s"), words, most, stems)
        kept = F.transform(kept, lambda s: s.dropFields("folded"))
        per.append(F.struct(F.lit(name).alias("field"), kept.alias("segments"), more.alias("compressed")))
    return seg.select(key, F.explode(F.array(*per)).alias("f")).select(key, "f.field", "f.segments", "f.compressed")


def field_evidence(fields: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, field, ordinal, start, end, sha256, preview) of every kept segment; a field without any has one row over the whole text."""
    j = fields.join(texts.select(key, F.col(text).alias("_t")), key)
    whole = F.array(F.struct(F.lit("").alias("text"), F.lit(0).alias("start"), F.length("_t").alias("end")))
    rows = j.select(key, "field", "_t", F.posexplode(F.when(F.size("segments") > 0, F.col("segments")).otherwise(whole)).alias("ordinal", "s"))
    piece = T.slice_of("_t", F.col("s.start"), F.col("s.end"))
    return rows.select(key, "field", "ordinal", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.sha2(piece, 256).alias("sha256"), T.clip(piece, 240).alias("preview"))


def field_decisions(fields: DataFrame, key: str) -> DataFrame:
    """(key, field, decision, kept): kept, compressed (more than fits) or missing."""
    n = F.size("segments")
    return fields.select(key, "field", F.when(n == 0, "missing").when(F.col("compressed"), "compressed").otherwise("kept").alias("decision"), n.alias("kept"))


def shared_only_fields(fields: DataFrame, key: str) -> DataFrame:
    """(key, field): fields with something, all of which other fields of the text hold too.

    Distinct raw values of a field count once; values compare trimmed.
    """
    v = fields.select(key, "field", F.explode(F.transform("segments", lambda s: s["text"])).alias("raw")).distinct()
    v = v.withColumn("value", T.strip("raw"))
    n = v.groupBy(key, "value").agg(F.count("*").alias("n"))
    return v.join(n, [key, "value"]).groupBy(key, "field").agg(F.bool_and(F.col("n") > 1).alias("shared")).where("shared").select(key, "field")


def presence(fields: DataFrame, key: str) -> DataFrame:
    """(key, present, total): how many fields of a text have something, and how many segments they have."""
    n = F.size("segments")
    return fields.groupBy(key).agg(F.count_if(n > 0).alias("present"), F.sum(n).alias("total"))


def dialogue_lines(facts: DataFrame, key: str) -> DataFrame:
    """(key, ordinal, speaker, line, rejected): utterances without reference labels; too short ones, single sounds and lines with labels in them are rejected, with the reason."""
    d = facts.where("kind = 'dialogue'").select(key, "ordinal", safe_speaker(F.get_json_object("value", "$.speaker")).alias("speaker"), F.get_json_object("value", "$.line").alias("line"))
    label = F.col("line").rlike(r"<<<|>>>|(?i)<(?:Picture|Subject|Video|Audio)\s+\d+>|(?<![\w@])@[A-Za-z]")
    return d.withColumn("rejected", F.when(F.length(T.strip("line")) < 2, "too_short").when(F.lower(T.strip("line")).isin("k", "ng", "m"), "sound").when(label, "label_inside"))


def strata_evidence(texts: DataFrame, facts: DataFrame, key: str, text: str, dimensions: dict[str, list[str]]) -> DataFrame:
    """(key, dimension, kind, start, end, sha256): per dimension the first three facts of its kinds, else the whole text."""
    from corpuslathe.operators.relational import top_per_group

    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.array(*(F.lit(k) for k in ks)).alias("kinds")) for d, ks in dimensions.items()))
    f = facts.select(key, "kind", "start", "end", "sha256", "ordinal", F.explode(pairs).alias("p")).where(F.array_contains("p.kinds", F.col("kind"))).select(key, "p.dimension", "kind", "start", "end", "sha256", "ordinal")
    some = top_per_group(f, [key, "dimension"], 3, F.col("ordinal")).select(key, "dimension", "kind", "start", "end", "sha256")
    # length and hash in place of the text, before it is repeated for each dimension
    every = texts.select(key, F.length(text).alias("end"), F.sha2(text, 256).alias("sha256"), F.explode(F.array(*(F.lit(d) for d in dimensions))).alias("dimension"))
    rest = every.join(some.select(key, "dimension").distinct(), [key, "dimension"], "left_anti").select(key, "dimension", F.lit("full_scan").alias("kind"), F.lit(0).alias("start"), "end", "sha256")
    return some.unionByName(rest)


def reference_role(candidate: Column | str, description: Column | str) -> Column:
    """The role of a reference: by what the proposed role contains, else by words of the description, else environment."""
    c, d = F.lower(F.coalesce(T.col(candidate), F.lit(""))), T.col(description)
    has = lambda parts: c.rlike("|".join(parts))
    return F.coalesce(*(F.when(has(parts), F.lit(role)) for role, parts in _ROLE_PARTS), *(F.when(d.rlike(rf"(?iU)\b(?:{words})\b"), F.lit(role)) for role, words in _ROLE_WORDS), F.lit("environment"))


def reference_description(raw: Column | str, label: Column | str) -> Column:
    """What a reference block says of its label: the block without its first label, the separator after it and syntax, at most 700 characters."""
    r, x = T.col(raw), T.col(label)
    at = F.when(F.coalesce(F.length(x), F.lit(0)) > 0, F.instr(r, x)).otherwise(F.lit(0))
    body = F.when(at > 0, F.concat(F.substring(r, F.lit(1), at - 1), F.lit(" "), F.substring(r, at + F.length(x), F.length(r)))).otherwise(r)
    return T.clip(T.clean_syntax(F.regexp_replace(body, r"^(?U)\s*(?:[-\u2014:=]|\[[^\]]+\])\s*", "")), 700)


def safe_speaker(value: Column | str) -> Column:
    """A speaker's name in lower case without reference syntax; null where nothing is left."""
    return F.nullif(F.lower(T.clean_syntax(value)), F.lit(""))


def causal_link(segment: Column | str) -> Column:
    """What joins a beat to those before it."""
    return F.when(T.col(segment).rlike(_CAUSAL), "explicit temporal or causal connector in source segment").otherwise("source order only; no explicit causal connector extracted")


def beats(fields: DataFrame, key: str) -> DataFrame:
    """(key, order, summary, causal_link): the action segments of each text in their order, from 1."""
    b = fields.where("field = 'action_summary'").select(key, F.posexplode("segments").alias("i", "s"))
    return b.select(key, (F.col("i") + 1).alias("order"), F.col("s.text").alias("summary"), causal_link(F.col("s.text")).alias("causal_link"))


def references(texts: DataFrame, facts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ordinal, reference_id, source_label, role, description, is_subject): material references of each text.

    One for each reference block with a description, the first of a label; a text without any that speaks of a reference or uploaded image has one implicit reference.
    """
    blocks = facts.where("kind = 'reference_block'").select(key, "ordinal", "start", "end", F.get_json_object("value", "$.label").alias("source_label"), F.get_json_object("value", "$.role_candidate").alias("_role"))
    per = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ordinal", "start", "end", "source_label", "_role"))).alias("_b"))
    implicit = F.regexp_extract(text, _IMPLICIT, 0)
    j = texts.select(key, text).join(per, key, "left")

    def made(x: Column) -> Column:
        d = reference_description(T.slice_of(text, x["start"], x["end"]), x["source_label"])
        return F.struct(F.concat(F.lit("ref-"), F.substring(F.sha2(F.coalesce(x["source_label"], d), 256), 1, 12)).alias("reference_id"), x["source_label"].alias("source_label"), reference_role(x["_role"], d).alias("role"), d.alias("description"))

    full = F.filter(F.transform(F.col("_b"), made), lambda r: F.length(r["description"]) > 0)
    once = T.let(lambda b: F.filter(b["a"], lambda r, i: F.array_position(b["ids"], r["reference_id"]) == i + 1), a=full, ids=F.transform(full, lambda r: r["reference_id"]))
    alone = F.array(F.struct(F.concat(F.lit("ref-implicit-"), F.substring(F.sha2(F.lower(implicit), 256), 1, 8)).alias("reference_id"), F.lit(None).cast("string").alias("source_label"), F.lit("environment").alias("role"), F.lit("Implicit image reference described in the Prompt; exact pixels are unavailable.").alias("description")))
    got = F.when(F.coalesce(F.size(once), F.lit(0)) > 0, once).when(implicit != "", alone)
    rows = j.select(key, F.posexplode(got).alias("ordinal", "r"))
    return rows.select(key, "ordinal", "r.reference_id", "r.source_label", "r.role", "r.description", F.col("r.role").isin(_SUBJECT_ROLES).alias("is_subject"))


def missing_fields(fields: DataFrame, refs: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """(key, field): fields of which a text says nothing; subjects too, unless its scene tags (key, scene_tags) say that it establishes an environment."""
    subjects = refs.where("is_subject").select(key).distinct().withColumn("_has", F.lit(True))
    every = fields.select(key).distinct().join(subjects, key, "left").join(tags, key, "left")
    no_subject = every.where(F.col("_has").isNull() & ~F.coalesce(F.array_contains("scene_tags", "environment_establishing"), F.lit(False))).select(key, F.lit("subjects").alias("field"))
    return fields.where(F.size("segments") == 0).select(key, "field").unionByName(no_subject)


def source_conflicts(struct: DataFrame, issue_rows: DataFrame, key: str) -> DataFrame:
    """(key, field, observed, status, selected_value): what a text and its metadata, or its own statements, say against each other; none is ever resolved here."""
    none = F.lit(None).cast("string")
    obs = N.duration_observation("declared_durations", "metadata_durations")
    durations = struct.where(obs["provenance"] == "unresolved_conflict").select(key, F.lit("duration").alias("field"), F.to_json(F.struct("declared_durations", "metadata_durations")).alias("observed"))
    takes = issue_rows.where("code = 'take_structure_conflict'").select(key, F.lit("take_structure").alias("field"), F.lit('["conflicted"]').alias("observed")).distinct()
    return durations.unionByName(takes).select("*", F.lit("unresolved").alias("status"), none.alias("selected_value"))


def uncertainty(missing: DataFrame, issue_rows: DataFrame, dialogue: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """(key, kind, detail): what stays open about a text: missing fields, its issues, lines without a speaker, rejected lines, references without media."""
    parts = [
        missing.select(key, F.lit("missing_field").alias("kind"), F.col("field").alias("detail")),
        issue_rows.select(key, F.lit("processing_issue").alias("kind"), F.col("code").alias("detail")),
        dialogue.where("rejected is null and speaker is null").select(key, F.lit("dialogue_speaker").alias("kind"), F.lit("").alias("detail")),
        dialogue.where("rejected = 'label_inside'").select(key, F.lit("dialogue_candidate_rejected").alias("kind"), F.col("ordinal").cast("string").alias("detail")),
        refs.select(key, F.lit("media_binding").alias("kind"), F.lit("").alias("detail")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def transferability(texts: DataFrame, key: str, text: str, blocked: DataFrame) -> DataFrame:
    """(key, status, media_binding, syntax_removed): whether a text's neutral fields can go to any adapter; those in `blocked` (key) must be looked at first."""
    b = blocked.select(key).distinct().withColumn("_b", F.lit(True))
    j = texts.select(key, F.col(text).rlike(T.SYNTAX).alias("syntax_removed")).join(b, key, "left")
    return j.select(key, F.when(F.col("_b").isNotNull(), "blocked_needs_manual_review").otherwise("portable_scene_intent").alias("status"), F.lit("none").alias("media_binding"), "syntax_removed")


def failure_records(failures: DataFrame, key: str, fields: dict = FIELDS) -> DataFrame:  # type: ignore[type-arg]
    """(key, status, reason, missing): the explicit record of a text that couldn't be processed: all its fields are missing, and someone must look at it."""
    names = sorted([*fields, "subjects"])
    return failures.select(key, F.lit("needs_manual_review").alias("status"), F.concat(F.lit("normalizer exception "), "reason").alias("reason"), F.array(*(F.lit(n) for n in names)).alias("missing"))
