"""Facts with evidence from prompt texts: settings, references, shots, times, dialogue, languages, sound.

All rules are column expressions over the text; what they find is one array a text, exploded at the end. Apply them to
distinct texts (`distinct_texts`), join the result back by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslathe.functions import text as T
from corpuslathe.functions.numbers import decimal_comma, duration_state, durations_disjoint, length_band, marker_band, reference_band
from corpuslathe.runtime import materialize

#: The patterns of the prompt format.
_UNIT = r"(?:s\b|secs?\b|seconds?\b|秒\b|сек(?:унд[аы]?)?\b)"
LABELED_DURATION = r"(?iU)\b(?:total\s+)?duration\s*(?::|=|-)?\s*([~≈])?(\d+(?:[.,]\d+)?)\s*" + _UNIT
DURATION = r"(?iU)(?<![\w.])([~≈])?(\d+(?:[.,]\d+)?)\s*" + _UNIT
SETTINGS_LINE = r"(?iU)(?:16\s*:\s*9|2\.3\d\s*:\s*1|\b(?:SFX|Photoreal|NON-IP|Cinematic|Output|Settings)\b)"
LABELED_ASPECT = r"(?iU)\b(?:aspect(?:\s+ratio)?|ratio)\s*(?::|=|-)?\s*(\d+(?:\.\d+)?\s*:\s*\d+(?:\.\d+)?)"
ASPECT = r"(?U)(?<![\d:])(\d{1,2}(?:\.\d+)?)\s*:\s*(\d{1,2}(?:\.\d+)?)(?![\d:])"
ASPECT_LINE = r"(?iU)(?:aspect|ratio|cinemascope|anamorphic|letterbox|output|16\s*:\s*9|2\.3\d\s*:\s*1)"
OPTICAL = r"(?i)cinemascope|anamorphic|letterbox"
MODE_LABEL = r"(?iU)\b(?:mode|prompt\s+mode|generation\s+mode)\s*[:=]\s*([^,.;\n]+)"
MODE = r"(?iU)\b(?:R2V|T2V|I2V|T2VA|I2VA|FL2VA|L2VA|Ref2VA)\b"
MODE_WORDS = r"(?iU)\b(?:image-to-video|text-to-video|reference-to-video)\b"
MODEL_LABEL = r"(?iU)\bmodel\s*[:=]\s*([^,.;\n]+)"
TRIPLE = r"<<<([^<>\r\n]{1,150})>>>"
AT_TAG = r"(?U)(?<![\w@])@([A-Za-z][A-Za-z0-9_.-]*[A-Za-z0-9_])\b"
MEDIA_TAG = r"(?iU)<(Picture|Subject|Video|Audio)\s+(\d+)>"
DEFINITION = r"(?dm)^[ \t]*(<<<[^<>\r\n]{1,150}>>>|@[A-Za-z][A-Za-z0-9_.-]*[A-Za-z0-9_]*)[ \t]*(?:[-–—:=]|\[)"
MARKER = r"(?iU)(?:^|(?<=[.;]))[ \t]*(?:[-*]\s*)?(?:\[\s*)?((?:SMASH|HARD|MATCH)\s+CUT|CUT(?:\s+TO)?|SHOT|BEAT|BLOCK|SEGMENT|PHASE|ACT|镜头|场景|СЦЕНА|КАДР)\b"
RULE_LINE = r"(?U)^[=\-_*─━│\s]{3,}$"
HEADING = r"(?U)^#{1,6}\s+|^\[[^\]\r\n]{2,80}\]$"
CAPITALS = r"^[A-Z][A-Z0-9 /&+_()\-]{2,90}:?$"
HEADING_NAMES = ["REFERENCES", "ACTIVE REFERENCES", "DIALOGUE", "AUDIO", "SOUND", "SFX", "LIGHTING", "STYLE", "HARD LOCKS", "OUTPUT SETTINGS", "CAMERA"]
TIMECODE = r"(?U)(?<![\d:])(?:(?:[01]?\d|2[0-3]):)?(?:[0-5]?\d):[0-5]\d(?:\.\d{1,3})?(?![\d:])"
RANGE = r"(?iU)(?<![\w.])(?:\d+(?:\.\d+)?(?:s|秒)\s*(?:[-–—]|to)\s*\d+(?:\.\d+)?(?:s|秒)?|\d+(?:\.\d+)?\s*(?:[-–—]|to)\s*\d+(?:\.\d+)?(?:s|秒))\b"
POINT = r"(?iU)\b(?:at|t\s*=)\s*[~≈]?\d+(?:\.\d+)?\s*s\b"
SINGLE = r"(?iU)\b(?:single(?:[- ]continuous)?(?:[- ](?:shot|take))?|one continuous (?:shot|take)|single uninterrupted shot|no cuts?)\b"
MULTI = r"(?iU)\b(?:multi[- ]shot|multiple shots?|montage|sequence of \d+ shots?|\d+ cuts?)\b"
DIALOGUE_BLOCK = r"(?isU)<d>\s*\[([^\]\r\n]+)\](.*?)</d>"
QUOTES = [r'"([^"\r\n]{1,500})"', "“([^”\\r\\n]{1,500})”", "«([^»\\r\\n]{1,500})»", "「([^」\\r\\n]{1,500})」"]
SPEECH = r"(?iU)\b(?:dialogue|spoken\s+line|says?|speaks?|shouts?|whispers?|asks?|replies?|murmurs?|delivers?|voice|lip[- ]sync)\b|对白|台词"
SPEAKER = r"(?dm)^[ \t]*([A-Z][A-Za-z0-9_<>-]{1,80})(?:\s*\([^\n)]{1,80}\))?\s*:\s*$"
NO_SPEAKER = ["DIALOGUE", "AUDIO", "SOUND", "SFX", "VOICE"]
LANGUAGE = r"(?iU)\b(?:in|speaks?|spoken|language)\s+(?:Japanese|English|Chinese|Russian|Korean|Spanish|French)\b|日语|英语|中文"
LANGUAGE_NAME = r"(?iU)(Japanese|English|Chinese|Russian|Korean|Spanish|French|日语|英语|中文)$"
AUDIO = {
    "negative_music": r"(?iU)\bno\s+(?:music|score)\b",
    "negative_voiceover": r"(?iU)\bno\s+(?:voiceover|voice[- ]over)\b",
    "negative_subtitles": r"(?iU)\bno\s+subtitles?\b",
    "sfx_only": r"(?iU)\bSFX\s+only\b",
    "silence": r"(?iU)\b(?:complete|near|total)\s+silence\b|\bsilent\b",
    "audio_heading": r"(?idm)^[ \t]*(?:AUDIO|SOUND|SFX|SOUNDSCAPE|MUSIC)\s*:",
}
ROLES = {
    "character": r"(?iU)\b(?:character|person|man|woman|boy|girl|male|female|actor|monster|subject)\b",
    "environment": r"(?iU)\b(?:environment|location|arena|room|hall|city|street|interior|exterior|landscape|building)\b",
    "prop": r"(?iU)\b(?:prop|weapon|sword|katana|gun|shield|object|vehicle|train)\b",
}
SETTING_KEYS = {"duration": "declared_duration", "aspect_ratio": "declared_aspect_ratio", "aspect": "declared_aspect_ratio", "model": "declared_model", "mode": "generation_mode"}
SCENES = {
    "action_interaction": r"(?iU)\b(?:fight|fighting|combat|battle|punch|kick|strike|dodge|block|parry|grab|throw|slam|chase|run|sprint|jump|fall|impact|collision|crash|explode|explosion|shoot|sword|weapon)\w*\b",
    "character_performance": r"(?iU)\b(?:perform|acting|reaction|reacts?|expression|emotion|gaze|eye contact|looks? at|listens?|speaks?|says?|whispers?|shouts?|breathes?|hesitates?|subtext|gesture|posture)\w*\b",
    "environment_establishing": r"(?iU)\b(?:environment|establishing|location|interior|exterior|city|street|alley|road|room|warehouse|station|forest|mountain|ocean|beach|desert|village|building|landscape|skyline|aerial|drone|weather|rain|snow|storm|traffic|train|background)\w*\b",
}

FACT = "struct<kind:string,subtype:string,start:int,end:int,value:string,rule:string,confidence:string,rank:int>"


def distinct_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per key: texts are the same where their hash is."""
    return df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).groupBy(key).agg(F.min(text).alias(text))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in sorted(fields.items()))), {"ignoreNullFields": "false"})


def _fact(s: Column, kind: Column | str, subtype: Column | str, value: Column, rule: str, confidence: str, rank: int) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(kind).alias("kind"), lit(subtype).alias("subtype"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), value.cast("string").alias("value"), F.lit(rule).alias("rule"), F.lit(confidence).alias("confidence"), F.lit(rank).alias("rank"))


def _none() -> Column:
    return F.array().cast(f"array<{FACT}>")


def _each(c: Column, pattern: str, kind: str, subtype: str, value, rule: str, confidence: str, rank: int) -> Column:  # noqa: ANN001
    return F.transform(T.spans(c, pattern), lambda s: _fact(s, kind, subtype, value(s["match"]), rule, confidence, rank))


def _seconds(pattern: str):  # noqa: ANN202
    return lambda m: _json(seconds=decimal_comma(F.regexp_extract(m, pattern, 2)), approximate=F.regexp_extract(m, pattern, 1) != "")


def _group(pattern: str, i: int = 1):  # noqa: ANN202
    return lambda m: T.strip(F.regexp_extract(m, pattern, i))


def _in_lines(c: Column, condition: str, pattern: str, make) -> Column:  # noqa: ANN001
    """Facts of a pattern within lines that meet a condition, placed in the whole text; make(span, line)."""
    rows = F.filter(T.lines(c), lambda x: x["line"].rlike(condition))
    place = lambda s, x: F.struct((s["start"] + x["start"]).alias("start"), (s["end"] + x["start"]).alias("end"), s["match"].alias("match"))
    return F.flatten(F.transform(rows, lambda x: F.transform(T.spans(x["line"], pattern), lambda s: make(place(s, x), x["line"]))))


def _role(block: Column) -> Column:
    n = sum((block.rlike(p).cast("int") for p in ROLES.values()), F.lit(0))
    return F.when(n == 1, F.coalesce(*(F.when(block.rlike(p), F.lit(k)) for k, p in ROLES.items())))


def _maker(kind: str, subtype: str, value: Column, rule: str):  # noqa: ANN202
    return lambda s: _fact(s, kind, subtype, value, rule, "high", 1)


def _settings(c: Column) -> Column:
    """Settings of a text that is a JSON object."""
    body = T.strip(c)
    doc = F.when(body.startswith("{") & body.endswith("}"), F.try_parse_json(body))
    out = []
    for k, kind in SETTING_KEYS.items():
        pattern = _setting(k)
        raw = F.try_variant_get(doc, f"$.{k}", "string")
        number = F.try_variant_get(doc, f"$.{k}", "double")
        first = F.slice(T.spans(c, pattern), F.lit(1), F.lit(1))
        quoted = F.regexp_extract(F.get(first, F.lit(0))["match"], r":\s*(\"?)", 1) == '"'
        if kind == "declared_duration":
            value, sub, ok = _json(seconds=number, approximate=F.lit(False)), "json", number.isNotNull() & ~quoted
        elif kind == "declared_aspect_ratio":
            value, sub, ok = F.regexp_replace(raw, r"(?U)\s+", ""), "output", raw.isNotNull() & quoted
        else:
            value, sub, ok = raw, "json", raw.isNotNull() & (quoted | ~raw.isin("true", "false"))
        out.append(F.when(ok, F.transform(first, _maker(kind, sub, value, f"json.{k}"))).otherwise(_none()))
    return F.when(doc.isNotNull(), F.concat(*out)).otherwise(_none())


def _definitions(c: Column) -> Column:
    """Reference blocks: from a definition to the next one or a blank line."""
    return T.let(lambda b: _blocks(c, b["defs"]), defs=T.spans(c, DEFINITION))


def _blocks(c: Column, defs: Column) -> Column:
    def block(d: Column, i: Column) -> Column:
        after = F.substring(c, d["end"] + 1, F.length(c))
        blank = F.when(after.rlike(r"(?U)\n\s*\n"), d["end"] + F.length(F.get(F.split(after, r"(?U)\n\s*\n", 2), F.lit(0))))
        end = F.greatest(d["end"], F.least(F.length(c), F.get(defs, i + 1)["start"], blank))
        return F.struct(d["start"].alias("start"), end.alias("end"), T.strip(F.regexp_extract(d["match"], DEFINITION, 1)).alias("label"), _role(T.slice_of(c, d["start"], end)).alias("role"))

    return T.let(lambda b: _block_facts(b["blocks"]), blocks=F.transform(defs, block))


def _block_facts(blocks: Column) -> Column:
    named = F.transform(blocks, lambda b: _fact(b, "reference_block", "definition", _json(label=b["label"], role_candidate=b["role"]), "reference.block", "medium", 9))
    roles = F.transform(F.filter(blocks, lambda b: b["role"].isNotNull()), lambda b: _fact(b, "entity_reference_span", b["role"], _json(label=b["label"], role=b["role"]), "entity.role", "medium", 9))
    return F.concat(named, roles)


def _line_facts(c: Column) -> Column:
    """Shot and cut markers; headings of lines without any."""
    rows = F.filter(T.lines(c), lambda x: (F.length(T.strip(x["line"])) > 0) & ~T.strip(x["line"]).rlike(RULE_LINE))

    def of(x: Column) -> Column:
        line = T.strip(x["line"])
        found = T.spans(x["line"], MARKER)

        def marker(s: Column) -> Column:
            kind = F.regexp_replace(F.lower(T.strip(F.regexp_extract(s["match"], MARKER, 1))), r"(?U)\s+", "_")
            at = F.struct((s["start"] + x["start"]).alias("start"), (s["end"] + x["start"]).alias("end"))
            return _fact(at, F.when(F.contains(kind, F.lit("cut")), "cut_marker").otherwise("shot_marker"), kind, T.strip(s["match"]), "shot-line", "high", 10)

        heading = line.rlike(HEADING) | (line.rlike(CAPITALS) & ~line.rlike(r"(?U)\b(?:CUT|SHOT)\b")) | F.upper(F.rtrim(line, F.lit(":"))).isin(HEADING_NAMES)
        at = F.struct(x["start"].alias("start"), (x["start"] + F.length(x["line"])).alias("end"))
        return F.when(F.size(found) > 0, F.transform(found, marker)).when(heading, F.array(_fact(at, "heading", "section", line, "heading.line", "medium", 10))).otherwise(_none())

    return F.flatten(F.transform(rows, of))


def _dialogue(c: Column) -> Column:
    """Marked dialogue, and quotations where the text around speaks of speech or a speaker's label comes before."""
    blocks = _each(c, DIALOGUE_BLOCK, "dialogue", "h3_block", lambda m: _json(speaker=F.nullif(T.strip(F.regexp_extract(m, DIALOGUE_BLOCK, 1)), F.lit("")), line=T.collapse(F.regexp_extract(m, DIALOGUE_BLOCK, 2))), "dialogue.block", "high", 14)
    return F.concat(blocks, *(_quotations(c, q) for q in QUOTES))


def _quotations(c: Column, q: str) -> Column:
    def quoted(s: Column) -> Column:
        before = T.slice_of(c, F.greatest(s["start"] - 220, F.lit(0)), s["start"])
        speaker = F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(before, F.lit(SPEAKER), F.lit(1))), -1)
        speaker = F.when(~speaker.isin(NO_SPEAKER), speaker)
        near = T.slice_of(c, F.greatest(s["start"] - 180, F.lit(0)), s["end"] + 80)
        value = _json(speaker=speaker, line=T.strip(F.regexp_extract(s["match"], q, 1)))
        return F.struct(_fact(s, "dialogue", "quoted_line", value, "dialogue.quote-context", "medium", 15).alias("f"), (near.rlike(SPEECH) | speaker.isNotNull()).alias("ok"))

    return F.transform(F.filter(F.transform(T.spans(c, q), quoted), lambda x: x["ok"]), lambda x: x["f"])


def facts_of(c: Column) -> Column:
    """Array of the facts of a text, in the order of the rules; a rule is tried only where a piece of text it can't do without is there."""
    return T.let(lambda b: _rules(c, b["low"]), low=F.lower(c))


def _rules(c: Column, low: Column) -> Column:
    def needing(words: list[str], facts: Column) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | F.contains(low, F.lit(w))
        return F.when(found, facts).otherwise(_none())

    labeled = F.concat(needing(["{"], _settings(c)), needing(["duration"], _each(c, LABELED_DURATION, "declared_duration", "prompt_label", _seconds(LABELED_DURATION), "duration.labeled", "high", 2)))
    on_lines = _in_lines(c, SETTINGS_LINE, DURATION, lambda s, _: _fact(s, "declared_duration", "settings_line", _seconds(DURATION)(s["match"]), "duration.settings-line", "medium", 3))
    on_lines = T.let(lambda b: F.filter(b["on_lines"], lambda f: ~F.exists(b["labeled"], lambda g: (g["kind"] == "declared_duration") & (f["start"] < g["end"]) & (f["end"] > g["start"]))), on_lines=on_lines, labeled=labeled)
    aspects = _in_lines(c, ASPECT_LINE, ASPECT, lambda s, line: _fact(s, "declared_aspect_ratio", F.when(line.rlike(OPTICAL), "optical").otherwise("output"), F.concat(F.regexp_extract(s["match"], ASPECT, 1), F.lit(":"), F.regexp_extract(s["match"], ASPECT, 2)), "aspect.context", "medium", 5))
    audio = {n: _each(c, p, "audio", n, lambda m, n=n: _json(signal=m, polarity=F.lit("negative" if n.startswith("negative") else "positive")), "audio.signal", "medium", 17) for n, p in AUDIO.items()}
    needs = {"negative_music": ["music", "score"], "negative_voiceover": ["voice"], "negative_subtitles": ["subtitle"], "sfx_only": ["sfx"], "silence": ["silen"], "audio_heading": ["audio", "sound", "sfx", "music"]}
    return F.concat(
        labeled,
        needing(["16", "2.3", "sfx", "photoreal", "non-ip", "cinematic", "output", "settings"], on_lines),
        needing(["aspect", "ratio"], _each(c, LABELED_ASPECT, "declared_aspect_ratio", "output", lambda m: F.regexp_replace(F.regexp_extract(m, LABELED_ASPECT, 1), r"(?U)\s+", ""), "aspect.labeled", "high", 4)),
        needing([":"], aspects),
        needing(["mode"], _each(c, MODE_LABEL, "generation_mode", "label", _group(MODE_LABEL), "mode.labeled", "high", 6)),
        needing(["2v"], _each(c, MODE, "generation_mode", "token", F.upper, "mode.token", "medium", 6)),
        needing(["-to-video"], _each(c, MODE_WORDS, "generation_mode", "natural_language", F.lower, "mode.natural-language", "medium", 6)),
        needing(["model"], _each(c, MODEL_LABEL, "declared_model", "label", _group(MODEL_LABEL), "model.labeled", "medium", 7)),
        needing(["<<<"], _each(c, TRIPLE, "reference_tag", "triple", _group(TRIPLE), "reference.triple", "high", 8)),
        needing(["@"], _each(c, AT_TAG, "reference_tag", "at_tag", _group(AT_TAG), "reference.at", "high", 8)),
        needing(["<"], _each(c, MEDIA_TAG, "reference_tag", "h3_media", lambda m: _json(kind=F.regexp_extract(m, MEDIA_TAG, 1), number=F.regexp_extract(m, MEDIA_TAG, 2).cast("bigint")), "reference.media", "high", 8)),
        needing(["<<<", "@"], _definitions(c)),
        _line_facts(c),
        needing([":"], _each(c, TIMECODE, "timestamp", "timecode", lambda m: m, "timestamp.timecode", "medium", 11)),
        needing(["-", "–", "—", "to"], _each(c, RANGE, "timestamp", "range", lambda m: m, "timestamp.range", "medium", 12)),
        _each(c, POINT, "timestamp", "point", lambda m: m, "timestamp.point", "medium", 13),
        needing(["single", "one continuous", "no cut"], _each(c, SINGLE, "take_declaration", "single", lambda _: F.lit("single"), "take.single", "high", 13)),
        needing(["multi", "montage", "shots", "shot", "cut"], _each(c, MULTI, "take_declaration", "multi", lambda _: F.lit("multi"), "take.multi", "high", 13)),
        needing(["<d>", *(q for q in '"“«「')], _dialogue(c)),
        _each(c, LANGUAGE, "language", "explicit", lambda m: F.regexp_extract(m, LANGUAGE_NAME, 1), "language.explicit", "high", 16),
        *(needing(needs[n], facts) for n, facts in audio.items()),
    )


def _evidence(c: Column, facts: Column) -> Column:
    """The facts with the hash and a preview of their piece of text, in order; of equal kind, span and value the first rule's alone."""

    def once(b: Column) -> Column:
        same = lambda x, y: (x["start"] == y["start"]) & (x["end"] == y["end"]) & (x["kind"] == y["kind"]) & x["value"].eqNullSafe(y["value"])
        return F.filter(b["sorted"], lambda x, i: (i == 0) | ~same(x, F.get(b["sorted"], i - 1)))

    def order(x: Column) -> Column:
        return F.struct(*(x[n].alias(n) for n in ("start", "end", "kind", "value", "rank", "subtype", "rule", "confidence")))

    def proof(x: Column) -> Column:
        piece = T.slice_of(c, x["start"], x["end"])
        return F.struct(*(x[n].alias(n) for n in ("start", "end", "kind", "subtype", "value", "rule", "confidence")), F.sha2(piece, 256).alias("sha256"), F.substring(T.collapse(piece), 1, 240).alias("preview"))

    first = T.let(once, sorted=F.array_sort(F.transform(facts, order)))
    return F.array_sort(F.transform(first, proof))


def extract_facts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ordinal, kind, subtype, start, end, value, sha256, preview, rule, confidence): the facts of each text with their evidence.

    Null and empty texts have none. ordinal counts from 0 by start, end, kind, subtype and value, within each row. Of facts of equal kind, span and
    value the first rule's stands. All of it is made within the row, so nothing is shuffled and the text stays behind. A null key is kept.
    """
    f = texts.select(key, F.posexplode(_evidence(F.col(text), facts_of(F.col(text)))).alias("ordinal", "f"))
    return f.select(key, "ordinal", *(F.col(f"f.{n}").alias(n) for n in ("kind", "subtype", "start", "end", "value", "sha256", "preview", "rule", "confidence")))


def safely(texts: DataFrame, key: str, text: str, extractor, schema: str):  # noqa: ANN001, ANN201
    """(rows, failures) of an extractor in Python, a function from (text) to a list of rows of `schema`: rows (key, ordinal, schema), failures (key, code, reason).

    A text whose extractor raises leaves no rows and one failure, parser_exception, with the error's type; all others go on.
    """
    import pandas as pd

    names = [f.strip().split()[0] for f in schema.split(",")]
    k_type = texts.schema[key].dataType.simpleString()

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            out = []
            for k, t in zip(b["k"], b["t"], strict=True):
                try:
                    out += [(k, i, None, *r) for i, r in enumerate(list(extractor(t)))]
                except Exception as e:  # noqa: BLE001 - whatever a pluggable extractor raises
                    out.append((k, -1, type(e).__name__, *[None] * len(names)))
            yield pd.DataFrame(out, columns=["key", "ordinal", "failure", *names])

    got = materialize(texts.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"key {k_type}, ordinal int, failure string, {schema}"), "extracted")
    rows = got.where("failure is null").select(F.col("key").alias(key), "ordinal", *names)
    return rows, got.where("failure is not null").select(F.col("key").alias(key), F.lit("parser_exception").alias("code"), F.col("failure").alias("reason"))


def structure(texts: DataFrame, facts: DataFrame, key: str, metadata: DataFrame | None = None) -> DataFrame:
    """One row per text: declared durations, aspects, modes, take structure and counts of its facts; metadata (key, durations) joins in."""
    kind = lambda k: F.col("kind") == k
    seconds = F.get_json_object("value", "$.seconds").cast("double")
    agg = facts.groupBy(key).agg(
        F.array_sort(F.collect_set(F.when(kind("declared_duration"), seconds))).alias("declared_durations"),
        F.array_sort(F.collect_set(F.when(kind("declared_aspect_ratio") & (F.col("subtype") == "output"), F.col("value")))).alias("aspects"),
        F.array_sort(F.collect_set(F.when(kind("generation_mode"), F.col("value")))).alias("modes"),
        F.collect_set(F.when(kind("take_declaration"), F.col("value"))).alias("_takes"),
        *(F.count_if(kind(k)).alias(f"{n}_count") for k, n in (("heading", "heading"), ("shot_marker", "shot_marker"), ("cut_marker", "cut_marker"), ("timestamp", "timestamp"), ("dialogue", "dialogue_evidence"), ("reference_tag", "reference_tag"), ("reference_block", "reference_block"), ("audio", "audio_signal"))),
        F.count_distinct(F.when(kind("dialogue"), F.col("value"))).alias("dialogue_utterance_count"),
        F.count_distinct(F.when(kind("reference_tag"), F.col("value"))).alias("reference_label_count"),
        F.coalesce(F.bool_or(kind("audio") & (F.col("subtype") == "sfx_only")), F.lit(False)).alias("sfx_only"),
    )
    counts = [c for c in agg.columns if c.endswith("_count")]
    none = F.array().cast("array<string>")
    out = texts.select(key).join(agg, key, "left")
    out = out.join(metadata, key, "left") if metadata is not None else out.withColumn("durations", F.array().cast("array<double>"))
    takes, cuts = F.coalesce("_takes", none), F.coalesce("cut_marker_count", F.lit(0))
    single, multi = F.array_contains(takes, "single"), F.array_contains(takes, "multi")
    take = F.when(single & (multi | (cuts > 0)), "conflict").when(single, "single").when(multi | (cuts > 0), "multi").otherwise("not_declared")
    return out.select(
        key,
        F.coalesce("declared_durations", F.array().cast("array<double>")).alias("declared_durations"),
        F.coalesce("durations", F.array().cast("array<double>")).alias("metadata_durations"),
        F.coalesce("aspects", none).alias("aspects"),
        F.coalesce("modes", none).alias("modes"),
        take.alias("take_structure"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        F.coalesce("sfx_only", F.lit(False)).alias("sfx_only"),
    )


def _setting(k: str) -> str:
    return '"' + k + r'"\s*:\s*(?:"(?:\\.|[^"\\])*"|[-+]?\d+(?:\.\d+)?|true|false|null)'


def _has(doc: Column, k: str) -> Column:
    """The setting is there and a scalar."""
    kind = F.schema_of_variant(F.try_variant_get(doc, f"$.{k}", "variant"))
    return F.coalesce(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), F.lit(False))


def _unsupported(doc: Column, k: str, kind: str) -> Column:
    """The setting has a value of a kind that can't be one: a duration that is no number, others that are no text or number."""
    has = F.schema_of_variant(F.try_variant_get(doc, f"$.{k}", "variant"))
    number = has.isin("BIGINT", "DOUBLE") | has.startswith("DECIMAL")
    ok = number if kind == "declared_duration" else has == "STRING" if kind == "declared_aspect_ratio" else (has == "STRING") | number
    return F.coalesce(~ok & (has != "VOID"), F.lit(False))


def issues(texts: DataFrame, struct: DataFrame, facts: DataFrame, key: str, text: str, redactions: str | None = None) -> DataFrame:
    """(key, code): what is doubtful about a text or its facts."""
    tags = facts.where("kind in ('reference_tag', 'reference_block')").groupBy(key).agg(F.collect_set(F.when(F.col("subtype") == "triple", F.concat(F.lit("<<<"), "value", F.lit(">>>")))).alias("used"), F.collect_set(F.when(F.col("kind") == "reference_block", F.get_json_object("value", "$.label"))).alias("defined"))
    cols = [key, text] + ([redactions] if redactions else [])
    # what is asked of the text is asked before the joins, so that it stays behind
    body = T.strip(text)
    is_json = body.startswith("{") & body.endswith("}")
    texts = texts.select(*cols, is_json.alias("_json"), F.when(is_json, F.try_parse_json(body)).alias("_doc"))
    is_json, doc = F.col("_json"), F.col("_doc")
    settings = F.array_compact(F.array(*(F.when(_unsupported(doc, k, kind), F.lit(k)) for k, kind in SETTING_KEYS.items())))
    lost = F.array_compact(F.array(*(F.when(_has(doc, k) & ~F.col(text).rlike(_setting(k)), F.lit(k)) for k in SETTING_KEYS)))
    seen = {"_bad": is_json & doc.isNull(), "_odd": is_json & (F.size(settings) > 0), "_lost": is_json & (F.size(lost) > 0), "_ufffd": F.contains(F.col(text), F.lit("�"))}
    j = texts.select(*(c for c in cols if c != text), *(c.alias(n) for n, c in seen.items())).join(struct, key).join(tags, key, "left")
    flags = {
        "invalid_json_prompt": F.col("_bad"),
        "unsupported_json_setting_value": F.col("_odd"),
        "json_field_span_not_found": F.col("_lost"),
        "unresolved_reference_occurrence": F.size(F.array_except(F.coalesce("used", F.array().cast("array<string>")), F.coalesce("defined", F.array().cast("array<string>")))) > 0,
        "take_structure_conflict": F.col("take_structure") == "conflict",
        "multiple_declared_duration_values": F.size("declared_durations") > 1,
        "duration_metadata_conflict": durations_disjoint("declared_durations", "metadata_durations"),
        "multiple_output_aspect_values": F.size("aspects") > 1,
        "audio_dialogue_scope_ambiguity": F.col("sfx_only") & (F.col("dialogue_evidence_count") > 0),
        "unicode_replacement_character": F.col("_ufffd"),
    }
    if redactions:
        flags["prompt_url_redacted"] = F.col(redactions) > 0
    return j.select(key, F.explode(F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in flags.items())))).alias("code"))


def scene_tags(c: Column, has_dialogue: Column) -> Column:
    """Sorted tags of the scene patterns found; two or more add mixed_scene, none gives unspecified_scene."""
    t = F.array_compact(F.array(*(F.when((c.rlike(p) | has_dialogue) if n == "character_performance" else c.rlike(p), F.lit(n)) for n, p in SCENES.items())))
    return F.when(F.size(t) == 0, F.array(F.lit("unspecified_scene"))).when(F.size(t) > 1, F.array_append(t, "mixed_scene")).otherwise(t)


def stratify(texts: DataFrame, struct: DataFrame, issue_rows: DataFrame, key: str, text: str, chars: str) -> DataFrame:
    """One row per text: states and bands of its structure, scene tags, risk flags, and the one complexity queue it belongs to."""
    codes = issue_rows.groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    j = texts.select(key, text, chars).join(struct, key).join(codes, key, "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    talk = (F.col("dialogue_evidence_count") > 0) | (F.col("dialogue_utterance_count") > 0)
    has = lambda c: F.array_contains("codes", c)
    j = j.select(
        key,
        "codes",
        F.when(F.col("take_structure") == "single", "single_take").when(F.col("take_structure") == "multi", "multi_take").when(F.col("take_structure") == "conflict", "conflicted").otherwise("not_declared").alias("structure_state"),
        F.when(has("audio_dialogue_scope_ambiguity"), "ambiguous").when(talk, "detected").otherwise("none").alias("dialogue_state"),
        duration_state("declared_durations", "metadata_durations").alias("duration_state"),
        length_band(chars).alias("text_length_band"),
        marker_band(F.col("shot_marker_count") + F.col("cut_marker_count") + F.col("timestamp_count")).alias("marker_density_band"),
        reference_band(F.col("reference_tag_count") + F.col("reference_block_count")).alias("reference_density_band"),
        scene_tags(F.col(text), talk).alias("scene_tags"),
        F.exists("metadata_durations", lambda x: x.isNull()).alias("_gap"),
    )
    very, high, dense = F.col("text_length_band") == "very_long", F.col("marker_density_band") == "high", F.col("reference_density_band") == "dense"
    flags = F.array_compact(F.array(F.when(F.col("_gap"), F.lit("missing_asset_duration")), F.when(very, F.lit("very_long_prompt")), F.when(high, F.lit("high_marker_density")), F.when(dense, F.lit("dense_references")), F.when(F.col("duration_state") == "conflict", F.lit("duration_conflict")), F.when(F.col("structure_state") == "conflicted", F.lit("structure_conflict"))))
    manual = has("parser_exception") | has("unicode_replacement_character")
    mixed, long = F.array_contains("scene_tags", "mixed_scene"), F.col("text_length_band") == "long"
    medium, light = F.col("marker_density_band") == "medium", F.col("reference_density_band") == "light"
    queue = F.when(manual, "manual_review").when((F.size("codes") > 0) | very | high | dense, "complex").when(long | medium | light | mixed, "standard").otherwise("simple")
    reasons = (
        F.when(manual, F.array_intersect("codes", F.array(F.lit("parser_exception"), F.lit("unicode_replacement_character"))))
        .when((F.size("codes") > 0) | very | high | dense, F.array_sort(F.array_union("codes", F.array_compact(F.array(F.when(very, F.lit("very_long_prompt")), F.when(high, F.lit("high_marker_density")), F.when(dense, F.lit("dense_references")))))))
        .when(long | medium | light | mixed, F.array_compact(F.array(F.when(long, F.lit("long_prompt")), F.when(medium, F.lit("medium_marker_density")), F.when(light, F.lit("light_references")), F.when(mixed, F.lit("mixed_scene")))))
        .otherwise(F.array(F.lit("low-structure")))
    )
    return j.select(key, queue.alias("complexity_queue"), "structure_state", "dialogue_state", "duration_state", "text_length_band", "marker_density_band", "reference_density_band", "scene_tags", F.array_sort(F.array_union("codes", flags)).alias("risk_flags"), reasons.alias("queue_reasons"))
