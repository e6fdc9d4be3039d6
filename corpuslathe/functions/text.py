"""Text functions as columns: normal forms, clean-up, matches with their exact positions.

Patterns are Java's with (?U), so that classes are Unicode-aware; positions count code points from 0, as substring does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the corpus format: what is a URL, what replaces it, what is trimmed from clipped text.
URL = r"(?i)https?://[^\s<>\"']+"
URL_MARKER = "<URL_REDACTED>"
NUMBER = r"(?U)(?<![\w.])[+-]?\d+(?:\.\d+)?%?(?![\w.])"
EDGE = " \t\r\n-—:;,|"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def collapse(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(col(c), r"(?U)\s+", " "))


#: Characters that full case folding changes otherwise than lower case does, with what they become; by rule, from Unicode's own tables.
_FOLDS = {c: c.casefold() for c in map(chr, range(0x20000)) if not "\ud800" <= c <= "\udfff" and c.casefold().lower() != c.lower() or c == "\u0130"}


_RARE = {a: b for a, b in _FOLDS.items() if a not in "ßςẞİ"}


def _ranges(chars: list[str]) -> str:
    """A character class; ranges are far quicker to match than single characters."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


def fold(c: Column | str) -> Column:
    """Without case, as Unicode's full folding has it (Cherokee folds to small letters here, which unites the same texts)."""
    low = F.replace(F.replace(F.lower(F.replace(col(c), F.lit("İ"), F.lit("i\u0307"))), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))
    one = {a: b for a, b in _RARE.items() if len(b) == 1}
    several = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _RARE.items() if len(b) > 1))

    def whole(v: Column) -> Column:
        full = F.aggregate(several, F.translate(v, "".join(one), "".join(one.values())), lambda s, p: F.replace(s, p["a"], p["b"]))
        return F.when(v.rlike(r"[^\x00-\x7f]") & v.rlike(_ranges(list(_RARE))), full).otherwise(v)

    return let(lambda b: whole(b["v"]), v=low)  # computed once


def format_normalize(c: Column | str) -> Column:
    """Equal for texts that differ in white space and case only."""
    return fold(collapse(c))


def numeric_normalize(c: Column | str) -> Column:
    """As format_normalize, with every number that stands alone replaced; numbers inside words or versions stay."""
    return F.regexp_replace(format_normalize(c), NUMBER, "<number>")


def redact_urls(c: Column | str) -> Column:
    return F.regexp_replace(col(c), URL, URL_MARKER)


def url_count(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(URL))


def clip(c: Column | str, limit: int = 520) -> Column:
    """White space collapsed, separators trimmed, cut to `limit` characters with dots where something is missing."""
    v = F.btrim(F.regexp_replace(col(c), r"(?U)\s+", " "), F.lit(EDGE))
    return F.when(F.length(v) <= limit, v).otherwise(F.concat(F.rtrim(F.substring(v, 1, limit - 1)), F.lit("...")))


#: Reference labels and adapter tokens that are no part of neutral text.
SYNTAX = r"(?i)<<<[^<>\r\n]{1,150}>>>|<(?:Picture|Subject|Video|Audio)\s+\d+>|(?<![\w@])@[A-Za-z][A-Za-z0-9_.-]*\b"
_TOKENS = r"(?i)\b(?:seedance|h3|t2va|i2va|fl2va|l2va|ref2va|r2v|i2v|t2v)\b"


def clean_syntax(c: Column | str) -> Column:
    """Without reference labels, unclosed labels, adapter tokens and mode settings."""
    v = F.regexp_replace(col(c), SYNTAX, " ")
    v = F.regexp_replace(F.regexp_replace(v, r"<<<[^<>\r\n]*$", " "), r"^[^<>\r\n]*>>>", " ")
    v = F.replace(F.replace(v, F.lit("<<<"), F.lit(" ")), F.lit(">>>"), F.lit(" "))
    v = F.regexp_replace(F.regexp_replace(v, _TOKENS, " "), r"(?i)\b(?:mode|prompt\s*mode|runtime\s*task)\s*[:=]\s*[A-Za-z0-9_-]+", " ")
    return F.btrim(F.regexp_replace(v, r"(?U)\s+", " "), F.lit(EDGE))


def slug(c: Column | str, default: str = "item") -> Column:
    s = F.btrim(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def excerpt(c: Column | str, n: int = 1200) -> Column:
    return F.substring(collapse(c), 1, n)


def bullets(items: Column | str) -> Column:
    return F.array_join(F.transform(col(items), lambda x: F.concat(F.lit("- "), x)), "\n")


def any_of(c: Column | str, alternatives: list[str]) -> Column:
    """Whether one of the patterns is found, without regard to case."""
    return col(c).rlike("(?iU)(?:" + "|".join(alternatives) + ")")


def signals(c: Column | str, groups: dict[str, list[str]]) -> Column:
    """Names of the groups with a pattern that is found, in their order."""
    return F.array_compact(F.array(*(F.when(any_of(c, ps), F.lit(n)) for n, ps in groups.items())))


def let(fn, **values: Column) -> Column:  # noqa: ANN001
    """fn of a struct of the values, each computed once: inside a lambda an expression would be computed for every element."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), fn), F.lit(0))


def spans(c: Column | str, pattern: str) -> Column:
    """Array of (start, end, match) of all matches; the pattern must not match the empty string.

    Positions come from the lengths of matches and of what stands between them: regexp_instr would count UTF-16 units.
    """
    t = col(c)
    found, between = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)
    total = lambda a, n: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda s, x: s + x)

    def placed(b: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            start = total(b["gaps"], i + 1) + total(b["sizes"], i)
            return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"))

        return F.transform(b["found"], span)

    length = lambda a: F.transform(a, lambda x: F.length(x))
    some = lambda f: let(placed, found=f["found"], sizes=length(f["found"]), gaps=length(between))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return let(lambda f: F.when(F.size(f["found"]) > 0, some(f)).otherwise(none), found=found)  # most patterns aren't there


def lines(c: Column | str) -> Column:
    """Array of (line, start); only line feeds end a line."""

    def placed(b: Column) -> Column:
        return F.transform(b["parts"], lambda x, i: F.struct(x.alias("line"), F.aggregate(F.slice(b["sizes"], F.lit(1), i), F.lit(0), lambda s, y: s + y + 1).alias("start")))

    return let(lambda p: let(placed, parts=p["parts"], sizes=F.transform(p["parts"], lambda x: F.length(x))), parts=F.split(col(c), "\n", -1))


def slice_of(c: Column | str, start: Column, end: Column) -> Column:
    return F.substring(col(c), start + 1, end - start)


def context_matches(c: Column | str, terms: list[str], radius: int = 180, per_term: int = 20) -> Column:
    """Array of (term, offset, context): occurrences of each term without regard to case, with the text around them."""
    t = col(c)

    def one(term: str) -> Column:
        at = F.slice(spans(t, "(?iU)\\Q" + term + "\\E"), F.lit(1), F.lit(per_term))
        return F.transform(at, lambda s: F.struct(F.lit(term).alias("term"), s["start"].alias("offset"), slice_of(t, F.greatest(s["start"] - radius, F.lit(0)), s["end"] + radius).alias("context")))

    return F.concat(*(one(x) for x in terms))


#: File types that are media, and what endpoint addresses contain.
_MEDIA = r"(?i)\.(?:png|jpe?g|gif|webp|svg|ico|mp4|webm|mov|mp3|wav|woff2?|ttf|css)(?:[?#]|$)"
_ENDPOINT = r"(?i)api|graphql|trpc|project|folder|asset"


def host_is(c: Column | str, host: str) -> Column:
    """An address of this host or of one below it."""
    own = F.lower(F.regexp_extract(col(c), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return (own == host.lower()) | own.endswith("." + host.lower())


def is_media(c: Column | str) -> Column:
    return col(c).rlike(_MEDIA)


def join_url(base: str, path: Column | str) -> Column:
    """An address relative to `base`, as browsers resolve it: absolute, `//host`, `/path`, `?query`, `#part`, or beside the base's last part; . and .. are resolved."""
    p = col(path)
    scheme = base.split("://", 1)[0]
    origin = f"{scheme}://" + base.split("://", 1)[1].split("/", 1)[0].split("?")[0].split("#")[0]
    whole = base.split("#")[0]
    plain = whole.split("?")[0]
    folder = plain.rsplit("/", 1)[0] + "/" if plain.count("/") > 2 else origin + "/"
    tail = F.regexp_extract(p, r"([?#].*)$", 1)
    body = F.regexp_replace(p, r"[?#].*$", "")
    full = F.when(body.startswith("/"), F.concat(F.lit(origin), body)).otherwise(F.concat(F.lit(folder), body))
    parts = F.split(F.substring(full, F.lit(len(origin) + 2), F.length(full)), "/")

    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.array_append(done, part))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    dots = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    resolved = F.concat(F.lit(origin + "/"), F.array_join(kept, "/"), F.when(dots, F.lit("/")).otherwise(F.lit("")), tail)
    return F.when(p.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), p).when(p.startswith("//"), F.concat(F.lit(scheme + ":"), p)).when(p == "", F.lit(whole)).when(p.startswith("#"), F.concat(F.lit(whole), p)).when(p.startswith("?"), F.concat(F.lit(plain), p)).otherwise(resolved)


def endpoint_candidates(c: Column | str, base: str, limit: int = 500) -> Column:
    """Sorted distinct addresses in a text that look like endpoints: absolute URLs and quoted paths (joined to `base`)."""
    t = col(c)
    absolute = F.transform(F.regexp_extract_all(t, F.lit(r"https?://[^\"'`\\\s]+"), F.lit(0)), lambda u: F.rtrim(u, F.lit(")]},;:")))
    paths = F.transform(F.regexp_extract_all(t, F.lit(r"[\"'`](/[^\"'`\\\s]{2,300})[\"'`]"), F.lit(1)), lambda p: join_url(base, p))
    ok = F.filter(F.concat(absolute, paths), lambda u: u.rlike(_ENDPOINT) & ~u.rlike(_MEDIA))
    return F.slice(F.array_sort(F.array_distinct(ok)), F.lit(1), F.lit(limit))


def segments(c: Column | str) -> Column:
    """Array of (text, start, end): sentences of the lines that are no headings or rules, without reference labels.

    A line of one sentence of more than 900 characters is cut at semicolons instead.
    """
    heading = r"^[\s\-_=*|:]+$|^[A-Z][A-Z0-9 /&()'\-]{1,80}:?$"
    sentence, clause = r"[^.!?。！？]+[.!?。！？]?", r"[^;；]+[;；]?"
    rows = F.filter(spans(c, r"[^\r\n]+"), lambda s: (F.length(strip(s["match"])) > 0) & ~strip(s["match"]).rlike(heading))

    def cut(s: Column) -> Column:
        body = strip(s["match"])
        first = s["start"] + F.length(s["match"]) - F.length(F.regexp_replace(s["match"], r"(?U)^\s+", ""))
        parts = F.when((F.size(F.regexp_extract_all(body, F.lit(sentence), F.lit(0))) == 1) & (F.length(body) > 900), spans(body, clause)).otherwise(spans(body, sentence))

        def place(p: Column) -> Column:
            raw = strip(p["match"])
            start = first + p["start"] + F.length(p["match"]) - F.length(F.regexp_replace(p["match"], r"(?U)^\s+", ""))
            return F.struct(clean_syntax(raw).alias("text"), start.alias("start"), (start + F.length(raw)).alias("end"))

        return F.transform(parts, place)

    return F.filter(F.flatten(F.transform(rows, cut)), lambda x: (F.length(x["text"]) > 0) & ~x["text"].rlike(heading))


def error_code(reason: Column | str) -> Column:
    """Code of an extraction error by the first known phrase in its reason."""
    r = F.lower(F.coalesce(col(reason), F.lit("unknown extraction error")))
    known = {"item is not an object": "item_not_object", "unsupported item type": "unsupported_item_type", "params are missing": "missing_job_params", "prompt is empty": "empty_prompt", "asset id is missing": "missing_asset_id", "folder id is missing": "missing_folder_id"}
    return F.coalesce(*(F.when(F.contains(r, F.lit(k)), F.lit(v)) for k, v in known.items()), F.lit("record_parse_error"))


def cursor_key(kind: Column, json: Column) -> Column:
    """Typed key of a cursor, so that 1 and "1" differ; null is the first page."""
    return F.when(json.isNull() | (kind == "null"), F.lit("<FIRST_PAGE>")).otherwise(F.concat(kind, F.lit(":"), json))
