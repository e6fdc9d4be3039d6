"""Text decoded with the wrong character encoding: finding it and restoring what was written.

The corpus is its own dictionary. Every distinct unit that holds a character beyond ASCII (words between ASCII delimiters, pairs
of neighbouring Han or kana characters, single characters) is put through all encoding chains: written as bytes of one encoding,
read as another, some of them twice. That gives a table of garbled forms. Documents' own units are hash-joined with it.
A form that the corpus holds at least as often as the word it comes from is a word itself, not a garbled one, unless undoing
the chain on the whole record shows otherwise. Texts that differ in nothing but digits, spaces and ASCII signs count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.llm.words import bitmap, bits_for
from corpuslathe.runtime import materialize

#: Units that a task counts before it passes them on; up to so many forms are broadcast to the texts.
HELD_UNITS, BROADCAST_FORMS, SALTS = 300_000, 50_000, 16
#: Fixed values: (written as, read as) by family. Letters' encodings and those of Han and kana.
_ONE_BYTE = ["latin-1", "cp1252", "iso8859-15", "cp1250", "cp1251", "cp1253", "cp1254", "koi8-r", "cp437", "cp850", "cp866", "mac-roman", "mac-cyrillic"]
_WIDE = ["gbk", "cp932", "euc-jp", "big5", "euc-kr"]
CHAINS: list[tuple[str, ...]] = (
    [("utf-8", r) for r in [*_ONE_BYTE, *_WIDE, "gb18030"]]
    + [(w, r) for w in ("cp1252", "mac-roman") for r in ["utf-8", *_ONE_BYTE, "gbk", "cp932"] if w != r]
    + [(w, r) for w in ("cp1251", "koi8-r", "cp866", "mac-cyrillic") for r in ["utf-8", *_ONE_BYTE, "gbk"] if w != r]
    + [(w, r) for w in _WIDE for r in ["utf-8", "latin-1", "cp1252", "mac-roman", "cp1251", "koi8-r", "cp437", *_WIDE] if w != r]
    + [("utf-8", r, "utf-8", q) for r in ("latin-1", "cp1252") for q in ("latin-1", "cp1252")]
    + [("utf-8", r, "utf-8", r) for r in ("cp1251", "cp437", "mac-roman", "cp1250")]
)
_LATIN = ("latin-1", "cp1252", "iso8859-15", "cp1250", "cp1254", "cp437", "cp850", "mac-roman")
#: The chains by the encoding that wrote; where the reader takes several bytes for a character, the first may have gone with what stood before.
_BY_WRITER = [(w, [(c, ">".join(c), (0, 1) if w == "utf-8" and c[1] in (*_WIDE, "gb18030") else (0,)) for c in CHAINS if c[0] == w]) for w in dict.fromkeys(c[0] for c in CHAINS)]
#: What becomes of bytes that an encoding leaves undefined: the control character of that number, nothing, or U+FFFD.
UNDEFINED = ("keep", "drop", "replace")

WIDE_CHAR = "⺀-〿ぁ-ヿ㄀-㆏ㇰ-㏿㐀-䶿一-鿿가-힣豈-﫿︰-﹏＀-￯\U00020000-\U0003ffff-"
_SPLIT = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_WIDE_RUN = re.compile(f"[{WIDE_CHAR}�]+")
_BEYOND = re.compile(r"[^\x00-\x7f]")
_WORD_RUN = re.compile(f"[^\\W{WIDE_CHAR}]+")
_NARROW_RUN = re.compile(f"[^\\s{WIDE_CHAR}�\\x00-\\x1f]*[^\\x00-\\x7f{WIDE_CHAR}�][^\\x00-\\x1f{WIDE_CHAR}�]*")
#: Quotation marks, dashes and dots that stand next to letters in well-written text.
_TYPOGRAPHIC = frozenset("’‘“”„‚«»‹›–—…•")
#: The letters that make up some 85 % of Russian text.
_COMMON_CYRILLIC = frozenset("оеаинтсрвлкмдпуяыОЕАИНТСРВЛКМДПУЯЫ")
#: The common characters of an encoding, by the first of their two bytes (level 1 of GB 2312, JIS X 0208 and Big5).
_LEVEL_1 = (("gb2312", 0xB0, 0xD7), ("euc-jp", 0xB0, 0xCF), ("big5", 0xA4, 0xC6))


def _read(data: bytes, enc: str, undefined: str) -> str:
    try:
        return data.decode(enc)
    except UnicodeDecodeError:
        if undefined == "replace":
            return data.decode(enc, "replace")
        if undefined == "drop":
            return data.decode(enc, "ignore")
        if enc in _ONE_BYTE:
            return "".join(_byte(b, enc) for b in data)
        return ""


@lru_cache(maxsize=8192)
def _byte(b: int, enc: str) -> str:
    try:
        return bytes([b]).decode(enc)
    except UnicodeDecodeError:
        return chr(b)


def garble(text: str, chain: tuple[str, ...], undefined: str = "keep", skip: int = 0) -> str | None:
    """The text put through a chain; None if an encoding can't write it. skip: bytes at the start that went with what stood before."""
    for i in range(0, len(chain), 2):
        try:
            data = _write(text, chain[i])
        except UnicodeEncodeError:
            return None
        text = _read(data[skip:] if i == 0 else data, chain[i + 1], undefined)
    return text


def _strictly(text: str, chain: tuple[str, ...], skip: int) -> str | None:
    """As garble, where every byte means something in each encoding; None otherwise."""
    try:
        for i in range(0, len(chain), 2):
            text = text.encode(chain[i])[skip if i == 0 else 0 :].decode(chain[i + 1])
    except UnicodeError:
        return None
    return text


def _write(text: str, enc: str) -> bytes:
    """Bytes of the text, with undefined bytes that were kept as control characters written back as such."""
    try:
        return text.encode(enc)
    except UnicodeEncodeError:
        if enc not in _ONE_BYTE:
            raise
        return b"".join(bytes([ord(c)]) if 0x80 <= ord(c) <= 0x9F else c.encode(enc) for c in text)


def oddness(s: str) -> int:
    """How unlike written text a unit is: control, private and unassigned characters, stray signs, scripts and cases mixed within it."""
    odd, last_script, upper_after_lower, accents = 0, "", 0, 0
    previous = ""
    for i, c in enumerate(s):
        if c < "\x80":
            kind = "a" if c.isalpha() else ""
        else:
            cat = unicodedata.category(c)
            if cat in ("Cc", "Cn", "Co", "Cf", "Cs") or c == "�":
                odd, kind = odd + 2, ""
            elif cat[0] == "L":
                kind = _script(c)
                if kind == "A":
                    kind = "a"
                    accents += 1
                    odd += accents > 2
                elif cat in ("Lm",) and kind != "H":
                    odd += 1
            else:
                if cat[0] in "SN" and kind_of_sign(c):
                    odd += 1
                elif cat[0] == "P" and c not in "’–—" and previous.isalpha() and s[i + 1 : i + 2].isalpha():
                    odd += 1  # a mark within a word
                kind = ""
        if kind != "a" or c < "\x80":
            accents = 0
        if kind and last_script and kind != last_script:
            odd += 1
        if kind and previous.islower() and c.isupper():
            upper_after_lower += 1
        if kind:
            last_script = kind
        previous = c
    return odd + upper_after_lower


def kind_of_sign(c: str) -> bool:
    return c not in "°½×€’"


@lru_cache(maxsize=65536)
def _script(c: str) -> str:
    name = unicodedata.name(c, "")
    if name.startswith("LATIN"):
        return "A"
    if name.startswith(("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "IDEOGRAPH", "KATAKANA-HIRAGANA", "HALFWIDTH", "FULLWIDTH")):
        return "H"
    return name.split(" ", 1)[0]


@lru_cache(maxsize=65536)
def _levels(c: str) -> tuple[bool, ...]:
    """Whether a Han character, kana or Hangul syllable is a common one of simplified Chinese, Japanese, traditional Chinese, Korean."""
    if "ぁ" <= c <= "ヿ":
        return False, True, False, False
    if "가" <= c <= "힣":
        return False, False, False, _strictly(c, ("euc-kr", "euc-kr"), 0) is not None
    found = []
    for enc, low, high in _LEVEL_1:
        try:
            data = c.encode(enc)
            found.append(len(data) == 2 and low <= data[0] <= high)
        except UnicodeEncodeError:
            found.append(False)
    return (*found, False)


def unlikely(text: str) -> float:
    """How unlike written text a whole text is: oddness of its words, rare Cyrillic letters, and characters rare in the writing that fits best."""
    total, hans, fits = 0.0, 0, [0, 0, 0, 0]
    for t in _SPLIT.split(text):
        if not t or t.isascii():
            continue
        total += oddness(t)
        for c in t:
            if "Ѐ" <= c <= "ӿ":
                total += c not in _COMMON_CYRILLIC
            elif "ぁ" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "가" <= c <= "힣" or "豈" <= c <= "﫿":
                hans += 1
                fits = [n + x for n, x in zip(fits, _levels(c), strict=True)]
    return total + hans - max(fits)


@lru_cache(maxsize=16)
def _unlikely_once(text: str) -> float:
    """As `unlikely`; the chains of a record are asked one after the other."""
    return unlikely(text)


@lru_cache(maxsize=16)
def _standing(text: str) -> frozenset[str]:
    """The units between ASCII delimiters that aren't ASCII."""
    return frozenset(t for t in _SPLIT.split(text) if t and not t.isascii())


def undone(text: str, chain: str, forms_: list[str], strong: bool) -> bool | None:
    """Whether undoing the chain explains the record: True if most of what is beyond ASCII goes and the rest reads clearly better, False if its forms read worse, else None.

    Of fewer than three forms all must be `strong`, and what they become be plain letters.
    """
    # the forms alone tell whether they read worse: most of the record may be sound
    if sum(unlikely(f) - unlikely(_undo(f, tuple(chain.split(">")), True)) for f in forms_) < 0:
        return False
    got, _ = restore(text, {chain: forms_}, {}, odder=True)
    if got == text:
        return None
    better = _unlikely_once(text) - unlikely(got)
    own, new = _standing(text), _standing(got)
    if len(forms_) < 3:
        return True if strong and better > 0 and not own & new and all(_plain(c) or c in _TYPOGRAPHIC for c in got) else None
    return True if len(own & new) <= 0.4 * len(own) and better >= max(2, 0.1 * len(_BEYOND.findall(got))) else None


def _plain(c: str) -> bool:
    """A letter as writers of Latin, Greek or Russian text use them, or ASCII."""
    return c < "\x80" or "À" <= c <= "ſ" and c not in "×÷" or "А" <= c <= "я" or c in "ёЁ" or "Α" <= c <= "ω"


def units(text: str) -> tuple[set[str], set[str], set[str]]:
    """(sources, probes, whole): units that may be garbled into forms, units of this text that may be such forms, and those that stand alone between ASCII delimiters."""
    if not _BEYOND.search(text):
        return set(), set(), set()
    found = {t for t in _SPLIT.split(text) if t and not t.isascii()}
    probes = set(found)
    # a long unit of Han or kana is many words: its pairs below stand for it, and the words of other scripts in it for themselves
    sources = {t for t in found if len(t) <= 40 or not _WIDE_RUN.search(t)}
    for t in found - sources:
        sources.update(w for w in _WORD_RUN.findall(t) if not w.isascii())
    for t in list(sources):
        sources.add(t.lower())
    sources.update(c for c in set(text) if c > "\x7f")
    if "�" in text:
        probes.add("�")
    for m in _WIDE_RUN.finditer(text):
        r = m[0]
        for i in range(len(r) - 1):
            sources.add(r[i : i + 2])
            probes.add(r[i : i + 2])
            if i + 3 <= len(r):
                probes.add(r[i : i + 3])
    for m in _NARROW_RUN.finditer(text):
        r = m[0]
        strange = [i for i, c in enumerate(r) if not _plain(c)]
        for n in (2, 3, 4, 6):
            for i in {j for k in strange for j in range(max(0, k - n + 1), min(k, len(r) - n) + 1)}:
                w = r[i : i + n]
                if w[0] > "\x7f":
                    probes.add(w)
    return sources, probes, found


def forms(unit: str) -> Iterator[tuple[str, str, bool]]:
    """(garbled form, chain, whether no byte was lost) of a unit under all chains; forms that are the unit itself or lost what makes them one are left out."""
    wide = len(unit) == 2 and all(_WIDE_RUN.fullmatch(c) for c in unit)
    seen = {unit, unit.lower(), ""}
    lone = len(unit) == 1 and _WIDE_RUN.fullmatch(unit) is not None
    for writer, chains in _BY_WRITER:
        if lone and writer in _WIDE:  # two bytes are too little to tell from other text
            continue
        try:  # written once for all its readers
            data, sound = unit.encode(writer), True
        except UnicodeEncodeError:
            try:
                data, sound = _write(unit, writer), False
            except UnicodeEncodeError:
                continue
        for chain, name, skips in chains:
            for skip in skips if wide else (0,):
                if sound and (g := _strict_rest(data[skip:], chain)) is not None:
                    read = ((g, "keep"),)  # no byte is undefined
                else:
                    kept = _rest(data[skip:], chain, "keep")
                    if kept is None:
                        continue
                    read = ((kept, "keep"), *((x, u) for u in UNDEFINED[1:] if (x := _rest(data[skip:], chain, u)) is not None))
                for g, undefined in read:
                    if wide and chain[-1] not in _ONE_BYTE:
                        g = g.strip("�") if undefined == "replace" else g
                        if len(g) < 2:
                            continue
                    for v in (g, g.lower(), g.upper()):
                        if v not in seen and not v.isascii() and (len(v) > 1 or v == "�"):
                            seen.add(v)
                            yield v, name, undefined == "keep"


def _strict_rest(data: bytes, chain: tuple[str, ...]) -> str | None:
    """What the bytes, written by the chain's first encoding, become in the rest of it, where every byte means something; None otherwise."""
    try:
        text = data.decode(chain[1])
        for i in range(2, len(chain), 2):
            text = text.encode(chain[i]).decode(chain[i + 1])
    except UnicodeError:
        return None
    return text


def _rest(data: bytes, chain: tuple[str, ...], undefined: str) -> str | None:
    text = _read(data, chain[1], undefined)
    return garble(text, chain[2:], undefined) if len(chain) > 2 else text


def _grown(unit: str, form: str, chain: str) -> bool:
    """Whether the form is what the several bytes of a character became as Latin letters and signs."""
    beyond = len(_BEYOND.findall(form))
    return chain.startswith("utf-8") and chain.rsplit(">", 1)[1] in _LATIN and beyond >= 2 and beyond > len(_BEYOND.findall(unit))


def spark_parallelism(df: DataFrame) -> int:
    """Tasks that keep the cluster busy with work that is heavy for its bytes."""
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def _texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).where(F.col("id").isNotNull() & F.col("t").rlike("[^\\x00-\\x7f]"))


def _bits(words: list[str], bits: int) -> np.ndarray:
    """As many first bits of each word's hash, which is that of Spark's xxhash64."""
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42) >> (64 - bits) for w in words), np.int64, len(words))


def _counts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(unit, df, source, probe, whole) of all units, counted within tasks first. Of texts that differ in nothing but digits, spaces and ASCII signs one is counted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[int]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame([(u, *v) for u, v in held.items()], columns=["unit", "n", "source", "probe", "whole"])

        for b in batches:
            for t in b["t"]:
                s, p, w = units(t)
                for u in s | p:
                    x = held.get(u)
                    if x is None:
                        held[u] = [1, u in s, u in p, u in w]
                    else:
                        x[0] += 1
                        x[1] |= u in s
                        x[2] |= u in p
                        x[3] |= u in w
                if len(held) > HELD_UNITS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    content = F.xxhash64(F.regexp_replace(F.lower("t"), "[\\x00-\\x60\\x7b-\\x7f]+", "")).alias("content")
    one = _texts(rows, id_col, text_col).select("id", "t", content).groupBy("content").agg(F.min_by("t", "id").alias("t"))
    each = one.select("t").mapInPandas(run, "unit string, n bigint, source boolean, probe boolean, whole boolean")
    return materialize(each.groupBy("unit").agg(F.sum("n").alias("df"), F.max("source").alias("source"), F.max("probe").alias("probe"), F.max("whole").alias("whole")), "unit_counts")


def _found(rows: DataFrame, id_col: str, text_col: str, best: DataFrame, n: int) -> DataFrame:
    """The forms in `best` that each text holds: (id, whole, and the columns of best)."""
    bits = bits_for(n)
    there = bitmap(best.select(F.xxhash64("form").alias("h")), bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t in zip(b["id"], b["t"], strict=True):
                _, p, w = units(t)
                own = list(p)
                at = _bits(own, bits)
                out += [(i, own[k], own[k] in w) for k in np.flatnonzero(there[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist()]
            yield pd.DataFrame(out, columns=["id", "form", "whole"])

    id_type = rows.schema[id_col].dataType.simpleString()
    got = _texts(rows, id_col, text_col).mapInPandas(run, f"id {id_type}, form string, whole boolean")
    if n <= BROADCAST_FORMS:
        return got.join(F.broadcast(best), "form").distinct()
    # one form may stand in a third of all texts
    salted = got.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["form", "salt"]).drop("salt").distinct()


def garbled_units(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, form, original, chain, strong): units of a text that are garbled forms of a more frequent unit of the corpus.

    strong: the form looks less like written text than its original (control characters, stray signs, mixed scripts or cases), or is
    several bytes of one character read as Latin letters and signs; others are evidence only together. Frequency counts texts by their letters.
    A form more than four times as frequent as its original (a weak one: as frequent) is a word of its own, unless it is of the latter kind
    or undoing a chain explains the record that holds it (`undone`). Weak forms count for no chain that makes a record read worse when undone.
    original is null where the original in the table is another chain's.
    """
    freq = _counts(rows, id_col, text_col)
    # a form that is nobody's unit is dropped where it is made, as far as a bitmap of bounded size can tell; the join tells the rest
    bits = bits_for(freq.where("probe").count())
    asked = bitmap(freq.where("probe").select(F.xxhash64("unit").alias("h")), bits)

    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 400):
                part = b.iloc[at : at + 400]
                out = [(f, u, chain, n, alone, all_bytes) for u, n, alone in zip(part["unit"], part["df"], part["whole"], strict=True) for f, chain, all_bytes in forms(u)]
                at = _bits([x[0] for x in out], bits)
                out = [out[k] for k in np.flatnonzero(asked[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist()]
                if out:
                    yield pd.DataFrame(out, columns=["form", "original", "chain", "original_df", "alone", "all_bytes"])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for f, u, chain, alone, all_bytes in zip(b["form"], b["original"], b["chain"], b["alone"], b["all_bytes"], strict=True):
                grown = f == "�" or all_bytes and _grown(u, f, chain)
                # a letter before a quotation mark or dash is common, unless the two stand where a sign alone stands elsewhere
                clear = f == "�" or any(not _plain(c) and c not in _TYPOGRAPHIC for c in f)
                if grown and not clear and not alone:
                    grown = False
                out.append((grown or oddness(f) > oddness(u), grown, clear))
            yield pd.concat([b.reset_index(drop=True), pd.DataFrame(out, columns=["strong", "grown", "clear"])], axis=1)

    parts = max(spark_parallelism(rows), -(-freq.where("source").count() // 10_000))
    made = freq.where("source").select("unit", "df", "whole").repartition(parts, F.xxhash64("unit")).mapInPandas(table, "form string, original string, chain string, original_df bigint, alone boolean, all_bytes boolean")
    there = freq.where("probe").select(F.col("unit").alias("form"), F.col("df").alias("form_df"))
    hit = made.join(there, "form").select("form", "original", "chain", "original_df", "alone", "all_bytes", "form_df")
    hit = hit.mapInPandas(judge, hit.schema.simpleString()[7:-1].replace(":", " ") + ", strong boolean, grown boolean, clear boolean")
    # the most frequent original explains a form; a form at least as frequent is a word of its own
    best = hit.groupBy("form").agg(F.max(F.struct("grown", "strong", "original_df", "original", "chain", "clear")).alias("b"), F.first("form_df").alias("form_df"), F.collect_set("chain").alias("chains"))
    fold = freq.groupBy(F.lower("unit").alias("folded")).agg(F.sum("df").alias("fold_df"))
    best = best.withColumn("folded", F.lower("form")).join(fold, "folded", "left")
    rarer = (F.col("b.original_df") > F.col("form_df")) | F.col("b.grown") | (F.col("b.strong") & (4 * F.col("b.original_df") >= F.col("form_df")))
    # a weak form whose lower case is an established word is that word in capitals
    rarer = rarer & (F.col("b.strong") | (F.col("fold_df") <= F.col("b.original_df") / 2) | (F.col("fold_df") <= 2))
    best = materialize(best.select("form", F.col("b.original").alias("original"), F.col("b.chain").alias("chain"), "chains", F.col("b.strong").alias("strong"), (F.col("b.grown") & ~F.col("b.clear")).alias("alone"), (~rarer).alias("common"), "form_df", F.col("b.original_df").alias("original_df")), "garbled_forms")
    hits = _found(rows, id_col, text_col, best, best.count()).where("whole or not alone").select("id", "form", "original", "chain", "chains", "strong", "common", "form_df", "original_df")
    hits = materialize(hits, "form_hits")
    kept = hits.join(_explained(hits, rows, id_col, text_col), "id", "left")
    yes, no = (F.coalesce(c, F.array().cast("array<string>")) for c in ("yes", "no"))
    chains = F.when(F.col("common"), F.array_intersect("chains", yes)).when(F.col("strong"), F.col("chains")).otherwise(F.array_except("chains", no))
    original = F.when(F.array_contains("left_", F.col("chain")), F.col("original"))
    return kept.withColumn("left_", chains).where("size(left_) > 0").select("id", "form", original.alias("original"), "chain", F.col("left_").alias("chains"), "strong", "form_df", "original_df")


def _explained(hits: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, yes, no): the chains that explain a record when undone, and those that make it read worse (`undone`), of those where it matters."""
    # forms by record; their chains are told apart where the text is
    ask = hits.where("length(form) >= 2").groupBy("id").agg(F.collect_set(F.struct("form", "strong", "common", "chains")).alias("ask"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, ask in zip(b["id"], b["t"], b["ask"], strict=True):
                per: dict[str, list] = {}
                for x in ask:
                    for c in x["chains"]:
                        per.setdefault(c, []).append(x)
                yes, no = [], []
                for c, xs in sorted(per.items()):
                    strong = sum(x["strong"] for x in xs)
                    # asked where it matters: some form is common, or no form alone is enough
                    if (strong or len(xs) >= 3) and (any(x["common"] for x in xs) or not any(x["strong"] and not x["common"] for x in xs)):
                        said = undone(t, c, sorted(x["form"] for x in xs), strong == len(xs))
                        (yes if said else no if said is False else []).append(c)
                if yes or no:
                    out.append((i, yes, no))
            yield pd.DataFrame(out, columns=["id", "yes", "no"])

    src = _texts(rows, id_col, text_col).distinct()
    id_type = rows.schema[id_col].dataType.simpleString()
    told = src.join(ask, "id").repartition(spark_parallelism(rows), "id").mapInPandas(run, f"id {id_type}, yes array<string>, no array<string>")
    return told.groupBy("id").agg(F.flatten(F.collect_list("yes")).alias("yes"), F.flatten(F.collect_list("no")).alias("no"))


def garbled_records(rows: DataFrame, id_col: str, text_col: str, weak_needed: int = 3, hits: DataFrame | None = None) -> DataFrame:
    """(id, chain, strong, weak): records holding garbled text, with the chain that explains most of their units.

    One strong unit suffices; of weak ones `weak_needed` different ones of one chain and of at least two characters are needed. Null, empty and pure
    ASCII texts are never garbled, nor are rows without an id. Repeated ids are one record. Empty table: nothing.
    """
    if hits is None:
        hits = garbled_units(rows, id_col, text_col)
    each = hits.select("id", "form", "strong", F.explode("chains").alias("chain"))
    per = each.where("length(form) >= 2 or strong").groupBy("id", "chain").agg(F.count_if("strong").alias("strong"), F.count_if(~F.col("strong")).alias("weak"))
    ok = per.where((F.col("strong") > 0) | (F.col("weak") >= weak_needed))
    return ok.groupBy("id").agg(F.max_by("chain", F.struct(F.col("strong") + F.col("weak"), "chain")).alias("chain"), F.max("strong").alias("strong"), F.max("weak").alias("weak"))


def restore(text: str, chains: dict[str, list[str]], originals: dict[str, str], odder: bool = False) -> tuple[str, bool]:
    """(text as it was written, whether all of it could be restored).

    Each chain, the likeliest first, is undone on every stretch of the text that holds one of its forms, where that works and gives back the
    stretch when applied again; what is left is replaced unit by unit with the original in the table, where one of the chains makes the stored form of it.
    A form within another word is no unit and stays. odder: also where the result looks less like text.
    """
    for name, forms_ in chains.items():
        chain, known = tuple(name.split(">")), set(forms_)

        def whole(m: re.Match, chain: tuple[str, ...] = chain, known: set[str] = known) -> str:
            own = [t for t in _SPLIT.split(m[0]) if not t.isascii()]
            return _undo(m[0], chain, odder) if sum(t in known for t in own) > 0.6 * len(own) else m[0]

        text = _LINE.sub(whole, text)  # a line most of whose words are such forms went this way as a whole
        text = _stretch(chain).sub(lambda m, c=chain, fs=forms_: _undo(m[0], c, odder) if any(f in m[0] for f in fs) else m[0], text)
    if originals:
        names = [tuple(n.split(">")) for n in chains]
        sure = {f: o for f, o in originals.items() if f in text and any(f in _variants(o, c) for c in names)}
        text = _UNIT.sub(lambda m: sure.get(m[0]) or _tiled(m[0], sure), text)
    left = originals and any(t in originals or any(t[i : i + n] in originals for n in (2, 3) for i in range(len(t) - n + 1) if _WIDE_RUN.fullmatch(t)) for t in _SPLIT.split(text) if t and not t.isascii())
    return text, not left and "�" not in text and not any(unicodedata.category(c) == "Cc" and c > "\x7f" for c in text)


_UNIT = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _variants(original: str, chain: tuple[str, ...]) -> set[str]:
    """What the chain makes of a text, whatever becomes of undefined bytes, in any case."""
    made = {g for u in UNDEFINED for k in (0, 1) if (g := garble(original, chain, u, k))}
    return {v for g in made for x in (g, g.strip("�")) for v in (x, x.lower(), x.upper())}


def _tiled(run: str, sure: dict[str, str]) -> str:
    """A run of Han or kana that consists of known forms from end to end becomes their originals; any other stays as it is."""
    if not sure or not _WIDE_RUN.fullmatch(run):
        return run
    out, i = [], 0
    while i < len(run):
        n = next((n for n in (3, 2) if run[i : i + n] in sure and i + n <= len(run)), 0)
        if not n:
            return run
        out.append(sure[run[i : i + n]])
        i += n
    return "".join(out)


_LINE = re.compile(r"[^\x00-\x1f]*[^\x00-\x7f][^\x00-\x1f]*")


@lru_cache(maxsize=256)
def _stretch(chain: tuple[str, ...]) -> re.Pattern:
    return re.compile(r"[^\x00-\x1f]*[^\x00-\x7f][^\x00-\x1f]*") if chain[-1] not in _ONE_BYTE or chain[0] in _WIDE else re.compile(r"[^\x00-\x7f]+")


def _undo(s: str, chain: tuple[str, ...], odder: bool = False) -> str:
    got = s
    if "�" in s:
        return s
    for i in range(len(chain) - 1, 0, -2):
        try:
            got = _write(got, chain[i]).decode(chain[i - 1])
        except (UnicodeEncodeError, UnicodeDecodeError):
            return s
    back = garble(got, chain)
    return got if back == s and (odder or oddness(got) <= oddness(s)) else s


def restored_records(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, restored_text, complete) of the garbled records; complete is false where something couldn't be restored."""
    hits = materialize(garbled_units(rows, id_col, text_col), "garbled_units")
    bad = garbled_records(rows, id_col, text_col, hits=hits).select("id")
    per = hits.groupBy("id").agg(F.collect_list(F.struct("form", "original", "chains", "strong")).alias("h"))
    src = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).where("t is not null").dropDuplicates(["id"])
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, h in zip(b["id"], b["t"], b["h"], strict=True):
                votes: dict[str, int] = {}
                per: dict[str, list[str]] = {}
                for x in h:
                    for c in x["chains"]:
                        votes[c] = votes.get(c, 0) + len(x["form"]) * (2 if x["strong"] else 1)
                        per.setdefault(c, []).append(x["form"])
                order = sorted(votes, key=lambda c: (-votes[c] * (1.5 if c.count(">") > 1 else 1), c))  # what was misread twice also has forms of once
                proven = {c for x in h if x["strong"] for c in x["chains"]}  # weak forms are replaced only where strong ones show their chain
                out.append((i, *restore(t, {c: per[c] for c in order}, {x["form"]: x["original"] for x in h if x["original"] is not None and (x["strong"] or proven & set(x["chains"]))})))
            yield pd.DataFrame(out, columns=["id", "restored_text", "complete"])

    return src.join(bad, "id").join(per, "id").mapInPandas(run, f"id {id_type}, restored_text string, complete boolean")
