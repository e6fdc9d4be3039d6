"""Languages of documents and of their stretches, by character language models.

One interpolated Kneser-Ney model per language over the characters of a word and its edges. The n-grams of all models stand in one sorted
hash array per order, with a column for each language. A word's log-probabilities don't depend on its neighbours, so each distinct word is
scored once per task and texts become sums of rows. A stretch gets the language of lowest length-normalised cross-entropy; its
confidence is calibrated on texts held out in training, and what no model explains is rejected.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslathe.llm.words import HAN_KANA

ORDER = 5
#: Training rows: at most so many labelled samples and documents per language.
MAX_SAMPLES, MAX_DOCUMENTS = 2_000, 60
#: Words that make a stretch a passage of its own; Han and kana count by character.
MIN_WORDS, MIN_WORDS_HAN = 12, 24
_CACHE_WORDS = 500_000
_TOKEN = re.compile(f"[{HAN_KANA}]+|[^\\W_{HAN_KANA}]+|[.!?。！？…\\n\\r\x0b\x0c\x85\u2028\u2029]+")
_BREAK = re.compile("[.!?。！？…\\s]")
_HAN = re.compile(f"[{HAN_KANA}]")

#: Other spellings of the nine languages' labels, and labels that name none.
NAMES = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french", "es": "es spa spanish castilian", "pt": "pt por portuguese",
    "it": "it ita italian", "ru": "ru rus russian", "zh": "zh zho chi cmn chinese mandarin", "ja": "ja jpn japanese",
}
NO_LABEL = {"", "und", "unknown", "n/a", "na", "xx", "none", "null", "mis", "mul", "zxx"}
_CODE = {n: c for c, ns in NAMES.items() for n in ns.split()}


def label_code(label: str | None) -> str | None:
    """The two-letter code of a label in any spelling, the label itself if the language is another, None if it names none."""
    s = (label or "").strip().lower()
    if s in NO_LABEL:
        return None
    head = re.split(r"[-_ (]", s)[0]
    return None if head in NO_LABEL else _CODE.get(s) or _CODE.get(head) or head


def tokens(text: str) -> list[str]:
    """Words, runs of Han or kana, and breaks between sentences, in lower case."""
    return _TOKEN.findall(text.lower())


_MULT = 0x100000001B3


def _gram(cs: list[int]) -> int:
    h = len(cs)
    for c in cs:
        h = (h * _MULT + c + 1) & 0x7FFFFFFFFFFFFFFF
    return h


@dataclass
class Model:
    """Sorted hashes per order; alpha (discounted relative frequency) by n-gram, gamma (mass left for shorter ones) by context."""

    languages: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    alpha: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    gamma: list[np.ndarray] = field(default_factory=list)
    floor: float = 1e-5
    sharpness: float = 8.0
    reject: np.ndarray | None = None

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probabilities by word and language, characters that were scored)."""
        lens = np.array([len(w) + 1 for w in words], np.int64)
        flat = np.fromiter((ord(c) for w in words for c in f" {w} "), np.int64)
        starts = np.cumsum(lens + 1) - (lens + 1)
        place = np.arange(len(flat)) - np.repeat(starts, lens + 1)
        keep = place > 0
        with np.errstate(over="ignore"):
            prob = np.full((int(keep.sum()), len(self.languages)), self.floor)
            at = np.flatnonzero(keep)
            for n in range(1, ORDER + 1):
                ok = place[at] >= n - 1
                i = at[ok]
                h = np.full(len(i), n, np.int64)
                ctx = np.full(len(i), n - 1, np.int64)
                for j in range(n - 1, -1, -1):
                    c = flat[i - j]
                    h = (h * _MULT + c + 1) & 0x7FFFFFFFFFFFFFFF
                    if j:
                        ctx = (ctx * _MULT + c + 1) & 0x7FFFFFFFFFFFFFFF
                a, g = _rows(self.grams[n - 1], self.alpha[n - 1], h, 0.0), _rows(self.contexts[n - 1], self.gamma[n - 1], ctx, 1.0)
                prob[ok] = a + g * prob[ok]
        logs = np.log(prob)
        first = np.cumsum(lens) - lens
        return np.add.reduceat(logs, first, axis=0) if len(first) else logs, lens


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), missing)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[i] == wanted)[:, None], values[i], missing)


def _letters(text: str) -> Iterator[str]:
    return (t for t in tokens(text) if not t.isdigit() and not _BREAK.match(t))


def train(samples: list[tuple[str, str]], calibrate: bool = True) -> Model:
    """Models of (language, text) pairs; every fifth text of a language is held out to calibrate confidence and rejection, then all are used."""
    langs = sorted({lang for lang, _ in samples})
    if not langs:
        raise ValueError("no training texts")
    if calibrate:
        seen: Counter = Counter()
        fit, held = [], []
        for lang, text in samples:
            seen[lang] += 1
            (held if seen[lang] % 5 == 0 else fit).append((lang, text))
        probe = train(fit if {x for x, _ in fit} == set(langs) else samples, calibrate=False)
    counts = [[Counter() for _ in range(ORDER)] for _ in langs]
    for lang, text in samples:
        per = counts[langs.index(lang)]
        for w, n in Counter(_letters(text)).items():
            for o, hs in enumerate(_hashed(w)):
                for pair in hs:
                    per[o][pair] += n
    m = Model(langs)
    chars = {h for per in counts for (_, h, _) in per[0]}
    m.floor = 1.0 / (20 * max(len(chars), 50))
    for o in range(ORDER):
        alpha: dict[int, dict[int, float]] = defaultdict(dict)
        gamma: dict[int, dict[int, float]] = defaultdict(dict)
        for k, per in enumerate(counts):
            if o < ORDER - 1:  # how many different characters it continues
                longer: Counter = Counter(x for _, _, x in {(h, c, s) for (c, h, s) in per[o + 1]})
                num = {g: (c, longer.get(g, n)) for (c, g, _), n in per[o].items()}
            else:
                num = {g: (c, n) for (c, g, _), n in per[o].items()}
            ones = sum(1 for _, v in num.values() if v == 1)
            twos = sum(1 for _, v in num.values() if v == 2)
            d = min(0.9, max(0.3, ones / (ones + 2 * twos))) if ones else 0.5
            total: Counter = Counter()
            kinds: Counter = Counter()
            for c, v in num.values():
                total[c] += v
                kinds[c] += 1
            for g, (c, v) in num.items():
                alpha[g][k] = max(v - d, 0) / total[c]
            for c, t in total.items():
                gamma[c][k] = d * kinds[c] / t
        for src, keys, vals, missing in ((alpha, m.grams, m.alpha, 0.0), (gamma, m.contexts, m.gamma, 1.0)):
            ks = np.array(sorted(src), np.int64)
            tab = np.full((len(ks), len(langs)), missing, np.float32)
            for r, x in enumerate(ks.tolist()):
                for k, v in src[x].items():
                    tab[r, k] = v
            keys.append(ks)
            vals.append(tab)
    if calibrate:
        m.sharpness, m.reject = _calibrate(probe, held or samples)
    return m


def _hashed(word: str) -> list[list[tuple[int, int, int]]]:
    """Per order the (context, n-gram, n-gram without its first character) of each place in the word."""
    chars = [ord(c) for c in f" {word} "]
    out = []
    for n in range(1, ORDER + 1):
        out.append([(_gram(chars[i - n + 1 : i]), _gram(chars[i - n + 1 : i + 1]), _gram(chars[i - n + 2 : i + 1])) for i in range(max(1, n - 1), len(chars))])
    return out


def _calibrate(m: Model, held: list[tuple[str, str]]) -> tuple[float, np.ndarray]:
    """The sharpness that gives held-out texts their likeliest confidences; per language the cross-entropy beyond which a text is rejected."""
    margins, right, own = [], [], defaultdict(list)
    for lang, text in held:
        ws = list(_letters(text))
        if not ws:
            continue
        s, n = m.score(ws)
        ce = -s.sum(0) / n.sum()
        order = np.argsort(ce)
        margins.append((ce[order[1]] - ce[order[0]]) * np.sqrt(n.sum()) if len(order) > 1 else 9.0)
        right.append(m.languages[order[0]] == lang)
        own[lang].append(float(ce[m.languages.index(lang)]))
    grid = np.array([0.5, 1, 2, 4, 8, 16])
    mg, rt = np.array(margins or [1.0]), np.array(right or [True])
    loss = [-np.where(rt, np.log(_sigmoid(a * mg)), np.log1p(-np.minimum(_sigmoid(a * mg), 1 - 1e-9))).mean() for a in grid]
    limit = np.array([(np.mean(own[x]) + max(1.5, 5 * np.std(own[x]))) if own[x] else 8.0 for x in m.languages])
    return float(min(grid[int(np.argmin(loss))], 4.0)), limit


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Languages of the stretches of many texts at once."""

    def __init__(self, model: Model, min_words: int = MIN_WORDS, min_words_han: int = MIN_WORDS_HAN) -> None:
        self.m, self.min_words, self.min_words_han = model, min_words, min_words_han
        self._reset()

    def _reset(self) -> None:
        k = len(self.m.languages)
        self.ids: dict[str, int] = {}
        self.scores = np.zeros((1024, k), np.float32)
        self.info = np.zeros((1024, 3), np.int32)  # scored characters, words, break

    def _number(self, flat: list[str]) -> np.ndarray:
        if len(self.ids) > _CACHE_WORDS:
            self._reset()
        ids = self.ids
        new = {t for t in set(flat) if t not in ids}
        if new:
            fresh = sorted(new)
            for t in fresh:
                ids[t] = len(ids)
            while len(self.scores) < len(ids):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.info = np.concatenate([self.info, np.zeros_like(self.info)])
            real = []
            for t in fresh:
                if t == "\x00" or _BREAK.match(t):
                    self.info[ids[t]] = (0, 0, 1)
                else:
                    self.info[ids[t]] = (0, len(t) if _HAN.match(t) else 1, 0)
                    if not t.isdigit():
                        real.append(t)
            for at in range(0, len(real), 20_000):
                part = real[at : at + 20_000]
                s, n = self.m.score(part)
                where = [ids[t] for t in part]
                self.scores[where] = s
                self.info[where, 0] = n
        return np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))

    def stretches(self, texts: list[str | None]) -> list[list[tuple[int, int, str | None, float]]]:
        """Per text its stretches (first word, words, language or None, confidence), sentences of one language joined."""
        flat: list[str] = []
        for t in texts:
            flat.append("\x00")
            if t:
                flat += tokens(t)
        if not flat:
            return []
        # in pieces, so that no batch of long texts needs much memory at once
        i = self._number(flat)
        info = self.info[i]
        starts = np.flatnonzero(info[:, 2])  # a text begins with a break
        langs = self.m.languages
        sums = np.empty((len(starts), len(langs)))
        bounds = np.append(starts, len(i))
        step = max(1, len(starts) // max(1, len(i) // 1_000_000))
        for a in range(0, len(starts), step):
            b = min(len(starts), a + step)
            sums[a:b] = np.add.reduceat(self.scores[i[bounds[a] : bounds[b]]], starts[a:b] - bounds[a], axis=0)
        chars = np.add.reduceat(info[:, 0], starts)
        words = np.add.reduceat(info[:, 1], starts)
        n = np.maximum(chars, 1)
        ce = -sums / n[:, None]
        best = ce.argmin(1)
        two = np.partition(ce, 1, axis=1) if len(langs) > 1 else np.concatenate([ce, ce + 9], axis=1)
        conf = _sigmoid(self.m.sharpness * (two[:, 1] - two[:, 0]) * np.sqrt(n))
        lost = (ce.min(1) > self.m.reject[best]) if self.m.reject is not None else np.zeros(len(best), bool)
        sure = (chars > 0) & (conf >= 0.7) & ~lost
        zero = self.ids["\x00"]
        first = np.flatnonzero(i[starts] == zero)
        ends = np.append(first[1:], len(starts))
        out = []
        for a, b in zip(first.tolist(), ends.tolist(), strict=True):
            out.append(self._join(best[a:b], conf[a:b], sure[a:b], words[a:b], sums[a:b], chars[a:b]))
        return out

    def _join(self, best, conf, sure, words, sums, chars) -> list[tuple[int, int, str | None, float]]:
        langs = self.m.languages
        if not sure.any():
            total, n = int(words.sum()), int(chars.sum())
            if not n:  # no letters
                return []
            ce = -sums.sum(0) / n
            k = int(ce.argmin())
            if self.m.reject is not None and ce[k] > self.m.reject[k]:
                return [(0, total, None, 0.0)]
            gap = float(np.partition(ce, 1)[1] - ce[k]) if len(langs) > 1 else 9.0
            return [(0, total, langs[k], float(_sigmoid(self.m.sharpness * gap * np.sqrt(n))))]
        kinds = np.unique(best[sure])
        if len(kinds) == 1:
            w = np.maximum(words[sure], 1)
            return [(0, int(words.sum()), langs[int(kinds[0])], float((conf[sure] * w).sum() / w.sum()))]
        out: list[list] = []
        at = 0
        for k, c, s, w in zip(best.tolist(), conf.tolist(), sure.tolist(), words.tolist(), strict=True):
            if out and (not s or out[-1][2] == k or out[-1][2] is None):
                last = out[-1]
                last[1] += w
                if s:
                    if last[2] is None:
                        last[2] = k
                    last[3] += c * w
                    last[4] += w
            elif w or s:
                out.append([at, w, k if s else None, c * w if s else 0.0, w if s else 0])
            at += w
        return [(a, w, None if k is None else langs[k], cw / max(sw, 1)) for a, w, k, cw, sw in out]

    def languages(self, stretches: list[tuple[int, int, str | None, float]]) -> dict[str, float]:
        """The languages a text holds, with confidence: its main one first, then any with a stretch of enough words."""
        weight: Counter = Counter()
        conf: dict[str, float] = {}
        long: dict[str, float] = {}
        for _, w, lang, c in stretches:
            if lang is None:
                continue
            han = lang in ("zh", "ja")
            weight[lang] += max(w, 1) * (0.5 if han else 1.0)
            conf[lang] = max(conf.get(lang, 0.0), c)
            if w >= (self.min_words_han if han else self.min_words):
                long[lang] = max(long.get(lang, 0.0), c)
        if not weight:
            return {}
        main = max(weight, key=lambda x: (weight[x], x))
        return {main: conf[main]} | {x: c for x, c in sorted(long.items()) if x != main}


def training_texts(samples: DataFrame, documents: DataFrame | None = None, id_col: str = "doc_id", max_samples: int = MAX_SAMPLES, max_documents: int = MAX_DOCUMENTS) -> list[tuple[str, str]]:
    """A bounded sample of labelled texts: per language the first samples by a hash, and of labelled documents those on which a first model agrees.

    Documents have wrong labels; one is used only if all of it is, to the model of the samples, in its label's language.
    """
    own = [(c, r["t"]) for r in _first(samples, "lang", "text", max_samples).orderBy("lang", "t").collect() if (c := label_code(r["lang"]))]
    if documents is None or not max_documents:
        return own
    first = Labeller(train(own))
    codes = {x for x, _ in own}
    # keys alone are ranked; the few chosen ones then bring their texts
    spellings = F.create_map(*(F.lit(x) for kv in _CODE.items() for x in kv))
    ids = documents.select(F.col(id_col).alias("d"), F.element_at(spellings, F.lower(F.trim("lang"))).alias("lang")).where("lang is not null and d is not null")
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("d"), "d"))).where(F.col("r") <= 2 * max_documents).select("d", "lang")
    picked = documents.select(F.col(id_col).alias("d"), F.col("text").alias("t")).join(F.broadcast(ids), "d").where("length(t) between 200 and 4000").select("lang", "t")
    rows = [(r["lang"], r["t"]) for r in picked.orderBy("lang", "t").collect() if r["lang"] in codes]
    out, left = list(own), Counter({c: max_documents for c in codes})
    for (c, t), st in zip(rows, first.stretches([t for _, t in rows]), strict=True):
        if left[c] > 0 and {x[2] for x in st} == {c}:
            out.append((c, t))
            left[c] -= 1
    return out


def _first(rows: DataFrame, lang: str, text: str, n: int) -> DataFrame:
    by = Window.partitionBy("lang").orderBy(F.xxhash64("t"), "t")
    some = rows.select(F.col(lang).alias("lang"), F.col(text).alias("t")).where("t is not null and lang is not null")
    return some.withColumn("r", F.row_number().over(by)).where(F.col("r") <= n).drop("r")


def document_stretches(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_words_han: int = MIN_WORDS_HAN) -> DataFrame:
    """(doc_id, stretch, first_word, n_words, lang, confidence): the stretches of each document in one language; lang is null where rejected."""
    id_type = documents.schema[id_col].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lab = Labeller(model, min_words, min_words_han)
        for b in batches:
            rows = [(d, k, *s) for d, ss in zip(b["d"], lab.stretches(b["t"].tolist()), strict=True) for k, s in enumerate(ss)]
            yield pd.DataFrame(rows, columns=["doc_id", "stretch", "first_word", "n_words", "lang", "confidence"])

    src = documents.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).cast("string").alias("t"))
    out = src.mapInPandas(run, "doc_id string, stretch int, first_word bigint, n_words bigint, lang string, confidence double")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))


def document_languages(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", min_words: int = MIN_WORDS, min_words_han: int = MIN_WORDS_HAN) -> DataFrame:
    """One row per document and language it holds: doc_id, lang, confidence, main, labelled (its label names this language).

    A document holds its main language and any other with a stretch of at least min_words words (min_words_han characters for zh, ja).
    Null, empty and letterless texts hold none and have no row. Repeated and null ids are separate documents. Texts are used whole.
    Of languages with equally many words the later in the alphabet is the main one.
    """
    id_type = documents.schema[id_col].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lab = Labeller(model, min_words, min_words_han)
        for b in batches:
            rows = []
            for d, label, st in zip(b["d"], b["l"], lab.stretches(b["t"].tolist()), strict=True):
                held = lab.languages(st)
                named = label_code(label) if held else None
                rows += [(d, x, c, k == 0, x == named) for k, (x, c) in enumerate(held.items())]
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "confidence", "main", "labelled"])

    src = documents.select(F.col(id_col).cast("string").alias("d"), F.col(label_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t"))
    out = src.mapInPandas(run, "doc_id string, lang string, confidence double, main boolean, labelled boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
