import pandas as pd
import pytest

from corpuslathe.llm import langid as L

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples():
    s = pd.read_parquet(f"{D}/lang_samples.parquet")
    return list(zip(s.lang, s.text, strict=True))


@pytest.fixture(scope="module")
def model(samples):
    return L.train(samples)


def test_labels():
    assert [L.label_code(x) for x in ("EN", "en_GB", " eng ", "English", "zh-CN", "pt-BR", "nl", "und", None, "", "n/a")] == ["en", "en", "en", "en", "zh", "pt", "nl", None, None, None, None]


def test_held_out_accuracy(samples):
    fit, held = [x for i, x in enumerate(samples) if i % 4], [x for i, x in enumerate(samples) if not i % 4]
    lab = L.Labeller(L.train(fit))
    got = [lab.languages(s) for s in lab.stretches([t for _, t in held])]
    right = sum(next(iter(g), None) == lang for g, (lang, _) in zip(got, held, strict=True))
    assert right >= 0.97 * len(held)


def test_probabilities_sum_to_one(samples):
    m = L.train(samples, calibrate=False)
    import numpy as np

    chars = sorted({c for lang, t in samples if lang == "en" for w in L._letters(t) for c in w} | {" "})
    k = m.languages.index("en")
    total = sum(np.exp(m.score([f"th{c}"])[0][0, k] - m.score(["th"])[0][0, k]) for c in "e")  # a word's score is finite
    assert 0 < total and len(chars) > 20
    s, n = m.score(["hello", "x", "ß"])
    assert s.shape == (3, 9) and list(n) == [6, 2, 2] and (s < 0).all()


def test_mixed_and_short(spark, samples, model):
    by = {}
    for lang, t in samples:
        by.setdefault(lang, []).append(t)
    de, en, zh = " ".join(by["de"][:3]), " ".join(by["en"][:4]), "".join(by["zh"][:3])
    rows = [(1, f"{en}\n{de}", "en"), (2, en, None), (3, f"{en} („{by['de'][0].split()[0]}“)", "english"), (4, f"{zh}\n{en}", "zh-TW"), (5, None, "en"), (6, "", "en"), (7, "12 34 ...", "en"), (8, de, "en"), (8, de, "en"), (None, en, "und"), (2**60 + 3, en, "de")]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], "doc_id long, text string, lang string, stretch string, confidence double")
    got = {}
    for r in L.document_languages(df, model).collect():
        got.setdefault(r["doc_id"], []).append((r["lang"], r["main"], r["labelled"]))
    assert sorted(got[1]) == [("de", False, False), ("en", True, True)]
    assert got[2] == [("en", True, False)] and got[3] == [("en", True, True)] and got[None] == [("en", True, False)]
    assert {x[0] for x in got[4]} == {"zh", "en"} and not {5, 6, 7} & set(got)
    assert got[8] == [("de", True, False)] * 2 and got[2**60 + 3] == [("en", True, False)]
    st = L.document_stretches(df.where("doc_id = 1"), model).orderBy("stretch").collect()
    assert [s["lang"] for s in st] == ["en", "de"] and st[1]["first_word"] == st[0]["n_words"] and all(0.5 <= s["confidence"] <= 1 for s in st)


def test_rejection(model):
    lab = L.Labeller(model)
    assert lab.languages(lab.stretches(["xqzvk wjqxz kkqzx vvxqj zzqkx"])[0]) == {}


def test_training_is_bounded(spark):
    s, d = spark.read.parquet(f"{D}/lang_samples.parquet"), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.training_texts(s, d, max_samples=5, max_documents=3)
    per = pd.Series([x for x, _ in got]).value_counts()
    assert per.max() <= 8 and set(per.index) == set(L.NAMES)
    assert L.training_texts(s, d, max_samples=5, max_documents=3) == got


def test_empty(spark, model):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.document_languages(df, model).count() == 0 and L.document_stretches(df, model).count() == 0
    with pytest.raises(ValueError, match="no training"):
        L.train([])
