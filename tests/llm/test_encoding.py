import pytest

from corpuslathe.llm import encoding as E

CLEAN = [
    "her fiancé’s coat and the café’s “last call” sign", "Señora Ibarell’s piñata costs €4", "ten ½-litre jars, 2 × 3 m mural at 5 °C", "die Dämmerung färbt alles blau über der Brücke", "la câmera não se move, três respirações",
    "Камера плавно скользит влево, фокус уходит на задний план", "Пыль кружится в луче, кадр слегка дрожит", "镜头缓缓向左滑动，暮色把一切染蓝。", "烛火随风摇曳，画面轻微晃动，硬切到室外。", "夕暮れがすべてを青く染める、やかんが鳴る。",
]


def corpus(spark, extra):
    rows = [(f"c{k}-{i}", t, 1, True) for k in range(5) for i, t in enumerate(CLEAN)] + [(i, t, 2, False) for i, t in extra]
    return spark.createDataFrame(rows, "id string, text string, unit int, probe boolean")


GARBLED = {
    "latin": CLEAN[0].encode().decode("latin-1"), "cp1252": "Cut to the " + E.garble(CLEAN[1], ("utf-8", "cp1252")), "twice": E.garble("ten ½-litre jars", ("utf-8", "cp1252", "utf-8", "cp1252")), "mac": "x " + CLEAN[3].encode("cp1252").decode("mac-roman"),
    "dos": CLEAN[3].encode().decode("cp437"), "koi": CLEAN[5].encode("koi8-r").decode("cp1251"), "cyr": CLEAN[6].encode("cp1251").decode("latin-1"), "utf-cyr": CLEAN[6].encode().decode("cp1251", "replace"), "gbk": CLEAN[7].encode().decode("gbk", "replace"), "gb-latin": CLEAN[8].encode("gbk").decode("latin-1"),
    "sjis": CLEAN[9].encode("cp932").decode("latin-1"), "lost": CLEAN[3].encode("latin-1").decode("utf-8", "replace"), "part": "Keep it. " + "a 2 × 3 m mural".encode().decode("cp1252") + " stays",
}
SOUND = {"caps": "ELE NÃO É", "nbsp": "\xa0plain text", "nbsp-ru": "\xa0Кадр слегка дрожит", "nbsp-q": "\xa0“last call”", "quote": "Amanhã” e “lã”", "price": "a €4 stub at 5 °C", "ru": "НЕ ОН", "none": None, "empty": "", "ascii": "plain", "zh": "暮色里，烛火摇曳", "odd": "naïve Ångström Øre"}


def test_found(spark):
    got = {r["id"] for r in E.garbled_records(corpus(spark, [*GARBLED.items(), *SOUND.items(), (None, GARBLED["latin"]), ("latin", GARBLED["latin"])]), "id", "text").collect()}
    assert got == set(GARBLED)


@pytest.mark.parametrize("name", ["latin", "cp1252", "koi", "cyr", "gb-latin", "part", "mac"])
def test_restored(spark, name):
    want = {"latin": CLEAN[0], "cp1252": "Cut to the " + CLEAN[1], "koi": CLEAN[5], "cyr": CLEAN[6], "gb-latin": CLEAN[8], "part": "Keep it. a 2 × 3 m mural stays", "mac": "x " + CLEAN[3]}[name]
    r = E.restored_records(corpus(spark, [(name, GARBLED[name])]), "id", "text").where(f"id = '{name}'").first()
    assert (r["restored_text"], r["complete"]) == (want, True)


def test_unrecoverable(spark):
    r = {x["id"]: x for x in E.restored_records(corpus(spark, [("lost", GARBLED["lost"]), ("gone", "Qv�xq färbt")]), "id", "text").collect()}
    assert (r["lost"]["restored_text"], r["lost"]["complete"]) == (CLEAN[3], True)  # its words are known
    assert (r["gone"]["restored_text"], r["gone"]["complete"]) == ("Qv�xq färbt", False)


def test_empty(spark):
    assert E.garbled_records(corpus(spark, []).limit(0), "id", "text").count() == 0


def test_long_text(spark):
    long = " ".join([CLEAN[1]] * 4000) + " " + GARBLED["cp1252"]
    assert "long" in {r["id"] for r in E.garbled_records(corpus(spark, [("long", long)]), "id", "text").collect()}


@pytest.mark.parametrize(("k", "chain"), [(6, ("utf-8", "cp1251")), (5, ("koi8-r", "cp1251")), (8, ("gbk", "big5")), (4, ("cp1252", "mac-roman"))])
def test_many_garbled_copies(spark, k, chain):
    want = CLEAN[k] + " Пыль, луч и кадр." * (k in (5, 6))
    rows = [("sound", want)] + [(f"copy{i}", E.garble(f"{want} take {i}", chain)) for i in range(40)] + [(f"other{i}", E.garble(f"{want} {chr(97 + i)}{chr(98 + i)}", chain)) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {r["id"]: r["restored_text"] for r in E.restored_records(df, "id", "text").collect()}
    assert set(got) == {i for i, _ in rows[1:]}
    assert got["copy7"] == f"{want} take 7" and got["other3"] == f"{want} de"


def test_undone_in_part():
    words = "УЛПМШЪЙФ ЧМЕЧП УФПТПЦ РХУФПН ВБМШОПН"
    assert E.undone(f"{CLEAN[5]}. {CLEAN[6]}. Камера плавно {words}", "koi8-r>cp1251", words.split(), False) is not False
    assert E.undone(CLEAN[5], "cp1251>koi8-r", CLEAN[5].replace(",", "").split(), False) is False


def test_only_whole_units_are_replaced_and_checked():
    assert E.restore("Котик и Кот", {}, {"Кот": "abc"}) == ("Котик и Кот", False)
    g = "Кот".encode("utf-8").decode("cp1251")
    chain = {"utf-8>cp1251": [g]}
    assert E.restore(f"{g} и {g}ик", {}, {g: "Кот"})[1] is False
    text, done = E.restore(f"a {g}, b", chain, {g: "Кот"})
    assert (text, done) == ("a Кот, b", True)
    assert E.restore("a абв b", chain, {"абв": "Кот"}) == ("a абв b", False)  # no chain makes this of it


def test_long_words_make_forms(spark):
    word = "Donaudampfschifffahrtsgesellschaftskapitänsmütze"
    assert len(word) > 45 and word in E.units(f"x {word} y")[0]
    g = word.encode("utf-8").decode("cp1252")
    rows = [(f"c{i}", f"Der {word} {i} ist da und {'abc'[i % 3]}") for i in range(6)] + [("bad", f"Der {g} ist hier")]
    df = spark.createDataFrame(rows, "id string, text string")
    assert [tuple(r) for r in E.restored_records(df, "id", "text").collect()] == [("bad", f"Der {word} ist hier", True)]
    two = "鏡頭" * 30
    assert len(two) > 40 and two not in E.units(two)[0] and "鏡頭" in E.units(two)[0]
