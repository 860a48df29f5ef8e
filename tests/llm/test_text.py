"""Encoding, look-alike, splitting and scan operators on small rows and odd ones."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silkmill.llm.batches import run_of_texts
from silkmill.llm.charmodel import CharModel
from silkmill.llm.lookalikes import find_lookalikes, quick_form
from silkmill.llm.mojibake import Restorer, all_chains, find_garbled, fit_restorer, garble
from silkmill.llm.scanned import Repairer, fit_lexicon, reflow, repair_scans, shared_titles, titles_by_book, word_vectors
from silkmill.llm.splitting import body_pattern, pieces, read_limits, split_texts
from silkmill.llm.tokens import texts_of, word_hash

ROW = "field string, row_id long, text string"
ZH = ["护理人员应观察视物模糊的变化，并及时口服抗生素。", "老年慢性胃炎起病隐匿，皮肤瘙痒往往不明显，容易漏诊。", "实验室检查：血钾3.1mmol/L，白细胞计数正常，符合糖尿病表现。", "体重指数大于29kg/m²者发生冠状动脉狭窄的风险较高。"]
LATIN = ["La température était de 36.5 °C, ce qui évoque l’hypertension artérielle.", "Der Patient klagte über Rückenschmerzen und “naïve” Übelkeit.", "The patient’s dizziness – see “Ménière disease” – lasted 9 days."]


@pytest.fixture(scope="module")
def restorer(spark):
    rng = random.Random(1)
    clean = [" ".join(rng.sample(LATIN, 2)) for _ in range(60)] + ["".join(rng.sample(ZH, 3)) for _ in range(60)]
    return fit_restorer(spark.createDataFrame([(c + str(i),) for i, c in enumerate(clean)] + [(None,), ("",)], "clean_text string"), "clean_text")


@pytest.mark.parametrize("chain", [c.name for c in all_chains() if c.true in ("utf-8", "cp1252") or c.true == "gbk" and c.wrong in ("cp1252", "latin_1", "cp949", "big5")])
def test_each_chain_is_undone(restorer, chain):
    wrong, true = chain.split(">")
    tried = 0
    for text in LATIN if true == "cp1252" else [*ZH, *LATIN] if true == "utf-8" else ZH:
        bad = garble(text, chain)
        if bad is None or bad == text or (true == "cp1252" and wrong not in ("cp437", "cp850", "mac_roman")):
            continue
        if wrong in ("gb18030", "big5", "cp949", "cp932") and true == "utf-8" and text in LATIN:
            continue
        found = restorer.restore(bad)
        assert found is not None, (text, bad)
        tried += 1
        if wrong in ("cp1252", "latin_1") and true == "utf-8":
            assert found[0] == text
    assert tried or true == "cp1252" or wrong in ("gb18030", "big5", "cp949", "cp932")  # hardly any text survives these whole


OTHERS = {
    "big5": ["護理人員應觀察視物模糊的變化，並及時口服抗生素。", "老年慢性胃炎起病隱匿，皮膚瘙癢往往不明顯，容易漏診。"],
    "cp932": ["看護師は患者の血圧を毎日測定し、記録してください。", "高齢者の胃炎は症状が目立たないことが多い。"],
    "cp949": ["간호사는 환자의 혈압을 매일 측정하고 기록하십시오.", "노인의 위염은 증상이 뚜렷하지 않은 경우가 많다."],
    "cp1251": ["Медсестра должна ежедневно измерять давление больного.", "У пожилых людей гастрит часто протекает незаметно."],
    "koi8_r": ["Медсестра должна ежедневно измерять давление больного.", "У пожилых людей гастрит часто протекает незаметно."],
}


@pytest.fixture(scope="module")
def polyglot(spark):
    rng = random.Random(2)
    every = [t for texts in OTHERS.values() for t in texts]
    clean = ["".join(rng.sample(ZH, 3)) for _ in range(60)] + [" ".join(rng.sample(LATIN, 2)) for _ in range(40)] + [" ".join(rng.sample(every, 2)) for _ in range(200)]
    return fit_restorer(spark.createDataFrame([(c + str(i),) for i, c in enumerate(clean)], "clean_text string"), "clean_text")


@pytest.mark.parametrize("chain", [c.name for c in all_chains() if c.true in OTHERS])
def test_every_true_encoding(polyglot, chain):
    wrong, true = chain.split(">")
    for text in OTHERS[true]:
        assert polyglot.restore(text) is None
        bad = garble(text, chain)
        if bad is None or wrong in ("gbk", "big5", "cp949", "cp932"):
            continue  # hardly any text survives these whole
        found = polyglot.restore(bad)
        assert found is not None, (text, bad)
        if wrong in ("cp1252", "latin_1"):
            assert found[0].split() == text.split() or true in ("cp932", "cp949", "big5")
    if chain == "gbk>big5":
        assert polyglot.restore(garble("護理人員應觀察變化", "gbk>big5"))[0] == "護理人員應觀察變化"


def test_text_read_as_another_double_byte_encoding(restorer):
    survivors = [(t[:k], garble(t[:k], "gb18030>utf-8")) for t in ZH for k in range(4, 16)]
    survivors = [(t, bad) for t, bad in survivors if bad is not None and t.isalpha()]
    assert survivors and all(restorer.restore(bad) is not None for _, bad in survivors)


def test_garbled_twice_in_part_and_lost(restorer):
    twice = garble(garble(LATIN[0], "cp1252>utf-8"), "cp1252>utf-8")
    assert restorer.restore(twice)[0] == LATIN[0]
    part = ZH[0][:10] + garble(ZH[1], "latin_1>utf-8")
    assert restorer.restore(part)[0] == ZH[0][:10] + ZH[1]
    high = [bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in range(256)]
    alone = ZH[0] + "29kg/m²者，évoque."  # characters of four bytes among ASCII
    assert restorer.restore("".join(high[b] for b in alone.encode("gb18030")))[0] == alone
    for lost in ("the patient�s cough", "骨质疏松锟斤拷锟斤拷", "isnï¿½t"):
        assert restorer.restore(lost)[1].endswith("lost")
    for fine in [*ZH, *LATIN, "ATENÇÃO: NÃO", "（俄文原名：Болезнь）", "nоt сlear", "１２３", "a b", "Öffnung façade"]:
        assert restorer.restore(fine) is None, fine


def test_find_garbled_rows(spark, restorer):
    bad = garble(ZH[2], "cp1252>utf-8")
    rows = [("content", 1, bad), ("content", 1, bad), ("content", 2, None), ("content", 3, ""), (None, None, ZH[0]), ("page_content", 4, bad + "好" * 50_000), ("content", 5, "\0 ok")]
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "1 AS restored", "2 AS chains")
    got = sorted((r["row_id"], r["restored"][:20]) for r in find_garbled(df, restorer).collect())
    assert [g[0] for g in got] == [1, 1, 4] and got[0][1] == ZH[2][:20]
    assert find_garbled(df.where("false"), restorer).count() == 0
    nothing = fit_restorer(spark.createDataFrame([], "clean_text string"), "clean_text")
    assert find_garbled(df.where("row_id = 2"), nothing).count() == 0


def test_margin_from_whole_texts_of_all_held_out_records(spark, restorer):
    rng = random.Random(2)
    tail = " " + garble("x°9", "cp1252>utf-8")  # clean as stored, and beyond any prefix
    texts = [" ".join(rng.choice(LATIN) for _ in range(9)) + f" {i}" + tail * (i >= 400) for i in range(800)]
    rows = spark.createDataFrame([(t,) for t in texts], "clean_text string").withColumn("part", F.expr("pmod(xxhash64(clean_text), 5)"))
    plain, quoting = rows.where(f"NOT endswith(clean_text, '{tail}')"), rows.where(f"endswith(clean_text, '{tail}') AND part = 0")
    gain = max(float(g.max()) for _, _, g in fit_restorer(plain, "clean_text").proposals(tail))
    assert 9 < gain < 19
    fitted = fit_restorer(plain.union(quoting), "clean_text")
    assert fitted.margin > gain and fitted.restore(texts[0] + tail) is None
    assert fit_restorer(plain.union(quoting).repartition(9, "part"), "clean_text").margin == fitted.margin


CASES = {
    "对比８例": "对比8例", "nоt": "not", "a​b": "ab", "Méni": "Méni", "10 2 3 ": "10 2 3 ", "ﬁne": "fine", "⼼": "心", "mmοl/L": "mmol/L", "ΙgА与ΙgΜ": "IgA与IgM",
    "HbA1с": "HbA1c", "例外": "例外", "Ｈｉ": "Hi", "x﻿": "x",
}
FINE = ["α受体阻滞药", "Болезнь", "👨‍👩‍👧 ok", "x² m³", "，（）！", "Méni", "β", "TNFα", "", "naïve “x”", "ΑΒΓ", "①㎡"]


def test_lookalikes(spark):
    texts = [*CASES, *FINE, None, "好" * 200_000 + "８", "👨‍👩 a‍b"]
    df = spark.createDataFrame([("question", i, t) for i, t in enumerate(texts)] + [("question", 0, texts[0])], ROW).selectExpr("*", "'x' AS one_form", "'x' AS batch")
    got = {r["row_id"]: r["one_form"] for r in find_lookalikes(df).collect()}
    for i, (t, form) in enumerate(CASES.items()):
        assert unicodedata.normalize("NFC", got[i]) == form, (t, got[i])
        assert quick_form(t) == form
    for i, t in enumerate(FINE):
        assert len(CASES) + i not in got, t
        assert quick_form(t) == t
    n = len(CASES) + len(FINE)
    assert n not in got and got[n + 1].endswith("好8") and got[n + 2] == "👨‍👩 ab"
    assert find_lookalikes(df.where("false")).count() == 0
    assert find_lookalikes(df, lambda: (lambda f, t: "８" in t)).where(F.col("row_id") == 0).count() == 0
    assert find_lookalikes(df).where(F.col("row_id") == 0).count() == 2


def test_pieces(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab。，. \n字😀́") for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["", "x" * 1000, None, "字" * 30_000, "\n" * 200, "a" * 60, "a" * 61]
    df = spark.createDataFrame([("content", i, t) for i, t in enumerate(texts)] + [("other", 999, "z" * 999)], ROW).selectExpr("*", "0 AS pieces")
    got = {r["row_id"]: r["pieces"] for r in split_texts(df, {"content": (60, 7)}, only_oversized=False).collect()}
    over = {r["row_id"] for r in split_texts(df, {"content": (60, 7)}).collect()}
    for i, t in enumerate(texts):
        assert (i in over) == (t is not None and len(t) > 60)
        if not t:
            assert i not in got
            continue
        parts = got[i]
        assert all(len(p) <= 60 for p in parts)
        assert parts[0] + "".join(p[7:] for p in parts[1:]) == t
        assert all(parts[k][:7] == parts[k - 1][-7:] for k in range(1, len(parts)))
    assert split_texts(df.where("false"), {"content": (60, 7)}).count() == 0
    ends = spark.createDataFrame([("好。" * 40 + "\n\n" + "坏" * 90,)], "t string").select(pieces(F.col("t"), 100, 10).alias("p")).first()["p"]
    assert ends[0].endswith("\n\n")
    with pytest.raises(ValueError):
        body_pattern(10, 6)
    limits = spark.createDataFrame([("a", 5, 1), (None, 5, 1), ("b", None, 1)], "field string, max_chars int, overlap_chars int")
    assert read_limits(limits) == {"a": (5, 1)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab1 2é护理\n-O。", max_size=30)), max_size=6))
def test_tokens_by_hand(texts):
    points, starts, t = texts_of(pa.array(texts, pa.string()))
    whole = points.tobytes().decode("utf-32-le")
    got = [(int(r), whole[a:b]) for r, a, b in zip(t.row, t.start, t.end, strict=True)]
    want = [(i, w) for i, x in enumerate(texts) for w in re.findall(r"[A-Za-z0-9é]+|[^\sA-Za-z0-9é]", x or "")]
    assert got == want
    assert all(word_hash(w) == h for (_, w), h in zip(got, t.hash, strict=True))
    _, starts = run_of_texts(pa.array(texts, pa.string()))
    assert [int(b - a) for a, b in zip(starts, starts[1:], strict=False)] == [len(x or "") for x in texts]


@pytest.fixture(scope="module")
def scans(spark):
    rng = random.Random(3)
    sentence = ["体重指数大于{}kg者发生高血压的风险较高。", "本例因头痛入院{}天，诊断为糖尿病，给予卧床休息后好转。", "护理人员应观察大便干结的变化，并及时复查血常规。", "The patient has severe hypertension and takes vitamin tablets for {} days.", "Pre- and postoperative care differ, see the well-known history of {} cases."]
    texts = [("".join if i % 2 else " ".join)(rng.choice(sentence).format(rng.randint(2, 90)) for _ in range(6)) for i in range(400)]
    lexicon = fit_lexicon(spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string"))
    return lexicon, ["治疗原则", "Treatment"]


def test_repair(spark, scans):
    lexicon, titles = scans
    zh = "体重指数大于30kg者发生高血压的风险较高。本例因头痛入院5天，诊断为糖尿病，给予卧床休息后好转。"
    en = "The patient has severe hypertension and takes vitamin tablets for 7 days."
    noisy = {
        1: zh.replace("体重", "休重").replace("糖尿病", "糖尿痛"),
        2: en.replace("hypertension", "hyper-\ntension"),
        3: en.replace("hypertension", "hyper¬ tension"),
        4: zh[:10] + "\n治疗原则\n" + zh[10:],
        5: zh[:10] + "\n- 77 -\n" + zh[10:],
        6: zh[:10] + "\n77   治疗原则\n" + zh[10:],
        7: zh + "\n青岚手册",
        8: en.replace("severe", "sevcre").replace("tablets", "tab1ets"),
        9: "第77页 共900页\n" + zh,
        10: zh.replace("30kg", "3Okg").replace("体重", "休重"),
    }
    fine = {20: zh, 21: en, 22: zh.replace("体重", "休重"), 23: "1. " + zh + "\n2. " + zh, 24: "体温\n37.6\n脉搏\n74", 25: "Pre- and postoperative care differ, see the well-known history of 8 cases.", 26: None, 27: "", 28: "卧床休息，头痛。", 29: "见第12页的说明。", 30: zh * 800}
    rows = [("content", i, t, 77, "青岚手册") for i, t in {**noisy, **fine}.items()] + [("content", 1, noisy[1], 77, "青岚手册"), ("content", 31, zh, None, None)]
    df = spark.createDataFrame(rows, ROW + ", page int, book string").selectExpr("*", "0 AS near", "0 AS repaired")
    got = {r["row_id"]: r for r in repair_scans(df, lexicon, titles).collect()}
    assert sorted(got) == sorted(noisy), sorted(got)
    flat = lambda t: re.sub(r"\s", "", t)
    for i in (1, 4, 5, 6, 7, 9, 10):
        assert flat(got[i]["repaired"]) == flat(zh), (i, got[i])
    for i in (2, 3, 8):
        assert got[i]["repaired"] == en, (i, got[i])
    assert repair_scans(df, lexicon, titles).where("row_id = 1").count() == 2
    assert repair_scans(df.where("false"), lexicon, titles).count() == 0
    assert repair_scans(df, lexicon, [], lambda: (lambda f, t: True)).count() == 0
    empty = fit_lexicon(df.where("false").select("text"))
    assert repair_scans(df.where("row_id = 20"), empty, []).count() == 0


def test_furniture_in_other_forms(spark, scans):
    lexicon, _ = scans
    zh = "体重指数大于30kg者发生高血压的风险较高。本例因头痛入院5天，诊断为糖尿病，给予卧床休息后好转。"
    lines = {1: "\u2f64药须知", 2: "用\u200b药须知", 3: "青岚\ufeff手册", 4: "Lovor\xa0Guide", 5: "Lovor\nGuide", 6: "第\U0001d7d5\U0001d7d5页", 7: "- ７７ -", 8: "- \u0667\u0667 -", 9: "\U0002f828药须知"}
    rows = [("content", i, zh[:10] + "\n" + line + "\n" + zh[10:], 77, "青岚手册" if i == 3 else "Lovor Guide") for i, line in lines.items()]
    rows += [("content", 20, zh + "\u200b", 77, "青岚手册")]
    got = {r["row_id"]: r for r in repair_scans(spark.createDataFrame(rows, ROW + ", page int, book string"), lexicon, ["用药须知", "勺药须知"]).collect()}
    assert sorted(got) == sorted(lines)
    assert all(r["furniture"] == 1 and re.sub(r"\s", "", r["repaired"]) == zh for r in got.values())
    odd_name = spark.createDataFrame([("content", 1, zh[:10] + "\n青岚手册\n" + zh[10:], 77, "青岚\u200b手册")], ROW + ", page int, book string")
    assert repair_scans(odd_name, lexicon, []).count() == 1


def test_rare_chapter_names(spark, scans):
    lexicon, _ = scans
    zh = "体重指数大于30kg者发生高血压的风险较高。本例因头痛入院5天，诊断为糖尿病，给予卧床休息后好转。"
    titled = spark.createDataFrame([(1, "Treatment")] * 3000 + [(1, "罕见章名"), (2, " Rare name "), (None, "No book"), (3, None)], "book_id long, title string")
    shared = shared_titles(titled, "title")
    assert shared == ["Treatment"]
    names = titles_by_book(titled, "title", shared)
    assert {r["book_id"]: r["own_titles"] for r in names.collect()} == {1: ["罕见章名"], 2: ["Rare name"]}
    texts = [(1, "罕见章名"), (2, "Rare\nname"), (3, "罕见章名"), (1, "好转")]
    pages = spark.createDataFrame([("content", i, f"{zh[:10]}\n{line}\n{zh[10:]}", 77, None, book) for i, (book, line) in enumerate(texts)], ROW + ", page int, book string, book_id long").join(names, "book_id", "left")
    got = {r["row_id"]: r["furniture"] for r in repair_scans(pages, lexicon, shared).collect()}
    assert got == {0: 1, 1: 1}


def test_rare_latin_word_stays_where_it_belongs(spark):
    texts = ["All patients eat well."] * 400 + ["After a cat bite."] * 5
    lexicon = fit_lexicon(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = [("content", 1, "After a cat bite. After a cat bite.", None, None), ("content", 2, "All patients cat well. All patients cat well.", None, None)]
    got = {r["row_id"]: r["repaired"] for r in repair_scans(spark.createDataFrame(rows, ROW + ", page int, book string"), lexicon, []).collect()}
    assert got == {2: "All patients eat well. All patients eat well."}


def test_reflow_and_titles(spark, scans):
    assert reflow("这一行还没有说完就断了\n接着\n\n新段。\n1. 甲\n2. 乙\n体温\n37.6") == "这一行还没有说完就断了接着\n\n新段。\n1. 甲\n2. 乙\n体温\n37.6"
    assert reflow("a longer line\nc d. Each\nf") == "a longer line c d. Each f"
    t = spark.createDataFrame([("A1",)] * 500 + [("B2",), (None,), ("",)], "title string")
    assert shared_titles(t, "title") == ["A1"] and shared_titles(t.where("false"), "title") == []
    assert Repairer(scans[0], []).furniture("text", None, None) == []


def test_vectors_bring_like_words_together():
    near = np.zeros((6, 16), np.float32)
    near[0, :4] = near[1, :4] = 50
    near[2, 8:12] = near[3, 8:12] = 50
    near[4, :4] = 2
    v, _ = word_vectors(near, rounds=120)
    assert v[0] @ v[1] > 0.9 > 0.2 > v[0] @ v[2] and v[0] @ v[4] > 0.8 and not v[5].any()


def test_vectors_decide(spark, monkeypatch):
    """Rare words a glyph edit from frequent ones: those in like contexts are misread, the others are words of their own."""
    from silkmill.llm.scanned import Lexicon

    rng = random.Random(7)
    ward, zoo, sea = "patients doctors nurses ward clinic voices clearly softly".split(), "polar grizzly forest honey claws winter sleeping snow".split(), "harbour sailors waves storm anchor deck tide coast".split()
    said = lambda words, middle: f"{rng.choice(words)} {rng.choice(words)} {middle} {rng.choice(words)} {rng.choice(words)}."
    # pairs of neighbours are all rare alike, so that counts of pairs decide nothing
    texts = [said(ward, "hear") for _ in range(600)] + [said(sea, "float") for _ in range(600)] + [said(zoo, "bear") for _ in range(12)] + [said(ward, "fioat") for _ in range(3)]
    texts += [said(zoo, "eats") for _ in range(300)]
    misread = [said(ward, "hcar") for _ in range(8)] + [said(sea, "f1oat") for _ in range(8)] + [said(sea, "floaf") for _ in range(2)]
    own = [t for t in texts if "bear" in t or "fioat" in t]
    rows = [("content", i, f"{t} {t}", None, None) for i, t in enumerate([*misread, *own])]
    df = spark.createDataFrame(rows, ROW + ", page int, book string")
    lexicon = fit_lexicon(spark.createDataFrame([(t,) for t in [*texts, *misread]], "text string"))
    found = lambda: {r["row_id"] for r in repair_scans(df, lexicon, []).collect()}
    assert found() == set(range(len(misread)))
    fixed = {r["row_id"]: r["repaired"] for r in repair_scans(df, lexicon, []).collect()}
    assert all(("hear" if i < 8 else "float") in fixed[i] for i in fixed)
    monkeypatch.setattr(Lexicon, "agree", lambda self, old, new, here: np.ones(len(old), bool))
    assert len(found() - set(range(len(misread)))) >= 10  # without vectors, words of their own are taken for misread ones


def test_long_words_are_tried_whole(spark):
    long = "behandlungsverfahrensbeschreibungsleitlinien"[:38]
    texts = [f"Eine {long} ist hier gut." for _ in range(40)]
    lexicon = fit_lexicon(spark.createDataFrame([(t,) for t in [*texts, texts[0].replace(long, long[:-1] + "h")]], "text string"))
    bad = long[:30] + long[30:].replace("i", "1").replace("l", "1")
    assert bad != long and lexicon.word(bad) == 0
    seen = fit_lexicon(spark.createDataFrame([(t,) for t in texts + [f"Eine {bad} ist hier gut."]], "text string"))
    assert seen.readings(bad)[0][0] == long and seen.readings("l" * 41 + "1") == []


def test_model_counts_everything(spark):
    from silkmill.llm.charmodel import fit_char_model

    m = fit_char_model(spark.createDataFrame([("ab",), ("ab",), (None,)], "t string").repartition(3), "t")
    assert isinstance(m, CharModel) and m.uni[ord("a")] == 2 and m.bi.sum() >= 6
    assert m.score("ab") > m.score("ba") and np.isfinite(m.score("护"))
    assert Restorer.of(Restorer(m).state()).restore("ab") is None
