"""Near-copies, packing, mixing and subjects on small corpora, against brute force and invariants."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from silkmill.llm import near_copies as N
from silkmill.llm.mixing import mix, quotas, sainte_lague, share_report
from silkmill.llm.packing import _pieces, count_tokens, differenced, fill_report, least_windows, pack, pack_documents, token_count, tokenizer
from silkmill.llm.splitting import read_limits
from silkmill.llm.subjects import assign_subjects, fit_subjects, with_labels


def grams(t):
    t = re.sub(r"[\W_]", "", t.lower())
    return {t[i : i + 3] for i in range(len(t) - 2)}


def brute(texts, t=0.6):
    out = set()
    items = [(i, grams(x)) for i, x in texts if x]
    for k, (i, a) in enumerate(items):
        for j, b in items[k + 1 :]:
            if i != j and a and b and len(a & b) >= t * len(a | b):
                out.add((min(i, j), max(i, j)))
    return out


@pytest.mark.parametrize("group", [N.GROUP, 24])
def test_pairs_against_brute_force(spark, group):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh护理人员观察") for _ in range(5)) for _ in range(60)]
    texts = []
    for i in range(150):
        base = [rng.choice(words) for _ in range(rng.randint(2, 9))]
        texts.append((2 * i, " ".join(base)))
        if rng.random() < 0.6:
            edited = list(base)
            edited[rng.randrange(len(edited))] = rng.choice(words)
            texts.append((2 * i + 1, "，".join(edited if rng.random() < 0.5 else reversed(edited))))
    texts += [(1000 + k, texts[0][1].upper()) for k in range(30)] + [(2000, None), (2001, ""), (2002, "ab"), (2003, "ab"), (2004, "！？"), (2005, "x" * 20_000), (2006, "x" * 20_001), texts[3]]
    rows = [("q", i, t) for i, t in texts] + [("question", 1, texts[0][1])]
    df = spark.createDataFrame(rows, "field string, id long, text string").selectExpr("*", "0 AS rep", "1 AS key")
    members, links = N.near_copies(df, ("q", "question"), group=group)
    got = [tuple(r) for r in N.all_pairs(members, links).collect()]
    assert len(got) == len(set(got)) and all(f == "q" for f, _, _ in got)
    assert {(a, b) for _, a, b in got} == brute([(i, t) for i, t in texts])
    classes = {r["id"]: (r["class_id"], r["n_links"]) for r in N.classes_with_links(members, links).where("field = 'q'").collect()}
    assert classes[1000][0] == 0 and classes[2005][0] == classes[2005][0] and 2000 not in classes


@pytest.mark.parametrize("group", [N.GROUP, 24])
def test_signature_trees(group, monkeypatch):
    """Every candidate leaves a traversal, no similar pair is lost, and trees spare most comparisons."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh护理人员观察") for _ in range(5)) for _ in range(300)]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    texts += [t[:-2] + "zz" for t in texts[::3]] + ["的确如此" + t for t in texts[1::4]]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(texts), pa.int32()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["f", "rep", "text"])
    tables = [np.zeros(1 << N.DF_BITS, np.int64) for _ in range(2)]
    N._count(batch.column(2), tables)
    rows = pa.Table.from_batches([N.routes(batch, tables, 0.6, group)]).sort_by([("key", "ascending"), ("slot", "ascending")])
    fields, forest = N.forest_of(rows, 0.6)
    found = {tuple(p) for p in forest.pairs().tolist()}
    want = brute(list(enumerate(texts)))
    assert len(want) > 200 and want <= found and set(fields) == {0}
    sizes = rows.group_by(["key", "slot"]).aggregate([("n", "sum")]).column("n_sum").to_pylist()
    assert min(sizes) <= 2 and max(sizes) > 16  # small groups and large ones are trees alike
    whole = sum(-(-n // N.FAN) * (-(-n // N.FAN) + 1) // 2 * N.FAN**2 for n in sizes)
    assert 0 < forest.met < whole
    _, at = np.unique(np.concatenate([np.frombuffer(x, N.SIGNATURE)["rep"] for x in rows.column("texts").to_pylist()]), return_index=True)
    one = np.concatenate([np.frombuffer(x, N.SIGNATURE) for x in rows.column("texts").to_pylist()])[at].copy()
    one["pos"] = 0
    none = np.zeros(len(one), np.int64)
    tree = N.Forest(one, none, np.zeros(1, bool), none, 0.6)
    assert want <= {tuple(p) for p in tree.pairs().tolist()} and tree.met < 0.5 * len(one) ** 2 / 2 and len(tree.levels) > 2
    ids = pa.array([a for a, _ in found]), pa.array([b for _, b in found])
    assert {p for p, ok in zip(found, N.reach(batch.column(2).take(ids[0]), batch.column(2).take(ids[1]), 0.6), strict=True) if ok} == want
    monkeypatch.setattr(N.Forest, "_leaves", lambda self, a, b: np.zeros((0, 2), np.int64))
    assert sum(b.num_rows for b in N._traverser(0.6)(rows.to_batches())) == 0


def test_settings_are_never_cut(spark):
    many = spark.range(1001).selectExpr("CAST(id AS string) AS field", "10 AS max_chars", "2 AS overlap_chars")
    assert len(read_limits(many.limit(1000))) == 1000
    with pytest.raises(ValueError, match="more than 1000"):
        read_limits(many)


def test_no_questions(spark):
    empty = spark.createDataFrame([], "field string, id long, text string")
    members, links = N.near_copies(empty, ("q",))
    assert N.all_pairs(members, links).count() == 0 and N.classes_with_links(members, links).count() == 0


def test_differencing_and_packing():
    rng = random.Random(5)
    for _ in range(40):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        k = rng.randint(1, 12)
        parts = differenced(sizes, k)
        assert len(parts) == k and sorted(i for p in parts for i in p) == list(range(len(sizes)))
        items = [(i, n * 3) for i, n in enumerate(sizes)]
        bins = pack(items, 100)
        assert all(sum(b - a for _, a, b in c) <= 100 for c in bins)
        spans = sorted(s for c in bins for s in c)
        for i, n in items:
            own = [(a, b) for j, a, b in spans if j == i]
            assert own[0][0] == 0 and own[-1][1] == n and all(x[1] == y[0] for x, y in zip(own, own[1:], strict=False))
            assert len(own) == 1 or n > 100
        assert least_windows(sizes, 100) <= len(pack(list(enumerate(sizes)), 100))
    assert least_windows([], 9) == 0 and least_windows([6, 6, 6], 10) == 3 and least_windows([7, 7, 4, 4], 10) == 3
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in differenced([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]
    assert pack([], 10) == [] and pack([(1, 0)], 10) == []


def test_pack_documents(spark):
    rng = random.Random(6)
    docs = [(i, "护理 patient " * rng.randint(0, 60)) for i in range(300)] + [(0, "dup"), (900, None), (901, "word " * 30_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").dropDuplicates(["doc_id"]).selectExpr("*", "1 AS tokens", "2 AS shard")
    counted = count_tokens(df)
    want = {r["doc_id"]: r["tokens"] for r in counted.collect()}
    assert 900 not in want and all(n > 0 for n in want.values())
    packed = pack_documents(counted, {"a": 64, "b": 4096}, 301)
    rows = packed.collect()
    for name, cap in (("a", 64), ("b", 4096)):
        fill, got = {}, {}
        for r in rows:
            if r["capacity_name"] == name:
                key = (r["shard"], r["container_no"])
                fill[key] = fill.get(key, 0) + r["token_end"] - r["token_start"]
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["token_end"] - r["token_start"]
        assert max(fill.values()) <= cap and got == want
    report = {r["capacity_name"]: r["unused_share"] for r in fill_report(packed, {"a": 64, "b": 4096}).collect()}
    assert report["a"] < 0.1 and report["b"] < 0.2
    assert pack_documents(counted.where("false"), {"a": 64}, 0).count() == 0
    encoder = tokenizer()
    long = "一句话。" * 5000
    assert abs(token_count(encoder, long) - len(encoder.encode_ordinary(long))) <= 20


def test_long_texts_have_the_tokens_of_the_whole():
    rng = random.Random(10)
    encoder = tokenizer()
    parts = ["护理人员", "patient", "'s", "'ll ", " ", "  ", "\n", "\n\n", "\t", "。", ". ", "12", "½", "一", "é", "e\u0301", "!'", "😀", "\xa0", "\u3000", "\x1c", "\u200b", "ǅ", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(6000)) for _ in range(30)]
    texts += ["护理" * 4000, "word " * 3000, "abcdefg" * 2000, " " * 9000 + "x", "x" + "\n" * 9000 + "y", "a1" * 5000, "'" * 9000, "一句话。" * 5000, "x, " * 3000]
    for text in texts:
        pieces = list(_pieces(text))
        assert "".join(pieces) == text
        assert [t for p in pieces for t in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)
        assert token_count(encoder, text) == len(encoder.encode_ordinary(text))
    assert max(map(len, _pieces("word " * 3000))) <= 4000


def test_highest_quotients():
    def slow(weights, seats, limits):
        given = [0] * len(weights)
        for _ in range(seats):
            best = max((w / (2 * s + 1), -i) for i, (w, s, most) in enumerate(zip(weights, given, limits, strict=True)) if s < most and w > 0) if any(s < m and w > 0 for w, s, m in zip(weights, given, limits, strict=True)) else None
            if best is None:
                break
            given[-best[1]] += 1
        return given

    rng = random.Random(7)
    for _ in range(200):
        n = rng.randint(1, 6)
        w, seats, limits = [rng.choice([0, 1, 1, 2.5, 7, 0.3]) for _ in range(n)], rng.randint(0, 60), [rng.randint(0, 30) for _ in range(n)]
        assert sainte_lague(w, seats, limits) == slow(w, seats, limits)
    q = quotas([("a", 0, 10_240), ("b", 0, 2048)], {"a": (0.5, 1), "b": (0.5, 3)}, None)
    assert q.blocks == {("a", 0): 6, ("b", 0): 6}


def test_mixture(spark):
    rng = random.Random(8)
    docs = [(i, "abc"[i % 3] if i % 5 else "a", rng.randint(5, 900)) for i in range(600)] + [(i, "rare", 400) for i in range(700, 710)] + [(800, None, 9), (801, "unlisted", 50), (802, "a", 0), (1, "b", 5)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens long").dropDuplicates(["doc_id"]).selectExpr("*", "1 AS block", "1 AS copies")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 2), ("rare", 0.1, 4), ("c", 0.1, 1), ("absent", 0.1, 3), (None, 0.5, 1), ("zero", None, None)], "source string, target_share double, max_repeats int")
    mixture = mix(df, targets)
    rows = mixture.collect()
    assert {r["source"] for r in rows} == {"a", "b", "c", "rare"} and len({r["doc_id"] for r in rows}) == len(rows)
    assert max(r["copies"] for r in rows if r["source"] == "rare") <= 4 and max(r["copies"] for r in rows if r["source"] == "a") == 1
    shares = {r["source"]: r["share"] for r in share_report(mixture, targets.where("source IS NOT NULL")).collect()}
    for s, want in (("a", 0.4 / 0.9), ("b", 0.3 / 0.9), ("c", 0.1 / 0.9), ("rare", 0.1 / 0.9), ("absent", 0.0)):
        assert abs(shares[s] - want) < 0.05, (s, shares)
    assert sorted(map(tuple, mix(df.repartition(7), targets).collect())) == sorted(map(tuple, rows))
    assert mix(df.where("false"), targets).count() == 0 and mix(df, targets.where("false")).count() == 0


def test_source_of_less_than_a_block(spark):
    docs = [(i, "a", 300) for i in range(400)] + [(1000 + i, "tiny", 30) for i in range(5)] + [(2000, "never", 30)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.9, 2), ("tiny", 0.1, 4), ("never", 0.1, 0)], "source string, target_share double, max_repeats int")
    for total in (None, 20_480):
        copies = {}
        for r in mix(df, targets, total).collect():
            copies.setdefault(r["source"], []).append(r["copies"])
        assert set(copies) == {"a", "tiny"} and copies["tiny"] == [4] * 5
        assert max(copies["a"]) <= 2
    assert quotas([("a", 0, 10_240), ("b", 0, 100)], {"a": (0.5, 1), "b": (0.5, 3)}, None).blocks == {("a", 0): 1, ("b", 0): 1}


SENTENCES = {"medicine": ["患者头痛入院，给予抗生素后好转。", "The patient took tablets against fever. "], "law": ["法院驳回全部诉讼请求。", "The court dismissed the claim on appeal. "], "sport": ["队长在决赛中刷新纪录。", "The striker scored in the final match. "]}


def test_subjects_held_out(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(400):
        own = rng.sample(sorted(SENTENCES), rng.choice([1, 1, 2]))
        docs.append((i, "".join(rng.choice(SENTENCES[s]) for _ in range(4) for s in own)))
        labels += [(i, s, "x") for s in own]
    docs += [(500, "请按顺序阅读。" * 3), (501, None), (502, ""), (503, SENTENCES["law"][0] * 9000)]
    labels += [(500, None, "x"), (0, "sport", "y"), (999, "law", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS share")
    lab = spark.createDataFrame(labels, "doc_id long, subject_code string, annotator string")
    model = fit_subjects(with_labels(d, lab.where("doc_id < 200 OR doc_id = 500")), sorted(SENTENCES))
    assert model.losses[-1] < model.losses[0]
    got = {(r["doc_id"], r["subject_code"]) for r in assign_subjects(d, model).where("doc_id >= 200").collect()}
    want = {(i, s) for i, s, _ in labels if s and 200 <= i < 400} | {(503, "law")}
    assert len(got & want) / len(want) > 0.97 and len(got - want) / len(want) < 0.03
    assert assign_subjects(d.where("false"), model).count() == 0
    none = fit_subjects(with_labels(d, lab.where("false")), ["law"])
    assert assign_subjects(d, none).count() == 0
    assert assign_subjects(d, fit_subjects(with_labels(d, lab), [])).count() == 0
    by = {r["doc_id"]: dict(zip(r["codes"], r["weights"], strict=True)) for r in with_labels(d, lab).where("doc_id IN (0, 500)").collect()}
    assert by[500] == {} and by[0]["sport"] >= 0.5
