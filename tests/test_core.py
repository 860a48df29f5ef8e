"""Core operators on hand-written rows, the odd behaviours in both modes, and repartition invariance."""

import base64
import json
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silkmill.functions import text as X
from silkmill.operators import chunking, dialog, graph, layout, metrics, qa, sampling, sections, tool_calls, triage, vectors
from silkmill.plans import model, pipelines
from silkmill.sources import files, pages


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in ((k, "string" if isinstance(v, str) or v is None else "array<string>" if isinstance(v, list) else "int") for k, v in values.items()))) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_text_functions(spark):
    assert one(spark, X.clean_text(F.col("t")), t="<b>见</b>https://a.b/c?d 发a.b@c.de！！！１２Ａ 13812345678") == "见 发！12A "
    assert one(spark, X.fenced_json(F.col("t")), t='```json\n{"a":1}\n```') == '{"a":1}'
    assert one(spark, X.literal_list(F.col("t")), t="['a', \"b\"]") == ["a", "b"]
    for written, meant in ((r"""['it\'s', "it's", 'say "a"', 'back\\n', 'x\ny']""", ["it's", "it's", 'say "a"', "back\\n", "x\ny"]), ("[1, -2.5, None, True,]", ["1", "-2.5", None, "True"]), ("[]", []), (" ['a' 'b']", []), ("['a', b]", []), ("['" + "x" * 30_000 + "']", ["x" * 30_000]), ("not", []), ("['a'] + ['b']", [])):
        assert one(spark, X.literal_list(F.col("t")), t=written) == meant
    assert one(spark, X.literal_list(F.col("t")), t="__import__('os')") == []
    assert one(spark, X.render("{{x}} {t}{u}", {"t": F.col("t")}), t="{u}") == "{x} {u}{u}"
    assert one(spark, X.drop_numbering(F.col("t")), t="1. a 1.b") == " a 1.b"
    assert one(spark, X.drop_numbering(F.col("t"), compat=True), t="1. a 1.b") == " a b"
    assert one(spark, X.wrap(F.col("t"), 3), t="abcdef") == "abc\ndef"
    assert one(spark, X.wrap(F.col("t"), 3, compat=True), t="abcdef") == "abc\nde\nf"
    assert one(spark, X.wrap(F.col("t"), 3), t="ab") == "ab"
    assert one(spark, X.file_bucket(F.col("t")), t="/a/b.DOCX") == "Docx"
    assert one(spark, X.file_bucket(F.col("t"), compat=True), t="/a/b.DOCX") == "else"
    assert one(spark, X.file_bucket(F.col("t")), t="a.xlsx") == "else"
    assert one(spark, X.good_length(F.col("t")), t="a" * 64) is False
    assert one(spark, X.good_length(F.col("t"), compat=True), t="a") is True
    assert one(spark, X.numbered(F.col("q")), q=["a", "b"]) == "0. a\n1. b"
    s = one(spark, F.to_json(X.sections(F.col("t"))), t="疾病：\n：感冒\n想得到怎样的帮助：药\n想得到怎样的帮助:吃什么")
    assert json.loads(s) == {"disease": "感冒", "detail": "", "past_treatment": "", "purpose": "吃什么"}
    assert json.loads(one(spark, F.to_json(X.sections(F.col("t"), compat=True)), t="疾病：\n：感冒"))["disease"] == "：感冒"


def test_titles_and_shorts(spark):
    lines = [("a", 0, "####一####x"), ("a", 1, "y"), ("a", 2, "###二###"), ("a", 3, "####三####"), ("a", 4, "#### foo ###"), ("a", 5, "########")]
    df = spark.createDataFrame(lines, "f string, pos int, text string")
    for n in (1, 7):
        got = [tuple(r)[2:] for r in sections.fill_titles(df.repartition(n), "f", ["pos"], "text").orderBy("pos").collect()]
        assert got == [("x", "一", None), ("y", "一", None), ("", "一", "二"), ("", "三", "二"), ("", "三", "# foo "), ("", "", "# foo ")]
    reset = [r["second_title"] for r in sections.fill_titles(df, "f", ["pos"], "text", reset_sub=True).orderBy("pos").collect()]
    assert reset[3] == ""
    rows = [("a", 0, "s1", "A"), ("a", 1, "L" * 65, "B"), ("a", 2, "k" * 64, "C"), ("a", 3, "s3", "D"), ("a", 4, None, "E")]
    p = spark.createDataFrame(rows, "d string, pos int, t string, title string")
    got = sorted((r["island"], r["part"], r["t"], r["title"]) for r in sections.coalesce_shorts(p, "d", ["pos"], "t", ["title"]).collect())
    assert got == [(0, 0, "L" * 65, "B"), (0, 1, "s1", "B"), (1, 1, "k" * 64 + "s3", "D")]
    assert sections.coalesce_shorts(p, "d", ["pos"], "t", ["title"], compat=True).count() == 2


def test_stop_and_records(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y参考文献z"), ("a", 3, "w"), ("b", 1, "q")], "d string, n int, text string")
    assert sorted(tuple(r) for r in sections.stop_at_marker(df, "d", ["n"], "text", "参考文献").collect()) == [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "q")]
    lines = ["lost", "id=7", "http", "Description", "a", "", "b", "Dialogue lost", "hi", "id=8", "u"]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)], "file string, n int, line string")
    got = [tuple(r) for r in sections.dialogue_records(df, "file", "n", "line").orderBy("record_no").collect()]
    assert got == [("f", 1, "7", "http", "", "a\nb", "hi"), ("f", 2, "8", "u", "", "", "")]
    assert [r["Description"] for r in sections.dialogue_records(df, "file", "n", "line", compat=True).collect()] == ["\na\nb"]


def test_blocks_change_nothing(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice(["####t####x", "###u###", "y" * 70, "z", "w参考文献", None, ""])) for i in range(300)]
    df = spark.createDataFrame(rows, "d string, pos int, t string")
    same = lambda f: sorted(map(str, f(None).collect())) == sorted(map(str, f(F.floor(F.col("pos") / 7)).collect()))
    assert same(lambda b: sections.fill_titles(df, "d", ["pos"], "t", block=b))
    assert same(lambda b: sections.stop_at_marker(df, "d", ["pos"], "t", "参考文献", b))
    assert same(lambda b: sections.coalesce_shorts(df, "d", ["pos"], "t", ["pos"], block=b))
    lines = df.withColumn("t", F.when(F.col("pos") % 9 == 0, F.concat(F.lit("id="), "pos")).when(F.col("pos") % 4 == 0, "Dialogue").otherwise(F.col("t")))
    assert same(lambda b: sections.dialogue_records(lines, "d", "pos", "t", block=b))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab。\n ", max_size=120), st.integers(5, 20), st.integers(0, 4))
def test_recursive_split(text, size, overlap):
    out = chunking.split_recursive(text, size, overlap, chunking.SEPARATORS)
    assert all(len(c) <= size for c in out)
    if overlap == 0:
        assert "".join(out) == text


def test_merges_and_packing(spark):
    assert one(spark, chunking.merge_sentences(F.col("t"), 5), t="ab。cd。efghijk。l") == ["abcd", "efghijk", "l"]
    assert one(spark, chunking.merge_sentences(F.col("t"), 5, compat=True), t="ab。cd。efghijk。l") == ["abcd", "efghijk"]
    assert one(spark, chunking.merge_pieces(F.col("q"), 4, 2), q=["ab", "cd", "ef"]) == ["abcd", "cd ef"]
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 3, 20), (1, 4, 1), (1, 5, None)], "s int, i int, n int")
    got = [r["bin_no"] for r in chunking.next_fit(df, "s", ["i"], "n", 10).orderBy("i").collect()]
    assert got == [0, 1, 2, 3, 3]
    w = chunking.token_windows(spark.createDataFrame([(1, [1, 2, 3, 4, 5]), (2, [])], "k int, a array<int>"), ["k"], "a", 3, 1)
    assert [tuple(r["window"]) for r in w.orderBy("start").collect()] == [(1, 2, 3), (3, 4, 5), (5,)]


def test_tokenizers(spark, tmp_path):
    (tmp_path / "small.tiktoken").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([*(bytes([k]) for k in range(256)), b"ab", b"abab"])))
    df = spark.createDataFrame([(1, "abab ab"), (2, None), (3, "")], "k int, t string")
    make = chunking.vocabulary_tokenizer(str(tmp_path / "small.tiktoken"))
    assert [r["ids"] for r in chunking.encode(df, "t", make).orderBy("k").collect()] == [[257, 32, 256], None, []]
    words = spark.createDataFrame([(1, "a b c d e。f g")], "k int, t string")
    pieces = chunking.recursive_chunks(words, ["k"], "t", 3, 1, measure=lambda: lambda t: len(t.split())).collect()
    assert all(len(r["chunk"].split()) <= 3 for r in pieces) and pieces[0]["chunk"] == "a b c "


def test_dialogues(spark):
    turns = F.array(*[F.struct(dialog.role(F.lit(s)).alias("role"), F.array(F.lit(1), F.lit(3)).alias("ids"), F.lit(s).alias("speaker")) for s in ("A from User", "B to User", "nobody")])
    seq = spark.range(1).select(dialog.masked_sequence(F.array(F.lit(9)), turns, F.lit(2)).alias("s")).first()["s"]
    assert seq["input_ids"] == [9, 2, 1, 3, 2, 1, 3, 2] and seq["labels"] == [-100] * 5 + [1, 3, 2]
    pre = F.array(F.struct(F.lit("User: ").alias("role"), F.array(F.lit(1)).alias("ids"), F.lit("Pretrain").alias("speaker")))
    assert spark.range(1).select(dialog.masked_sequence(F.array(F.lit(9)), pre, F.lit(2)).alias("s")).first()["s"]["labels"] == [1, 2]
    assert spark.range(1).select(dialog.masked_sequence(F.array(F.lit(9)), pre, F.lit(2), compat=True).alias("s")).first()["s"]["labels"] == [-100] * 4
    df = spark.createDataFrame([(1, [1] * 30, [-100] * 15 + [1] * 15), (2, [1] * 11, [1] * 11), (3, [1] * 14, [1] + [-100] * 13)], "k int, i array<int>, l array<int>")
    kept = dialog.cut_windows(df, ["k"], "i", "l", 20, 14)
    assert sorted((r["k"], r["window_no"]) for r in kept.collect()) == [(1, 0), (1, 1), (2, 0), (3, 0)]
    assert {r["k"] for r in dialog.cut_windows(df, ["k"], "i", "l", 20, 14, filter_all=True).collect()} == {1}
    arr = lambda *x: F.array(*[F.lit(v) for v in x]) if x else F.array().cast("array<int>")
    cont = lambda p, g: spark.range(1).select(dialog.continuation(arr(*p), arr(*g), F.lit(2)).alias("c")).first()["c"]
    assert cont([5, 6], [1, 5, 6, 7, 8, 2, 9]) == [7, 8] and cont([5], [1, 2]) == [] and cont([5], [1, 5]) == [] and cont([1], [1, 7]) == [7]


def test_layout(spark):
    words = [(1, 0, 5, 10, "a"), (1, 1, 60, 10, "b"), (1, 2, 6, 10, "c"), (1, 3, 500, 10, "out"), (1, 4, 5, 20, "d")]
    df = spark.createDataFrame(words, "page int, seq int, x0 int, y0 int, text string")
    table = lambda compat: {r["y0"]: list(r["cells"]) for r in layout.words_to_table(df, "page", [0, 50, 100], compat).collect()}
    assert table(False) == {10: ["a c out", "b"], 20: ["d", ""]}
    assert table(True)[10] == ["c out", "b"]
    spans = spark.createDataFrame([(1, 0, 0.0, 5.0, "a"), (1, 1, 8.0, 9.0, "b"), (1, 2, 12.5, 14.0, "c")], "line int, seq int, x0 double, x1 double, text string")
    assert sorted(r["text"] for r in layout.merge_spans(spans, ["line"]).collect()) == ["ab", "c"]
    boxes = spark.createDataFrame([(1, 0, "Text", 401, "r"), (1, 1, "title", 400, "l"), (1, 2, "figure", 0, "f")], "page int, seq int, type string, x1 int, text string")
    assert layout.reading_order(boxes, "page", F.lit(1000)).first()["text"] == "l\nr\n"
    figs = spark.createDataFrame([("figure", 0, 0, 301, 301), ("figure", 0, 0, 300, 301)], "type string, x1 int, y1 int, x2 int, y2 int")
    assert layout.large_figures(figs, F.lit(51)).count() == 1 and layout.large_figures(figs, F.lit(50)).count() == 0


def test_crop(spark):
    rows = [(bytes(range(12)), 3, 2, 1, 0, 9, 1), (bytes(range(6)), 3, 2, 1, 1, 3, 2), (bytes(range(6)), 3, 2, 2, 0, 1, 2), (None, 3, 2, 0, 0, 1, 1), (b"", 0, 0, 0, 0, 1, 1), (bytes(range(6)), 3, 2, 0, 0, None, 1)]
    df = spark.createDataFrame(rows, "p binary, w int, h int, a int, b int, c int, d int")
    got = [None if r[0] is None else bytes(r[0]) for r in df.select(layout.crop(*[F.col(c) for c in df.columns])).collect()]
    assert got == [bytes([2, 3, 4, 5]), bytes([4, 5]), b"", None, None, None]


def test_page_spans(spark):
    span, line = "struct<x0: double, x1: double, text: string>", "struct<y0: double, y1: double, spans: array<{}>>"
    schema = f"page int, blocks array<struct<lines: array<{line.format(span)}>>>"
    lines = [(10.0, 12.0, [(0.0, 4.0, "a"), (6.0, 9.0, "b"), (50.0, 60.0, "c"), None]), None, (14.0, 16.0, [(200.0, 300.0, "out")]), (90.0, 99.0, [(0.0, 1.0, "low")]), (20.0, 22.0, None)]
    df = spark.createDataFrame([(1, [(lines,), None, ([],)]), (2, None), (3, [])], schema)
    assert [(r["line_no"], r["span_no"], r["text"]) for r in layout.page_spans(df, "page").orderBy("seq").collect()] == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (2, 0, "out"), (3, 0, "low")]
    assert sorted(tuple(r) for r in layout.spans_table(df, "page", [0.0, 0.0, 100.0, 50.0]).collect()) == [(1, 10.0, 0, "ab"), (1, 10.0, 1, "c")]


def test_library(spark):
    books = spark.createDataFrame([("/a/x.pdf",), ("/a/y.pdf",), (None,)], "p string")
    images = spark.createDataFrame([("/i/x__1.png",), ("/i/z.png",), (None,)], "i string")
    assert [r["p"] for r in triage.unprocessed_books(books, "p", images, "i").collect()] in (["/a/y.pdf", None], [None, "/a/y.pdf"])
    assert triage.unclassified(books.where("p IS NOT NULL"), "p", spark.createDataFrame([("/else/y.pdf",)], "q string"), "q").first()["p"] == "/a/x.pdf"


def test_graph(spark):
    node = "labels array<string>, id long, name string, props map<string,string>"
    nodes = spark.createDataFrame([(["A"], 1, "x", {"k": "1", "m": "2"}), (["B"], 2, "y", None)], node)
    up = graph.upsert_nodes(nodes, spark.createDataFrame([(["A"], 1, None, {"k": "9"}), (["A"], 3, "z", {})], node))
    got = {r["id"]: (r["name"], r["props"], r["inserted"]) for r in up.collect()}
    assert got == {1: ("x", {"k": "9", "m": "2"}, False), 2: ("y", {}, False), 3: ("z", {}, True)}
    assert graph.max_node_id(nodes.where("false")).first()[0] == -1
    changes = spark.createDataFrame([(["A"], 1, None, {"k": "9"}), (["A"], 3, "z", {})], node)
    assert {r["id"]: (r["name"], r["props"], r["changed"]) for r in graph.update_nodes(nodes, changes).collect()} == {1: ("x", {"k": "9", "m": "2"}, True), 2: ("y", None, False)}
    assert [r["id"] for r in graph.unmatched(nodes, changes).collect()] == [3]
    edges = spark.createDataFrame([(1, 1, 2, "r"), (2, 2, 1, "s")], "id long, source long, target long, label string")
    new = spark.createDataFrame([(3, 1, 2, "t")], edges.schema)
    assert sorted(r["id"] for r in graph.replace_edges(edges, new).collect()) == [2, 3]
    assert sorted(r["id"] for r in graph.replace_edges(edges, new, either_way=True).collect()) == [3]
    assert sorted(r["id"] for r in graph.incident_edges(edges, nodes, "both").collect()) == [1, 2]
    assert [x.count() for x in graph.delete_label(nodes, edges, "A")] == [1, 0]
    assert [x.count() for x in graph.delete_all(nodes, edges)] == [0, 0]
    tree = spark.createDataFrame([(0, -1), (1, 0), (2, -2), (-1, 0)], "id int, parent int")
    assert graph.tree_edges(tree).count() == 1 and graph.tree_edges(tree, compat=True).count() == 2


def test_vectors_and_metrics(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, None), (4, [2.0, 0.0])], "id long, v array<float>")
    got = [(r["query_id"], r["id"], r["rank"]) for r in vectors.nearest(v, "id", "v", F.col("id") % 4 == 0, 2, 2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 4, 1), (0, 1, 2), (4, 0, 1), (4, 1, 2)]
    index = spark.createDataFrame([("a", [1.0], 1)], "_id string, vector array<double>, n int")
    merged = vectors.upsert(index, spark.createDataFrame([("a", [2.0], 2), (None, [3.0], 3)], index.schema))
    assert sorted(r["n"] for r in merged.collect()) == [2, 3]
    with pytest.raises(Exception, match="no vector"):
        vectors.upsert(index, spark.createDataFrame([("b", None, 2)], index.schema)).collect()
    assert metrics.common_subsequence(list("abcbdab"), list("bdcaba")) == 4
    pair = spark.createDataFrame([(1, list("the the the"), list("the cat"))], "k int, c array<string>, r array<string>")
    same = spark.createDataFrame([(1, list("abcdef"), list("abcdef"))], pair.schema)
    assert metrics.bleu(same, "k", F.col("c"), F.col("r")).first()["bleu_4"] == pytest.approx(1.0)
    assert metrics.summary_overlap([["the", "cat", "sat"], ["it", "ran"]], [["the", "cat", "ran"]]) == pytest.approx(2 * 3 / 8)
    assert metrics.summary_overlap([], [["a"]]) == 0.0
    lines = spark.createDataFrame([("a b\nc d", "c d\na b"), (None, "a"), ("", "")], "c string, r string")
    assert [r[0] for r in lines.select(metrics.rouge_lsum(F.col("c"), F.col("r"))).collect()] == [1.0, 0.0, 0.0]
    assert metrics.mean_loss(spark.createDataFrame([(1.0,), (None,), (2.0,)], "loss double")).first()[:] == (1.5, 2)
    assert metrics.ngram_overlap(pair, "k", F.col("c"), F.col("r"), 3).first()["matches"] == 2


def test_sampling_and_qa(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(50)] + [(100, "c")], "id int, s string")
    for n in (1, 5):
        mixed = sampling.interleave(df.repartition(n), "s", "id", {"a": 0.5, "c": 0.4, "none": 0.1}, 20, 3).collect()
        assert sorted(r["draw_no"] for r in mixed) == list(range(1, 19))
        assert sum(r["s"] == "c" for r in mixed) == 8 and max(r["repeat_no"] for r in mixed) == 7
    for n in (1, 5):
        placed = [(r["n"], r["id"]) for r in sampling.numbered(sampling.shuffled(df.repartition(n), "id", 4), "n").collect()]
        assert sorted(p for p, _ in placed) == list(range(1, 52))
        assert [i for _, i in sorted(placed)] == [r["id"] for r in sampling.shuffled(df, "id", 4).collect()]
    assert sampling.largest_remainder({"a": 1, "b": 1, "c": 1}, 4) == {"a": 2, "b": 1, "c": 1}
    assert sampling.sample_per_group(df, ["s"], "id", 3, 1).count() == 7
    assert one(spark, qa.refined(F.col("q")), q=["1. a\nb", "说答案", "c"]) == [" a", "c"]
    assert one(spark, qa.majority(F.array(F.lit(True), F.lit(False)))) is True
    acc = spark.createDataFrame([(1, "q", 2), (1, "q", 1), (1, "r", 3), (1, None, 0)], "k int, q string, o int")
    assert qa.accepted(acc, ["k"], "q", "o").first()["Q"] == ["q", "r"]
    assert triage.not_done(df, "id", df.where("id < 49"), "id").count() == 2


def test_tool_calls(spark):
    schema = "f array<struct<name string, parameters struct<required array<string>>>>, c array<struct<function_name string, arguments map<string,string>>>"
    rows = [([("a", (["x"],))], [("a", {"x": "1"})]), ([("a", (["x"],))], [("b", {"x": "1"})]), ([("a", (["x"],))], [("a", {})]), ([("a", ([],))], [("a", {})]), ([("a", None)], [("a", {})]), ([("a", (["x"],))], [("a", None)]), (None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(tool_calls.calls_are_valid(F.col("f"), F.col("c"))).collect()]
    assert got == [True, False, False, True, False, False, False]


def test_model_boundary(spark):
    class Flaky:
        def __init__(self):
            self.n = 0

        def generate(self, prompts):
            self.n += 1
            if self.n % 2:
                raise OSError("down")
            return [f"<{p}>" for p in prompts]

    class Dead:
        def generate(self, prompts):
            raise OSError("down")

    df = spark.createDataFrame([("a",), (None,)], "p string").coalesce(1)
    assert [r["answer"] for r in model.ask(df, F.col("p"), Flaky, tries=3).collect()] == ["<a>", None]
    dead = model.ask(df, F.col("p"), Dead, tries=2).collect()
    assert dead[0]["answer"] is None and "down" in dead[0]["error"]
    assert one(spark, model.strict_bool(F.col("t")), t="True.") is None and one(spark, model.loose_bool(F.col("t")), t="True.") is True
    assert model.branch(df, F.col("p") == "a", lambda x: x.withColumn("b", F.lit(1)), lambda x: x.withColumn("b", F.lit(2))).where("b = 2").count() == 1
    class Picky:
        """Refuses every second call for a function; groups of prompts with a bad one fail as a whole."""

        def __init__(self):
            self.seen = []

        def generate(self, prompts):
            self.seen += prompts
            if len(prompts) > 1 and "bad" in "".join(prompts):
                raise OSError("down")
            return [None if "bad" in p else json.dumps({"question": f"q{len(self.seen)}", "function": [{"name": "f", "parameters": {"required": []}}], "input_parameters": [{"function_name": "f" if "#1" in p else "g", "arguments": {}}]}) for p in prompts]

        def chat(self, conversations):
            return ["|".join(m["role"] + m["text"] for m in c) for c in conversations]

    rows = spark.createDataFrame([(1, "one", "first"), (2, "bad", "first"), (3, "two", None)], "k int, f string, q string").coalesce(1)
    grown = model.grow(rows, "k", "f", "q", "{function}: {questions}", 2, 3, Picky).collect()
    assert sorted((r["k"], r["example_no"], r["attempt"]) for r in grown) == [(1, 0, 1), (1, 1, 1), (3, 0, 1), (3, 1, 1)]
    assert [a for a, _ in model._answers(Picky().generate, ["ok", None, "bad"], 2)][1:] == [None, None]
    assert model.accept_example("no") is None and model.accept_example('{"function": []}') is None
    talk = spark.range(1).select(F.array(F.struct(F.lit("system").alias("role"), F.lit("s").alias("text")), F.struct(F.lit("nurse").alias("role"), F.lit("n").alias("text"))).alias("m"))
    assert model.chat(talk, F.col("m"), Picky).first()["answer"] == "systems|ain"
    nodes = model.new_nodes(spark.createDataFrame([(1, []), (2, ["a"]), (3, None)], "k int, l array<string>"), "l", F.lit("unasked"), F.lit("p"))
    assert sorted((r["k"], r["answer"] == "unasked") for r in nodes.collect()) == [(1, True), (2, False), (3, True)]


def test_recognise(spark):
    df = spark.createDataFrame([(1, "a\n\nb".encode()), (2, None), (3, b""), (4, b"\xff")], "k int, image binary")
    assert sorted(tuple(r) for r in model.recognise(df, "image", size=2).collect()) == [(1, 0, "a", 1.0), (1, 1, "b", 1.0)]


def test_http_model():
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from threading import Thread

    class Echo(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            said = json.dumps({"choices": [{"message": {"content": body["model"] + ":" + ",".join(m["role"] for m in body["messages"])}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(said)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Echo)
    Thread(target=server.serve_forever, daemon=True).start()
    client = model.HttpModel(f"http://127.0.0.1:{server.server_port}/", "m")
    assert client.generate(["a", "b"]) == ["m:user", "m:user"]
    assert client.chat([[{"role": "system", "text": ""}, {"role": "ai", "text": ""}]]) == ["m:system,assistant"]
    server.shutdown()


def _pdf() -> bytes:
    """Two pages: one plain, its text in Latin letters; one deflated, with a font of two-byte codes."""
    drawn = b"BT /F1 12 Tf 72 700 Td (Hello \\(World\\)) Tj 0 -14 Td [(next) -300 (li) 20 (ne)] TJ ET"
    wide = zlib.compress(b"BT /F2 12 Tf 1 0 0 1 72 700 Tm <00010002> Tj <0010> Tj ET")
    cmap = b"1 beginbfchar <0001> <62A4> endbfchar 1 beginbfrange <0002> <0003> <7406> endbfrange 1 beginbfrange <0010> <0010> [<0041>] endbfrange"
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 /Resources << /Font << /F1 7 0 R /F2 8 0 R >> >> >>",
        b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>",
        b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R] /Resources << /Font << /F2 8 0 R >> /XObject << /A 11 0 R /B 12 0 R /C 13 0 R /D 14 0 R /F 7 0 R >> >> >>",
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(drawn), drawn),
        b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(wide), wide),
        b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>",
        b"<< /Type /Font /Subtype /Type0 /ToUnicode 9 0 R >>",
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap),
        b"<< /Title (A title) /Author <FEFF62A4> >>",
        b"<< /Subtype /Image /Width 2 /Height 1 /Filter /DCTDecode >>\nstream\nJPEG\nendstream",
        b"<< /Subtype /Image /Width 2 /Height 1 /ColorSpace /DeviceCMYK /Filter /FlateDecode >>\nstream\n%s\nendstream" % zlib.compress(bytes([0, 0, 0, 0, 255, 0, 0, 51])),
        b"<< /Subtype /Image /Width 2 /Height 2 /Filter /FlateDecode >>\nstream\n%s\nendstream" % zlib.compress(bytes([1, 2, 3, 4])),
        b"<< /Subtype /Image /Width 2 /Height 2 >>\nstream\nxyz\nendstream",
    ]
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (i + 1, o) for i, o in enumerate(objects)) + b"\ntrailer << /Root 1 0 R /Info 10 0 R >>"


PDF = _pdf()


def test_sheets(spark, tmp_path):
    main, link = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = lambda rows: f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets><sheet name="one" r:id="r1"/><sheet name="two" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>问题</t></si><si><r><t>回</t></r><r><t>答</t></r></si><si><t>q1</t></si></sst>')
        z.writestr("xl/worksheets/s1.xml", sheet('<row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="C2"><v>7</v></c></row><row><c r="A3" t="inlineStr"><is><t>q2</t></is></c></row>'))
        z.writestr("xl/worksheets/s2.xml", sheet('<row><c r="A1" t="s"><v>1</v></c><c r="B1" t="s"><v>0</v></c></row>'))
    got = files.read_xlsx(spark, str(tmp_path), ["one", "two"], ["问题", "回答"])
    assert [tuple(r)[1:] for r in got.orderBy("row_no").collect()] == [(0, 0, "q1", "7"), (0, 1, "q2", None)]
    with pytest.raises(Exception, match="no sheet"):
        files.read_xlsx(spark, str(tmp_path), ["three"], ["问题"]).collect()


def test_sources(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.txt").write_text("one。\ntwo\fthree", encoding="utf-8")
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]', encoding="utf-8")
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n{"k": 2}\n', encoding="utf-8")
    (tmp_path / "bad.jsonl").write_text('{"k": 1}\nnot\n', encoding="utf-8")
    assert files.read_json(spark, str(tmp_path / "a.json"), "k int").count() == 2
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "k int").count() == 2
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "k int").collect()
    assert [r["text"] for r in files.read_delimited(spark, str(tmp_path / "x" / "a.txt")).orderBy("pos").collect()][0] == "one"
    assert files.read_lines(spark, str(tmp_path / "x" / "a.txt")).count() == 2
    (tmp_path / "b.pdf").write_bytes(PDF)
    (tmp_path / "broken.pdf").write_bytes(b"%PDF /Encrypt")
    got = {(r["file"].rsplit("/", 1)[-1], r["page_number"]): r for r in pages.read_pages(spark, str(tmp_path)).collect()}
    assert {k: r["total_pages"] for k, r in got.items()} == {("a.txt", 1): 2, ("a.txt", 2): 2, ("b.pdf", 1): 2, ("b.pdf", 2): 2, ("broken.pdf", None): 0}
    first = got[("b.pdf", 1)]
    assert first["text"].split("\n")[:2] == ["Hello (World)", "next line"] and got[("b.pdf", 2)]["text"].strip() == "护理A"
    assert (first["title"], first["author"], first["keywords"]) == ("A title", "护", None) and "encrypted" in got[("broken.pdf", None)]["error"]
    images = [(r["page_number"], r["image_no"], r["kind"], bytes(r["data"])) for r in pages.read_images(spark, str(tmp_path)).orderBy("image_no").collect()]
    assert images == [(2, 0, "jpeg", b"JPEG"), (2, 1, "rgb", bytes([255, 255, 255, 0, 204, 204])), (2, 2, "gray", bytes([1, 2, 3, 4]))]
    assert pages.read_pages(spark, str(tmp_path), "*.txt", {"txt": lambda raw: pages.Book([raw.decode()])}).count() == 1
    listed = {(r["filename"], r["dirs"]) for r in triage.file_listing(spark, str(tmp_path)).collect()}
    assert ("a.txt", "x") in listed and ("a.json", "") in listed
    df = spark.createDataFrame([(1, "护"), (2, None)], "k int, t string")
    assert files.export_json_array(df, str(tmp_path / "new" / "o.json")) == 2
    files.write_jsonl(df, str(tmp_path / "o"))
    files.write_jsonl(df, str(tmp_path / "o"), append=True)
    assert spark.read.json(str(tmp_path / "o")).count() == 4


def test_streams(spark, tmp_path):
    from silkmill.streaming.accepted import append_accepted, windowed_counts

    source = tmp_path / "in"
    spark.createDataFrame([(1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:01:05"), (3, "2024-01-01 00:00:30")], "k int, t string").selectExpr("k", "CAST(t AS timestamp) AS t").write.parquet(str(source))
    stream = spark.readStream.schema("k int, t timestamp").parquet(str(source))
    append_accepted(stream, lambda b: b.where("k < 3"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    counts = windowed_counts(spark.read.parquet(str(source)), "t", "1 minute", "1 minute", [])
    assert sorted(r["events"] for r in counts.collect()) == [1, 2]


def test_pipelines(spark):
    book = spark.createDataFrame([("b", 1, "字" * 200), ("b", 2, "尾" * 70 + "参考文献" + "x" * 99), ("b", 3, "y" * 99)], "book string, page_number int, text string")
    chunks = pipelines.load_chunks(book, "book", 100, 10).collect()
    assert {r["page_number"] for r in chunks} == {1, 2} and all(64 <= len(r["chunk"]) <= 100 for r in chunks) and all(r["total_pages"] == 3 for r in chunks)
    lines = spark.createDataFrame([("f", 0, "####甲####" + "长" * 600), ("f", 1, "短")], "file string, pos int, text string")
    merged = pipelines.merged_paragraphs(lines, "file", ["pos"]).collect()
    assert {r["first_title"] for r in merged} == {"甲"} and sum(len(r["chunk"]) for r in merged) >= 601
    assert pipelines.chunks_either_way(lines, ["file"], "text", True, 100, 0).count() == pipelines.chunks_either_way(lines, ["file"], "text", False, 100, 0).count()
    assert pipelines.titled_chunks(lines, "file", ["pos"]).count() >= 3


def test_evaluation(spark):
    turns = spark.createDataFrame([(1, 0, "A from User", "hello there"), (1, 1, "B to User", "good day"), (1, 2, "A from User", "and now"), (2, 0, "B to User", "first")], "conv int, turn int, speaker string, text string")
    examples = pipelines.evaluation_set(turns, "conv", "turn", 12, 4)
    row = examples.first()
    assert examples.count() == 1 and len(row["prompt"]) == 8 and "".join(map(chr, row["answer"])) == "B to Usergood day"
    right = examples.select("conv", "turn", F.concat("prompt", "answer", F.array(F.lit(2))).alias("generated"))
    assert pipelines.evaluate(right, examples, ["conv", "turn"], 2).first()["bleu_4"] == pytest.approx(1.0)
    wrong = right.withColumn("generated", F.array(F.lit(5)))
    assert pipelines.evaluate(wrong, examples, ["conv", "turn"], 2).first()["bleu_1"] == 0.0
