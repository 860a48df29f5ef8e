"""Queries of sources, model stages and whole pipelines, with SQL twins: the stand-in model answers by rule, so SQL can too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.catalog import CHUNKS, LINES, OPENS, PARAS, SEQUENCES, SETS, TURNS, _edges, _nodes, _pairs, _sections_sql, _sequences, _sql_clean, chunks, dialogue_lines, paras, query, sets, turns
from silkmill.functions import text as X
from silkmill.operators import chunking, graph, layout, metrics, qa, sampling, triage
from silkmill.plans import model, pipelines
from silkmill.session import read_table, scratch_folder
from silkmill.sources import files
from silkmill.streaming.accepted import append_accepted

# ---------------------------------------------------------------------------------------------- SQL of shared parts


def stub(prompt: str) -> str:
    """What the stand-in model answers."""
    return f"""(SELECT CASE WHEN contains(_p, 'True') AND contains(_p, 'False') THEN CASE WHEN right(md5(_p), 1) IN ('0', '4', '8', 'c') THEN 'False' ELSE 'True' END
        WHEN contains(_p, 'JSON') THEN '{{"answer": "' || left(md5(_p), 8) || '"}}' ELSE 'answer ' || left(md5(_p), 8) END FROM (SELECT {prompt} AS _p))"""


def yes(prompt: str) -> str:
    return f"contains({stub(prompt)}, 'True')"


PLAIN = "NOT contains({0}, '答案') AND NOT contains({0}, chr(10)) AND NOT contains({0}, 'None')"
TAIL = "list_filter(held, lambda e, j: length(array_to_string(held[j:], '')) <= least({overlap}, {size} - length(x)))"


def split_sql(source: str, keys: str, size: int, overlap: int, separators: tuple[str, ...], above: int | None = None) -> str:
    """(keys, chunk_no, chunk) of ``source`` (keys, t) by the rule of the recursive splitter: a level of folds per separator.

    Texts of at most ``above`` characters stay whole.
    """
    out = f"WITH RECURSIVE l0 AS (SELECT {keys}, [0] AS path, t FROM {source} WHERE length(t) > 0)"
    whole = f" AND (len(path) > 1 OR length(t) > {above})" if above is not None else ""
    for k, sep in enumerate(separators):
        s = "'" + sep.replace("\n", "' || chr(10) || '") + "'"
        wanted = f"length(t) > {size}" + (f" AND contains(t, {s})" if sep else "") + whole
        parts = f"list_filter(list_transform(string_split(t, {s}), lambda x, i: CASE WHEN i < len(string_split(t, {s})) THEN x || {s} ELSE x END), lambda x: x <> '')" if sep else "list_filter(string_split(t, ''), lambda x: x <> '')"
        joined = "array_to_string(held, '')"
        flushed = f"CASE WHEN len(held) > 0 THEN list_append(out, {joined}) ELSE out END"
        full = f"len(held) > 0 AND length({joined}) + length(x) > {size}"
        out += f""",
            f{k} AS (SELECT {keys}, path, {parts} AS s, 0 AS i, CAST([] AS VARCHAR[]) AS held, CAST([] AS VARCHAR[]) AS out FROM l{k} WHERE {wanted}
                UNION ALL SELECT {keys}, path, s, i + 1,
                    CASE WHEN length(x) > {size} THEN CAST([] AS VARCHAR[]) WHEN {full} THEN list_append({TAIL.format(size=size, overlap=overlap)}, x) ELSE list_append(held, x) END,
                    CASE WHEN length(x) > {size} THEN list_append({flushed}, x) WHEN {full} THEN list_append(out, {joined}) ELSE out END
                FROM (SELECT *, s[i + 1] AS x FROM f{k} WHERE i < len(s))),
            o{k} AS (SELECT {keys}, path, {flushed} AS o FROM f{k} WHERE i = len(s)),
            l{k + 1} AS (SELECT {keys}, path, t FROM l{k} WHERE NOT ({wanted}) UNION ALL SELECT {keys}, list_append(path, CAST(j AS INT)), o[j] FROM o{k}, unnest(generate_series(1, len(o))) AS u(j))"""
    return f"({out} SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY path) - 1 AS INT) AS chunk_no, t AS chunk FROM l{len(separators)})"


def titles_sql(source: str, doc: str, order: str, keys: str) -> str:
    """(keys, first_title, second_title, t) of ``source`` (keys, t): title marks carried down a document."""
    window = f"WINDOW w AS (PARTITION BY {doc} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""(SELECT {keys}, last_value(f IGNORE NULLS) OVER w AS first_title, last_value(sub IGNORE NULLS) OVER w AS second_title, clean AS t FROM (
        SELECT {keys}, CASE WHEN regexp_matches(t, '(####.*####)') THEN replace(regexp_extract(t, '(####.*####)', 1), '####', '') END AS f,
            CASE WHEN regexp_matches(r, '(###.*###)') THEN replace(regexp_extract(r, '(###.*###)', 1), '###', '') END AS sub, regexp_replace(r, '(###.*###)', '', 'g') AS clean
        FROM (SELECT *, regexp_replace(t, '(####.*####)', '', 'g') AS r FROM {source})) {window})"""


MARKED = f"""(SELECT book_id, pos, para_id, CASE WHEN pos % 7 = 0 THEN '####' || coalesce(first_title, '') || '####' WHEN pos % 5 = 0 THEN '###' || coalesce(second_title, '') || '###' ELSE '' END || chr(10) || coalesce(content, '') AS t FROM {PARAS})"""


def marked_lines(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs with title marks in their texts, as in a book's text file."""
    none = lambda c: F.coalesce(c, F.lit(""))
    mark = F.when(F.col("pos") % 7 == 0, F.concat(F.lit("####"), none("first_title"), F.lit("####"))).when(F.col("pos") % 5 == 0, F.concat(F.lit("###"), none("second_title"), F.lit("###"))).otherwise("")
    return paras(s, d).select("book_id", "pos", "para_id", F.concat(mark, F.lit("\n"), none("content")).alias("text"))


# ---------------------------------------------------------------------------------------------- splitting


SPLIT_KEYS = "chunk_id"
CHUNK_TEXT = f"(SELECT chunk_id, page_content AS t FROM {CHUNKS})"


@query(f"SELECT * FROM {split_sql(CHUNK_TEXT, 'chunk_id', 300, 50, chunking.SEPARATORS)}")
def recursive_split(s: SparkSession, d: str) -> DataFrame:
    return chunking.recursive_chunks(chunks(s, d), ["chunk_id"], "page_content", 300, 50)


@query(f"SELECT * FROM {split_sql(CHUNK_TEXT, 'chunk_id', 500, 50, ('。' + chr(10),))}")
def single_separator_split(s: SparkSession, d: str) -> DataFrame:
    return chunking.recursive_chunks(chunks(s, d), ["chunk_id"], "page_content", 500, 50, ("。\n",))


PAGES = f"(SELECT book_id, CAST(chunk_id AS INT) AS page_number, page_content AS text FROM {CHUNKS} WHERE page_content IS NOT NULL)"
#: A word of the tables in place of the usual mark of a bibliography, which they don't hold.
BEFORE_STOP = f"""(SELECT book_id, page_number, string_split(text, '{X.STOP_MARKER}')[1] AS text FROM (
    SELECT *, coalesce(max(CASE WHEN contains(text, '{X.STOP_MARKER}') THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM {PAGES}) WHERE seen = 0)"""
CLEAN_PAGES = f"(SELECT book_id, page_number, {_sql_clean('text')} AS t FROM {BEFORE_STOP})"
LOADED = f"(SELECT book_id, page_number, chunk_no, replace(chunk, chr(65533), '') AS chunk FROM {split_sql(CLEAN_PAGES, 'book_id, page_number', 300, 50, chunking.SEPARATORS)} WHERE length(replace(chunk, chr(65533), '')) >= 64)"
TOTALS = f"(SELECT book_id, CAST(count(*) AS INT) AS total_pages FROM {PAGES} GROUP BY book_id)"


def book_pages(s: SparkSession, d: str) -> DataFrame:
    return chunks(s, d).where(F.col("page_content").isNotNull()).select("book_id", F.col("chunk_id").cast("int").alias("page_number"), F.col("page_content").alias("text"))


@query(f"SELECT l.book_id, page_number, total_pages, chunk_no, replace(chunk, chr(10), '') AS chunk FROM {LOADED} l JOIN {TOTALS} t ON l.book_id IS NOT DISTINCT FROM t.book_id")
def load_chunks(s: SparkSession, d: str) -> DataFrame:
    return pipelines.load_chunks(book_pages(s, d), "book_id", 300, 50)


@query(f"SELECT book_id, page_number, chunk_no, chunk FROM {LOADED}")
def load_strings(s: SparkSession, d: str) -> DataFrame:
    return pipelines.load_strings(book_pages(s, d), "book_id", 300, 50)


@query(
    f"""SELECT replace(chunk, chr(10), '') AS page_content, b.file_path AS source, page_number, t.total_pages, author, subject, chunk_no
       FROM {LOADED} l JOIN {TOTALS} t ON l.book_id = t.book_id JOIN books b ON b.book_id = l.book_id"""
)
def load_documents(s: SparkSession, d: str) -> DataFrame:
    about = read_table(s, d, "books").select("book_id", "file_path", F.col("book_name").alias("title"), "author", "subject", "keywords")
    pages = book_pages(s, d).join(about, "book_id")
    # a path is a book's here, as its number is
    found = pipelines.load_documents(pages.withColumn("file", F.concat_ws("#", "file_path", F.col("book_id").cast("string"))), "file", 300, 50)
    return found.select("page_content", F.substring_index("metadata.source", "#", 1).alias("source"), "metadata.page_number", "metadata.total_pages", "metadata.author", "metadata.subject", "chunk_no")


@query(f"SELECT book_id, page_number, chunk_no, chunk FROM {split_sql(f'''(SELECT book_id, page_number, {_sql_clean(f"string_split(text, '{X.STOP_MARKER}')[1]")} AS t FROM {PAGES})''', 'book_id, page_number', 300, 50, chunking.SEPARATORS)}")
def clean_then_split(s: SparkSession, d: str) -> DataFrame:
    return pipelines.chunks_either_way(book_pages(s, d), ["book_id", "page_number"], "text", True, 300, 50)


@query(f"SELECT book_id, page_number, chunk_no, {_sql_clean('chunk')} AS chunk FROM {split_sql(f'''(SELECT book_id, page_number, string_split(text, '{X.STOP_MARKER}')[1] AS t FROM {PAGES})''', 'book_id, page_number', 300, 50, chunking.SEPARATORS)}")
def split_then_clean(s: SparkSession, d: str) -> DataFrame:
    return pipelines.chunks_either_way(book_pages(s, d), ["book_id", "page_number"], "text", False, 300, 50)


TITLED_KEYS = "book_id, pos, para_id, first_title, second_title"
GATED = f"""(SELECT * FROM (SELECT {TITLED_KEYS}, chunk_no, {_sql_clean('chunk')} AS chunk FROM {split_sql(titles_sql(MARKED, 'book_id', 'pos, para_id', 'book_id, pos, para_id'), TITLED_KEYS, 300, 50, chunking.SEPARATORS)})
    WHERE {yes("'True or False: ' || chunk")})"""


@query(f"SELECT * FROM {GATED}")
def gated_chunks(s: SparkSession, d: str) -> DataFrame:
    """A text book as titled chunks, those kept that the stand-in model lets pass."""
    return pipelines.gated_chunks(marked_lines(s, d), "book_id", ["pos", "para_id"], "True or False: {text}")


@query(
    f"""SELECT chunk_id, chunk_no, chunk FROM (SELECT chunk_id, chunk_no, {_sql_clean('chunk')} AS chunk FROM {split_sql(CHUNK_TEXT, 'chunk_id', 300, 50, chunking.SEPARATORS)}) WHERE {yes("'True or False: ' || chunk")}
       UNION ALL SELECT chunk_id, -1, page_content FROM {CHUNKS}"""
)
def gated_pages(s: SparkSession, d: str) -> DataFrame:
    """Both outputs of the page pipeline: the chunks that pass, and (as chunk -1) the raw text of each page."""
    passed, raw = pipelines.gated_pages(chunks(s, d).select("chunk_id", "page_content"), ["chunk_id"], "page_content", "True or False: {text}")
    return passed.unionByName(raw.select("chunk_id", F.lit(-1).alias("chunk_no"), F.col("page_content").alias("chunk")))


SQUEEZED = f"(SELECT book_id, pos, para_id, first_title, second_title, {_sql_clean('''translate(t, chr(10) || ' ' || chr(9), '')''')} AS t FROM {titles_sql(f'(SELECT book_id, pos, para_id, content AS t FROM {PARAS} WHERE content IS NOT NULL)', 'book_id', 'pos, para_id', 'book_id, pos, para_id')})"


@query(
    f"""WITH p AS (SELECT *, CASE WHEN length(chunk) > 64 THEN 1 ELSE 0 END AS long, coalesce(sum(CASE WHEN length(chunk) > 64 THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY pos, para_id, chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
            FROM {split_sql(SQUEEZED, TITLED_KEYS, 300, 50, chunking.SEPARATORS, above=500)}),
        o AS (SELECT *, (pos, para_id, chunk_no) AS place FROM p),
        g AS (SELECT book_id, island, max(long) AS has_long, max(chunk) FILTER (long = 1) AS t_long, string_agg(chunk, '' ORDER BY pos, para_id, chunk_no) FILTER (long = 0) AS shorts,
                arg_max({{'a': first_title, 'b': second_title}}, place) FILTER (long = 1) AS own, arg_max({{'a': first_title, 'b': second_title}}, place) AS last FROM o GROUP BY book_id, island)
       SELECT book_id, CAST(island AS INT) AS island, 0 AS part, t_long AS chunk, own.a AS first_title, own.b AS second_title FROM g WHERE has_long = 1
       UNION ALL SELECT book_id, CAST(island AS INT), 1, shorts, CASE WHEN has_long = 1 THEN own.a ELSE last.a END, CASE WHEN has_long = 1 THEN own.b ELSE last.b END FROM g WHERE shorts IS NOT NULL"""
)
def merged_paragraphs(s: SparkSession, d: str) -> DataFrame:
    lines = paras(s, d).where(F.col("content").isNotNull()).select("book_id", "pos", "para_id", F.col("content").alias("text"))
    return pipelines.merged_paragraphs(lines, "book_id", ["pos", "para_id"])


# ---------------------------------------------------------------------------------------------- questions and answers


@query(f"SELECT qa_id, sum(CASE WHEN {yes('p')} THEN 1 ELSE 0 END) * 2 >= count(*) AS verdict FROM (SELECT qa_id, 'True or False: ' || coalesce(content, '') || chr(10) || '#' || i AS p FROM {SETS}, unnest(generate_series(1, 3)) AS t(i)) GROUP BY qa_id")
def model_vote(s: SparkSession, d: str) -> DataFrame:
    """A yes-or-no question asked three times of the stand-in model, decided by majority."""
    return model.vote(sets(s, d), "qa_id", F.concat(F.lit("True or False: "), F.coalesce("content", F.lit(""))))


@query(f"SELECT qa_id, a = 'True' AS strict, CASE WHEN a = 'True' THEN a ELSE 'other' END AS named, CAST(NULL AS VARCHAR) AS error FROM (SELECT qa_id, {stub(chr(39) + 'True or False: ' + chr(39) + ' || coalesce(book_name, ' + chr(39) * 2 + ')')} AS a FROM {SETS})")
def model_answers(s: SparkSession, d: str) -> DataFrame:
    """Answers of the stand-in model, as strict booleans and as an enumeration with a default."""
    asked = model.ask(sets(s, d).select("qa_id", "book_name"), F.concat(F.lit("True or False: "), F.coalesce("book_name", F.lit(""))), model.StubModel)
    return asked.select("qa_id", model.strict_bool(F.col("answer")).alias("strict"), model.one_of(F.col("answer"), ["True"], "other").alias("named"), "error")


@query(
    f"""SELECT book_id, para_id, Q, A FROM (SELECT book_id, para_id, A, {stub("'ask about ' || A")} AS Q FROM (SELECT book_id, para_id, {stub('content')} AS A FROM (
            SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY md5('5:' || para_id), para_id) AS n FROM {PARAS} WHERE length(content) > 64 AND length(content) < 2048
            AND book_id NOT IN (SELECT book_id FROM documents WHERE book_id IS NOT NULL AND source = 'case_reports'))
        WHERE n <= 400 AND {yes("'True or False: ' || content")}) WHERE NOT contains(A, 'None'))
       WHERE NOT contains(Q, '答案') AND NOT contains(Q, chr(10)) AND {yes("'True or False: ' || Q || ' ' || A")}"""
)
def verified_qa(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs of books not done yet, through the four model stages to checked question and answer."""
    templates = {"relevant": "True or False: {text}", "summary": "{text}", "question": "ask about {text}", "check": "True or False: {Q} {A}"}
    done = read_table(s, d, "documents").where((F.col("source") == "case_reports") & F.col("book_id").isNotNull()).select("book_id")
    return pipelines.verified_qa(paras(s, d).where(F.col("book_id").isNotNull()), "book_id", "para_id", "content", templates, 5, done=done)


@query(f"SELECT para_id, CAST(i AS INT) AS sample_no, Q FROM (SELECT para_id, i, {stub(chr(39) + 'ask ' + chr(39) + ' || i || ' + chr(39) + ': ' + chr(39) + ' || coalesce(content, ' + chr(39) * 2 + ')')} AS Q FROM {PARAS}, unnest(generate_series(0, 4)) AS t(i)) WHERE {PLAIN.format('Q')}")
def sampled_questions(s: SparkSession, d: str) -> DataFrame:
    return pipelines.sampled_questions(paras(s, d), "para_id", "content", "ask {n}: {text}")


@query(
    f"""SELECT para_id, array_to_string(list(Q ORDER BY i), '¦') AS questions FROM (SELECT para_id, i, {stub("'ask ' || i || ': ' || coalesce(content, '')")} AS Q FROM {PARAS}, unnest(generate_series(0, 4)) AS t(i))
       WHERE {PLAIN.format('Q')} AND {yes("'For doctors, True or False: ' || Q")} GROUP BY para_id"""
)
def checked_questions(s: SparkSession, d: str) -> DataFrame:
    checks = {"D": "For doctors, True or False: {text}", "P": "For patients, True or False: {text}"}
    found = pipelines.checked_questions(paras(s, d), "para_id", "content", "ask {n}: {text}", checks, "D")
    return found.select("para_id", F.array_join("Q", "¦").alias("questions"))


REFINED = "array_to_string(list_filter(list_transform(q, lambda x: CASE WHEN starts_with(string_split(x, chr(10))[1], '1.') THEN substr(string_split(x, chr(10))[1], 3) ELSE string_split(x, chr(10))[1] END), lambda x: NOT contains(x, '答案')), '¦')"


@query(
    f"""SELECT qa_id, {REFINED} AS questions, 0 AS part_no FROM {SETS} WHERE book_id % 2 = 0 AND q IS NOT NULL
       UNION ALL SELECT qa_id, {REFINED}, 1 FROM {SETS} WHERE book_id % 2 = 1 AND q IS NOT NULL UNION ALL SELECT example_id, {REFINED}, 2 FROM (SELECT DISTINCT example_id, [question] AS q FROM all_function_res_qas WHERE question IS NOT NULL)"""
)
def merged_questions(s: SparkSession, d: str) -> DataFrame:
    """Sets from several sources, refined and in one table."""
    own = sets(s, d).where(F.col("q").isNotNull()).select("qa_id", "q", "book_id")
    asked = read_table(s, d, "all_function_res_qas").where(F.col("question").isNotNull()).select(F.col("example_id").alias("qa_id"), F.array("question").alias("q")).distinct()
    part = lambda k: own.where(F.col("book_id") % 2 == k).drop("book_id")
    return pipelines.refine_and_merge(part(0), part(1), asked).select("qa_id", F.array_join("q", "¦").alias("questions"), "part_no")


@query(f"SELECT qa_id, {stub(chr(39) + 'sum up ' + chr(39) + ' || coalesce(content, ' + chr(39) * 2 + ')')} AS summary, {stub(chr(39) + 'sum up or say so: ' + chr(39) + ' || coalesce(content, ' + chr(39) * 2 + ')')} AS strict_summary FROM {SETS}")
def model_summaries(s: SparkSession, d: str) -> DataFrame:
    return pipelines.summaries(sets(s, d).select("qa_id", "content"), "content", "sum up {text}", "sum up or say so: {text}").select("qa_id", "summary", "strict_summary")


@query(f"SELECT qa_id, 0 AS n FROM {SETS}")
def model_keywords(s: SparkSession, d: str) -> DataFrame:
    """The stand-in model writes no list, so that none is found."""
    return pipelines.keyword_lists(sets(s, d).select("qa_id", "content"), "content", "keywords of {text}").select("qa_id", F.size("keywords").alias("n"))


@query(f"SELECT page, text, {stub(chr(39) + 'clean ' + chr(39) + ' || text')} AS cleaned FROM (SELECT user_id AS page, string_agg(event_type, chr(10) || chr(10) ORDER BY event_id) AS text FROM events GROUP BY user_id)")
def recognised_texts(s: SparkSession, d: str) -> DataFrame:
    lines = read_table(s, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), F.col("event_type").alias("text"))
    return pipelines.recognised_texts(lines, "page", "clean {text}")


@query("SELECT doc_id, CAST(i - 1 AS INT) AS seq, l[i] AS text, CAST(1 AS DOUBLE) AS score FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL), unnest(generate_series(1, len(l))) AS t(i)")
def recognised_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines that the stand-in recogniser reads in images, which are texts here."""
    return model.recognise(read_table(s, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("image")), "image")


@query(f"SELECT qa_id, CASE WHEN coalesce(len(q), 0) = 0 THEN coalesce(book_name, '') ELSE {stub(chr(39) + 'name ' + chr(39) + ' || array_to_string(q, ' + chr(39) + ',' + chr(39) + ')')} END AS answer FROM {SETS}")
def model_nodes(s: SparkSession, d: str) -> DataFrame:
    """A node named by the model from its labels; one without labels keeps its condition, and no model is asked."""
    rows = sets(s, d).select("qa_id", "q", F.coalesce("book_name", F.lit("")).alias("condition"))
    return model.new_nodes(rows, "q", F.col("condition"), F.concat(F.lit("name "), F.array_join("q", ","))).select("qa_id", "answer")


@query(
    f"""SELECT conv_id, {stub("c")} AS answer FROM (SELECT conv_id, string_agg(CASE turn WHEN 0 THEN 'system' WHEN 1 THEN 'human' ELSE 'ai' END || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS c FROM {TURNS} GROUP BY conv_id)"""
)
def model_chat(s: SparkSession, d: str) -> DataFrame:
    """Whole conversations, as lists of roles and texts, answered by the stand-in model."""
    kind = F.when(F.col("turn") == 0, "system").when(F.col("turn") == 1, "human").otherwise("doctor")
    gathered = turns(s, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", kind.alias("role"), "text"))).alias("m"))
    return model.chat(gathered, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))).select("conv_id", "answer")


TASK = """(SELECT source, string_agg(n || '. ' || doc_id, chr(10) ORDER BY n) AS examples FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('4:' || doc_id), doc_id) AS n FROM documents WHERE source IS NOT NULL) WHERE n <= 10 GROUP BY source)"""


@query(f"SELECT source, examples FROM {TASK}")
def few_shot_sample(s: SparkSession, d: str) -> DataFrame:
    docs = read_table(s, d, "documents").where(F.col("source").isNotNull())
    return sampling.example_prompt(docs.select("doc_id", "source", F.col("doc_id").cast("string").alias("shown")), ["source"], "doc_id", "shown", 10, 4)


@query(
    f"""WITH i AS (SELECT source, {stub("'new task like ' || examples")} AS instruction FROM {TASK}),
        v AS (SELECT source, instruction, arg_min(a = 'True', n) AS is_classification FROM (SELECT *, {stub("'True or False? ' || instruction || ' ' || n")} AS a FROM i, unnest(generate_series(0, 4)) AS t(n)) GROUP BY source, instruction)
       SELECT source, instruction, is_classification, CASE WHEN is_classification THEN {stub("'classes of ' || instruction")} ELSE {stub("'do ' || instruction")} END AS instance FROM v"""
)
def self_instruct(s: SparkSession, d: str) -> DataFrame:
    docs = read_table(s, d, "documents").where(F.col("source").isNotNull()).select("doc_id", "source", F.col("doc_id").cast("string").alias("shown"))
    templates = {"instruction": "new task like {examples}", "identify": "True or False? {task} {n}", "classify": "classes of {task}", "other": "do {task}"}
    return pipelines.self_instruct(docs, "source", "doc_id", "shown", templates, 10, 4)


@query(
    f"""WITH RECURSIVE base AS (SELECT example_id, fn, {stub("'ask ' || fn")} AS q FROM (SELECT example_id, {stub("'JSON of ' || coalesce(question, '')")} AS fn FROM (SELECT DISTINCT example_id, question FROM all_function_res_qas))),
        g AS (SELECT example_id, fn, [q] AS held, 0 AS no, 0 AS try, -1 AS found_no, -1 AS found_try FROM base
            UNION ALL SELECT example_id, fn, CASE WHEN ok THEN list_append(held, 'question ' || left(h, 8)) ELSE held END, CASE WHEN ok OR try = 1 THEN no + 1 ELSE no END, CASE WHEN ok OR try = 1 THEN 0 ELSE try + 1 END,
                CASE WHEN ok THEN no ELSE -1 END, CASE WHEN ok THEN try ELSE -1 END
            FROM (SELECT *, right(h, 1) NOT IN ('0', '4', '8', 'c') AS ok FROM (SELECT *, md5('more of ' || fn || chr(10) || array_to_string(list_transform(held, lambda x, i: (i - 1) || '. ' || x), chr(10)) || chr(10) || '#' || try) AS h FROM g WHERE no < 3)))
       SELECT example_id, found_no AS example_no, found_try AS attempt, list_last(held) AS question FROM g WHERE found_no >= 0"""
)
def function_dataset(s: SparkSession, d: str) -> DataFrame:
    """Function-calling examples in three stages, each prompt with the questions accepted before it."""
    described = read_table(s, d, "all_function_res_qas").select("example_id", "question").distinct()
    templates = {"function": "JSON of {description}", "question": "ask {function}", "more": "more of {function}\n{questions}"}
    return pipelines.function_dataset(described, "example_id", "question", templates, wanted=3, tries=2).select("example_id", "example_no", "attempt", "question")


# ---------------------------------------------------------------------------------------------- dialogues


@query(
    f"""WITH m AS (SELECT file, line_no, line, {OPENS} AS h FROM {LINES} WHERE length(line) > 0),
        r AS (SELECT *, sum(CASE WHEN h = 'urls' THEN 1 ELSE 0 END) OVER w AS record_no, last_value(h IGNORE NULLS) OVER w AS part FROM m WINDOW w AS (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        g AS (SELECT file, CAST(record_no AS INT) AS record_no, max(CASE WHEN h = 'urls' THEN list_last(string_split(line, '=')) END) AS id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h IS NULL AND part = 'Description'), '') AS t FROM r GROUP BY file, record_no)
       SELECT file, record_no, id, {_sections_sql()} FROM g"""
)
def dialogues_to_json(s: SparkSession, d: str) -> DataFrame:
    found = pipelines.dialogues_to_json(dialogue_lines(s, d), "file", F.floor(F.col("line_no") / 50_000))
    return found.select("file", "record_no", "id", "parsed.*")


@query(
    f"""WITH RECURSIVE w AS (SELECT conv_id // 512 AS shard, conv_id, CAST(k AS INT) AS window_no, CASE WHEN n > 2048 THEN input_ids[k * 1536 + 1 : k * 1536 + 2048] ELSE input_ids END AS i,
                CASE WHEN n > 2048 THEN labels[k * 1536 + 1 : k * 1536 + 2048] ELSE labels END AS l, n > 2048 AS cut
            FROM (SELECT *, len(input_ids) AS n FROM {SEQUENCES}), unnest(generate_series(0, CASE WHEN n > 2048 THEN (n - 1) // 1536 ELSE 0 END)) AS t(k)),
        p AS (SELECT *, len(i) AS n, row_number() OVER (PARTITION BY shard ORDER BY conv_id, window_no) AS rn FROM w WHERE NOT cut OR (len(l) >= 12 AND len(list_filter(l[2:], lambda x: x >= 0)) > 0)),
        f AS (SELECT shard, rn, n AS held, 0 AS bin_no FROM p WHERE rn = 1
            UNION ALL SELECT p.shard, p.rn, CASE WHEN held + p.n > 2048 THEN p.n ELSE held + p.n END, CASE WHEN held + p.n > 2048 THEN bin_no + 1 ELSE bin_no END FROM f JOIN p ON p.shard = f.shard AND p.rn = f.rn + 1)
       SELECT p.shard, bin_no, conv_id, window_no, CAST(n AS INT) AS n, array_to_string(i, ',') AS input_ids, array_to_string(l, ',') AS labels FROM p JOIN f ON p.shard = f.shard AND p.rn = f.rn"""
)
def entry_pipeline(s: SparkSession, d: str) -> DataFrame:
    """Dialogues tokenised, masked, cut, filtered and packed into training windows."""
    ids = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    packed = pipelines.training_windows(turns(s, d), "conv_id", "turn", F.lit("Be brief."), F.floor(F.col("conv_id") / 512), 2048, 1536)
    return packed.select("shard", "bin_no", "conv_id", "window_no", "n", ids("input_ids"), ids("labels"))


WEIGHTS = {"0": 0.5, "1": 0.3, "2": 0.2}
NEED = "(SELECT * FROM (VALUES (0, 60), (1, 36), (2, 24)) AS v(source, need))"


@query(
    f"""WITH RECURSIVE d AS (SELECT *, conv_id % 3 AS source FROM {SEQUENCES}),
        r AS (SELECT d.*, need, row_number() OVER (PARTITION BY d.source ORDER BY md5('21:' || conv_id), conv_id) AS rank, count(*) OVER (PARTITION BY d.source) AS size FROM d JOIN {NEED} v ON v.source = d.source),
        x AS (SELECT *, row_number() OVER (ORDER BY md5('22:' || conv_id || ':' || CAST(k AS INT)), conv_id, k) AS draw_no FROM r, unnest(generate_series(0, (need - rank) // size)) AS t(k) WHERE need >= rank),
        w AS (SELECT (draw_no - 1) // 30 AS shard, draw_no, conv_id, CAST(j AS INT) AS window_no, CASE WHEN n > 256 THEN input_ids[j * 192 + 1 : j * 192 + 256] ELSE input_ids END AS i, CASE WHEN n > 256 THEN labels[j * 192 + 1 : j * 192 + 256] ELSE labels END AS l, n > 256 AS cut
            FROM (SELECT *, len(input_ids) AS n FROM x), unnest(generate_series(0, CASE WHEN n > 256 THEN (n - 1) // 192 ELSE 0 END)) AS t(j)),
        p AS (SELECT *, len(i) AS n, row_number() OVER (PARTITION BY shard ORDER BY draw_no, window_no) AS rn FROM w WHERE NOT cut OR (len(l) >= 12 AND len(list_filter(l[2:], lambda x: x >= 0)) > 0)),
        f AS (SELECT shard, rn, n AS held, 0 AS bin_no FROM p WHERE rn = 1
            UNION ALL SELECT p.shard, p.rn, CASE WHEN held + p.n > 256 THEN p.n ELSE held + p.n END, CASE WHEN held + p.n > 256 THEN bin_no + 1 ELSE bin_no END FROM f JOIN p ON p.shard = f.shard AND p.rn = f.rn + 1)
       SELECT p.shard, bin_no, CAST(draw_no AS INT) AS draw_no, CAST(conv_id AS VARCHAR) AS conv_id, window_no, CAST(n AS INT) AS n, array_to_string(l, ',') AS labels FROM p JOIN f ON p.shard = f.shard AND p.rn = f.rn"""
)
def mixed_windows(s: SparkSession, d: str) -> DataFrame:
    """Training windows of dialogues drawn from three sources by weight, in a seeded order."""
    said = turns(s, d).withColumn("source", (F.col("conv_id") % 3).cast("string"))
    packed = pipelines.mixed_windows(said, "conv_id", "turn", "source", WEIGHTS, 120, 21, F.lit("Be brief."), 4, 256, 192)
    name = F.split(F.col("dialogue"), "[:#]")
    return packed.select("shard", "bin_no", name[0].cast("int").alias("draw_no"), name[1].alias("conv_id"), "window_no", "n", F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"))


# ---------------------------------------------------------------------------------------------- metrics


def bleu_sql(pairs: str) -> str:
    """bleu_1 to bleu_4 of ``pairs`` (id, c, r), texts whose characters are the tokens."""
    grams = " UNION ALL ".join(f"SELECT id, {n} AS n, substr({side}, CAST(i AS INT), {n}) AS gram, {int(side == 'c')} AS c, {int(side == 'r')} AS r FROM pairs, unnest(generate_series(1, length({side}) - {n - 1})) AS t(i)" for n in range(1, 5) for side in "cr")
    scores = ", ".join(f"round(coalesce(penalty * exp(({' + '.join(f'ln(m{k} / t{k})' for k in range(1, n + 1))}) / {n}), 0), 9) AS bleu_{n}" for n in range(1, 5))
    sums = ", ".join(f"sum(least(c, r)) FILTER (n = {n}) AS m{n}, sum(c) FILTER (n = {n}) AS t{n}" for n in range(1, 5))
    return f"""WITH pairs AS {pairs}, g AS (SELECT id, n, gram, sum(c) AS c, sum(r) AS r FROM ({grams}) GROUP BY id, n, gram),
        s AS (SELECT {sums}, sum(r) FILTER (n = 1) AS r FROM g), b AS (SELECT *, CASE WHEN t1 >= r THEN 1.0 ELSE exp(1 - r / t1) END AS penalty FROM s)
       SELECT {scores} FROM b"""


PAIRS = f"(SELECT qa_id AS id, q[1] AS c, q[2] AS r FROM {SETS} WHERE len(q) >= 2 AND q[1] IS NOT NULL AND q[2] IS NOT NULL)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) for c in df.columns])


@query(bleu_sql(PAIRS))
def bleu_corpus(s: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.bleu(_pairs(s, d), "qa_id", F.col("c"), F.col("r")))


ANSWERS = f"""(SELECT conv_id || ':' || turn AS id, left(answer, length(answer) - 2) AS c, answer AS r FROM (SELECT conv_id, turn, speaker, speaker || text AS answer, count(*) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n
    FROM {TURNS} WHERE text IS NOT NULL) WHERE n > 0 AND contains(lower(speaker), 'to ') AND length(answer) > 2)"""


@query(bleu_sql(ANSWERS))
def evaluation_scores(s: SparkSession, d: str) -> DataFrame:
    """Evaluation set, generated tokens (here: the prompt, its answer without the last two tokens, the end) and their scores."""
    examples = pipelines.evaluation_set(turns(s, d).where(F.col("text").isNotNull()), "conv_id", "turn", 512, 128).where(F.size("answer") > 2)
    said = F.slice("answer", F.lit(1), F.size("answer") - 2)
    generated = examples.select("conv_id", "turn", F.concat("prompt", said, F.array(F.lit(2))).alias("generated"))
    return _rounded(pipelines.evaluate(generated, examples, ["conv_id", "turn"], 2))


def _rouge_sql(n: int) -> str:
    return f"""(SELECT id, CASE WHEN sum(least(c, r)) > 0 THEN 2.0 * sum(least(c, r)) / (sum(c) + sum(r)) ELSE 0.0 END AS f1 FROM (SELECT id, gram, sum(c) AS c, sum(r) AS r FROM (
        SELECT id, substr(c, CAST(i AS INT), {n}) AS gram, 1 AS c, 0 AS r FROM pairs, unnest(generate_series(1, length(c) - {n - 1})) AS t(i) UNION ALL SELECT id, substr(r, CAST(i AS INT), {n}), 0, 1 FROM pairs, unnest(generate_series(1, length(r) - {n - 1})) AS t(i)) GROUP BY id, gram) GROUP BY id)"""


@query(f"WITH pairs AS {PAIRS} SELECT a.id AS qa_id, round(a.f1, 9) AS rouge_1, round(b.f1, 9) AS rouge_2 FROM {_rouge_sql(1)} a JOIN {_rouge_sql(2)} b ON a.id = b.id")
def rouge_scores(s: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(s, d)
    of = lambda n: metrics.rouge_n(pairs, "qa_id", F.col("c"), F.col("r"), n).select("qa_id", F.round("f1", 9).alias(f"rouge_{n}"))
    return of(1).join(of(2), "qa_id")


@query()
def rouge_longest(s: SparkSession, d: str) -> DataFrame:
    """Scores by longest common subsequences, of the whole texts and of their sentences."""
    both = sets(s, d).where((F.size("q") >= 2) & F.col("q")[0].isNotNull() & F.col("q")[1].isNotNull()).select("qa_id", F.col("q")[0].alias("a"), F.col("q")[1].alias("b"))
    return both.select("qa_id", metrics.rouge_l(X.tokens(F.col("a")), X.tokens(F.col("b"))).alias("rouge_l"), metrics.rouge_lsum(F.col("a"), F.col("b")).alias("rouge_lsum"))


@query("SELECT round(avg(value), 9) AS mean_loss, count(value) AS batches FROM events")
def mean_loss(s: SparkSession, d: str) -> DataFrame:
    return metrics.mean_loss(read_table(s, d, "events"), "value").withColumn("mean_loss", F.round("mean_loss", 9))


# ---------------------------------------------------------------------------------------------- tables and layout


@query(
    """SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 0 WHEN p_retailprice < 1500 THEN 1 WHEN p_retailprice < 2000 THEN 2 ELSE 0 END AS col_no,
        CAST((SELECT count(DISTINCT q.p_size) FROM part q WHERE q.p_type = part.p_type AND q.p_size <= part.p_size) - 1 AS INT) AS start_no FROM part"""
)
def column_lookup(s: SparkSession, d: str) -> DataFrame:
    """The column of a price between fixed borders, and of a size among those at which its own type's columns begin."""
    parts = read_table(s, d, "part")
    borders = layout.column_borders([1000.0, 1500.0], 900.0, 2000.0)
    starts = parts.groupBy("p_type").agg(F.array_sort(F.collect_set("p_size")).alias("starts"))
    return parts.join(starts, "p_type").select("p_partkey", layout.column_of(F.col("p_retailprice"), borders).alias("col_no"), layout.last_start(F.col("p_size"), F.col("starts")).alias("start_no"))


def nested_pages(s: SparkSession, d: str) -> DataFrame:
    """Events as pages of blocks, lines and spans."""
    e = read_table(s, d, "events").select("user_id", "event_id", "event_type", (F.col("event_id") % 3).alias("b"), (F.col("event_id") % 7).alias("l"))
    span = F.struct("event_id", (F.col("event_id") * 7 % 500).cast("double").alias("x0"), (F.col("event_id") * 7 % 500 + 8).cast("double").alias("x1"), F.col("event_type").alias("text"))
    line = e.groupBy("user_id", "b", "l").agg(F.array_sort(F.collect_list(span)).alias("s"))
    spans = F.transform("s", lambda x: F.struct(x["x0"].alias("x0"), x["x1"].alias("x1"), x["text"].alias("text")))
    lines = line.select("user_id", "b", F.struct("l", F.struct((F.col("l") * 20).cast("double").alias("y0"), (F.col("l") * 20 + 12).cast("double").alias("y1"), spans.alias("spans")).alias("line")).alias("x"))
    block = lines.groupBy("user_id", "b").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]).alias("lines"))
    return block.groupBy(F.col("user_id").alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("b", F.struct("lines").alias("block")))), lambda x: x["block"]).alias("blocks"))


FLAT_SPANS = """(SELECT user_id AS page, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY event_id % 3) - 1 AS INT) AS block_no, CAST(dense_rank() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id % 7) - 1 AS INT) AS line_no,
    CAST(row_number() OVER (PARTITION BY user_id, event_id % 3, event_id % 7 ORDER BY event_id) - 1 AS INT) AS span_no, CAST(event_id % 7 * 20 AS DOUBLE) AS y0, CAST(event_id * 7 % 500 AS DOUBLE) AS x0, event_type AS text FROM events)"""


@query(f"SELECT page, block_no, line_no, span_no, y0, x0, text FROM {FLAT_SPANS}")
def page_spans(s: SparkSession, d: str) -> DataFrame:
    return layout.page_spans(nested_pages(s, d), "page").select("page", "block_no", "line_no", "span_no", "y0", "x0", "text")


@query(
    f"""WITH k AS (SELECT *, x0 + 8 AS x1, CAST(block_no AS BIGINT) * 1000000000000 + line_no * 1000000 + span_no AS seq FROM {FLAT_SPANS} WHERE y0 >= 20 AND y0 + 12 <= 112 AND x0 >= 10 AND x0 + 8 <= 400),
        g AS (SELECT *, sum(CASE WHEN abs(x0 - prev) > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY page, block_no, line_no ORDER BY x0, seq ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, lag(x1) OVER (PARTITION BY page, block_no, line_no ORDER BY x0, seq) AS prev FROM k)),
        m AS (SELECT page, block_no, line_no, y0, min(x0) AS x0, string_agg(text, '' ORDER BY x0, seq) AS text FROM g GROUP BY page, block_no, line_no, y0, island),
        c AS (SELECT page, x0, row_number() OVER (PARTITION BY page ORDER BY x0) - 1 AS col_no FROM (SELECT DISTINCT page, x0 FROM m))
       SELECT page, y0, CAST(col_no AS INT) AS col_no, string_agg(text, ' ' ORDER BY block_no, line_no, x0) AS text FROM m JOIN c USING (page, x0) GROUP BY page, y0, col_no"""
)
def spans_table(s: SparkSession, d: str) -> DataFrame:
    """The table inside a rectangle of nested pages."""
    return layout.spans_table(nested_pages(s, d), "page", [10.0, 20.0, 400.0, 112.0])


# ---------------------------------------------------------------------------------------------- graph and library


@query("SELECT o.s_suppkey AS id, CASE WHEN c.id IS NULL THEN o.s_name ELSE 'new ' || c.name END AS name, CASE WHEN c.id IS NULL THEN CAST(o.s_nationkey AS VARCHAR) ELSE 'moved' END AS nation, 'supplier' AS kind, c.id IS NOT NULL AS changed FROM supplier o LEFT JOIN (SELECT s_suppkey * 3 AS id, s_name AS name FROM supplier) c ON o.s_suppkey = c.id")
def node_update(s: SparkSession, d: str) -> DataFrame:
    changes = read_table(s, d, "supplier").select((F.col("s_suppkey") * 3).alias("id"), F.concat(F.lit("new "), "s_name").alias("name"), F.create_map(F.lit("nation"), F.lit("moved")).alias("props"))
    return graph.update_nodes(_nodes(s, d), changes).select("id", "name", F.col("props")["nation"].alias("nation"), F.col("props")["kind"].alias("kind"), "changed")


@query("SELECT s_suppkey * 3 AS id FROM supplier WHERE s_suppkey * 3 NOT IN (SELECT s_suppkey FROM supplier)")
def node_update_missed(s: SparkSession, d: str) -> DataFrame:
    return graph.unmatched(_nodes(s, d), read_table(s, d, "supplier").select((F.col("s_suppkey") * 3).alias("id")))


@query("SELECT 'node' AS kind, s_suppkey AS id FROM (SELECT * FROM supplier ORDER BY s_suppkey OFFSET 40) UNION ALL SELECT 'edge', s_suppkey FROM (SELECT * FROM supplier ORDER BY s_suppkey OFFSET 40)")
def delete_all(s: SparkSession, d: str) -> DataFrame:
    """What is left after deleting the first forty nodes and the edges at them."""
    nodes, edges = graph.delete_all(_nodes(s, d), _edges(s, d), 40)
    return nodes.select(F.lit("node").alias("kind"), "id").unionByName(edges.select(F.lit("edge").alias("kind"), "id"))


@query("SELECT book_id FROM books WHERE list_last(string_split(regexp_replace(file_path, '[.]pdf$', ''), '/')) NOT IN (SELECT DISTINCT list_last(string_split(regexp_replace(file_path, '[.]pdf$', ''), '/')) FROM books WHERE book_id % 3 = 0)")
def images_to_make(s: SparkSession, d: str) -> DataFrame:
    """Books that no image is named after."""
    books = read_table(s, d, "books").select("book_id", "file_path")
    images = books.where(F.col("book_id") % 3 == 0).select(F.concat(F.lit("/img/"), F.regexp_replace(X.base_name(F.col("file_path")), r"\.pdf$", ""), F.lit("__p1__2.png")).alias("image"))
    return triage.unprocessed_books(books, "file_path", images, "image").select("book_id")


LEFT = "(SELECT * FROM (SELECT book_id, list_last(string_split(file_path, '/')) AS filename FROM books) WHERE filename NOT IN (SELECT list_last(string_split(file_path, '/')) FROM books WHERE book_id % 4 = 0))"


@query(
    f"""SELECT book_id, filename, action, CASE WHEN action = 'stay' THEN '其他' END AS department FROM (SELECT book_id, filename, CASE WHEN regexp_matches(filename, '犬|猫|动物|禽|猪|兽|羊') THEN 'delete' WHEN ends_with(lower(filename), '.pdf') OR ends_with(lower(filename), '.txt') THEN 'stay' ELSE 'move' END AS action FROM {LEFT})"""
)
def library_triage(s: SparkSession, d: str) -> DataFrame:
    """Files not placed yet, routed, and those that stay shown to the stand-in model, which names no department."""
    books = read_table(s, d, "books").select("book_id", "file_path")
    placed = books.where(F.col("book_id") % 4 == 0).select(F.concat(F.lit("/placed/"), X.base_name(F.col("file_path"))).alias("at"))
    found = pipelines.library_triage(books, "file_path", placed, "at", "department of {name}", ["内科", "外科"])
    return found.select("book_id", "filename", "action", "department")


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('9:' || doc_id), doc_id) AS INT) AS place FROM documents")
def shuffled_documents(s: SparkSession, d: str) -> DataFrame:
    """Documents in a seeded order; places are counted partition by partition of the range-partitioned sort."""
    ordered = sampling.shuffled(read_table(s, d, "documents").select("doc_id"), "doc_id", 9)
    return sampling.numbered(ordered, "place")


# ---------------------------------------------------------------------------------------------- sources


@query("SELECT p_partkey, p_name FROM part")
def source_jsonl(s: SparkSession, d: str) -> DataFrame:
    """Written as JSON lines in two appended parts and read again."""
    at, parts = scratch_folder(s, "jsonl"), read_table(s, d, "part").select("p_partkey", "p_name")
    files.write_jsonl(parts.where(F.col("p_partkey") % 2 == 0), at)
    files.write_jsonl(parts.where(F.col("p_partkey") % 2 == 1), at, append=True)
    return files.read_jsonl(s, at, "p_partkey bigint, p_name string")


@query("SELECT n_nationkey, n_name FROM nation")
def source_json(s: SparkSession, d: str) -> DataFrame:
    """One array over several lines in each file, which its reader takes apart."""
    at = scratch_folder(s, "json")
    for key in range(5):
        rows = read_table(s, d, "nation").where(F.col("n_regionkey") == key).agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name")), {"pretty": "true"}).alias("t"))
        files.write_text(rows, "t", f"{at}/k={key}")
    return files.read_json(s, f"{at}/*/*.txt", "n_nationkey int, n_name string")


@query("SELECT r_regionkey, pos, text FROM (SELECT r_regionkey, 0 AS pos, r_name AS text FROM region UNION ALL SELECT r_regionkey, 1, 'x' || r_regionkey FROM region)")
def source_delimited(s: SparkSession, d: str) -> DataFrame:
    """Whole text files parted at a separator of several characters."""
    at = scratch_folder(s, "text")
    rows = read_table(s, d, "region").select("r_regionkey", F.concat("r_name", F.lit("。\nx"), F.col("r_regionkey").cast("string")).alias("t"))
    for key in range(5):
        files.write_text(rows.where(F.col("r_regionkey") == key), "t", f"{at}/k={key}")
    parted = files.read_delimited(s, f"{at}/*/*.txt")
    key = F.regexp_extract("file", "k=([0-9]+)", 1).cast("int")
    return parted.select(key.alias("r_regionkey"), "pos", F.regexp_replace("text", "\n$", "").alias("text"))


@query("SELECT page_content, metadata.page_number AS page_number, metadata.title AS title FROM pdf_chunks")
def source_documents(s: SparkSession, d: str) -> DataFrame:
    """Tagged chunks written as JSON and loaded as documents."""
    at = scratch_folder(s, "tagged")
    files.write_jsonl(read_table(s, d, "pdf_chunks").select("page_content", "metadata", F.lit(1).alias("other")), at)
    return files.read_jsonl(s, at, files.CHUNK).select("page_content", F.col("metadata.page_number").alias("page_number"), F.col("metadata.title").alias("title"))


@query("SELECT 'k=' || r_regionkey AS dirs, 'txt' AS ending FROM region")
def source_listing(s: SparkSession, d: str) -> DataFrame:
    """A folder's files of one kind, with their folders below it."""
    at = scratch_folder(s, "files")
    for key in range(5):
        files.write_text(read_table(s, d, "region").where(F.col("r_regionkey") == key).coalesce(1), "r_name", f"{at}/k={key}")
    return triage.file_listing(s, at, "*.txt").select("dirs", F.element_at(F.split("filename", "[.]"), -1).alias("ending"))


@query("SELECT event_id, event_type FROM events WHERE event_type = 'purchase' OR event_id % 2 = 0")
def source_stream(s: SparkSession, d: str) -> DataFrame:
    """JSON lines read as a stream; what is accepted of each batch is written once and read again."""
    at, out, state = (scratch_folder(s, name) for name in ("stream", "accepted", "state"))
    files.write_jsonl(read_table(s, d, "events").select("event_id", "event_type"), at)
    stream = files.stream_jsonl(s, at, "event_id bigint, event_type string")
    append_accepted(stream, lambda b: b.where((F.col("event_type") == "purchase") | (F.col("event_id") % 2 == 0)), out, state).awaitTermination()
    return files.read_jsonl(s, f"{out}/batch=*", "event_id bigint, event_type string")


@query("SELECT sheet_no, p_name AS question, p_brand AS answer FROM (SELECT 0 AS sheet_no, p_name, p_brand FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 1, p_name, p_brand FROM part WHERE p_partkey % 2 = 1)")
def sheet_union(s: SparkSession, d: str) -> DataFrame:
    """Two sheets with more columns than wanted, in one table."""
    sheet = lambda k: read_table(s, d, "part").where(F.col("p_partkey") % 2 == k).select(F.col("p_name").alias("question"), F.col("p_brand").alias("answer"), "p_size")
    return files.read_sheets([sheet(0), sheet(1)], ["question", "answer"])


@query("SELECT p_partkey, p_name || '|it''s ' || p_brand || '|' || p_size AS items FROM part")
def literal_lists(s: SparkSession, d: str) -> DataFrame:
    """Written lists with either kind of quotes, an apostrophe inside one, and a number."""
    written = F.concat(F.lit("['"), "p_name", F.lit("', \"it's "), "p_brand", F.lit("\", "), F.col("p_size").cast("string"), F.lit("]"))
    return read_table(s, d, "part").select("p_partkey", F.array_join(X.literal_list(written), "|").alias("items"))
