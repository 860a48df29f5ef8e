"""Every query of the core, by name, and SQL for those that SQL can express.

Queries run over whole tables. Where the test data lacks an input (layout boxes, dialogue files),
it is derived from another table by plain expressions, the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.functions import text as X
from silkmill.operators import chunking, dialog, graph, layout, metrics, qa, sampling, sections, tool_calls, triage, vectors
from silkmill.operators.tool_tables import argument_table, call_table, child_items, function_table, property_table
from silkmill.plans import pipelines
from silkmill.plans.model import StubModel, ask, embed, one_of, strict_bool, vote
from silkmill.session import read_table
from silkmill.streaming.accepted import windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL twin if it has one."""

    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------------------------------------- inputs

#: Positions of a document per block in order-sensitive operators.
BLOCK = 1024
PARAS = "(SELECT DISTINCT para_id, book_id, pos, page_number, content, first_title, second_title FROM titled_paragraphs)"
CHUNKS = "(SELECT DISTINCT chunk_id, book_id, chunk_no, page_content, metadata.page_number AS page_number FROM pdf_chunks)"
SETS = "(SELECT DISTINCT qa_id, book_id, book_name, content, q, q_ids FROM qa_sets)"
TURNS = f"""(SELECT qa_id AS conv_id, CAST(i - 1 AS INT) AS turn, q[i] AS text,
    CASE (i - 1) % 3 WHEN 0 THEN 'Patient from User' WHEN 1 THEN 'Helper to User' ELSE 'Nurse to Note' END AS speaker
    FROM {SETS}, unnest(generate_series(1, len(q))) AS t(i))"""
EVENTS = "(SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events)"


def paras(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "titled_paragraphs").select("para_id", "book_id", "pos", "page_number", "content", "first_title", "second_title").distinct()


def chunks(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "pdf_chunks").select("chunk_id", "book_id", "chunk_no", "page_content", F.col("metadata.page_number").alias("page_number")).distinct()


def sets(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "qa_sets").select("qa_id", "book_id", "book_name", "content", "q", "q_ids").distinct()


def turns(s: SparkSession, d: str) -> DataFrame:
    speaker = F.element_at(F.array(F.lit("Patient from User"), F.lit("Helper to User"), F.lit("Nurse to Note")), (F.col("turn") % 3 + 1).cast("int"))
    return sets(s, d).select(F.col("qa_id").alias("conv_id"), F.posexplode("q").alias("turn", "text")).withColumn("speaker", speaker)


def events(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "events").select("event_id", "user_id", "event_type", "value", F.floor(F.unix_seconds(F.col("ts").cast("timestamp"))).cast("long").alias("sec"))


def _ids(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def _unicode(expr: str) -> str:
    return f"list_transform(string_split({expr}, ''), lambda c: unicode(c))"


# ------------------------------------------------------------------------------------ nested records


@query()
def p3_found(s: SparkSession, d: str) -> DataFrame:
    return child_items(read_table(s, d, "all_function_res_qas"), read_table(s, d, "function_raw_outputs"))


def _examples(s: SparkSession, d: str, raw: bool = True) -> tuple[DataFrame, DataFrame | None]:
    return read_table(s, d, "all_function_res_qas"), read_table(s, d, "function_raw_outputs") if raw else None


@query()
def p3_functions(s: SparkSession, d: str) -> DataFrame:
    return function_table(*_examples(s, d))


@query()
def p3_properties(s: SparkSession, d: str) -> DataFrame:
    return property_table(*_examples(s, d))


@query()
def p3_calls(s: SparkSession, d: str) -> DataFrame:
    return call_table(*_examples(s, d))


@query()
def p3_arguments(s: SparkSession, d: str) -> DataFrame:
    return argument_table(*_examples(s, d))


FUNCTION = "(SELECT DISTINCT example_id, CAST(i - 1 AS INT) AS function_no, f FROM (SELECT example_id, unnest(function) AS f, generate_subscripts(function, 1) AS i FROM all_function_res_qas) WHERE f IS NOT NULL)"
CALL = "(SELECT DISTINCT example_id, CAST(i - 1 AS INT) AS call_no, p FROM (SELECT example_id, unnest(input_parameters) AS p, generate_subscripts(input_parameters, 1) AS i FROM all_function_res_qas) WHERE p IS NOT NULL)"


@query(f"SELECT example_id, function_no, f.name AS name, f.description AS description, f.parameters.type AS parameters_type FROM {FUNCTION}")
def p3_structured_functions(s: SparkSession, d: str) -> DataFrame:
    """The functions of the structured table alone, as the next ones: SQL can unnest it as well."""
    return function_table(*_examples(s, d, raw=False))


@query(
    f"""SELECT example_id, function_no, CAST(i - 1 AS INT) AS property_no, e.key AS property, e.value.type AS type, e.value.description AS description
       FROM (SELECT example_id, function_no, unnest(map_entries(f.parameters.properties)) AS e, generate_subscripts(map_entries(f.parameters.properties), 1) AS i FROM {FUNCTION})"""
)
def p3_structured_properties(s: SparkSession, d: str) -> DataFrame:
    return property_table(*_examples(s, d, raw=False))


@query(f"SELECT example_id, call_no, p.function_name AS function_name FROM {CALL}")
def p3_structured_calls(s: SparkSession, d: str) -> DataFrame:
    return call_table(*_examples(s, d, raw=False))


@query(
    f"""SELECT example_id, call_no, CAST(i - 1 AS INT) AS argument_no, e.key AS argument, e.value AS value
       FROM (SELECT example_id, call_no, unnest(map_entries(p.arguments)) AS e, generate_subscripts(map_entries(p.arguments), 1) AS i FROM {CALL})"""
)
def p3_structured_arguments(s: SparkSession, d: str) -> DataFrame:
    return argument_table(*_examples(s, d, raw=False))


@query(
    """SELECT example_id, list_name, parent_no, child_no, item FROM (
        SELECT DISTINCT example_id, 'required' AS list_name, CAST(f - 1 AS INT) AS parent_no, CAST(r - 1 AS INT) AS child_no, item FROM (
            SELECT example_id, f, unnest(req) AS item, generate_subscripts(req, 1) AS r FROM (
                SELECT example_id, unnest(function).parameters.required AS req, generate_subscripts(function, 1) AS f FROM all_function_res_qas)))
       WHERE item IS NOT NULL"""
)
def p3_structured_required(s: SparkSession, d: str) -> DataFrame:
    """The required entries of the structured table alone, which SQL can unnest as well."""
    return child_items(read_table(s, d, "all_function_res_qas"), None).where(F.col("list_name") == "required")


# ------------------------------------------------------------------------------------ dialogues


@query(
    f"""SELECT conv_id, turn, n_history, history, answer FROM (
        SELECT conv_id, turn, speaker, speaker || text AS answer,
            count(*) OVER w AS n_history, string_agg(speaker || '|' || text, chr(10)) OVER w AS history
        FROM {TURNS} WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       WHERE n_history > 0 AND contains(lower(speaker), 'to ')"""
)
def prefix_explode(s: SparkSession, d: str) -> DataFrame:
    found = dialog.prefix_examples(turns(s, d), "conv_id", "turn", "speaker", "text", "to ")
    history = F.array_join(F.transform("history", lambda t: F.concat(t["speaker"], F.lit("|"), t["text"])), "\n")
    return found.select("conv_id", "turn", F.size("history").cast("long").alias("n_history"), history.alias("history"), "answer")


ROLE = """CASE WHEN contains(lower(speaker), 'from terminal') THEN 'Terminal: ' WHEN contains(lower(speaker), 'to terminal') THEN 'Command: '
    WHEN contains(lower(speaker), 'to note') THEN 'Record: ' WHEN contains(lower(speaker), 'to user') THEN 'Helper: '
    WHEN contains(lower(speaker), 'from user') THEN 'User: ' END"""


@query(
    f"""SELECT conv_id, turn, {ROLE} AS role, CASE turn WHEN 0 THEN 'system' WHEN 1 THEN 'human' ELSE 'ai' END AS chat_role
       FROM {TURNS} WHERE {ROLE} IS NOT NULL"""
)
def role_map(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("turn") == 0, "system").when(F.col("turn") == 1, "human").otherwise("doctor")
    mapped = turns(s, d).select("conv_id", "turn", dialog.role(F.col("speaker")).alias("role"), dialog.chat_role(kind).alias("chat_role"))
    return mapped.where(F.col("role").isNotNull())


PROMPT = "Instructions: Be brief."


def _sequences(s: SparkSession, d: str) -> DataFrame:
    one = F.struct("turn", dialog.role(F.col("speaker")).alias("role"), X.tokens(F.concat(dialog.role(F.col("speaker")), "text")).alias("ids"), "speaker")
    gathered = turns(s, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    seq = dialog.masked_sequence(X.tokens(F.lit(PROMPT)), F.col("turns"), F.lit(2))
    return gathered.select("conv_id", seq.alias("s")).select("conv_id", F.col("s.input_ids").alias("input_ids"), F.col("s.labels").alias("labels"))


SEQUENCES = f"""(SELECT conv_id, list_concat(p, flatten(list(ids ORDER BY turn))) AS input_ids,
        list_concat(list_transform(p, lambda x: -100), flatten(list(CASE WHEN role IN ('Helper: ', 'Record: ', 'Command: ') THEN ids ELSE list_transform(ids, lambda x: -100) END ORDER BY turn))) AS labels
    FROM (SELECT conv_id, turn, {ROLE} AS role, list_append({_unicode(f"({ROLE}) || text")}, 2) AS ids, list_append({_unicode(f"'{PROMPT}'")}, 2) AS p FROM {TURNS})
    GROUP BY conv_id, p)"""


@query(f"SELECT conv_id, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels FROM {SEQUENCES}")
def mask_labels(s: SparkSession, d: str) -> DataFrame:
    return _sequences(s, d).select("conv_id", _ids(F.col("input_ids")).alias("input_ids"), _ids(F.col("labels")).alias("labels"))


@query(
    f"""SELECT conv_id, window_no, array_to_string(i, ',') AS input_ids, array_to_string(l, ',') AS labels FROM (
        SELECT conv_id, CAST(k AS INT) AS window_no, n > 128 AS cut, CASE WHEN n > 128 THEN input_ids[k * 96 + 1 : k * 96 + 128] ELSE input_ids END AS i,
            CASE WHEN n > 128 THEN labels[k * 96 + 1 : k * 96 + 128] ELSE labels END AS l
        FROM (SELECT *, len(input_ids) AS n FROM {SEQUENCES}), unnest(generate_series(0, CASE WHEN n > 128 THEN (n - 1) // 96 ELSE 0 END)) AS t(k))
       WHERE NOT cut OR (len(l) >= 12 AND len(list_filter(l[2:], lambda x: x >= 0)) > 0)"""
)
def label_windows(s: SparkSession, d: str) -> DataFrame:
    cut = dialog.cut_windows(_sequences(s, d), ["conv_id"], "input_ids", "labels", 128, 96)
    return cut.select("conv_id", "window_no", _ids(F.col("input_ids")).alias("input_ids"), _ids(F.col("labels")).alias("labels"))


@query(f"SELECT doc_id, len(u) AS n, array_to_string(u[greatest(len(u) - 127, 1):], ',') AS tail FROM (SELECT doc_id, {_unicode('text')} AS u FROM documents WHERE length(text) > 0)")
def left_truncate(s: SparkSession, d: str) -> DataFrame:
    ids = read_table(s, d, "documents").where(F.length("text") > 0).select("doc_id", X.tokens(F.col("text")).alias("u"))
    return ids.select("doc_id", F.size("u").cast("long").alias("n"), _ids(dialog.keep_last(F.col("u"), 128)).alias("tail"))


@query(
    f"""SELECT doc_id, array_to_string({_unicode('found')}, ',') AS continuation FROM (
        SELECT doc_id, string_split(substr(text, strpos(text, p) + length(p)), '。')[1] AS found
        FROM (SELECT doc_id, text, substr(text, 5, 6) AS p FROM documents WHERE length(text) > 20))"""
)
def continuation_extract(s: SparkSession, d: str) -> DataFrame:
    docs = read_table(s, d, "documents").where(F.length("text") > 20)
    # as columns of their own, the token arrays are made once and not for every position
    ids = docs.select("doc_id", X.tokens(F.substring("text", 5, 6)).alias("p"), X.tokens(F.col("text")).alias("g"))
    found = ids.select("doc_id", dialog.continuation(F.col("p"), F.col("g"), F.lit(0x3002)).alias("c"))
    return found.select("doc_id", _ids(F.col("c")).alias("continuation"))


@query(f"SELECT qa_id, q_ids[i] AS question_id, q[i] AS question FROM {SETS}, unnest(generate_series(1, least(len(q), len(q_ids)))) AS t(i)")
def zip_questions(s: SparkSession, d: str) -> DataFrame:
    zipped = sets(s, d).select("qa_id", F.explode(dialog.zip_shortest(F.col("q_ids"), F.col("q"), ("a", "b"))).alias("z"))
    return zipped.select("qa_id", F.col("z.a").alias("question_id"), F.col("z.b").alias("question"))


# ------------------------------------------------------------------------------------ texts


def _sql_clean(expr: str) -> str:
    for pattern, new in X.CLEANING.values():
        expr = f"regexp_replace({expr}, '{pattern.replace(chr(39), chr(39) * 2)}', '{new.replace('$1', chr(92) + '1')}', 'g')"
    return f"translate({expr}, '{X.FULL_WIDTH.replace(chr(39), chr(39) * 2)}', '{X.HALF_WIDTH.replace(chr(39), chr(39) * 2)}')"


@query(
    f"""SELECT chunk_id, {_sql_clean('page_content')} AS cleaned, replace(page_content, chr(65533), '') AS no_replacement,
        translate(page_content, chr(10) || ' ' || chr(9), '') AS squeezed FROM {CHUNKS} WHERE page_content IS NOT NULL"""
)
def clean_text(s: SparkSession, d: str) -> DataFrame:
    t = F.col("page_content")
    return chunks(s, d).where(t.isNotNull()).select("chunk_id", X.clean_text(t).alias("cleaned"), X.strip_replacement(t).alias("no_replacement"), X.squeeze(t).alias("squeezed"))


@query(
    f"""SELECT chunk_id, book_id, page_number, replace(replace(page_content, chr(65533), ''), chr(10), '') AS chunk, count(*) OVER (PARTITION BY book_id) AS book_chunks
       FROM {CHUNKS} WHERE length(replace(page_content, chr(65533), '')) >= 64"""
)
def chunk_filter(s: SparkSession, d: str) -> DataFrame:
    kept = chunks(s, d).withColumn("chunk", X.strip_replacement(F.col("page_content"))).where(F.length("chunk") >= 64)
    # counts by group and a join rather than a window: texts of a hot book are not sorted in one task
    counts = kept.groupBy("book_id").agg(F.count("*").alias("book_chunks"))
    joined = kept.join(counts, "book_id")
    return joined.select("chunk_id", "book_id", "page_number", F.replace("chunk", F.lit("\n"), F.lit("")).alias("chunk"), "book_chunks")


@query(f"SELECT para_id, length(content) > 64 AND length(content) < 2048 AS good, content IS NOT NULL AND NOT contains(content, chr(10)) AND NOT contains(content, '答案') AS plain FROM {PARAS}")
def length_filter(s: SparkSession, d: str) -> DataFrame:
    return paras(s, d).select("para_id", X.good_length(F.col("content")).alias("good"), F.coalesce(qa.asks_plainly(F.col("content")), F.lit(False)).alias("plain"))


def _trim_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^:+|:+$', '', 'g'), '^：+|：+$', '', 'g')"


def _sections_sql() -> str:
    out, rest = [], "t"
    for name, marker in X.SECTIONS:
        value = _trim_sql(f"replace(list_last(string_split({rest}, '{marker}')), chr(10), '')")
        out.append(f"CASE WHEN contains({rest}, '{marker}') THEN {value} ELSE '' END AS {name}")
        rest = f"string_split({rest}, '{marker}')[1]"
    return ", ".join(out)


MARK = dict(X.SECTIONS)


@query(
    f"""SELECT para_id, {_sections_sql()} FROM (SELECT para_id, '{MARK["disease"]}' || coalesce(first_title, '') || chr(10) || '{MARK["detail"]}：' || chr(10) || coalesce(content, '')
        || CASE WHEN pos % 2 = 0 THEN chr(10) || '{MARK["past_treatment"]}：' || coalesce(second_title, '') ELSE '' END || chr(10) || '{MARK["purpose"]}：：' || para_id AS t FROM {PARAS})"""
)
def section_parse(s: SparkSession, d: str) -> DataFrame:
    none = lambda c: F.coalesce(c, F.lit(""))
    treated = F.when(F.col("pos") % 2 == 0, F.concat(F.lit(f"\n{MARK['past_treatment']}："), none("second_title"))).otherwise("")
    t = F.concat(F.lit(f"{MARK['disease']}"), none("first_title"), F.lit(f"\n{MARK['detail']}：\n"), none("content"), treated, F.lit(f"\n{MARK['purpose']}：："), F.col("para_id").cast("string"))
    return paras(s, d).select("para_id", X.sections(t).alias("p")).select("para_id", "p.*")


@query(
    f"""SELECT para_id, book_id, coalesce(last_value(f IGNORE NULLS) OVER w, NULL) AS first_title, last_value(sub IGNORE NULLS) OVER w AS second_title, clean AS text FROM (
        SELECT para_id, book_id, pos, CASE WHEN regexp_matches(t, '(####.*####)') THEN replace(regexp_extract(t, '(####.*####)', 1), '####', '') END AS f,
            CASE WHEN regexp_matches(r, '(###.*###)') THEN replace(regexp_extract(r, '(###.*###)', 1), '###', '') END AS sub, regexp_replace(r, '(###.*###)', '', 'g') AS clean
        FROM (SELECT *, regexp_replace(t, '(####.*####)', '', 'g') AS r FROM (
            SELECT para_id, book_id, pos, CASE WHEN pos % 7 = 0 THEN '####' || coalesce(first_title, '') || '####' WHEN pos % 5 = 0 THEN '###' || coalesce(second_title, '') || '###' ELSE '' END || chr(10) || coalesce(content, '') AS t FROM {PARAS})))
       WINDOW w AS (PARTITION BY book_id ORDER BY pos, para_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def title_ffill(s: SparkSession, d: str) -> DataFrame:
    none = lambda c: F.coalesce(c, F.lit(""))
    mark = F.when(F.col("pos") % 7 == 0, F.concat(F.lit("####"), none("first_title"), F.lit("####"))).when(F.col("pos") % 5 == 0, F.concat(F.lit("###"), none("second_title"), F.lit("###"))).otherwise("")
    lines = paras(s, d).select("para_id", "book_id", "pos", F.concat(mark, F.lit("\n"), none("content")).alias("text"))
    return sections.fill_titles(lines, "book_id", ["pos", "para_id"], "text", block=F.floor(F.col("pos") / BLOCK)).select("para_id", "book_id", "first_title", "second_title", "text")


@query(
    f"""SELECT chunk_id, string_split(page_content, '编写组')[1] AS page_content FROM (
        SELECT *, coalesce(max(CASE WHEN contains(page_content, '编写组') THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY chunk_no, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM {CHUNKS})
       WHERE seen = 0"""
)
def stop_marker(s: SparkSession, d: str) -> DataFrame:
    return sections.stop_at_marker(chunks(s, d), "book_id", ["chunk_no", "chunk_id"], "page_content", "编写组", F.floor(F.col("chunk_no") / BLOCK)).select("chunk_id", "page_content")


@query(
    f"""WITH p AS (SELECT *, CASE WHEN length(content) > 64 THEN 1 ELSE 0 END AS long, coalesce(sum(CASE WHEN length(content) > 64 THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY pos, para_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
            FROM {PARAS} WHERE content IS NOT NULL),
        g AS (SELECT book_id, island, max(long) AS has_long, arg_max(first_title, pos) FILTER (long = 1) AS f_long, max(content) FILTER (long = 1) AS t_long,
                string_agg(content, '' ORDER BY pos, para_id) FILTER (long = 0) AS shorts, arg_max(coalesce(first_title, chr(1)), pos) AS f_last, arg_max(coalesce(first_title, chr(1)), pos) FILTER (long = 1) AS f_own FROM p GROUP BY book_id, island)
       SELECT book_id, CAST(island AS INT) AS island, 0 AS part, t_long AS content, nullif(f_own, chr(1)) AS first_title FROM g WHERE has_long = 1
       UNION ALL SELECT book_id, CAST(island AS INT), 1, shorts, nullif(CASE WHEN has_long = 1 THEN f_own ELSE f_last END, chr(1)) FROM g WHERE shorts IS NOT NULL"""
)
def short_coalesce(s: SparkSession, d: str) -> DataFrame:
    return sections.coalesce_shorts(paras(s, d), "book_id", ["pos", "para_id"], "content", ["first_title"], block=F.floor(F.col("pos") / BLOCK))


#: Name of a part of a dialogue record to what its first line begins with.
HEAD = {name: prefix for prefix, name in sections.HEADERS}
LINES = f"""(SELECT 'f' || (conv_id % 10) AS file, conv_id * 100 + k AS line_no, line FROM (
    SELECT qa_id AS conv_id, 0 AS k, '{HEAD["urls"]}=' || qa_id AS line FROM {SETS} UNION ALL SELECT qa_id, 1, 'https://example.org/' || qa_id FROM {SETS}
    UNION ALL SELECT qa_id, 2, '{HEAD["Doctor_faculty"]}' FROM {SETS} UNION ALL SELECT qa_id, 3, coalesce(book_name, '') FROM {SETS} UNION ALL SELECT qa_id, 4, '' FROM {SETS}
    UNION ALL SELECT qa_id, 5, '{HEAD["Description"]}' FROM {SETS} UNION ALL SELECT qa_id, 6, '- ' || replace(coalesce(content, ''), chr(10), ' ') FROM {SETS} UNION ALL SELECT qa_id, 7, '{HEAD["Dialogue"]}' FROM {SETS}
    UNION ALL SELECT conv_id, 8 + turn, '> ' || replace(text, chr(10), ' ') FROM {TURNS}))"""


#: The part that a line opens, null if it opens none.
OPENS = "CASE " + " ".join(f"WHEN starts_with(line, '{prefix}') THEN '{name}'" for prefix, name in sections.HEADERS) + " END"


def dialogue_lines(s: SparkSession, d: str) -> DataFrame:
    base = sets(s, d)
    flat = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" "))
    of = [F.concat(F.lit(HEAD["urls"] + "="), F.col("qa_id").cast("string")), F.concat(F.lit("https://example.org/"), F.col("qa_id").cast("string")), F.lit(HEAD["Doctor_faculty"]), F.coalesce("book_name", F.lit("")), F.lit(""), F.lit(HEAD["Description"]), F.concat(F.lit("- "), flat(F.col("content"))), F.lit(HEAD["Dialogue"])]
    fixed = base.select(F.col("qa_id").alias("conv_id"), F.posexplode(F.array(*of)).alias("k", "line"))
    said = turns(s, d).select("conv_id", (F.col("turn") + 8).alias("k"), F.concat(F.lit("> "), flat(F.col("text"))).alias("line"))
    both = fixed.unionByName(said)
    return both.select(F.concat(F.lit("f"), (F.col("conv_id") % 10).cast("string")).alias("file"), (F.col("conv_id") * 100 + F.col("k")).alias("line_no"), "line")


@query(
    f"""WITH m AS (SELECT file, line_no, line, {OPENS} AS h
            FROM {LINES} WHERE length(line) > 0),
        r AS (SELECT *, sum(CASE WHEN h = 'urls' THEN 1 ELSE 0 END) OVER w AS record_no, last_value(h IGNORE NULLS) OVER w AS part FROM m WINDOW w AS (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
       SELECT file, CAST(record_no AS INT) AS record_no, max(CASE WHEN h = 'urls' THEN list_last(string_split(line, '=')) END) AS id,
        coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h IS NULL AND part = 'urls'), '') AS urls, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h IS NULL AND part = 'Doctor_faculty'), '') AS Doctor_faculty,
        coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h IS NULL AND part = 'Description'), '') AS Description, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h IS NULL AND part = 'Dialogue'), '') AS Dialogue
       FROM r GROUP BY file, record_no"""
)
def dialog_state_machine(s: SparkSession, d: str) -> DataFrame:
    return sections.dialogue_records(dialogue_lines(s, d), "file", "line_no", "line", block=F.floor(F.col("line_no") / 50_000))


@query("SELECT file, count(*) AS records FROM (SELECT 'f' || (qa_id % 10) AS file FROM " + SETS + ") GROUP BY file")
def dialogue_file_stats(s: SparkSession, d: str) -> DataFrame:
    return sections.record_counts(dialogue_lines(s, d), "file", "line")


# ------------------------------------------------------------------------------------ chunks


@query(
    f"""SELECT doc_id, CAST(k AS INT) AS window_no, CAST(k * 448 AS INT) AS start, array_to_string({_unicode('substr(text, k * 448 + 1, 512)')}, ',') AS ids
       FROM documents, unnest(generate_series(0, (length(text) - 1) // 448)) AS t(k) WHERE length(text) > 0"""
)
def token_windows(s: SparkSession, d: str) -> DataFrame:
    ids = read_table(s, d, "documents").where(F.length("text") > 0).select("doc_id", X.tokens(F.col("text")).alias("ids"))
    return chunking.token_windows(ids, ["doc_id"], "ids", 512, 64).select("doc_id", "window_no", "start", _ids(F.col("window")).alias("ids"))


def _fold_sql(items: str, first: str, step_held: str, step_out: str) -> str:
    """A fold over a list column ``s``, as a recursive query with a row per item."""
    return f"""WITH RECURSIVE base AS ({items}), f AS (
        SELECT chunk_id, s, 0 AS i, {first} FROM base
        UNION ALL SELECT chunk_id, s, i + 1, {step_held} AS held, {step_out} AS out FROM (SELECT *, s[i + 1] AS x FROM f WHERE i < len(s)))"""


@query(
    _fold_sql(
        f"SELECT chunk_id, string_split(page_content, '。') AS s FROM {CHUNKS} WHERE length(page_content) >= 300",
        "'' AS held, CAST([] AS VARCHAR[]) AS out",
        "CASE WHEN length(x) > 300 OR length(held || x) > 300 THEN '' ELSE held || x END",
        "CASE WHEN length(x) > 300 THEN list_append(CASE WHEN held <> '' THEN list_append(out, held) ELSE out END, x) WHEN length(held || x) > 300 THEN list_append(out, held || x) ELSE out END",
    )
    + f""" SELECT chunk_id, array_to_string(CASE WHEN held <> '' THEN list_append(out, held) ELSE out END, '¦') AS parts FROM f WHERE i = len(s)
          UNION ALL SELECT chunk_id, page_content FROM {CHUNKS} WHERE length(page_content) < 300"""
)
def sentence_merge(s: SparkSession, d: str) -> DataFrame:
    kept = chunks(s, d).where(F.col("page_content").isNotNull())
    return kept.select("chunk_id", F.array_join(chunking.merge_sentences(F.col("page_content"), 300), "¦").alias("parts"))


@query(
    _fold_sql(
        f"SELECT chunk_id, string_split(page_content, '。') AS s FROM {CHUNKS} WHERE page_content IS NOT NULL",
        "'' AS held, CAST([] AS VARCHAR[]) AS out",
        "CASE WHEN held = '' THEN x WHEN length(held) + length(x) <= 200 THEN held || x ELSE right(held, 20) || ' ' || x END",
        "CASE WHEN held = '' OR length(held) + length(x) <= 200 THEN out ELSE list_append(out, held) END",
    )
    + " SELECT chunk_id, array_to_string(CASE WHEN held <> '' THEN list_append(out, held) ELSE out END, '¦') AS parts FROM f WHERE i = len(s)"
)
def piece_merge(s: SparkSession, d: str) -> DataFrame:
    kept = chunks(s, d).where(F.col("page_content").isNotNull())
    return kept.select("chunk_id", F.array_join(chunking.merge_pieces(F.split("page_content", "。"), 200, 20), "¦").alias("parts"))


@query(
    f"""WITH RECURSIVE p AS (SELECT para_id, para_id // 512 AS shard, coalesce(length(content), 0) AS n, row_number() OVER (PARTITION BY para_id // 512 ORDER BY para_id) AS rn FROM {PARAS}),
        f AS (SELECT shard, rn, para_id, n, n AS held, 0 AS bin_no FROM p WHERE rn = 1
            UNION ALL SELECT p.shard, p.rn, p.para_id, p.n, CASE WHEN held + p.n > 2000 THEN p.n ELSE held + p.n END, CASE WHEN held + p.n > 2000 THEN bin_no + 1 ELSE bin_no END FROM f JOIN p ON p.shard = f.shard AND p.rn = f.rn + 1)
       SELECT para_id, shard, n, bin_no FROM f"""
)
def greedy_pack(s: SparkSession, d: str) -> DataFrame:
    items = paras(s, d).select("para_id", F.floor(F.col("para_id") / 512).alias("shard"), F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("n"))
    return chunking.next_fit(items, "shard", ["para_id"], "n", 2000)


@query(
    f"""SELECT book_id, CAST(chunk_no // 50 AS INT) AS part_no, string_agg(page_content, '¦' ORDER BY chunk_no, page_content) AS items FROM {CHUNKS} WHERE page_content IS NOT NULL GROUP BY book_id, chunk_no // 50"""
)
def chunk_lists(s: SparkSession, d: str) -> DataFrame:
    kept = chunks(s, d).where(F.col("page_content").isNotNull())
    return chunking.collect_parts(kept, "book_id", "chunk_no", "page_content", 50).select("book_id", "part_no", F.array_join("items", "¦").alias("items"))


# ------------------------------------------------------------------------------------ questions and calls


@query(
    r"""SELECT raw_id, json, json_valid(json) AS ok FROM (
        SELECT raw_id, trim(regexp_replace(regexp_replace(raw, '^\s*```(?:json)?\s*', ''), '\s*```\s*$', '')) AS json FROM function_raw_outputs WHERE raw IS NOT NULL)"""
)
def fence_json_parse(s: SparkSession, d: str) -> DataFrame:
    raws = read_table(s, d, "function_raw_outputs").where(F.col("raw").isNotNull()).select("raw_id", X.fenced_json(F.col("raw")).alias("json"))
    return raws.select("raw_id", "json", F.expr("try_parse_json(json)").isNotNull().alias("ok"))


@query(
    """WITH e AS (SELECT example_id, any_value(function) AS f, any_value(input_parameters) AS p FROM all_function_res_qas GROUP BY example_id),
        c AS (SELECT example_id, bool_and(coalesce(f[i].name = p[i].function_name AND f[i].parameters.required IS NOT NULL AND p[i].arguments IS NOT NULL
            AND len(list_filter(f[i].parameters.required, lambda r: r IS NOT NULL AND NOT list_contains(map_keys(p[i].arguments), r))) = 0, false)) AS good
            FROM e, unnest(generate_series(1, len(p))) AS t(i) WHERE len(f) = len(p) GROUP BY example_id)
       SELECT example_id, coalesce(good, false) AS valid FROM e LEFT JOIN c USING (example_id)"""
)
def toolcall_check(s: SparkSession, d: str) -> DataFrame:
    examples = read_table(s, d, "all_function_res_qas").dropDuplicates(["example_id"])
    return examples.select("example_id", tool_calls.calls_are_valid(F.col("function"), F.col("input_parameters")).alias("valid"))


@query(
    f"""SELECT qa_id, lines, 'Set {{' || qa_id || '}}:' || chr(10) || coalesce(lines, '') AS prompt,
        'Examples' || chr(10) || chr(10) || array_to_string(q, chr(10) || chr(10)) || chr(10) || chr(10) || 'Next' AS shots
       FROM (SELECT qa_id, q, array_to_string(list_transform(q, lambda x, i: (i - 1) || '. ' || x), chr(10)) AS lines FROM {SETS}) WHERE q IS NOT NULL"""
)
def numbered_prompt(s: SparkSession, d: str) -> DataFrame:
    base = sets(s, d).where(F.col("q").isNotNull()).select("qa_id", "q", X.numbered(F.col("q")).alias("lines"))
    prompt = X.render("Set {{{id}}}:\n{lines}", {"id": F.col("qa_id"), "lines": F.col("lines")})
    return base.select("qa_id", "lines", prompt.alias("prompt"), X.few_shot(F.lit("Examples"), F.col("q"), F.lit("Next")).alias("shots"))


@query(
    f"""SELECT qa_id, array_to_string(list_filter(list_transform(q, lambda x: CASE WHEN starts_with(string_split(x, chr(10))[1], '1.') THEN substr(string_split(x, chr(10))[1], 3) ELSE string_split(x, chr(10))[1] END), lambda x: NOT contains(x, '答案')), '¦') AS q
       FROM {SETS} WHERE q IS NOT NULL"""
)
def qa_refine(s: SparkSession, d: str) -> DataFrame:
    return sets(s, d).where(F.col("q").isNotNull()).select("qa_id", F.array_join(qa.refined(F.col("q")), "¦").alias("q"))


@query(
    f"""SELECT qa_id AS id, q[i] AS question, 0 AS part_no FROM {SETS}, unnest(generate_series(1, len(q))) AS t(i)
       UNION ALL SELECT example_id, question, 1 FROM (SELECT DISTINCT example_id, question FROM all_function_res_qas)"""
)
def qa_union(s: SparkSession, d: str) -> DataFrame:
    own = sets(s, d).select(F.col("qa_id").alias("id"), F.explode("q").alias("question"))
    calls = read_table(s, d, "all_function_res_qas").select(F.col("example_id").alias("id"), "question").distinct()
    return qa.union_all(own, calls)


@query(f"SELECT para_id, CAST(i AS INT) AS sample_no FROM {PARAS}, unnest(generate_series(0, 4)) AS t(i)")
def qa_fanout(s: SparkSession, d: str) -> DataFrame:
    return qa.fan_out(paras(s, d).select("para_id"))


@query(
    f"""SELECT book_id, array_to_string(list(text ORDER BY n), '¦') AS questions FROM (
        SELECT book_id, text, row_number() OVER (PARTITION BY book_id ORDER BY o, text) AS n FROM (
            SELECT book_id, q[i] AS text, min(q_ids[i]) AS o FROM {SETS}, unnest(generate_series(1, len(q))) AS t(i) WHERE book_id IS NOT NULL AND q[i] IS NOT NULL GROUP BY book_id, q[i]))
       WHERE n <= 5 GROUP BY book_id"""
)
def accepted_questions(s: SparkSession, d: str) -> DataFrame:
    flat = sets(s, d).where(F.col("book_id").isNotNull()).select("book_id", F.explode(F.arrays_zip("q", "q_ids")).alias("z")).select("book_id", F.col("z.q").alias("text"), F.col("z.q_ids").alias("o"))
    return qa.accepted(flat, ["book_id"], "text", "o").select("book_id", F.array_join("Q", "¦").alias("questions"))


@query(
    """SELECT doc_id, sum(CASE WHEN subject_code = 'medicine' THEN 1 ELSE 0 END) >= sum(CASE WHEN subject_code <> 'medicine' THEN 1 ELSE 0 END) AS verdict
       FROM subject_labels JOIN (SELECT doc_id FROM documents WHERE text IS NOT NULL) USING (doc_id) GROUP BY doc_id"""
)
def label_gate(s: SparkSession, d: str) -> DataFrame:
    votes = read_table(s, d, "subject_labels").groupBy("doc_id").agg(F.collect_list(F.col("subject_code") == "medicine").alias("votes"))
    known = read_table(s, d, "documents").where(F.col("text").isNotNull()).select("doc_id")
    return votes.join(known, "doc_id", "left_semi").select("doc_id", qa.majority(F.col("votes")).alias("verdict"))


@query("SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN p_brand ELSE '其他' END AS brand FROM part")
def enum_default(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "part").select("p_partkey", one_of(F.col("p_brand"), ["Brand#1", "Brand#2", "Brand#3"], "其他").alias("brand"))


# ------------------------------------------------------------------------------------ samples


@query(
    """SELECT doc_id, source, sample_no FROM (SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id) AS INT) AS sample_no FROM documents WHERE source IS NOT NULL)
       WHERE sample_no <= 20"""
)
def sample_per_source(s: SparkSession, d: str) -> DataFrame:
    docs = read_table(s, d, "documents").where(F.col("source").isNotNull()).select("doc_id", "source")
    return sampling.sample_per_group(docs, ["source"], "doc_id", 20, 7)


@query(
    """WITH need AS (SELECT * FROM (VALUES ('textbook', 500), ('tool_docs', 300), ('herbals', 200)) AS v(source, need)),
        r AS (SELECT doc_id, source, need, row_number() OVER (PARTITION BY source ORDER BY md5('11:' || doc_id), doc_id) AS rank, count(*) OVER (PARTITION BY source) AS size FROM documents JOIN need USING (source)),
        x AS (SELECT doc_id, source, CAST(k AS INT) AS repeat_no FROM r, unnest(generate_series(0, (need - rank) // size)) AS t(k) WHERE need >= rank)
       SELECT doc_id, source, repeat_no, CAST(row_number() OVER (ORDER BY md5('12:' || doc_id || ':' || repeat_no), doc_id, repeat_no) AS INT) AS draw_no FROM x"""
)
def mix_sources(s: SparkSession, d: str) -> DataFrame:
    docs = read_table(s, d, "documents").where(F.col("source").isNotNull()).select("doc_id", "source")
    return sampling.interleave(docs, "source", "doc_id", {"textbook": 0.5, "tool_docs": 0.3, "herbals": 0.2}, 1000, 11).select("doc_id", "source", "repeat_no", "draw_no")


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 10000 OFFSET 12")
def first_after(s: SparkSession, d: str) -> DataFrame:
    return sampling.first_n(read_table(s, d, "documents").select("doc_id", "source", "n_chars"), ["doc_id"], 10_000, 12)


# ------------------------------------------------------------------------------------ files


@query(
    """SELECT book_id, list_last(string_split(file_path, '/')) AS filename, string_split(list_last(string_split(file_path, '/')), '.')[1] AS stem,
        CASE WHEN ends_with(lower(p), '.docx') OR ends_with(lower(p), '.doc') THEN 'Docx' WHEN ends_with(lower(p), '.ppt') OR ends_with(lower(p), '.pptx') THEN 'ppt' WHEN ends_with(lower(p), '.rar') OR ends_with(lower(p), '.zip') THEN 'rar_zip' WHEN ends_with(lower(p), '.xls') THEN 'xls'
             WHEN ends_with(lower(p), '.pdf') OR ends_with(lower(p), '.txt') THEN 'stay' ELSE 'else' END AS bucket,
        CASE WHEN regexp_matches(list_last(string_split(p, '/')), '犬|猫|动物|禽|猪|兽|羊') THEN 'delete' WHEN ends_with(lower(p), '.pdf') OR ends_with(lower(p), '.txt') THEN 'stay' ELSE 'move' END AS action
       FROM (SELECT book_id, file_path, CASE book_id % 6 WHEN 0 THEN file_path || '.DOCX' WHEN 1 THEN file_path || '.zip' WHEN 2 THEN file_path || '.xlsx' WHEN 3 THEN file_path || '.PPTX' ELSE file_path END AS p FROM books)"""
)
def file_route(s: SparkSession, d: str) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(x) for x in (".DOCX", ".zip", ".xlsx", ".PPTX", "", "")]), (F.col("book_id") % 6 + 1).cast("int"))
    books = read_table(s, d, "books").select("book_id", "file_path", F.concat("file_path", ending).alias("p"))
    routed = triage.routing_table(books, "p")
    return routed.select("book_id", X.base_name(F.col("file_path")).alias("filename"), X.stem(F.col("file_path")).alias("stem"), "bucket", "action")


@query("SELECT book_id, book_name FROM books WHERE book_id NOT IN (SELECT book_id FROM documents WHERE book_id IS NOT NULL AND source = 'case_reports')")
def skip_existing(s: SparkSession, d: str) -> DataFrame:
    return triage.not_done(read_table(s, d, "books").select("book_id", "book_name"), "book_id", read_table(s, d, "documents").where(F.col("source") == "case_reports"), "book_id").select("book_id", "book_name")


@query("SELECT source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def source_stats(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "documents").groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


# ------------------------------------------------------------------------------------ layout


@query(
    f"""SELECT user_id, min(sec) AS x0, max(sec) AS x1, string_agg(event_type, '' ORDER BY sec, event_id) AS text FROM (
        SELECT *, sum(CASE WHEN abs(sec - prev) > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS prev FROM {EVENTS})) GROUP BY user_id, island"""
)
def span_gap_merge(s: SparkSession, d: str) -> DataFrame:
    spans = events(s, d).select("user_id", F.col("event_id").alias("seq"), F.col("sec").alias("x0"), F.col("sec").alias("x1"), F.col("event_type").alias("text"))
    return layout.merge_spans(spans, ["user_id"], 3600)


WORDS = "(SELECT user_id AS page, event_id AS seq, event_id * 37 % 110 AS x0, event_id % 20 AS y0, event_type AS text FROM events)"


def _words(s: SparkSession, d: str) -> DataFrame:
    e = read_table(s, d, "events")
    return e.select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), (F.col("event_id") * 37 % 110).alias("x0"), (F.col("event_id") % 20).alias("y0"), F.col("event_type").alias("text"))


@query(
    f"""SELECT page, y0, '| ' || array_to_string([coalesce(max(t) FILTER (c = 0), ''), coalesce(max(t) FILTER (c = 1), ''), coalesce(max(t) FILTER (c = 2), ''), coalesce(max(t) FILTER (c = 3), '')], ' | ') || ' | ' || chr(10) AS line FROM (
        SELECT page, y0, CASE WHEN x0 < 25 THEN 0 WHEN x0 < 50 THEN 1 WHEN x0 < 75 THEN 2 WHEN x0 < 100 THEN 3 ELSE 0 END AS c, string_agg(text, ' ' ORDER BY seq) AS t FROM {WORDS} GROUP BY 1, 2, 3) GROUP BY page, y0"""
)
def table_rebuild(s: SparkSession, d: str) -> DataFrame:
    borders = layout.column_borders([25, 50, 75], 0, 100)
    return layout.words_to_table(_words(s, d), "page", borders).select("page", "y0", layout.pipe_row(F.col("cells")).alias("line"))


@query(
    """WITH s AS (SELECT user_id AS page, event_id AS seq, event_id * 7 % 5 * 10 AS x0, event_id % 30 AS y0, event_type || CASE WHEN event_id % 4 = 0 THEN ' ' ELSE '' END AS text FROM events),
        c AS (SELECT page, x0, row_number() OVER (PARTITION BY page ORDER BY x0) - 1 AS col_no FROM (SELECT DISTINCT page, x0 FROM s)),
        l AS (SELECT page, y0, col_no, seq, text, lag(text) OVER (PARTITION BY page, y0, col_no ORDER BY seq) AS prev FROM s JOIN c USING (page, x0))
       SELECT page, y0, CAST(col_no AS INT) AS col_no, string_agg(CASE WHEN prev IS NULL OR ends_with(prev, ' ') OR starts_with(text, ' ') THEN text ELSE ' ' || text END, '' ORDER BY seq) AS text FROM l GROUP BY page, y0, col_no"""
)
def span_rows(s: SparkSession, d: str) -> DataFrame:
    e = read_table(s, d, "events")
    text = F.concat("event_type", F.when(F.col("event_id") % 4 == 0, " ").otherwise(""))
    spans = e.select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), (F.col("event_id") * 7 % 5 * 10).alias("x0"), (F.col("event_id") % 30).alias("y0"), text.alias("text"))
    return layout.spans_to_rows(spans, "page")


@query(
    """SELECT user_id AS page, string_agg(event_type || chr(10), '' ORDER BY CASE WHEN event_id * 13 % 1000 > 400 THEN 1 ELSE 0 END, event_id) AS text
       FROM events WHERE event_id % 3 <> 2 GROUP BY user_id"""
)
def reading_order(s: SparkSession, d: str) -> DataFrame:
    e = read_table(s, d, "events")
    kind = F.element_at(F.array(F.lit("Text"), F.lit("title"), F.lit("figure")), (F.col("event_id") % 3 + 1).cast("int"))
    boxes = e.select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), kind.alias("type"), (F.col("event_id") * 13 % 1000).alias("x1"), F.lit(1000).alias("page_width"), F.col("event_type").alias("text"))
    return pipelines.scanned_pages(boxes, "page")


@query("SELECT user_id AS page, string_agg(event_type, chr(10) || chr(10) ORDER BY event_id) AS text FROM events GROUP BY user_id")
def page_lines(s: SparkSession, d: str) -> DataFrame:
    lines = read_table(s, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), F.col("event_type").alias("text"))
    return layout.page_lines(lines, "page", "\n\n")


@query("SELECT p_partkey FROM part WHERE p_size * 12 > 300 AND p_size * 10 > 300 AND length(p_name) + p_size > 50")
def figure_filter(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "part")
    boxes = p.select("p_partkey", "p_name", F.lit("figure").alias("type"), F.lit(0).alias("x1"), F.lit(0).alias("y1"), (F.col("p_size") * 12).alias("x2"), (F.col("p_size") * 10).alias("y2"), "p_size")
    return layout.large_figures(boxes, F.length("p_name") + F.col("p_size")).select("p_partkey")


@query("SELECT p_partkey, CASE WHEN p_size * 2 >= 90 THEN p_name WHEN p_size * 3 >= 90 THEN p_brand END AS chosen FROM part WHERE p_size >= 5 AND p_size <= 45")
def accuracy_gate(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "part").where(layout.inside(["p_size", "p_size", "p_size", "p_size"], [5, 5, 45, 45]))
    return p.select("p_partkey", layout.accurate(F.col("p_name"), F.col("p_size") * 2, F.col("p_brand"), F.col("p_size") * 3).alias("chosen"))


@query(
    f"""SELECT chunk_id, contains(t, chr(10) || '表 ') AS has_table, regexp_extract(t, '({chr(92)}n表[^{chr(92)}n]*)', 1) AS title
       FROM (SELECT chunk_id, coalesce(page_content, '') || CASE WHEN chunk_no % 3 = 0 THEN chr(10) || '表 ' || chunk_id || chr(10) || '体温' ELSE '' END AS t FROM {CHUNKS})"""
)
def table_titles(s: SparkSession, d: str) -> DataFrame:
    extra = F.when(F.col("chunk_no") % 3 == 0, F.concat(F.lit("\n表 "), F.col("chunk_id").cast("string"), F.lit("\n体温"))).otherwise("")
    t = F.concat(F.coalesce("page_content", F.lit("")), extra)
    return chunks(s, d).select("chunk_id", F.contains(t, F.lit("\n表 ")).alias("has_table"), X.table_title(t).alias("title"))


@query("SELECT event_id, sqrt(pow(value - user_id, 2) + pow(event_id % 7 - 3, 2)) AS distance FROM events")
def point_distance(s: SparkSession, d: str) -> DataFrame:
    e = read_table(s, d, "events")
    return e.select("event_id", X.distance(F.col("value"), F.col("event_id") % 7, F.col("user_id"), F.lit(3)).alias("distance"))


@query("SELECT p_partkey, CASE WHEN p_size * 100 > 3000 OR p_retailprice > 3000 THEN 2 ELSE 3 END AS zoom FROM part")
def raster_zoom(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "part").select("p_partkey", X.raster_zoom(F.col("p_size") * 100, F.col("p_retailprice")).alias("zoom"))


# ------------------------------------------------------------------------------------ graph

NODES = "(SELECT s_suppkey AS id, s_name AS name, MAP {'nation': CAST(s_nationkey AS VARCHAR), 'kind': 'supplier'} AS props FROM supplier)"


def _nodes(s: SparkSession, d: str) -> DataFrame:
    props = F.create_map(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("kind"), F.lit("supplier"))
    return read_table(s, d, "supplier").select(F.array(F.lit("Supplier")).alias("labels"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), props.alias("props"))


def _edges(s: SparkSession, d: str) -> DataFrame:
    sup = read_table(s, d, "supplier")
    return sup.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("source"), (F.col("s_nationkey") + 1_000_000).cast("long").alias("target"), F.lit("in").alias("label"))


@query(
    """WITH o AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier), c AS (SELECT s_suppkey * 3 AS id, 'new ' || s_name AS name, CAST(s_suppkey AS VARCHAR) AS rank FROM supplier)
       SELECT coalesce(o.id, c.id) AS id, coalesce(c.name, o.name) AS name, concat_ws(';', CASE WHEN o.id IS NOT NULL THEN 'kind=supplier' END, CASE WHEN o.id IS NOT NULL THEN 'nation=' || coalesce(CASE WHEN c.id IS NOT NULL THEN 'moved' END, CAST(nation AS VARCHAR)) WHEN c.id IS NOT NULL THEN 'nation=moved' END, 'rank=' || rank) AS props, o.id IS NULL AS inserted
       FROM o FULL OUTER JOIN c ON o.id = c.id"""
)
def node_upsert(s: SparkSession, d: str) -> DataFrame:
    sup = read_table(s, d, "supplier")
    props = F.create_map(F.lit("nation"), F.lit("moved"), F.lit("rank"), F.col("s_suppkey").cast("string"))
    changes = sup.select(F.array(F.lit("Supplier")).alias("labels"), (F.col("s_suppkey") * 3).alias("id"), F.concat(F.lit("new "), "s_name").alias("name"), props.alias("props"))
    done = graph.upsert_nodes(_nodes(s, d), changes)
    flat = F.array_join(F.array_sort(F.transform(F.map_entries("props"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return done.select("id", "name", flat.alias("props"), "inserted")


@query("SELECT coalesce(max(s_suppkey), -1) AS max_id FROM supplier")
def node_max_id(s: SparkSession, d: str) -> DataFrame:
    return graph.max_node_id(_nodes(s, d))


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey = 5 ORDER BY s_suppkey LIMIT 1")
def node_match(s: SparkSession, d: str) -> DataFrame:
    return graph.find_nodes(_nodes(s, d), "Supplier", {"nation": "5"}).select("id", "name")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier ORDER BY s_suppkey LIMIT 10000")
def node_scan(s: SparkSession, d: str) -> DataFrame:
    return sampling.first_n(_nodes(s, d).select("id", "name"), ["id"], 10_000)


@query(
    """WITH e AS (SELECT s_suppkey AS id, s_suppkey AS source, CAST(s_nationkey + 1000000 AS BIGINT) AS target, 'in' AS label FROM supplier), n AS (SELECT id + 5000000 AS id, source, target, 'near' AS label FROM e WHERE id % 4 = 0)
       SELECT id, source, target, label FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.source = e.source AND n.target = e.target) UNION ALL SELECT id, source, target, label FROM n"""
)
def edge_replace(s: SparkSession, d: str) -> DataFrame:
    edges = _edges(s, d)
    new = edges.where(F.col("id") % 4 == 0).select((F.col("id") + 5_000_000).alias("id"), "source", "target", F.lit("near").alias("label"))
    return graph.replace_edges(edges, new).select("id", "source", "target", "label")


@query("SELECT s_suppkey AS id, s_suppkey AS source, CAST(s_nationkey + 1000000 AS BIGINT) AS target FROM supplier WHERE s_suppkey % 3 = 0 OR s_nationkey % 3 = 0")
def incident_edges(s: SparkSession, d: str) -> DataFrame:
    sup = read_table(s, d, "supplier")
    ids = sup.where(F.col("s_suppkey") % 3 == 0).select(F.col("s_suppkey").alias("id")).unionByName(read_table(s, d, "nation").where(F.col("n_nationkey") % 3 == 0).select((F.col("n_nationkey") + 1_000_000).cast("long").alias("id")))
    return graph.incident_edges(_edges(s, d), ids, "both").select("id", "source", "target")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 5 <> 0")
def node_delete(s: SparkSession, d: str) -> DataFrame:
    nodes = _nodes(s, d)
    return graph.delete_nodes(nodes, "Supplier", nodes.where(F.col("id") % 5 == 0)).select("id", "name")


@query("SELECT s_suppkey AS id, s_suppkey AS source, CAST(s_nationkey + 1000000 AS BIGINT) AS target FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 2")
def node_delete_cascade(s: SparkSession, d: str) -> DataFrame:
    none = F.expr("map()").cast("map<string,string>")
    nations = read_table(s, d, "nation").select(F.array(F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("labels"), (F.col("n_nationkey") + 1_000_000).cast("long").alias("id"), F.col("n_name").alias("name"), none.alias("props"))
    return graph.delete_label(_nodes(s, d).unionByName(nations), _edges(s, d), "R2")[1].select("id", "source", "target")


@query(
    """WITH t AS (SELECT r_regionkey AS id, -1 AS parent, r_name AS name FROM region UNION ALL SELECT n_nationkey + 100, n_regionkey, n_name || ' of the region' FROM nation UNION ALL SELECT -1, -2, 'none'),
        w AS (SELECT id, parent, id || '-p:' || parent || '  ' || CASE WHEN length(name) % 12 = 0 THEN left(regexp_replace(name, '(.{12})', '\\1' || chr(10), 'g'), length(regexp_replace(name, '(.{12})', '\\1' || chr(10), 'g')) - 1) ELSE regexp_replace(name, '(.{12})', '\\1' || chr(10), 'g') END AS caption FROM t),
        l AS (SELECT 0 AS kind, id AS a, 0 AS b, id || ' [label="' || replace(caption, chr(10), '\\n') || '"]' AS line FROM w WHERE id <> -1 UNION ALL SELECT 1, parent, id, parent || ' -> ' || id FROM t WHERE id <> -1 AND parent NOT IN (-1, -2))
       SELECT CAST(row_number() OVER (ORDER BY kind, a, b) AS INT) AS line_no, line FROM l"""
)
def tree_render(s: SparkSession, d: str) -> DataFrame:
    top = read_table(s, d, "region").select(F.col("r_regionkey").alias("id"), F.lit(-1).alias("parent"), F.col("r_name").alias("name"))
    below = read_table(s, d, "nation").select((F.col("n_nationkey") + 100).alias("id"), F.col("n_regionkey").alias("parent"), F.concat("n_name", F.lit(" of the region")).alias("name"))
    tree = top.unionByName(below).unionByName(s.createDataFrame([(-1, -2, "none")], "id int, parent int, name string"))
    caption = F.concat(F.col("id").cast("string"), F.lit("-p:"), F.col("parent").cast("string"), F.lit("  "), X.wrap(F.col("name"), 12))
    return graph.dot_lines(tree, caption)


# ------------------------------------------------------------------------------------ vectors and metrics


@query(
    """SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank
        FROM embeddings a JOIN embeddings b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id) WHERE rank <= 5"""
)
def vector_topk(s: SparkSession, d: str) -> DataFrame:
    return vectors.nearest(read_table(s, d, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 64, 5)


@query(
    """SELECT 'v' || vec_id AS _id, label, len(embedding) AS dims FROM embeddings WHERE vec_id % 7 <> 0
       UNION ALL SELECT 'v' || vec_id, label + 100, len(embedding) FROM embeddings WHERE vec_id % 7 = 0 UNION ALL SELECT 'w' || vec_id, label, len(embedding) FROM embeddings WHERE vec_id % 11 = 0"""
)
def vector_upsert(s: SparkSession, d: str) -> DataFrame:
    e = read_table(s, d, "embeddings")
    row = lambda df, lead, label: df.select(F.concat(F.lit(lead), F.col("vec_id").cast("string")).alias("_id"), F.col("embedding").alias("vector"), label.cast("int").alias("label"))
    index = row(e, "v", F.col("label"))
    changes = row(e.where(F.col("vec_id") % 7 == 0), "v", F.col("label") + 100).unionByName(row(e.where(F.col("vec_id") % 11 == 0), "w", F.col("label")))
    return vectors.upsert(index, changes).select("_id", "label", F.size("vector").cast("long").alias("dims"))


@query("SELECT DISTINCT chunk_id FROM pdf_chunks WHERE metadata.subject = '医学' AND list_contains(string_split(metadata.keywords, ';'), '护理')")
def metadata_filter(s: SparkSession, d: str) -> DataFrame:
    listed = read_table(s, d, "pdf_chunks").withColumn("m", F.struct(F.col("metadata.subject").alias("subject"), F.split("metadata.keywords", ";").alias("keywords")))
    return vectors.where_metadata(listed, {"subject": "医学"}, {"keywords": "护理"}, "m").select("chunk_id").distinct()


#: Vectors of hashed character trigrams: 63 bits of code points times an odd number, of which the first bit gives the sign.
EMBEDDED = f"""(SELECT id, list_transform(generate_series(0, 63), lambda k: CAST(list_sum(list_transform(list_filter(h, lambda x: (x >> 40) % 64 = k), lambda x: CASE WHEN x >> 63 = 1 THEN 1 ELSE -1 END)) AS DOUBLE)) AS v FROM (
    SELECT id, list_transform(generate_series(1, greatest(length(t) - 2, 1)), lambda i: CAST(((CAST(unicode(substr(t, CAST(i AS INT), 1)) AS HUGEINT) * 4398046511104 + CAST(coalesce(nullif(unicode(substr(t, CAST(i + 1 AS INT), 1)), -1), 0) AS HUGEINT) * 2097152 + coalesce(nullif(unicode(substr(t, CAST(i + 2 AS INT), 1)), -1), 0)) * 11400714819323198485) % 18446744073709551616 AS UBIGINT)) AS h
    FROM (SELECT q_ids[i] AS id, q[i] AS t FROM {SETS}, unnest(generate_series(1, len(q))) AS s(i)) WHERE length(t) > 0))"""


@query(
    f"""WITH e AS (SELECT id, list_transform(v, lambda x: coalesce(x, 0)) AS v FROM {EMBEDDED})
       SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
        SELECT a.id AS query_id, b.id AS id, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM e a JOIN e b ON a.id % 20 = 0 AND a.id <> b.id)) WHERE rank <= 3"""
)
def embedded_search(s: SparkSession, d: str) -> DataFrame:
    """Questions embedded by the stand-in model, and the three nearest of every twentieth."""
    asked = sets(s, d).select(F.explode(F.arrays_zip("q_ids", "q")).alias("z")).select(F.col("z.q_ids").alias("id"), F.col("z.q").alias("text"))
    return vectors.nearest(embed(asked.where(F.length("text") > 0), "text"), "id", "vector", F.col("id") % 20 == 0, 64, 3)


PAIRS = f"(SELECT qa_id, q[1] AS c, q[2] AS r FROM {SETS} WHERE len(q) >= 2 AND q[1] IS NOT NULL AND q[2] IS NOT NULL)"


def _pairs(s: SparkSession, d: str) -> DataFrame:
    q = F.col("q")
    return sets(s, d).where((F.size("q") >= 2) & q[0].isNotNull() & q[1].isNotNull()).select("qa_id", X.tokens(q[0]).alias("c"), X.tokens(q[1]).alias("r"))


@query(
    f"""WITH g AS (SELECT qa_id, 0 AS side, substr(c, CAST(i AS INT), 2) AS gram FROM {PAIRS}, unnest(generate_series(1, length(c) - 1)) AS t(i) UNION ALL SELECT qa_id, 1, substr(r, CAST(i AS INT), 2) FROM {PAIRS}, unnest(generate_series(1, length(r) - 1)) AS t(i)),
        n AS (SELECT qa_id, gram, count(*) FILTER (side = 0) AS c, count(*) FILTER (side = 1) AS r FROM g GROUP BY qa_id, gram)
       SELECT qa_id, CAST(sum(least(c, r)) AS BIGINT) AS matches, CAST(sum(c) AS BIGINT) AS candidate_ngrams, CAST(sum(r) AS BIGINT) AS reference_ngrams FROM n GROUP BY qa_id"""
)
def bleu_ngrams(s: SparkSession, d: str) -> DataFrame:
    return metrics.ngram_overlap(_pairs(s, d), "qa_id", F.col("c"), F.col("r"), 2)


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(s: SparkSession, d: str) -> DataFrame:
    """The streaming aggregation over the whole table at once."""
    counted = windowed_counts(read_table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", "10 minutes", ["event_type"])
    return counted.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
