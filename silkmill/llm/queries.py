"""The queries of this subpackage's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.llm.batches import long_texts
from silkmill.llm.lookalikes import Check, find_lookalikes
from silkmill.llm.mixing import mix, share_report
from silkmill.llm.mojibake import Restorer, find_garbled, fit_restorer
from silkmill.llm.near_copies import all_pairs, classes_with_links, near_copies
from silkmill.llm.packing import count_tokens, fill_report, pack_documents
from silkmill.llm.scanned import fit_lexicon, repair_scans, shared_titles, titles_by_book
from silkmill.llm.splitting import BOUNDARIES, read_limits, split_texts
from silkmill.llm.subjects import assign_subjects, fit_subjects, with_labels
from silkmill.session import broadcast_if_small, cut, few_rows, read_table


def _restorer(spark: SparkSession, sf_dir: str):
    return fit_restorer(read_table(spark, sf_dir, "proofread_samples"), "clean_text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_garbled(long_texts(spark, sf_dir, ("content", "page_content")), _restorer(spark, sf_dir))
    return hits.select("field", "row_id").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per affected value: the text as far as it can be restored and the chains that were undone."""
    hits = find_garbled(long_texts(spark, sf_dir, ("content", "page_content")), _restorer(spark, sf_dir))
    return hits.groupBy("field", "row_id").agg(F.max("restored").alias("restored"), F.max("chains").alias("chains"))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, id, text) of both fields of questions."""
    own = read_table(spark, sf_dir, "all_function_res_qas").select(F.lit("question").alias("field"), F.col("example_id").alias("id"), F.col("question").alias("text"))
    sets = read_table(spark, sf_dir, "qa_sets").select(F.explode(F.arrays_zip("q_ids", "q")).alias("z")).select(F.lit("q").alias("field"), F.col("z.q_ids").alias("id"), F.col("z.q").alias("text"))
    return own.unionByName(sets).where(F.col("id").isNotNull() & F.col("text").isNotNull())


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_pairs(*near_copies(_questions(spark, sf_dir), ("question", "q"))).distinct()


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per question: its class of equal questions and the number of classes that are near-copies of it."""
    return classes_with_links(*near_copies(_questions(spark, sf_dir), ("question", "q")))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_texts(long_texts(spark, sf_dir, ("content", "page_content")), read_limits(read_table(spark, sf_dir, "split_limits")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).where(F.size("pieces") > 1).select("field", "row_id").distinct()


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, row_id, piece_no, piece) of every oversized value, once."""
    return _split(spark, sf_dir).dropDuplicates(["field", "row_id"]).select("field", "row_id", F.posexplode("pieces").alias("piece_no", "piece"))


def _garbled_test(restorer: Restorer) -> Callable[[], Check]:
    """A test of a value for wrong decoding, to be made on the executors from a broadcast of fixed size."""
    shared = SparkSession.active().sparkContext.broadcast(restorer.state())

    def make() -> Check:
        own = Restorer.of(shared.value)
        return lambda field, text: field in ("content", "page_content") and own.suspect(text) and own.restore(text) is not None

    return make


def _one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_lookalikes(long_texts(spark, sf_dir, ("content", "page_content", "question")), _garbled_test(_restorer(spark, sf_dir)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_form(spark, sf_dir).select("field", "row_id").distinct()


def p5_one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, row_id, one_form) of every affected value, once."""
    return _one_form(spark, sf_dir).groupBy("field", "row_id").agg(F.max("one_form").alias("one_form"))


def _pages(spark: SparkSession, sf_dir: str, shared: list[str]) -> DataFrame:
    """(field, row_id, text, page, book, own_titles) of both fields; a book's name and its chapter names that are not
    ``shared`` are joined by broadcast while they are few. A row without a book has its own chapter name."""
    books = broadcast_if_small(read_table(spark, sf_dir, "books").select("book_id", F.col("book_name").alias("book")))
    content = read_table(spark, sf_dir, "titled_paragraphs").select(F.lit("content").alias("field"), F.col("para_id").alias("row_id"), F.col("content").alias("text"), F.col("page_number").alias("page"), "book_id", F.trim("first_title").alias("own"))
    chunks = read_table(spark, sf_dir, "pdf_chunks").select(F.lit("page_content").alias("field"), F.col("chunk_id").alias("row_id"), F.col("page_content").alias("text"), F.col("metadata.page_number").alias("page"), "book_id", F.lit(None).cast("string").alias("own"))
    names = titles_by_book(read_table(spark, sf_dir, "titled_paragraphs"), "first_title", shared)
    # estimates don't see how few names are left, so they are counted: 64 bytes a book, 16 and its letters a name
    size = names.agg(F.sum(64 + F.expr("aggregate(own_titles, 0L, (a, x) -> a + 16 + octet_length(x))"))).first()[0] or 0
    names = F.broadcast(names) if size <= 32 << 20 else names
    both = content.unionByName(chunks).where(F.length("text") > 0).join(books, "book_id", "left")
    both = both.join(names, "book_id", "left") if size else both.withColumn("own_titles", F.lit(None).cast("array<string>"))
    # the row's own chapter name is among its book's, unless it has no book
    alone = F.when(F.col("book_id").isNull() & F.col("own").isNotNull(), F.array("own"))
    return both.select("field", "row_id", "text", "page", "book", F.coalesce("own_titles", alone).alias("own_titles"))


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = fit_lexicon(long_texts(spark, sf_dir, ("content", "page_content")))
    titles = shared_titles(read_table(spark, sf_dir, "titled_paragraphs"), "first_title")
    return repair_scans(_pages(spark, sf_dir, titles), lexicon, titles, _garbled_test(_restorer(spark, sf_dir)))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).select("field", "row_id").distinct()


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, row_id, repaired, broken, furniture, misread) of every noisy value, once."""
    found = _repaired(spark, sf_dir).groupBy("field", "row_id").agg(F.max(F.struct("repaired", "broken", "furniture", "misread")).alias("r"))
    return found.select("field", "row_id", "r.*")


def _capacities(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    rows = few_rows(read_table(spark, sf_dir, "pack_capacities"), 1000, "capacities")
    return {r["capacity_name"]: int(r["capacity_tokens"]) for r in rows if r["capacity_name"] is not None and (r["capacity_tokens"] or 0) > 0}


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return pack_documents(count_tokens(documents), _capacities(spark, sf_dir), documents.count())


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p7_containers(spark, sf_dir), _capacities(spark, sf_dir))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = read_table(spark, sf_dir, "mix_targets")
    # counting tokens is the dear part, and it is needed for the quotas and again for the choice
    counted = cut(count_tokens(read_table(spark, sf_dir, "documents").where(F.col("source").isNotNull()), keep=("source",)))
    return mix(counted, targets), targets


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_report(*_mixture(spark, sf_dir))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    codes = sorted(r[0] for r in few_rows(read_table(spark, sf_dir, "subject_areas").select("subject_code").distinct(), 1000, "subjects") if r[0])
    model = fit_subjects(with_labels(documents, read_table(spark, sf_dir, "subject_labels")), codes)
    return assign_subjects(documents, model)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).select("doc_id", "subject_code").distinct()


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by subject: documents and the characters their shares amount to, on a row per subject."""
    sized = read_table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars")).dropDuplicates(["doc_id"])
    found = _subjects(spark, sf_dir).dropDuplicates(["doc_id", "subject_code"]).join(sized, "doc_id")
    return found.groupBy("subject_code").agg(F.count("*").alias("documents"), F.round(F.sum(F.col("share") * F.col("chars"))).cast("long").alias("chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_classes, p4_found, p4_pieces, p5_found, p5_one_form, p6_found, p6_repaired, p7_containers, p7_fill, p8_mixture, p8_shares, p9_found, p9_composition)}
#: Questions of both fields with their sets of three-character sequences, and pairs of different ids that share any.
_GRAMS = r"""t AS (SELECT DISTINCT 'question' AS field, example_id AS id, question AS text FROM all_function_res_qas
                UNION SELECT 'q', q_ids[i], q[i] FROM qa_sets, unnest(generate_series(1, len(q))) AS s(i)),
            n AS (SELECT field, id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS text FROM t WHERE text IS NOT NULL AND id IS NOT NULL),
            g AS (SELECT DISTINCT field, id, substr(text, CAST(i AS INT), 3) AS gram FROM n, unnest(generate_series(1, length(text) - 2)) AS s(i)),
            c AS (SELECT field, id, count(*) AS size FROM g GROUP BY field, id),
            p AS (SELECT a.field, a.id AS id_a, b.id AS id_b, count(*) AS shared FROM g a JOIN g b ON a.field = b.field AND a.gram = b.gram AND a.id < b.id GROUP BY ALL),
            near AS (SELECT p.field, id_a, id_b FROM p JOIN c x ON x.field = p.field AND x.id = id_a JOIN c y ON y.field = p.field AND y.id = id_b WHERE shared >= 0.6 * (x.size + y.size - shared))"""


def _pieces_sql() -> str:
    """The pieces of oversized texts: at each step the farthest boundary of the strongest kind in reach, first with half a piece
    filled, then with the overlap; RE2 counts to 1,000 at most, so that boundaries are looked for in lists of their places."""
    found = lambda low, b: f"list_max(list_filter(list_transform(generate_series({low}, room - 5), lambda k: CASE WHEN regexp_matches(substr(rest, CAST(k + 1 AS INT), 8), '(?s)^(?:{b})') THEN k + length(regexp_extract(substr(rest, CAST(k + 1 AS INT), 8), '(?s)^(?:{b})')) END), lambda e: e IS NOT NULL))"
    reach = ", ".join(found(low, b.replace("'", "''")) for low in ("half", "least") for b in BOUNDARIES)
    plain = r"list_max(list_filter(generate_series(least, room), lambda k: NOT regexp_matches(substr(rest, CAST(k + 1 AS INT), 1), '\p{M}')))"
    return f"""WITH RECURSIVE v AS (SELECT DISTINCT field, row_id, text, max_chars - overlap_chars AS room, overlap_chars AS o FROM (
            SELECT 'content' AS field, para_id AS row_id, content AS text FROM titled_paragraphs UNION ALL SELECT 'page_content', chunk_id, page_content FROM pdf_chunks) JOIN split_limits USING (field) WHERE length(text) > max_chars),
        b AS (SELECT *, greatest(1, o) AS least, greatest(o, room // 2, 1) AS half FROM v),
        f AS (SELECT field, row_id, text AS rest, room, o, least, half, -1 AS piece_no, '' AS before, '' AS piece FROM b
            UNION ALL SELECT field, row_id, substr(rest, CAST(n + 1 AS INT)), room, o, least, half, piece_no + 1, substr(rest, 1, CAST(n AS INT)), right(before, o) || substr(rest, 1, CAST(n AS INT))
            FROM (SELECT *, CASE WHEN length(rest) <= room THEN length(rest) ELSE coalesce({reach}, {plain}, room) END AS n FROM f WHERE length(rest) > 0))
       SELECT field, row_id, CAST(piece_no AS INT) AS piece_no, piece FROM f WHERE piece_no >= 0"""


ORACLES: dict[str, str] = {
    "p2_found": f"WITH {_GRAMS} SELECT field, id_a, id_b FROM near",
    "p2_classes": f"""WITH {_GRAMS}, k AS (SELECT field, id, min(id) OVER (PARTITION BY field, text) AS class_id FROM n WHERE length(text) >= 3),
            l AS (SELECT a.field, a.class_id AS a, b.class_id AS b FROM near JOIN k a ON a.field = near.field AND a.id = id_a JOIN k b ON b.field = near.field AND b.id = id_b WHERE a.class_id <> b.class_id),
            m AS (SELECT field, class_id, count(DISTINCT other) AS n FROM (SELECT field, a AS class_id, b AS other FROM l UNION ALL SELECT field, b, a FROM l) GROUP BY field, class_id)
        SELECT k.field, id, k.class_id, coalesce(m.n, 0) AS n_links FROM k LEFT JOIN m ON m.field = k.field AND m.class_id = k.class_id""",
    "p4_pieces": _pieces_sql(),
    "p4_found": """
        SELECT DISTINCT field, row_id FROM (
            SELECT 'content' AS field, para_id AS row_id, content AS text FROM titled_paragraphs
            UNION ALL SELECT 'page_content', chunk_id, page_content FROM pdf_chunks) JOIN split_limits USING (field)
        WHERE length(text) > max_chars""",
}
