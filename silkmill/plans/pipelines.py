"""Composite pipelines over the operators; each is lazy, and a DataFrame from end to end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkmill.functions.text import STOP_MARKER, clean_text, fenced_json, good_length, literal_list, sections, squeeze, strip_replacement, tokens
from silkmill.operators.chunking import SEPARATORS, next_fit, recursive_chunks
from silkmill.operators.dialog import continuation, cut_windows, keep_last, masked_sequence, prefix_examples, role
from silkmill.operators.layout import page_lines, reading_order
from silkmill.operators.metrics import bleu
from silkmill.operators.qa import accepted, asks_plainly, fan_out, is_answer, refined, union_all
from silkmill.operators.sampling import example_prompt, interleave, sample_per_group
from silkmill.operators.sections import coalesce_shorts, dialogue_records, fill_titles, stop_at_marker
from silkmill.operators.tool_calls import calls_are_valid
from silkmill.operators.triage import not_done, routing_table, unclassified
from silkmill.plans.model import ModelClient, StubModel, StubToolModel, ask, ask_template, branch, grow, loose_bool, one_of, strict_bool
from silkmill.session import cut

#: Positions of a document per block of order-sensitive steps; the first column of an order is an integer position.
BLOCK = 1024


def load_chunks(pages: DataFrame, doc: str, size: int = 1024, overlap: int = 128, separators: Sequence[str] = SEPARATORS, least: int = 64, keep_newlines: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(doc, page_number, total_pages, keep.., chunk_no, chunk) of (doc, page_number, text): bibliography cut off, text
    cleaned, split, short chunks dropped, line breaks removed unless kept. total_pages counts the document's pages as given."""
    # counted by group and joined: no task holds the texts of a whole document
    totals = pages.groupBy(F.col(doc).alias("_d")).agg(F.count("*").cast("int").alias("total_pages"))
    kept = stop_at_marker(pages, doc, ["page_number"], "text", STOP_MARKER, F.floor(F.col("page_number") / BLOCK))
    cleaned = kept.withColumn("text", clean_text(F.col("text")))
    chunks = recursive_chunks(cleaned, [doc, "page_number", *keep], "text", size, overlap, separators)
    chunk = strip_replacement(F.col("chunk"))
    out = chunks.where(F.length(chunk) >= least).join(totals, F.col(doc).eqNullSafe(F.col("_d")))
    return out.select(doc, "page_number", "total_pages", *keep, "chunk_no", (chunk if keep_newlines else F.replace(chunk, F.lit("\n"), F.lit(""))).alias("chunk"))


def load_documents(pages: DataFrame, doc: str, size: int = 1024, overlap: int = 128) -> DataFrame:
    """(page_content, metadata, chunk_no) of pages with the fields of their file: chunks that carry source, file_path,
    page_number, total_pages, title, author, subject and keywords. ``doc`` is the file's path."""
    fields = ["title", "author", "subject", "keywords"]
    chunks = load_chunks(pages, doc, size, overlap, keep=fields)
    metadata = F.struct(F.col(doc).alias("source"), F.col(doc).alias("file_path"), "page_number", "total_pages", *fields)
    return chunks.select(F.col("chunk").alias("page_content"), metadata.alias("metadata"), "chunk_no")


def load_strings(pages: DataFrame, doc: str, size: int = 1024, overlap: int = 128) -> DataFrame:
    """(doc, page_number, chunk_no, chunk): the chunks alone, with their line breaks."""
    return load_chunks(pages, doc, size, overlap, keep_newlines=True).drop("total_pages")


def chunks_either_way(pages: DataFrame, keys: list[str], text: str, clean_first: bool, size: int = 1024, overlap: int = 128) -> DataFrame:
    """(keys, chunk_no, chunk), cleaned before or after the split; no stop, no length filter."""
    cut = F.substring_index(text, STOP_MARKER, 1)
    if clean_first:
        return recursive_chunks(pages.withColumn(text, clean_text(cut)), keys, text, size, overlap)
    return recursive_chunks(pages.withColumn(text, cut), keys, text, size, overlap).withColumn("chunk", clean_text(F.col("chunk")))


def gate(df: DataFrame, text: str, question: str, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """Rows to whose text the model answers yes."""
    return ask_template(df, question, {"text": F.col(text)}, make).where(loose_bool(F.col("answer"))).drop("answer", "error")


def titled_chunks(lines: DataFrame, doc: str, order: list[str], size: int = 300, overlap: int = 50) -> DataFrame:
    """(doc, first_title, second_title, pos.., chunk_no, chunk): titles carried down, long lines split, text cleaned."""
    titled = fill_titles(lines, doc, order, "text", block=F.floor(F.col(order[0]) / BLOCK))
    return recursive_chunks(titled, [doc, *order, "first_title", "second_title"], "text", size, overlap).withColumn("chunk", clean_text(F.col("chunk")))


def gated_chunks(lines: DataFrame, doc: str, order: list[str], question: str, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """Titled chunks that the model lets pass."""
    return gate(titled_chunks(lines, doc, order), "chunk", question, make)


def gated_pages(pages: DataFrame, keys: list[str], text: str, question: str, make: Callable[[], ModelClient] = StubModel) -> tuple[DataFrame, DataFrame]:
    """(chunks, raw): the cleaned chunks of pages that the model lets pass, and the pages' texts as they are."""
    chunks = recursive_chunks(pages, keys, text, 300, 50).withColumn("chunk", clean_text(F.col("chunk")))
    return gate(chunks, "chunk", question, make), pages.select(*keys, text)


def merged_paragraphs(lines: DataFrame, doc: str, order: list[str], long: int = 500, size: int = 300, overlap: int = 50) -> DataFrame:
    """Titled paragraphs without inner white space, those above ``long`` split, short ones gathered."""
    titled = fill_titles(lines, doc, order, "text", block=F.floor(F.col(order[0]) / BLOCK)).withColumn("text", clean_text(squeeze(F.col("text"))))
    # written once: gathering reads the paragraphs twice, and what leads to them is dear
    chunks = cut(recursive_chunks(titled, [doc, *order, "first_title", "second_title"], "text", size, overlap, above=long))
    return coalesce_shorts(chunks, doc, [*order, "chunk_no"], "chunk", ["first_title", "second_title"], block=F.floor(F.col(order[0]) / BLOCK))


def sampled_questions(paragraphs: DataFrame, key: str, text: str, template: str, times: int = 5, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """(key, sample_no, Q): ``times`` generated questions a paragraph, failed ones left out."""
    asked = ask_template(fan_out(paragraphs.select(key, text), times), template, {"text": F.col(text), "n": F.col("sample_no")}, make)
    return asked.where(is_answer(F.col("answer")) & asks_plainly(F.col("answer"))).select(key, "sample_no", F.col("answer").alias("Q"))


def checked_questions(paragraphs: DataFrame, key: str, text: str, template: str, check: dict[str, str], kind: str, most: int = 5, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """(key, Q): up to ``most`` questions a paragraph that are plain and that the model, asked by the template for this
    ``kind`` of reader, finds good; without repeats, in the order they were made. A paragraph without any has no row."""
    asked = ask_template(fan_out(paragraphs.select(key, text), most), template, {"text": F.col(text), "n": F.col("sample_no")}, make)
    plain = asked.where(is_answer(F.col("answer")) & asks_plainly(F.col("answer"))).select(key, "sample_no", F.col("answer").alias("question"))
    good = gate(plain, "question", check[kind], make)
    return accepted(good, [key], "question", "sample_no", most)


def refine_and_merge(*sets: DataFrame) -> DataFrame:
    """All question sets with their questions refined, in part and source order."""
    return union_all(*sets).withColumn("q", refined(F.col("q")))


def verified_qa(paragraphs: DataFrame, book: str, key: str, text: str, templates: dict[str, str], seed: int, most: int = 400, make: Callable[[], ModelClient] = StubModel, done: DataFrame | None = None) -> DataFrame:
    """(book, key, Q, A): up to ``most`` paragraphs of good length a book, through relevance, summary, question and
    check; a paragraph that fails a stage is not asked again. Books that ``done`` has are passed over."""
    if done is not None:
        paragraphs = not_done(paragraphs, book, done, book)
    base = sample_per_group(paragraphs.where(good_length(F.col(text))), [book], key, most, seed).select(book, key, text)
    relevant = gate(base, text, templates["relevant"], make)
    summed = ask_template(relevant, templates["summary"], {"text": F.col(text)}, make).where(is_answer(F.col("answer"))).withColumnRenamed("answer", "A").drop("error")
    asked = ask_template(summed, templates["question"], {"text": F.col("A")}, make).where(asks_plainly(F.col("answer"))).withColumnRenamed("answer", "Q").drop("error")
    checked = ask_template(asked, templates["check"], {"Q": F.col("Q"), "A": F.col("A")}, make)
    return checked.where(loose_bool(F.col("answer"))).select(book, key, "Q", "A")


def summaries(texts: DataFrame, text: str, plain: str, strict: str, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """``texts`` with summary and strict_summary, by two templates; the strict one is null where the model finds nothing."""
    first = ask_template(texts, plain, {"text": F.col(text)}, make).withColumnRenamed("answer", "summary").drop("error")
    second = ask_template(first, strict, {"text": F.col(text)}, make).drop("error")
    return second.withColumn("strict_summary", F.when(is_answer(F.col("answer")), F.col("answer"))).drop("answer")


def keyword_lists(texts: DataFrame, text: str, template: str, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """``texts`` with keywords: the list that the model wrote, empty where its answer isn't one."""
    return ask_template(texts, template, {"text": F.col(text)}, make).withColumn("keywords", literal_list(F.col("answer"))).drop("answer", "error")


def recognised_texts(lines: DataFrame, page: str, template: str, make: Callable[[], ModelClient] = StubModel, tries: int = 20) -> DataFrame:
    """(page, text, cleaned): recognised lines of a page joined by blank lines, and what the model makes of them."""
    joined = page_lines(lines, page, "\n\n")
    return ask_template(joined, template, {"text": F.col("text")}, make, tries).withColumnRenamed("answer", "cleaned").drop("error")


def self_instruct(seeds: DataFrame, group: str, key: str, text: str, templates: dict[str, str], k: int, seed: int, tries: int = 5, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """(group, instruction, is_classification, instance): a new instruction from ``k`` examples of each group; whether it
    is a classification, asked until the answer is yes or no, ``tries`` times at most; and an instance of its kind.

    Templates: instruction {examples}, identify {task} {n}, classify {task}, other {task}. Groups without a verdict have no row.
    """
    shown = example_prompt(seeds, [group], key, text, k, seed)
    made = ask_template(shown, templates["instruction"], {"examples": F.col("examples")}, make).where(F.col("answer").isNotNull())
    # written once, as every attempt and the instance build on the same instruction
    made = cut(made.select(group, F.col("answer").alias("instruction")))
    asked = ask_template(fan_out(made, tries), templates["identify"], {"task": F.col("instruction"), "n": F.col("sample_no")}, make)
    verdict = asked.select(group, "sample_no", strict_bool(F.col("answer")).alias("_v")).where(F.col("_v").isNotNull()).groupBy(group).agg(F.min_by("_v", "sample_no").alias("is_classification"))
    known = made.join(verdict, group)
    instance = lambda kind: lambda d: ask_template(d, templates[kind], {"task": F.col("instruction")}, make)
    done = branch(known, F.col("is_classification"), instance("classify"), instance("other"))
    return done.select(group, "instruction", "is_classification", F.col("answer").alias("instance"))


def dialogues_to_json(lines: DataFrame, file: str, block: Column | None = None) -> DataFrame:
    """Records of dialogue files with their descriptions parsed; files' counts are ``record_counts``."""
    return dialogue_records(lines, file, "line_no", "line", block=block).withColumn("parsed", sections(F.col("Description")))


def tool_call_examples(functions: DataFrame, key: str, prompt: Column, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """(key, parsed text, ok): a generated example for each function, taken out of its fence; ok if it is JSON."""
    asked = ask(functions, prompt, make).withColumn("json", fenced_json(F.col("answer")))
    return asked.select(key, "json", F.expr("try_parse_json(json)").isNotNull().alias("ok"))


def function_dataset(described: DataFrame, key: str, description: str, templates: dict[str, str], wanted: int = 30, tries: int = 5, make: Callable[[], ModelClient] = StubModel, make_examples: Callable[[], ModelClient] = StubToolModel) -> DataFrame:
    """(key, example_no, attempt, question, json): function-calling examples in three stages.

    A description becomes a function ({description}), the function a first question ({function}), and both
    up to ``wanted`` examples ({function}, {questions}), each prompted with the questions accepted before it.
    """
    functions = ask_template(described.select(key, description), templates["function"], {"description": F.col(description)}, make).where(F.col("answer").isNotNull())
    functions = functions.select(key, fenced_json(F.col("answer")).alias("function"))
    first = ask_template(functions, templates["question"], {"function": F.col("function")}, make).select(key, "function", F.coalesce("answer", F.lit("")).alias("question"))
    grown = grow(first, key, "function", "question", templates["more"], wanted, tries, make_examples)
    return grown.select(key, "example_no", "attempt", "question", fenced_json(F.col("answer")).alias("json"))


def valid_examples(examples: DataFrame) -> DataFrame:
    return examples.where(calls_are_valid(F.col("function"), F.col("input_parameters")))


def training_windows(turns: DataFrame, conv: str, turn: str, instruction: Column, shard: Column, most: int, step: int, end_token: int = 2) -> DataFrame:
    """(shard, conv, window_no, input_ids, labels, n, bin_no): dialogues tokenised, masked, cut, filtered and packed.

    A conversation's turns are gathered into one row, as a training sequence is one row in the end.
    """
    text = F.concat(role(F.col("speaker")), F.col("text"))
    one = F.struct(F.col(turn).alias("turn"), role(F.col("speaker")).alias("role"), tokens(text).alias("ids"), F.col("speaker").alias("speaker"))
    gathered = turns.groupBy(conv).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    sequence = masked_sequence(tokens(F.concat(F.lit("Instructions: "), instruction)), F.col("turns"), F.lit(end_token))
    sequences = gathered.select(conv, sequence.alias("s")).select(conv, F.col("s.input_ids").alias("input_ids"), F.col("s.labels").alias("labels"))
    windows = cut_windows(sequences, [conv], "input_ids", "labels", most, step).withColumn("n", F.size("input_ids")).withColumn("shard", shard)
    return next_fit(windows, "shard", [conv, "window_no"], "n", most)


def mixed_windows(turns: DataFrame, conv: str, turn: str, source: str, weights: dict[str, float], dialogues: int, seed: int, instruction: Column, shards: int, most: int, step: int) -> DataFrame:
    """``training_windows`` of ``dialogues`` dialogues drawn from sources by weight, in a seeded order: a dialogue drawn again
    is one of its own, and shards follow the order of drawing."""
    drawn = interleave(turns.groupBy(conv).agg(F.min(source).alias("_source")), "_source", conv, weights, dialogues, seed)
    name = F.concat_ws("#", F.col(conv).cast("string"), F.col("repeat_no").cast("string"))
    shuffled = turns.join(drawn.select(conv, "repeat_no", "draw_no"), conv).withColumn("_name", F.concat_ws(":", F.lpad(F.col("draw_no").cast("string"), 10, "0"), name))
    shard = F.floor((F.substring("_name", 1, 10).cast("int") - 1) / F.lit(max(1, -(-dialogues // shards))))
    return training_windows(shuffled, "_name", turn, instruction, shard, most, step).withColumnRenamed("_name", "dialogue")


def library_triage(files: DataFrame, path: str, placed: DataFrame, placed_path: str, template: str, kinds: list[str], default: str = "其他", make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """``files`` with filename, bucket, action and department: files placed already are left out, and only books that stay
    are shown to the model; what it names outside ``kinds`` counts as ``default``."""
    routed = routing_table(unclassified(files, path, placed, placed_path), path)
    named = lambda d: ask_template(d, template, {"name": F.col("filename")}, make).withColumn("department", one_of(F.col("answer"), kinds, default)).drop("answer", "error")
    return branch(routed, F.col("action") == "stay", named, lambda d: d.withColumn("department", F.lit(None).cast("string")))


def scanned_pages(boxes: DataFrame, page: str) -> DataFrame:
    """Text of two-column pages from layout boxes with their recognised text."""
    return reading_order(boxes, page, F.col("page_width"))


def evaluation_set(turns: DataFrame, conv: str, turn: str, most: int, reserve: int, part: str = "to ") -> DataFrame:
    """(conv, turn, prompt, answer): each answer with the tokens of what came before it, the last ``most - reserve`` of them."""
    found = prefix_examples(turns, conv, turn, "speaker", "text", part)
    said = F.array_join(F.transform("history", lambda t: F.concat(t["speaker"], F.lit(": "), t["text"])), "\n")
    prompts = found.select(conv, turn, tokens(said).alias("prompt"), tokens(F.col("answer")).alias("answer"))
    return prompts.withColumn("prompt", keep_last(F.col("prompt"), most - reserve))


def evaluate(predictions: DataFrame, examples: DataFrame, keys: list[str], end_token: int) -> DataFrame:
    """One row of BLEU scores: generated tokens (keys, generated) against the examples' answers, joined by key, not by place."""
    joined = examples.join(predictions, keys).withColumn("c", continuation(F.col("prompt"), F.col("generated"), F.lit(end_token)))
    keyed = joined.select(F.concat_ws(":", *keys).alias("k"), "c", "answer")
    return bleu(keyed, "k", F.col("c"), F.col("answer"))
