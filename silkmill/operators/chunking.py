"""Splitting and merging texts: windows of tokens, recursive separators, sequential merges and packing."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how texts are cut into words before byte pairs are merged.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Separators of the recursive splitter, strongest first, for Chinese and for Latin text.
SEPARATORS = ("。\n", "\n\n", "。", "\n", " ", "")
LATIN_SEPARATORS = (".\n", "\n\n", ". ", "\n", " ", "")


def window_starts(length: Column, size: int, stride: int) -> Column:
    """0-based starts of windows of ``size`` every ``stride`` over ``length`` items; empty for none."""
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be positive")
    return F.when(length > 0, F.sequence(F.lit(0), (length - 1).cast("int"), F.lit(stride))).otherwise(F.array().cast("array<int>"))


def token_windows(df: DataFrame, keys: list[str], items: str, size: int, overlap: int) -> DataFrame:
    """(keys, window_no, start, window): windows of an array column, each ``overlap`` items into the one before."""
    starts = window_starts(F.size(items), size, size - overlap)
    exploded = df.select(*keys, items, F.posexplode(starts).alias("window_no", "start"))
    return exploded.select(*keys, "window_no", "start", F.slice(items, F.col("start") + 1, size).alias("window"))


def split_recursive(text: str, size: int, overlap: int, separators: Sequence[str], length: Callable[[str], int] = len) -> list[str]:
    """Chunks of at most ``size``: split at the first separator that the text holds, which stays with the piece before
    it; pieces are merged while they fit, a new chunk begins with the last pieces of up to ``overlap``; a piece above
    the size is split by the next separator. The empty separator splits into characters."""
    if not text:
        return []
    if length(text) <= size:
        return [text]
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), None)
    if at is None:
        return [text]
    sep = separators[at]
    parts = list(text) if sep == "" else [p + sep for p in text.split(sep)[:-1]] + [text.split(sep)[-1]]
    out: list[str] = []
    held: list[str] = []
    total = 0
    for part in (p for p in parts if p):
        n = length(part)
        if n > size:
            if held:
                out.append("".join(held))
            held, total = [], 0
            out += split_recursive(part, size, overlap, separators[at + 1 :], length)
            continue
        if total + n > size and held:
            out.append("".join(held))
            while held and (total > overlap or total + n > size):
                total -= length(held.pop(0))
        held.append(part)
        total += n
    if held:
        out.append("".join(held))
    return out


def recursive_chunks(df: DataFrame, keys: list[str], text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS, above: int | None = None, measure: Callable[[], Callable[[str], int]] | None = None) -> DataFrame:
    """(keys, chunk_no, chunk) by ``split_recursive``, in Arrow batches; keys keep their types. Texts of at most ``above``
    characters stay whole, if it is given; null and empty texts give no chunk. ``measure`` makes, once per Python worker,
    what the lengths of texts are taken with, such as a tokenizer's count; without it they are characters."""
    schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("chunk_no", T.IntegerType()), T.StructField("chunk", T.StringType())])
    seps = tuple(separators)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = measure() if measure else len
        for batch in batches:
            rows, numbers, chunks = [], [], []
            for i, t in enumerate(batch.column(len(keys)).to_pylist()):
                found = [t] if t and above is not None and len(t) <= above else split_recursive(t or "", size, overlap, seps, length)
                rows += [i] * len(found)
                numbers += range(len(found))
                chunks += found
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(keys))), pa.array(numbers, pa.int32()), pa.array(chunks, pa.string())], names=[*keys, "chunk_no", "chunk"])

    return df.select(*keys, text).mapInArrow(run, schema)


def encode(df: DataFrame, text: str, make: Callable[[], Callable[[str], list[int]]], name: str = "ids") -> DataFrame:
    """``df`` with the token ids of a text, by the tokenizer that ``make`` loads once per Python worker; null for null."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = make()
        for batch in batches:
            ids = [None if t is None else tokenize(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def vocabulary_tokenizer(path: str, pattern: str = WORD_PATTERN) -> Callable[[], Callable[[str], list[int]]]:
    """A maker for ``encode``: a public byte-pair vocabulary file, each line a token in base 64 and its rank."""

    def make() -> Callable[[str], list[int]]:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    return make


def merge_sentences(text: Column, most: int = 300, compat: bool = False) -> Column:
    """Sentences (parted at 。, which is dropped) merged until they exceed ``most``.

    A text below ``most`` stays whole. A sentence above it flushes what is held and stands alone.
    What is held at the end is emitted; with ``compat`` it is dropped.
    """
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("held"))

    def step(acc: Column, s: Column) -> Column:
        grown = F.concat(acc["held"], s)
        out, held = acc["out"], acc["held"]
        flushed = F.when(F.length(held) > 0, F.concat(out, F.array(held))).otherwise(out)
        alone = F.struct(F.concat(flushed, F.array(s)).alias("out"), F.lit("").alias("held"))
        full = F.struct(F.concat(out, F.array(grown)).alias("out"), F.lit("").alias("held"))
        more = F.struct(out.alias("out"), grown.alias("held"))
        return F.when(F.length(s) > most, alone).when(F.length(grown) > most, full).otherwise(more)

    def finish(acc: Column) -> Column:
        if compat:
            return acc["out"]
        return F.when(F.length(acc["held"]) > 0, F.concat(acc["out"], F.array(acc["held"]))).otherwise(acc["out"])

    return F.when(F.length(text) < most, F.array(text)).otherwise(F.aggregate(F.split(text, "。"), empty, step, finish))


def merge_pieces(pieces: Column, size: int, overlap: int) -> Column:
    """Small pieces merged greedily to at most ``size``; a new one begins with the last ``overlap`` characters of the
    one before and a space. A piece above the size stands as it is."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("held"))

    def step(acc: Column, p: Column) -> Column:
        fits = F.length(acc["held"]) + F.length(p) <= size
        tail = F.when(F.length(acc["held"]) > overlap, F.right(acc["held"], F.lit(overlap))).otherwise(acc["held"])
        opened = F.struct(F.concat(acc["out"], F.array(acc["held"])).alias("out"), F.concat(tail, F.lit(" "), p).alias("held"))
        return F.when(F.length(acc["held"]) == 0, F.struct(acc["out"].alias("out"), p.alias("held"))).when(fits, F.struct(acc["out"].alias("out"), F.concat(acc["held"], p).alias("held"))).otherwise(opened)

    finish = lambda acc: F.when(F.length(acc["held"]) > 0, F.concat(acc["out"], F.array(acc["held"]))).otherwise(acc["out"])
    return F.aggregate(pieces, start, step, finish)


def next_fit(df: DataFrame, shard: str, order: list[str], size: str, capacity: int) -> DataFrame:
    """Adds bin_no: items of a shard in order go into the open bin while they fit, else open the next.

    An item above the capacity has a bin of its own. The fold runs in Arrow batches of one shard at a
    time; shards bound what one task holds, so choose them by a hash or a file, not by a hot key.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("bin_no", T.IntegerType())])

    def run(shard_rows: pa.Table) -> pa.Table:
        table = shard_rows.sort_by([(c, "ascending") for c in order])
        bins, held, no = [], 0, 0
        for n in table.column(size).to_pylist():
            n = n or 0
            if bins and held + n > capacity:
                no, held = no + 1, 0
            held += n
            bins.append(no)
        return table.append_column("bin_no", pa.array(bins, pa.int32()))

    return df.groupBy(shard).applyInArrow(run, schema)


def collect_parts(df: DataFrame, doc: str, position: str, column: str, size: int = 1000) -> DataFrame:
    """(doc, part_no, items): a document's values in order of an integer position, ``size`` positions to a list, so
    that even the longest document is never one list."""
    part = F.floor(F.col(position) / size).cast("int").alias("part_no")
    lists = F.array_sort(F.collect_list(F.struct(position, column)))
    return df.groupBy(doc, part).agg(F.transform(lists, lambda s: s[column]).alias("items"))
