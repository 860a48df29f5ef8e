"""Arrow string columns as numpy code points, and the text fields that the operators read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.session import read_table

#: field -> (table, id column, text column)
FIELDS = {
    "content": ("titled_paragraphs", "para_id", "content"),
    "page_content": ("pdf_chunks", "chunk_id", "page_content"),
    "question": ("all_function_res_qas", "example_id", "question"),
}


def long_texts(spark: SparkSession, sf_dir: str, fields: tuple[str, ...]) -> DataFrame:
    """(field, row_id, text) of whole tables, null texts left out; repeated rows stay repeated."""
    parts = []
    for field in fields:
        table, key, text = FIELDS[field]
        parts.append(read_table(spark, sf_dir, table).select(F.lit(field).alias("field"), F.col(key).cast("long").alias("row_id"), F.col(text).alias("text")).where(F.col("text").isNotNull()))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points (uint32) of all texts of a column, a 0 before each text and one at the end, and the index of each text's 0.

    Nulls count as empty texts; a text's own 0 characters become 1.
    """
    joined = "\0" + "\0".join(["" if t is None else t.replace("\0", "\1") for t in column.to_pylist()]) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    return points, np.flatnonzero(points == 0)


def run_of_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points (uint32) of all texts end to end, and where each text starts, with the total at the end."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
    raw = memoryview(data)[at[0] : at[-1]]
    points = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, out=starts[1:])
    return points, starts[at - at[0]]


def regrouped(batches: Iterable[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, and of ``size`` bytes or little more unless a single row is larger."""
    held: list[pa.RecordBatch] = []
    n = 0

    def out() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for whole in batches:
        step = max(1, min(rows, whole.num_rows, int(whole.num_rows * size / max(whole.nbytes, 1)) or 1))
        for at in range(0, whole.num_rows, step):
            part = whole.slice(at, step)
            if held and (n + part.num_rows > rows or sum(b.nbytes for b in held) + part.nbytes > size):
                yield out()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield out()
