"""A table of text vectors: upserts, metadata filters and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors per block of either side of a search.
BLOCK = 2048


def upsert(index: DataFrame, rows: DataFrame, key: str = "_id") -> DataFrame:
    """``index`` with ``rows`` added, those of the same key replaced; rows without a key get a new one. Of rows with one
    key, one stays. Rows without a vector fail the write, as an index can't hold them."""
    keyed = rows.withColumn(key, F.coalesce(F.col(key), F.expr("uuid()"))).dropDuplicates([key])
    checked = keyed.withColumn("vector", F.when(F.col("vector").isNull(), F.raise_error(F.lit("a row has no vector"))).otherwise(F.col("vector")))
    return index.join(checked.select(key), key, "left_anti").unionByName(checked)


def where_metadata(df: DataFrame, equal: dict[str, object], contains: dict[str, object] | None = None, column: str = "metadata") -> DataFrame:
    """Rows whose metadata has all given values; ``contains`` is for fields that are a value or a list of values."""
    hit: Column = F.lit(True)
    for name, value in equal.items():
        hit = hit & (F.col(f"{column}.{name}") == F.lit(value))
    for name, value in (contains or {}).items():
        hit = hit & F.array_contains(F.col(f"{column}.{name}"), F.lit(value))
    return df.where(hit)


def _blocker(dim: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, vector) to blocks of unit vectors: one row holds up to BLOCK of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                rows = np.array([v if v is not None and len(v) == dim else [0.0] * dim for v in batch.column(1).to_pylist()], np.float64).reshape(-1, dim)
                unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([unit.tobytes()], pa.binary())], names=["ids", "unit"])

    return run


def _searcher(dim: int, k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, d = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                a, b = np.frombuffer(row["q_unit"]).reshape(-1, dim), np.frombuffer(row["unit"]).reshape(-1, dim)
                score = np.round(a @ b.T, 6)
                score[q[:, None] == d[None, :]] = -2.0
                # the k best of each query, ties by id: enough of them, as the rest can't be among the k best of all
                order = np.lexsort((np.broadcast_to(d, score.shape), -score), axis=1)[:, :k]
                best = np.take_along_axis(score, order, axis=1)
                keep = best > -2.0
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, order.shape[1])[keep.ravel()]), pa.array(d[order].ravel()[keep.ravel()]), pa.array(best.ravel()[keep.ravel()])], names=["query_id", "id", "score"])

    return run


def nearest(df: DataFrame, key: str, vector: str, queries: Column, dim: int, k: int) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` rows most similar (cosine, 6 decimals) to each query row, exact.

    Queries and rows meet block by block: a matrix product for each pair of blocks, from which only
    the k best of each query go on. Ties go to the lesser id; a row is not its own neighbour; rows
    without a vector of ``dim`` numbers score 0.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    blocks = rows.mapInArrow(_blocker(dim), "ids binary, unit binary")
    asked = df.where(queries).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(_blocker(dim), "ids binary, unit binary").select(F.col("ids").alias("q_ids"), F.col("unit").alias("q_unit"))
    met = blocks.crossJoin(asked)  # of blocks: a stated query set against all rows
    found = met.mapInArrow(_searcher(dim, k), "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
