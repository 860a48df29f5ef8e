"""Smoothed character bigram model in hashed tables of fixed size, counted over any number of partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkmill.llm.batches import code_points

UNI_BITS, BI_BITS = 16, 20
_MULT = 0x9E3779B97F4A7C15


def uni_bucket(points: np.ndarray) -> np.ndarray:
    return (points ^ (points >> np.uint32(UNI_BITS))) & np.uint32((1 << UNI_BITS) - 1)


def bi_bucket(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first.astype(np.uint64) * np.uint64(0x110000) + second.astype(np.uint64)) * np.uint64(_MULT)
    return (mixed >> np.uint64(64 - BI_BITS)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uni, bi = np.zeros(1 << UNI_BITS, np.int64), np.zeros(1 << BI_BITS, np.int64)
    for batch in batches:
        points, _ = code_points(batch.column(0))
        uni += np.bincount(uni_bucket(points), minlength=len(uni))
        bi += np.bincount(bi_bucket(points[:-1], points[1:]), minlength=len(bi))
    for order, table in ((1, uni), (2, bi)):
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), order, np.int32)), pa.array(at), pa.array(table[at])], names=["n", "bucket", "count"])


@dataclass
class CharModel:
    """log P(next | previous): a bigram estimate, backed off to the unigram and then to a floor for unseen characters."""

    uni: np.ndarray
    bi: np.ndarray

    def __post_init__(self) -> None:
        self.total = float(self.uni.sum()) or 1.0

    def log_probs(self, points: np.ndarray) -> np.ndarray:
        """Of each code point but the first."""
        first, second = points[:-1], points[1:]
        uni_first, uni_second = self.uni[uni_bucket(first)], self.uni[uni_bucket(second)]
        smooth = (uni_second + 0.02) / (self.total + 2000.0)
        # absolute discounting: the mass taken from seen pairs goes to the unigram estimate
        pair = self.bi[bi_bucket(first, second)]
        return np.log(np.maximum(pair - 0.75, 0.0) / (uni_first + 1.0) + (0.15 + 0.85 / (uni_first + 1.0)) * smooth)

    def score(self, text: str) -> float:
        """log-probability of ``text`` after its first character."""
        return float(self.log_probs(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)).sum())


def fit_char_model(clean: DataFrame, text_col: str) -> CharModel:
    """Counts all rows of ``clean`` in their partitions; the driver gets at most 2^16 + 2^20 summed counts."""
    counted = clean.select(F.col(f"`{text_col}`")).mapInArrow(_count, "n int, bucket long, count long").groupBy("n", "bucket").agg(F.sum("count").alias("count")).toPandas()
    uni, bi = np.zeros(1 << UNI_BITS, np.float32), np.zeros(1 << BI_BITS, np.float32)
    for order, table in ((1, uni), (2, bi)):
        part = counted[counted["n"] == order]
        table[part["bucket"].to_numpy()] = part["count"].to_numpy()
    return CharModel(uni, bi)
