"""Words of whole Arrow batches as numpy hashes, and counts of them in hashed tables summed over partitions.

A token is a run of Latin letters and digits, or any other single character that is not white space.
Letters are lower-cased; a run of digits counts as one number token, whatever its value; digits
inside a word count as the digit 0. White space only separates, so that text reads alike however its
lines are laid out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from silkmill.llm.batches import run_of_texts

_BASE = 0x100000001B3
_MIX = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(64)], np.uint64)
NUMBER = np.uint64(0x5851F42D4C957F2D)
#: Code points per block of a sparse count table.
BLOCK = 4096


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For code points below 0x250: the folded character (0 for white space), and whether it belongs in a word."""
    fold, word = np.zeros(0x250, np.uint32), np.zeros(0x250, bool)
    for c in range(0x250):
        ch = chr(c)
        low = ch.lower()
        fold[c] = 0 if ch.isspace() or c == 0 else ord("0") if ch.isdigit() and c < 128 else ord(low) if len(low) == 1 else c
        word[c] = ch.isalnum() and (c < 128 or ch.isalpha()) and c not in (0xAA, 0xBA)
    return fold, word


_FOLD, _WORD = _tables()
_WIDE_SPACE = np.array([0x2000 + k for k in range(12)] + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF, 0x2060], np.uint32)


@dataclass
class Tokens:
    """``hash``, first code point index, end index, text number and word flag of each token of a batch."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    word: np.ndarray


def tokenize(points: np.ndarray, starts: np.ndarray) -> Tokens:
    n = len(points)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Tokens(none.astype(np.uint64), none, none, none, none.astype(bool))
    begins, word = np.ones(n, bool), np.zeros(n, bool)
    low = np.flatnonzero(points < 0x250)
    folded = _FOLD[points[low]]
    in_word = _WORD[points[low]]
    word[low] = in_word
    begins[low] = folded != 0
    middle = np.flatnonzero((points >= 0x2000) & (points < 0x3001) | (points == 0xFEFF))
    begins[middle[np.isin(points[middle], _WIDE_SPACE)]] = False
    begins[1:][word[1:] & word[:-1]] = False
    first = starts[:-1][starts[:-1] < n]
    begins[first[word[first]]] = True  # a word never runs on into the next text
    at = np.flatnonzero(begins)
    hashes, ends, is_word = points[at].astype(np.uint64), at + 1, word[at]
    inside = low[in_word]
    if len(inside):
        heads = np.flatnonzero(begins[inside])
        length = np.diff(np.append(heads, len(inside)))
        within = np.arange(len(inside)) - np.repeat(heads, length)
        value = folded[in_word].astype(np.uint64)
        sums = np.add.reduceat(value * _POWERS[np.minimum(within, 63)], heads)
        digits = np.add.reduceat((value == 48).astype(np.int64), heads)
        sums[digits == length] = NUMBER
        hashes[is_word] = sums
        ends[is_word] += length - 1
    return Tokens(hashes, at, ends, np.repeat(np.arange(len(starts) - 1), np.diff(np.searchsorted(at, starts))), is_word)


def word_hash(word: str) -> np.uint64:
    """The hash that ``tokenize`` gives to ``word``, a single token."""
    if word.isdigit() and word.isascii():
        return NUMBER
    total = 0
    for k, ch in enumerate(word):
        c = ord(ch)
        total += (int(_FOLD[c]) if c < 0x250 else c) * int(_POWERS[min(k, 63)])
    return np.uint64(total & 0xFFFFFFFFFFFFFFFF)


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * np.uint64(_MIX)) >> np.uint64(64 - bits)).astype(np.int64)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * np.uint64(0xD6E8FEB86659FD93)) ^ (second + (first >> np.uint64(29)))


def _sparse(table: np.ndarray, name: int) -> Iterator[tuple[int, int, bytes]]:
    for block in range(0, len(table), BLOCK):
        part = table[block : block + BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            yield name, block // BLOCK, at.astype(np.uint16).tobytes() + part[at].astype(np.int64).tobytes()


def _dense(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 10
    return np.frombuffer(raw, np.uint16, n), np.frombuffer(raw, np.int64, n, 2 * n)


def _merge(key: tuple, group: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.int64)
    for raw in group.column("counts").to_pylist():
        at, n = _dense(raw)
        total[at] += n
    return pa.Table.from_pylist([{"name": a, "block": b, "counts": c} for a, b, c in _sparse(total, key[0].as_py())] or [], schema=_SPARSE).set_column(1, "block", pa.array([key[1].as_py()] * bool(total.any()), pa.int32()))


_SPARSE = pa.schema([("name", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])


def summed_tables(texts: DataFrame, sizes: list[int], add: Callable[[pa.Array, list[np.ndarray]], None]) -> list[np.ndarray]:
    """Count tables of the given sizes over the column ``text`` of all rows.

    ``add`` adds an Arrow column to the tables of its partition; the partitions' tables are summed
    block by block on the executors, so the driver gets one table of each size, however large the input.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(s, np.int64) for s in sizes]
        for batch in batches:
            add(batch.column(0), tables)
        rows = [r for i, t in enumerate(tables) for r in _sparse(t, i)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _SPARSE.field(k).type) for k in range(3)], schema=_SPARSE)

    schema = "name int, block int, counts binary"
    merged = texts.select("text").mapInArrow(run, schema).groupBy("name", "block").applyInArrow(_merge, schema).toArrow()
    out = [np.zeros(s, np.float32) for s in sizes]
    for name, block, raw in zip(*(merged.column(c).to_pylist() for c in ("name", "block", "counts")), strict=True):
        at, n = _dense(raw)
        out[name][block * BLOCK + at.astype(np.int64)] = n
    return out


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Tokens]:
    points, starts = run_of_texts(column)
    return points, starts, tokenize(points, starts)
