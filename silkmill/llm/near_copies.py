"""Near-copies with small edits: an exact set-similarity join by signature trees.

A text is the set of its distinct character sequences of a fixed length; two texts are near-copies
if the sets' Jaccard similarity reaches a threshold t.

1. Equal texts are one class; only one representative each goes on.
2. A representative's signature is a bitmap of its hashed sequences with its size. Trees that hold
   unrelated texts fill up and prune nothing, so signatures first go to trees by sequence: sequences
   are ordered from rare to frequent by counts over all texts (hashed, so the order needs tables of
   fixed size), and two sets that reach t share one of the first few, the larger set within its first
   40 % at t = 0.6, the smaller within its first 25 %. No other pair can be missed.
3. Every group, of two texts or of thousands, is a signature tree: a leaf node holds up to ``FAN``
   signatures of like size, an inner node the OR of its children's
   bitmaps with the range of their sizes. All trees of a task are traversed against themselves, level
   by level; a pair of nodes is pruned if the largest overlap that bitmaps and sizes allow is less
   than t demands of their smallest members. The traversal is the only way to a candidate. Groups
   above ``GROUP`` texts are split into blocks, and each pair of blocks is a tree of its own, so none
   is held in one task and no pair is lost.
4. The surviving pairs are checked on the texts themselves.

Defined results: null and blank texts, and those with no full sequence, have no copies, not even
each other; rows repeated with one id count once; a text is never its own copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkmill.llm.batches import regrouped, run_of_texts
from silkmill.llm.tokens import bucket, summed_tables
from silkmill.session import cut

N, DF_BITS, BITS, FAN = 3, 21, 256, 8
WORDS = BITS // 64
#: Texts in one tree, at most; larger groups are compared block by block.
GROUP = 4096
#: Texts routed together, signatures traversed together and pairs of leaf nodes compared together.
ROUTED, HELD, COMPARED = 20_000, 100_000, 2048

#: A text in a tree. ``pos``: the place of the tree's sequence in the text's order, its complement beyond the smaller set's part.
SIGNATURE = np.dtype([("rep", "<i8"), ("size", "<i4"), ("pos", "<i4"), ("bits", "<u8", WORDS)])


def letters_only(text: Column) -> Column:
    """The lower-cased text with everything but letters and digits removed."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def _sequences(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, sequence) of the distinct sequences of each row, sorted; three code points fill 63 bits, so none are confused."""
    if len(points) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p = points.astype(np.uint64)
    h = p[:-2] << np.uint64(42) | p[1:-1] << np.uint64(21) | p[2:]
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = row[:-2] == row[2:]
    row, h = row[:-2][whole], h[whole]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[first], h[first]


def _mixed(h: np.ndarray, odd: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(odd)
    return h ^ (h >> np.uint64(29))


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sequence's places in the two tables of counts."""
    return bucket(_mixed(h, 0xBF58476D1CE4E5B9), DF_BITS), bucket(_mixed(h, 0x94D049BB133111EB), DF_BITS)


def _count(column: pa.Array, tables: list[np.ndarray]) -> None:
    _, h = _sequences(*run_of_texts(column))
    for table, place in zip(tables, _places(h), strict=True):
        table += np.bincount(place, minlength=len(table))


def _packed(items: np.ndarray, new: np.ndarray) -> pa.Array:
    """Runs of an array of records, each beginning where ``new`` is true, as one binary value each."""
    ends = np.append(np.flatnonzero(new), len(items)).astype(np.int64) * items.dtype.itemsize
    if ends[-1] >= 1 << 31:
        raise ValueError("more than 2 GB of signatures in one batch")
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(items.tobytes())])


_ROUTES = "key long, slot long, blocks int, n int, texts binary"


def routes(batch: pa.RecordBatch, tables: tuple[np.ndarray, np.ndarray], t: float, group: int = GROUP) -> pa.RecordBatch:
    """(field number, rep, text) to a row for each sequence by which another text can be met, with the texts met there.

    ``slot`` holds the field and the pair of blocks; ``blocks`` is 1 for a sequence in few texts.
    """
    row, h = _sequences(*run_of_texts(batch.column(2)))
    n = batch.num_rows
    own, rep = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    size = np.bincount(row, minlength=n)
    set_bits = np.zeros((n, BITS), np.uint8)
    set_bits[row, (_mixed(h, 0xFF51AFD7ED558CCD) >> np.uint64(33)) % np.uint64(BITS)] = 1
    texts = np.zeros(n, SIGNATURE)
    texts["rep"], texts["size"] = rep, size
    texts["bits"] = np.packbits(set_bits, axis=1).view(np.uint64)
    a, b = _places(h)
    count = np.minimum(tables[0][a], tables[1][b])
    order = np.lexsort((h, count, row))
    row, h, count = row[order], h[order], count[order]
    pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    of = size[row]
    # a sequence that no other text has leads to nobody, but it keeps its place in the order
    met = (pos <= of - np.ceil(t * of - 1e-9)) & (count > 1)
    row, h, count, pos, of = row[met], h[met], count[met], pos[met], of[met]
    pos = np.where(pos <= of - np.ceil(2 * t / (1 + t) * of - 1e-9), pos, ~pos)
    # counts are never too low, and the same for all texts: so is the number of blocks
    blocks = np.where(count > group, -(-count // (group // 2)), 1).astype(np.int64)
    at = np.repeat(np.arange(len(row)), blocks)
    other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    mine = side_of(rep[row], blocks)[at]
    slot = own[row][at] << 56 | np.minimum(mine, other) << 28 | np.maximum(mine, other)
    key = h[at].view(np.int64)
    order = np.lexsort((slot, key))
    at, key, slot = at[order], key[order], slot[order]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (slot[1:] != slot[:-1])
    items = texts[row[at]]
    items["pos"] = pos[at]
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(at)))
    return pa.RecordBatch.from_arrays([pa.array(key[heads]), pa.array(slot[heads]), pa.array(blocks[at[heads]].astype(np.int32)), pa.array(lengths.astype(np.int32)), _packed(items, new)], names=["key", "slot", "blocks", "n", "texts"])


def side_of(rep: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of a text in a group of so many."""
    return (_mixed(rep.view(np.uint64), 0x9E3779B97F4A7C15) % blocks.astype(np.uint64)).astype(np.int64)


def _router(shared: object, t: float, group: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, ROUTED, 4 << 20):
            yield routes(batch, shared.value, t, group)

    return run


class Forest:
    """Signature trees of many groups, built and traversed together, a level at a time.

    ``texts`` are in order of ``group``, a number from 0; ``apart``: only texts with different ``side`` are pairs of the group.
    ``met``: pairs of texts that the traversal came to compare.
    """

    def __init__(self, texts: np.ndarray, group: np.ndarray, apart: np.ndarray, side: np.ndarray, t: float) -> None:
        self.t, self.met = t, 0
        order = np.lexsort((texts["rep"], texts["size"], group))
        count = np.bincount(group)
        room = -(-count // FAN) * FAN
        place = np.arange(len(texts)) + np.repeat(np.cumsum(room) - room - (np.cumsum(count) - count), count)
        # leaf nodes of FAN places each; a group's last may have free ones, of size 0
        self.texts = np.zeros(int(room.sum()), SIGNATURE)
        self.texts[place] = texts[order]
        self.side = np.zeros(len(self.texts), np.int64)
        self.side[place] = np.where(apart[group], side, -1 - np.arange(len(texts)))[order]
        shape = (-1, FAN)
        self.size = self.texts["size"].astype(np.int32).reshape(shape)
        self.words = [np.ascontiguousarray(self.texts["bits"][:, w]).reshape(shape) for w in range(WORDS)]
        self.excess = self.size - sum(np.bitwise_count(w).astype(np.int32) for w in self.words)
        bits = np.stack([np.bitwise_or.reduce(w, axis=1) for w in self.words], axis=1)
        low = np.where(self.size > 0, self.size, 1 << 40).min(axis=1)
        self.levels = [(bits, low, self.size.max(axis=1), self.excess.max(axis=1))]
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        nodes = room // FAN
        while (nodes > 1).any():
            above = -(-nodes // FAN)
            of = np.repeat(np.cumsum(nodes) - nodes, above)
            first = of + FAN * (np.arange(above.sum()) - np.repeat(np.cumsum(above) - above, above))
            bits, low, high, excess = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(bits, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.maximum.reduceat(excess, first)))
            self.children.append((first, np.diff(np.append(first, len(low)))))
            nodes = above

    def _may_meet(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of nodes with members that may reach t, by bitmaps and sizes."""
        bits, low, high, excess = self.levels[level]
        need = self.t / (1 + self.t) * (low[a] + low[b]) - 1e-9
        most = np.minimum(np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64) + np.minimum(excess[a], excess[b]), np.minimum(high[a], high[b]))
        # sizes alone: the smaller must be at least t of the larger
        return (most >= need) & (np.minimum(high[a], high[b]) >= self.t * np.maximum(low[a], low[b]) - 1e-9)

    def pairs(self) -> np.ndarray:
        """Dual traversal of every tree against itself: (lesser rep, greater rep) of the pairs of texts that may reach t."""
        found = [np.zeros((0, 2), np.int64)]
        top = np.arange(len(self.levels[-1][1]))
        stack = [(len(self.levels) - 1, top, top)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > COMPARED:  # halves, so that no more is expanded at a time
                half = len(a) // 2
                stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
                continue
            keep = self._may_meet(level, a, b)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                found.append(self._leaves(a, b))
                continue
            first, count = self.children[level - 1]
            many = count[a] * count[b]
            at = np.repeat(np.arange(len(a)), many)
            inside = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            x, y = first[a[at]] + inside // count[b[at]], first[b[at]] + inside % count[b[at]]
            stack.append((level - 1, x[x <= y], y[x <= y]))
        return np.unique(np.concatenate(found), axis=0)

    def _leaves(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of texts of two leaf nodes each that may reach t."""
        sizes = self.size[a][:, :, None] + self.size[b][:, None, :]
        overlap = np.minimum(self.excess[a][:, :, None], self.excess[b][:, None, :])
        for word in self.words:
            overlap += np.bitwise_count(word[a][:, :, None] & word[b][:, None, :])
        self.met += overlap.size
        k, i, j = np.nonzero(overlap >= self.t / (1 + self.t) * sizes - 1e-9)
        x, y = a[k] * FAN + i, b[k] * FAN + j
        texts = self.texts
        keep = (x < y) & (texts["size"][x] > 0) & (texts["size"][y] > 0) & (texts["rep"][x] != texts["rep"][y]) & (self.side[x] != self.side[y])
        x, y = texts[x[keep]], texts[y[keep]]
        px, py = np.where(x["pos"] < 0, ~x["pos"], x["pos"]), np.where(y["pos"] < 0, ~y["pos"], y["pos"])
        # the tree's sequence is the first in common at best, so what comes before it is not shared
        after = np.minimum(x["size"] - px, y["size"] - py)
        smaller = np.where(x["size"] < y["size"], x["pos"] >= 0, np.where(x["size"] > y["size"], y["pos"] >= 0, (x["pos"] >= 0) | (y["pos"] >= 0)))
        keep = smaller & (after >= self.t / (1 + self.t) * (x["size"].astype(np.int64) + y["size"]) - 1e-9)
        return np.sort(np.stack([x["rep"][keep], y["rep"][keep]], axis=1), axis=1)


def forest_of(rows: pa.Table, t: float) -> tuple[np.ndarray, Forest]:
    """The fields of the groups in a table of routes, sorted by group, and their trees; see ``field_pairs``."""
    key, slot, blocks, n = (rows.column(c).to_numpy() for c in ("key", "slot", "blocks", "n"))
    texts = np.frombuffer(b"".join(rows.column("texts").to_pylist()), SIGNATURE)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (slot[1:] != slot[:-1])
    group = np.repeat(np.cumsum(new) - 1, n)
    low, high = slot[new] >> 28 & (1 << 28) - 1, slot[new] & (1 << 28) - 1
    return slot[new] >> 56, Forest(texts, group, low != high, side_of(texts["rep"], np.repeat(blocks.astype(np.int64), n)), t)


def _traverser(t: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Routes sorted by field and group to candidates."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        texts = 0

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            field = table.column("slot").to_numpy() >> 56
            for f in np.unique(field):
                pairs = forest_of(table.filter(pa.array(field == f)), t)[1].pairs()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), f, np.int32)), pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["f", "a", "b"])

        for batch in batches:
            held.append(batch)
            texts += int(batch.column(3).to_numpy().sum())
            if texts < HELD:
                continue
            table = pa.Table.from_batches(held)
            key, slot = table.column("key").to_numpy(), table.column("slot").to_numpy()
            last = np.flatnonzero((key != key[-1]) | (slot != slot[-1]))
            if not len(last):
                continue  # one group only, and it is bounded
            cut_at = int(last[-1]) + 1
            yield from out(table.slice(0, cut_at))
            held = table.slice(cut_at).to_batches()
            texts = int(table.slice(cut_at).column("n").to_numpy().sum())
        if texts:
            yield from out(pa.Table.from_batches(held))

    return run


def similar_pairs(reps: DataFrame, t: float, group: int = GROUP) -> DataFrame:
    """(f, a, b), a < b, of different texts of (f, rep, text) with similarity of at least ``t``; ``f`` numbers the field
    (0 to 127), within which ids are unique and pairs are looked for."""
    tables = summed_tables(reps.select("text"), [1 << DF_BITS] * 2, _count)
    shared = reps.sparkSession.sparkContext.broadcast(tuple(x.astype(np.int64).astype(np.int32) for x in tables))
    routed = reps.select("f", "rep", "text").mapInArrow(_router(shared, t, group), _ROUTES)
    trees = routed.repartition("key", "slot").sortWithinPartitions("key", "slot")
    candidates = trees.mapInArrow(_traverser(t), "f int, a long, b long").distinct()
    text = lambda side: reps.select("f", F.col("rep").alias(side), F.col("text").alias(f"text_{side}"))
    both = candidates.join(text("a"), ["f", "a"]).join(text("b"), ["f", "b"]).select("f", "a", "b", "text_a", "text_b")
    return both.mapInArrow(_checker(t), "f int, a long, b long")


def reach(first: pa.Array, second: pa.Array, t: float) -> np.ndarray:
    """Of two columns side by side: the texts whose sets of sequences reach a similarity of ``t``."""
    n = len(first)
    (i, x), (j, y) = _sequences(*run_of_texts(first)), _sequences(*run_of_texts(second))
    row, h = np.concatenate([i, j]), np.concatenate([x, y])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    both = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=n)
    either = np.bincount(row, minlength=n) - both
    return (both > 0) & (both >= t * either - 1e-9)


def _checker(t: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(reach(batch.column(3), batch.column(4), t))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in range(3)], names=["f", "a", "b"])

    return run


def near_copies(texts: DataFrame, fields: tuple[str, ...], t: float = 0.6, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(members, links) of (field, id, text), ids unique within a field: members has (field, id, rep), the class of
    equal texts of each id; links has (field, a, b), pairs of class representatives, so copies are never expanded."""
    number = F.array_position(F.lit(list(fields)), F.col("field")).cast("int") - 1
    ids = texts.where(F.col("field").isin(*fields)).select(number.alias("f"), "id", letters_only(F.col("text")).alias("text")).where(F.length("text") >= N)
    classes = cut(ids.groupBy("f", "text").agg(F.min("id").alias("rep")))
    links = similar_pairs(classes, t, group)
    # equal texts are told by their digest, so that the texts needn't be shuffled again
    same = F.unhex(F.sha2("text", 256)).alias("same")
    members = ids.select("f", "id", same).distinct().join(classes.select("f", "rep", same), ["f", "same"])
    named = F.element_at(F.lit(list(fields)), F.col("f") + 1).alias("field")
    return members.select(named, "id", "rep"), links.select(named, "a", "b")


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(field, id_a, id_b), id_a < id_b: every pair of near-copies, equal texts among them."""
    a = members.select("field", F.col("rep").alias("a"), F.col("id").alias("x"))
    b = members.select("field", F.col("rep").alias("b"), F.col("id").alias("y"))
    equal = a.join(b.withColumnRenamed("b", "a"), ["field", "a"]).where(F.col("x") < F.col("y"))
    near = links.join(a, ["field", "a"]).join(b, ["field", "b"])
    low, high = F.least("x", "y"), F.greatest("x", "y")
    return equal.select("field", low.alias("id_a"), high.alias("id_b")).unionByName(near.select("field", low.alias("id_a"), high.alias("id_b")))


def classes_with_links(members: DataFrame, links: DataFrame) -> DataFrame:
    """(field, id, class_id, n_links): one row per id, its class of equal texts and the number of classes near it."""
    both = links.select("field", F.col("a").alias("rep")).unionByName(links.select("field", F.col("b").alias("rep")))
    counts = both.groupBy("field", "rep").agg(F.count("*").alias("n"))
    return members.join(counts, ["field", "rep"], "left").select("field", "id", F.col("rep").alias("class_id"), F.coalesce("n", F.lit(0)).alias("n_links"))
