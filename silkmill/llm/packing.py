"""Texts measured in tokens and packed into containers of fixed capacity.

Documents are spread over shards of bounded size, and each shard is packed on its own: a text above
the capacity is cut into full containers and a rest; rests and whole texts are divided into equally
full windows by Karmarkar-Karp multiway differencing: partial partitions are kept as vectors of
window sums, the two with the greatest imbalance are merged with the fullest windows of the one
meeting the emptiest of the other, until one is left. The number of windows starts at a bound below
which none can do and rises whenever windows exceed the capacity, by as many as what is above would fill, one at least.

Defined results: null and empty texts (no tokens) are left out; repeated ids count once; every other
text is in exactly one container unless it exceeds the capacity; positions are token offsets.
"""

from __future__ import annotations

import base64
import bisect
import heapq
import os
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usual place of the public tokenizers, and the vocabulary used.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"
# Fixed value: how the vocabulary's texts are cut into words before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents per shard on average, and the most that differencing takes at once.
SHARD, BLOCK = 1024, 2048
#: Tasks that shards are spread over, at most.
TASKS = 10_000


def tokenizer(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> object:
    """The encoder of a vocabulary file, loaded once per Python process."""
    kept = sys.modules.setdefault("_silkmill_tokenizers", type(sys)("_silkmill_tokenizers")).__dict__
    key = f"{folder}/{vocabulary}"
    if key not in kept:
        import tiktoken

        with Path(folder, vocabulary).open("rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept[key] = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[key]


def _kind(char: str) -> str:
    """Which class of ``WORD_PATTERN`` a character is of: L, N, S or P; empty where that is not certain."""
    category = unicodedata.category(char)
    if char == "'" or category == "Cn" or category == "Cc" and char not in "\t\n\r":
        return ""  # contractions; characters that other versions of Unicode class differently
    return "S" if char.isspace() else category[0] if category[0] in "LN" else "P"


def _parted(text: str, at: int) -> bool:
    """A word of ``WORD_PATTERN`` surely ends before ``at``, whether or not the text goes on.

    No word has anything but space before its letters, digits or marks, and none has a space after
    them; a run of spaces is parted by what follows it, so there is no parting after a space.
    """
    before, after = _kind(text[at - 1]), _kind(text[at])
    return before in ("L", "N", "P") and after != "" and before != after


def _pieces(text: str) -> Iterator[str]:
    """A text in runs of a few thousand characters, parted where ``WORD_PATTERN`` parts it, so that no single run is slow
    and the runs' tokens are those of the whole text. A run goes on to the next such place, however far."""
    at = 0
    while at < len(text):
        end = min(at + 4000, len(text))
        if end < len(text):
            before = next((k for k in range(end, at, -1) if _parted(text, k)), None)
            end = before or next((k for k in range(end + 1, len(text)) if _parted(text, k)), len(text))
        yield text[at:end]
        at = end


def token_count(encoder: object, text: str) -> int:
    return sum(len(encoder.encode_ordinary(p)) for p in _pieces(text))


def _counter(folder: str, vocabulary: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(folder, vocabulary)
        for batch in batches:
            counts = [token_count(encoder, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(k) for k in range(2, batch.num_columns)), pa.array(counts, pa.int64())], names=[batch.schema.names[0], *batch.schema.names[2:], "tokens"])

    return run


def count_tokens(documents: DataFrame, keep: tuple[str, ...] = (), folder: str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, *keep, tokens) of documents with a text; one narrow pass."""
    folder = folder or os.environ.get("SILKMILL_TOKENIZERS", TOKENIZERS)
    kinds = dict(documents.dtypes)
    schema = ", ".join(["doc_id long", *(f"`{k}` {kinds[k]}" for k in keep), "tokens long"])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep).where(F.length("text") > 0).mapInArrow(_counter(folder, vocabulary), schema)


def differenced(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``k`` parts of nearly equal sum, by multiway differencing. Ties go by index."""
    # a partial partition: (-sum, first item, node) of the windows that hold anything, the fullest first; the others are empty
    heap = [(-s, i, [(-s, i, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    items = serial = len(sizes)
    joined: list[tuple[int, int]] = []  # node items + n holds the items of both
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        free = k - len(a)
        # the fullest windows of b meet the emptiest of a: empty ones first, then from the end
        merged = a + b[:free]
        for at, (s, _, node) in zip(range(len(a) - 1, -1, -1), b[free:], strict=False):
            t, first, own = merged[at]
            merged[at] = (t + s, first, items + len(joined))
            joined.append((own, node))
        merged.sort()
        least = merged[-1][0] if len(merged) == k else 0
        serial += 1
        heapq.heappush(heap, (merged[0][0] - least, serial, merged))
    parts = []
    for _, _, node in heap[0][2] if heap else []:
        out, stack = [], [node]
        while stack:
            x = stack.pop()
            if x < items:
                out.append(x)
            else:
                stack += reversed(joined[x - items])
        parts.append(out)
    return parts + [[] for _ in range(k - len(parts))]


def least_windows(sizes: list[int], capacity: int) -> int:
    """No fewer windows can hold the items: those above half the capacity need one each, and what doesn't fit beside them more."""
    ordered = sorted(sizes, reverse=True)
    before = [0]
    for s in ordered:
        before.append(before[-1] + s)
    small = [-s for s in ordered]
    over = bisect.bisect_left(small, -(capacity // 2))  # items above half the capacity
    most = max(over, -(-before[-1] // capacity))
    for least in sorted({s for s in ordered[over:]}):
        alone = bisect.bisect_left(small, -(capacity - least))  # beside these nothing of ``least`` or more fits
        fit = bisect.bisect_right(small, -least)
        room = (over - min(alone, over)) * capacity - (before[over] - before[min(alone, over)])
        most = max(most, over + max(0, -(-(before[fit] - before[over] - room) // capacity)))
    return most


def pack(items: list[tuple[int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Containers of (id, start, end) token spans for (id, tokens) items; none exceeds the capacity."""
    full: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []
    for key, tokens in sorted(items):
        at = 0
        while tokens - at > capacity:
            full.append([(key, at, at + capacity)])
            at += capacity
        if tokens > at:
            rest.append((key, at, tokens))
    out = full
    for begin in range(0, len(rest), BLOCK):
        block = rest[begin : begin + BLOCK]
        sizes = [b - a for _, a, b in block]
        k = least_windows(sizes, capacity)
        while True:
            parts = differenced(sizes, k)
            above = sum(max(0, sum(sizes[i] for i in p) - capacity) for p in parts)
            if not above:
                break
            k += max(1, above // capacity)
        out = out + [[block[i] for i in sorted(p)] for p in parts if p]
    return out


def _packer(capacities: dict[str, int]) -> Callable[[tuple, pa.Table], pa.Table]:
    names = ["capacity_name", "shard", "container_no", "doc_id", "token_start", "token_end"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(key: tuple, shard: pa.Table) -> pa.Table:
        number = key[0].as_py()
        items = list(zip(shard.column("doc_id").to_pylist(), shard.column("tokens").to_pylist(), strict=True))
        rows = [(name, number, no, *span) for name, capacity in sorted(capacities.items()) for no, spans in enumerate(pack(items, capacity)) for span in spans]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(6)], names=names)

    return run


def pack_documents(counted: DataFrame, capacities: dict[str, int], documents: int) -> DataFrame:
    """(capacity_name, shard, container_no, doc_id, token_start, token_end) of (doc_id, tokens).

    ``documents``: about how many there are; shards go by a hash of the id, so none grows with the data.
    """
    shards = max(1, round(documents / SHARD))
    items = counted.select("doc_id", "tokens").where(F.col("tokens") > 0).dropDuplicates(["doc_id"]).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    # shards are small but dear: their number of tasks is set here, as it would else follow their few bytes
    spread = items.select("shard", "doc_id", "tokens").repartition(min(shards, TASKS), "shard")
    return spread.groupBy("shard").applyInArrow(_packer(capacities), "capacity_name string, shard long, container_no int, doc_id long, token_start long, token_end long")


def fill_report(packed: DataFrame, capacities: dict[str, int]) -> DataFrame:
    """(capacity_name, containers, tokens, unused_share) per capacity."""
    size = F.lit(None).cast("long")
    for name, capacity in capacities.items():
        size = F.when(F.col("capacity_name") == name, F.lit(capacity).cast("long")).otherwise(size)
    each = packed.groupBy("capacity_name", "shard", "container_no").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    total = each.groupBy("capacity_name").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return total.select("capacity_name", "containers", "tokens", F.round(1 - F.col("tokens") / (F.col("containers") * size), 6).alias("unused_share"))
