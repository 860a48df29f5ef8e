"""Subject areas of documents: averaged word and subword embeddings with independent logistic outputs.

A text is the mean of the embeddings of its features: Latin words and pairs of ideographs as words,
letter trigrams and single ideographs as subwords, all hashed. One logistic output per subject says
whether it is there, whatever the others say. All parameters are learnt from the labelled documents:
in each round every partition computes the gradient of a part of its documents, the parts in turn;
the gradients are summed on the executors, and one step is taken for all. The model is fitted on the
labelled documents as wholes, then twice on their sentences, each taken for the subjects that the
model before gives it, with odds for its document's labels; so a label on a document of two subjects,
a passing mention and a wrong label don't colour the words of other sentences. Every document is
scored sentence by sentence, a sentence counts for every subject with a positive output, and a
subject is assigned if its sentences take up at least ``share`` of the text.

Defined results: null, blank and unlabelled-language texts get no subject unless a sentence scores;
a document with several labels by one or more annotators learns their mean; repeated rows give
repeated rows; texts are scored whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkmill.llm.batches import regrouped, run_of_texts
from silkmill.llm.tokens import bucket, pair_hash, tokenize
from silkmill.session import cut

FEATURE_BITS, DIM = 16, 16
#: Texts of a slice, parts of the texts that steps take in turn, and features per block of a gradient.
SLICE, STRIPES, BLOCK = 500, 4, 4096
#: Labelled documents that the model is fitted on, at most; and the partitions that share them.
LABELLED, PARTITIONS = 20_000, 8
#: Weight decay; how much likelier (logarithm of the odds) a label of the document makes a sentence's subject; length of a step.
DECAY, LABEL_ODDS, RATE = 0.02, 2.0, 0.3
#: Code points scored at a time.
CHUNK = 250_000


def features(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point index, feature) of all features of the texts, in no order."""
    t = tokenize(points, starts)
    if not len(t.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = points[t.start]
    wide = ~t.word & (head >= 0x2E80)
    together = np.flatnonzero(wide[:-1] & wide[1:] & (t.row[:-1] == t.row[1:]))
    p = points.astype(np.uint64)
    letters = np.zeros(len(points), bool)
    inside = np.cumsum(np.bincount(t.start[t.word], minlength=len(points) + 1) - np.bincount(t.end[t.word], minlength=len(points) + 1))[: len(points)]
    letters = inside > 0
    tri = np.flatnonzero(letters[:-2] & letters[1:-1] & letters[2:]) if len(points) > 2 else np.zeros(0, np.int64)
    low = np.where((p >= 65) & (p <= 90), p + np.uint64(32), p)
    grams = pair_hash(pair_hash(low[tri], low[tri + 1]), low[tri + 2]) ^ np.uint64(0x5BD1E995)
    at = np.concatenate([t.start, t.start[together], tri])
    hashes = np.concatenate([t.hash, pair_hash(t.hash[together], t.hash[np.minimum(together + 1, len(t.hash) - 1)]), grams])
    return at, bucket(hashes, FEATURE_BITS)


_SLICE = "stripe int, n int, docs binary, uses binary, ids binary, weights binary, targets binary"


def _label_matrix(batch: pa.RecordBatch, codes: list[str]) -> np.ndarray:
    targets = np.zeros((batch.num_rows, len(codes)), np.float32)
    for i, (own, share) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
        for code, w in zip(own, share, strict=True):
            if code in codes:
                targets[i, codes.index(code)] = w
    return targets


def _slicer(codes: list[str], shared: object | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, codes, weights) to slices of texts as sparse feature means with their targets: ``ids`` are a slice's features,
    ``uses`` says which of them a text of ``docs`` holds, with its weight in the mean. A text is in one of ``STRIPES``.

    With a model in ``shared`` the texts are the sentences of the documents, and their targets what it gives them.
    """
    kinds = pa.schema([("stripe", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("docs", "uses", "ids", "weights", "targets"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, SLICE, 8 << 20):
            points, starts = run_of_texts(batch.column(0))
            targets = _label_matrix(batch, codes)
            at, ids = features(points, starts)
            if shared is not None:
                table, bias = shared.value
                cuts = sentences(points, starts)
                scores, _ = _sentence_scores(at, ids, cuts, table, bias)
                labels = targets[np.searchsorted(starts, cuts, side="right") - 1]
                # each subject by itself: a label makes it likelier, the lack of one less likely
                targets = (scores > np.maximum(0, LABEL_ODDS * (1 - 2 * labels))).astype(np.float32)
                starts = np.append(cuts, len(points))
            doc = np.searchsorted(starts, at, side="right") - 1
            joint, count = np.unique(doc * (1 << FEATURE_BITS) + ids, return_counts=True)
            doc, ids = joint >> FEATURE_BITS, joint & ((1 << FEATURE_BITS) - 1)
            weights = (count / np.bincount(doc, count, minlength=len(targets))[doc]).astype(np.float32)
            rows = []
            for stripe in range(STRIPES):
                mine = doc % STRIPES == stripe
                own, uses = np.unique(ids[mine], return_inverse=True)
                part = targets[stripe::STRIPES]
                if len(part):
                    rows.append({"stripe": stripe, "n": len(part), "docs": (doc[mine] // STRIPES).astype(np.int32).tobytes(), "uses": uses.astype(np.int32).tobytes(), "ids": own.astype(np.int32).tobytes(), "weights": weights[mine].tobytes(), "targets": part.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return run


_GRADIENT = "block int, n long, loss double, grads binary"


def _gradient(shared: object, outputs: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The summed gradient of a partition's texts by what a feature adds to each output, a row per block of features; the
    biases' gradient is block -1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        total, d_bias, n_all, loss = np.zeros((len(table), outputs), np.float32), np.zeros(outputs, np.float32), 0, 0.0
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                doc, uses, ids = (np.frombuffer(row[c], np.int32) for c in ("docs", "uses", "ids"))
                w, targets = np.frombuffer(row["weights"], np.float32), np.frombuffer(row["targets"], np.float32).reshape(n, outputs)
                # an output at a time: a column of the slice's own features fits the cache
                out = np.stack([np.bincount(doc, column[uses] * w, minlength=n) for column in np.ascontiguousarray(table[ids].T)], axis=1) + bias
                p = 1.0 / (1.0 + np.exp(-out))
                loss -= float((targets * np.log(p + 1e-7) + (1 - targets) * np.log(1 - p + 1e-7)).sum())
                error = p - targets
                d_bias += error.sum(axis=0).astype(np.float32)
                total[ids] += np.stack([np.bincount(uses, column[doc] * w, minlength=len(ids)) for column in np.ascontiguousarray(error.T.astype(np.float32))], axis=1)
                n_all += n
        rows = [{"block": -1, "n": n_all, "loss": loss, "grads": d_bias.tobytes()}]
        rows += [{"block": k, "n": 0, "loss": 0.0, "grads": total[k * BLOCK : (k + 1) * BLOCK].tobytes()} for k in range(len(table) // BLOCK)]
        yield pa.RecordBatch.from_pylist(rows, schema=_GRADIENT_ROWS)

    return run


_GRADIENT_ROWS = pa.schema([("block", pa.int32()), ("n", pa.int64()), ("loss", pa.float64()), ("grads", pa.binary())])


def _summed(key: tuple, parts: pa.Table) -> pa.Table:
    """All partitions' gradients of one block."""
    grads = np.sum([np.frombuffer(g, np.float32) for g in parts.column("grads").to_pylist()], axis=0, dtype=np.float32)
    sums = {c: sum(parts.column(c).to_pylist()) for c in ("n", "loss")}
    return pa.Table.from_pylist([{"block": key[0].as_py(), **sums, "grads": grads.tobytes()}], schema=_GRADIENT_ROWS)


@dataclass
class SubjectModel:
    """``table``: what one occurrence of each feature adds to each subject's output, before the mean is taken."""

    codes: list[str]
    table: np.ndarray
    bias: np.ndarray
    losses: list[float]


def _descend(slices: DataFrame, outputs: int, rounds: int, seed: int) -> tuple[list[np.ndarray], list[float]]:
    """Synchronous gradient descent: in each step one stripe of every partition's texts. Embeddings, outputs, biases; losses.

    An output is linear in the embeddings' products with the output weights, so those products are
    all that partitions need and all whose gradient they give; it is summed block by block on the
    executors, and the driver derives from it the gradients of embeddings and weights.
    """
    rng = np.random.default_rng(seed)
    parameters = [
        rng.normal(0, 0.05, (1 << FEATURE_BITS, DIM)).astype(np.float32),
        rng.normal(0, 0.5, (DIM, outputs)).astype(np.float32),
        np.full(outputs, -2.0, np.float32),
    ]
    first = [np.zeros_like(x) for x in parameters]
    second = [np.zeros_like(x) for x in parameters]
    losses: list[float] = []
    context = slices.sparkSession.sparkContext
    for step in range(1, rounds + 1):
        embeddings, out, bias = parameters
        shared = context.broadcast(((embeddings @ out).astype(np.float32), bias))
        stripe = slices.where(F.col("stripe") == step % STRIPES)
        summed = stripe.mapInArrow(_gradient(shared, outputs), _GRADIENT).groupBy("block").applyInArrow(_summed, _GRADIENT).collect()
        shared.destroy()
        n = sum(r["n"] for r in summed)
        if n:
            by_block = {r["block"]: np.frombuffer(r["grads"], np.float32) for r in summed}
            of_table = np.concatenate([by_block[k] for k in range((1 << FEATURE_BITS) // BLOCK)]).reshape(-1, outputs)
            grads = [of_table @ out.T, embeddings.T @ of_table, by_block[-1]]
            losses.append(sum(r["loss"] for r in summed) / n)
            rate = RATE * min(1.0, (rounds + 1 - step) / (0.4 * rounds))
            for x, g, m, v, decay in zip(parameters, grads, first, second, (DECAY, DECAY, 0.0), strict=True):
                g = g / n
                m += 0.1 * (g - m)
                v += 0.05 * (g * g - v)
                x -= rate * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-6) + decay * x)
    return parameters, losses


def fit_subjects(labelled: DataFrame, codes: list[str], rounds: tuple[int, ...] = (16, 12, 12), limit: int = LABELLED, seed: int = 3) -> SubjectModel:
    """From (doc_id, text, codes array, weights array), at most ``limit`` documents, taken by the hash of their id."""
    # ids are chosen first, so that no more than ``limit`` ids, and no texts, are sorted or broadcast
    ids = labelled.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = labelled.where(F.length("text") > 0).join(F.broadcast(ids), "doc_id", "left_semi")
    sample = cut(sample.repartition(PARTITIONS, "doc_id").select("text", "codes", "weights"))
    context = labelled.sparkSession.sparkContext
    losses: list[float] = []
    table, bias = np.zeros((1 << FEATURE_BITS, len(codes)), np.float32), np.full(len(codes), -2.0, np.float32)
    if not codes:
        return SubjectModel(codes, table, bias, losses)
    shared = None
    for step, n in enumerate(rounds):
        slices = cut(sample.mapInArrow(_slicer(codes, shared), _SLICE))
        (embeddings, out, bias), more = _descend(slices, len(codes), n, seed + step)
        table = (embeddings @ out).astype(np.float32)
        losses += more
        shared = context.broadcast((table, bias))
    return SubjectModel(codes, table, bias, losses)


_ENDS = np.zeros(0x10000, bool)
_ENDS[[ord(c) for c in "。！？；\n\r"]] = True
_STOPS = np.zeros(0x10000, bool)
_STOPS[[ord(c) for c in ".!?"]] = True


def sentences(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where each sentence starts; texts start one."""
    small = np.minimum(points, 0xFFFF)
    new = np.zeros(len(points) + 1, bool)
    new[1:] = _ENDS[small]
    stop = np.flatnonzero(_STOPS[small[:-1]] & (small[1:] == 32)) if len(points) else np.zeros(0, np.int64)
    new[stop + 2] = True
    new[starts[:-1]] = True
    return np.flatnonzero(new[: len(points)])


def _sentence_scores(at: np.ndarray, ids: np.ndarray, cuts: np.ndarray, table: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of each sentence, and the number of its features; a sentence without features scores the biases."""
    which = np.searchsorted(cuts, at, side="right") - 1
    count = np.bincount(which, minlength=len(cuts))
    sums = [np.bincount(which, column[ids], minlength=len(cuts)) for column in np.ascontiguousarray(table.T)]
    return np.stack(sums, axis=1) / np.maximum(count, 1)[:, None] + bias, count


def shares(points: np.ndarray, starts: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Of each text the share that each subject's sentences take up."""
    n, out = len(starts) - 1, np.zeros((len(starts) - 1, len(bias)))
    cuts = sentences(points, starts)
    if not len(cuts):
        return out
    scores, _ = _sentence_scores(*features(points, starts), cuts, table, bias)
    length = np.diff(np.append(cuts, len(points)))
    doc = np.searchsorted(starts, cuts, side="right") - 1
    which, subject = np.nonzero(scores > 0)
    np.add.at(out, (doc[which], subject), length[which])
    return out / np.maximum(np.diff(starts), 1)[:, None]


def _scorer(shared: object, share: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, table, bias = shared.value
        names = np.array(codes, dtype=object)
        for batch in batches:
            length = np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32)[batch.column(1).offset : batch.column(1).offset + batch.num_rows + 1].astype(np.int64))
            piece = np.cumsum(length) // (2 * CHUNK)
            for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(piece)) + 1):
                if not len(rows):
                    continue
                part = batch.slice(int(rows[0]), len(rows))
                points, starts = run_of_texts(part.column(1))
                found = shares(points, starts, table, bias)
                doc, subject = np.nonzero(found >= share)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), pa.array(names[subject], pa.string()), pa.array(found[doc, subject])], names=["doc_id", "subject_code", "share"])

    return run


def assign_subjects(documents: DataFrame, model: SubjectModel, share: float = 0.16) -> DataFrame:
    """(doc_id, subject_code, share) of (doc_id, text), scored whole; one narrow pass."""
    if not model.codes:
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("").alias("subject_code"), F.lit(0.0).alias("share")).limit(0)
    shared = documents.sparkSession.sparkContext.broadcast((model.codes, model.table, model.bias))
    return documents.select("doc_id", "text").where(F.col("text").isNotNull()).mapInArrow(_scorer(shared, share), "doc_id long, subject_code string, share double")


def with_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, codes, weights): labelled documents, each label weighted by the part of its annotators that gave it."""
    by = labels.groupBy("doc_id").agg(F.count_distinct(F.coalesce("annotator", F.lit(""))).alias("annotators"))
    each = labels.where(F.col("subject_code").isNotNull()).groupBy("doc_id", "subject_code").agg(F.count_distinct(F.coalesce("annotator", F.lit(""))).alias("n"))
    wide = each.groupBy("doc_id").agg(F.collect_list(F.struct("subject_code", "n")).alias("given"))
    target = by.join(wide, "doc_id", "left").select("doc_id", F.coalesce(F.transform("given", lambda g: g["subject_code"]), F.array().cast("array<string>")).alias("codes"), F.coalesce(F.transform("given", lambda g: g["n"]), F.array().cast("array<bigint>")).alias("counts"), "annotators")
    joined = documents.select("doc_id", "text").dropDuplicates(["doc_id"]).join(target, "doc_id")
    return joined.select("doc_id", "text", "codes", F.transform("counts", lambda c: c / F.col("annotators")).alias("weights"))
