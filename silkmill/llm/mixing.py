"""Sources mixed to target shares of the tokens, small ones repeated up to a limit.

1. Tokens are counted per source and shard of a source.
2. Equal-token blocks are apportioned to the sources by Sainte-Laguë's highest quotients, under each
   source's limit of its tokens times its repeats; the blocks of a source are apportioned to its
   shards in the same way, so every shard has an integer quota.
3. In a shard the documents form blocks of about equal tokens; whole passes over the shard and, for
   what is left of the quota, blocks in seeded order give each document its number of copies.

The total is the largest at which no source that has documents falls short of its share, unless one
is given; then sources at their limit leave the rest to the others. Shares are kept to whole blocks:
a source that doesn't fill a block with all its repeats still has one block of its own, which holds
all its documents as often as they may be repeated.

Defined results: sources that are not listed, and documents without a source or tokens, are left
out; listed sources without documents reach a share of 0, and the others share what is left in
proportion; a target of null, 0 or less takes nothing; repeated ids count once; documents are never cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silkmill.session import broadcast_if_small, few_rows

#: Tokens of a block, blocks per shard at least, and shards of a source at most.
BLOCK_TOKENS, SHARD_BLOCKS, SHARDS = 1024, 256, 2048
#: Listed sources, at most: more fail.
SOURCES = 100_000


def sainte_lague(weights: list[float], seats: int, limits: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2 s + 1), none above its limit; ties go to the first.

    A seat count is what rounding weight times a common multiplier gives, so the multiplier is
    searched for and only the last few seats are given out one by one: the time does not depend on
    the number of seats.
    """
    w = np.array([max(0.0, x or 0.0) for x in weights], float)
    limit = np.where(w > 0, np.array(limits, np.int64), 0)
    seats = int(min(seats, limit.sum()))
    if seats <= 0:
        return [0] * len(w)
    at = lambda m: np.minimum(np.floor(w * m + 0.5).astype(np.int64), limit)
    low, high = 0.0, 1.0
    while at(high).sum() < seats:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if at(middle).sum() <= seats:
            low = middle
        else:
            high = middle
    given = at(low)
    while given.sum() < seats:
        quotient = np.where(given < limit, w / (2 * given + 1), -1.0)
        given[int(quotient.argmax())] += 1
    return [int(x) for x in given]


@dataclass
class Quotas:
    """Blocks per (source, shard), and the total of all."""

    blocks: dict[tuple[str, int], int]
    total: int


def quotas(sizes: list[tuple[str, int, int]], targets: dict[str, tuple[float, int]], total_tokens: int | None) -> Quotas:
    """From (source, shard, tokens) and source -> (target share, repeats)."""
    by: dict[str, list[tuple[int, int]]] = {}
    for source, shard, tokens in sorted(sizes):
        by.setdefault(source, []).append((shard, tokens))
    names = [s for s in sorted(by) if targets[s][0] > 0]
    share = [targets[s][0] for s in names]
    limit = [[t * max(0, targets[s][1]) // BLOCK_TOKENS for _, t in by[s]] for s in names]
    for s, own in zip(names, limit, strict=True):
        if not any(own) and targets[s][1] > 0:  # less than a block: one of its own, for its largest shard
            own[max(range(len(own)), key=lambda k: by[s][k][1])] = 1
    most = [sum(x) for x in limit]
    if total_tokens is None:
        fair = [m / (w / sum(share)) for m, w in zip(most, share, strict=True) if m]
        seats = int(min(fair)) if fair else 0
    else:
        seats = total_tokens // BLOCK_TOKENS
    blocks: dict[tuple[str, int], int] = {}
    for s, n, own in zip(names, sainte_lague(share, seats, most), limit, strict=True):
        for (shard, _), k in zip(by[s], sainte_lague([float(t) for _, t in by[s]], n, own), strict=True):
            blocks[(s, shard)] = k
    return Quotas(blocks, sum(blocks.values()))


def mix(counted: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, source, tokens, copies) of the mixture's documents, from (doc_id, source, tokens)."""
    spark = counted.sparkSession
    wanted = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in few_rows(targets, SOURCES, "sources") if r["source"] is not None}
    items = counted.select("doc_id", "source", "tokens").where(F.col("source").isNotNull() & (F.col("tokens") > 0)).dropDuplicates(["doc_id"])
    listed = spark.createDataFrame([(s,) for s in sorted(wanted)] or [("",)], "source string")
    items = items.join(broadcast_if_small(listed), "source", "left_semi")
    # the number of shards follows a source's tokens up to a fixed most
    sums = {r["source"]: r["tokens"] for r in items.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    shards = spark.createDataFrame([(s, int(min(SHARDS, max(1, t // (SHARD_BLOCKS * BLOCK_TOKENS))))) for s, t in sorted(sums.items())] or [("", 1)], "source string, shards int")
    items = items.join(broadcast_if_small(shards), "source").withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.col("shards")).cast("int")).drop("shards")
    sizes = [(r["source"], r["shard"], r["tokens"]) for r in items.groupBy("source", "shard").agg(F.sum("tokens").alias("tokens")).collect()]
    quota = quotas(sizes, wanted, total_tokens)
    total = {(s, k): t for s, k, t in sizes}
    # a source's only block may hold less than a block's tokens: no document goes beyond its repeats
    plan = spark.createDataFrame([(s, k, int(min(n * BLOCK_TOKENS, total[(s, k)] * max(0, wanted[s][1]))), int(total[(s, k)])) for (s, k), n in sorted(quota.blocks.items())] or [("", 0, 0, 1)], "source string, shard int, quota long, whole long")
    of_shard = Window.partitionBy("source", "shard")
    placed = items.withColumn("start", F.sum("tokens").over(of_shard.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.withColumn("block", F.floor(F.coalesce("start", F.lit(0)) / BLOCK_TOKENS))
    blocks = placed.groupBy("source", "shard", "block").agg(F.sum("tokens").alias("size")).join(broadcast_if_small(plan), ["source", "shard"])
    order = of_shard.orderBy(F.xxhash64(F.lit(seed), "source", "shard", "block"), "block")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    passes = F.floor(F.col("quota") / F.col("whole"))
    rest = F.col("quota") - passes * F.col("whole")
    chosen = blocks.withColumn("copies", (passes + F.when(before + F.col("size") / 2 <= rest, 1).otherwise(0)).cast("int"))
    return placed.join(chosen.select("source", "shard", "block", "copies"), ["source", "shard", "block"]).where(F.col("copies") > 0).select("doc_id", "source", "tokens", "copies")


def share_report(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, tokens, share, most_copies) of every listed source."""
    got = mixture.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    all_tokens = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    joined = targets.select("source", "target_share").dropDuplicates(["source"]).join(got, "source", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return joined.select("source", "target_share", tokens.alias("tokens"), F.round(F.coalesce(F.col("tokens") / all_tokens, F.lit(0.0)), 6).alias("share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
