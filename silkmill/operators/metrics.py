"""Corpus metrics of generated text against references: BLEU, ROUGE-N and ROUGE-L, after the published formulas."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ngrams(items: Column, n: Column | int) -> Column:
    """All runs of ``n`` items of an array, joined by an unlikely separator."""
    n = F.lit(n) if isinstance(n, int) else n
    count = F.size(items) - n + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(items, i, n), "\x1f"))


def all_ngrams(df: DataFrame, key: str, candidate: Column, reference: Column, sizes: list[int]) -> DataFrame:
    """(key, n, gram, c, r): how often each n-gram of the given sizes stands in the candidate and in the reference.

    Both sides and all sizes come from one pass over the rows and are counted in one grouping.
    """

    def counted(items: Column, n: int, side: int) -> Column:
        return F.transform(ngrams(items, n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram"), F.lit(1 - side).alias("c"), F.lit(side).alias("r")))

    # an array for each side and size; nulls, where a side is null, are left out
    parts = F.array_compact(F.array(*[counted(items, n, side) for side, items in enumerate((candidate, reference)) for n in sizes]))
    each = df.select(F.col(key).alias("_k"), F.explode(F.flatten(parts)).alias("_g")).select(F.col("_k").alias(key), "_g.*")
    return each.groupBy(key, "n", "gram").agg(F.sum("c").alias("c"), F.sum("r").alias("r"))


def ngram_overlap(df: DataFrame, key: str, candidate: Column, reference: Column, n: int) -> DataFrame:
    """(key, matches, candidate_ngrams, reference_ngrams): n-grams of two token arrays, matches clipped at the reference's count."""
    both = all_ngrams(df, key, candidate, reference, [n])
    return both.groupBy(key).agg(F.sum(F.least("c", "r")).alias("matches"), F.sum("c").alias("candidate_ngrams"), F.sum("r").alias("reference_ngrams"))


def bleu(df: DataFrame, key: str, candidate: Column, reference: Column, most: int = 4) -> DataFrame:
    """One row: bleu_1 .. bleu_most of the corpus, by clipped precisions, their geometric means and the brevity penalty.

    0 where a precision is 0 or there is nothing to count. A single pass: the lengths are the numbers of 1-grams.
    """
    grams = all_ngrams(df, key, candidate, reference, list(range(1, most + 1)))
    of = lambda n, c: F.sum(F.when(F.col("n") == n, c))
    measures = [of(n, F.least("c", "r")).alias(f"m_{n}") for n in range(1, most + 1)] + [of(n, F.col("c")).alias(f"t_{n}") for n in range(1, most + 1)]
    sums = grams.agg(*measures, of(1, F.col("r")).alias("r"))
    c, r = F.col("t_1"), F.coalesce("r", F.lit(0))
    penalty = F.when(c >= r, F.lit(1.0)).otherwise(F.coalesce(F.exp(1 - r / F.nullif(c, F.lit(0))), F.lit(0.0)))
    log_sum: Column = F.lit(0.0)
    out = []
    for n in range(1, most + 1):
        log_sum = log_sum + F.log(F.col(f"m_{n}") / F.nullif(F.col(f"t_{n}"), F.lit(0)))
        out.append(F.coalesce(penalty * F.exp(log_sum / n), F.lit(0.0)).alias(f"bleu_{n}"))
    return sums.select(*out)


def mean_loss(losses: DataFrame, loss: str = "loss") -> DataFrame:
    """One row: the mean of the losses that a model gave for the batches of an evaluation; null where there are none."""
    return losses.agg(F.avg(loss).alias("mean_loss"), F.count(loss).alias("batches"))


def rouge_n(df: DataFrame, key: str, candidate: Column, reference: Column, n: int) -> DataFrame:
    """(key, precision, recall, f1) of n-grams, 0 where a side has none."""
    o = ngram_overlap(df, key, candidate, reference, n)
    p = F.coalesce(F.col("matches") / F.nullif("candidate_ngrams", F.lit(0)), F.lit(0.0))
    r = F.coalesce(F.col("matches") / F.nullif("reference_ngrams", F.lit(0)), F.lit(0.0))
    return o.select(key, p.alias("precision"), r.alias("recall")).withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over the longer list."""
    if len(a) < len(b):
        a, b = b, a
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        match = row & where.get(x, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - bin(row).count("1")


def rouge_l(candidate: Column, reference: Column) -> Column:
    """F1 by the longest common subsequence of two token arrays; 0 where a side is empty or null."""

    @F.pandas_udf("double")
    def score(c: pd.Series, r: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(c, r, strict=True):
            x, y = list(x) if x is not None else [], list(y) if y is not None else []
            lcs = common_subsequence(x, y) if x and y else 0
            out.append(2 * lcs / (len(x) + len(y)) if lcs else 0.0)
        return pd.Series(out)

    return score(candidate, reference)


def _matched(reference: list, candidate: list) -> set[int]:
    """Places of ``reference`` on one longest common subsequence with ``candidate``."""
    rows = [[0] * (len(candidate) + 1)]
    for x in reference:
        last, row = rows[-1], [0]
        for j, y in enumerate(candidate):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        rows.append(row)
    out, i, j = set(), len(reference), len(candidate)
    while i and j:
        if reference[i - 1] == candidate[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def summary_overlap(candidate: list[list], reference: list[list]) -> float:
    """F1 of two texts as lists of sentences: of each reference sentence the words on a longest common subsequence with
    any candidate sentence count, each word no more often than either text has it."""
    left, right = Counter(w for s in candidate for w in s), Counter(w for s in reference for w in s)
    sizes, hits = (left.total(), right.total()), 0
    for sentence in reference:
        for i in sorted(set().union(*(_matched(sentence, c) for c in candidate))):
            w = sentence[i]
            if left[w] > 0 and right[w] > 0:
                left[w], right[w], hits = left[w] - 1, right[w] - 1, hits + 1
    return 2 * hits / sum(sizes) if hits else 0.0


def rouge_lsum(candidate: Column, reference: Column) -> Column:
    """F1 over the sentences (lines of words) of two texts; 0 where a side is empty or null."""

    @F.pandas_udf("double")
    def score(c: pd.Series, r: pd.Series) -> pd.Series:
        lines = lambda t: [line.split() for line in t.split("\n") if line.strip()] if t else []
        return pd.Series([summary_overlap(lines(x), lines(y)) for x, y in zip(c, r, strict=True)], dtype="float64")

    return score(candidate, reference)
