"""Samples, shuffles and mixtures that are the same wherever and however often they run: order by hash, not by chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkmill.session import broadcast_if_small, cut


def hash_key(seed: int, *keys: Column) -> Column:
    """A text that orders rows as if at random; any engine with md5 gives the same."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def sample_per_group(df: DataFrame, group: list[str], key: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows of each group, with their sample_no from 1; the rank filter limits each partition before the shuffle."""
    w = Window.partitionBy(*group).orderBy(hash_key(seed, F.col(key)), key)
    return df.withColumn("sample_no", F.row_number().over(w)).where(F.col("sample_no") <= n)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """All rows in a seeded order, by a range-partitioned sort."""
    return df.orderBy(hash_key(seed, F.col(key)), key)


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Adds the place of each row of a sorted table, from 1: rows are numbered within their partition, and the sizes of the
    partitions before, a number each, come on top, so no task holds all rows.

    The rows are written first, as a sort that is run again may part them differently.
    """
    at = cut(ordered.withColumn("_i", F.monotonically_increasing_id()))
    part = F.shiftright("_i", 33)
    sizes = at.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = broadcast_if_small(sizes.select("_p", before.alias("_before")))
    place = F.col("_before") + F.col("_i").bitwiseAND((1 << 33) - 1) + 1
    return at.withColumn("_p", part).join(starts, "_p").withColumn(name, place.cast("int")).drop("_i", "_p", "_before")


def example_prompt(df: DataFrame, group: list[str], key: str, text: str, k: int, seed: int) -> DataFrame:
    """(group, examples): ``k`` examples of each group drawn without replacement, as lines numbered from 1."""
    drawn = sample_per_group(df, group, key, k, seed)
    lines = F.array_sort(F.collect_list(F.struct("sample_no", F.col(text).alias("_t"))))
    return drawn.groupBy(*group).agg(F.array_join(F.transform(lines, lambda s: F.concat(s["sample_no"].cast("string"), F.lit(". "), s["_t"])), "\n").alias("examples"))


def first_n(df: DataFrame, order: list[str], n: int, skip: int = 0) -> DataFrame:
    """``n`` rows after the first ``skip`` in order."""
    return df.orderBy(*order).offset(skip).limit(n)


def largest_remainder(weights: dict[str, float], n: int) -> dict[str, int]:
    """``n`` split in proportion; what rounding down leaves goes to the greatest remainders, ties to the first name."""
    total = sum(weights.values()) or 1.0
    exact = {k: n * w / total for k, w in weights.items()}
    out = {k: int(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (-(exact[k] - out[k]), k))[: n - sum(out.values())]:
        out[k] += 1
    return out


def interleave(df: DataFrame, source: str, key: str, weights: dict[str, float], n: int, seed: int) -> DataFrame:
    """``n`` rows with each source's part of them by weight: columns of ``df``, repeat_no and draw_no.

    A source with too few rows starts over (repeat_no counts); one without rows gives nothing. The
    rows come in a seeded order, draw_no from 1.
    """
    quota = largest_remainder(weights, n)
    need = F.lit(0)
    for name, k in quota.items():
        need = F.when(F.col(source) == name, F.lit(k)).otherwise(need)
    w = Window.partitionBy(source)
    ranked = df.withColumn("_need", need).where(F.col("_need") > 0)
    ranked = ranked.withColumn("_rank", F.row_number().over(w.orderBy(hash_key(seed, F.col(key)), key))).withColumn("_size", F.count("*").over(w))
    times = F.greatest(F.floor((F.col("_need") - F.col("_rank")) / F.col("_size")) + 1, F.lit(0)).cast("int")
    repeated = ranked.withColumn("_times", times).where(F.col("_times") > 0).withColumn("repeat_no", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    # the mixture has n rows in all, so one window over it is bounded by the request, not by the data
    order = Window.partitionBy(F.lit(0)).orderBy(hash_key(seed + 1, F.col(key), F.col("repeat_no")), key, "repeat_no")
    return repeated.withColumn("draw_no", F.row_number().over(order)).drop("_need", "_rank", "_size", "_times")
