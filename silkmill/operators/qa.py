"""Question-answer sets: fan-out, checks, refining and merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkmill.functions.text import drop_numbering, first_line, without_answers


def fan_out(df: DataFrame, times: int = 5) -> DataFrame:
    """Every row ``times`` times, with its sample_no from 0."""
    return df.withColumn("sample_no", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def refined(questions: Column, compat: bool = False) -> Column:
    """First lines of the questions, numbering dropped, without those that ask for or give the answer."""
    return without_answers(F.transform(questions, lambda q: drop_numbering(first_line(q), compat)))


def asks_plainly(question: Column) -> Column:
    """One line that doesn't speak of the answer."""
    return ~F.contains(question, F.lit("答案")) & (F.instr(question, "\n") == 0)


def is_answer(answer: Column) -> Column:
    """An answer that a model did give."""
    return answer.isNotNull() & ~F.contains(answer, F.lit("None"))


def accepted(df: DataFrame, keys: list[str], question: str, order: str, most: int = 5, distinct: bool = True) -> DataFrame:
    """(keys, Q): the first ``most`` questions of each key in order, without repeats unless ``distinct`` is off."""
    from pyspark.sql import Window

    base = df.where(F.col(question).isNotNull())
    if distinct:
        base = base.groupBy(*keys, question).agg(F.min(order).alias(order))
    ranked = base.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order, question))).where(F.col("_n") <= most)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", question))), lambda s: s[question]).alias("Q"))


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of sets with the same columns, whatever their order, with part_no from 0."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("part_no", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out


def majority(votes: Column) -> Column:
    """True if at least half of an array of booleans is true; nulls don't vote, and no vote is true."""
    count = lambda wanted: F.size(F.filter(votes, lambda v: v == F.lit(wanted)))
    return count(True) >= count(False)
