"""Dialogues as training sequences: roles, masks, cuts and continuations, all as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a speaker's name holds and how the turn is then headed; the last that fits counts.
SPEAKERS = (
    ("from user", "User: "),
    ("to user", "Helper: "),
    ("to note", "Record: "),
    ("to terminal", "Command: "),
    ("from terminal", "Terminal: "),
)
SUPERVISED = ("Helper: ", "Record: ", "Command: ")
MASKED, LEAST_LABELS = -100, 12


def role(speaker: Column) -> Column:
    """The heading of a speaker's turns, null where nothing fits; letters count as small ones."""
    low = F.lower(speaker)
    out = F.lit(None).cast("string")
    for part, heading in SPEAKERS:
        out = F.when(F.contains(low, F.lit(part)), F.lit(heading)).otherwise(out)
    return out


def chat_role(kind: Column) -> Column:
    return F.when(kind == "system", "system").when(kind == "human", "human").otherwise("ai")


def zip_shortest(a: Column, b: Column, names: tuple[str, str]) -> Column:
    """Two arrays side by side, as long as the shorter."""
    n = F.least(F.size(a), F.size(b))
    return F.transform(F.slice(F.arrays_zip(a.alias(names[0]), b.alias(names[1])), F.lit(1), F.greatest(n, F.lit(0))), lambda s: s)


def masked_sequence(prompt: Column, turns: Column, end_token: Column, compat: bool = False) -> Column:
    """struct(input_ids, labels) of a prompt (token ids) and turns (array of struct(role, ids, speaker)).

    Turns without a role are skipped. Prompt and turns that aren't supervised are masked in the
    labels; the end token after a turn goes with the turn. A dialogue whose first speaker says
    "pretrain" has no mask, no prompt and one end token; with ``compat`` that never happens.
    """
    kept = F.filter(turns, lambda t: t["role"].isNotNull())
    mask = lambda ids: F.transform(ids, lambda _: F.lit(MASKED))
    with_end = lambda ids: F.concat(ids, F.array(end_token))
    head = with_end(prompt)
    ids = F.concat(head, F.flatten(F.transform(kept, lambda t: with_end(t["ids"]))))
    labels = F.concat(mask(head), F.flatten(F.transform(kept, lambda t: F.when(t["role"].isin(*SUPERVISED), with_end(t["ids"])).otherwise(mask(with_end(t["ids"]))))))
    plain = with_end(F.flatten(F.transform(turns, lambda t: t["ids"])))
    pretrain = F.lit(False) if compat else F.coalesce(F.contains(F.lower(F.get(turns, F.lit(0))["speaker"]), F.lit("pretrain")), F.lit(False))
    return F.struct(F.when(pretrain, plain).otherwise(ids).alias("input_ids"), F.when(pretrain, plain).otherwise(labels).alias("labels"))


def trainable(labels: Column) -> Column:
    """At least 12 labels, one of them after the first not masked."""
    return (F.size(labels) >= LEAST_LABELS) & F.exists(F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: x >= 0)


def cut_windows(df: DataFrame, keys: list[str], ids: str, labels: str, most: int, step: int, filter_all: bool = False) -> DataFrame:
    """(keys, window_no, input_ids, labels): sequences above ``most`` as windows every ``step``, those that are not
    trainable dropped. Shorter sequences stay as they are; with ``filter_all`` they must be trainable too."""
    n = F.size(ids)
    starts = F.when(n > most, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step))).otherwise(F.array(F.lit(0)))
    windows = df.select(*keys, F.col(ids).alias("_i"), F.col(labels).alias("_l"), (n > most).alias("_cut"), F.posexplode(starts).alias("window_no", "_at"))
    out = windows.select(*keys, "window_no", "_cut", F.slice("_i", F.col("_at") + 1, most).alias("input_ids"), F.slice("_l", F.col("_at") + 1, most).alias("labels"))
    return out.where(trainable(F.col("labels")) | (F.lit(not filter_all) & ~F.col("_cut"))).drop("_cut")


def prefix_examples(turns: DataFrame, conv: str, turn: str, speaker: str, text: str, part: str = "to") -> DataFrame:
    """(conv, turn, history, answer): for each turn whose speaker holds ``part`` and that isn't the first, all earlier
    turns in order as array of struct(speaker, text), and its own speaker and text."""
    before = Window.partitionBy(conv).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    history = F.collect_list(F.struct(F.col(speaker).alias("speaker"), F.col(text).alias("text"))).over(before)
    marked = turns.select(conv, turn, F.col(speaker).alias("_s"), F.concat(speaker, text).alias("answer"), history.alias("history"))
    return marked.where(F.contains(F.lower("_s"), F.lit(part)) & (F.size("history") > 0)).select(conv, turn, "history", "answer")


def keep_last(ids: Column, n: int) -> Column:
    """The last ``n`` items of an array."""
    return F.slice(ids, F.greatest(F.size(ids) - n + 1, F.lit(1)), F.lit(n))


def continuation(prompt: Column, generated: Column, end_token: Column) -> Column:
    """What follows the first occurrence of ``prompt`` in ``generated``, up to the end token; empty if it is not there.

    Arrays of integers. They are compared as texts of numbers between commas, as a search in a text is one pass.
    """
    listed = lambda ids: F.concat(F.lit(","), F.array_join(ids.cast("array<string>"), ","), F.lit(","))
    wanted, whole = listed(prompt), listed(generated)
    at = F.instr(whole, wanted)
    # the comma that ends the prompt begins what follows
    rest = F.concat(F.lit(","), F.substring(whole, at + F.length(wanted), F.length(whole)))
    stop = F.instr(rest, F.concat(F.lit(","), end_token.cast("string"), F.lit(",")))
    kept = F.when(stop > 0, F.substring(rest, F.lit(1), stop)).otherwise(rest)
    ids = F.filter(F.split(kept, ","), lambda x: x != "").cast("array<int>")
    return F.when((at > 0) & (F.size(prompt) > 0), ids).otherwise(F.array().cast("array<int>"))
