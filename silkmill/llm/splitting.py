"""Oversized texts cut into pieces within a limit, at natural boundaries, with a fixed overlap.

One bounded-quantifier regular expression cuts a text into bodies: its alternatives are ordered by
the strength of the boundary (paragraph, line, sentence, clause, word) and each takes as many
characters as the limit allows; where no boundary lies within reach, plain characters are taken, not
before a combining mark if that can be helped. A piece is the body with the last ``overlap``
characters of the body before it in front. Everything is SQL expressions; no row leaves the JVM.

Defined results: lengths are in code points; a text within the limit is one piece, itself; null and
empty texts give no piece; bodies joined give the text again. A body is never shorter than the
overlap, except the last, so every overlap is exactly ``overlap`` characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkmill.session import few_rows

#: Fields that can have limits.
FIELDS = 1000
# What ends a piece well, strongest first. Each ends with one character, the last of the body.
BOUNDARIES = (
    r"\n\s{0,3}\n",
    r"\n",
    r"[。！？；…][”’」』）)]?",
    r"[.!?][\"”’)]?\s",
    r"[，、,;:：]\s?",
    r"\s",
)


def body_pattern(limit: int, overlap: int) -> str:
    """The regular expression whose successive matches are the bodies of a text."""
    room = limit - overlap
    if overlap < 0 or room < max(1, overlap):
        raise ValueError(f"an overlap of {overlap} leaves no room in pieces of {limit}")
    least, half = max(1, overlap), max(overlap, room // 2, 1)
    whole = rf".{{1,{room}}}\z"
    # first with at least half a piece filled, then with the least body
    near = [rf".{{{low},{room - 5}}}{b}" for low in dict.fromkeys((half, least)) for b in BOUNDARIES if room - 5 >= low]
    plain = [rf".{{{least},{room}}}(?!\p{{M}})", rf".{{{least},{room}}}", r".+"]
    return "(?s)(?:" + "|".join([whole, *near, *plain]) + ")"


def bodies(text: Column, limit: int, overlap: int) -> Column:
    """The bodies of a text longer than ``limit``; an array of the text itself otherwise."""
    cut = F.regexp_extract_all(text, F.lit(body_pattern(limit, overlap)), F.lit(0))
    return F.when(F.length(text) > limit, cut).when(F.length(text) > 0, F.array(text))


def pieces(text: Column, limit: int, overlap: int) -> Column:
    """The pieces of a text, in order."""
    parts = bodies(text, limit, overlap)
    return F.transform(parts, lambda body, i: F.when((i == 0) | F.lit(overlap == 0), body).otherwise(F.concat(F.right(F.get(parts, i - 1), F.lit(overlap)), body)))


def split_texts(texts: DataFrame, limits: dict[str, tuple[int, int]], *, only_oversized: bool = True) -> DataFrame:
    """(field, row_id, pieces): the array of pieces of each row of (field, row_id, text) whose field has limits.

    With ``only_oversized``, rows within the limit are left out before any text is cut. Repeated rows stay repeated.
    """
    cut: Column = F.lit(None).cast("array<string>")
    wanted: Column = F.lit(False)
    for field, (limit, overlap) in limits.items():
        here = F.col("field") == field
        cut = F.when(here, pieces(F.col("text"), limit, overlap)).otherwise(cut)
        wanted = wanted | (here & (F.length("text") > (limit if only_oversized else 0)))
    return texts.where(wanted).select("field", "row_id", cut.alias("pieces"))


def read_limits(limits: DataFrame) -> dict[str, tuple[int, int]]:
    """field -> (max_chars, overlap_chars); one row per field, so it is small by construction."""
    rows = few_rows(limits.select("field", "max_chars", "overlap_chars").distinct(), FIELDS, "limits of fields")
    return {r["field"]: (r["max_chars"], r["overlap_chars"]) for r in rows if None not in (r["field"], r["max_chars"], r["overlap_chars"])}
