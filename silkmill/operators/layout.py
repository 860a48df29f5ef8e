"""Tables and reading order from positioned words, spans and boxes: windows and array expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkmill.operators.sections import runs


def inside(box: list[str], rect: list[Column | float]) -> Column:
    """A box (x0, y0, x1, y1) within a rectangle, borders included."""
    x0, y0, x1, y1 = (F.col(c) if isinstance(c, str) else c for c in box)
    a, b, c, d = (r if isinstance(r, Column) else F.lit(r) for r in rect)
    return (x0 >= a) & (y0 >= b) & (x1 <= c) & (y1 <= d)


def column_borders(columns: list[float], left: float, right: float) -> list[float]:
    """Sorted column coordinates, with the rectangle's sides where columns don't reach them."""
    out = sorted(columns)
    if not out:
        return [left, right]
    if left < out[0]:
        out.insert(0, left)
    if right > out[-1]:
        out.append(right)
    return out


def spans_table(pages: DataFrame, page: str, rect: list[float], gap: float = 3.0) -> DataFrame:
    """(page, y0, col_no, text): the table inside ``rect`` of pages as for ``page_spans``: lines and spans outside are left
    out, spans of a line near each other joined, columns begin where any of them does."""
    x0, y0, x1, y1 = rect
    kept = page_spans(pages, page).where((F.col("y0") >= y0) & (F.col("y1") <= y1) & (F.col("x0") >= x0) & (F.col("x1") <= x1))
    merged = merge_spans(kept, [page, "block_no", "line_no", "y0"], gap)
    seq = (F.col("block_no").cast("long") * 1_000_000 + F.col("line_no")) * 1_000_000_000 + F.col("x0").cast("long")
    return spans_to_rows(merged.withColumn("seq", seq), page)


def column_of(x: Column, borders: list[float]) -> Column:
    """Index of the column that ``x`` starts in: the one before the first border right of it; 0 if there is none."""
    out = F.lit(0)
    for i in range(len(borders) - 1, 0, -1):
        out = F.when(x < borders[i], F.lit(i - 1)).otherwise(out)
    return out


def last_start(x: Column, starts: Column) -> Column:
    """Index of the greatest of the sorted ``starts`` at or left of ``x``; -1 if all are right of it."""
    return F.size(F.filter(starts, lambda s: s <= x)) - 1


def page_spans(pages: DataFrame, page: str, blocks: str = "blocks") -> DataFrame:
    """(page, seq, block_no, line_no, span_no, y0, y1, x0, x1, text) of pages whose blocks hold lines and these spans.

    ``blocks``: array of struct(lines array of struct(y0, y1, spans array of struct(x0, x1, text))). Pages, blocks and
    lines that are null or empty give no row; seq orders the spans of a page.
    """
    b = pages.select(page, F.posexplode(blocks).alias("block_no", "_b"))
    line = b.select(page, "block_no", F.posexplode("_b.lines").alias("line_no", "_l"))
    span = line.select(page, "block_no", "line_no", F.col("_l.y0").alias("y0"), F.col("_l.y1").alias("y1"), F.posexplode("_l.spans").alias("span_no", "_s"))
    # places within a page number far fewer than a million each
    seq = (F.col("block_no").cast("long") * 1_000_000 + F.col("line_no")) * 1_000_000 + F.col("span_no")
    return span.where(F.col("_s").isNotNull()).select(page, seq.alias("seq"), "block_no", "line_no", "span_no", "y0", "y1", "_s.x0", "_s.x1", "_s.text")


def words_to_table(words: DataFrame, page: str, borders: list[float], compat: bool = False) -> DataFrame:
    """(page, y0, cells) from words (page, seq, x0, y0, text): a row per y0, a cell per column.

    Words of a cell keep their order in the page and are joined by spaces. Words of one column apart
    from each other in a row are joined too; with ``compat`` only the last run of them is kept.
    """
    cells = len(borders) - 1
    placed = words.withColumn("col_no", column_of(F.col("x0"), borders))
    grouped = runs(placed, [page, "y0"], ["seq"], F.col("col_no"))
    each = grouped.groupBy(page, "y0", "col_no", "run_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), " ").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("run_no", "text")))
    joined = F.element_at(F.transform(parts, lambda s: s["text"]), -1) if compat else F.array_join(F.transform(parts, lambda s: s["text"]), " ")
    by_col = each.groupBy(page, "y0", "col_no").agg(joined.alias("text"))
    table = by_col.groupBy(page, "y0").agg(F.map_from_entries(F.collect_list(F.struct("col_no", "text"))).alias("m"))
    return table.select(page, "y0", F.array(*[F.coalesce(F.element_at("m", i), F.lit("")) for i in range(cells)]).alias("cells"))


def merge_spans(spans: DataFrame, line: list[str], gap: float = 3.0) -> DataFrame:
    """(line, x0, x1, text): spans of a line, by x0, joined while the next begins within ``gap`` of the last one's end."""
    w = Window.partitionBy(*line).orderBy("x0", "seq")
    new = F.coalesce((F.abs(F.col("x0") - F.lag("x1").over(w)) > gap).cast("int"), F.lit(0))
    marked = spans.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("x0", "seq", "text", "x1")))
    out = marked.groupBy(*line, "_island").agg(parts.alias("p"))
    return out.select(*line, F.get("p", F.lit(0))["x0"].alias("x0"), F.element_at("p", -1)["x1"].alias("x1"), F.array_join(F.transform("p", lambda s: s["text"]), "").alias("text"))


def spans_to_rows(spans: DataFrame, page: str) -> DataFrame:
    """(page, y0, col_no, text) from spans (page, seq, x0, y0, text): columns begin where any span of the page does;
    texts of a cell are joined in order, by a space unless either side has one."""
    starts = spans.groupBy(page).agg(F.array_sort(F.collect_set("x0")).alias("starts"))
    placed = spans.join(starts, page).withColumn("col_no", last_start(F.col("x0"), F.col("starts")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"])

    def append(acc: Column, t: Column) -> Column:
        return F.when((acc == "") | F.endswith(acc, F.lit(" ")) | F.startswith(t, F.lit(" ")), F.concat(acc, t)).otherwise(F.concat(acc, F.lit(" "), t))

    return placed.groupBy(page, "y0", "col_no").agg(F.aggregate(texts, F.lit(""), append).alias("text"))


def reading_order(boxes: DataFrame, page: str, width: Column) -> DataFrame:
    """(page, text): texts of a two-column page, left column first, each followed by a line break; boxes other than
    text and titles are left out. A box is in the left column if it starts in the left two fifths."""
    kept = boxes.where(F.lower("type").isin("text", "title"))
    side = (F.col("x1") > F.floor(width * 2 / 5)).cast("int")
    parts = F.array_sort(F.collect_list(F.struct(side.alias("side"), F.col("seq"), F.col("text"))))
    return kept.groupBy(page).agg(F.array_join(F.transform(parts, lambda s: F.concat(s["text"], F.lit("\n"))), "").alias("text"))


def large_figures(boxes: DataFrame, text_length: Column, side: int = 300, least: int = 50) -> DataFrame:
    """Figures wider and higher than ``side`` whose text is longer than ``least``."""
    return boxes.where((F.lower("type") == "figure") & (F.col("x2") - F.col("x1") > side) & (F.col("y2") - F.col("y1") > side) & (text_length > least))


def pipe_row(cells: Column) -> Column:
    """Cells as a line of a pipe table."""
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" | \n"))


def accurate(first: Column, first_score: Column, second: Column, second_score: Column, least: float = 90.0) -> Column:
    """The first candidate if accurate enough, else the second, else null."""
    return F.when(first_score >= least, first).when(second_score >= least, second)


def page_lines(lines: DataFrame, page: str, separator: str = "") -> DataFrame:
    """(page, text): recognised lines of a page joined in order."""
    return lines.groupBy(page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), separator).alias("text"))


def crop(pixels: Column, width: Column, height: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The rows ``y1`` to ``y2`` and columns ``x1`` to ``x2`` (ends left out) of an image's bytes, as many a pixel as it has.

    A box is cut at the image's sides; nothing is left of an empty one. Null where anything is null.
    """

    @F.pandas_udf("binary")
    def cut_out(p: pd.Series, w: pd.Series, h: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        out = []
        for row in zip(p, w, h, a, b, c, d, strict=True):
            if any(v is None or v != v for v in row[1:]) or row[0] is None or not row[1] * row[2]:
                out.append(None)
                continue
            raw, (wide, high, left, top, right, bottom) = row[0], (int(v) for v in row[1:])
            image = np.frombuffer(raw, np.uint8).reshape(high, wide, -1)
            out.append(image[max(0, top) : max(0, bottom), max(0, left) : max(0, right)].tobytes())
        return pd.Series(out, dtype="object")

    return cut_out(pixels, width, height, x1, y1, x2, y2)
