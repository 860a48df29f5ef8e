"""Order-sensitive operators on the lines and paragraphs of a document: windows, islands, no Python.

A document's rows must carry an explicit position; equal positions are told apart by a tie column.
Running values are taken block by block: ``block`` is an integer that never falls along a document's
order (such as position / 1024), windows run within a block, and what earlier blocks carry over comes
from one summary row a block. So a document that holds a great part of all rows is worked on by many
tasks; without a block it is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_running(df: DataFrame, doc: str, order: list[str], lasts: dict[str, Column], sums: dict[str, Column], block: Column | None = None) -> DataFrame:
    """Adds, over each document up to and with the row, the last value that is not null and the sum of each given expression."""
    staged = df.select("*", (block if block is not None else F.lit(0)).alias("_b"), *[e.alias(f"_e_{n}") for n, e in {**lasts, **sums}.items()])
    within = Window.partitionBy(doc, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = {n: F.last(f"_e_{n}", True).over(within) for n in lasts}
    total = {n: F.coalesce(F.sum(f"_e_{n}").over(within), F.lit(0)) for n in sums}
    if block is None:
        return staged.select(*df.columns, *[e.alias(n) for n, e in {**last, **total}.items()])
    at = F.struct(*order)
    ends = [F.max_by(f"_e_{n}", F.when(F.col(f"_e_{n}").isNotNull(), at)).alias(f"_l_{n}") for n in lasts]
    ends += [F.sum(f"_e_{n}").alias(f"_s_{n}") for n in sums]
    summary = staged.groupBy(F.col(doc).alias("_d"), F.col("_b").alias("_k")).agg(*ends)
    before = Window.partitionBy("_d").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_l_{n}", True).over(before).alias(f"_c_{n}") for n in lasts] + [F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums]
    joined = staged.join(summary.select("_d", "_k", *carried), F.col(doc).eqNullSafe(F.col("_d")) & (F.col("_b") == F.col("_k")))
    out = [F.coalesce(e, F.col(f"_c_{n}")).alias(n) for n, e in last.items()] + [(e + F.col(f"_c_{n}")).alias(n) for n, e in total.items()]
    return joined.select(*df.columns, *out)


def stop_at_marker(pages: DataFrame, doc: str, order: list[str], text: str, marker: str, block: Column | None = None) -> DataFrame:
    """Pages up to the first that holds ``marker``, that one cut before it; later pages are dropped."""
    hit = F.coalesce(F.contains(text, F.lit(marker)), F.lit(False)).cast("int")
    seen = with_running(pages, doc, order, {}, {"_seen": hit}, block)
    first = seen.where((F.col("_seen") == 0) | ((F.col("_seen") == 1) & (hit == 1)))
    return first.drop("_seen").withColumn(text, F.substring_index(text, marker, 1))


def fill_titles(lines: DataFrame, doc: str, order: list[str], text: str, reset_sub: bool = False, block: Column | None = None) -> DataFrame:
    """Adds first_title and second_title, and removes the markers ####title#### and ###title### from the text.

    A title holds until the next of its kind; with ``reset_sub`` a first title also ends the second.
    An empty title between markers is a title.
    """
    t = F.col(text)
    first_mark, second_mark = "(####.*####)", "(###.*###)"
    found_first = F.when(t.rlike(first_mark), F.replace(F.regexp_extract(t, first_mark, 1), F.lit("####"), F.lit("")))
    rest = F.when(t.rlike(first_mark), F.regexp_replace(t, first_mark, "")).otherwise(t)
    found_second = F.when(rest.rlike(second_mark), F.replace(F.regexp_extract(rest, second_mark, 1), F.lit("###"), F.lit("")))
    clean = F.when(rest.rlike(second_mark), F.regexp_replace(rest, second_mark, "")).otherwise(rest)
    marked = lines.select("*", found_first.alias("_f"), found_second.alias("_s"), clean.alias("_c"))
    if reset_sub:
        marked = marked.withColumn("_s", F.when(F.col("_s").isNotNull(), F.col("_s")).when(F.col("_f").isNotNull(), F.lit("")))
    filled = with_running(marked, doc, order, {"first_title": F.col("_f"), "second_title": F.col("_s")}, {}, block)
    return filled.withColumn(text, F.col("_c")).drop("_f", "_s", "_c")


def coalesce_shorts(paragraphs: DataFrame, doc: str, order: list[str], text: str, keep: list[str], limit: int = 64, compat: bool = False, block: Column | None = None) -> DataFrame:
    """Paragraphs of at most ``limit`` characters gathered until the next long one.

    Each long paragraph is emitted first, then the shorts before it as one, with the long one's
    ``keep`` columns. Shorts after the last long one come last with their own last columns; with
    ``compat`` they are dropped. Columns: doc, island, part (0 long, 1 shorts), text, keep.
    """
    is_long = (F.length(text) > limit).cast("int")
    counted = with_running(paragraphs.where(F.col(text).isNotNull()), doc, order, {}, {"_upto": is_long}, block)
    marked = counted.select(doc, F.struct(*order).alias("_at"), F.col(text).alias("_t"), *keep, is_long.alias("_long"), (F.col("_upto") - is_long).alias("island"))
    of_short = F.when(F.col("_long") == 0, F.struct("_at", "_t"))
    grouped = marked.groupBy(doc, "island").agg(
        F.max(F.when(F.col("_long") == 1, F.struct("_at", "_t", *keep))).alias("_l"),
        F.array_sort(F.collect_list(of_short)).alias("_shorts"),
        F.max(F.struct("_at", *keep)).alias("_last"),
    )
    merged = F.array_join(F.transform("_shorts", lambda s: s["_t"]), "")
    if compat:
        grouped = grouped.where(F.col("_l").isNotNull())
    long_row = F.when(F.col("_l").isNotNull(), F.struct(F.lit(0).alias("part"), F.col("_l._t").alias(text)))
    short_row = F.when(F.size("_shorts") > 0, F.struct(F.lit(1).alias("part"), merged.alias(text)))
    rows = grouped.withColumn("_r", F.explode(F.array_compact(F.array(long_row, short_row))))
    kept: list[Column] = [F.coalesce(F.col(f"_l.{k}"), F.when(F.col("_l").isNull(), F.col(f"_last.{k}"))).alias(k) for k in keep]
    return rows.select(doc, F.col("island").cast("int").alias("island"), F.col("_r.part").alias("part"), F.col(f"_r.{text}").alias(text), *kept)


# What a line that opens a part of a dialogue record begins with, and the part's name.
HEADERS = (("id", "urls"), ("Doctor faculty", "Doctor_faculty"), ("Description", "Description"), ("Dialogue", "Dialogue"))


def dialogue_records(lines: DataFrame, file: str, number: str, line: str, compat: bool = False, block: Column | None = None) -> DataFrame:
    """(file, record_no, id, urls, Doctor_faculty, Description, Dialogue) from the lines of dialogue files.

    A line that begins with a header opens that part, "id" also a new record; what else the header
    line holds is lost, but for the id after the last "=". Blank lines don't count. Lines before the
    first id belong to no record. With ``compat`` the last record of a file is lost and values keep
    the line break before each line.
    """
    t = F.col(line)
    header = F.lit(None).cast("string")
    for prefix, name in reversed(HEADERS):
        header = F.when(F.startswith(t, F.lit(prefix)), F.lit(name)).otherwise(header)
    marked = lines.where(F.length(F.replace(t, F.lit("\n"), F.lit(""))) > 0).select(file, number, t.alias("_t"), header.alias("_h"))
    opens = (F.coalesce(F.col("_h"), F.lit("")) == "urls").cast("int")
    marked = with_running(marked, file, [number], {"_part": F.col("_h")}, {"record_no": opens}, block).where(F.col("record_no") > 0)
    join = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_h").isNull() & (F.col("_part") == name), F.struct(number, "_t")))), lambda s: s["_t"]), "\n")
    lead = F.lit("\n") if compat else F.lit("")
    value = lambda name: F.when(F.length(join(name)) > 0, F.concat(lead, join(name))).otherwise("").alias(name)
    opened = F.max(F.when(F.col("_h") == "urls", F.trim(F.substring_index("_t", "=", -1)))).alias("id")
    out = marked.groupBy(file, "record_no").agg(opened, *[value(n) for _, n in HEADERS])
    if compat:
        last = F.max("record_no").over(Window.partitionBy(file))
        out = out.withColumn("_last", last).where(F.col("record_no") < F.col("_last")).drop("_last")
    return out.withColumn("record_no", F.col("record_no").cast("int"))


def record_counts(lines: DataFrame, file: str, line: str) -> DataFrame:
    """(file, records): the number of dialogue records of each file that has any, counted by the lines that open one."""
    opens = F.startswith(F.col(line), F.lit(HEADERS[0][0]))
    return lines.where(opens).groupBy(file).agg(F.count("*").alias("records"))


def runs(df: DataFrame, part: list[str], order: list[str], value: Column) -> DataFrame:
    """Adds run_no: rows of a partition in order share it while ``value`` stays the same (nulls are equal)."""
    w = Window.partitionBy(*part).orderBy(*order)
    marked = df.withColumn("_v", value)
    new = (~F.col("_v").eqNullSafe(F.lag("_v").over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return marked.withColumn("_new", new).withColumn("run_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new", "_v")
