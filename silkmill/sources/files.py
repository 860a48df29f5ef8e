"""Readers and writers of text files. Schemas are always given, so nothing is read twice to infer them."""

from __future__ import annotations

import functools
import io
import json
import re
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silkmill.schemas import CHUNK


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array or object."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files with a JSON object a line, plain or compressed; a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_delimited(spark: SparkSession, path: str, separator: str = "。\n") -> DataFrame:
    """(file, pos, text): whole files parted at ``separator``, which is dropped; pos from 0."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    quoted = "\\Q" + separator + "\\E"
    return whole.select("file", F.posexplode(F.split("value", quoted)).alias("pos", "text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, line_no from 1; a file is numbered within one row, so keep files of moderate size."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def read_sheets(sheets: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of several sheets with the named columns, in one table; pos is the order within all."""
    out = None
    for i, sheet in enumerate(sheets):
        part = sheet.select(*columns).withColumn("sheet_no", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


# The name spaces of sheets inside their files.
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(raw: bytes, wanted: str) -> list[list[str | None]]:
    """The rows of a named sheet of an xlsx file, all values as text; cells left out are null."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        tree = lambda name: ElementTree.fromstring(book.read(name))
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(_SHEET + "t")) for item in tree("xl/sharedStrings.xml").iter(_SHEET + "si")]
        targets = {r.get("Id"): r.get("Target") for r in tree("xl/_rels/workbook.xml.rels")}
        links = {s.get("name"): s.get(_LINK) for s in tree("xl/workbook.xml").iter(_SHEET + "sheet")}
        if wanted not in links:
            raise ValueError(f"no sheet {wanted}")
        target = targets[links[wanted]]
        out = []
        for row in tree(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter(_SHEET + "row"):
            values: list[str | None] = []
            for cell in row.iter(_SHEET + "c"):
                letters = re.match("[A-Z]*", cell.get("r") or "").group()
                at = functools.reduce(lambda n, c: n * 26 + ord(c) - 64, letters, 0) - 1 if letters else len(values)
                values += [None] * (at + 1 - len(values))
                value = cell.find(_SHEET + "v")
                if cell.get("t") == "inlineStr":
                    values[at] = "".join(t.text or "" for t in cell.iter(_SHEET + "t"))
                elif value is not None:
                    values[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
            out.append(values)
    return out


def read_xlsx(spark: SparkSession, path: str, sheets: list[str], columns: list[str]) -> DataFrame:
    """The named columns of the named sheets of xlsx files, as text, in one table with file, sheet_no and row_no (from 0).

    A sheet's first row names its columns; a missing sheet or column fails. A file is read within one task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for number, sheet in enumerate(sheets):
                    head, *rows = sheet_rows(raw.as_py(), sheet) or [[]]
                    if missing := [c for c in columns if c not in head]:
                        raise ValueError(f"{file}: sheet {sheet} has no column {missing[0]}")
                    at = [head.index(c) for c in columns]
                    values = [pa.array([r[k] if k < len(r) else None for r in rows], pa.string()) for k in at]
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), pa.array([number] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()), *values], names=["file", "sheet_no", "row_no", *columns])

    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("sheet_no", T.IntegerType()), T.StructField("row_no", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in columns)])
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content").mapInArrow(run, schema)


def stream_jsonl(spark: SparkSession, folder: str, schema: T.StructType | str, files_at_once: int = 100) -> DataFrame:
    """JSON lines, plain or compressed, with declared fields as a stream of the files of a folder."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").option("maxFilesPerTrigger", files_at_once).json(folder)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(page_content, metadata) of files with an array of tagged chunks; other fields are left out."""
    return read_json(spark, path, CHUNK)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """A folder of JSON lines."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    """A folder of text files, a row a line."""
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def export_json_array(df: DataFrame, path: str, most: int = 100_000) -> int:
    """One JSON array in one local file, not ASCII-escaped; for results of at most ``most`` rows, more fail."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write JSON lines instead")
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps([json.loads(r) for r in rows], ensure_ascii=False), encoding="utf-8")
    return len(rows)


def number_rows(df: DataFrame, part: str, order: list[str], name: str = "pos") -> DataFrame:
    """Adds the position of each row within ``part``, from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1)
