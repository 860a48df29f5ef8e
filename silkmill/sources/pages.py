"""Books as rows of pages: files are read as whole binary values and parsed on the executors.

A parser makes of a file's bytes its pages and what the file says about itself. There are one for
text with form feeds between pages and one for simple PDF files (text drawn by the usual operators,
plain or deflated streams, fonts with a map to Unicode or Latin encodings); others can be given by
file ending. Encrypted files and pages of images alone have no text here.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.functions.text import base_name

SCHEMA = "file string, page_number int, total_pages int, text string, title string, author string, subject string, keywords string, error string"
FIELDS = ("title", "author", "subject", "keywords")


@dataclass
class Book:
    pages: list[str]
    about: dict[str, str] = field(default_factory=dict)


Parser = Callable[[bytes], Book]


def form_feed_pages(raw: bytes) -> Book:
    return Book(raw.decode("utf-8").split("\f"))


# ---------------------------------------------------------------------------------------------- PDF

_OBJECT = re.compile(rb"(?<![0-9])(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R\b")
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s()<>\[\]/]+|-?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPE = re.compile(rb"\\(?:([0-7]{1,3})|(\r\n|.))", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}


def _literal(raw: bytes) -> bytes:
    """The bytes of a string as written, in brackets or in hexadecimal."""
    if raw[:1] == b"<":
        digits = re.sub(rb"\s", b"", raw[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    return _ESCAPE.sub(lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1) else _ESCAPES.get(m.group(2), m.group(2)), raw[1:-1])


def _text(raw: bytes) -> str:
    """A text value outside pages."""
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("utf-8") if _is_utf8(raw) else raw.decode("latin-1")


def _is_utf8(raw: bytes) -> bool:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


class _Pdf:
    def __init__(self, raw: bytes) -> None:
        self.objects = {int(m.group(1)): m.group(3) for m in _OBJECT.finditer(raw)}
        if b"/Encrypt" in raw:
            raise ValueError("the file is encrypted")
        for body in list(self.objects.values()):
            if b"/ObjStm" in body:
                self._unpack(body)
        self.trailer = raw[raw.rfind(b"trailer") :] if b"trailer" in raw else b"".join(b for b in self.objects.values() if b"/XRef" in b)
        self.root = self.value(self.trailer, b"Root") or next((b for b in self.objects.values() if b"/Catalog" in b), b"")

    def stream(self, body: bytes) -> bytes:
        m = _STREAM.search(body)
        if not m:
            return b""
        head = body[: m.start()]
        if b"/FlateDecode" not in head:
            return m.group(1)
        return zlib.decompressobj().decompress(m.group(1))

    def _unpack(self, body: bytes) -> None:
        """Objects inside a stream of objects."""
        first = int(re.search(rb"/First\s+(\d+)", body).group(1))
        data = self.stream(body)
        numbers = [int(x) for x in data[:first].split()]
        starts = [*numbers[1::2], len(data) - first]
        for number, a, b in zip(numbers[::2], starts, starts[1:], strict=False):
            self.objects.setdefault(number, data[first + a : first + b])

    def value(self, body: bytes, name: bytes) -> bytes:
        """The rest of a dictionary after a key, the object itself where it is a reference; empty if there is none."""
        m = re.search(rb"/" + name + rb"(?![A-Za-z])\s*", body)
        if not m:
            return b""
        rest = body[m.end() :]
        reference = _REFERENCE.match(rest)
        return self.objects.get(int(reference.group(1)), b"") if reference else rest

    def kids(self, body: bytes) -> list[bytes]:
        rest = self.value(body, b"Kids")
        return [self.objects.get(int(n), b"") for n in _REFERENCE.findall(rest[: rest.find(b"]")])]

    def pages(self, node: bytes, fonts: bytes = b"", depth: int = 0) -> Iterator[tuple[bytes, bytes]]:
        """(page, its resources), in order; resources are inherited."""
        own = self.value(node, b"Resources") or fonts
        if b"/Kids" in node and depth < 64:
            for kid in self.kids(node):
                yield from self.pages(kid, own, depth + 1)
        elif b"/Page" in node:
            yield node, own

    def content(self, page: bytes) -> bytes:
        m = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", page)
        if not m:
            return b""
        bodies = [self.objects.get(int(n), b"") for n in _REFERENCE.findall(m.group(1))]
        if len(bodies) == 1 and bodies[0].lstrip()[:1] == b"[":
            bodies = [self.objects.get(int(n), b"") for n in _REFERENCE.findall(bodies[0])]
        return b"\n".join(self.stream(b) for b in bodies)

    def fonts(self, resources: bytes) -> dict[bytes, dict[bytes, str] | None]:
        """Font name to the map of its codes, None for fonts of Latin encodings."""
        listed = self.value(resources, b"Font")
        listed = listed[: listed.find(b">>")] if b">>" in listed else listed
        out: dict[bytes, dict[bytes, str] | None] = {}
        for name, number in re.findall(rb"/([^\s/]+)\s+(\d+)\s+\d+\s+R", listed):
            mapped = self.value(self.objects.get(int(number), b""), b"ToUnicode")
            out[name] = self.codes(self.stream(mapped)) if mapped else None
        return out

    @staticmethod
    def codes(cmap: bytes) -> dict[bytes, str]:
        out: dict[bytes, str] = {}
        of = lambda h: _literal(b"<" + h + b">")
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            for a, b in re.findall(rb"<([0-9A-Fa-f\s]+)>\s*<([0-9A-Fa-f\s]+)>", block):
                out[of(a)] = of(b).decode("utf-16-be", "replace")
        for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
            for a, b, c, several in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f]+)>|\[(.*?)\])", block, re.S):
                low, high, width = int(a, 16), int(b, 16), len(of(a))
                if several:
                    texts = [of(x).decode("utf-16-be", "replace") for x in re.findall(rb"<([0-9A-Fa-f]+)>", several)]
                else:
                    start = of(c).decode("utf-16-be", "replace")
                    texts = [start[:-1] + chr(ord(start[-1]) + k) for k in range(high - low + 1)]
                for k, text in zip(range(low, high + 1), texts, strict=False):
                    out[k.to_bytes(width, "big")] = text
        return out

    def page_text(self, page: bytes, resources: bytes) -> str:
        """The text that a page draws, a line break where the line changes."""
        fonts, codes = self.fonts(resources), None
        out: list[str] = []
        stack: list[bytes] = []

        def shown(raw: bytes) -> str:
            data = _literal(raw)
            if codes is None:
                return data.decode("cp1252", "replace")
            width = max((len(k) for k in codes), default=1)
            return "".join(codes.get(data[i : i + width], "\ufffd") for i in range(0, len(data), width))

        def line() -> None:
            if out and not out[-1].endswith("\n"):
                out.append("\n")

        for m in _TOKEN.finditer(self.content(page)):
            token = m.group()
            if token[:1] in b"(<[]/-.0123456789":
                stack.append(token)
                continue
            if token == b"Tf" and len(stack) > 1:
                codes = fonts.get(stack[-2][1:])
            elif token in (b"Tj", b"'", b'"'):
                if token != b"Tj":
                    line()
                out += [shown(s) for s in stack[-1:] if s[:1] in b"(<"]
            elif token == b"TJ":
                for s in stack:
                    if s[:1] in b"(<":
                        out.append(shown(s))
                    elif s[:1] not in b"[]/" and float(s) < -200 and out and not out[-1].endswith((" ", "\n")):
                        out.append(" ")  # a gap as wide as a word's
            elif token in (b"T*", b"TD") or (token == b"Td" and stack and float(stack[-1]) != 0) or token in (b"Tm", b"ET"):
                line()
            stack = []
        return "".join(out)


def pdf_pages(raw: bytes) -> Book:
    pdf = _Pdf(raw)
    pages = [pdf.page_text(page, resources) for page, resources in pdf.pages(pdf.value(pdf.root, b"Pages"))]
    info = pdf.value(pdf.trailer, b"Info")
    about = {}
    for name in FIELDS:
        rest = pdf.value(info, name.capitalize().encode())
        m = _TOKEN.match(rest)
        if m and m.group()[:1] in b"(<":
            about[name] = _text(_literal(m.group()))
    return Book(pages, about)


@dataclass
class Image:
    """``kind``: "jpeg" or "jp2" with the file's bytes as they are, else "gray" or "rgb" with eight bits a value, row by row."""

    page_number: int
    width: int
    height: int
    kind: str
    data: bytes


def cmyk_to_rgb(raw: bytes) -> bytes:
    """Pixels of four inks as red, green and blue."""
    inks = np.frombuffer(raw, np.uint8).reshape(-1, 4).astype(np.uint16)
    return ((255 - inks[:, :3]) * (255 - inks[:, 3:]) // 255).astype(np.uint8).tobytes()


def pdf_images(raw: bytes) -> list[Image]:
    """The images embedded in a PDF file, by page and in the order of its resources; one used on two pages is there twice.
    Pixels that are neither gray, RGB nor CMYK with eight bits, and packed in other ways than by deflation, are left out."""
    pdf = _Pdf(raw)
    out = []
    for number, (_, resources) in enumerate(pdf.pages(pdf.value(pdf.root, b"Pages")), start=1):
        listed = pdf.value(resources, b"XObject")
        listed = listed[: listed.find(b">>")] if b">>" in listed else listed
        for reference in _REFERENCE.findall(listed):
            body = pdf.objects.get(int(reference), b"")
            head = body[: body.find(b"stream")]
            if not re.search(rb"/Subtype\s*/Image", head):
                continue
            width, height = (int(m.group(1)) if (m := re.search(rb"/" + side + rb"\s+(\d+)", head)) else 0 for side in (b"Width", b"Height"))
            data, kind = pdf.stream(body), "jpeg" if b"/DCTDecode" in head else "jp2" if b"/JPXDecode" in head else ""
            if not kind:
                channels = len(data) // max(width * height, 1)
                if channels == 4:
                    data, channels = cmyk_to_rgb(data[: width * height * 4]), 3
                kind = {1: "gray", 3: "rgb"}.get(channels, "") if len(data) == width * height * channels else ""
            if kind:
                out.append(Image(number, width, height, kind, data))
    return out


# ---------------------------------------------------------------------------------------------- reading

PARSERS: dict[str, Parser] = {"txt": form_feed_pages, "pdf": pdf_pages}


def _pages(parsers: dict[str, Parser]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["file", "page_number", "total_pages", "text", *FIELDS, "error"]
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 6]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    book, error = parsers[path.rsplit(".", 1)[-1].lower()](raw.as_py()), None
                except Exception as e:  # noqa: BLE001
                    book, error = Book([]), f"{type(e).__name__}: {e}"[:500]
                about = [book.about.get(f) for f in FIELDS]
                rows = [(path, i + 1, len(book.pages), text, *about, None) for i, text in enumerate(book.pages)]
                rows += [(path, None, 0, None, *about, error)] if error else []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))], names=names)

    return run


def read_pages(spark: SparkSession, folder: str, glob: str | None = None, parsers: dict[str, Parser] | None = None) -> DataFrame:
    """(file, page_number, total_pages, text, title, author, subject, keywords, error): a row per page of all files below a
    folder, of the kinds that have a parser. A file that can't be read has one row with its error and no page."""
    parsers = {**PARSERS, **(parsers or {})}
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    ending = F.lower(F.substring_index(base_name(F.col("path")), ".", -1))
    return reader.load(folder).where(ending.isin(*parsers)).select("path", "content").mapInArrow(_pages(parsers), SCHEMA)


def read_images(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """(file, image_no, page_number, width, height, kind, data): the images embedded in PDF files; files that can't be read
    have none, see ``read_pages`` for their errors."""
    names = ["file", "image_no", "page_number", "width", "height", "kind", "data"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    images = pdf_images(raw.as_py())
                except Exception:  # noqa: BLE001
                    images = []
                rows = [(path, i, x.page_number, x.width, x.height, x.kind, x.data) for i, x in enumerate(images)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))], names=names)

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "content").mapInArrow(run, "file string, image_no int, page_number int, width int, height int, kind string, data binary")
