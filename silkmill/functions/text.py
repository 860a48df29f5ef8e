"""String functions as Column expressions; every one stays inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning steps, in the order they are applied. The patterns are read alike by RE2.
CLEANING: dict[str, tuple[str, str]] = {
    "html": (r"<[^<>]*>", ""),
    "url": (r"https?://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+", ""),
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", ""),
    "phone": (r"1[3-9][0-9]{9}", ""),
    "control": (r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""),
    "repeated": (r"([。！？!?，,；;])[。！？!?，,；;]+", "$1"),
}
_HALF = "".join(chr(c) for c in range(0x21, 0x7F))
_FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
#: Full-width letters, digits and signs, without the marks that Chinese text needs.
FULL_WIDTH = "".join(c for c in _FULL if c not in "，。！？；：（）～")
HALF_WIDTH = "".join(chr(ord(c) - 0xFEE0) for c in FULL_WIDTH)

# Parts of a consultation's description, in the order they are peeled off the end.
SECTIONS = (
    ("purpose", "想得到怎样的帮助"),
    ("past_treatment", "曾经治疗情况和效果"),
    ("detail", "病情描述（发病时间、主要症状、就诊医院等）"),
    ("disease", "疾病："),
)
# Where a book's text ends; words of books about animals; file kinds and where they go.
STOP_MARKER = "参考文献"
ANIMAL_WORDS = ("犬", "猫", "动物", "禽", "猪", "兽", "羊")
FILE_KINDS = (
    (("docx", "doc"), "Docx"),
    (("ppt", "pptx"), "ppt"),
    (("mobi",), "mobi"),
    (("epub",), "epub"),
    (("rar", "zip"), "rar_zip"),
    (("djvu",), "djvu"),
    (("ebk3",), "ebk3"),
    (("chm",), "chm"),
    (("xls",), "xls"),
    (("pdf", "txt"), "stay"),
)


def clean_text(text: Column, steps: Sequence[str] = (*CLEANING, "half_width")) -> Column:
    """Text after the named cleaning steps, in the given order."""
    for step in steps:
        if step == "half_width":
            text = F.translate(text, FULL_WIDTH, HALF_WIDTH)
        else:
            pattern, new = CLEANING[step]
            text = F.regexp_replace(text, pattern, new)
    return text


def strip_replacement(text: Column) -> Column:
    """Text without U+FFFD."""
    return F.replace(text, F.lit("�"), F.lit(""))


def squeeze(text: Column) -> Column:
    """Text without line breaks, spaces and tabs."""
    return F.translate(text, "\n \t", "")


def until_marker(text: Column, marker: str = STOP_MARKER) -> Column:
    """Text before the first ``marker``; all of it where there is none."""
    return F.substring_index(text, marker, 1)


def fenced_json(raw: Column) -> Column:
    """The text inside a code fence, with or without a language; unfenced text unchanged, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(raw, r"^\s*```(?:json)?\s*", ""), r"\s*```\s*$", ""))


# Items of a written list: text in either kind of quotes with escapes, numbers and constants.
_ITEM = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9]+(?:\.[0-9]+)?|True|False|None|true|false|null)"""
_LIST = rf"(?s)\A\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*+,?\s*)?\]\s*\z"


def literal_list(raw: Column) -> Column:
    """A list of strings written with either kind of quotes, which may hold the other; an empty array where it isn't one.

    Nothing is evaluated: numbers and constants stay as written, none and null are null, and of the
    escapes those of quotes, backslashes, line breaks and tabs are known.
    """

    def item(x: Column) -> Column:
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        # a backslash of its own is put aside while the others are read
        held = F.replace(inner, F.lit("\\\\"), F.lit("\x00"))
        for written, meant in (("\\n", "\n"), ("\\t", "\t"), ("\\'", "'"), ('\\"', '"')):
            held = F.replace(held, F.lit(written), F.lit(meant))
        quoted = F.startswith(x, F.lit("'")) | F.startswith(x, F.lit('"'))
        return F.when(quoted, F.replace(held, F.lit("\x00"), F.lit("\\"))).when(~x.isin("None", "null"), x)

    items = F.transform(F.regexp_extract_all(raw, F.lit("(?s)" + _ITEM), F.lit(0)), item)
    return F.when(raw.rlike(_LIST), items).otherwise(F.array().cast("array<string>"))


def render(template: str, values: Mapping[str, Column]) -> Column:
    """``template`` with each {name} replaced; {{ and }} are braces. Values are inserted in one pass, so braces inside them stay."""
    parts: list[Column] = []
    rest = template
    while rest:
        start = rest.find("{")
        end = rest.find("}")
        if start < 0 and end < 0:
            parts.append(F.lit(rest))
            break
        at = min(x for x in (start, end) if x >= 0)
        parts.append(F.lit(rest[:at]))
        if rest[at : at + 2] in ("{{", "}}"):
            parts.append(F.lit(rest[at]))
            rest = rest[at + 2 :]
        elif rest[at] == "{" and (close := rest.find("}", at)) > 0 and rest[at + 1 : close] in values:
            parts.append(F.coalesce(values[rest[at + 1 : close]].cast("string"), F.lit("")))
            rest = rest[close + 1 :]
        else:
            parts.append(F.lit(rest[at]))
            rest = rest[at + 1 :]
    return F.concat(*parts)


def numbered(items: Column, first: int = 0) -> Column:
    """An array of strings as lines "number. item"."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + first).cast("string"), F.lit(". "), x)), "\n")


def few_shot(prefix: Column, examples: Column, suffix: Column, separator: str = "\n\n") -> Column:
    """Prefix, rendered examples and suffix of a few-shot prompt; null examples are left out."""
    return F.concat_ws(separator, prefix, F.array_join(F.filter(examples, lambda x: x.isNotNull()), separator), suffix)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def drop_numbering(text: Column, compat: bool = False) -> Column:
    """A leading "1." removed; with ``compat``, every "1." of a text that begins with one."""
    led = F.startswith(text, F.lit("1."))
    return F.when(led, F.replace(text, F.lit("1."), F.lit("")) if compat else F.substring(text, 3, 1 << 30)).otherwise(text)


def without_answers(questions: Column, word: str = "答案") -> Column:
    """An array of questions without those that hold ``word``; the row stays, if with an empty array."""
    return F.filter(questions, lambda q: ~F.contains(q, F.lit(word)))


def trim_colons(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "^:+|:+$", ""), "^：+|：+$", "")


def sections(text: Column, compat: bool = False) -> Column:
    """A description as struct(disease, detail, past_treatment, purpose).

    From the end: a part's value follows the last occurrence of its marker, and the search goes on
    before the first. Missing parts are empty. Line breaks around a value go before its colons do;
    with ``compat`` colons go first, so a line break protects them.
    """
    values: dict[str, Column] = {}
    for name, marker in SECTIONS:
        value = F.substring_index(text, marker, -1)
        value = F.replace(trim_colons(value), F.lit("\n"), F.lit("")) if compat else trim_colons(F.replace(value, F.lit("\n"), F.lit("")))
        values[name] = F.when(F.contains(text, F.lit(marker)), value).otherwise(F.lit(""))
        text = F.substring_index(text, marker, 1)
    return F.struct(*[values[n].alias(n) for n in ("disease", "detail", "past_treatment", "purpose")])


def wrap(text: Column, width: int, compat: bool = False) -> Column:
    """A line break after every ``width`` characters, none at the end; with ``compat`` later lines hold one character less."""
    if not compat:
        return F.regexp_replace(text, f"(?s)(.{{{width}}})(?=.)", "$1\n")
    rest = F.substring(text, width + 1, 1 << 30)
    lines = F.regexp_replace(rest, f"(?s)(.{{{max(1, width - 1)}}})(?=.)", "$1\n")
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("\n"), lines)).otherwise(text)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def file_bucket(path: Column, compat: bool = False) -> Column:
    """Where a file belongs by its ending; with ``compat`` endings count by case, as listed."""
    name = base_name(path) if compat else F.lower(base_name(path))
    out = F.lit("else")
    for endings, bucket in reversed(FILE_KINDS):
        hit = F.lit(False)
        for e in endings:
            hit = hit | F.endswith(name, F.lit("." + e))
            if compat and e in ("pptx", "pdf"):
                hit = hit | F.endswith(name, F.lit("." + e.upper()))
        out = F.when(hit, F.lit(bucket)).otherwise(out)
    return out


def about_animals(name: Column) -> Column:
    return name.rlike("|".join(ANIMAL_WORDS))


def table_title(page: Column) -> Column:
    """The line that begins with the word for table, with the line break before it; empty where there is none."""
    return F.regexp_extract(page, "(\n表[^\n]*)", 1)


def good_length(text: Column, low: int = 64, high: int = 2048, compat: bool = False) -> Column:
    """Longer than ``low`` and shorter than ``high``; with ``compat``, either."""
    return (F.length(text) > low) | (F.length(text) < high) if compat else (F.length(text) > low) & (F.length(text) < high)


def tokens(text: Column) -> Column:
    """Default tokenizer: the code points of a text."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def raster_zoom(width: Column, height: Column, most: int = 3000, large: int = 2, small: int = 3) -> Column:
    """The zoom to draw a page with: less for pages above ``most`` points a side."""
    return F.when((width > most) | (height > most), large).otherwise(small)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance of two points."""
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))
