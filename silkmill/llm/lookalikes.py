"""Text that looks alike but differs in its characters, brought to one form by SQL inside Arrow partitions.

Each Arrow batch is a table of an embedded database: its regular expressions find the affected rows,
and translate, nfc_normalize and regexp_replace write the one form:
full-width letters and digits, compatibility ideographs and radicals become the ordinary ones;
ligatures are spelled out; combining accents are composed; non-breaking spaces become spaces;
zero-width characters go, except the joiners inside emoji; a letter of another alphabet inside a
Latin word becomes the Latin letter it looks like.

Defined results: null and empty texts are not affected; ordinary Chinese punctuation (full-width
comma, brackets and so on), superscripts, composed accents, single Greek letters and words wholly in
another alphabet are left as they are; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Letters of other alphabets and the Latin letters they look like.
LOOKALIKES = dict(
    zip(
        "АВЕЅЗКМНОРСТУХІЈҮԚԜаеѕіјоррсухһԁԛԝґ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧΪοικνρυχ" + "օսոՕՍ",
        "ABES3KMHOPCTYXIJYQWaesijoppcyxhdqwr" + "ABEZHIKMNOPTYXIoiknpux" + "ounOU",
        strict=True,
    )
)
#: Zero-width characters.
ZERO_WIDTH = r"\x{200B}-\x{200D}\x{2060}-\x{2064}\x{FEFF}\x{180E}"
NO_BREAK = r"\x{00A0}\x{202F}\x{2007}"
FULL_WIDTH = r"\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}"
LIGATURES = r"\x{FB00}-\x{FB06}\x{FB13}-\x{FB17}"
IDEOGRAPH_FORMS = r"\x{2E80}-\x{2FD5}\x{F900}-\x{FA0D}\x{FA10}\x{FA12}\x{FA15}-\x{FA1E}\x{FA20}\x{FA22}\x{FA25}\x{FA26}\x{FA2A}-\x{FAD9}\x{2F800}-\x{2FA1D}"
LETTER_FORMS = r"\x{1D400}-\x{1D7FF}"
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2190}-\x{21FF}\x{2B00}-\x{2BFF}\x{FE0F}\x{20E3}]"
ACCENTS = r"[\p{L}][\x{0300}-\x{036F}]"
WORD = r"[\p{Latin}\p{Cyrillic}\p{Greek}\p{Armenian}0-9\x{0300}-\x{036F}]"
#: Stands for a joiner inside an emoji while the others are removed; no character is ever assigned here.
HELD = "\U000ffffe"


def _one_to_one() -> tuple[str, str]:
    """Compatibility forms that stand for exactly one ordinary character, by the rule of Unicode's compatibility mapping."""
    ranges = [(0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0x2E80, 0x2FD5), (0xF900, 0xFAD9), (0x2F800, 0x2FA1D), (0x1D400, 0x1D7FF)]
    pairs = [(chr(c), n) for low, high in ranges for c in range(low, high + 1) if len(n := unicodedata.normalize("NFKC", chr(c))) == 1 and n != chr(c)]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _sql() -> str:
    """One statement over the table ``batch`` (field, row_id, text): the affected rows and their one form."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    old, new = _one_to_one()
    foreign, latin = "".join(LOOKALIKES), "".join(LOOKALIKES.values())
    # Greek letters count only if they pass for a Latin one; letters of the other alphabets always do
    inside = f"[{''.join(c for c in foreign if 'Ͱ' <= c <= 'Ͽ')}\\p{{Cyrillic}}\\p{{Armenian}}]"
    mixed = f"\\p{{Latin}}[0-9\\x{{0300}}-\\x{{036F}}]*{inside}|{inside}[0-9\\x{{0300}}-\\x{{036F}}]*\\p{{Latin}}"
    # letters of one word may be apart, with Greek that is no look-alike or more foreign letters between them
    apart = f"\\p{{Latin}}{WORD}*{inside}|{inside}{WORD}*\\p{{Latin}}"
    plain = f"[{FULL_WIDTH}{NO_BREAK}{LIGATURES}{IDEOGRAPH_FORMS}{LETTER_FORMS}]|{ACCENTS}"
    def hold(value: str) -> str:
        return f"regexp_replace({value}, {text(f'({EMOJI})' + chr(92) + 'x{200D}(' + EMOJI + ')')}, {text(chr(92) + '1' + HELD + chr(92) + '2')}, 'g')"

    held = hold(hold("text"))  # twice, as neighbouring joiners share an emoji
    tokens = f"regexp_extract_all(t, {text(f'{WORD}+|[^' + WORD[1:] + '+')})"
    word = f"CASE WHEN regexp_matches(w, {text(apart)}) THEN translate(w, {text(foreign)}, {text(latin)}) ELSE w END"
    steps = f"regexp_replace(held, {text(f'[{ZERO_WIDTH}]')}, '', 'g')"
    steps = f"translate({steps}, {text(HELD)}, chr(8205))"
    steps = f"regexp_replace({steps}, {text(f'[{NO_BREAK}]')}, ' ', 'g')"
    steps = f"translate({steps}, {text(old)}, {text(new)})"
    for ligature in [chr(c) for c in (*range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18))]:
        steps = f"replace({steps}, {text(ligature)}, {text(unicodedata.normalize('NFKC', ligature))})"
    return f"""
        WITH near AS (SELECT field, row_id, text FROM batch
                      WHERE regexp_matches(text, {text(f"{plain}|[{ZERO_WIDTH}]|{mixed}|{apart}")})),
             kept AS (SELECT field, row_id, text, {held} AS held FROM near),
             hits AS (SELECT * FROM kept WHERE regexp_matches(text, {text(f"{plain}|{apart}")}) OR regexp_matches(held, {text(f"[{ZERO_WIDTH}]")})),
             flat AS (SELECT field, row_id, text, nfc_normalize({steps}) AS t FROM hits)
        SELECT field, row_id, text, CASE WHEN regexp_matches(t, {text(apart)}) THEN array_to_string(list_transform({tokens}, lambda w: {word}), '') ELSE t END AS one_form
        FROM flat"""


_PLAIN: dict[int, str | None] = {}
_MIXED = re.compile(r"[A-Za-zÀ-ɏͰ-ԯ԰-֏0-9]+")
_JOINED_EMOJI = re.compile("(?<![\U0001f000-\U0001faff☀-➿️])\u200d|\u200d(?![\U0001f000-\U0001faff☀-➿])")


def plain_forms() -> dict[int, str | None]:
    """Code points of compatibility forms and invisible characters, and what stands for them in the one form."""
    if not _PLAIN:
        old, new = _one_to_one()
        _PLAIN.update(zip(map(ord, old), new, strict=True))
        _PLAIN.update({c: " " for c in (0xA0, 0x202F, 0x2007)} | {c: None for c in (0x200B, 0x200C, *range(0x2060, 0x2065), 0xFEFF, 0x180E)})
        _PLAIN.update({c: unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18))})
    return _PLAIN


def quick_form(text: str) -> str:
    """The one form of a single text, for operators that read past such characters in passing."""
    text = unicodedata.normalize("NFC", _JOINED_EMOJI.sub("", text).translate(plain_forms()))

    def latin(m: re.Match) -> str:
        word = m.group()
        if not re.search("[A-Za-z]", word) or not re.search("[Ͱ-֏]", word):
            return word
        return "".join(LOOKALIKES.get(c, c) for c in word)

    return _MIXED.sub(latin, text)


Check = Callable[[str, str], bool]


def normalizer(excluded: Callable[[], Check] | None = None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (field, row_id, text) to those of affected rows; ``excluded`` makes a test (field, text) of rows to leave out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        sql, test = _sql(), excluded() if excluded else None
        with duckdb.connect(config={"threads": 1, "memory_limit": "400MB"}) as db:
            for batch in batches:
                db.register("batch", pa.Table.from_batches([batch]))
                hits = db.sql(sql).to_arrow_table()
                db.unregister("batch")
                if test is not None:
                    fields, texts = hits.column("field").to_pylist(), hits.column("text").to_pylist()
                    hits = hits.filter(pa.array([not test(f, t) for f, t in zip(fields, texts, strict=True)], pa.bool_()))
                for out in hits.select(["field", "row_id", "one_form"]).to_batches():
                    yield out

    return run


def find_lookalikes(texts: DataFrame, excluded: Callable[[], Check] | None = None) -> DataFrame:
    """(field, row_id, one_form) of the affected rows of (field, row_id, text); one narrow pass."""
    return texts.select("field", "row_id", "text").mapInArrow(normalizer(excluded), "field string, row_id long, one_form string")
