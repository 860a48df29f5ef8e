"""Text decoded with the wrong character encoding: found, and restored where the bytes survive.

Every chain "encode with the encoding that was wrongly used, decode with the true one" is tried on
the parts of a text whose bytes fit it; a smoothed character model of clean records scores the
outcome, and the likeliest chain is accepted if it gains more than a validated margin. Chains are
repeated, as text can be garbled twice. A replacement character (U+FFFD) always comes from a failed
decoding: such a text is affected even where nothing can be recovered.

Defined results: null and empty texts are never affected; repeated rows give repeated rows;
a text that no chain improves by the margin stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkmill.llm.batches import run_of_texts
from silkmill.llm.charmodel import CharModel, bi_bucket, fit_char_model, uni_bucket

# Encodings that text is commonly decoded with by mistake.
SINGLE_BYTE = ("cp1252", "latin_1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "koi8_r")
MULTI_BYTE = ("gb18030", "big5", "cp949", "cp932")
# True encodings of more than one byte, and of Cyrillic letters, besides UTF-8 and Western ones.
MULTI_TRUE, CYRILLIC_TRUE = ("gbk", "big5", "cp932", "cp949"), ("cp1251", "koi8_r")
_WIDER = {"gbk": "gb18030"}
WESTERN_AS = ("cp437", "cp850", "mac_roman", "cp866", "cp1251", "cp1250")
# Letters that stand for themselves or for a Latin look-alike, and say nothing about the encoding.
NO_EVIDENCE = "ﬁﬂаесорухіѕјһАВЕЅКМНОРСТУХІЈαβγδεμπσΓΣΩ\xa0"


def _lost_forms() -> re.Pattern:
    """The replacement character, and how its bytes read in each of the encodings: what it stood for can't be recovered."""
    mark = "\ufffd".encode()
    forms = {"\ufffd"}
    for codec in (*SINGLE_BYTE, *MULTI_BYTE):
        try:
            forms.add((mark if codec in SINGLE_BYTE else mark * 2).decode(codec))
        except UnicodeDecodeError:
            continue
    return re.compile("|".join(re.escape(f) for f in sorted(forms, key=len, reverse=True)))


def _high_half(codec: str) -> list[str]:
    """Characters of the bytes 0x80 to 0xFF; undefined bytes as the control character of that number."""
    out = []
    for b in range(0x80, 0x100):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@dataclass
class Change:
    start: int
    end: int
    text: str


#: A part of a text with its bytes (or, where those are single letters, the part itself).
Span = tuple[int, int, bytes | str]


@dataclass
class Family:
    """Chains that share where they look, as the text was decoded with the same encoding.

    ``find`` gives the parts whose bytes fit, each with narrower ones to try if it can't be read, from the text and its
    characters that clean records never show; ``chars``: without any of these in a text there are none.
    """

    find: Callable[[str, set[str]], list[list[Span]]]
    chars: frozenset[str] | None = None


@dataclass
class Chain:
    """``wrong``: the encoding the text was decoded with; ``true``: the encoding of its bytes, read by ``read`` (None: not possible)."""

    wrong: str
    true: str
    family: Family
    read: Callable[[bytes | str], str | None]

    @property
    def name(self) -> str:
        return f"{self.wrong}>{self.true}"


def _char_class(chars: Iterable[str]) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def _reader(codec: str) -> Callable[[bytes], str | None]:
    def read(raw: bytes) -> str | None:
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            return None

    return read


def _utf8_in_single(codec: str) -> Chain:
    high = _high_half(codec)
    to_byte = {c: 0x80 + i for i, c in enumerate(high)}
    of = lambda a, b: _char_class(high[a - 0x80 : b - 0x80 + 1])
    tail = of(0x80, 0xBF)
    runs = re.compile(f"(?:{of(0xC2, 0xDF)}{tail}|{of(0xE0, 0xEF)}{tail}{{2}}|{of(0xF0, 0xF4)}{tail}{{3}})+")

    def decoded(m: re.Match) -> str:
        return bytes([to_byte[c] for c in m.group()]).decode("utf-8")

    def read(part: str) -> str | None:
        try:
            new = runs.sub(decoded, part)
            for _ in range(3):  # text can be garbled more than once
                again = runs.sub(decoded, new)
                if again == new:
                    break
                new = again
            return new
        except UnicodeDecodeError:
            return None

    find = lambda text, _: [[(*m.span(), m.group())] for m in runs.finditer(text)]
    return Chain(codec, "utf-8", Family(find, frozenset(high[0x42:0x75])), read)


def _multi_in_single(codec: str, readers: dict[str, Callable]) -> list[Chain]:
    high = _high_half(codec)
    to_byte = {c: 0x80 + i for i, c in enumerate(high)} | {chr(b): b for b in range(0x30, 0x7F)}
    lead, upper = _char_class(high[1:-1]), _char_class(high[:-1])
    four = f"{lead}[0-9]{lead}[0-9]"  # a character outside GBK, which may stand alone
    runs = re.compile(f"(?:{lead}{upper}|{four})(?:{lead}(?:{upper}|[@-~](?={lead}))|{four})*")
    find = lambda text, _: [[(*m.span(), bytes([to_byte[c] for c in m.group()]))] for m in runs.finditer(text)]
    family = Family(find, frozenset(high[1:-1]))
    return [Chain(codec, true, family, readers[_WIDER.get(true, true)]) for true in MULTI_TRUE]


_UTF8_BYTES = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2})+")
_NOT_ASCII = re.compile("[^\x00-\x7f�]+")


def _utf8_in_multi(codec: str) -> Chain:
    def find(text: str, strange: set[str]) -> list[list[Span]]:
        out: list[list[Span]] = []
        for run in _NOT_ASCII.finditer(text) if strange else ():
            if strange.isdisjoint(run.group()):
                continue
            try:
                raw = run.group().encode(codec)
            except UnicodeEncodeError:
                continue
            for m in _UTF8_BYTES.finditer(raw):
                if m.end() - m.start() < 6 and not (len(raw) < 8 and len(run.group()) <= 3):
                    continue  # by chance, in running text of this encoding
                try:
                    before, after = raw[: m.start()].decode(codec), raw[m.end() :].decode(codec)
                    out.append([(run.start() + len(before), run.end() - len(after), m.group())])
                except UnicodeDecodeError:
                    continue
        return out

    return Chain(codec, "utf-8", Family(find), _reader("utf-8"))


_DOUBLE = re.compile("[가-힣｡-ﾟ㐀-鿿]{2}")


def _multi_in_multi(codec: str, readers: dict[str, Callable]) -> list[Chain]:
    wider = _WIDER.get(codec, codec)

    def find(text: str, strange: set[str]) -> list[list[Span]]:
        out: list[list[Span]] = []
        for run in _NOT_ASCII.finditer(text) if strange and _DOUBLE.search(text) else ():
            part = run.group()
            if len(part) < 3 or strange.isdisjoint(part):
                continue
            odd = [i for i, c in enumerate(part) if c in strange]
            ways: list[Span] = []
            # the whole run, or from its first to its last odd character, where the rest was never garbled
            for a, b in dict.fromkeys(((0, len(part)), *((max(0, odd[0] - x), min(len(part), odd[-1] + 1 + y)) for x in (1, 0) for y in (1, 0)))):
                try:
                    ways.append((run.start() + a, run.start() + b, part[a:b].encode(wider)))
                except UnicodeEncodeError:
                    continue
            if ways:
                out.append(ways)
        return out

    family = Family(find)
    return [Chain(codec, true, family, readers[true]) for true in MULTI_TRUE if true != codec]


def _mapped(codec: str, true: str, table: dict[str, str], pattern: str) -> Chain:
    """A chain between encodings of single bytes, whose letters are read one by one."""
    words = re.compile(pattern.replace("%", _char_class(table)))
    find = lambda text, _: [[(*m.span(), m.group())] for m in words.finditer(text)]
    return Chain(codec, true, Family(find, frozenset(table)), lambda part: "".join(table.get(c, c) for c in part))


def _western_in_single(codec: str) -> Chain:
    western = _high_half("cp1252")
    table = {c: western[i] for i, c in enumerate(_high_half(codec)) if c != western[i] and (western[i].isalpha() or western[i] in "’‘“”–—°±«»²³µ§ß") and c not in NO_EVIDENCE}
    return _mapped(codec, "cp1252", table, "(?:(?<=[A-Za-z0-9 ])|^)%{1,3}|%{1,3}(?=[A-Za-z ])")


def _cyrillic_in_single(codec: str, true: str) -> Chain:
    """Runs of at least two letters, single spaces between, all of them Cyrillic in the true encoding."""
    letters = _high_half(true)
    table = {c: letters[i] for i, c in enumerate(_high_half(codec)) if c != letters[i] and "Ѐ" <= letters[i] <= "ӿ"}
    return _mapped(codec, true, table, "%(?: ?%)+")


def all_chains() -> list[Chain]:
    # one reader for an encoding: what it read once holds for all chains
    readers = {codec: _reader(codec) for codec in (*MULTI_TRUE, *_WIDER.values())}
    return (
        [_utf8_in_single(c) for c in SINGLE_BYTE]
        + [chain for c in SINGLE_BYTE if c != "cp866" for chain in _multi_in_single(c, readers)]
        + [_utf8_in_multi(c) for c in MULTI_BYTE]
        + [chain for c in ("cp949", "big5", "cp932", "gbk") for chain in _multi_in_multi(c, readers)]
        + [_western_in_single(c) for c in WESTERN_AS]
        + [_cyrillic_in_single(c, true) for true in CYRILLIC_TRUE for c in SINGLE_BYTE if c != true]
    )


_LOST = _lost_forms()


@dataclass
class Restorer:
    """``margin``: the log-probability that an accepted change must gain; ``rounds``: how often text may be garbled."""

    model: CharModel
    margin: float = 8.0
    rounds: int = 3
    chains: list[Chain] = field(default_factory=list, repr=False)
    seen: frozenset[str] = field(default_factory=frozenset, repr=False)

    def __post_init__(self) -> None:
        # characters of the first plane outside ASCII that occur in clean records; the others are asked for
        points = np.arange(0x80, 0x10000, dtype=np.uint32)
        self.seen = frozenset(map(chr, points[self.model.uni[uni_bucket(points)] > 0].tolist()))

    def state(self) -> tuple:
        """Plain arrays and numbers, to be broadcast; of fixed size."""
        return self.model.uni, self.model.bi, self.margin, self.rounds

    @classmethod
    def of(cls, state: tuple) -> Restorer:
        return cls(CharModel(state[0], state[1]), state[2], state[3])

    def _gains(self, text: str, changes: list[Change]) -> np.ndarray:
        """Log-probability gained by each change within two characters of context."""
        parts = []
        for c in changes:
            before, after = text[max(0, c.start - 2) : c.start], text[c.end : c.end + 2]
            parts += [before, text[c.start : c.end], after, "\0", before, c.text, after, "\0"]
        points = np.frombuffer(("\0" + "".join(parts)).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.flatnonzero(points == 0)
        sums = np.add.reduceat(self.model.log_probs(points), ends[:-1])
        return sums[1::2] - sums[0::2]

    def _seen(self, char: str) -> bool:
        """The character occurs in clean records."""
        return char in self.seen or char > "\uffff" and bool(self.model.uni[uni_bucket(np.uint32(ord(char)))] > 0)

    def _known(self, text: str) -> bool:
        """At least half of the characters outside ASCII occur in clean records; a text without any doesn't count."""
        wide = text if text.isascii() else [c for c in text if c > "\x7f"]
        return not text.isascii() and 2 * sum(map(self._seen, wide)) >= len(wide)

    def proposals(self, text: str) -> list[tuple[Chain, list[Change], np.ndarray]]:
        """What each chain would change to characters that are known, with the gain of each change."""
        if not self.chains:
            self.chains = all_chains()
        wide = {c for c in set(text) if c > "\x7f"}
        strange = {c for c in wide if not self._seen(c)}
        spans: dict[int, list[list[Span]]] = {}
        reads: dict[tuple[Callable, bytes], tuple[str | None, bool]] = {}  # the same bytes come of several encodings
        found: list[tuple[Chain, list[Change]]] = []
        for chain in self.chains:
            family = chain.family
            if family.chars is not None and family.chars.isdisjoint(wide):
                continue
            if id(family) not in spans:
                spans[id(family)] = family.find(text, strange)
            changes = []
            for ways in spans[id(family)]:
                for start, end, raw in ways:
                    if isinstance(raw, str):
                        new = chain.read(raw)
                        known = new is not None and self._known(new)
                    else:
                        key = (chain.read, raw)
                        if key not in reads:
                            new = chain.read(raw)
                            reads[key] = new, new is not None and self._known(new)
                        new, known = reads[key]
                    if new is not None and new != text[start:end]:
                        if known:
                            changes.append(Change(start, end, new))
                        break
            if changes:
                found.append((chain, changes))
        if not found:
            return []
        gains = self._gains(text, [c for _, changes in found for c in changes])
        cuts = np.cumsum([len(changes) for _, changes in found])[:-1]
        return [(chain, changes, g) for (chain, changes), g in zip(found, np.split(gains, cuts), strict=True)]

    def best_step(self, text: str, margin: float) -> tuple[str, str, float] | None:
        """The text after the chain that gains most, the chain's name and its gain; None below the margin."""
        best: tuple[float, Chain, list[Change]] | None = None
        for chain, changes, gains in self.proposals(text):
            if gains.max() <= margin:
                continue
            taken = [c for c, g in zip(changes, gains, strict=True) if g > 0]  # the rest of the text was read the same way
            total = float(gains[gains > 0].sum())
            if taken and (chain.true not in MULTI_TRUE or max(len(c.text) for c in taken) >= 3) and (best is None or total > best[0]):
                best = (total, chain, taken)
        if best is None:
            return None
        parts, at = [], 0
        for change in best[2]:
            parts += [text[at : change.start], change.text]
            at = change.end
        return "".join(parts) + text[at:], best[1].name, best[0]

    def suspect(self, text: str) -> bool:
        """The text holds what ``suspects`` looks for."""
        return bool(len(suspects(self.model, pa.array([text], pa.string()))))

    def restore(self, text: str) -> tuple[str, str, float] | None:
        """(restored text, chains, gain) of an affected text, else None."""
        names: list[str] = []
        total = 0.0
        now = text
        for _ in range(self.rounds):
            step = self.best_step(now, self.margin)
            if step is None:
                break
            now, total = step[0], total + step[2]
            names.append(step[1])
        if _LOST.search(text):
            names.append("lost")
        return (now, " ".join(names), total) if names else None


def garble(text: str, chain_name: str) -> str | None:
    """``text`` as it reads after wrong decoding, None where that isn't possible without loss."""
    wrong, true = chain_name.split(">")
    try:
        raw = text.encode(true)
        if wrong in SINGLE_BYTE:
            high = _high_half(wrong)
            return "".join(chr(b) if b < 0x80 else high[b - 0x80] for b in raw)
        return raw.decode(_WIDER.get(wrong, wrong))
    except UnicodeError:
        return None


#: The margins to choose from.
MARGINS = np.arange(8.0, 20.5, 0.5)
_SENTENCE = re.compile(r"[^。！？.!?\n]*[。！？.!?\n]*")


def garbled_as_far(text: str, chain_name: str) -> str | None:
    """The whole text garbled, or each of its sentences that survives; None where nothing changes."""
    bad = garble(text, chain_name)
    if bad is None:
        parts = _SENTENCE.findall(text)
        bad = "".join(p if (b := garble(p, chain_name)) is None else b for p in parts)
    return bad if bad != text else None


def margins_below(restorer: Restorer, text: str) -> int:
    """How many of ``MARGINS`` the largest gain of any change of the whole text exceeds."""
    gains = [g.max() for chain, changes, g in restorer.proposals(text) if chain.true not in MULTI_TRUE or max(len(c.text) for c in changes) >= 3]
    return int(np.searchsorted(MARGINS, max(gains, default=0.0)))


def _validator(shared: object) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (text, number) to one row (garbled, below, n) per case of its partition; the number chooses the chain."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer.of(shared.value)
        restorer.chains = all_chains()
        counts = np.zeros((2, len(MARGINS) + 1), np.int64)
        for batch in batches:
            for text, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[0, margins_below(restorer, text)] += 1
                bad = garbled_as_far(text, restorer.chains[number % len(restorer.chains)].name)
                if bad is not None:
                    counts[1, margins_below(restorer, bad)] += 1
        kind, below = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(below, pa.int32()), pa.array(counts[kind, below])], names=["garbled", "below", "n"])

    return run


def validated_margin(restorer: Restorer, held_out: DataFrame, text_col: str) -> float:
    """The margin, from 8 to 20, with the fewest errors on held-out clean records and on the same records garbled.

    All records count, with their whole texts; each is garbled by a chain that its hash chooses, so
    that the margin doesn't depend on the order of rows.
    """
    shared = held_out.sparkSession.sparkContext.broadcast(restorer.state())
    number = F.pmod(F.xxhash64(F.lit(1), f"`{text_col}`"), F.lit(1 << 30)).cast("int")
    found = held_out.select(F.col(f"`{text_col}`"), number).mapInArrow(_validator(shared), "garbled int, below int, n long").groupBy("garbled", "below").agg(F.sum("n").alias("n")).collect()
    if not found:
        return restorer.margin
    counts = np.zeros((2, len(MARGINS) + 1), np.int64)
    for r in found:
        counts[r["garbled"], r["below"]] = r["n"]
    # a gain that exceeds k margins is taken by the first k of them
    false, missed = counts[0].sum() - np.cumsum(counts[0])[:-1], np.cumsum(counts[1])[:-1]
    errors = 3 * false + missed
    fewest = MARGINS[errors == errors.min()]
    return float(min(fewest[0] + 1.0, fewest[-1]))


def fit_restorer(clean: DataFrame, text_col: str) -> Restorer:
    """The model counts four fifths of the clean records, all of them; all others validate the margin.

    With no clean records nothing but replacement characters is found.
    """
    fifth = F.pmod(F.xxhash64(f"`{text_col}`"), F.lit(5))
    part = clean.where(F.col(f"`{text_col}`").isNotNull())
    restorer = Restorer(fit_char_model(part.where(fifth != 0), text_col))
    restorer.margin = validated_margin(restorer, part.where(fifth == 0), text_col)
    return restorer


def suspects(model: CharModel, column: pa.Array) -> np.ndarray:
    """Indexes of the texts that may be garbled: they hold a character that clean records never show, or a pair of
    characters, not both ASCII and neither an ideograph, that clean records never show."""
    points, starts = run_of_texts(column)
    if not len(points):
        return np.zeros(0, np.int64)
    wide = points > 127
    at = np.flatnonzero(wide)
    chars = points[at]
    strange = at[(model.uni[uni_bucket(chars)] == 0) | (chars == 0xFFFD)]
    plain = (points < 0x3400) | (points >= 0xA000)
    inside = np.ones(len(points) - 1, bool)
    cuts = starts[1:-1]
    inside[cuts[(cuts > 0) & (cuts < len(points))] - 1] = False
    near = np.flatnonzero((wide[:-1] | wide[1:]) & plain[:-1] & plain[1:] & inside)
    pairs = near[model.bi[bi_bucket(points[near], points[near + 1])] == 0]
    hit = np.zeros(len(starts), bool)
    hit[np.searchsorted(starts, strange, side="right") - 1] = True
    hit[np.searchsorted(starts, pairs, side="right") - 1] = True
    return np.flatnonzero(hit[:-1])


def _finder(shared: object) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer.of(shared.value)
        for batch in batches:
            texts = batch.column(2)
            at = suspects(restorer.model, texts)
            if not len(at):
                continue
            few = batch.take(pa.array(at))
            hits = [restorer.restore(t) for t in few.column(2).to_pylist()]
            kept = [i for i, h in enumerate(hits) if h is not None]
            rows = few.take(pa.array(kept, pa.int64()))
            done = [hits[i] for i in kept]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([h[0] for h in done], pa.string()), pa.array([h[1] for h in done], pa.string()), pa.array([h[2] for h in done], pa.float64())], names=["field", "row_id", "restored", "chains", "gain"])

    return run


def find_garbled(texts: DataFrame, restorer: Restorer) -> DataFrame:
    """(field, row_id, restored, chains, gain) of the affected rows of (field, row_id, text); one narrow pass.

    ``chains`` ends in "lost" where characters can't be recovered.
    """
    shared = texts.sparkSession.sparkContext.broadcast(restorer.state())
    return texts.select("field", "row_id", "text").mapInArrow(_finder(shared), "field string, row_id long, restored string, chains string, gain double")
