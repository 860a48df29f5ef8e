"""Text from scanned pages repaired into continuous paragraphs.

1. One pass counts words and word pairs of all texts, and how often the words that glyph confusions
   could concern stand near which others. From the last, skip-gram vectors with negative sampling
   are learnt; the counts of all pairs stand in for a run over the corpus, whose expected loss they
   determine. A word's vector is the sum of its contexts' vectors, so a word seen once has one too, and
   so has each single occurrence.
2. A rare word is linked to a frequent one if a plausible glyph edit leads from one to the other and
   they are neighbours by their vectors, that of the rare word in all its contexts or in this one;
   among several, the nearest is taken. In Chinese, where nothing marks words, the two words are the
   pairs that a character makes with its neighbours. A link is used only where it fits the words
   around. Letters in place of digits are told by the numbers around them, as numbers are no words.
3. Running headers, footers and page numbers are removed, words broken at a line end joined, and the
   lines of a paragraph joined.

Defined results: null and empty texts are not affected; layout alone (lists, small tables, line
breaks) is no noise; one misread character is corrected but does not make a text noisy; hyphens of
compounds stay; words of more than ``LONGEST`` letters stand as they are; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkmill.llm.batches import run_of_texts
from silkmill.llm.lookalikes import LOOKALIKES, plain_forms, quick_form
from silkmill.llm.tokens import NUMBER, Tokens, bucket, pair_hash, summed_tables, texts_of, word_hash

UNI_BITS, PAIR_BITS, CENTER_BITS, CONTEXT_BITS, DIM = 20, 21, 15, 8, 16

# Ideographs that scanning confuses, in either direction.
GLYPHS = (
    "休体 耆者 痛病 珍诊 朋期 皿血 太大 捡检 當常 咏脉 氷水 夭天 曰日 人入 千干 卞下 復腹 淸清 末未 自白 申甲 庄压 闻间 "
    "己已 巳已 土士 木本 十千 王玉 日目 田由 刀力 大犬 问间 冶治 侯候 今令 兔免 拨拔 折析 淮准 住往 徙徒 戍戌 晴睛 密蜜 辩辨 "
    "壮状 侍待 坏环 贝见 厂广 几儿 乌鸟 师帅 处外 失矢 夫天 午牛 丁于 子于 人八 口囗 门们 洒酒 楝炼 鸣呜 暧暖 梢稍 孑子 拆折"
).split()
# How scanning misreads Latin letters, from what is read to what stands there.
LATIN_EDITS = (("5", "s"), ("1", "l"), ("0", "o"), ("c", "e"), ("l", "i"), ("ii", "u"), ("rn", "m"), ("b", "h"), ("1", "i"), ("vv", "w"), ("cl", "d"), ("q", "g"), ("f", "t"), ("9", "g"), ("6", "b"))
# Letters read in place of digits.
DIGIT_EDITS = {"l": "1", "I": "1", "O": "0", "o": "0"}

#: The least cosine of the vectors of linked words, and the longest word that glyph edits are looked for in.
AGREE, LONGEST = 0.2, 40
#: A correction must be so many times likelier (logarithm) than the text as it stands.
ODDS = 3.5
RATIO = 20.0


def _alternatives() -> list[np.ndarray]:
    """For each ideograph up to three that it may stand for, 0 where there are fewer."""
    out = [np.zeros(0x10000, np.uint32) for _ in range(3)]
    for a, b in (p for pair in GLYPHS for p in ((pair[0], pair[1]), (pair[1], pair[0]))):
        level = next((t for t in out if t[ord(a)] in (0, ord(b))), None)
        if level is not None:
            level[ord(a)] = ord(b)
    return out


def _centers(points: np.ndarray, t: Tokens, involved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words that links can concern, with their first and last token: pairs with a confusable
    ideograph, and Latin words."""
    head = points[t.start]
    wide = involved[np.minimum(head, 0xFFFF)] & ~t.word
    together = np.flatnonzero((wide[:-1] | wide[1:]) & (t.row[:-1] == t.row[1:])) if len(head) > 1 else np.zeros(0, np.int64)
    single = np.flatnonzero(t.word & (t.hash != NUMBER) & (t.end - t.start > 2))
    hashes = np.concatenate([pair_hash(t.hash[together], t.hash[np.minimum(together + 1, len(head) - 1)]), t.hash[single]])
    return hashes, np.concatenate([together, single]), np.concatenate([together + 1, single])


def twin_hash(hashes: np.ndarray) -> np.ndarray:
    """A second hash of words: the lesser of two counts is hardly ever another word's."""
    return (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)


def _counter() -> Callable[[pa.Array, list[np.ndarray]], None]:
    involved = np.zeros(0x10000, bool)
    for pair in GLYPHS:
        involved[[ord(c) for c in pair]] = True

    def add(column: pa.Array, tables: list[np.ndarray]) -> None:
        points, _, t = texts_of(column)
        if not len(t.hash):
            return
        uni, twin, pair, near = tables
        uni += np.bincount(bucket(t.hash, UNI_BITS), minlength=len(uni))
        twin += np.bincount(bucket(twin_hash(t.hash), UNI_BITS), minlength=len(twin))
        same = t.row[1:] == t.row[:-1]
        pair += np.bincount(bucket(pair_hash(t.hash[:-1], t.hash[1:])[same], PAIR_BITS), minlength=len(pair))
        hashes, first, last = _centers(points, t, involved)
        center, context = bucket(hashes, CENTER_BITS) << CONTEXT_BITS, bucket(t.hash, CONTEXT_BITS)
        for at in (first - 2, first - 1, last + 1, last + 2):
            inside = np.clip(at, 0, len(context) - 1)
            ok = (at == inside) & (t.row[inside] == t.row[first])
            np.add.at(near, center[ok] + context[inside[ok]], 1)  # the table is large, a batch touches little of it

    return add


def context_vectors(near: np.ndarray, dim: int = DIM, negative: float = 5.0, rounds: int = 40, seed: int = 7) -> np.ndarray:
    """Vectors of the columns of a table of (word, context) counts, by skip-gram with negative sampling.

    The loss of sampling contexts from the corpus depends on the counts alone, so its expectation is
    descended directly; each word weighs the same, so rare words are learnt from as well as frequent ones.
    """
    total = near.sum(axis=1, keepdims=True)
    used = np.flatnonzero(total[:, 0] > 0)
    rng = np.random.default_rng(seed)
    words = rng.normal(0, 0.1, (len(used), dim)).astype(np.float32)
    contexts = rng.normal(0, 0.1, (near.shape[1], dim)).astype(np.float32)
    if not len(used):
        return contexts
    observed = near[used] / total[used]
    noise = near.sum(axis=0, keepdims=True) ** 0.75
    noise = (negative * noise / noise.sum()).astype(np.float32)
    moments = [np.zeros_like(words), np.zeros_like(words), np.zeros_like(contexts), np.zeros_like(contexts)]
    for step in range(1, rounds + 1):
        pull = 1.0 / (1.0 + np.exp(-(words @ contexts.T)))
        error = observed - pull * (observed + noise)
        grads = (error @ contexts, error.T @ words * (64.0 / len(used)))
        for table, grad, m, v in ((words, grads[0], *moments[:2]), (contexts, grads[1], *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            table += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return contexts


def word_vectors(near: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, contexts) of a table of (word, context) counts: unit vectors of the rows, the sums of their contexts'
    vectors, and these, taken from the mean of all contexts, so that words without anything in common are at right
    angles. Zero for words without context."""
    contexts, total = context_vectors(near, rounds=rounds), near.sum(axis=0)
    contexts = contexts - (total / max(float(total.sum()), 1.0)) @ contexts
    return _unit(near @ contexts), contexts.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-6)).astype(np.float32)


@dataclass
class Lexicon:
    """Counts of words and word pairs of the corpus and the vectors of confusable words; of fixed size."""

    uni: np.ndarray
    twin: np.ndarray
    pair: np.ndarray
    vectors: np.ndarray
    contexts: np.ndarray
    alternatives: list[np.ndarray] = field(default_factory=_alternatives, repr=False)
    total: float = 0.0
    cache: dict[str, list[tuple[str, int, np.uint64]]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.total = float(self.uni.sum())

    def state(self) -> tuple:
        return self.uni, self.twin, self.pair, self.vectors, self.contexts

    def words(self, hashes: np.ndarray) -> np.ndarray:
        return np.minimum(self.uni[bucket(hashes, UNI_BITS)], self.twin[bucket(twin_hash(hashes), UNI_BITS)])

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.pair[bucket(pair_hash(first, second), PAIR_BITS)]

    def word(self, word: str) -> float:
        return float(self.words(np.array([word_hash(word)], np.uint64))[0])

    def together(self, first: str, second: str) -> float:
        return float(self.pairs(np.array([word_hash(first)], np.uint64), np.array([word_hash(second)], np.uint64))[0])

    def around(self, t: Tokens, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Vectors of single occurrences of words, from their first to their last token."""
        context = bucket(t.hash, CONTEXT_BITS)
        sums = np.zeros((len(first), self.contexts.shape[1]), np.float32)
        for at in (first - 2, first - 1, last + 1, last + 2):
            inside = np.clip(at, 0, len(context) - 1)
            ok = (at == inside) & (t.row[inside] == t.row[first])
            sums[ok] += self.contexts[context[inside[ok]]]
        return _unit(sums)

    def nearness(self, old: np.ndarray, new: np.ndarray, here: np.ndarray) -> np.ndarray:
        """The cosine of words' vectors with those of the words they may stand for: of all their occurrences or of the one
        that ``here`` is the vector of, whichever is greater."""
        target = self.vectors[bucket(new, CENTER_BITS)]
        return np.maximum((self.vectors[bucket(old, CENTER_BITS)] * target).sum(axis=1), (here * target).sum(axis=1))

    def agree(self, old: np.ndarray, new: np.ndarray, here: np.ndarray) -> np.ndarray:
        """The words stand in like contexts."""
        return self.nearness(old, new, here) > AGREE

    def misread_ideographs(self, points: np.ndarray, t: Tokens) -> list[tuple[int, str]]:
        """(token, what stands there) of the characters that another one fits far better between its neighbours.

        A lone l, I or O between numbers counts as an ideograph here, with a number as its other reading.
        """
        hashes = t.hash.copy()
        n = len(hashes)
        head = points[t.start]
        small = np.minimum(head, 0xFFFF)
        lone = t.end - t.start == 1
        as_digit = lone & np.isin(head, np.array([ord(c) for c in DIGIT_EDITS], np.uint32))
        candidates = np.flatnonzero((self.alternatives[0][small] > 0) & ~t.word | as_digit)
        if not len(candidates):
            return []
        before, after = np.maximum(candidates - 1, 0), np.minimum(candidates + 1, n - 1)
        has_before = (before < candidates) & (t.row[before] == t.row[candidates])
        has_after = (after > candidates) & (t.row[after] == t.row[candidates])
        found: dict[int, str] = {}
        for _ in range(2):  # the second time with the neighbours corrected
            best = np.full(len(candidates), ODDS)
            choice = np.zeros(len(candidates), np.uint32)
            now_left = np.where(has_before, self.pairs(hashes[before], hashes[candidates]), 0.0)
            now_right = np.where(has_after, self.pairs(hashes[candidates], hashes[after]), 0.0)
            now = np.log((now_left + 0.5) * (now_right + 0.5))
            for table in self.alternatives:
                other = np.where(as_digit[candidates], np.uint32(ord("0")), table[small[candidates]])
                k = np.flatnonzero(other)
                left, right = hashes[before[k]], hashes[after[k]]
                old, new = hashes[candidates[k]], np.where(as_digit[candidates[k]], NUMBER, other[k].astype(np.uint64))
                then_left = np.where(has_before[k], self.pairs(left, new), 0.0)
                then_right = np.where(has_after[k], self.pairs(new, right), 0.0)
                odds = np.log((then_left + 0.5) * (then_right + 0.5)) - now[k]
                ok = np.flatnonzero((odds > best[k]) & (np.maximum(then_left, then_right) >= 4))
                k, odds = k[ok], odds[ok]
                here = candidates[k]
                linked = as_digit[here].copy()
                linked |= (then_left[ok] > now_left[k]) & self.agree(pair_hash(left[ok], old[ok]), pair_hash(left[ok], new[ok]), self.around(t, before[k], here))
                linked |= (then_right[ok] > now_right[k]) & self.agree(pair_hash(old[ok], right[ok]), pair_hash(new[ok], right[ok]), self.around(t, here, after[k]))
                k, odds = k[linked], odds[linked]
                best[k], choice[k] = odds, other[k]
            changed = np.flatnonzero(choice)
            for k in changed:
                i = int(candidates[k])
                found[i] = DIGIT_EDITS[chr(int(head[i]))] if as_digit[i] else chr(int(choice[k]))
                hashes[i] = NUMBER if as_digit[i] else np.uint64(choice[k])
            if not len(changed):
                break
            # a candidate is looked at again if a neighbour was corrected
            at = candidates[changed]
            again = np.isin(candidates, np.concatenate([at - 1, at + 1])) & (choice == 0)
            candidates, before, after, has_before, has_after = (x[again] for x in (candidates, before, after, has_before, has_after))
            if not len(candidates):
                break
        return sorted(found.items())

    def fit_around(self, t: Tokens, at: np.ndarray, read: np.ndarray) -> np.ndarray:
        """False for the words at the tokens ``at`` that are likelier beside their neighbours as they are than read as those
        with the hashes ``read``, by ``ODDS`` and with this occurrence left out: a rare word that belongs there stays."""
        fixed = t.hash.copy()
        fixed[at] = read
        before, after = np.maximum(at - 1, 0), np.minimum(at + 1, len(fixed) - 1)
        has_before = (before < at) & (t.row[before] == t.row[at])
        has_after = (after > at) & (t.row[after] == t.row[at])
        now_left = np.where(has_before, np.maximum(self.pairs(t.hash[before], t.hash[at]) - 1, 0), 0.0)
        now_right = np.where(has_after, np.maximum(self.pairs(t.hash[at], t.hash[after]) - 1, 0), 0.0)
        then_left = np.where(has_before, self.pairs(fixed[before], fixed[at]), 0.0)
        then_right = np.where(has_after, self.pairs(fixed[at], fixed[after]), 0.0)
        return np.log((then_left + 0.5) * (then_right + 0.5)) + ODDS >= np.log((now_left + 0.5) * (now_right + 0.5))

    def readings(self, word: str) -> list[tuple[str, int, np.uint64 | None]]:
        """What a rare word may have been misread from: a frequent word, the number of misread characters and its hash; a
        number has no hash. Empty: it stands."""
        if word not in self.cache:
            if len(self.cache) > 500_000:
                self.cache.clear()
            self.cache[word] = self._readings(word)
        return self.cache[word]

    def _readings(self, word: str) -> list[tuple[str, int, np.uint64 | None]]:
        letters = [c for c in word if not c.isdigit()]
        if len(letters) < len(word) and letters and all(c in DIGIT_EDITS for c in letters):
            if self.word(word.lower()) * RATIO < float(self.words(np.array([NUMBER]))[0]):
                return [("".join(DIGIT_EDITS.get(c, c) for c in word), len(letters), None)]
            return []
        low = word.lower()
        if mixed := _NUMBER_AND_UNIT.fullmatch(word):
            number, unit = mixed.groups()
            wrong = [c for c in number if c in DIGIT_EDITS]
            fixed = "".join(DIGIT_EDITS.get(c, c) for c in number) + unit
            if wrong and len(wrong) < len(number) and self.word(fixed.lower()) >= 8 and self.word(fixed.lower()) > RATIO * self.word(low):
                return [(fixed, len(wrong), None)]
        if len(low) < 3 or len(low) > LONGEST or not letters:
            return []
        name = int(word[0].isupper())  # a capital is not misread like its small letter
        tried, level = {low: 0}, [low]
        for edits in (1, 2, 3):
            level = [w[:k] + new + w[k + len(old) :] for w in level for old, new in LATIN_EDITS for k in range(name, len(w)) if w.startswith(old, k)]
            level = [w for w in dict.fromkeys(level) if w not in tried]
            tried |= dict.fromkeys(level, edits)
        others = [w for w in tried if w != low]
        if not others:
            return []
        hashes = texts_of(pa.array([low, *others]))[2].hash
        counts = self.words(hashes)
        fits = np.flatnonzero((counts[1:] >= 8 + 2e-6 * self.total) & (counts[1:] > RATIO * counts[0]))
        return [(others[k].capitalize() if word[0].isupper() else others[k], tried[others[k]], hashes[1 + k]) for k in fits]

    def misread_words(self, points: np.ndarray, t: Tokens) -> list[tuple[int, str, int]]:
        """(token, what stands there, misread characters) of the rare Latin words that are linked to a frequent one."""
        words = np.flatnonzero(t.word & (t.end - t.start > 1) & (t.hash != NUMBER))
        rare = words[self.words(t.hash[words]) < self.total * 2e-5 + 50]
        spelled = lambda i: points[t.start[i] : t.end[i]].tobytes().decode("utf-32-le")
        unique, first = np.unique(t.hash[rare], return_index=True)
        some = [h for h, k in zip(unique, first, strict=True) if self.readings(spelled(rare[k]))]
        if not some:
            return []
        at = [(int(i), r) for i in rare[np.isin(t.hash[rare], np.array(some, np.uint64))] for r in self.readings(spelled(i))]
        if not at:
            return []
        token = np.array([i for i, _ in at])
        number = np.array([r[2] is None for _, r in at])
        new = np.array([word_hash(r[0].lower()) if r[2] is None else r[2] for _, r in at], np.uint64)
        here = self.around(t, token, token)
        kept = number | self.agree(t.hash[token], new, here)
        near = self.nearness(t.hash[token], new, here)
        best: dict[int, int] = {}
        for k in np.flatnonzero(kept):
            i, (_, edits, _) = at[k]
            if i not in best or (-edits, near[k]) > (-at[best[i]][1][1], near[best[i]]):
                best[i] = int(k)
        chosen = np.array(sorted(best.values()), np.int64)
        if not len(chosen):
            return []
        fit = self.fit_around(t, token[chosen], new[chosen])
        return [(at[k][0], at[k][1][0], at[k][1][1]) for k in chosen[fit]]


def fit_lexicon(texts: DataFrame) -> Lexicon:
    """From all rows of the column ``text``."""
    uni, twin, pair, near = summed_tables(texts, [1 << UNI_BITS, 1 << UNI_BITS, 1 << PAIR_BITS, 1 << (CENTER_BITS + CONTEXT_BITS)], _counter())
    near = near.reshape(1 << CENTER_BITS, 1 << CONTEXT_BITS)
    return Lexicon(uni, twin, pair, *word_vectors(near))


_NUMBER_AND_UNIT = re.compile(r"([0-9lIOo]+)([a-z]*)")
_NUMBERS = r"(\d{1,5})"
_PAGE_FORM = re.compile(
    r"(?<!\S)(?:"
    rf"第\s?{_NUMBERS}\s?页(?:\s{{0,2}}共\s?\d{{1,5}}\s?页)?"
    rf"|(?:[Pp]age|Seite|[Pp]\.|S\.)\s{_NUMBERS}(?:\s(?:of|sur|von|de|/)\s\d{{1,5}})?"
    rf"|[-–—]\s?{_NUMBERS}\s?[-–—]"
    rf"|\[\s?{_NUMBERS}\s?\]"
    rf"|·\s?{_NUMBERS}\s?·"
    rf"|{_NUMBERS}\s?/\s?\d{{1,5}}"
    r")(?!\S)"
)
_DIGIT = re.compile(r"\d")
_BARE = re.compile(r"(?<!\S)\d{1,5}(?!\S)")
_BROKEN = re.compile(r"([A-Za-zÀ-ɏ]+)([-¬‐­])([ \n\r]+)([A-Za-zÀ-ɏ]+)")
_TOKEN = re.compile(r"[A-Za-zÀ-ɏ0-9]+|\S")
_SENTENCE_END = "。！？；.!?:：”\""
_LIST_ITEM = re.compile(r"\s*(?:[-*•]\s|\d{1,3}[.、)）]|[（(]\d{1,3}[)）])")


def _last_token(text: str) -> str | None:
    part = text[-80:].rstrip()
    m = None
    for m in _TOKEN.finditer(part):  # noqa: B007
        pass
    return m.group() if m else None


def _first_token(text: str) -> str | None:
    m = _TOKEN.search(text[:80])
    return m.group() if m else None


@dataclass
class Repairer:
    """``titles``: chapter names that many rows share; the page, the book's name and its other names come with each row."""

    lexicon: Lexicon
    titles: list[str]
    find_titles: re.Pattern | None = None

    def __post_init__(self) -> None:
        names = sorted({t for t in self.titles if len(t) > 1}, key=lambda t: (-len(t), t))
        self.find_titles = re.compile("|".join(re.escape(t) for t in names)) if names else None

    def may_hold_furniture(self, text: str, page: int | None, named: tuple[str, ...], other_digits: bool) -> bool:
        """No text in which ``furniture`` finds anything fails this; ``other_digits``: it has digits of another script."""
        if other_digits or (_DIGIT.search(text) if page is None else str(page) in text):
            return True
        if any(len(name) > 1 and all(w in text for w in name.split(" ")) for name in named):
            return True
        return bool(self.find_titles and self.find_titles.search(text))

    def _fits(self, text: str, start: int, end: int, number: bool) -> bool:
        """What stands around a span belongs together, as far as the corpus shows, and the span doesn't belong to it."""
        before, after = _last_token(text[:start]), _first_token(text[end:])
        inner_first, inner_last = _first_token(text[start:end]), _last_token(text[start:end])
        lex = self.lexicon
        alone = text[:start].rstrip(" ")[-1:] in ("", "\n") and text[end:].lstrip(" ")[:1] in ("", "\n")
        if before is None or after is None:
            if not number:
                return alone or before is None or before in _SENTENCE_END or not before.isascii() or before.isdigit()
            if before is None:
                return alone or lex.together("1", after) * 20 < lex.word(after)
            return (alone or before in _SENTENCE_END) and lex.together(before, "1") * 12 < lex.word(before) or (alone and before in _SENTENCE_END)
        if before in "-¬‐\u00ad" and text[:start].rstrip()[-2:-1].isalpha() and after[0].islower():
            return True  # it stands inside a word broken at the line end
        joined = lex.together(before, after)
        kept = min(lex.together(before, inner_first), lex.together(inner_last, after))
        if alone and not number:
            return True
        if alone and before in _SENTENCE_END and lex.together(before, after) >= 1:
            return True
        return joined >= 3 and joined > 8 * kept

    def furniture(self, text: str, page: int | None, *named: str | None) -> list[tuple[int, int]]:
        """Spans of running headers, footers and page numbers; ``named``: the book's name and chapter names of its own."""
        plain = text
        spans: list[tuple[int, int]] = []
        for m in _PAGE_FORM.finditer(plain):
            n = int(next(g for g in m.groups() if g))
            if page is None or n == page:
                spans.append(m.span())
        names = [(m.start(), m.end()) for m in self.find_titles.finditer(plain)] if self.find_titles else []
        for name in named:
            if not name or len(name) < 2:
                continue
            at = plain.find(name)
            while at >= 0:
                names.append((at, at + len(name)))
                at = plain.find(name, at + len(name))
            if " " in name and all(w in plain for w in name.split(" ")):  # its line may have been broken, or its words parted
                names += [m.span() for m in re.finditer(r"\s+".join(map(re.escape, name.split(" "))), plain)]
        for start, end in names:
            numbered = False
            before = re.search(r"(?<!\S)(\d{1,5})\s{2,4}\Z", plain[max(0, start - 12) : start])
            after = re.match(r"\s{2,4}(\d{1,5})(?!\S)", plain[end : end + 12])
            if before and (page is None or int(before.group(1)) == page):
                start, numbered = start - len(before.group()), True
            if after and (page is None or int(after.group(1)) == page):
                end, numbered = end + len(after.group()), True
            isolated = plain[start - 1 : start].strip() == "" and plain[end : end + 1].strip() == ""
            if isolated and (numbered or self._fits(text, start, end, False)):
                spans.append((start, end))
        if page is not None:
            taken = spans
            for m in _BARE.finditer(plain):
                if int(m.group()) == page and not any(a <= m.start() < b for a, b in taken) and self._fits(text, *m.span(), True):
                    spans = [*spans, m.span()]
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def is_broken(self, left: str, mark: str, right: str) -> bool:
        """``left`` and ``right`` are parts of one word, not of a compound."""
        if mark != "-":
            return True
        lex, joined = self.lexicon, (left + right).lower()
        a, b, whole = lex.word(left.lower()), lex.word(right.lower()), lex.word(joined)
        if whole >= 4 and whole * 20 >= min(a, b):
            return True
        return min(a, b) < 20 and right[0].islower() and a < 200

    def repair(self, text: str, page: int | None, named: tuple[str, ...], misread: list[tuple[int, int, str]]) -> tuple[str, int, int]:
        """(repaired text, broken words, pieces of furniture); ``misread``: spans of the text and what they read."""
        spans = self.furniture(text, page, *named)
        changes = [(a, b, "\x00" if text[a - 1 : a] == "\n" or text[b : b + 1] == "\n" else " ") for a, b in spans]
        changes += [(a, b, new) for a, b, new in misread if not any(x < b and a < y for x, y in spans)]
        parts, at = [], 0
        for a, b, new in sorted(changes):
            parts += [text[at:a], new]
            at = b
        out = "".join(parts) + text[at:]
        # a removed line leaves its line break: one of the two goes
        out = re.sub(r"[ ]*\n?\x00[ ]*\n?", "\n", out).strip("\n") if spans else out
        broken = 0

        def join(m: re.Match) -> str:
            nonlocal broken
            if self.is_broken(m.group(1), m.group(2), m.group(4)):
                broken += 1
                return m.group(1) + m.group(4)
            return m.group()

        out = _BROKEN.sub(join, out)
        return reflow(out), broken, len(spans)


def reflow(text: str) -> str:
    """The lines of a paragraph on one line; blank lines, list items and short table rows keep their own."""
    lines = text.split("\n")
    out = [lines[0].strip(" ")]
    for line in lines[1:]:
        last = out[-1]
        line = line.strip(" ")
        keeps = not last or not line or last[-1] in _SENTENCE_END or _LIST_ITEM.match(line) or (len(last) < 8 and len(line) < 8)
        if keeps:
            out.append(line)
        else:
            wide = last[-1] > "⺀" or line[0] > "⺀"
            out[-1] = last + ("" if wide else " ") + line
    return re.sub(r"(?<=[⺀-鿿。，；：！？、]) (?=[⺀-鿿，。；：！？、])", "", "\n".join(out)).strip()


def _odd() -> np.ndarray:
    """Of each code point: text with it may not be in one form. Characters beyond the first plane count as U+FFFF."""
    out = np.zeros(0x10000, bool)
    out[[c for c in plain_forms() if c < 0x10000] + [ord(c) for c in LOOKALIKES] + [0x200D, 0xFFFF, *range(0x300, 0x370)]] = True
    return out


def _other_digits() -> np.ndarray:
    """Of each code point: a decimal digit of another script. Characters beyond the first plane count as U+FFFF, which may be one."""
    out = np.zeros(0x10000, bool)
    out[[c for c in range(0x80, 0x10000) if chr(c).isdecimal()] + [0xFFFF]] = True
    return out


_ODD, _OTHER_DIGITS = _odd(), _other_digits()


def _in_one_form(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with compatibility forms, invisible characters and look-alike letters brought to one form, where there are any."""
    points, starts = run_of_texts(batch.column(2))
    odd = _ODD[np.minimum(points, 0xFFFF)]
    rows = np.unique(np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1)
    if not len(rows):
        return batch
    texts = batch.column(2).to_pylist()
    for row in rows:
        texts[row] = quick_form(texts[row])
    return batch.set_column(2, "text", pa.array(texts, pa.string()))


def _repairer(shared: object, excluded: Callable[[], Callable[[str, str], bool]] | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["field", "row_id", "repaired", "broken", "furniture", "misread"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, titles = shared.value
        lexicon = Lexicon(*state)
        repairer = Repairer(lexicon, [quick_form(t) for t in titles])
        one_form = lru_cache(10_000)(quick_form)  # names are searched in texts of one form
        test = excluded() if excluded else None
        for stored in batches:
            batch = _in_one_form(stored)
            points, starts, t = texts_of(batch.column(2))
            if not len(t.hash):
                continue
            fixes: dict[int, list[tuple[int, int, str]]] = {}

            def note(i: int, new: str, n: int) -> None:
                row = int(t.row[i])
                fixes.setdefault(row, []).append((int(t.start[i] - starts[row]), int(t.end[i] - starts[row]), new))
                amount[row] = amount.get(row, 0) + n

            amount: dict[int, int] = {}
            for i, new in lexicon.misread_ideographs(points, t):
                note(i, new, 1)
            for link in lexicon.misread_words(points, t):
                note(*link)
            marks = np.flatnonzero(np.isin(points, np.array([ord(c) for c in "-¬‐­"], np.uint32)))
            spaced = marks[(marks + 1 < len(points)) & np.isin(points[np.minimum(marks + 1, len(points) - 1)], np.array([32, 10, 13], np.uint32))]
            look = set((np.searchsorted(starts, spaced, side="right") - 1).tolist()) | set(fixes)
            others = np.zeros(len(starts), bool)
            others[np.searchsorted(starts, np.flatnonzero(_OTHER_DIGITS[np.minimum(points, 0xFFFF)]), side="right") - 1] = True
            named = [tuple(one_form(n) for n in (book, *(own or ())) if n) for book, own in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            for row, (text, page) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if row not in look and repairer.may_hold_furniture(text, page, named[row], bool(others[row])):
                    look.add(row)
            if not look:
                continue
            at = sorted(look)
            few = batch.take(pa.array(at))
            rows = []
            as_stored = stored.column(2).take(pa.array(at)).to_pylist()
            for row, raw, name, key, text, page in zip(at, as_stored, *(few.column(k).to_pylist() for k in range(4)), strict=True):
                out, broken, spans = repairer.repair(text, page, named[row], fixes.get(row, []))
                misread = amount.get(row, 0)
                if (broken or spans or misread > 1) and not (test is not None and test(name, raw)):
                    rows.append((name, key, out, broken, spans, misread))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names=names)

    return run


def shared_titles(titled: DataFrame, column: str, share: float = 0.001) -> list[str]:
    """Chapter names on at least ``share`` of all rows that have one: at most 1/share names, whatever the input.

    They are looked for in every row; the others are ``titles_by_book``.
    """
    counts = titled.where(F.length(F.trim(column)) > 1).groupBy(F.trim(column).alias("title")).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return sorted(r["title"] for r in counts.where(F.col("count") >= max(2.0, share * total)).collect())


def titles_by_book(titled: DataFrame, column: str, shared: list[str]) -> DataFrame:
    """(book_id, own_titles): each book's chapter names that are not among ``shared``; no row for a book without any."""
    name = F.trim(column)
    rest = titled.select("book_id", name.alias("title")).where((F.length("title") > 1) & F.col("book_id").isNotNull())
    if shared:
        rest = rest.where(~F.col("title").isin(shared))
    return rest.groupBy("book_id").agg(F.sort_array(F.collect_set("title")).alias("own_titles"))


def repair_scans(pages: DataFrame, lexicon: Lexicon, titles: list[str], excluded: Callable[[], Callable[[str, str], bool]] | None = None) -> DataFrame:
    """(field, row_id, repaired, broken, furniture, misread) of the noisy rows of (field, row_id, text, page, book).

    A column ``own_titles``, if there is one, has chapter names to look for in that row besides ``titles``.
    ``excluded`` makes a test (field, text) of rows to leave out. One narrow pass.
    """
    shared = pages.sparkSession.sparkContext.broadcast((lexicon.state(), titles))
    pages = pages.where(F.length("text") > 0)
    own = F.col("own_titles") if "own_titles" in pages.columns else F.lit(None).cast("array<string>").alias("own_titles")
    return pages.select("field", "row_id", "text", F.col("page").cast("int").alias("page"), "book", own).mapInArrow(_repairer(shared, excluded), "field string, row_id long, repaired string, broken int, furniture int, misread int")
