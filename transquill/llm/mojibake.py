"""Problem 3: text that was decoded with the wrong encoding.

Character trigram counts of all clean records make a smoothed model. Each suspect passage goes through every chain of
(wrong decoder, right encoding); the likeliest result is taken if it beats the text as it stands by a margin, which is
validated on all clean records, garbled on purpose; each half of them is tried with the counts of the other.

Defined results: a null or blank text gives no row; a passage whose letters are gone for good (substitute signs) counts
as garbled and is kept as it is; without clean records (empty table) only byte-exact UTF-8 repairs are judged.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.llm.rows import collected, has_text, map_batches, map_columns, map_rows, stored

# Encodings in which UTF-8 was read by mistake, and encodings of the originals.
DECODERS = ["cp1252", "cp850", "cp437", "mac_roman", "cp1251", "cp1253", "cp1250", "cp1256", "cp866", "koi8-r"]
ORIGINALS = ["cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic", "cp1256", "iso8859-6", "cp874", "shift_jis", "cp932", "euc-jp", "gb18030", "big5", "euc-kr", "cp1253"]
LATIN = ["cp1252", "cp850", "cp437", "mac_roman"]
CYRILLIC = ["cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic"]
# End of fixed values.

BITS3, BITS2, BITS1 = 20, 18, 16
#: Weight of the lower order, in counts.
PRIOR = 4.0
#: Most passes of wrong decoding that are undone.
DEPTH = 3


@lru_cache(None)
def high(codec: str) -> dict[int, str]:
    """What the bytes from 0x80 are read as; bytes without a character become the control character of that number."""
    return {b: bytes([b]).decode(codec, "ignore") or chr(b) for b in range(0x80, 0x100)}


@lru_cache(None)
def table(codec: str) -> dict[int, int]:
    """For str.translate: from the wrong characters to characters numbered as the bytes."""
    out = {ord(c): b for b, c in high(codec).items()}
    if codec == "cp1252":  # it is often mixed with Latin-1
        out |= {b: b for b in range(0x80, 0xA0)}
    return out


def unread(text: str, codec: str) -> bytes | None:
    """The bytes that codec read as text."""
    try:
        return text.translate(table(codec)).encode("latin-1")
    except UnicodeEncodeError:
        return None


def read_wrongly(text: str, original: str, decoder: str) -> str | None:
    """What text looks like when its bytes are read by decoder."""
    try:
        data = text.encode(original)
    except UnicodeEncodeError:
        return None
    return "".join(chr(b) if b < 0x80 else high(decoder)[b] for b in data)


def some(chars: str) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


#: Byte ranges of the UTF-8 sequences of the letters and signs that are restored, as (first, second, number of the rest).
SEQUENCES = [(0xC2, 0xC5, 0x80, 0xBF, 0), (0xCC, 0xCC, 0x80, 0xBF, 0), (0xD0, 0xD0, 0x80, 0xBF, 0), (0xD1, 0xD1, 0x80, 0x9F, 0), (0xD8, 0xD9, 0x80, 0xBF, 0), (0xE0, 0xE0, 0xA4, 0xA5, 1), (0xE0, 0xE0, 0xB8, 0xB9, 1), (0xE2, 0xE2, 0x80, 0x9F, 1), (0xE3, 0xE3, 0x80, 0x83, 1), (0xE4, 0xE9, 0x80, 0xBF, 1), (0xEF, 0xEF, 0xBB, 0xBF, 1)]


def sequences(codec: str, begun: bool = False) -> str:
    """Pattern of one UTF-8 sequence as codec reads it; begun: after its first character."""
    both = codec == "cp1252"
    of = lambda a, b: some("".join(high(codec)[x] + (chr(x) if both and x < 0xA0 else "") for x in range(a, b + 1)))
    return "|".join((f"(?<={of(a, b)})" if begun else of(a, b)) + of(c, d) + of(0x80, 0xBF) * n for a, b, c, d, n in SEQUENCES)


@lru_cache(None)
def utf8_pattern(codec: str) -> re.Pattern:
    """Matches runs of what codec makes of UTF-8 sequences; as it begins with one set, other characters are passed over fast."""
    return re.compile(f"{some(''.join(sorted(utf8_parts(codec)[0])))}(?:{sequences(codec, begun=True)})(?:{sequences(codec)})*")


@lru_cache(None)
def utf8_parts(codec: str) -> tuple[frozenset[str], frozenset[str]]:
    """Characters that such a sequence begins with, and those that it goes on with."""
    leads = {high(codec)[x] for a, b, *_ in SEQUENCES for x in range(a, b + 1)}
    rests = {high(codec)[x] for x in range(0x80, 0xC0)} | ({chr(x) for x in range(0x80, 0xA0)} if codec == "cp1252" else set())
    return frozenset(leads), frozenset(rests)


LOST = re.compile(r"�|(?<=\w)\?\?+(?=\w)|(?:(?<=[.!?»”]\s)|(?<=\n)|(?<![\s\S]))\?\?+(?=\s[a-zà-ÿ]|[a-zà-ÿ])|(?<=[a-zà-ÿ,] )\?\?(?= [a-zà-ÿ])|(?<=[a-zà-ÿ])\?\?(?=[’'][a-z])")
#: Signs that the letters of one Latin encoding become in another.
ODD_SIGN = "".join(sorted({c for x in LATIN for c in high(x).values() if not c.isalpha() and c not in "«»“”‘’–—…•·°€£¥§©®™¿¡\xa0\xad-" and not "\u0080" <= c <= "\u009f"}))
WORD_SUSPECT = re.compile(f"(?<=[^\\W\\d_]){some(ODD_SIGN + '·‡‰¸ˆ˙˚˘')}|{some(ODD_SIGN)}(?=[^\\W\\d_])|(?<=[a-zß-ÿ])[À-ÞŸŠŒΓ-Ωﬂƒ](?=[a-zß-ÿ])|[\u0080-\u009f]|(?<=[a-zß-ÿ])ﬂ")
RUN = re.compile("[\u0080-¿À-ÿŒœŠšŸŽžƒˆ˜–-›€™]{3,}|[‚ƒ][^\\s]{1,2}[‚ƒ]")
SWAPPED = re.compile("(?<![А-ЯЁа-яё])[а-яё][А-ЯЁ]{1,}(?![а-яё])|[─-■Ђ-Џђ-џ][А-я]|[А-я][─-■Ђ-ЄЅ-Џђ-іј-џ]")
SWAPPED_OR_UPPER = re.compile(SWAPPED.pattern + "|[А-ЯЁ]{3}")
#: Words on end whose case is the wrong way round, or all upper.
SWAP_WORD = "(?:[а-яё][А-ЯЁ]*|[А-ЯЁ]{2,})(?![А-ЯЁа-яё])"
SWAP_RUN = re.compile(f"(?<![А-ЯЁа-яё]){SWAP_WORD}(?:[^А-ЯЁа-яё\\n]{{1,12}}{SWAP_WORD})*")
UPPER_RUN = re.compile("[А-ЯЁ]{3}")
SENTENCE = re.compile(r"[^.!?\n]+")


def spread(ranges: str) -> set[str]:
    """The characters of a class like 'a-zß-ÿ'."""
    out: set[str] = set()
    i = 0
    while i < len(ranges):
        last = ranges[i + 2] if ranges[i + 1 : i + 2] == "-" and i + 2 < len(ranges) else ranges[i]
        out |= {chr(c) for c in range(ord(ranges[i]), ord(last) + 1)}
        i += 3 if last != ranges[i] else 1
    return out


def _gate() -> list[list[set[str]]]:
    """What a text must have to be looked at: one of these runs of one to four characters, each of a set.

    Rare leads, common leads before odd signs, runs of them, swapped case, and question marks in place of letters.
    """
    common = set("àâãäåæçèéêëìíîïñòóôõöùúûüß’‘“”«»–—…°·•€£§©®™¿¡ÀÇÉÖÜÄ") | {chr(c) for c in range(0x400, 0x460)} | {chr(c) for c in range(0x600, 0x700)}
    rare, firm = set(ODD_SIGN) - common, set()
    for codec in DECODERS:
        for a, b, *_ in SEQUENCES:
            for lead in range(a, b + 1):
                (firm if high(codec)[lead] in common else rare).add(high(codec)[lead])
    signs = {high("cp1252")[b] for b in range(0x80, 0xC0)} - {"\xa0"}
    slavic = {high("cp1251")[b] for b in range(0x80, 0xC0)}
    arabic = {c for c in firm if "؀" <= c <= "ۿ"}
    upper, latin = spread("А-ЯЁ"), spread("¡-¿À-ÿ")
    return [
        [rare - set("0123456789") | {"�"} | spread("─-■\u0080-\u009f")], [{"?"}] * 2, [set("àâãäåæçèéï"), signs], [set("ВГДЕЌРС"), slavic], [arabic, spread("\u0080-¿") | set("€‚ƒ„…†‡ˆ‰‹‘’“”•–—™›")], [latin] * 3, [spread("а-яё"), upper], [upper] * 4,
        [spread("a-zß-ÿ"), spread("À-ÞΓ-Ω") | set("Ÿ²³¹÷ﬂ")],
    ]


RUNS_OF = _gate()
#: The same as a pattern.
GATE = "|".join("".join(some("".join(sorted(x))) for x in run) for run in RUNS_OF if all(run))
#: Characters that only look like others; with them a record isn't clean.
LOOKS_LIKE = "\xad\u200b-\u200f\u2060-\u2064\ufeffＡ-ｚﬀ-ﬆ\U0001d400-\U0001d7ff"


def _classes(runs_of: list[list[set[str]]]) -> tuple[np.ndarray, list[tuple[int, list[int]]], int]:
    """For each code point the sets that it is in, as bits; each run as bits, with the number within it of its last set without ASCII letters; the bit of what only looks like others."""
    sets: list[set[str]] = []
    runs = []
    for run in runs_of:
        if all(run):
            for x in run:
                if x not in sets:
                    sets.append(x)
            runs.append((max(k for k, x in enumerate(run) if not any(c.isascii() and c.isalpha() for c in x)), [1 << sets.index(x) for x in run]))
    table = np.zeros(0x110000, np.uint32)
    for i, x in enumerate([*sets, spread(LOOKS_LIKE)]):
        table[[ord(c) for c in x]] |= np.uint32(1 << i)
    return table, runs, 1 << len(sets)


CLASSES, RUN_BITS, ALIKE_BIT = _classes(RUNS_OF)


def begun(bits: np.ndarray, runs: list[tuple[int, list[int]]]) -> np.ndarray:
    """Where the runs begin, in no order; most text is ASCII letters, so only the places of one other set of each run are looked at."""
    rare = 0
    for k, run in runs:
        rare |= run[k]
    at = np.flatnonzero(bits & np.uint32(rare))
    own = bits[at]
    out = []
    for k, run in runs:
        first = at[own & np.uint32(run[k]) != 0] - k
        if len(run) > 1:
            first = first[(first >= 0) & (first <= len(bits) - len(run))]
        for j, x in enumerate(run):
            if j != k:
                first = first[bits[first + j] & np.uint32(x) != 0]
        out.append(first)
    return np.concatenate(out)


def gated(texts: list[str | None], alike: bool = False) -> list[bool]:
    """Which of the texts the gate's pattern matches, or, if asked, have characters that only look like others; all at once."""
    out = [False] * len(texts)
    own = [i for i, t in enumerate(texts) if t and (not t.isascii() or "??" in t)]
    if not own:
        return out
    joined = "\n".join(texts[i] for i in own)
    bits = CLASSES[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    hit = begun(bits, RUN_BITS + ([(0, [ALIKE_BIT])] if alike else []))
    ends = np.cumsum([len(texts[i]) + 1 for i in own])
    for i in np.unique(np.searchsorted(ends, hit, "right")).tolist():
        out[own[i]] = True
    return out


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of every unigram, bigram and trigram."""
    x = codes.astype(np.uint32, copy=False)
    one = x & np.uint32((1 << BITS1) - 1)
    first = x[:-1] * np.uint32(0x85EBCA77) + x[1:] * np.uint32(0xC2B2AE3D)
    two = (first ^ first >> np.uint32(15)) >> np.uint32(3) & np.uint32((1 << BITS2) - 1)
    last = first[:-1] * np.uint32(0x9E3779B1) + x[2:] * np.uint32(0x27D4EB2F)
    three = (last ^ last >> np.uint32(16)) >> np.uint32(2) & np.uint32((1 << BITS3) - 1)
    return one, two, three


#: To the model, quotation marks, dashes and the like are blanks: their use differs between clean writers.
BLANKS = "’‘'“”\"«»„–—…"


def codes(text: str) -> np.ndarray:
    for c in BLANKS:
        text = text.replace(c, " ")
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


#: Signs and letters that any text may hold, seen in clean records or not.
SIGNS = frozenset(c for c in high("cp1252").values() if not "\u0080" <= c <= "\u009f" and c not in "ƒˆ‰˜¦¨¬¯¸\xad")


@dataclass
class Model:
    """Counts by hashed unigram, bigram and trigram; of fixed size whatever the corpus."""

    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    margin: float = 6.0
    total: float = field(init=False)
    _known: dict[str, bool] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.total = float(self.one.sum())

    def known(self, text: str) -> bool:
        """Whether each character occurs in clean text, more often than leaks may account for."""
        for c in text:
            if (k := self._known.get(c)) is None:
                k = self._known[c] = self.total == 0 or ord(c) < 128 or c in SIGNS or bool(self.one[_hashes(np.array([ord(c)] * 3, np.uint32))[0][0]] >= max(3.0, 1e-8 * self.total))
            if not k:
                return False
        return True

    def score(self, text: str) -> float:
        """Log likelihood of text's characters from the third on."""
        if len(text) < 3 or not self.total:
            return 0.0
        one, two, three = _hashes(codes(text))
        p1 = (self.one[one[2:]] + 0.05) / (self.total + 0.05 * (1 << BITS1))
        p2 = (self.two[two[1:]] + PRIOR * p1) / (self.one[one[1:-1]] + PRIOR)
        p3 = (self.three[three] + PRIOR * p2) / (self.two[two[:-1]] + PRIOR)
        return float(np.log(p3).sum())


    def scores(self, texts: list[str]) -> np.ndarray:
        """score() of many texts at once."""
        if not self.total or not texts:
            return np.zeros(len(texts))
        sizes = np.array([len(t) for t in texts])
        data = codes("".join(texts))
        if len(data) < 3:
            return np.zeros(len(texts))
        one, two, three = _hashes(data)
        p1 = (self.one[one[2:]] + 0.05) / (self.total + 0.05 * (1 << BITS1))
        p2 = (self.two[two[1:]] + PRIOR * p1) / (self.one[one[1:-1]] + PRIOR)
        p3 = np.log((self.three[three] + PRIOR * p2) / (self.two[two[:-1]] + PRIOR))
        owner = np.repeat(np.arange(len(texts)), sizes)
        within = owner[:-2] == owner[2:]
        return np.bincount(owner[:-2][within], weights=p3[within], minlength=len(texts))


@dataclass
class Span:
    start: int
    end: int
    text: str | None
    chain: str


WORD = re.compile(r"[^\s.,;:!?()\"]+")
QUOTE_WITHIN = re.compile(r"\w[“”„«»…–¡¿]\w")
STAND_IN = re.compile("[\xad\u200b-\u200f\u2060-\u2064\ufeff\ufb00-\ufb06]")
WORD_START = re.compile(r"[^\s.,;:!?()\"]+$")


@lru_cache(None)
def run_pattern(codec: str, bridge: bool) -> re.Pattern:
    """Runs of a decoder's characters from 0x80; bridge: with ASCII in between, as in the encodings of two bytes."""
    highs = some("".join(map(chr, table(codec))))
    return re.compile(f"{highs}(?:[\\x20-\\x7e\\n]{{0,4}}{highs})*[\\x21-\\x7e]?" if bridge else f"{highs}(?:[\\x20-\\x40\\n]{{0,4}}{highs})*")


def one_script(text: str) -> bool:
    """Whether letters beyond ASCII are of one script family and no ASCII letters stand among them."""
    kinds = {unicodedata.name(c, "?").split(" ", 1)[0].split("-")[0] for c in set(text) if c.isalpha()}
    cjk = {"CJK", "HIRAGANA", "KATAKANA", "FULLWIDTH", "HALFWIDTH", "BOPOMOFO"}
    return len(kinds) == 1 and not kinds <= {"LATIN"} or bool(kinds & {"CJK", "HIRAGANA", "KATAKANA"}) and kinds <= cjk | {"LATIN"} and not re.search("[A-Za-z]", text[:1] + text[-1:])


def ascii_letters(text: str) -> bool:
    return any(c.isascii() and c.isalpha() for c in text)


def letters(text: str) -> int:
    return sum(c.isalpha() or unicodedata.category(c)[0] == "M" for c in text)


def disjoint(found: list[tuple[float, Span]]) -> list[Span]:
    """The likeliest repairs that don't overlap; of equal ones the earlier."""
    taken: list[Span] = []
    full = bytearray(max((s.end for _, s in found), default=0))
    for _, s in sorted(found, key=lambda x: (-x[0], x[1].start, x[1].chain)):
        if full.find(1, s.start, s.end) < 0:
            full[s.start : s.end] = b"\1" * (s.end - s.start)
            taken.append(s)
    return sorted(taken, key=lambda s: s.start)


def blanked(text: str, spans: list[Span]) -> str:
    """The text with blanks in the spans' places."""
    out, at = [], 0
    for s in spans:
        out += [text[at : s.start], " " * (s.end - s.start)]
        at = s.end
    return "".join(out) + text[at:]


class Restorer:
    """Finds garbled passages of a text and restores what can be restored."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.gate = re.compile(GATE)
        self._scores: dict[str, float] = {}
        self._undone: dict[tuple[str, str, int, float], tuple[str, str] | None] = {}
        self._readings: dict[tuple[bytes, tuple[str, ...]], list[tuple[str, str]]] = {}
        self._latin: dict[str, list[tuple[str, str]]] = {}

    def gain(self, text: str, a: int, b: int, new: str) -> float:
        """How much likelier the text gets with new in place of text[a:b]."""
        left, right = text[max(0, a - 3) : a].rjust(2, "\n"), text[b : b + 3]
        return self.score(left + new + right) - self.score(left + text[a:b] + right)

    def score(self, text: str) -> float:
        if len(text) > 64:
            return self.model.score(text)
        if (s := self._scores.get(text)) is None:
            if len(self._scores) > 200_000:
                self._scores.clear()
            s = self._scores[text] = self.model.score(text)
        return s

    def undone(self, codec: str, found: str, depth: int) -> tuple[str, str] | None:
        """What found was before codec read it as UTF-8's bytes, and the chain; kept, as the same few sequences come again."""
        key = codec, found, depth, self.model.margin
        if key in self._undone:
            return self._undone[key]
        if len(self._undone) > 200_000:
            self._undone.clear()
        data, out = unread(found, codec), None
        new = data.decode("utf-8", "ignore") if data else ""
        if new:
            chain = f"utf-8>{codec}"
            if depth > 1 and len(new) > 1:
                for _, inner in sorted(self.utf8(new, depth - 1), key=lambda x: -x[1].start):
                    new, chain = new[: inner.start] + inner.text + new[inner.end :], f"{inner.chain}>{chain}"
            if new != found and self.model.known(new) and not any("\u0080" <= c <= "\u009f" for c in new):
                out = new, chain
        self._undone[key] = out
        return out

    def utf8_changes(self, text: str, depth: int, codecs: list[str]) -> list[Span]:
        """What was UTF-8 before one of the codecs read it."""
        maybe: list[Span] = []
        chars = set(text)
        for codec in codecs:
            leads, rests = utf8_parts(codec)
            if leads.isdisjoint(chars) or rests.isdisjoint(chars) or codec == "cp1250" and maybe:  # all but the same as cp1252
                continue
            for m in utf8_pattern(codec).finditer(text):
                if done := self.undone(codec, m[0], depth):
                    maybe.append(Span(m.start(), m.end(), *done))
        return maybe

    def utf8(self, text: str, depth: int = DEPTH) -> list[tuple[float, Span]]:
        """Byte-exact repairs with their gains; inside another repair the best for each place."""
        maybe = self.utf8_changes(text, depth, DECODERS)
        if not maybe:
            return []
        found: list[tuple[float, Span]] = []
        for s, gain in zip(maybe, self.gains(text, [(s.start, s.end, s.text) for s in maybe])):
            if (gain > self.model.margin / 2 or not self.model.total) and gain > self.plain_gain(text, s.start, s.end):
                found.append((gain, s))
        return found if depth == DEPTH else [(0.0, s) for s in disjoint(found)]

    def gains(self, text: str, changes: list[tuple[int, int, str]]) -> list[float]:
        """gain() of many changes at once."""
        return self.gains_of([(text, *c) for c in changes])

    def gains_of(self, changes: list[tuple[str, int, int, str]]) -> list[float]:
        """gain() of many changes to several texts at once."""
        need: dict[str, float | None] = {}
        pairs = []
        for text, a, b, new in changes:
            left, right = text[max(0, a - 3) : a].rjust(2, "\n"), text[b : b + 3]
            pairs.append((left + new + right, left + text[a:b] + right))
            for t in pairs[-1]:
                need[t] = self._scores.get(t)
        missing = [t for t, s in need.items() if s is None]
        if len(self._scores) > 200_000:
            self._scores.clear()
        for t, s in zip(missing, self.model.scores(missing).tolist()):
            need[t] = s
            if len(t) <= 64:
                self._scores[t] = s
        return [need[x] - need[y] for x, y in pairs]

    def plain_gain(self, text: str, a: int, b: int) -> float:
        """The gain if the passage only lost its invisible characters and joined forms, which is another problem's."""
        if not STAND_IN.search(text, a, b):
            return -1e9
        plain = "".join(c for c in unicodedata.normalize("NFKC", text[a:b]) if unicodedata.category(c) != "Cf")
        return self.gain(text, a, b, plain) if plain != text[a:b] else -1e9

    def readings(self, data: bytes, originals: tuple[str, ...]) -> list[tuple[str, str]]:
        """(encoding, text) of each encoding in which the bytes are words of one script; kept, as several decoders give the same bytes."""
        key = data, originals
        if (out := self._readings.get(key)) is None:
            if len(self._readings) > 50_000:
                self._readings.clear()
            out = self._readings[key] = []
            for y in originals:
                try:
                    new = data.decode(y)
                except UnicodeDecodeError:
                    continue
                if self.model.known(new) and one_script(new) and letters(new) >= max(4, 0.6 * len(new.replace(" ", ""))):
                    out.append((y, new))
        return out

    def passage_changes(self, text: str, suspect: re.Pattern, decoders: list[str], originals: list[str], bridge: bool) -> list[Span]:
        """Runs of characters of one decoder that are words in another encoding."""
        maybe: list[Span] = []
        same = None if bridge else self.runs(text, [*SENTENCE.finditer(text), *SWAP_RUN.finditer(text)], suspect, False)
        for x in decoders:
            for a, b in self.runs(text, run_pattern(x, True).finditer(text), suspect, True) if same is None else same:
                data = unread(text[a:b], x)
                for y, new in self.readings(data, tuple(originals)) if data else ():
                    if y != x and new != text[a:b]:
                        maybe.append(Span(a, b, new, f"{y}>{x}"))
        return maybe

    @staticmethod
    def runs(text: str, found: Iterable[re.Match], suspect: re.Pattern, bridge: bool) -> list[tuple[int, int]]:
        """Where the matches begin and end that are long and suspect, and have no ASCII letters beside them; with and without an ASCII character at the end."""
        out = []
        for m in found:
            if len(m[0]) < 4 or not suspect.search(m[0]):
                continue
            for cut in (0, 1) if bridge and ord(m[0][-1]) < 128 else (0,):
                a, b = m.start(), m.end() - cut
                if not ascii_letters(text[a - 1 : a] + text[b : b + 1]):
                    out.append((a, b))
        return out

    def passages(self, text: str, suspect: re.Pattern, decoders: list[str], originals: list[str], bridge: bool) -> list[tuple[float, Span]]:
        """Runs of characters of one decoder that read better as text of another encoding."""
        maybe = self.passage_changes(text, suspect, decoders, originals, bridge)
        best: list[tuple[float, Span]] = []
        for s, gain in zip(maybe, self.gains(text, [(s.start, s.end, s.text) for s in maybe])):
            # text in capitals is rare, too: it must not be that alone
            if gain > self.model.margin + 0.5 * (s.end - s.start) and (bridge or gain > self.gain(text, s.start, s.end, text[s.start : s.end].lower()) + self.model.margin):
                best.append((gain, s))
        return best

    def latin(self, word: str) -> list[tuple[str, str]]:
        """What a word may be through each other Latin encoding, and the chain; kept if short, as words come again."""
        if (out := self._latin.get(word)) is None:
            if len(self._latin) > 50_000:
                self._latin.clear()
            out = []
            if len(word) <= 64:
                self._latin[word] = out
            for x in LATIN:
                data = unread(word, x)
                for y in LATIN if data else ():
                    new = data.decode("latin-1").translate(high(y))
                    if x != y and new != word and self.model.known(new) and not QUOTE_WITHIN.search(new) and all(c.isalpha() or c in "-'’«»“”¿¡…–" for c in new if ord(c) > 127):
                        out.append((new, f"{y}>{x}"))
        return out

    def word_changes(self, text: str) -> list[Span]:
        """Suspect words as they are through other Latin encodings."""
        maybe: list[Span] = []
        at = 0
        for hit in WORD_SUSPECT.finditer(text):
            if hit.start() < at:
                continue
            a = WORD_START.search(text, max(at, hit.start() - 60), hit.start() + 1)
            m = WORD.match(text, a.start() if a else hit.start())
            if not m or m.end() <= hit.start():
                continue
            at = m.end()
            maybe += [Span(m.start(), at, new, chain) for new, chain in self.latin(m[0])]
        return maybe

    def words(self, text: str) -> list[tuple[float, Span]]:
        """Words of a Latin language that read better through another Latin encoding."""
        maybe = self.word_changes(text)
        gains = self.gains(text, [(s.start, s.end, s.text) for s in maybe])
        fits = [(g, s) for g, s in zip(gains, maybe) if g > 0.5 and g > self.plain_gain(text, s.start, s.end)]
        weight: Counter = Counter()
        for g, s in fits:
            weight[s.chain] += g
        best = [(g, s) for g, s in fits if g > self.model.margin or weight[s.chain] > 1.5 * self.model.margin]
        for chain, n in Counter(s.chain for s in disjoint(best)).most_common():
            if n < 2:
                break
            y, x = chain.split(">")  # the text's other words may have come the same way
            maybe = []
            for m in WORD.finditer(text):
                data = None if m[0].isascii() else unread(m[0], x)
                new = "".join(chr(b) if b < 0x80 else high(y)[b] for b in data) if data else m[0]
                if new != m[0] and self.model.known(new):
                    maybe.append(Span(m.start(), m.end(), new, chain))
            best += [(g, s) for g, s in zip(self.gains(text, [(s.start, s.end, s.text) for s in maybe]), maybe) if g > 0.5]
        return best

    def spans(self, text: str) -> list[Span]:
        """Garbled passages from left to right; text None where nothing can be restored."""
        if not text or text.isascii() and "??" not in text or not self.gate.search(text):
            return []
        return self.judged(text)

    def spans_of(self, texts: list[str]) -> list[list[Span]]:
        """spans() of many texts at once."""
        return [self.judged(t) if hit else [] for t, hit in zip(texts, gated(texts))]

    def restored(self, texts: list[str]) -> list[str]:
        """restore() of many texts at once."""
        return [self.restore(t, spans) for t, spans in zip(texts, self.spans_of(texts))]

    def judged(self, text: str) -> list[Span]:
        """spans() of a text whatever signs it has."""
        found = self.utf8(text)
        rest = blanked(text, disjoint(found))
        if RUN.search(rest):
            found += self.passages(text, RUN, ["cp1252", "cp850", "mac_roman"], ORIGINALS, True)
        if SWAPPED.search(rest) or UPPER_RUN.search(rest):
            found += self.passages(text, SWAPPED_OR_UPPER, CYRILLIC, CYRILLIC, False)
        if WORD_SUSPECT.search(rest):
            found += self.words(text)
        spans = disjoint(found)
        spans += [s for m in (LOST.finditer(text) if "�" in text or "??" in text else ()) if all(m.end() <= t.start or m.start() >= t.end for t in spans) for s in [Span(m.start(), m.end(), None, "lost")]]
        return sorted(spans, key=lambda s: s.start)

    def finds(self, text: str) -> bool:
        """Whether judged() gives any passage."""
        if self.utf8(text) or LOST.search(text):
            return True
        if WORD_SUSPECT.search(text) and self.words(text) or RUN.search(text) and self.passages(text, RUN, ["cp1252", "cp850", "mac_roman"], ORIGINALS, True):
            return True
        return bool((SWAPPED.search(text) or UPPER_RUN.search(text)) and self.passages(text, SWAPPED_OR_UPPER, CYRILLIC, CYRILLIC, False))

    def restore(self, text: str, spans: list[Span] | None = None) -> str:
        spans = self.spans(text) if spans is None else spans
        if not spans:
            return text
        out, at = [], 0
        for s in spans:
            out += [text[at : s.start], text[s.start : s.end] if s.text is None else s.text]
            at = s.end
        return "".join(out) + text[at:]


#: A record is clean if it has no sign of any garbling, and no characters that only look like others.
CLEAN = GATE + f"|[{LOOKS_LIKE}]"


#: First slot of each order in one row of counts, and the marks of passages: as they are, and to be garbled.
FIRST = {1: 0, 2: 1 << BITS1, 3: (1 << BITS1) + (1 << BITS2)}
SLOTS = FIRST[3] + (1 << BITS3)
RIGHT, TO_GARBLE = -1, -2


def slot_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the n-grams of all texts on end, and how many are in each."""
    data = codes("\n\n".join(texts))
    if data.size < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = np.concatenate([np.bincount(of, minlength=1 << bits) for of, bits in zip(_hashes(data), (BITS1, BITS2, BITS3))])
    at = np.flatnonzero(n)
    return at, n[at]


def _gram_counts(texts: list[str]) -> list[tuple[int, int, int]]:
    """(order, slot, n) of the n-grams of all texts on end."""
    return [(order := max(o for o, a in FIRST.items() if a <= at), at - FIRST[order], n) for at, n in zip(*map(np.ndarray.tolist, slot_counts(texts)))]


#: Two characters on each side of a word are what a trigram sees of its neighbours.
REACH = 2
#: Texts whose words are sought at once.
TEXTS = 512
@lru_cache(None)
def letter_kinds() -> np.ndarray:
    """For each code point: 0 no letter, 1 one of ASCII, 2 one beyond."""
    out = np.zeros(0x110000, np.uint8)
    for m in re.finditer(r"[^\W\d_]+", "".join(map(chr, range(0x110000)))):
        out[m.start() : m.end()] = 2
    out[:128] = np.minimum(out[:128], 1)
    return out


def passages_of(texts: list[str]) -> tuple[Counter, Counter]:
    """Each word beyond ASCII with the characters that a trigram sees on its sides, counted; and each text's middle one of them."""
    right: Counter = Counter()
    middle: Counter = Counter()
    edge = "\n" * REACH
    own = [t for t in texts if not t.isascii()]
    for a in range(0, len(own), TEXTS):
        part = own[a : a + TEXTS]
        joined = edge + "".join(t + edge for t in part)
        kinds = letter_kinds()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        turns = np.flatnonzero(np.diff(kinds != 0)) + 1  # the edges are no letters, so words begin and end in turn
        starts, ends = turns[::2], turns[1::2]
        beyond = np.concatenate([[0], np.cumsum(kinds == 2)])
        words = beyond[ends] > beyond[starts]
        starts = starts[words]
        found = [joined[x:y] for x, y in zip((starts - REACH).tolist(), (ends[words] + REACH).tolist())]
        right.update(found)
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + REACH for t in part])).tolist()
        middle.update(found[x + (y - x) // 2] for x, y in zip(bounds, bounds[1:]) if x < y)
    return right, middle


def _count_kernel(columns: list[list]) -> list[list]:
    """(slot, passage, n0, n1) of the clean records: n-grams, and passages to try the margin on, in either half of the records; by column."""
    halves: tuple[list[str], list[str]] = ([], [])
    for h, t, unclean in zip(*columns, gated(columns[1], alike=True)):
        if t and not unclean:
            halves[h & 1].append(t)
    slots: list[np.ndarray] = []
    passages: list[str | None] = []
    counts: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for half, texts in enumerate(halves):
        at, n = slot_counts(texts)
        own = passages_of(texts)
        passages += [None] * len(at) + [p for x in own for p in x]
        slots += [at, *(np.full(len(x), mark) for mark, x in zip((RIGHT, TO_GARBLE), own))]
        n = np.concatenate([n, np.fromiter((k for x in own for k in x.values()), np.int64)])
        counts[half].append(n)
        counts[1 - half].append(np.zeros_like(n))
    return [np.concatenate(slots), passages, *map(np.concatenate, counts)]


def count_clean(texts: DataFrame, column: str = "text") -> DataFrame:
    """(slot, passage, n0, n1) over all clean records; which half a record is in is told by its hash, so copies are in the same."""
    rows = texts.where(has_text(column)).select(F.xxhash64(column).alias("__h"), column)
    counted = map_columns(rows, ["__h", column], lambda: _count_kernel, "slot int, passage string, n0 bigint, n1 bigint")
    return counted.groupBy("slot", "passage").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def held_records(texts: DataFrame, column: str, rows: int) -> dict[int, str]:
    """The whole clean records beyond ASCII with the least hashes, over all rows; by hash, so that copies count once. For trials by hand: fit() takes all records."""
    hashed = texts.where(has_text(column) & F.col(column).rlike(r"[^\x00-\x7f]")).select(F.xxhash64(column).alias("h"), F.col(column).alias("t"))
    least = collected(hashed.orderBy("h", "t").limit(8 * rows))
    held = {h: t for h, t in zip(least["h"].tolist(), least["t"].tolist()) if not re.search(CLEAN, t)}
    if len(held) < rows and len(least["h"]) == 8 * rows:

        def start() -> Callable[..., list[tuple]]:  # clean records are rare here: all rows are looked at
            unclean = re.compile(CLEAN)
            return lambda h, t: [] if unclean.search(t) else [(h, t)]

        least = collected(map_rows(hashed, ["h", "t"], start, "h bigint, t string").distinct().orderBy("h", "t").limit(rows))
        held = dict(zip(least["h"].tolist(), least["t"].tolist()))
    return dict(list(held.items())[:rows])


def model_of_counts(counts: np.ndarray, margin: float = 6.0) -> Model:
    return Model(*(counts[FIRST[order] : FIRST[order] + (1 << bits)].astype(np.float32) for order, bits in ((1, BITS1), (2, BITS2), (3, BITS3))), margin)


def fit(texts: DataFrame, column: str = "text") -> Model:
    """Counts over all clean records, and the margin from all of them: each half is tried with the counts of the other.

    The collected table is bounded: it has at most 2^20 + 2^18 + 2^16 rows, whatever the corpus. Passages stay on the executors.
    """
    counted = stored(count_clean(texts, column))
    rows = collected(counted.where("slot >= 0").select("slot", "n0", "n1"))
    halves = np.zeros((2, SLOTS))
    for half, n in zip(halves, (rows["n0"], rows["n1"])):
        half[rows["slot"]] = n
    tries = tried(counted.where("slot < 0"), [model_of_counts(halves[1]), model_of_counts(halves[0])])
    return model_of_counts(halves[0] + halves[1], best_margin(tries))


#: Passages whose writings are held at once, and characters of changes that are weighed at once.
ROWS, TOGETHER = 4096, 500_000
#: Decoders whose changes show whether one's are looked at: cp1250's only are if those before have none.
BEFORE_OR = {d: DECODERS[: i + 1] if d == "cp1250" else [d] for i, d in enumerate(DECODERS)}
#: All (right encoding, wrong decoder) that are undone.
CHAINS = [("utf-8", d) for d in DECODERS] + [(o, d) for o in LATIN for d in LATIN if o != d] + [(o, d) for o in CYRILLIC for d in CYRILLIC if o != d] + [(o, d) for o in ORIGINALS for d in ("cp1252", "cp850", "mac_roman")]
DECODERS_OF = {o: [d for p, d in CHAINS if p == o] for o, _ in CHAINS}
BEYOND = re.compile(r"[^\W\d_]*[^\x00-\x7f\W\d_][^\W\d_]*")


def right_writings(text: str, at: tuple[int, int] | None = None) -> list[str]:
    """A clean text in ways that are right but carry the gate's signs: as it is, in capitals, and with signs set tight against its letters, or those from at[0] to at[1]."""

    def beside(before: str, after: str) -> str:
        return BEYOND.sub(lambda m: before + m[0] + after, text) if at is None else text[: at[0]] + before + text[at[0] : at[1]] + after + text[at[1] :]

    return [text, text.upper(), beside("«", "»"), beside("", "—"), beside("“", "”…")]


def garbled_words(word: str) -> dict[str, tuple[str, str]]:
    """The word after each chain that can have happened to it, with the first such chain."""
    out: dict[str, tuple[str, str]] = {}
    for o, decoders in DECODERS_OF.items():
        try:
            data = word.encode(o).decode("latin-1")
        except UnicodeEncodeError:
            continue
        for d in decoders:
            out.setdefault(data.translate(high(d)), (o, d))
    out.pop(word, None)
    return out


def garblings(text: str, at: tuple[int, int] | None = None) -> dict[str, tuple[str, str]]:
    """The text after each chain that can have happened to its word from at[0] to at[1], or its middle word beyond ASCII: one word alone is the hardest to see."""
    if at is None:
        words = [m.span() for m in BEYOND.finditer(text) if not m[0].isascii()]
        if not words:
            return {}
        at = words[len(words) // 2]
    return {text[: at[0]] + w + text[at[1] :]: chain for w, chain in garbled_words(text[at[0] : at[1]]).items()}


#: Stands beside the numbers of margins for the number of records.
RECORDS = -1
#: The margins that are tried.
GRID = (3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 12.0)


def _firsts() -> np.ndarray:
    """For each code point, by decoder, as bits: whether a UTF-8 sequence of two begins with it, one of three, and whether one goes on with it."""
    table = np.zeros(0x110000, np.uint32)
    for i, codec in enumerate(DECODERS):
        for a, b, *_, n in SEQUENCES:
            table[[ord(high(codec)[x]) for x in range(a, b + 1)]] |= np.uint32(1 << i + 10 * n)
        table[[ord(c) for c in utf8_parts(codec)[1]]] |= np.uint32(1 << i + 20)
    return table


FIRSTS = _firsts()


def _signs() -> list[list[set[str]]]:
    """Runs of sets of characters, one of which is in whatever RUN, SWAPPED, UPPER_RUN, WORD_SUSPECT and LOST match."""
    low, up, small = spread("а-яё"), spread("А-ЯЁ"), spread("a-zß-ÿ")
    return [
        [spread("\u0080-¿À-ÿŒœŠšŸŽžƒˆ˜–-›€™")] * 3, [set("‚ƒ")], [low, up], [spread("─-■Ђ-Џђ-џ"), spread("А-я")], [spread("А-я"), spread("─-■Ђ-ЄЅ-Џђ-іј-џ")], [up] * 3,
        [set(ODD_SIGN + "·‡‰¸ˆ˙˚˘")], [small, spread("À-ÞŸŠŒΓ-Ωﬂƒ"), small], [spread("\u0080-\u009f")], [small, {"ﬂ"}], [{"�"}], [{"?"}] * 2,
    ]


SIGN_CLASSES, SIGN_RUNS, _ = _classes(_signs())


def may_be_found(texts: list[str]) -> list[bool]:
    """Which of the texts have any sign that judged() goes by, whatever the gate and the margin say; all at once."""
    out = [False] * len(texts)
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = FIRSTS[points]
    ten = np.uint32((1 << 10) - 1)
    rest = bits >> np.uint32(20)
    hit = np.zeros(len(bits), bool)
    hit[begun(SIGN_CLASSES[points], SIGN_RUNS)] = True
    hit[:-1] |= bits[:-1] & rest[1:] & ten != 0
    hit[:-2] |= bits[:-2] >> np.uint32(10) & rest[1:-1] & rest[2:] & ten != 0
    ends = np.cumsum([len(t) + 1 for t in texts])
    for i in np.unique(np.searchsorted(ends, np.flatnonzero(hit), "right")).tolist():
        out[i] = True
    return out


def passed(r: Restorer, text: str, ends: tuple[int, ...], grid: tuple[float, ...] = GRID) -> int:
    """At how many margins of the grid something is found in the text; the grid's ends, which mostly tell, are tried first.

    What is found at one margin is found at all lower ones, so each text is tried at few of them.
    """
    low, high = 0, len(grid)
    while low < high:
        at, ends = (ends[0], ends[1:]) if ends else ((low + high) // 2, ends)
        if low <= at < high:
            r.model.margin = grid[at]
            low, high = (at + 1, high) if r.finds(text) else (low, at)
    return low


def weighed(r: Restorer, changes: list[tuple[int, str, Span, str]]) -> Iterator[tuple[int, Span, str, float, float]]:
    """(text's number, change, kind, gain, what it must be beyond besides the margin) of the changes that no other reason rules out; gains of many at once."""
    a, size = 0, 0
    for b, (_, text, s, _) in enumerate(changes, 1):
        size += s.end - s.start + len(s.text)
        if size < TOGETHER and b < len(changes):
            continue
        part = changes[a:b]
        gains = r.gains_of([(text, s.start, s.end, s.text) for _, text, s, _ in part])
        lower = iter(r.gains_of([(text, s.start, s.end, text[s.start : s.end].lower()) for _, text, s, kind in part if kind == "case"]))
        for (i, text, s, kind), gain in zip(part, gains):
            least = 0.0 if kind in ("utf-8", "word") else 0.5 * (s.end - s.start)
            if kind == "case":
                least = max(least, next(lower))
            if kind == "word" and gain <= 0.5 or kind in ("utf-8", "word") and gain <= r.plain_gain(text, s.start, s.end):
                continue
            yield i, s, kind, gain if r.model.total or kind != "utf-8" else 1e9, least
        a, size = b, 0


def passed_together(r: Restorer, texts: list[str], grid: tuple[float, ...] = GRID) -> list[int]:
    """passed() of many texts; passages and words are weighed once for all margins and texts."""
    out = [0] * len(texts)
    r.model.margin = grid[0]
    changes: list[tuple[int, str, Span, str]] = []
    for i, text in enumerate(texts):
        if LOST.search(text):
            out[i] = len(grid)
        elif r.utf8(text):  # what is inside of it may change with the margin
            out[i] = passed(r, text, (len(grid) - 1,), grid)
            r.model.margin = grid[0]
        else:
            if WORD_SUSPECT.search(text):
                changes += [(i, text, s, "word") for s in r.word_changes(text)]
            if RUN.search(text):
                changes += [(i, text, s, "run") for s in r.passage_changes(text, RUN, ["cp1252", "cp850", "mac_roman"], ORIGINALS, True)]
            if SWAPPED.search(text) or UPPER_RUN.search(text):
                changes += [(i, text, s, "case") for s in r.passage_changes(text, SWAPPED_OR_UPPER, CYRILLIC, CYRILLIC, False)]
    weight: Counter = Counter()
    for i, s, kind, gain, least in weighed(r, changes):
        if kind == "word":
            weight[i, s.chain] += gain
        while out[i] < len(grid) and (gain > least + grid[out[i]] or kind == "word" and weight[i, s.chain] > 1.5 * grid[out[i]]):
            out[i] += 1
    return out


def found_by_own(r: Restorer, writings: list[tuple[str, tuple[str, str]]]) -> list[bool]:
    """Of texts with their chains (right encoding, wrong decoder), in which finds() sees what the chain did; the others may hold something by another one."""
    out = [False] * len(writings)
    changes: list[tuple[int, str, Span, str]] = []
    for i, (text, (o, d)) in enumerate(writings):
        if o == "utf-8":
            changes += [(i, text, s, "utf-8") for s in r.utf8_changes(text, DEPTH, BEFORE_OR[d])]
        elif o in LATIN:
            changes += [(i, text, s, "word") for s in r.word_changes(text) if s.chain == f"{o}>{d}"]
        elif d in LATIN:
            changes += [(i, text, s, "run") for s in r.passage_changes(text, RUN, [d], [o], True)]
        elif SWAPPED.search(text) or UPPER_RUN.search(text):
            changes += [(i, text, s, "case") for s in r.passage_changes(text, SWAPPED_OR_UPPER, [d], [o], False)]
    margin = r.model.margin
    for i, _, kind, gain, least in weighed(r, changes):
        if gain > least + (margin / 2 if kind == "utf-8" else margin):
            out[i] = True
    return out


def tries_of(r: Restorer, mark: int, passages: dict[str, int], grid: tuple[float, ...] = GRID) -> Counter:
    """By mark and passed(), how many writings of the passages: the right ones whatever the gate says, the garbled ones as they are looked for."""
    of = right_writings if mark == RIGHT else garblings
    writings: list[tuple[str, tuple[str, str] | None, int]] = []
    for p, n in passages.items():
        own = of(p, (REACH, len(p) - REACH))
        writings += [(w, None, n) for w in dict.fromkeys(own)] if mark == RIGHT else [(w, chain, n) for w, chain in own.items()]
    out: Counter = Counter()
    if mark == TO_GARBLE:
        seen = gated([w for w, *_ in writings])
        out[mark, 0] += sum(n for (*_, n), s in zip(writings, seen) if not s)
        writings = [x for x, s in zip(writings, seen) if s]
        r.model.margin = grid[-1]  # most are found at all margins, and by what garbled them
        found = found_by_own(r, [(w, chain) for w, chain, _ in writings])
        out[mark, len(grid)] += sum(n for (*_, n), f in zip(writings, found) if f)
        writings = [x for x, f in zip(writings, found) if not f]
    hit = may_be_found([w for w, *_ in writings])
    out[mark, 0] += sum(n for (*_, n), h in zip(writings, hit) if not h)
    writings = [x for x, h in zip(writings, hit) if h]
    for (*_, n), k in zip(writings, passed_together(r, [w for w, *_ in writings], grid)):
        out[mark, k] += n
    if mark == TO_GARBLE:
        out[mark, RECORDS] += sum(passages.values())
    return out


def tried(passages: DataFrame, models: list[Model]) -> Counter:
    """Over all passages (slot, passage, n0, n1) how many writings, by mark, are found at how many margins; a half's passages by its own model.

    Equal passages are tried once; only the counts reach the driver.
    """
    spark = passages.sparkSession
    make = [restorer(spark, m) for m in models]

    def start() -> Callable[[list[list]], list[tuple]]:
        both = [m() for m in make]

        def kernel(columns: list[list]) -> list[tuple]:
            out: Counter = Counter()
            for a in range(0, len(columns[0]), ROWS):
                marks, texts, *counts = (c[a : a + ROWS] for c in columns)
                for r, ns in zip(both, counts):
                    for mark in (RIGHT, TO_GARBLE):
                        out.update(tries_of(r, mark, {t: n for m, t, n in zip(marks, texts, ns) if m == mark and n}))
            return [(mark, k, n) for (mark, k), n in out.items()]

        return kernel

    # by number, as few bytes of passages are much work, and would come together in one task
    spread_out = passages.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    sums = map_batches(spread_out, ["slot", "passage", "n0", "n1"], start, "mark int, passed int, n bigint").groupBy("mark", "passed").agg(F.sum("n").alias("n"))
    return Counter({(row["mark"], row["passed"]): row["n"] for row in sums.collect()})


def best_margin(tries: Counter, grid: tuple[float, ...] = GRID) -> float:
    """The margin with the fewest errors: false finds for each right writing of a record, which count three times, and the share of garbled words that are missed; of equals the middle one."""
    writings = 5 * tries[TO_GARBLE, RECORDS]  # each record has one middle word
    garbled = sum(n for (mark, k), n in tries.items() if mark == TO_GARBLE and k >= 0)
    if not garbled:
        return 6.0
    errors = []
    for i in range(len(grid)):
        wrong = sum(n for (mark, k), n in tries.items() if mark == RIGHT and k > i)
        missed = sum(n for (mark, k), n in tries.items() if mark == TO_GARBLE and 0 <= k <= i)
        errors.append(3 * wrong / writings + missed / garbled)
    best = [m for m, e in zip(grid, errors) if e == min(errors)]
    return best[len(best) // 2]


def validated_margin(model: Model, held: list[str], grid: tuple[float, ...] = GRID) -> float:
    """best_margin() of all passages of some texts that the model doesn't hold."""
    r = Restorer(model)
    tries: Counter = Counter()
    for mark, passages in zip((RIGHT, TO_GARBLE), passages_of(held)):
        tries.update(tries_of(r, mark, passages, grid))
    return best_margin(tries, grid)


def restorer(spark: SparkSession, model: Model) -> Callable[[], Restorer]:
    """A factory for the tasks; the model travels as one broadcast of about 5 MB."""
    sent = spark.sparkContext.broadcast((model.one, model.two, model.three, model.margin))

    def make() -> Restorer:
        one, two, three, margin = sent.value
        return Restorer(Model(one, two, three, margin))

    return make


def find_garbled(texts: DataFrame, model: Model, key: str = "video_id", column: str = "text") -> DataFrame:
    """(key, restored, passages, chains) of each record with a garbled passage."""
    make = restorer(texts.sparkSession, model)

    def start() -> Callable[[list[list]], list[tuple]]:
        r = make()

        def kernel(columns: list[list]) -> list[tuple]:
            return [(k, r.restore(text, spans), len(spans), sorted({s.chain for s in spans})) for k, text, spans in zip(*columns, r.spans_of(columns[1])) if spans]

        return kernel

    kind = dict(texts.dtypes)[key]
    return map_batches(texts.where(has_text(column)), [key, column], start, f"`{key}` {kind}, restored string, passages int, chains array<string>")
