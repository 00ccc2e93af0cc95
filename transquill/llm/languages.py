"""Problem 6: the language of each document and of each segment of a mixed one.

Character n-grams are counted by the (noisy) label of their document. An n-gram belongs to each language in which it is
about as frequent as where it is most frequent; these languages are the bits of its slot in two hashed tables, bit-sliced
Bloom filters of which one look-up gives all languages at once. A sentence's n-grams vote: the bits that are left after
joining both tables are summed by language and corrected for the filters' false positives; the most wins. Scripts only
narrow the choice: a sentence of whose n-grams no filter of its script knows a quarter is in none of the languages.

Defined results: null or blank texts, and texts of nothing but annotations, placeholders, filler or markup, or in none of
the languages, give no row; a segment in none of them has the empty language; a language without labelled records is told
by its script alone; of equal votes the language with more letters in the text wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.llm import mojibake
from transquill.llm.markup import clean
from transquill.llm.residue import fillers, holes
from transquill.llm.rows import collected, has_text, map_batches, map_columns
from transquill.llm.sentences import Model as Splitter
from transquill.llm.sentences import sentences

# The languages, and how they are called.
CODES = ["ar", "de", "en", "es", "fr", "hi", "ja", "pt", "ru", "th", "zh"]
NAMES = {
    "ar": "ar ara arabic arabe arabisch árabe العربية عربي арабский", "de": "de deu ger german deutsch allemand alemán alemão немецкий", "en": "en eng english anglais englisch inglés inglês английский", "es": "es spa spanish español espanol castellano espagnol spanisch espanhol испанский",
    "fr": "fr fra fre french français francais französisch francés francês французский", "hi": "hi hin hindi हिन्दी हिंदी хинди", "ja": "ja jpn jp japanese japonais japanisch japonés japonês 日本語 японский", "pt": "pt por portuguese português portugues portugais portugiesisch portugués португальский",
    "ru": "ru rus russian русский russe russisch ruso russo", "th": "th tha thai thaï ไทย ภาษาไทย тайский", "zh": "zh zho chi cmn chinese mandarin chinois chinesisch chino chinês 中文 汉语 普通话 китайский",
}
# End of fixed values.
CODE_OF = {n: c for c, names in NAMES.items() for n in names.split()}
BITS = 17
#: N-grams have three characters and four, and two in scripts without spaces.
GRAM = 4
#: An n-gram is in a language if its frequency there is at least this part of its highest.
PART = 0.25
#: A confidence that says nothing.
DOUBT = 0.5
#: Least part of a sentence's n-grams that a language knows of its own, and n-grams from which that can be judged.
KNOWN, JUDGED = 0.25, 24
#: Texts whose pieces are judged at once.
CHUNK = 512
ANNOTATION = re.compile(r"[\[(♪♫<](?:(?<=\[)[^\]\n]{1,40}\]|(?<=\()[^()\d\n]{1,30}\)|(?<=[♪♫])|(?<=<)[^<>\n]{1,80}>)")
#: What every time holds.
TIME_PART = re.compile(r":\d\d")
TIME = re.compile(r"[\[(]?\b\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\b[\])]?(?:\s*[-–]\s)?")
LETTERS = re.compile(r"[^\W\d_]")
SCRIPTS = re.compile(r"(?P<th>[฀-๿]+)|(?P<ja>[぀-ヿ]+)|(?P<ar>[؀-ۿ]+)|(?P<hi>[ऀ-ॿ]+)|(?P<ru>[Ѐ-ӿ]+)|(?P<zh>[㐀-鿿]+)|(?P<la>[A-Za-zÀ-ɏ]+)")
LATIN_LETTER = re.compile("[A-Za-zÀ-ɏ]")
#: A pattern that begins with a set passes other characters over fast, so the sets are written out.
OTHER_RUN = re.compile("[Ѐ-ӿ؀-ۿऀ-ॿ฀-๿぀-ヿ㐀-鿿]" * 3)
#: Signs of an end with a blank after them, or full-width ones.
PIECE = re.compile(r"[.!?؟।。！？](?:(?<=[.!?؟।])[.!?؟।]*[\"”»’)]*\s+|(?<=[。！？])[。！？]*)")
THAI = re.compile("[฀-๿]")
THAI_PIECE = re.compile(r"[.!?]+\s+|(?<=[฀-๿]{20})\s+")
RANGES = {"th": "฀-๿", "ja": "぀-ヿ", "ar": "؀-ۿ", "hi": "ऀ-ॿ", "ru": "Ѐ-ӿ", "zh": "㐀-鿿", "la": "A-Za-zÀ-ɏ"}
#: For each script the letters of the others, and those of other writings: kana and ideographs are one.
OTHERS = {k: re.compile("[" + "".join(r for j, r in RANGES.items() if j != k) + "]") for k in RANGES}
OTHER_WRITINGS = OTHERS | dict.fromkeys(("ja", "zh"), re.compile("[" + "".join(r for j, r in RANGES.items() if j not in ("ja", "zh")) + "]"))
BY_SCRIPT = {"th": ["th"], "ja": ["ja"], "ar": ["ar"], "hi": ["hi"], "ru": ["ru"], "zh": ["zh", "ja"], "la": ["de", "en", "es", "fr", "pt"]}


def label(text: Column) -> Column:
    """The one language that a label names, else null; regions and spellings don't matter."""
    names = F.create_map(*(F.lit(x) for pair in CODE_OF.items() for x in pair))
    parts = F.split(F.lower(F.trim(text)), r"[\s,;/|+&]+")
    named = F.transform(parts, lambda p: F.coalesce(names[p], names[F.regexp_extract(p, r"^(\p{L}+)[-_]", 1)]))
    known = F.array_distinct(F.filter(named, lambda c: c.isNotNull()))
    return F.when(F.size(known) == 1, known[0])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts on end, non-letters as one blank; the text each belongs to."""
    lowered = [" " + t.lower() + " " for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    return data, owner


_LETTER = np.zeros(0x30000, bool)
for _a, _b in ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x300, 0x36F), (0x370, 0x52F), (0x600, 0x6FF), (0x900, 0x963), (0x966, 0x97F), (0xE00, 0xE7F), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF)):
    _LETTER[_a : _b + 1] = True
_LETTER[[0xD7, 0xF7, 0x60C, 0x61B, 0x61F, 0x6D4]] = False
#: Each code point as it is counted: letters as they are, others as a blank.
_LOWER = np.where(_LETTER, np.arange(len(_LETTER)), 32).astype(np.uint32)
#: Scripts without spaces.
DENSE = 0x3040, 0xA000


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot in the first table, slot in the second, text) of every n-gram."""
    data, owner = _codes(texts)
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), owner[:0]
    data = _LOWER[np.minimum(data, 0x2FFFF)]
    letter = data != 32
    keep = np.flatnonzero(letter | np.concatenate([[True], letter[:-1]]))  # one blank between words
    data, owner, letter = data[keep], owner[keep], letter[keep]
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), owner[:0]
    x = data.astype(np.uint64)
    n = len(x) - GRAM + 1
    of_dense = data - np.uint32(DENSE[0]) < np.uint32(DENSE[1] - DENSE[0])
    dense = of_dense[:n] & of_dense[1 : n + 1]
    a = x[:n] * np.uint64(0x9E3779B97F4A7C15) ^ x[1 : n + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = a ^ x[2 : n + 2] * np.uint64(0x165667B19E3779F9)
    four = three ^ x[3 : n + 3] * np.uint64(0x27D4EB2F165667C5)
    first = np.where(dense, a, three)
    same = owner[:n] == owner[GRAM - 1 :]
    pick = np.flatnonzero(same & (dense | letter[1 : n + 1]))
    also = np.flatnonzero(same & letter[1 : n + 1] & letter[2 : n + 2] & ~dense)
    h = np.concatenate([first[pick], four[also]])
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    mask = np.uint64((1 << BITS) - 1)
    return (h & mask).view(np.int64), (h >> np.uint64(24) & mask).view(np.int64), np.concatenate([owner[pick], owner[also]])


def _count() -> Callable[[list[list]], list[np.ndarray]]:
    def kernel(columns: list[list]) -> list[np.ndarray]:
        labels, texts = columns
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
        for i, code in enumerate(CODES):
            own = [t for c, t in zip(labels, texts) if c == code]
            if own:
                for table, slots in enumerate(grams(own)[:2]):
                    n = np.bincount(slots, minlength=1 << BITS)
                    at = np.flatnonzero(n)
                    for column, x in zip(out, (np.full(len(at), table), np.full(len(at), i), at, n[at])):
                        column.append(x)
        return [np.concatenate(x) for x in out]

    return kernel


#: Languages whose hits are summed in one number, and bits of each.
TOGETHER, FIELD = 4, 13


@dataclass
class Filters:
    """Two tables of language bits; false[l] is how often a random n-gram has bit l in both."""

    bits: np.ndarray = field(default_factory=lambda: np.zeros((2, 1 << BITS), np.uint16))
    false: np.ndarray = field(init=False)
    learned: np.ndarray = field(init=False)
    _fields: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        fill = np.array([[((t >> i) & 1).mean() for i in range(len(CODES))] for t in self.bits])
        self.false = np.clip(fill[0] * fill[1], 0.0, 0.9)
        self.learned = fill[0] > 0
        sets = np.arange(1 << len(CODES))
        self._fields = [sum(((sets >> a + k) & 1) << FIELD * k for k in range(min(TOGETHER, len(CODES) - a))).astype(float) for a in range(0, len(CODES), TOGETHER)]

    def hits(self, sets: np.ndarray, owner: np.ndarray, texts: int, most: int) -> list[np.ndarray]:
        """For each language in how many of each text's n-grams' sets of languages it is."""
        if most >= 1 << FIELD:
            return [np.bincount(owner[(sets >> i) & 1 == 1], minlength=texts) for i in range(len(CODES))]
        sums = [np.bincount(owner, weights=f[sets], minlength=texts).astype(np.int64) for f in self._fields]
        return [(sums[i // TOGETHER] >> FIELD * (i % TOGETHER)) & ((1 << FIELD) - 1) for i in range(len(CODES))]

    def votes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the part of its n-grams that the language has, corrected; and the n-grams of each text."""
        one, two, owner = grams(texts)
        both = self.bits[0][one] & self.bits[1][two]
        n = np.bincount(owner, minlength=len(texts)).astype(float)
        out = np.zeros((len(texts), len(CODES)))
        for i, hits in enumerate(self.hits(both, owner, len(texts), int(n.max(initial=0)))):
            out[:, i] = (hits - n * self.false[i]) / (1 - self.false[i]) / np.maximum(n, 1)
        return out, n


def fit(labelled: DataFrame, code: str = "code", column: str = "text") -> Filters:
    """Filters from all labelled records; at most 2 x 11 x 2^17 rows of counts reach the driver, whatever the corpus."""
    rows = collected(map_columns(labelled.where(has_text(column) & F.col(code).isNotNull()), [code, column], _count, "part int, lang int, slot int, n bigint").groupBy("part", "lang", "slot").agg(F.sum("n").alias("n")))
    counts = np.zeros((2, len(CODES), 1 << BITS), np.float64)
    counts[rows["part"], rows["lang"], rows["slot"]] = rows["n"]
    total = np.maximum(counts.sum(axis=2, keepdims=True), 1.0)
    # a language with few records still needs an n-gram more than once
    rate = counts / total
    inside = (rate >= PART * rate.max(axis=1, keepdims=True)) & (counts >= 2)
    return Filters(sum((inside[:, i].astype(np.uint16) << i for i in range(len(CODES))), np.zeros((2, 1 << BITS), np.uint16)).astype(np.uint16))


@dataclass
class Unit:
    text: str
    letters: int
    code: str = ""
    sure: float = 0.0


def pure(text: str) -> str:
    """A restored text without placeholders, filler, markup, annotations and time marks."""
    spans = sorted([(a, b) for _, a, b in holes(text)] + fillers(text))
    for a, b in reversed(spans):
        text = text[:a] + " " + text[b:]
    text = clean(text, drop_code=True)[0]
    if any(c in text for c in "[(♪♫<"):
        text = ANNOTATION.sub(" ", text)
    return TIME.sub(" ", text) if TIME_PART.search(text) else text


def one_writing(text: str) -> bool:
    """Whether there are no runs of two writings to cut between, and so none in any part of the text."""
    if text.isascii() or not OTHER_RUN.search(text):
        return True
    m = SCRIPTS.search(text)
    return not m or not OTHER_WRITINGS[m.lastgroup].search(text)


def script_runs(text: str) -> list[str]:
    """A sentence cut where a long run of another writing begins."""
    if one_writing(text):
        return [text]
    parts: list[list] = []
    for m in SCRIPTS.finditer(text):
        kind = m.lastgroup
        kind = "cjk" if kind in ("ja", "zh") else kind
        if parts and parts[-1][0] == kind:
            parts[-1][2], parts[-1][3] = m.end(), parts[-1][3] + len(m[0])
        else:
            parts.append([kind, m.start(), m.end(), len(m[0])])
    if len(parts) < 2:
        return [text]
    long = [p for p in parts if p[3] >= 15]
    if len({p[0] for p in long}) < 2:
        return [text]
    cuts = [0]
    for p, q in zip(long, long[1:]):
        if p[0] != q[0]:
            cuts.append(q[1])
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


#: Sentences under SHORT characters are judged with the short ones next to them; LEAST characters can be judged, from SURE on for sure.
SHORT, LEAST, SURE = 25, 12, 0.62
#: How sentences end, unlike lines with a name alone.
ENDED = re.compile(r"[.!?…。！？।؟]\W*$")


def windows(sizes: list[int]) -> list[tuple[int, int]]:
    """From each of the items on end, the fewest of at least two that make LEAST together; as (start, end)."""
    out = []
    for a in range(len(sizes) - 1):
        e, n = a + 2, sizes[a] + sizes[a + 1]
        while n < LEAST and e < len(sizes):
            n += sizes[e]
            e += 1
        if n >= LEAST:
            out.append((a, e))
    return out


class Identifier:
    def __init__(self, filters: Filters) -> None:
        self.filters = filters
        self.splitter = Splitter()
        self.at = {c: i for i, c in enumerate(CODES)}
        self.latin = [self.at[c] for c in BY_SCRIPT["la"]]

    def decide(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language of each text with a confidence from 0 to 1, by the votes among the languages of its script; '' for none."""
        votes, many = self.filters.votes(texts)
        learned = self.filters.learned
        out: list[tuple[str, float]] = [("", 0.0)] * len(texts)
        latin = [i for i, t in enumerate(texts) if (t.isascii() or not OTHER_RUN.search(t)) and LATIN_LETTER.search(t)]
        if latin:
            own = votes[np.ix_(latin, self.latin)]
            first = own.argmax(axis=1)
            top = np.sort(own, axis=1)
            sure = np.clip(0.5 + top[:, -1] - top[:, -2], 0.0, 1.0)
            strange = (top[:, -1] < KNOWN) & (many[latin] >= JUDGED) & learned[self.latin].all()
            for i, f, s, none in zip(latin, first.tolist(), sure.tolist(), strange.tolist()):
                if not none:
                    out[i] = BY_SCRIPT["la"][f], s
        taken = set(latin)
        for i, t in enumerate(texts):
            if i in taken:
                continue
            sizes: dict[str, int] = {}
            if not (m := SCRIPTS.search(t)):
                continue
            if not OTHERS[m.lastgroup].search(t):  # then only its share counts, which is all
                sizes[m.lastgroup] = 1
            else:
                for m in SCRIPTS.finditer(t):
                    sizes[m.lastgroup] = sizes.get(m.lastgroup, 0) + len(m[0])
            if "ja" in sizes and "zh" in sizes:
                sizes["ja"] += sizes.pop("zh") if sizes["ja"] * 8 > sizes["zh"] else 0
            top_script = max(sizes, key=lambda s: sizes[s])
            may = BY_SCRIPT[top_script]
            v = votes[i]
            ranked = sorted(may, key=lambda c: -v[self.at[c]])
            best = float(v[self.at[ranked[0]]])
            second = float(v[self.at[ranked[1]]]) if len(ranked) > 1 else 0.0
            share = sizes[top_script] / sum(sizes.values())
            if all(learned[self.at[c]] for c in may):
                if best < KNOWN and many[i] >= JUDGED:
                    continue
                out[i] = ranked[0], share * min(1.0, max(0.0, 0.5 + best - second))
            else:
                out[i] = ranked[0], share if len(may) == 1 else share * min(1.0, max(0.0, 0.5 + best - second))
        return out

    def segments(self, text: str) -> list[tuple[str, int, int, float]]:
        """(language, sentences, letters, confidence) of each run of sentences of one language."""
        units: list[Unit] = []
        for a, e in sentences(text, self.splitter):
            for part in script_runs(text[a:e]):
                n = len(LETTERS.findall(part))
                if n >= 3:
                    units.append(Unit(part, n))
        if not units:
            return []
        for u, (c, s) in zip(units, self.decide([u.text for u in units])):
            u.code, u.sure = c, s
        self._smooth(units)
        out: list[tuple[str, int, int, float]] = []
        for u in units:
            if out and out[-1][0] == u.code:
                c, n, letters, sure = out[-1]
                out[-1] = c, n + 1, letters + u.letters, (sure * letters + u.sure * u.letters) / (letters + u.letters)
            else:
                out.append((u.code, 1, u.letters, u.sure))
        return out

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """Parts of about a sentence, long enough to judge; short ones on end are judged together, not with a long one beside them."""
        cut = (lambda p: (p,)) if one_writing(text) else script_runs
        parts = [s for line in text.split("\n") for p in (THAI_PIECE if THAI.search(line) else PIECE).split(line) for q in cut(p) if (s := q.strip())]
        out: list[str] = []
        held, i = "", 0
        while i < len(parts):
            if not held and len(parts[i]) >= SHORT:
                out.append(parts[i])
                i += 1
                continue
            j = i
            while j < len(parts) and len(parts[j]) < SHORT and (j == i or not SCRIPTS_DIFFER(parts[j - 1], parts[j])):
                j += 1
            run = windows([len(q) for q in parts[i:j]])
            if run:
                out += [held] * bool(held) + [" ".join(parts[i + a : i + e]) for a, e in run]
                held = ""
            else:  # a long one, or too little to judge
                j = max(j, i + 1)
                q, long = " ".join(parts[i:j]), len(parts[i]) >= SHORT
                if held and not SCRIPTS_DIFFER(held, q):
                    q = held + " " + q
                elif held:
                    out.append(held)
                held = ""
                if long or j == len(parts):
                    out.append(q)
                elif out and not SCRIPTS_DIFFER(out[-1], q):
                    out[-1] += " " + q
                else:
                    held = q
            i = j
        return [p for p in out if len(p) >= LEAST]

    def _smooth(self, units: list[Unit]) -> None:
        """Unsure or short sentences go with the sure ones next to them, if these are in the same script."""
        firm = [u.sure >= SURE and u.letters >= LEAST for u in units]
        self._judge_together(units, firm)
        before: list[str] = []
        code = ""
        for u, sure in zip(units, firm):
            before.append(code)
            code = u.code if sure else code
        code = ""
        for i in range(len(units) - 1, -1, -1):
            u = units[i]
            if firm[i]:
                code = u.code
                continue
            near = [c for c in (before[i], code) if c and (u.letters < LEAST or set(BY_SCRIPT_OF[c]) & set(BY_SCRIPT_OF[u.code]))]
            if near and u.code not in near:
                u.code = near[0]

    def _judge_together(self, units: list[Unit], firm: list[bool]) -> None:
        """Sentences on end that are too short or unsure alone become sure if they are so together and each is rather in that language."""
        spans, i = [], 0
        while i < len(units):
            j = i
            while j < len(units) and not firm[j]:
                j += 1
            spans += [(i + a, i + e) for a, e in windows([u.letters for u in units[i:j]])]
            i = max(j, i + 1)
        spans = [(a, e) for a, e in spans if units[a].code and len({u.code for u in units[a:e]}) == 1 and all(ENDED.search(u.text) for u in units[a:e])]
        for (a, e), (c, s) in zip(spans, self.decide([" ".join(u.text for u in units[a:e]) for a, e in spans]) if spans else ()):
            if c == units[a].code and s >= SURE:
                for k in range(a, e):
                    units[k].sure, firm[k] = max(units[k].sure, s), True

    def languages(self, texts: list[str]) -> list[tuple[str, list[str], list[tuple[str, int, int, float]]]]:
        """For each text its main language, all languages it is really in, and its segments.

        Pieces of about a sentence, and short sentences on end together, of all texts are judged at once; where they don't
        agree, the text is cut into its sentences and these are judged.
        """
        pieces, owner = [], []
        for i, t in enumerate(texts):
            rough = self._pieces(t) or ([t] if LETTERS.search(t) else [])
            pieces += rough
            owner += [i] * len(rough)
        many = Counter(owner)
        weights: list[dict[str, float]] = [{} for _ in texts]
        size: list[dict[str, int]] = [{} for _ in texts]
        for p, i, (c, s) in zip(pieces, owner, self.decide(pieces)):
            if c:
                weights[i][c] = weights[i].get(c, 0.0) + s * len(p)
                size[i][c] = size[i].get(c, 0) + len(p)
        out = []
        for i, t in enumerate(texts):
            if not weights[i]:
                out.append(("", [], []))
                continue
            if len(weights[i]) == 1:
                c = next(iter(weights[i]))
                out.append((c, [c], [(c, many[i], size[i][c], weights[i][c] / size[i][c])]))
                continue
            parts = self.segments(t)
            letters: dict[str, float] = {}
            for c, _, n, sure in parts:
                if c:
                    letters[c] = letters.get(c, 0.0) + n * max(0.01, sure - DOUBT)
            if not letters:
                out.append(("", [], []))
                continue
            main = max(sorted(letters), key=lambda c: letters[c])
            out.append((main, sorted({main} | {c for c, n, _, sure in parts if c and n >= 2 and sure >= DOUBT + 0.1}), parts))
        return out


BY_SCRIPT_OF = {c: [s for s, codes in BY_SCRIPT.items() if c in codes] for c in CODES} | {"": []}


def SCRIPTS_DIFFER(a: str, b: str) -> bool:  # noqa: N802
    if a.isascii() and b.isascii():
        return False
    x, y = SCRIPTS.search(a), SCRIPTS.search(b)
    cjk = {"ja", "zh"}
    return bool(x and y and x.lastgroup != y.lastgroup and not {x.lastgroup, y.lastgroup} <= cjk)


def identify(texts: DataFrame, filters: Filters, model: mojibake.Model, keys: list[str], column: str = "text") -> DataFrame:
    """keys, main, langs, and segments (lang, sentences, letters, confidence) of each text that is in a language."""
    spark: SparkSession = texts.sparkSession
    make = mojibake.restorer(spark, model)
    sent = spark.sparkContext.broadcast(filters.bits)

    def start() -> Callable[[list[list]], list[tuple]]:
        r, who = make(), Identifier(Filters(sent.value))
        names = ("lang", "sentences", "letters", "confidence")

        def kernel(columns: list[list]) -> list[tuple]:
            out = []
            for a in range(0, len(columns[-1]), CHUNK):
                part = [c[a : a + CHUNK] for c in columns]
                found = who.languages([pure(t) for t in r.restored(part[-1])])
                out += [(*values, main, langs, [dict(zip(names, p)) for p in parts]) for *values, (main, langs, parts) in zip(*part[:-1], found) if langs]
            return out

        return kernel

    kinds = dict(texts.dtypes)
    return map_batches(texts.where(has_text(column)), [*keys, column], start, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", main string, langs array<string>, segments array<struct<lang:string,sentences:int,letters:int,confidence:double>>")


def labels(videos: DataFrame, transcripts: DataFrame, channels: DataFrame) -> DataFrame:
    """(video_id, code): the label of each video, by its latest transcript row, else by its channel; null if there is none."""
    latest = transcripts.where(F.col("youtube_id").isNotNull()).groupBy("youtube_id").agg(F.max_by("language", F.struct(F.col("acquired_at"), F.coalesce(F.col("language"), F.lit("")))).alias("language"))
    named = channels.select(F.col("id").alias("channel_id"), label(F.col("lang_config")).alias("of_channel"))
    ids = videos.groupBy(F.col("id").alias("video_id")).agg(F.max("youtube_id").alias("youtube_id"), F.max("channel_id").alias("channel_id"))
    joined = ids.join(latest, "youtube_id", "left").join(named, "channel_id", "left")
    return joined.select("video_id", F.coalesce(label(F.col("language")), F.col("of_channel")).alias("code"))
