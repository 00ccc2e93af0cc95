"""Problem 10: sentence units of every document, whatever its language and script.

A semi-Markov dynamic programme picks whole sentence spans between candidate boundaries. A span's score joins its length,
its opening word, its closing word with the mark after it, and whether quotations and brackets are balanced within. How
often a word opens or closes text for certain is counted over all documents, in tables of fixed size.

Defined results: null and blank texts give no unit; a text without any mark is one unit for each block between blank lines;
units carry no white space around them; positions count code points from 1 in the text as stored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from math import log

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.llm.rows import collected, has_text, map_batches, map_rows

# Abbreviations with a point, in lower case.
ABBREVIATIONS = frozenset(
    """a al ap art aprox approx av avda ave bd bldg bspw bzw ca cap capt cf cie co col corp dept dez dir dott doz dr dra ebd ed ej etc evtl ex exp feb ff fig figs fl fr ft gen ggf gov gr hon hr hrsg ibid i inc
    inkl insb jan janv jr kap lic lt ltd m max mgr mio mlle mm mme mr mrs ms msgr mt nº no nov nr num oct okt op p pág págs par pl pp pr pres prof prov pt ref rep rev s sen sens sept sgt sog sr sra srta st sta ste
    str tab tel tsd u usw v vgl vol vs z zb б в г гг гл др е и им л млн млрд напр обл п пер пр руб с св см соч стр т тел тж тыс ул ч д डॉ श्री श्रीमती सं ดร นาย พ ศ د أ م ص""".split()
)
CLOSERS = "»”\"’'“)\\]」』）】›"
OPENERS = "«“\"‘'„([「『（【‹¿¡"
PAIRS = {"«": "»", "„": "“", "(": ")", "[": "]", "「": "」", "『": "』", "（": "）", "【": "】", "“": "”"}
# End of fixed values.

BITS = 17
OPEN, TOKEN, FINAL, DOTTED = range(4)
#: Scores of closing marks, of case, and of what is out of balance.
HARD, POINT, DOTS, SPACE, LOWER, UPPER, UNBALANCED = 4.0, 2.5, 0.5, 0.3, -5.0, 1.0, -6.0
TYPICAL, SPREAD = log(70.0), 1.6
#: Characters from which the cost of a span's length is concave in it.
FAR = 191

BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+|\r\n[^\S\n]*\r\n\s*")
MARK = re.compile(rf"(?P<mark>\.{{2,}}|…+|[。！？।॥]+|[.!?؟۔‼⁇⁈⁉]+(?:[.!?…]*))(?P<close>(?:[^\S\n]?»|[{CLOSERS}])*)")
THAI_SPACE = re.compile(r"(?<=[฀-๿\"”'’)\]\d%ๆฯ])\s+(?=\S)|(?<=[฀-๿])(?=[A-Za-z぀-ヿ一-鿿Ѐ-ӿ؀-ۿऀ-ॿ]{2})")
THAI = re.compile(r"[฀-๿]")
HEADER = re.compile(r"-{3,}[^\n]*?\S[^\S\n]+-{3,}(?=\s|$)|={3,}[^\n=]+={3,}(?=\s|$)")
#: Word characters and the marks of scripts in which marks are none: accents, Arabic, Devanagari, Thai.
MORE = r"\w" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x300, 0x36F), (0x64B, 0x655), (0x900, 0x97F), (0xE00, 0xE7F)))
#: The word that ends where a text, read backwards, begins.
LAST_TOKEN = re.compile(rf"(?:[{MORE}]|(?<=[{MORE}])[.'’-])*(?<=[^\W_])")
QUOTES = re.compile(r"[«»“”„\"()\[\]「」『』（）【】]")
NEXT_TOKEN = re.compile(rf"[\s{OPENERS}–—•*-]*(?P<word>[^\W_](?:[{MORE}]|['’-](?=\w))*)")
WIDE = re.compile(r"[぀-ヿ㐀-鿿]")
ANY_WORD = re.compile(rf"[^\W_](?:[{MORE}]|['’-](?=\w))*")


def key(word: str) -> str:
    """What a word is counted as: scripts without spaces by their first characters, numbers as one."""
    if word[0].isdigit():
        return "0"
    if WIDE.match(word):
        return word[:2]
    if THAI.match(word):
        return word[:5]
    return word.lower()


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & ((1 << BITS) - 1)


@dataclass
class Model:
    """Counts by hashed word: openings for certain, all, endings for certain, all before a point."""

    counts: np.ndarray = field(default_factory=lambda: np.zeros((4, 1 << BITS), np.float32))
    _open: dict[str, float] = field(default_factory=dict)
    _close: dict[str, float] = field(default_factory=dict)

    def _ratio(self, part: int, whole: int, word: str, weight: float) -> float:
        all_whole = float(self.counts[whole].sum())
        if not all_whole:
            return 0.0
        base = (float(self.counts[part].sum()) + 1) / (all_whole + 2)
        b = bucket(word)
        n = min(float(self.counts[part][b]), float(self.counts[whole][b]))
        return log((n + weight * base) / (float(self.counts[whole][b]) + weight)) - log(base)

    def opening(self, word: str) -> float:
        k = key(word)
        if (s := self._open.get(k)) is None:
            s = self._open[k] = max(-5.0, min(3.0, self._ratio(OPEN, TOKEN, k, 4.0)))
        return s

    def closing(self, word: str) -> float:
        k = word.lower()
        if (s := self._close.get(k)) is None:
            s = max(-5.0, min(1.5, self._ratio(FINAL, DOTTED, k, 3.0)))
            if k in ABBREVIATIONS or "." in k and all(len(x) <= 2 for x in k.split(".")):
                s = min(s, -5.0)
            elif len(k) == 1 and k.isalpha():
                s = min(s, -4.0)
            self._close[k] = s
        return s


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans between blank lines, headers apart, without white space around."""
    out, at = [], 0
    for m in [*BLANK.finditer(text), None]:
        a, b = at, m.start() if m else len(text)
        at = m.end() if m else len(text)
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b and (h := HEADER.match(text, a, b)) and h.end() < b:
            out.append((a, h.end()))
            a = h.end()
            while a < b and text[a].isspace():
                a += 1
        if a < b:
            out.append((a, b))
    return out


def is_lower(text: str) -> bool:
    """Whether case says nothing here: sentences start in lower case."""
    after = re.findall(r"[.!?]\s+([^\W\d_])", text) or re.findall(r"(?:^|\n\n)([^\W\d_])", text)
    cased = [c for c in after if c.lower() != c.upper()]
    return bool(cased) and sum(c.isupper() for c in cased) < 0.3 * len(cased)


def depths(text: str, a: int, b: int) -> tuple[list[int], list[int]]:
    """Positions at which quotations and brackets open or close, and how many are open from there."""
    at, open_, stack = [a], [0], []
    for m in QUOTES.finditer(text, a, b):
        c, i = m[0], m.start()
        if c == '"':
            if stack and stack[-1] == '"':
                stack.pop()
            else:
                stack.append('"')
        elif c == "“" and stack and stack[-1] == "“":
            stack.pop()
        elif c in PAIRS:
            stack.append(PAIRS[c])
        elif stack and stack[-1] == c:
            stack.pop()
        elif c in stack:
            del stack[stack.index(c) :]
        else:
            continue
        at.append(i + 1)
        open_.append(len(stack))
    if stack:  # something is never closed: then balance says nothing
        return [a], [0]
    return at, open_


def last_word(backwards: str, start: int, end: int) -> str:
    """The word of the text from start that ends at end; the text is given backwards."""
    n = len(backwards)
    m = LAST_TOKEN.match(backwards, n - end, n - start)
    return m[0][::-1] if m else ""


def split_block(text: str, backwards: str, a: int, b: int, lower: bool, model: Model) -> list[int]:
    """Ends of the sentences of one block."""
    ends: list[int] = []
    close: list[float] = []
    opens: list[float] = []
    thai = bool(THAI.search(text, a, b))
    for m in MARK.finditer(text, a, b):
        end = m.end()
        if end >= b:
            break
        if ends and not any(c.isalnum() for c in text[ends[-1] : m.start()]):  # nothing was said between two marks
            ends.pop(), close.pop(), opens.pop()
        mark, quoted, nxt = m["mark"], m["close"], text[end]
        token = last_word(backwards, a, m.start())
        follows = NEXT_TOKEN.match(text, end, b)
        first = follows["word"] if follows else ""
        tight = not nxt.isspace()
        wide = mark[0] in "。！？।॥"
        if tight and not wide:
            if quoted and nxt in ",;:–-":
                continue
            if nxt in ".!?…,;:%/\\_@=&-–)]»" or nxt.isdigit() and (not token or token[-1].isdigit() or mark[0] == "."):
                continue
            if mark[0] == "." and len(mark) == 1 and not quoted:
                glued = (text[max(a, m.start() - 60) : m.start() + 1].split() or [""])[-1][:-1] + (text[end : end + 60].split(None, 1) or [""])[0]
                if nxt.isalpha() and nxt.islower() and (not lower or len(token) < 3 or "/" in glued or len(first) < 2 or re.search(r"\.\w*\.", "." + glued) or first in ("example", "com", "org", "net", "html", "fr", "de", "es")):
                    continue
                if nxt.isalpha() and nxt.isupper() and (len(token) < 2 or "/" in glued or token[-1:].isupper() and len(token) < 3):
                    continue
                if not nxt.isalpha() and nxt not in OPENERS:
                    continue
        c = DOTS if mark[0] in "…" or mark.startswith("..") else HARD if mark[0] != "." else POINT
        if mark == "." and not quoted:
            if token and token[0].isdigit():
                start = text[a : m.start() - len(token)].strip()
                line = text.rfind("\n", a, m.start())
                if not start or not text[line + 1 : m.start() - len(token)].strip() and line >= a:
                    continue  # a list number belongs to its sentence
                if re.fullmatch(r"\d{1,2}", token):
                    c = -2.5 if re.search(r"(?i)\b(?:am|vom|zum|bis|der|den|dem|des|im|seit|ab|und|kl|den)\s*$", start[-12:]) else -0.5 if re.search(r"[.!?]\s*$", start[-3:]) else 1.0
                    if re.search(r"[.!?…。]\s*$", start[-3:]):
                        c = -6.0  # a number in the flow of a list
            elif token:
                c += model.closing(token.rsplit("'", 1)[-1].rsplit("’", 1)[-1])
        o = 0.0
        if first:
            i = follows.start("word")
            o = model.opening(first)
            cased = first[0].lower() != first[0].upper()
            before = text[end:i].strip()
            if cased and not lower:
                o = (LOWER if first[0].islower() else UPPER) + 0.4 * o
            if before[:1] in ("¿", "¡", "«", "“", "„", '"', "「") and before:
                o = max(o, 0.5 if not quoted else 0.0)
        elif nxt in OPENERS:
            o = 0.5
        if quoted and WIDE.match(text, end) and text[end] in "とってのはがをにでも，、":
            o = min(o, -5.0)
        ends.append(end)
        close.append(c)
        opens.append(o)
    if thai:
        for m in THAI_SPACE.finditer(text, a, b):
            i = bisect_left(ends, m.start())
            if i < len(ends) and ends[i] == m.start():
                continue
            follows = NEXT_TOKEN.match(text, m.end(), b)
            first = follows["word"] if follows else ""
            if not first or not (THAI.match(first) or THAI.match(text[m.start() - 1])):
                continue
            o = 1.5 * model.opening(first) if THAI.match(first) else -3.0 if first[0].isdigit() else 1.0 if len(ANY_WORD.findall(text[m.end() : m.end() + 60])) > 3 or WIDE.match(first) else -2.0
            c = SPACE if THAI.match(text[m.start() - 1]) else -0.5
            ends.insert(i, m.start())
            close.insert(i, c)
            opens.insert(i, o)
    if not ends:
        return [b]
    return _best(text, a, b, ends, close, opens)


def _best(text: str, a: int, b: int, ends: list[int], close: list[float], opens: list[float]) -> list[int]:
    """The likeliest spans: best[j] is the best score of text up to boundary j."""
    points = [a, *ends, b]
    n = len(points)
    where, depth = depths(text, a, b)
    deep = [depth[bisect_left(where, p + 1) - 1] for p in points]
    deep[0] = deep[-1] = 0
    gain = [0.0, *(c + o for c, o in zip(close, opens)), 0.0]
    best = [0.0] + [-1e18] * (n - 1)
    back = [0] * n
    high = [0.0] * n
    far = Far(points, best)
    for j in range(1, n):
        full = True
        for i in range(j - 1, -1, -1):
            size = points[j] - points[i]
            off = (log(size) - TYPICAL) / SPREAD
            if off > 0 and high[i] + gain[j] - 0.5 * off * off <= best[j]:
                full = False
                break  # no longer span can be better: none starts from a higher score, and all are further off
            if size > FAR:
                break
            x = best[i] + gain[j] - 0.5 * off * off - (2.5 if size < 3 else 0.0)
            if deep[i] != deep[j]:
                x += UNBALANCED
            if x > best[j]:
                best[j], back[j] = x, i
        if full and points[j] - points[0] > FAR:
            for depth_of, x, i in far.best(j, deep):
                x += gain[j] + (UNBALANCED if depth_of != deep[j] else 0.0)
                if x > best[j]:
                    best[j], back[j] = x, i
        high[j] = max(high[j - 1], best[j])
    out, j = [], n - 1
    while j > 0:
        out.append(points[j])
        j = back[j]
    return out[::-1]


class Far:
    """Beginnings of long spans. Past FAR characters the cost of length is concave: a beginning that was once better than a later
    one stays better, so of each depth a stack is kept in which each gives way to the one below at a known point."""

    def __init__(self, points: list[int], best: list[float]) -> None:
        self.points, self.scores = points, best
        self.taken = 0
        self.stacks: dict[int, list[tuple[int, int]]] = {}  # (beginning, the point from which the one below is better)

    def value(self, i: int, j: int) -> float:
        off = (log(self.points[j] - self.points[i]) - TYPICAL) / SPREAD
        return self.scores[i] - 0.5 * off * off

    def crossing(self, older: int, newer: int, j: int) -> int:
        """The first point from j on at which the older beginning is at least as good."""
        low, high = j, len(self.points)
        while low < high:
            at = (low + high) // 2
            if self.value(older, at) >= self.value(newer, at):
                high = at
            else:
                low = at + 1
        return low

    def best(self, j: int, deep: list[int]) -> list[tuple[int, float, int]]:
        """(depth, score without the gain, beginning) of the best beginning of each depth for a long span to j."""
        while self.points[j] - self.points[self.taken] > FAR:
            i = self.taken
            self.taken += 1
            stack = self.stacks.setdefault(deep[i], [])
            at = len(self.points)
            while stack:
                at = self.crossing(stack[-1][0], i, j)
                if len(stack) > 1 and at >= stack[-1][1]:
                    stack.pop()  # before it is better than the new one, the one below it is
                    continue
                break
            if not stack or at > j:
                stack.append((i, at if stack else len(self.points)))
        out = []
        for depth_of, stack in self.stacks.items():
            while len(stack) > 1 and stack[-1][1] <= j:
                stack.pop()
            out.append((depth_of, self.value(stack[-1][0], j), stack[-1][0]))
        return out


def sentences(text: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit, from 0, end excluded."""
    out = []
    lower, backwards = is_lower(text), text[::-1]
    for a, b in blocks(text):
        for end in split_block(text, backwards, a, b, lower or b - a < len(text) and is_lower(text[a:b]), model):
            e = end
            while e > a and text[e - 1].isspace():
                e -= 1
            while a < e and text[a].isspace():
                a += 1
            if a < e:
                out.append((a, e))
            a = max(a, end)
    return out


CERTAIN = re.compile(rf"[!?。！？।؟][{CLOSERS}]?\s*(?=[^\W\d_])|(?<=[^\W\d_]{{5}})\.\s+(?=[^\W\d_])")
DOT = re.compile(r"\.(?=\s|$)")


def _evidence() -> Callable[[list[list]], list[tuple]]:
    def kernel(columns: list[list]) -> list[tuple]:
        every: Counter = Counter()  # whole words; what they are counted as is looked up once for each
        counts = [Counter() for _ in range(4)]
        for text in columns[0]:
            if not text or not text.strip():
                continue
            lower = is_lower(text)
            for a, b in blocks(text):
                body = text[a:b]
                if body.startswith("---") or len(body) < 40 and body[-1] not in ".!?。！？।؟…":
                    continue
                words = ANY_WORD.findall(body)
                if not words:
                    continue
                every.update(words)
                counts[OPEN][key(words[0])] += 1
                for m in CERTAIN.finditer(body):
                    nxt = body[m.end()]
                    if m[0][0] in "。！？।؟" and len(m[0].rstrip()) == 1 or not lower and nxt.isupper():
                        w = ANY_WORD.match(body, m.end())
                        if w:
                            counts[OPEN][key(w[0])] += 1
                backwards = body[::-1]
                for m in DOT.finditer(body):
                    w = last_word(backwards, 0, m.start())
                    if w and not w[0].isdigit():
                        k = w.rsplit("'", 1)[-1].rsplit("’", 1)[-1].lower()
                        counts[DOTTED][k] += 1
                        if m.end() == len(body):
                            counts[FINAL][k] += 1
        for w, n in every.items():
            counts[TOKEN][key(w)] += n
        out: list[tuple] = []
        for kind, c in enumerate(counts):
            by: Counter = Counter()
            for w, n in c.items():
                by[bucket(w)] += n
            out += [(kind, b, n) for b, n in by.items() if n]
        return out

    return kernel


def fit(texts: DataFrame, column: str = "text") -> Model:
    """Counts over all documents; at most 4 x 2^17 rows reach the driver, whatever the corpus."""
    rows = collected(map_batches(texts.where(has_text(column)), [column], _evidence, "kind int, bucket int, n bigint").groupBy("kind", "bucket").agg(F.sum("n").alias("n")))
    model = Model()
    model.counts[rows["kind"], rows["bucket"]] = rows["n"]
    return model


def split_documents(texts: DataFrame, model: Model, key_column: str = "doc_id", column: str = "text", with_text: bool = True) -> DataFrame:
    """(key, sentence_no, end_char, sentence) of every unit of every document; the text itself only if asked for."""
    spark: SparkSession = texts.sparkSession
    sent = spark.sparkContext.broadcast(model.counts)

    def start() -> Callable[..., list[tuple]]:
        m = Model(sent.value)

        def kernel(k, text):  # noqa: ANN001, ANN202
            return [(k, i + 1, e, text[a:e] if with_text else None) for i, (a, e) in enumerate(sentences(text, m))]

        return kernel

    kind = dict(texts.dtypes)[key_column]
    return map_rows(texts.where(has_text(column)), [key_column, column], start, f"`{key_column}` {kind}, sentence_no int, end_char bigint, sentence string")
