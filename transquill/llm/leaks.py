"""Problem 8: passages of evaluation items inside documents.

Documents are cut into windows of the items' sizes, and into windows half as long as the shortest passage that counts: a leak
may be a part of an item, and of a passage with one word changed, dropped or added one half is always whole. Each window has
a weighted 64-bit SimHash. The items' fingerprints lie in a multi-index of blocks: fingerprints within the radius share a
block, so no such pair is missed. A candidate is laid over the document by its place in the item, and verified by the
weighted shingles of the whole item and of the passage, and by the exact rule on the aligned words.

Defined results: null or blank texts on either side give no row; items shorter than a passage can't leak; a document that
holds an item several times gives one row; equal items give a row each; a near copy of a whole item without any passage
of the rule's length has run 0.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transquill.llm.rows import has_text, map_batches

# What counts as a leak.
PASSAGE_WORDS, PASSAGE_CHARS = 12, 20
# End of fixed values.

#: Window in words: any passage with one edit holds so many words on end. Window in characters: exact runs only.
WINDOW = PASSAGE_WORDS // 2
RADIUS, BLOCKS = 3, 4
#: Item-sized windows have the greatest of the sizes 12, 15, 18 ... that the item has; each size is a quarter above the last.
STEP = 1.25
#: Least weighted share of a passage's, or a whole item's, shingles that both sides have.
SIMILAR = 0.8
#: Documents whose windows are hashed at once.
CHUNK = 256
#: Most items that are sent to every task at once; more are sent in blocks, of which each meets all documents.
MOST_ITEM_BYTES = 64 << 20

TIME_MARK = re.compile(r"[\[(<]?\b\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\b[\])>]?")
CJK = re.compile("[぀-ヿ㐀-鿿]")


@lru_cache(65536)
def folded(c: str) -> str:
    """A character without case, accents, width and punctuation; blank for what parts words."""
    out = "".join(x for x in unicodedata.normalize("NFKD", c.casefold()) if not unicodedata.combining(x) or "゙" <= x <= "゚")
    out = unicodedata.normalize("NFC", out)
    return "".join(x if x.isalnum() or "゙" <= x <= "゚" else " " for x in out)


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        out = self[code] = "" if unicodedata.category(chr(code)) in ("Cf", "Mn") else folded(chr(code))
        return out


FOLD = _Fold()


def words(text: str) -> list[str]:
    if not text.isascii() and "̀" <= max(text):
        text = unicodedata.normalize("NFC", text)
    if ":" in text:
        text = TIME_MARK.sub(" ", text)
    return text.translate(FOLD).split()


def chars(text: str) -> str:
    """Letters and digits of a text in a script without spaces."""
    return "".join(words(text))


@lru_cache(500_000)
def weight(word: str) -> int:
    """Short words say little; numbers and long words say more."""
    return 1 if len(word) < 3 else 2 if len(word) < 6 else 3


def window_size(n: int, least: int) -> int:
    """The item-sized window of an item of n words."""
    size = least
    while (more := int(size * STEP)) <= n:
        size = more
    return size


class Fingerprints:
    """SimHash of all windows of a list of token lists at once."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((1024, 64), np.int8)

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.ids]
        if not new:
            return
        if len(self.ids) + len(new) > 400_000:
            self.ids.clear()
            new = list(tokens)
        first = len(self.ids)
        self.ids.update(zip(new, range(first, first + len(new))))
        while len(self.rows) < len(self.ids):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        raw = [t.encode("utf-8", "replace") for t in new]
        crc = np.array([(zlib.crc32(r), zlib.crc32(r, 0x9E3779B9)) for r in raw], "<u4")
        bits = np.unpackbits(crc.view(np.uint8).reshape(len(new), 8), axis=1)
        mixed = bits ^ np.roll(bits, 29, axis=1) ^ np.roll(bits, 11, axis=1)
        self.rows[first : first + len(new)] = np.where(mixed, 1, -1) * np.array([weight(t) for t in new], np.int8)[:, None]

    def of(self, lists: list[list[str]], *windows: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each window size (fingerprint, list, start) of every window."""
        sizes = [len(x) for x in lists]
        flat_tokens = list(chain.from_iterable(lists))
        self.learn(set(flat_tokens))
        flat = np.fromiter(map(self.ids.__getitem__, flat_tokens), np.int64, len(flat_tokens))
        kind = np.int16 if 3 * max(windows, default=0) < 32_000 else np.int32  # differences are exact even where sums wrap around
        total = np.zeros((len(flat) + 1, 64), kind)
        np.cumsum(self.rows[flat], axis=0, dtype=kind, out=total[1:])
        owner = np.repeat(np.arange(len(lists)), sizes)
        start = np.arange(len(flat)) - np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) if sizes else np.zeros(0, np.int64)
        out = []
        for window in windows:
            if len(flat) < window:
                out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            at = np.nonzero(owner[: len(flat) - window + 1] == owner[window - 1 :])[0]
            prints = np.packbits((total[at + window] - total[at]) > 0, axis=1).view(np.uint64).ravel()
            out.append((prints, owner[at], start[at]))
        return out


class Index:
    """Fingerprints by each of their blocks; finds all within the radius."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        self.width = 64 // BLOCKS
        self.tables = []
        for b in range(BLOCKS):
            block = self.block(prints, b)
            order = np.argsort(block, kind="stable")
            first = np.searchsorted(block[order], np.arange((1 << self.width) + 1))
            self.tables.append((order, first))

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in prints, position in the index), each once."""
        left, right = [], []
        for b, (order, first) in enumerate(self.tables):
            block = self.block(prints, b)
            n = first[block + 1] - first[block]
            hit = np.nonzero(n)[0]
            if not len(hit):
                continue
            of = np.repeat(hit, n[hit])
            at = np.arange(len(of)) - np.repeat(np.cumsum(n[hit]) - n[hit], n[hit]) + np.repeat(first[block[hit]], n[hit])
            to = order[at]
            near = np.bitwise_count(prints[of] ^ self.prints[to]) <= RADIUS
            left.append(of[near])
            right.append(to[near])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def aligned(doc: list[str], item: list[str], i: int, j: int) -> tuple[int, int, int, int]:
    """The longest passage through doc[i], item[j] with at most one inner edit: (words of the item, item start, doc start, doc end)."""
    if doc[i] != item[j]:
        return 0, j, i, i
    a, b = i, j
    while a > 0 and b > 0 and doc[a - 1] == item[b - 1]:
        a, b = a - 1, b - 1
    c, d = i + 1, j + 1
    while c < len(doc) and d < len(item) and doc[c] == item[d]:
        c, d = c + 1, d + 1
    best = (d - b, b, a, c)
    for x, y in ((1, 1), (0, 1), (1, 0)):  # changed, dropped, added
        p, q, n = a - 1 - x, b - 1 - y, 0
        while p >= 0 and q >= 0 and doc[p] == item[q]:
            p, q, n = p - 1, q - 1, n + 1
        if n and (d - q - 1) > best[0]:
            best = (d - q - 1, q + 1, p + 1, c)
        p, q, n = c + x, d + y, 0
        while p < len(doc) and q < len(item) and doc[p] == item[q]:
            p, q, n = p + 1, q + 1, n + 1
        if n and q - b > best[0]:
            best = (q - b, b, a, p)
    return best


def similarity(left: list[str], right: list[str], whole: bool = False) -> float:
    """Weighted share of the shingles of one and two words that both have: of the smaller side, or of both together."""

    def shingles(x: list[str]) -> dict[tuple[str, ...], int]:
        out: dict[tuple[str, ...], int] = {}
        for k in range(len(x)):
            out[(x[k],)] = out.get((x[k],), 0) + 2 * weight(x[k])
            if k + 1 < len(x):
                out[(x[k], x[k + 1])] = out.get((x[k], x[k + 1]), 0) + 1
        return out

    p, q = shingles(left), shingles(right)
    both = sum(min(v, q.get(k, 0)) for k, v in p.items())
    one, other = sum(p.values()), sum(q.values())
    return both / max(1, one + other - both if whole else min(one, other))


class Side:
    """Items of one kind of script with the indexes of their windows: those of a part of a passage, and item-sized ones."""

    def __init__(self, prints: Fingerprints, rows: list[tuple[int, list[str]]], part: int, least: int) -> None:
        self.rows = rows
        by_size: dict[int, list[int]] = {}
        for i, (_, w) in enumerate(rows):
            by_size.setdefault(window_size(len(w), least), []).append(i)
        self.windows = [part, *sorted(by_size)] if rows else []
        self.tables = []
        for size in self.windows:
            own = list(range(len(rows))) if size == part else by_size[size]
            f, of, at = prints.of([rows[i][1] for i in own], size)[0]
            self.tables.append((Index(f), np.array(own, np.int64)[of], at))

    def candidates(self, prints: Fingerprints, lists: list[list[str]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(window, document, item, place in the document, place in the item) of windows within the radius."""
        if not self.windows:
            return
        for size, (f, owner, start), (index, of, at) in zip(self.windows, prints.of(lists, *self.windows), self.tables):
            w, x = index.within(f)
            yield from zip([size] * len(w), owner[w].tolist(), of[x].tolist(), start[w].tolist(), at[x].tolist())


def over(doc: list[str], item: list[str], shift: int) -> float:
    """How alike the whole item and what lies under it in the document are."""
    return similarity(doc[max(0, shift) : max(0, shift + len(item))], item, whole=True)


class Items:
    """The items' words and characters with their indexes."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.prints = Fingerprints()
        self.spaced = Side(self.prints, [(k, w) for k, t in rows if not CJK.search(t) and len(w := words(t)) >= PASSAGE_WORDS], WINDOW, PASSAGE_WORDS)
        self.chars = [(k, c) for k, t in rows if CJK.search(t) and len(c := chars(t)) >= PASSAGE_CHARS]
        self.dense = Side(self.prints, [(k, self.grams(c)) for k, c in self.chars], PASSAGE_CHARS - 1, PASSAGE_CHARS)

    @staticmethod
    def grams(text: str) -> list[str]:
        return [text[i : i + 2] for i in range(len(text) - 1)]

    def leaks(self, docs: list[tuple[int, str]]) -> Iterator[tuple[int, int, int, float, float]]:
        """(document, item, words or characters on end, similarity of the passage, of the whole item), each pair once."""
        lists = [words(t) for _, t in docs]

        def spaced(d: int, n: int, i: int, j: int, size: int) -> tuple[int, float]:
            doc, item = lists[d], self.spaced.rows[n][1]
            for k in range(size):
                run, b, p, q = aligned(doc, item, i + k, j + k)
                if run >= PASSAGE_WORDS and (s := similarity(doc[p:q], item[b : b + run])) >= SIMILAR:
                    return run, s
            return 0, 0.0

        for (d, n), found in self._verified(self.spaced, lists, spaced).items():
            yield docs[d][0], self.spaced.rows[n][0], *found
        dense = [(d, c) for d, (_, t) in enumerate(docs) if self.chars and CJK.search(t) and len(c := "".join(lists[d])) >= PASSAGE_CHARS]

        def close(d: int, n: int, i: int, j: int, size: int) -> tuple[int, float]:
            doc, item = dense[d][1], self.chars[n][1]
            best = (0, 0.0)
            for k in range(max(1, size - PASSAGE_CHARS + 2)):
                if doc[i + k : i + k + PASSAGE_CHARS] == item[j + k : j + k + PASSAGE_CHARS] and len(item) >= j + k + PASSAGE_CHARS:
                    p, q = i + k + PASSAGE_CHARS, j + k + PASSAGE_CHARS
                    while p < len(doc) and q < len(item) and doc[p] == item[q]:
                        p, q = p + 1, q + 1
                    return q - j - k, similarity(list(doc[i + k : p]), list(item[j + k : q]))
            return best

        for (d, n), found in self._verified(self.dense, [self.grams(c) for _, c in dense], close).items():
            yield docs[dense[d][0]][0], self.chars[n][0], *found

    def _verified(self, side: Side, lists: list[list[str]], passage: Callable[[int, int, int, int, int], tuple[int, float]]) -> dict[tuple[int, int], tuple[int, float, float]]:
        """The longest passage and the likest place of each pair; of windows on one diagonal the first tells."""
        best: dict[tuple[int, int], tuple[int, float, float]] = {}
        told: dict[tuple[int, int, int], float] = {}
        passed: set[tuple[int, int, int]] = set()
        for size, d, n, i, j in side.candidates(self.prints, lists):
            at = d, n, i - j
            if at in passed:
                continue
            run, s = passage(d, n, i, j, size)
            if at not in told:
                told[at] = over(lists[d], side.rows[n][1], i - j)
            if run:
                passed.add(at)
            if run or told[at] >= SIMILAR:
                old = best.get((d, n), (0, 0.0, 0.0))
                best[d, n] = *max(old[:2], (run, s)), max(old[2], told[at])
        return best


def find_leaks(documents: DataFrame, items: DataFrame, most_bytes: int = MOST_ITEM_BYTES) -> DataFrame:
    """documents (doc_id, text), items (item_id, text): (doc_id, item_id, run, similarity, whole).

    Items of more than most_bytes are cut into blocks by their hash; each block is read by all documents' windows.
    """
    small = items.where(has_text("text")).select("item_id", "text")
    size = small.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // most_bytes) or 1
    return reduce(DataFrame.unionAll, (_in_block(documents, small.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else small) for b in range(blocks)))


def _in_block(documents: DataFrame, small: DataFrame) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast([tuple(r) for r in small.collect()])

    def start() -> Callable[[list[list]], Iterator[tuple]]:
        found = Items(sent.value)

        def kernel(columns: list[list]) -> Iterator[tuple]:
            ids, texts = columns
            for a in range(0, len(ids), CHUNK):
                yield from found.leaks(list(zip(ids[a : a + CHUNK], texts[a : a + CHUNK])))

        return kernel

    return map_batches(documents.where(has_text("text")), ["doc_id", "text"], start, "doc_id bigint, item_id bigint, run int, similarity double, whole double")
