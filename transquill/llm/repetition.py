"""Problem 5: repetition inside a single document, with verdicts by host.

Each document is measured (share of words in runs that occurred before, of repeated lines) and held
against rules. Failures are counted by host; each host's rate is shrunk towards the others by a beta prior whose two
parameters are estimated from all hosts by moments; the host's verdict is joined back to its documents: the higher the
host's rate, the lower the share from which a document is suspect. An exact rule on the document's own share may follow.

Defined results: null or blank texts give no row; a text shorter than a run has share 0; documents without a host form the
host null; with no host, or none that fails, the prior is flat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, repeat

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transquill.llm.mojibake import Model, restorer
from transquill.llm.rows import has_text, map_batches, stored

# Words, or characters of scripts without spaces, on end that make a run; the share from which a rule fails.
RUN_WORDS, RUN_CHARS = 8, 20
LIMITS = {"runs": 0.3, "lines": 0.3}
# End of fixed values.

#: Copies of each host's row, so that a host with a third of all documents is spread over tasks.
SALTS = 16
#: Texts that are looked at at once.
CHUNK = 512
#: Words of at most 64 characters whose hashes a task keeps, as the same ones come again; and the hash of none, which no word has.
KEPT, NOTHING = 200_000, -1
#: A run's hash is made of those of its parts.
FACTORS = {RUN_WORDS: (2, 2, 2), RUN_CHARS: (2, 2, 5)}
DENSE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]+")
NO_UNIT = regex.compile(r"[^\p{L}\p{N}\p{M}]+")
HIGH = regex.compile("[\u0e00-\U0010ffff]{4}")
EDGES = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»“”‘’‚‛„‟–—―…¿¡·•。，、！？「」『』（）：；،؛؟।♪♫\u00a0\u200b"


def by_chars(text: str) -> bool:
    """Whether characters are counted, as most are of scripts without spaces."""
    return not text.isascii() and bool(HIGH.search(text)) and sum(map(len, DENSE.findall(text))) * 2 > len(text) * 0.8


def units_of(text: str) -> tuple[list[str] | str, int]:
    """What is counted, words or characters, and how many of them on end make a run."""
    if by_chars(text):
        return NO_UNIT.sub("", text.lower()), RUN_CHARS
    return list(filter(None, map(str.strip, text.lower().split(), repeat(EDGES)))), RUN_WORDS


class Hashes(dict):
    """The hash of each word without the signs at its edges, as it is met; NOTHING if no more than signs."""

    def __missing__(self, word: str) -> int:
        bare = word.strip(EDGES)
        h = hash(bare) if bare else NOTHING
        if len(self) < KEPT and len(word) <= 64:
            self[word] = h
        return h


def _hashes(texts: list[str], known: Hashes) -> tuple[np.ndarray, np.ndarray, list[bool]]:
    """A hash of each unit of all texts, the text that each is in, and which texts are counted by characters."""
    chars = [by_chars(t) for t in texts]
    words = [[] if c else t.lower().split() for t, c in zip(texts, chars)]
    counts = [len(w) for w in words]
    h = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, sum(counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    kept = h != NOTHING
    each, owners = [h[kept]], [owner[kept]]
    for i in (i for i, c in enumerate(chars) if c):
        each.append(np.frombuffer(units_of(texts[i])[0].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64))
        owners.append(np.full(len(each[-1]), i))
    return np.concatenate(each), np.concatenate(owners), chars


def _rolled(h: np.ndarray, factors: tuple[int, ...]) -> np.ndarray:
    """A hash of each run of as many units as the factors' product."""
    step, power = 1, 0x9E3779B97F4A7C15
    for f in factors:
        n, whole = len(h) - (f - 1) * step, h
        h = whole[:n]
        for k in range(1, f):
            h = h * np.uint64(power) + whole[k * step : k * step + n]
        step, power = step * f, pow(power, f, 1 << 64)
    return h


def copies(texts: list[str], known: Hashes) -> list[list[int]]:
    """For each text where its runs begin whose hash another of its runs has; all others are there once. All texts at once."""
    h, owner, chars = _hashes(texts, known)
    out: list[list[int]] = [[] for _ in texts]
    of_chars = np.array(chars, bool)[owner]
    for size, own in ((RUN_WORDS, ~of_chars), (RUN_CHARS, of_chars)):
        units, text = h[own].view(np.uint64), owner[own]
        if len(units) <= size:
            continue
        first = np.searchsorted(text, np.arange(len(texts)))
        roll = _rolled(units, FACTORS[size])
        within = np.flatnonzero(text[: len(roll)] == text[size - 1 :])
        key = roll[within] ^ (text[within].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        top = np.zeros(1 << 16, bool)  # few keys begin as one of these, so only those are sought
        top[twice >> np.uint64(48)] = True
        maybe = np.flatnonzero(top[key >> np.uint64(48)])
        maybe = maybe[twice[np.minimum(np.searchsorted(twice, key[maybe]), len(twice) - 1)] == key[maybe]]
        at = within[maybe]
        starts = (at - first[text[at]]).tolist()
        bounds = np.searchsorted(text[at], np.arange(len(texts) + 1)).tolist()
        for i, (x, y) in enumerate(zip(bounds, bounds[1:])):
            if x < y:
                out[i] = starts[x:y]
    return out


def repeated_share(text: str) -> float:
    """Share of words (or characters, in scripts without spaces) in runs that occurred earlier."""
    return share_of(*units_of(text)) if text else 0.0


def share_of(units: list[str] | str, size: int, starts: Iterable[int] | None = None) -> float:
    """starts: where the runs begin that may be there twice, if known."""
    n = len(units)
    if n <= size:
        return 0.0
    seen: set = set()
    marked, until = 0, 0
    for i in range(n - size + 1) if starts is None else starts:
        g = units[i : i + size] if isinstance(units, str) else tuple(units[i : i + size])
        if g in seen:
            marked += i + size - max(i, until)
            until = i + size
        else:
            seen.add(g)
    return marked / n


def measures(texts: list[str], known: Hashes | None = None) -> list[tuple[float, float]]:
    """For each text the shares of repeated runs and of repeated lines (by length)."""
    return [(share_of(*units_of(t), starts) if starts else 0.0, repeated_lines(t)) for t, starts in zip(texts, copies(texts, Hashes() if known is None else known))]


def repeated_lines(text: str) -> float:
    if "\n" not in text:
        return 0.0
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    total = sum(map(len, lines))
    return (total - sum(map(len, set(lines)))) / total if total else 0.0


def measure(texts: DataFrame, model: Model, key: str = "video_id", host: str = "host", column: str = "text") -> DataFrame:
    """(key, host, runs, lines), once for each key; garbled passages count as restored."""
    make = restorer(texts.sparkSession, model)

    def start() -> Callable[[list[list]], list[tuple]]:
        r, known = make(), Hashes()

        def kernel(columns: list[list]) -> list[tuple]:
            out = []
            for a in range(0, len(columns[0]), CHUNK):
                ids, hosts, texts_ = (c[a : a + CHUNK] for c in columns)
                out += [(k, h, *m) for k, h, m in zip(ids, hosts, measures(r.restored(texts_), known))]
            return out

        return kernel

    kinds = dict(texts.dtypes)
    out = map_batches(texts.where(has_text(column)), [key, host, column], start, f"`{key}` {kinds[key]}, `{host}` {kinds[host]}, runs double, lines double")
    return out.dropDuplicates([key])


def measure_lines(texts: DataFrame, key: str = "video_id", host: str = "host", column: str = "text") -> DataFrame:
    """(key, host, lines): the share of repeated lines alone, of the text as it is; without Python."""
    lines = F.filter(F.transform(F.split(column, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    chars = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.length(x))
    rows = texts.where(has_text(column)).select(key, host, lines.alias("l")).select(key, host, chars(F.col("l")).alias("n"), chars(F.array_distinct("l")).alias("first"))
    return rows.select(key, host, ((F.col("n") - F.col("first")) / F.greatest(F.col("n"), F.lit(1))).alias("lines")).dropDuplicates([key])


def with_failures(measured: DataFrame) -> DataFrame:
    """Adds failed: the rules beyond whose limit the document is."""
    return measured.withColumn("failed", F.array_compact(F.array(*(F.when(F.col(k) >= v, F.lit(k)) for k, v in LIMITS.items() if k in measured.columns))))


def hosts(docs: DataFrame, host: str = "host", limit: float = 0.25) -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_bad, host_limit): each host's failures, its shrunk rate, and the share from which its documents are suspect.

    Only counts by host are shuffled, summed within tasks first; what reaches the driver is one row of moments.
    """
    counts = docs.groupBy(host).agg(F.count("*").alias("host_docs"), F.count_if(F.size("failed") > 0).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    m = counts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("var"), F.avg(rate * (1 - rate) / F.col("host_docs")).alias("noise")).first()
    a, b = beta_prior(m["mean"], m["var"], m["noise"])
    counts = counts.withColumn("host_rate", (F.col("host_failed") + F.lit(a)) / (F.col("host_docs") + F.lit(a + b)))
    return counts.withColumn("host_bad", F.col("host_rate") >= limit).withColumn("host_limit", F.lit(min(LIMITS.values())) * (1 - F.col("host_rate")))


def judge(measured: DataFrame, key: str = "video_id", host: str = "host", limit: float = 0.25) -> DataFrame:
    """Adds failed (rules), what hosts() says of the document's host, and suspect to each document; the join is salted."""
    docs = with_failures(stored(measured))
    verdicts = hosts(docs, host, limit)
    columns = verdicts.columns[1:]
    salted = verdicts.select(F.col(host).alias("__host"), *columns, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    docs = docs.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    joined = docs.join(salted, docs[host].eqNullSafe(salted["__host"]) & (docs["__salt"] == salted["__salt"]))
    return joined.select(key, host, *LIMITS, "failed", *columns, (F.greatest(*LIMITS) >= F.col("host_limit")).alias("suspect"))


def beta_prior(mean: float | None, var: float | None, noise: float | None) -> tuple[float, float]:
    """Parameters of the beta distribution of hosts' true rates, by moments; sampling noise is taken off first."""
    if mean is None or not 0 < mean < 1:
        return 1.0, 1.0
    true = max((var or 0.0) - (noise or 0.0), 1e-4)
    strength = min(1000.0, max(1.0, mean * (1 - mean) / true - 1))
    return mean * strength, (1 - mean) * strength
