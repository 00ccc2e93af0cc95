"""Problem 9: sources combined to target shares of all tokens.

A classifier fitted on the labelled documents gives each document without a usable source its posterior over the sources;
labelled ones are certain of theirs. Nonnegative rates of use up to the caps are then fitted by projected gradient steps on
the squares of what each source's expected tokens miss of its goal, each divided by the source's tokens. The gradient is
taken with a document's tokens as its unit of length; in it the step is 1 / L with L = 1, as posteriors sum to one. So all
documents of one label have one rate, which needs no pass over them, and a step sums over the unlabelled ones alone. The
rates follow from the steps' history, so nothing is written in between. A rate becomes a whole number of uses by the hash
of its document; within a source the hash is cut where the tokens used are nearest to those that the rates expect.

The goals: a target without labelled documents can't be met; its share is spread over the others in proportion, and the
total is what the scarcest target allows.

Defined results: null or blank texts are not used; a source without target, and a target without documents, get share 0;
shares are stated of the tokens used; with no document for any target nothing is used and shares are 0; a null or negative
target or cap counts as 0.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transquill.llm.rows import collected, has_text, map_batches, stored

#: Where the public vocabulary lies on each node, and how it parts words; parameters of the operator.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FEATURES = 1 << 14
#: Most steps, and the miss of the total at which they end.
STEPS, CLOSE = 24, 1e-4
#: Parts into which the hash of a source's documents is cut to find its threshold.
BINS = 4096
#: Most sources; their targets are a small table by nature, and its size is checked.
MOST_SOURCES = 500
WORD = re.compile(r"[^\W\d_]{2,}|[぀-ヿ㐀-鿿]")


def clean_source(source: Column) -> Column:
    """A source's name without blanks and in one letter case, for matching."""
    name = F.lower(F.trim(F.regexp_replace(source, r"^[\s ]+|[\s ]+$", "")))
    return F.when(name != "", name)


def token_counts(path: str, pattern: str = PATTERN) -> Callable[[list[str]], list[int]]:
    """A function that counts the tokens of texts; strings of special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]


def features(text: str) -> np.ndarray:
    """Hashed words of a text, each once."""
    return np.array(list({zlib.crc32(w.encode()) & (FEATURES - 1) for w in set(WORD.findall(text.lower()))}), np.int64)


def _counts(known: dict[str, int]) -> Callable[[], Callable[[list[list]], list[tuple]]]:
    def make() -> Callable[[list[list]], list[tuple]]:
        def kernel(columns: list[list]) -> list[tuple]:
            total: dict[int, np.ndarray] = {}
            docs: dict[int, int] = {}
            for source, text in zip(*columns):
                k = known.get(source)
                if k is not None:
                    total.setdefault(k, np.zeros(FEATURES, np.int64))[features(text)] += 1
                    docs[k] = docs.get(k, 0) + 1
            out = [(k, -1, n) for k, n in docs.items()]
            for k, c in total.items():
                at = np.nonzero(c)[0]
                out += zip([k] * len(at), at.tolist(), c[at].tolist())
            return out

        return kernel

    return make


class Classifier:
    """Bernoulli naive Bayes over hashed words; tempered, as words of a text depend on each other."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray, temper: float = 0.1) -> None:
        rate = (counts + 0.2) / (docs[:, None] + 0.4)
        self.on = (np.log(rate) - np.log1p(-rate)).astype(np.float32)
        self.base = np.log1p(-rate).sum(axis=1) * temper + np.log((docs + 1.0) / (docs.sum() + len(docs)))
        self.temper = temper

    def posterior(self, text: str) -> np.ndarray:
        x = self.base + self.temper * self.on[:, features(text)].sum(axis=1)
        p = np.exp(x - x.max())
        return p / p.sum()


def prepare(documents: DataFrame, sources: list[str], targeted: set[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, own, tokens, labelled, post): own source or the likeliest, tokens, and where unlabelled the posterior over sources."""
    spark: SparkSession = documents.sparkSession
    known = {s: i for i, s in enumerate(sources)}
    docs = documents.where(has_text("text")).select("doc_id", clean_source(F.col("source")).alias("src"), "text")
    rows = collected(map_batches(docs.where(F.col("src").isNotNull()), ["src", "text"], _counts(known), "k int, bucket int, n bigint").groupBy("k", "bucket").agg(F.sum("n").alias("n")))
    counts, sizes = np.zeros((len(sources), FEATURES), np.float32), np.zeros(len(sources))
    body = rows["bucket"] >= 0
    counts[rows["k"][body], rows["bucket"][body]] = rows["n"][body]
    sizes[rows["k"][~body]] = rows["n"][~body]
    sent = spark.sparkContext.broadcast((counts, sizes))

    def make() -> Callable[[list[list]], list[tuple]]:
        count, model = token_counts(tokenizer), Classifier(*sent.value)

        def kernel(columns: list[list]) -> list[tuple]:
            out = []
            for i, s, t, n in zip(*columns, count(columns[2])):
                if s in known:
                    out.append((i, known[s], n, True, None))
                else:
                    p = model.posterior(t)
                    out.append((i, int(p.argmax()), n, False, p.tolist()))
            return out

        return kernel

    return map_batches(docs, ["doc_id", "src", "text"], make, "doc_id bigint, own int, tokens bigint, labelled boolean, post array<double>")


def stepped(start: np.ndarray, cap: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates after all projected steps so far."""
    r = np.minimum(cap, start)
    for move in moves:
        r = np.clip(r - move, 0.0, cap)
    return r


def open_rates(post: np.ndarray, cap: np.ndarray, start: float, history: list[np.ndarray]) -> np.ndarray:
    """Rates of documents that are known by their posteriors."""
    return stepped(np.full(len(post), start), cap, [post @ step for step in history])


def fit_rates(sure: np.ndarray, soft: np.ndarray, goal: np.ndarray, cap: np.ndarray, expected: Callable[[float, list[np.ndarray]], np.ndarray]) -> tuple[float, list[np.ndarray], np.ndarray]:
    """(first rate, the steps, the tokens that each source may expect after them).

    sure: tokens by label; soft: with those of unlabelled documents by posterior; expected(start, steps): what these give.
    """
    able = goal > 0
    start = float(goal.sum() / soft[able].sum()) if able.any() else 0.0
    scale = np.maximum(np.where(able, soft, 1e18), 1.0)
    history: list[np.ndarray] = []
    while True:
        got = stepped(np.full(len(goal), start), cap, history) * sure + expected(start, history)
        if not able.any() or len(history) == STEPS or np.abs((got - goal)[able]).max() <= CLOSE * goal.sum():
            return start, history, got
        history.append(np.where(able, (got - goal) / scale, 0.0))


def mix(documents: DataFrame, weights: DataFrame, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, repeats) of the documents that are used, and by source (source, target_share, goal_share, expected_share, actual_share, tokens, docs, uses, max_repeats, converged).

    Expected and actual shares count an unlabelled document by its posterior; tokens, docs and uses by its likeliest source.
    """
    spark: SparkSession = documents.sparkSession
    targets = weights.select(F.trim("source").alias("name"), clean_source(F.col("source")).alias("src"), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("cap")).where(F.col("src").isNotNull()).groupBy("src").agg(F.min("name").alias("name"), F.sum("share").alias("share"), F.min("cap").alias("cap")).limit(MOST_SOURCES + 1).collect()
    found = documents.where(has_text("text")).select(clean_source(F.col("source")).alias("src")).where(F.col("src").isNotNull()).distinct().limit(MOST_SOURCES + 1).collect()
    if len(targets) > MOST_SOURCES or len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    names = {t["src"]: t["name"] for t in targets}
    sources = sorted({t["src"] for t in targets} | {f["src"] for f in found})
    n = len(sources)
    at = {s: i for i, s in enumerate(sources)}
    share, cap = np.zeros(n), np.zeros(n)
    for t in targets:
        share[at[t["src"]]], cap[at[t["src"]]] = t["share"], t["cap"]
    docs = stored(prepare(documents, sources, set(names), tokenizer))
    unlabelled = docs.where("not labelled")

    def by_source(df: DataFrame, value) -> np.ndarray:  # noqa: ANN001
        out = np.zeros(n)
        for row in df.groupBy("k").agg(F.sum(value).alias("n")).collect():
            out[row["k"]] = row["n"]
        return out

    sure = by_source(docs.where("labelled").withColumnRenamed("own", "k"), F.col("tokens"))
    spread = lambda df, *more: df.select(*more, "tokens", F.posexplode("post").alias("k", "p"))
    soft = sure + by_source(spread(unlabelled), F.col("p") * F.col("tokens"))
    able = (share > 0) & (cap > 0) & (sure > 0)  # only what is labelled is sure to be there
    part = np.where(able, share, 0.0) / max(share[able].sum(), 1e-12)
    total = float((cap[able] * sure[able] / part[able]).min()) if able.any() else 0.0
    doc_cap = np.where(able, cap, 0.0)

    def expected(start: float, history: list[np.ndarray]) -> np.ndarray:
        def make() -> Callable[[list[list]], list[tuple]]:
            def kernel(columns: list[list]) -> list[tuple]:
                own, tokens, post = columns
                p = np.array(post, float).reshape(-1, n)
                return list(enumerate(((open_rates(p, doc_cap[own], start, history) * tokens) @ p).tolist()))

            return kernel

        return by_source(map_batches(unlabelled, ["own", "tokens", "post"], make, "k int, n double"), F.col("n"))

    start, history, got = fit_rates(sure, soft, part * total, doc_cap, expected)
    of_label = stepped(np.full(n, start), doc_cap, history).tolist()

    def rate_rows() -> Callable[[list[list]], list[tuple]]:
        def kernel(columns: list[list]) -> list[tuple]:
            ids, own, tokens, post = columns
            rate = [of_label[k] for k in own]
            some = [i for i, p in enumerate(post) if p is not None]
            if some:
                p = np.array([post[i] for i in some], float).reshape(-1, n)
                for i, r in zip(some, open_rates(p, doc_cap[[own[i] for i in some]], start, history).tolist()):
                    rate[i] = r
            return list(zip(ids, own, tokens, post, rate))

        return kernel

    rates = map_batches(docs, ["doc_id", "own", "tokens", "post"], lambda: rate_rows(), "doc_id bigint, own int, tokens bigint, post array<double>, rate double")
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rates = rates.withColumn("whole", F.floor("rate")).withColumn("v", u - (F.col("rate") - F.col("whole"))).withColumn("bin", F.floor((F.col("v") + 1) * (BINS / 2)).cast("int"))
    more = F.when(F.col("rate") > F.col("whole"), F.col("tokens")).otherwise(0)  # a part of a use is above the cap nowhere
    bins = rates.groupBy("own", "bin").agg(F.sum(more).alias("more"), F.sum((F.col("rate") - F.col("whole")) * F.col("tokens")).alias("want")).toPandas()
    cut = {}
    for own, rows in bins.groupby("own"):
        rows = rows.sort_values("bin")
        sums, want = np.concatenate([[0.0], rows["more"].cumsum().to_numpy()]), rows["want"].sum()
        k = int(np.abs(sums - want).argmin())
        cut[int(own)] = int(rows["bin"].to_numpy()[k - 1]) if k else -1
    as_map = lambda d, kind: F.create_map(*(F.lit(x) for pair in d.items() for x in pair)) if d else F.lit(None).cast(kind)
    uses = F.col("whole") + F.when((F.col("rate") > F.col("whole")) & (F.col("bin") <= as_map(cut, "map<int,int>")[F.col("own")]), 1).otherwise(0)
    label = as_map({i: names.get(s, s) for i, s in enumerate(sources)}, "map<int,string>")
    used = rates.withColumn("repeats", uses.cast("int")).where("repeats > 0")
    mixture = used.select("doc_id", label[F.col("own")].alias("source"), "tokens", "repeats")
    listed = mixture.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("docs"), F.sum("repeats").alias("uses"))
    weight = F.col("tokens") * F.col("repeats")
    each = F.when(F.col("post").isNull(), F.array(F.struct(F.col("own").alias("k"), F.lit(1.0).alias("p")))).otherwise(F.transform("post", lambda p, i: F.struct(i.alias("k"), p.alias("p"))))
    actual = used.select(weight.alias("w"), F.explode(each).alias("e")).groupBy(label[F.col("e.k")].alias("source")).agg(F.sum(F.col("w") * F.col("e.p")).alias("held"))
    close = bool(not able.any() or np.abs((got - part * total)[able]).max() <= CLOSE * total)
    goals = spark.createDataFrame([(names[t["src"]], float(t["share"]), float(part[at[t["src"]]]), float(got[at[t["src"]]] / max(got.sum(), 1e-12)), int(t["cap"]), close) for t in targets], "source string, target_share double, goal_share double, expected_share double, max_repeats int, converged boolean")
    every = Window.partitionBy(F.lit(1))  # as many rows as there are sources
    both = actual.withColumn("all", F.sum("held").over(every)).join(listed, "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    shares = goals.join(F.broadcast(both), "source", "left").select("source", "target_share", "goal_share", "expected_share", F.coalesce(F.col("held") / F.col("all"), F.lit(0.0)).alias("actual_share"), zero("tokens"), zero("docs"), zero("uses"), "max_repeats", "converged")
    return mixture, shares
