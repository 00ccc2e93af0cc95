"""Full-text search: postings, prefix-and match, BM25 ranks, snippets."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.functions.text import folded, has_text, let, tokens

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
#: Characters of a term by which the index is bucketed, and the number of buckets.
PREFIX, BUCKETS = 2, 64


def query_terms(query: str) -> list[str]:
    """Words of a query, folded; each matches as a prefix."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", re.sub(r"[^\w\s]|_", "", query)).lower() if not unicodedata.combining(c))
    return list(dict.fromkeys(plain.split()))


def terms(title: Column, transcript: Column) -> Column:
    """The folded words of a title and a transcript."""
    return tokens(folded(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(transcript, F.lit("")))))


def _starts(term: str):  # noqa: ANN202
    return lambda x: x.startswith(term)


def measures(*queries: str) -> dict[str, Column]:
    """What a search needs of a document, as numbers: its length, and how often each term of the queries begins a word.

    They are derived where the text is read, words being taken once; what comes out is some bytes a document, not its words.
    """
    wanted = list(dict.fromkeys(t for q in queries for t in query_terms(q)))
    counts = let(terms(F.col("title"), F.col("transcript")), lambda w: F.array(F.size(w), *(F.size(F.filter(w, _starts(t))) for t in wanted)))
    return {"found": counts}


def match(docs: DataFrame, *queries: str) -> DataFrame:
    """docs with found -> docs with length and tf_<term>."""
    wanted = list(dict.fromkeys(t for q in queries for t in query_terms(q)))
    return docs.select("*", F.col("found")[0].alias("length"), *(F.col("found")[i + 1].alias(f"tf_{t}") for i, t in enumerate(wanted))).drop("found")


def every(query: str) -> Column:
    """That all terms of a query begin some word; a query without terms matches nothing."""
    out = F.lit(bool(query_terms(query)))
    for t in query_terms(query):
        out = out & (F.col(f"tf_{t}") > 0)
    return out


def ranked(docs: DataFrame, query: str, n: int = 100) -> DataFrame:
    """(id, rank) of the best n of docs (id, found) by BM25; lower is better. Two scalars and a count for each term are aggregated."""
    wanted = query_terms(query)
    docs = match(docs, query)
    if not wanted:
        return docs.where("false").select("id", F.lit(0.0).alias("rank"))
    stats = docs.agg(F.count("*").alias("docs"), F.avg("length").alias("mean"), *(F.count_if(F.col(f"tf_{t}") > 0).alias(f"df_{t}") for t in wanted)).first()
    score = F.lit(0.0)
    for t in wanted:
        idf = F.greatest(F.log((F.lit(float(stats["docs"])) - stats[f"df_{t}"] + 0.5) / (F.lit(float(stats[f"df_{t}"])) + 0.5)), F.lit(LEAST_IDF))
        tf = F.col(f"tf_{t}")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(stats["mean"] or 1.0)))
    return docs.where(every(query)).select("id", F.round(-score, 6).alias("rank")).orderBy("rank", "id").limit(n)


def postings(videos: DataFrame, latest: DataFrame) -> DataFrame:
    """(term, id, n): how often each video's latest version has a term; copies count once, and counts are summed where the text is read."""
    rows = videos.withColumn("has_text", has_text(F.col("transcript"))).join(latest.select("id", "has_text"), ["id", "has_text"], "left_semi")
    each = rows.select("id", F.monotonically_increasing_id().alias("row"), terms(F.col("title"), F.col("transcript")).alias("terms")).select("id", "row", F.explode("terms").alias("term"))
    return each.groupBy("id", "row", "term").agg(F.count("*").alias("n")).groupBy("term", "id").agg(F.max("n").alias("n"))


def _bucket(start: Column) -> Column:
    return F.pmod(F.xxhash64(start), F.lit(BUCKETS)).cast("int")


def write_index(index: DataFrame, path: str) -> None:
    """Postings in buckets of their terms' beginnings, so that a search reads the few files that may have its terms."""
    index.withColumn("bucket", _bucket(F.substring("term", 1, PREFIX))).repartition("bucket").sortWithinPartitions("term", "id").write.partitionBy("bucket").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A written index; one without any term has no files, but the same columns."""
    return spark.read.schema("term string, id bigint, n bigint, bucket int").parquet(path)


def indexed(index: DataFrame, query: str) -> DataFrame:
    """(id): documents of a written index in which every term of the query begins some word; other buckets aren't read, but for terms shorter than a beginning."""
    found = None
    for t in query_terms(query):
        rows = index.where(F.col("term").startswith(t))
        if len(t) >= PREFIX:
            rows = rows.where(F.col("bucket") == _bucket(F.lit(t[:PREFIX])))
        ids = rows.select("id").distinct()
        found = ids if found is None else found.join(ids, "id", "left_semi")
    return index.where("false").select("id") if found is None else found


def snippet(videos: DataFrame, query: str, width: int = 64) -> DataFrame:
    """(id, snippet): the window of words with the most hits, hits in <b></b>, ... where it is cut."""
    terms = query_terms(query)
    w = F.filter(F.split("transcript", r"\s+"), lambda x: x != "")
    hit = lambda x: F.exists(F.array(*(F.lit(t) for t in terms)), lambda t: folded(F.regexp_replace(x, r"^[^\p{L}\p{N}]+", "")).startswith(t)) if terms else F.lit(False)
    docs = videos.where(F.col("transcript").isNotNull()).select("id", w.alias("w")).withColumn("hits", F.filter(F.transform("w", lambda x, i: F.when(hit(x), i)), lambda i: i.isNotNull())).where(F.size("hits") > 0)
    best = F.array_max(F.transform("hits", lambda s: F.struct(F.size(F.filter("hits", lambda h: (h >= s) & (h < s + width))).alias("n"), (-s).alias("neg"))))
    docs = docs.withColumn("start", F.greatest(F.lit(0), F.least(-best["neg"], F.size("w") - width)))
    shown = F.transform(F.slice("w", F.col("start") + 1, width), lambda x: F.when(hit(x), F.concat(F.lit("<b>"), x, F.lit("</b>"))).otherwise(x))
    return docs.select("id", F.concat(F.when(F.col("start") > 0, "...").otherwise(""), F.array_join(shown, " "), F.when(F.col("start") + width < F.size("w"), "...").otherwise("")).alias("snippet"))
