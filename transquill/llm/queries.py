"""Queries over the problems' tables: name -> (spark, sf_dir) -> DataFrame. SQL stands beside a query where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.llm import languages, leaks, lookalikes, markup, mixing, mojibake, repetition, residue, sentences, turns
from transquill.llm.rows import has_text, transcripts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def video_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, field, text) of titles and transcripts, from one scan of videos."""
    videos = _table(spark, sf_dir, "videos").select("id", "title", "transcript")
    pair = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("title", "transcript")))
    return videos.select(F.col("id").alias("video_id"), F.explode(pair).alias("p")).select("video_id", "p.field", "p.text")


def _lookalikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.find_lookalikes(video_fields(spark, sf_dir), mojibake.fit(transcripts(spark, sf_dir)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookalikes(spark, sf_dir).select("video_id", "field").distinct()


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each changed field in its consistent form."""
    return _lookalikes(spark, sf_dir).dropDuplicates(["video_id", "field"])


def _turns(spark: SparkSession, sf_dir: str, with_speech: bool) -> DataFrame:
    """Turns of transcripts and of caption files; each row's turns are numbers of a few bytes unless their speech is asked for."""
    columns = ["turn_no", "speaker_no", *(["label", "start", "speech"] if with_speech else [])]
    captions = _table(spark, sf_dir, "raw_captions").where(has_text("raw_text")).select(turns.path_id(F.col("raw_path")).alias("youtube_id"), F.col("raw_text").alias("text"))
    weights = turns.fit(captions)
    of_text = turns.find_turns(transcripts(spark, sf_dir), "transcript", weights).select("video_id", F.lit("transcript").alias("field"), *columns)
    of_files = turns.find_turns(captions, "captions", weights, key="youtube_id").select("youtube_id", *columns).distinct()
    ids = _table(spark, sf_dir, "videos").select("youtube_id", F.col("id").alias("video_id")).distinct()
    return of_text.unionByName(of_files.join(ids, "youtube_id").select("video_id", F.lit("raw_path").alias("field"), *columns))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, with_speech=False).distinct()


def p2_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with their clean speech."""
    return _turns(spark, sf_dir, with_speech=True).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = transcripts(spark, sf_dir)
    return mojibake.find_garbled(texts, mojibake.fit(texts)).select("video_id").distinct()


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled transcripts, restored where possible."""
    texts = transcripts(spark, sf_dir)
    return mojibake.find_garbled(texts, mojibake.fit(texts)).dropDuplicates(["video_id"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(transcripts(spark, sf_dir)).select("video_id").distinct()


def p4_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The videos left after those with residue are excluded."""
    return transcripts(spark, sf_dir).select("video_id").distinct().join(p4_found(spark, sf_dir), "video_id", "left_anti")


def _hosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "videos").where(has_text("transcript")).select(F.col("id").alias("video_id"), F.col("channel_id").alias("host"), F.col("transcript").alias("text"))


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each video's shares with its channel's verdict."""
    videos = _hosted(spark, sf_dir)
    return repetition.judge(repetition.measure(videos, mojibake.fit(videos)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the videos that their channel's verdict makes suspect, those whose own share is beyond the limit."""
    return p5_shares(spark, sf_dir).where(F.col("suspect") & F.array_contains("failed", "runs")).select("video_id").distinct()


def p5_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each channel's failures of the rule on repeated lines, and its verdict."""
    found = repetition.hosts(repetition.with_failures(repetition.measure_lines(_hosted(spark, sf_dir))))
    return found.select("host", "host_docs", "host_failed", F.round("host_rate", 6).alias("host_rate"), "host_bad")


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = transcripts(spark, sf_dir)
    labelled = _table(spark, sf_dir, "documents").select(languages.label(F.col("lang")).alias("code"), "text")
    return languages.identify(texts, languages.fit(labelled), mojibake.fit(texts), ["video_id"]).dropDuplicates(["video_id"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = languages.labels(_table(spark, sf_dir, "videos"), _table(spark, sf_dir, "pipeline_transcripts"), _table(spark, sf_dir, "channels"))
    wrong = F.col("code").isNull() | (F.size("langs") > 1) | (F.col("langs")[0] != F.col("code"))
    return _identified(spark, sf_dir).join(labels, "video_id", "left").where(wrong).select("video_id", F.explode("langs").alias("lang")).distinct()


def p6_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each video's language label, by its latest transcript row or its channel; null where there is none."""
    return languages.labels(_table(spark, sf_dir, "videos"), _table(spark, sf_dir, "pipeline_transcripts"), _table(spark, sf_dir, "channels"))


def p6_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each video's segments with their languages and confidence."""
    return _identified(spark, sf_dir).select("video_id", "main", F.posexplode("segments").alias("segment_no", "s")).select("video_id", "main", (F.col("segment_no") + 1).alias("segment_no"), "s.lang", "s.sentences", "s.confidence")


def _markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts hold markup here and there, documents none: the classifier's costs come from both."""
    texts = transcripts(spark, sf_dir)
    return markup.find_markup(texts, markup.fit(texts, _table(spark, sf_dir, "documents").select("text")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _markup(spark, sf_dir).select("video_id", "kind").distinct()


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean text of each transcript with markup."""
    return _markup(spark, sf_dir).select("video_id", "clean").dropDuplicates(["video_id"])


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).where("run > 0").select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items with the words on end, and near copies of whole items (run 0 if no passage is as the rule demands)."""
    return leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_weights"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_weights"))[1]


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document."""
    documents = _table(spark, sf_dir, "documents")
    return sentences.split_documents(documents, sentences.fit(documents))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return sentences.split_documents(documents, sentences.fit(documents), with_text=False).select("doc_id", "end_char")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_consistent, p2_found, p2_turns, p3_found, p3_restored, p4_found, p4_kept, p5_found, p5_shares, p5_hosts, p6_found, p6_segments, p6_labels, p7_found, p7_clean, p8_found, p8_leaks, p9_mixture, p9_shares, p10_found, p10_sentences)
}
SQL: dict[str, str] = {
    "p6_labels": "WITH names(name, code) AS (VALUES " + ", ".join(f"('{n}', '{c}')" for n, c in languages.CODE_OF.items()) + r"""), w AS (SELECT language AS raw FROM pipeline_transcripts UNION SELECT lang_config FROM channels), tok AS (SELECT raw, unnest(string_split_regex(lower(trim(raw)), '[\s,;/|+&]+')) AS p FROM w WHERE raw IS NOT NULL),
nm AS (SELECT raw, coalesce(n.code, m.code) AS code FROM tok LEFT JOIN names n ON n.name = p LEFT JOIN names m ON m.name = nullif(regexp_extract(p, '^(\p{L}+)[-_]', 1), '')), lab AS (SELECT raw, min(code) AS code FROM nm WHERE code IS NOT NULL GROUP BY 1 HAVING count(DISTINCT code) = 1),
l AS (SELECT youtube_id, language FROM (SELECT *, row_number() OVER (PARTITION BY youtube_id ORDER BY acquired_at DESC NULLS LAST, coalesce(language, '') DESC) AS rn FROM pipeline_transcripts WHERE youtube_id IS NOT NULL) WHERE rn = 1), v AS (SELECT id, max(youtube_id) AS youtube_id, max(channel_id) AS channel_id FROM videos GROUP BY 1)
SELECT v.id AS video_id, coalesce(a.code, b.code) AS code FROM v LEFT JOIN l USING (youtube_id) LEFT JOIN lab a ON a.raw = l.language LEFT JOIN channels c ON c.id = v.channel_id LEFT JOIN lab b ON b.raw = c.lang_config""",
    "p5_hosts": r"""WITH l AS (SELECT id, channel_id, list_filter(list_transform(string_split(transcript, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM videos WHERE regexp_matches(transcript, '\S')),
d AS (SELECT DISTINCT id, channel_id AS host, (length(array_to_string(l, '')) - length(array_to_string(list_distinct(l), ''))) / greatest(length(array_to_string(l, '')), 1)::DOUBLE AS share FROM l),
h AS (SELECT host, count(*) AS n, count(*) FILTER (share >= 0.3) AS f FROM d GROUP BY 1),
m AS (SELECT avg(f / n::DOUBLE) AS mean, var_samp(f / n::DOUBLE) AS var, avg(f / n::DOUBLE * (1 - f / n::DOUBLE) / n) AS noise FROM h),
s AS (SELECT mean, CASE WHEN mean > 0 AND mean < 1 THEN least(1000.0, greatest(1.0, mean * (1 - mean) / greatest(coalesce(var, 0) - coalesce(noise, 0), 1e-4) - 1)) END AS strength FROM m),
p AS (SELECT CASE WHEN strength IS NULL THEN 1.0 ELSE mean * strength END AS a, CASE WHEN strength IS NULL THEN 1.0 ELSE (1 - mean) * strength END AS b FROM s)
SELECT host, n AS host_docs, f AS host_failed, round((f + a) / (n + a + b), 6) AS host_rate, (f + a) / (n + a + b) >= 0.25 AS host_bad FROM h, p""",
}
