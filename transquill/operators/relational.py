"""Filters, joins, aggregates, ordered operators and sets over the relations of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transquill.functions.text import FAILURES, has_text, word_count_spaces, words


#: What a video has beside its text.
COLUMNS = ("id", "channel_id", "youtube_id", "title", "status", "upload_date", "duration", "last_updated")


def latest(videos: DataFrame, **derived: Column) -> DataFrame:
    """One row for each id, the one updated last, with what is derived from its text instead of the text.

    Copies and late stale versions fall away. has_text, nonempty, blank_words, space_words, chars, text_sha and the derived
    columns are computed where the text is read; those that nobody asks for are not computed at all, and no text is exchanged.
    Columns that a video doesn't have by nature are left out, whatever their names.
    """
    t = F.col("transcript")
    small = videos.select(
        *(c for c in COLUMNS if c in videos.columns), has_text(t).alias("has_text"), F.coalesce(t != "", F.lit(False)).alias("nonempty"), word_count_spaces(t).alias("blank_words"), F.size(words(t)).alias("space_words"),
        F.length(t).alias("chars"), F.sha2(t, 256).alias("text_sha"), *(c.alias(n) for n, c in derived.items()),
    )
    order = [F.col("last_updated").desc_nulls_last(), F.col("status").asc_nulls_first(), F.col("chars").desc_nulls_last(), F.col("title").asc_nulls_last(), F.col("upload_date").asc_nulls_last(), F.col("duration").asc_nulls_last()]
    w = Window.partitionBy("id").orderBy(*order)
    return small.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keyed(df: DataFrame, key: str, by: str) -> DataFrame:
    """One row for each key: the one with the greatest value of by, ties by the whole row."""
    rest = [c for c in df.columns if c != key]
    order = F.struct(F.col(by), *(F.col(c) for c in rest if c != by))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def no_text() -> Column:
    return ~F.col("has_text")


def is_no_subs() -> Column:
    s = F.col("status")
    return s.like("ERR_NO_EN_FR%") | s.like("ERR_TOO_SHORT%") | (s == "NO_SUBS")


def work_queue(videos: DataFrame, attempts: DataFrame, channels: DataFrame, now: str, ids: DataFrame | None = None, channel: str | None = None, limit: int = 500) -> DataFrame:
    """Videos without text that may be tried now, the newest first; of given ids or of one channel. An empty list of ids selects nothing."""
    if not 1 <= limit <= 500:
        raise ValueError("a queue has 1 to 500 videos")
    v = videos.where(no_text() & (F.coalesce("status", F.lit("")) != "PREMIUM")).select("id", "youtube_id", "channel_id", "upload_date")
    c = channels.select(F.col("id").alias("channel_id"), "prefix")
    v = v.join(c.where(F.col("prefix") == channel) if channel is not None else c, "channel_id", "left_semi")
    if ids is not None:
        v = v.join(ids, "youtube_id", "left_semi")
    due = v.join(attempts.select("youtube_id", "next_attempt_at"), "youtube_id", "left").where(F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= now))
    return due.select("id", "youtube_id", "upload_date").orderBy(F.col("upload_date").desc_nulls_last(), "id").limit(limit)


def recovery_list(videos: DataFrame, channels: DataFrame, limit: int = 200) -> DataFrame:
    """The newest videos that may still be fetched, with their channel's name."""
    c = channels.select(F.col("id").alias("channel_id"), F.col("prefix").alias("channel"))
    v = videos.where(F.col("status").isin("PENDING", "MISSING", "RETRY_429", "ERR_429_BLOCK", "ERR_DL_FAIL")).select("id", "youtube_id", "title", "status", "channel_id", "upload_date")
    return v.orderBy(F.col("upload_date").desc_nulls_last(), "id").limit(limit).join(c, "channel_id", "left").select("youtube_id", "title", "status", "channel")


def newest(latest_videos: DataFrame, videos: DataFrame, channels: DataFrame, limit: int, chars: int) -> DataFrame:
    """(youtube_id, title, upload_date, duration, part) of the newest with text in a known channel; part is its beginning."""
    known = latest_videos.where("nonempty").join(channels.select(F.col("id").alias("channel_id")), "channel_id", "left_semi")
    top = known.select("id", "youtube_id", "title", "upload_date", "duration").orderBy(F.col("upload_date").desc_nulls_last(), "id").limit(limit)
    parts = videos.where(F.coalesce(F.col("transcript") != "", F.lit(False))).select("id", F.substring("transcript", 1, chars).alias("part"))
    return top.join(parts.join(F.broadcast(top.select("id")), "id", "left_semi").dropDuplicates(["id"]), "id")


def channel_lists(videos: DataFrame, n: int = 100) -> DataFrame:
    """(channel_id, list, ids, n): up to n missing, premium and subtitle-less videos of each channel, by id."""
    s = F.col("status")
    kind = F.when(~F.col("nonempty") & (s.isNull() | s.isin("MISSING", "PENDING")), "missing").when(s == "PREMIUM", "premium").when(is_no_subs(), "no_subs")
    w = Window.partitionBy("channel_id", "list").orderBy("id")
    rows = videos.select("channel_id", "id", "youtube_id", kind.alias("list")).where("list is not null").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "youtube_id"))), lambda x: x["youtube_id"]), ",")
    return rows.groupBy("channel_id", "list").agg(ids.alias("ids"), F.count("*").alias("n"))


def status_counters(videos: DataFrame) -> DataFrame:
    """Missing, failed, premium and no-subtitle counts in one pass."""
    s = F.col("status")
    return videos.agg(
        F.count_if(s.isin("MISSING", "PENDING")).alias("missing"), F.count_if(s.like("ERR_DL_FAIL%")).alias("failed"), F.count_if(s == "PREMIUM").alias("premium"), F.count_if(is_no_subs()).alias("no_subs"), F.count("*").alias("total")
    )


def follow_up(videos: DataFrame) -> DataFrame:
    """Status -> follow-up category, first match wins."""
    s = F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("PENDING"))
    category = (
        F.when(s == "NO_SUBS", "no_subtitles_reported").when(s.like("ERR_NO_EN_FR%"), "no_fr_en_subtitles_reported").when(s.like("ERR_TOO_SHORT%"), "caption_content_to_review").when(s == "PREMIUM", "restricted_access")
        .when(s.contains("429"), "rate_limited").when(s.like("ERR_DL_FAIL%"), "download_failed").otherwise("not_yet_verified")
    )
    return videos.where(no_text()).select("id", category.alias("category"))


def failure_categories(attempts: DataFrame) -> DataFrame:
    """Error text -> all categories that it matches, else the unclassified one."""
    found = F.array_compact(F.array(*(F.when(F.col("last_error").rlike(f"(?is){p}"), F.lit(n)) for n, p in FAILURES.items())))
    some = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("unclassified_extractor_error")))
    return attempts.where("last_error is not null").select("youtube_id", F.explode(some).alias("category"))


def channel_health(channels: DataFrame, videos: DataFrame) -> DataFrame:
    """Nine measures for each channel; one without videos counts its null row, as a left join does.

    Videos are summed by channel before the join, so that a channel with a third of all rows is one row there.
    """
    text, s = F.col("nonempty"), F.col("status")
    sums = videos.groupBy("channel_id").agg(
        F.count_if(text).alias("total_local"), F.count("*").alias("n"), F.count_if(~text & (s.isNull() | s.isin("MISSING", "PENDING"))).alias("missing"), F.count_if(s == "PREMIUM").alias("premium_count"),
        F.count_if(is_no_subs()).alias("no_subs_count"), F.count_if(s.like("ERR_429_BLOCK%") | (s == "RETRY_429")).alias("retry_count"), F.sum(F.when(text, F.col("blank_words")).otherwise(0)).alias("words"),
    )
    joined = channels.select(F.col("id").alias("channel_id"), "prefix").join(sums, "channel_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    total = F.coalesce("n", F.lit(1))
    return joined.select(
        "channel_id", "prefix", F.concat(F.round(zero("total_local") / total * 100, 1).cast("string"), F.lit("%")).alias("success_rate"), zero("total_local").alias("total_local"), total.alias("total_remote"), F.coalesce("missing", F.lit(1)).alias("missing_count"),
        zero("premium_count").alias("premium_count"), zero("no_subs_count").alias("no_subs_count"), zero("retry_count").alias("retry_count"), zero("words").alias("word_count"), F.expr("(coalesce(words, 0) + 199999) div 200000").alias("est_packs"),
    )


def health_grade(channels: DataFrame, videos: DataFrame) -> DataFrame:
    """Done share by channel with its grade; one aggregation for all channels."""
    done = F.col("has_text") | F.col("status").isin("NO_SUBS", "PREMIUM")
    counts = videos.groupBy("channel_id").agg(F.count("*").alias("total"), F.count_if(F.coalesce(done, F.lit(False))).alias("done"))
    rate = F.round(F.col("done") * 100.0 / F.col("total"), 1)
    return channels.join(counts, channels["id"] == counts["channel_id"]).select("prefix", "total", "done", rate.alias("rate"), F.when(rate >= 95, "OK").when(rate >= 80, "RETARD").otherwise("CRITIQUE").alias("grade"))


def excluded(videos: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Without those whose present text is excluded by its hash; a corrected text comes back."""
    key = videos if "text_sha" in videos.columns else videos.withColumn("text_sha", F.sha2("transcript", 256))
    out = exclusions.select(F.col("youtube_id").alias("x_id"), F.col("transcript_sha256").alias("x_sha"))
    return key.join(out, (key["youtube_id"] == out["x_id"]) & (key["text_sha"] == out["x_sha"]), "left_anti")


def insert_absent(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """base and those rows of new whose key it lacks."""
    return base.unionByName(new.join(base.select(key), key, "left_anti"))


def upsert(base: DataFrame, new: DataFrame, key: str, by: str) -> DataFrame:
    """Of each key the row with the greatest value of by."""
    return keyed(base.unionByName(new), key, by)


def fill_empty(base: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """new's value where base has no text; every other value stays."""
    add = new.select(key, F.col(column).alias("__new"))
    return base.join(add, key, "left").withColumn(column, F.when(has_text(F.col(column)), F.col(column)).otherwise(F.coalesce("__new", column))).drop("__new")


def compare_and_set(current: DataFrame, plan: DataFrame, key: str = "youtube_id") -> tuple[DataFrame, DataFrame]:
    """(journal, conflicts): of current (key, text_sha) and a plan (key, before_sha, after_sha), what applies and what doesn't.

    A plan applies only where the text still has the hash that it was made for. Hashes are compared; texts stay where they are.
    """
    p = plan.select(F.col(key).alias("__k"), "before_sha", "after_sha")
    joined = p.join(current.select(F.col(key).alias("__c"), F.col("text_sha").alias("found_sha")), F.col("__k") == F.col("__c"), "left")
    fits = F.coalesce(F.col("before_sha") == F.col("found_sha"), F.lit(False))
    return joined.where(fits).select(F.col("__k").alias(key), "before_sha", "after_sha"), joined.where(~fits).select(F.col("__k").alias(key), "before_sha", "found_sha")


def applied(texts: DataFrame, journal: DataFrame, candidates: DataFrame, key: str = "youtube_id", column: str = "transcript") -> DataFrame:
    """The texts with those of the candidates (key, after_sha, candidate) in place that the journal names."""
    new = candidates.join(journal.select(key, "after_sha"), [key, "after_sha"], "left_semi").select(key, F.col("candidate").alias("__new"), F.lit(True).alias("__is"))
    return texts.join(new, key, "left").withColumn(column, F.when(F.col("__is"), F.col("__new")).otherwise(F.col(column))).drop("__new", "__is")


def pack_review(packs: DataFrame, column: str) -> DataFrame:
    """packs with the words, sources and seconds that their text states; seconds from metadata where no duration is marked."""
    of = lambda p: F.aggregate(F.regexp_extract_all(column, F.lit(p), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    marked = of(r"\[DUR:(\d+)\]")
    return packs.select("*", F.size(words(F.col(column))).cast("long").alias("words"), F.regexp_count(column, F.lit("SOURCE:")).cast("long").alias("sources"), F.when(marked > 0, marked).otherwise(of(r'"duration":\s*(\d+)')).alias("seconds")).drop(column)
