"""All queries of the core by name, with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transquill.functions import text as X
from transquill.operators import captions as C
from transquill.operators import ordered as O
from transquill.operators import relational as R
from transquill.operators import search as S
from transquill.operators.storage import scratch
from transquill.sources import readers
from transquill.streaming import state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The latest version of each video, and of each attempt, as SQL.
CUR = "cur AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY last_updated DESC NULLS LAST, status ASC NULLS FIRST, length(transcript) DESC NULLS LAST, title ASC NULLS LAST, upload_date ASC NULLS LAST, duration ASC NULLS LAST) AS rn FROM videos) WHERE rn = 1)"
ATT = "att AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY youtube_id ORDER BY updated_at DESC NULLS LAST, attempts DESC NULLS LAST, last_error DESC NULLS LAST, next_attempt_at DESC NULLS LAST) AS rn FROM pipeline_attempts WHERE youtube_id IS NOT NULL) WHERE rn = 1)"
TXT = "trim(coalesce(transcript, '')) <> ''"
NOSUBS = "(status LIKE 'ERR_NO_EN_FR%' OR status LIKE 'ERR_TOO_SHORT%' OR status = 'NO_SUBS')"
NOW = "2026-01-01 00:00:00"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def current(spark: SparkSession, d: str, **derived: Column) -> DataFrame:
    """Each video's latest version, with what is derived from its text instead of the text."""
    return R.latest(table(spark, d, "videos"), **derived)


def texts_of(spark: SparkSession, d: str, keep: DataFrame) -> DataFrame:
    """keep, which has an id, with the transcript: the one use that exchanges texts, for results that are texts."""
    return keep.join(texts(spark, d).join(keep.select("id"), "id", "left_semi").dropDuplicates(["id"]), "id")


def attempts(spark: SparkSession, d: str) -> DataFrame:
    return R.keyed(table(spark, d, "pipeline_attempts").select("youtube_id", "updated_at", "attempts", "last_error", "next_attempt_at"), "youtube_id", "updated_at")


def texts(spark: SparkSession, d: str) -> DataFrame:
    """(id, transcript) of rows with text; the rows of an id hold one text, so results are made distinct instead of texts."""
    return table(spark, d, "videos").where(X.has_text(F.col("transcript"))).select("id", "transcript")


def query(sql: str = "") -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- scans and sources


@query("SELECT id, channel_id, youtube_id, status, upload_date, duration, coalesce(length(transcript), 0) AS chars FROM videos")
def src01_scan(spark, d):
    return table(spark, d, "videos").select("id", "channel_id", "youtube_id", "status", "upload_date", "duration", F.coalesce(F.length("transcript"), F.lit(0)).cast("long").alias("chars"))


@query(r"""SELECT youtube_id, lang, count(DISTINCT path) AS files, string_agg(DISTINCT path, ';' ORDER BY path) AS paths FROM (
SELECT nullif(regexp_extract(raw_path, '([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9-]+)*$', 1), '') AS youtube_id, regexp_extract(raw_path, '\.([A-Za-z-]+)\.(?:vtt|srt)(?:\.gz)?$', 1) AS lang, replace(raw_path, '\', '/') AS path
FROM raw_captions WHERE regexp_matches(raw_path, '\.(?:vtt|srt)(?:\.gz)?$')) WHERE youtube_id IS NOT NULL GROUP BY 1, 2""")
def src02_caption_inventory(spark, d):
    return C.inventory(table(spark, d, "raw_captions"))


@query(r"SELECT DISTINCT raw_path, nullif(regexp_extract(raw_path, '(?:^|[/\\])([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9-]+)*$', 1), '') AS youtube_id FROM pipeline_transcripts WHERE raw_path IS NOT NULL")
def src03_video_id(spark, d):
    return table(spark, d, "pipeline_transcripts").where("raw_path is not null").select("raw_path", C.video_id(F.col("raw_path")).alias("youtube_id")).distinct()


@query()
def src04_local_caption(spark, d):
    return C.best_local(table(spark, d, "raw_captions")).select("youtube_id", "path", F.sha2("text", 256).alias("text_sha"))


CLOCK = r"(?:[0-9]+:)?[0-9]{1,2}:[0-9]{2}[.,][0-9]{3}"
SECONDS = "list_sum(list_transform(list_reverse(string_split(replace({0}, ',', '.'), ':')), lambda x, i: x::DOUBLE * power(60, i - 1)))"


@query(rf"""WITH f AS (SELECT raw_path AS path, min(replace(raw_text, chr(13), '')) AS t FROM raw_captions WHERE trim(coalesce(raw_text, '')) <> '' GROUP BY 1), m AS (SELECT path, regexp_extract_all(t, '(?m)^[ \t]*({CLOCK})[ \t]*-->[ \t]*{CLOCK}', 1) AS a, regexp_extract_all(t, '(?m)^[ \t]*{CLOCK}[ \t]*-->[ \t]*({CLOCK})', 1) AS b FROM f), u AS (SELECT path, unnest(range(len(a))) AS pos, a, b FROM m) SELECT path, CAST(pos AS INTEGER) AS pos, round({SECONDS.format('a[pos + 1]')}, 3) AS start, round({SECONDS.format('b[pos + 1]')}, 3) AS "end" FROM u""")
def src05_cues(spark, d):
    return C.cue_rows(table(spark, d, "raw_captions")).select("path", "pos", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query("""SELECT raw_path, CAST(json_array_length(raw_text, '$.segments') AS BIGINT) AS segments, json_extract_string(raw_text, '$.language') AS lang FROM (SELECT DISTINCT raw_path, raw_text FROM raw_captions WHERE raw_path LIKE '%.json')""")
def src17_json_segments(spark, d):
    rows = table(spark, d, "raw_captions").where(F.col("raw_path").like("%.json")).select("raw_path", "raw_text").distinct()
    parsed = F.from_json("raw_text", "language string, segments array<struct<start:double>>")
    return rows.select("raw_path", parsed.alias("j")).select("raw_path", F.size("j.segments").cast("long").alias("segments"), F.col("j.language").alias("lang"))


# ---- filters and predicates


@query(f"SELECT DISTINCT id FROM videos WHERE {TXT}")
def flt01_has_text(spark, d):
    return texts(spark, d).select("id").distinct()


#: The work queue's rule as SQL, without ids, channel and limit.
QUEUE = f"NOT ({TXT}) AND coalesce(status, '') <> 'PREMIUM' AND (next_attempt_at IS NULL OR next_attempt_at <= '{NOW}')"


@query(f"WITH {CUR}, {ATT}, w AS (SELECT cur.id, cur.upload_date, c.prefix, cur.youtube_id FROM cur JOIN channels c ON c.id = cur.channel_id LEFT JOIN att USING (youtube_id) WHERE {QUEUE}), a AS (SELECT 'all' AS part, id, upload_date FROM w ORDER BY upload_date DESC NULLS LAST, id LIMIT 500), b AS (SELECT 'channel' AS part, id, upload_date FROM w WHERE prefix = 'HalmiPauvan' ORDER BY upload_date DESC NULLS LAST, id LIMIT 500), c AS (SELECT 'ids' AS part, id, upload_date FROM w WHERE youtube_id IN (SELECT youtube_id FROM pipeline_attempts WHERE attempts >= 3) ORDER BY upload_date DESC NULLS LAST, id LIMIT 500) FROM a UNION ALL FROM b UNION ALL FROM c")
def flt02_work_queue(spark, d):
    """The queue of all videos, of one channel, and of given ids; no ids select nothing."""
    v, a, c = current(spark, d), attempts(spark, d), table(spark, d, "channels")
    ids = table(spark, d, "pipeline_attempts").where("attempts >= 3").select("youtube_id").distinct()
    parts = {"all": R.work_queue(v, a, c, NOW), "channel": R.work_queue(v, a, c, NOW, channel="HalmiPauvan"), "ids": R.work_queue(v, a, c, NOW, ids=ids), "none": R.work_queue(v, a, c, NOW, ids=ids.where("false"))}
    rows = [q.select(F.lit(n).alias("part"), "id", "upload_date") for n, q in parts.items()]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])


@query(f"WITH {CUR} SELECT cur.id, CASE WHEN c.prefix = 'HalmiPauvan' THEN 0 ELSE 1 END AS pinned, row_number() OVER (ORDER BY CASE WHEN c.prefix = 'HalmiPauvan' THEN 0 ELSE 1 END, upload_date DESC NULLS LAST, cur.id) AS place FROM cur JOIN channels c ON c.id = cur.channel_id WHERE status = 'PENDING' AND NOT ({TXT})")
def flt03_pinned_first(spark, d):
    """All pending videos without text with their place in the queue; the pinned channel comes first."""
    v = current(spark, d).where(R.no_text() & (F.col("status") == "PENDING"))
    c = table(spark, d, "channels").select(F.col("id").alias("channel_id"), F.when(F.col("prefix") == "HalmiPauvan", 0).otherwise(1).alias("pinned"))
    queue = v.select("channel_id", "id", "upload_date").join(c, "channel_id").select("id", "pinned", "upload_date")
    return O.ranks(queue, [F.col("pinned"), F.col("upload_date").desc_nulls_last(), F.col("id")], "place").select("id", "pinned", "place")


@query(f"WITH {CUR} SELECT id FROM cur WHERE NOT ({TXT}) AND status IN ('NO_SUBS', 'ERR_NO_EN_FR', 'ERR_TOO_SHORT', 'ERR_DL_FAIL') ORDER BY upload_date DESC NULLS LAST, id LIMIT 300")
def flt04_transcribe_queue(spark, d):
    v = current(spark, d).where(R.no_text() & F.col("status").isin("NO_SUBS", "ERR_NO_EN_FR", "ERR_TOO_SHORT", "ERR_DL_FAIL"))
    return v.orderBy(F.col("upload_date").desc_nulls_last(), "id").limit(300).select("id")


@query(f"WITH {CUR} SELECT count(*) FILTER (status IN ('MISSING', 'PENDING')) AS missing, count(*) FILTER (status LIKE 'ERR_DL_FAIL%') AS failed, count(*) FILTER (status = 'PREMIUM') AS premium, count(*) FILTER ({NOSUBS}) AS no_subs, count(*) AS total FROM cur")
def flt05_status_counters(spark, d):
    return R.status_counters(current(spark, d))


@query(f"WITH {CUR} SELECT cur.youtube_id, cur.title, cur.status, c.prefix AS channel FROM cur LEFT JOIN channels c ON c.id = cur.channel_id WHERE status IN ('PENDING', 'MISSING', 'RETRY_429', 'ERR_429_BLOCK', 'ERR_DL_FAIL') ORDER BY upload_date DESC NULLS LAST, cur.id LIMIT 200")
def flt06_recovery_list(spark, d):
    return R.recovery_list(current(spark, d), table(spark, d, "channels"))


@query("SELECT DISTINCT id, p.pattern FROM videos, (SELECT unnest(['[Music]', '[Musique]', '├', 'Ã', '-->', '????', 'WEBVTT']) AS pattern) p WHERE contains(transcript, p.pattern) OR contains(title, p.pattern)")
def flt09_artifact_scan(spark, d):
    """One scan for all patterns: each row gives the patterns that it has."""
    hit = lambda p: F.coalesce(F.col("transcript").contains(p), F.lit(False)) | F.coalesce(F.col("title").contains(p), F.lit(False))
    found = F.array_compact(F.array(*(F.when(hit(p), F.lit(p)) for p in ("[Music]", "[Musique]", "├", "Ã", "-->", "????", "WEBVTT"))))
    return table(spark, d, "videos").select("id", F.explode(found).alias("pattern")).distinct()


@query("SELECT DISTINCT id, substr(transcript, 1, 1000) AS part FROM videos WHERE contains(lower(transcript), 'telescope') OR contains(lower(title), 'telescope')")
def flt10_deep_search(spark, d):
    hit = F.lower("transcript").contains("telescope") | F.lower("title").contains("telescope")
    return table(spark, d, "videos").where(hit).select("id", F.substring("transcript", 1, 1000).alias("part")).distinct()


@query(f"WITH {CUR} SELECT id, CASE WHEN s = 'NO_SUBS' THEN 'no_subtitles_reported' WHEN s LIKE 'ERR_NO_EN_FR%' THEN 'no_fr_en_subtitles_reported' WHEN s LIKE 'ERR_TOO_SHORT%' THEN 'caption_content_to_review' WHEN s = 'PREMIUM' THEN 'restricted_access' WHEN contains(s, '429') THEN 'rate_limited' WHEN s LIKE 'ERR_DL_FAIL%' THEN 'download_failed' ELSE 'not_yet_verified' END AS category FROM (SELECT id, coalesce(nullif(status, ''), 'PENDING') AS s FROM cur WHERE NOT ({TXT}))")
def flt13_follow_up(spark, d):
    return R.follow_up(current(spark, d))


@query(f"WITH {ATT}, m AS (SELECT youtube_id, last_error, " + ", ".join(f"regexp_matches(last_error, '(?is){p}') AS {n}" for n, p in X.FAILURES.items()) + " FROM att WHERE last_error IS NOT NULL) " + " UNION ALL ".join(f"SELECT youtube_id, '{n}' AS category FROM m WHERE {n}" for n in X.FAILURES) + " UNION ALL SELECT youtube_id, 'unclassified_extractor_error' FROM m WHERE NOT (" + " OR ".join(X.FAILURES) + ")")
def flt14_failure_categories(spark, d):
    return R.failure_categories(attempts(spark, d))


@query(r"SELECT DISTINCT raw_path, CASE WHEN regexp_matches(lower(raw_path), '\.(?:mp4|mkv|webm|mov|m4a|mp3|opus|wav|ogg|flac|aac)$') THEN 'media' WHEN regexp_matches(lower(raw_path), '\.(?:vtt|srt|ass|ttml|json3)(?:\.gz)?$') THEN 'caption_source' WHEN lower(raw_path) LIKE '%.info.json' THEN 'video_metadata' WHEN lower(raw_path) LIKE '%.txt' THEN 'other_text' ELSE 'other' END AS kind FROM raw_captions")
def flt15_file_kind(spark, d):
    p = F.lower("raw_path")
    kind = F.when(p.rlike(r"\.(?:mp4|mkv|webm|mov|m4a|mp3|opus|wav|ogg|flac|aac)$"), "media").when(p.rlike(r"\.(?:vtt|srt|ass|ttml|json3)(?:\.gz)?$"), "caption_source").when(p.like("%.info.json"), "video_metadata").when(p.like("%.txt"), "other_text").otherwise("other")
    return table(spark, d, "raw_captions").select("raw_path", kind.alias("kind")).distinct()


@query("SELECT DISTINCT id, coalesce(contains(title, '????'), false) AS bad_title, coalesce(contains(transcript, '-->'), false) AS timed, coalesce(regexp_matches(transcript, '\"segments\"|\"formats\"'), false) AS json FROM videos WHERE coalesce(contains(title, '????'), false) OR coalesce(contains(transcript, '-->'), false) OR coalesce(regexp_matches(transcript, '\"segments\"|\"formats\"'), false)")
def flt19_leaked_formats(spark, d):
    no = F.lit(False)
    cols = {"bad_title": F.coalesce(F.col("title").contains("????"), no), "timed": F.coalesce(F.col("transcript").contains("-->"), no), "json": F.coalesce(F.col("transcript").rlike('"segments"|"formats"'), no)}
    return table(spark, d, "videos").select("id", *(c.alias(n) for n, c in cols.items())).where("bad_title or timed or json").distinct()


# ---- joins


@query(f"WITH {CUR} SELECT cur.id, c.prefix FROM cur JOIN channels c ON c.id = cur.channel_id")
def jon01_videos_channels(spark, d):
    c = table(spark, d, "channels").select(F.col("id").alias("channel_id"), "prefix")
    return current(spark, d).join(c, "channel_id").select("id", "prefix")


@query(f"WITH {CUR}, {ATT} SELECT cur.id, coalesce(att.attempts, 0) AS attempts FROM cur LEFT JOIN att USING (youtube_id) WHERE NOT ({TXT})")
def jon02_attempts(spark, d):
    return current(spark, d).where(R.no_text()).join(attempts(spark, d).select("youtube_id", "attempts"), "youtube_id", "left").select("id", F.coalesce("attempts", F.lit(0)).alias("attempts"))


@query("SELECT DISTINCT youtube_id FROM videos WHERE youtube_id NOT IN (SELECT youtube_id FROM pipeline_transcripts WHERE youtube_id IS NOT NULL) AND youtube_id NOT IN (SELECT youtube_id FROM pipeline_attempts WHERE youtube_id IS NOT NULL)")
def jon06_to_fetch(spark, d):
    have = table(spark, d, "pipeline_transcripts").select("youtube_id")
    tried = table(spark, d, "pipeline_attempts").select("youtube_id")
    return table(spark, d, "videos").where("youtube_id is not null").select("youtube_id").distinct().join(have, "youtube_id", "left_anti").join(tried, "youtube_id", "left_anti")


@query(f"WITH {CUR} SELECT youtube_id, id FROM cur UNION ALL SELECT DISTINCT p.youtube_id, CAST(NULL AS BIGINT) FROM pipeline_transcripts p WHERE p.youtube_id IS NOT NULL AND p.youtube_id NOT IN (SELECT youtube_id FROM videos WHERE youtube_id IS NOT NULL)")
def jon07_insert_absent(spark, d):
    base = table(spark, d, "videos").select("youtube_id", "id").distinct()
    new = table(spark, d, "pipeline_transcripts").where("youtube_id is not null").select("youtube_id", F.lit(None).cast("long").alias("id")).distinct()
    return R.insert_absent(base, new, "youtube_id")


@query(f"WITH {CUR} SELECT id FROM cur WHERE {TXT} AND NOT EXISTS (SELECT 1 FROM pipeline_transcripts p WHERE p.youtube_id = cur.youtube_id AND p.sha256 = sha256(cur.transcript))")
def jon08_exclusions(spark, d):
    out = table(spark, d, "pipeline_transcripts").select("youtube_id", F.col("sha256").alias("transcript_sha256"))
    return R.excluded(current(spark, d).where(F.col("has_text")), out).select("id")


@query(f"WITH {CUR} SELECT r.raw_path, cur.status, coalesce({TXT}, false) AS has_text FROM (SELECT DISTINCT raw_path, regexp_extract(raw_path, '(?:^|[/\\\\])([A-Za-z0-9_-]{{11}})(?:\\.[A-Za-z0-9-]+)*$', 1) AS youtube_id FROM raw_captions) r LEFT JOIN cur USING (youtube_id)")
def jon09_files_status(spark, d):
    files = table(spark, d, "raw_captions").select("raw_path", C.video_id(F.col("raw_path")).alias("youtube_id")).distinct()
    v = current(spark, d).select("youtube_id", "status", F.col("has_text").alias("has_text"))
    return files.join(v, "youtube_id", "left").select("raw_path", "status", F.coalesce("has_text", F.lit(False)).alias("has_text"))


@query(f"WITH {CUR}, {ATT.replace('att AS', 'x AS').replace('pipeline_attempts', 'pipeline_attempts')}, p AS (SELECT DISTINCT youtube_id, sha256 FROM pipeline_transcripts WHERE sha256 IS NOT NULL) SELECT cur.id, bool_or(p.sha256 = sha256(cur.transcript)) AS same FROM cur JOIN p USING (youtube_id) WHERE {TXT} GROUP BY 1")
def jon10_same_content(spark, d):
    p = table(spark, d, "pipeline_transcripts").where("sha256 is not null").select("youtube_id", "sha256").distinct()
    v = current(spark, d).where(F.col("has_text")).select("id", "youtube_id", F.col("text_sha").alias("now"))
    return v.join(p, "youtube_id").groupBy("id").agg(F.bool_or(F.col("sha256") == F.col("now")).alias("same"))


@query(f"WITH {CUR}, k AS (SELECT id, lower(trim(title)) AS t, upload_date FROM cur WHERE title IS NOT NULL), u AS (SELECT t, upload_date, min(id) AS only_id FROM k WHERE upload_date IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1) SELECT k.id, u.only_id FROM k JOIN u USING (t, upload_date)")
def jon11_unique_title_date(spark, d):
    k = current(spark, d).where("title is not null").select("id", F.lower(F.trim("title")).alias("t"), "upload_date")
    only = k.where("upload_date is not null").groupBy("t", "upload_date").agg(F.min("id").alias("only_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    return k.join(only, ["t", "upload_date"]).select("id", "only_id")


# ---- aggregates


@query(f"WITH {CUR} SELECT count(*) AS videos, floor(CAST(sum(CAST(duration AS DECIMAL(18,3))) AS DOUBLE) / 3.6) / 1000 AS hours, CAST(sum(length(transcript) - length(replace(transcript, ' ', '')) + 1) AS BIGINT) AS words FROM cur WHERE transcript IS NOT NULL AND transcript <> ''")
def agg01_global(spark, d):
    v = current(spark, d).where("nonempty")
    return v.agg(F.count("*").alias("videos"), (F.floor(F.sum(F.col("duration").cast("decimal(18,3)")).cast("double") / 3.6) / 1000).alias("hours"), F.sum("blank_words").alias("words"))


WORDS = "CASE WHEN v.transcript IS NOT NULL AND v.transcript <> '' THEN length(v.transcript) - length(replace(v.transcript, ' ', '')) + 1 ELSE 0 END"


@query(f"""WITH {CUR} SELECT c.id AS channel_id, c.prefix, round(count(*) FILTER (v.transcript IS NOT NULL AND v.transcript <> '') / count(*)::DOUBLE * 100, 1)::VARCHAR || '%' AS success_rate,
count(*) FILTER (v.transcript IS NOT NULL AND v.transcript <> '') AS total_local, count(*) AS total_remote, count(*) FILTER ((v.transcript IS NULL OR v.transcript = '') AND (v.status IS NULL OR v.status IN ('MISSING', 'PENDING'))) AS missing_count,
count(*) FILTER (v.status = 'PREMIUM') AS premium_count, count(*) FILTER (v.status LIKE 'ERR_NO_EN_FR%' OR v.status LIKE 'ERR_TOO_SHORT%' OR v.status = 'NO_SUBS') AS no_subs_count, count(*) FILTER (v.status LIKE 'ERR_429_BLOCK%' OR v.status = 'RETRY_429') AS retry_count,
CAST(sum({WORDS}) AS BIGINT) AS word_count, CAST((sum({WORDS}) + 199999) // 200000 AS BIGINT) AS est_packs FROM channels c LEFT JOIN cur v ON c.id = v.channel_id GROUP BY 1, 2""")
def agg02_channel_health(spark, d):
    return R.channel_health(table(spark, d, "channels"), current(spark, d))


LISTED = "(transcript IS NULL OR transcript = '') AND (status IS NULL OR status IN ('MISSING', 'PENDING'))"


@query(f"WITH {CUR}, k AS (SELECT channel_id, youtube_id, id, CASE WHEN {LISTED} THEN 'missing' WHEN status = 'PREMIUM' THEN 'premium' WHEN {NOSUBS} THEN 'no_subs' END AS list FROM cur), r AS (SELECT channel_id, list, youtube_id, row_number() OVER (PARTITION BY channel_id, list ORDER BY id) AS rn FROM k WHERE list IS NOT NULL) SELECT channel_id, list, string_agg(youtube_id, ',' ORDER BY rn) AS ids, count(*) AS n FROM r WHERE rn <= 100 GROUP BY 1, 2")
def agg03_lists(spark, d):
    """Up to 100 missing, premium and subtitle-less videos of each channel, from one pass."""
    return R.channel_lists(current(spark, d))


@query(f"WITH {CUR}, n AS (SELECT channel_id, count(*) AS total, count(*) FILTER ({TXT} OR coalesce(status IN ('NO_SUBS', 'PREMIUM'), false)) AS done FROM cur GROUP BY 1) SELECT prefix, total, done, round(done * 100.0 / total, 1)::DOUBLE AS rate, CASE WHEN round(done * 100.0 / total, 1) >= 95 THEN 'OK' WHEN round(done * 100.0 / total, 1) >= 80 THEN 'RETARD' ELSE 'CRITIQUE' END AS grade FROM channels c JOIN n ON c.id = n.channel_id")
def agg04_health_grade(spark, d):
    return R.health_grade(table(spark, d, "channels"), current(spark, d)).withColumn("rate", F.col("rate").cast("double"))


#: Texts of which each seventh has a marker of one kind put to its end, in both dialects.
MARKED = "concat(CASE WHEN id % 8 = 7 THEN '{\"id\": \"abcdefghijk\", \"formats\": []} ' ELSE '' END, transcript, CASE id % 8 WHEN 0 THEN ' <00:00:01.000>' WHEN 1 THEN ' 00:00:01.000 --> 00:00:02.000' WHEN 2 THEN ' at 01:02:03.400 sharp' WHEN 3 THEN ' align:start position:0%' WHEN 4 THEN ' <c.white>' WHEN 5 THEN ' WEBVTT' ELSE '' END)"


@query(f"WITH s AS (SELECT DISTINCT id, {MARKED} AS transcript FROM videos WHERE {TXT}) SELECT m.name AS marker, count(*) AS videos FROM s, (VALUES " + ", ".join("('" + n + "', '" + p.replace("'", "''") + "')" for n, p in X.PLAIN_MARKERS.items()) + ") m(name, pattern) WHERE regexp_matches(transcript, m.pattern) GROUP BY 1")
def agg07_markers(spark, d):
    """How many texts have a marker of each kind; markers are put into the texts, as the tables have few."""
    found = F.array_compact(F.array(*(F.when(F.expr("transcript").rlike(p), F.lit(n)) for n, p in X.MARKERS.items())))
    rows = texts(spark, d).select("id", F.expr(MARKED).alias("transcript"))
    return rows.select("id", F.explode(found).alias("marker")).distinct().groupBy("marker").agg(F.count("*").alias("videos"))


@query("SELECT regexp_extract(replace(raw_path, '\\', '/'), '^(?:[^/]*/){2}([^/]*)', 1) AS folder, count(*) AS files, CAST(sum(strlen(raw_text)) AS BIGINT) AS bytes FROM (SELECT DISTINCT raw_path, raw_text FROM raw_captions) GROUP BY 1")
def agg09_folder_sizes(spark, d):
    rows = table(spark, d, "raw_captions").select("raw_path", F.octet_length("raw_text").alias("n"), F.xxhash64("raw_text").alias("h")).distinct()
    return rows.groupBy(F.regexp_extract(F.translate("raw_path", "\\", "/"), r"^(?:[^/]*/){2}([^/]*)", 1).alias("folder")).agg(F.count("*").alias("files"), F.sum("n").cast("long").alias("bytes"))


GARBLINGS = [("é", "├®"), ("è", "├¿"), ("à", "├á"), ("ê", "├¬"), ("ç", "├º")]


@query(" UNION ALL ".join(f"SELECT '{bad}' AS before, '{c}' AS after FROM documents HAVING count(*) FILTER (contains(text, '{c}')) >= 3 AND sum(length(text) - length(replace(text, '{c}', ''))) >= 10" for c, bad in GARBLINGS))
def agg10_learned_artifacts(spark, d):
    """Evidence from all documents, garbled once beside their correct form; letters that few documents have aren't learned."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text")))
    return C.learned_artifacts(docs.select("doc_id", X.replaced(F.col("text"), GARBLINGS).alias("before"), F.col("text").alias("after")), "doc_id").select("before", "after")


@query(f"WITH s AS (SELECT DISTINCT id, transcript FROM videos WHERE {TXT}), p AS (SELECT id, trim(u) AS sentence FROM s, unnest(string_split_regex(transcript, '[.!?\\n]+')) t(u)), n AS (SELECT id, sentence, count(*) AS times, length(sentence) - length(replace(sentence, ' ', '')) + 1 AS words FROM p WHERE sentence <> '' GROUP BY 1, 2) SELECT id, CAST(max(words * times) AS BIGINT) AS weight FROM n GROUP BY 1")
def agg12_dominant_sentence(spark, d):
    """Within the row: the sentences of one text never leave it."""
    s = F.filter(F.transform(F.split("transcript", r"[.!?\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    return texts(spark, d).select("id", s.alias("s")).where(F.size("s") > 0).select("id", X.heaviest(F.col("s"), X.word_count_spaces).alias("weight")).distinct()


@query(f"WITH {CUR} SELECT count(*) AS rows_all, count(*) FILTER ({TXT}) AS rows_text FROM cur")
def agg16_integrity(spark, d):
    return current(spark, d).agg(F.count("*").alias("rows_all"), F.count_if(F.col("has_text")).alias("rows_text"))


# ---- ordered operators, sorting and sets


@query()
def win01_spoken_windowed(spark, d):
    return C.spoken(C.cue_rows(table(spark, d, "raw_captions"))).select("path", F.sha2("text", 256).alias("text_sha"))


@query("WITH e AS (SELECT user_id, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS back FROM events) SELECT user_id, CAST(sum(back) AS BIGINT) AS regressions FROM e GROUP BY 1")
def win04_regressions(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, d, "events").select("user_id", (F.col("ts") < F.lag("ts").over(w)).alias("back")).groupBy("user_id").agg(F.count_if("back").alias("regressions"))


@query(f"WITH s AS (SELECT DISTINCT id, transcript FROM videos WHERE {TXT}), w AS (SELECT id, list_filter(string_split_regex(transcript, '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS l FROM s) SELECT id, CAST(len(list_filter(list_zip(l, list_concat([NULL], l[:-2])), lambda p: p[1] IS DISTINCT FROM p[2])) AS INTEGER) AS kept FROM w")
def win05_collapse(spark, d):
    return texts(spark, d).select("id", F.size(X.collapsed(X.words(F.col("transcript")))).alias("kept")).distinct()


@query("""WITH RECURSIVE s AS (SELECT lower(trim(source)) AS src, row_number() OVER (PARTITION BY lower(trim(source)) ORDER BY upload_date NULLS FIRST, doc_id) AS rn, CAST(len(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS BIGINT) AS w FROM documents WHERE trim(coalesce(text, '')) <> '' AND source IS NOT NULL),
f AS (SELECT src, rn, w AS fill, CAST(1 AS BIGINT) AS pack, w FROM s WHERE rn = 1 UNION ALL SELECT s.src, s.rn, CASE WHEN f.fill > 0 AND f.fill + s.w > 5000 THEN s.w ELSE f.fill + s.w END, CASE WHEN f.fill > 0 AND f.fill + s.w > 5000 THEN f.pack + 1 ELSE f.pack END, s.w FROM f JOIN s ON s.src = f.src AND s.rn = f.rn + 1)
SELECT src, pack, CAST(sum(w) AS BIGINT) AS words, count(*) AS texts FROM f GROUP BY 1, 2""")
def win07_packs(spark, d):
    """Texts are put into packs in ranges; what is open at a range's end is carried into the next."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text")) & F.col("source").isNotNull()).select(F.lower(F.trim("source")).alias("src"), "upload_date", "doc_id", F.size(X.words(F.col("text"))).alias("w"))
    return O.packs(docs, "src", ["upload_date", "doc_id"], "w", 5000).groupBy("src", "pack").agg(F.sum("w").alias("words"), F.count("*").alias("texts"))


@query("SELECT youtube_id, max(acquired_at) AS acquired_at FROM pipeline_transcripts WHERE youtube_id IS NOT NULL GROUP BY 1")
def win09_latest_revision(spark, d):
    return R.keyed(table(spark, d, "pipeline_transcripts"), "youtube_id", "acquired_at").select("youtube_id", "acquired_at")


@query(f"WITH {CUR} SELECT cur.youtube_id, title, substr(transcript, 1, 999) AS part FROM cur JOIN channels c ON c.id = cur.channel_id WHERE transcript IS NOT NULL AND transcript <> '' ORDER BY upload_date DESC NULLS LAST, cur.id LIMIT 2000")
def top01_newest(spark, d):
    """The newest are picked first; only their beginnings are fetched."""
    return R.newest(current(spark, d), table(spark, d, "videos"), table(spark, d, "channels"), 2000, 999).select("youtube_id", "title", "part")


@query(f"SELECT DISTINCT id, sha256(array_to_string(k, chr(10))) AS lines_sha, len(k) AS kept FROM (SELECT id, list_transform(list_sort(list_transform(list_distinct(l), lambda x: {{'p': list_position(l, x), 'x': x}})), lambda s: s.x) AS k FROM (SELECT id, string_split(transcript, chr(10)) AS l FROM videos WHERE {TXT}))")
def top08_unique_lines(spark, d):
    """Lines in the order of their first, by their hash: texts aren't exchanged."""
    lines = F.array_distinct(F.split("transcript", "\n"))
    return texts(spark, d).select("id", F.sha2(F.array_join(lines, "\n"), 256).alias("lines_sha"), F.size(lines).cast("long").alias("kept")).distinct()


@query(f"WITH {CUR}, r AS (SELECT status, id, row_number() OVER (PARTITION BY status ORDER BY id) AS rn FROM cur) SELECT status, id FROM r WHERE rn <= 5")
def top09_samples(spark, d):
    w = Window.partitionBy("status").orderBy("id")
    return current(spark, d).select("status", "id", F.row_number().over(w).alias("rn")).where("rn <= 5").drop("rn")


@query("SELECT DISTINCT youtube_id FROM videos WHERE youtube_id IN (SELECT youtube_id FROM pipeline_transcripts) ")
def set05_membership(spark, d):
    return table(spark, d, "videos").select("youtube_id").distinct().join(table(spark, d, "pipeline_transcripts").select("youtube_id"), "youtube_id", "left_semi")


@query("SELECT youtube_id FROM videos WHERE youtube_id IS NOT NULL EXCEPT SELECT youtube_id FROM pipeline_transcripts")
def set02_difference(spark, d):
    return table(spark, d, "videos").where("youtube_id is not null").select("youtube_id").subtract(table(spark, d, "pipeline_transcripts").select("youtube_id"))


@query("SELECT youtube_id FROM pipeline_attempts WHERE youtube_id IS NOT NULL UNION SELECT youtube_id FROM pipeline_transcripts WHERE youtube_id IS NOT NULL AND sha256 IS NULL")
def set04_union(spark, d):
    a = table(spark, d, "pipeline_attempts").where("youtube_id is not null").select("youtube_id")
    return a.union(table(spark, d, "pipeline_transcripts").where("youtube_id is not null and sha256 is null").select("youtube_id")).distinct()


# ---- text


@query()
def txt02_clean_captions(spark, d):
    return C.spoken_files(table(spark, d, "raw_captions")).select("path", "removed", F.sha2("text", 256).alias("text_sha"))


def tripled(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): several documents of a source on end, with each of their sentences three times."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text"))).groupBy(F.lower(F.trim("source")).alias("src"), F.pmod("doc_id", F.lit(40)).alias("part")).agg(F.min("doc_id").alias("doc_id"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), " ").alias("text"))
    return docs.select("doc_id", F.transform(F.split("text", r"(?<=[.!?])\s+"), lambda s: F.concat_ws(" ", s, s, s)).alias("s")).select("doc_id", F.array_join("s", " ").alias("text"))


@query()
def txt05_triplicates(spark, d):
    """The strict rule: only long units of large texts are taken back."""
    return C.collapsed_triples(tripled(spark, d), strict=True, key="doc_id", column="text").select("doc_id", "removed")


@query()
def txt06_complete_triplicates(spark, d):
    """The rule for varied texts: all units are taken back."""
    return C.collapsed_triples(tripled(spark, d), strict=False, key="doc_id", column="text").select("doc_id", "removed")


@query()
def txt07_spoken_dedup(spark, d):
    return C.spoken_once(texts(spark, d)).dropDuplicates(["id"]).select("id", "events", F.sha2("text", 256).alias("text_sha"))


@query(r"""WITH s AS (SELECT DISTINCT raw_path, raw_text AS t FROM raw_captions WHERE regexp_matches(raw_path, '\.(?:vtt|srt)$')), a AS (SELECT raw_path, regexp_replace(regexp_replace(t, '(?s)<.*?>', '', 'g'), '(?im)^(?:WEBVTT[ \t]*|Kind:[^\n]*|Language:[^\n]*)$', '', 'g') AS t FROM s),
b AS (SELECT raw_path, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?i)(?:align|position|size|line|vertical|region|style):[^ \t\n\r]+', ' ', 'g'), '[0-9]{8}\|[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}', ' ', 'g'), '[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}[ \t\n]*-->[ \t\n]*[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}', ' ', 'g'), '\b[0-9]{1,2}:[0-9]{2}\b', ' ', 'g') AS t FROM a),
c AS (SELECT raw_path, regexp_replace(regexp_replace(regexp_replace(t, '(?m)^[0-9]+[ \t]*$', '', 'g'), '&[A-Za-z0-9_]+;', ' ', 'g'), '[ \t\n\r]+', ' ', 'g') AS t FROM b),
e AS (SELECT raw_path, regexp_replace(regexp_replace(regexp_replace(t, '[‘’‚‛]', '''', 'g'), '[“”„‟]', chr(34), 'g'), '([a-zA-Z])\?([a-zA-Z])', '\1''\2', 'g') AS t FROM c), w AS (SELECT raw_path, list_filter(string_split(t, ' '), lambda x: x <> '') AS l FROM e)
SELECT raw_path, sha256(coalesce(array_to_string(list_transform(list_filter(list_zip(l, list_concat([NULL], l[:-2])), lambda p: lower(p[1]) IS DISTINCT FROM lower(p[2])), lambda p: p[1]), ' '), '')) AS text_sha FROM w""")
def txt08_clean_rendered(spark, d):
    rows = table(spark, d, "raw_captions").where(F.col("raw_path").rlike(r"\.(?:vtt|srt)$")).select("raw_path", X.clean_rendered(F.col("raw_text")).alias("t"))
    return rows.select("raw_path", F.sha2("t", 256).alias("text_sha")).distinct()


@query(f"SELECT DISTINCT id, CAST(length(transcript) - length(replace(transcript, ' ', '')) + 1 AS INTEGER) AS by_blanks, CAST(len(list_filter(string_split_regex(transcript, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS INTEGER) AS by_space FROM videos WHERE {TXT}")
def txt09_word_counts(spark, d):
    return texts(spark, d).select("id", X.word_count_spaces(F.col("transcript")).alias("by_blanks"), F.size(X.words(F.col("transcript"))).alias("by_space")).distinct()


@query(f"SELECT DISTINCT id, CAST(len(regexp_extract_all(lower(transcript), '[\\p{{L}}\\p{{N}}\\p{{M}}_’''-]+')) AS INTEGER) AS tokens FROM videos WHERE {TXT}")
def txt11_tokens(spark, d):
    return texts(spark, d).select("id", F.size(X.tokens(F.col("transcript"))).alias("tokens")).distinct()


@query(r"SELECT DISTINCT id, substr(regexp_replace(regexp_replace(title, '[^\p{L}\p{N}_.-]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g'), 1, 80) AS label FROM videos WHERE title IS NOT NULL")
def txt12_labels(spark, d):
    return table(spark, d, "videos").where("title is not null").select("id", X.safe_label(F.col("title")).alias("label")).distinct()


@query(r"SELECT DISTINCT id, regexp_replace(regexp_replace(regexp_replace(title, '[‘’‚‛]', '''', 'g'), '[“”„‟]', chr(34), 'g'), '([a-zA-Z])\?([a-zA-Z])', '\1''\2', 'g') AS title, CASE WHEN regexp_matches(upload_date, '[A-Za-z]') THEN 'INCONNUE' ELSE upload_date END AS upload_date FROM videos")
def txt13_title_dates(spark, d):
    fixed = F.regexp_replace(X.quotes_plain(F.col("title")), r"([a-zA-Z])\?([a-zA-Z])", "$1'$2")
    return table(spark, d, "videos").select("id", fixed.alias("title"), F.when(F.col("upload_date").rlike("[A-Za-z]"), "INCONNUE").otherwise(F.col("upload_date")).alias("upload_date")).distinct()


@query(f"SELECT DISTINCT id, substr(transcript, greatest(p - 100, 1), least(p + 8 + 100, length(transcript)) - greatest(p - 100, 1) + 1) AS part FROM (SELECT id, transcript, instr(transcript, 'telescope') AS p FROM videos) WHERE p > 0")
def txt16_excerpt(spark, d):
    return texts(spark, d).select("id", X.excerpt(F.col("transcript"), "telescope").alias("part")).where("part is not null").distinct()


@query(f"WITH {CUR} SELECT cur.id, '--- VIDEO: ' || coalesce(title, '') || ' (' || coalesce(upload_date, '') || ') ' || cur.youtube_id || ' ---' AS header FROM cur WHERE {TXT}")
def txt18_headers(spark, d):
    v = current(spark, d).where(F.col("has_text"))
    return v.select("id", F.concat(F.lit("--- VIDEO: "), F.coalesce("title", F.lit("")), F.lit(" ("), F.coalesce("upload_date", F.lit("")), F.lit(") "), "youtube_id", F.lit(" ---")).alias("header"))


# ---- encoding repair


def _heal(name: str, pairs: list[tuple[str, str]], spaces: bool, noise: list[str] | None = None, titles: bool = False, given: str = "") -> None:
    """A repair pass as a query with its SQL: id, field and hash of each text, and each title where the pass covers them, that it changes; given: the rule for the few ids that the pass is for."""
    every = pairs + [(n, "") for n in noise or []] + ([("  ", " ")] if spaces else [])
    fields = ("transcript", "title") if titles else ("transcript",)

    def run(spark: SparkSession, d: str) -> DataFrame:
        firsts = "".join(sorted({"\\" + k[0] if k[0] in "[]|" else k[0] for k, _ in every if k[0] != " "}))
        v = table(spark, d, "videos")
        if given:
            few = v.where(given).select("youtube_id").distinct().orderBy("youtube_id").limit(6)
            v = v.join(F.broadcast(few), "youtube_id", "left_semi")
        both = v.select("id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("old")) for f in fields))).alias("p")).select("id", "p.field", "p.old")
        some = both.where(X.has_text(F.col("old")) & F.col("old").rlike(f"[{firsts}]" + ("|  " if spaces else "")))
        new = some.select("id", "field", "old", X.replaced(F.col("old"), every).alias("healed")).where("healed <> old")
        return new.select("id", "field", F.sha2("healed", 256).alias("text_sha")).distinct()

    QUERIES[name] = run
    only = f" AND youtube_id IN (SELECT DISTINCT youtube_id FROM videos WHERE {given} ORDER BY 1 LIMIT 6)" if given else ""
    SQL[name] = " UNION ALL ".join(f"SELECT DISTINCT id, '{f}' AS field, sha256(healed) AS text_sha FROM (SELECT id, {f} AS old, {X.duckdb_replaced(f, every)} AS healed FROM videos WHERE trim(coalesce({f}, '')) <> ''{only}) WHERE healed <> old" for f in fields)


_heal("enc01_heal_a", X.HEAL_A, True, X.NOISE_A, titles=True)
_heal("enc02_heal_b", X.HEAL_B, True, titles=True)
_heal("enc03_heal_c", X.HEAL_C, False)
_heal("enc04_heal_d", X.HEAL_D, True)
_heal("enc07_heal_g", X.HEAL_G, False)
_heal("enc13_heal_h", X.HEAL_H, False, titles=True, given="transcript LIKE '%├%'")


@query(f"SELECT DISTINCT id, sha256(t) AS text_sha FROM (SELECT id, trim(regexp_replace(regexp_replace({X.duckdb_replaced('transcript', X.HEAL_E)}, '(?i)\\[(?:{'|'.join(X.NOISE_E)})\\]|\\((?:Rires|Laughter)\\)', '', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')) AS t, transcript FROM videos WHERE {TXT}) WHERE t <> transcript")
def enc05_heal_e(spark, d):
    rows = texts(spark, d)
    new = F.trim(F.regexp_replace(F.regexp_replace(X.replaced(F.col("transcript"), X.HEAL_E), r"(?i)\[(?:" + "|".join(X.NOISE_E) + r")\]|\((?:Rires|Laughter)\)", ""), r"[ \t\n\r\f]+", " "))
    return rows.select("id", "transcript", new.alias("t")).where("t <> transcript").select("id", F.sha2("t", 256).alias("text_sha")).distinct()


@query(f"SELECT DISTINCT id, sha256(t) AS text_sha FROM (SELECT id, transcript, nfc_normalize({X.duckdb_replaced('transcript', X.HEAL_F)}) AS t FROM videos WHERE {TXT}) WHERE t <> transcript")
def enc06_heal_f(spark, d):
    """Pairs are replaced in the JVM; only texts that composition may change go through Python."""
    import unicodedata

    from transquill.functions.arrow import map_documents

    rows = texts(spark, d).select("id", "transcript", X.replaced(F.col("transcript"), X.HEAL_F).alias("t"))
    loose = F.col("t").rlike(X.MAY_COMPOSE)
    composed = map_documents(rows.where(loose), ["id", "transcript", "t"], lambda i, old, t: [(i, n)] if (n := unicodedata.normalize("NFC", t)) != old else [], "id bigint, t string")
    return composed.unionAll(rows.where(~loose & (F.col("t") != F.col("transcript"))).select("id", "t")).select("id", F.sha2("t", 256).alias("text_sha")).distinct()


LETTERS = "len(regexp_extract_all(text, '[éèàêç]'))"
SOUND = "NOT regexp_matches(text, '�|Ôò|Ôö|û[▓╣┬│]|[┬├]|[─-▟]')"


@query(f"SELECT doc_id, CAST({LETTERS} AS INTEGER) AS n, sha256(text) AS text_sha FROM documents WHERE {LETTERS} >= 5 AND {SOUND}")
def enc10_restore(spark, d):
    """Learns from half of the documents, garbled once, beside their correct forms, and restores garbled copies of all: those with enough letters come out as they were."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text")) & ~F.col("text").rlike("�|Ôò|Ôö|û[▓╣┬│]|[┬├]|[─-▟]"))
    bad = X.replaced(F.col("text"), [("é", "├®"), ("è", "├¿"), ("à", "├á"), ("ê", "├¬"), ("ç", "├º")])
    pairs = C.learned_artifacts(docs.where("doc_id % 2 = 0").select("doc_id", bad.alias("before"), F.col("text").alias("after")), "doc_id")
    return C.restored(docs.select("doc_id", bad.alias("t")), pairs, "doc_id", "t").select("doc_id", "n", F.sha2("text", 256).alias("text_sha"))


@query(f"SELECT DISTINCT id, CAST(len(regexp_extract_all(transcript, '{X.CORRUPTION}')) AS INTEGER) AS signals, CAST(len(regexp_extract_all(transcript, '{X.WEAK_CORRUPTION}')) AS INTEGER) AS weak FROM videos WHERE {TXT} AND regexp_matches(transcript, '{X.CORRUPTION}|{X.WEAK_CORRUPTION}')")
def enc12_signals(spark, d):
    rows = texts(spark, d).where(F.col("transcript").rlike(f"{X.CORRUPTION}|{X.WEAK_CORRUPTION}"))
    return rows.select("id", F.regexp_count("transcript", F.lit(X.CORRUPTION)).alias("signals"), F.regexp_count("transcript", F.lit(X.WEAK_CORRUPTION)).alias("weak")).distinct()


# ---- quality


@query(f"WITH s AS (SELECT DISTINCT id, {MARKED} AS transcript FROM videos WHERE {TXT}) SELECT id, " + ", ".join(f"CAST(len(regexp_extract_all(transcript, '{p}')) AS INTEGER) AS {n}" for n, p in X.PLAIN_MARKERS.items()) + " FROM s WHERE " + " OR ".join(f"regexp_matches(transcript, '{p}')" for p in X.PLAIN_MARKERS.values()))
def qua01_markers(spark, d):
    rows = texts(spark, d).select("id", F.expr(MARKED).alias("t")).select("id", *(F.regexp_count("t", F.lit(p)).alias(n) for n, p in X.MARKERS.items()))
    return rows.where(" or ".join(f"{n} > 0" for n in X.MARKERS)).distinct()


def plain_markup(x: str) -> str:
    """A text without the markup of captions, as SQL: three layers of entities and tags."""
    for _ in range(3):
        for entity, c in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
            x = f"replace({x}, '{entity}', '{c}')"
        for pattern, to in (("(?i)</?(?:br|p|div)\\b[^<>]*>", " "), ("<[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?[.,][0-9]{3}>", ""), ("(?i)</?(?:c(?:\\.[A-Za-z0-9_.-]+)*|v(?:[ \\t][^<>]*)?|lang(?:[ \\t][^<>]*)?|ruby|rt|i|b|u|font(?:[ \\t][^<>]*)?)>", "")):
            x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


def plain_line(x: str) -> str:
    return f"trim(regexp_replace({plain_markup(x)}, '[\\s\u00a0\u3000\u2000-\u200a]+', ' ', 'g'))"


LINE = rf"(?m)^[ \t]*{CLOCK}[ \t]*-->[ \t]*{CLOCK}[^\n]*$"
#: The spoken text of each caption file, from the definition: sp(path, text, removed, rolls).
SPOKEN = rf"""f0 AS (SELECT raw_path AS path, ltrim(replace(replace(min(raw_text), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(65279)) AS t FROM raw_captions WHERE trim(coalesce(raw_text, '')) <> '' GROUP BY 1),
f1 AS (SELECT path, regexp_extract_all(t, '(?m)^[ \t]*({CLOCK})[ \t]*-->[ \t]*{CLOCK}[^\n]*$', 1) AS a, regexp_extract_all(t, '(?m)^[ \t]*{CLOCK}[ \t]*-->[ \t]*({CLOCK})[^\n]*$', 1) AS b, string_split_regex(t, '{LINE}') AS parts FROM f0),
f2 AS (SELECT *, try_cast(trim(parts[1], E' \n\t') AS BIGINT) AS first FROM f1 WHERE len(a) > 0),
f3 AS (SELECT *, coalesce(regexp_full_match(trim(parts[1], E' \n\t'), '[0-9]+') AND len(list_filter(range(1, least(len(a) - 1, 3) + 1), lambda i: regexp_extract(parts[i + 1], '([^\n]*)\s*$', 1) IS DISTINCT FROM '' AND trim(string_split(rtrim(parts[i + 1], E' \n\t'), chr(10))[-1]) <> CAST(first + i AS VARCHAR))) = 0, false) AS numbered FROM f2),
u AS (SELECT path, unnest(range(1, len(a) + 1)) AS k, a, b, parts, numbered, first FROM f3),
c0 AS (SELECT path, k - 1 AS pos, {SECONDS.format("a[k]")} AS s, {SECONDS.format("b[k]")} AS e, CASE WHEN numbered AND k < len(a) AND trim(string_split(rtrim(parts[k + 1], E' \n\t'), chr(10))[-1]) = CAST(first + k AS VARCHAR) THEN string_split(rtrim(parts[k + 1], E' \n\t'), chr(10))[:-2] ELSE string_split(parts[k + 1], chr(10)) END AS raw FROM u),
c1 AS (SELECT path, pos, s, e, list_filter(list_transform(raw, lambda x: {{'t': {plain_line('x')}, 'st': regexp_matches(replace(replace(replace(x, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '<[0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?[.,][0-9]{{3}}>')}}), lambda l: l.t <> '') AS l FROM c0),
c2 AS (SELECT *, lag(s) OVER w AS ps, lag(e) OVER w AS pe, lag(l) OVER w AS pl, lead(s) OVER w AS ns, lead(pos) OVER w IS NULL AS last FROM c1 WINDOW w AS (PARTITION BY path ORDER BY pos)),
c3 AS (SELECT *, coalesce(ps <= s AND abs(pe - s) <= 0.051, false) AS near, coalesce(len(pl) > 0 AND len(l) > 0 AND NOT l[1].st AND l[1].t = pl[-1].t, false) AS same FROM c2),
c4 AS (SELECT *, near AND same AND len(l) >= 2 AS carried FROM c3),
c5 AS (SELECT *, same AND near AND len(l) = 1 AND e - s BETWEEN 0 AND 0.051 AND coalesce(s <= ns AND abs(e - ns) <= 0.051, false) AND coalesce(lead(carried) OVER w, false) AS shown, last AND pos > 0 AND len(l) = 1 AND same AND e - s <= 0.051 AND coalesce(abs(pe - s) <= 0.051, false) AS final FROM c4 WINDOW w AS (PARTITION BY path ORDER BY pos)),
g0 AS (SELECT path, (count(*) FILTER (carried AND len(list_filter(l[2:], lambda x: x.st)) > 0) >= 2 OR count(DISTINCT CASE WHEN shown THEN l[1].t END) >= 3) AND count(*) FILTER (s < ps) = 0 AS rolls FROM c5 GROUP BY 1),
c6 AS (SELECT c5.*, g0.rolls, list_filter(string_split(array_to_string(list_transform(CASE WHEN g0.rolls AND (shown OR final) THEN [] WHEN g0.rolls AND carried THEN l[2:] ELSE l END, lambda x: x.t), ' '), ' '), lambda x: x <> '') AS w, g0.rolls AND (shown OR final OR carried) AS gone FROM c5 JOIN g0 USING (path)),
c7 AS (SELECT *, coalesce(lag(w) OVER v, []) AS pw FROM c6 WINDOW v AS (PARTITION BY path ORDER BY pos)),
c8 AS (SELECT *, CASE WHEN coalesce(s < pe, false) THEN coalesce(list_max(list_filter(range(1, least(len(w), len(pw)) + 1), lambda k: w[1:k] = pw[len(pw) - k + 1:len(pw)])), 0) ELSE 0 END AS cut FROM c7),
sp AS (SELECT path, coalesce(string_agg(array_to_string(w[cut + 1:], ' '), ' ' ORDER BY pos) FILTER (len(w) > cut), '') AS text, CAST(count(*) FILTER (gone) AS INTEGER) AS removed, any_value(rolls) AS rolls FROM c8 GROUP BY 1)"""
#: The best spoken text of each video: best(youtube_id, path, text).
BEST = r"""best AS (SELECT youtube_id, path, text FROM (SELECT *, row_number() OVER (PARTITION BY youtube_id ORDER BY CASE regexp_extract(path, '\.([A-Za-z-]+)\.[A-Za-z0-9_]+$', 1) WHEN 'orig' THEN 1 WHEN 'cap' THEN 2 WHEN 'auto' THEN 3 ELSE 99 END, path) AS rn FROM (SELECT nullif(regexp_extract(path, '(?:^|[/\\])([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9-]+)*$', 1), '') AS youtube_id, path, text FROM sp WHERE text <> '') WHERE youtube_id IS NOT NULL) WHERE rn = 1)"""


#: Words of texts without signs of markup; a position, and what stands at it, is looked at once a step.
REPEATS = r"""s AS (SELECT DISTINCT id, translate(transcript, '<&', '  ') AS t FROM videos WHERE trim(coalesce(transcript, '')) <> ''), w AS (SELECT id, regexp_extract_all(lower(t), '[\p{L}\p{N}_](?:[\p{L}\p{N}_’''-]*[\p{L}\p{N}_])?') AS l FROM s),
g AS (SELECT id, CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS unit, CAST(0 AS BIGINT) AS span FROM w UNION ALL
SELECT id, i + CASE WHEN n > 0 THEN 2 * n WHEN two THEN 6 WHEN four THEN 4 ELSE 1 END, CASE WHEN n > 0 THEN n WHEN two THEN 2 WHEN four THEN 1 ELSE 0 END, CASE WHEN n > 0 THEN 2 * n WHEN two THEN 6 WHEN four THEN 4 ELSE 0 END FROM (
SELECT g.id, g.i, coalesce(list_max(list_filter(range(3, 13), lambda k: g.i + 2 * k - 1 <= len(w.l) AND w.l[g.i:g.i + k - 1] = w.l[g.i + k:g.i + 2 * k - 1])), 0) AS n, g.i + 5 <= len(w.l) AND w.l[g.i:g.i + 1] = w.l[g.i + 2:g.i + 3] AND w.l[g.i:g.i + 1] = w.l[g.i + 4:g.i + 5] AS two, g.i + 3 <= len(w.l) AND length(w.l[g.i]) >= 2 AND len(list_distinct(w.l[g.i:g.i + 3])) = 1 AS four FROM g JOIN w ON w.id = g.id WHERE g.i <= len(w.l))),
r AS (SELECT w.id, CAST(any_value(len(w.l)) AS INTEGER) AS words, CAST(count(*) FILTER (unit > 0) AS INTEGER) AS alerts, CAST(sum(span) AS INTEGER) AS covered, CAST(max(unit) AS INTEGER) AS longest, CAST(count(*) FILTER (unit >= 6) AS INTEGER) AS long_alerts FROM g JOIN w ON w.id = g.id GROUP BY 1)"""


@query(f"WITH RECURSIVE {REPEATS} SELECT * FROM r")
def qua02_repetition(spark, d):
    plain = texts(spark, d).select("id", F.translate("transcript", "<&", "  ").alias("transcript"))
    return C.repetition_signals(plain).select("id", "words", "alerts", "covered", "longest", "long_alerts").distinct()


@query()
def qua05_concordance(spark, d):
    """Each video's transcript against the spoken text of its best caption file."""
    files = C.best_local(table(spark, d, "raw_captions")).select("youtube_id", F.col("text").alias("before"))
    wanted = current(spark, d).where("has_text").select("id", "youtube_id").join(files, "youtube_id")
    return C.concordant(texts_of(spark, d, wanted).withColumnRenamed("transcript", "after"), "id")


@query(f"WITH s AS (SELECT DISTINCT id, transcript AS a, replace(replace(transcript, ' not ', ' '), '2', '3') AS b FROM videos WHERE {TXT}), p AS (SELECT id, regexp_extract_all(a, '[0-9]+(?:[.,][0-9]+)*') AS na, regexp_extract_all(b, '[0-9]+(?:[.,][0-9]+)*') AS nb, list_filter(regexp_extract_all(lower(a), '[a-z]+'), lambda x: x IN ('not', 'no', 'never', 'without', 'neither', 'ne', 'pas', 'non', 'sans', 'jamais')) AS ga, list_filter(regexp_extract_all(lower(b), '[a-z]+'), lambda x: x IN ('not', 'no', 'never', 'without', 'neither', 'ne', 'pas', 'non', 'sans', 'jamais')) AS gb FROM s) SELECT id, na = nb AS numbers_kept, ga = gb AS negations_kept FROM p")
def qua09_numbers_negations(spark, d):
    """Whether a changed copy keeps the numbers and the negations of its text, in order."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit("[0-9]+(?:[.,][0-9]+)*"), F.lit(0))
    negations = lambda c: F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0)), lambda x: x.isin(*X.NEGATIONS))
    t = F.col("transcript")
    changed = F.replace(F.replace(t, F.lit(" not "), F.lit(" ")), F.lit("2"), F.lit("3"))
    return texts(spark, d).select("id", (numbers(t) == numbers(changed)).alias("numbers_kept"), (negations(t) == negations(changed)).alias("negations_kept")).distinct()


@query(f"SELECT DISTINCT id, sha256(transcript) AS text_sha FROM videos WHERE {TXT}")
def qua15_fingerprints(spark, d):
    return texts(spark, d).select("id", F.sha2("transcript", 256).alias("text_sha")).distinct()


# ---- search

def searched(spark: SparkSession, d: str, *queries: str) -> DataFrame:
    """Each video's latest version with what the queries need of it."""
    return current(spark, d, **S.measures(*queries)).select("id", "channel_id", "has_text", "found")


WORDS_OF = "regexp_extract_all(translate(lower(concat_ws(' ', coalesce(title, ''), coalesce(transcript, ''))), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\\p{L}\\p{N}\\p{M}_’''-]+')"


@query(f"WITH {CUR}, s AS (SELECT id, {WORDS_OF} AS t FROM cur) SELECT id FROM s WHERE len(list_filter(t, lambda x: starts_with(x, 'bakery'))) > 0 AND len(list_filter(t, lambda x: starts_with(x, 'tele'))) > 0")
def fts02_match(spark, d):
    return S.match(searched(spark, d, "bakery tele"), "bakery tele").where(S.every("bakery tele")).select("id")


@query(f"WITH {CUR}, " + r"""s AS (SELECT id, regexp_extract_all(translate(lower(concat_ws(' ', coalesce(title, ''), coalesce(transcript, ''))), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\p{L}\p{N}\p{M}_’''-]+') AS t FROM cur),
f AS (SELECT id, len(t)::DOUBLE AS n, len(list_filter(t, lambda x: starts_with(x, 'bakery')))::DOUBLE AS a, len(list_filter(t, lambda x: starts_with(x, 'tele')))::DOUBLE AS b FROM s), g AS (SELECT count(*)::DOUBLE AS docs, avg(n) AS mean, count(*) FILTER (a > 0)::DOUBLE AS da, count(*) FILTER (b > 0)::DOUBLE AS db FROM f)
SELECT id, round(-(greatest(ln((docs - da + 0.5) / (da + 0.5)), 1e-6) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean)) + greatest(ln((docs - db + 0.5) / (db + 0.5)), 1e-6) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS rank FROM f, g WHERE a > 0 AND b > 0 ORDER BY rank, id LIMIT 100""")
def fts03_ranked(spark, d):
    return S.ranked(searched(spark, d, "bakery tele"), "bakery tele")


@query(r"""WITH t AS (SELECT DISTINCT id, list_filter(string_split_regex(transcript, '\s+'), lambda x: x <> '') AS w FROM videos WHERE transcript IS NOT NULL), h AS (SELECT id, w, list_filter(range(0, len(w)), lambda i: starts_with(translate(lower(regexp_replace(w[i + 1], '^[^\p{L}\p{N}]+', '')), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), 'telescope')) AS hits FROM t),
b AS (SELECT id, w, hits, greatest(0, least(list_sort(list_transform(hits, lambda s: {'n': -len(list_filter(hits, lambda k: k >= s AND k < s + 64)), 's': s}))[1].s, len(w) - 64)) AS a FROM h WHERE len(hits) > 0)
SELECT id, CASE WHEN a > 0 THEN '...' ELSE '' END || array_to_string(list_transform(range(a, least(a + 64, len(w))), lambda i: CASE WHEN list_contains(hits, i) THEN '<b>' || w[i + 1] || '</b>' ELSE w[i + 1] END), ' ') || CASE WHEN a + 64 < len(w) THEN '...' ELSE '' END AS snippet FROM b""")
def fts04_snippets(spark, d):
    return S.snippet(table(spark, d, "videos").select("id", "transcript"), "telescope").distinct()


@query(f"WITH {CUR}, s AS (SELECT id, {WORDS_OF} AS t FROM cur) SELECT id, CAST(len(t) AS BIGINT) AS words, CAST(len(list_distinct(t)) AS BIGINT) AS terms, true AS sound FROM s WHERE len(t) > 0")
def fts05_index_integrity(spark, d):
    """Postings, made anew, against what they are counted from: each video's words and terms, and whether both agree."""
    docs = S.match(searched(spark, d))
    total = S.postings(table(spark, d, "videos"), docs).groupBy("id").agg(F.sum("n").cast("long").alias("words"), F.count("*").alias("terms"))
    sizes = docs.select("id", F.col("length").cast("long").alias("length")).where("length > 0")
    return sizes.join(total, "id", "full").select("id", "words", "terms", F.coalesce(F.col("words") == F.col("length"), F.lit(False)).alias("sound"))


@query(f"WITH {CUR}, s AS (SELECT id, {WORDS_OF} AS t FROM cur) SELECT id FROM s WHERE len(list_filter(t, lambda x: starts_with(x, 'bak'))) > 0 AND len(list_filter(t, lambda x: starts_with(x, 'the'))) > 0")
def fts06_indexed_search(spark, d):
    """The index written once by the beginnings of its terms, and searched by reading the files of two of them."""
    path = scratch(spark, "index")
    S.write_index(S.postings(table(spark, d, "videos"), current(spark, d)), path)
    return S.indexed(S.read_index(spark, path), "bak the")


# ---- state and increments


@query("WITH f AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error'), l AS (SELECT user_id, count(*) AS attempts, max(ts) AS last FROM f GROUP BY 1) SELECT user_id, attempts, strftime(last + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS next_attempt_at FROM l")
def str01_attempts(spark, d):
    e = table(spark, d, "events").where("event_type = 'error'")
    return e.groupBy("user_id").agg(F.count("*").alias("attempts"), F.date_format(F.max("ts") + F.expr("interval 24 hours"), "yyyy-MM-dd HH:mm:ss").alias("next_attempt_at"))


@query("WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS hit FROM events), m AS (SELECT user_id, hit, row_number() OVER w - sum(hit) OVER w AS island FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS length, count(*) >= 3 AS stops FROM m WHERE hit = 1 GROUP BY 1, 2")
def str06_failure_runs(spark, d):
    """Runs of failures; three on end stop a worker."""
    e = table(spark, d, "events").withColumn("hit", F.col("event_type") == "error")
    return O.runs(e, "user_id", ["ts", "event_id"], "hit").withColumn("stops", F.col("length") >= 3)


@query(f"WITH {CUR}, p AS (SELECT youtube_id, sha256 AS before_sha FROM (SELECT youtube_id, sha256, row_number() OVER (PARTITION BY youtube_id ORDER BY acquired_at DESC NULLS LAST, sha256 DESC NULLS LAST) AS rn FROM pipeline_transcripts WHERE youtube_id IS NOT NULL) WHERE rn = 1 AND sha256 IS NOT NULL) SELECT cur.youtube_id, p.before_sha, CASE WHEN p.before_sha = sha256(cur.transcript) THEN sha256(cur.transcript || ' (checked)') END AS after_sha, coalesce(p.before_sha = sha256(cur.transcript), false) AS applied FROM cur JOIN p USING (youtube_id)")
def str08_compare_and_set(spark, d):
    """Plans made for the latest known hash: those that still fit, and those that met another text."""
    cur = current(spark, d, after_sha=F.sha2(F.concat("transcript", F.lit(" (checked)")), 256))
    plan = table(spark, d, "pipeline_transcripts").where("youtube_id is not null").groupBy("youtube_id").agg(F.max_by("sha256", F.struct("acquired_at", "sha256")).alias("before_sha")).where("before_sha is not null")
    journal, conflicts = R.compare_and_set(cur, plan.join(cur.select("youtube_id", "after_sha"), "youtube_id"))
    return journal.withColumn("applied", F.lit(True)).unionByName(conflicts.select("youtube_id", "before_sha", F.lit(None).cast("string").alias("after_sha"), F.lit(False).alias("applied")))


@query("SELECT youtube_id, max(struct_pack(u := updated_at, a := attempts)).a AS attempts FROM pipeline_attempts WHERE youtube_id IS NOT NULL AND updated_at IS NOT NULL GROUP BY 1")
def str09_upsert(spark, d):
    a = table(spark, d, "pipeline_attempts").where("updated_at is not null").select("youtube_id", "updated_at", "attempts")
    return R.upsert(a, a, "youtube_id", "updated_at").select("youtube_id", "attempts")


@query()
def str10_fill_empty(spark, d):
    """Texts by their hashes: what a video without text gets from its best caption file, and what stays as it is."""
    files = C.best_local(table(spark, d, "raw_captions")).select("youtube_id", F.sha2("text", 256).alias("text_sha"))
    v = current(spark, d).select("id", "youtube_id", F.when(F.col("has_text"), F.col("text_sha")).alias("text_sha"))
    return R.fill_empty(v, files, "youtube_id", "text_sha").select("id", "text_sha")


@query("SELECT time_bucket(INTERVAL '1 minute', ts) AS start, event_type, count(*) AS n, sum(value) AS value FROM events GROUP BY 1, 2")
def str05_live_counts(spark, d):
    return state.live_counts(table(spark, d, "events")).withColumn("value", F.round("value", 4)).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


SQL["str05_live_counts"] = "SELECT strftime(time_bucket(INTERVAL '1 minute', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2"


@query("WITH f AS (SELECT youtube_id FROM pipeline_transcripts WHERE youtube_id IS NOT NULL UNION ALL SELECT replace(youtube_id, substr(youtube_id, 1, 1), '~') FROM pipeline_attempts WHERE youtube_id IS NOT NULL) SELECT DISTINCT youtube_id FROM f WHERE youtube_id NOT IN (SELECT youtube_id FROM videos WHERE youtube_id IS NOT NULL)")
def str11_discovery(spark, d):
    """Found ids that the catalogue lacks; each attempt also finds one of another video."""
    other = F.replace(F.col("youtube_id"), F.substring("youtube_id", 1, 1), F.lit("~"))
    found = table(spark, d, "pipeline_transcripts").where("youtube_id is not null").select("youtube_id").unionAll(table(spark, d, "pipeline_attempts").where("youtube_id is not null").select(other))
    return state.new_ids(found, table(spark, d, "videos").select("youtube_id"))


@query("WITH RECURSIVE e AS (SELECT user_id, event_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events), p AS (SELECT user_id, event_id, rn, t AS start FROM e WHERE rn = 1 UNION ALL SELECT e.user_id, e.event_id, e.rn, greatest(e.t, p.start + 3600) FROM p JOIN e ON e.user_id = p.user_id AND e.rn = p.rn + 1) SELECT user_id, event_id, round(start, 3) AS start FROM p")
def str04_paced_calls(spark, d):
    """When each call of a user may start if calls are at least an hour apart."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.col("ts").cast("timestamp").cast("double").alias("t"))
    return O.paced(e, "user_id", ["ts", "event_id"], "t", 3600.0).select("user_id", "event_id", F.round("start", 3).alias("start"))


@query(r"SELECT DISTINCT youtube_id, title FROM videos WHERE regexp_matches(youtube_id, '^[A-Za-z0-9_-]{11}$') AND title IS NOT NULL AND trim(title) <> ''")
def src08_line_streams(spark, d):
    """Titles written as lines and read back."""
    lines = table(spark, d, "videos").where("title is not null and trim(title) <> ''").select(F.concat("youtube_id", F.lit("[SEP]"), "title").alias("value"), "title")
    return readers.separated_lines(lines).distinct()


@query("SELECT DISTINCT youtube_id, title FROM videos WHERE title IS NOT NULL")
def src07_playlists(spark, d):
    lists = table(spark, d, "videos").where("title is not null").groupBy("channel_id", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("youtube_id").alias("id"), "title")).alias("entries"))).alias("value"))
    return readers.playlist_entries(lists).distinct()


@query("SELECT DISTINCT youtube_id, CASE WHEN regexp_matches(last_error, '^[^ ]+') THEN regexp_extract(trim(last_error), '^([^ ]+)', 1) END AS marker FROM pipeline_attempts WHERE last_error IS NOT NULL AND regexp_matches(youtube_id, '^[A-Za-z0-9_-]{11}$') AND NOT regexp_matches(last_error, '[\\[\\]#]')")
def src21_blacklist(spark, d):
    a = table(spark, d, "pipeline_attempts").where(F.col("last_error").isNotNull() & ~F.col("last_error").rlike(r"[\[\]#]"))
    return readers.blacklist(a.select(F.concat("youtube_id", F.lit(" # "), "last_error").alias("value"))).distinct()


SQL |= {
    "src04_local_caption": f"WITH {SPOKEN}, {BEST} SELECT youtube_id, path, sha256(text) AS text_sha FROM best",
    "win01_spoken_windowed": f"WITH {SPOKEN} SELECT path, sha256(text) AS text_sha FROM sp",
    "txt02_clean_captions": f"WITH {SPOKEN} SELECT path, removed, sha256(text) AS text_sha FROM sp",
    "txt01_strip_markup": f"SELECT raw_path, sha256({plain_markup('t')}) AS text_sha FROM (SELECT raw_path, min(raw_text) AS t FROM raw_captions WHERE regexp_matches(raw_text, '[<&]') GROUP BY 1)",
    "txt03_rendered_triples": f"WITH {SPOKEN}, k AS (SELECT path, string_agg(array_to_string(list_transform(l, lambda x: x.t), ' '), ' ' ORDER BY pos) AS t, count(*) AS n FROM c1 WHERE len(l) > 0 GROUP BY 1) SELECT path, CAST(2 * n AS INTEGER) AS removed, sha256(t) AS text_sha FROM k WHERE n >= 2",
    "str10_fill_empty": f"WITH {CUR}, {SPOKEN}, {BEST} SELECT cur.id, CASE WHEN {TXT} THEN sha256(cur.transcript) ELSE sha256(best.text) END AS text_sha FROM cur LEFT JOIN best USING (youtube_id)",
}
