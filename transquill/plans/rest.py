"""Queries over formats, states and decisions whose inputs the tables don't hold as they are: both dialects make them in the same way."""

from __future__ import annotations

from pyspark.sql import functions as F

from transquill.functions import kernels as K
from transquill.functions import text as X
from transquill.functions.arrow import map_documents
from transquill.operators import captions as C
from transquill.operators import quality as Q
from transquill.operators import relational as R
from transquill.operators import search as S
from transquill.operators import states as T
from transquill.plans.catalog import ATT, BEST, CUR, LETTERS, NOSUBS, SOUND, SPOKEN, TXT, attempts, current, query, searched, table, texts, texts_of
from transquill.plans.more import SIGNALS, STATUS, signals
from transquill.sources import readers

#: A listing of subtitles for each id, in both dialects.
LISTING = "CASE id % 6 WHEN 0 THEN 'HTTP Error 429: Too Many Requests' WHEN 1 THEN 'this video has no subtitles' WHEN 2 THEN concat('Language formats', chr(10), 'en   vtt', chr(10), 'fr   vtt') WHEN 3 THEN concat('Language formats', chr(10), 'fr   vtt') WHEN 4 THEN concat('Language formats', chr(10), 'en   vtt') ELSE concat('Language formats', chr(10), 'ja vtt') END"
#: The path of a file for each id, of each kind.
PATHS = ["x/.git/objects/a", "DATABASE/db.sqlite-wal", "M/_Captions_GZ/talk.mp4", "W/_CAPTIONS_GZ/a.vtt.gz", "W/_VERIFIED_TEXT_GZ/a.txt.gz", "W/_LEGACY_RENDERED_GZ/a.txt.gz", "DATABASE/PIPELINE.db", "B/snapshots/a.bin", "B/a.verified.json", "R/a.fr.vtt.gz", "4_Packs/a.txt", "Q/2_TXT/a.txt", "Q/notes/a.txt", "R/a.info.json", "S/run.ps1", "S/readme.doc"]
PATH_OF = "CASE id % 16 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PATHS)) + " END"
IDS = "SELECT DISTINCT id, youtube_id, title FROM videos"


def ids(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "videos").select("id", "youtube_id", "title").distinct()


# ---- sources


@query("SELECT DISTINCT youtube_id, title, upload_date FROM videos WHERE title IS NOT NULL AND NOT regexp_matches(title, '[<>&\\x00-\\x1f]') AND trim(title) <> '' AND regexp_matches(upload_date, '^[0-9]{8}$')")
def src06_feeds(spark, d):
    """Feeds of some thousand entries each, and what is read from them."""
    v = table(spark, d, "videos").where(F.col("title").isNotNull() & ~F.col("title").rlike(r"[<>&\x00-\x1f]") & (F.trim("title") != "") & F.col("upload_date").rlike("^[0-9]{8}$")).select("youtube_id", "title", "upload_date").distinct()
    date = F.concat_ws("-", F.substring("upload_date", 1, 4), F.substring("upload_date", 5, 2), F.substring("upload_date", 7, 2))
    entry = F.concat(F.lit("<entry><yt:videoId>"), "youtube_id", F.lit("</yt:videoId><title>"), "title", F.lit("</title><published>"), date, F.lit("T10:00:00+00:00</published></entry>"))
    feeds = v.groupBy(F.pmod(F.xxhash64("youtube_id"), F.lit(64))).agg(F.concat(F.lit('<feed xmlns:yt="u">'), F.array_join(F.collect_list(entry), ""), F.lit("</feed>")).alias("value"))
    return readers.feed_entries(feeds)


@query("SELECT yt_url AS url, prefix, nullif(trim(lang_config), '') AS lang FROM channels WHERE yt_url IS NOT NULL")
def src09_channels_config(spark, d):
    """The configuration written as a table with the old name of its language column, and read back."""
    from transquill.operators.storage import scratch

    path = scratch(spark, "config")
    table(spark, d, "channels").where("yt_url is not null").select(F.col("yt_url").alias("URL"), F.col("prefix").alias("Prefixe"), F.col("lang_config").alias("Langue")).coalesce(1).write.option("sep", ";").option("header", True).csv(path)
    return readers.channels_config(spark, path).select("url", "prefix", F.nullif("lang", F.lit("")).alias("lang"))


@query(f"WITH {CUR}, {ATT}, f AS (SELECT youtube_id, CASE WHEN attempts % 2 = 0 THEN 'SUCCESS' ELSE 'FAIL' END AS status, CASE WHEN attempts % 3 = 0 THEN '' ELSE 'fetched ' || youtube_id END AS transcript FROM att) SELECT cur.youtube_id, CASE WHEN f.transcript IS NOT NULL THEN 'SUCCESS' ELSE cur.status END AS status, coalesce(sha256(f.transcript), CASE WHEN {TXT.replace('transcript', 'cur.transcript')} THEN sha256(cur.transcript) END) AS text_sha FROM cur LEFT JOIN (SELECT * FROM f WHERE status = 'SUCCESS' AND transcript <> '') f ON f.youtube_id = cur.youtube_id")
def src10_fetch_results(spark, d):
    """Results of fetches by hand: only successes with a text are taken, over whatever was there."""
    a = attempts(spark, d).select("youtube_id", F.when(F.col("attempts") % 2 == 0, "SUCCESS").otherwise("FAIL").alias("status"), F.when(F.col("attempts") % 3 == 0, "").otherwise(F.concat(F.lit("fetched "), "youtube_id")).alias("transcript"))
    v = current(spark, d).select("youtube_id", "status", F.when(F.col("has_text"), F.col("text_sha")).alias("text_sha"))
    return readers.injected(v, a)


@query(f"""WITH {CUR}, f AS (SELECT youtube_id, CASE WHEN id % 5 = 0 THEN '{{"id": "' || youtube_id || '", "formats": []}}' WHEN id % 5 = 1 THEN '   ' ELSE 'recovered words of ' || youtube_id END AS text FROM cur WHERE id % 2 = 0) SELECT cur.youtube_id, 'SUCCESS (RECOVERY)' AS status, sha256(trim(f.text)) AS text_sha FROM cur JOIN f USING (youtube_id) WHERE NOT ({TXT}) AND trim(f.text) <> '' AND NOT contains(f.text, '"formats"')""")
def src12_recovery_folder(spark, d):
    """Files of a recovery folder: metadata and empty files are refused, and only videos without text are filled."""
    text = F.when(F.col("id") % 5 == 0, F.concat(F.lit('{"id": "'), "youtube_id", F.lit('", "formats": []}'))).when(F.col("id") % 5 == 1, "   ").otherwise(F.concat(F.lit("recovered words of "), "youtube_id"))
    files = ids(spark, d).where("id % 2 = 0").select(F.concat(F.lit("_RECOVERY/"), "youtube_id", F.lit(".txt")).alias("path"), text.alias("text"))
    return readers.recovered(current(spark, d).select("youtube_id", "has_text"), files)


@query(f"WITH {CUR}, s AS (SELECT id, youtube_id, CASE id % 4 WHEN 0 THEN 'fr' WHEN 1 THEN 'en' WHEN 2 THEN 'ja' ELSE 'fr' END AS lang, CASE WHEN id % 7 = 0 THEN 'bad ????' WHEN id % 7 = 1 THEN 'short' ELSE 'spoken words of video ' || youtube_id END AS text FROM cur) SELECT youtube_id, lang, sha256(text) AS text_sha FROM s WHERE lang IN ('fr', 'en') AND length(text) > 10 AND NOT contains(text, '????') AND NOT contains(text, '-->') AND youtube_id NOT IN (SELECT youtube_id FROM pipeline_transcripts WHERE youtube_id IS NOT NULL)")
def src13_sidecars(spark, d):
    """Metadata sidecars with their captions: ids that are known, other languages, damaged and very short texts are left out."""
    lang = F.when(F.col("id") % 4 == 1, "en").when(F.col("id") % 4 == 2, "ja").otherwise("fr")
    text = F.when(F.col("id") % 7 == 0, "bad ????").when(F.col("id") % 7 == 1, "short").otherwise(F.concat(F.lit("spoken words of video "), "youtube_id"))
    info = ids(spark, d).select(F.to_json(F.struct(F.col("youtube_id").alias("id"), F.coalesce("title", F.lit("")).alias("title"))).alias("value"))
    captions = ids(spark, d).select("youtube_id", lang.alias("lang"), text.alias("text")).distinct()
    known = table(spark, d, "pipeline_transcripts").select("youtube_id")
    return readers.sidecars(readers.metadata(info), captions, known, ("fr", "en")).select("youtube_id", "lang", F.sha2("text", 256).alias("text_sha")).distinct()


@query("WITH o AS (SELECT youtube_id, min(struct_pack(i := id, c := channel_id)) AS r FROM videos WHERE youtube_id IS NOT NULL AND id % 3 = 0 GROUP BY 1), n AS (SELECT 'old-' || (id % 4) AS prefix, youtube_id FROM videos WHERE youtube_id IS NOT NULL AND id % 2 = 0), c AS (SELECT prefix, row_number() OVER (ORDER BY prefix) + (SELECT max(id) FROM channels) AS id FROM (SELECT DISTINCT prefix FROM n)), k AS (SELECT n.youtube_id, min(c.id) AS channel_id FROM n JOIN c USING (prefix) GROUP BY 1) SELECT youtube_id, CAST(r.c AS BIGINT) AS channel_id FROM o UNION ALL SELECT youtube_id, CAST(channel_id AS BIGINT) FROM k WHERE youtube_id NOT IN (SELECT youtube_id FROM o)")
def src14_merge_databases(spark, d):
    """Tables of single channels merged into the catalogue: their channels are created where missing, and of an id the first row stays."""
    v = table(spark, d, "videos").where("youtube_id is not null")
    own = v.where("id % 3 = 0").groupBy("youtube_id").agg(F.min(F.struct("id", "channel_id"))["channel_id"].cast("long").alias("channel_id"))
    others = v.where("id % 2 = 0").select(F.concat(F.lit("old-"), (F.col("id") % 4).cast("string")).alias("prefix"), "youtube_id")
    return readers.merged(own, table(spark, d, "channels").select(F.col("id").cast("long").alias("id"), "prefix"), others)[0]


@query("SELECT DISTINCT youtube_id, youtube_id AS id FROM videos WHERE youtube_id IS NOT NULL")
def src16_truncated_json(spark, d):
    """The id of metadata of which only the beginning is there; ids of nested objects come first, and the rest is cut off."""
    v = table(spark, d, "videos").where("youtube_id is not null").select("youtube_id").distinct()
    header = F.concat(F.lit('{"channel": {"id": "no-such-id-"}, "tags": ["id"], "id": "'), "youtube_id", F.lit('", "formats": [{"url": "https://tube.example/very/lo'))
    return readers.top_level_ids(v.select("youtube_id", header.alias("header")), "youtube_id", "header")


@query(f"WITH f AS (SELECT {PATH_OF} AS path, id * 10 AS bytes, id % 5 = 0 AS tracked FROM ({IDS})) SELECT path, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS files FROM f WHERE NOT tracked GROUP BY 1")
def src18_inventory_lines(spark, d):
    """Lines of a file inventory in JSON, malformed ones among them."""
    line = F.to_json(F.struct(F.expr(PATH_OF).alias("path"), (F.col("id") * 10).alias("size_bytes"), (F.col("id") % 5 == 0).alias("git_tracked"), F.lit(None).cast("string").alias("youtube_id")))
    lines = ids(spark, d).select(F.explode(F.array(line, F.lit('{"path": "cut o'))).alias("value"))
    return readers.inventory_lines(lines).where(~F.col("git_tracked")).groupBy("path").agg(F.sum("size_bytes").alias("bytes"), F.count("*").alias("files"))


@query("SELECT CASE WHEN ends_with(raw_path, '.vtt') OR ends_with(raw_path, '.srt') OR ends_with(raw_path, '.ass') THEN 'caption_source' ELSE 'other' END AS category, count(*) AS files, CAST(sum(strlen(raw_text)) AS BIGINT) AS bytes FROM (SELECT DISTINCT raw_path, raw_text FROM raw_captions) GROUP BY 1")
def src19_file_inventory(spark, d):
    """Files by category with their sizes; contents are measured, not exchanged."""
    files = table(spark, d, "raw_captions").select("raw_path", F.octet_length("raw_text").alias("bytes"), F.xxhash64("raw_text").alias("h")).distinct()
    return files.groupBy(T.file_kind(F.col("raw_path")).alias("category")).agg(F.count("*").alias("files"), F.sum("bytes").cast("long").alias("bytes"))


@query("SELECT DISTINCT youtube_id FROM pipeline_attempts WHERE last_error LIKE 'HTTP Error 429%' AND regexp_matches(youtube_id, '^[A-Za-z0-9_-]{11}$')")
def src20_limited_in_logs(spark, d):
    """Logs in which a line with the id stands before the line with the error."""
    a = table(spark, d, "pipeline_attempts").where("last_error is not null").select("youtube_id", "last_error").distinct()
    lines = a.select("youtube_id", F.posexplode(F.array(F.concat(F.lit("get ["), "youtube_id", F.lit("] now")), F.col("last_error"))).alias("line_no", "value"))
    return readers.rate_limited(lines, "youtube_id")


@query(f"WITH {CUR} SELECT status, count(*) AS n FROM cur GROUP BY 1")
def src22_sql_template(spark, d):
    """A query taken from a script's text; only a fixed SELECT is accepted."""
    script = 'Write-Host "x"\n$statusSql = @"\nSELECT status, count(*) AS n FROM latest_videos GROUP BY status\n"@\n'
    current(spark, d).createOrReplaceTempView("latest_videos")
    return spark.sql(readers.sql_template(script, "statusSql"))


# ---- filters and states


@query(f"WITH {CUR} SELECT cur.youtube_id, cur.title, c.prefix AS channel FROM cur JOIN channels c ON c.id = cur.channel_id WHERE (transcript IS NULL OR transcript = '') AND status IN ('NO_SUBS', 'PREMIUM') AND cur.id % 2 = 0")
def flt08_upload_candidates(spark, d):
    """Media are there for every second video."""
    v = current(spark, d).withColumn("is_downloaded", F.when(F.col("id") % 2 == 0, "OUI").otherwise("NON"))
    return T.upload_candidates(v, table(spark, d, "channels"))


@query("SELECT id % 16 AS no, count(*) AS n, CASE id % 16 WHEN 0 THEN 'git_history' WHEN 1 THEN 'sqlite_journal_protected' WHEN 2 THEN 'media' WHEN 3 THEN 'canonical_timed_source_protected' WHEN 4 THEN 'canonical_text_source_protected' WHEN 5 THEN 'revision_original_protected' WHEN 6 THEN 'database' WHEN 7 THEN 'backup_protected' WHEN 8 THEN 'backup_protected' WHEN 9 THEN 'caption_source' WHEN 10 THEN 'generated_pack' WHEN 11 THEN 'generated_transcript' WHEN 12 THEN 'other_text' WHEN 13 THEN 'video_metadata' WHEN 14 THEN 'code_or_runtime' ELSE 'other' END AS kind FROM (" + IDS + ") GROUP BY ALL")
def flt15_file_kind(spark, d):
    """Every kind of file; the order of the rules matters."""
    return ids(spark, d).select((F.col("id") % 16).alias("no"), T.file_kind(F.expr(PATH_OF)).alias("kind")).groupBy("no", "kind").agg(F.count("*").alias("n"))


@query(f"WITH {CUR}, l AS (SELECT DISTINCT youtube_id FROM pipeline_attempts WHERE last_error LIKE 'HTTP Error 429%') SELECT cur.id, CASE WHEN l.youtube_id IS NOT NULL AND NOT ({TXT}) THEN 'RETRY_429' WHEN status = 'PREMIUM' THEN 'PENDING' ELSE status END AS status, CASE WHEN cur.id % 9 = 0 THEN 'UPLOADED' END AS recovery_status FROM cur LEFT JOIN l USING (youtube_id)")
def flt16_status_edits(spark, d):
    """Edits by hand as a new version of the states: restricted videos again, limited ones, uploaded ones."""
    limited = table(spark, d, "pipeline_attempts").where("last_error like 'HTTP Error 429%'").select("youtube_id").distinct().withColumn("limited", F.lit(True))
    v = current(spark, d).select("id", "youtube_id", "status", "has_text").join(limited, "youtube_id", "left")
    return v.select("id", T.edited_status(F.col("status"), F.col("has_text"), F.lit(True), F.coalesce("limited", F.lit(False))).alias("status"), F.when(F.col("id") % 9 == 0, "UPLOADED").alias("recovery_status"))


@query(f"SELECT id, CASE id % 6 WHEN 0 THEN 'RETRY_429' WHEN 1 THEN 'DIAG_NO_SUBS' WHEN 2 THEN 'DIAG_HAS_BOTH' WHEN 3 THEN 'DIAG_HAS_FR' WHEN 4 THEN 'DIAG_HAS_EN' ELSE 'DIAG_HAS_OTHER' END AS diagnosis FROM ({IDS})")
def flt17_diagnosis(spark, d):
    return ids(spark, d).select("id", T.diagnosis(F.expr(LISTING)).alias("diagnosis"))


@query("SELECT DISTINCT youtube_id AS id, CASE id % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'fr' WHEN 2 THEN 'fr' END AS lang, CASE id % 4 WHEN 0 THEN 'manual' WHEN 1 THEN 'manual' WHEN 2 THEN 'automatic' END AS source FROM videos WHERE youtube_id IS NOT NULL")
def flt18_caption_choice(spark, d):
    """People's captions in the order of the languages, then automatic ones; those without the timed format don't count."""
    j = "CASE id % 4 WHEN 0 THEN '\"subtitles\":{\"de\":[{\"ext\":\"vtt\"}]},\"automatic_captions\":{\"fr\":[{\"ext\":\"vtt\"}]}' WHEN 1 THEN '\"subtitles\":{\"de\":[{\"ext\":\"vtt\"}],\"fr\":[{\"ext\":\"vtt\"}]}' WHEN 2 THEN '\"subtitles\":{\"fr\":[{\"ext\":\"json\"}]},\"automatic_captions\":{\"fr\":[{\"ext\":\"vtt\"}]}' ELSE '\"subtitles\":{\"ja\":[{\"ext\":\"vtt\"}]}' END"
    lines = ids(spark, d).where("youtube_id is not null").select(F.concat(F.lit('{"id":"'), "youtube_id", F.lit('",'), F.expr(j), F.lit("}")).alias("value"))
    return readers.caption_choice(readers.metadata(lines.distinct()), ("fr", "de"))


LANG_OF = "CASE id % 4 WHEN 0 THEN 'fr-CA' WHEN 1 THEN 'en' WHEN 2 THEN 'ja' ELSE '' END"


@query(f"SELECT youtube_id, youtube_id || ' # [AUTO-LANG: ja] ' || coalesce(title, '') AS line FROM ({IDS}) WHERE id % 4 = 2")
def flt20_rejected_languages(spark, d):
    return T.rejected_languages(ids(spark, d).select("youtube_id", F.expr(LANG_OF).alias("lang"), "title"))


@query(f"SELECT id, CASE id % 6 WHEN 1 THEN 'NO_SUBS_TOTAL' WHEN 2 THEN 'en' WHEN 3 THEN 'fr' WHEN 4 THEN 'en' WHEN 5 THEN 'NO_EN_FR' END AS target FROM ({IDS})")
def flt21_target_language(spark, d):
    return ids(spark, d).select("id", T.target_language(F.expr(LISTING)).alias("target"))


@query(f"SELECT youtube_id AS id, CASE WHEN id % 5 = 0 THEN 'PREMIUM' WHEN id % 5 = 1 THEN 'NO_SUBS' ELSE 'DONE' END AS state FROM ({IDS}) WHERE youtube_id IS NOT NULL")
def flt23_availability(spark, d):
    """Whether a video is open to all and has captions, by its metadata."""
    j = "CASE id % 5 WHEN 0 THEN '\"availability\":\"premium_only\",\"subtitles\":{\"fr\":[]}' WHEN 1 THEN '\"availability\":\"public\",\"subtitles\":{}' WHEN 2 THEN '\"availability\":\"unlisted\",\"automatic_captions\":{\"fr\":[]}' ELSE '\"availability\":\"public\",\"subtitles\":{\"en\":[]}' END"
    meta = readers.metadata(ids(spark, d).where("youtube_id is not null").select(F.concat(F.lit('{"id":"'), "youtube_id", F.lit('",'), F.expr(j), F.lit("}")).alias("value")))
    return meta.select("id", T.availability(meta).alias("state"))


@query("SELECT c.id, coalesce(nullif(k.lang, ''), c.lang_config) AS lang_config FROM channels c LEFT JOIN (SELECT prefix, CASE WHEN id % 3 = 0 THEN 'fr' WHEN id % 3 = 1 THEN '' ELSE 'en' END AS lang FROM channels WHERE id % 4 <> 0) k USING (prefix)")
def flt24_config_update(spark, d):
    """Channels updated by prefix from a configuration written and read as a table; what it leaves blank stays."""
    from transquill.operators.storage import scratch

    path = scratch(spark, "config")
    c = table(spark, d, "channels")
    c.where("id % 4 <> 0").select(F.lit("u").alias("URL"), F.col("prefix").alias("Prefixe"), F.when(F.col("id") % 3 == 0, "fr").when(F.col("id") % 3 == 1, "").otherwise("en").alias("Language")).coalesce(1).write.option("sep", ";").option("header", True).csv(path)
    new = readers.channels_config(spark, path).select("prefix", F.nullif("lang", F.lit("")).alias("new"))
    return c.join(new, "prefix", "left").select("id", F.coalesce("new", "lang_config").alias("lang_config"))


# ---- joins, aggregates, orders, sets


@query(f"WITH {CUR} SELECT c.id AS channel_id, count(*) AS rows_all, count(v.id) AS videos FROM channels c LEFT JOIN cur v ON v.channel_id = c.id GROUP BY 1")
def jon03_channels_left(spark, d):
    """Channels with their videos; one without any keeps its null row, which counts."""
    n = current(spark, d).groupBy("channel_id").agg(F.count("*").alias("n"))
    c = table(spark, d, "channels").select(F.col("id").alias("channel_id"))
    return c.join(n, "channel_id", "left").select("channel_id", F.coalesce("n", F.lit(1)).alias("rows_all"), F.coalesce("n", F.lit(0)).alias("videos"))


@query(f"WITH {CUR} SELECT c.prefix, (SELECT string_agg(x.youtube_id, ',' ORDER BY x.id) FROM (SELECT youtube_id, id FROM cur WHERE cur.channel_id = c.id AND status = 'PREMIUM' ORDER BY id LIMIT 100) x) AS premium, (SELECT string_agg(x.youtube_id, ',' ORDER BY x.id) FROM (SELECT youtube_id, id FROM cur WHERE cur.channel_id = c.id AND {NOSUBS} ORDER BY id LIMIT 100) x) AS no_subs FROM channels c")
def jon04_lists_of_channels(spark, d):
    """Lists that SQL asks for by correlated subqueries, as one aggregation and a join."""
    lists = R.channel_lists(current(spark, d)).groupBy("channel_id").agg(F.max(F.when(F.col("list") == "premium", F.col("ids"))).alias("premium"), F.max(F.when(F.col("list") == "no_subs", F.col("ids"))).alias("no_subs"))
    return table(spark, d, "channels").select(F.col("id").alias("channel_id"), "prefix").join(lists, "channel_id", "left").select("prefix", "premium", "no_subs")


@query(f"WITH {CUR} SELECT r.raw_path, cur.status, coalesce(length(trim(coalesce(cur.transcript, ''))) > 0 AND starts_with(cur.status, 'SUCCESS'), false) AS safe_to_purge FROM (SELECT DISTINCT raw_path, regexp_extract(raw_path, '(?:^|[/\\\\])([A-Za-z0-9_-]{{11}})(?:\\.[A-Za-z0-9-]+)*$', 1) AS youtube_id FROM raw_captions) r LEFT JOIN cur USING (youtube_id)")
def jon09_safe_to_purge(spark, d):
    """Files whose videos have their text for sure."""
    files = table(spark, d, "raw_captions").select("raw_path", C.video_id(F.col("raw_path")).alias("youtube_id")).distinct()
    v = current(spark, d).select("youtube_id", "status", "has_text")
    return files.join(v, "youtube_id", "left").select("raw_path", "status", T.purge_candidate(F.col("status"), F.col("has_text").cast("int")).alias("safe_to_purge"))


@query(f"WITH {CUR}, {ATT}, f AS (SELECT DISTINCT regexp_extract(raw_path, '(?:^|[/\\\\])([A-Za-z0-9_-]{{11}})(?:\\.[A-Za-z0-9-]+)*$', 1) AS youtube_id FROM raw_captions), p AS (SELECT youtube_id, 'pack-' || (min(id) % 3) AS pack FROM cur WHERE {TXT} GROUP BY 1) SELECT cur.id, CASE WHEN att.last_error = 'members only' THEN 'BLACKLISTED' WHEN {TXT} THEN 'SUCCESS (DENSE)' WHEN f.youtube_id IS NOT NULL THEN 'DOWNLOADED (RAW ONLY)' WHEN att.youtube_id IS NOT NULL THEN 'FAILED/PENDING' ELSE 'DETECTED (ON YT)' END AS state, coalesce(p.pack, '') AS pack FROM cur LEFT JOIN f USING (youtube_id) LEFT JOIN att USING (youtube_id) LEFT JOIN p USING (youtube_id)")
def jon14_inventory_state(spark, d):
    """Where each catalogued video stands: blacklist, dense texts, raw files, failures and packs, in their order."""
    raw = table(spark, d, "raw_captions").select(C.video_id(F.col("raw_path")).alias("youtube_id")).where("youtube_id is not null").distinct().withColumn("raw", F.lit(True))
    tried = attempts(spark, d).select("youtube_id", (F.col("last_error") == "members only").alias("black"), F.lit(True).alias("tried"))
    v = current(spark, d).select("id", "youtube_id", "has_text", F.when(F.col("has_text"), F.concat(F.lit("pack-"), (F.col("id") % 3).cast("string"))).otherwise("").alias("pack"))
    state = T.inventory_state(F.col("black"), F.col("has_text"), F.col("raw"), F.col("tried"))
    return v.join(raw, "youtube_id", "left").join(tried, "youtube_id", "left").select("id", state.alias("state"), "pack")


@query("SELECT count(*) AS videos, floor(CAST(sum(CAST(duration AS DECIMAL(18,3))) AS DOUBLE) / 3.6) / 1000 AS hours, count(*) * 10000 AS words FROM (SELECT channel_id, id, max(duration) AS duration FROM videos GROUP BY 1, 2)")
def agg13_live_stats(spark, d):
    """Over the tables of all channels put together; words are estimated by the videos."""
    v = table(spark, d, "videos")
    parts = [v.where(F.pmod("channel_id", F.lit(4)) == i).select("channel_id", "id", "duration") for i in range(4)] + [v.where("channel_id is null").select("channel_id", "id", "duration")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4]).groupBy("channel_id", "id").agg(F.max("duration").alias("duration"))
    return every.agg(F.count("*").alias("videos"), (F.floor(F.sum(F.col("duration").cast("decimal(18,3)")).cast("double") / 3.6) / 1000).alias("hours"), (F.count("*") * 10000).alias("words"))


@query(f"WITH {CUR}, v AS (SELECT channel_id, id, CAST(floor(coalesce(duration, 0)) AS BIGINT) AS secs, len(list_filter(string_split_regex(transcript, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS w FROM cur WHERE {TXT} AND NOT contains(transcript, 'SOURCE:') AND NOT contains(transcript, '[DUR:')) SELECT channel_id, count(*) AS sources, CAST(sum(CAST(floor(secs) AS BIGINT)) AS BIGINT) AS seconds, CAST(sum(w + 4) AS BIGINT) AS words FROM v GROUP BY 1")
def agg14_pack_review(spark, d):
    """Words, sources and seconds of each channel's pack, counted in its text."""
    v = texts_of(spark, d, current(spark, d).where("has_text").select("id", "channel_id", F.floor(F.coalesce("duration", F.lit(0.0))).cast("long").alias("secs")))
    v = v.where(~F.col("transcript").contains("SOURCE:") & ~F.col("transcript").contains("[DUR:"))
    part = F.concat("transcript", F.lit("\n### SOURCE: "), F.col("id").cast("string"), F.lit(" [DUR:"), F.col("secs").cast("string"), F.lit("]###\n"))
    packs = v.groupBy("channel_id", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(F.array_join(F.collect_list(part), "").alias("pack"))
    return R.pack_review(packs, "pack").groupBy("channel_id").agg(F.sum("sources").alias("sources"), F.sum("seconds").alias("seconds"), F.sum("words").alias("words"))


@query(f"WITH {ATT} SELECT c.prefix, CASE WHEN regexp_matches(a.last_error, '^[^ ]+') THEN regexp_extract(a.last_error, '^([^ ]+)', 1) END AS reason, count(*) AS n FROM att a JOIN (SELECT DISTINCT youtube_id, channel_id FROM videos) v USING (youtube_id) JOIN channels c ON c.id = v.channel_id WHERE a.last_error IS NOT NULL GROUP BY 1, 2")
def agg15_blacklist_reasons(spark, d):
    """Why catalogued videos are ignored, by channel."""
    lines = readers.blacklist(attempts(spark, d).where("last_error is not null").select(F.concat("youtube_id", F.lit(" # "), "last_error").alias("value")))
    v = table(spark, d, "videos").select("youtube_id", "channel_id").distinct().join(table(spark, d, "channels").select(F.col("id").alias("channel_id"), "prefix"), "channel_id")
    return lines.join(v, "youtube_id").groupBy("prefix", F.col("marker").alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {SPOKEN} SELECT path, rolls, removed FROM sp")
def win02_rolling_files(spark, d):
    """Which caption files roll, and how many of their display lines say nothing new."""
    return C.spoken_files(table(spark, d, "raw_captions")).select("path", "rolls", "removed")


@query("SELECT CAST(doc_id AS VARCHAR) AS raw_path, true AS whole FROM documents WHERE trim(coalesce(text, '')) <> '' AND len(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) >= 24")
def win03_overlaps(spark, d):
    """Spoken text of cues that begin before the one before ends, and again with what is said already."""
    cues = table(spark, d, "documents").where(X.has_text(F.col("text"))).select("doc_id", F.slice(X.words(F.col("text")), 1, 24).alias("w")).where("size(w) = 24")
    at = lambda k: F.concat(F.lit("00:00:"), F.lpad(F.lit(2 * k).cast("string"), 2, "0"), F.lit(".000 --> 00:00:"), F.lpad(F.lit(2 * k + 3).cast("string"), 2, "0"), F.lit(".000\n"))
    raw = F.concat(F.lit("WEBVTT\n\n"), *(F.concat(at(k), F.array_join(F.slice("w", 4 * k + 1, 8), " "), F.lit("\n\n")) for k in range(5)))
    files = cues.select(F.col("doc_id").cast("string").alias("raw_path"), raw.alias("raw_text"), F.array_join("w", " ").alias("want"))
    said = C.spoken_files(files.select("raw_path", "raw_text")).select(F.col("path").alias("raw_path"), "text")
    return files.select("raw_path", "want").join(said, "raw_path").select("raw_path", (F.col("text") == F.col("want")).alias("whole"))


@query(f"WITH {CUR}, " + r"""s AS (SELECT id, regexp_extract_all(translate(lower(concat_ws(' ', coalesce(title, ''), coalesce(transcript, ''))), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\p{L}\p{N}\p{M}_’''-]+') AS t FROM cur),
f AS (SELECT id, len(t)::DOUBLE AS n, len(list_filter(t, lambda x: starts_with(x, 'the')))::DOUBLE AS a FROM s), g AS (SELECT count(*)::DOUBLE AS docs, avg(n) AS mean, count(*) FILTER (a > 0)::DOUBLE AS da FROM f)
SELECT id, round(-(greatest(ln((docs - da + 0.5) / (da + 0.5)), 1e-6) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS rank FROM f, g WHERE a > 0 ORDER BY rank, id LIMIT 100""")
def top02_search_page(spark, d):
    """The best hundred of a search that very many texts match."""
    return S.ranked(searched(spark, d, "the"), "the", 100)


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, {STATUS} AS status, markers FROM sig WHERE markers > 0 OR alerts > 0 ORDER BY CASE WHEN {STATUS} = 'technical_issue' THEN 0 ELSE 1 END, markers DESC, id LIMIT 20")
def top03_review_priority(spark, d):
    """Which texts to look at first: technical issues, then by their markers."""
    s = signals(spark, d, plain=True)
    status = Q.status(s["markers"], s["alerts"])
    flagged = s.where((F.col("markers") > 0) | (F.col("alerts") > 0)).select("id", status.alias("status"), "markers")
    return flagged.orderBy(F.col("status") != "technical_issue", F.col("markers").desc(), "id").limit(20)


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, artifacts, alerts FROM sig WHERE artifacts > 0 OR alerts > 0 ORDER BY artifacts DESC, alerts DESC, id LIMIT 500")
def top04_repair_order(spark, d):
    """Garbled texts first, then those with the most repetitions."""
    return signals(spark, d, plain=True).where((F.col("artifacts") > 0) | (F.col("alerts") > 0)).orderBy(F.col("artifacts").desc(), F.col("alerts").desc(), "id").limit(500).select("id", "artifacts", "alerts")


@query("WITH l AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS x FROM events GROUP BY 1) SELECT user_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(x), lambda e: {'p': list_position(x, e), 'e': e})), lambda s: s.e), ',') AS kinds FROM l")
def top07_ordered_distinct(spark, d):
    """Each user's kinds of events in the order of their first."""
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("at"))
    return first.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"]), ",").alias("kinds"))


@query("WITH t AS (SELECT language AS before, source AS after FROM pipeline_transcripts WHERE language IS NOT NULL AND source IS NOT NULL AND cleaner_version = 'v15.0' UNION ALL SELECT language, 'learned' FROM pipeline_transcripts WHERE language IS NOT NULL AND cleaner_version = 'v16.0') SELECT before, max(after) AS after FROM t GROUP BY 1 HAVING count(DISTINCT after) = 1")
def set03_union_of_templates(spark, d):
    """Inherited and learned templates put together; those with two targets fall away."""
    t = table(spark, d, "pipeline_transcripts").where("language is not null and source is not null")
    inherited = t.where("cleaner_version = 'v15.0'").select(F.col("language").alias("before"), F.col("source").alias("after")).distinct()
    learned = table(spark, d, "pipeline_transcripts").where("language is not null and cleaner_version = 'v16.0'").select(F.col("language").alias("before"), F.lit("learned").alias("after")).distinct()
    return C.merged_artifacts(inherited, learned)


@query("SELECT 'Télé-scope (ET) été!' AS query, 'telescope et ete' AS terms UNION ALL SELECT '!!', '' UNION ALL SELECT 'a_b  C1', 'ab c1'")
def fts01_query_terms(spark, d):
    rows = [(q, " ".join(S.query_terms(q))) for q in ("Télé-scope (ET) été!", "!!", "a_b  C1")]
    return spark.createDataFrame(rows, "query string, terms string")


# ---- text and repair


@query(f"WITH s AS (SELECT DISTINCT id, list_filter(string_split_regex(translate(transcript, '<&>', '   '), '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS l FROM videos WHERE {TXT}) SELECT id, CAST(120 AS INTEGER) AS removed, sha256(array_to_string(l[1:60], chr(10)) || chr(10)) AS text_sha FROM s WHERE len(l) >= 60")
def txt04_technical_candidate(spark, d):
    """Texts with a caption header and lines shown three times, brought back."""
    words = X.words(F.translate("transcript", "<&>", "   "))
    line = F.transform(F.slice("w", 1, 60), lambda w: F.concat(F.lit("<00:00:01.000>"), w, F.lit("\n"), w, F.lit("\n"), w, F.lit("\n")))
    rows = texts(spark, d).select("id", words.alias("w")).where("size(w) >= 60").select("id", F.concat(F.lit("Kind: captions Language: fr\n"), F.array_join(line, "")).alias("t"))
    return C.technical_candidates(rows, "id", "t").select("id", "removed", F.sha2("text", 256).alias("text_sha")).distinct()


@query("SELECT 'é' AS letter, count(*) > 0 AS found FROM documents WHERE contains(text, 'é') UNION ALL SELECT 'è', count(*) > 0 FROM documents WHERE contains(text, 'è') UNION ALL SELECT 'à', count(*) > 0 FROM documents WHERE contains(text, 'à') UNION ALL SELECT 'ê', count(*) > 0 FROM documents WHERE contains(text, 'ê') UNION ALL SELECT 'ç', count(*) > 0 FROM documents WHERE contains(text, 'ç')")
def enc08_artifact_evidence(spark, d):
    """Which letters the evidence from all documents, garbled once, stands for."""
    seen = C.artifact_evidence(garbled(spark, d), "doc_id")
    letters = spark.createDataFrame([(c,) for c in "éèàêç"], "letter string")
    return letters.join(seen.select(F.col("after").alias("letter")).distinct().withColumn("found", F.lit(True)), "letter", "left").select("letter", F.coalesce("found", F.lit(False)).alias("found"))


def garbled(spark, d):  # noqa: ANN001, ANN201
    """(doc_id, before, after): all documents with their letters garbled once."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text")))
    bad = X.replaced(F.col("text"), [("é", "├®"), ("è", "├¿"), ("à", "├á"), ("ê", "├¬"), ("ç", "├º")])
    return docs.select("doc_id", bad.alias("before"), F.col("text").alias("after"))


PAIRS = [("├®", "é"), ("├®", "ée"), ("├", "é"), ("├e®", "é"), ("├®", "├®"), ("ab", "é"), ("├®├¿├á", ""), ("├®├¿├á├ª┬«", ""), ("��", "e"), ("├®", "7"), ("┬½", "«"), ("Ã©", "é"), ("├®├¿├áe├ª┬«├®├¿", "é")]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, {str(s).lower()}, {str(x).lower()})" for i, (s, x) in enumerate([(True, True), (False, False), (False, False), (False, False), (False, False), (False, False), (False, False), (True, True), (False, False), (False, False), (True, True), (True, True), (False, True)])) + ") t(no, sound, deep)")
def enc09_artifact_rules(spark, d):
    """What may be learned: never a letter or digit, no two targets at once, deletions only of long wrappers; the deep rule lets single e through."""
    rows = spark.createDataFrame([(i, b, a) for i, (b, a) in enumerate(PAIRS)], "no int, before string, after string")
    return map_documents(rows, ["no", "before", "after"], lambda n, b, a: [(n, K.sound_artifact(b, a), K.deep_artifact(b, a))], "no int, sound boolean, deep boolean")


@query(f"SELECT doc_id, CAST({LETTERS} AS INTEGER) AS n, true AS whole FROM documents WHERE doc_id % 2 = 1 AND {LETTERS} >= 1 AND {SOUND} AND NOT regexp_matches(text, 'Ã[^\x00-\x7f]|Â[^\x00-\x7f]')")
def enc11_deep_restore(spark, d):
    """Learned with the deep rule from half of the documents, applied to the garbled other half, where one letter is enough: whether the text came back."""
    g = garbled(spark, d).where(~F.col("after").rlike("�|Ôò|Ôö|û[▓╣┬│]|[┬├]|[─-▟]"))
    pairs = C.learned_artifacts(g.where("doc_id % 2 = 0"), "doc_id", deep=True)
    done = C.restored(g.where("doc_id % 2 = 1").select("doc_id", "before"), pairs, "doc_id", "before", deep=True)
    return done.join(g.select("doc_id", "after"), "doc_id").select("doc_id", "n", (F.col("text") == F.col("after")).alias("whole"))


# ---- quality


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, round(covered / greatest(words, 1)::DOUBLE, 6) AS share, longest, long_alerts, artifacts FROM sig WHERE alerts > 0")
def qua03_review_signals(spark, d):
    s = signals(spark, d, plain=True)
    return s.where("alerts > 0").select("id", F.round(Q.share(s), 6).alias("share"), "longest", "long_alerts", "artifacts")


def spoken_plan(spark, d):  # noqa: ANN001, ANN201
    """(id, transcript, events): what is said again at once, said once."""
    return C.spoken_once(texts(spark, d)).dropDuplicates(["id"]).withColumnRenamed("text", "transcript")


def gated(before, plan):  # noqa: ANN001, ANN201
    """Repairs (id, transcript) with the signals of before and after, of which those that may be taken."""
    after = C.quality_signals(plan).select("id", *(F.col(c).alias(f"{c}_after") for c in ("markers", "artifacts", "alerts", "words")))
    both = after.join(before.select("id", *(F.col(c).alias(f"{c}_before") for c in ("artifacts", "alerts"))), "id")
    return both.where(T.repair_gate(F.col("markers_after"), F.col("artifacts_before"), F.col("artifacts_after"), F.col("alerts_before"), F.col("alerts_after"), F.col("words_after")))


@query()
def qua06_repair_gate(spark, d):
    """Repairs of the spoken de-duplication that may be taken."""
    return gated(signals(spark, d), spoken_plan(spark, d)).select("id", "alerts_before", "alerts_after", "artifacts_before", "artifacts_after")


MADE = "id % 3 AS markers, id % 5 % 2 AS artifacts, id % 7 AS alerts, id % 4 AS sound_alerts, id % 2 AS filler_alerts, id % 90 AS covered, 100 AS words, id % 13 AS longest, id % 6 AS long_alerts, id % 11 = 0 AS excluded, id % 10 = 0 AS verified"


@query(f"WITH s AS (SELECT id, {MADE} FROM ({IDS})) SELECT id, CASE WHEN excluded THEN 'excluded_non_speech_loop' WHEN markers > 0 OR artifacts > 0 THEN 'priority_encoding_or_markup' WHEN alerts = 0 THEN 'no_remaining_alert' WHEN alerts <= sound_alerts + filler_alerts THEN 'annotations_or_short_oral_fillers' WHEN verified THEN 'matches_local_timed_source' WHEN (covered / 100.0 >= 0.10 AND long_alerts >= 2) OR (longest >= 10 AND long_alerts >= 5) THEN 'priority_long_repetitions' ELSE 'preserved_unconfirmed_oral_repetition' END AS triage FROM s")
def qua07_triage(spark, d):
    """All seven outcomes, on signals that the ids give."""
    s = ids(spark, d).selectExpr("id", *[x.strip() for x in MADE.split(",")])
    return s.select("id", Q.triage(s, F.col("excluded"), F.col("verified")).alias("triage"))


LOOP = "CASE WHEN id % 3 = 0 THEN repeat('The fire burns on and on. ', 120) WHEN id % 3 = 1 THEN repeat('The fire burns on and on. ', 40) ELSE concat(repeat('The fire burns on and on. ', 120), repeat('Now some speech follows here at last ', 60)) END"


@query(f"SELECT id, id % 3 = 0 AND id % 2 = 0 AS accepted FROM ({IDS})")
def qua08_loop_verdict(spark, d):
    """Loops without speech: only long texts of nearly one sentence, said twenty times, under titles that say so."""
    made = ids(spark, d).select("id", F.when(F.col("id") % 2 == 0, "Relaxation fireplace, no talking").otherwise("A talk on fireplaces").alias("title"), F.expr(LOOP).alias("transcript")).distinct()
    return Q.loops(made).select("id", "accepted").distinct()


@query()
def qua10_restoration_proof(spark, d):
    """Whether each video's caption file restores what its text lost."""
    files = C.best_local(table(spark, d, "raw_captions")).select("youtube_id", F.col("text").alias("after"))
    pairs = texts_of(spark, d, current(spark, d).where("has_text").select("id", "youtube_id").join(files, "youtube_id")).withColumnRenamed("transcript", "before")
    return C.restoration_proofs(pairs, "id")


@query(f"WITH s AS (SELECT id, id % 5 = 0 AS eligible, id % 3 = 0 AS changed, id % 2 AS markers, (id % 40) / 100.0 AS coverage, id % 9 AS long_groups, id % 60 AS alerts, id % 50 AS alerts_after FROM ({IDS})) SELECT id, CASE WHEN changed AND (markers > 0 OR alerts_after > alerts) THEN 'candidate_rejected' WHEN eligible THEN 'systemic_triplicates' WHEN changed THEN 'technical_metadata' WHEN markers > 0 THEN 'unresolved_markup' WHEN coverage >= 0.15 AND long_groups >= 5 THEN 'partial_triplicates_needs_source' WHEN alerts >= 30 THEN 'frequent_repetitions_unconfirmed' ELSE 'isolated_repetitions_unconfirmed' END AS category FROM s")
def qua11_maintenance_category(spark, d):
    s = ids(spark, d).selectExpr("id", "id % 5 = 0 AS eligible", "id % 3 = 0 AS changed", "id % 2 AS markers", "(id % 40) / 100.0 AS coverage", "id % 9 AS long_groups", "id % 60 AS alerts", "id % 50 AS alerts_after")
    c = F.col
    category = T.maintenance_category(c("eligible"), c("changed"), c("markers"), c("coverage"), c("long_groups"), c("alerts"))
    return s.select("id", F.when(c("changed") & T.rejected(F.lit(False), c("markers"), c("alerts_after"), c("alerts")), "candidate_rejected").otherwise(category).alias("category"))


@query(f"WITH s AS (SELECT id, id % 4 % 3 AS markers, 0 AS artifacts, 60 + id % 400 AS words, CAST(id % 900 AS DOUBLE) AS duration, id % 3 AS alerts, CASE WHEN id % 2 = 0 THEN id % 3 ELSE 0 END AS filler_alerts, 0 AS sound_alerts, CASE WHEN id % 5 = 0 THEN 2 ELSE 0 END AS long_alerts, id % 12 AS longest, id % 3 AS covered FROM ({IDS})) SELECT id, CASE WHEN markers > 0 OR artifacts > 0 THEN 'technical_or_encoding_issue' WHEN words < 100 THEN 'text_too_short_for_automatic_media_deletion' WHEN duration > 120 AND words < duration * 0.5 THEN 'text_coverage_too_low_for_duration' WHEN (alerts * 100.0 / words >= 0.10 AND long_alerts >= 2) OR (longest >= 10 AND long_alerts >= 5) THEN 'priority_repetition_review' WHEN alerts = 0 OR (filler_alerts + sound_alerts = alerts AND long_alerts = 0 AND covered * 1.0 / words <= 0.01 AND alerts * 100.0 / words <= 0.2) THEN 'healthy_database_text_and_backup' ELSE 'unexplained_repetitions_require_review' END AS verdict FROM s")
def qua12_retention(spark, d):
    """Which texts stand without their media; sparse oral repetitions that are explained may."""
    s = ids(spark, d).selectExpr("id", "id % 4 % 3 AS markers", "0 AS artifacts", "60 + id % 400 AS words", "CAST(id % 900 AS DOUBLE) AS duration", "id % 3 AS alerts", "CASE WHEN id % 2 = 0 THEN id % 3 ELSE 0 END AS filler_alerts", "0 AS sound_alerts", "CASE WHEN id % 5 = 0 THEN 2 ELSE 0 END AS long_alerts", "id % 12 AS longest", "id % 3 AS covered")
    return s.select("id", Q.retention(s).alias("verdict"))


@query("SELECT id, 'replace' AS operation FROM (SELECT DISTINCT id, transcript FROM videos WHERE " + TXT + ") WHERE regexp_matches(transcript, '(^|\\s)the(\\s|$)')")
def qua14_snippets(spark, d):
    """The first change between each text and a copy with one word replaced."""
    rows = texts(spark, d).select("id", "transcript", F.regexp_replace("transcript", r"(?<=^|\s)the(?=\s|$)", "THE-WORD").alias("after")).where("after <> transcript")
    return map_documents(rows, ["id", "transcript", "after"], lambda i, a, b: [(i, x[0]) for x in K.snippets(a, b, most=1)], "id bigint, operation string").distinct()


@query(f"WITH {CUR}, {SPOKEN}, {BEST} SELECT youtube_id, true AS not_empty, true AS found, true AS unchanged FROM best JOIN cur USING (youtube_id) WHERE {TXT} ORDER BY youtube_id LIMIT 3")
def qua16_pilot(spark, d):
    """A re-import of a few videos in an isolated copy: text is there, one of its words is found by the search, and the catalogue's text is unchanged."""
    return C.pilot(table(spark, d, "raw_captions"), current(spark, d), table(spark, d, "videos"), 3)


# ---- state


@query("WITH l AS (SELECT user_id, event_id, CASE WHEN event_id % 10 = 3 THEN '{\"user\": ' ELSE 'ok' END AS line FROM events) SELECT user_id, max(event_id) AS event_id FROM l WHERE line = 'ok' GROUP BY 1")
def str12_journal(spark, d):
    """Journal lines replayed: each tenth is cut off and skipped, the last of each key wins."""
    line = F.when(F.col("event_id") % 10 == 3, '{"user": ').otherwise(F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_id").alias("seq"))))
    return readers.journal(table(spark, d, "events").select(line.alias("value"))).select(F.col("user").alias("user_id"), F.col("seq").alias("event_id"))


@query("SELECT * FROM (VALUES ('audit', 1), ('plan', 1), ('publish', 1)) t(stage, runs)")
def str07_stages(spark, d):
    """Stages of a job whose ledger is kept: run again, those that are done are skipped."""
    from transquill.operators.ledger import Ledger
    from transquill.operators.storage import scratch

    ledger, ran = Ledger(spark, scratch(spark, "ledger")), []
    for _ in range(2):
        for stage in ("audit", "plan", "publish"):
            ledger.run("job", stage, lambda s=stage: ran.append(s) or len(ran))
    return spark.createDataFrame([(s, ran.count(s)) for s in ("audit", "plan", "publish")], "stage string, runs int")
