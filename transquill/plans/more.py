"""Further queries of the core; see catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.functions import kernels as K
from transquill.functions import text as X
from transquill.functions.arrow import map_documents
from transquill.operators import captions as C
from transquill.operators import quality as Q
from transquill.operators import relational as R
from transquill.operators import search as S
from transquill.operators import states as T
from transquill.operators import ordered as O
from transquill.plans.catalog import ATT, CUR, REPEATS, TXT, attempts, current, query, searched, table, texts, texts_of


def signals(spark: SparkSession, d: str, plain: bool = False) -> DataFrame:
    """Repetition signals with markers, artifacts and duration of each video's latest version; texts are measured where they are read.

    plain: without the signs of markup, as SQL can't undo entities; all texts take part all the same.
    """
    t = texts(spark, d)
    return C.quality_signals(t.withColumn("transcript", F.translate("transcript", "<&", "  ")) if plain else t).dropDuplicates(["id"]).join(current(spark, d).where("has_text").select("id", "title", "youtube_id", "channel_id", "duration"), "id")


#: The same as SQL, of plain texts: (id, words, alerts, covered, markers, artifacts).
SIGNALS = f"{CUR}, {REPEATS}, sig AS (SELECT r.id, r.words, r.alerts, r.covered, r.long_alerts, r.longest, m.markers, m.artifacts FROM r JOIN (SELECT id, CAST(" + " + ".join(f"len(regexp_extract_all(t, '{p}'))" for p in X.PLAIN_MARKERS.values()) + f" AS INTEGER) AS markers, CAST(len(regexp_extract_all(t, '{X.CORRUPTION}')) AS INTEGER) AS artifacts FROM s) m USING (id) JOIN cur USING (id) WHERE {TXT})"
STATUS = "CASE WHEN markers > 0 THEN 'technical_issue' WHEN alerts > 0 THEN 'repetition_review' ELSE 'no_heuristic_alert' END"


# ---- sources, filters


PROBED = "(status IS NULL OR status IN ('PENDING', 'NO_SUBS', 'RETRY_429', 'MISSING'))"


@query(f"WITH {CUR}, p AS (SELECT id FROM cur WHERE {PROBED} ORDER BY id LIMIT 500), a AS (SELECT id FROM (SELECT id, CASE WHEN {PROBED} AND status = 'NO_SUBS' THEN 'DIAG_NO_SUBS' ELSE status END AS status FROM cur) WHERE status = 'DIAG_NO_SUBS' ORDER BY id LIMIT 50) SELECT 'probe' AS part, id FROM p UNION ALL SELECT 'audio', id FROM a")
def flt07_probe_set(spark, d):
    """The videos to probe, and of those that a probe found without subtitles the ones for audio."""
    v = current(spark, d).select("id", "status")
    wanted = F.col("status").isNull() | F.col("status").isin("PENDING", "NO_SUBS", "RETRY_429", "MISSING")
    probe = v.where(wanted).orderBy("id").limit(500)
    audio = v.withColumn("status", F.when(F.col("status") == "NO_SUBS", "DIAG_NO_SUBS").otherwise(F.col("status"))).where("status = 'DIAG_NO_SUBS'").orderBy("id").limit(50)
    return probe.select(F.lit("probe").alias("part"), "id").unionAll(audio.select(F.lit("audio").alias("part"), "id"))


@query("SELECT DISTINCT id, transcript FROM videos WHERE youtube_id = (SELECT min(youtube_id) FROM videos) AND transcript IS NOT NULL")
def flt11_point_lookup(spark, d):
    """One transcript by its id; the id is validated, and the filter reaches the scan."""
    v = table(spark, d, "videos")
    first = v.agg(F.min("youtube_id")).first()[0]
    return T.point_lookup(v, first) if first is not None else v.select("id", "transcript").where("false")


@query(f"WITH {CUR} SELECT id FROM cur WHERE id > 100 ORDER BY id LIMIT 100")
def flt12_next_page(spark, d):
    return table(spark, d, "videos").where("id > 100").select("id").distinct().orderBy("id").limit(100)


@query(f"WITH {ATT} SELECT youtube_id, CASE WHEN regexp_matches(last_error, '(?i)429|Too Many Requests') THEN 'RETRY_429' WHEN regexp_matches(last_error, '(?i)Premium|copyright|Music|protected') THEN 'PREMIUM' WHEN regexp_matches(last_error, '(?i)available|subtitles') THEN 'NO_SUBS' ELSE 'ERR_DL_FAIL' END AS verdict FROM att WHERE last_error IS NOT NULL")
def flt22_failure_text(spark, d):
    """The status that a failed download's text gives; the first rule that holds."""
    return attempts(spark, d).where("last_error is not null").select("youtube_id", T.failure_status(F.col("last_error")).alias("verdict"))


# ---- joins


@query(f"WITH {CUR}, k AS (SELECT id, lower(trim(title)) AS t FROM cur WHERE title IS NOT NULL), u AS (SELECT t, min(id) AS only_id FROM k GROUP BY 1 HAVING count(*) = 1) SELECT k.id, u.only_id FROM k JOIN u USING (t)")
def jon12_unique_title(spark, d):
    k = current(spark, d).where("title is not null").select("id", F.lower(F.trim("title")).alias("t"))
    only = k.groupBy("t").agg(F.min("id").alias("only_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    return k.join(only, "t").select("id", "only_id")


@query(r"""SELECT youtube_id, raw_path FROM (SELECT *, row_number() OVER (PARTITION BY youtube_id ORDER BY CASE WHEN raw_path LIKE '%.orig.%' THEN 0 WHEN raw_path LIKE '%.cap.%' THEN 1 ELSE 2 END, CASE WHEN regexp_matches(raw_path, '\.(?:vtt|srt)$') THEN 0 ELSE 1 END, raw_path) AS rn FROM
(SELECT DISTINCT raw_path, nullif(regexp_extract(raw_path, '(?:^|[/\\])([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9-]+)*$', 1), '') AS youtube_id FROM raw_captions) WHERE youtube_id IS NOT NULL) WHERE rn = 1""")
def jon13_best_source(spark, d):
    p = F.col("raw_path")
    files = table(spark, d, "raw_captions").select("raw_path", C.video_id(p).alias("youtube_id")).where("youtube_id is not null").distinct()
    order = F.struct(F.when(p.contains(".orig."), 0).when(p.contains(".cap."), 1).otherwise(2), F.when(p.rlike(r"\.(?:vtt|srt)$"), 0).otherwise(1), p)
    return files.groupBy("youtube_id").agg(F.min_by("raw_path", order).alias("raw_path"))


@query(f"WITH {CUR}, " + r"""s AS (SELECT id, channel_id, regexp_extract_all(translate(lower(concat_ws(' ', coalesce(title, ''), coalesce(transcript, ''))), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\p{L}\p{N}\p{M}_’''-]+') AS t FROM cur)
SELECT c.prefix, s.id FROM s JOIN channels c ON c.id = s.channel_id WHERE len(list_filter(t, lambda x: starts_with(x, 'forest') OR starts_with(x, 'foret'))) > 0""")
def jon05_search_channels(spark, d):
    """Two searches in one scan."""
    hits = S.match(searched(spark, d, "forest", "forêt"), "forest", "forêt").where(S.every("forest") | S.every("forêt"))
    return hits.join(table(spark, d, "channels").select(F.col("id").alias("channel_id"), "prefix"), "channel_id").select("prefix", "id")


# ---- aggregates, ordered operators


@query(f"WITH {CUR}, k AS (SELECT * FROM cur WHERE {TXT} AND NOT EXISTS (SELECT 1 FROM pipeline_transcripts p WHERE p.youtube_id = cur.youtube_id AND p.sha256 = sha256(cur.transcript))) SELECT channel_id, count(*) AS videos, CAST(sum(length(transcript) - length(replace(transcript, ' ', '')) + 1) AS BIGINT) AS words FROM k GROUP BY 1")
def agg05_adjusted(spark, d):
    out = table(spark, d, "pipeline_transcripts").select("youtube_id", F.col("sha256").alias("transcript_sha256"))
    kept = R.excluded(current(spark, d).where(F.col("has_text")), out)
    return kept.groupBy("channel_id").agg(F.count("*").alias("videos"), F.sum("blank_words").alias("words"))


@query(f"WITH {CUR}, s AS (SELECT channel_id, coalesce(CAST(sum(CAST(duration AS DECIMAL(18,3))) AS DOUBLE) / 3600.0, 0) AS h, sum(length(transcript) - length(replace(transcript, ' ', '')) + 1) AS w FROM cur WHERE {TXT} GROUP BY 1) SELECT channel_id, CASE WHEN h < 1 AND w > 0 THEN round_even(w / 9000.0, 0)::DOUBLE ELSE floor(h * 1000) / 1000 END AS hours FROM s")
def agg06_hours_fallback(spark, d):
    s = current(spark, d).where(F.col("has_text")).groupBy("channel_id").agg(F.coalesce(F.sum(F.col("duration").cast("decimal(18,3)")).cast("double") / 3600.0, F.lit(0.0)).alias("h"), F.sum("blank_words").alias("w"))
    return s.select("channel_id", F.when((F.col("h") < 1) & (F.col("w") > 0), F.bround(F.col("w") / 9000.0, 0)).otherwise(F.floor(F.col("h") * 1000) / 1000).cast("double").alias("hours"))


@query(f"WITH {CUR}, c AS (SELECT CASE WHEN s = 'NO_SUBS' THEN 'no_subtitles_reported' WHEN s LIKE 'ERR_NO_EN_FR%' THEN 'no_fr_en_subtitles_reported' WHEN s LIKE 'ERR_TOO_SHORT%' THEN 'caption_content_to_review' WHEN s = 'PREMIUM' THEN 'restricted_access' WHEN contains(s, '429') THEN 'rate_limited' WHEN s LIKE 'ERR_DL_FAIL%' THEN 'download_failed' ELSE 'not_yet_verified' END AS category FROM (SELECT coalesce(nullif(status, ''), 'PENDING') AS s FROM cur WHERE NOT ({TXT}))) SELECT category, count(*) AS n FROM c GROUP BY 1")
def agg08_category_counts(spark, d):
    return R.follow_up(current(spark, d)).groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT language, min(source) AS source, count(*) AS n FROM pipeline_transcripts WHERE language IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) = 1")
def agg11_unambiguous_map(spark, d):
    """Keys with one target only; conflicting ones fall away."""
    t = table(spark, d, "pipeline_transcripts").where("language is not null")
    return t.groupBy("language").agg(F.min("source").alias("source"), F.count("*").alias("n"), F.count_distinct("source").alias("k")).where("k = 1").drop("k")


@query(r"""WITH m AS (SELECT DISTINCT youtube_id, replace(raw_path, '\', '/') AS path FROM pipeline_transcripts WHERE raw_path IS NOT NULL AND youtube_id IS NOT NULL), f AS (SELECT youtube_id, regexp_replace(path, '\.[a-z0-9]+$', CASE WHEN hash_no % 3 = 0 THEN '.m4a' WHEN hash_no % 3 = 1 THEN '.mp4' ELSE '.opus' END) AS path, length(path) * 1000 + hash_no % 7 AS bytes FROM (SELECT *, ascii(substr(youtube_id, 2, 1)) + ascii(substr(youtube_id, 5, 1)) AS hash_no FROM m))
SELECT youtube_id, path FROM (SELECT *, row_number() OVER (PARTITION BY youtube_id ORDER BY CASE WHEN regexp_matches(path, '\.(?:m4a|mp3|opus|wav|ogg|flac|aac)$') THEN 0 ELSE 1 END, bytes, path) AS rn FROM f) WHERE rn = 1""")
def win11_best_media(spark, d):
    """Of each video's media files the best for speech: audio first, then the smallest."""
    m = table(spark, d, "pipeline_transcripts").where("raw_path is not null and youtube_id is not null").select("youtube_id", F.translate("raw_path", "\\", "/").alias("path")).distinct()
    no = F.ascii(F.substring("youtube_id", 2, 1)) + F.ascii(F.substring("youtube_id", 5, 1))
    ending = F.when(no % 3 == 0, ".m4a").when(no % 3 == 1, ".mp4").otherwise(".opus")
    files = m.select("youtube_id", F.regexp_replace("path", F.lit(r"\.[a-z0-9]+$"), ending).alias("path"), (F.length("path") * 1000 + no % 7).alias("bytes"))
    return T.best_media(files, "youtube_id", "path", "bytes").select("youtube_id", "path")


@query(r"SELECT youtube_id, raw_path FROM (SELECT raw_path, youtube_id, row_number() OVER (PARTITION BY youtube_id ORDER BY CASE WHEN contains(raw_path, youtube_id) THEN 0 ELSE 1 END, raw_path) AS rn FROM (SELECT DISTINCT youtube_id, raw_path FROM pipeline_transcripts WHERE raw_path IS NOT NULL AND youtube_id IS NOT NULL)) WHERE rn = 1")
def win08_sidecars(spark, d):
    t = table(spark, d, "pipeline_transcripts").where("raw_path is not null and youtube_id is not null").select("youtube_id", "raw_path").distinct()
    return t.groupBy("youtube_id").agg(F.min_by("raw_path", F.struct(F.when(F.col("raw_path").contains(F.col("youtube_id")), 0).otherwise(1), "raw_path")).alias("raw_path"))


@query(f"WITH {CUR}, q AS (SELECT id, upload_date, row_number() OVER (ORDER BY id) AS pos FROM cur WHERE NOT ({TXT})) SELECT id, row_number() OVER (ORDER BY CASE WHEN pos <= 10 THEN pos END NULLS LAST, upload_date DESC NULLS LAST, id DESC) AS place FROM q")
def win10_queue_tail(spark, d):
    """The first ten stay where they are; the rest is sorted anew. Places come from sorted ranges that are written once."""
    q = current(spark, d).where(R.no_text()).select("id", "upload_date")
    head = [r["id"] for r in q.select("id").orderBy("id").limit(10).collect()]
    at = F.nullif(F.array_position(F.array(*(F.lit(i) for i in head)) if head else F.array().cast("array<bigint>"), F.col("id")), F.lit(0))
    return O.ranks(q.withColumn("at", at), [F.col("at").asc_nulls_last(), F.col("upload_date").desc_nulls_last(), F.col("id").desc()], "place").select("id", "place")


@query(rf"""WITH RECURSIVE {CUR}, v AS (SELECT channel_id, id, CAST(len(list_filter(string_split_regex(transcript, '[ \t\n\r\f]+'), lambda x: x <> '')) AS BIGINT) AS w, CAST(length(coalesce(title, '')) - length(replace(coalesce(title, ''), ' ', '')) + 6 AS BIGINT) AS h, row_number() OVER (PARTITION BY channel_id ORDER BY upload_date NULLS FIRST, id) AS rn FROM cur WHERE {TXT} AND channel_id IS NOT NULL),
f AS (SELECT channel_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS id, CAST(0 AS BIGINT) AS remains, CAST(0 AS BIGINT) AS fill, CAST(1 AS BIGINT) AS pack, CAST(0 AS BIGINT) AS taken FROM v WHERE rn = 1 UNION ALL
SELECT channel_id, rn, id, todo - t, CASE WHEN todo = 0 THEN fill ELSE base + h + t END, CASE WHEN todo > 0 AND fill + h >= 2000 THEN pack + 1 ELSE pack END, t FROM (SELECT *, least(2000 - base - h, todo) AS t FROM (SELECT f.channel_id, v.rn, v.id, v.h, f.fill, f.pack, CASE WHEN f.remains > 0 THEN f.remains ELSE v.w END AS todo, CASE WHEN f.fill + v.h >= 2000 THEN 0 ELSE f.fill END AS base FROM f JOIN v ON v.channel_id = f.channel_id AND v.rn = CASE WHEN f.remains > 0 THEN f.rn ELSE f.rn + 1 END)))
SELECT channel_id, pack, id, taken AS words FROM f WHERE taken > 0""")
def win06_split_packs(spark, d):
    """Packs of at most 2,000 words in which long texts are cut, each piece with its header of the title's words and five more."""
    v = current(spark, d).where(F.col("has_text") & F.col("channel_id").isNotNull()).select("channel_id", "upload_date", "id", (X.word_count_spaces(F.coalesce("title", F.lit(""))) + 5).alias("h"), F.col("space_words").alias("w"))
    return O.split_packs(v, "channel_id", ["upload_date", "id"], "id", "h", "w", 2000)


@query(f"WITH {CUR} SELECT id, row_number() OVER (ORDER BY upload_date NULLS FIRST, id) AS place FROM cur WHERE {TXT}")
def top10_pack_order(spark, d):
    """The order in which all texts go into packs."""
    v = current(spark, d).where(F.col("has_text")).select("id", "upload_date")
    return O.ranks(v, [F.col("upload_date").asc_nulls_first(), F.col("id")], "place").select("id", "place")


@query("SELECT folder, files FROM (SELECT regexp_extract(replace(raw_path, '\\', '/'), '^(?:[^/]*/){2}([^/]*)', 1) AS folder, count(DISTINCT raw_path) AS files FROM raw_captions GROUP BY 1) ORDER BY files DESC, folder LIMIT 35")
def top06_largest_folders(spark, d):
    f = table(spark, d, "raw_captions").select("raw_path").distinct().groupBy(F.regexp_extract(F.translate("raw_path", "\\", "/"), r"^(?:[^/]*/){2}([^/]*)", 1).alias("folder")).agg(F.count("*").alias("files"))
    return f.orderBy(F.col("files").desc(), "folder").limit(35)


@query(f"WITH s AS (SELECT DISTINCT id, transcript FROM videos WHERE {TXT}) SELECT id, CAST(len(list_distinct(regexp_extract_all(lower(transcript), '[\\p{{L}}\\p{{N}}\\p{{M}}_’''-]+'))) AS INTEGER) AS vocabulary, CAST(len(list_intersect(list_distinct(regexp_extract_all(lower(transcript), '[\\p{{L}}\\p{{N}}\\p{{M}}_’''-]+')), ['the', 'of', 'une', 'der', 'de', 'la'])) AS INTEGER) AS shared FROM s")
def set01_vocabulary(spark, d):
    words = F.array_distinct(X.tokens(F.col("transcript")))
    common = F.array(*(F.lit(w) for w in ("the", "of", "une", "der", "de", "la")))
    return texts(spark, d).select("id", words.alias("w")).select("id", F.size("w").alias("vocabulary"), F.size(F.array_intersect("w", common)).alias("shared")).distinct()


# ---- text


@query()
def txt01_strip_markup(spark, d):
    rows = table(spark, d, "raw_captions").where(F.col("raw_text").rlike("[<&]")).select("raw_path", "raw_text").dropDuplicates(["raw_path"])
    return map_documents(rows, ["raw_path", "raw_text"], lambda p, t: [(p, K.strip_markup(t))], "raw_path string, text string").select("raw_path", F.sha2("text", 256).alias("text_sha"))


@query()
def txt03_rendered_triples(spark, d):
    """Captions rendered three times over, as a faulty export would, and brought back."""
    cues = C.cue_rows(table(spark, d, "raw_captions")).where(F.size("lines") > 0)
    line = F.array_join(F.transform("lines", lambda x: x["text"]), " ")
    three = cues.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("t")))), lambda x: F.concat(F.lit("<00:00:01.000>"), x["t"], F.lit("\n\n"), x["t"], F.lit("\n\n"), x["t"])), "\n\n").alias("raw"), F.count("*").alias("n")).where("n >= 2")
    return map_documents(three, ["path", "raw"], lambda p, t: [(p, *K.rendered_triples(t))], "path string, text string, removed int").select("path", "removed", F.sha2("text", 256).alias("text_sha"))


@query(r"SELECT DISTINCT raw_path, sha256(regexp_replace(raw_text, '^WEBVTT[ \t]*\n(?:(?:Kind|Language):[^\n]*\n)*', '')) AS text_sha FROM raw_captions WHERE regexp_matches(raw_path, '\.(?:vtt|srt)$')")
def txt04_without_header(spark, d):
    t = F.regexp_replace("raw_text", r"^WEBVTT[ \t]*\n(?:(?:Kind|Language):[^\n]*\n)*", "")
    return table(spark, d, "raw_captions").where(F.col("raw_path").rlike(r"\.(?:vtt|srt)$")).select("raw_path", F.sha2(t, 256).alias("text_sha")).distinct()


#: Letters of ASCII and Latin-1, to which SQL's folding is equal.
WESTERN = "regexp_replace({}, '[^\\x00-\\x7fÀ-ÖØ-öø-ÿ]', '', 'g')"


@query("SELECT DISTINCT id, trim(regexp_replace(replace(strip_accents(lower(regexp_replace(regexp_replace(regexp_replace(" + WESTERN.format("title") + ", '(?:\\.(?:[a-z]{2}(?:-[A-Za-z]+)?|orig|auto|f[0-9]+|vtt|srt|txt|json|info|gz|mp4|m4a|webm))+$', ''), '\\s*\\[[A-Za-z0-9_-]{11}\\]\\s*$', ''), '^[0-9]{8}\\s*-\\s*', ''))), 'ß', 'ss'), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS title_key FROM videos WHERE title IS NOT NULL")
def txt10_title_keys(spark, d):
    """Keys of all titles, of their western letters."""
    rows = table(spark, d, "videos").where("title is not null").select("id", F.regexp_replace("title", r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]", "").alias("title")).distinct()
    return map_documents(rows, ["id", "title"], lambda i, t: [(i, K.title_key(t))], "id bigint, title_key string").distinct()


@query("SELECT DISTINCT id, translate(title, '’‘“”', '''''\"\"') AS title FROM videos WHERE title IS NOT NULL")
def txt14_quotes(spark, d):
    return table(spark, d, "videos").where("title is not null").select("id", F.translate("title", "’‘“”", "''\"\"").alias("title")).distinct()


@query("WITH s AS (SELECT DISTINCT id, regexp_extract_all(replace(lower(" + WESTERN.format("replace(transcript, '’', chr(39))") + "), 'ß', 'ss'), '[0-9]+(?:[.,][0-9]+)*|[\\p{L}\\p{N}_''-]+') AS l FROM videos WHERE " + TXT + "), k AS (SELECT id, list_transform(list_filter(list_zip(l, list_concat([NULL], l[:-2])), lambda p: p[1] IS DISTINCT FROM p[2]), lambda p: p[1]) AS w FROM s) SELECT id, CAST(len(w) AS INTEGER) AS words, CAST(len(list_distinct(w)) AS INTEGER) AS kinds FROM k")
def txt15_canonical_words(spark, d):
    """Canonical words of all texts, of their western letters."""
    western = F.regexp_replace(F.translate("transcript", "’", "'"), r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]", "")
    return map_documents(texts(spark, d).select("id", western.alias("t")), ["id", "t"], lambda i, t: [(i, len(w := K.canonical_words(t)), len(set(w)))], "id bigint, words int, kinds int").distinct()


@query(r"""WITH s AS (SELECT DISTINCT raw_path, raw_text AS t FROM raw_captions WHERE regexp_matches(raw_path, '\.(?:vtt|srt)$')), c AS (SELECT raw_path, regexp_replace(regexp_replace(regexp_replace(t, '<[^>]+>', '', 'g'), '(?m)^(?:WEBVTT|Kind:|Language:)[^\n]*$', '', 'g'), '(?m)^[0-9:.]+ --> [^\n]*$', '', 'g') AS t FROM s),
l AS (SELECT raw_path, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+')) AS l FROM c)
SELECT raw_path, CAST(len(list_distinct(l)) AS INTEGER) AS kept FROM l WHERE length(array_to_string(l, ' ')) > 100""")
def txt17_simple_clean(spark, d):
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw_text", "<[^>]+>", ""), r"(?m)^(?:WEBVTT|Kind:|Language:)[^\n]*$", ""), r"(?m)^[0-9:.]+ --> [^\n]*$", "")
    lines = F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
    rows = table(spark, d, "raw_captions").where(F.col("raw_path").rlike(r"\.(?:vtt|srt)$")).select("raw_path", lines.alias("l"))
    return rows.where(F.length(F.array_join("l", " ")) > 100).select("raw_path", F.size(F.array_distinct("l")).alias("kept")).distinct()


# ---- quality, composed flows


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, {STATUS} AS status FROM sig")
def qua04_status(spark, d):
    s = signals(spark, d, plain=True)
    return s.select("id", Q.status(s["markers"], s["alerts"]).alias("status"))


@query(f"WITH {CUR}, s AS (SELECT id, title, transcript FROM cur WHERE {TXT}), p AS (SELECT id, trim(u) AS sentence FROM s, unnest(string_split_regex(lower(transcript), '[.!?\\n]+')) t(u)), n AS (SELECT id, count(*) * (length(sentence) - length(replace(sentence, ' ', '')) + 1) AS w FROM p WHERE sentence <> '' GROUP BY id, sentence), m AS (SELECT id, CAST(max(w) AS BIGINT) AS dominant FROM n GROUP BY 1) SELECT s.id, CAST(length(transcript) - length(replace(transcript, ' ', '')) + 1 AS INTEGER) AS words, m.dominant, coalesce(regexp_matches(title, '(?i)\\b(?:lofi|music|musique|fireplace|ambient|relaxation)\\b'), false) AS music, coalesce(regexp_matches(title, '(?i)no talking|sans parole'), false) AS silent FROM s JOIN m USING (id)")
def qua08_loops(spark, d):
    loops = Q.loops(table(spark, d, "videos")).distinct().drop("accepted", "times", "share")
    return loops.join(current(spark, d).where("has_text").select("id"), "id", "left_semi")


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, alerts, words FROM sig WHERE artifacts > 0 OR alerts >= 0.01 * words")
def qua13_worth_review(spark, d):
    s = signals(spark, d, plain=True)
    return s.where((F.col("artifacts") > 0) | (F.col("alerts") >= 0.01 * F.col("words"))).select("id", "alerts", "words")


# ---- state


@query("WITH f AS (SELECT max(ts) AS t FROM events WHERE event_type = 'error') SELECT strftime(t + INTERVAL 62 MINUTE, '%Y-%m-%d %H:%M:%S') AS until FROM f")
def str03_pause(spark, d):
    from transquill.streaming import state

    e = table(spark, d, "events").where("event_type = 'error'").withColumn("category", F.lit("http_429"))
    return state.paused_until(e).select(F.date_format("until", "yyyy-MM-dd HH:mm:ss").alias("until"))


@query(f"WITH {ATT} SELECT youtube_id, CASE WHEN regexp_matches(last_error, '(?i)429|too many') THEN 62 WHEN regexp_matches(last_error, '(?i)subtitle|caption|short') THEN 10080 ELSE 1440 END AS wait_minutes FROM att WHERE last_error IS NOT NULL")
def str02_back_off(spark, d):
    e = F.col("last_error")
    wait = F.when(e.rlike("(?i)429|too many"), 62).when(e.rlike("(?i)subtitle|caption|short"), 10080).otherwise(1440)
    return attempts(spark, d).where(e.isNotNull()).select("youtube_id", wait.alias("wait_minutes"))


@query(f"WITH {CUR} SELECT cur.id, p.cleaner_version FROM cur JOIN (SELECT DISTINCT youtube_id, sha256, cleaner_version FROM pipeline_transcripts WHERE sha256 IS NOT NULL) p USING (youtube_id) WHERE {TXT} AND p.sha256 = sha256(cur.transcript) AND p.cleaner_version = 'v16.0'")
def str13_valid_cache(spark, d):
    p = table(spark, d, "pipeline_transcripts").where("sha256 is not null and cleaner_version = 'v16.0'").select("youtube_id", "sha256", "cleaner_version").distinct()
    v = current(spark, d).where(F.col("has_text")).select("id", "youtube_id", F.col("text_sha").alias("sha256"))
    return v.join(p, ["youtube_id", "sha256"]).select("id", "cleaner_version")


# ---- round trips and further flows


@query(f"WITH {CUR} SELECT cur.youtube_id AS url, trim(title) AS title, count(*) AS n FROM cur WHERE {TXT} AND title IS NOT NULL AND trim(title) <> '' AND NOT contains(title, chr(10)) AND length(trim(transcript)) >= 100 AND NOT regexp_matches(transcript, '(?m)^(?:={{4,}}[ \\t]*$|### SOURCE:)') GROUP BY 1, 2")
def src11_pack_round_trip(spark, d):
    """Texts rendered as packs, and read back from them."""
    from transquill.sources.readers import pack_entries

    v = texts_of(spark, d, current(spark, d).where(F.col("has_text") & F.col("title").isNotNull() & (F.trim("title") != "") & ~F.col("title").contains("\n")))
    v = v.where((F.length(F.trim("transcript")) >= 100) & ~F.col("transcript").rlike(r"(?m)^(?:={4,}[ \t]*$|### SOURCE:)"))
    part = F.concat(F.lit("### SOURCE: x\nURL: "), "youtube_id", F.lit("\nTITLE: "), "title", F.lit("\nDATE: "), F.coalesce("upload_date", F.lit("")), F.lit("\n====\nbody\n====\n"), F.trim("transcript"), F.lit("\n"))
    packs = v.groupBy("channel_id", F.pmod(F.xxhash64("id"), F.lit(256)).alias("part")).agg(F.array_join(F.collect_list(part), "").alias("value"))
    return pack_entries(packs).groupBy("url", "title").agg(F.count("*").alias("n"))


@query(f"WITH {CUR} SELECT youtube_id AS id, title, duration FROM cur WHERE regexp_matches(youtube_id, '^[A-Za-z0-9_-]{{11}}$') AND title IS NOT NULL")
def src15_metadata(spark, d):
    """Metadata as JSON with keys that must not come through, read with the allowed ones only."""
    from transquill.sources.readers import metadata

    v = current(spark, d).where("title is not null").select(F.to_json(F.struct(F.col("youtube_id").alias("id"), "title", "duration", F.lit("secret").alias("token"))).alias("value"))
    return metadata(v).select("id", "title", "duration")


@query(f"WITH RECURSIVE {SIGNALS} SELECT id, artifacts, round(covered / greatest(words, 1)::DOUBLE, 6) AS share FROM sig WHERE alerts > 0 OR artifacts > 0 ORDER BY artifacts DESC, covered / greatest(words, 1)::DOUBLE DESC, id LIMIT 30")
def top05_triage_priority(spark, d):
    s = signals(spark, d, plain=True)
    share = Q.share(s)
    return s.where((F.col("alerts") > 0) | (F.col("artifacts") > 0)).orderBy(F.col("artifacts").desc(), share.desc(), "id").limit(30).select("id", "artifacts", F.round(share, 6).alias("share"))


