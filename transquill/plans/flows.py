"""Queries of the sinks, each written and read again, and of the composed flows."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.functions import text as X
from transquill.operators import captions as C
from transquill.operators import flows as W
from transquill.operators import relational as R
from transquill.operators import sinks
from transquill.operators.storage import scratch, stored
from transquill.plans.catalog import ATT, CUR, LETTERS, NOSUBS, NOW, QUEUE, SOUND, TXT, attempts, current, query, table, texts, texts_of
from transquill.plans.more import SIGNALS, STATUS, signals


def local(path: str) -> str:
    """A path for small files that the driver writes."""
    return path.removeprefix("file://").removeprefix("file:")


def latest_texts(spark: SparkSession, d: str) -> DataFrame:
    """(id, youtube_id, title, channel_id, transcript) of latest versions with text."""
    return texts_of(spark, d, current(spark, d).where("has_text").select("id", "youtube_id", "title", "channel_id"))


def files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_captions")


# ---- sinks


@query("SELECT count(prefix) AS channels, coalesce(string_agg(prefix, ',' ORDER BY id), '') AS prefixes FROM channels")
def snk01_json(spark, d):
    """A small file of the channels' names, written at once and read again."""
    names = [r["prefix"] for r in table(spark, d, "channels").where("prefix is not null").select("id", "prefix").orderBy("id", "prefix").collect()]
    path = local(scratch(spark, "json")) + "/channels.json"
    sinks.write_small_json({"prefixes": names}, path)
    back = json.loads(Path(path).read_text(encoding="utf-8"))["prefixes"]
    return spark.createDataFrame([(len(back), ",".join(back))], "channels bigint, prefixes string")


@query(f"WITH {CUR} SELECT (SELECT count(*) FROM cur WHERE transcript IS NOT NULL AND transcript <> '') AS videos, (SELECT count(*) FROM channels) AS health, (SELECT count(*) FROM (SELECT 1 FROM cur JOIN channels c ON c.id = cur.channel_id WHERE transcript IS NOT NULL AND transcript <> '' LIMIT 2000)) AS data, (SELECT count(*) FROM (SELECT 1 FROM cur WHERE status IN ('PENDING', 'MISSING', 'RETRY_429', 'ERR_429_BLOCK', 'ERR_DL_FAIL') LIMIT 200)) AS recovery")
def snk02_dashboard_files(spark, d):
    """The dashboard's three scripts, of bounded size, written and read again."""
    v, c = current(spark, d), table(spark, d, "channels")
    none = v.where("false").select("id")
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  (bounded lists)
    folder = local(scratch(spark, "assets"))
    sinks.write_script(f"{folder}/stats.js", {"GLOBAL_STATS": rows(W.dashboard_totals(v, c, none))[0]})
    sinks.write_script(f"{folder}/data.js", {"GLOBAL_DATA": rows(R.newest(v, table(spark, d, "videos"), c, 2000, 999))})
    sinks.write_script(f"{folder}/health.js", {"HEALTH_DATA": rows(W.health_rows(v, c, none)), "GLOBAL_RECOVERY": rows(R.recovery_list(v, c))})
    read = lambda name, const: json.JSONDecoder().raw_decode(Path(f"{folder}/{name}").read_text(encoding="utf-8").split(f"const {const} = ", 1)[1])[0]
    row = (read("stats.js", "GLOBAL_STATS")["videos"], len(read("health.js", "HEALTH_DATA")), len(read("data.js", "GLOBAL_DATA")), len(read("health.js", "GLOBAL_RECOVERY")))
    return spark.createDataFrame([row], "videos bigint, health bigint, data bigint, recovery bigint")


@query(f"WITH {CUR} SELECT c.prefix AS channel, count(*) AS videos FROM cur JOIN channels c ON c.id = cur.channel_id WHERE {TXT} GROUP BY 1")
def snk03_pack_generation(spark, d):
    """A generation of packs by channel that takes the place of the last one only when it is whole."""
    path = scratch(spark, "packs")
    plan = W.pack_plan(current(spark, d, is_metadata=F.lit(False)), spark.createDataFrame([], "youtube_id string, transcript_sha256 string"), table(spark, d, "channels"), 5000)
    sinks.write_generation(plan.where("false"), path, ["channel"])
    sinks.write_generation(plan, path, ["channel"])
    return spark.read.schema(plan.schema).parquet(path).groupBy("channel").agg(F.count_distinct("id").alias("videos"))


@query(f"SELECT DISTINCT id, sha256(transcript) AS text_sha FROM videos WHERE {TXT}")
def snk04_gzip_archives(spark, d):
    """Every text as an archive that is the same whenever it is made, written, read again and unpacked."""
    path = scratch(spark, "archives")
    sinks.gzip_archive(texts(spark, d), "id", "transcript").dropDuplicates(["id"]).write.parquet(path)
    return sinks.from_archive(spark.read.parquet(path), "id").select("id", F.sha2("text", 256).alias("text_sha"))


@query(f"WITH {CUR} SELECT youtube_id AS key, sha256(transcript) AS text_sha, length(substr(transcript, 1, 2000)) AS snippet FROM cur WHERE {TXT}")
def snk05_text_files(spark, d):
    """All texts as files under their ids, read again; and the length of the snippet that goes into the index."""
    path = scratch(spark, "texts")
    sinks.write_texts(latest_texts(spark, d), "youtube_id", "transcript", path)
    return sinks.read_texts(spark, path).select("key", F.sha2("text", 256).alias("text_sha"), F.length(F.substring("text", 1, 2000)).cast("long").alias("snippet"))


@query(f"WITH {CUR} SELECT c.prefix, count(*) AS n FROM cur JOIN channels c ON c.id = cur.channel_id WHERE NOT ({TXT}) GROUP BY 1")
def snk06_reports(spark, d):
    """A manifest as a ';' table and a report in Markdown, read again from the table."""
    c = table(spark, d, "channels").select(F.col("id").alias("channel_id"), "prefix")
    counts = current(spark, d).where(R.no_text()).groupBy("channel_id").agg(F.count("*").alias("n")).join(c, "channel_id").groupBy("prefix").agg(F.sum("n").alias("n"))
    path = scratch(spark, "report")
    sinks.write_csv_report(counts, path)
    sinks.replace_file(local(path) + ".md", "| channel | videos |\n|---|---:|\n" + "".join(f"| {r['prefix']} | {r['n']} |\n" for r in counts.orderBy("prefix").collect()))
    return spark.read.option("sep", ";").option("header", True).schema("prefix string, n bigint").csv(path)


@query("SELECT count(*) AS n, true AS same, 's1' AS expired FROM (SELECT DISTINCT id, status FROM videos)")
def snk07_snapshots(spark, d):
    """A verified copy of the states, and which of five copies are beyond the newest four."""
    df = table(spark, d, "videos").select("id", "status").distinct()
    folder = scratch(spark, "snapshots")
    n, h = sinks.snapshot(df, folder, "s5")
    names = spark.createDataFrame([(f"s{i}", f"2026-01-0{i}") for i in range(1, 6)], "name string, created_at string")
    gone = ",".join(r["name"] for r in sinks.expired(names, 4).collect())
    return spark.createDataFrame([(n, (n, h) == sinks.manifest(df), gone)], "n bigint, same boolean, expired string")


@query("SELECT DISTINCT youtube_id, attempts FROM pipeline_attempts WHERE youtube_id IS NOT NULL")
def snk08_restore(spark, d):
    """A copy restored after its manifest was computed anew."""
    df = table(spark, d, "pipeline_attempts").where("youtube_id is not null").select("youtube_id", "attempts").distinct()
    folder = scratch(spark, "restore")
    return sinks.restore_snapshot(spark, folder, "copy", sinks.snapshot(df, folder, "copy"))


@query("SELECT DISTINCT raw_path, sha256(raw_text) AS text_sha FROM raw_captions")
def snk09_publish(spark, d):
    """Copies published in two steps; the journal's last entry names them."""
    df = files(spark, d).select("raw_path", F.sha2("raw_text", 256).alias("text_sha")).distinct()
    folder = scratch(spark, "publish")
    sinks.publish(df.where("false"), folder, "first", f"{folder}/journal")
    sinks.publish(df, folder, "second", f"{folder}/journal")
    return sinks.published(spark, folder, f"{folder}/journal")


@query(f"WITH {ATT} SELECT youtube_id, last_error FROM att WHERE last_error IS NOT NULL UNION ALL SELECT youtube_id, 'again \"quoted\", twice' FROM att")
def snk10_sync_log(spark, d):
    """A log in two appends, read again."""
    path, a = scratch(spark, "log"), attempts(spark, d)
    sinks.append_log(a.where("last_error is not null").select("youtube_id", "last_error"), path)
    sinks.append_log(a.select("youtube_id", F.lit('again "quoted", twice').alias("last_error")), path)
    return spark.read.schema("youtube_id string, last_error string").option("escape", '"').csv(path)


# ---- audit, plans, application


@query(f"WITH RECURSIVE {SIGNALS}, k AS (SELECT sig.*, {STATUS} AS status, c.prefix FROM sig JOIN cur USING (id) JOIN channels c ON c.id = cur.channel_id), f AS (SELECT status FROM k WHERE prefix = 'HalmiPauvan' AND status <> 'no_heuristic_alert' ORDER BY CASE WHEN status = 'technical_issue' THEN 0 ELSE 1 END, markers DESC, id LIMIT 5) SELECT 'status' AS what, status AS name, count(*) AS videos FROM k GROUP BY 2 UNION ALL SELECT 'example', status, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'marker', m.name, count(*) FROM s JOIN k USING (id), (VALUES " + ", ".join("('" + n + "', '" + p.replace("'", "''") + "')" for n, p in X.PLAIN_MARKERS.items()) + ") m(name, pattern) WHERE regexp_matches(s.t, m.pattern) GROUP BY 2")
def cmp01_audit(spark, d):
    """Statuses of all texts, and markers, as (what, name, n); examples of one channel."""
    t = latest_texts(spark, d).withColumn("transcript", F.translate("transcript", "<&", "  "))
    a, one = W.audit(t, table(spark, d, "channels")), W.audit(t, table(spark, d, "channels"), channel="HalmiPauvan", examples=5)
    rows = [a.counts.select(F.lit("status").alias("what"), F.col("status").alias("name"), "videos"), a.markers.select(F.lit("marker").alias("what"), F.col("marker").alias("name"), "videos"), one.examples.groupBy(F.lit("example").alias("what"), F.col("status").alias("name")).agg(F.count("*").alias("videos"))]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def headed(spark: SparkSession, d: str) -> DataFrame:
    """(youtube_id, transcript): texts of which every second has a caption header put before it, and every third a sentence said again."""
    t = latest_texts(spark, d)
    head = F.when(F.col("id") % 2 == 0, F.lit("Kind: captions Language: fr\n")).otherwise(F.lit(""))
    again = F.when(F.col("id") % 3 == 0, F.lit(" and so we went home again and so we went home again")).otherwise(F.lit(""))
    return t.select("youtube_id", F.concat(head, "transcript", again).alias("transcript"))


@query()
def cmp02_maintenance_plan(spark, d):
    """What is to be done with each doubtful text: (youtube_id, category, apply)."""
    return W.maintenance_plan(headed(spark, d)).select("youtube_id", "category", "apply")


HEADS = f"WITH {CUR}, t AS (SELECT youtube_id, CASE WHEN id % 2 = 0 THEN 'Kind: captions Language: fr' || chr(10) ELSE '' END || transcript AS transcript FROM cur WHERE {TXT}), p AS (SELECT youtube_id, sha256(transcript) AS before_sha, sha256(transcript || ' checked') AS after_sha, transcript || ' checked' AS candidate FROM t), c AS (SELECT youtube_id, transcript || CASE WHEN right(youtube_id, 1) BETWEEN 'a' AND 'f' THEN ' edited' ELSE '' END AS transcript FROM t)"


@query(f"{HEADS} SELECT c.youtube_id, CASE WHEN right(c.youtube_id, 1) BETWEEN 'a' AND 'f' THEN 'conflict' ELSE 'applied' END AS outcome, sha256(CASE WHEN right(c.youtube_id, 1) BETWEEN 'a' AND 'f' THEN c.transcript ELSE p.candidate END) AS text_sha FROM c JOIN p USING (youtube_id)")
def cmp03_apply_plan(spark, d):
    """A plan for all texts applied to a catalogue of which some were edited since: these are conflicts; applied again, nothing is written twice."""
    t = latest_texts(spark, d).select("youtube_id", F.concat(F.when(F.col("id") % 2 == 0, F.lit("Kind: captions Language: fr\n")).otherwise(F.lit("")), "transcript").alias("transcript"))
    plan = t.select("youtube_id", F.lit("technical_metadata").alias("category"), F.sha2("transcript", 256).alias("before_sha"), F.concat("transcript", F.lit(" checked")).alias("candidate"), F.lit(True).alias("apply")).withColumn("after_sha", F.sha2("candidate", 256))
    now = t.withColumn("transcript", F.concat("transcript", F.when(F.substring("youtube_id", -1, 1).between("a", "f"), F.lit(" edited")).otherwise(F.lit(""))))
    first = W.apply_plan(now, plan, "job")
    second = W.apply_plan(first.texts, plan, "job", first.journal)
    outcome = first.journal.select("youtube_id", F.lit("applied").alias("outcome")).unionAll(first.conflicts.select("youtube_id", F.lit("conflict").alias("outcome"))).unionAll(second.journal.select("youtube_id", F.lit("twice").alias("outcome")))
    return second.texts.select("youtube_id", F.sha2("transcript", 256).alias("text_sha")).join(outcome, "youtube_id")


@query()
def cmp04_triplet_repairs(spark, d):
    """Texts rendered three times with their times, taken back and applied: whether each came out as it was."""
    line = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.array_join(F.slice(X.words(F.col("transcript")), i * 4 + 1, 4), " "))
    base = latest_texts(spark, d).where((F.size(X.words(F.col("transcript"))) >= 40) & ~F.col("transcript").rlike("[<&]")).select("youtube_id", line.alias("l"))
    three = base.select("youtube_id", F.array_join(F.transform("l", lambda x: F.concat(F.lit("<00:00:01.000>"), x, F.lit("\n\n"), x, F.lit("\n\n"), x)), "\n\n").alias("transcript"))
    plan = stored(W.triplet_plan(three))
    done = W.apply_plan(three, plan, "night")
    back = done.texts.select("youtube_id", F.sha2("transcript", 256).alias("sha")).join(base.select("youtube_id", F.sha2(F.array_join("l", " "), 256).alias("want")), "youtube_id")
    return back.join(plan.select("youtube_id", "category", "apply"), "youtube_id").select("youtube_id", "category", "apply", (F.col("sha") == F.col("want")).alias("whole"))


def worn(spark: SparkSession, d: str) -> DataFrame:
    """(youtube_id, transcript): the spoken text of caption files with a sentence said again and garbled letters, as old exports have it."""
    said = C.best_local(files(spark, d)).select("youtube_id", "text")
    bad = X.replaced(F.col("text"), [("é", "├®"), ("è", "├¿"), ("à", "├á")])
    return said.select("youtube_id", F.concat(bad, F.lit(" that is all for now friends that is all for now friends")).alias("transcript"))


@query()
def cmp05_source_repair(spark, d):
    """Worn texts repaired from their timed sources: (youtube_id, category)."""
    return W.source_plan(worn(spark, d), files(spark, d), selective=False).select("youtube_id", "category")


def taught(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, texts): documents garbled once beside their originals, and others garbled without one."""
    docs = table(spark, d, "documents").where(X.has_text(F.col("text")) & ~F.col("text").rlike("�|Ôò|Ôö|û[▓╣┬│]|[┬├]|[─-▟]")).select(F.col("doc_id").cast("string").alias("youtube_id"), F.col("text").alias("after"), (F.col("doc_id") % 2 == 0).alias("known"))
    bad = docs.withColumn("before", X.replaced(F.col("after"), [("é", "├®"), ("è", "├¿"), ("à", "├á"), ("ê", "├¬"), ("ç", "├º")]))
    return bad.where("known").select("youtube_id", "before", "after"), bad.where("not known").select("youtube_id", F.col("before").alias("transcript"), "after")


@query(f"SELECT doc_id::VARCHAR AS youtube_id, 'demonstrated_encoding_restoration' AS category, true AS whole FROM documents WHERE doc_id % 2 = 1 AND {LETTERS} >= 5 AND {SOUND} AND NOT (" + " OR ".join(f"regexp_matches(text, '{p}')" for p in X.PLAIN_MARKERS.values()) + ")")
def cmp06_encoding_repair(spark, d):
    """What garbled pairs teach, applied to other texts: those with enough letters come out as they were."""
    pairs, others = taught(spark, d)
    plan = W.encoding_plan(others.select("youtube_id", "transcript"), pairs)
    return plan.join(others.select("youtube_id", F.sha2("after", 256).alias("want")), "youtube_id").select("youtube_id", "category", (F.col("after_sha") == F.col("want")).alias("whole"))


@query()
def cmp07_full_review(spark, d):
    """Worn texts held against every caption file of their video: the best result of each."""
    said = C.spoken_files(files(spark, d)).where("text <> ''").select(C.video_id(F.col("path")).alias("youtube_id"), F.col("text").alias("candidate"), F.lit(True).alias("timed")).where("youtube_id is not null")
    return W.review(worn(spark, d), said)


@query()
def cmp08_finalize(spark, d):
    """Plans looked at once more: candidates that change numbers or negations are named."""
    plan = W.source_plan(worn(spark, d), files(spark, d), selective=False)
    spoiled = plan.withColumn("candidate", F.when(F.pmod(F.xxhash64("youtube_id"), F.lit(3)) == 0, F.concat("candidate", F.lit(" 42"))).otherwise(F.col("candidate")))
    return W.finalized(spoiled, worn(spark, d)).select("youtube_id", "category", "rejection")


@query()
def cmp09_spoken_plan(spark, d):
    """The plan of spoken de-duplication with a journal of an earlier pass, of which a part is taken over."""
    t = latest_texts(spark, d).select("youtube_id", "transcript")
    none = spark.createDataFrame([], "youtube_id string, transcript_sha256 string")
    empty = spark.createDataFrame([], "youtube_id string, before_sha string, version string, after_sha string")
    first = W.spoken_plan(t, none, empty, "v4")
    journal = first.where(F.pmod(F.xxhash64("youtube_id"), F.lit(2)) == 0).select("youtube_id", "before_sha", F.lit("v4").alias("version"), "after_sha")
    return W.spoken_plan(t, none, journal, "v4").select("youtube_id", "before_sha", "after_sha")


@query()
def cmp10_residual_triage(spark, d):
    """Flagged texts by what they need; loops without speech are excluded by their hash."""
    t = latest_texts(spark, d).select("youtube_id", "title", F.when(F.col("id") % 50 == 0, F.expr("repeat('The fire burns on and on. ', 120)")).otherwise(F.col("transcript")).alias("transcript"))
    t = t.withColumn("title", F.when(F.col("transcript").startswith("The fire burns on"), "Relaxation fireplace, no talking").otherwise(F.col("title")))
    verified = table(spark, d, "pipeline_transcripts").where("sha256 is not null").select("youtube_id", F.col("sha256").alias("text_sha"))
    return W.residual_triage(t, W.loop_exclusions(t), verified)


@query()
def cmp11_archive_matches(spark, d):
    """Texts of videos with media against their caption files."""
    media = table(spark, d, "pipeline_transcripts").where("youtube_id is not null").select("youtube_id").distinct()
    return W.archive_matches(media, latest_texts(spark, d).select("youtube_id", "transcript"), files(spark, d))


@query()
def cmp12_storage_candidates(spark, d):
    """Media whose texts stand without them, as (part, name, bytes)."""
    v = current(spark, d)
    made = v.where("id % 2 = 0").select(F.concat(F.lit("MEDIA/"), (F.col("id") % 7).cast("string"), F.lit("/"), "youtube_id", F.lit(".m4a")).alias("path"), (F.col("id") * 1000).alias("size_bytes"))
    snapshot = v.where("id % 5 <> 0").select("youtube_id", F.col("text_sha").alias("saved_sha"))
    s = W.storage_audit(made, v, snapshot, signals(spark, d))
    return s.candidates.agg(F.lit("eligible").alias("part"), F.lit("media").alias("name"), F.sum("size_bytes").alias("bytes")).unionAll(s.totals.select(F.lit("folder"), "folder", "bytes")).unionAll(s.held.select(F.lit("held"), "reason", "bytes"))


@query(f"WITH {CUR}, {ATT}, q AS (SELECT youtube_id, coalesce(att.attempts, 0) AS attempts, ascii(substr(youtube_id, 3, 1)) % 3 = 0 AS mute FROM cur JOIN channels c ON c.id = cur.channel_id LEFT JOIN att USING (youtube_id) WHERE {QUEUE} ORDER BY upload_date DESC NULLS LAST, cur.id LIMIT 500) SELECT youtube_id, CASE WHEN mute THEN 'ERR_TOO_SHORT' ELSE 'SUCCESS (SYNC)' END AS outcome, CASE WHEN NOT mute THEN sha256('words of ' || youtube_id) END AS text_sha, CASE WHEN mute THEN attempts + 1 END AS attempts FROM q")
def cmp13_sync(spark, d):
    """Queued videos filled from local captions, a third of which say nothing: these count as failures."""
    v = current(spark, d)
    queue = R.work_queue(v, attempts(spark, d), table(spark, d, "channels"), NOW).select("youtube_id")
    mute = F.ascii(F.substring("youtube_id", 3, 1)) % 3 == 0
    raw = F.when(mute, F.lit("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n\n")).otherwise(F.concat(F.lit("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nwords of "), "youtube_id", F.lit("\n")))
    made = queue.select(F.concat(F.lit("R/"), "youtube_id", F.lit(".fr.vtt")).alias("raw_path"), raw.alias("raw_text"))
    s = W.sync(v, attempts(spark, d), table(spark, d, "channels"), made, NOW)
    return s.filled.select("youtube_id", F.col("status").alias("outcome"), "text_sha", F.lit(None).cast("int").alias("attempts")).unionAll(s.failures.select("youtube_id", "last_error", F.lit(None).cast("string"), "attempts"))


@query("WITH e AS (SELECT channel_id, youtube_id FROM videos WHERE youtube_id IS NOT NULL UNION ALL SELECT channel_id, reverse(youtube_id) FROM videos WHERE youtube_id IS NOT NULL), n AS (SELECT youtube_id, min(channel_id) AS channel_id FROM e WHERE regexp_matches(youtube_id, '^[A-Za-z0-9_-]{11}$') AND youtube_id NOT IN (SELECT youtube_id FROM videos WHERE youtube_id IS NOT NULL) GROUP BY 1) SELECT channel_id, count(*) AS inserted FROM n GROUP BY 1")
def cmp14_discover(spark, d):
    """Entries of feeds and playlists, of which half are new."""
    v = table(spark, d, "videos").where("youtube_id is not null").select("channel_id", "youtube_id", "title", "upload_date")
    entries = v.unionAll(v.withColumn("youtube_id", F.reverse("youtube_id")))
    return W.discover(v, entries)[1]


EXCLUDED = f"x AS (SELECT cur.id FROM cur WHERE {TXT} AND EXISTS (SELECT 1 FROM pipeline_transcripts p WHERE p.youtube_id = cur.youtube_id AND p.sha256 = sha256(cur.transcript) AND p.cleaner_version = 'v15.0'))"


def excluded_ids(spark: SparkSession, d: str, v: DataFrame) -> DataFrame:
    p = table(spark, d, "pipeline_transcripts").where("cleaner_version = 'v15.0' and sha256 is not null").select("youtube_id", F.col("sha256").alias("text_sha")).distinct()
    return v.where("has_text").join(p, ["youtube_id", "text_sha"], "left_semi").select("id")


BW = "length(transcript) - length(replace(transcript, ' ', '')) + 1"


@query(f"""WITH {CUR}, {EXCLUDED}, k AS (SELECT * FROM cur WHERE transcript IS NOT NULL AND transcript <> '' AND id NOT IN (SELECT id FROM x)), s AS (SELECT count(*) AS videos, coalesce(CAST(sum(CAST(duration AS DECIMAL(18,3))) AS DOUBLE) / 3600.0, 0) AS h, CAST(coalesce(sum({BW}), 0) AS BIGINT) AS words FROM k)
SELECT s.videos, CASE WHEN h < 1 AND words > 0 THEN round_even(words / 9000.0, 0)::DOUBLE ELSE round(h, 1) END AS hours, s.words, (SELECT count(*) FROM cur WHERE status IN ('MISSING', 'PENDING')) AS missing, (SELECT count(*) FROM cur WHERE status LIKE 'ERR_DL_FAIL%') AS failed, (SELECT count(*) FROM cur WHERE status = 'PREMIUM') AS premium, (SELECT count(*) FROM cur WHERE {NOSUBS}) AS no_subs, (SELECT count(*) FROM x) AS quality_excluded, (SELECT count(*) FROM channels) AS channels FROM s""")
def cmp15_dashboard_totals(spark, d):
    """The dashboard's totals without the excluded texts, in one pass."""
    v = current(spark, d)
    return W.dashboard_totals(v, table(spark, d, "channels"), excluded_ids(spark, d, v))


@query(f"""WITH {CUR}, {EXCLUDED}, g AS (SELECT channel_id, count(*) AS n, sum({BW}) AS w FROM cur WHERE id IN (SELECT id FROM x) GROUP BY 1), h AS (SELECT c.id AS channel_id, c.prefix, count(*) AS total_remote, count(*) FILTER (v.transcript <> '') AS local, coalesce(sum(CASE WHEN v.transcript <> '' THEN length(v.transcript) - length(replace(v.transcript, ' ', '')) + 1 ELSE 0 END), 0) AS words FROM channels c LEFT JOIN cur v ON v.channel_id = c.id GROUP BY 1, 2)
SELECT h.channel_id, prefix, total_remote, h.local - coalesce(g.n, 0) AS total_local, CAST(h.words - coalesce(g.w, 0) AS BIGINT) AS word_count, CAST((h.words - coalesce(g.w, 0) + 199999) // 200000 AS BIGINT) AS est_packs, coalesce(g.n, 0) AS quality_excluded, round((h.local - coalesce(g.n, 0)) / total_remote::DOUBLE * 100, 1)::VARCHAR || '%' AS success_rate FROM h LEFT JOIN g USING (channel_id)""")
def cmp15_dashboard_health(spark, d):
    """The dashboard's rows of channels without the excluded texts."""
    v = current(spark, d)
    return W.health_rows(v, table(spark, d, "channels"), excluded_ids(spark, d, v)).select("channel_id", "prefix", "total_remote", "total_local", "word_count", "est_packs", "quality_excluded", "success_rate")


@query(rf"""WITH RECURSIVE {CUR}, {EXCLUDED}, v AS (SELECT c.prefix AS channel, cur.id, CAST(len(list_filter(string_split_regex(transcript, '[ \t\n\r\f]+'), lambda x: x <> '')) AS BIGINT) AS w, CAST(length(coalesce(title, '')) - length(replace(coalesce(title, ''), ' ', '')) + 6 AS BIGINT) AS h, row_number() OVER (PARTITION BY c.prefix ORDER BY upload_date NULLS FIRST, cur.id) AS rn FROM cur JOIN channels c ON c.id = cur.channel_id WHERE {TXT} AND NOT regexp_matches(transcript, '\A\s*\{{\s*"id"\s*:') AND cur.id NOT IN (SELECT id FROM x)),
f AS (SELECT channel, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS id, CAST(0 AS BIGINT) AS remains, CAST(0 AS BIGINT) AS fill, CAST(1 AS BIGINT) AS pack, CAST(0 AS BIGINT) AS taken FROM v WHERE rn = 1 UNION ALL
SELECT channel, rn, id, todo - t, CASE WHEN todo = 0 THEN fill ELSE base + h + t END, CASE WHEN todo > 0 AND fill + h >= 3000 THEN pack + 1 ELSE pack END, t FROM (SELECT *, least(3000 - base - h, todo) AS t FROM (SELECT f.channel, v.rn, v.id, v.h, f.fill, f.pack, CASE WHEN f.remains > 0 THEN f.remains ELSE v.w END AS todo, CASE WHEN f.fill + v.h >= 3000 THEN 0 ELSE f.fill END AS base FROM f JOIN v ON v.channel = f.channel AND v.rn = CASE WHEN f.remains > 0 THEN f.rn ELSE f.rn + 1 END)))
SELECT channel, pack, string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS videos, CAST(sum(taken) AS BIGINT) AS words FROM f WHERE taken > 0 GROUP BY 1, 2""")
def cmp16_packs(spark, d):
    """The manifest of all packs of 3,000 words: excluded texts and metadata are left out, long texts cut."""
    v = current(spark, d, is_metadata=F.col("transcript").rlike(r'\A\s*\{\s*"id"\s*:'))
    out = table(spark, d, "pipeline_transcripts").where("cleaner_version = 'v15.0' and sha256 is not null").select("youtube_id", F.col("sha256").alias("transcript_sha256"))
    plan = W.pack_plan(v, out, table(spark, d, "channels"), 3000)
    return W.manifest(plan.withColumn("id", F.col("id").cast("string")))


@query(f"WITH {CUR}, k AS (SELECT c.prefix AS channel, cur.youtube_id, cur.id, upload_date, coalesce(nullif(status, ''), 'PENDING') AS s FROM cur JOIN channels c ON c.id = cur.channel_id WHERE NOT ({TXT})), g AS (SELECT *, CASE WHEN s = 'NO_SUBS' THEN 'no_subtitles_reported' WHEN s LIKE 'ERR_NO_EN_FR%' THEN 'no_fr_en_subtitles_reported' WHEN s LIKE 'ERR_TOO_SHORT%' THEN 'caption_content_to_review' WHEN s = 'PREMIUM' THEN 'restricted_access' WHEN contains(s, '429') THEN 'rate_limited' WHEN s LIKE 'ERR_DL_FAIL%' THEN 'download_failed' ELSE 'not_yet_verified' END AS category FROM k) SELECT channel, row_number() OVER (ORDER BY channel, upload_date DESC NULLS LAST, id) AS place, youtube_id, category, CASE WHEN category IN ('no_subtitles_reported', 'no_fr_en_subtitles_reported') THEN 'defer_audio_test' ELSE 'check_subtitles_first' END AS action FROM g")
def cmp17_follow_up(spark, d):
    """Every video without text with its category and what to do, by channel and date."""
    return W.follow_up(current(spark, d), table(spark, d, "channels"))
