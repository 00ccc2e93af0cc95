from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from transquill.functions import text as X
from transquill.operators import captions as C
from transquill.operators import flows as W
from transquill.operators import ordered as O
from transquill.operators import relational as R
from transquill.operators import search as S
from transquill.operators import sinks
from transquill.operators import states as T
from transquill.operators.ledger import Ledger
from transquill.sources import readers
from transquill.streaming import state


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def vtt(*cues):
    return "WEBVTT\n\n" + "\n\n".join(f"{a} --> {b}\n{t}" for a, b, t in cues)


ROLLING = vtt(
    ("00:00:01.000", "00:00:02.000", "hello<00:00:01.500><c> there</c>"), ("00:00:02.000", "00:00:02.010", "hello there"), ("00:00:02.010", "00:00:03.000", "hello there\nhow<00:00:02.500><c> are</c>"),
    ("00:00:03.000", "00:00:03.010", "how are"), ("00:00:03.010", "00:00:04.000", "how are\nyou<00:00:03.500><c> now</c>"),
)


def test_spoken_text_of_caption_files(spark):
    overlap = vtt(("00:00:01.000", "00:00:04.000", "one two three"), ("00:00:03.000", "00:00:06.000", "two three four"), ("00:00:07.000", "00:00:08.000", "four &amp; five"))
    numbered = "1\n00:00:01,000 --> 00:00:02,000\na\n\n2\n00:00:03,000 --> 00:00:04,000\nb\n\n3\n00:00:05,000 --> 00:00:06,000\n7\n"
    once = vtt(("00:00:01.000", "00:00:02.000", "hello<00:00:01.500><c> there</c>"), ("00:00:02.000", "00:00:03.000", "hello there\nhow are"))
    back = vtt(("00:00:05.000", "00:00:06.000", "later"), ("00:00:01.000", "00:00:02.000", "earlier"))
    df = spark.createDataFrame([("o", overlap), ("n", numbered), ("r", ROLLING), ("r", ROLLING), ("once", once), ("back", back), ("empty", ""), ("null", None), ("none", "no cues here"), ("mute", "00:00:01.000 --> 00:00:02.000\n")], "raw_path string, raw_text string").withColumn("path", F.lit("clash"))
    got = {r["path"]: (r["text"], r["removed"]) for r in C.spoken_files(df).collect()}
    assert got == {"o": ("one two three four four & five", 0), "n": ("a b 7", 0), "r": ("hello there how are you now", 4), "once": ("hello there hello there how are", 0), "back": ("later earlier", 0), "mute": ("", 0)}


def latest_of(spark, rows):
    return R.latest(spark.createDataFrame(rows, "id bigint, channel_id int, youtube_id string, title string, transcript string, status string, upload_date string, duration double, last_updated timestamp"))


def test_latest_versions_carry_no_text(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, 1, "a", "t", "some words", "SUCCESS", "20240101", 1.0, old), (1, 1, "a", "t", None, "PENDING", "20240101", 1.0, new), (1, 1, "a", "t", None, "PENDING", "20240101", 1.0, new), (2, None, None, None, " ", None, None, None, None), (3, 1, "c", "t", "x  y", "SUCCESS", None, None, old)]
    df = latest_of(spark, rows)
    assert "transcript" not in df.columns
    got = {r["id"]: (r["status"], r["has_text"], r["nonempty"], r["blank_words"], r["space_words"]) for r in df.collect()}
    assert got[1][:4] == ("PENDING", False, False, None) and got[2] == (None, False, True, 2, 0) and got[3] == ("SUCCESS", True, True, 3, 2)
    plan = df.agg(F.count_if("has_text"))._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert shuffled and "sha2" not in plan  # what nobody asks for isn't computed
    assert latest_of(spark, []).count() == 0


def test_compare_and_set_journals_and_reports_conflicts(spark):
    cur = spark.createDataFrame([("a", "old"), ("b", "changed"), ("c", None)], "youtube_id string, transcript string")
    state = cur.select("youtube_id", F.sha2("transcript", 256).alias("text_sha"))
    plan = cur.select("youtube_id", F.sha2(F.lit("old"), 256).alias("before_sha"), F.sha2(F.lit("new"), 256).alias("after_sha"))
    journal, conflicts = R.compare_and_set(state, plan)
    assert [r["youtube_id"] for r in journal.collect()] == ["a"] and sorted(r["youtube_id"] for r in conflicts.collect()) == ["b", "c"]
    candidates = plan.select("youtube_id", "after_sha", F.lit("new").alias("candidate"))
    after = R.applied(cur, journal, candidates)
    assert sorted((r["youtube_id"], r["transcript"] or "") for r in after.collect()) == [("a", "new"), ("b", "changed"), ("c", "")]


def test_plans_applied_twice_write_nothing_twice(spark):
    texts = spark.createDataFrame([("a", "one"), ("b", "two")], "youtube_id string, transcript string")
    plan = texts.select("youtube_id", F.lit("x").alias("category"), F.sha2("transcript", 256).alias("before_sha"), F.upper("transcript").alias("candidate"), F.lit(True).alias("apply")).withColumn("after_sha", F.sha2("candidate", 256))
    edited = texts.withColumn("transcript", F.when(F.col("youtube_id") == "b", "edited").otherwise(F.col("transcript")))
    first = W.apply_plan(edited, plan, "job")
    assert rows(first.texts) == [("a", "ONE"), ("b", "edited")] and first.journal.count() == 1 and first.conflicts.count() == 1
    second = W.apply_plan(first.texts, plan, "job", first.journal)
    assert second.journal.count() == 0 and rows(second.texts) == rows(first.texts)


def test_repairs_that_make_things_worse_are_refused(spark):
    pairs = spark.createDataFrame([("ok", "so we go so we go home", "so we go home"), ("marks", "so we go so we go home", "<00:00:01.000> so"), ("same", "plain words here", "plain words there"), ("empty", "so we go so we go home", " "), ("heal", "caf├® here", "café here")], "youtube_id string, transcript string, candidate string")
    assert sorted(r["youtube_id"] for r in W.repairs(pairs, "x").collect()) == ["heal", "ok"]


def test_triage_and_exclusion_of_loops(spark):
    loop = "The fire burns on and on. " * 120
    t = spark.createDataFrame([("loop", "Relaxation fireplace, no talking", loop), ("talk", "A talk", loop), ("fine", "x", "nothing is said twice here"), ("null", None, None)], "youtube_id string, title string, transcript string")
    x = W.loop_exclusions(t)
    assert [r["youtube_id"] for r in x.collect()] == ["loop"]
    none = t.where("false").select("youtube_id", F.lit("").alias("text_sha"))
    got = {r["youtube_id"]: r["category"] for r in W.residual_triage(t.where("transcript is not null"), x, none).collect()}
    assert got["loop"] == "excluded_non_speech_loop" and got["talk"] == "priority_long_repetitions" and "fine" not in got
    edited = t.withColumn("transcript", F.concat("transcript", F.lit(" edited")))
    assert W.residual_triage(edited.where("transcript is not null"), x, none).where("category = 'excluded_non_speech_loop'").count() == 0


def test_encoding_lessons_need_one_target_in_all_evidence(spark):
    seen = spark.createDataFrame([(f"v{i}", "├®", "é", 5) for i in range(4)] + [("v9", "├®", "e", 1)] + [(f"v{i}", "├¿", "è", 5) for i in range(4)] + [("v1", "├á", "à", 50)], "k string, before string, after string, n int")
    assert [r["before"] for r in C.supported_artifacts(seen, "k").collect()] == ["├¿"]


def test_sync_fills_from_local_captions_only(spark):
    v = latest_of(spark, [(i, 1, f"abcdefghij{i}", "t", None if i else "has text", "PENDING", "20240101", 1.0, None) for i in range(4)])
    channels = spark.createDataFrame([(1, "c")], "id int, prefix string")
    attempts = spark.createDataFrame([("abcdefghij1", 2, "2020-01-01 00:00:00"), ("abcdefghij3", 1, "2099-01-01 00:00:00")], "youtube_id string, attempts int, next_attempt_at string")
    files = spark.createDataFrame([("R/abcdefghij0.vtt", ROLLING), ("R/abcdefghij1.vtt", "00:00:01.000 --> 00:00:02.000\n"), ("R/abcdefghij2.vtt", ROLLING), ("R/abcdefghij3.vtt", ROLLING)], "raw_path string, raw_text string")
    s = W.sync(v, attempts, channels, files, "2026-01-01 00:00:00")
    assert [(r["youtube_id"], r["transcript"]) for r in s.filled.collect()] == [("abcdefghij2", "hello there how are you now")]
    assert [tuple(r) for r in s.failures.collect()] == [("abcdefghij1", 3, "ERR_TOO_SHORT", "2026-01-08 00:00:00")]


def test_ordered_operators_equal_their_definitions_however_ranges_are_cut(spark):
    rng = np.random.default_rng(4)
    data = [(f"g{int(g)}", int(i), int(w), float(t)) for i, (g, w, t) in enumerate(zip(rng.choice([0, 0, 0, 1, 2], 120), rng.integers(0, 30, 120), np.sort(rng.integers(0, 400, 120))))]
    df = spark.createDataFrame(data, "g string, i int, w int, t double")
    packs = {(r["g"], r["i"]): r["pack"] for r in O.packs(df, "g", ["i"], "w", 40, rows=17).collect()}
    starts = {(r["g"], r["i"]): r["start"] for r in O.paced(df, "g", ["t", "i"], "t", 9.0, rows=17).collect()}
    runs = {(r["g"], r["island"]): r["length"] for r in O.runs(df.withColumn("hit", F.col("w") % 3 == 0), "g", ["i"], "hit", rows=17).collect()}
    for g in ("g0", "g1", "g2"):
        fill, pack, last, miss, want = 0, 1, None, 0, {}
        for _, i, w, t in (x for x in data if x[0] == g):
            if fill > 0 and fill + w > 40:
                pack, fill = pack + 1, w
            else:
                fill += w
            assert packs[g, i] == pack
            last = t if last is None else max(t, last + 9.0)
            assert starts[g, i] == last
            miss += w % 3 != 0
            if w % 3 == 0:
                want[miss] = want.get(miss, 0) + 1
        assert {k[1]: v for k, v in runs.items() if k[0] == g} == want
    assert [r["rank"] for r in O.ranks(df, [F.col("w").desc(), F.col("i")], rows=17).orderBy(F.col("w").desc(), "i").collect()] == list(range(1, 121))
    assert O.packs(df.where("false"), "g", ["i"], "w", 40).count() == 0


def test_split_packs_stay_within_the_limit_and_lose_no_word(spark):
    df = spark.createDataFrame([("g", i, 3, n) for i, n in enumerate([5, 50, 0, 12, 7])], "g string, i int, h int, w int")
    got = O.split_packs(df, "g", ["i"], "i", "h", "w", 20).collect()
    fill = {}
    for r in got:
        fill[r["pack"]] = fill.get(r["pack"], 0) + 3 + r["words"]
    assert max(fill.values()) <= 20 and sum(r["words"] for r in got) == 74
    with pytest.raises(Exception, match="fills a pack"):
        O.split_packs(df.withColumn("h", F.lit(20)), "g", ["i"], "i", "h", "w", 20).collect()


def test_work_queue_arguments(spark):
    v = latest_of(spark, [(i, 1 + i % 2, f"abcdefghij{i}", "t", None, "PREMIUM" if i == 3 else "PENDING", f"2024010{i}", 1.0, None) for i in range(1, 6)])
    channels = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prefix string")
    none = spark.createDataFrame([], "youtube_id string, next_attempt_at string")
    ids = lambda **k: [r["id"] for r in R.work_queue(v, none, channels, "2026-01-01 00:00:00", **k).collect()]
    assert ids() == [5, 4, 2, 1] and ids(channel="a") == [4, 2] and ids(ids=none.select("youtube_id")) == [] and ids(limit=1) == [5]
    with pytest.raises(ValueError, match="1 to 500"):
        ids(limit=501)


def test_point_lookup_refuses_what_is_no_id(spark):
    v = spark.createDataFrame([(1, "abcdefghijk", "x")], "id bigint, youtube_id string, transcript string")
    assert T.point_lookup(v, "abcdefghijk").count() == 1
    for bad in ("' or 1=1 --", "", None):
        with pytest.raises(ValueError, match="no video id"):
            T.point_lookup(v, bad)


def test_stages_run_once_and_failures_are_not_noted(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.run("j", "a", lambda: 1) and not ledger.run("j", "a", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ledger.run("j", "b", lambda: 1 / 0)
    assert ledger.run("j", "b", lambda: 2) and ledger.run("other", "a", lambda: 3)


def test_sinks_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("a", "été\n\t\\n x\r\ny"), ("b", ""), ("c", None)], "k string, t string")
    packed = sinks.gzip_archive(df, "k", "t")
    assert rows(sinks.from_archive(packed, "k")) == [("a", "été\n\t\\n x\r\ny"), ("b", "")]
    assert packed.collect() == sinks.gzip_archive(df, "k", "t").collect()
    with pytest.raises(Exception, match="damaged"):
        sinks.from_archive(packed.withColumn("sha", F.lit("0")), "k").collect()
    sinks.write_texts(df.where("t is not null"), "k", "t", str(tmp_path / "texts"))
    assert rows(sinks.read_texts(spark, str(tmp_path / "texts"))) == [("a", "été\n\t\\n x\r\ny"), ("b", "")]
    kept = sinks.snapshot(df, str(tmp_path), "s")
    with pytest.raises(OSError, match="not as it was"):
        sinks.restore_snapshot(spark, str(tmp_path), "s", (kept[0] + 1, kept[1]))
    sinks.publish(df, str(tmp_path), "p1", str(tmp_path / "journal"))
    with pytest.raises(Exception):  # noqa: B017, PT011
        sinks.publish(df.withColumn("x", F.raise_error(F.lit("no")).cast("string")), str(tmp_path), "p2", str(tmp_path / "journal"))
    assert sinks.published(spark, str(tmp_path), str(tmp_path / "journal")).count() == 3


def test_sql_templates_must_be_fixed_selects():
    assert readers.sql_template('$q = @"\nSELECT 1\n"@', "q") == "SELECT 1" and readers.sql_template('$q = "SELECT 2;"', "q") == "SELECT 2"
    for bad in ('$q = "DELETE FROM x"', '$q = "SELECT $y"', '$q = "SELECT 1; DROP TABLE x"', ""):
        with pytest.raises(ValueError, match="no fixed SELECT"):
            readers.sql_template(bad, "q")


def test_exclusion_ends_when_the_text_is_corrected(spark):
    v = spark.createDataFrame([("a", "bad"), ("b", "bad")], "youtube_id string, transcript string")
    x = v.where("youtube_id = 'a'").select("youtube_id", F.sha2("transcript", 256).alias("transcript_sha256"))
    assert [r["youtube_id"] for r in R.excluded(v, x).collect()] == ["b"]
    assert R.excluded(v.withColumn("transcript", F.lit("good")), x).count() == 2


def test_fill_empty_never_overwrites(spark):
    base = spark.createDataFrame([("a", ""), ("b", "kept"), ("c", None)], "k string, t string")
    new = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, t string")
    assert rows(R.fill_empty(base, new, "k", "t").where("t is not null")) == [("a", "x"), ("b", "kept")]


def test_packs_stay_within_the_limit_unless_one_text_is_larger(spark):
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate([3, 4, 5, 12, 1, 9, 2])], "g string, i int, w int")
    got = rows(O.packs(df, "g", ["i"], "w", 10).groupBy("pack").agg(F.sum("w")))
    assert [x[1] for x in got] == [7, 5, 12, 10, 2]


def test_heal_restores_what_was_garbled(spark):
    good = "été à la forêt, ça va où"
    df = spark.createDataFrame([("".join(chr(b) if b < 128 else bytes([b]).decode("cp1252", "ignore") or chr(b) for b in good.encode()),)], "t string")
    assert df.select(X.replaced(F.col("t"), X.HEAL_A)).first()[0] == good


def test_search_ranks_and_snippets(spark):
    v = spark.createDataFrame([(1, "Été", "the telescope is here"), (2, None, "tele " * 3), (3, "x", None)], "id bigint, title string, transcript string")
    assert S.query_terms("Télé-scope, (ET)") == ["telescope", "et"]
    search = lambda q: [r["id"] for r in S.ranked(v.select("id", *(c.alias(n) for n, c in S.measures(q).items())), q).collect()]
    assert search("tele") == [2, 1] and search("ete telescope") == [1] and search("!!") == []
    p = S.postings(v.unionAll(v), v.select("id", X.has_text(F.col("transcript")).alias("has_text")))
    assert {(r["term"], r["id"]): r["n"] for r in p.collect()}["tele", 2] == 3
    assert S.snippet(v, "telescope").first()["snippet"] == "the <b>telescope</b> is here"


def test_video_ids_come_from_names_only(spark):
    df = spark.createDataFrame([("x/My talk [abcdefghijk].fr.vtt",), (r"x\abcdefghijk.vtt",), ("x/an eleven-word talk.vtt",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(C.video_id(F.col("p"))).collect()] == ["abcdefghijk", "abcdefghijk", None, None, None]


def test_readers(spark, tmp_path):
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    assert rows(readers.separated_lines(lines("abcdefghijk[SEP]A title", "bad"))) == [("abcdefghijk", "A title")]
    assert rows(readers.blacklist(lines("abcdefghijk # [LANG] x", "bcdefghijkl # gone away", ""))) == [("abcdefghijk", "LANG"), ("bcdefghijkl", "gone")]
    assert rows(readers.playlist_entries(lines('{"entries":[{"id":"abcdefghijk","title":"t"},{"id":"short"}]}', "{"))) == [("abcdefghijk", "t")]
    log = spark.createDataFrame([("f", 1, "get [abcdefghijk]"), ("f", 2, "HTTP Error 429"), ("g", 1, "HTTP Error 429")], "file string, line_no int, value string")
    assert rows(readers.rate_limited(log)) == [("abcdefghijk",)]
    feed = '<feed xmlns:yt="u"><entry><yt:videoId>abcdefghijk</yt:videoId><title>T</title><published>2024-05-06T01:02</published></entry></feed>'
    assert rows(readers.feed_entries(lines(feed))) == [("abcdefghijk", "T", "20240506")]
    assert rows(readers.json_exports(lines('[{"id":"a","text":"t"}]', '{"data":[{"youtube_id":"b","transcript":"u"}]}', "no"))) == [("a", "t"), ("b", "u")]
    assert readers.top_level_id('{"x": {"id": "no"}, "id": "yes", "formats": [{"url') == "yes"
    assert readers.top_level_id('{"x": {"id": "no"}, "formats": [{"url') is None and readers.top_level_id("") is None
    pack = "head\n### SOURCE: a\nURL: u\nTITLE: t\nDATE: d\n====\nmore\n====\n" + "long text " * 20
    assert [r["url"] for r in readers.pack_entries(lines(pack, "")).collect()] == ["u"]
    (tmp_path / "c.csv").write_text("﻿URL;Prefixe;Langue\nu;p;fr\n", encoding="utf-8")
    assert rows(readers.channels_config(spark, str(tmp_path / "c.csv"))) == [("u", "p", "fr")]
    meta = readers.metadata(lines('{"id":"abcdefghijk","token":"s","subtitles":{"de":[{"ext":"vtt"}]},"automatic_captions":{"fr":[{"ext":"vtt"}]}}'))
    assert rows(readers.caption_choice(meta, ("fr", "de"))) == [("abcdefghijk", "de", "manual")]


def test_generation_is_replaced_only_when_whole(spark, tmp_path):
    path = str(tmp_path / "packs")
    sinks.write_generation(spark.range(3).withColumn("g", F.lit("a")), path, ["g"])
    with pytest.raises(Exception):  # noqa: B017, PT011
        sinks.write_generation(spark.range(3).withColumn("g", F.raise_error(F.lit("no")).cast("string")), path, ["g"])
    assert spark.read.parquet(path).count() == 3
    sinks.write_generation(spark.range(5).withColumn("g", F.lit("a")), path, ["g"])
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(path + ".previous").count() == 3


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "i int, t string")
    assert sinks.snapshot(df, str(tmp_path), "s1") == sinks.manifest(df.orderBy("t", ascending=False))
    names = spark.createDataFrame([(f"s{i}", f"2024-01-0{i}") for i in range(1, 5)], "name string, created_at string")
    assert rows(sinks.expired(names, 3)) == [("s1", "2024-01-01")]


EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def test_streams_equal_batches(spark, tmp_path):
    data = spark.sql("select id as event_id, timestamp'2024-01-01' + make_interval(0,0,0,0,0,0,id * 7) as ts, id % 3 as user_id, case when id % 4 = 0 then 'error' else 'view' end as event_type, cast(id as double) as value, '{}' as props from range(60)")
    data.write.parquet(str(tmp_path / "in"))
    stream = state.read_events(spark, str(tmp_path / "in"))
    state.run_once(state.live_counts(stream), str(tmp_path / "c1"), "live", "complete")
    assert rows(spark.table("live")) == rows(state.live_counts(data))
    state.run_once(state.retries(stream), str(tmp_path / "c2"), "retries", "update")
    want = {r["user_id"]: r["n"] for r in data.where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert {r["user_id"]: r["attempts"] for r in spark.table("retries").collect()} == want
