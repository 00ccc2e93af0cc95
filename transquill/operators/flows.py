"""Flows composed of the operators: audits, plans of repairs and their application, reviews, acquisition, packs and the dashboard.

A plan is a table (youtube_id, category, before_sha, after_sha, apply, candidate): what a text would become and why. Only
hashes are compared when a plan is applied; a text that has changed since is a conflict and stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transquill.functions import text as X
from transquill.operators import captions as C
from transquill.operators import ordered as O
from transquill.operators import quality as Q
from transquill.operators import relational as R
from transquill.operators import states as T
from transquill.operators.storage import stored

PLAN = ["youtube_id", "category", "before_sha", "after_sha", "apply", "candidate"]
SIGNALS = ("markers", "artifacts", "words", "alerts", "covered", "longest", "long_alerts", "sound_alerts", "filler_alerts")


def sha(c: str) -> Column:
    return F.sha2(c, 256)


def measured(texts: DataFrame, column: str, suffix: str) -> DataFrame:
    """(youtube_id, signals with a suffix) of texts."""
    return C.quality_signals(texts.select("youtube_id", F.col(column).alias("t")), "youtube_id", "t").select("youtube_id", *(F.col(c).alias(f"{c}_{suffix}") for c in SIGNALS))


# ---- audit, plans and their application


@dataclass
class Audit:
    counts: DataFrame
    markers: DataFrame
    flagged: DataFrame
    examples: DataFrame


def audit(texts: DataFrame, channels: DataFrame, channel: str | None = None, examples: int = 6) -> Audit:
    """texts (id, youtube_id, title, channel_id, transcript), each once: statuses, markers, flagged texts, and examples of what to look at first."""
    if not 0 <= examples <= 20:
        raise ValueError("0 to 20 examples")
    c = channels.select(F.col("id").alias("channel_id"), F.col("prefix").alias("channel"))
    t = texts.join(c.where(F.col("channel") == channel) if channel is not None else c, "channel_id")
    s = C.quality_signals(t)
    s = s.withColumn("status", Q.status(s["markers"], s["alerts"]))
    found = F.array_compact(F.array(*(F.when(F.col("transcript").rlike(p), F.lit(n)) for n, p in X.MARKERS.items())))
    flagged = s.where("status <> 'no_heuristic_alert'")
    first = flagged.orderBy(F.col("status") != "technical_issue", F.col("markers").desc(), "id").limit(examples)
    around = F.coalesce(*(F.when(F.col("transcript").rlike(p), F.regexp_extract("transcript", f"(?s).{{0,100}}(?:{p.removeprefix('(?i)').removeprefix('(?U)')}).{{0,100}}", 0)) for n, p in X.MARKERS.items() if "\\A" not in p and "(?<" not in p))
    return Audit(
        s.groupBy("status").agg(F.count("*").alias("videos"), F.sum("alerts").alias("alerts")),
        t.select(F.explode(found).alias("marker")).groupBy("marker").agg(F.count("*").alias("videos")),
        flagged, t.select("id", around.alias("around")).join(F.broadcast(first.select("id", "status", "markers")), "id").select("id", "status", "markers", "around"),
    )


def maintenance_plan(texts: DataFrame) -> DataFrame:
    """PLAN for texts (youtube_id, transcript) with alerts or markers: headers, copies and systematic triples taken away, where nothing gets worse."""
    before = measured(texts, "transcript", "before").where("markers_before > 0 or alerts_before > 0")
    doubtful = texts.join(before, "youtube_id")
    cleaned = C.technical_candidates(doubtful, "youtube_id", "transcript").select("youtube_id", F.col("text").alias("cleaned"))
    once = doubtful.join(cleaned, "youtube_id", "left").withColumn("cleaned", F.coalesce("cleaned", "transcript"))
    triple = C.collapsed_triples(once.where("alerts_before >= 30").select("youtube_id", "cleaned"), True, "youtube_id", "cleaned").select("youtube_id", F.col("text").alias("single"))
    tried = once.join(triple, "youtube_id", "left").withColumn("candidate", F.coalesce("single", "cleaned")).withColumn("changed", F.col("candidate") != F.col("transcript"))
    both = tried.join(measured(tried.where("changed"), "candidate", "after"), "youtube_id", "left")
    c = F.col
    category = T.maintenance_category(c("single").isNotNull(), c("changed"), c("markers_before"), F.lit(0.0), F.lit(0), c("alerts_before"))
    bad = c("changed") & T.rejected(c("words_after").isNull(), c("markers_after"), c("alerts_after"), c("alerts_before"))
    out = both.select("youtube_id", F.when(bad, "candidate_rejected").otherwise(category).alias("category"), (c("changed") & ~bad).alias("apply"), "transcript", "candidate")
    return out.select("youtube_id", "category", sha("transcript").alias("before_sha"), F.when(c("apply"), sha("candidate")).otherwise(sha("transcript")).alias("after_sha"), "apply", F.when(c("apply"), c("candidate")).alias("candidate"))


@dataclass
class Applied:
    texts: DataFrame
    journal: DataFrame
    conflicts: DataFrame


def apply_plan(texts: DataFrame, plan: DataFrame, job: str, revisions: DataFrame | None = None) -> Applied:
    """texts (youtube_id, transcript) after a plan; the journal is what is new beside earlier revisions, so a plan applied again writes nothing twice."""
    wanted = plan.where("apply")
    state = texts.select("youtube_id", sha("transcript").alias("text_sha"))
    open_ = wanted.join(state.select("youtube_id", F.col("text_sha").alias("after_sha")), ["youtube_id", "after_sha"], "left_anti")  # what is done already is no conflict
    journal, conflicts = R.compare_and_set(state, open_)
    journal = journal.select(F.lit(job).alias("job_id"), "youtube_id", "before_sha", "after_sha")
    if revisions is not None:
        journal = journal.join(revisions.select("job_id", "youtube_id", "before_sha"), ["job_id", "youtube_id", "before_sha"], "left_anti")
    return Applied(R.applied(texts, journal, wanted), journal, conflicts)


def triplet_plan(texts: DataFrame) -> DataFrame:
    """PLAN for texts rendered three times with their times: taken back unless markers stay or repetitions grow. Others aren't touched."""
    stamped = texts.where(F.col("transcript").rlike(r"<[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?[.,][0-9]{3}>") | F.col("transcript").rlike(X.MARKERS["inline_timestamp"]))
    once = C.rendered_once(stamped).select("youtube_id", F.col("text").alias("candidate"))
    both = stored(stamped.join(once, "youtube_id").where("candidate <> transcript"))  # only texts that change
    both = both.join(measured(both, "transcript", "before"), "youtube_id").join(measured(both, "candidate", "after"), "youtube_id")
    good = (F.col("markers_after") == 0) & (F.col("alerts_after") <= F.col("alerts_before"))
    category = T.rules((F.col("markers_after") > 0, "residual_technical_markers"), (F.col("alerts_after") > F.col("alerts_before"), "repetition_alert_increase"), otherwise="rendered_triplets")
    return both.select("youtube_id", category.alias("category"), sha("transcript").alias("before_sha"), sha("candidate").alias("after_sha"), good.alias("apply"), "candidate")


def repairs(pairs: DataFrame, category: str) -> DataFrame:
    """PLAN of those of pairs (youtube_id, transcript, candidate) that pass the gate."""
    both = pairs.join(measured(pairs, "transcript", "before"), "youtube_id").join(measured(pairs, "candidate", "after"), "youtube_id")
    ok = T.repair_gate(*(F.col(c) for c in ("markers_after", "artifacts_before", "artifacts_after", "alerts_before", "alerts_after", "words_after")))
    return both.where(ok).select("youtube_id", F.lit(category).alias("category"), sha("transcript").alias("before_sha"), sha("candidate").alias("after_sha"), F.lit(True).alias("apply"), "candidate")


def source_plan(texts: DataFrame, files: DataFrame, selective: bool = True) -> DataFrame:
    """PLAN of doubtful texts: triples of varied texts first, then the best caption file that says the same; texts of few repetitions are passed over."""
    s = measured(texts, "transcript", "now").where("alerts_now > 0 or artifacts_now > 0")
    if selective:
        s = s.where((F.col("artifacts_now") > 0) | (F.col("alerts_now") >= 0.01 * F.col("words_now")))
    doubtful = stored(texts.join(s.select("youtube_id", "alerts_now"), "youtube_id"))  # a small part of all texts, gone through several times
    triple = C.collapsed_triples(doubtful.where("alerts_now >= 20"), False, "youtube_id", "transcript").select("youtube_id", F.col("text").alias("candidate"))
    first = stored(repairs(doubtful.join(triple, "youtube_id").select("youtube_id", "transcript", "candidate"), "short_systemic_triplicates"))
    rest = doubtful.join(first.select("youtube_id"), "youtube_id", "left_anti")
    sourced = stored(rest.join(C.best_local(files).select("youtube_id", F.col("text").alias("candidate")), "youtube_id"))
    same = C.concordant(sourced.select("youtube_id", F.col("transcript").alias("before"), F.col("candidate").alias("after")), "youtube_id").where("same").select("youtube_id")
    second = repairs(sourced.join(same, "youtube_id", "left_semi").select("youtube_id", "transcript", "candidate"), "verified_local_timed_source")
    return first.unionByName(second)


def encoding_plan(texts: DataFrame, pairs: DataFrame, inherited: DataFrame | None = None, deep: bool = False, done: DataFrame | None = None) -> DataFrame:
    """PLAN of garbled texts that pairs (youtube_id, before, after) teach to restore; inherited templates count where nothing contradicts them."""
    learned = C.learned_artifacts(pairs, "youtube_id", deep=deep)
    templates = C.merged_artifacts(inherited, learned) if inherited is not None else learned
    open_ = texts if done is None else texts.join(done.select("youtube_id"), "youtube_id", "left_anti")
    suspect = open_.where(F.col("transcript").rlike(f"{X.CORRUPTION}|[ÃÂûÔ├┬]"))
    back = C.restored(suspect, templates, "youtube_id", "transcript", deep=deep).select("youtube_id", F.col("text").alias("candidate"))
    return repairs(suspect.join(back, "youtube_id").select("youtube_id", "transcript", "candidate"), "demonstrated_deep_encoding_restoration" if deep else "demonstrated_encoding_restoration")


def review(texts: DataFrame, sources: DataFrame) -> DataFrame:
    """(youtube_id, result) of each doubtful text held against all its sources (youtube_id, candidate, timed): the best thing that any of them says."""
    both = texts.join(sources, "youtube_id")
    words = lambda c: F.array_join(X.collapsed(X.tokens(F.translate(c, "’", "'"))), " ")
    squeezed = lambda c: F.array_join(X.words(F.col(c)), " ")
    keyed = both.withColumn("pair", F.concat_ws(" ", "youtube_id", sha("candidate"))).dropDuplicates(["pair"])
    agreed = C.concordant(keyed.select("pair", F.col("transcript").alias("before"), F.col("candidate").alias("after")), "pair").select("pair", "same")
    after = C.quality_signals(keyed.select("pair", "candidate"), "pair", "candidate").select("pair", *(F.col(c).alias(f"{c}_after") for c in ("markers", "artifacts", "alerts", "words")))
    before = C.quality_signals(texts.select("youtube_id", "transcript"), "youtube_id").select("youtube_id", *(F.col(c).alias(f"{c}_before") for c in ("artifacts", "alerts")))
    j = keyed.join(agreed, "pair", "left").join(after, "pair", "left").join(before, "youtube_id")
    garbled = F.col("transcript").rlike(X.CORRUPTION)
    gate = T.repair_gate(*(F.col(c) for c in ("markers_after", "artifacts_before", "artifacts_after", "alerts_before", "alerts_after", "words_after")))
    result = T.rules(
        ((squeezed("transcript") == squeezed("candidate")) & F.col("timed") & ~garbled, "matches_timed_source"), (squeezed("transcript") == squeezed("candidate"), "same_local_text"),
        ((words("transcript") == words("candidate")) & ~garbled, "same_words_formatting_only"), (~F.coalesce("same", F.lit(False)), "source_wording_mismatch"), (gate, "repair_prepared"), otherwise="no_demonstrated_quality_gain",
    )
    order = ["matches_timed_source", "repair_prepared", "same_local_text", "same_words_formatting_only", "no_demonstrated_quality_gain", "source_wording_mismatch"]
    rank = F.array_position(F.array(*(F.lit(x) for x in order)), result)
    return j.select("youtube_id", rank.alias("rank")).groupBy("youtube_id").agg(F.min("rank").alias("r")).select("youtube_id", F.array(*(F.lit(x) for x in order))[(F.col("r") - 1).cast("int")].alias("result"))


def finalized(plan: DataFrame, texts: DataFrame) -> DataFrame:
    """plan with rejection: what a candidate must not do at the last look: bring weak garbling, change numbers, change negations of a sound text."""
    both = plan.join(texts, "youtube_id")
    weak = lambda c: F.regexp_count(c, F.lit(r"Ã[^\x00-\x7f]|Â[^\x00-\x7f]"))
    numbers = lambda c: F.regexp_extract_all(c, F.lit(r"[0-9]+(?:[.,][0-9]+)*"), F.lit(0))
    negations = lambda c: F.filter(X.tokens(F.translate(c, "’", "'")), lambda w: w.isin(*X.NEGATIONS) | w.endswith("n't"))
    sourced = F.col("category").isin("verified_local_timed_source", "verified_local_text_source")
    why = T.rules(
        (F.col("category").isin("short_systemic_triplicates", "completed_systemic_triplicates"), None), (weak("candidate") > weak("transcript"), "source_introduces_weak_encoding_artifacts"), (sourced & (numbers("candidate") != numbers("transcript")), "source_changes_numeric_content"),
        (sourced & ~F.col("transcript").rlike(X.CORRUPTION) & (negations("candidate") != negations("transcript")), "source_changes_negation"),
    )
    return both.select("youtube_id", "category", "before_sha", "after_sha", why.alias("rejection"))


def spoken_plan(texts: DataFrame, exclusions: DataFrame, journal: DataFrame, version: str) -> DataFrame:
    """PLAN of spoken de-duplication of texts that aren't excluded; what a journal (youtube_id, before_sha, version, after_sha) of this version holds is taken from it, and a candidate must not change when tried again."""
    kept = R.excluded(texts, exclusions).select("youtube_id", "transcript", F.col("text_sha").alias("before_sha"))
    known = journal.where(F.col("version") == version).select("youtube_id", "before_sha", F.col("after_sha").alias("known_sha")).dropDuplicates(["youtube_id", "before_sha"])
    fresh = kept.join(known, ["youtube_id", "before_sha"], "left_anti")
    once = stored(C.spoken_once(fresh, "youtube_id", "transcript").select("youtube_id", F.col("text").alias("transcript")))  # only texts that change
    again = C.spoken_once(once, "youtube_id", "transcript").select("youtube_id")
    new = once.join(again, "youtube_id", "left_anti").join(fresh.select("youtube_id", "before_sha"), "youtube_id").select("youtube_id", "before_sha", sha("transcript").alias("after_sha"), F.lit(False).alias("reused"))
    old = kept.join(known, ["youtube_id", "before_sha"]).select("youtube_id", "before_sha", F.col("known_sha").alias("after_sha"), F.lit(True).alias("reused"))
    return new.unionByName(old)


def loop_exclusions(texts: DataFrame) -> DataFrame:
    """(youtube_id, transcript_sha256, reason): loops without speech, excluded by their exact text."""
    loops = Q.loops(texts, "youtube_id").where("accepted").select("youtube_id").distinct()
    return texts.join(loops, "youtube_id", "left_semi").select("youtube_id", sha("transcript").alias("transcript_sha256"), F.lit("non_speech_loop").alias("reason")).distinct()


def residual_triage(texts: DataFrame, exclusions: DataFrame, verified: DataFrame) -> DataFrame:
    """(youtube_id, category, artifacts, share) of texts that are flagged, excluded or garbled; verified: (youtube_id, text_sha) that match a timed source as they are."""
    s = C.quality_signals(texts.select("youtube_id", "transcript"), "youtube_id").join(texts.select("youtube_id", sha("transcript").alias("text_sha")), "youtube_id")
    out = exclusions.select("youtube_id", F.col("transcript_sha256").alias("text_sha"), F.lit(True).alias("out")).distinct()
    ok = verified.select("youtube_id", "text_sha", F.lit(True).alias("ok")).distinct()
    s = s.join(out, ["youtube_id", "text_sha"], "left").join(ok, ["youtube_id", "text_sha"], "left")
    is_out, is_ok = F.coalesce("out", F.lit(False)), F.coalesce("ok", F.lit(False))
    flagged = s.where((F.col("markers") > 0) | (F.col("alerts") > 0) | (F.col("artifacts") > 0) | is_out)
    return flagged.select("youtube_id", Q.triage(flagged, is_out, is_ok).alias("category"), "artifacts", F.round(Q.share(flagged), 6).alias("share"))


def archive_matches(media_ids: DataFrame, texts: DataFrame, files: DataFrame) -> DataFrame:
    """(youtube_id, path, match): of videos with media and text the caption file that is their source: word for word, or the same speech."""
    wanted = texts.join(media_ids, "youtube_id", "left_semi")
    best = C.best_local(files).select("youtube_id", "path", F.col("text").alias("candidate"))
    both = wanted.join(best, "youtube_id")
    canonical = C.canonical(both, "youtube_id", ("transcript", "candidate"))
    same = C.concordant(both.select("youtube_id", F.col("transcript").alias("before"), F.col("candidate").alias("after")), "youtube_id").select("youtube_id", "same")
    j = both.select("youtube_id", "path").join(canonical, "youtube_id").join(same, "youtube_id", "left")
    return j.select("youtube_id", "path", T.rules((F.col("transcript_key") == F.col("candidate_key"), "exact_words"), (F.col("same"), "same_speech"), otherwise="other_text").alias("match"))


@dataclass
class Storage:
    candidates: DataFrame
    totals: DataFrame
    held: DataFrame


def storage_audit(files: DataFrame, latest: DataFrame, snapshot: DataFrame, signals: DataFrame) -> Storage:
    """files (path, size_bytes), latest versions, a snapshot's hashes (youtube_id, saved_sha) and signals: media that may go, sizes by folder, and what holds the others back."""
    f = files.select("path", "size_bytes", T.file_kind(F.col("path")).alias("category"), C.video_id(F.col("path")).alias("youtube_id"))
    v = latest.select("youtube_id", "status", "has_text", "text_sha", "chars")
    verdict = signals.select("youtube_id", Q.retention(signals).alias("verdict"))
    media = f.where("category = 'media'").join(v, "youtube_id", "left").join(snapshot, "youtube_id", "left").join(verdict, "youtube_id", "left")
    reason = T.rules(
        (~F.coalesce("has_text", F.lit(False)), "no_text"), (~F.coalesce(F.col("saved_sha") == F.col("text_sha"), F.lit(False)), "backup_text_mismatch"),
        (F.col("verdict") != "healthy_database_text_and_backup", "quality"), (~T.purge_candidate(F.col("status"), F.col("chars")), "status"), otherwise="eligible",
    )
    judged = media.select("path", "youtube_id", "size_bytes", reason.alias("reason"))
    folder = F.regexp_extract(F.translate("path", "\\", "/"), r"^([^/]*)", 1)
    return Storage(judged.where("reason = 'eligible'").drop("reason"), f.groupBy(folder.alias("folder")).agg(F.sum("size_bytes").alias("bytes")), judged.where("reason <> 'eligible'").groupBy("reason").agg(F.sum("size_bytes").alias("bytes"), F.count("*").alias("files")))


# ---- acquisition


@dataclass
class Synced:
    filled: DataFrame
    provenance: DataFrame
    failures: DataFrame
    cleared: DataFrame


def sync(latest: DataFrame, attempts: DataFrame, channels: DataFrame, files: DataFrame, now: str, limit: int = 500) -> Synced:
    """The part of a synchronisation that needs no network: queued videos get the text of their local captions; a caption without text is a failure with a week's wait."""
    queue = R.work_queue(latest, attempts, channels, now, limit=limit).select("youtube_id")
    cleaned = C.spoken_files(files).select(C.video_id(F.col("path")).alias("youtube_id"), "path", "text")
    best = cleaned.join(F.broadcast(queue), "youtube_id", "left_semi").groupBy("youtube_id").agg(F.min_by(F.struct("path", "text"), F.struct(F.col("text") == "", F.col("path"))).alias("r")).select("youtube_id", "r.*")
    good, empty = best.where("text <> ''"), best.where("text = ''")
    return Synced(
        good.select("youtube_id", F.lit("SUCCESS (SYNC)").alias("status"), sha("text").alias("text_sha"), F.col("text").alias("transcript")),
        good.select("youtube_id", F.lit("cached-captions").alias("source"), F.col("path").alias("raw_path"), F.lit(now).alias("acquired_at")),
        failures(attempts, empty.select("youtube_id", F.lit("ERR_TOO_SHORT").alias("error"), F.lit(168.0).alias("hours")), now),
        attempts.join(good.select("youtube_id"), "youtube_id", "left_semi").select("youtube_id"),
    )


def failures(attempts: DataFrame, failed: DataFrame, now: str) -> DataFrame:
    """(youtube_id, attempts, last_error, next_attempt_at): failures counted on top of earlier ones, each with its wait in hours."""
    old = attempts.select("youtube_id", F.col("attempts").alias("before"))
    at = F.to_timestamp(F.lit(now)) + F.make_dt_interval(F.lit(0), F.col("hours").cast("int"))
    return failed.join(old, "youtube_id", "left").select("youtube_id", (F.coalesce("before", F.lit(0)) + 1).alias("attempts"), F.col("error").alias("last_error"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("next_attempt_at"))


def discover(catalogue: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new videos, inserted by channel) of entries (channel_id, youtube_id, title, upload_date): valid ids that the catalogue lacks, pending."""
    valid = entries.where(F.col("youtube_id").rlike("^[A-Za-z0-9_-]{11}$"))
    one = valid.groupBy("youtube_id").agg(F.min(F.struct("channel_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("upload_date", F.lit("")).alias("upload_date"))).alias("r")).select("youtube_id", "r.*")
    new = one.join(catalogue.select("youtube_id"), "youtube_id", "left_anti").withColumn("status", F.lit("PENDING"))
    return new, new.groupBy("channel_id").agg(F.count("*").alias("inserted"))


# ---- packs, follow-up, dashboard


def pack_plan(latest: DataFrame, exclusions: DataFrame, channels: DataFrame, limit: int) -> DataFrame:
    """(channel, pack, place, id, words): texts that are neither excluded nor metadata, in packs of at most limit words, long ones cut; only sizes go through it."""
    v = R.excluded(latest.where(F.col("has_text") & ~F.col("is_metadata")), exclusions).join(channels.select(F.col("id").alias("channel_id"), F.col("prefix").alias("channel")), "channel_id")
    v = v.select("channel", "upload_date", "id", (X.word_count_spaces(F.coalesce("title", F.lit(""))) + 5).alias("header"), F.col("space_words").alias("w"))
    return O.split_packs(v, "channel", ["upload_date", "id"], "id", "header", "w", limit)


def manifest(plan: DataFrame) -> DataFrame:
    """(channel, pack, videos, words) of a pack plan; a video that is cut is in several packs."""
    return plan.groupBy("channel", "pack").agg(F.array_join(F.transform(F.sort_array(F.collect_set("id")), lambda x: x.cast("string")), ",").alias("videos"), F.sum("words").alias("words"))


def follow_up(latest: DataFrame, channels: DataFrame) -> DataFrame:
    """(channel, place, youtube_id, category, action) of all videos without text, by channel and date."""
    c = channels.select(F.col("id").alias("channel_id"), F.col("prefix").alias("channel"))
    categories = R.follow_up(latest)
    v = latest.where(R.no_text()).select("id", "youtube_id", "channel_id", "upload_date").join(categories, "id").join(c, "channel_id")
    action = F.when(F.col("category").isin("no_subtitles_reported", "no_fr_en_subtitles_reported"), "defer_audio_test").otherwise("check_subtitles_first")
    ordered = O.ranks(v.select("channel", "upload_date", "id", "youtube_id", "category", action.alias("action")), [F.col("channel"), F.col("upload_date").desc_nulls_last(), F.col("id")], "place")
    return ordered.select("channel", "place", "youtube_id", "category", "action")


def health_rows(latest: DataFrame, channels: DataFrame, excluded_ids: DataFrame) -> DataFrame:
    """channel_health less the excluded texts, with their number."""
    health = R.channel_health(channels, latest)
    out = latest.join(excluded_ids, "id", "left_semi").groupBy("channel_id").agg(F.count("*").alias("quality_excluded"), F.sum("blank_words").alias("gone"))
    h = health.join(out, "channel_id", "left").withColumn("quality_excluded", F.coalesce("quality_excluded", F.lit(0)))
    local, words = F.greatest(F.col("total_local") - F.col("quality_excluded"), F.lit(0)), F.greatest(F.col("word_count") - F.coalesce("gone", F.lit(0)), F.lit(0))
    rate = F.when(F.col("quality_excluded") > 0, F.concat(F.round(100 * local / F.col("total_remote"), 1).cast("string"), F.lit("%"))).otherwise(F.col("success_rate"))
    h = h.select(*(c for c in h.columns if c not in ("gone", "success_rate", "total_local", "word_count", "est_packs")), rate.alias("success_rate"), local.alias("total_local"), words.alias("word_count"))
    return h.withColumn("est_packs", F.expr("(word_count + 199999) div 200000"))


def dashboard_totals(latest: DataFrame, channels: DataFrame, excluded_ids: DataFrame) -> DataFrame:
    """One row of totals over texts that aren't excluded, and of states over all videos."""
    v = latest.join(excluded_ids.select("id", F.lit(True).alias("__out")), "id", "left")
    counted = F.col("nonempty") & F.col("__out").isNull()
    when = lambda c: F.when(counted, c)
    s = F.col("status")
    totals = v.agg(
        F.count_if(counted).alias("videos"), F.coalesce(F.sum(when(F.col("duration").cast("decimal(18,3)"))).cast("double") / 3600.0, F.lit(0.0)).alias("h"), F.coalesce(F.sum(when(F.col("blank_words"))), F.lit(0)).alias("words"), F.count("__out").alias("quality_excluded"),
        F.count_if(s.isin("MISSING", "PENDING")).alias("missing"), F.count_if(s.like("ERR_DL_FAIL%")).alias("failed"), F.count_if(s == "PREMIUM").alias("premium"), F.count_if(R.is_no_subs()).alias("no_subs"),
    )
    hours = F.when((F.col("h") < 1) & (F.col("words") > 0), F.bround(F.col("words") / 9000.0, 0)).otherwise(F.round("h", 1)).cast("double")
    return totals.select("videos", hours.alias("hours"), "words", "missing", "failed", "premium", "no_subs", "quality_excluded", F.lit(channels.count()).cast("long").alias("channels"))
