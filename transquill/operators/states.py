"""Decisions on the state of videos and files, as column expressions: the first rule that holds gives the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Endings of media, audio and code files; parts of paths; names of answers.
MEDIA = ("mp4", "mkv", "webm", "mov", "m4a", "mp3", "opus", "wav", "ogg", "flac", "aac")
AUDIO = ("m4a", "mp3", "opus", "wav", "ogg", "flac", "aac")
CODE = ("py", "ps1", "html", "js", "css", "md", "toml", "exe", "dll")
TRANSCRIPT_FOLDERS = ("transcripts", "2_clean_txt", "2_txt", "clean_txt", "txt")
# End of fixed values.


def rules(*pairs: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The answer of the first rule that holds; a rule that is null doesn't."""
    out = F.when(pairs[0][0], pairs[0][1])
    for condition, answer in pairs[1:]:
        out = out.when(condition, answer)
    return out.otherwise(F.lit(otherwise))


def ending(*of: str) -> str:
    return r"\.(?:" + "|".join(of) + ")$"


def file_kind(path: Column) -> Column:
    """What a file is for, by the parts of its path; 16 answers, in the order in which they protect."""
    p = F.lower(F.translate(path, "\\", "/"))
    name, folders = F.regexp_extract(p, r"([^/]*)$", 1), F.regexp_extract(p, r"^(.*/)?[^/]*$", 1)
    within = lambda part: F.concat(F.lit("/"), p, F.lit("/")).contains(f"/{part}/")
    return rules(
        (within(".git"), "git_history"), (name.rlike("-(?:wal|shm|journal)$"), "sqlite_journal_protected"), (name.rlike(ending(*MEDIA)), "media"), (within("_captions_gz"), "canonical_timed_source_protected"),
        (within("_text_sources_gz") | within("_verified_text_gz"), "canonical_text_source_protected"), (within("_legacy_rendered_gz"), "revision_original_protected"), (name.rlike(ending("db", "sqlite", "sqlite3")), "database"),
        (within("snapshots") | name.endswith(".verified.json"), "backup_protected"), (name.rlike(r"\.(?:vtt|srt|ass|ttml|json3)(?:\.gz)?$"), "caption_source"), (name.endswith(".txt") & folders.contains("pack"), "generated_pack"),
        (name.endswith(".txt") & folders.rlike("(?:^|/)(?:" + "|".join(TRANSCRIPT_FOLDERS) + ")/"), "generated_transcript"), (name.endswith(".txt"), "other_text"), (name.endswith(".info.json"), "video_metadata"), (name.rlike(ending(*CODE)), "code_or_runtime"), otherwise="other",
    )


def failure_status(error: Column) -> Column:
    """The status that a failed download's text gives."""
    return rules((error.rlike("(?i)429|Too Many Requests"), "RETRY_429"), (error.rlike("(?i)Premium|copyright|Music|protected"), "PREMIUM"), (error.rlike("(?i)available|subtitles"), "NO_SUBS"), otherwise="ERR_DL_FAIL")


def diagnosis(listing: Column) -> Column:
    """What a listing of subtitles says about a video."""
    en, fr = listing.rlike(r"(?i)en\s+"), listing.rlike(r"(?i)fr\s+")
    return rules((listing.rlike("(?i)429: Too Many Requests"), "RETRY_429"), (listing.rlike("(?i)has no subtitles"), "DIAG_NO_SUBS"), (en & fr, "DIAG_HAS_BOTH"), (en, "DIAG_HAS_EN"), (fr, "DIAG_HAS_FR"), otherwise="DIAG_HAS_OTHER")


def target_language(listing: Column) -> Column:
    """The language to fetch by a listing of subtitles, English before French; else why there is none, and null while calls are refused."""
    return F.when(~listing.contains("HTTP Error 429"), rules((listing.contains("has no subtitles"), "NO_SUBS_TOTAL"), (listing.rlike(r"(?m)^en\s+") | listing.contains("en-orig"), "en"), (listing.rlike(r"(?m)^fr\s+"), "fr"), otherwise="NO_EN_FR"))


def availability(meta: DataFrame) -> Column:
    """PREMIUM if the video isn't open to all, NO_SUBS if it has captions of no kind, else DONE."""
    none = lambda c: F.coalesce(F.size(F.map_keys(c)), F.lit(0)) <= 0
    return rules((~F.coalesce(meta["availability"], F.lit("")).isin("public", "unlisted"), "PREMIUM"), (none(meta["subtitles"]) & none(meta["automatic_captions"]), "NO_SUBS"), otherwise="DONE")


def edited_status(status: Column, has_text: Column, premium_again: Column, limited: Column) -> Column:
    """A status after the edits by hand: restricted videos to try again, those that a log names as limited while they have no text."""
    return F.when(limited & ~has_text, F.lit("RETRY_429")).when((status == "PREMIUM") & premium_again, F.lit("PENDING")).otherwise(status)


def upload_candidates(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """(youtube_id, title, channel) of videos without text or captions whose media are there."""
    v = videos.where(~F.col("nonempty") & F.col("status").isin("NO_SUBS", "PREMIUM") & (F.col("is_downloaded") == "OUI"))
    return v.join(channels.select(F.col("id").alias("channel_id"), F.col("prefix").alias("channel")), "channel_id").select("youtube_id", "title", "channel")


def rejected_languages(ids: DataFrame) -> DataFrame:
    """Blacklist lines of videos (youtube_id, lang, title) whose language is known and neither French nor English."""
    lines = ids.where((F.col("lang") != "") & ~F.col("lang").rlike("^(?:fr|en)"))
    return lines.select("youtube_id", F.concat("youtube_id", F.lit(" # [AUTO-LANG: "), "lang", F.lit("] "), F.coalesce("title", F.lit(""))).alias("line"))


def inventory_state(blacklisted: Column, dense: Column, raw: Column, missing: Column) -> Column:
    """Where a catalogued video stands; what excludes it comes first."""
    return rules((blacklisted, "BLACKLISTED"), (dense, "SUCCESS (DENSE)"), (raw, "DOWNLOADED (RAW ONLY)"), (missing, "FAILED/PENDING"), otherwise="DETECTED (ON YT)")


def purge_candidate(status: Column, chars: Column) -> Column:
    """Whether a media file's video has its text for sure."""
    return F.coalesce((chars > 0) & status.startswith("SUCCESS"), F.lit(False))


def best_media(files: DataFrame, key: str, path: str, size: str) -> DataFrame:
    """Of each key's media the audio before the rest, then the smallest, then by path."""
    sort = F.struct(F.when(F.lower(path).rlike(ending(*AUDIO)), 0).otherwise(1), F.col(size), F.col(path))
    return files.groupBy(key).agg(F.min_by(F.struct(path, size), sort).alias("r")).select(key, "r.*")


def maintenance_category(eligible: Column, changed: Column, markers: Column, coverage: Column, long_groups: Column, alerts: Column) -> Column:
    """What a plan says about a text, before its candidate is tried."""
    return rules(
        (eligible, "systemic_triplicates"), (changed, "technical_metadata"), (markers > 0, "unresolved_markup"), ((coverage >= 0.15) & (long_groups >= 5), "partial_triplicates_needs_source"),
        (alerts >= 30, "frequent_repetitions_unconfirmed"), otherwise="isolated_repetitions_unconfirmed",
    )


def rejected(candidate_empty: Column, markers_after: Column, alerts_after: Column, alerts_before: Column) -> Column:
    """Whether a changed candidate must not be taken."""
    return candidate_empty | (markers_after > 0) | (alerts_after > alerts_before)


def repair_gate(markers_after: Column, artifacts_before: Column, artifacts_after: Column, alerts_before: Column, alerts_after: Column, words_after: Column) -> Column:
    """Whether a repair may be taken: something is left without markers, no more is garbled, and either repetition or garbling fell."""
    return (words_after > 0) & (markers_after == 0) & (artifacts_after <= artifacts_before) & ((alerts_after < alerts_before) | (artifacts_after < artifacts_before))


def restoration_proof(same: Column, of_before: Column, ratio: Column, after: dict[str, Column], before: dict[str, Column], kept: Column) -> Column:
    """Whether a longer source text restores what was lost: all of the old text is in it, in a tenth more words at most, and nothing got worse."""
    return (
        same & (of_before >= 0.999) & (ratio > 1) & (ratio <= 1.10) & (after["markers"] == 0) & (after["artifacts"] == 0) & (after["long_alerts"] <= before["long_alerts"])
        & (after["covered"] / F.greatest(after["words"], F.lit(1)) <= before["covered"] / F.greatest(before["words"], F.lit(1)) + 0.02) & kept
    )


def point_lookup(videos: DataFrame, youtube_id: str) -> DataFrame:
    """(id, transcript) of one video; anything but a valid id is refused before it reaches the data."""
    import re

    if not re.fullmatch(r"[A-Za-z0-9_-]{11}", youtube_id or ""):
        raise ValueError(f"no video id: {youtube_id!r}")
    return videos.where((F.col("youtube_id") == youtube_id) & F.col("transcript").isNotNull()).select("id", "transcript").distinct()
