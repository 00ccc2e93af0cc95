"""Verdicts over measured texts: status, triage, loops, gates of repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transquill.functions.text import CORRUPTION, MARKERS, has_text, heaviest, word_count_spaces
from transquill.operators.states import rules

# Words of titles of music without speech.
MUSIC = r"(?i)\b(?:lofi|music|musique|fireplace|ambient|relaxation)\b"
SILENT = r"(?i)no talking|sans parole"
# End of fixed values.


def marker_count(c: Column) -> Column:
    total = F.lit(0)
    for pattern in MARKERS.values():
        total = total + F.regexp_count(c, F.lit(pattern))
    return total


def status(markers: Column, alerts: Column) -> Column:
    return F.when(markers > 0, "technical_issue").when(alerts > 0, "repetition_review").otherwise("no_heuristic_alert")


def triage(signals: DataFrame, excluded: Column | None = None, verified: Column | None = None) -> Column:
    """Of (markers, artifacts, alerts, sound_alerts, filler_alerts, covered, words, longest, long_alerts) the first of seven rules that holds."""
    s, no = signals, F.lit(False)
    return rules(
        (no if excluded is None else excluded, "excluded_non_speech_loop"), ((s["markers"] > 0) | (s["artifacts"] > 0), "priority_encoding_or_markup"), (s["alerts"] == 0, "no_remaining_alert"),
        (s["alerts"] <= s["sound_alerts"] + s["filler_alerts"], "annotations_or_short_oral_fillers"), (no if verified is None else verified, "matches_local_timed_source"),
        (((share(s) >= 0.10) & (s["long_alerts"] >= 2)) | ((s["longest"] >= 10) & (s["long_alerts"] >= 5)), "priority_long_repetitions"), otherwise="preserved_unconfirmed_oral_repetition",
    )


def share(signals: DataFrame) -> Column:
    """The part of the words that repetitions cover."""
    return signals["covered"] / F.greatest(signals["words"], F.lit(1))


def artifact_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(CORRUPTION))


def loops(texts: DataFrame, key: str = "id") -> DataFrame:
    """(key, words, dominant, times, share, music, silent, accepted): how much of a text its weightiest sentence is, what the title says, and whether it is a loop without speech."""
    s = F.filter(F.transform(F.split(F.lower("transcript"), r"[.!?\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    rows = texts.where(has_text(F.col("transcript"))).select(key, "title", word_count_spaces(F.col("transcript")).alias("words"), s.alias("s")).where(F.size("s") > 0)
    found = rows.select(key, "words", heaviest(F.col("s"), word_count_spaces).alias("dominant"), heaviest(F.col("s"), lambda _: F.lit(1)).alias("times"), F.coalesce(F.col("title").rlike(MUSIC), F.lit(False)).alias("music"), F.coalesce(F.col("title").rlike(SILENT), F.lit(False)).alias("silent"))
    found = found.withColumn("share", F.col("dominant") / F.greatest(F.col("words"), F.lit(1)))
    return found.withColumn("accepted", F.col("music") & F.col("silent") & (F.col("words") >= 500) & (F.col("times") >= 20) & (F.col("share") >= 0.90))


def retention(signals: DataFrame, oral_allowed: bool = True) -> Column:
    """Whether a text is good enough to stand without its media: long and dense enough for its duration, repetitions few and explained."""
    s = signals
    density = s["alerts"] / F.greatest(s["words"], F.lit(1)) * 100
    sparse = F.lit(oral_allowed) & (s["alerts"] > 0) & (s["filler_alerts"] + s["sound_alerts"] == s["alerts"]) & (s["long_alerts"] == 0) & (share(s) <= 0.01) & (density <= 0.2)
    return rules(
        ((s["markers"] > 0) | (s["artifacts"] > 0), "technical_or_encoding_issue"), (s["words"] < 100, "text_too_short_for_automatic_media_deletion"),
        ((F.coalesce(s["duration"], F.lit(0.0)) > 120) & (s["words"] < s["duration"] * 0.5), "text_coverage_too_low_for_duration"), (((density >= 0.10) & (s["long_alerts"] >= 2)) | ((s["longest"] >= 10) & (s["long_alerts"] >= 5)), "priority_repetition_review"),
        ((s["alerts"] == 0) | sparse, "healthy_database_text_and_backup"), otherwise="unexplained_repetitions_require_review",
    )
