"""Structured Streaming forms of the pipeline's state: live counts, retries with back-off, discovery of new ids."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS = {"http_429": 62 / 60, "download": 24.0, "no_subtitles": 168.0}


def live_counts(events: DataFrame, minutes: int = 1, late: str = "10 minutes") -> DataFrame:
    """Events and value by window and type; the same on a stream and on a batch."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", f"{minutes} minutes")
    return source.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def new_ids(found: DataFrame, known: DataFrame, key: str = "youtube_id", time: str = "ts", late: str = "1 day") -> DataFrame:
    """Ids that the catalogue lacks, each once; state is kept no longer than the watermark."""
    fresh = found.join(known.select(key), key, "left_anti")
    return fresh.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if found.isStreaming else fresh.dropDuplicates([key])


def retries(events: DataFrame, hours: float = HOURS["download"]) -> DataFrame:
    """(user_id, attempts, next_attempt_at) after each batch: a failure counts up and sets the next time, a success clears."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        attempts, last = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for kind, ts in zip(rows["event_type"], rows["ts"]):
            if kind == "error":
                attempts, last = attempts + 1, int(ts.timestamp())
            elif kind == "purchase":
                attempts, last = 0, 0
        state.update((attempts, last))
        at = pd.Timestamp(last + int(hours * 3600), unit="s") if attempts else pd.NaT
        yield pd.DataFrame({"user_id": [key[0]], "attempts": [attempts], "next_attempt_at": [at]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, attempts int, next_attempt_at timestamp", "attempts int, last long", "update", "NoTimeout")


def paused_until(failures: DataFrame, minutes: int = 62) -> DataFrame:
    """The time before which no call may be made, after the last rate limit."""
    return failures.where("category = 'http_429'").agg((F.max("ts") + F.expr(f"interval {minutes} minutes")).alias("until"))


def run_once(stream: DataFrame, checkpoint: str, table: str, mode: str = "append") -> None:
    """Everything that is there now, then stop."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).format("memory").queryName(table).trigger(availableNow=True).start().awaitTermination()


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").parquet(folder)
