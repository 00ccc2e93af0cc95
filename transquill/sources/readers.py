"""Readers of the pipeline's text formats as DataFrames."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transquill.functions.arrow import map_documents
from transquill.functions.text import MARKERS
from transquill.operators import captions

ID = r"[A-Za-z0-9_-]{11}"


def channels_config(spark: SparkSession, path: str) -> DataFrame:
    """(url, prefix, lang) of a ';' table; the language column has any of its three names."""
    df = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)
    names = {c.lstrip("﻿").strip().lower(): c for c in df.columns}
    pick = lambda *of: next((F.trim(F.col(f"`{names[n]}`")) for n in of if n in names), F.lit(None).cast("string"))
    return df.select(pick("url").alias("url"), pick("prefixe", "prefix").alias("prefix"), pick("language", "langue", "lang").alias("lang"))


def playlist_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """(youtube_id, title) of flat playlists in JSON; entries without a valid id fall away."""
    entries = F.from_json(column, "entries array<struct<id:string,title:string>>")["entries"]
    return lines.select(F.explode(entries).alias("e")).where(F.col("e.id").rlike(f"^{ID}$")).select(F.col("e.id").alias("youtube_id"), F.col("e.title").alias("title"))


def separated_lines(lines: DataFrame, separator: str = "[SEP]", column: str = "value") -> DataFrame:
    """(youtube_id, title) of lines 'id<separator>title'."""
    parts = F.split(column, re.escape(separator), 2)
    return lines.select(F.trim(parts[0]).alias("youtube_id"), F.trim(F.get(parts, F.lit(1))).alias("title")).where(F.col("youtube_id").rlike(f"^{ID}$"))


def blacklist(lines: DataFrame, column: str = "value") -> DataFrame:
    """(youtube_id, marker) of lines 'id # [TAG] comment'; without a tag the comment's first word."""
    comment = F.trim(F.regexp_extract(column, r"^[^#]*#(.*)$", 1))
    tag = F.regexp_extract(comment, r"\[([^\]]+)\]", 1)
    return lines.select(F.regexp_extract(column, rf"^\s*({ID})(?:\s|#|$)", 1).alias("youtube_id"), F.when(tag != "", tag).otherwise(F.nullif(F.regexp_extract(comment, r"^(\S+)", 1), F.lit(""))).alias("marker")).where("youtube_id <> ''")


def rate_limited(log: DataFrame, file: str = "file", line_no: str = "line_no", column: str = "value") -> DataFrame:
    """Ids of the lines just before those that report a rate limit, file by file."""
    w = Window.partitionBy(file).orderBy(line_no)
    rows = log.withColumn("before", F.lag(column).over(w)).where(F.col(column).contains("HTTP Error 429"))
    return rows.select(F.regexp_extract("before", rf"\[({ID})\]", 1).alias("youtube_id")).where("youtube_id <> ''").distinct()


def feed_entries(feeds: DataFrame, column: str = "value") -> DataFrame:
    """(youtube_id, title, upload_date) of Atom feeds; the date without its hyphens."""
    ids = F.expr(f"xpath({column}, '//*[local-name()=\"entry\"]/*[local-name()=\"videoId\"]/text()')")
    titles = F.expr(f"xpath({column}, '//*[local-name()=\"entry\"]/*[local-name()=\"title\"]/text()')")
    dates = F.expr(f"xpath({column}, '//*[local-name()=\"entry\"]/*[local-name()=\"published\"]/text()')")
    return feeds.select(F.explode(F.arrays_zip(ids.alias("i"), titles.alias("t"), dates.alias("d"))).alias("e")).select(F.col("e.i").alias("youtube_id"), F.col("e.t").alias("title"), F.regexp_replace(F.substring("e.d", 1, 10), "-", "").alias("upload_date"))


def pack_entries(packs: DataFrame, column: str = "value", least: int = 100) -> DataFrame:
    """(url, title, upload_date, text) of concatenated packs: parts after '### SOURCE:' with a block between rules."""
    parts = packs.select(F.explode(F.slice(F.split(column, r"(?m)^### SOURCE:"), 2, 1 << 20)).alias("p"))
    pick = lambda label: F.nullif(F.trim(F.regexp_extract("p", rf"(?mi)^\s*{label}\s*:\s*(.+)$", 1)), F.lit(""))
    text = F.trim(F.get(F.split("p", r"(?m)^={4,}\s*$"), F.lit(2)))
    return parts.select(pick("URL").alias("url"), pick("TITLE").alias("title"), pick("DATE").alias("upload_date"), text.alias("text")).where(F.length("text") >= least)


def json_exports(files: DataFrame, column: str = "value") -> DataFrame:
    """(youtube_id, transcript) of exports that are a list, or an object with videos or data."""
    item = "array<struct<youtube_id:string,id:string,transcript:string,text:string>>"
    inner = F.from_json(column, f"videos {item}, data {item}")
    rows = F.when(F.ltrim(column).startswith("["), F.from_json(column, item)).otherwise(F.coalesce(inner["videos"], inner["data"]))
    return files.select(F.explode(rows).alias("r")).select(F.coalesce("r.youtube_id", "r.id").alias("youtube_id"), F.coalesce("r.transcript", "r.text").alias("transcript")).where("youtube_id is not null and transcript is not null")


def top_level_id(header: str) -> str | None:
    """The string id of a JSON object of which only the beginning is there; ids of nested objects don't count."""
    decoder, i, n = json.JSONDecoder(), header.find("{") + 1, len(header)
    if i == 0:
        return None
    while i < n:
        while i < n and header[i] in " \t\r\n,":
            i += 1
        try:
            key, i = decoder.raw_decode(header, i)
            while i < n and header[i] in " \t\r\n:":
                i += 1
            value, i = decoder.raw_decode(header, i)
        except ValueError:
            return None
        if key == "id":
            return value if isinstance(value, str) else None
    return None


def top_level_ids(files: DataFrame, key: str, column: str) -> DataFrame:
    kind = dict(files.dtypes)[key]
    return map_documents(files.where(F.col(column).isNotNull()), [key, column], lambda k, h: [(k, i)] if (i := top_level_id(h[:65536])) else [], f"`{key}` {kind}, id string")


def metadata(lines: DataFrame, column: str = "value") -> DataFrame:
    """The allowed keys of downloaded metadata; everything else is never parsed."""
    keys = "id string, title string, upload_date string, duration double, availability string, language string, subtitles map<string,array<struct<ext:string>>>, automatic_captions map<string,array<struct<ext:string>>>"
    return lines.select(F.from_json(column, keys).alias("m")).select("m.*").where(F.col("id").rlike(f"^{ID}$"))


def caption_choice(meta: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """(id, lang, source): people's captions in the order of the languages, then automatic ones, if there is a timed format."""
    has = lambda col, lang: F.exists(F.coalesce(F.col(col)[lang], F.array().cast("array<struct<ext:string>>")), lambda x: x["ext"] == "vtt")
    choices = [F.when(has(col, lang), F.struct(F.lit(lang).alias("lang"), F.lit(source).alias("source"))) for col, source in (("subtitles", "manual"), ("automatic_captions", "automatic")) for lang in languages]
    return meta.select("id", F.coalesce(*choices).alias("c")).select("id", "c.lang", "c.source")


def injected(videos: DataFrame, results: DataFrame) -> DataFrame:
    """videos (youtube_id, status, text_sha) after results (youtube_id, status, transcript) of fetches: only successes with a text count."""
    good = results.where((F.col("status") == "SUCCESS") & F.col("transcript").isNotNull() & (F.col("transcript") != "")).groupBy("youtube_id").agg(F.max(F.sha2("transcript", 256)).alias("__new"))
    joined = videos.join(good, "youtube_id", "left")
    return joined.select("youtube_id", F.when(F.col("__new").isNotNull(), "SUCCESS").otherwise(F.col("status")).alias("status"), F.coalesce("__new", "text_sha").alias("text_sha"))


def recovered(videos: DataFrame, files: DataFrame) -> DataFrame:
    """(youtube_id, status, text_sha) of what files (path, text) of a recovery folder fill in videos (youtube_id, has_text).

    Metadata of the downloader is refused before anything is parsed; caption files are cleaned; texts are never overwritten.
    """
    good = files.where(F.col("path").rlike(r"(?i)\.(?:txt|srt|vtt)$") & ~F.coalesce(F.col("text").rlike(MARKERS["downloader_metadata"]), F.lit(False)))
    timed = F.col("path").rlike(r"(?i)\.(?:srt|vtt)$")
    cleaned = captions.spoken_files(good.where(timed).select(F.col("path").alias("raw_path"), F.col("text").alias("raw_text"))).select("path", "text")
    both = good.where(~timed).select("path", F.trim("text").alias("text")).unionByName(cleaned)
    one = both.where(F.col("text") != "").select(captions.video_id(F.col("path")).alias("youtube_id"), "path", "text").groupBy("youtube_id").agg(F.min_by("text", "path").alias("text"))
    return videos.where(~F.col("has_text")).join(one, "youtube_id").select("youtube_id", F.lit("SUCCESS (RECOVERY)").alias("status"), F.sha2("text", 256).alias("text_sha"))


def sidecars(meta: DataFrame, subtitles: DataFrame, known: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """(youtube_id, title, lang, text): new videos by their metadata with a caption in the first of the languages that has a sound one."""
    sound = subtitles.where(F.col("lang").isin(*languages) & (F.length("text") > 10) & ~F.col("text").contains("????") & ~F.col("text").contains("-->"))
    order = F.array_position(F.array(*(F.lit(x) for x in languages)), F.col("lang"))
    best = sound.groupBy("youtube_id").agg(F.min_by(F.struct("lang", "text"), F.struct(order, F.col("text"))).alias("r"))
    new = meta.select(F.col("id").alias("youtube_id"), "title").groupBy("youtube_id").agg(F.min("title").alias("title")).join(known, "youtube_id", "left_anti")
    return new.join(best, "youtube_id").select("youtube_id", "title", "r.lang", "r.text")


def merged(catalogue: DataFrame, channels: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalogue, channels) after videos (prefix, youtube_id) of other tables: missing channels are created, known ids are left alone.

    New channels are numbered after the highest id by their names' order; they are as few as channels are.
    """
    names = others.select("prefix").distinct().join(channels.select("prefix"), "prefix", "left_anti")
    highest = channels.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = names.select("prefix", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("prefix")) + F.lit(highest)).cast("long").alias("id"))
    every = channels.select("id", "prefix").unionByName(new.select("id", "prefix"))
    add = others.join(every, "prefix").groupBy("youtube_id").agg(F.min("id").alias("channel_id")).join(catalogue.select("youtube_id"), "youtube_id", "left_anti")
    return catalogue.select("youtube_id", "channel_id").unionByName(add), every


def inventory_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(path, size_bytes, git_tracked, youtube_id) of an inventory's lines; malformed ones are left out."""
    return lines.select(F.from_json(column, "path string, size_bytes bigint, git_tracked boolean, youtube_id string").alias("j")).select("j.*").where("path is not null and size_bytes is not null")


def journal(lines: DataFrame, column: str = "value") -> DataFrame:
    """(user, seq): of each key's journal records the last; malformed lines are skipped."""
    rows = lines.select(F.from_json(column, "user bigint, seq bigint").alias("j")).select("j.*").where("user is not null and seq is not null")
    return rows.groupBy("user").agg(F.max("seq").alias("seq"))


def sql_template(script: str, name: str) -> str:
    """The query that a script holds under a name, as a block or in quotes; anything but a fixed SELECT is refused."""
    block = re.search(rf'\${re.escape(name)}\s*=\s*@"\s*\n(.*?)\n"@', script, re.DOTALL) or re.search(rf'\${re.escape(name)}\s*=\s*"(.*?)"', script, re.DOTALL)
    found = block[1].strip() if block else ""
    if not found.upper().startswith("SELECT") or "$" in found or ";" in found.rstrip(";"):
        raise ValueError(f"no fixed SELECT named {name}")
    return found.rstrip(";")
