"""Caption files as DataFrames: inventory, cues, rolling display, spoken text; repairs of rendered texts."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transquill.functions import kernels
from transquill.functions.arrow import map_documents
from transquill.functions.text import folded, has_text
from transquill.operators import quality, search, states

CUES = "path string, pos int, start double, `end` double, lines array<struct<text:string,stamped:boolean>>"


def video_id(path: Column) -> Column:
    """[ID] before the extensions, else a stem that is an id; never any other word of eleven letters."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    bracket = F.regexp_extract(name, r"\[([A-Za-z0-9_-]{11})\](?:\.[A-Za-z0-9-]+)*$", 1)
    stem = F.regexp_extract(name, r"^([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9-]+)*$", 1)
    return F.coalesce(F.nullif(bracket, F.lit("")), F.nullif(stem, F.lit("")))


def inventory(files: DataFrame) -> DataFrame:
    """(youtube_id, lang, files, paths) of caption files by their names; contents aren't read."""
    lang = F.coalesce(F.nullif(F.regexp_extract("raw_path", r"\.([A-Za-z-]+)\.(?:vtt|srt)(?:\.gz)?$", 1), F.lit("")), F.lit("und"))
    rows = files.where(F.col("raw_path").rlike(r"\.(?:vtt|srt)(?:\.gz)?$")).select(video_id(F.col("raw_path")).alias("youtube_id"), lang.alias("lang"), F.translate("raw_path", "\\", "/").alias("path"))
    return rows.where("youtube_id is not null").groupBy("youtube_id", "lang").agg(F.count_distinct("path").alias("files"), F.array_join(F.sort_array(F.collect_set("path")), ";").alias("paths"))


def cue_rows(files: DataFrame) -> DataFrame:
    """One row for each cue, in the file's order."""

    def kernel(path: str, raw: str):  # noqa: ANN202
        return [(path, i, c.start, c.end, [{"text": x.text, "stamped": x.stamped} for x in c.lines]) for i, c in enumerate(kernels.cues(raw or ""))]

    return map_documents(files.where(has_text(F.col("raw_text"))).select("raw_path", "raw_text").dropDuplicates(["raw_path"]), ["raw_path", "raw_text"], kernel, CUES)


def spoken(cue_table: DataFrame) -> DataFrame:
    """(path, text, removed, rolls) of all cues: carried lines, repeated displays and overlaps taken out; windows over one file each."""
    w = Window.partitionBy("path").orderBy("pos")
    file = Window.partitionBy("path")
    first = lambda c: F.get(c, F.lit(0))
    near = lambda a, b, s0, s1: (s0 <= s1) & (F.abs(a - b) <= kernels.TOLERANCE)
    c = cue_table.withColumns({"p_lines": F.lag("lines").over(w), "p_end": F.lag("end").over(w), "p_start": F.lag("start").over(w), "n_start": F.lead("start").over(w), "last": F.lead("pos").over(w).isNull()})
    prev_last = F.element_at("p_lines", -1)["text"]
    has_prev = F.coalesce(F.size("p_lines") > 0, F.lit(False))
    adjacent = F.coalesce(near(F.col("p_end"), F.col("start"), F.col("p_start"), F.col("start")), F.lit(False))
    head = first(F.col("lines"))
    same = F.coalesce(has_prev & ~head["stamped"] & (head["text"] == F.when(has_prev, prev_last)), F.lit(False))
    c = c.withColumn("carried", adjacent & same & (F.size("lines") >= 2))
    short = (F.col("end") - F.col("start")).between(0, kernels.TOLERANCE)
    c = c.withColumn("n_carried", F.coalesce(F.lead("carried").over(w), F.lit(False)))
    follows = F.coalesce(near(F.col("end"), F.col("n_start"), F.col("start"), F.col("n_start")), F.lit(False))
    c = c.withColumn("shown", same & adjacent & follows & short & (F.size("lines") == 1) & F.col("n_carried") & (F.col("pos") > 0))
    c = c.withColumn("final", F.col("last") & (F.col("pos") > 0) & (F.size("lines") == 1) & same & ((F.col("end") - F.col("start")) <= kernels.TOLERANCE) & F.coalesce(F.abs(F.col("p_end") - F.col("start")) <= kernels.TOLERANCE, F.lit(False)))
    anchor = F.col("carried") & F.exists(F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1))), lambda x: x["stamped"])
    back = F.coalesce(F.col("start") < F.col("p_start"), F.lit(False))
    c = c.withColumn("rolls", ((F.sum(anchor.cast("int")).over(file) >= 2) | (F.size(F.collect_set(F.when(F.col("shown"), head["text"])).over(file)) >= 3)) & (F.sum(back.cast("int")).over(file) == 0))
    texts = F.transform("lines", lambda x: x["text"])
    kept = F.when(F.col("rolls") & (F.col("shown") | F.col("final")), F.array().cast("array<string>")).when(F.col("rolls") & F.col("carried"), F.slice(texts, 2, F.greatest(F.size("lines"), F.lit(1)))).otherwise(texts)
    c = c.withColumn("words", F.filter(F.split(F.array_join(kept, " "), " "), lambda x: x != ""))
    c = c.withColumn("p_words", F.lag("words").over(w))
    most = F.least(F.size("words"), F.coalesce(F.size("p_words"), F.lit(0)))
    overlap = F.when(
        (F.col("start") < F.col("p_end")) & (most > 0),
        F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), lambda k: F.when((k == 0) | (F.slice("words", 1, k) == F.slice("p_words", F.size("p_words") - k + 1, k)), k).otherwise(0))),
    ).otherwise(0)
    said = F.slice("words", F.coalesce(overlap, F.lit(0)) + 1, F.greatest(F.size("words"), F.lit(1)))
    gone = F.when(F.col("rolls") & (F.col("shown") | F.col("final") | F.col("carried")), 1).otherwise(0)
    return c.groupBy("path").agg(F.array_join(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", said.alias("w")))), lambda x: x["w"])), " ").alias("text"), F.sum(gone).cast("int").alias("removed"), F.bool_or("rolls").alias("rolls"))


def spoken_files(files: DataFrame) -> DataFrame:
    """(path, text, removed, rolls): the spoken text of caption files, and how many display lines were left out."""
    return spoken(cue_rows(files))


def best_local(files: DataFrame, preference: tuple[str, ...] = ("orig", "cap", "auto")) -> DataFrame:
    """(youtube_id, path, text): of each video the first file in the order of preference that has spoken text."""
    texts = spoken_files(files).where("text <> ''").select(video_id(F.col("path")).alias("youtube_id"), "path", "text")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(p) for p in preference)), F.regexp_extract("path", r"\.([A-Za-z-]+)\.\w+$", 1)), F.lit(0)), F.lit(99))
    return texts.where("youtube_id is not null").groupBy("youtube_id").agg(F.min_by(F.struct("path", "text"), F.struct(rank, F.col("path"))).alias("r")).select("youtube_id", "r.*")


def repetition_signals(texts: DataFrame, key: str = "id", column: str = "transcript") -> DataFrame:
    kind = dict(texts.dtypes)[key]

    def kernel(k, t):  # noqa: ANN001, ANN202
        r = kernels.repetition(t)
        return [(k, r.words, r.alerts, r.covered, r.longest, r.long_alerts, r.sound_alerts, r.filler_alerts)]

    return map_documents(texts.where(has_text(F.col(column))), [key, column], kernel, f"`{key}` {kind}, words int, alerts int, covered int, longest int, long_alerts int, sound_alerts int, filler_alerts int")


def quality_signals(texts: DataFrame, key: str = "id", column: str = "transcript") -> DataFrame:
    """repetition_signals with the text's markers and garbled signs."""
    kind = dict(texts.dtypes)[key]
    measured = texts.where(has_text(F.col(column))).select(key, column, quality.marker_count(F.col(column)).alias("markers"), quality.artifact_count(F.col(column)).alias("artifacts"))

    def kernel(k, m, a, t):  # noqa: ANN001, ANN202
        r = kernels.repetition(t)
        return [(k, m, a, r.words, r.alerts, r.covered, r.longest, r.long_alerts, r.sound_alerts, r.filler_alerts)]

    return map_documents(measured, [key, "markers", "artifacts", column], kernel, f"`{key}` {kind}, markers int, artifacts int, words int, alerts int, covered int, longest int, long_alerts int, sound_alerts int, filler_alerts int")


def collapsed_triples(texts: DataFrame, strict: bool, key: str = "id", column: str = "transcript") -> DataFrame:
    """(key, text, removed) of texts that were rendered three times over."""
    kind = dict(texts.dtypes)[key]
    rule = dict(coverage=0.98, groups=100, long_groups=30, gap=40, long_only=True) if strict else dict(coverage=0.98, groups=25, long_groups=20, distinct=20)

    def kernel(k, t):  # noqa: ANN001, ANN202
        new, n = kernels.collapse_triples(t, **rule)
        return [(k, new, n)] if n else []

    return map_documents(texts.where(has_text(F.col(column))), [key, column], kernel, f"`{key}` {kind}, text string, removed int")


def spoken_once(texts: DataFrame, key: str = "id", column: str = "transcript") -> DataFrame:
    """(key, text, events): what is said again at once, said once."""
    kind = dict(texts.dtypes)[key]

    def kernel(k, t):  # noqa: ANN001, ANN202
        new, n = kernels.dedup_spoken(t)
        return [(k, new, n)] if n else []

    return map_documents(texts.where(has_text(F.col(column))), [key, column], kernel, f"`{key}` {kind}, text string, events int")


def rendered_once(texts: DataFrame, key: str = "youtube_id", column: str = "transcript") -> DataFrame:
    """(key, text, removed) of texts in which each timed line stands three times."""
    kind = dict(texts.dtypes)[key]

    def kernel(k, t):  # noqa: ANN001, ANN202
        new, n = kernels.rendered_triples(t)
        return [(k, new, n)] if n else []

    return map_documents(texts.where(has_text(F.col(column))), [key, column], kernel, f"`{key}` {kind}, text string, removed int")


def canonical(texts: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """(key, <column>_key): hashes of the texts' canonical words."""
    kind = dict(texts.dtypes)[key]
    names = ", ".join(f"`{c}_key` string" for c in columns)
    return map_documents(texts, [key, *columns], lambda k, *ts: [(k, *(hashlib.sha256(" ".join(kernels.canonical_words(t or "")).encode("utf-8", "replace")).hexdigest() for t in ts))], f"`{key}` {kind}, {names}")


def technical_candidates(texts: DataFrame, key: str, column: str) -> DataFrame:
    """(key, text, removed) of texts whose caption header, settings, anchored copies and tags are taken away, where that changes them."""
    kind = dict(texts.dtypes)[key]
    header = r"(?is)\A\s*(?:WEBVTT\b\s*)?(?:Kind:\s*captions\s*)?(?:Language:\s*[a-z]{2}(?:-[a-z]+)?\s*)?(?:(?:align|position|line|size|vertical):\S+\s*)*"
    bare = texts.where(has_text(F.col(column))).select(key, F.col(column).alias("old"), F.when(F.col(column).rlike(r"(?i)\A\s*(?:WEBVTT\b|Kind:\s*captions|Language:\s*[a-z]{2}\b)"), F.regexp_replace(column, header, "")).otherwise(F.col(column)).alias("new"))

    def kernel(k, old, new):  # noqa: ANN001, ANN202
        text, n = kernels.without_copies(new)
        text = kernels.strip_markup(text) if kernels.STAMP.search(text) or kernels.CUE_TAG.search(text) else text
        return [(k, text, n)] if text != old else []

    return map_documents(bare, [key, "old", "new"], kernel, f"`{key}` {kind}, text string, removed int")


def restoration_proofs(pairs: DataFrame, key: str) -> DataFrame:
    """(key, of_before, ratio, kept, accepted) of pairs (key, before, after): whether the longer text restores what the other lost."""
    kind = dict(pairs.dtypes)[key]

    def kernel(k, a, b):  # noqa: ANN001, ANN202
        left, _, same = kernels.concordance(a, b)
        return [(k, left, same, len(b.split()) / max(1, len(a.split())), kernels.protected(a) == kernels.protected(b))]

    rows = pairs.where(has_text(F.col("before")) & has_text(F.col("after")))
    agreed = map_documents(rows, [key, "before", "after"], kernel, f"`{key}` {kind}, of_before double, same boolean, ratio double, kept boolean")
    names = ("markers", "artifacts", "words", "covered", "long_alerts")
    signals = [quality_signals(rows.select(key, F.col(side).alias("t")), key, "t").select(key, *(F.col(n).alias(f"{n}_{side}") for n in names)) for side in ("before", "after")]
    joined = agreed.join(signals[0], key).join(signals[1], key)
    side = lambda s: {n: F.col(f"{n}_{s}") for n in names}
    accepted = states.restoration_proof(F.col("same"), F.col("of_before"), F.col("ratio"), side("after"), side("before"), F.col("kept"))
    return joined.select(key, F.round("of_before", 6).alias("of_before"), F.round("ratio", 6).alias("ratio"), "kept", accepted.alias("accepted"))


def pilot(files: DataFrame, latest: DataFrame, videos: DataFrame, most: int = 3) -> DataFrame:
    """(youtube_id, not_empty, found, unchanged) of at most so many re-imported videos: checked in a copy of their own, the catalogue stays as it is."""
    known = latest.select("youtube_id", "id", "text_sha", "has_text")
    some = best_local(files).join(known.where("has_text"), "youtube_id").orderBy("youtube_id").limit(most)
    term = F.lower(F.regexp_extract("text", r"(\p{L}{4,})", 1))
    copied = some.select("youtube_id", "id", "text", "text_sha", term.alias("term"))
    found = F.exists(search.terms(F.lit(""), F.col("text")), lambda w: w.startswith(folded(F.col("term"))))
    now = videos.where(has_text(F.col("transcript"))).select("id", F.sha2("transcript", 256).alias("sha_now")).join(F.broadcast(copied.select("id")), "id", "left_semi").distinct()
    return copied.join(now, "id").select("youtube_id", (F.trim("text") != "").alias("not_empty"), ((F.col("term") != "") & found).alias("found"), (F.col("sha_now") == F.col("text_sha")).alias("unchanged"))


def concordant(pairs: DataFrame, key: str) -> DataFrame:
    """pairs (key, before, after): how much of each is in the other, and whether they are one speech."""
    kind = dict(pairs.dtypes)[key]
    return map_documents(pairs.where(has_text(F.col("before")) & has_text(F.col("after"))), [key, "before", "after"], lambda k, a, b: [(k, *kernels.concordance(a, b))], f"`{key}` {kind}, of_before double, of_after double, same boolean")


def artifact_evidence(pairs: DataFrame, key: str, deep: bool = False) -> DataFrame:
    """(key, before, after, n): which garbled signs stand for which letter in texts (key, before, after) that both exist."""
    kind = dict(pairs.dtypes)[key]
    may = kernels.deep_artifact if deep else kernels.sound_artifact
    return map_documents(pairs, [key, "before", "after"], lambda k, a, b: [(k, x, y, n) for (x, y), n in kernels.artifact_pairs(a or "", b or "", may=may).items()], f"`{key}` {kind}, before string, after string, n int")


def supported_artifacts(seen: DataFrame, key: str, least: int = 10, documents: int = 3) -> DataFrame:
    """(before, after, occurrences, documents) of evidence (key, before, after, n): pairs with enough support whose signs stand for one letter in all of it."""
    sums = seen.groupBy("before", "after").agg(F.sum("n").alias("occurrences"), F.count_distinct(key).alias("documents"))
    one = sums.groupBy("before").agg(F.count("*").alias("targets")).where("targets = 1").select("before")
    return sums.where((F.col("occurrences") >= least) & (F.col("documents") >= documents)).join(one, "before", "left_semi")


def learned_artifacts(pairs: DataFrame, key: str, least: int = 10, documents: int = 3, deep: bool = False) -> DataFrame:
    """(before, after, occurrences, documents): pairs with enough independent evidence and only one target."""
    return supported_artifacts(artifact_evidence(pairs, key, deep), key, least, documents)


def merged_artifacts(inherited: DataFrame, learned: DataFrame) -> DataFrame:
    """(before, after): of both those whose targets don't conflict."""
    both = inherited.select("before", "after").unionByName(learned.select("before", "after"))
    return both.groupBy("before").agg(F.max("after").alias("after"), F.count_distinct("after").alias("k")).where("k = 1").drop("k")


def restored(texts: DataFrame, artifacts: DataFrame, key: str = "id", column: str = "transcript", most: int = 10_000, deep: bool = False) -> DataFrame:
    """(key, text, n) of texts that the learned pairs restore wholly; the pairs are few by their support, and that is checked."""
    rows = artifacts.select("before", "after").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} pairs")
    mapping = {r["before"]: r["after"] for r in rows}
    kind = dict(texts.dtypes)[key]
    run = kernels.deep_restore if deep else kernels.restore

    def kernel(k, t):  # noqa: ANN001, ANN202
        new, n = run(t, mapping)
        return [(k, new, n)] if n else []

    return map_documents(texts.where(has_text(F.col(column)) & F.col(column).rlike("[^\\x00-\\x7f]")), [key, column], kernel, f"`{key}` {kind}, text string, n int")
