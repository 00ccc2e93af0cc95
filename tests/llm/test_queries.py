"""Every query over empty tables, and over tables with nulls, copies, long texts and columns that clash with internal names."""

import pytest

from transquill.llm import queries

SCHEMAS = {
    "channels": "id int, prefix string, yt_url string, lang_config string",
    "videos": "id bigint, channel_id int, youtube_id string, title string, transcript string, status string, upload_date string, duration double, last_updated timestamp",
    "pipeline_transcripts": "youtube_id string, language string, source string, raw_path string, sha256 string, cleaner_version string, acquired_at string",
    "raw_captions": "raw_path string, raw_text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, video_id bigint, upload_date string, acquired_at timestamp",
    "eval_items": "item_id bigint, text string, lang string",
    "mix_weights": "source string, target_share double, max_repeats int",
}
CLASHING = "host int, field string, kind string, text string, src string, own int, code string, passages int, __host int, __salt int, rn int, k int, p double"
LONG = "The garden crew cleans the keyboard and the pilot keeps a logbook. " * 3000
ROWS = {
    "channels": [(1, "A", None, "fr"), (2, None, None, None), (None, None, None, None)],
    "videos": [
        (1, 1, "abcdefghijk", "A title", "0:01 Anna: Hello there. 0:05 Tom: I see it now.", "OK", None, None, None), (1, 1, "abcdefghijk", "A title", "0:01 Anna: Hello there. 0:05 Tom: I see it now.", "OK", None, None, None), (2, None, None, None, None, None, None, None, None),
        (3, 2, "bbcdefghijk", " ", "", None, "x", -1.0, None), (4, 1, "cbcdefghijk", "T​x", LONG, None, None, None, None), (5, 9, "dbcdefghijk", "", "Hello {{ name }} and <b>this</b>.", None, None, None, None), (None, None, None, None, "no id at all", None, None, None, None),
    ],
    "pipeline_transcripts": [("abcdefghijk", "fr", None, None, None, None, None), ("abcdefghijk", "fr", None, None, None, None, "2024-01-01 00:00:00"), (None, None, None, None, None, None, None)],
    "raw_captions": [("x/abcdefghijk.cap.vtt", "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n<v A>Hello\n\n00:00:03.000 --> 00:00:04.000\n<v B>I see"), ("x\\abcdefghijk.auto.json", None), (None, None), ("odd", "")],
    "documents": [(1, "One. Two is here.", "en", " a ", 1, None, None, None), (2, None, None, None, None, None, None, None), (3, "", None, "A", None, None, None, None), (4, LONG, "xx", "b", None, None, None, None), (5, "One. Two is here.", None, None, None, None, None, None)],
    "eval_items": [(1, "garden crew cleans the keyboard and the pilot keeps a logbook the garden crew", "en"), (2, None, None)],
    "mix_weights": [("A", 0.5, 2), ("B", 0.5, 1), (None, None, None)],
}


def tables(spark, folder, rows, extra=False):
    for name, schema in SCHEMAS.items():
        names = {c.split()[0] for c in schema.split(", ")}
        more = [c for c in CLASHING.split(", ") if c.split()[0] not in names] if extra else []
        full = ", ".join([schema, *more])
        data = [tuple(r) + tuple({"int": 7, "double": 0.5}.get(c.split()[1], "zz") for c in more) for r in rows.get(name, [])]
        spark.createDataFrame(data, full).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), {})


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("odd"), ROWS, extra=True)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


FOUND = {
    "p1_found": {(4, "title")}, "p2_found": {(1, "transcript", 1, 1), (1, "transcript", 2, 2), (1, "raw_path", 1, 1), (1, "raw_path", 2, 2)}, "p3_found": set(), "p4_found": {(5,)}, "p5_found": {(4,)}, "p7_found": {(5, "html")}, "p8_found": {(4, 1)},
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_odd_tables(spark, odd, name):
    rows = [tuple(r) for r in queries.QUERIES[name](spark, odd).collect()]
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name in FOUND:
        assert {r for r in rows if r[0] is not None} == FOUND[name]
    if name == "p10_found":
        assert {(1, 4), (1, 17), (5, 4), (5, 17)} < set(rows) and sum(r[0] == 4 for r in rows) == 3000


def test_nothing_else_imports_this_package():
    from pathlib import Path

    root = Path(queries.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "transquill.llm" not in path.read_text(encoding="utf-8"), path
