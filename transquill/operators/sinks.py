"""Writers: packs that replace the last generation only when whole, snapshots that can be verified, single small files."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transquill.functions.arrow import map_documents


def write_small_json(value: object, path: str) -> None:
    """A small driver-side file, replaced at once."""
    replace_file(path, json.dumps(value, ensure_ascii=False))


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), lambda x: spark._jvm.org.apache.hadoop.fs.Path(x)


def write_generation(df: DataFrame, path: str, partitions: list[str]) -> None:
    """All files of a generation in a staging folder first; then it takes the place of the last one, which is kept beside."""
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    staging, previous = path + ".staging", path + ".previous"
    fs.delete(at(staging), True)
    df.write.partitionBy(*partitions).mode("overwrite").parquet(staging)
    fs.delete(at(previous), True)
    if fs.exists(at(path)):
        fs.rename(at(path), at(previous))
    fs.rename(at(staging), at(path))


def manifest(df: DataFrame) -> tuple[int, int]:
    """Rows, and a hash that doesn't depend on their order; void and map columns by their JSON."""
    hashable = [F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in df.dtypes]
    row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*hashable)).alias("h")).first()
    return row["n"], row["h"] or 0


def snapshot(df: DataFrame, folder: str, name: str) -> tuple[int, int]:
    """Writes a copy and reads it back; fails if they differ."""
    df.write.mode("errorifexists").parquet(f"{folder}/{name}")
    want, got = manifest(df), manifest(df.sparkSession.read.parquet(f"{folder}/{name}"))
    if want != got:
        raise OSError(f"snapshot {name}: {got} read back, {want} written")
    return got


def expired(snapshots: DataFrame, keep: int) -> DataFrame:
    """Of (name, created_at) those beyond the newest keep."""
    newest = snapshots.orderBy(F.col("created_at").desc(), "name").limit(keep).select("name")
    return snapshots.join(newest, "name", "left_anti")


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_script(path: str, assignments: dict[str, object]) -> None:
    """A small asset of a page: constants with their values in JSON, replaced at once."""
    replace_file(path, " ".join(f"const {name} = {json.dumps(value, ensure_ascii=True, separators=(',', ':'))};" for name, value in assignments.items()))


def replace_file(path: str, text: str) -> None:
    """A small file on the driver, in place of the last one at once."""
    folder = Path(path).parent
    folder.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(name, path)


def gzip_archive(texts: DataFrame, key: str, column: str) -> DataFrame:
    """(key, sha, archive): each text compressed without a time stamp, so that equal texts have equal archives; each is read back and compared."""
    kind = dict(texts.dtypes)[key]

    def kernel(k, t):  # noqa: ANN001, ANN202
        data = t.encode("utf-8", "replace")
        packed = gzip.compress(data, mtime=0)
        if gzip.decompress(packed) != data:
            raise OSError(f"archive of {k} differs")
        return [(k, hashlib.sha256(data).hexdigest(), packed)]

    return map_documents(texts.where(F.col(column).isNotNull()), [key, column], kernel, f"`{key}` {kind}, sha string, archive binary")


def from_archive(archives: DataFrame, key: str) -> DataFrame:
    """(key, text) of archives (key, sha, archive); one whose text hasn't its hash is an error."""
    kind = dict(archives.dtypes)[key]

    def kernel(k, sha, packed):  # noqa: ANN001, ANN202
        data = gzip.decompress(packed)
        if hashlib.sha256(data).hexdigest() != sha:
            raise OSError(f"archive of {k} is damaged")
        return [(k, data.decode("utf-8"))]

    return map_documents(archives, [key, "sha", "archive"], kernel, f"`{key}` {kind}, text string")


def restore_snapshot(spark: SparkSession, folder: str, name: str, expected: tuple[int, int]) -> DataFrame:
    """A snapshot read back; its rows must have the manifest that it was written with."""
    df = spark.read.parquet(f"{folder}/{name}")
    if manifest(df) != expected:
        raise OSError(f"snapshot {name} is not as it was written")
    return df


def publish(df: DataFrame, folder: str, name: str, pointer: str) -> None:
    """Copies are written and verified first; only then does the journal point to them. A failure before that leaves the journal as it was."""
    spark = df.sparkSession
    rows, check = snapshot(df, folder, name)
    spark.createDataFrame([(name, rows, check)], "name string, n bigint, h bigint").withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(pointer)


def published(spark: SparkSession, folder: str, pointer: str) -> DataFrame:
    """What the journal's last entry points to."""
    last = spark.read.parquet(pointer).orderBy(F.col("published_at").desc(), F.col("name").desc()).first()
    return restore_snapshot(spark, folder, last["name"], (last["n"], last["h"]))


def append_log(df: DataFrame, path: str) -> None:
    """Lines of a log in CSV, after those that are there."""
    df.write.mode("append").option("header", False).option("quoteAll", True).option("escape", '"').csv(path)


def write_texts(texts: DataFrame, key: str, column: str, path: str) -> None:
    """Each text under its key, in as many files as there are partitions; a text has one line there with its line breaks escaped."""
    line = F.concat(F.col(key).cast("string"), F.lit("\t"), F.regexp_replace(F.replace(F.col(column), F.lit("\\"), F.lit("\\\\")), "\n", r"\\n"))
    texts.select(F.regexp_replace(line, "\r", r"\\r").alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of write_texts()."""
    parts = F.split("value", "\t", 2)
    raw = parts[1]
    plain = F.replace(F.replace(F.replace(F.replace(raw, F.lit("\\\\"), F.lit("")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")), F.lit(""), F.lit("\\"))
    return spark.read.text(path).select(parts[0].alias("key"), plain.alias("text"))
