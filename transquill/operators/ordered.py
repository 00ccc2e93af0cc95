"""Operators that carry something along an order within groups, however large a group is.

The rows are written once in sorted ranges of a bounded number of rows, so a group with a third of all rows lies in many of
them. Each range says in a few numbers what it does to whatever is carried into it; these are chained on the driver, at most
two for each range; then all ranges are gone through at once. Only order columns, sizes and times take part, never texts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from transquill.operators.storage import stored

#: Rows of a range.
ROWS = 1_000_000


class Algebra(Protocol):
    """What is carried: its beginning, what a run of values does to it, and what it gives for each value."""

    start: object

    def summary(self, values: np.ndarray) -> object: ...

    def after(self, state: object, summary: object) -> object: ...

    def outputs(self, state: object, values: np.ndarray) -> np.ndarray: ...


class Total:
    """The sum of the values so far."""

    start = 0

    def summary(self, values: np.ndarray) -> int:
        return int(values.sum())

    def after(self, state: int, summary: int) -> int:
        return state + summary

    def outputs(self, state: int, values: np.ndarray) -> np.ndarray:
        return state + np.cumsum(values)


class Spaced:
    """Start times at least so far apart, none before its value."""

    start = None

    def __init__(self, seconds: float) -> None:
        self.seconds = seconds

    def summary(self, values: np.ndarray) -> list[float]:
        """The last start if nothing comes before, and how much later than a start before it the last one is at least."""
        return [float(self.outputs(None, values)[-1]), self.seconds * len(values)]

    def after(self, state: float | None, summary: list[float]) -> float:
        return summary[0] if state is None else max(summary[0], state + summary[1])

    def outputs(self, state: float | None, values: np.ndarray) -> np.ndarray:
        steps = self.seconds * np.arange(len(values))
        starts = np.maximum.accumulate(values - steps) + steps
        return starts if state is None else np.maximum(starts, state + self.seconds + steps)


class Packs:
    """Numbers of packs: a pack is closed when the next size doesn't fit into what is left of the limit."""

    start = (0, 1)

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def _chain(self, total: np.ndarray, at: int, ends: dict[int, tuple[int, int]]) -> tuple[int, int]:
        """(what the open pack holds at the end, packs opened) if a pack is opened at a value; kept, as chains soon meet."""
        path = []
        n = len(total) - 1
        while at < n and at not in ends:
            path.append(at)
            first = int(np.searchsorted(total, total[at], "right"))  # one size above zero is always taken
            at = min(n, max(first, int(np.searchsorted(total, total[at] + self.limit, "right")) - 1))
        fill, opened = ends[at] if at < n else (0, 0)
        for i in reversed(path):
            if at >= n:
                fill, at = int(total[n] - total[i]), i
            opened += 1
            ends[i] = fill, opened
        return ends[path[0]] if path else (fill, opened)

    def summary(self, values: np.ndarray) -> dict:
        """What comes out for each amount that may be in the open pack: [from, held at the end, packs opened], by from; None adds the sum."""
        total, ends = np.concatenate([[0], np.cumsum(values)]), {}
        held, opened = self._chain(total, 0, ends)
        out = [[0, held, opened - 1]]
        steps: list[list] = []
        last = int(np.searchsorted(total, self.limit, "right")) - 1  # so many values may go into a pack that holds something
        for e in range(min(last, len(values) - 1), -1, -1):
            low = max(1, self.limit - int(total[e + 1]) + 1)
            held, opened = self._chain(total, e, ends)
            if steps and steps[-1][1:] == [held, opened]:
                continue
            steps.append([low, held, opened])
        if steps and steps[0][0] > 1 or not steps:
            steps.insert(0, [1, None, 0])
        return {"empty": out[0][1:], "steps": steps, "sum": int(total[-1])}

    def after(self, state: tuple[int, int], summary: dict) -> tuple[int, int]:
        held, number = state
        if held == 0:
            return summary["empty"][0], number + summary["empty"][1]
        fill, opened = next((f, o) for low, f, o in reversed(summary["steps"]) if low <= held)
        return (held + summary["sum"] if fill is None else fill), number + opened

    def outputs(self, state: tuple[int, int], values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        out, n = np.empty(len(values), np.int64), len(values)
        held, number = state
        at = 0
        if held:
            at = max(0, int(np.searchsorted(total, self.limit - held, "right")) - 1)
            out[:at] = number
            number += 1
        while at < n:
            first = int(np.searchsorted(total, total[at], "right"))
            to = min(n, max(first, int(np.searchsorted(total, total[at] + self.limit, "right")) - 1))
            out[at:to] = number
            at, number = to, number + 1
        return out


def ranged(df: DataFrame, by: list, rows: int = ROWS) -> DataFrame:
    """The rows in sorted ranges with their block's number, written once; keys that are all equal stay in one range."""
    blocks = max(1, -(-df.count() // rows))
    return stored(df.repartitionByRange(blocks, *by).sortWithinPartitions(*by).withColumn("__block", F.spark_partition_id()))


def _runs(batches: Iterator[pa.RecordBatch], group: str, value: str) -> Iterator[tuple[int, object, np.ndarray, pa.Table]]:
    """(block, group, values, rows) of each group of a range, in order."""
    held: list[pa.RecordBatch] = []
    name: object = None
    for batch in batches:
        names = batch.column(group).to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and names[a] != name:
                yield _whole(held, name, value)
                held = []
            name = names[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield _whole(held, name, value)


def _whole(parts: list[pa.RecordBatch], name: object, value: str) -> tuple[int, object, np.ndarray, pa.Table]:
    rows = pa.Table.from_batches(parts)
    return rows.column("__block")[0].as_py(), name, rows.column(value).to_numpy(), rows


def carried(df: DataFrame, group: str, order: list[str], value: str, algebra: Algebra, out: str, kind: str, rows: int = ROWS) -> DataFrame:
    """df with out: what the algebra gives for each value along the order within its group; values must not be null."""
    table = ranged(df, [group, *order], rows)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for block, name, values, _ in _runs(batches, group, value):
            made = (block, len(found), json.dumps(algebra.summary(values)), name)
            found = [*found[:1], made]  # a group between the first and the last one of a range is whole
        if found:
            yield pa.RecordBatch.from_pydict({"block": pa.array([f[0] for f in found], pa.int32()), "place": pa.array(range(len(found)), pa.int32()), "summary": [f[2] for f in found], "name": pa.array([f[3] for f in found], to_arrow_schema(names)[0].type)})

    names = T.StructType([T.StructField("name", table.schema[group].dataType)])
    schema = T.StructType.fromDDL("block int, place int, summary string").add(names[0])
    entries: dict[int, object] = {}
    last, state = object(), algebra.start
    for row in table.select(group, value, "__block").mapInArrow(ends, schema).orderBy("block", "place").collect():
        if row["name"] != last:
            state = algebra.start
        elif row["place"] == 0:
            entries[row["block"]] = state
        last, state = row["name"], algebra.after(state, json.loads(row["summary"]))
    sent = df.sparkSession.sparkContext.broadcast(entries)
    fields = T.StructType([*(f for f in table.schema if f.name != "__block"), T.StructField(out, T.StructType.fromDDL(f"x {kind}")[0].dataType)])
    arrow = to_arrow_schema(fields)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for block, _, values, found in _runs(batches, group, value):
            state = sent.value.get(block, algebra.start) if first else algebra.start
            first = False
            given = found.drop_columns(["__block"]).append_column(out, pa.array(algebra.outputs(state, values), arrow.field(out).type))
            yield from given.cast(arrow).to_batches(max_chunksize=100_000)

    return table.mapInArrow(give, fields)


def streamed(df: DataFrame, group: str, order: list[str], columns: list[str], start: Callable[[], Callable[..., list[tuple]]], schema: str) -> DataFrame:
    """For what has no short summary: each group's rows one after the other through a kernel of its own; a group is in one task, but never in its memory."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kernel = object(), None
        for batch in batches:
            out: list[tuple] = []
            for name, *values in zip(*(batch.column(c).to_pylist() for c in [group, *columns])):
                if name != last:
                    last, kernel = name, start()
                out += [(name, *x) for x in kernel(*values)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return df.repartition(group).sortWithinPartitions(group, *order).mapInArrow(run, fields)


def packs(texts: DataFrame, group: str, order: list[str], words: str, limit: int, rows: int = ROWS) -> DataFrame:
    """Greedy packs of whole texts by group: a pack is closed when the next text doesn't fit. texts with pack."""
    return carried(texts.withColumn(words, F.col(words).cast("long")), group, order, words, Packs(limit), "pack", "bigint", rows)


def split_packs(texts: DataFrame, group: str, order: list[str], name: str, header: str, words: str, limit: int) -> DataFrame:
    """(group, pack, name, words): packs in which a text that doesn't fit is cut; each piece has the text's header again."""
    kind = dict(texts.dtypes)

    def start() -> Callable[..., list[tuple]]:
        pack, fill = 1, 0

        def kernel(who: object, head: int, left: int) -> list[tuple]:
            nonlocal pack, fill
            if head >= limit:
                raise ValueError(f"header of {who} fills a pack")
            out = []
            while left > 0:
                if fill + head >= limit:
                    pack, fill = pack + 1, 0
                taken = min(limit - fill - head, left)
                out.append((pack, who, taken))
                fill, left = fill + head + taken, left - taken
            return out

        return kernel

    return streamed(texts, group, order, [name, header, words], start, f"`{group}` {kind[group]}, pack bigint, `{name}` {kind[name]}, words bigint")


def runs(df: DataFrame, key: str, order: list[str], hit: str, rows: int = ROWS) -> DataFrame:
    """(key, island, length): lengths of runs of hits on end for each key; an island is numbered by the misses before it."""
    marked = df.select(key, *order, (1 - F.coalesce(F.col(hit).cast("int"), F.lit(0))).cast("long").alias("__miss"))
    islands = carried(marked, key, order, "__miss", Total(), "island", "bigint", rows)
    return islands.where("__miss = 0").groupBy(key, "island").agg(F.count("*").alias("length"))


def paced(events: DataFrame, group: str, order: list[str], time: str, seconds: float, rows: int = ROWS) -> DataFrame:
    """events with start: when each call may start if a group's calls are at least so far apart."""
    return carried(events, group, order, time, Spaced(seconds), "start", "double", rows)


def ranks(df: DataFrame, by: list, out: str = "rank", rows: int = ROWS) -> DataFrame:
    """df with its place from 1 in an order over all rows, without bringing them into one task."""
    table = ranged(df.withColumn("__one", F.lit(1).cast("long")), by, rows)
    sizes = table.groupBy("__block").agg(F.count("*").alias("n")).orderBy("__block").collect()
    before, total = {}, 0
    for r in sizes:
        before[r["__block"]], total = total, total + r["n"]
    sent = df.sparkSession.sparkContext.broadcast(before)
    fields = T.StructType([*(f for f in table.schema if not f.name.startswith("__")), T.StructField(out, T.LongType())])
    arrow = to_arrow_schema(fields)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if batch.num_rows:
                at = sent.value[batch.column("__block")[0].as_py()] if at is None else at
                place = pa.array(np.arange(at + 1, at + 1 + batch.num_rows), pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in arrow.names[:-1]), place], schema=arrow)
                at += batch.num_rows

    return table.mapInArrow(give, fields)
