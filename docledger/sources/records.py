"""Records of delimited files whose quoted cells may hold line breaks, read by byte ranges.

Whether a line break ends a record depends on all quotes before it, so Spark reads
such a file in one task. Here every range of a file is read by its own task:

1. A narrow pass over the lines that hold quotes tells what each range does to
   the state "inside a quoted cell": where it leaves a reader that enters it
   outside, and one that enters it inside. The first pass needs neither order
   between ranges nor their text.
2. Ranges of a file are put together in order, by a window over one row per
   range, which gives every range the state it begins in.
3. Each range then cuts its own lines into records. A record that crosses the
   end of its range leaves a piece in every range that it touches; the pieces,
   two a range at most, are put together by place.

Ranges may be cut anew between the passes, when executors come or go. A range
with quotes that the first pass has not seen is an error, never a wrong state.

A quote opens a cell at its beginning only, a doubled one inside is a quote, and
what follows a closing one up to the separator belongs to the cell. A record
ends in a line feed, with or without a carriage return before it; line breaks in
cells stay as the file has them.
"""

from __future__ import annotations

import csv
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
HEADER_LINES = (1, 64, 4_096)
READERS = 8
WHOLE, HEAD, TAIL, MIDDLE = range(4)
PIECES = "text string, path string, start long, kind int"

# Per file the starts of its ranges with quotes and the state after each.
States = Mapping[str, tuple[list[int], list[bool]]]


class Quoting:
    """What a line does to the state of its reader, for one separator."""

    def __init__(self, sep: str):
        self.sep = sep
        gap = re.escape(sep)
        self._closed = re.compile(rf'(?:(?<=^)|(?<={gap}))"(?:[^"]|"")*+"')
        self._opens = re.compile(rf'(?:^|{gap})"')
        self._end = re.compile(r'(?:[^"]|"")*+"')

    def after(self, line: str, inside: bool) -> bool:
        """Whether the line ends inside a quoted cell."""
        if inside:
            end = self._end.match(line)
            if end is None:
                return True
            at = line.find(self.sep, end.end())
            if at < 0:
                return False
            line = line[at + len(self.sep) :]
        return self._opens.search(self._closed.sub("", line)) is not None


def lines_of(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, start (of the range that holds the line) and value of every line, in file order within a range."""
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Stretches of lines of one range: path, start, lines."""
    starts = batch.column("start").to_numpy()
    files = pc.dictionary_encode(batch.column("path")).indices.to_numpy()
    edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
    bounds = [0, *edges.tolist(), len(batch)] if len(batch) else []
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield batch.column("path")[a].as_py(), int(starts[a]), batch.column("value").slice(a, b - a)


def _effects(sep: str) -> Callable:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting = Quoting(sep)
        found: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for path, start, lines in _runs(batch):
                outside, inside, broken = found.get((path, start), [False, True, False])
                for line in lines.to_pylist():
                    line = line.removesuffix("\r")
                    same = outside == inside
                    outside = quoting.after(line, outside)
                    inside = outside if same else quoting.after(line, inside)
                    broken |= outside
                found[path, start] = [outside, inside, broken]
        rows = [(p, s, *x) for (p, s), x in found.items()]
        names = ("path", "start", "outside", "inside", "broken")
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return measure


def range_states(lines: DataFrame, sep: str) -> DataFrame:
    """path, start, after, broken: per range with quotes the state it ends in, and
    whether a line of it may end inside a cell.

    A range either leaves every reader in one state, or keeps or turns the state
    it is entered in. The state after a range is that of the last range of the
    first kind, turned as often as ranges of the last kind follow it.
    """
    quoted = lines.where(F.col("value").contains(QUOTE))
    effects = quoted.mapInArrow(_effects(sep), "path string, start long, outside boolean, inside boolean, broken boolean")
    so_far = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.col("outside") == F.col("inside")
    turned = effects.withColumn("turns", F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(so_far))
    base = F.last(F.when(fixed, F.struct(F.col("outside").cast("int").alias("state"), "turns")), ignorenulls=True).over(so_far)
    state = F.coalesce(base["state"], F.lit(0)) + F.col("turns") - F.coalesce(base["turns"], F.lit(0))
    return turned.select("path", "start", (state % 2 == 1).alias("after"), "broken")


def _entered(states: States, path: str, start: int) -> bool:
    starts, after = states.get(path, ([], []))
    at = bisect_left(starts, start)
    return after[at - 1] if at else False


def _cut(states: States, headers: Sequence[str] | None, sep: str, pieces: bool) -> Callable:
    """Whole records of every range, or with ``pieces`` the parts of those that cross its ends."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting = Quoting(sep)
        now: tuple[str, int] | None = None
        inside = first = False
        entered_inside = False  # and no record has ended yet
        pending: list[str] = []

        def rest_of_range() -> Iterator[pa.RecordBatch]:
            if not pending:
                return
            if first and headers is not None:
                raise ValueError(f"the header of {now[0]} does not end in the first range of the file")
            if pieces:
                yield _piece("\n".join(pending), *now, MIDDLE if entered_inside else TAIL)

        for batch in batches:
            for path, start, lines in _runs(batch):
                if (path, start) != now:
                    yield from rest_of_range()
                    now, pending = (path, start), []
                    inside = entered_inside = _entered(states, path, start)
                    first = start == 0
                open_after, inside = _open_after(lines, inside, quoting, states, path, start)
                if pending or entered_inside:
                    closed = np.flatnonzero(~open_after)
                    at = int(closed[0]) + 1 if len(closed) else len(lines)
                    pending += lines.slice(0, at).to_pylist()
                    if not len(closed):
                        continue
                    text, pending = "\n".join(pending), []
                    if entered_inside:
                        entered_inside = False
                        if pieces:
                            yield _piece(text, path, start, HEAD)
                    else:
                        first = yield from _records(pa.array([text]), path, first, headers, sep, pieces)
                    lines, open_after = lines.slice(at), open_after[at:]
                if not len(lines):
                    continue
                begins = np.flatnonzero(np.concatenate(([True], ~open_after[:-1])))
                if open_after[-1]:
                    pending = lines.slice(int(begins[-1])).to_pylist()
                    lines, begins = lines.slice(0, int(begins[-1])), begins[:-1]
                if len(begins) < len(lines):
                    ends = pa.array([*begins.tolist(), len(lines)], pa.int32())
                    lines = pc.binary_join(pa.ListArray.from_arrays(ends, lines), "\n")
                if len(lines):
                    first = yield from _records(lines, path, first, headers, sep, pieces)
        yield from rest_of_range()

    return cut


def _open_after(lines: pa.Array, inside: bool, quoting: Quoting, states: States, path: str, start: int):
    """Per line whether its end is inside a cell, and the state after the last."""
    open_after = np.zeros(len(lines), dtype=bool)
    quoted = np.flatnonzero(pc.match_substring(lines, QUOTE).to_numpy(zero_copy_only=False))
    if len(quoted):
        starts = states.get(path, ([], []))[0]
        at = bisect_left(starts, start)
        if at == len(starts) or starts[at] != start:
            raise RuntimeError(f"the ranges of {path} were cut anew between two passes; read it again")
    begin = 0
    for i in quoted.tolist():
        open_after[begin:i] = inside
        inside = quoting.after(lines[i].as_py().removesuffix("\r"), inside)
        open_after[i] = inside
        begin = i + 1
    open_after[begin:] = inside
    return open_after, inside


def _records(records: pa.Array, path: str, first: bool, headers: Sequence[str] | None, sep: str, checked_only: bool):
    """Hand over records without their carriage return, empty ones and, checked, the file's
    header; whether that is still to come."""
    if pc.any(pc.match_substring(records, "\r")).as_py():
        records = pc.replace_substring_regex(records, "\r\\z", "")
    records = records.filter(pc.not_equal(records, ""))
    if first and not len(records):
        return True
    if first and headers is not None:
        told = header_cells(records[0].as_py(), sep)
        if told != list(headers):
            raise ValueError(f"{path} has the header {told}, expected {list(headers)}")
        records = records.slice(1)
    if len(records) and not checked_only:
        n = len(records)
        yield pa.RecordBatch.from_pydict(
            {
                "text": records,
                "path": pa.nulls(n, pa.string()),
                "start": pa.nulls(n, pa.int64()),
                "kind": pa.array(np.zeros(n, dtype=np.int32)),
            }
        )
    return False


def _piece(text: str, path: str, start: int, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "text": pa.array([text], pa.string()),
            "path": pa.array([path], pa.string()),
            "start": pa.array([start], pa.int64()),
            "kind": pa.array([kind], pa.int32()),
        }
    )


def header_cells(record: str, sep: str = ",") -> list[str]:
    return next(csv.reader([record.removeprefix("﻿")], delimiter=sep), [])


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross the ends of ranges, from their pieces in order of place."""
    in_order = Window.partitionBy("path").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "text")))
    joined = numbered.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return joined.select(F.regexp_replace("text", r"\r\z", "").alias("text"))


def line_use(lines: DataFrame, sep: str) -> tuple[bool, bool]:
    """Whether any line holds a quote, and whether every line is a whole record to a reader of lines; one scan.

    It is one if its quotes are doubled or enclose whole cells. Lines with a carriage return before
    their end, or of white space alone in a file with quotes, are no such records.
    """
    value, gap = F.col("value"), re.escape(sep)
    enclosed = rf"(?<=\A|{gap})\"[^\"]*\"(?={gap}|\r?\z)"
    single = F.regexp_replace(F.replace(value, F.lit(QUOTE * 2), F.lit("")), enclosed, "").contains(QUOTE)
    found = lines.agg(
        F.max(value.contains(QUOTE)).alias("quoted"),
        F.max(value.contains(QUOTE) & single).alias("open"),
        F.max((value < "!") & value.rlike(r"\A(?!\r?\z)[\x00-\x20]+\z")).alias("blank"),
        F.max(value.contains("\r") & value.rlike(r"\r(?!\z)")).alias("bare"),
    ).first()
    quoted = bool(found["quoted"])
    return quoted, not (found["bare"] or found["open"] or quoted and found["blank"])


def records_of(lines: DataFrame, sep: str, headers: Sequence[str] | None) -> DataFrame:
    """text of every record but the headers, which must be the given ones; without ``headers`` all records.

    The states of ranges come to the driver, a row per range, as the ranges themselves do.
    """
    states: dict[str, tuple[list[int], list[bool]]] = defaultdict(lambda: ([], []))
    for row in sorted(range_states(lines, sep).select("path", "start", "after").collect()):
        states[row["path"]][0].append(row["start"])
        states[row["path"]][1].append(row["after"])
    told = dict(states)
    whole = lines.mapInArrow(_cut(told, headers, sep, pieces=False), PIECES).select("text")
    if not any(any(after) for _, after in told.values()):
        return whole
    return whole.unionByName(_joined(lines.mapInArrow(_cut(told, headers, sep, pieces=True), PIECES)))


def first_records(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[str, str]:
    """The first record of every file by path, its header as a rule; a file without lines has "".

    One small task a file opens it, reads a line and stops, or a few more where
    the record's quotes are still open, so files of any size cost the same.
    """
    quoting = Quoting(sep)

    def first(path: str) -> str:
        for most in HEADER_LINES:
            found = lines_of(spark, path).where("start = 0").limit(most).collect()
            lines = [r["value"].removesuffix("\r") for r in found]
            inside = False
            for i, line in enumerate(lines):
                inside = quoting.after(line.removeprefix("﻿") if not i else line, inside)
                if not inside and any(lines[: i + 1]):
                    return "\n".join(lines[: i + 1]).lstrip("\n")
            if len(lines) < most:
                return "\n".join(lines)
        raise ValueError(f"the first record of {path} does not end within {most} lines")

    with ThreadPoolExecutor(READERS) as pool:
        return dict(zip(paths, pool.map(first, paths), strict=True))
