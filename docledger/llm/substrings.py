"""Remove passages that repeat, by counting windows of words in super-k-mers.

A window is a run of consecutive words, its minimiser the smallest hash among
its short word runs. Neighbouring windows mostly share their minimiser, so they
travel as one packed string to the minimiser's bucket, where the hashes of the
windows are sorted and equal ones counted. Equal windows have equal minimisers
and meet; a bucket and a window hash together are a key of 128 bits.

Most minimisers occur once in the corpus, and none of their windows can repeat.
So narrow rows, minimiser and text, are counted first, and only windows whose
minimiser occurs again are packed. Equal texts are one text with a number of
copies from the start: all their windows repeat. A minimiser with more than
``HOT`` places would fill one bucket. Its strings are first reduced to different
ones with a count, as inside a passage that many texts share most are equal, and
are then cut again by longer minimisers, ``LONGER`` words, which deal them to
many more buckets; strings of buckets that stay crowded are cut by their windows
themselves. Buckets are sorted and counted alike on every level.

Texts are shuffled once; that exchange serves the count, the packing and the
removal, as one plan without a checkpoint between them.

Defined results: a null text has no words and keeps the empty string; a text
shorter than a window keeps all words; repeated rows each get the result of
their text, in which every window repeats; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.words import utf8_rows, window_hashes, word_hashes, word_spans

WINDOW = 35
SEED_WORDS = 8
HOT = 5_000  # strings in a bucket: under two megabytes
LONGER = 20  # words of a second minimiser
MOST_WINDOWS = 512
_BLANK = np.uint8(0x20)


def minimisers(words: np.ndarray, window: int, seed_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of every window, and the hashes of all short runs it is the least of."""
    seeds = window_hashes(words, seed_words)
    span, n = window - seed_words + 1, len(words) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), seeds
    blocks = -(-len(seeds) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(seeds)] = seeds
    square = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]), seeds


def _runs(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window of each run of one minimiser, and the window after its last; long runs are cut."""
    fresh = np.concatenate(([True], least[1:] != least[:-1]))
    first = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    fresh |= (np.arange(len(least)) - first[run]) % MOST_WINDOWS == 0
    first = np.flatnonzero(fresh)
    return first, np.concatenate((first[1:], [len(least)]))


def _places(window: int, seed_words: int):
    """Per text its minimisers, each with the number of places its words are at."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("t").to_numpy()
            texts, keys, places = [], [], []
            for t, data in zip(ids, utf8_rows(batch.column("text")), strict=True):
                least, seeds = minimisers(word_hashes(data)[2], window, seed_words)
                if not len(least):
                    continue
                chosen = np.unique(least)
                seeds = np.sort(seeds)
                count = np.searchsorted(seeds, chosen, "right") - np.searchsorted(seeds, chosen, "left")
                keys.append(chosen.view(np.int64))
                places.append(count)
                texts.append(np.full(len(chosen), t))
            if keys:
                yield pa.RecordBatch.from_pydict(
                    {"key": np.concatenate(keys), "t": np.concatenate(texts), "places": np.concatenate(places).astype(np.int64)}
                )

    return place


def _normal(data: np.ndarray) -> np.ndarray:
    """The words of a text joined by one space each, as bytes."""
    starts, ends = word_spans(data)
    if not len(starts):
        return data[:0]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    keep = np.cumsum(inside[:-1]).astype(bool)
    keep[ends[:-1]] = True
    out = data.copy()
    out[ends[:-1]] = _BLANK
    return out[keep]


def _packed(window: int, seed_words: int):
    """Super-k-mers of the asked minimisers: key, t, first window, words with a blank after each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column("t").to_numpy(), batch.column("cold")
            out = {name: [] for name in ("key", "t", "first", "words")}
            for row, data in enumerate(utf8_rows(batch.column("text"))):
                wanted = asked[row].values
                if wanted is None or not len(wanted):
                    continue
                data = _normal(data)
                starts, ends, words = word_hashes(data)
                least, _ = minimisers(words, window, seed_words)
                first, after = _runs(least)
                among = np.flatnonzero(np.isin(least[first].view(np.int64), wanted.to_numpy()))
                whole = data.tobytes() + b" "
                for at in among:
                    a, b = first[at], after[at]
                    out["words"].append(whole[starts[a] : ends[b + window - 2] + 1])
                out["key"].append(least[first[among]].view(np.int64))
                out["t"].append(np.full(len(among), ids[row]))
                out["first"].append(first[among].astype(np.int32))
            if out["key"]:
                yield pa.RecordBatch.from_pydict(
                    {name: np.concatenate(out[name]) for name in ("key", "t", "first")} | {"words": pa.array(out["words"], pa.binary())}
                )

    return pack


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def _strings(data: np.ndarray, window: int, seed_words: int, wanted: np.ndarray | None):
    """Super-k-mers of a text, those of the ``wanted`` minimisers: minimiser, first window, words."""
    starts, ends, words = word_hashes(data)
    least, _ = minimisers(words, window, seed_words)
    if not len(least):
        return
    first, after = _runs(least)
    keys = least[first].view(np.int64)
    whole = data.tobytes() + b" "
    for at in range(len(first)) if wanted is None else np.flatnonzero(np.isin(keys, wanted)).tolist():
        a, b = int(first[at]), int(after[at])
        yield int(keys[at]), a, whole[starts[a] : ends[b + window - 2] + 1]


def _hot_strings(window: int, seed_words: int):
    """Super-k-mers of the hot minimisers: run (a digest of the words), t, first window, words."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column("t").to_pylist(), batch.column("hot")
            rows = [
                (_digest(words), t, first, words)
                for row, (t, data) in enumerate(zip(ids, utf8_rows(batch.column("text")), strict=True))
                for _, first, words in _strings(_normal(data), window, seed_words, asked[row].values.to_numpy())
            ]
            run, t, first, words = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_pydict(
                {
                    "run": pa.array(run, pa.binary()), "t": pa.array(t, pa.int64()), "first": pa.array(first, pa.int32()),
                    "words": pa.array(words, pa.binary()),
                }
            )

    return strings


def _parts(window: int, seed_words: int):
    """Strings cut by longer minimisers: run, offset of the part in it, key, part (a digest), n, words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (run, first, key, _digest(words), n, words)
                for run, n, string in zip(*[batch.column(c).to_pylist() for c in ("run", "n", "words")], strict=True)
                for key, first, words in _strings(np.frombuffer(string, dtype=np.uint8)[:-1], window, seed_words, None)
            ]
            run, offset, key, part, n, words = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_pydict(
                {
                    "run": pa.array(run, pa.binary()), "offset": pa.array(offset, pa.int32()), "key": pa.array(key, pa.int64()),
                    "part": pa.array(part, pa.binary()), "n": pa.array(n, pa.int64()), "words": pa.array(words, pa.binary()),
                }
            )

    return cut


def _marks_of(strings: DataFrame, window: int, seeds: tuple[int, ...], hot: int) -> DataFrame:
    """run, first, end: stretches of repeated windows in strings that are there ``n`` times each.

    Strings are cut by minimisers of the first of ``seeds``, equal parts become
    one with their count, and the parts of a bucket are sorted and counted; those
    of crowded buckets are cut by the next of ``seeds``.
    """
    parts = strings.mapInArrow(
        _parts(window, seeds[0]), "run binary, offset int, key long, part binary, n long, words binary"
    )
    different = (
        parts.groupBy("key", "part").agg(F.first("words").alias("words"), F.sum("n").alias("n")).withColumnRenamed("part", "run")
    )
    calm, found = different, None
    if len(seeds) > 1:
        crowded = different.groupBy("key").count().where(F.col("count") > hot).select(F.col("key").alias("key__"))
        full = different["key"].eqNullSafe(crowded["key__"])
        calm = different.join(crowded, full, "left_anti")
        found = _marks_of(different.join(crowded, full, "left_semi"), window, seeds[1:], hot)
    counted = (
        calm.withColumn("first", F.lit(0)).repartition("key").sortWithinPartitions("key")
        .mapInArrow(_counted(window, "run"), "run binary, first int, end int")
    )
    found = counted if found is None else counted.unionByName(found)
    listed = found.groupBy("run").agg(F.collect_list(F.struct("first", "end")).alias("marks")).withColumnRenamed("run", "part")
    placed = _matched(parts.select("run", "offset", "part"), listed, "part").select("run", "offset", F.explode("marks").alias("m"))
    moved = [(F.col("offset") + F.col("m")[c]).alias(c) for c in ("first", "end")]
    return placed.select("run", *moved)


def _counted(window: int, name: str = "t", at_once: int = 4_000):
    """Runs of repeated windows from rows sorted by bucket: the row's name, first and end in words.

    A row counts as often as its ``n`` says, once without one.
    """

    def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                held.append(part)
                rows += part.num_rows
                keys = np.concatenate([h.column("key").to_numpy() for h in held])
                edge = np.flatnonzero(keys[1:] != keys[:-1])
                if rows >= at_once and len(edge):
                    table = pa.Table.from_batches(held)
                    cut = int(edge[-1]) + 1
                    yield table.slice(0, cut)
                    held = table.slice(cut).combine_chunks().to_batches()
                    rows -= cut
        if rows:
            yield pa.Table.from_batches(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            keys, firsts = (table[c].to_numpy() for c in ("key", "first"))
            times = table["n"].to_numpy() if "n" in table.column_names else np.ones(len(keys), dtype=np.int64)
            packed = table["words"].combine_chunks()
            packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
            offsets = np.frombuffer(packed.buffers()[1], dtype=np.int32)[packed.offset : packed.offset + len(packed) + 1]
            data = np.frombuffer(packed.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
            starts, _, words = word_hashes(data)
            of = np.searchsorted(offsets - offsets[0], starts, "right") - 1  # the string of each word
            every = window_hashes(words, window)
            whole = of[: len(every)] == of[window - 1 :]
            at = np.flatnonzero(whole)
            every, row = every[at], of[at]
            place = at - np.searchsorted(of, np.arange(len(keys)))[row]
            order = np.lexsort((every, keys[row]))
            same = np.concatenate(([False], (every[order][1:] == every[order][:-1]) & (keys[row][order][1:] == keys[row][order][:-1])))
            group = np.cumsum(~same) - 1
            total = np.bincount(group, weights=times[row][order])
            repeated = np.zeros(len(every), dtype=bool)
            repeated[order] = total[group] >= 2
            at = np.flatnonzero(repeated)
            if not len(at):
                continue
            starts = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (row[at][1:] != row[at][:-1])))
            a = at[starts]
            b = at[np.concatenate((starts[1:], [True]))]
            yield pa.RecordBatch.from_pydict(
                {
                    name: table[name].combine_chunks().take(pa.array(row[a])),
                    "first": (firsts[row[a]] + place[a]).astype(np.int32),
                    "end": (firsts[row[b]] + place[b] + window).astype(np.int32),
                }
            )

    return count


def _removed(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for row, data in enumerate(utf8_rows(batch.column("text"))):
                data = _normal(data)
                starts, ends = word_spans(data)
                n = len(starts)
                change = np.zeros(n + 1, dtype=np.int32)
                if copies[row] > 1 and n >= window:
                    change[0] = 1
                else:
                    marks = batch.column("marks")[row].values
                    if marks is not None and len(marks):
                        np.add.at(change, marks.field("first").to_numpy(), 1)
                        np.add.at(change, marks.field("end").to_numpy(), -1)
                gone = np.cumsum(change[:n]) > 0
                if gone.any():
                    whole = data.tobytes()
                    kept = ~gone
                    edge = np.diff(np.concatenate(([0], kept.view(np.int8), [0])))
                    parts = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
                    kept_text = b" ".join([whole[starts[a] : ends[b - 1]] for a, b in parts])
                else:
                    kept_text = data.tobytes()
                n_words.append(n)
                n_removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept_text).hexdigest())
                kept_texts.append(kept_text)
            yield pa.RecordBatch.from_pydict(
                {
                    "t": batch.column("t"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept_texts, pa.binary()).cast(pa.string()),
                }
            )

    return remove


def _matched(rows: DataFrame, unique: DataFrame, *on: str) -> DataFrame:
    """Rows with the columns of the one row that has their key.

    Null-safe equality gives both sides an exchange of their own, so adaptive
    execution can split a key that very many rows have.
    """
    side = unique.withColumnsRenamed({c: f"{c}__" for c in on})
    both = reduce(and_, [rows[c].eqNullSafe(side[f"{c}__"]) for c in on])
    return rows.join(side, both).drop(*[f"{c}__" for c in on])


def without_repeats(
    docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS, hot: int = HOT, with_text: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept) of every row.

    A word goes if a window of ``window`` words over it also starts anywhere else.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t"))
    check = F.xxhash64(F.lit(1), F.col("text"))
    clash = F.assert_true(F.min(check) == F.max(check), "two texts have one digest")
    texts = (
        rows.select("t", "text").groupBy("t")
        .agg(F.min("text").alias("text"), F.count("*").alias("copies"), clash.alias("sound"))
        .select("t", "text", "copies", "sound")
    )
    placed = texts.mapInArrow(_places(window, seed_words), "key long, t long, places long")
    totals = placed.groupBy("key").agg(F.sum("places").alias("total"), F.count("*").alias("texts")).where(F.col("total") > 1)
    met = _matched(placed.select("key", "t"), totals.select("key", "total"), "key")
    asked = met.groupBy("t").agg(
        F.collect_list(F.when(F.col("total") <= hot, F.col("key"))).alias("cold"),
        F.collect_list(F.when(F.col("total") > hot, F.col("key"))).alias("hot"),
    )
    wanted = texts.join(asked, "t")
    packed = wanted.where(F.size("cold") > 0).mapInArrow(_packed(window, seed_words), "key long, t long, first int, words binary")
    cold = packed.repartition("key").sortWithinPartitions("key").mapInArrow(
        _counted(window), "t long, first int, end int"
    )
    strings = wanted.where(F.size("hot") > 0).mapInArrow(
        _hot_strings(window, seed_words), "run binary, t long, first int, words binary"
    )
    different = strings.groupBy("run").agg(F.first("words").alias("words"), F.count("*").alias("n"))
    repeated = _marks_of(different, window, (min(LONGER, window), window), hot)
    again = repeated.groupBy("run").agg(F.collect_list(F.struct("first", "end")).alias("marks"))
    begin = lambda mark, c: (F.col("first") + mark[c]).alias(c)
    warm = _matched(strings.select("run", "t", "first"), again, "run").select(
        "t", F.transform("marks", lambda m: F.struct(begin(m, "first"), begin(m, "end"))).alias("marks")
    )
    marks = (
        cold.select("t", F.array(F.struct("first", "end")).alias("marks")).unionByName(warm)
        .groupBy("t").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    )
    removed = texts.join(marks, "t", "left").mapInArrow(
        _removed(window), "t long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    columns = ["n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    return rows.select("doc_id", "t").join(removed.select("t", *columns), "t").select("doc_id", *columns)
