"""Exact dedup by recipes of content-defined chunks.

A text is cut where a rolling hash of its last bytes says so, so equal passages
are cut alike wherever they stand. Every chunk gets a digest, and the digest is
verified: chunks meet by digest, once, and are compared byte by byte. Should two
contents share a digest, that numbering is refused and another seed is taken, so
a verified digest is an identifier. A text's recipe is the ordered list of its
chunks' identifiers; equal texts have equal recipes and different texts have
different ones. From there on only recipes and ids move, 16 bytes for about
``AVERAGE`` bytes of text; the text itself moved once, as chunks, and a chunk
that a task has sent is not sent again while the task remembers it.

Defined results: a null text is an empty one, whose recipe is empty; of equal
texts the row with the largest id stays, a null id is the smallest; of repeated
rows with that id one stays; an empty table gives no rows; further columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm.words import mixed, written
from docledger.session import checkpoint

WINDOW = 32  # bytes that decide a cut
LEAST, AVERAGE, MOST = 512, 2_048, 16_384  # bytes of a chunk
DIGEST_BYTES = 16
SEGMENT = 1 << 20  # bytes hashed at once
SENT_BYTES = 16 << 20  # chunks a task remembers having sent
OUT_BYTES = 4 << 20  # chunks handed over at once
TRIES = 8

_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def strong_digest(chunk, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def cut_hints(data: np.ndarray, average: int = AVERAGE) -> list[int]:
    """Places after which the last ``WINDOW`` bytes allow a cut, ascending.

    The hash of a window is the sum of its bytes' random numbers, each shifted
    by its distance, and is built by doubling, so a segment costs ten passes.
    """
    bits = max(1, average.bit_length() - 1)
    found: list[int] = []
    for start in range(0, len(data), SEGMENT):
        before = min(start, WINDOW - 1)
        sums = _GEAR[data[start - before : start + SEGMENT]]
        shift = 1
        while shift < WINDOW:
            sums[shift:] += sums[:-shift] << np.uint32(shift)
            shift *= 2
        found += (np.flatnonzero(sums[before:] >> np.uint32(32 - bits) == 0) + (start + 1)).tolist()
    return found


def chunk_ends(hints: list[int], start: int, end: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of the text at [start, end); ``least`` covers the window, so no other text has a say."""
    ends = []
    at = bisect_left(hints, start + least)
    while end - start > least:
        while at < len(hints) and hints[at] < start + least:
            at += 1
        cut = min(hints[at] if at < len(hints) else end, start + most, end)
        ends.append(cut)
        start = cut
    if end > start:
        ends.append(end)
    return ends


def _texts(column) -> tuple[np.ndarray, list[int]]:
    """All bytes of an Arrow string column without nulls, not copied, and where its texts begin and end."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return every[at[0] : at[-1]], (at - at[0]).tolist()


def _chunked(batches: Iterator[pa.RecordBatch], sizes: tuple[int, int, int]):
    """Per batch its bytes and, per text, start, end and the ends of its chunks."""
    least, average, most = sizes
    for batch in batches:
        if not len(batch):
            continue
        data, at = _texts(batch.column("text"))
        hints = cut_hints(data, average)
        yield batch, data, [(a, b, chunk_ends(hints, a, b, least, most)) for a, b in zip(at, at[1:], strict=False)]


def _recipe_rows(digest: Callable, seed: int, sizes: tuple[int, int, int]):
    def recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, cut in _chunked(batches, sizes):
            lists, hashes = [], []
            for start, end, ends in cut:
                hashes.append(hashlib.sha256(data[start:end]).hexdigest())
                lists.append(b"".join([digest(data[a:b], seed) for a, b in zip([start, *ends], ends, strict=False)]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "recipe": pa.array(lists, pa.binary()),
                    "text_sha256": pa.array(hashes, pa.string()),
                }
            )

    return recipes


def _chunk_rows(digest: Callable, seed: int, sizes: tuple[int, int, int]):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        remembered = 0
        out: list[bytes] = []
        held = 0
        for _, data, cut in _chunked(batches, sizes):
            for start, _, ends in cut:
                for a, b in zip([start, *ends], ends, strict=False):
                    chunk = data[a:b].tobytes()
                    if chunk in sent:
                        continue
                    if remembered > SENT_BYTES:
                        sent, remembered = set(), 0
                    sent.add(chunk)
                    remembered += len(chunk)
                    out.append(chunk)
                    held += len(chunk)
                    if held > OUT_BYTES:
                        yield _chunk_batch(out, digest, seed)
                        out, held = [], 0
        if out:
            yield _chunk_batch(out, digest, seed)

    return chunks


def _chunk_batch(chunks: list[bytes], digest: Callable, seed: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"digest": pa.array([digest(c, seed) for c in chunks], pa.binary()), "chunk": pa.array(chunks, pa.binary())}
    )


def distinct_chunks(told: DataFrame, digest: Callable, seed: int, sizes: tuple[int, int, int]) -> DataFrame:
    """digest and chunk, every different pair once: the store that recipes refer to."""
    return told.select("text").mapInArrow(_chunk_rows(digest, seed, sizes), "digest binary, chunk binary").distinct()


def _verified(chunks: DataFrame) -> bool:
    """Whether no digest stands for two contents."""
    return chunks.groupBy("digest").count().where(F.col("count") > 1).isEmpty()


def chunk_recipes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    sizes: tuple[int, int, int] = (LEAST, AVERAGE, MOST),
    digest: Callable[..., bytes] = strong_digest,
    seed: int = 0,
) -> DataFrame:
    """doc_id, recipe, text_sha256 and row of every document, as a table in the shared folder.

    ``recipe`` holds the verified identifiers of the chunks, in order, packed.
    ``sizes`` are the least, average and most bytes of a chunk, the average a
    power of two and the least not below the window.
    """
    if sizes[0] < WINDOW:
        raise ValueError(f"chunks of less than {WINDOW} bytes would depend on the text before them")
    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    told = docs.select(docs[f"`{id_col}`"].alias("doc_id"), (normalise(text) if normalise else text).alias("text"))
    for attempt in range(seed, seed + TRIES):
        if _verified(distinct_chunks(told, digest, attempt, sizes)):
            break
    else:
        raise ValueError(f"chunks with equal digests under {TRIES} seeds")
    kind = told.schema["doc_id"].dataType.simpleString()
    recipes = told.mapInArrow(_recipe_rows(digest, attempt, sizes), f"doc_id {kind}, recipe binary, text_sha256 string")
    return written(recipes.withColumn("row", F.monotonically_increasing_id()), "recipes")


def equal_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    sizes: tuple[int, int, int] = (LEAST, AVERAGE, MOST),
    digest: Callable[..., bytes] = strong_digest,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Groups are summed before their shuffle. Rows then meet their group in a join
    that adaptive execution splits where copies fill a partition.
    """
    recipes = chunk_recipes(docs, id_col, text_col, normalise, sizes, digest)
    groups = checkpoint(
        recipes.groupBy("recipe").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("best")
        )
    )
    return recipes.join(groups, "recipe").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        "text_sha256",
    )
