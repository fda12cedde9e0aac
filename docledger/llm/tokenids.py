"""Token ids on disk: blocks of separately compressed documents with one shared dictionary.

A zstandard dictionary is trained on the serialized ids of a bounded sample of
documents. Every document's ids are compressed by themselves with it, so a short
document is read by itself at the ratio of its neighbours. File format, all
Parquet tables in one folder that Spark can write anywhere:

``blocks``  shard, block, dict_sha256, first_id, last_id, entries, payload: the
            frames of consecutive documents, at most about ``BLOCK_BYTES`` of
            them; entries is the offset index, per document doc_id, offset and
            length of the frame, n_tokens, and its start within the shard.
``shards``  shard, n_tokens and start: ids in all shards before it.
``header``  dict_sha256, dictionary, width (bytes an id), end_id, tokenizer_sha256.

Documents are laid out by ranges of their id, so shards and their documents
ascend; the sum over shards, a row each, gives every shard its start.

A text is encoded in pieces: a blank between two characters that are no white
space always begins a new pre-token, so pieces cut there have the same ids alone
as in the text. Pieces recur, so the ids of those met before are kept in a
bounded table. Letters alone are one pre-token, so such a piece goes to the
tokenizer's model without its patterns.

Defined results: null and empty texts hold the end id alone; null ids come
first; rows with equal ids go by a hash of the text, repeated rows are written each; an empty
table gives an empty file; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.llm.words import hand_back, kept_between_tasks

END_ID = 2
BLOCK_BYTES = 1 << 20
SAMPLE_DOCUMENTS = 1_000
SAMPLE_BYTES = 8_192  # of a sampled document's ids, for the dictionary alone
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
KNOWN_PIECES = 200_000  # twice that in memory, which idle workers keep
ONCE_PIECES = 400_000  # met once since the table was full
PIECE_BYTES = 64  # longer pieces are not kept
TEXT_BYTES = 1 << 20  # of the texts whose pieces are numbered together, or one longer text
PIECES_A_LINE = 64

_ENTRY = "struct<doc_id:{kind},offset:int,length:int,n_tokens:bigint,start:bigint>"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_OTHER_WHITE = [c for c in _WHITE if c.isascii() and c != " "]
_LETTER = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"  # letters in every version of Unicode's tables since 5.0
# A letter or digit, then other signs up to the piece's end: these are a pre-token of their own.
_MARKED = rf"([0-9{_LETTER}])([!-/:-@\[-`{{-~]+(?:\x00|$))"
_LETTERS = rf"\A ?[{_LETTER}]+\z"
_SOLID = r"\A ?[^" + "".join(f"\\x{{{ord(c):X}}}" for c in _WHITE) + r"]+\z"
_WIDE_WHITE = [c for c in _WHITE if not c.isascii()]
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}
_ENCODERS: dict[str, PieceEncoder] = kept_between_tasks({})


class PieceEncoder:
    """Ids of whole texts as little-endian unsigned numbers of ``width`` bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = id_width(self.tokenizer)
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = line_break[0] if len(line_break) == 1 else -1
        self.code = "H" if self.width == 2 else "I"
        self.empty = self.known = self.older = self.once = _Pieces.empty(self.kind)
        letters = any(t.strip().isalpha() for t in self.special)
        self.bare = None if letters or not _splits_letters(self.tokenizer) else self.tokenizer.model

    def cut(self, text: str) -> str | None:
        """The text with a zero before each further piece; none if it has to stay whole."""
        if "\0" in text or any(s in text for s in self.special):
            return None
        if _uneven(text):
            return "\0 ".join(_CUT.split(text))
        marked = text.replace(" ", "\0 ")
        if "\n" in text and not any(c in text and ("\n" + c in text or c + "\n" in text) for c in _OTHER_WHITE):
            marked = marked.replace("\n", "\0\n\0")  # a line break alone is a pre-token of its own
        return marked

    def encode(self, texts: list[str]) -> list[bytes]:
        """Arrow numbers the different pieces of all texts, so each is looked up once."""
        cut = [self.cut(text) for text in texts]
        whole = [text for text, marked in zip(texts, cut, strict=True) if marked is None]
        alone = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False))
        marked = pa.array([marked or "" for marked in cut], pa.large_string())
        if self.bare is not None:
            marked = pc.replace_substring_regex(marked, _MARKED, "\\1\0\\2")
        pieces = pc.split_pattern(marked, "\0")
        numbered = pieces.values.dictionary_encode()
        ids, starts, lengths = self.look_up(numbered.dictionary)
        places = numbered.indices.to_numpy()
        n = lengths[places]
        data = _gathered(ids, starts[places], n).tobytes()
        bounds = np.concatenate([[0], np.cumsum(n)])[pieces.offsets.to_numpy()] * self.width
        return [
            array(self.code, next(alone).ids).tobytes() if marked is None else data[start:end]
            for marked, start, end in zip(cut, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]

    def look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, and the start and length in these of each piece's ids; the pieces differ from each other.

        Once the table was full it takes those met before.
        """
        if len(self.known) > KNOWN_PIECES:
            self.known, self.older = self.empty, self.known
        if len(self.once) > ONCE_PIECES:
            self.once = self.empty
        kept = (self.known, self.older, self.once)
        source = np.full(len(pieces), -1)
        starts, lengths, before = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), 0
        for number, table in enumerate(kept):
            rows, at = table.found(pieces)
            unseen = source[at] < 0
            rows, at = rows[unseen], at[unseen]
            source[at], starts[at], lengths[at] = number, table.starts[rows] + before, table.lengths[rows]
            before += len(table.ids)
        missing = np.flatnonzero(source < 0)
        learned, new_starts, new_lengths = self.learn(pieces.take(pa.array(missing)))
        starts[missing], lengths[missing] = new_starts + before, new_lengths
        ids = np.concatenate([*(table.ids for table in kept), learned])
        short = pc.binary_length(pieces).to_numpy() <= PIECE_BYTES
        was_full = len(self.older) > 0
        again = short & ((source > 0) if was_full else (source != 0))
        self.known = self.known.extended(pieces, np.flatnonzero(again), ids, starts, lengths)
        if was_full:
            self.once = self.once.extended(pieces, np.flatnonzero(short & (source < 0)), ids, starts, lengths)
        return ids, starts, lengths

    def learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces not in the tables, as ``look_up`` returns them."""
        solid = pc.match_substring_regex(pieces, _SOLID).to_numpy(zero_copy_only=False)
        words = np.zeros(len(pieces), bool)
        if self.bare is not None:
            words = pc.match_substring_regex(pieces, _LETTERS).to_numpy(zero_copy_only=False)
        starts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        parts, before = [np.zeros(0, self.kind)], 0

        def put(places: np.ndarray, ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
            nonlocal before
            begins = np.concatenate([[0], ends[:-1] + gap])
            starts[places], lengths[places] = begins + before, ends - begins
            parts.append(ids)
            before += len(ids)

        def put_all(places: np.ndarray, found: list[list[int]]) -> None:
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            put(places, np.fromiter(chain.from_iterable(found), self.kind, ends[-1]), ends, 0)

        def texts(places: np.ndarray) -> list[str]:
            return pieces.take(pa.array(places)).to_pylist()

        at = np.flatnonzero(words)
        if len(at):
            put_all(at, self.words_ids(texts(at)))
        # Pieces without white space, many to a text: a line break between them is one id of its own.
        at = np.flatnonzero(solid & ~words)
        rest, lines = [np.flatnonzero(~solid & ~words)], texts(at)
        groups = ["\n".join(lines[i : i + PIECES_A_LINE]) for i in range(0, len(lines), PIECES_A_LINE)]
        for i, found in enumerate(self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)):
            places, ids = at[i * PIECES_A_LINE : (i + 1) * PIECES_A_LINE], np.array(found.ids, np.int64)
            ends = np.append(np.flatnonzero(ids == self.line_break), len(ids))
            if len(ends) == len(places):
                put(places, ids.astype(self.kind), ends, 1)
            else:
                rest.append(places)
        at = np.concatenate(rest)
        if len(at):
            put_all(at, [x.ids for x in self.tokenizer.encode_batch_fast(texts(at), add_special_tokens=False)])
        return np.concatenate(parts), starts, lengths

    def words_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of pieces of letters, which the tokenizer takes as one pre-token each, in its spelling of bytes."""
        spelled = "\n".join(words).encode().decode("latin-1").translate(_SPELLED).split(_SPELLED[ord("\n")])
        tokenize = self.bare.tokenize
        return [[token.id for token in tokenize(word)] for word in spelled]


class _Pieces:
    """A table of pieces and their ids, packed; what it holds does not change."""

    def __init__(self, pieces: pa.Array, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.pieces, self.ids, self.starts, self.lengths = pieces, ids, starts, lengths

    @classmethod
    def empty(cls, kind: np.dtype) -> _Pieces:
        none = np.zeros(0, np.int64)
        return cls(pa.array([], pa.large_string()), np.zeros(0, kind), none, none)

    def __len__(self) -> int:
        return len(self.pieces)

    def __iter__(self) -> Iterator[str]:
        return iter(self.pieces.to_pylist())

    def found(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The rows of this table whose piece is sought, and its place among those sought."""
        at = pc.index_in(self.pieces, value_set=pieces)  # the larger side is not hashed into a table
        return np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False)), at.drop_null().to_numpy()

    def extended(self, pieces: pa.Array, chosen: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> _Pieces:
        """This table and the chosen pieces, with their ids."""
        if not len(chosen):
            return self
        n = lengths[chosen]
        return _Pieces(
            pa.concat_arrays([self.pieces, pieces.take(pa.array(chosen))]),
            np.concatenate([self.ids, _gathered(ids, starts[chosen], n)]),
            np.concatenate([self.starts, len(self.ids) + np.cumsum(n) - n]),
            np.concatenate([self.lengths, n]),
        )


def _gathered(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of ``numbers``, one behind the other."""
    ends = np.cumsum(lengths)
    return numbers[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _uneven(text: str) -> bool:
    """Whether a blank may stand beside other white space, or at an end of the text."""
    if not text or text[0].isspace() or text[-1].isspace() or "  " in text:
        return True
    for c in _OTHER_WHITE:
        if c in text and (c + " " in text or " " + c in text):
            return True
    return not text.isascii() and any(c in text for c in _WIDE_WHITE)


def _splits_letters(tokenizer) -> bool:
    """Whether letters, alone or after a blank, are one pre-token, spelled a sign a byte."""
    plan = json.loads(tokenizer.to_str())
    before = plan["pre_tokenizer"] or {}
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    return bool(byte_level and plan["normalizer"] is None and plan["model"]["type"] == "BPE" and not plan["truncation"])


def id_width(tokenizer) -> int:
    return 2 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _some(texts: pa.Array, n: int = 4_096) -> Iterator[list[str]]:
    """A column's texts, null as empty, a few at a time, as Python's copies need room: up to ``n`` of ``TEXT_BYTES`` in all."""
    for start in range(0, len(texts), n):
        some = texts.slice(start, n)
        sizes = pc.fill_null(pc.binary_length(some), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        groups = (np.cumsum(sizes) - sizes) // TEXT_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(some)]
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            yield [t or "" for t in some.slice(first, last - first).to_pylist()]
            hand_back()  # the tables of pieces were copied for these texts


def trained_dictionary(docs: DataFrame, tokenizer_path: str) -> bytes:
    """From the ids of about ``SAMPLE_DOCUMENTS`` documents; empty if these are too few."""
    import zstandard

    total = docs.count()
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, total))
    chosen = F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30) < share

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x[:SAMPLE_BYTES] for some in _some(batch.column("text")) for x in _encoder(tokenizer_path).encode(some)]
            yield pa.RecordBatch.from_pydict({"ids": pa.array(ids, pa.binary())})

    samples = docs.where(chosen).select("text").mapInArrow(serialized, "ids binary").toArrow()["ids"].to_pylist()
    samples = sorted(x for x in samples if len(x) >= 8)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, threads=0).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b""


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, shards: int | None = None
) -> str:
    """Write the ids of all documents, in ascending order of doc_id, below ``folder``."""
    import zstandard
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    dictionary = trained_dictionary(docs, tokenizer_path)
    sha = hashlib.sha256(dictionary).hexdigest()
    width = id_width(Tokenizer.from_file(tokenizer_path))
    if end_id >= 1 << (8 * width):
        width = 4
    kind = docs.schema["doc_id"].dataType.simpleString()
    entry = _ENTRY.format(kind=kind)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        encoder = _encoder(tokenizer_path)
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        entries, frames, held = [], [], 0
        id_type = None

        def flush():
            entry_type = pa.struct(
                [("doc_id", id_type), ("offset", pa.int32()), ("length", pa.int32()), ("n_tokens", pa.int64()), ("start", pa.int64())]
            )
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "dict_sha256": pa.array([sha]),
                    "first_id": pa.array([entries[0]["doc_id"]], id_type),
                    "last_id": pa.array([entries[-1]["doc_id"]], id_type),
                    "entries": pa.array([entries], pa.list_(entry_type)),
                    "payload": pa.array([b"".join(frames)], pa.binary()),
                }
            )

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids = batch.column("doc_id").to_pylist()
            at = 0
            for texts in _some(batch.column("text")):
                for found in encoder.encode(texts):
                    if width != encoder.width:
                        found = np.frombuffer(found, dtype=encoder.kind).astype(f"<u{width}").tobytes()
                    frame = compressor.compress(found + end)
                    n = len(found) // width + 1
                    entries.append({"doc_id": ids[at], "offset": held, "length": len(frame), "n_tokens": n, "start": before})
                    frames.append(frame)
                    held, before, at = held + len(frame), before + n, at + 1
                    if held >= BLOCK_BYTES:
                        yield flush()
                        entries, frames, held, block = [], [], 0, block + 1
        if entries:
            yield flush()

    # Bounds of ranges are samples of the order's columns, so the text itself is only the last resort within a task.
    order = [F.asc_nulls_first("doc_id"), F.asc("text_hash")]
    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    ranged = narrow.repartitionByRange(shards, *order) if shards else narrow.repartitionByRange(*order)
    schema = f"shard int, block int, dict_sha256 string, first_id {kind}, last_id {kind}, entries array<{entry}>, payload binary"
    ranged.sortWithinPartitions(*order, "text").mapInArrow(blocks, schema).write.parquet(f"{folder}/blocks")
    written = spark.read.parquet(f"{folder}/blocks")
    last = F.element_at("entries", -1)
    totals = written.groupBy("shard").agg(F.max(last["start"] + last["n_tokens"]).alias("n_tokens"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row a shard
    totals.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long"))).coalesce(1).write.parquet(
        f"{folder}/shards"
    )
    tokenizer_sha = hashlib.sha256(Path(tokenizer_path).read_bytes()).hexdigest()
    spark.createDataFrame(
        [(sha, bytearray(dictionary), width, end_id, tokenizer_sha)],
        "dict_sha256 string, dictionary binary, width int, end_id int, tokenizer_sha256 string",
    ).coalesce(1).write.parquet(f"{folder}/header")
    return folder


def _frames(dictionary: bytes, sha: str, width: int, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decompressor = zstandard.ZstdDecompressor(dict_data=known)
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("dict_sha256")[row].as_py() != sha:
                    raise ValueError("a block was written with another dictionary")
                entries = batch.column("entries")[row].values
                payload = memoryview(batch.column("payload")[row].as_buffer())
                crc, numbers, ids = [], [], []
                places = zip(entries.field("offset").to_pylist(), entries.field("length").to_pylist(), strict=True)
                for offset, length in places:
                    found = np.frombuffer(decompressor.decompress(payload[offset : offset + length]), dtype=f"<u{width}").astype("<u4")
                    numbers.append(len(found))
                    crc.append(zlib.crc32(found.tobytes()))
                    if with_ids:
                        ids.append(found.astype(np.int64))
                n = len(numbers)
                out = {
                    "doc_id": entries.field("doc_id"),
                    "shard": pa.array([batch.column("shard")[row].as_py()] * n, pa.int32()),
                    "start": entries.field("start"),
                    "n_tokens": pa.array(numbers, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array(ids, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    return read


def read_token_ids(spark: SparkSession, folder: str, where: Column | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of the documents written below ``folder``.

    ``where`` is a condition on first_id and last_id that picks blocks; Parquet's
    statistics keep the others unread.
    """
    header = spark.read.parquet(f"{folder}/header").first()
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["first_id"].dataType.simpleString()
    if where is not None:
        blocks = blocks.where(where)
    schema = f"doc_id {kind}, shard int, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    reader = _frames(bytes(header["dictionary"]), header["dict_sha256"], header["width"], with_ids)
    documents = blocks.select("shard", "dict_sha256", "entries", "payload").mapInArrow(reader, schema)
    shards = spark.read.parquet(f"{folder}/shards").select("shard", F.col("start").alias("shard_start"))
    joined = documents.join(F.broadcast(shards), "shard")  # a row a shard: bounded by the number of partitions
    return joined.select("doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> DataFrame:
    """One document, from the blocks whose range of ids holds it."""
    inside = (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    return read_token_ids(spark, folder, inside, with_ids=True).where(F.col("doc_id") == doc_id)
