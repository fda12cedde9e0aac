"""What the operators share: the word pattern, shared folders and hashes of words."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.session import ensure_checkpoint_dir, shuffle_files_dropped

WORD = r"[^\x20\x09-\x0D]+"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def count_words(text: Column) -> Column:
    """Number of words as a long; null counts as no word."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package's sources to the Python workers, once per application.

    Workers started elsewhere than in the repository can't import it otherwise.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="docledger-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_KEPT: list[dict] = []


def kept_between_tasks(table: dict) -> dict:
    """Register a table that an operator keeps in a Python worker for its later tasks."""
    _KEPT.append(table)
    return table


def hand_back() -> None:
    """Hand back what Arrow's memory pool holds and doesn't use; it keeps several times its arrays otherwise."""
    pa.default_memory_pool().release_unused()


def make_room() -> None:
    """Drop what other operators keep in this Python worker, and hand back Arrow's unused memory.

    Workers are used again by later stages; what an earlier one kept would count
    against these for as long as the worker lives.
    """
    for table in _KEPT:
        table.clear()
    hand_back()


def with_room(task):
    """The task, which makes room before its first batch and hands back unused memory behind its last one.

    An idle worker's memory counts against the stages that run without it.
    """

    def run(batches):
        make_room()
        try:
            yield from task(batches)
        finally:
            hand_back()

    return run


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back; cuts the lineage."""
    folder = scratch_folder(df.sparkSession, name)
    with shuffle_files_dropped(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(df: DataFrame, name: str) -> str:
    """A name for a working column that the table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """The table's columns by their exact names, whatever characters these hold."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every input bit moves every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TABLE_BYTES = 64  # places in a word that have numbers of their own
_TABLE = mixed((np.arange(_TABLE_BYTES * 256, dtype=np.uint64) + np.uint64(1)) * _MULTIPLIER)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in the UTF-8 bytes of one text.

    Every byte at every place of a word has a random number; a word's hash mixes
    the sum of its bytes' numbers. Long words use the table again, mixed with how
    often it was used. No pattern of bytes makes such sums equal.
    """
    starts, ends = word_spans(data)
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    begins = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(lengths)[:-1]))
    letters = data[~_SPACE[data]]
    if lower:
        letters = _LOWER[letters]
    place = np.arange(len(letters), dtype=np.int32)
    place -= np.repeat(begins.astype(np.int32), lengths)
    far = np.flatnonzero(place >= _TABLE_BYTES) if int(lengths.max()) > _TABLE_BYTES else None
    again = place[far] // _TABLE_BYTES if far is not None else None
    place &= np.int32(_TABLE_BYTES - 1)
    place <<= np.int32(8)
    place |= letters
    numbers = _TABLE[place]
    if far is not None:
        numbers[far] = mixed(numbers[far] + again.astype(np.uint64) * _WORD_STEP)
    return starts, ends, mixed(np.add.reduceat(numbers, begins))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    if width > 8:
        powers = np.multiply.accumulate(np.full(len(words), _WORD_STEP, dtype=np.uint64))
        inverse = np.uint64(pow(int(_WORD_STEP), -1, 1 << 64))
        back = np.multiply.accumulate(np.full(n, inverse, dtype=np.uint64))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
        return mixed((sums[width:] - sums[:n]) * back)
    out = words[:n].copy()
    for i in range(1, width):
        out *= _WORD_STEP
        out += words[i : i + n]
    return mixed(out)


def utf8_rows(column) -> list[np.ndarray]:
    """The bytes of each text of an Arrow string column, not copied; a null text has none."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    rows = [every[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    if column.null_count:
        valid = column.is_valid().to_pylist()
        rows = [r if ok else r[:0] for r, ok in zip(rows, valid, strict=True)]
    return rows
