"""Atomic commits in a folder that several writers share.

Data is written to a folder of its own that nobody else names. What makes it
count is one small log entry, ``_log/<number>.json``, which appears whole or not
at all and is never replaced: of two writers that claim a number one gets it, the
other is told so and takes the next. A writer that dies at any point leaves data
without an entry, which no reader sees and which blocks nobody.

A claim is a hard link on a local disk and a rename that refuses to overwrite
elsewhere; the store must keep that promise, as HDFS and its like do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_log"
DATA = "data"
_TAKEN = ("FileAlreadyExistsException",)


def _store(spark: SparkSession, path: str):
    """The path as its store's object, and the store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _kind(error: Py4JJavaError) -> str:
    return error.java_exception.getClass().getSimpleName()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    place, store = _store(spark, path)
    return store.exists(place)


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file appear with its whole text; False if a file of that name is there already."""
    target, store = _store(spark, path)
    beside, _ = _store(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
    out = store.create(beside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    try:
        _appear(spark, store, beside, target)
    except Py4JJavaError as error:
        if _kind(error) in _TAKEN:
            return False
        raise
    finally:
        store.delete(beside, False)
    return True


def _appear(spark: SparkSession, store, beside, target) -> None:
    jvm = spark._jvm
    if store.getUri().getScheme() == "file":
        paths = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, beside)]
        jvm.java.nio.file.Files.createLink(*paths)
    else:
        _rename_once(spark, store, beside, target)


def _rename_once(spark: SparkSession, store, beside, target) -> None:
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(
        beside, target, options
    )


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``, which stays until then.

    Two renames; should the work end between them, ``restore_folder`` brings the old one back.
    """
    fresh, store = _store(spark, new)
    place, _ = _store(spark, path)
    old, _ = _store(spark, f"{_hidden(place)}.old-{uuid.uuid4().hex}")
    there = store.exists(place)
    if there and not store.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    moved = False
    try:
        moved = store.rename(fresh, place)
    finally:
        if there and not moved:
            store.rename(old, place)
    if not moved:
        raise OSError(f"cannot move {new} to {path}")
    if there:
        store.delete(old, True)


def restore_folder(spark: SparkSession, path: str) -> bool:
    """Bring back what a replacement had moved aside when its writer ended between its two renames."""
    place, store = _store(spark, path)
    if store.exists(place) or not store.exists(place.getParent()):
        return False
    begin = f".{place.getName()}.old-"
    aside = [s for s in store.listStatus(place.getParent()) if s.getPath().getName().startswith(begin)]
    if not aside:
        return False
    return store.rename(max(aside, key=lambda s: s.getModificationTime()).getPath(), place)


def _hidden(place) -> str:
    return f"{place.getParent().toString().rstrip('/')}/.{place.getName()}"


def beside(spark: SparkSession, path: str) -> str:
    """A new name next to ``path`` that readers of the parent folder pass over."""
    return f"{_hidden(_store(spark, path)[0])}.new-{uuid.uuid4().hex}"


def fresh_folder(root: str) -> str:
    """A folder for data that no entry names yet."""
    return f"{root}/{DATA}/{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    place, store = _store(spark, path)
    store.delete(place, True)


def entry_path(root: str, number: int) -> str:
    return f"{root}/{LOG}/{number:020d}.json"


def claim_entry(spark: SparkSession, root: str, number: int, entry: Mapping[str, Any]) -> bool:
    return claim(spark, entry_path(root, number), json.dumps(dict(entry)) + "\n")


def last_entry(spark: SparkSession, root: str) -> tuple[int, dict[str, Any]] | None:
    """Number and content of the highest entry; one listing and one small read, whatever the log's length."""
    folder, store = _store(spark, f"{root}/{LOG}")
    if not store.exists(folder):
        return None
    numbers = [int(n[:-5]) for n in _names(store, folder) if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return None
    lines = spark.read.text(entry_path(root, max(numbers)), wholetext=True).first()
    return max(numbers), json.loads(lines[0])


def _names(store, folder) -> list[str]:
    return [status.getPath().getName() for status in store.listStatus(folder)]


def drop_unclaimed(spark: SparkSession, root: str, claimed: Iterable[str], older_than: float = 7 * 86_400) -> list[str]:
    """Delete data folders that no entry names and that are older than so many seconds; their names.

    The age keeps the data of a writer that is still at work.
    """
    folder, store = _store(spark, f"{root}/{DATA}")
    if not store.exists(folder):
        return []
    named = {path.rstrip("/").rsplit("/", 1)[-1] for path in claimed}
    now = time.time() * 1000
    dropped = []
    for status in store.listStatus(folder):
        name = status.getPath().getName()
        if name not in named and now - status.getModificationTime() >= older_than * 1000:
            store.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
