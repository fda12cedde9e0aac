"""Content fingerprints, versioned writes and snapshot differences."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import named, row_hash
from docledger.operators.ordering import with_ordinal
from docledger.session import checkpoint
from docledger.sources.commits import LOG, claim_entry, drop_folder, drop_unclaimed, fresh_folder, path_exists

LOG_COLUMNS = ("version", "file_hash", "message", "created_by", "created_at", "path")
LOG_SCHEMA = "version bigint, file_hash string, message string, created_by string, created_at string, path string"
_WORDS = 4
BLOCK_LINES = 65_536


def _word(digest: Column, i: int) -> Column:
    """The i-th 32-bit word of an md5 text as a number."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")


def _fold(digest: Column) -> list[Column]:
    sums = [F.coalesce(F.sum(_word(digest, i)), F.lit(0).cast("decimal(30,0)")) for i in range(_WORDS)]
    return [F.count(F.lit(1)), *sums]


def _folded_text(parts: Sequence[Column]) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (row_count, fingerprint): equal for equal row multisets in any order.

    Row digests are summed word by word, which combines on the map side; no
    sorted pass through one task is needed.
    """
    picked = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema}
    digests = df.select(row_hash([(c, types[c]) for c in picked]).alias("d"))
    folded = digests.agg(*[c.alias(f"f{i}") for i, c in enumerate(_fold(F.col("d")))])
    return folded.select(
        F.col("f0").alias("row_count"),
        _folded_text([F.col(f"f{i}") for i in range(_WORDS + 1)]).alias("fingerprint"),
    )


def file_hashes(spark: SparkSession, path: str, glob: str | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """(path, hash) per file under ``path``: the top of a hash tree over its lines.

    Files are read by ranges and no file is held whole. A line's digest is a
    leaf, ``block_lines`` digests in order make one of the level above, until one
    is left; the hash is that of the file's size and the top. Leaves are numbered
    in ranges of place, so one large file fills as many tasks as it has ranges.
    Spark lists no empty files, so they have no row.
    """
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": glob} if glob else {})
    place = F.col("_metadata.file_path")
    listed = spark.read.format("binaryFile").options(**options).load(path)
    files = listed.select("path", place.alias("file"), F.col("length").cast("string").alias("size"))
    lines = spark.read.options(lineSep="\n", **options).text(path)
    leaves = checkpoint(
        lines.select(
            place.alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"), F.md5(F.col("value").cast("binary")).alias("digest"),
        )
    )
    nodes = with_ordinal(leaves, ["file"], ["start", "id"], "n").select("file", (F.col("n") - 1).alias("n"), "digest")
    while True:
        told = F.transform(F.sort_array(F.collect_list(F.struct("n", "digest"))), lambda x: x["digest"])
        grouped = nodes.groupBy("file", F.floor(F.col("n") / block_lines).alias("block"))
        alone = (F.col("block") == 0) & (F.count(F.lit(1)) == 1)  # the top already
        digest = F.when(alone, F.min("digest")).otherwise(F.md5(F.array_join(told, ""))).alias("digest")
        nodes = checkpoint(grouped.agg(digest).withColumnRenamed("block", "n"))
        if not (nodes.agg(F.max("n")).first()[0] or 0):
            break
    tops = nodes.select("file", F.col("digest").alias("top"))
    return files.join(tops, "file", "left").select(
        "path", F.md5(F.concat_ws(":", "size", F.coalesce("top", F.lit("")))).alias("hash")
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str] | None = None
) -> DataFrame:
    """(key, change): Added, Removed or Modified; unchanged keys are not reported.

    Rows of both sides meet in one aggregate that sums their digests per key and
    side, on the map side first, so repeated keys neither multiply nor need an
    order and there is one shuffle.
    """
    values = list(values or [c for c in old.columns if c not in key])
    keys = [named(c) for c in key]
    sides = []
    for side, frame in (("old", old), ("new", new)):
        types = {f.name: f.dataType for f in frame.schema}
        sides.append(frame.select(*keys, F.lit(side).alias("__side"), row_hash([(c, types[c]) for c in values]).alias("__d")))
    of = {side: F.when(F.col("__side") == side, F.col("__d")) for side in ("old", "new")}
    sums = []
    for side in ("old", "new"):
        sums.append(F.count(of[side]).alias(f"__{side}_rows"))
        sums += [F.sum(_word(of[side], i)).alias(f"__{side}_{i}") for i in range(_WORDS)]
    folded = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*sums)
    same = reduce(
        and_,
        [F.col("__old_rows") == F.col("__new_rows"), *[F.col(f"__old_{i}") == F.col(f"__new_{i}") for i in range(_WORDS)]],
    )
    change = (
        F.when(F.col("__old_rows") == 0, "Added").when(F.col("__new_rows") == 0, "Removed").when(~same, "Modified")
    )
    return folded.select(*keys, change.alias("change")).where(F.col("change").isNotNull())


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The version log, oldest first; empty before the first write.

    Only a log that isn't there counts as empty; any other failure to read it is raised.
    """
    if path_exists(spark, f"{root}/{LOG}"):
        log = spark.read.schema(LOG_SCHEMA).json(f"{root}/{LOG}", mode="FAILFAST")
    else:
        log = spark.createDataFrame([], LOG_SCHEMA)
    return log.orderBy("version")


def latest_version(log: DataFrame) -> DataFrame:
    """One row: number and file_hash of the highest version, whatever the clock said."""
    return log.agg(F.max("version").alias("version"), F.max_by("file_hash", "version").alias("file_hash"))


def write_version(df: DataFrame, root: str, message: str, created_by: str) -> int | None:
    """Write ``df`` as the next version unless its content equals the latest one.

    Returns the version number, or None when nothing changed. Data goes to a
    folder of its own; the log entry that names it is the claim on the number
    and the only thing that makes it a version. Of writers at once each gets a
    number of its own; one that fails in between leaves no version and is in
    nobody's way. Times are UTC.
    """
    spark = df.sparkSession
    digest = fingerprint(df).first()["fingerprint"]
    path = None
    while True:
        last = latest_version(versions(spark, root)).first()
        if last["file_hash"] == digest:
            if path is not None:
                drop_folder(spark, path)
            return None
        number = (last["version"] or 0) + 1
        if path is None:
            path = fresh_folder(root)
            df.write.mode("errorifexists").parquet(path)
        now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%d %H:%M:%S")
        entry = dict(zip(LOG_COLUMNS, (number, digest, message, created_by, now, path.removeprefix(f"{root}/")), strict=True))
        if claim_entry(spark, root, number, entry):
            return number


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, of the latest one by default; a number that the log lacks is an error."""
    log = versions(spark, root)
    if version is None:
        version = latest_version(log).first()["version"]
    row = log.where(F.col("version") == version).agg(F.count(F.lit(1)).alias("n"), F.max("path").alias("path")).first()
    if not row["n"]:
        raise ValueError(f"no version {version} in {root}")
    return spark.read.parquet(f"{root}/{row['path'] or f'version={version}'}")


def drop_failed_writes(spark: SparkSession, root: str, older_than: float = 7 * 86_400) -> list[str]:
    """Delete the data of writes that never became a version and are older than so many seconds."""
    claimed = [r["path"] for r in versions(spark, root).select("path").distinct().toLocalIterator() if r["path"]]
    return drop_unclaimed(spark, root, claimed, older_than)
