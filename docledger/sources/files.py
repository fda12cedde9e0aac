"""Delimited files: staged folders, borrowed schemas, header guard, seeds."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.functions import named, null_if_na
from docledger.sources import excel
from docledger.sources.catalog import conform, rename_columns
from docledger.sources.records import first_records, header_cells, line_use, lines_of, records_of

ROW_ORDER = "_row_ord"
_QUOTING = {"quote": '"', "escape": '"'}


def with_row_order(df: DataFrame) -> DataFrame:
    """Add ``_row_ord``, an ordering of rows by file, place in the file and row."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ROW_ORDER))


def read_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a file, without a byte-order mark; repeated names are an error."""
    return header_names(first_records(spark, [path], sep)[path], sep)


def first_lines(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[str, str]:
    """The first record of every file by plain path; a file without lines has an empty one."""
    return {plain_path(path): record for path, record in first_records(spark, paths, sep).items()}


def plain_path(path: str) -> str:
    return unquote(urlparse(path).path)


def header_names(line: str, sep: str = ",") -> list[str]:
    headers = header_cells(line, sep)
    repeated = sorted({h for h in headers if headers.count(h) > 1})
    if repeated:
        raise ValueError(f"Duplicate columns found in CSV headers: {repeated}")
    return headers


def read_strings(
    spark: SparkSession, paths: str | Sequence[str], headers: Sequence[str], sep: str = ",", multi_line: bool = True
) -> DataFrame:
    """All columns as text, missing-value tokens as NULL.

    Every file's header is checked against ``headers`` as it is scanned, and a
    row with more or fewer cells fails the read. Quoted line breaks stay inside
    their cell, and a large file is read by ranges all the same: files whose lines
    are records, as one scan tells, by Spark's own reader, others by their records.
    ``multi_line=False`` is for files known to have no quoted breaks.
    """
    lines = lines_of(spark, paths)
    if multi_line and not line_use(lines, sep)[1]:
        raw = text_cells(records_of(lines, sep, headers), headers, sep)
    else:
        raw = _text_of_lines(spark, paths, headers, sep)
    return raw.select(*[null_if_na(named(h)).alias(h) for h in headers])


def _text_of_lines(spark: SparkSession, paths: str | Sequence[str], headers: Sequence[str], sep: str) -> DataFrame:
    """The cells of files whose lines are records, as text; another header or number of cells fails."""
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers])
    return spark.read.option("columnPruning", "false").csv(
        paths, schema=schema, header=True, sep=sep, mode="FAILFAST", enforceSchema=False, **_QUOTING
    )


def text_cells(records: DataFrame, headers: Sequence[str], sep: str) -> DataFrame:
    """The cells of records as text columns; one with more or fewer cells fails."""
    places = [f"c{i}" for i in range(len(headers))]
    options = {"sep": sep, "mode": "FAILFAST", "multiLine": "true", "lineSep": "\n", **_QUOTING}
    cells = records.select(F.from_csv("text", ", ".join(f"{c} string" for c in places), options).alias("cells"))
    return cells.select(*[F.col("cells")[c].alias(h) for c, h in zip(places, headers, strict=True)])


def read_delimited(spark: SparkSession, path: str, sep: str = ",", all_text: bool = True) -> DataFrame:
    """A delimited file as text columns, or with inferred types; a malformed row fails.

    Files are read by ranges, with quoted line breaks or without.
    """
    options = {"sep": sep, "mode": "FAILFAST", **_QUOTING}
    lines = lines_of(spark, path)
    reader = spark.read.option("columnPruning", "false")
    quoted, whole = line_use(lines, sep)
    if whole and not quoted:
        return reader.csv(path, header=True, inferSchema=not all_text, **options)
    headers = read_header(spark, path, sep)
    if whole and all_text:
        return _text_of_lines(spark, path, headers, sep)
    records = records_of(lines, sep, headers)
    if all_text:
        return text_cells(records, headers, sep)
    strings = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = reader.options(**options, inferSchema=True, multiLine=True, lineSep="\n")
    return DataFrame(reader._jreader.csv(strings), spark).toDF(*headers)


def list_files(spark: SparkSession, root: str, glob: str) -> list[str]:
    """Paths under ``root`` from a listing; no content is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return sorted(r[0] for r in listing.option("pathGlobFilter", glob).load(root).select("path").collect())


def table_of(path: str) -> str:
    return unquote(PurePosixPath(path).parent.name)


def read_staged(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, T.StructType],
    sep: str = ",",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Load every CSV and XLSX under ``root`` into the table its folder names.

    A file of any other kind is an error. Files of a table are grouped by header
    and read one group at a time, then aligned by column name, so column order
    may differ between files. Headers are found by opening each file and reading
    its first record.
    """
    kinds: dict[str, list[str]] = {".csv": [], ".xlsx": []}
    for path in list_files(spark, root, "*"):
        kind = PurePosixPath(path).suffix.lower()
        if kind not in kinds:
            raise ValueError(f"neither CSV nor XLSX: {path}")
        kinds[kind].append(path)
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    lines = first_lines(spark, kinds[".csv"], sep) if kinds[".csv"] else {}
    for path in kinds[".csv"]:
        groups[table_of(path), tuple(header_names(lines.get(plain_path(path), ""), sep))].append(path)
    parts: dict[str, list[DataFrame]] = defaultdict(list)
    for (table, headers), paths in groups.items():
        parts[table].append(read_strings(spark, paths, headers, sep, multi_line))

    workbooks: dict[str, list[str]] = defaultdict(list)
    for path in kinds[".xlsx"]:
        workbooks[table_of(path)].append(path)
    for table, paths in workbooks.items():
        for (row, header), same in excel.headers(spark, paths).items():
            parts[table].append(excel.read_body(spark, same, row, header))

    unknown = sorted(set(parts) - set(catalog))
    if unknown:
        raise ValueError(f"no declared schema for {', '.join(unknown)}")
    loaded = {}
    for table, frames in parts.items():
        union = conform(frames[0], catalog[table])
        for frame in frames[1:]:
            union = union.unionByName(conform(frame, catalog[table]))
        loaded[table] = union
    return loaded


def read_borrowed(
    spark: SparkSession, path: str, reference: T.StructType, mapping: Mapping[str, str] | None = None, sep: str = ","
) -> DataFrame:
    """A customer file typed after the register it is compared with.

    Headers are mapped to register columns for their type, unknown ones are
    text; a cell that does not fit its type fails the read.
    """
    mapping = mapping or {}
    types = {f.name: f.dataType for f in reference}
    headers = read_header(spark, path, sep)
    schema = T.StructType(
        [T.StructField(h, types.get(mapping.get(h, h), T.StringType())) for h in headers]
    )
    raw = spark.read.csv(
        path, schema=schema, header=True, sep=sep, mode="FAILFAST", enforceSchema=False, **_QUOTING
    )
    return rename_columns(with_row_order(raw), mapping)


def read_seed(spark: SparkSession, path: str, types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """A lookup file: header names trimmed, text unless ``types`` says otherwise."""
    types = types or {}
    headers = read_header(spark, path)
    seed = read_strings(spark, path, headers).toDF(*[h.strip() for h in headers])
    return seed.select(*[named(c).cast(types.get(c, T.StringType())).alias(c) for c in seed.columns])


def attach(frames: Mapping[str, DataFrame], layer: str) -> None:
    """Expose frames to SQL as read-only views ``<layer>_<table>`` of this session."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{layer}_{name}")


def attach_layer(spark: SparkSession, layer: str, places: Mapping[str, str], home: str) -> None:
    """Make written Parquet tables known to SQL as ``<layer>.<table>``, as views, so read-only.

    ``places`` has the folder of each table; ``home`` is where the catalog may
    keep the schema's own folder. A table that is attached again points to its new place.
    """
    schema, place = quoted(layer), f"{home}/{layer}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create schema if not exists {schema} location '{place}'")
    for name, path in places.items():
        spark.sql(f"create or replace view {schema}.{quoted(name)} as select * from parquet.{quoted(path)}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def task_files(tasks: DataFrame, column: str) -> DataFrame:
    """(table, url, file) per entry of the file lists in task descriptions (JSON); malformed JSON fails."""
    schema = "request struct<fileInfo:map<string,array<struct<s3FileUrl:string,userFileName:string>>>>"
    files = tasks.select(F.from_json(named(column), schema, {"mode": "FAILFAST"})["request"]["fileInfo"].alias("info"))
    entries = files.select(F.explode("info").alias("table", "entries"))
    return entries.select("table", F.inline("entries").alias("url", "file"))
