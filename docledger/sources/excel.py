"""First sheet of XLSX workbooks as text columns.

A workbook is a zip of XML parts and cannot be split, so one file is one task;
the format itself stops at 1,048,576 rows. Bulk data should arrive as CSV or
Parquet.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import null_if_na

_BATCH = 10_000
_CELLS = "path string, row_no long, cells array<string>"
# Built-in number formats of the workbook format that show dates.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_EPOCH = datetime.datetime(1899, 12, 30)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter() if _local(t.tag) == "t") for item in root]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId")) for f in root.iter() if _local(f.tag) == "numFmt"
        and re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "").lower()))
    }
    for section in root:
        if _local(section.tag) == "cellXfs":
            return {i for i, xf in enumerate(section) if int(xf.get("numFmtId", 0)) in _DATE_FORMATS | custom}
    return set()


def _first_sheet(book: zipfile.ZipFile) -> str:
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheet = next(e for e in workbook.iter() if _local(e.tag) == "sheet")
    wanted = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
    rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cell_text(cell: ElementTree.Element, texts: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
    value = next((v.text for v in cell if _local(v.tag) == "v"), None)
    if value is None or kind in ("str", "e"):
        return value
    if kind == "s":
        return texts[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if int(cell.get("s", -1)) in dates:
        return str(_EPOCH + datetime.timedelta(seconds=round(float(value) * 86400)))
    return value


def sheet_rows(content: bytes, limit: int | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of the first sheet, streamed from the XML.

    Blank rows count only between filled ones.
    """
    book = zipfile.ZipFile(io.BytesIO(content))
    texts, dates = _texts(book), _date_styles(book)
    produced, started, blank = 0, False, []
    with book.open(_first_sheet(book)) as part:
        for _, element in ElementTree.iterparse(part):
            if _local(element.tag) != "row":
                continue
            cells: list[str | None] = []
            for cell in element:
                at = _column(cell.get("r")) if cell.get("r") else len(cells)
                cells.extend([None] * (at + 1 - len(cells)))
                cells[at] = _cell_text(cell, texts, dates)
            produced += 1
            row = int(element.get("r", produced)), cells
            element.clear()
            if all(c is None for c in cells):
                if started:
                    blank.append(row)
                continue
            started = True
            yield from blank
            yield row
            blank.clear()
            if limit is not None and produced >= limit:
                return


def _parser(limit: int | None):
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows: list[tuple[str, int, list[str | None]]] = []
                for number, cells in sheet_rows(content, limit):
                    rows.append((path, number, cells))
                    if len(rows) == _BATCH:
                        yield pd.DataFrame(rows, columns=["path", "row_no", "cells"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "row_no", "cells"])

    return parse


def read_sheet(spark: SparkSession, paths: str | Sequence[str], limit: int | None = None) -> DataFrame:
    """Raw cells (path, row_no, cells) of the first sheet of each workbook."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(_parser(limit), _CELLS)


def sheet_region(cells: DataFrame, first_row: int, last_row: int, columns: str) -> DataFrame:
    """A block of a sheet by row range and column letters, e.g. rows 13-19 of AEFHI."""
    block = cells.where(F.col("row_no").between(first_row, last_row))
    return block.select("row_no", *[F.get("cells", F.lit(_column(c))).alias(c) for c in columns])


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[int, tuple[str | None, ...]], list[str]]:
    """Workbooks by (header row, header cells); only the header rows reach the driver."""
    groups: dict[tuple[int, tuple[str | None, ...]], list[str]] = {}
    for row in read_sheet(spark, paths, limit=1).collect():
        groups.setdefault((row["row_no"], tuple(row["cells"])), []).append(row["path"])
    return groups


def read_body(
    spark: SparkSession, paths: Sequence[str], header_row: int, header: Sequence[str | None]
) -> DataFrame:
    """Rows below the header of workbooks that share it, all columns as text."""
    body = read_sheet(spark, paths).where(F.col("row_no") > header_row)
    return body.select(
        *[null_if_na(F.get("cells", F.lit(i))).alias(name) for i, name in enumerate(header) if name is not None]
    )


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """First sheet of a workbook, header in its first filled row, all columns as text."""
    ((row, header), paths), = headers(spark, [path]).items()
    return read_body(spark, paths, row, header)
