"""Workbook folders as long text cells."""

from __future__ import annotations

import datetime as dt
import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = "path string, sheet string, row_no int, col_no int, value string"
TAGGED = f"{CELLS}, fault string"
BATCH = 10_000

# Element names and built-in date formats of the Office Open XML format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# What a damaged part, sheet, string index or date serial raises; such a workbook must not fail the others.
DAMAGED = (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, EOFError, KeyError, IndexError, ValueError, OverflowError)
REASONS = (
    ((zipfile.BadZipFile, EOFError), "it is no Excel archive, or the archive is cut off"),
    (zlib.error, "a compressed part is damaged"),
    (ElementTree.ParseError, "the XML of a part is damaged or cut off"),
    (KeyError, "a part is missing"),
    (IndexError, "a cell names a text that is not there"),
    ((ValueError, OverflowError), "a cell holds a number that is none"),
)
DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])


def _workbook_files(spark: SparkSession, path: str) -> DataFrame:
    """Files ending in .xlsx; others are dropped by name while listing, so their bytes are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[xX][lL][sS][xX]")
        .load(path)
    )


def scan_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Cells (path, sheet, row_no, col_no, value) of all .xlsx files below ``path``.

    Row and column numbers are those of the sheet, from 1.
    """
    return parse_workbooks(_workbook_files(spark, path))


def scan_tagged(spark: SparkSession, path: str) -> DataFrame:
    """S1 with its faults: the same cells, and one row with ``fault`` set for each file that cannot be read.

    Both come from one pass over the files; stage it before the two are told apart.
    """
    return parse_tagged(_workbook_files(spark, path))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of every file below ``path``, without reading content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def parse_workbooks(files: DataFrame) -> DataFrame:
    """Cells of (path, content) rows; a workbook of which any part is damaged gives no cells."""
    return parse_tagged(files).where(F.col("fault").isNull()).drop("fault")


def parse_tagged(files: DataFrame) -> DataFrame:
    """Cells of (path, content) rows with a NULL ``fault``; a damaged workbook gives its reason instead of any cell."""
    return files.select("path", "content").mapInPandas(_cells, TAGGED)


def with_dataset(cells: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Adds dataset_id: from (dataset_id, path) requests, else the file name without extension.

    A local path of a request may be given with or without its 'file:' scheme.
    """
    if requests is None:
        return cells.withColumn("dataset_id", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))

    def key(path: str) -> Column:
        return F.regexp_replace(path, "^file:/+", "/")

    asked = requests.select("dataset_id", key("path").alias("__key"))
    return cells.withColumn("__key", key("path")).join(asked, "__key").drop("__key")


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "sheet", "row_no", "col_no", "value", "fault"]
    rows: list[tuple] = []
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                cells = [(*cell, None) for cell in _read(content)]
            except DAMAGED as error:
                cells = [(None, None, None, None, next(text for kind, text in REASONS if isinstance(error, kind)))]
            for cell in cells:
                rows.append((path, *cell))
                if len(rows) >= BATCH:
                    yield _frame(rows, names)
                    rows = []
    if rows:
        yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    # Numbers are nullable: a fault has none.
    return pd.DataFrame(rows, columns=names).astype({"row_no": "Int32", "col_no": "Int32"})


def _read(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """Non-empty cells of one workbook, one sheet after the other, streamed from the archive."""
    book = zipfile.ZipFile(io.BytesIO(content))
    targets = {
        r.get("Id"): r.get("Target").lstrip("/")
        for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    shared, dates = _shared_strings(book), _date_styles(book)
    epoch = _epoch(workbook)
    for sheet in workbook.iter(f"{MAIN}sheet"):
        target = targets[sheet.get(f"{REL}id")]
        with book.open(target if target.startswith("xl/") else f"xl/{target}") as part:
            row_no = 0
            for _, row in ElementTree.iterparse(part):
                if row.tag != f"{MAIN}row":
                    continue
                row_no = int(row.get("r") or row_no + 1)
                col_no = 0
                for cell in row.iter(f"{MAIN}c"):
                    col_no = _column(cell.get("r")) or col_no + 1
                    value = _text(cell, shared, dates, epoch)
                    if value is not None:
                        yield sheet.get("name"), row_no, col_no, value
                row.clear()


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_runs(item) for item in root.iter(f"{MAIN}si")]


def _runs(item: ElementTree.Element) -> str:
    """Text of a string item, without its phonetic reading."""
    own = [t.text or "" for t in item.findall(f"{MAIN}t")]
    rich = [t.text or "" for r in item.findall(f"{MAIN}r") for t in r.findall(f"{MAIN}t")]
    return "".join(own + rich)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    quoted = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')
    own = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{MAIN}numFmt")
        if re.search("[dmyhs]", quoted.sub("", f.get("formatCode") or "").lower())
    }
    formats = root.find(f"{MAIN}cellXfs")
    return {
        i for i, x in enumerate(formats if formats is not None else [])
        if int(x.get("numFmtId") or 0) in DATE_FORMATS | own
    }


def _epoch(workbook: ElementTree.Element) -> dt.datetime:
    props = workbook.find(f"{MAIN}workbookPr")
    late = props is not None and props.get("date1904") in ("1", "true")
    return dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)


def _column(reference: str | None) -> int:
    number = 0
    for letter in re.match("[A-Z]*", reference or "").group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def _text(cell: ElementTree.Element, shared: list[str], dates: set[int], epoch: dt.datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{MAIN}is")
        return None if inline is None else _runs(inline) or None
    value = cell.findtext(f"{MAIN}v")
    if value is None or value == "":
        return None
    if kind == "s":
        return shared[int(value)] or None
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind != "n":
        return value
    number = float(value)
    if int(cell.get("s") or 0) in dates:
        stamp = epoch + dt.timedelta(seconds=round(number * 86_400))
        return str(stamp if number >= 1 else stamp.time())
    return str(int(number)) if number.is_integer() else repr(number)
