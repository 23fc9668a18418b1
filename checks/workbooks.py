"""Small .xlsx files made from rows, as input for the workbook source."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def _letters(number: int) -> str:
    out = ""
    while number:
        number, rest = divmod(number - 1, 26)
        out = chr(ord("A") + rest) + out
    return out


def build_workbook(sheets: Mapping[str, Sequence[Sequence[str | None]]], shared: bool = False) -> bytes:
    """Bytes of a workbook of text cells, inline or through the shared string table."""
    strings: dict[str, int] = {}

    def cell(row: int, column: int, text: str) -> str:
        at = f"{_letters(column)}{row}"
        if shared:
            return f'<c r="{at}" t="s"><v>{strings.setdefault(text, len(strings))}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for i, rows in enumerate(sheets.values(), start=1):
            lines = [
                f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row, start=1) if v is not None) + "</row>"
                for r, row in enumerate(rows, start=1)
            ]
            book.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
            )
        named = "".join(
            f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, start=1)
        )
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets>{named}</sheets></workbook>')
        targets = "".join(
            f'<Relationship Id="rId{i}" Type="{REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}">{targets}</Relationships>')
        if shared:
            items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{NS}">{items}</sst>')
    return buffer.getvalue()


def _param_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for dataset, entries in zip(batch["dataset_id"], batch["entries"]):
            rows = [["Key", "Value"], *([e["key"], e["value"]] for e in entries)]
            contents.append(build_workbook({"DPS-CDP Params": rows}, shared=len(dataset) % 2 == 0))
        yield pd.DataFrame({"path": batch["dataset_id"] + ".xlsx", "content": contents})


def param_workbooks(pairs: DataFrame) -> DataFrame:
    """(path, content): one workbook per dataset with its 13 parameter rows."""
    entries = F.sort_array(F.collect_list(F.struct("row_no", "key", "value")))
    books = pairs.groupBy("dataset_id").agg(entries.alias("entries"))
    # The rows are few bytes but much Python work, so AQE must not merge them into one task.
    books = books.repartition(pairs.sparkSession.sparkContext.defaultParallelism, "dataset_id")
    return books.mapInPandas(_param_books, "path string, content binary")
