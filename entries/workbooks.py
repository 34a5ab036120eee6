"""Writes given rows as workbooks, so that the workbook reader has files to read."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def _letter(index: int) -> str:
    letters, rest = "", index + 1
    while rest:
        rest, letter = divmod(rest - 1, 26)
        letters = chr(ord("A") + letter) + letters
    return letters


def workbook(pdf: pd.DataFrame) -> bytes:
    """One sheet with a header row; text in place, numbers as numbers, empty cells left out."""

    def cell(value, at: str) -> str:
        if value is None or value != value:
            return ""
        if isinstance(value, str):
            return f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f'<c r="{at}"><v>{value}</v></c>'

    lines = [list(pdf.columns), *pdf.astype(object).values.tolist()]
    rows = "".join(
        f'<row r="{n}">' + "".join(cell(v, f"{_letter(i)}{n}") for i, v in enumerate(line)) + "</row>"
        for n, line in enumerate(lines, 1)
    )
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" '
        f'Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook {_MAIN} xmlns:r="{_OFFICE}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" '
        f'Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {_MAIN}><sheetData>{rows}</sheetData></worksheet>",
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return buffer.getvalue()


def write_workbooks(df: DataFrame, folder: str, name: str) -> int:
    """One workbook per batch and value of ``name``, called ``<value> 2019.xlsx``; returns their number."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "://" in folder or folder.startswith("file:"):
            system, base = fs.FileSystem.from_uri(folder)
        else:
            system, base = fs.LocalFileSystem(), folder
        for number, batch in enumerate(batches):
            place = f"{base}/part-{TaskContext.get().partitionId()}-{number}"
            system.create_dir(place, recursive=True)
            files = 0
            for value, rows in batch.groupby(name):
                with system.open_output_stream(f"{place}/{value} 2019.xlsx") as out:
                    out.write(workbook(rows.drop(columns=[name])))
                files += 1
            yield pd.DataFrame({"files": [files]})

    return df.mapInPandas(write, "files long").groupBy().sum("files").first()[0]
