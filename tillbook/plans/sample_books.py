"""Folders of workbooks made from sales rows, as input for the folder and workbook scans."""

from __future__ import annotations

import io
import os
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from datetime import date
from typing import BinaryIO
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.schema import CANONICAL_COLUMNS
from tillbook.sources.workbook import Opener, open_file

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_DAY_ZERO = date(1899, 12, 30)

# The fixed parts of a minimal workbook; style 1 shows a number as a date.
_PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/></Types>',
    "xl/workbook.xml": f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets>'
    '<sheet name="Sales" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">'
    f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet {_MAIN}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
}


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, date):
        return f'<c s="1"><v>{(value - _DAY_ZERO).days}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def _cells(column: pa.Array) -> pa.Array:
    """The cells of a column; a value that comes again is made once, and plain amounts as an array."""
    if pa.types.is_float64(column.type):
        size = pc.abs(column)
        usual = pc.and_(pc.greater_equal(size, 1e-4), pc.less(size, 1e10))  # written alike by Arrow and Python, but for ".0"
        if column.null_count == 0 and pc.all(usual).as_py():
            end = pc.if_else(pc.equal(pc.floor(column), column), ".0</v></c>", "</v></c>")
            return pc.binary_join_element_wise("<c><v>", column.cast(pa.string()), end, "")
    coded = column.dictionary_encode("encode")
    return pa.array(map(_cell, coded.dictionary.to_pylist()), pa.string()).take(coded.indices)


def _book(headers: Iterable[str], lines: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, text in _PARTS.items():
            book.writestr(name, text)
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f"<worksheet {_MAIN}><sheetData><row>{''.join(map(_cell, headers))}</row>".encode())
            sheet.write(lines)
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def workbook_bytes(headers: Iterable[str], rows: Iterable[Iterable]) -> bytes:
    """An ``.xlsx`` file with one sheet."""
    return _book(headers, "".join(f"<row>{''.join(map(_cell, row))}</row>" for row in rows).encode())


def workbook_of(batch: pa.RecordBatch) -> bytes:
    """The same file, of the columns of a batch."""
    lines = pc.binary_join_element_wise("<row>", *map(_cells, batch.columns), "</row>", "")
    return _book(batch.schema.names, memoryview(lines.buffers()[2]) if batch.num_rows else b"")


def write_file(path: str, content: bytes) -> None:
    """A file on any file system that Arrow knows; folders are made as needed."""
    path = re.sub("^s3[an]:", "s3:", re.sub("^file:/*", "/", path))
    if "://" not in path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as file:
            file.write(content)
        return
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(inner))
    with system.open_output_stream(inner) as file:
        file.write(content)


def _exists(path: str) -> bool:
    path = re.sub("^s3[an]:", "s3:", re.sub("^file:/*", "/", path))
    if "://" not in path:
        return os.path.exists(path)
    system, inner = fs.FileSystem.from_uri(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def busy_opener(folder: str, failures: int) -> Opener:
    """Opens every third workbook only after so many failures of the storage, which ``folder`` keeps count of."""

    def open_after(path: str) -> BinaryIO:
        name = os.path.basename(path)
        for i in range(failures if zlib.crc32(name.encode()) % 3 == 0 else 0):
            if not _exists(f"{folder}/{name}-{i}"):
                write_file(f"{folder}/{name}-{i}", b"")
                raise OSError("the storage is busy")
        return open_file(path)

    return open_after


def write_workbooks(sales: DataFrame, folder: str) -> None:
    """The rows as workbooks in ``folder``, one per Arrow batch, with small and capital endings.

    Needs no shuffle, and a workbook holds no more rows than an Arrow batch. A
    task that is repeated writes the same files again.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            content = workbook_of(batch)
            path = f"{folder}/sales-{part:05d}-{i:05d}.{'XLSM' if (part + i) % 2 else 'xlsx'}"
            write_file(path, content)
            yield pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

    sales.select(*[F.col(c) for c in CANONICAL_COLUMNS]).mapInArrow(encode, "path string").count()
