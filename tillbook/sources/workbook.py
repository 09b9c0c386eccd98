"""Scan of OOXML workbooks (``.xlsx``, ``.xlsm``) into raw text rows.

Spark distributes the paths; each task opens its own files where they are, reads
only the parts it needs with the standard library, and hands Arrow batches back.
A sheet holds at most 1,048,576 rows by the file format, so one workbook is a
bounded unit of work; its rows are streamed, its shared strings go to a file
beyond a bound, and nothing of it is held whole.
"""

from __future__ import annotations

import os
import re
import struct
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import chain
from posixpath import basename, join, normpath
from tempfile import TemporaryFile
from typing import BinaryIO
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.schema import LANDING_SCHEMA

_ROWS_PER_BATCH = 4096
_SLICE = 1 << 20
_ARROW_SCHEMA = pa.schema([
    ("source_file", pa.string()),
    ("path", pa.string()),
    ("modified_at", pa.timestamp("us", tz="UTC")),
    ("row_no", pa.int64()),
    ("cells", pa.list_(pa.string())),
    ("error", pa.string()),
    ("storage", pa.bool_()),
    ("rows_read", pa.int64()),
    ("seconds", pa.float64()),
    ("kind", pa.string()),
])
# What Arrow's file systems open; credentials are those of its own configuration.
SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")
Opener = Callable[[str], BinaryIO]
# Built-in number formats that show a date or time.
_DATE_FORMAT_IDS = set(range(14, 23)) | set(range(27, 37)) | set(range(45, 48)) | set(range(50, 59))


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _children(root, *names):
    return [e for e in root.iter() if _tag(e) in names]


def _plain_text(element) -> str:
    """Text of a shared or inline string without phonetic hints."""
    if len(element) == 1 and element[0].tag.endswith("}t"):
        return element[0].text or ""
    parts = []
    for child in element:
        name = _tag(child)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.extend(t.text or "" for t in child if _tag(t) == "t")
    return "".join(parts)


#: Shared strings of so many bytes are held in memory; those beyond go to a file.
STRING_BYTES = 32 << 20
_RECENT = 4096


class SharedStrings:
    """The string table of a workbook. Beyond a bound its bytes, and where each string begins, are in files.

    The files are the task's own scratch: they have no name, and go with the task.
    """

    def __init__(self, bound: int | None = None) -> None:
        self._bound = STRING_BYTES if bound is None else bound
        self._near: list[str] = []
        self._held = self._written = 0
        self._texts: BinaryIO | None = None
        self._ends: BinaryIO | None = None
        self._recent: dict[int, str] = {}

    def append(self, text: str) -> None:
        if self._texts is None:
            if self._held <= self._bound:
                self._near.append(text)
                self._held += len(text) + 64
                return
            self._texts, self._ends = TemporaryFile(), TemporaryFile()
            self._ends.write(struct.pack("<q", 0))
        data = text.encode("utf-8", "surrogatepass")
        self._texts.write(data)
        self._written += len(data)
        self._ends.write(struct.pack("<q", self._written))

    def close_writing(self) -> None:
        """To be called once, after the last string."""
        if self._texts is not None:
            self._texts.flush()
            self._ends.flush()

    def __getitem__(self, i: int) -> str:
        if 0 <= i < len(self._near):
            return self._near[i]
        text = self._recent.get(i)
        if text is None:
            where = os.pread(self._ends.fileno(), 16, 8 * (i - len(self._near))) if self._ends and i >= 0 else b""
            if len(where) < 16:
                raise IndexError(f"no shared string {i}")
            begin, end = struct.unpack("<qq", where)
            text = os.pread(self._texts.fileno(), end - begin, begin).decode("utf-8", "surrogatepass")
            if len(self._recent) >= _RECENT:
                self._recent.clear()
            self._recent[i] = text
        return text


def _shared_strings(book: zipfile.ZipFile) -> SharedStrings:
    strings = SharedStrings()
    if "xl/sharedStrings.xml" not in book.namelist():
        return strings
    with book.open("xl/sharedStrings.xml") as part:
        events = ElementTree.iterparse(part, events=("start", "end"))
        _, root = next(events)
        for event, element in events:
            if event == "end" and _tag(element) == "si":
                strings.append(_plain_text(element))
                root.clear()  # also of the elements that were read
    strings.close_writing()
    return strings


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers whose number format shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dated = set(_DATE_FORMAT_IDS)
    for fmt in _children(root, "numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", fmt.get("formatCode", ""))
        (dated.add if re.search("[dmyhs]", code, re.I) else dated.discard)(int(fmt.get("numFmtId")))
    styles = set()
    for block in _children(root, "cellXfs"):
        for i, xf in enumerate(x for x in block if _tag(x) == "xf"):
            if int(xf.get("numFmtId", "0")) in dated:
                styles.add(i)
    return styles


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, datetime]:
    """Part name of the first sheet and day zero of the workbook's calendar."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    from_1904 = any(p.get("date1904") in ("1", "true") for p in _children(root, "workbookPr"))
    sheet = _children(root, "sheet")[0]
    wanted = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in _children(links, "Relationship") if r.get("Id") == wanted)
    part = target.lstrip("/") if target.startswith("/") else normpath(join("xl", target))
    return part, datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)


def _column_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _number_text(value: str) -> str:
    """Numbers as shortest text: files store 0.1 as 0.10000000000000001."""
    return value if value.lstrip("-").isdigit() else repr(float(value))


def _date_text(value: str, day_zero: datetime) -> str:
    """A day number as a date, or a date and time."""
    moment = day_zero + timedelta(milliseconds=round(float(value) * 86_400_000))
    return str(moment.date()) if moment.time() == datetime.min.time() else moment.isoformat(" ", "seconds")


def _cell_text(cell, ns: str, strings: SharedStrings, dated: set[int], day_zero: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(ns + "is")
        return None if inline is None else _plain_text(inline)
    value = cell.findtext(ns + "v")
    if value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind != "n":
        return value
    style = cell.get("s")
    if style is not None and int(style) in dated:
        return _date_text(value, day_zero)
    return _number_text(value)


def _sheet_slices(sheet) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Whole rows of a sheet in slices, each with what opens the sheet's data before it and closes it after.

    A slice is small, so that memory stays flat, and large enough for C code to do the work instead of one Python
    event per cell.
    """
    buffer, opening = b"", None
    while opening is None:
        block = sheet.read(_SLICE)
        buffer += block
        opening = re.search(rb"<([\w.-]+:)?sheetData\b[^>]*>", buffer)
        if opening is None and not block:
            raise ValueError("the sheet has no data section")
    if opening[0].endswith(b"/>"):
        return
    prefix = opening[1] or b""
    head, buffer = buffer[: opening.end()], buffer[opening.end():]
    tail = b"</" + prefix + b"sheetData>"
    row_end = b"</" + prefix + b"row>"
    while True:
        cut = buffer.rfind(row_end) + len(row_end)
        if cut >= len(row_end):
            yield head, buffer[:cut], tail + b"</" + prefix + b"worksheet>"
            buffer = buffer[cut:]
        block = sheet.read(_SLICE)
        if not block:
            break
        buffer += block
    if tail not in buffer:
        raise ValueError("the sheet is cut off")


def _parsed_rows(elements, strings: SharedStrings, dated: set[int], day_zero: datetime) -> Iterator[list[str | None]]:
    """The cells of row elements."""
    for element in elements:
        ns = element.tag[:-3]
        tag = ns + "c"
        row: list[str | None] = []
        for cell in element:
            if cell.tag != tag:
                continue
            ref = cell.get("r")
            if ref:
                row.extend([None] * (_column_index(ref) - len(row)))
            row.append(_cell_text(cell, ns, strings, dated, day_zero))
        yield row


# Rows as spreadsheet programs mostly write them: cells with their place, style and kind, and a value or an inline string.
_ROW_TAG = re.compile(
    rb'<row(?: r="[0-9]+")?(?: spans="[0-9: ]*")?(?: s="[0-9]+")?(?: customFormat="[0-9a-z]*")?(?: ht="[0-9.]*")?(?: customHeight="[0-9a-z]*")?>'
)
_CELL_TAG = re.compile(rb'<c(?: r="([A-Z]{1,3})[0-9]{1,7}")?(?: s="([0-9]{1,9})")?(?: t="([A-Za-z]{1,9})")?(/)?>')
# Kinds of tags, and which of them may follow which. White space may stand behind those of _SPACED, text behind those of _HOLDING.
_ROW, _ROW_END, _CELL, _EMPTY, _CELL_END, _VALUE, _VALUE_END, _INLINE, _INLINE_END, _TEXT, _TEXT_END = range(11)
_TAGS = {
    b"</row>": _ROW_END, b"</c>": _CELL_END, b"<v>": _VALUE, b"</v>": _VALUE_END, b"<is>": _INLINE, b"</is>": _INLINE_END,
    b"<t>": _TEXT, b'<t xml:space="preserve">': _TEXT, b"</t>": _TEXT_END,
}
_FOLLOWS = np.zeros(121, bool)
for _tag_kind, _next_kinds in {
    _ROW: (_CELL, _EMPTY, _ROW_END), _EMPTY: (_CELL, _EMPTY, _ROW_END), _CELL_END: (_CELL, _EMPTY, _ROW_END),
    _CELL: (_CELL_END, _VALUE, _INLINE), _VALUE: (_VALUE_END,), _VALUE_END: (_CELL_END,), _INLINE: (_TEXT,),
    _TEXT: (_TEXT_END,), _TEXT_END: (_INLINE_END,), _INLINE_END: (_CELL_END,), _ROW_END: (_ROW,),
}.items():
    _FOLLOWS[_tag_kind * 11 + np.array(_next_kinds)] = True
_SPACED = np.isin(range(11), (_ROW, _ROW_END, _EMPTY, _CELL_END))
_HOLDING = np.isin(range(11), (_VALUE, _TEXT))
# What a cell holds, by its kind and style.
_AS_IS, _IN_PLACE, _NUMBER, _DATE, _SHARED, _TRUTH = range(6)
_ENTITIES = {"&gt;": ">", "&lt;": "<", "&quot;": '"', "&apos;": "'", "&amp;": "&"}  # the last one last
_REMEMBERED = 10_000


@dataclass
class _Rows:
    """Rows of text cells as one flat array, and where in it each row begins (and the last one ends)."""

    starts: np.ndarray
    cells: pa.Array

    @classmethod
    def of(cls, rows: list[list[str | None]]) -> _Rows:
        starts = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) for r in rows], out=starts[1:])
        return cls(starts, pa.array(list(chain.from_iterable(rows)), pa.string()))

    def lists(self) -> list[list[str | None]]:
        cells = self.cells.to_pylist()
        return [cells[a:b] for a, b in zip(self.starts[:-1], self.starts[1:])]

    def filled(self) -> _Rows:
        """Those with a cell that is not null."""
        known = np.zeros(len(self.cells) + 1, np.int64)
        np.cumsum(self.cells.is_valid().to_numpy(zero_copy_only=False), out=known[1:])
        keep = known[self.starts[1:]] > known[self.starts[:-1]]
        if keep.all():
            return self
        sizes = np.diff(self.starts)
        starts = np.zeros(int(keep.sum()) + 1, np.int64)
        np.cumsum(sizes[keep], out=starts[1:])
        return _Rows(starts, self.cells.filter(pa.array(np.repeat(keep, sizes))))

    def columns(self, width: int, chosen: list[int]) -> pa.Array:
        """The chosen ones of the first ``width`` columns of all rows, flat, cut or padded."""
        sizes = np.diff(self.starts)
        if len(chosen) == width and (sizes == width).all():
            return self.cells
        chosen = np.array(chosen, np.int64)
        places = np.where(chosen < sizes[:, None], self.starts[:-1, None] + chosen, -1).ravel()
        return self.cells.take(pa.array(places, mask=places < 0))


class _PlainRows:
    """Reads slices of rows in their usual form without an XML parser, to the same cells; all others give None.

    Tags and texts of a slice are told apart by array operations; Python sees each distinct tag, number, date and string number once.
    """

    def __init__(self, strings: SharedStrings, dated: set[int], day_zero: datetime) -> None:
        self._strings, self._dated, self._day_zero = strings, dated, day_zero
        self._tags: dict[bytes, tuple[int, int, int]] = {}
        self._head: bytes | None = None
        self._sound = False

    def rows(self, head: bytes, content: bytes) -> Iterator[list[str | None]] | None:
        """The rows of a slice as lists; going through them raises ValueError if one cannot be read."""
        found = self._cells(head, content)
        return None if found is None else self._read(*found)

    def table(self, head: bytes, content: bytes) -> _Rows | None:
        """The rows of a slice at once; None also if one of them cannot be read, which the parser then says."""
        found = self._cells(head, content)
        if found is None:
            return None
        try:
            return _Rows(found[0], self._converted(*found[1:]))
        except (ValueError, IndexError, OverflowError):
            return None

    def _read(self, starts: np.ndarray, texts: pa.Array, kinds: np.ndarray) -> Iterator[list[str | None]]:
        yield from _Rows(starts, self._converted(texts, kinds)).lists()

    def _cells(self, head: bytes, content: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray] | None:
        """Where rows begin, the texts of all cells, and what they hold."""
        if head is not self._head:
            named = re.match(rb"<\?xml[^>]*?(?:\sencoding=[\"']([^\"']*)[\"'])?[^>\"']*\?>", head)
            coded = not head.startswith(b"<?xml") or (named is not None and (named[1] or b"utf-8").lower() == b"utf-8")
            plain = coded and head.startswith(b"<") and b"<!" not in head and not re.search(rb"<[\w.-]+:sheetData\b", head)
            self._head, self._sound = head, plain and _parses(head)
        if not self._sound or not _legal(content):
            return None
        array = np.frombuffer(content, np.uint8)
        opens, closes = np.flatnonzero(array == ord("<")), np.flatnonzero(array == ord(">"))
        if not len(opens) or content[: opens[0]].strip(b" \t\n"):
            return None
        if len(opens) != len(closes):
            # The first ">" behind a "<" ends the tag; a text behind it holds others.
            first = np.searchsorted(closes, opens)
            if first[-1] >= len(closes):
                return None
            closes = closes[first]
        # Tags and texts by turns.
        edges = np.empty(2 * len(opens) + 1, np.int32)
        edges[:-1:2], edges[1::2], edges[-1] = opens, closes + 1, len(content)
        sizes = np.diff(edges)
        if sizes.min() < 0:
            return None
        pieces = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(content)])
        tags = pieces.take(pa.array(np.arange(0, len(pieces), 2, np.int32))).dictionary_encode()
        known = [self._tag(t) for t in tags.dictionary.to_pylist()]
        if None in known:
            return None
        by_tag, tags = np.array(known, np.int64), tags.indices.to_numpy()
        kinds = by_tag[:, 0].astype(np.int8)[tags]
        if kinds[0] != _ROW or kinds[-1] != _ROW_END or not _FOLLOWS[kinds[:-1] * np.int8(11) + kinds[1:]].all():
            return None
        filled = sizes[1::2] > 0
        if not filled[kinds == _VALUE].all():
            return None
        other = np.flatnonzero(filled & ~_HOLDING[kinds])
        if len(other) and (not _SPACED[kinds[other]].all() or any(t.strip(b" \t\n") for t in set(pieces.take(pa.array(2 * other + 1)).to_pylist()))):
            return None
        cells = np.flatnonzero((kinds == _CELL) | (kinds == _EMPTY))
        places, holds = by_tag[tags[cells], 1:].T
        within = np.where(kinds[cells] == _EMPTY, _CELL_END, kinds[cells + 1])
        # A value of a cell that says its string is in place counts as little as the reverse.
        texts = np.where((holds == _IN_PLACE) & (within == _INLINE), 2 * cells + 5, np.where((holds != _IN_PLACE) & (within == _VALUE), 2 * cells + 3, -1))
        firsts, lasts = np.flatnonzero(kinds == _ROW), np.flatnonzero(kinds == _ROW_END)
        starts = np.append(np.searchsorted(cells, firsts), len(cells))
        if (places >= 0).any():
            starts, (texts, holds) = _placed(starts, places, texts, holds)
        values = pieces.take(pa.array(texts, mask=texts < 0)).cast(pa.string())
        if b"&" in content:
            for entity, character in _ENTITIES.items():
                values = pc.replace_substring(values, entity, character)
        return starts, values, holds

    def _tag(self, tag: bytes) -> tuple[int, int, int] | None:
        """Kind of a tag, and of a cell its column (-1: not named) and what it holds; None for an unusual one."""
        found = self._tags.get(tag)
        if found is None:
            if tag in _TAGS:
                found = (_TAGS[tag], -1, 0)
            elif cell := _CELL_TAG.fullmatch(tag):
                ref, style, kind, empty = cell.groups()
                if kind == b"inlineStr":
                    holds = _IN_PLACE
                elif kind and kind != b"n":
                    holds = {b"s": _SHARED, b"b": _TRUTH}.get(kind, _AS_IS)
                else:
                    holds = _DATE if style and int(style) in self._dated else _NUMBER
                found = (_EMPTY if empty else _CELL, _column_index(ref.decode()) if ref else -1, holds)
            elif _ROW_TAG.fullmatch(tag):
                found = (_ROW, -1, 0)
            else:
                return None
            if len(self._tags) >= _REMEMBERED:
                self._tags.clear()
            self._tags[tag] = found
        return found

    def _converted(self, texts: pa.Array, kinds: np.ndarray) -> pa.Array:
        """The texts as cells hold them; raises ValueError or IndexError for one that cannot be read."""
        parts, places, n = [texts], np.arange(len(texts)), len(texts)
        for kind, convert in (
            (_NUMBER, _number_text), (_DATE, lambda v: _date_text(v, self._day_zero)),
            (_SHARED, lambda v: self._strings[int(v)]), (_TRUTH, lambda v: "true" if v == "1" else "false"),
        ):
            at = np.flatnonzero(kinds == kind)
            if not len(at):
                continue
            coded = texts.take(pa.array(at)).dictionary_encode()
            made = pa.array([convert(v) for v in coded.dictionary.to_pylist()], pa.string())
            if not made.equals(coded.dictionary):
                parts.append(made)
                numbers = coded.indices.fill_null(-1).to_numpy()
                places[at] = np.where(numbers < 0, at, numbers + n)
                n += len(made)
        return texts if len(parts) == 1 else pa.concat_arrays(parts).take(pa.array(places))


def _legal(content: bytes) -> bool:
    """Whether all characters are such as XML holds and a parser leaves, and all entities are those of ``_ENTITIES``."""
    low = np.count_nonzero(np.frombuffer(content, np.uint8) < 32)
    if low and low != content.count(b"\t") + content.count(b"\n"):
        return False
    if not content.isascii():
        try:
            content.decode()
        except UnicodeDecodeError:
            return False
        if b"\xef\xbf\xbe" in content or b"\xef\xbf\xbf" in content:
            return False
    if b"&" in content and content.count(b"&") != sum(content.count(e.encode()) for e in _ENTITIES):
        return False
    return b"]]>" not in content


def _placed(starts: np.ndarray, places: np.ndarray, texts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Rows with nothing (-1) where a cell's place is beyond the end of those before it."""
    sizes = np.diff(starts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.arange(len(places)) - starts[row]
    # How far a cell is moved is the greatest of what the cells up to it in the row ask for.
    step = int(max(places.max(), 0)) + 1
    moved = np.maximum.accumulate(np.maximum(places - order, 0) + row * step) - row * step
    if not moved.any():
        return starts, (texts, kinds)
    at = order + moved
    sizes = np.zeros(len(sizes), np.int64)
    np.maximum.at(sizes, row, at + 1)
    begun = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=begun[1:])
    spread = np.full(begun[-1], -1, np.int64), np.full(begun[-1], _AS_IS, np.int64)
    for out, values in zip(spread, (texts, kinds)):
        out[begun[row] + at] = values
    return begun, spread


def _parses(head: bytes) -> bool:
    """Whether what comes before the rows is well-formed; if not, the parser says so."""
    try:
        ElementTree.fromstring(head + b"</sheetData></worksheet>")
    except ElementTree.ParseError:
        return False
    return True


def check_schemes(files: DataFrame) -> None:
    """Raises ValueError if :func:`open_file` does not know the scheme of a path; nothing is opened."""
    scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    unknown = files.select(scheme.alias("scheme")).distinct().filter(~F.col("scheme").isin("", *SCHEMES)).limit(5).collect()
    if unknown:
        names = ", ".join(sorted(r.scheme for r in unknown))
        raise ValueError(f"no way to open paths of the scheme {names}; known are {', '.join(SCHEMES)}, others need an opener")


def open_file(path: str) -> BinaryIO:
    """A seekable file of one of ``SCHEMES``; ``s3a`` and ``s3n`` are read as ``s3``."""
    path = re.sub("^s3[an]:", "s3:", path)
    if path.startswith("file:"):
        return open(re.sub("^file:/*", "/", path), "rb")
    if "://" not in path:
        return open(path, "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _sheet_tables(file: BinaryIO) -> Iterator[_Rows]:
    """Non-empty rows of the first sheet, slice by slice, header row first."""
    with zipfile.ZipFile(file) as book:
        part, day_zero = _first_sheet(book)
        strings, dated = _shared_strings(book), _date_styles(book)
        usual = _PlainRows(strings, dated, day_zero)
        with book.open(part) as sheet:
            for head, content, tail in _sheet_slices(sheet):
                table = usual.table(head, content)
                if table is not None:
                    yield table.filled()
                    continue
                rows, problem = [], None
                try:
                    for row in _parsed_rows(ElementTree.fromstring(head + content + tail)[-1], strings, dated, day_zero):
                        rows.append(row)
                except Exception as raised:  # rows before one that cannot be read count
                    problem = raised
                yield _Rows.of(rows).filled()
                if problem is not None:
                    raise problem


def sheet_rows(file: BinaryIO) -> Iterator[list[str | None]]:
    """Non-empty rows of the first sheet as text cells, header row first."""
    for table in _sheet_tables(file):
        yield from table.lists()


def _read(file: BinaryIO) -> tuple[list[str], Iterator[tuple[pa.Array, int]]]:
    """Headers, and the cells below them, cut or padded to the headed columns, with the number of rows."""
    tables = _sheet_tables(file)
    top = next((t for t in tables if len(t.starts) > 1), None)
    if top is None:
        return [], iter(())
    first = top.cells.slice(0, top.starts[1]).to_pylist()
    headed = [i for i, h in enumerate(first) if h is not None and h != ""]
    rest = _Rows(top.starts[1:] - top.starts[1], top.cells.slice(top.starts[1]))
    return [first[i] for i in headed], ((t.columns(len(first), headed), len(t.starts) - 1) for t in chain((rest,), tables))


def _batch(path, modified, first_row_no: int, cells: pa.Array, n: int, kind: str, **known) -> pa.RecordBatch:
    """So many rows of equal width, whose cells are given flat, as an Arrow batch."""
    width = len(cells) // n
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), cells)
    constants = {"source_file": basename(path), "path": path, "modified_at": modified, "kind": kind, **known}
    columns = {f.name: pa.repeat(pa.scalar(constants.get(f.name), f.type), n) for f in _ARROW_SCHEMA if f.name not in ("row_no", "cells")}
    columns["row_no"] = pa.array(np.arange(first_row_no, first_row_no + n, dtype=np.int64))
    columns["cells"] = lists
    return pa.RecordBatch.from_arrays([columns[f.name] for f in _ARROW_SCHEMA], schema=_ARROW_SCHEMA)


def _decode_file(path: str, modified, opener: Opener) -> Iterator[pa.RecordBatch]:
    headers, error, storage, row_no, started = [], None, False, 1, time.monotonic()
    try:
        with opener(path) as file:
            headers, tables = _read(file)
            pending, n, full = pa.array([], pa.string()), 0, _ROWS_PER_BATCH * len(headers)
            for cells, more in tables:
                pending, n = pa.concat_arrays([pending, cells]), n + more
                while n >= _ROWS_PER_BATCH:
                    yield _batch(path, modified, row_no, pending.slice(0, full), _ROWS_PER_BATCH, "row")
                    row_no, pending, n = row_no + _ROWS_PER_BATCH, pending.slice(full), n - _ROWS_PER_BATCH
            if n:
                yield _batch(path, modified, row_no, pending, n, "row")
                row_no += n
    except FileNotFoundError as problem:
        error = f"Not readable as a workbook ({type(problem).__name__}: {problem})"
    except OSError as problem:  # the storage is at fault, perhaps for a moment: another try may open the file
        error, storage = f"Not readable from storage ({type(problem).__name__}: {problem})", True
    except MemoryError:
        raise
    except Exception as problem:  # the file is at fault, not the job: reject it and go on
        error = f"Not readable as a workbook ({type(problem).__name__}: {problem})"
    seconds = round(time.monotonic() - started, 3)
    yield _batch(path, modified, 0, pa.array(headers, pa.string()), 1, "file", error=error, storage=storage, rows_read=row_no - 1, seconds=seconds)


def scan_workbooks(files: DataFrame, opener: Opener | None = None) -> DataFrame:
    """Decode the workbooks of ``(path, modificationTime)`` into landing records (``LANDING_SCHEMA``).

    ``opener`` takes the place of :func:`open_file`, for other file systems or credentials. It runs in the tasks.
    """
    if opener is None:
        check_schemes(files)
    use = opener or open_file

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, modified in zip(batch.column("path"), batch.column("modificationTime"), strict=True):
                yield from _decode_file(path.as_py(), modified.as_py(), use)

    return files.select("path", "modificationTime").mapInArrow(decode, LANDING_SCHEMA)


def storage_failures(landing: DataFrame) -> DataFrame:
    """(path, modified_at, error) of the files that the storage did not give."""
    return landing.filter("kind = 'file' AND storage").select("path", "modified_at", "error")


def raw_files(landing: DataFrame) -> DataFrame:
    """One row per workbook: headers, or the reason it could not be read."""
    return landing.filter("kind = 'file'").select(
        "path", "source_file", "modified_at", F.col("cells").alias("headers"), "error", "rows_read", "seconds"
    )


def raw_rows(landing: DataFrame) -> DataFrame:
    """The data rows of all workbooks."""
    return landing.filter("kind = 'row'").select("path", "source_file", "row_no", "cells")
