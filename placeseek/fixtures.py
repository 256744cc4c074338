"""Workbooks to read back: the inputs of the file-based queries and tests.

The library reads workbooks and writes none; no workbook is at hand, so these
are made from the driver's tables.  Each task writes its rows as workbooks of
its own into a folder on a path that Python can open (the shared folder).
"""

from __future__ import annotations

import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from placeseek.session import ship_package

# Fixed value: Excel's sheet row limit.
MAX_SHEET_ROWS = 1_048_576
_MAIN_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"


def write_workbooks(df: DataFrame, folder: str, split_by: str | None = None, max_rows: int = MAX_SHEET_ROWS - 1) -> None:
    """Append ``df`` to ``folder`` as workbooks: per task, and with ``split_by`` per value of
    that column; a full sheet rolls over to a further workbook.

    Names carry an id of this call, so a second call adds files and a retried task rewrites its
    own.  Rows come sorted by ``split_by``, so one workbook is open at a time.
    """
    ship_package(df.sparkSession)
    names, call = df.columns, uuid.uuid4().hex[:12]
    local = re.sub("^file:(//)?", "", folder)
    if re.match("[A-Za-z][A-Za-z0-9+.-]*:", local):
        raise ValueError(f"workbooks are written to paths that Python can open, not to {folder}")
    key = names.index(split_by) if split_by else None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(local, exist_ok=True)
        task, book, value, n = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if book is None or book.rows > max_rows or (key is not None and row[key] != value):
                    if book is not None:
                        book.close()
                    value = None if key is None else row[key]
                    label = "" if key is None else f"{split_by}={value}-"
                    book = WorkbookStream(f"{local}/{label}part-{task:05d}-{n:05d}-{call}.xlsx", names)
                    n += 1
                book.add(row)
        if book is not None:
            book.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    rows = df.sortWithinPartitions(split_by) if split_by else df
    rows.mapInArrow(step, "files long").agg({"files": "sum"}).collect()


# Characters XML cannot carry are written as _xHHHH_, a literal text of that shape guarded by _x005F_.
_XSTRING_LITERAL = re.compile(r"_(x[0-9A-Fa-f]{4}_)")
_XSTRING_UNSAFE = re.compile(r"[\x00-\x08\x0b\x0c\x0d\x0e-\x1f]")


def _encode_xstring(text: str) -> str:
    text = _XSTRING_LITERAL.sub(r"_x005F_\1", text)
    return _XSTRING_UNSAFE.sub(lambda m: f"_x{ord(m.group()):04X}_", text)


def _cell_ref(col: int, row: int) -> str:
    letters = ""
    col += 1
    while col:
        col, rem = divmod(col - 1, 26)
        letters = chr(65 + rem) + letters
    return f"{letters}{row}"


_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
    "</Types>"
)
_PACKAGE_RELS = (
    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{_PKG_REL_NS}">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
    "</Relationships>"
)
_WORKBOOK = (
    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><workbook xmlns="{_MAIN_NS}" '
    f'xmlns:r="{_REL_NS}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_WORKBOOK_RELS = (
    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{_PKG_REL_NS}">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
    "</Relationships>"
)
# Rows of sheet XML gathered before one write into the compressed member.
_WRITE_ROWS = 2048


class WorkbookStream:
    """Writes a one-sheet .xlsx row by row to ``path``, which appears when complete.

    The sheet goes straight into its (compressed) zip member; only the
    table of distinct strings stays in memory until ``close``.
    """

    def __init__(self, path: str, header):
        self._path, self._part = path, f"{path}.{uuid.uuid4().hex[:8]}.part"
        self._zip = zipfile.ZipFile(self._part, "w", zipfile.ZIP_DEFLATED)
        self._sheet = self._zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self._strings: dict[str, int] = {}
        self._pending: list[str] = [
            f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN_NS}"><sheetData>'
        ]
        self.rows = 0
        self.add(header)

    def _cell(self, ci: int, ri: int, v) -> str:
        if v is None:
            return ""
        ref = _cell_ref(ci, ri)
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        index = self._strings.setdefault(str(v), len(self._strings))
        return f'<c r="{ref}" t="s"><v>{index}</v></c>'

    def add(self, values) -> None:
        self.rows += 1
        ri = self.rows
        self._pending.append(f'<row r="{ri}">' + "".join(self._cell(ci, ri, v) for ci, v in enumerate(values)) + "</row>")
        if len(self._pending) >= _WRITE_ROWS:
            self._flush()

    def _flush(self) -> None:
        self._sheet.write("".join(self._pending).encode("utf-8"))
        self._pending = []

    def close(self) -> None:
        self._pending.append("</sheetData></worksheet>")
        self._flush()
        self._sheet.close()
        shared = (
            f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<sst xmlns="{_MAIN_NS}" count="{len(self._strings)}" uniqueCount="{len(self._strings)}">'
            + "".join(
                f'<si><t xml:space="preserve">{escape(_encode_xstring(s))}</t></si>' for s in self._strings
            )
            + "</sst>"
        )
        for name, body in (
            ("[Content_Types].xml", _CONTENT_TYPES),
            ("_rels/.rels", _PACKAGE_RELS),
            ("xl/workbook.xml", _WORKBOOK),
            ("xl/_rels/workbook.xml.rels", _WORKBOOK_RELS),
            ("xl/sharedStrings.xml", shared),
        ):
            self._zip.writestr(name, body)
        self._zip.close()
        os.replace(self._part, self._path)


def write_workbook(path: str, header: list[str], rows: list[tuple]) -> None:
    """One workbook with a header and rows."""
    book = WorkbookStream(path, header)
    for row in rows:
        book.add(row)
    book.close()
