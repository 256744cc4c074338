"""Excel workbooks as tables (SRC1-SRC3, SRC6).

Spark lists and opens the files (``binaryFile``: any Hadoop file system, any
name) and deals them over tasks by size, small ones together; a task turns the
bytes of its workbooks into rows.  A workbook is never split (a zip archive
cannot be; a sheet holds at most 1,048,576 rows) and its first sheet is read as
a stream of rows.

Every row of the sheet after the header is a row, also one without a value.  A
schema is matched to the sheet's columns by position.  An empty or absent cell
is ``''`` in a text column (null with ``empty_as_null``) and null in others.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructType

from placeseek.session import ship_package

BATCH_ROWS = 8192
_MAIN_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

# ----------------------------------------------------------------- files


def workbook_files(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """``path`` and ``content`` of the workbooks that ``path`` names: a file, a glob,
    or a folder (its ``.xlsx`` files in any case, not those of folders below it).
    A name with glob characters that matches nothing is taken literally.
    Naming no existing file is an error; a folder without workbooks is an empty table."""

    def load(pattern: str | list[str]) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
        return reader.load(pattern).select("path", "content")

    try:
        if only is None:
            files = load(path)
        else:  # as many paths as the driver lists anyway
            paths = [_literal(r[0]) for r in only.select("path").collect()]
            files = load(paths) if paths else load(path).limit(0)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND" or not re.search(r"[\[\]{}*?]", path):
            raise
        files = load(_literal(path))
    return files.where(files["path"].rlike(r"(?i)\.xlsx$"))


def _literal(path: str) -> str:
    """A pattern that matches ``path`` alone."""
    return re.sub(r"([\[\]{}*?])", r"\\\1", path)


# ----------------------------------------------------------------- parsing


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if "A" <= ch <= "Z":
            n = n * 26 + (ord(ch) - 64)
        elif "a" <= ch <= "z":
            n = n * 26 + (ord(ch) - 96)
        else:
            break
    return n - 1


# Characters XML cannot carry (control characters, a carriage return) stand
# as _xHHHH_; a literal text of that shape is guarded by _x005F_.
_XSTRING_ESCAPE = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _decode_xstring(text: str) -> str:
    if "_x" not in text:
        return text
    return _XSTRING_ESCAPE.sub(lambda m: chr(int(m.group(1), 16)), text)


def _text_of(el) -> str:
    """Displayed text of a string item: its ``t``, or the ``t`` of each
    rich-text run ``r``; phonetic hints (``rPh``) are not displayed."""
    parts = []
    for child in el:
        tag = _local(child.tag)
        if tag == "t":
            parts.append(child.text or "")
        elif tag == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return _decode_xstring("".join(parts))


def _tags(name: str) -> tuple[str, ...]:
    return (f"{{{_MAIN_NS}}}{name}", name)


_ROW, _CELL, _VALUE = _tags("row"), _tags("c"), _tags("v")
_SHARED_ITEM = _tags("si")


class SharedStrings:
    """The shared-string table, parsed only as far as the cells read need.

    Strings are numbered in order of first use, so reading a header or a
    sample touches the start of the table only; a full read of the sheet
    parses it all, once.
    """

    def __init__(self, z: zipfile.ZipFile):
        name = next((n for n in z.namelist() if n.lower() == "xl/sharedstrings.xml"), None)
        self._items: list[str] = []
        self._events = ET.iterparse(z.open(name), events=("end",)) if name else None

    def __getitem__(self, i: int) -> str:
        while i >= len(self._items) and self._events is not None:
            try:
                _, el = next(self._events)
            except StopIteration:
                self._events = None
                break
            if el.tag in _SHARED_ITEM:
                self._items.append(_text_of(el))
                el.clear()
        return self._items[i]


def first_sheet(z: zipfile.ZipFile) -> str:
    names = set(z.namelist())
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        sheet = next(e for e in wb.iter() if _local(e.tag) == "sheet")
        rid = sheet.get(f"{{{_REL_NS}}}id")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for rel in rels:
            if rel.get("Id") == rid:
                target = rel.get("Target")
                path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                    posixpath.join("xl", target)
                )
                if path in names:
                    return path
    except (KeyError, StopIteration, ET.ParseError):
        pass
    sheets = sorted(n for n in names if n.startswith("xl/worksheets/") and n.endswith(".xml"))
    if not sheets:
        raise ValueError("workbook has no worksheet")
    return sheets[0]


def _cell_value(c, kind: str, strings: SharedStrings):
    v = None
    for x in c:
        if x.tag in _VALUE:
            v = x.text
            break
    if kind == "s":
        return strings[int(v)] if v is not None else None
    if kind == "inlineStr":
        inline = next((x for x in c if _local(x.tag) == "is"), None)
        return _text_of(inline) if inline is not None else None
    if kind in ("str", "d"):
        return v
    if kind == "b":
        return None if v is None else v.strip() in ("1", "true")
    if kind == "e":
        return None
    return float(v) if v not in (None, "") else None


def is_row(el) -> bool:
    return el.tag in _ROW


def row_cells(el, strings: Mapping[int, str] | SharedStrings) -> dict[int, object]:
    """The values of a row element by column index."""
    cells: dict[int, object] = {}
    nxt = 0
    for c in el:
        if c.tag not in _CELL:
            continue
        ref = c.get("r")
        idx = _col_index(ref) if ref else nxt
        nxt = idx + 1
        val = _cell_value(c, c.get("t", "n"), strings)
        if val is not None:
            cells[idx] = val
    return cells


def sheet_rows(content: bytes) -> Iterator[dict[int, object]]:
    """Rows of the first sheet as ``{column index: value}``, a row without a value
    as an empty dict.  Values: ``str``, ``float`` or ``bool``.

    Only element ends are parsed; a row is read when its end arrives, then
    cleared, so memory holds one row (plus an empty shell per row read).
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = SharedStrings(z)
        with z.open(first_sheet(z)) as f:
            for _, el in ET.iterparse(f, events=("end",)):
                if is_row(el):
                    cells = row_cells(el, strings)
                    el.clear()
                    yield cells


def header_names(cells: dict[int, object]) -> list[str]:
    """Names of a header row; a column without one is ``_c`` and its number."""
    width = max(cells) + 1 if cells else 0
    return [text(cells[i]) if cells.get(i) not in (None, "") else f"_c{i}" for i in range(width)]


# ----------------------------------------------------------------- values


def text(v: object) -> str:
    """A cell's value as text: whole numbers without a fraction."""
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() and abs(v) < 1e16 else repr(v)
    return v


def _number(v: object) -> float | None:
    if isinstance(v, bool):
        return None
    try:
        return float(v)
    except ValueError:
        return None


def _whole(bits: int) -> Callable[[object], int | None]:
    def whole(v: object) -> int | None:
        f = _number(v)
        return int(f) if f is not None and f.is_integer() and -(2.0**bits) <= f < 2.0**bits else None

    return whole


def _boolean(v: object) -> bool | None:
    if isinstance(v, bool):
        return v
    return {"true": True, "false": False}.get(v.strip().lower()) if isinstance(v, str) else None


def converter(kind: DataType, empty_as_null: bool) -> Callable[[object], object]:
    known = {StringType: text, IntegerType: _whole(31), LongType: _whole(63), DoubleType: _number, BooleanType: _boolean}
    if type(kind) not in known:
        raise ValueError(f"workbook columns can be string, int, long, double or boolean, not {kind.simpleString()}")
    make, missing = known[type(kind)], "" if isinstance(kind, StringType) and not empty_as_null else None
    return lambda v: missing if v is None else make(v)


def read_workbooks(
    spark: SparkSession, path: str, schema: StructType, empty_as_null: bool = False, only: DataFrame | None = None
) -> DataFrame:
    """The rows of all workbooks that ``path`` names (see ``workbook_files``); with ``only`` (a table of
    ``path``), of those among them, the others unopened."""
    ship_package(spark)
    arrow = to_arrow_schema(schema)
    converters = [converter(f.dataType, empty_as_null) for f in schema.fields]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = sheet_rows(content.as_py())
                next(rows, None)  # the header
                columns: list[list] = [[] for _ in converters]
                for n, cells in enumerate(rows, 1):
                    for i, (column, convert) in enumerate(zip(columns, converters)):
                        column.append(convert(cells.get(i)))
                    if n % BATCH_ROWS == 0:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
                        columns = [[] for _ in converters]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return workbook_files(spark, path, only).mapInArrow(step, schema)
