"""One workbook read by many tasks (SRC1, SRC2).

A workbook is a zip archive, which only one task can open; but opening it is the cheap part.  The first pass
opens each workbook, cuts the text of its sheet after every ``BLOCK_ROWS`` rows without parsing it, and passes
each block on with the shared strings its cells name.  The blocks are dealt to all tasks, and the second pass parses
them and converts the values, which is where the time goes.  A block has all it needs, so a lost task costs its blocks
and no more.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from placeseek.session import estimated_bytes, ship_package
from placeseek.sources.excel import SharedStrings, converter, first_sheet, is_row, row_cells, workbook_files

BLOCK_ROWS = 20_000
#: Sheet text for one task, and how much larger than the workbook it is taken to be.
TASK_BYTES, UNPACKED = 64 << 20, 10
_READ_BYTES = 1 << 20
_ROW_BEGIN = re.compile(rb"<(?:\w+:)?row[\s/>]")
_ROW_END = re.compile(rb"</(?:\w+:)?row\s*>|<(?:\w+:)?row(?:\s[^>]*)?/>")
_STRING_CELL = re.compile(rb"""<(?:\w+:)?c\s[^>]*?\bt=["']s["'][^>]*>\s*(?:<(?:\w+:)?f(?:\s[^>]*)?(?:/>|>[^<]*</(?:\w+:)?f>)\s*)?<(?:\w+:)?v>\s*(\d+)""")
_BLOCK_SCHEMA = "path string, block int, head binary, rows binary, numbers array<int>, strings array<string>"


def cut_sheet(content: bytes, block_rows: int = BLOCK_ROWS) -> Iterator[tuple[bytes, bytes, dict[int, str]]]:
    """Blocks of the first sheet's text: what stands before its first row, some rows, and the strings they name."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = SharedStrings(z)

        def block(rows: bytes) -> tuple[bytes, bytes, dict[int, str]]:
            return head, rows, {i: strings[i] for i in sorted({int(m) for m in _STRING_CELL.findall(rows)})}

        with z.open(first_sheet(z)) as f:
            held = b""
            while (begin := _ROW_BEGIN.search(held)) is None:
                more = f.read(_READ_BYTES)
                if not more:
                    return
                held += more
            head, held = held[: begin.start()], held[begin.start() :]
            seen, at = 0, 0  # rows of the open block, and where the search goes on
            while True:
                while (end := _ROW_END.search(held, at)) is not None:
                    seen, at = seen + 1, end.end()
                    if seen == block_rows:
                        yield block(held[:at])
                        held, seen, at = held[at:], 0, 0
                more = f.read(_READ_BYTES)
                if not more:
                    break
                held += more
            if seen:
                yield block(held[:at])


def _block_rows(head: bytes, rows: bytes, strings: dict[int, str]) -> Iterator[dict[int, object]]:
    parser = ET.XMLPullParser(events=("end",))
    parser.feed(head)
    parser.feed(rows)
    for _, el in parser.read_events():
        if is_row(el):
            yield row_cells(el, strings)
            el.clear()


def read_workbook_blocks(
    spark: SparkSession, path: str, schema: StructType, empty_as_null: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The rows of all workbooks that ``path`` names, as ``read_workbooks`` reads them, each workbook by as
    many tasks as it has blocks."""
    ship_package(spark)
    arrow = to_arrow_schema(schema)
    converters = [converter(f.dataType, empty_as_null) for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for n, (head, rows, strings) in enumerate(cut_sheet(content.as_py(), block_rows)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path]), pa.array([n], pa.int32()), pa.array([head], pa.binary()), pa.array([rows], pa.binary()),
                            pa.array([list(strings)], pa.list_(pa.int32())), pa.array([list(strings.values())], pa.list_(pa.string())),
                        ],
                        names=["path", "block", "head", "rows", "numbers", "strings"],
                    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, n, head, rows, numbers, strings = (c[i].as_py() for c in batch.columns)
                columns: list[list] = [[] for _ in converters]
                for k, cells in enumerate(_block_rows(head, rows, dict(zip(numbers, strings)))):
                    if n or k:  # the first row of the first block is the header
                        for at, (column, convert) in enumerate(zip(columns, converters)):
                            column.append(convert(cells.get(at)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    files = workbook_files(spark, path)
    blocks = files.mapInArrow(cut, _BLOCK_SCHEMA)
    # enough tasks that each gets some TASK_BYTES of sheet text, judged by the files' sizes
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (estimated_bytes(files) or 0) * UNPACKED // TASK_BYTES)
    return blocks.repartition(parts, "path", "block").mapInArrow(parse, schema)
