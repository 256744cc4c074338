"""File listing (SRC5), the per-file column audit (SRC6, PIPE7) and exact
types of workbooks (SRC3)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from placeseek.session import ship_package
from placeseek.sources.excel import header_names, sheet_rows, workbook_files

AUDIT_SCHEMA = "path string, file string, ordinal int, column string"
TYPE_STATS_SCHEMA = "path string, ordinal int, name string, n_values long, n_numbers long, n_booleans long"


def list_files(spark: SparkSession, folder: str, suffix: str = ".xlsx") -> DataFrame:
    """SRC5: files directly in ``folder`` whose name ends with ``suffix``
    (case-sensitive); columns ``path`` and ``file`` (the base name).  A
    folder that does not exist gives no rows.

    Spark lists the folder (any Hadoop file system); only ``path`` is
    selected, so no file is opened.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", f"*{suffix}")
            .option("recursiveFileLookup", "false")
            .load(folder)
            .select("path")
        )
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        # a folder that does not exist holds no files
        return spark.createDataFrame([], "path string, file string")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"))


def column_audit(spark: SparkSession, folder: str, suffix: str = ".xlsx") -> DataFrame:
    """SRC6/PIPE7: for every workbook in ``folder``, its header names in order.

    One distributed job: Spark opens the files, and each task parses the
    header row of its own.  Comparing the rows of two files shows columns that drifted.
    """
    ship_package(spark)
    file = F.element_at(F.split("path", "/"), -1)
    files = workbook_files(spark, folder).where(file.endswith(suffix)).select("path", file.alias("file"), "content")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, names, ordinals, columns = [], [], [], []
            for path, name, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows = sheet_rows(content)
                found = header_names(next(rows, {}))
                rows.close()
                paths += [path] * len(found)
                names += [name] * len(found)
                ordinals += range(len(found))
                columns += found
            kinds = pa.string(), pa.string(), pa.int32(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip((paths, names, ordinals, columns), kinds)], names=["path", "file", "ordinal", "column"]
            )

    return files.mapInArrow(step, AUDIT_SCHEMA)


def drift_report(audit: DataFrame) -> DataFrame:
    """SRC6/PIPE7: how each file's header departs from the commonest one (of equally common ones, the
    shortest, then the last in order).

    From the rows of ``column_audit``: ``path``, ``file``, ``change``, ``column``, ``expected`` and ``found``
    (ordinals).  A column of the commonest header that a file lacks is ``missing``, one that only the file has
    ``inserted``; of the columns of both, one that stands in another order among them is ``moved``.
    Files without departures have no rows.
    """
    cells = F.sort_array(F.collect_list(F.struct("ordinal", "column")))
    headers = audit.groupBy("path", "file").agg(F.transform(cells, lambda c: c["column"]).alias("header"))
    usual = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n"))
    # one header comes to the driver
    usual = usual.agg(F.max_by("header", F.struct("n", F.negative(F.size("header")), "header"))).first()[0]
    both = headers.withColumn("usual", F.lit(usual or []).cast("array<string>"))
    place = lambda columns, c: (F.array_position(columns, c) - 1).cast("int")
    change = lambda kind, c: F.struct(
        F.lit(kind).alias("change"), c.alias("column"), F.nullif(place(F.col("usual"), c), F.lit(-1)).alias("expected"),
        F.nullif(place(F.col("header"), c), F.lit(-1)).alias("found"),
    )
    shared = lambda a, b: F.array_intersect(a, b)
    old, new = shared(F.col("usual"), F.col("header")), shared(F.col("header"), F.col("usual"))
    changes = F.concat(
        F.transform(F.array_except("usual", "header"), lambda c: change("missing", c)),
        F.transform(F.array_except("header", "usual"), lambda c: change("inserted", c)),
        F.transform(F.filter(old, lambda c: F.array_position(old, c) != F.array_position(new, c)), lambda c: change("moved", c)),
    )
    return both.select("path", "file", F.inline(changes))


def _type_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per workbook and column (those beyond the header too): how many cells hold
    a value, a number and a boolean (the whole sheet is read, one row at a time)."""
    for batch in batches:
        out = []
        for path, content in zip(*(c.to_pylist() for c in batch.columns)):
            rows = sheet_rows(content)
            names = header_names(next(rows, {}))
            stats = [[0, 0, 0] for _ in names]
            for cells in rows:
                for i, v in cells.items():
                    if v == "":
                        continue
                    while i >= len(stats):
                        names.append(f"_c{len(stats)}")
                        stats.append([0, 0, 0])
                    stats[i][0] += 1
                    stats[i][1] += isinstance(v, float)
                    stats[i][2] += isinstance(v, bool)
            out += [(path, i, name, *s) for i, (name, s) in enumerate(zip(names, stats))]
        columns = list(zip(*out)) or [[]] * 6
        kinds = pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "ordinal", "name", "n_values", "n_numbers", "n_booleans"]
        )


def infer_excel_schema(spark: SparkSession, pattern: str, typed: bool = True) -> StructType:
    """Names and exact types for the workbooks that ``pattern`` names, from every
    cell of every workbook.

    One distributed pass: each task reads its own workbooks and returns a
    few counts per column; the driver receives one row per column position.  A position is
    named by the first workbook (by path) that has it, so a column that only some workbooks
    have is kept; a name used twice gets its position added.  It is ``double``
    when all its values are numbers, ``boolean`` when all are booleans, else ``string``
    (also when it holds no value, and with ``typed=False``).
    """
    ship_package(spark)
    stats = workbook_files(spark, pattern).mapInArrow(_type_stats, TYPE_STATS_SCHEMA)
    unnamed = F.col("name").rlike("^_c[0-9]+$")  # a header's name comes before none
    columns = (
        stats.groupBy("ordinal")
        .agg(
            F.min_by("name", F.struct(unnamed.alias("unnamed"), F.col("path"))).alias("name"),
            F.sum("n_values").alias("n_values"),
            F.sum("n_numbers").alias("n_numbers"),
            F.sum("n_booleans").alias("n_booleans"),
        )
        .orderBy("ordinal")
        .collect()
    )
    fields: dict[str, StructField] = {}
    for r in columns:
        kind = StringType()
        if typed and r.n_values and r.n_numbers == r.n_values:
            kind = DoubleType()
        elif typed and r.n_values and r.n_booleans == r.n_values:
            kind = BooleanType()
        name = r.name if r.name.lower() not in fields else f"{r.name}_c{r.ordinal}"
        fields[name.lower()] = StructField(name, kind, True)
    return StructType(list(fields.values()))
