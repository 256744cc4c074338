"""Blocks of one workbook, incremental ingest, header drift, and the bucketed sound table."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from conftest import SF_SMALL
from placeseek.fixtures import write_workbooks
from placeseek.operators.search import phonetic_filter, phonetic_pairs
from placeseek.plans.ingest import ingest_new, ingested, manifest, new_files
from placeseek.plans.sound_table import sound_pairs, store_sound_table, words_like
from placeseek.sources.blocks import cut_sheet, read_workbook_blocks
from placeseek.sources.excel import read_workbooks, sheet_rows
from placeseek.sources.files import column_audit, drift_report

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("x", DoubleType())])


def _rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        "id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("n <&> é "), "id")).alias("name"), (F.col("id") / 4).alias("x")
    )


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("block_rows", [1, 7, 100, 10_000])
def test_blocks_give_the_rows_of_the_whole(spark, tmp_dir, block_rows):
    write_workbooks(_rows(spark, 500).coalesce(1), tmp_dir + "/one")
    write_workbooks(_rows(spark, 3, 900).repartition(2), tmp_dir + "/one")
    whole = read_workbooks(spark, tmp_dir + "/one", SCHEMA)
    blocks = read_workbook_blocks(spark, tmp_dir + "/one", SCHEMA, block_rows=block_rows)
    assert whole.count() == 503 and blocks.schema == whole.schema and _same(blocks, whole)


def test_one_workbook_is_read_by_many_tasks(spark, tmp_dir):
    write_workbooks(_rows(spark, 4000).coalesce(1), tmp_dir + "/one")
    assert len(os.listdir(tmp_dir + "/one")) == 1
    rows = read_workbook_blocks(spark, tmp_dir + "/one", SCHEMA, block_rows=100)
    per = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 1500


def test_cut_of_handmade_sheets():
    import io
    import zipfile

    def workbook(sheet, strings=None):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/worksheets/sheet1.xml", sheet)
            if strings:
                z.writestr("xl/sharedStrings.xml", strings)
        return out.getvalue()

    names = "<sst xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'>" + "".join(f"<si><t>s{i}</t></si>" for i in range(9)) + "</sst>"
    x = "xmlns:x='http://schemas.openxmlformats.org/spreadsheetml/2006/main'"
    main = "xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'"
    sheets = [
        f"<worksheet {main}><sheetData><row r='1'><c t='s'><v>8</v></c></row><row r='2'/><row r='3' spans='1:2'><c r='B3' s='1' t=\"s\"><v>3</v></c></row></sheetData></worksheet>",
        f"<x:worksheet {x}><x:sheetData><x:row><x:c t='s'><x:f>A1</x:f><x:v>1</x:v></x:c></x:row><x:row /><x:row><x:c><x:v>4.5</x:v></x:c><x:c t='inlineStr'><x:is><x:t>in</x:t></x:is></x:c></x:row></x:sheetData></x:worksheet>",
        f"<worksheet {main}><rowBreaks/><sheetData></sheetData></worksheet>",
    ]
    from placeseek.sources.blocks import _block_rows

    for sheet in sheets:
        content = workbook(sheet, names)
        for n in (1, 2, 5):
            got = [cells for block in cut_sheet(content, n) for cells in _block_rows(*block)]
            assert got == list(sheet_rows(content))


def test_only_new_workbooks_are_read(spark, tmp_dir):
    folder, store = tmp_dir + "/in", tmp_dir + "/store"
    write_workbooks(_rows(spark, 20).repartition(2), folder)
    assert manifest(spark, store).count() == 0 and ingested(spark, store, SCHEMA).count() == 0
    assert ingest_new(spark, folder, store, SCHEMA) == 2
    assert _same(ingested(spark, store, SCHEMA), read_workbooks(spark, folder, SCHEMA))
    assert ingest_new(spark, folder, store, SCHEMA) == 0 and manifest(spark, store).count() == 2
    write_workbooks(_rows(spark, 7, 100).coalesce(1), folder)
    assert new_files(spark, folder, store).count() == 1
    assert ingest_new(spark, folder, store, SCHEMA) == 1
    assert _same(ingested(spark, store, SCHEMA), read_workbooks(spark, folder, SCHEMA)) and ingested(spark, store, SCHEMA).count() == 27
    # a changed file is read again
    book = next(f for f in sorted(os.listdir(folder)) if f.endswith(".xlsx"))
    shutil.copyfile(f"{folder}/{book}", f"{folder}/copy [1].xlsx")
    assert [r.path.rsplit("/", 1)[1] for r in new_files(spark, folder, store).collect()] == ["copy [1].xlsx"]
    before = ingested(spark, store, SCHEMA).count()
    assert ingest_new(spark, folder, store, SCHEMA) == 1 and ingested(spark, store, SCHEMA).count() > before


def test_a_run_that_fails_leaves_nothing(spark, tmp_dir, monkeypatch):
    from placeseek.plans import ingest

    folder, store = tmp_dir + "/in", tmp_dir + "/store"
    write_workbooks(_rows(spark, 20).repartition(2), folder)
    ingest_new(spark, folder, store, SCHEMA)
    with open(f"{folder}/broken.xlsx", "wb") as f:
        f.write(b"not a workbook")
    with pytest.raises(Exception):
        ingest_new(spark, folder, store, SCHEMA)
    assert ingested(spark, store, SCHEMA).count() == 20
    # rows that were written but not committed are not seen
    spark.createDataFrame([(1, "x", 1.0)], SCHEMA).write.parquet(f"{store}/rows/{ingest.BATCH_COL}=lost")
    assert ingested(spark, store, SCHEMA).count() == 20


def test_drift_report(spark, tmp_dir):
    rows = spark.createDataFrame([("a", "b", "c", "d")], "c1 string, c2 string, c3 string, c4 string")
    for _ in range(3):
        write_workbooks(rows.select("c1", "c2", "c3"), tmp_dir + "/in")
    write_workbooks(rows.select("c1", "c3"), tmp_dir + "/in")
    write_workbooks(rows.select("c4", "c1", "c2", "c3"), tmp_dir + "/in")
    write_workbooks(rows.select("c1", "c3", "c2"), tmp_dir + "/in")
    audit = column_audit(spark, tmp_dir + "/in")
    report = drift_report(audit)
    changes = sorted(tuple(r)[2:] for r in report.collect())
    assert changes == [("inserted", "c4", None, 0), ("missing", "c2", 1, None), ("moved", "c2", 1, 2), ("moved", "c3", 2, 1)]
    assert report.select("path").distinct().count() == 3
    assert drift_report(audit.limit(0)).count() == 0


def test_sound_tables_meet_without_a_shuffle(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = docs.select(F.explode(F.split("text", r"\s+")).alias("palavras"))
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(F.explode(F.split("p_name", " ")).alias("palavras"))
    store_sound_table(words, "sounds_docs", tmp_dir + "/a", buckets=8)
    store_sound_table(parts, "sounds_parts", tmp_dir + "/b", buckets=8)
    pairs = sound_pairs(spark, "sounds_docs", "sounds_parts")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    names = [r[0] for r in parts.distinct().collect()]
    want = phonetic_pairs(words.distinct(), " ".join(names)).distinct()
    assert want.count() > 20 and _same(pairs.select(F.col("left_word").alias("palavras"), F.col("right_word").alias("parameters")), want)
    found = words_like(spark, "sounds_docs", "erblest therouou 12")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(code" in plan and "Exchange" not in plan
    assert _same(found.select(F.col("word").alias("palavras")), phonetic_filter(words.distinct(), "erblest therouou"))
    assert words_like(spark, "sounds_docs", None).count() == words_like(spark, "sounds_docs", "12").count() == 0
