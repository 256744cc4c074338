"""Excel, CSV, listing, audit, sinks: hand-made fixtures."""

import json
import os
import zipfile

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from placeseek.fixtures import write_workbook, write_workbooks
from placeseek.operators import rename_columns
from placeseek.plans.files import read_excel
from placeseek.sinks import append_to_index, json_lines
from placeseek.sources import column_audit, list_files, read_csv_strings

SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


_write = write_workbook


def _sparse_workbook(path):
    """A hand-written workbook: shared strings, an inline string, a skipped
    cell in mid-row (B2), and cells without a type mark."""
    sheet = (
        f'<worksheet xmlns="{SHEET_NS}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
        '<row r="2"><c r="A2"><v>7</v></c><c r="C2" t="inlineStr"><is><r><t>x</t></r></is></c></row>'
        '<row r="4"><c r="A4"><v>2.5</v></c><c r="B4" t="s"><v>1</v></c><c r="C4" t="b"><v>1</v></c></row>'
        "</sheetData></worksheet>"
    )
    sst = (
        f'<sst xmlns="{SHEET_NS}"><si><t>linha</t></si>'
        "<si><r><t>Mun</t></r><r><t>icípio</t></r><rPh><t>hint</t></rPh></si><si><t>C</t></si></sst>"
    )
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", sst)


def test_excel_sparse_cells_and_shared_strings(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a.xlsx")
    _sparse_workbook(path)
    schema = StructType([StructField("linha", IntegerType()), StructField("m", StringType()), StructField("c", StringType())])
    rows = [tuple(r) for r in read_excel(spark, path, schema).collect()]
    assert rows == [(7, "", "x"), (None, "Município", "TRUE")]
    nulls = [tuple(r) for r in read_excel(spark, path, schema, empty_as_null=True).collect()]
    assert nulls == [(7, None, "x"), (None, "Município", "TRUE")]
    inferred = read_excel(spark, path, infer=True)
    assert inferred.columns == ["linha", "Município", "C"]
    assert [f.dataType.typeName() for f in inferred.schema.fields] == ["double", "string", "string"]


def test_excel_glob_union_and_audit(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "one.xlsx"), ["id", "name", "uf"], [(1, "a", "SP"), (2, "b", None)])
    _write(os.path.join(tmp_dir, "two.xlsx"), ["id", "name"], [(3, "c")])
    with open(os.path.join(tmp_dir, "notes.XLSX"), "w") as f:
        f.write("not a workbook")
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("uf", StringType())])
    rows = sorted(tuple(r) for r in read_excel(spark, f"{tmp_dir}/*.xlsx", schema).collect())
    assert rows == [(1, "a", "SP"), (2, "b", ""), (3, "c", "")]
    files = sorted(r.file for r in list_files(spark, tmp_dir).collect())
    assert files == ["one.xlsx", "two.xlsx"]
    audit = {(r.file, r.ordinal, r.column) for r in column_audit(spark, tmp_dir).collect()}
    assert audit == {("one.xlsx", 0, "id"), ("one.xlsx", 1, "name"), ("one.xlsx", 2, "uf"),
                     ("two.xlsx", 0, "id"), ("two.xlsx", 1, "name")}


def test_workbooks_append_and_split(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x", 0), (2, "y", 1), (3, "z", 0)], "a int, b string, g int")
    target = os.path.join(tmp_dir, "out")
    for _ in range(2):
        write_workbooks(df.coalesce(1), target, split_by="g")
    names = sorted(f.rsplit("-", 2)[0] for f in os.listdir(target))
    assert names == ["g=0-part-00000", "g=0-part-00000", "g=1-part-00000", "g=1-part-00000"]
    assert sorted(map(tuple, read_excel(spark, target, df.schema).collect())) == sorted(2 * [(1, "x", 0), (2, "y", 1), (3, "z", 0)])


def test_csv_empties_stay_null_na_stays_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "regions.csv")
    with open(path, "w") as f:
        f.write('local_code,name,continent,iso_country\n,Empty,NA,NA\n"",Q,EU,PT\n')
    rows = [tuple(r) for r in read_csv_strings(spark, path).collect()]
    assert rows == [(None, "Empty", "NA", "NA"), (None, "Q", "EU", "PT")]


def test_json_lines_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(json_lines(df).collect()[0].value) == {"a": 1}


def test_rename_ignores_missing_and_case(spark):
    df = spark.createDataFrame([(1, "x")], "Tipo int, b string")
    assert rename_columns(df, {"missing": "y"}).columns == ["Tipo", "b"]
    assert rename_columns(df, {"tipo": "t", "B": "bb"}).columns == ["t", "bb"]


def test_append_twice_keeps_both(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    target = os.path.join(tmp_dir, "index")
    append_to_index(df, target, "json")
    append_to_index(df, target, "json")
    assert spark.read.json(target).count() == 4
    dedup = os.path.join(tmp_dir, "index2")
    append_to_index(df.union(df), dedup, "parquet", dedupe_keys=["k"])
    assert spark.read.parquet(dedup).count() == 2


def test_listing_a_missing_folder_gives_no_rows(spark, tmp_dir):
    assert list_files(spark, os.path.join(tmp_dir, "nope")).count() == 0
    assert list_files(spark, tmp_dir).count() == 0


def test_preview_collect_and_json_text(spark, tmp_dir):
    from placeseek.sinks import collect_records, preview, write_json_lines

    df = spark.range(0, 100).selectExpr("id", "cast(id % 7 as string) AS g")
    assert [r.id for r in preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    rows = collect_records(df, 5, ["g", "id"])
    assert [(r.g, r.id) for r in rows] == [("0", 0), ("0", 7), ("0", 14), ("0", 21), ("0", 28)]
    target = os.path.join(tmp_dir, "json")
    write_json_lines(df, target)
    back = [json.loads(r.value) for r in spark.read.text(target).collect()]
    assert sorted(b["id"] for b in back) == list(range(100))


def test_excel_numbers_and_booleans(spark, tmp_dir):
    from pyspark.sql.types import BooleanType, DoubleType, LongType

    path = os.path.join(tmp_dir, "d.xlsx")
    _write(path, ["n", "flag", "x"], [(2**40, True, 1.5), (3, False, None), ("12", "true", "2.5"), ("x", "x", "x")])
    schema = StructType([StructField("n", LongType()), StructField("flag", BooleanType()), StructField("x", DoubleType())])
    rows = [tuple(r) for r in read_excel(spark, path, schema).collect()]
    assert rows == [(2**40, True, 1.5), (3, False, None), (12, True, 2.5), (None, None, None)]
    whole = StructType([StructField("n", IntegerType())])
    assert [r.n for r in read_excel(spark, path, whole).collect()] == [None, 3, 12, None]


def test_workbook_names(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException

    schema = StructType([StructField("id", IntegerType())])
    folder = os.path.join(tmp_dir, "with blank")
    os.makedirs(os.path.join(folder, "below"))
    for i, name in enumerate(["a b.xlsx", "cities[1].xlsx", "Up.XLSX", "below/deep.xlsx"]):
        _write(os.path.join(folder, name), ["id"], [(i,)])
    ids = lambda path, **k: sorted(r[0] for r in read_excel(spark, path, **k).collect())
    assert ids(folder, schema=schema) == [0, 1, 2]
    assert ids(folder, infer=True) == [0.0, 1.0, 2.0]
    assert ids(f"{folder}/cities[1].xlsx", schema=schema) == [1]
    assert ids(f"{folder}/*.XLSX", infer=True) == [2.0]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_excel(spark, f"{folder}/missing.xlsx", schema)
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert read_excel(spark, empty, schema).count() == 0 and column_audit(spark, empty).count() == 0
    with pytest.raises(ValueError, match="date"):
        read_excel(spark, folder, StructType.fromDDL("d date"))


def test_nothing_in_a_workbook_is_lost(spark, tmp_dir):
    late = os.path.join(tmp_dir, "late")
    os.makedirs(late)
    _write(os.path.join(late, "a.xlsx"), ["v"], [(i,) for i in range(1100)] + [("word",)] * 50)
    got = read_excel(spark, late, infer=True)
    assert got.dtypes == [("v", "string")] and got.where("v = 'word'").count() == 50 and got.count() == 1150
    drift = os.path.join(tmp_dir, "drift")
    os.makedirs(drift)
    _write(os.path.join(drift, "1.xlsx"), ["c"], [("x",), (None,)])
    _write(os.path.join(drift, "2.xlsx"), ["d", "c"], [("y", 2, "beyond the header")])
    got = read_excel(spark, drift, infer=True)
    assert got.columns == ["c", "c_c1", "_c2"]
    assert sorted(map(tuple, got.collect()), key=str) == [("", None, ""), ("x", None, ""), ("y", 2.0, "beyond the header")]
    assert read_excel(spark, drift).dtypes == [("c", "string"), ("c_c1", "string"), ("_c2", "string")]


def test_preview_then_append(spark, tmp_dir):
    from placeseek.plans.files import index_search_documents
    from placeseek.sinks import preview_then_append

    df = spark.range(0, 50).selectExpr("id", "id * 2 AS v")
    target = os.path.join(tmp_dir, "idx")
    rows = preview_then_append(df, target, "parquet", n=3)
    assert len({r.id for r in rows}) == 3 and all(r.v == 2 * r.id for r in rows)
    assert spark.read.parquet(target).count() == 50
    assert not df.is_cached
    # the search documents' preview shows distinct rows, the append keeps all
    path = os.path.join(tmp_dir, "w.xlsx")
    header = ["linha", "Municípios", "Tipo", "H", "CEP", "SKU País", "SKU Município"]
    _write(path, header, [(1, "a", "t", "h", "c", "p", "m")] * 5 + [(2, "b", "t", "h", "c", "p", "m")])
    shown = index_search_documents(spark, path, os.path.join(tmp_dir, "docs"), "json")
    assert sorted(r.linha for r in shown) == [1, 2] and spark.read.json(os.path.join(tmp_dir, "docs")).count() == 6


def test_exact_inference_sees_every_workbook(spark, tmp_dir):
    from placeseek.sources import infer_excel_schema

    _write(os.path.join(tmp_dir, "a.xlsx"), ["x", "y", "z"], [(1, 2.5, True), (2, 3.0, False)])
    _write(os.path.join(tmp_dir, "b.xlsx"), ["x", "y", "z"], [("ten", 4, True), (None, None, None)])
    schema = infer_excel_schema(spark, tmp_dir)
    assert [(f.name, f.dataType.typeName()) for f in schema.fields] == [
        ("x", "string"), ("y", "double"), ("z", "boolean")
    ]
    rows = sorted(read_excel(spark, tmp_dir, infer=True).collect(), key=lambda r: r.x)
    # the last row of b.xlsx has no value: it is still a row
    assert [tuple(r) for r in rows] == [("", None, None), ("1", 2.5, True), ("2", 3.0, False), ("ten", 4.0, True)]


def test_writer_rolls_over_full_sheets(spark, tmp_dir):
    df = spark.range(0, 25).selectExpr("cast(id as int) AS id", "cast(id % 2 as string) AS g").coalesce(1)
    target = os.path.join(tmp_dir, "roll")
    write_workbooks(df, target, max_rows=10)
    assert len(os.listdir(target)) == 3
    back = read_excel(spark, target, df.schema)
    assert sorted(r.id for r in back.collect()) == list(range(25))


def test_workbook_text_roundtrip_is_lossless(spark, tmp_dir):
    import random

    rng = random.Random(5)
    alphabet = "ab &<>\"' \tçé\n\r\x01漢x_=;:"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    values += ["  leading", "trailing  ", "a&amp;b", "<t>x</t>", "_x000D_", "a\r\nb", "_x005F_"]
    path = os.path.join(tmp_dir, "t.xlsx")
    _write(path, ["i", "s"], [(i, v) for i, v in enumerate(values)])
    schema = StructType([StructField("i", IntegerType()), StructField("s", StringType())])
    back = {r.i: r.s for r in read_excel(spark, path, schema).collect()}
    assert [back[i] for i in range(len(values))] == values
