"""Sources: Excel workbooks, CSV, views, file listing and column audit."""

from placeseek.sources.excel import read_workbooks, workbook_files
from placeseek.sources.files import column_audit, infer_excel_schema, list_files
from placeseek.sources.tables import read_csv_strings, read_table, read_view

__all__ = [
    "column_audit",
    "infer_excel_schema",
    "list_files",
    "read_csv_strings",
    "read_table",
    "read_view",
    "read_workbooks",
    "workbook_files",
]
