"""DataFrame-in, DataFrame-out operators."""

from placeseek.operators.aggregate import distinct_rows, first_distinct_rows, row_count
from placeseek.operators.joins import left_join, left_join_twice
from placeseek.operators.limit import first_rows, page_of_rows
from placeseek.operators.pages import rows_after, store_pages, stored_page
from placeseek.operators.project import (
    RECORD_FIELDS,
    rename_columns,
    select_aliased,
    to_city_record,
    with_columns,
    with_search_parameter,
)
from placeseek.operators.search import fuzzy_filter, fuzzy_join, fuzzy_pairs, phonetic_filter, phonetic_pairs

__all__ = [
    "RECORD_FIELDS",
    "distinct_rows",
    "first_distinct_rows",
    "first_rows",
    "fuzzy_filter",
    "fuzzy_join",
    "fuzzy_pairs",
    "left_join",
    "left_join_twice",
    "page_of_rows",
    "phonetic_filter",
    "phonetic_pairs",
    "rename_columns",
    "row_count",
    "rows_after",
    "select_aliased",
    "store_pages",
    "stored_page",
    "to_city_record",
    "with_columns",
    "with_search_parameter",
]
