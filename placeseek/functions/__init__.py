"""Column functions: text (FN1-FN5), distance (FN6), sound codes (FN7-FN8)."""

from placeseek.functions.distance import candidates, near_any, within_distance
from placeseek.functions.phonetic import (
    fold_accents,
    phonetic_code,
    register_sql_functions,
    soundex_code,
)
from placeseek.functions.text import (
    explode_words,
    search_text,
    split_terms,
    split_words,
    title_case,
)

__all__ = [
    "candidates",
    "explode_words",
    "fold_accents",
    "near_any",
    "phonetic_code",
    "register_sql_functions",
    "search_text",
    "soundex_code",
    "split_terms",
    "split_words",
    "title_case",
    "within_distance",
]
