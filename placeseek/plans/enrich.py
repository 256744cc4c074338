"""City enrichment (PIPE1) and city preview (PIPE2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from placeseek.functions.text import title_case
from placeseek.operators.aggregate import first_distinct_rows
from placeseek.operators.joins import DEFAULT_BROADCAST_ROWS, KeyPairs, left_join, left_join_twice
from placeseek.operators.project import rename_columns

# Workbook and state-file headers and the names they get.
CITY_RENAMES = {
    "SKU IBGE": "skuIBGE",
    "Sigla País": "siglaPais",
    "Tipo": "type",
    "Ordem Alfabética País": "ordemAlfabetica",
    "SKU Fériaz": "skuFeriaz",
    "Município": "municipio",
    "País": "pais",
    "Região": "regiao",
    "UF": "uf",
    "Região Turística": "regiaoTuristica",
    "Arrecadação": "arrecadacao",
    "Cluster": "cluster",
}
STATE_RENAMES = {
    "local_code": "localCode",
    "name": "nomeEstado",
    "continent": "continente",
    "iso_country": "siglaPaisEstado",
}
CITY_STATE_KEYS = (("siglaPais", "siglaPaisEstado"), ("uf", "localCode"))
STATE_COLUMNS = ("nomeEstado", "continente")


def enrich_cities(
    cities: DataFrame,
    states: DataFrame,
    on: KeyPairs = CITY_STATE_KEYS,
    state_cols: Sequence[str] = STATE_COLUMNS,
    country_col: str = "pais",
    title_name: str = "paisCamel",
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """PIPE1: every city, its country name in title case, its state's columns.

    ``states`` is pruned to its keys and ``state_cols`` before the join and
    broadcast when a size check allows (the usual case: a few thousand
    states against any number of cities).  Cities whose keys are null, empty
    or unknown keep null state columns.  The states table is joined once:
    on unique state keys this equals the reference's double join;
    ``enrich_cities_as_reference`` keeps its k*k fan-out on repeated keys.
    """
    rkeys = [rc for _, rc in on]
    right = states.select(*rkeys, *[c for c in state_cols if c not in rkeys])
    joined = left_join(cities, right, on, broadcast_rows=broadcast_rows)
    return joined.select(*cities.columns, title_case(country_col).alias(title_name), *state_cols)


def enrich_cities_as_reference(
    cities: DataFrame,
    states: DataFrame,
    on: KeyPairs = CITY_STATE_KEYS,
    state_cols: Sequence[str] = STATE_COLUMNS,
    country_col: str = "pais",
    title_name: str = "paisCamel",
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """PIPE1 with the reference's second LEFT JOIN of the states (JON2)."""
    twice = left_join_twice(cities, states, on, cities.columns, list(state_cols), broadcast_rows)
    return twice.select(*cities.columns, title_case(country_col).alias(title_name), *state_cols)


def prepare_cities(raw: DataFrame, renames: Mapping[str, str] = CITY_RENAMES) -> DataFrame:
    """PRJ1 on the municipalities workbook."""
    return rename_columns(raw, renames)


def prepare_states(raw: DataFrame, renames: Mapping[str, str] = STATE_RENAMES) -> DataFrame:
    """PRJ1 on the regions/states CSV."""
    return rename_columns(raw, renames)


def city_preview(
    cities: DataFrame,
    cols: Sequence[str],
    country_col: str = "pais",
    title_name: str = "paisCamel",
    n: int = 10,
) -> DataFrame:
    """PIPE2: the selected city columns plus the title-cased country,
    de-duplicated, first ``n`` in order of all output columns."""
    shaped = cities.select(*cols, title_case(country_col).alias(title_name))
    return first_distinct_rows(shaped, n)
