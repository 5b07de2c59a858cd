"""Driver contract and a DuckDB oracle pass over cheap queries at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from matchlake.plans.standins import TABLES


def test_contract_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["delivery_id", "match_id"] and "league" in df.columns


def _canon(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "∅" if v is None else str(v)


CHEAP = ["people_profiles", "innings_key", "ball_features", "type_selector_cast", "value_replace_all_strings",
         "document_match_info", "document_registry", "json_field_project", "other_team", "date_parse",
         "id_listing_stem", "new_ids_anti", "collision_guard", "append_batches", "read_or_empty", "row_index",
         "fact_table", "role_joins", "delivery_projection", "hash_keys", "star_join", "dimension_keys", "incremental_fact",
         "rebuild_or_reuse", "document_deliveries", "document_quarantine", "quarantine_split", "first_key_of_map",
         "csv_roundtrip", "match_player_join", "league_join_recode", "limit_ordered", "player_form_report"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", CHEAP)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    srows = sorted(tuple(_canon(r[c]) for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted(tuple(_canon(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows
