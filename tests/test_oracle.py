"""Registered queries vs their DuckDB oracle on the smallest driver tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
FAST = ["stg_rename", "inventory_risk", "int_inventory_signals", "fct_inventory", "dim_products",
        "dim_suppliers", "dim_dates", "star_join_using", "kpi_overview", "top10_high_risk", "supplier_summary",
        "check_summary", "check_unique_combo", "flatten_envelopes", "flatten_rejects", "run_id_paths",
        "late_rows", "restock_age_subday", "incremental_same_instant_stg", "incremental_same_instant_int",
        "incremental_same_instant_fct", "supplier_filtered", "dim_dates_ext"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ["region", "nation", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from check_oracle import digest
    sdf = E.queries()[name](spark, SF).toPandas()
    odf = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert digest(sdf) == digest(odf)


def test_registry_and_oracle_cover_each_other():
    import __spark_entry__ as E
    from shelfwise.plans.oracle import SQL
    from shelfwise.plans.registry import REGISTRY
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert len(REGISTRY) >= 51
