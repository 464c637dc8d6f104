"""Checks kept by date equal checks of the whole tables, after any sequence of loads."""

import datetime as dt

import pytest
from helpers import raw_rows

from shelfwise.operators import quality
from shelfwise.plans import checks
from shelfwise.plans import pipeline as P
from shelfwise.sources.warehouse import Warehouse

D = [dt.datetime(2024, 1, d, 10) for d in range(1, 13)]


def counts(rows):
    return {(r.table_name, r.check_name, r.column_name): r.n_violations for r in rows}


def whole(wh):
    return counts(quality.summary(P.tables(wh)).collect())


def row(sku, at, **other):
    return dict(sku=sku, ingestion_time=at, stock_quantity=1) | other


IDS = ["l0", "l0", "l1", "l2"]
LOADS = [
    [row("A", D[0], sale=None), row("A", D[0], stock_status="Gone"), row("B", D[1], stock_quantity=-5, supplier_name="X"),
     row("C", None, stock_status="Odd")],
    # the first load again: B's row at the watermark is replaced, so its supplier X goes and the fact's row of that day has no parent
    [row("B", D[1], supplier_name="Y", reviews_rating=9.0), row("D", D[2], stock_status="Gone", supplier_contact=None)],
    [row("E", D[3], supplier_name="X"), row("F", D[4], discount=101.0, name=None), row("G", None, stock_quantity=None)],   # X comes back
    [row("F", D[4], supplier_name="Z", name=None), row("F", D[4], supplier_name="W", name=None)],
]


@pytest.fixture()
def wh(spark, scratch):
    return Warehouse(spark, scratch("wh"))


def test_kept_counts_equal_whole_counts_after_each_load(spark, wh):
    seen = []
    for name, load in zip(IDS, LOADS):
        got = counts(P.run_batch(spark, wh, raw_rows(spark, load), name, keep_checks=True).checks)
        assert len(got) == len(quality.SUITE)
        assert got == whole(wh)
        seen.append(got)
    orphan = (quality.FCT, "relationships", "supplier_name")
    assert [s[orphan] for s in seen][:3] == [0, 1, 0]       # X goes, then comes back
    assert [s[quality.RAW, "accepted_values", "stock_status"] for s in seen][:3] == [2, 1, 1]
    assert seen[0][quality.STG, "unique_combination", "product_id,ingestion_time"] == 1


def test_only_the_dates_of_a_load_are_opened(spark, wh):
    P.run_batch(spark, wh, raw_rows(spark, [row("A", d) for d in D[:6]]), "l0", keep_checks=True)
    opened = []
    for i, d in enumerate(D[6:9]):
        before = wh.folders_listed
        P.run_batch(spark, wh, raw_rows(spark, [row("A", d)]), f"n{i}", keep_checks=True)
        opened.append(wh.folders_listed - before)
    assert len(set(opened)) == 1


def test_a_load_without_kept_checks_or_one_that_stops_makes_them_anew(spark, wh, monkeypatch):
    P.run_batch(spark, wh, raw_rows(spark, LOADS[0]), "l0", keep_checks=True)
    P.run_batch(spark, wh, raw_rows(spark, LOADS[1]), "l1")
    assert wh.record(checks.KEPT)["open"]
    with monkeypatch.context() as m:
        m.setattr(P, "extend_dims", lambda wh: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.run_batch(spark, wh, raw_rows(spark, LOADS[2]), "l2", keep_checks=True)
    got = P.run_batch(spark, wh, raw_rows(spark, LOADS[3]), "l3", keep_checks=True).checks
    assert counts(got) == whole(wh) and not wh.record(checks.KEPT)["open"]


def test_empty_loads(spark, wh):
    assert P.run_batch(spark, wh, raw_rows(spark, []), "l0", keep_checks=True).checks is None
    got = P.run_batch(spark, wh, raw_rows(spark, LOADS[0]), "l1", keep_checks=True).checks
    assert counts(got) == whole(wh)
    got = P.run_batch(spark, wh, raw_rows(spark, []), "l2", keep_checks=True).checks
    assert counts(got) == whole(wh)
