"""Publishes that stop half-way, reads that open only the newest folders, dimensions as of an instant."""

import datetime as dt
import os

import pytest
from helpers import raw_rows

from shelfwise.plans import models as m
from shelfwise.plans import pipeline as P
from shelfwise.sources.warehouse import Warehouse

DAYS = [dt.datetime(2024, 1, d, 10) for d in range(1, 13)]


def state(wh):
    return {name: sorted(map(tuple, P.table(wh, name).collect()), key=str) for name in P.LAYER_COLUMNS if name != P.RAW}


def rows(spark, *pairs):
    return raw_rows(spark, [dict(sku=sku, ingestion_time=at, stock_quantity=q) for sku, at, q in pairs])


class Stop(RuntimeError):
    pass


def stopping(method, when):
    """``method`` until ``when`` says of its arguments that the process dies."""
    def run(self, *args, **kw):
        if when(*args):
            raise Stop
        return method(self, *args, **kw)
    return run


@pytest.fixture(scope="module")
def finished(spark):
    """What three loads give that nothing stops."""
    from shelfwise.session import scratch_dir
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    for i, load in enumerate(loads(spark)):
        P.run_batch(spark, wh, load, f"l{i}")
    return state(wh)


def loads(spark):
    return [rows(spark, ("A", DAYS[0], 1), ("B", DAYS[1], 2)),
            rows(spark, ("B", DAYS[1], 3), ("C", DAYS[1], 4), ("A", DAYS[2], 5), ("A", DAYS[3], 6), ("D", DAYS[4], 7)),
            rows(spark, ("A", DAYS[5], 8))]


@pytest.mark.parametrize("place", [
    lambda a, b: "stg_products/ingestion_date=2024-01-04" in b,          # after some of staging's dates
    lambda a, b: "fct_inventory/ingestion_date=2024-01-04" in b,
    lambda a, b: "raw/products/ingestion_date=2024-01-04" in b,
    lambda a, b: "int_inventory_signals/ingestion_date=2024-01-03" in b,
])
def test_a_publish_that_stops_after_some_dates_is_finished_later(spark, scratch, monkeypatch, finished, place):
    first, second, third = loads(spark)
    wh = Warehouse(spark, scratch("wh"))
    P.run_batch(spark, wh, first, "l0")
    before = state(wh)
    with monkeypatch.context() as mp:
        mp.setattr(Warehouse, "_move", stopping(Warehouse._move, place))
        with pytest.raises(Stop):
            P.run_batch(spark, wh, second, "l1")
    seen = state(Warehouse(spark, wh.root))
    for name in P.LAYER_COLUMNS:                             # each table is as before or whole, never in between
        if name != P.RAW:
            assert len(seen[name]) in (len(before[name]), len(finished[name]) - (name in (P.STG, P.INT, P.FCT, P.DIM_D)))
    again = Warehouse(spark, wh.root)
    P.run_batch(spark, again, second, "l1")
    P.run_batch(spark, again, third, "l2")
    assert state(again) == finished


def test_a_stopped_replacement_shows_old_or_new_rows(spark, scratch, monkeypatch, finished):
    first, second, third = loads(spark)
    wh = Warehouse(spark, scratch("wh"))
    P.run_batch(spark, wh, first, "l0")
    with monkeypatch.context() as mp:
        mp.setattr(Warehouse, "_delete", stopping(Warehouse._delete, lambda path: "stg_products" in path and "publish_id=0" in path))
        with pytest.raises(Stop):
            P.run_batch(spark, wh, second, "l1")
    assert state(Warehouse(spark, wh.root))[P.STG] == [r for r in finished[P.STG] if r[-1] != DAYS[5]] or \
        len(state(Warehouse(spark, wh.root))[P.STG]) == len(finished[P.STG]) - 1
    again = Warehouse(spark, wh.root)
    P.run_batch(spark, again, second, "l1")
    P.run_batch(spark, again, third, "l2")
    assert state(again) == finished
    assert os.listdir(wh.path(P.STG) + "/ingestion_date=2024-01-02") == ["publish_id=1"]


def test_a_torn_record_leaves_the_one_before(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    P.run_batch(spark, wh, loads(spark)[0], "l0")
    record = wh.record(P.STG)
    at, fs = wh._at(f"{wh.path(P.STG)}/_commit.{(record['serial'] + 1) % 2}")
    out = fs.create(at, True)
    out.write(b'{"serial": 99, "sta')
    out.close()
    assert wh.record(P.STG) == record and wh.watermark(P.STG) == DAYS[1]


def test_readers_of_a_stopped_refresh_see_the_old_rows(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch("wh"))
    P.run_batch(spark, wh, loads(spark)[0], "l0")
    reader = P.table(Warehouse(spark, wh.root), P.DIM_P)
    before = sorted(reader.collect())
    with monkeypatch.context() as mp:
        mp.setattr(Warehouse, "_write_record", stopping(Warehouse._write_record, lambda base, record: "dim_products" in base))
        with pytest.raises(Stop):
            P.run_batch(spark, wh, loads(spark)[1], "l1")
    assert sorted(reader.collect()) == before == sorted(P.table(Warehouse(spark, wh.root), P.DIM_P).collect())
    P.run_batch(spark, wh, loads(spark)[1], "l1")
    assert len(P.table(wh, P.DIM_P).collect()) == 4 and sorted(reader.collect()) == before


def test_batches_open_no_more_folders_as_the_table_grows(spark, scratch):
    wh, opened = Warehouse(spark, scratch("wh")), []
    for i, day in enumerate(DAYS[:5]):
        before = wh.folders_listed
        P.run_batch(spark, wh, rows(spark, ("A", day, i)), f"l{i}")
        opened.append(wh.folders_listed - before)
    assert len(set(opened[2:])) == 1 and opened[-1] <= 16


def test_a_rewritten_instant_reads_no_history(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    P.run_batch(spark, wh, rows(spark, *[(sku, day, 1) for sku in "AB" for day in DAYS[:6]], ("C", DAYS[2], 1)), "l0")
    P.run_batch(spark, wh, rows(spark, ("B", DAYS[7], 5), ("A", DAYS[7], 5)), "l1")
    before = wh.folders_listed
    for i, q in enumerate((6, 7)):                           # the newest instant comes twice more, with other rows
        res = P.run_batch(spark, wh, rows(spark, ("B", DAYS[7], q), (f"N{i}", DAYS[7], q)), f"m{i}")
        assert not res.merges[0].appended
        stg = P.table(wh, P.STG)
        for name, model in ((P.DIM_P, m.dim_products), (P.DIM_S, m.dim_suppliers), (P.DIM_D, m.dim_dates)):
            assert sorted(P.table(wh, name).collect()) == sorted(model(stg).collect())
    assert wh.folders_listed - before <= 16 * 2              # of 8 dates in four tables, only the newest


def test_empty_loads(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    res = P.run_batch(spark, wh, rows(spark, ("A", DAYS[0], 1)).limit(0), "l0")
    assert res.rows == 0 and not wh.exists(P.STG)
    P.run_batch(spark, wh, rows(spark, ("A", DAYS[0], 1)), "l1")
    P.run_batch(spark, wh, rows(spark, ("A", DAYS[0], 1)).limit(0), "l2")
    assert P.table(wh, P.FCT).count() == 1 and P.table(wh, P.DIM_D).count() == 1


def test_the_catalog_follows_publishes(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    for name in (P.STG, P.FCT, P.DIM_P):
        spark.sql(f"DROP TABLE IF EXISTS {name}") if spark.catalog.tableExists(name) else None
    for i, load in enumerate(loads(spark)):
        P.run_batch(spark, wh, load, f"l{i}")
        for name in (P.STG, P.FCT, P.DIM_P):
            if (i, name) != (1, P.FCT):                      # one is left out, and catches up
                wh.register(name)
    for name in (P.STG, P.FCT, P.DIM_P):
        cols = P.LAYER_COLUMNS[name]
        got = spark.table(name)
        got = got.filter("is_current") if name == P.DIM_P else got
        assert sorted(map(tuple, got.select(*cols).collect()), key=str) == state(wh)[name]
