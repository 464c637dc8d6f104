"""Landing, hand-off and replay neither lose nor change data."""

import datetime as dt
import json
import os

import pytest

from shelfwise.plans import pipeline as P
from shelfwise.session import scratch_dir
from shelfwise.sources import files, landing
from shelfwise.sources.warehouse import Warehouse
from shelfwise.streaming import microbatch
from helpers import raw_rows
from test_streaming import envelope, land

D1, D2, D3 = (dt.datetime(2024, 1, d, 10) for d in (1, 2, 3))
ODD = ['19" monitor', '19" monitor, black', "a,b", 'two\nlines, "q"', "back\\slash", "\\", "", None, " padded ", '""', "'", "über, ñ", "\ttab"]


def test_csv_keeps_every_value(spark, scratch):
    rows = raw_rows(spark, [dict(sku=f"S{i}", name=v, brand=v, ingestion_time=D1.replace(microsecond=123456)) for i, v in enumerate(ODD)])
    path = scratch("csv")
    files.write_csv(rows, path, rows_a_file=5)
    back = files.read_csv(spark, path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_csv_rows_that_do_not_fit_raise(spark, scratch):
    path = scratch("csv")
    spark.createDataFrame([("a", "x")], "sku string, msrp string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        files.read_csv(spark, path, schema="sku string, msrp double").collect()


def test_runs_come_back_whole(spark, scratch):
    rows, base = raw_rows(spark, [dict(sku="A", ingestion_time=D1), dict(sku="B", ingestion_time=D2)]), scratch("runs")
    files.land_runs(rows, base, rows["sku"])
    assert {(r.run_id, r.ingestion_time) for r in files.read_runs(spark, base).collect()} == {("A", D1), ("B", D2)}


def state(wh):
    return {name: sorted(map(tuple, P.table(wh, name).collect()), key=str) for name in (P.STG, P.FCT, P.DIM_P, P.DIM_S, P.DIM_D)}


def test_replay_after_a_stop_before_the_dimensions(spark, scratch, monkeypatch):
    wh, clean = Warehouse(spark, scratch("wh")), Warehouse(spark, scratch("wh"))
    first = raw_rows(spark, [dict(sku="A", ingestion_time=D1)])
    second = raw_rows(spark, [dict(sku="B", supplier_name="T", ingestion_time=D2), dict(sku="C", ingestion_time=D3)])
    for w in (wh, clean):
        P.run_batch(spark, w, first, "l1")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(P, "extend_dims", stop)
        m.setattr(P, "refresh_dims", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            P.run_batch(spark, wh, second, "l2")
    P.run_batch(spark, wh, second, "l2")
    P.run_batch(spark, clean, second, "l2")
    assert state(wh) == state(clean) and len(state(wh)[P.DIM_P]) == 3


def test_a_retried_load_replaces_all_its_dates(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    wh.write_load(P.RAW, raw_rows(spark, [dict(sku="A", ingestion_time=D1), dict(sku="B", ingestion_time=D2)]), "x")
    wh.write_load(P.RAW, raw_rows(spark, [dict(sku="A", ingestion_time=D1)]), "x")
    assert [r.sku for r in P.table(wh, P.RAW).collect()] == ["A"]


def test_streams_do_not_replace_each_other(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    for sku in "AB":
        folder = scratch("landing")
        land(folder, "x.json", [envelope(sku, "2024-01-01T08:00:00.000Z")])
        microbatch.drain(spark, folder, wh, scratch("ckpt"))
    assert sorted(r.sku for r in P.table(wh, P.RAW).collect()) == ["A", "B"]


def flat(spark, *docs):
    return landing.flatten(landing.envelopes(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")))


def test_offsets_move_to_utc(spark):
    (row,) = flat(spark, envelope("A", "2024-01-01T10:00:00+02:00")).rows.collect()
    assert row.generated_at == dt.datetime(2024, 1, 1, 8)
    doc = envelope("A", "2024-01-01T10:00:00")
    doc["data"][0]["stock"]["lastRestocked"] = "2024-01-01T00:30:00-01:30"
    (row,) = flat(spark, doc).rows.collect()
    assert row.generated_at == dt.datetime(2024, 1, 1, 10) and row.stock_last_restocked == dt.datetime(2024, 1, 1, 2)


def test_numbers_out_of_range_are_rejected_with_their_document(spark):
    doc = envelope("A", "2024-01-01T08:00:00.000Z")
    doc["data"][0]["stock"]["quantity"] = 3_000_000_000
    res = flat(spark, doc, {"meta": {}, "data": "no list"})
    assert res.rows.count() == 0
    rejects = {r.reject_reason: json.loads(r.document) for r in res.rejects.collect()}
    assert rejects["bad_type:stock_quantity"] == doc["data"][0]
    assert rejects["data_not_array"] == {"meta": {}, "data": "no list"}


def test_rejects_are_kept_and_counted_by_default(spark, scratch):
    wh, folder = Warehouse(spark, scratch("wh")), scratch("landing")
    land(folder, "x.json", [envelope("A", "2024-01-01T08:00:00.000Z"), envelope("B", "2024-01-01T08:00:00.000Z", status=None)])
    log = microbatch.drain(spark, folder, wh, scratch("ckpt"))
    assert (log.accepted, log.rejects) == (1, 1)
    (kept,) = spark.read.parquet(wh.path("raw.rejects") + "/*").collect()
    assert kept.sku == "B" and json.loads(kept.document)["sku"] == "B"


def test_a_retry_stamps_the_first_try_s_time(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    first = microbatch.batch_time(spark, wh, "s", 4)
    assert microbatch.batch_time(spark, wh, "s", 4) == first != microbatch.batch_time(spark, wh, "s", 5)


def test_existence_is_asked_of_the_store(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    assert not wh.exists(P.STG) and wh.newest_date(P.STG) is None
    os.makedirs(wh.path(P.STG) + "/_temporary")
    assert not wh.exists(P.STG)
    wh.write_load(P.RAW, raw_rows(spark, [dict(sku="A", ingestion_time=D1)]), "x")
    P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", ingestion_time=D1)]), "x")
    assert wh.exists(P.STG) and wh.newest_date(P.STG) == D1.date()


def test_violated_checks_stop_a_load_that_asks_for_it(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    with pytest.raises(P.CheckViolation):
        P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", stock_quantity=-1, ingestion_time=D1)]), "x", fail_on_violation=True)


def test_a_cluster_without_a_shared_folder_raises(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="shared folder"):
        scratch_dir(Session())


def test_an_autodetected_load_widens_or_rejects(spark, scratch):
    path = scratch("csv")
    rows = [("A", "1", "2.5", "3"), ("B", "n/a", "1", "1e3"), ("C", "12", None, "7"), ("D", None, "x", "8")]
    files.write_csv(spark.createDataFrame(rows, "sku string, stock_quantity string, msrp string, reviews_review_count string"), path)
    from pyspark.sql.types import StructType
    table = StructType.fromDDL("sku string, stock_quantity int, msrp double, reviews_review_count int, brand string")
    load = files.load_inferred(spark, path, table)
    assert load.widened == ["reviews_review_count"]
    assert sorted(map(tuple, load.rows.collect())) == [("A", 1, 2.5, 3.0, None), ("C", 12, None, 7.0, None)]
    assert {r.sku: r.reject_reason for r in load.rejects.collect()} == {"B": "bad_type:stock_quantity", "D": "bad_type:msrp"}
