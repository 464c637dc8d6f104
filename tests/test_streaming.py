"""Micro-batch feed: files handed over once, across restarts; rejects kept."""

import datetime as dt
import json
import os

from shelfwise.plans import pipeline as P
from shelfwise.sources import landing
from shelfwise.sources.warehouse import Warehouse
from shelfwise.streaming import microbatch


def envelope(sku, ts, status="In Stock"):
    stock = {"quantity": 5, "warehouse": {"region": "EU"}}
    if status:
        stock["status"] = status
    return {"meta": {"generatedAt": ts}, "data": [{"sku": sku, "name": sku.lower(), "price": {"msrp": 2, "sale": 1},
                                                   "stock": stock, "supplier": {"name": "S", "contact": "c"}}]}


def land(path, name, docs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs) + "\n")


def test_two_runs_same_checkpoint(spark, scratch):
    landing_dir, ck, rej = scratch("landing"), scratch("ckpt"), scratch("rejects")
    wh = Warehouse(spark, scratch("wh"))
    land(landing_dir, "a.json", [envelope("A", "2024-01-01T08:00:00.000Z"), envelope("X", "2024-01-01T08:00:00.000Z",
                                                                                      status=None)])
    log = microbatch.drain(spark, landing_dir, wh, ck, rejects_dir=rej)
    assert len(log.batches) == 1
    assert [r.product_id for r in P.table(wh, P.FCT).collect()] == ["A"]
    assert [r.reject_reason for r in spark.read.parquet(rej).collect()] == ["missing_critical:stock_status"]

    land(landing_dir, "b.json", [envelope("B", "2024-01-02T08:00:00.000Z")])
    log2 = microbatch.drain(spark, landing_dir, wh, ck)
    assert len(log2.batches) == 1                     # only the new file
    assert sorted(r.product_id for r in P.table(wh, P.FCT).collect()) == ["A", "B"]
    assert P.table(wh, P.RAW).count() == 2
    fct = {r.product_id: r for r in P.table(wh, P.FCT).collect()}
    assert fct["B"].ingestion_time == dt.datetime(2024, 1, 2, 8, 0) and fct["B"].date_key == 20240102

    log3 = microbatch.drain(spark, landing_dir, wh, ck)
    assert log3.batches == []                         # nothing new


def test_document_layout(spark, scratch):
    landing_dir, ck = scratch("landing"), scratch("ckpt")
    wh = Warehouse(spark, scratch("wh"))
    os.makedirs(landing_dir, exist_ok=True)
    with open(os.path.join(landing_dir, "run.json"), "w") as f:
        json.dump([envelope("A", "2024-01-01T08:00:00.000Z"), envelope("B", "2024-01-01T09:00:00.000Z")], f, indent=2)
    microbatch.drain(spark, landing_dir, wh, ck, layout="document")
    assert sorted(r.product_id for r in P.table(wh, P.STG).collect()) == ["A", "B"]


def test_counts_outlive_the_driver_and_a_timed_trigger_runs(spark, scratch):
    landing_dir, ck = scratch("landing"), scratch("ckpt")
    wh = Warehouse(spark, scratch("wh"))
    land(landing_dir, "a.json", [envelope("A", "2024-01-01T08:00:00.000Z"), envelope("X", "2024-01-01T08:00:00.000Z", status=None)])
    microbatch.drain(spark, landing_dir, wh, ck)
    land(landing_dir, "b.json", [envelope("B", "2024-01-02T08:00:00.000Z")])
    again = Warehouse(spark, wh.root)                 # as after a restart
    q = microbatch.start(spark, landing_dir, again, ck, cadence="1 second")
    try:
        for _ in range(90):
            if again.exists(P.FCT) and microbatch.load_counts(spark, again).count() == 2 or q.exception() is not None:
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    counts = {r.batch_id: (r.accepted, r.skipped, r.defaulted, r.late, r.no_time) for r in microbatch.load_counts(spark, again).collect()}
    assert counts == {0: (1, 1, 1, 0, 0), 1: (1, 0, 1, 0, 0)}
    assert sorted(r.product_id for r in P.table(Warehouse(spark, wh.root), P.FCT).collect()) == ["A", "B"]


def test_flattened_rows_are_kept_beside_the_tables_while_a_batch_runs(spark, scratch, monkeypatch):
    landing_dir, wh, read = scratch("landing"), Warehouse(spark, scratch("wh")), []
    split = landing.split
    monkeypatch.setattr(landing, "split", lambda wide, *a: read.append((wide._jdf.queryExecution().executedPlan().toString(), wide.count())) or split(wide, *a))
    land(landing_dir, "a.json", [envelope("A", "2024-01-01T08:00:00.000Z"), envelope("X", "2024-01-01T08:00:00.000Z", status=None)])
    microbatch.drain(spark, landing_dir, wh, scratch("ckpt"))
    plan, rows = read[-1]
    assert rows == 2 and "FileScan parquet" in plan and "InMemoryTableScan" not in plan and "Scan ExistingRDD" not in plan
    assert not os.listdir(f"{wh.root}/_staged/flattened")
    assert P.table(wh, P.RAW).count() == 1 and spark.read.parquet(wh.path("raw.rejects")).count() == 1
