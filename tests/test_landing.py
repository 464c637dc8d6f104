"""Flattener truth table: envelope / item / container / leaf rules."""

import copy
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import models
from shelfwise.schemas import RAW_COLUMNS
from shelfwise.sources import landing

HERE = os.path.dirname(os.path.abspath(__file__))
SAMPLE = json.load(open(os.path.join(HERE, "fixtures", "sample_envelopes.json")))
PRODUCT = SAMPLE[0]["data"][0]
MISSING = object()


def product(**changes):
    """The sample product with dotted-path changes (MISSING deletes a key)."""
    p = copy.deepcopy(PRODUCT)
    for path, value in changes.items():
        keys = path.split("__")
        node = p
        for k in keys[:-1]:
            node = node[k]
        if value is MISSING:
            node.pop(keys[-1], None)
        else:
            node[keys[-1]] = value
    return p


class Batch:
    """Collects every case of this module, flattens them in ONE Spark job
    (case id carried as a pass-through column), then serves results."""

    def __init__(self):
        self.docs: list[tuple[str, str]] = []
        self.result = None

    def add(self, case: str, doc) -> str:
        self.docs.append((case, json.dumps(doc)))
        return case

    def run(self, spark):
        if self.result is None:
            text = spark.createDataFrame(self.docs, "case string, value string")
            res = landing.flatten(landing.envelopes(text, passthrough=("case",)), passthrough=("case",))
            rows, rejects = {}, {}
            for r in res.rows.collect():
                rows.setdefault(r.case, []).append(r)
            for r in res.rejects.collect():
                rejects.setdefault(r.case, []).append(r)
            self.result = rows, rejects
        return self.result


BATCH = Batch()


def _case(doc) -> str:
    return BATCH.add(f"c{len(BATCH.docs)}", doc)


def flat(spark, docs, case=None):
    """Rows and rejects of one registered case (docs is a list of envelopes
    or envelope arrays, one text value each)."""
    rows, rejects = BATCH.run(spark)
    return rows.get(case, []), rejects.get(case, [])


def one(spark, case):
    rows, rejects = flat(spark, None, case)
    return (rows[0] if rows else None), (rejects[0].reject_reason if rejects else None)


def env(prod):
    return {"meta": {}, "data": [prod]}


SAMPLE_CASE = _case(SAMPLE)  # file shape: an array of envelopes


def test_sample_document(spark):
    rows, rejects = flat(spark, None, SAMPLE_CASE)
    assert not rejects and len(rows) == 1
    r = rows[0]
    assert r.sku == "LMP-000731-04" and r.sale == 52.25 and r.msrp == 61.5 and r.discount == 15.0
    assert r.stock_quantity == 0 and r.stock_status == "Backordered" and r.stock_region == "Nordics"
    assert r.stock_reorder_point == 22 and r.supplier_lead_time_days == 10
    assert r.stock_last_restocked == dt.datetime(2024, 5, 1, 8, 15, 30, 125000)
    assert r.reviews_tags == "desk, dimmable" and r.reviews_review_count == 812
    assert r.shipping_free_shipping is True and r.generated_at == dt.datetime(2024, 9, 18, 6, 30, 0, 500000)


def test_sample_signals(spark):
    """Expected flags of the sample when its generation instant is the
    ingestion time: 139 whole days -> STALE, BACKORDER, lead 10 is not > 10."""
    text = spark.createDataFrame([(json.dumps(SAMPLE),)], "value string")
    raw, _ = landing.flatten_text(text)
    r = models.int_inventory_signals(models.stg_products(raw)).first()
    assert r.days_since_last_restock == 139 and r.restock_staleness_flag == "STALE"
    assert r.normalized_stock_status == "BACKORDER" and r.alert_flag is False
    assert r.in_stock_risk_flag is False and r.backorder_delay_flag is False
    assert r.high_demand_flag is True and r.inventory_risk_flag == "LOW_RISK"


@pytest.mark.parametrize("case", [_case({"meta": {}})] + [_case({"meta": {}, "data": d})
                                                          for d in (None, [], {}, "", 0)])
def test_empty_or_falsy_data_is_skipped_silently(spark, case):
    assert flat(spark, None, case) == ([], [])


@pytest.mark.parametrize("case", [_case({"data": d}) for d in ("abc", 5, {"a": 1})])
def test_truthy_non_array_data_is_rejected(spark, case):
    rows, rejects = flat(spark, None, case)
    assert rows == [] and [r.reject_reason for r in rejects] == ["data_not_array"]


@pytest.mark.parametrize("case", [_case({"data": [item, PRODUCT]}) for item in ({}, "str", None, 5, [])])
def test_invalid_items(spark, case):
    rows, rejects = flat(spark, None, case)
    assert len(rows) == 1 and [r.reject_reason for r in rejects] == ["invalid_item"]


@pytest.mark.parametrize("case", [_case(env(product(**{c: v})))
                                  for c in ("price", "stock", "supplier", "reviews", "shipping", "stock__warehouse")
                                  for v in (None, "text", [1])])
def test_null_or_non_object_container_rejects(spark, case):
    row, reason = one(spark, case)
    assert row is None and reason.startswith("bad_container:")


@pytest.mark.parametrize("container,case", [(c, _case(env(product(**{c: MISSING}))))
                                            for c in ("reviews", "shipping", "stock__warehouse")])
def test_missing_optional_container_defaults(spark, container, case):
    row, reason = one(spark, case)
    assert reason is None
    if container == "reviews":
        assert row.reviews_rating == 0.0 and row.reviews_review_count == 0 and row.reviews_tags == ""
    if container == "shipping":
        assert row.shipping_free_shipping is False and row.shipping_weight is None
    if container == "stock__warehouse":
        assert row.stock_region == "UNKNOWN" and row.stock_code is None


CRITICAL = [("sku", "sku"), ("stock__quantity", "stock_quantity"), ("stock__status", "stock_status"),
            ("price__msrp", "msrp"), ("price__sale", "sale_price"), ("supplier__name", "supplier_name")]


@pytest.mark.parametrize("label,case", [(label, _case(env(product(**{path: v}))))
                                        for path, label in CRITICAL for v in (MISSING, None)])
def test_critical_fields(spark, label, case):
    row, reason = one(spark, case)
    assert row is None and reason == f"missing_critical:{label}"


MISSING_PRICE = _case(env(product(price=MISSING)))


def test_missing_price_container_is_critical(spark):
    row, reason = one(spark, MISSING_PRICE)
    assert row is None and reason == "missing_critical:msrp,sale_price"


DEFAULTS = _case(env(product(supplier__leadTimeDays=None, stock__reorderPoint=MISSING, reviews__reviewCount=None,
                             stock__warehouse__region=None, category=MISSING, brand=None, reviews__rating=MISSING)))


def test_defaults(spark):
    row, reason = one(spark, DEFAULTS)
    assert reason is None
    assert (row.supplier_lead_time_days, row.stock_reorder_point, row.reviews_review_count) == (0, 0, 0)
    assert (row.stock_region, row.category, row.brand) == ("UNKNOWN", "UNKNOWN", "UNKNOWN")
    assert row.reviews_rating == 0.0


EMPTY_STRINGS = _case(env(product(category="", price__currency="")))


def test_empty_strings(spark):
    row, _ = one(spark, EMPTY_STRINGS)
    assert row.category == "" and row.currency == "USD"


@pytest.mark.parametrize("expected,case", [(e, _case(env(product(price__discount=v))))
                                           for v, e in [(None, 0.0), (0, 0.0), ("", 0.0), (12.5, 12.5),
                                                        (MISSING, 0.0)]])
def test_discount_falsy(spark, expected, case):
    row, _ = one(spark, case)
    assert row.discount == expected


@pytest.mark.parametrize("expected,case", [(e, _case(env(product(shipping__freeShipping=v))))
                                           for v, e in [(None, False), (False, False), (True, True), (0, False)]])
def test_free_shipping(spark, expected, case):
    row, _ = one(spark, case)
    assert row.shipping_free_shipping is expected


@pytest.mark.parametrize("expected,case", [(e, _case(env(product(reviews__tags=t))))
                                           for t, e in [(["a", "b"], "a, b"), ([], ""), ("solo", "solo"),
                                                        (None, ""), ("", ""), (MISSING, "")]])
def test_tags(spark, expected, case):
    row, reason = one(spark, case)
    assert reason is None and row.reviews_tags == expected


@pytest.mark.parametrize("case", [_case(env(product(reviews__tags=t))) for t in (["a", 1], ["a", None], [{"x": 1}])])
def test_tags_with_non_string_reject(spark, case):
    row, reason = one(spark, case)
    assert row is None and reason == "bad_type:reviews_tags"


@pytest.mark.parametrize("case", [_case(env(product(**{p: v})))
                                  for p, v in [("stock__quantity", 12.5), ("stock__quantity", True),
                                               ("price__msrp", "abc"), ("stock__lastRestocked", "not a time")]])
def test_bad_types_reject(spark, case):
    row, reason = one(spark, case)
    assert row is None and reason.startswith("bad_type:")


NUMERIC_STRINGS = _case(env(product(stock__quantity="12", price__msrp="9.5")))


def test_numeric_strings_are_accepted(spark):
    row, reason = one(spark, NUMERIC_STRINGS)
    assert reason is None and row.stock_quantity == 12 and row.msrp == 9.5


def test_unparseable_text_is_rejected(spark):
    text = spark.createDataFrame([("{not json",)], "value string")
    res = landing.flatten(landing.envelopes(text))
    assert res.rows.count() == 0 and [r.reject_reason for r in res.rejects.collect()] == ["data_not_array"]


def test_audit_lists_warned_defaults(spark):
    text = spark.createDataFrame([(json.dumps({"data": [product(brand=MISSING, reviews__rating=None)]}),)],
                                 "value string")
    audit = landing.flatten(landing.envelopes(text)).audit.collect()
    assert sorted(audit[0].defaults_applied) == ["brand", "reviews_rating"]


def test_envelope_roundtrip(spark):
    """raw rows -> envelopes -> flatten gives the same rows back; NULL
    optional fields come back with their defaults."""
    from shelfwise.schemas import RAW_SCHEMA
    vals = {c: None for c in RAW_COLUMNS}
    vals.update(sku="S1", stock_status="In Stock", supplier_name="Sup", stock_quantity=3, msrp=2.5, sale=2.0,
                ingestion_time=dt.datetime(2024, 1, 2, 3, 4, 5))
    raw = spark.createDataFrame([tuple(vals[c] for c in RAW_COLUMNS)], RAW_SCHEMA)
    back, rejects = landing.flatten_text(landing.to_envelopes(raw))
    r = back.first()
    assert rejects.count() == 0
    assert (r.sku, r.stock_quantity, r.msrp, r.sale) == ("S1", 3, 2.5, 2.0)
    assert r.ingestion_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.category == "UNKNOWN" and r.currency == "USD" and r.discount == 0.0
