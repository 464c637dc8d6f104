"""What the flattener does once for each item, and that it still tells apart what it did before."""

import json
import re

import pytest

from shelfwise.session import BASE_CONF
from shelfwise.sources import landing


def flat(spark, *items):
    text = spark.createDataFrame([(json.dumps({"data": [p]}),) for p in items], "value string")
    return landing.flatten(landing.envelopes(text))


def product(**members):
    return {"sku": "A", "price": {"msrp": 2.0, "sale": 1.0}, "stock": {"quantity": 1, "status": "In Stock"}, "supplier": {"name": "S"}, **members}


def test_an_item_is_taken_apart_once_and_only_leaves_are_copied(spark):
    plan = flat(spark, product()).wide._jdf.queryExecution().optimizedPlan().toString()
    casts = re.findall(r"try_variant_get\([^$]*\$, StructField", plan)
    assert len(casts) == 1                         # not once more for each container
    assert "array_compact" not in plan and "filter(array(" not in plan


def test_stages_too_long_to_be_compiled_are_not_fused(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == BASE_CONF["spark.sql.codegen.hugeMethodLimit"] == "8000"


@pytest.mark.parametrize("members, reason", [
    ({"reviews": {"tags": ["a", None]}}, "bad_type:reviews_tags"), ({"reviews": {"tags": [None, None]}}, "bad_type:reviews_tags"),
    ({"reviews": {"tags": ["a", 1]}}, "bad_type:reviews_tags"), ({"reviews": {"tags": [["a"]]}}, "bad_type:reviews_tags"),
    ({"reviews": None, "shipping": [1]}, "bad_container:reviews,shipping"),
    ({"stock": {"quantity": 1, "status": "x", "warehouse": "W"}}, "bad_container:stock.warehouse"),
    ({"stock": 3, "sku": None}, "bad_container:stock"), ({"supplier": {}, "sku": None}, "missing_critical:sku,supplier_name")])
def test_reasons(spark, members, reason):
    (row,) = flat(spark, product(**members)).rejects.collect()
    assert row.reject_reason == reason and row.document is not None


def test_tags_and_defaults(spark):
    res = flat(spark, product(reviews={"tags": []}, brand="b"), product(sku="B", reviews={"tags": ["a", "", "b"]}))
    assert {r.sku: r.reviews_tags for r in res.rows.collect()} == {"A": "", "B": "a, , b"}
    assert {r.sku: len(r.defaults_applied) for r in res.audit.collect()} == {"A": 6, "B": 7}
