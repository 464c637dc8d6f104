import datetime as dt

from shelfwise.schemas import RAW_COLUMNS, RAW_SCHEMA

DEFAULTS = dict(stock_status="In Stock", stock_quantity=10, supplier_lead_time_days=1, reviews_rating=4.0,
                reviews_review_count=10, msrp=1.0, sale=1.0, discount=0.0, supplier_name="S",
                supplier_contact="s@x", name="n", category="c", brand="b", stock_region="EU",
                stock_last_restocked=dt.datetime(2024, 5, 1))


def raw_rows(spark, rows):
    """Raw snapshot rows from dicts; unspecified columns take DEFAULTS or NULL."""
    base = {c: None for c in RAW_COLUMNS}
    base.update(DEFAULTS)
    return spark.createDataFrame([tuple({**base, **r}[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)
