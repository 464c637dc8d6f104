"""Declarative data-quality assertions.

Each check is a query returning its violating rows; empty means pass. The six
kinds and their row semantics:

* ``not_null``           rows where the column is NULL
* ``unique``             values (NULL excluded) occurring more than once
* ``unique_combination`` key combinations (NULLs included) occurring more
                         than once
* ``accepted_values``    distinct non-NULL values outside the list
* ``accepted_range``     rows with ``c < min OR c > max`` (NULL passes)
* ``relationships``      child rows whose non-NULL key has no parent row

``summary`` evaluates a whole suite with few passes: all row-level checks of
one table (not_null, accepted_values, accepted_range) fold into a single
aggregate over that table; uniqueness is a grouped count (partial
aggregation before the shuffle, so a hot key costs one row per map task);
relationships count child keys map-side, anti-join them against the distinct
parent keys and sum, so only keys cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.schemas import NORMALIZED_STATUS_VALUES, RISK_VALUES, STOCK_STATUS_VALUES

SUMMARY_COLUMNS = ["table_name", "check_name", "column_name", "n_violations"]


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    to_table: str | None = None
    to_field: str | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        c = self.columns[0]
        if self.kind == "not_null":
            return not_null_violations(df, c)
        if self.kind == "unique":
            return unique_violations(df, c)
        if self.kind == "unique_combination":
            return unique_combination_violations(df, self.columns)
        if self.kind == "accepted_values":
            return accepted_values_violations(df, c, self.values)
        if self.kind == "accepted_range":
            return accepted_range_violations(df, c, self.min_value, self.max_value)
        if self.kind == "relationships":
            return relationships_violations(df, c, tables[self.to_table], self.to_field)
        raise ValueError(f"unknown check kind {self.kind}")


# -- one function per kind -------------------------------------------------------

def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unique_combination_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(~F.col("value_field").isin(list(values))))


def _range_violation(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def accepted_range_violations(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.filter(_range_violation(F.col(column), min_value, max_value))


def relationships_violations(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    keys = parent.select(F.col(field).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, on=column, how="left_anti")


# -- the suite as data -----------------------------------------------------------

def _nn(table: str, *cols: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in cols]


RAW, STG, INT, FCT = ("raw.products", "staging.stg_products", "intermediate.int_inventory_signals",
                      "marts.fct_inventory")
DIM_P, DIM_S, DIM_D = "marts.dim_products", "marts.dim_suppliers", "marts.dim_dates"

# The 51 assertions of the source project.
SUITE: list[Check] = [
    *_nn(RAW, "sku", "sale", "stock_quantity", "reviews_rating", "ingestion_time"),
    Check(RAW, "accepted_values", ("stock_status",), values=tuple(STOCK_STATUS_VALUES)),
    Check(STG, "unique_combination", ("product_id", "ingestion_time")),
    *_nn(STG, "product_id", "ingestion_time", "stock_quantity", "sale_price", "rating"),
    Check(STG, "accepted_range", ("stock_quantity",), min_value=0, max_value=1000000),
    Check(STG, "accepted_range", ("discount",), min_value=0, max_value=100),
    Check(STG, "accepted_range", ("lead_time_days",), min_value=0, max_value=365),
    Check(STG, "accepted_range", ("rating",), min_value=1, max_value=5),
    *_nn(INT, "product_id", "ingestion_time", "normalized_stock_status", "inventory_risk_flag",
         "alert_flag", "high_demand_flag"),
    Check(INT, "accepted_values", ("normalized_stock_status",), values=tuple(NORMALIZED_STATUS_VALUES)),
    Check(INT, "accepted_values", ("inventory_risk_flag",), values=tuple(RISK_VALUES)),
    *_nn(DIM_D, "date_key", "full_date", "day", "month", "year", "day_of_week"),
    Check(DIM_D, "unique", ("date_key",)),
    Check(DIM_D, "unique", ("full_date",)),
    *_nn(DIM_P, "product_id", "product_name", "product_category"),
    Check(DIM_P, "unique", ("product_id",)),
    *_nn(DIM_S, "supplier_name", "supplier_contact"),
    Check(DIM_S, "unique", ("supplier_name",)),
    *_nn(FCT, "product_id", "supplier_name", "date_key", "ingestion_time", "stock_quantity",
         "normalized_stock_status", "sale_price", "alert_flag", "inventory_risk_flag"),
    Check(FCT, "relationships", ("product_id",), to_table=DIM_P, to_field="product_id"),
    Check(FCT, "relationships", ("supplier_name",), to_table=DIM_S, to_field="supplier_name"),
    Check(FCT, "unique_combination", ("product_id", "ingestion_time")),
]

ROW_LEVEL = ("not_null", "accepted_values", "accepted_range")


def _row_level_counts(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in one aggregate, unpivoted to
    summary rows."""
    aggs = []
    for i, ch in enumerate(checks):
        c = F.col(ch.columns[0])
        if ch.kind == "not_null":
            a = F.count_if(c.isNull())
        elif ch.kind == "accepted_range":
            a = F.count_if(_range_violation(c, ch.min_value, ch.max_value))
        else:  # accepted_values: distinct offending values
            a = F.count_distinct(F.when(~c.isin(list(ch.values)), c))
        aggs.append(a.cast("long").alias(f"v{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(ch.kind).alias("check_name"),
                              F.lit(ch.column_label).alias("column_name"),
                              F.col(f"v{i}").alias("n_violations"))
                     for i, ch in enumerate(checks)])
    return wide.select(F.inline(rows))


def relationships_violation_count(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Number of child rows without a parent, shuffling keys, not rows: child
    keys are counted map-side first (a hot key costs one row per map task),
    then anti-joined against the distinct parent keys and summed."""
    counts = (child.filter(F.col(column).isNotNull()).groupBy(column)
                   .agg(F.count(F.lit(1)).alias("n")))
    keys = parent.select(F.col(field).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return (counts.join(keys, on=column, how="left_anti")
                  .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_violations")))


def _count_row(ch: Check, violations: DataFrame) -> DataFrame:
    if "n_violations" not in violations.columns:
        violations = violations.agg(F.count(F.lit(1)).cast("long").alias("n_violations"))
    return violations.select(
        F.lit(ch.table).alias("table_name"), F.lit(ch.kind).alias("check_name"),
        F.lit(ch.column_label).alias("column_name"), "n_violations")


def summary(tables: Mapping[str, DataFrame], checks: Sequence[Check] = SUITE) -> DataFrame:
    """(table_name, check_name, column_name, n_violations), one row per check."""
    parts = []
    by_table: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_LEVEL:
            by_table.setdefault(ch.table, []).append(ch)
        elif ch.kind == "relationships":
            parts.append(_count_row(ch, relationships_violation_count(
                tables[ch.table], ch.columns[0], tables[ch.to_table], ch.to_field)))
        else:
            parts.append(_count_row(ch, ch.violations(tables)))
    for table, chs in by_table.items():
        parts.insert(0, _row_level_counts(table, tables[table], chs))
    return reduce(DataFrame.unionByName, parts)


def assert_clean(tables: Mapping[str, DataFrame], checks: Sequence[Check] = SUITE) -> DataFrame:
    """Raise if any check fails; returns the (small, already computed)
    summary otherwise."""
    s = summary(tables, checks).cache()
    failing = s.filter(F.col("n_violations") > 0).collect()
    if failing:
        lines = ", ".join(f"{r.table_name}.{r.column_name} {r.check_name}={r.n_violations}" for r in failing)
        raise AssertionError(f"data quality checks failed: {lines}")
    return s


def kind(checks: Sequence[Check], name: str) -> list[Check]:
    return [c for c in checks if c.kind == name]
