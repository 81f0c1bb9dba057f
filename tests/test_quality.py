"""Quality suite: passes on silver, and each of the 20 assertions fails on a fixture that breaks it."""

import pytest
from pyspark.sql import functions as F

from martflow.operators import quality
from martflow.plans.scenarios import silver_tables

SUITE = quality.SILVER_SUITE


def failing(summary_df):
    return {(r.model, r.test, r.columns) for r in summary_df.where("failures > 0").collect()}


def test_suite_has_twenty_assertions():
    assert len(SUITE) == 20
    kinds = [c.kind for c in SUITE]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("non_negative"),
            kinds.count("unique_combination")) == (4, 7, 8, 1)


def test_silver_passes(wh):
    tables = silver_tables(wh)
    assert failing(quality.summary(tables)) == set()
    assert quality.failures(tables).count() == 0


def _break(df, check):
    """Make exactly this assertion fail on one row of the real table."""
    col = check.columns[0]
    first = df.orderBy(*check.columns).limit(1)
    if check.kind in ("unique", "unique_combination"):
        return df.unionByName(first)  # a second copy of one key
    dtype = dict(df.dtypes)[col]
    if check.kind == "not_null":
        bad = first.withColumn(col, F.lit(None).cast(dtype))
    else:
        bad = first.withColumn(col, F.lit(-1).cast(dtype))
    return df.unionByName(bad)


@pytest.mark.parametrize("check", SUITE, ids=lambda c: f"{c.model}-{c.kind}-{c.column_label}")
def test_each_assertion_catches_its_defect(wh, check):
    tables = dict(silver_tables(wh))
    tables[check.model] = _break(tables[check.model], check)
    suite = [c for c in SUITE if c.model == check.model]
    got = failing(quality.summary(tables, suite))
    assert (check.model, check.kind, check.column_label) in got
    offenders = quality.failures(tables, [check])
    assert offenders.count() >= 1


def test_scoped_suite_catches_duplicates_across_partitions(wh):
    """Uniqueness scoped to changed rows still counts copies anywhere in the table."""
    tables = dict(silver_tables(wh))
    fo = tables["fact_orders"]
    changed_rows = fo.orderBy("order_id").limit(3)       # the rows of a touched partition
    tables["fact_orders"] = fo.unionByName(changed_rows)  # whose keys now exist twice
    got = failing(quality.summary(tables, changed={"fact_orders": changed_rows}))
    assert ("fact_orders", "unique", "order_id") in got
    clean = dict(silver_tables(wh))
    assert failing(quality.summary(clean, changed={"fact_orders": changed_rows})) == set()
