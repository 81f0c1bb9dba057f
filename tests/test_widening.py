"""Schema evolution with wider types: the lattice, values unchanged, refusals."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from martflow.operators import merge

LONG, INT, DATE, NTZ = T.LongType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()


@pytest.mark.parametrize("a,b,want", [
    (INT, LONG, LONG), (T.ByteType(), T.ShortType(), T.ShortType()), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (INT, T.DoubleType(), T.DoubleType()), (LONG, T.DoubleType(), None), (INT, T.FloatType(), None),
    (T.DecimalType(6, 2), T.DecimalType(12, 2), T.DecimalType(12, 2)),
    (T.DecimalType(6, 2), T.DecimalType(6, 4), T.DecimalType(8, 4)), (INT, T.DecimalType(6, 2), T.DecimalType(12, 2)),
    (T.DecimalType(38, 0), T.DecimalType(6, 2), None), (DATE, NTZ, NTZ), (DATE, T.TimestampType(), T.TimestampType()),
    (NTZ, T.TimestampType(), None), (T.StringType(), LONG, None), (T.NullType(), DATE, DATE)])
def test_lattice(a, b, want):
    assert merge.wider(a, b) == want and merge.wider(b, a) == want


def test_both_sides_keep_their_values(spark):
    old = spark.createDataFrame([(1, Decimal("9999.99"), dt.date(2024, 1, 2)), (2, None, None)], "k int, m decimal(6,2), at date")
    new = spark.createDataFrame([(1 << 40, Decimal("123456789.1234"), dt.datetime(2024, 1, 2, 3))], "k long, m decimal(13,4), at timestamp_ntz")
    for a, b in ((old, new), (new, old)):
        out = merge.union_evolving(a, b)
        assert [f.dataType for f in out.schema] == [LONG, T.DecimalType(13, 4), NTZ]
        assert {tuple(r) for r in out.collect()} == {
            (1, Decimal("9999.9900"), dt.datetime(2024, 1, 2)), (2, None, None),
            (1 << 40, Decimal("123456789.1234"), dt.datetime(2024, 1, 2, 3))}


def test_upsert_compares_versions_in_the_wider_type(spark):
    old = spark.createDataFrame([(1, dt.date(2024, 1, 2), "a"), (2, dt.date(2024, 1, 3), "b")], "k int, at date, v string")
    new = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 5), "c"), (2, dt.datetime(2024, 1, 2, 23), "d")], "k long, at timestamp_ntz, v string")
    got = merge.merge_upsert(old, new, ["k"], ts_col="at")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "c"), (2, "b")]


def test_types_without_a_common_one_are_refused(spark):
    old = spark.createDataFrame([(1, "x")], "k long, a string")
    with pytest.raises(TypeError, match="a: string and int"):
        merge.union_evolving(old, spark.createDataFrame([(1, 5)], "k long, a int"))
