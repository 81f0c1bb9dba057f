"""Uniqueness by bitmaps: the rows of a grouped count, a fraction of its shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import quality
from martflow.operators.quality import Check


def repeated(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffled_bytes(spark, df):
    """Bytes that the exchanges of an executed plan wrote."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        todo, total = [plan], 0
        while todo:
            p = todo.pop()
            if "ShuffleExchange" in p.getClass().getSimpleName():
                total += p.metrics().apply("shuffleBytesWritten").value()
            todo += [p.children().apply(i) for i in range(p.children().size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("shift", [0, -70_000, (1 << 62)])
def test_bitmaps_find_what_a_grouped_count_finds(spark, monkeypatch, shift):
    rnd = random.Random(1)
    keys = [rnd.randrange(100_000) + shift for _ in range(3000)] + [shift, shift, 32_768 + shift, 32_768 + shift, None, None]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    check = Check("t", "unique", ("id",))
    monkeypatch.setattr(quality, "bitmap_pays", lambda keyed: True)
    assert repeated(quality.bitmap_duplicates(df, check)) == repeated(quality._duplicates(df, check))


def test_pairs_with_null_parts(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(-20, 20)]), rnd.choice([None, *range(7)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a long, b int")
    check = Check("t", "unique_combination", ("a", "b"))
    monkeypatch.setattr(quality, "bitmap_pays", lambda keyed: True)
    assert repeated(quality.bitmap_duplicates(df, check)) == repeated(quality._duplicates(df, check))
    assert quality.bitmap_duplicates(df.where("false"), check).isEmpty()


def test_choice_by_measured_buckets(spark):
    together = spark.range(0, 200_000, 1, 4).select(F.col("id").alias("_key"))
    apart = together.select(F.xxhash64("_key").alias("_key"))
    assert quality.bitmap_pays(together) and not quality.bitmap_pays(apart)
    assert not quality.bitmap_pays(together.where("false"))
    assert quality.dense_key(spark.createDataFrame([("x",)], "s string"), ["s"]) is None
    wide = spark.createDataFrame([(0, 0), (1 << 61, 1 << 61)], "a long, b long")
    assert quality.dense_key(wide, ["a", "b"]) is None


def test_bitmaps_shuffle_less(spark, monkeypatch, capsys):
    df = spark.range(0, 400_000, 1, 4).union(spark.range(17, 18)).select(F.col("id").alias("id"))
    check = Check("t", "unique", ("id",))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    few, many = quality.bitmap_buckets(quality.dense_key(df, ["id"])), quality._duplicates(df, check)
    small, large = shuffled_bytes(spark, few), shuffled_bytes(spark, many)
    with capsys.disabled():
        print(f" [bitmaps shuffle {small} bytes, grouped counts {large}]", end="")
    assert small * 10 < large
    assert repeated(quality.bitmap_duplicates(df, check)) == [(17, 2)]
