"""The spread join equals the plain join and spreads what it promises to."""

import pytest
from pyspark.sql import functions as F

from contractlake.operators.skew import hot_keys, salt_left, salt_right, spread_join

from conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    """Half of the rows under one key, a quarter without key, many identical copies."""
    left = spark.range(8000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, "hot")
        .when(F.col("id") % 4 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("key"),
        (F.col("id") % 50).alias("value"),
        (F.col("id") % 3).alias("year"),
    )
    keys = left.select("key", "year").where("key <> 'k3'").distinct()
    return left, keys.withColumn("name", F.concat("key", F.col("year").cast("string")))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_plain_join(sides, how):
    left, right = sides
    spread = spread_join(left, right, "key", ["year"], how, parts=16)
    assert rows(spread) == rows(left.join(right, ["key", "year"], how))


def test_hot_keys_are_bounded_by_the_parts(sides):
    left, _ = sides
    for parts in (2, 4, 16, 1000):
        hot = hot_keys(left, "key", parts).collect()
        assert len(hot) <= parts
    hot = {r.key: r._salts for r in hot_keys(left, "key", 16).collect()}
    assert hot == {"hot": 11}  # two thirds of the rows that have a key


def test_hot_key_and_null_key_are_spread(sides):
    left, right = sides
    left = left.withColumn("row", F.monotonically_increasing_id())
    hot = hot_keys(left, "key", 16)
    salted = salt_left(left, hot, "key", 16)
    assert salted.count() == left.count()
    largest = salted.groupBy("key", "salt").count().groupBy("key").agg(F.max("count").alias("n"))
    found = {r.key: r.n for r in largest.collect()}
    assert found["hot"] < 8000 / 2 / 11 * 1.5
    assert found[None] < 8000 / 4 / 16 * 1.5
    repeated = salt_right(right, hot, "key").groupBy("key", "year").count()
    assert {r["count"] for r in repeated.where("key = 'hot'").collect()} == {11}
    assert {r["count"] for r in repeated.where("key <> 'hot'").collect()} == {1}


def test_salt_is_the_same_when_computed_again(sides):
    left, _ = sides
    hot = hot_keys(left, "key", 16)
    assert rows(salt_left(left, hot, "key", 16)) == rows(salt_left(left, hot, "key", 16))


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError):
        spread_join(*sides, "key", how="right")
