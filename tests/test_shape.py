"""Keys, one row per vendor, widths, rejects."""

import random

import pytest
from pyspark.sql import functions as F

from contractlake.functions.keys import blank_to_null, joined_key
from contractlake.functions.text import truncate_utf8
from contractlake.operators.dedupe import dedupe_vendors
from contractlake.operators.rejects import (
    LoadError,
    apply_types,
    cast_rules,
    check_rejects,
    split_rejects,
)
from contractlake.operators.width import DEFAULT_WIDTH, apply_widths, cut_counts, truncate_bytes

from conftest import plan_of, rows

VENDORS = "DUNSNumber string, signedDate string, name string"


def test_joined_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("a", " "), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(joined_key([F.col("x"), F.col("y")])).collect()]
    assert keys == ["a_b", None, None, None]
    assert df.select(blank_to_null(F.lit(" x "))).first() == (" x ",)


def test_latest_vendor_row_does_not_depend_on_partitions(spark):
    random.seed(1)
    data = [
        (random.choice(["1", "2", "3", None, " ", ""]), random.choice(["2001", "2002", None]), str(i))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, VENDORS)
    expected = {}
    for key, date, name in data:
        if key and key.strip():
            expected[key] = max(expected.get(key, ("", "")), (date or "", name))
    results = [rows(dedupe_vendors(df.repartition(n), keep_order_columns=True)) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]
    found = dedupe_vendors(df, keep_order_columns=True).collect()
    assert {r.DUNSNumber: (r.signedDate, r.name) for r in found} == expected
    assert dedupe_vendors(df).columns == ["DUNSNumber", "name"]


def test_vendor_rows_shrink_before_the_shuffle(spark):
    df = spark.createDataFrame([("1", "2001", "a")], VENDORS)
    plan = plan_of(dedupe_vendors(df))
    assert plan.index("functions=[max(") < plan.index("Exchange") < plan.index("partial_max")


def test_any_row_per_vendor(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("1", "b", "y"), (None, "c", "z")], VENDORS)
    assert dedupe_vendors(df, mode="any").count() == 1
    assert dedupe_vendors(df.select("DUNSNumber")).collect() == [("1",)]
    with pytest.raises(ValueError):
        dedupe_vendors(df, mode="first")


def cut_in_python(text, width):
    data = text.encode()
    return text if len(data) <= width else data[:width].decode(errors="ignore")


def test_truncation_equals_python_and_is_idempotent(spark):
    random.seed(2)
    letters = "aé€😀ß日"
    texts = ["".join(random.choices(letters, k=random.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    for width in range(4, 20):
        cut = df.select("t", truncate_utf8("t", width).alias("c"))
        cut = cut.withColumn("again", truncate_utf8("c", width))
        for text, short, again in cut.collect():
            if text is None:
                assert short is None
            else:
                assert short == again == cut_in_python(text, width)
                assert len(short.encode()) <= width
    with pytest.raises(ValueError):
        truncate_utf8("t", 3)


def test_width_borders(spark):
    df = spark.createDataFrame([("a" * 8, "a" * 9, "a" * 7 + "é")], "x string, y string, z string")
    cut = truncate_bytes(df, {"x": 8, "y": 8, "z": 8, "absent": 5})
    assert cut.first() == ("a" * 8, "a" * 8, "a" * 7)


def test_width_metadata_outlives_parquet(spark, folder):
    df = spark.createDataFrame([("a", "b" * 300, 1)], "x string, y string, n int")
    wide = apply_widths(df, {"x": 5, "nothing": 9}, DEFAULT_WIDTH)
    assert cut_counts(df, {"x": 5}, DEFAULT_WIDTH) == {"y": 1} and cut_counts(df, {}) == {}
    wide.write.parquet(f"{folder}/w")
    schema = spark.read.parquet(f"{folder}/w").schema
    assert schema["x"].metadata["maxlength"] == 5
    assert schema["y"].metadata["maxlength"] == 256
    assert schema["n"].metadata == {}
    assert len(wide.first().y) == 256
    untouched = apply_widths(df, {})
    assert untouched.schema["y"].metadata == {} and len(untouched.first().y) == 300
    assert len(apply_widths(df, {}, DEFAULT_WIDTH, truncate=False).first().y) == 300


def test_every_row_is_good_or_rejected(spark):
    df = spark.createDataFrame(
        [("1", "2004-01-01"), ("x", "2004-01-01"), ("x", "?"), (None, None)], "n string, d string"
    )
    types = {"n": "decimal(18,2)", "d": "date", "absent": "int"}
    good, bad = split_rejects(df, cast_rules(types, df.columns))
    assert good.count() + bad.count() == df.count()
    assert [r.reasons for r in bad.collect()] == [
        ["n is not decimal(18,2)"],
        ["n is not decimal(18,2)", "d is not date"],
    ]
    assert dict(apply_types(good, types).dtypes) == {"n": "decimal(18,2)", "d": "date"}
    unruled, none = split_rejects(df, {"never": F.lit(None).cast("boolean")})
    assert (unruled.count(), none.count()) == (4, 0)
    assert [f.count() for f in split_rejects(df, {})] == [4, 0]


def test_limit_of_rejects(spark):
    rejected = spark.range(49)
    assert check_rejects(rejected, 50) == 49
    with pytest.raises(LoadError):
        check_rejects(spark.range(50), 50)
