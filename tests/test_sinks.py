"""Tables on disk: layouts, plans, CSV, dictionary."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractlake.sinks.tables import (
    column_sketches,
    data_dictionary,
    distinct_counts,
    export_csv,
    join_bucketed,
    lookup,
    read_csv_export,
    read_table,
    write_bucketed,
    write_contract,
    write_vendor,
    year_path,
)

from conftest import plan_of, rows


@pytest.fixture(scope="module")
def contract(spark):
    """Half of the awards belong to one vendor, a tenth to none, many are exact copies."""
    number = F.col("id")
    return spark.range(2000, numPartitions=4).select(
        F.when(number % 10 == 3, None)
        .when(number % 2 == 0, "000000001")
        .otherwise(F.lpad((number % 40).cast("string"), 9, "0"))
        .alias("DUNSNumber"),
        F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(int(id % 700))").alias(
            "signedDate"
        ),
        (number % 100).cast("decimal(18,2)").alias("obligatedAmount"),
        (2000 + number % 3).cast("int").alias("year"),
    )


@pytest.fixture(scope="module")
def vendor(contract):
    keys = contract.select("DUNSNumber", "year").where("DUNSNumber > '000000003'").distinct()
    first = contract.select(F.lit("000000001").alias("DUNSNumber"), "year").distinct()
    return keys.unionByName(first).distinct().withColumn("name", F.concat(F.lit("v"), "DUNSNumber"))


@pytest.mark.parametrize("layout", ["sorted", "ranged"])
def test_contract_round_trip(spark, folder, contract, layout):
    write_contract(contract, folder, layout=layout)
    back = read_table(spark, folder, "contract")
    assert rows(back) == rows(contract)
    write_contract(contract.where("year = 2001").drop("year"), folder, "2009", layout)
    assert read_table(spark, folder, "contract").where("year = 2009").count() == 667


def test_rows_of_a_file_are_sorted_by_date(spark, folder, contract):
    path = write_contract(contract.drop("year"), folder, 2000)
    dates = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.collect_list("signedDate").alias("d"))
    )
    for row in dates.collect():
        assert row.d == sorted(row.d)


def test_ranged_layout_divides_a_date_with_very_many_rows(spark, folder, contract):
    one_day = contract.withColumn("signedDate", F.lit(dt.datetime(2000, 5, 5)).cast("timestamp_ntz"))
    one_day = one_day.withColumn("row", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_contract(one_day.drop("year"), folder, 2000, "ranged")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 1000


def test_existing_table_is_left_alone(spark, folder, contract, vendor):
    contract, vendor = contract.drop("year"), vendor.drop("year")
    path = write_contract(contract, folder, 2000)
    write_vendor(vendor, folder, 2000)
    before = rows(spark.read.parquet(path))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_contract(contract.limit(1), folder, 2000)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_vendor(vendor, folder, 2000)
    assert rows(spark.read.parquet(path)) == before
    with pytest.raises(ValueError, match="layout"):
        write_contract(contract, folder, 2001, "heap")
    with pytest.raises(ValueError, match="rename the column 'year'"):
        write_contract(contract.withColumn("Year", F.lit(1)), folder, 2001)


def test_year_and_date_filters_reach_the_scan(spark, folder, contract):
    write_contract(contract, folder)
    table = read_table(spark, folder, "contract")
    plan = plan_of(table.where("year = 2001").select("DUNSNumber"))
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<DUNSNumber:string>" in plan
    day = F.lit("2000-03-01").cast("timestamp_ntz")
    plan = plan_of(table.where(F.col("signedDate") > day))
    assert "PushedFilters: [IsNotNull(signedDate), GreaterThan(signedDate" in plan
    assert year_path(folder, "contract", 2001).endswith("/contract/year=2001")


def test_years_that_disagree_about_a_type(spark, folder):
    dated = spark.createDataFrame([("a", 1)], "signedDate string, n int")
    write_contract(dated, folder, 2000)
    write_contract(dated.withColumn("n", F.lit("1")), folder, 2001)
    with pytest.raises(ValueError, match="'n' changes its type .*year=2001"):
        read_table(spark, folder, "contract")


def test_bucketed_join_has_no_exchange_and_no_hot_bucket(spark, folder, contract, vendor):
    suffix = uuid.uuid4().hex
    names = (f"contract_{suffix}", f"vendor_{suffix}")
    write_bucketed(contract, vendor, folder, names, buckets=8, more_keys=("year",))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_bucketed(spark, names, "year")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert rows(joined) == rows(contract.join(vendor, ["DUNSNumber", "year"], "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sizes = spark.table(names[0]).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) <= 8 and max(r["count"] for r in sizes) < 2000 / 2.5
    assert spark.table(names[0]).select("salt").distinct().count() > 1


def test_csv_round_trip_with_awkward_text(spark, folder):
    data = [(1, 'a "b", c'), (2, "line\nbreak"), (3, None), (4, ""), (5, " é€ "), (6, "\\"), (7, "a\r\nb\rc")]
    time = F.expr("timestamp_ntz'2004-05-06 07:08:09.123456'")
    df = spark.createDataFrame(data, "n int, t string").withColumn("d", time)
    export_csv(df, f"{folder}/c")
    files = spark.read.format("binaryFile").load(f"{folder}/c/*.csv.gz")
    assert files.count() >= 1
    assert rows(read_csv_export(spark, f"{folder}/c", df.schema)) == rows(df)


def test_csv_joins_arrays(spark, folder):
    df = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    export_csv(df, f"{folder}/c")
    schema = df.select(F.array_join("t", ",").alias("t")).schema
    assert read_csv_export(spark, f"{folder}/c", schema).first() == ("a,b",)


def test_data_dictionary(spark):
    df = spark.createDataFrame([("aé", 1), (None, 2)], "t string, n int")
    df = df.withMetadata("t", {"maxlength": 7, "path": "a:b.a:t"})
    assert data_dictionary(df, "x").collect() == [
        ("x", "a:b.a:t", "t", "string", 7, 1, 3),
        ("x", "n", "n", "int", None, 2, None),
    ]


def test_all_years_are_few_files_however_many_tasks(spark, folder):
    frame = spark.range(0, 4000, 1, 40).selectExpr(
        "cast(id AS string) AS DUNSNumber", "cast('2001-01-01' AS timestamp_ntz) AS signedDate",
        "CAST(1995 + id % 13 AS int) AS year",
    )
    write_contract(frame, folder)
    write_vendor(frame.drop("signedDate"), folder)
    for table in ("contract", "vendor"):
        assert len(list(Path(folder, table).glob("year=*/*.parquet"))) <= 26
        assert read_table(spark, folder, table).count() == 4000


def test_both_sides_of_bucketed_tables_spread_alike(spark, folder):
    """One frame as both sides: every row finds itself, also those of a vendor with half the rows."""
    frame = spark.range(4000).selectExpr(
        "if(id % 2 = 0, 'hot', cast(id AS string)) AS DUNSNumber", "id", "cast('2001-01-01' AS timestamp_ntz) AS signedDate"
    )
    vendor = frame.select("DUNSNumber").distinct().selectExpr("DUNSNumber", "upper(DUNSNumber) AS name")
    name = folder.rsplit("-", 1)[-1]
    names = write_bucketed(frame, vendor, folder, (f"c_{name}", f"v_{name}"))
    joined = join_bucketed(spark, names)
    assert joined.count() == 4000 and joined.where("name IS NULL OR name <> upper(DUNSNumber)").count() == 0


def scanned_rows(df):
    """Rows that the scans of a finished query gave, by their own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_lookup_leaves_out_row_groups(spark, folder):
    """Ids are in no order, so only the filters can tell which of the 16 files may hold one."""
    ids = spark.range(64_000, numPartitions=16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("unique_award_id"), F.lpad(F.col("id").cast("string"), 9, "0").alias("DUNSNumber"),
        F.expr("timestamp_ntz'2000-01-01 00:00:00'").alias("signedDate"),
    )
    write_contract(ids, folder, 2000)
    table = read_table(spark, folder, "contract")
    wanted = [r[0] for r in ids.where("DUNSNumber IN ('000000007', '000050007')").select("unique_award_id").collect()]
    found = lookup(table, "unique_award_id", wanted)
    assert sorted(r.DUNSNumber for r in found.collect()) == ["000000007", "000050007"]
    assert scanned_rows(found) <= 64_000 / 16 * 3
    assert scanned_rows(lookup(table, "unique_award_id", ["no such id"])) <= 64_000 / 16
    spark.conf.set("spark.sql.parquet.filterPushdown", "false")
    try:
        assert scanned_rows(lookup(table, "unique_award_id", wanted)) == 64_000
    finally:
        spark.conf.unset("spark.sql.parquet.filterPushdown")


def test_sketches_of_years_add_up(spark):
    """Years share values: the merged sketch counts each once, within five percent."""
    years = [spark.range(20_000).selectExpr(f"id + {8_000 * n} AS a", "id % 7 AS b", "IF(id % 2 = 0, id, NULL) AS c") for n in range(3)]
    sketches = [column_sketches(df, "t", 2000 + n) for n, df in enumerate(years)]
    merged = sketches[0].unionByName(sketches[1]).unionByName(sketches[2])
    found = {r.column: (r.filled, r["values"]) for r in distinct_counts(merged).collect()}
    assert {k: v[0] for k, v in found.items()} == {"a": 60_000, "b": 60_000, "c": 30_000}
    for name, exact in (("a", 36_000), ("b", 7), ("c", 10_000)):
        assert abs(found[name][1] - exact) <= 0.05 * exact
    empty = distinct_counts(column_sketches(years[0].limit(0), "t", 2000)).collect()
    assert {(r.filled, r["values"]) for r in empty} == {(0, 0)}
