"""The ad hoc questions on a small table, counted by hand."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from contractlake.plans import questions as ask

CONTRACT = "DUNSNumber string, agencyID string, productOrServiceCode string, referencedID string, \
PIID string, signedDate string, obligatedAmount decimal(18,2), year int"
DATA = [
    ("1", "0300", "A", None, "p", "2004-01-05", Decimal("10.10"), 2004),
    ("1", "0300", "B", "v", "p", "2004-01-31", Decimal("0.20"), 2004),
    ("2", "9700", "A", "v", "q", "2004-02-01", Decimal("5.00"), 2004),
    (None, "9700", None, None, "p", "2005-02-01", Decimal("-1.00"), 2005),
    ("1", "9700", "A", None, "p", None, None, 2005),
]


@pytest.fixture(scope="module")
def contract(spark):
    return spark.createDataFrame(DATA, CONTRACT).withColumn(
        "signedDate", F.col("signedDate").cast("timestamp_ntz")
    )


@pytest.fixture(scope="module")
def vendor(spark):
    data = [("1", "US", 2004), ("1", "CA", 2005), ("3", "FR", 2004)]
    return spark.createDataFrame(data, "DUNSNumber string, countryCode string, year int")


def found(df):
    return {tuple(str(v) for v in r) for r in df.collect()}


def test_sums(contract):
    assert found(ask.spend_by_agency(contract)) == {("0300", "10.30", "2"), ("9700", "4.00", "3")}
    assert found(ask.spend_by_product(contract)) == {
        ("A", "15.10", "3"), ("B", "0.20", "1"), ("None", "-1.00", "1")
    }
    assert found(ask.spend_by_month(contract)) == {
        ("2004-01-01", "10.30", "2"), ("2004-02-01", "5.00", "1"),
        ("2005-02-01", "-1.00", "1"), ("None", "None", "1"),
    }
    assert found(ask.spend_by_vehicle(contract)) == {("None", "9.10", "3"), ("v", "5.20", "2")}


def test_locations_keep_awards_without_vendor(contract, vendor):
    assert found(ask.spend_by_location(contract, vendor, more_keys=["year"])) == {
        ("US", "10.30", "2"), ("CA", "None", "1"), ("None", "4.00", "2")
    }


def test_join_keeps_awards_without_vendor(contract, vendor):
    joined = ask.join_contract_vendor(contract, vendor, "year")
    assert sorted(str(r.countryCode) for r in joined.collect()) == ["CA", "None", "None", "US", "US"]


def test_top_and_latest(contract, vendor):
    assert found(ask.top_vendors(contract, 1)) == {("1", "10.30", "3")}
    assert {(r.DUNSNumber, r.countryCode) for r in ask.latest_vendors(vendor).collect()} == {
        ("1", "CA"), ("3", "FR")
    }


def test_history(spark, contract):
    rows = {(r.PIID, r.agencyID, r.referencedID): (r.awards, str(r.spend)) for r in ask.award_mod_totals(contract).collect()}
    plain = {}
    for r in contract.collect():
        n, total = plain.get((r.PIID, r.agencyID, r.referencedID), (0, 0))
        plain[r.PIID, r.agencyID, r.referencedID] = (n + 1, total + (r.obligatedAmount or 0))
    assert rows == {key: (n, str(total)) for key, (n, total) in plain.items()}
    assert len(rows) > len({key[:2] for key in rows})  # one order number under two vehicles


def test_union_of_drifting_years(spark):
    one = spark.createDataFrame([(1, 2.5)], "id long, amount double")
    two = spark.createDataFrame([("07", "x")], "id string, more string")
    both = ask.union_years([one, two], {"amount": "decimal(18,2)"})
    assert {tuple(r) for r in both.collect()} == {("1", Decimal("2.50"), None), ("07", None, "x")}
    with pytest.raises(ValueError):
        ask.union_years([])


def test_sums_combine_before_the_shuffle(contract):
    plan = ask.spend_by_agency(contract)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_sum")
    assert "HashAggregate" in plan and "SortAggregate" not in plan
