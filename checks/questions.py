"""The ad hoc questions on the stored contract and vendor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.registry import check, with_award
from checks import fixtures
from contractlake.plans import questions

SPEND = "sum(amount)::double AS spend, count(*) AS awards"


@check(
    with_award(
        """SELECT piid AS "PIID", year, amount::double AS "obligatedAmount",
          CASE WHEN year > 1997 THEN product END AS "productOrServiceCode" FROM award"""
    )
)
def union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year tables that drifted: early years have numeric numbers and no product column."""
    contract = fixtures.contract(spark, sf_dir)
    frames = []
    for (year,) in contract.select("year").distinct().collect():
        one = contract.where(F.col("year") == year)
        if year <= 1997:
            frames.append(one.select(F.col("PIID").cast("long"), "year", "obligatedAmount"))
        else:
            frames.append(one.select("PIID", "year", "obligatedAmount", "productOrServiceCode"))
    return questions.union_years(frames, {"obligatedAmount": "decimal(18,2)"})


@check(with_award(f'SELECT agency AS "agencyID", {SPEND} FROM award GROUP BY 1'))
def spend_by_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.spend_by_agency(fixtures.contract(spark, sf_dir))


@check(with_award(f'SELECT product AS "productOrServiceCode", {SPEND} FROM award GROUP BY 1'))
def spend_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.spend_by_product(fixtures.contract(spark, sf_dir))


@check(with_award(f"SELECT strftime(signed_at, '%Y-%m-01') AS month, {SPEND} FROM award GROUP BY 1"))
def spend_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.spend_by_month(fixtures.contract(spark, sf_dir))


@check(with_award(f'SELECT country AS "countryCode", {SPEND} FROM award GROUP BY 1'))
def spend_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, vendor = (f(spark, sf_dir) for f in (fixtures.contract, fixtures.vendor))
    return questions.spend_by_location(contract, vendor, more_keys=("year",))


@check(
    with_award(
        f'SELECT duns AS "DUNSNumber", {SPEND} FROM award GROUP BY 1 ORDER BY spend DESC, 1 LIMIT 10'
    )
)
def top_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.top_vendors(fixtures.contract(spark, sf_dir))


@check(with_award(f'SELECT vehicle AS "referencedID", {SPEND} FROM award GROUP BY 1'))
def spend_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.spend_by_vehicle(fixtures.contract(spark, sf_dir))


@check(
    """SELECT l_orderkey::varchar AS "PIID", lpad((l_orderkey % 25)::varchar, 4, '0') AS "agencyID",
      'V' || (l_linenumber % 2) AS "referencedID",
      sum(l_extendedprice::decimal(18,2))::double AS spend, count(*) AS awards,
      strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_signed,
      strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_signed
    FROM lineitem GROUP BY l_orderkey, l_linenumber % 2"""
)
def award_mod_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items stand for the modifications of orders whose numbers two vehicles share."""
    mods = fixtures.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("PIID"),
        F.lpad((F.col("l_orderkey") % 25).cast("string"), 4, "0").alias("agencyID"),
        F.concat(F.lit("V"), (F.col("l_linenumber") % 2).cast("string")).alias("referencedID"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("obligatedAmount"),
        F.col("l_shipdate").alias("signedDate"),
    )
    return questions.award_mod_totals(mods)


BLANK_LOCATION = f"""SELECT CASE WHEN product <> 'P' THEN country END AS "countryCode", {SPEND}
  FROM award GROUP BY 1"""


@check(with_award(BLANK_LOCATION))
def spend_by_location_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards of one status name no vendor: their spend stands under no location."""
    contract, vendor = fixtures.blank_vendor_tables(spark, sf_dir)
    return questions.spend_by_location(contract, vendor, more_keys=("year",))
