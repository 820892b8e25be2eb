"""The register and what all queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The award, contract and vendor tables as SQL over the driver tables.
AWARD = """
award AS (
  SELECT o_orderkey::varchar AS piid,
         lpad((o_orderkey % 25)::varchar, 4, '0') AS agency,
         o_orderkey::varchar || '_' || lpad((o_orderkey % 25)::varchar, 4, '0') || '_0_00' AS award_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'IDV_9700_0' END AS vehicle,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS signed,
         o_orderdate AS signed_at,
         year(o_orderdate)::bigint AS year,
         o_totalprice::decimal(18,2) AS amount,
         o_orderstatus AS product,
         replace(o_orderpriority, '-', ',') AS tag,
         o_orderpriority AS alt_name,
         c_name AS name,
         c_nationkey::varchar AS country,
         lpad(o_custkey::varchar, 9, '0') AS duns
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

VENDOR = """
vendor AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY duns, year ORDER BY signed_at DESC, alt_name DESC, name DESC, country DESC) AS rank
    FROM award) WHERE rank = 1
)"""

CONTRACT_COLUMNS = """piid AS "PIID", agency AS "agencyID", '0' AS "modNumber", duns AS "DUNSNumber",
  award_id AS "unique_award_id", vehicle AS "referencedID", signed AS "signedDate",
  amount::double AS "obligatedAmount", product AS "productOrServiceCode", tag, year"""

VENDOR_COLUMNS = """duns AS "DUNSNumber", name AS "vendorName", alt_name AS "vendorAlternateName",
  country AS "countryCode", year"""


def with_award(select: str) -> str:
    return f"WITH {AWARD} {select}"


def with_vendor(select: str) -> str:
    return f"WITH {AWARD}, {VENDOR} {select}"


def portable(df: DataFrame) -> DataFrame:
    """Types both engines return alike: decimals as doubles, times as text, whole numbers long."""

    def plain(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.DateType, T.ArrayType)):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            value = value.cast("long")
        return value.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def check(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name (or ``name``), with its SQL where SQL can say it."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = lambda spark, sf_dir: portable(query(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = sql
        return query

    return register
