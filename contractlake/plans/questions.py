"""Who bought what, from which agency, for how much, when and where.

Every question that sums first adds up inside each map task, so no key, however frequent,
sends more than one row per task over the network.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contractlake.operators.dedupe import dedupe_vendors
from contractlake.operators.flatten import named
from contractlake.operators.skew import spread_join

KEY = "DUNSNumber"
AMOUNT = "obligatedAmount"


def _spend(amount: str = AMOUNT) -> list[Column]:
    return [F.sum(amount).alias("spend"), F.count(F.lit(1)).alias("awards")]


def union_years(frames: Sequence[DataFrame], types: Mapping[str, str] | None = None) -> DataFrame:
    """All years as one table.

    Columns a year does not have are null there. A column whose type differs between years is
    read as text, unless ``types`` declares one.
    """
    seen: dict[str, set[str]] = {}
    for frame in frames:
        for name, dtype in frame.dtypes:
            seen.setdefault(name, set()).add(dtype)
    declared = dict(types or {})
    target = {n: declared.get(n, "string") for n, found in seen.items() if len(found) > 1}
    target |= {n: t for n, t in declared.items() if n in seen}
    result: DataFrame | None = None
    for frame in frames:
        casts = {n: named(n).cast(t) for n, t in target.items() if n in frame.columns}
        frame = frame.withColumns(casts) if casts else frame
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    if result is None:
        raise ValueError("no year given")
    return result


def latest_vendors(vendors: DataFrame, year: str = "year") -> DataFrame:
    """One row per vendor over all years, the latest year's."""
    return dedupe_vendors(vendors, KEY, latest_by=(year,), keep_order_columns=True)


def join_contract_vendor(contract: DataFrame, vendor: DataFrame, *more_keys: str) -> DataFrame:
    """Contracts with their vendor; contracts without one stay. Safe for very frequent vendors."""
    return spread_join(contract, vendor, KEY, more_keys)


def spend_by(contract: DataFrame, *columns: str | Column) -> DataFrame:
    """Spend and number of awards per value of the columns."""
    return contract.groupBy(*columns).agg(*_spend())


def spend_by_agency(contract: DataFrame) -> DataFrame:
    return spend_by(contract, "agencyID")


def spend_by_product(contract: DataFrame, column: str = "productOrServiceCode") -> DataFrame:
    return spend_by(contract, column)


def spend_by_month(contract: DataFrame, date: str = "signedDate") -> DataFrame:
    """Per calendar month, given by its first day."""
    return spend_by(contract, F.trunc(F.col(date).cast("date"), "month").alias("month"))


def spend_by_vehicle(contract: DataFrame) -> DataFrame:
    """Per vehicle the awards were ordered under; null stands for stand-alone awards."""
    return spend_by(contract, "referencedID")


def spend_by_location(
    contract: DataFrame, vendor: DataFrame, location: str = "countryCode", more_keys: Sequence[str] = ()
) -> DataFrame:
    """Per vendor location; awards without a known vendor under null.

    Contracts are added up per vendor before the join, so the join sees each vendor once.
    """
    keys = [KEY, *more_keys]
    per_vendor = spend_by(contract, *keys)
    joined = per_vendor.join(vendor.select(*keys, location), keys, "left")
    return joined.groupBy(location).agg(
        F.sum("spend").alias("spend"), F.sum("awards").alias("awards")
    )


def top_vendors(contract: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` vendors with the highest spend, ties by key; awards without a vendor left out."""
    known = contract.where(F.col(KEY).isNotNull())
    return spend_by(known, KEY).orderBy(F.desc_nulls_last("spend"), KEY).limit(k)


def award_mod_totals(contract: DataFrame) -> DataFrame:
    """Per contract: awards and modifications, total, first and last change.

    Order numbers repeat from vehicle to vehicle, so the vehicle is part of the key.
    """
    totals = contract.groupBy("PIID", "agencyID", "referencedID").agg(
        *_spend(),
        F.min("signedDate").alias("first_signed"),
        F.max("signedDate").alias("last_signed"),
    )
    return totals
