"""Award and vehicle keys, built from nested identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contractlake.operators.flatten import Path, as_path, column_or_null

# Element paths of an award record.
AWARD_ID = "ns1:awardID.ns1:awardContractID"
VEHICLE_ID = "ns1:awardID.ns1:referencedIDVID"
DUNS = "ns1:vendor.ns1:vendorSiteDetails.ns1:vendorDUNSInformation.ns1:DUNSNumber"
AWARD_PARTS = ("ns1:PIID", "ns1:agencyID", "ns1:modNumber", "ns1:transactionNumber")
VEHICLE_PARTS = ("ns1:PIID", "ns1:agencyID", "ns1:modNumber")


def blank_to_null(value: Column) -> Column:
    """Null for text that is empty or only blanks; any other text as it is."""
    return F.when(F.trim(value) != "", value)


def joined_key(parts: list[Column], sep: str = "_") -> Column:
    """Parts joined by ``sep``; null as soon as one part is null or blank."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(sep)] if pieces else []
        pieces.append(blank_to_null(part))
    return F.concat(*pieces)


def award_key(
    awards: DataFrame,
    award_id: str | Path = AWARD_ID,
    vehicle_id: str | Path = VEHICLE_ID,
) -> DataFrame:
    """Add ``ns1:unique_award_id`` and ``ns1:referencedID``; absent elements give a null key."""

    def parts(parent: str | Path, names: tuple[str, ...]) -> list[Column]:
        return [column_or_null(awards.schema, as_path(parent) + (name,)) for name in names]

    return awards.withColumns(
        {
            "ns1:unique_award_id": joined_key(parts(award_id, AWARD_PARTS)),
            "ns1:referencedID": joined_key(parts(vehicle_id, VEHICLE_PARTS)),
        }
    )
