"""From nested awards to the contract and the vendor table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from contractlake.functions.keys import AWARD_ID, DUNS, blank_to_null
from contractlake.operators.dedupe import dedupe_vendors
from contractlake.operators.flatten import (
    as_before,
    as_path,
    flatten,
    leaf_paths,
    local_name,
    named,
)
from contractlake.operators.rejects import apply_types
from contractlake.sources.awards import CORRUPT

# Subtrees that make up the vendor table and the award identifier.
VENDOR = "ns1:vendor"
AWARD = "ns1:awardID"

# Types of the columns every award has; all others stay text.
TYPES = {"signedDate": "timestamp_ntz", "obligatedAmount": "decimal(18,2)"}


def contract_projection(
    awards: DataFrame,
    rename: Mapping[str, str] | None = None,
    arrays: str = "join",
    keep_id_parts: bool = True,
) -> DataFrame:
    """Flat contract columns of awards that have their keys (see ``award_key``).

    All leaves but those of the vendor and the award identifier, then PIID, agency and
    modification number (without which no question about agencies could be asked), and last
    the vendor's DUNS number, on which the two tables join.
    """
    parts = ("ns1:PIID", "ns1:agencyID", "ns1:modNumber") if keep_id_parts else ()
    flat = flatten(
        awards,
        exclude=[VENDOR, AWARD, CORRUPT],
        carry=[*[as_path(AWARD_ID) + (part,) for part in parts], DUNS],
        rename=rename,
        arrays=arrays,
    )
    duns = (rename or {}).get(DUNS, local_name(DUNS))
    return flat.withColumn(duns, as_before(blank_to_null(named(duns)), flat.schema[duns]))


def vendor_projection(
    awards: DataFrame,
    rename: Mapping[str, str] | None = None,
    arrays: str = "join",
    also: Sequence[str] = ("signedDate",),
) -> DataFrame:
    """Flat vendor columns, one row per award; ``also`` names other output columns to carry along."""
    leaves = leaf_paths(awards.schema)
    carried = [
        p
        for p in leaves
        if (rename or {}).get(".".join(p), local_name(p)) in also and p[0] != VENDOR
    ]
    return flatten(awards, include=[VENDOR], carry=carried, rename=rename, arrays=arrays)


def vendor_table(
    awards: DataFrame,
    rename: Mapping[str, str] | None = None,
    types: Mapping[str, str] = TYPES,
    date: str = "signedDate",
    key: str = "DUNSNumber",
    per: Sequence[str] = (),
) -> DataFrame:
    """One row per vendor (and per value of the ``per`` columns): that of the latest award."""
    flat = vendor_projection(awards, rename, also=(date, *per))
    return dedupe_vendors(apply_types(flat, types), [key, *per], latest_by=(date,))
