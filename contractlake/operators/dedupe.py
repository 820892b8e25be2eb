"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from contractlake.functions.keys import blank_to_null
from contractlake.operators.flatten import as_before, column, named


def dedupe_vendors(
    df: DataFrame,
    key: str | Sequence[str] = "DUNSNumber",
    latest_by: Sequence[str] = ("signedDate",),
    keep_order_columns: bool = False,
    mode: str = "latest",
) -> DataFrame:
    """One row per key; rows whose key is null or blank are left out before anything is shuffled.

    ``latest`` takes the greatest row by ``latest_by`` and then by all other columns (nulls
    lowest), so the survivor does not depend on how the input is partitioned. The greatest row
    is an aggregate: each map task sends one row per key, so a key with a third of all rows
    costs no more than any other. ``any`` takes whichever row comes first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    for name in keys:
        value = named(name)
        if dict(df.dtypes)[name] == "string":
            value = blank_to_null(value)
            df = df.withColumn(name, as_before(value, df.schema[name]))
        df = df.where(named(name).isNotNull())
    order = [name for name in latest_by if name in df.columns and name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in order]
    shown = [n for n in df.columns if keep_order_columns or n not in order]
    if mode == "any":
        return df.dropDuplicates(keys).select(*map(named, shown))
    if mode != "latest":
        raise ValueError(f"unknown mode {mode!r}")
    if not order + rest:
        return df.select(*map(named, keys)).distinct()
    row = F.struct(*map(named, order + rest))
    best = df.groupBy(*map(named, keys)).agg(F.max(row).alias("_row"))
    return best.select(
        *[
            as_before(named(n) if n in keys else column(("_row", n)), df.schema[n])
            for n in shown
        ]
    )
