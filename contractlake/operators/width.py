"""Byte widths of text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from contractlake.functions.text import truncate_utf8

# Columns of a table that say which landed file, and which version of it, a row came from.
LINEAGE = ("_source", "_batch")

# Fixed value: width of a text column of a warehouse table that declares none. Parquet needs no
# widths: nothing is cut unless a width is given.
DEFAULT_WIDTH = 256


def column_widths(
    df: DataFrame, widths: Mapping[str, int], default: int | None = None
) -> dict[str, int]:
    """Width per text column of ``df``; widths for columns that do not exist are ignored, and
    columns that say where a row came from have none."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in LINEAGE]
    found = {name: widths.get(name, default) for name in text}
    return {name: width for name, width in found.items() if width is not None}


def truncate_bytes(
    df: DataFrame, widths: Mapping[str, int], default: int | None = None
) -> DataFrame:
    """Cut text columns to their width in bytes, at a character boundary."""
    cut = column_widths(df, widths, default)
    return df.withColumns({n: truncate_utf8(n, w) for n, w in cut.items()}) if cut else df


def apply_widths(
    df: DataFrame,
    widths: Mapping[str, int],
    default: int | None = None,
    truncate: bool = True,
) -> DataFrame:
    """Cut text columns to their width and note it as ``maxlength`` in the column metadata.

    Metadata survives a filter and a Parquet round trip but no expression: apply it last.
    """
    found = column_widths(df, widths, default)
    columns = []
    for field in df.schema.fields:
        value, width = F.col(f"`{field.name}`"), found.get(field.name)
        if width is not None:
            value = truncate_utf8(field.name, width) if truncate else value
            value = value.alias(field.name, metadata={**field.metadata, "maxlength": width})
        columns.append(value)
    return df.select(*columns)


def wider_counts(df: DataFrame, widths: Mapping[str, int], default: int | None = None) -> list[Column]:
    """Per text column with a width the number of wider values, as aggregates: to be observed while
    the rows are written, or asked for by themselves."""
    found = column_widths(df, widths, default)
    return [F.count_if(F.octet_length(F.col(f"`{n}`")) > w).alias(n) for n, w in found.items()]


def cut_counts(df: DataFrame, widths: Mapping[str, int], default: int | None = None) -> dict[str, int]:
    """How many values of each text column are wider than their width; columns without any left out."""
    wider = wider_counts(df, widths, default)
    return {name: n for name, n in df.agg(*wider).first().asDict().items() if n} if wider else {}
