"""Tolerant load: good rows, rejected rows with reasons, and a limit on the latter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from contractlake.operators.flatten import as_before, named

# Fixed value: a load fails when this many rows are rejected.
MAX_ERRORS = 50


class LoadError(RuntimeError):
    """Too many rejected rows, or a load that was left half done."""


def cast_rules(types: Mapping[str, str], columns: list[str]) -> dict[str, Column]:
    """One rule per typed column: the text is there but is no value of the type."""
    return {
        f"{name} is not {dtype}": named(name).isNotNull() & named(name).try_cast(dtype).isNull()
        for name, dtype in types.items()
        if name in columns
    }


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; use after :func:`cast_rules` took the impossible ones out."""
    casts = {
        n: as_before(named(n).try_cast(dtype), df.schema[n])
        for n, dtype in types.items()
        if n in df.columns
    }
    return df.withColumns(casts) if casts else df


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: a row is rejected when a rule is true; ``reasons`` lists those rules.

    A rule that is null for a row does not reject it, so every row is in exactly one result.
    """
    if not rules:
        return df, df.withColumn("reasons", F.array().cast("array<string>")).where(F.lit(False))
    broken = {reason: F.coalesce(rule, F.lit(False)) for reason, rule in rules.items()}
    any_broken = F.lit(False)
    for rule in broken.values():
        any_broken = any_broken | rule
    reasons = F.array_compact(
        F.array(*[F.when(rule, F.lit(reason)) for reason, rule in broken.items()])
    )
    return df.where(~any_broken), df.where(any_broken).withColumn("reasons", reasons)


def check_rejects(rejects: DataFrame, max_errors: int = MAX_ERRORS) -> int:
    """Number of rejects; raises when ``max_errors`` rows or more are rejected. Tasks send counts."""
    return check_count(rejects.count(), max_errors)


def check_count(found: int, max_errors: int = MAX_ERRORS) -> int:
    """The same for rejects that are counted already."""
    if found >= max_errors:
        raise LoadError(f"{found} rows were rejected, {max_errors} rows or more stop a load")
    return found
