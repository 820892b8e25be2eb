"""Sharding: rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contractlake.llm.common import (
    every_copy,
    in_chunks,
    key_digest,
    no_such_columns,
    prefix_digits,
    running_total,
    staged,
)

# Fixed values of the mix: a prime under 2**31, so that squares fit a long, and an odd step.
PRIME = 2147483647
STEP = 1234567891


def _lane(digest: Column, place: int) -> Column:
    return F.conv(F.substring(digest, place, 8), 16, 10).cast("long") % PRIME


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: the one with the lowest ``-ln(u) / weight``, ties to the lower number.

    ``u`` in (0, 1) comes from the key and the shard number alone, so a shard that is added
    takes records only into itself, and one that goes gives up only its own. The share of a
    shard is its weight's share. A null key counts as the text ``null``.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need weights above 0")
    digest = key_digest(key)
    one, two = _lane(digest, 1), _lane(digest, 9)
    given = F.array(*[F.lit(float(w)) for w in weights])
    first = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(len(weights) - 1).cast("long")), lambda s: (one + s * F.lit(STEP)) % PRIME)
    second = F.transform(first, lambda x: (x * x + two) % PRIME)
    last = F.transform(second, lambda x, s: (x * x + one + s) % PRIME)
    costs = F.transform(
        last, lambda x, s: F.struct((-F.log((x + F.lit(0.5)) / PRIME) / F.get(given, s.cast("int"))).alias("cost"), s.alias("shard"))
    )
    return F.array_min(costs).getField("shard").cast("int")


def assign_shards(
    df: DataFrame, key: str, weights: Sequence[float], name: str = "shard"
) -> DataFrame:
    """Add the shard of each record; a column of that name is replaced. Nothing is moved.

    A null key has the shard of the text ``null``; equal rows stay rows and share a shard; an empty
    table gives an empty one.
    """
    return df.withColumn(name, shard_of(F.col(f"`{key}`"), weights))


def shard_slots(records: DataFrame, key: str, shards: int) -> DataFrame:
    """Columns of ``records`` plus ``shard``, ``slot`` (gapless from 0 in each shard) and
    ``grown_shard`` (the shard if there were one more), for equal shards.

    Equal records are counted before they are moved and told apart by slot only, so a key that
    holds a third of all rows costs a row per 65,536 of them, and its rows come out of all tasks. Slots go by the digest of
    the key; its first digits are buckets, so that no shard is gathered in one task. Null keys share
    a shard; an empty table gives an empty one. Columns named ``shard``, ``slot``, ``grown_shard`` or with
    a leading underscore are an error.
    """
    no_such_columns(records, "shard", "slot", "grown_shard")
    columns = records.columns
    placed = records.withColumn("shard", shard_of(F.col(f"`{key}`"), [1.0] * shards)).withColumn(
        "grown_shard", shard_of(F.col(f"`{key}`"), [1.0] * (shards + 1))
    )
    placed = placed.groupBy(*[f"`{c}`" for c in columns], "shard", "grown_shard").agg(F.count(F.lit(1)).alias("_rows"))
    placed = staged(in_chunks(placed, "_rows"), "shards")
    digits = prefix_digits(placed.count())
    numbered = running_total(
        placed.withColumn("_digest", key_digest(F.col(f"`{key}`"))),
        ["shard"], F.substring("_digest", 1, digits), ["_digest", *[f"`{c}`" for c in columns], "_part"], "_rows", "_first",
    )
    slots = every_copy(numbered, columns, F.col("_first"), "_rows", "slot")
    return slots.select(*[F.col(f"`{c}`") for c in columns], "shard", "slot", "grown_shard")
