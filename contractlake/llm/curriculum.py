"""Mixing sources to target weights: a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contractlake.llm.common import every_copy, in_chunks, key_digest, prefix_digits, running_total, staged

# How many times the whole of a source the mix takes at most.
MAX_EPOCHS = 3


def source_targets(
    sizes: DataFrame, weights: Sequence[int], max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source``, ``source_rank``, ``source_size``, ``weight``, ``target`` from ``source``, ``size``.

    Sources are taken by code point, null last, and get the weights in turn. The targets share
    the sum of all sizes by weight; no target is above ``max_epochs`` times its source's size and
    what a full source leaves goes to the others by weight. Sources fill in the order of
    size / weight, so the full ones are a prefix of that order and the shares follow from running
    sums. The table that the windows see has one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = by_source.withColumn("source_rank", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.get(cycle, F.col("source_rank") % len(weights)).cast("long")
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "source_rank")
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    done = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = max_epochs * F.col("source_size")
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(done), F.lit(0))
    shares = ranked.withColumn("_left", left).withColumn("_weights", F.sum("weight").over(rest))
    # Full while its cap is below its share of what is left when its turn comes.
    open_ = F.col("_left") * F.col("weight") <= cap * F.col("_weights")
    turn = shares.withColumn("_open", open_).withColumn("_turn", F.row_number().over(fill))
    start = F.min(F.when(F.col("_open"), F.struct("_turn", "_left", "_weights"))).over(every)
    share = start["_left"] * F.col("weight") / start["_weights"]
    is_full = start.isNull() | (F.col("_turn") < start["_turn"])
    return turn.select(
        "source", "source_rank", "source_size", "weight",
        F.when(is_full, cap.cast("double")).otherwise(share).alias("target"),
    )


def schedule_position(done: Column, start: Column, end: Column) -> Column:
    """When a source has given the part ``done`` (0 to 1) of its demand, as a time from 0 to 1.

    Its rate goes from ``start`` to ``end`` in a straight line. The integral of the rate,
    ``start * t + (end - start) * t**2 / 2``, over its value at 1 is ``done``; this solves for t.
    """
    slope = end - start
    demand = done * (start + end) / 2
    return F.least(2 * demand / (start + F.sqrt(start * start + 2 * slope * demand)), F.lit(1.0))


def mix_sources(
    documents: DataFrame,
    weights: Sequence[int],
    schedule: Sequence[tuple[float, float]] = ((1.0, 3.0), (2.0, 2.0), (3.0, 1.0)),
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Where each document is read in training, from columns ``key``, ``source``, ``size``.

    Returns these with ``source_size``, ``target`` and ``placements``, an array of (``position`` 0 to 1, ``words``) with one entry per time the document is read.
    ``schedule`` has, in turn per source, the rate of the source at the begin and at the end of
    training. A source's documents stand in the order of a hash of their key and are read in
    that order again and again until the source's target is met; the last one read is cut, so a
    source gives its target to the word. The words a source has given so far, through the
    inverse of the integral of its rate, are the training position.

    Equal rows are counted first and share their placements' law: each copy stands on its own in
    the order. Null sources form one source, documents of size 0 are never read, null sizes count
    as 0; a table without words has targets of 0. The result is the same in every run.
    """
    columns = ["key", "source", "size"]
    flat = documents.select("key", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    if min(min(pair) for pair in schedule) <= 0:
        raise ValueError("rates must be above 0")
    counted = flat.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    equal = staged(in_chunks(counted, "_rows").withColumn("_hash", key_digest(F.col("key"))), "mix")
    targets = source_targets(
        equal.select("source", (F.col("size") * F.col("_rows")).alias("size")), weights, max_epochs
    )
    # null-safe: the source itself is the join key, and one source may be null
    known = equal.withColumn("_source", F.struct("source")).join(
        targets.withColumn("_source", F.struct("source")).drop("source"), "_source"
    )
    known = known.withColumn("_words", F.col("size") * F.col("_rows"))
    bucket = F.substring("_hash", 1, prefix_digits(equal.count()))
    total = running_total(
        known, ["source_rank"], bucket, ["_hash", "key", "size", "_part"], "_words", "_before"
    )
    copies = every_copy(total, columns, F.lit(0).cast("long"), "_rows", "_copy")
    rows = copies.withColumn("_before", F.col("_before") + F.col("_copy") * F.col("size"))
    demand = F.floor(F.col("target") + 0.5).cast("long")
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(max_epochs)),
        lambda epoch: F.col("_before") + epoch * F.col("source_size"),
    )
    rates = [
        F.get(F.array(*[F.lit(float(pair[i])) for pair in schedule]), F.col("source_rank") % len(schedule))
        for i in (0, 1)
    ]
    read = F.filter(starts, lambda begin: (begin < demand) & (F.col("size") > 0))
    placements = F.transform(
        read,
        lambda begin: F.struct(
            schedule_position(begin / demand, *rates).alias("position"),
            F.least(F.col("size"), demand - begin).alias("words"),
        ),
    )
    return rows.select(*columns, "source_size", "target", placements.alias("placements"))


def in_training_order(placed: DataFrame, *keys: str) -> DataFrame:
    """Rows with a ``position``, range-sorted by it, then ``keys``: files in sequence hold the order."""
    return placed.repartitionByRange("position", *keys).sortWithinPartitions("position", *keys)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per placement, sorted by position: files in sequence hold the training order.

    ``mixed`` comes from :func:`mix_sources`; documents that are not read give no row, null keys
    and equal rows stay rows, and an empty table gives an empty one.
    """
    one = mixed.select("*", F.inline("placements")).drop("placements")
    return in_training_order(one, "key")
