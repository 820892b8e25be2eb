"""Joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


# Fixed value: keys the sketch function can keep track of at most.
MAX_TRACKED = 1_000_000


def default_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys with more than one part's fair share of the rows, and over how many parts to spread them.

    A frequent-items sketch finds them in one pass over the key column: each task sends a sketch
    of fixed size, not its keys. At most ``parts`` keys come out, which bounds this frame (and
    its broadcast) whatever the data. The counts are estimates, which is enough: they decide
    how rows are spread, never what a join returns.
    """
    tracked = min(8 * max(parts, 16), MAX_TRACKED)
    sketch = F.expr(f"approx_top_k(`{key}`, {min(parts, tracked)}, {tracked})")
    found = df.where(F.col(key).isNotNull()).agg(sketch.alias("_top"), F.count(key).alias("_total"))
    share = F.col("count") * parts / F.col("_total")
    return (
        found.select("_total", F.inline("_top"))
        .where(share > 1)
        .select(F.col("item").alias(key), F.least(F.ceil(share), F.lit(parts)).cast("int").alias("_salts"))
    )


def _salt(columns: Sequence[str], salts: Column) -> Column:
    # Content and partition, not a random number: a re-run task gives every row the same salt.
    row = F.xxhash64(*[F.col(f"`{name}`") for name in columns], F.spark_partition_id())
    return F.when(salts == 1, F.lit(0)).otherwise(F.pmod(row, salts).cast("int"))


def salt_left(left: DataFrame, hot: DataFrame, key: str, parts: int) -> DataFrame:
    """Add ``salt``: 0 for ordinary keys, spread for hot keys and for the null key."""
    columns = left.columns
    salts = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = left.join(F.broadcast(hot), key, "left")
    return spread.select(*[F.col(f"`{c}`") for c in columns], _salt(columns, salts).alias("salt"))


def salt_right(right: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat the rows of hot keys once per salt."""
    columns = [F.col(f"`{c}`") for c in right.columns]
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return right.join(F.broadcast(hot), key, "left").select(*columns, F.explode(every).alias("salt"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    more_keys: Sequence[str] = (),
    how: str = "left",
    parts: int | None = None,
) -> DataFrame:
    """Left or inner equi-join in which no reducer gets more than its share of one key.

    Rows of ``left`` with a hot key are spread over several parts and the matching rows of
    ``right`` are repeated for those parts; the result equals the plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be spread")
    if how == "inner":
        left = left.where(F.col(key).isNotNull())
    parts = parts or default_parts(left)
    hot = hot_keys(left, key, parts)
    joined = salt_left(left, hot, key, parts).join(
        salt_right(right, hot, key), [key, *more_keys, "salt"], how
    )
    return joined.drop("salt")
