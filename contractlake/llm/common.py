"""What several operators share: words, staged tables, running totals."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Hashable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from contractlake.session import drop_path, scratch_dir

# Fixed value: a word is a run of characters other than blank, tab, line and page breaks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text, none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def staged(df: DataFrame, purpose: str, made: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors. Ids made while writing are fixed
    from then on. The folder's name is added to ``made``, for ``drop_staged`` once nothing reads
    it any more; else it stays as long as the result may be read, which this library can't know:
    it lies below ``spark.checkpoint.dir`` and goes with it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, made: list[str]) -> None:
    """Delete staged tables of which all that is needed has been written elsewhere."""
    for path in made:
        drop_path(spark, path)
    made.clear()


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a whole row, nulls told apart from what stands beside them."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    parts = [*columns, *[column.isNull() for column in columns]]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def give_back() -> None:
    """Hand freed memory to the system: a Python worker lives on between tasks, idle or not."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def per_process(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a process: a Python worker runs many tasks.

    Functions reach a worker by value, each task with globals of its own, and the worker need not
    have this package; so the values are kept in a module of their own that no file stands for.
    """
    name = "contractlake-made"
    made = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("made", {})
    if key not in made:
        made[key] = make()
    return made[key]


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` for a function that yields columns by name as lists or numpy arrays."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [
                value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
                for field, value in ((field, columns[field.name]) for field in arrow)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        give_back()

    return df.mapInArrow(run, schema)


def key_digest(key: Column) -> Column:
    """32 hex digits of a key of any type, a null key as the text ``null``."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))


def prefix_digits(rows: int) -> int:
    """So many hex digits of a digest that there are as many prefixes as rows with one prefix, at
    least: both the table of prefixes and the rows of one grow with the root of the rows."""
    return next(d for d in range(1, 33) if rows <= 16 ** (2 * d))


# Equal rows that one task makes out of their number at once.
COPIES = 1 << 16


def in_chunks(counted: DataFrame, rows: str) -> DataFrame:
    """Rows that stand for ``rows`` equal ones, as several where these are more than ``COPIES``.

    ``_part`` numbers them; ``rows`` becomes the number that each stands for.
    """
    most = COPIES
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({rows} - 1) div {most}")))
    left = F.col(rows) - F.col("_part") * F.lit(most)
    return counted.withColumn("_part", parts).withColumn(rows, F.least(F.lit(most).cast("long"), left))


def every_copy(chunks: DataFrame, keys: Sequence[str], first: Column, rows: str, name: str) -> DataFrame:
    """One row for each that a row of :func:`in_chunks` stands for, numbered on from ``first`` as ``name``.

    The chunks of a key are dealt to all tasks before they grow.
    """
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(parts, F.xxhash64(*[F.col(f"`{key}`") for key in keys], F.col("_part")))
    return dealt.withColumn(name, F.explode(F.sequence(first, first + F.col(rows) - 1))).drop("_part")


def no_such_columns(df: DataFrame, *names: str) -> None:
    """Raise where a table has columns that an operator makes itself."""
    taken = [c for c in df.columns if c in names or c.startswith("_")]
    if taken:
        raise ValueError(f"rename the columns {taken}: the result has its own of these names")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    value: str,
    name: str,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that come before.

    Rows come in the order of ``bucket``, then ``order``. A group of any size is dealt out by
    bucket: the bucket sums give where each bucket starts, a window inside the bucket the rest.
    ``group`` columns must not be null; ``df`` is read twice and must not change meanwhile.
    """
    keys = [*group, "_bucket"]
    df = df.withColumn("_bucket", bucket)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, keys)
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_bucket", "_start")
    )
