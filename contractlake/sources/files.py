"""File listings and where their files will land."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contractlake.functions.text import base_name
from contractlake.operators.skew import spread_join

# Fixed value: files above this many bytes take the large-file way.
MAX_SIZE = 1 << 30
# Names of compressed files, and in how many shares many of them are read.
COMPRESSED = (".snappy", ".gz", ".bz2", ".zst", ".lz4", ".deflate")
SHARES = 4


def literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_shares(spark: SparkSession, path: str | list[str]) -> list[str | list[str]]:
    """The files of ``path`` in lists to be read side by side; ``path`` alone where they are few.

    Spark deals files to tasks by their bytes, which for compressed files are a small part of their
    text: some cores get twice as much as others, or nothing. Every share is dealt by itself, so
    tasks are smaller. A list of compressed files is not listed again.
    """
    if isinstance(path, str):
        listed = spark.read.text(path)
        if listed.columns != ["value"]:  # folders that give columns are read as they are
            return [path]
        names = [literal(unquote(name)) for name in sorted(listed.inputFiles())]
    else:
        names = path
    few = len(names) < 2 * SHARES * spark.sparkContext.defaultParallelism
    if few or not all(name.endswith(COMPRESSED) for name in names):
        return [path]
    return [names[share::SHARES] for share in range(SHARES)]


def file_manifest(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of all files below a folder; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", "length", "modificationTime")


def size_class(length: Column, max_size: int = MAX_SIZE) -> Column:
    """``large`` strictly above the limit, else ``small``."""
    return F.when(length > max_size, "large").otherwise("small")


def landing_keys(files: DataFrame, prefix: str, path_col: str = "path") -> DataFrame:
    """Add the flat ``landing_key`` and ``same_key``, the number of files that would share it.

    A base name shared by a third of all files (an index page) is counted on the map side and
    joined back in spread parts.
    """
    prefix = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    keyed = files.withColumn("landing_key", F.concat(F.lit(prefix), base_name(F.col(path_col))))
    counts = keyed.groupBy("landing_key").agg(F.count(F.lit(1)).alias("same_key"))
    joined = spread_join(keyed, counts.where("same_key > 1"), "landing_key")
    return joined.withColumn("same_key", F.coalesce("same_key", F.lit(1)))
