"""Contract and vendor tables: Parquet by year, bucketed tables, gzip CSV, data dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from contractlake.operators.skew import default_parts, hot_keys, salt_left, salt_right
from contractlake.operators.width import LINEAGE
from contractlake.session import listed, path_exists, scratch_dir, sub_folders
from contractlake.sinks.snapshots import BATCH, LOAD, SOURCE, latest_snapshot, published_years

# Where the file versions lie that were withdrawn from a year, and what a row says.
WITHDRAWN = "_withdrawn"
WITHDRAWN_FIELDS = f"{SOURCE} string, {BATCH} long"

KEY = "DUNSNumber"
DATE = "signedDate"
# Columns by which single rows are looked up, in tables that are not sorted by them.
LOOKUPS = ("unique_award_id", KEY)


def lookup_options(df: DataFrame, columns: Sequence[str] = LOOKUPS) -> dict[str, str]:
    """Writer options that give row groups a Bloom filter of these columns, as large as their values need."""
    found = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns if name in df.columns}
    return {**found, "parquet.bloom.filter.adaptive.enabled": "true"} if found else {}


def year_path(root: str, table: str, year: int | str) -> str:
    return f"{root.rstrip('/')}/{table}/year={year}"


def _write_years(df: DataFrame, root: str, table: str, year: int | str | None) -> str:
    if year is not None and "year" in map(str.lower, df.columns):
        raise ValueError("rename the column 'year': the folder gives the table a column of that name")
    if year is None:
        path = f"{root.rstrip('/')}/{table}"
        df.write.mode("error").options(**lookup_options(df)).partitionBy("year").parquet(path)
    else:
        path = year_path(root, table, year)
        df.write.mode("error").options(**lookup_options(df)).parquet(path)
    return path


def write_contract(
    df: DataFrame,
    root: str,
    year: int | str | None = None,
    layout: str = "sorted",
    date: str = DATE,
) -> str:
    """Write ``<root>/contract/year=YYYY``, fail if it exists, return the path.

    Without ``year`` the frame has a ``year`` column and all years are written, each gathered into
    files of the size that adaptive execution aims at, so their number follows the data and not
    tasks times years. Rows are sorted by date inside each file, so that row groups can be skipped.
    ``layout="ranged"`` shuffles into date ranges first, so that whole files can be skipped;
    a date with very many rows is divided by a hash of the rows.
    """
    return _write_years(contract_layout(df, layout, date, year is None), root, "contract", year)


def contract_layout(
    df: DataFrame, layout: str = "sorted", date: str = DATE, by_year: bool = False
) -> DataFrame:
    """Rows in the files and the order in which :func:`write_contract` writes them."""
    order = [name for name in ("year", date) if name in df.columns]
    if layout == "ranged":
        row = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns], F.spark_partition_id())
        ranged = df.withColumn("_tie", row).repartitionByRange(*order, "_tie")
        df = ranged.drop("_tie")
    elif layout != "sorted":
        raise ValueError(f"unknown layout {layout!r}")
    elif by_year:
        df = df.hint("rebalance", F.col("year"))
    return df.sortWithinPartitions(*order) if order else df


def write_vendor(
    df: DataFrame, root: str, year: int | str | None = None, key: str = KEY
) -> str:
    """Write ``<root>/vendor/year=YYYY``, fail if it exists, return the path; sorted by key.

    Without ``year`` all years are written, as in :func:`write_contract`.
    """
    order = ["year", key] if year is None else [key]
    df = df.hint("rebalance", F.col("year")) if year is None else df
    return _write_years(df.sortWithinPartitions(*order), root, "vendor", year)


def read_table(spark: SparkSession, root: str, table: str, lineage: bool = False) -> DataFrame:
    """All years of a table; columns that only some years have are null in the others.

    A year that jobs publish consists of the folders its newest snapshot names, without the rows
    withdrawn since; any other one of the files in its folder. The files of a folder were written
    together, so one footer per folder gives the whole schema;
    merging the footers of all files would read every file once before the query starts.
    Years that disagree about a type are for ``union_years``. With ``lineage`` rows of years that
    follow a landed table say which file and batch they come from.
    """
    root = root.rstrip("/")
    published = {year: latest_snapshot(spark, root, year) for year in published_years(spark, root)}
    parts = []
    plain = [folder for year, folder in plain_years(spark, root, table).items() if year not in published]
    if plain:
        parts.append(read_folders(spark, f"{root}/{table}", plain))
    loads = [f"{root}/{f}" for s in published.values() for f in s.tables.get(table, ())]
    if loads:
        withdrawn = [f"{root}/{f}" for s in published.values() for f in s.withdrawn]
        rows = without_withdrawn(spark, root, read_folders(spark, f"{root}/{table}", loads).drop(LOAD), withdrawn)
        parts.append(rows if lineage else rows.drop(*LINEAGE))
    if not parts:
        raise ValueError(f"no year of {root} has a table {table!r}")
    if len({part.schema["year"].dataType for part in parts}) > 1:
        parts = [part.withColumn("year", F.col("year").cast("string")) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def plain_years(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """Folders by year that were written directly, not by jobs, which put theirs into load folders."""
    path = f"{root.rstrip('/')}/{table}"
    folders = [y for y in sub_folders(spark, path) if "/year=" in y] if path_exists(spark, path) else []
    return {
        y.rsplit("/year=", 1)[1]: y
        for y in folders
        if any(not name.startswith(f"{LOAD}=") for name, _ in listed(spark, y))
    }


def read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Folders below ``path``, whose names give columns, as one scan."""
    fields: dict[str, T.StructField] = {}
    for folder in folders:
        for field in spark.read.parquet(folder).schema.fields:
            known = fields.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise ValueError(f"{field.name!r} changes its type in {folder}: use union_years")
    reader = spark.read.schema(T.StructType(list(fields.values()))).option("basePath", path)
    return reader.parquet(*folders)


def without_withdrawn(spark: SparkSession, root: str, rows: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Rows with a ``year`` whose file version is not withdrawn by any of the folders."""
    if not folders or not {*LINEAGE} <= {*rows.columns}:
        return rows
    place = f"{root.rstrip('/')}/{WITHDRAWN}"
    gone = spark.read.schema(WITHDRAWN_FIELDS).option("basePath", place).parquet(*folders)
    gone = gone.select(F.col("year").cast("string").alias("_year"), *LINEAGE).distinct()
    marked = rows.withColumn("_year", F.col("year").cast("string"))
    return marked.join(gone, ["_year", *LINEAGE], "left_anti").drop("_year")


def write_bucketed(
    contract: DataFrame,
    vendor: DataFrame,
    root: str,
    names: tuple[str, str] = ("contract_bucketed", "vendor_bucketed"),
    buckets: int | None = None,
    more_keys: Sequence[str] = (),
) -> tuple[str, str]:
    """Save both tables in the catalog, bucketed by their join keys and ``salt``.

    Tables bucketed by exactly the join keys join in place. A vendor with more than a bucket's
    share of the contracts has them spread over several salts and its own row repeated for
    each; without that one bucket could hold a third of the table. Both sides are shuffled into
    exactly the buckets first: one file per bucket.
    """
    buckets = buckets or default_parts(contract)
    by = (KEY, *more_keys, "salt")
    # Written once: both sides must spread the same keys in the same way.
    hot_path = scratch_dir(contract.sparkSession, "hot")
    hot_keys(contract, KEY, buckets).write.parquet(hot_path)
    hot = contract.sparkSession.read.parquet(hot_path)
    sides = (
        (salt_left(contract, hot, KEY, buckets), names[0], DATE),
        (salt_right(vendor, hot, KEY), names[1], KEY),
    )
    for df, name, sort in sides:
        (
            df.repartition(buckets, *by)
            .write.mode("error")
            .bucketBy(buckets, *by)
            .sortBy(sort)
            .option("path", f"{root.rstrip('/')}/{name}")
            .saveAsTable(name)
        )
    return names


def join_bucketed(spark: SparkSession, names: tuple[str, str], *more_keys: str) -> DataFrame:
    """Contracts with their vendor from tables bucketed by the same keys; no side is shuffled."""
    contract, vendor = (spark.table(name) for name in names)
    return contract.join(vendor, [KEY, *more_keys, "salt"], "left").drop("salt")


def export_csv(df: DataFrame, path: str, array_sep: str = ",") -> None:
    """Gzip CSV with a header; arrays become joined text, null and empty text stay apart."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    flat = df.withColumns({name: F.array_join(name, array_sep) for name in arrays}) if arrays else df
    writer = flat.write.mode("error").options(**CSV_OPTIONS).option("emptyValue", '""')
    writer.option("compression", "gzip").csv(path)


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The exported rows; line breaks inside text make a file one split, as gzip does anyway.

    The reader would take empty text for null: it hands it out as a NUL character, which no XML
    text can hold, and that is turned back.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("emptyValue", "\0").option("multiLine", "true")
    text = {
        f.name: F.when(F.col(f"`{f.name}`") == "\0", "").otherwise(F.col(f"`{f.name}`"))
        for f in schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    rows = reader.schema(schema).csv(path)
    return rows.withColumns(text) if text else rows


# How the CSV files are written and read back.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def lookup(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows of a written table with one of some values, such as award ids.

    The values reach the scan, which leaves out row groups by their Bloom filters where rows are in
    another order than the column's (see ``LOOKUPS``).
    """
    return table.where(F.col(f"`{column}`").isin(list(values)))


# Bits of a sketch's register number: 2 to that many registers, about 1.04 / sqrt of them off (1.6 %).
SKETCH_BITS = 12


def column_sketches(df: DataFrame, table: str, year: int | str) -> DataFrame:
    """One row per column of a year: rows filled, and a sketch of its different values.

    Kept beside the year, the sketches of all years tell how many values there are without
    reading any year again; see :func:`distinct_counts`. One pass, a sketch per task and column.
    """
    entries = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(str(year)).alias("year"),
            F.lit(field.name).alias("column"),
            F.count(F.col(f"`{field.name}`")).alias("filled"),
            F.hll_sketch_agg(F.col(f"`{field.name}`").cast("string"), F.lit(SKETCH_BITS)).alias("sketch"),
        )
        for field in df.schema.fields
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """Per table and column over all years of :func:`column_sketches`: rows filled, and about how many different values."""
    merged = sketches.groupBy("table", "column").agg(F.sum("filled").alias("filled"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("table", "column", "filled", F.hll_sketch_estimate("sketch").alias("values"))


def data_dictionary(df: DataFrame, table: str) -> DataFrame:
    """One row per column: source path, type, noted width, filled rows, longest value in bytes.

    One pass with partial aggregates; the longest value tells which columns need a width.
    """
    fields = df.schema.fields

    def longest(field: T.StructField):
        if isinstance(field.dataType, T.StringType):
            return F.max(F.octet_length(F.col(f"`{field.name}`"))).cast("long")
        return F.lit(None).cast("long")

    entries = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(field.metadata.get("path", field.name)).alias("path"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.lit(field.metadata.get("maxlength")).cast("long").alias("maxlength"),
            F.count(F.col(f"`{field.name}`")).alias("filled"),
            longest(field).alias("longest"),
        )
        for field in fields
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
