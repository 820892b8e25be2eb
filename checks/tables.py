"""Queries over shaping and storing: flatten, keys, dedupe, widths, rejects, sinks, the year job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.registry import CONTRACT_COLUMNS, VENDOR_COLUMNS, check, with_award, with_vendor
from checks import fixtures
from contractlake.operators.dedupe import dedupe_vendors
from contractlake.operators.flatten import array_child, child_tables, flatten, gathered
from contractlake.operators.rejects import apply_types, cast_rules, split_rejects
from contractlake.operators.width import apply_widths, truncate_bytes
from contractlake.plans.jobs import run_year, run_years, update_year
from contractlake.plans.questions import join_contract_vendor, latest_vendors
from contractlake.plans.tables import TYPES, contract_projection, vendor_projection, vendor_table
from contractlake.session import qualified, scratch_dir
from contractlake.sinks.tables import (
    column_sketches,
    data_dictionary,
    distinct_counts,
    export_csv,
    join_bucketed,
    lookup,
    read_csv_export,
    read_table,
    write_bucketed,
    write_contract,
    write_vendor,
)
from contractlake.sources.awards import CORRUPT
from contractlake.streaming.landing import ingest_new_files

CONTRACT_SQL = with_award(f"SELECT {CONTRACT_COLUMNS} FROM award")
VENDOR_SQL = with_vendor(f"SELECT {VENDOR_COLUMNS} FROM vendor")


@check(
    with_award(
        """SELECT piid AS contract_piid, agency AS contract_agency, '0' AS contract_mod,
          '00' AS "transactionNumber", CASE WHEN vehicle IS NOT NULL THEN 'IDV' END AS "PIID",
          CASE WHEN vehicle IS NOT NULL THEN '9700' END AS "agencyID",
          CASE WHEN vehicle IS NOT NULL THEN '0' END AS "modNumber",
          signed AS "signedDate", amount::double AS "obligatedAmount",
          product AS "productOrServiceCode", tag, name AS "vendorName",
          alt_name AS "vendorAlternateName", country AS "countryCode", duns AS "DUNSNumber", year
        FROM award"""
    )
)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf of the award; the names two paths share are settled by the rename map."""
    contract_id = "ns1:awardID.ns1:awardContractID."
    rename = {
        contract_id + "ns1:PIID": "contract_piid",
        contract_id + "ns1:agencyID": "contract_agency",
        contract_id + "ns1:modNumber": "contract_mod",
    }
    flat = flatten(fixtures.award_frame(spark, sf_dir), rename=rename, arrays="join")
    return apply_types(flat, {"obligatedAmount": "double"})


@check(CONTRACT_SQL, name="contract_projection")
def contract_projection_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_types(contract_projection(fixtures.keyed_awards(spark, sf_dir)), TYPES)


@check(
    with_award(
        """SELECT name AS "vendorName", alt_name AS "vendorAlternateName", country AS "countryCode",
        duns AS "DUNSNumber", signed AS "signedDate" FROM award"""
    ),
    name="vendor_projection",
)
def vendor_projection_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_projection(fixtures.award_frame(spark, sf_dir))


@check(
    with_award(
        "SELECT piid AS \"PIID\", signed AS action_date, product AS psc FROM award"
    )
)
def rename_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rename = {
        "ns1:relevantContractDates.ns1:signedDate": "action_date",
        "ns1:contractData.ns1:productOrServiceCode": "psc",
    }
    awards = fixtures.keyed_awards(spark, sf_dir)
    return contract_projection(awards, rename).select("PIID", "action_date", "psc")


@check(
    with_award(
        """SELECT award_id AS "unique_award_id", (pos - 1)::bigint AS position, parts[pos] AS tag
        FROM (SELECT award_id, string_split(alt_name, '-') AS parts,
                     unnest(range(1, 1 + len(string_split(alt_name, '-')))) AS pos FROM award)"""
    )
)
def array_child_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_child(
        fixtures.keyed_awards(spark, sf_dir),
        "ns1:contractData.ns1:tag",
        {"unique_award_id": "ns1:unique_award_id"},
    )


@check(
    """WITH line AS (
      SELECT l_orderkey AS "order", l_returnflag, l_linestatus, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus) - 1 AS position_1
      FROM lineitem)
    SELECT "order", position_1, 0::bigint AS position_2, l_returnflag AS code FROM line
    UNION ALL SELECT "order", position_1, 1, l_linestatus FROM line"""
)
def array_child_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of an element repeated inside a repeated one: each row with its place in both."""
    tables = child_tables(fixtures.orders_with_lines(spark, sf_dir), {"order": "order"})
    return tables["lines", "line", "flags", "flag"]


@check(
    """WITH line AS (
      SELECT l_orderkey AS "order", l_linenumber::bigint AS number, l_partkey AS part, l_quantity AS quantity, l_returnflag, l_linestatus
      FROM lineitem)
    SELECT "order", count(*) AS lines, md5(string_agg(
      number || ' ' || part || ' ' || quantity::bigint || ' ' || l_returnflag || ',' || l_linestatus, ';'
      ORDER BY number, part, quantity, l_returnflag, l_linestatus)) AS content
    FROM line GROUP BY "order" """
)
def array_child_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records put together again from the tables of their repeated elements."""
    tables = child_tables(fixtures.orders_with_lines(spark, sf_dir), {"order": "order"})
    back = gathered(tables, ("lines", "line"), ["order"])
    text = F.transform(
        "line",
        lambda x: F.concat_ws(
            " ", x["number"].cast("string"), x["part"].cast("string"), x["quantity"].cast("long").cast("string"),
            F.array_join(F.transform(x["flag"], lambda f: f["code"]), ","),
        ),
    )
    return back.select("order", F.size("line").cast("long").alias("lines"), F.md5(F.array_join(text, ";")).alias("content"))


@check(with_award('SELECT award_id AS "unique_award_id", signed AS "signedDate", amount::double AS "obligatedAmount" FROM award WHERE piid::bigint % 997 = 1'))
def lookup_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards by their ids, which the scan finds by Bloom filters: the files are in the order of dates."""
    orders = fixtures.table(spark, sf_dir, "orders").where("o_orderkey % 997 = 1").select(
        F.format_string("%d_%04d_0_00", "o_orderkey", F.col("o_orderkey") % 25).alias("id")
    )
    # As many ids as a user asks for: the thousandth part of the given table.
    asked = [row["id"] for row in orders.collect()]
    table = read_table(spark, fixtures.lake(spark, sf_dir), "contract")
    return lookup(table, "unique_award_id", asked).select("unique_award_id", "signedDate", "obligatedAmount")


@check(
    with_award(
        """, counts AS (SELECT count(DISTINCT award_id) AS "unique_award_id", count(DISTINCT duns) AS "DUNSNumber",
          count(DISTINCT amount) AS "obligatedAmount", count(DISTINCT agency) AS "agencyID" FROM award)
        SELECT "column", "values" AS exact, true AS within_five_percent
        FROM (UNPIVOT counts ON * INTO NAME "column" VALUE "values")"""
    )
)
def distinct_across_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different values over all years from the sketches that each year left, beside the exact number."""
    columns = ["unique_award_id", "DUNSNumber", "obligatedAmount", "agencyID"]

    def make(path: str) -> None:
        table = fixtures.contract(spark, sf_dir)
        for row in table.select("year").distinct().collect():
            mine = table.where(F.col("year") == row["year"]).select(*columns)
            column_sketches(mine, "contract", row["year"]).write.mode("append").parquet(path)

    sketches = spark.read.parquet(fixtures.once(spark, sf_dir, "sketches", make))
    exact = fixtures.contract(spark, sf_dir).agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.unpivot([], columns, "column", "exact")
    close = F.abs(F.col("values") - F.col("exact")) <= 0.05 * F.col("exact")
    return distinct_counts(sketches).join(exact, "column").select("column", "exact", close.alias("within_five_percent"))


@check(with_award('SELECT award_id AS "unique_award_id", tag FROM award'))
def array_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = fixtures.keyed_awards(spark, sf_dir)
    return contract_projection(awards, arrays="join").select("unique_award_id", "tag")


@check(with_award("SELECT award_id AS unique_award_id FROM award"))
def key_unique_award_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = fixtures.keyed_awards(spark, sf_dir)
    return awards.select(F.col("`ns1:unique_award_id`").alias("unique_award_id"))


@check(with_award("SELECT piid, vehicle AS referenced_id FROM award"))
def key_referenced_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = fixtures.keyed_awards(spark, sf_dir)
    return awards.select(
        F.col("`ns1:awardID`.`ns1:awardContractID`.`ns1:PIID`").alias("piid"),
        F.col("`ns1:referencedID`").alias("referenced_id"),
    )


@check(
    with_award(
        """SELECT duns AS "DUNSNumber", name AS "vendorName", alt_name AS "vendorAlternateName",
          country AS "countryCode" FROM (
          SELECT *, row_number() OVER (PARTITION BY duns
            ORDER BY signed_at DESC, alt_name DESC, name DESC, country DESC) AS rank FROM award)
        WHERE rank = 1"""
    )
)
def vendor_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_table(fixtures.award_frame(spark, sf_dir))


@check(with_award('SELECT DISTINCT duns AS "DUNSNumber" FROM award'))
def vendor_dedupe_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = vendor_projection(fixtures.award_frame(spark, sf_dir))
    return dedupe_vendors(flat, mode="any").select("DUNSNumber")


@check(
    with_award(
        """SELECT CASE WHEN product <> 'P' THEN duns END AS "DUNSNumber", count(*) AS awards,
          max(product <> 'P') AS in_vendor_table
        FROM award GROUP BY 1"""
    )
)
def vendor_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards of one status have a blank vendor number: kept as contracts, no vendor row."""
    awards = fixtures.keyed_awards(spark, sf_dir)
    product = F.col("`ns1:contractData`")["ns1:productOrServiceCode"]
    site = F.col("`ns1:vendor`.`ns1:vendorSiteDetails`")
    duns = site["ns1:vendorDUNSInformation"]["ns1:DUNSNumber"]
    blanked = fixtures.with_duns(awards, F.when(product == "P", F.lit(" ")).otherwise(duns))
    vendors = vendor_table(blanked).select("DUNSNumber", F.lit(True).alias("in_vendor_table"))
    per_key = contract_projection(blanked).groupBy("DUNSNumber").agg(F.count("*").alias("awards"))
    return per_key.join(vendors, "DUNSNumber", "left").na.fill(False)


@check(
    with_vendor(
        f"""SELECT {VENDOR_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY duns ORDER BY year DESC) AS latest FROM vendor)
        WHERE latest = 1"""
    )
)
def vendor_latest_across_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_vendors(fixtures.vendor(spark, sf_dir))


@check(
    """SELECT doc_id, md5(CASE WHEN strlen(text) <= 256 THEN text ELSE left(text, list_max(list_filter(
        range(0, 257), lambda k: strlen(left(text, k)) <= 256))) END) AS cut_256,
      md5(CASE WHEN strlen(text) <= 301 THEN text ELSE left(text, list_max(list_filter(
        range(0, 302), lambda k: strlen(left(text, k)) <= 301))) END) AS cut_301
    FROM documents"""
)
def width_truncate_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents")
    text = documents.select("doc_id", F.col("text").alias("cut_256"), F.col("text").alias("cut_301"))
    cut = truncate_bytes(text, {"cut_256": 256, "cut_301": 301})
    return cut.select("doc_id", F.md5("cut_256").alias("cut_256"), F.md5("cut_301").alias("cut_301"))


def _raw_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Contract rows as text; urgent awards have no readable amount, one status no date."""
    raw = contract_projection(fixtures.keyed_awards(spark, sf_dir))
    bad_amount = F.concat(F.lit("USD "), "obligatedAmount")
    raw = raw.withColumns(
        {
            "obligatedAmount": F.when(F.col("tag") == "1,URGENT", bad_amount).otherwise(
                F.col("obligatedAmount")
            ),
            "signedDate": F.when(F.col("productOrServiceCode") == "P", F.lit("n/a")).otherwise(
                F.col("signedDate")
            ),
        }
    )
    good, rejects = split_rejects(raw, cast_rules(TYPES, raw.columns))
    return apply_types(good, TYPES), rejects


@check(with_award(f"SELECT {CONTRACT_COLUMNS} FROM award WHERE tag <> '1,URGENT' AND product <> 'P'"))
def load_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_load(spark, sf_dir)[0]


@check(
    with_award(
        """SELECT award_id AS "unique_award_id", concat_ws('; ',
          CASE WHEN product = 'P' THEN 'signedDate is not timestamp_ntz' END,
          CASE WHEN tag = '1,URGENT' THEN 'obligatedAmount is not decimal(18,2)' END) AS reasons
        FROM award WHERE tag = '1,URGENT' OR product = 'P'"""
    )
)
def load_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _raw_load(spark, sf_dir)[1]
    return rejects.select("unique_award_id", F.array_join("reasons", "; ").alias("reasons"))


@check(CONTRACT_SQL)
def sink_contract_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "contracts")
    write_contract(fixtures.contract(spark, sf_dir), root)
    return read_table(spark, root, "contract")


@check(CONTRACT_SQL)
def sink_contract_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "ranged")
    write_contract(fixtures.contract(spark, sf_dir), root, layout="ranged")
    return read_table(spark, root, "contract")


@check(VENDOR_SQL)
def sink_vendor_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "vendors")
    write_vendor(vendor_table(fixtures.award_frame(spark, sf_dir), per=("year",)), root)
    return read_table(spark, root, "vendor")


JOINED_SQL = with_vendor(
    """SELECT award.piid AS "PIID", award.amount::double AS "obligatedAmount", award.year,
      vendor.duns AS "DUNSNumber", vendor.name AS "vendorName",
      vendor.alt_name AS "vendorAlternateName", vendor.country AS "countryCode"
    FROM award JOIN vendor ON award.duns = vendor.duns AND award.year = vendor.year"""
)
JOINED = (
    "PIID",
    "obligatedAmount",
    "year",
    "DUNSNumber",
    "vendorName",
    "vendorAlternateName",
    "countryCode",
)


def bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Catalog tables made once per application and data."""

    def names_for(path: str) -> tuple[str, str]:
        suffix = path.rsplit("-", 1)[-1]
        return f"contract_{suffix}", f"vendor_{suffix}"

    def make(path: str) -> None:
        contract, vendor = (f(spark, sf_dir) for f in (fixtures.contract, fixtures.vendor))
        write_bucketed(contract, vendor, path, names_for(path), more_keys=("year",))

    return names_for(fixtures.once(spark, sf_dir, "bucketed", make))


@check(JOINED_SQL, name="join_bucketed")
def join_bucketed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_bucketed(spark, bucketed_tables(spark, sf_dir), "year").select(*JOINED)


@check(JOINED_SQL, name="join_contract_vendor")
def join_contract_vendor_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, vendor = (f(spark, sf_dir) for f in (fixtures.contract, fixtures.vendor))
    return join_contract_vendor(contract, vendor, "year").select(*JOINED)


@check(
    with_vendor(
        """SELECT award.piid AS "PIID", award.amount::double AS "obligatedAmount", award.year,
          b.duns AS "DUNSNumber", b.name AS "vendorName", b.alt_name AS "vendorAlternateName",
          b.country AS "countryCode"
        FROM award LEFT JOIN (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY duns, year
            ORDER BY signed_at DESC, alt_name DESC, name DESC, country DESC) AS latest
          FROM award WHERE product <> 'P') WHERE latest = 1) b
        ON award.product <> 'P' AND award.duns = b.duns AND award.year = b.year"""
    )
)
def join_contract_vendor_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts that name no vendor stay, without one."""
    return join_contract_vendor(*fixtures.blank_vendor_tables(spark, sf_dir), "year").select(*JOINED)


@check(CONTRACT_SQL)
def sink_csv_gzip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    contract = fixtures.contract(spark, sf_dir)
    export_csv(contract, path)
    return read_csv_export(spark, path, contract.schema)


@check(
    """SELECT doc_id, md5(text) AS content, lang FROM documents"""
)
def sink_csv_free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with quotes and line breaks through the CSV files."""
    path = scratch_dir(spark, "csv-text")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    export_csv(documents, path)
    return read_csv_export(spark, path, documents.schema).select(
        "doc_id", F.md5("text").alias("content"), "lang"
    )


DICTIONARY_WIDTHS = {"PIID": 50, "agencyID": 4, "DUNSNumber": 13}


def _dictionary_sql() -> str:
    contract_id, vendor = "ns1:awardID.ns1:awardContractID.", "ns1:vendor.ns1:vendorSiteDetails."
    text = {
        "PIID": (contract_id + "ns1:PIID", "piid"),
        "agencyID": (contract_id + "ns1:agencyID", "agency"),
        "modNumber": (contract_id + "ns1:modNumber", "'0'"),
        "DUNSNumber": (vendor + "ns1:vendorDUNSInformation.ns1:DUNSNumber", "duns"),
        "unique_award_id": ("ns1:unique_award_id", "award_id"),
        "referencedID": ("ns1:referencedID", "vehicle"),
        "productOrServiceCode": ("ns1:contractData.ns1:productOrServiceCode", "product"),
        "tag": ("ns1:contractData.ns1:tag", "tag"),
    }
    other = {
        "signedDate": ("ns1:relevantContractDates.ns1:signedDate", "timestamp_ntz", "signed_at"),
        "obligatedAmount": ("ns1:dollarValues.ns1:obligatedAmount", "decimal(18,2)", "amount"),
        "year": ("year", "int", "year"),
    }
    rows = [
        f"SELECT '{path}' AS path, '{name}' AS \"column\", 'string' AS type, "
        f"{DICTIONARY_WIDTHS.get(name, 0)}::bigint AS maxlength, count({value}) AS filled, max(strlen({value}))::bigint AS longest FROM award"
        for name, (path, value) in text.items()
    ]
    rows += [
        f"SELECT '{path}', '{name}', '{dtype}', 0, count({value}), 0::bigint FROM award"
        for name, (path, dtype, value) in other.items()
    ]
    return with_award(" UNION ALL ".join(rows))


@check(_dictionary_sql(), name="data_dictionary")
def data_dictionary_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a table written with widths for some columns and read back."""
    path = scratch_dir(spark, "wide")
    apply_widths(fixtures.contract(spark, sf_dir), DICTIONARY_WIDTHS).write.parquet(path)
    entries = data_dictionary(spark.read.parquet(path), "contract")
    longest, width = (F.coalesce(n, F.lit(0)).alias(n) for n in ("longest", "maxlength"))
    return entries.select("path", "column", "type", width, "filled", longest)


@check(
    with_award(
        f"""SELECT {CONTRACT_COLUMNS} FROM award
        WHERE signed_at >= timestamp '1997-03-01' AND signed_at < timestamp '1997-06-15'"""
    )
)
def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("signedDate")
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1997-03-01", "1997-06-15"))
    return fixtures.contract(spark, sf_dir).where((date >= first) & (date < last))


@check(with_award(f"SELECT {CONTRACT_COLUMNS} FROM award WHERE year = 1999"))
def scan_year_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.contract(spark, sf_dir).where("year = 1999")


def loaded_years(spark: SparkSession, sf_dir: str) -> str:
    """All year folders through the year job, made once per application and data."""
    folder = fixtures.award_xml(spark, sf_dir)
    schema = fixtures.award_frame(spark, sf_dir).drop("year").schema
    years = fixtures.table(spark, sf_dir, "orders").select(F.year("o_orderdate")).distinct()

    def make(path: str) -> None:
        sources = {year: f"{folder}/year={year}" for (year,) in years.collect()}
        run_years(spark, sources, path, schema=schema, widths={"vendorName": 16})

    return fixtures.once(spark, sf_dir, "years", make)


@check(CONTRACT_SQL)
def job_year_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, loaded_years(spark, sf_dir), "contract")


@check(with_vendor(f"SELECT {VENDOR_COLUMNS.replace('name AS', 'left(name, 16) AS', 1)} FROM vendor"))
def job_year_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the vendor table, names cut to 16 bytes by the job's width map."""
    return read_table(spark, loaded_years(spark, sf_dir), "vendor")


@check(CONTRACT_SQL)
def job_archives_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load straight from the zip files, which hold the awards of all years."""
    folder = fixtures.archive_files(spark, sf_dir)
    schema = fixtures.award_frame(spark, sf_dir).drop("year").schema
    target = scratch_dir(spark, "from-archives")
    load = run_year(spark, folder, target, "all", schema, mode="archives")
    return spark.read.parquet(load.contract).withColumn("year", F.year("signedDate"))


@check(
    r"""SELECT doc_id::varchar AS "PIID",
      md5(regexp_replace(text, '[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]', '', 'g')) AS content
    FROM documents"""
)
def job_wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as the description of an award through the year job: nothing is cut. Left out
    are only characters that XML does not have."""

    def make(path: str) -> None:
        text = F.regexp_replace("text", r"[^\x09\x0A\x0D\x20-\uD7FF\uE000-\uFFFD\x{10000}-\x{10FFFF}]", "")
        for letter, escape in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
            text = F.replace(text, F.lit(letter), F.lit(escape))
        leaf = lambda name, value: F.concat(F.lit(f"<ns1:{name}>"), value, F.lit(f"</ns1:{name}>"))
        ident = F.concat(leaf("PIID", F.col("doc_id").cast("string")), leaf("agencyID", F.lit("0300")),
                         leaf("modNumber", F.lit("0")), leaf("transactionNumber", F.lit("0")))
        award = leaf("award", F.concat(leaf("awardID", leaf("awardContractID", ident)), leaf("description", leaf("text", F.concat(F.lit("|"), text, F.lit("|"))))))
        fixtures.table(spark, sf_dir, "documents").select(award.alias("value")).write.text(f"{path}/in")
        schema = T.StructType.fromDDL(
            "`ns1:awardID` struct<`ns1:awardContractID`: struct<`ns1:PIID`: string, `ns1:agencyID`: string, "
            "`ns1:modNumber`: string, `ns1:transactionNumber`: string>>, `ns1:description` struct<`ns1:text`: string>"
        )
        ingest_new_files(spark, f"{path}/in/*.txt", f"{path}/landed", f"{path}/state", schema)
        run_year(spark, f"{path}/landed", f"{path}/lake", 2005, types={}, mode="landed", max_errors=1)

    folder = fixtures.once(spark, sf_dir, "wide-text", make)
    text = F.expr("substring(text, 2, length(text) - 2)")
    return read_table(spark, f"{folder}/lake", "contract").select("PIID", F.md5(text).alias("content"))


@check(
    with_award(
        """SELECT 'vendor' AS "table", count(*) AS awards, 'countryCode is not int' AS reason
        FROM award WHERE country::int % 5 = 0
        UNION ALL SELECT 'loaded', count(DISTINCT duns), 'none' FROM award WHERE country::int % 5 <> 0"""
    )
)
def job_vendor_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors of every fifth nation have a country that is no number: rejects of the vendor table."""

    def make(path: str) -> None:
        awards = fixtures.award_frame(spark, sf_dir).drop("year")
        vendor = F.col("`ns1:vendor`")
        site = vendor["ns1:vendorSiteDetails"]
        country = site["ns1:vendorLocation"]["ns1:countryCode"]
        bad = F.when(country.cast("int") % 5 == 0, F.concat(F.lit("no. "), country)).otherwise(country)
        moved = site.withField("`ns1:vendorLocation`", F.struct(bad.alias("ns1:countryCode")))
        awards = awards.withColumn("ns1:vendor", vendor.withField("`ns1:vendorSiteDetails`", moved))
        awards.withColumn(CORRUPT, F.lit(None).cast("string")).write.parquet(f"{path}/landed")
        everything = awards.count() + 1
        run_year(spark, f"{path}/landed", f"{path}/lake", 2005, types={**TYPES, "countryCode": "int"},
                 mode="landed", max_errors=everything)

    lake = f"{fixtures.once(spark, sf_dir, 'vendor-rejects', make)}/lake"
    rejects = read_table(spark, lake, "rejects").select("table", F.explode("reasons").alias("reason"))
    vendors = read_table(spark, lake, "vendor").select(F.lit("loaded").alias("table"), F.lit("none").alias("reason"))
    return rejects.unionByName(vendors).groupBy("table", "reason").agg(F.count(F.lit(1)).alias("awards"))


@check(CONTRACT_SQL)
def job_archives_broken_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every archive has one more member that is not UTF-8: all readable awards are loaded."""

    def make(path: str) -> None:
        source = qualified(spark, fixtures.archive_files(spark, sf_dir))
        files = spark.read.format("binaryFile").load(f"{source}/*.zip").select("path", "content")
        folder = qualified(spark, f"{path}/in")
        broken = files.mapInArrow(lambda batches: fixtures.add_member(batches, folder), "path string")
        n = broken.count()
        schema = fixtures.award_frame(spark, sf_dir).drop("year").schema
        run_year(spark, f"{path}/in", f"{path}/lake", "all", schema, mode="archives", max_broken=n, max_errors=n + 1)

    lake = f"{fixtures.once(spark, sf_dir, 'broken-members', make)}/lake"
    return read_table(spark, lake, "contract").withColumn("year", F.year("signedDate"))


@check(
    with_award(
        """SELECT 'contract' AS "table", count(*) AS rows, sum(amount)::double AS amount FROM award
        UNION ALL SELECT 'vendor', count(DISTINCT duns), NULL FROM award"""
    )
)
def incremental_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year loaded from what has landed, and brought up to date when more has: both tables follow."""

    def make(path: str) -> None:
        awards = fixtures.award_frame(spark, sf_dir, even=True)
        schema = awards.drop("year").schema
        for due in (F.col("year") > 1998, F.col("year") <= 1998):
            fixtures.write_xml(awards.where(due), f"{path}/in")
            ingest_new_files(spark, f"{path}/in/year=*/*AWARD.xml", f"{path}/landed", f"{path}/state", schema)
            update_year(spark, f"{path}/landed", f"{path}/lake", "all")

    lake = f"{fixtures.once(spark, sf_dir, 'incremental-year', make)}/lake"
    contract, vendor = (read_table(spark, lake, name) for name in ("contract", "vendor"))
    sums = contract.agg(F.lit("contract").alias("table"), F.count(F.lit(1)).alias("rows"), F.sum("obligatedAmount").alias("amount"))
    return sums.unionByName(
        vendor.agg(F.lit("vendor").alias("table"), F.count(F.lit(1)).alias("rows"), F.lit(None).cast("decimal(18,2)").alias("amount"))
    )


def _followed(spark: SparkSession, sf_dir: str) -> str:
    """A lake that followed files being replaced: half of them first came with wrong amounts, dates and
    names and with awards that are no longer there, and files that came later."""

    def make(path: str) -> None:
        schema = fixtures.award_frame(spark, sf_dir).drop("year").schema
        for version in (0, 1):
            fixtures.write_versions(spark, sf_dir, f"{path}/in", version)
            ingest_new_files(spark, f"{path}/in/*AWARD.xml.gz", f"{path}/landed", f"{path}/state", schema)
            update_year(spark, f"{path}/landed", f"{path}/lake", "all")

    return f"{fixtures.once(spark, sf_dir, 'followed', make)}/lake"


@check(CONTRACT_SQL)
def incremental_changed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts after files were replaced: those of the newest versions, each once."""
    return read_table(spark, _followed(spark, sf_dir), "contract").withColumn("year", F.year("signedDate"))


@check(
    with_award(
        """SELECT duns AS "DUNSNumber", name AS "vendorName", alt_name AS "vendorAlternateName", country AS "countryCode"
        FROM (SELECT *, row_number() OVER (
          PARTITION BY duns ORDER BY signed_at DESC, alt_name DESC, name DESC, country DESC) AS rank FROM award)
        WHERE rank = 1"""
    )
)
def incremental_changed_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors after the same: what a replaced version said of them is forgotten."""
    return read_table(spark, _followed(spark, sf_dir), "vendor").drop("year")
