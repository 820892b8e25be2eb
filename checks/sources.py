"""Queries over the readers: XML, zips, links, file listings, incremental landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.registry import CONTRACT_COLUMNS, check, with_award
from checks import fixtures
from contractlake.functions.keys import award_key
from contractlake.operators.flatten import column, leaf_paths, local_name
from contractlake.operators.rejects import apply_types
from contractlake.plans.index import (
    archive_names,
    pending_archives,
    plan_downloads,
    store_links,
    walk_all,
    walk_index,
)
from contractlake.plans.jobs import landing_manifest
from contractlake.plans.tables import TYPES, contract_projection
from contractlake.session import scratch_dir
from contractlake.sources.archives import expand_archives, expand_large_archives
from contractlake.sources.awards import (
    CORRUPT,
    ROW_TAG,
    award_records,
    discover_schema,
    parse_records,
    read_awards,
)
from contractlake.sources.files import file_manifest, landing_keys, size_class
from contractlake.sources.pages import extract_links, labelled, resolve_links
from contractlake.streaming.landing import ingest_new_files

# The year is no element of the award but the folder it lies in; here it comes from the date.
CONTRACT_SQL = with_award(f"SELECT {CONTRACT_COLUMNS} FROM award")


def _contracts(awards: DataFrame) -> DataFrame:
    flat = apply_types(contract_projection(award_key(awards)), TYPES)
    return flat.withColumn("year", F.year("signedDate"))


def _xml(spark: SparkSession, sf_dir: str) -> str:
    return fixtures.all_award_files(fixtures.award_xml(spark, sf_dir))


def _schema(spark: SparkSession, sf_dir: str):
    """Declared schema of an award, as a user would store it: no inference pass."""
    return fixtures.award_frame(spark, sf_dir).drop("year").schema


@check(CONTRACT_SQL)
def xml_scan_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contracts(read_awards(spark, _xml(spark, sf_dir)))


@check(CONTRACT_SQL)
def xml_scan_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contracts(read_awards(spark, _xml(spark, sf_dir), _schema(spark, sf_dir)))


@check(CONTRACT_SQL)
def xml_scan_splittable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without compression, which are read in splits."""
    path = fixtures.all_award_files(fixtures.award_xml(spark, sf_dir, plain=True))
    return _contracts(read_awards(spark, path, _schema(spark, sf_dir), mode="records"))


@check(CONTRACT_SQL)
def xml_scan_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reader takes files of every size class; the class is a label and changes no row."""
    path = _xml(spark, sf_dir)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    limit = files.agg(F.avg("length")).first()[0]
    sized = files.select(F.col("path").alias("file"), size_class(F.col("length"), int(limit)).alias("size_class"))
    records = award_records(spark, path).join(sized, "file")
    awards = parse_records(records, _schema(spark, sf_dir))
    classes = [awards.where(F.col("size_class") == name) for name in ("large", "small")]
    return _contracts(classes[0].unionByName(classes[1]).drop("file", "size_class"))


@check(
    with_award(
        "SELECT piid AS \"PIID\", agency AS \"agencyID\", false AS has_attribute FROM award"
    )
)
def xml_exclude_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = read_awards(spark, _xml(spark, sf_dir))
    award_id = F.col("`ns1:awardID`.`ns1:awardContractID`")
    return awards.select(
        award_id["ns1:PIID"].alias("PIID"),
        award_id["ns1:agencyID"].alias("agencyID"),
        F.lit("_version" in awards.columns).alias("has_attribute"),
    )


@check(with_award("SELECT piid AS \"PIID\" FROM award WHERE product <> 'P'"))
def xml_glob_award_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards of one status lie in another kind of file, which the pattern leaves out."""

    def make(path: str) -> None:
        other = F.col("`ns1:contractData`")["ns1:productOrServiceCode"] == "P"
        file = F.when(other, "B-IDV.xml").otherwise(fixtures.AWARD_DIR)
        fixtures.write_xml(fixtures.award_frame(spark, sf_dir, even=True), path, file)

    folder = fixtures.once(spark, sf_dir, "xml-kinds", make)
    awards = read_awards(spark, fixtures.all_award_files(folder), _schema(spark, sf_dir))
    return awards.select(F.col("`ns1:awardID`.`ns1:awardContractID`.`ns1:PIID`").alias("PIID"))


@check(
    with_award(
        "SELECT agency AS \"agencyID\", duns AS \"DUNSNumber\", count(*) AS awards "
        "FROM award GROUP BY agency, duns"
    )
)
def xml_infer_leading_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = contract_projection(award_key(read_awards(spark, _xml(spark, sf_dir))))
    return awards.groupBy("agencyID", "DUNSNumber").agg(F.count(F.lit(1)).alias("awards"))


@check(
    with_award(
        """SELECT path, count(*) AS filled FROM (
             SELECT unnest(['PIID', 'agencyID', 'modNumber', 'transactionNumber', 'signedDate',
               'obligatedAmount', 'productOrServiceCode', 'tag', 'vendorName',
               'vendorAlternateName', 'countryCode', 'DUNSNumber']) AS path FROM award
             UNION ALL
             SELECT unnest(['vehicle PIID', 'vehicle agencyID', 'vehicle modNumber']) FROM award
             WHERE vehicle IS NOT NULL) GROUP BY path"""
    )
)
def xml_schema_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema found by the distributed pass, and how many records fill each leaf of it."""
    pieces = award_records(spark, _xml(spark, sf_dir))
    schema = discover_schema(pieces)
    awards = parse_records(pieces, schema)
    counts = []
    for path in leaf_paths(schema):
        prefix = "vehicle " if "ns1:referencedIDVID" in path else ""
        name, filled = F.lit(prefix + local_name(path)), F.count(column(path))
        counts.append(F.struct(name.alias("path"), filled.alias("filled")))
    return awards.agg(F.array(*counts).alias("found")).select(F.inline("found"))


@check(
    with_award(
        "SELECT count(*) FILTER (alt_name <> '5-LOW') AS good, "
        "count(*) FILTER (alt_name = '5-LOW') AS corrupt, "
        "sum(amount) FILTER (alt_name <> '5-LOW')::double AS good_amount FROM award"
    )
)
def xml_corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one priority lose an end tag; the others are all read."""
    pieces = award_records(spark, _xml(spark, sf_dir))
    broken = F.when(
        F.col("value").contains("<ns1:vendorAlternateName>5-LOW<"),
        F.replace("value", F.lit("</ns1:vendorHeader>"), F.lit("")),
    ).otherwise(F.col("value"))
    awards = parse_records(pieces.withColumn("value", broken), _schema(spark, sf_dir))
    good = F.col(CORRUPT).isNull()
    amount = F.col("`ns1:dollarValues`.`ns1:obligatedAmount`").cast("decimal(18,2)")
    return awards.agg(
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("corrupt"),
        F.sum(F.when(good, amount)).alias("good_amount"),
    )


@check(
    with_award(
        """SELECT shape, count(*) AS awards, sum(amount)::double AS amount,
          count(*) FILTER (shape = 'torn') AS corrupt
        FROM (SELECT *, ['plain', 'spaced end', 'section', 'commented', 'torn', 'accents'][1 + piid::bigint % 6] AS shape FROM award)
        WHERE shape <> 'commented' GROUP BY shape"""
    )
)
def xml_scan_awkward_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records with blanks in the end tag, end tags in sections, inside comments, without
    an end tag, and with letters beyond ASCII: each is read or named corrupt, those commented out are none."""

    def make(path: str) -> None:
        key = F.col("o_orderkey").cast("string")
        shape = F.col("o_orderkey") % 6
        body = F.concat(F.lit("<ns1:PIID>"), key, F.lit("</ns1:PIID><ns1:amount>"), "amount", F.lit("</ns1:amount>"))
        record = F.concat(F.lit("<ns1:award>"), body, F.lit("</ns1:award>"))
        text = (
            F.when(shape == 1, F.concat(F.lit("<ns1:award>"), body, F.lit("</ns1:award\t>")))
            .when(shape == 2, F.concat(F.lit("<ns1:award>"), body, F.lit("<ns1:note><![CDATA[a </ns1:award> <ns1:award> b]]></ns1:note></ns1:award>")))
            .when(shape == 3, F.concat(F.lit("<!-- "), record, F.lit(" and "), record, F.lit(" -->")))
            .when(shape == 4, F.concat(F.lit("<ns1:award>"), body))
            .when(shape == 5, F.concat(F.lit("<ns1:award>"), body, F.lit("<ns1:note>caf\u00e9</ns1:note></ns1:award>")))
            .otherwise(record)
        )
        orders = fixtures.table(spark, sf_dir, "orders").withColumn("amount", F.col("o_totalprice").cast("string"))
        rows = orders.select(F.concat(F.lit('<r xmlns:ns1="urn:awards">'), text, F.lit("</r>")).alias("value"))
        rows.write.text(path)

    folder = fixtures.once(spark, sf_dir, "xml-awkward", make)
    schema = "`ns1:PIID` string, `ns1:amount` string, `ns1:note` string"
    awards = read_awards(spark, f"{folder}/*.txt", T.StructType.fromDDL(schema), mode="records")
    # Of a torn record the text is left, and its number and amount can still be told.
    piid = F.coalesce("`ns1:PIID`", F.regexp_extract(CORRUPT, "<ns1:PIID>([0-9]+)<", 1)).cast("long")
    amount = F.coalesce("`ns1:amount`", F.regexp_extract(CORRUPT, "<ns1:amount>([0-9.]+)<", 1))
    names = F.array(*map(F.lit, ("plain", "spaced end", "section", "commented", "torn", "accents")))
    wrong_letters = (piid % 6 == 5) & F.col(CORRUPT).isNull() & (F.col("`ns1:note`") != "caf\u00e9")
    shape = F.when(wrong_letters, "garbled").otherwise(F.get(names, (piid % 6).cast("int")))
    return awards.groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("awards"),
        F.sum(amount.cast("decimal(18,2)")).alias("amount"),
        F.count(CORRUPT).alias("corrupt"),
    )


@check(
    """WITH block AS (SELECT *, o_orderkey // 500 AS block, min(o_orderkey) OVER (PARTITION BY o_orderkey // 500) AS first,
        count(*) OVER (PARTITION BY o_orderkey // 500) AS rows FROM orders)
    SELECT o_orderkey::varchar AS "PIID", o_totalprice::decimal(18,2)::double AS amount,
      CASE WHEN block % 3 = 2 THEN rows - 1 END AS records_in_note
    FROM block WHERE block % 3 = 0 OR (block % 3 = 2 AND o_orderkey = first)"""
)
def xml_scan_split_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments and sections of hundreds of records each, over the borders of some 40 splits."""
    path = f"{fixtures.section_files(spark, sf_dir)}/*.txt"
    name = "spark.sql.files.maxPartitionBytes"
    before, size = spark.conf.get(name), spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    records = scratch_dir(spark, "border-records")
    spark.conf.set(name, size // 40)
    try:
        award_records(spark, path).write.parquet(records)
    finally:
        spark.conf.set(name, before)
    schema = T.StructType.fromDDL("`ns1:PIID` string, `ns1:amount` string, `ns1:note` string")
    awards = parse_records(spark.read.parquet(records), schema).where(F.col(CORRUPT).isNull())
    return awards.select(
        F.col("`ns1:PIID`").alias("PIID"),
        F.col("`ns1:amount`").cast("decimal(18,2)").alias("amount"),
        F.regexp_count("`ns1:note`", F.lit("</ns1:award>")).cast("long").alias("records_in_note"),
    )


@check(CONTRACT_SQL)
def zip_expand_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards straight from zip archives, cut into records while unpacking."""
    rows = expand_archives(fixtures.award_archives(spark, sf_dir), row_tag=ROW_TAG)
    return _contracts(parse_records(rows.select("value", "error"), _schema(spark, sf_dir)))


@check(CONTRACT_SQL)
def zip_expand_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from zip files read in place, their members dealt out to the tasks."""
    folder = fixtures.archive_files(spark, sf_dir)
    rows = expand_large_archives(spark, f"{folder}/*.zip", row_tag=ROW_TAG)
    return _contracts(parse_records(rows.select("value", "error"), _schema(spark, sf_dir)))


@check("SELECT doc_id || '.txt' AS member, md5(text) AS content FROM documents")
def zip_expand_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = expand_archives(fixtures.document_archives(spark, sf_dir))
    return rows.select("member", F.md5("value").alias("content"))


@check(
    """SELECT doc_id || '.txt' AS member, md5(text) AS content, 'whole' AS archive FROM documents"""
)
def zip_expand_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every archive comes twice, once cut in half: of those nothing but a reject comes out."""
    whole = fixtures.document_archives(spark, sf_dir)
    half = F.substring("content", F.lit(1), (F.length("content") / 2).cast("int"))
    cut = whole.select(F.concat(F.lit("cut-"), "path").alias("path"), half.alias("content"))
    rows = expand_archives(whole.unionByName(cut))
    kind = F.when(F.col("archive").startswith("cut-"), "cut").otherwise("whole")
    known = F.col("error").isNull()
    # As many archives are rejected as are read, all of the cut ones, or a row is too much.
    counts = rows.groupBy(kind.alias("kind"), known.alias("known")).agg(F.count_distinct("archive").alias("n"))
    sums = counts.agg(
        F.sum(F.when((F.col("kind") == "cut") & ~F.col("known"), F.col("n"))).alias("rejected"),
        F.sum(F.when((F.col("kind") == "whole") & F.col("known"), F.col("n"))).alias("read"),
        F.count(F.lit(1)).alias("kinds"),
    )
    wrong = sums.where("rejected <> read OR kinds <> 2").select(
        F.lit(None).cast("string").alias("member"), F.lit(None).cast("string").alias("content"), F.lit("wrong").alias("archive")
    )
    return rows.where(known).select("member", F.md5("value").alias("content"), kind.alias("archive")).unionByName(wrong)


# Tidy anchors as SQL: comments and scripts out, then every anchor, its address and its text.
LINKS = r"""
anchor AS (
  SELECT page_id, url, unnest(regexp_extract_all(
    regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
    '(?is)<a\s.*?</a>')) AS a FROM pages),
link AS (
  SELECT page_id, url, regexp_extract(a, 'href="([^"]*)"', 1) AS href,
         nullif(regexp_extract(regexp_replace(a, '<[^>]*>', '', 'g'), '[A-Z0-9.\-]+', 0), '') AS label
  FROM anchor)"""


def _links(spark: SparkSession, sf_dir: str, tidy: bool = True) -> DataFrame:
    pages = fixtures.table(spark, sf_dir, "pages")
    return extract_links(pages, tidy=tidy, keep=("page_id", "url"))


@check(f"WITH {LINKS} SELECT page_id, href, label FROM link")
def links_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).drop("url")


@check(f"WITH {LINKS} SELECT page_id, href, label FROM link")
def links_from_pages_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir, tidy=False).drop("url")


@check(f"WITH {LINKS} SELECT page_id, href, label FROM link WHERE label IS NOT NULL")
def links_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(_links(spark, sf_dir)).drop("url")


@check(
    rf"""WITH {LINKS}, relative AS (
      SELECT page_id, href, label, substr(href, 2) AS below FROM link)
    SELECT page_id, href, 'https://site.example.org/root/' || below AS target,
      'https://site.example.org' || href AS rooted_target FROM relative"""
)
def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses without their leading slash go below the base; rooted ones below its site."""
    base = "https://site.example.org/root"
    links = _links(spark, sf_dir).select("page_id", "href")
    rooted = resolve_links(links, base).withColumnRenamed("target", "rooted_target")
    below = rooted.withColumnsRenamed({"href": "full"}).withColumn("href", F.expr("substr(full, 2)"))
    return resolve_links(below, base).select(
        "page_id", F.col("full").alias("href"), "target", "rooted_target"
    )


ARCHIVE = """
archive AS (
  SELECT 'https://index.example.org/b' || (s_suppkey // 5000) || '/' AS root,
         regexp_extract(r_name, '[A-Z0-9.\\-]+', 0) AS folder,
         '../' || place || '/' || replace(s_name, '#', '-') || '.v1.zip' AS href,
         'https://archive.example.org/' || place || '/' || replace(s_name, '#', '-') || '.v1.zip' AS target,
         replace(s_name, '#', '-') || '.v1' AS name, s_acctbal
  FROM (SELECT *, unnest(CASE WHEN s_suppkey % 10 = 0 THEN ['zips', 'old'] ELSE ['zips'] END) AS place FROM supplier)
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@check(f"WITH {ARCHIVE} SELECT DISTINCT root, folder, href FROM archive")
def index_three_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = store_links(fixtures.index_pages(spark, sf_dir), scratch_dir(spark, "links"))
    return walk_index(linked, fixtures.index_roots(spark, sf_dir))


@check(
    """WITH RECURSIVE most AS (SELECT max(s_suppkey) AS most FROM supplier),
    edge AS (
      SELECT s_suppkey AS a, 3 * s_suppkey + i AS b, 'F' || (3 * s_suppkey + i) AS label
        FROM supplier, most, (SELECT unnest([-1, 0, 1]) AS i) WHERE 3 * s_suppkey + i <= most AND 3 * s_suppkey + i > 1
      UNION ALL SELECT s_suppkey, (s_suppkey + 1) // 3, 'UP' FROM supplier
      UNION ALL SELECT s_suppkey, (s_suppkey * 7) % most + 1, 'ACROSS' FROM supplier, most),
    reach AS (
      SELECT NULL::varchar AS folder, 1::bigint AS page
      UNION
      SELECT coalesce(folder, label), b FROM reach JOIN edge ON page = a)
    SELECT DISTINCT coalesce(folder, 'ZIP') AS folder, 'a' || page || '.zip' AS href
    FROM reach WHERE page IN (SELECT s_suppkey FROM supplier)"""
)
def index_any_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages linked in circles, as deep as their number makes them: all archives that labelled links reach."""
    linked = store_links(fixtures.graph_pages(spark, sf_dir), scratch_dir(spark, "links"))
    base = f"{fixtures.SITE}/g/"
    roots = spark.createDataFrame([(f"{base}p1.html",)], "url string")
    return walk_all(linked, roots, scratch_dir(spark, "walk"), base=base).select("folder", "href")


@check(
    f"""WITH {ARCHIVE}, one AS (SELECT DISTINCT folder || '/' || name AS plain, target FROM archive),
    named AS (SELECT *, count(*) OVER (PARTITION BY plain) AS same_destination FROM one)
    SELECT CASE WHEN same_destination > 1 THEN plain || '-' || left(md5(target), 8) ELSE plain END AS destination,
      target, same_destination
    FROM named WHERE NOT plain IN
      (SELECT folder || '/' || name FROM archive WHERE s_acctbal < 1000)"""
)
def plan_downloads_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole index flow; archives of suppliers with a low balance have landed before."""
    nation, region = (fixtures.table(spark, sf_dir, name) for name in ("nation", "region"))
    landed = (
        fixtures.table(spark, sf_dir, "supplier")
        .where("s_acctbal < 1000")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(
                F.regexp_extract("r_name", "[A-Z0-9.\\-]+", 0),
                F.lit("/"),
                F.replace("s_name", F.lit("#"), F.lit("-")),
                F.lit(".v1"),
            ).alias("destination")
        )
    )
    return plan_downloads(
        fixtures.index_pages(spark, sf_dir),
        fixtures.index_roots(spark, sf_dir),
        landed,
        fixtures.ARCHIVE_SITE,
        scratch_dir(spark, "links"),
    )


@check(
    r"""SELECT url AS href, lang AS folder, url AS target,
      regexp_replace(list_last(string_split(url, '/')), '\.[^.]*$', '') AS name,
      lang || '/' || regexp_replace(list_last(string_split(url, '/')), '\.[^.]*$', '') AS destination
    FROM (SELECT url, regexp_extract(url, '//([^/]*)/', 1) AS lang FROM pages)"""
)
def archive_target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = fixtures.table(spark, sf_dir, "pages").select(
        F.col("url").alias("href"), F.regexp_extract("url", "//([^/]*)/", 1).alias("folder")
    )
    return archive_names(links, fixtures.ARCHIVE_SITE)


@check(
    """WITH named AS (SELECT lpad(o_custkey::varchar, 9, '0') AS plain, o_orderkey::varchar AS target,
        count(*) OVER (PARTITION BY o_custkey) AS same_destination, o_totalprice FROM orders),
    landed AS (SELECT target FROM named WHERE o_totalprice > 450000)
    SELECT CASE WHEN same_destination > 1 THEN plain || '-' || left(md5(target), 8) ELSE plain END AS destination,
      target, same_destination
    FROM named WHERE target NOT IN (SELECT target FROM landed)"""
)
def pending_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for archives, of which those of one customer share a name; none is lost."""
    orders = fixtures.table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("destination"),
        F.col("o_orderkey").cast("string").alias("target"),
        "o_totalprice",
    )
    return pending_archives(orders, orders.where("o_totalprice > 450000").select("target"))


@check(
    with_award(
        """SELECT 'first' AS seen_after, year, count(*) AS awards, sum(amount)::double AS amount
             FROM award WHERE year <= 1998 AND year <> 1996 GROUP BY year
           UNION ALL
           SELECT 'second', year, count(*), sum(amount)::double FROM award GROUP BY year"""
    )
)
def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; files land before each. The second adds the new files' awards only, among them
    files of 1996 with times long before those of the first run."""
    landing, target, state = (scratch_dir(spark, part) for part in ("landing", "landed", "state"))
    awards = fixtures.award_frame(spark, sf_dir)
    schema = awards.drop("year").schema
    late = F.col("year") == 1996
    seen = []
    for run, due in (("first", (F.col("year") <= 1998) & ~late), ("second", (F.col("year") > 1998) | late)):
        fixtures.write_xml(awards.where(due), landing)
        if run == "second":
            fixtures.set_old(spark, f"{landing}/year=1996/*/*.xml.snappy")
        ingest_new_files(spark, f"{landing}/year=*/*AWARD.xml", target, state, schema)
        seen.append(spark.read.parquet(target).withColumn("seen_after", F.lit(run)))
    date = F.col("`ns1:relevantContractDates`.`ns1:signedDate`")
    amount = F.col("`ns1:dollarValues`.`ns1:obligatedAmount`").cast("decimal(18,2)")
    rows = seen[0].unionByName(seen[1])
    return rows.groupBy("seen_after", F.year(date.cast("timestamp_ntz")).alias("year")).agg(
        F.count(F.lit(1)).alias("awards"), F.sum(amount).alias("amount")
    )


@check(
    with_award(
        """SELECT DISTINCT 'year=' || year AS folder, 'A-AWARD.xml' AS kind, true AS has_bytes
           FROM award"""
    )
)
def manifest_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = file_manifest(spark, fixtures.award_xml(spark, sf_dir), "*.xml.snappy")
    parts = F.split("path", "/")
    return files.groupBy(
        F.element_at(parts, -3).alias("folder"),
        F.regexp_replace(F.element_at(parts, -2), "^file=", "").alias("kind"),
    ).agg((F.min("length") > 0).alias("has_bytes"))


@check(
    r"""SELECT page_id, 'landing/' || regexp_extract(url, '[^/]*$', 0) AS landing_key,
      count(*) OVER (PARTITION BY regexp_extract(url, '[^/]*$', 0)) AS same_key FROM pages"""
)
def manifest_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.table(spark, sf_dir, "pages").select("page_id", "url")
    return landing_keys(pages, "landing", "url").drop("url")


@check(
    "SELECT doc_id, CASE WHEN strlen(text) > 256 THEN 'large' ELSE 'small' END AS size_class "
    "FROM documents"
)
def manifest_size_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents")
    return documents.select("doc_id", size_class(F.octet_length("text"), 256).alias("size_class"))


@check(with_award("SELECT count(DISTINCT year) AS years, true AS keys_flat FROM award"))
def landing_manifest_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fixtures.award_xml(spark, sf_dir)
    files = landing_manifest(spark, folder, "raw").where(F.col("path").endswith(".xml.snappy"))
    return files.agg(
        F.count_distinct(F.regexp_extract("path", "/year=([0-9]+)/", 1)).alias("years"),
        F.bool_and(F.col("landing_key").rlike("^raw/[^/]+$")).alias("keys_flat"),
    )
