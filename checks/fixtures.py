"""Award data made by Spark from the order tables: nested frames, XML files, zips, index pages.

Test support. Everything is derived from whole tables, so its size follows theirs.
"""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from contractlake.functions.keys import award_key
from contractlake.operators.rejects import apply_types
from contractlake.plans.tables import TYPES, contract_projection, vendor_table
from contractlake.session import qualified, scratch_dir
from contractlake.sinks.tables import write_contract, write_vendor
from contractlake.sources.archives import shared_store
from contractlake.sources.awards import ROW_TAG, award_records

ROOT_TAG = 'ns1:awards xmlns:ns1="urn:awards"'
AWARD_DIR = "A-AWARD.xml"
SITE = "https://index.example.org"
ARCHIVE_SITE = "https://archive.example.org/"
PAGE_LINKS = 5000
# Records of an XML file at most, and files that a task has open at once.
XML_RECORDS = 50_000
OPEN_FILES = 32
# Tasks per core that write XML.
WAVES = 3
# Characters of text in an archive, from which on another one is begun.
ARCHIVE_CHARS = 1 << 22

_made: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, kind: str, make: Callable[[str], object]) -> str:
    """Folder of this kind for this application and data, made at the first call."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _made:
        path = scratch_dir(spark, kind)
        make(path)
        _made[key] = path
    return _made[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def award_frame(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    """One nested award per order, every leaf text, and the ``year`` it was signed in.

    Where customers are too many to broadcast, adaptive execution splits the join's partition of
    a customer with very many orders. ``even`` deals orders out where splits are about as many as
    cores: what is dear to write should not wait for the task with the most row groups.
    """
    orders = table(spark, sf_dir, "orders")
    tasks, splits = spark.sparkContext.defaultParallelism, orders.rdd.getNumPartitions()
    if splits * 4 <= tasks:  # a small table is one split
        orders = orders.repartition(tasks)
    elif even and splits < WAVES * tasks:
        orders = orders.repartition(WAVES * tasks)
    customer = table(spark, sf_dir, "customer")
    order_key = F.col("o_orderkey").cast("string")
    award_id = F.struct(
        order_key.alias("ns1:PIID"),
        F.lpad((F.col("o_orderkey") % 25).cast("string"), 4, "0").alias("ns1:agencyID"),
        F.lit("0").alias("ns1:modNumber"),
        F.lit("00").alias("ns1:transactionNumber"),
    )
    vehicle = F.struct(
        F.lit("IDV").alias("ns1:PIID"),
        F.lit("9700").alias("ns1:agencyID"),
        F.lit("0").alias("ns1:modNumber"),
    )
    site = F.struct(
        F.struct(F.col("c_nationkey").cast("string").alias("ns1:countryCode")).alias(
            "ns1:vendorLocation"
        ),
        F.struct(F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("ns1:DUNSNumber")).alias(
            "ns1:vendorDUNSInformation"
        ),
    )
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.struct(
            award_id.alias("ns1:awardContractID"),
            F.when(F.col("o_orderkey") % 3 == 0, vehicle).alias("ns1:referencedIDVID"),
        ).alias("ns1:awardID"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ns1:signedDate")
        ).alias("ns1:relevantContractDates"),
        F.struct(F.col("o_totalprice").cast("string").alias("ns1:obligatedAmount")).alias(
            "ns1:dollarValues"
        ),
        F.struct(
            F.col("o_orderstatus").alias("ns1:productOrServiceCode"),
            F.split("o_orderpriority", "-").alias("ns1:tag"),
        ).alias("ns1:contractData"),
        F.struct(
            F.struct(
                F.col("c_name").alias("ns1:vendorName"),
                F.col("o_orderpriority").alias("ns1:vendorAlternateName"),
            ).alias("ns1:vendorHeader"),
            site.alias("ns1:vendorSiteDetails"),
        ).alias("ns1:vendor"),
        F.year("o_orderdate").alias("year"),
    )


def with_duns(awards: DataFrame, duns: Column) -> DataFrame:
    """Awards with another DUNS number."""
    vendor = F.col("`ns1:vendor`")
    site = vendor["ns1:vendorSiteDetails"]
    return awards.withColumn(
        "ns1:vendor",
        vendor.withField(
            "`ns1:vendorSiteDetails`",
            site.withField(
                "`ns1:vendorDUNSInformation`", F.struct(duns.alias("ns1:DUNSNumber"))
            ),
        ),
    )


def write_xml(awards: DataFrame, path: str, file: Column | None = None, plain: bool = False) -> None:
    """Awards as XML with attributes, ``<path>/year=YYYY/file=<file>/``; appends.

    The files are not indented. They are compressed and hold a bounded number of records, as a
    compressed file is one split; ``plain`` files are of any size and are read in splits. Tasks keep
    a file open per folder rather than sort wide rows by folder.
    """
    award_id = F.col("`ns1:awardID`")
    contract_id = award_id["ns1:awardContractID"]
    agency = F.struct(contract_id["ns1:agencyID"].alias("_VALUE"), F.lit("N").alias("_name"))
    marked = awards.withColumns(
        {
            "ns1:awardID": award_id.withField(
                "`ns1:awardContractID`", contract_id.withField("`ns1:agencyID`", agency)
            ),
            "_version": F.lit("1.4"),
            "file": F.lit(AWARD_DIR) if file is None else file,
        }
    )
    writer = (
        marked.write.mode("append")
        .partitionBy("year", "file")
        .format("xml")
        .option("rowTag", ROW_TAG)
        .option("rootTag", ROOT_TAG)
        .option("validateName", "false")
        .option("indent", "")
        .options(**{} if plain else {"compression": "snappy", "maxRecordsPerFile": XML_RECORDS})
    )
    conf, name = awards.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FILES)
    try:
        writer.save(path)
    finally:
        conf.set(name, before)


# Records of a file that is written under a name of its own.
FILE_RECORDS = 2000


def write_versions(spark: SparkSession, sf_dir: str, path: str, version: int) -> None:
    """Award files with names of their own, compressed, a file per some 2000 orders.

    The first version has every second file, with amounts, dates and names that are wrong, and with
    awards under numbers that are none; the next one has all files as they should be, so half of
    them take the place of others.
    """
    folder = qualified(spark, path)
    records = award_records(spark, all_award_files(award_xml(spark, sf_dir))).select("value")
    piid = F.regexp_extract("value", "<ns1:PIID>([0-9]+)<", 1).cast("long")
    files = table(spark, sf_dir, "orders").count() // FILE_RECORDS + 2
    dealt = records.withColumn("file", F.pmod(F.xxhash64(piid), F.lit(files)))
    if version == 0:
        wrong = F.regexp_replace("value", "<ns1:obligatedAmount>[^<]*<", "<ns1:obligatedAmount>1.00<")
        wrong = F.regexp_replace(wrong, "<ns1:signedDate>[0-9]{4}", "<ns1:signedDate>2032")
        wrong = F.regexp_replace(wrong, "<ns1:vendorName>", "<ns1:vendorName>Not ")
        none = F.regexp_replace(F.regexp_replace(wrong, "<ns1:PIID>", "<ns1:PIID>X"), "<ns1:DUNSNumber>0", "<ns1:DUNSNumber>9")
        old = dealt.where("file % 2 = 0").select("file", wrong.alias("value"), none.alias("other"))
        dealt = old.select("file", F.explode(F.array("value", "other")).alias("value"))

    def save(group: pd.DataFrame) -> pd.DataFrame:
        store, name = shared_store(folder)
        store.create_dir(name, recursive=True)
        file = f"{group['file'].iloc[0]}-AWARD.xml.gz"
        text = "\n".join(['<?xml version="1.0"?>', f"<{ROOT_TAG}>", *sorted(group["value"]), f"</{ROOT_TAG.split()[0]}>"])
        with store.open_output_stream(f"{name}/{file}", compression=None) as out:
            out.write(gzip.compress(text.encode(), 1))
        return pd.DataFrame({"file": [file]})

    dealt.groupBy("file").applyInPandas(save, "file string").write.format("noop").mode("overwrite").save()


def section_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders as records in files in which whole blocks of 500 keys are commented out, or are text
    in a section of the block's first record."""

    def make(path: str) -> None:
        key, block = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 500)
        orders = table(spark, sf_dir, "orders").select(
            key, block.alias("block"), F.col("o_totalprice").cast("string").alias("amount")
        )
        ends = Window.partitionBy("block")
        first, last = key == F.min(key).over(ends), key == F.max(key).over(ends)
        body = F.concat(F.lit("<ns1:award><ns1:PIID>"), key, F.lit("</ns1:PIID><ns1:amount>"), "amount", F.lit("</ns1:amount>"))
        plain = F.concat(body, F.lit("</ns1:award>"))
        commented = F.concat(F.when(first, "<!-- ").otherwise(""), plain, F.when(last, " -->").otherwise(""))
        end = F.lit("]]></ns1:note></ns1:award>")
        inside = (
            F.when(first, F.concat(body, F.lit("<ns1:note><![CDATA["), F.when(last, end).otherwise("")))
            .when(last, F.concat(plain, end))
            .otherwise(plain)
        )
        kind = F.col("block") % 3
        text = F.when(kind == 1, commented).when(kind == 2, inside).otherwise(plain)
        rows = orders.select("block", "o_orderkey", text.alias("value"))
        rows.repartitionByRange("block").sortWithinPartitions("block", "o_orderkey").select("value").write.text(path)

    return once(spark, sf_dir, "sections", make)


def set_old(spark: SparkSession, pattern: str) -> None:
    """Give files the time of a copy that kept that of long ago."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path):
        fs.setTimes(status.getPath(), 1_000_000_000_000, -1)


def award_xml(spark: SparkSession, sf_dir: str, plain: bool = False) -> str:
    """Folder with all awards as XML, one folder per year; ``plain`` in files that can be split."""
    kind = "xml-plain" if plain else "xml"
    return once(spark, sf_dir, kind, lambda path: write_xml(award_frame(spark, sf_dir, even=True), path, plain=plain))


def all_award_files(folder: str) -> str:
    return f"{folder}/year=*/*AWARD.xml"


def keyed_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return award_key(award_frame(spark, sf_dir))


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the contract and vendor tables of all years."""

    def make(path: str) -> None:
        awards = keyed_awards(spark, sf_dir)
        write_contract(apply_types(contract_projection(awards), TYPES), path)
        write_vendor(vendor_table(awards, per=("year",)), path)

    return once(spark, sf_dir, "lake", make)


def blank_vendor_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Contract and vendor tables in which awards of one status have a blank vendor number."""

    def make(path: str) -> None:
        awards = keyed_awards(spark, sf_dir)
        product = F.col("`ns1:contractData`")["ns1:productOrServiceCode"]
        duns = F.col("`ns1:vendor`.`ns1:vendorSiteDetails`")["ns1:vendorDUNSInformation"]["ns1:DUNSNumber"]
        awards = with_duns(awards, F.when(product == "P", F.lit(" ")).otherwise(duns))
        write_contract(apply_types(contract_projection(awards), TYPES), path)
        write_vendor(vendor_table(awards, per=("year",)), path)

    path = once(spark, sf_dir, "blank-vendors", make)
    return spark.read.parquet(f"{path}/contract"), spark.read.parquet(f"{path}/vendor")


def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{lake(spark, sf_dir)}/contract")


def vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{lake(spark, sf_dir)}/vendor")


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of ``(member, text)``, another one from ``ARCHIVE_CHARS`` characters on; members of
    one name are joined. Texts leave the batch one by one, so no copy of it is made."""
    partition, number = TaskContext.get().partitionId(), 0

    def archive(members: dict[str, list[str]]) -> pa.RecordBatch:
        nonlocal number
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as made:
            for member, texts in members.items():
                made.writestr(member, "".join(texts))
        number += 1
        return pa.RecordBatch.from_pydict({"path": [f"{partition}-{number - 1}.zip"], "content": [content.getvalue()]})

    for batch in batches:
        members: dict[str, list[str]] = {}
        chars = 0
        for member, text in zip(batch.column("member"), batch.column("text")):
            if not member.is_valid:
                continue
            members.setdefault(member.as_py(), []).append(text.as_py())
            chars += len(members[member.as_py()][-1])
            if chars >= ARCHIVE_CHARS:
                yield archive(members)
                members, chars = {}, 0
        if members:
            yield archive(members)


def award_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The award XML as ``(member, text)``, many records per member."""
    return award_records(spark, all_award_files(award_xml(spark, sf_dir))).select(
        F.concat(F.pmod(F.xxhash64("value"), F.lit(8)), F.lit("-AWARD.xml")).alias("member"),
        F.concat("value", F.lit("\n")).alias("text"),
    )


def award_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip archives ``(path, content)`` of the award XML."""
    records = award_members(spark, sf_dir)
    return records.mapInArrow(_zip, "path string, content binary")


def archive_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the award archives as zip files, each written by the task that made it."""

    def make(path: str) -> None:
        folder = qualified(spark, path)

        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, name = shared_store(folder)
            store.create_dir(name, recursive=True)
            for batch in _zip(batches):
                for file, content in zip(batch.column("path"), batch.column("content")):
                    with store.open_output_stream(f"{name}/{file}") as out:
                        out.write(content.as_buffer())
                yield batch.select(["path"])

        saved = award_members(spark, sf_dir).mapInArrow(save, "path string")
        saved.write.format("noop").mode("overwrite").save()

    return once(spark, sf_dir, "zips", make)


def add_member(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Copies of the archives with one more award member, whose bytes are no text."""
    store, name = shared_store(folder)
    store.create_dir(name, recursive=True)
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            copy = io.BytesIO(content.as_py())
            with zipfile.ZipFile(copy, "a", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("broken-AWARD.xml", b"<ns1:award>\xff\xfe</ns1:award>")
            with store.open_output_stream(f"{name}/{path.as_py().rsplit('/', 1)[-1]}") as out:
                out.write(copy.getbuffer())
        yield batch.select(["path"])


def document_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip archives with one member per document, named by its id."""
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), "text"
    )
    return documents.mapInArrow(_zip, "path string, content binary")


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages ``(url, html)`` of three-level indexes: region, nation, one zip per supplier.

    There is one index per block of ``PAGE_LINKS`` supplier keys. Keys are unique, so no page
    lists more than twice as many links, however many suppliers there are. The first level has
    rooted links, the anchors of the second are never closed, every tenth supplier has a second
    archive of the same name in another folder, and each page is stored in two versions with
    different links.
    """
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    block = F.concat(F.lit("/b"), F.floor(F.col("s_suppkey") / PAGE_LINKS).cast("string"), F.lit("/"))
    rows = table(spark, sf_dir, "supplier").withColumn("site", block)
    rows = rows.withColumn("root", F.concat(F.lit(SITE), "site"))
    rows = rows.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))

    def anchor(href: Column, label: Column, end: str = "</a></li>") -> Column:
        return F.concat(F.lit('<li><a href="'), href, F.lit('">'), label, F.lit(end))

    def pages(links: DataFrame) -> DataFrame:
        body = F.array_join(F.sort_array(F.collect_list("link")), "\n")
        html = F.concat(
            F.lit('<html><body><a href="../">up</a><ul>'), body, F.lit("</ul></body></html>")
        )
        versions = links.distinct().withColumn("version", F.pmod(F.xxhash64("link"), F.lit(2)))
        return versions.groupBy("url", "version").agg(html.alias("html")).drop("version")

    region = F.concat(F.lit("r"), F.col("r_regionkey").cast("string"), F.lit(".html"))
    country = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".html"))
    name = F.concat(F.replace("s_name", F.lit("#"), F.lit("-")), F.lit(".v1.zip"))
    archives = rows.select(
        F.concat("root", country).alias("url"), anchor(F.concat(F.lit("../zips/"), name), F.col("s_name")).alias("link")
    ).unionByName(
        rows.where("s_suppkey % 10 = 0").select(
            F.concat("root", country).alias("url"), anchor(F.concat(F.lit("../old/"), name), F.col("s_name")).alias("link")
        )
    )
    levels = (
        rows.select(F.col("root").alias("url"), anchor(F.concat("site", region), F.col("r_name")).alias("link")),
        rows.select(F.concat("root", region).alias("url"), anchor(country, F.col("n_name"), "").alias("link")),
        archives,
    )
    return pages(levels[0]).unionByName(pages(levels[1])).unionByName(pages(levels[2]))


def index_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.floor(F.col("s_suppkey") / PAGE_LINKS).cast("string")
    url = F.concat(F.lit(f"{SITE}/b"), block, F.lit("/")).alias("url")
    return table(spark, sf_dir, "supplier").select(url).distinct()


def graph_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages ``(url, html)``, one per supplier key: links down a tree of three branches, up again,
    across, and to an archive; so pages are linked in circles, and the deepest lie as many levels
    down as the tree has."""
    suppliers = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    most = suppliers.agg(F.max(key).alias("most"))
    # One row, the largest key, beside every supplier.
    rows = suppliers.select(key).join(F.broadcast(most))

    def anchor(to: Column, label: Column) -> Column:
        return F.concat(F.lit('<li><a href="p'), to.cast("string"), F.lit('.html">'), label, F.lit("</a></li>"))

    down = F.filter(F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: 3 * key + i), lambda c: (c <= F.col("most")) & (c > 1))
    links = F.concat(
        F.transform(down, lambda c: anchor(c, F.concat(F.lit("F"), c.cast("string")))),
        F.array(
            anchor(F.floor((key + 1) / 3), F.lit("UP")),
            anchor((key * 7) % F.col("most") + 1, F.lit("ACROSS")),
            anchor(key + 1, F.lit("next page")),
            F.concat(F.lit('<li><a href="a'), key.cast("string"), F.lit('.zip">ZIP</a></li>')),
        ),
    )
    html = F.concat(F.lit("<html><body><ul>"), F.array_join(links, "\n"), F.lit("</ul></body></html>"))
    return rows.select(F.concat(F.lit(f"{SITE}/g/p"), key.cast("string"), F.lit(".html")).alias("url"), html.alias("html"))


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as a repeated element, and in each line its flags as another one."""
    lines = table(spark, sf_dir, "lineitem")
    flags = F.array("l_returnflag", "l_linestatus")
    line = F.struct(
        F.col("l_linenumber").cast("long").alias("number"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("quantity"),
        F.struct(F.transform(flags, lambda f: F.struct(f.alias("code"))).alias("flag")).alias("flags"),
    )
    grouped = lines.groupBy(F.col("l_orderkey").alias("order")).agg(F.sort_array(F.collect_list(line)).alias("line"))
    return grouped.select("order", F.struct("line").alias("lines"))
