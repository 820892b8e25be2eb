"""From stored index pages to the list of archives still to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contractlake.functions.text import archive_stem
from contractlake.operators.skew import spread_join
from contractlake.sources.pages import explode_links, labelled, page_links, resolve_links


def walk_index(linked: DataFrame, roots: DataFrame, depth: int = 3) -> DataFrame:
    """Archive links found ``depth`` pages deep: ``(root, folder, href)``, each once.

    ``linked`` has one row per stored page, ``(url, links)``; ``roots`` a column ``url``. Each
    level is a join of the distinct addresses reached so far with the pages. Joining whole pages
    keeps one row per address on that side, however many links the page has, and the distinct
    step means an address linked from everywhere is followed once. ``folder`` is the label of
    the first-level link (the year) the archive was found under.
    """
    front = roots.select(F.col("url").alias("root"), F.col("url").alias("target")).distinct()
    folder = F.lit(None).cast("string")
    for level in range(depth):
        pages = front.join(linked, front["target"] == linked["url"]).drop("url", "target")
        links = labelled(explode_links(pages))
        if level == 0:
            folder = F.col("label")
        links = links.withColumn("folder", folder).where(F.col("href").isNotNull())
        folder = F.col("folder")
        if level == depth - 1:
            return links.select("root", "folder", "href").distinct()
        front = resolve_links(links, F.col("root")).select("root", "folder", "target").distinct()
    raise ValueError("depth must be at least 1")


# Fixed value: what the address of an archive ends with.
ARCHIVE = r"(?i)\.zip$"


def walk_all(
    linked: DataFrame,
    roots: DataFrame,
    path: str,
    archive: str = ARCHIVE,
    base: str | None = None,
    max_rounds: int = 1000,
) -> DataFrame:
    """Archive links on all pages that labelled links reach, at any depth: ``(root, folder, href)``, each once.

    As :func:`walk_index`, but which links are archives is told by their address, and the walk
    goes on until no page is new. Addresses are joined to the root's, or to ``base``. ``folder`` is the label of the link by which the walk left the root page (an
    archive on that page stands under its own label); a page that several of them lead to is followed
    once for each. Pages may link back and in circles. Every round joins only the addresses that are new with
    the pages, and writes them below ``path``: what has been seen lies there and not on the
    driver, which learns of each round whether it found anything.
    """
    spark = linked.sparkSession
    seen_as = "root string, folder string, target string"
    start = roots.select(F.col("url").alias("root"), F.lit(None).cast("string").alias("folder"), F.col("url").alias("target"))
    start.distinct().write.parquet(f"{path}/round=0")

    def links_of(front: DataFrame) -> DataFrame:
        pages = front.join(linked, front["target"] == linked["url"]).drop("url", "target")
        links = labelled(explode_links(pages)).where(F.col("href").isNotNull())
        return links.withColumn("folder", F.coalesce("folder", "label"))

    for number in range(1, max_rounds + 1):
        front = spark.read.schema(seen_as).parquet(f"{path}/round={number - 1}")
        if front.isEmpty():
            break
        onward = links_of(front).where(~F.col("href").rlike(archive))
        reached = resolve_links(onward, F.col("root") if base is None else base).select("root", "folder", "target").distinct()
        seen = spark.read.schema(seen_as).parquet(*[f"{path}/round={n}" for n in range(number)])
        new = reached.join(seen, ["root", "folder", "target"], "left_anti")
        new.write.parquet(f"{path}/round={number}")
    else:
        raise RuntimeError(f"new pages were still found after {max_rounds} rounds")
    everything = spark.read.schema(seen_as).parquet(*[f"{path}/round={n}" for n in range(number)])
    return links_of(everything).where(F.col("href").rlike(archive)).select("root", "folder", "href").distinct()


def archive_names(links: DataFrame, base: str) -> DataFrame:
    """Add where to fetch an archive (``target``), its ``name`` and its ``destination`` folder."""
    named = resolve_links(links, base, archives=True).withColumn("name", archive_stem(F.col("href")))
    return named.withColumn("destination", F.concat_ws("/", "folder", "name"))


def pending_archives(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Archives not landed yet: ``destination``, ``target``, ``same_destination``, one row per target.

    Targets that would land under one name (``same_destination`` of them) get a name of their own,
    with a part of the target's digest, so none takes the place of another. ``done`` has a column
    ``target`` or ``destination``; of the latter both the plain and the own names count. A
    target whose name collides only from some later day on may be fetched once more, never less.
    """
    one = candidates.select(F.col("destination").alias("plain"), "target").distinct()
    counts = one.groupBy("plain").agg(F.count(F.lit(1)).alias("same_destination"))
    counted = spread_join(one, counts.where("same_destination > 1"), "plain")
    own = F.concat_ws("-", "plain", F.substring(F.md5("target"), 1, 8))
    named = counted.withColumn("same_destination", F.coalesce("same_destination", F.lit(1))).withColumn(
        "destination", F.when(F.col("same_destination") > 1, own).otherwise(F.col("plain"))
    )
    if "target" in done.columns:
        left = named.join(done.select("target").distinct(), "target", "left_anti")
    else:
        known = done.select("destination").distinct()
        left = named.join(known, "destination", "left_anti")
        left = left.join(known.withColumnRenamed("destination", "plain"), "plain", "left_anti")
    return left.select("destination", "target", "same_destination")


def store_links(pages: DataFrame, path: str, tidy: bool | None = None) -> DataFrame:
    """Links of all pages, one row per address: those of every version that was stored of it.

    Extracted once and written to ``path``: the levels of the walk then join this narrow table
    instead of reading all HTML once per level. Equal links are one before a page's links are
    gathered, so a page stored any number of times is as long as its different links.
    """
    links = page_links(pages, tidy=tidy).select("url", F.inline("links")).distinct()
    linked = links.groupBy("url").agg(F.collect_list(F.struct("href", "text")).alias("links"))
    linked.write.mode("error").parquet(path)
    return pages.sparkSession.read.parquet(path)


def missing_pages(linked: DataFrame, roots: DataFrame, depth: int = 3) -> DataFrame:
    """``(root, target)`` of labelled links above the last level that lead to no stored page."""
    front = roots.select(F.col("url").alias("root"), F.col("url").alias("target")).distinct()
    known = linked.select(F.col("url").alias("target"))
    missing = front.join(known, "target", "left_anti")
    for _ in range(depth - 1):
        pages = front.join(linked, front["target"] == linked["url"]).drop("url", "target")
        links = labelled(explode_links(pages)).where(F.col("href").isNotNull())
        front = resolve_links(links, F.col("root")).select("root", "target").distinct()
        missing = missing.union(front.join(known, "target", "left_anti").select(*missing.columns))
    return missing.select("root", "target").distinct()


def plan_downloads(
    pages: DataFrame,
    roots: DataFrame,
    done: DataFrame,
    archive_base: str,
    linked_path: str,
    tidy: bool | None = None,
    depth: int = 3,
) -> DataFrame:
    """Archives to fetch: walk the stored index pages and leave out what has landed.

    ``linked_path`` is a new folder for the links of the pages (see :func:`store_links`); what
    :func:`missing_pages` finds in it are pages still to be stored.
    """
    linked = store_links(pages, linked_path, tidy)
    found = archive_names(walk_index(linked, roots, depth), archive_base)
    return pending_archives(found, done)
