"""Links of HTML pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contractlake.functions.text import CHARACTER_REFERENCES, decode_references, join_url, link_label

LINK = T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])

# Fixed value: pages whose text and links are objects of Python at once.
PARSED_AT_ONCE = 64
# Patterns of tidy markup.
UNSHOWN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR = r"(?is)<a[\s>].*?</a>"
HREF = r"""(?is)^<a(?:\s[^>]*?)?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _anchors(html: Column) -> Column:
    def link(anchor: Column) -> Column:
        values = [F.regexp_extract(anchor, HREF, group) for group in (1, 2, 3)]
        href = F.when(anchor.rlike(HREF), decode_references(F.concat(*values)))
        text = decode_references(F.regexp_replace(anchor, "<[^>]*>", ""))
        return F.struct(href.alias("href"), text.alias("text"))

    shown = F.regexp_replace(html, UNSHOWN, "")
    return F.transform(F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(0)), link)


class _LinkParser(HTMLParser):
    """Collects ``(href, text)`` per anchor, in order of the start tags; anchors may nest."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[list] = []
        self._open: list[list] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            link = [dict(attrs).get("href"), ""]
            self.links.append(link)
            self._open.append(link)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self._open:
            self._open.pop()

    def handle_data(self, data: str) -> None:
        for link in self._open:
            link[1] += data


@F.arrow_udf(T.ArrayType(LINK))
def _parsed_anchors(pages: pa.Array) -> pa.Array:
    """Links of a batch of pages, of which only some are text and objects of Python at a time."""

    def links(html: str | None) -> list[dict]:
        parser = _LinkParser()
        parser.feed(html or "")
        parser.close()
        return [{"href": href, "text": text} for href, text in parser.links]

    kind = pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))
    parts = [pages.slice(at, PARSED_AT_ONCE) for at in range(0, len(pages), PARSED_AT_ONCE)]
    return pa.concat_arrays([pa.array([], kind), *(pa.array(map(links, part.to_pylist()), kind) for part in parts)])


def _untidy(html: Column) -> Column:
    """Whether the patterns may miss something: anchors that nest or stay open, ``>`` within an
    attribute, comments or scripts that stay open, character references the patterns don't know."""
    shown = F.regexp_replace(html, UNSHOWN, "")
    anchors = F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(0))
    starts = F.regexp_count(shown, F.lit(r"(?i)<a[\s>/]"))
    odd = shown.rlike(r"""(?is)<!--|<(script|style|textarea|title)\b[^>]*>(?!.*</\1)|<[a-z][^<>]*=\s*("[^"]*[<>][^"]*"|'[^']*[<>][^']*')""")
    known = "|".join(reference[1:-1] for reference in CHARACTER_REFERENCES)
    rare = F.exists(anchors, lambda anchor: anchor.rlike(rf"&(?!(?:{known});)[A-Za-z#]"))
    return F.coalesce((starts != F.size(anchors)) | odd | rare, F.lit(False))


def page_links(
    pages: DataFrame,
    html_col: str = "html",
    tidy: bool | None = None,
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """One row per page: the kept columns and ``links``, an array of ``(href, text)``.

    Tidy pages are read with patterns inside the JVM, the others are parsed; the markup of each
    page decides. ``tidy`` set to True or False takes one way for all pages.
    """
    html = F.col(html_col)
    if tidy is not None:
        links = _anchors(html) if tidy else _parsed_anchors(html)
        return pages.select(*keep, links.alias("links"))
    # The parser is handed the untidy pages only: the others are null on its side.
    marked = pages.select(*keep, html.alias("_html"), _untidy(html).alias("_untidy"))
    parsed = _parsed_anchors(F.when(F.col("_untidy"), F.col("_html")))
    links = F.when(F.col("_untidy"), parsed).otherwise(_anchors(F.col("_html")))
    return marked.select(*keep, links.alias("links"))


def explode_links(linked: DataFrame) -> DataFrame:
    """One row per link with ``href`` and ``label`` (null when the text has none)."""
    others = [name for name in linked.columns if name != "links"]
    return linked.select(*others, F.inline("links")).select(
        *others, "href", link_label(F.col("text")).alias("label")
    )


def extract_links(
    pages: DataFrame,
    html_col: str = "html",
    tidy: bool | None = None,
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """All anchors of all pages: the kept columns, ``href`` and ``label``."""
    return explode_links(page_links(pages, html_col, tidy, keep))


def labelled(links: DataFrame) -> DataFrame:
    """Links that lead on: those with a label."""
    return links.where(F.col("label").isNotNull())


def resolve_links(links: DataFrame, base: str | Column, archives: bool = False) -> DataFrame:
    """Add ``target``; links without ``href`` are dropped.

    The base is that of the whole site, on deeper pages too. For ``archives`` every ``../`` is
    taken out of the address first.
    """
    base = F.lit(base) if isinstance(base, str) else base
    href = F.replace(F.col("href"), F.lit("../"), F.lit("")) if archives else F.col("href")
    return links.where(F.col("href").isNotNull()).withColumn("target", join_url(base, href))
