"""Text expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as a link label, and the character references decoded in tidy markup.
LABEL_PATTERN = r"([A-Z0-9.\-]+)"
CHARACTER_REFERENCES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}


def truncate_utf8(name: str, width: int) -> Column:
    """Longest prefix of the named column of at most ``width`` bytes that ends between characters.

    Only the first ``width + 1`` characters are encoded, so the cost does not grow with the text.
    A byte from 80 to BF goes on with the character before it.
    """
    if width < 4:
        raise ValueError("a width below 4 bytes cannot hold every character")
    text = "`" + name.replace("`", "``") + "`"
    data = f"encode(substring({text}, 1, {width + 1}), 'UTF-8')"
    cases = " ".join(
        f"WHEN hex(substring({data}, {cut + 1}, 1)) NOT BETWEEN '80' AND 'BF' "
        f"THEN decode(substring({data}, 1, {cut}), 'UTF-8')"
        for cut in (width, width - 1, width - 2)
    )
    last = f"decode(substring({data}, 1, {width - 3}), 'UTF-8')"
    return F.expr(f"CASE WHEN octet_length({text}) <= {width} THEN {text} {cases} ELSE {last} END")


def link_label(text: Column) -> Column:
    """First run of capitals, digits, dots and dashes; null when there is none."""
    return F.nullif(F.regexp_extract(text, LABEL_PATTERN, 1), F.lit(""))


def decode_references(text: Column) -> Column:
    """Common character references replaced, ``&amp;`` last so nothing is decoded twice."""
    for reference, character in CHARACTER_REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def join_url(base: Column, href: Column) -> Column:
    """``href`` below ``base``; a rooted path below the base's site, a full address as it is."""
    slash = F.when(base.endswith("/"), F.lit("")).otherwise(F.lit("/"))
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?", 0)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?", 0)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .otherwise(F.concat(base, slash, href))
    )


def base_name(path: Column) -> Column:
    """Text after the last slash (empty for a path that ends in one)."""
    return F.substring_index(path, "/", -1)


def archive_stem(path: Column) -> Column:
    """File name without its last extension only: ``a/FY05-V1.4-x.zip`` gives ``FY05-V1.4-x``."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")
