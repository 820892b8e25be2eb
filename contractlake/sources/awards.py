"""Award records from XML files.

One reader cuts any file, whatever its size, into whole records: the text is read in splits at the
end tag. Every start tag outside of comments and CDATA sections gives one row, good or marked
corrupt with its text and file, so nothing disappears and nothing commented out is loaded. A bad
record costs only itself. ``files`` uses the XML source instead: one task per file, and a record
that is not well-formed costs the rest of its file.

A first scan tells three kinds of files apart. In tidy ones every piece between end tags is one
record with what stands before it, and is cut by column expressions. In others the pieces of a split,
which come in order, go through a cutter. Where a section holds end tags it may lie across the
border of splits: such files are staged, every split says what it makes of each state it might begin
in, these few bytes tell in order how each one does begin, and what belongs to a record over a
border is put together afterwards.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from encodings.aliases import aliases
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from contractlake.session import scratch_dir
from contractlake.sources.files import file_shares

# Row element, file pattern and the column for text that is no record.
ROW_TAG = "ns1:award"
FILE_PATTERN = "*AWARD.xml"
CORRUPT = "_corrupt_record"

XML_OPTIONS = {
    "excludeAttribute": "true",
    "inferSchema": "false",
    "nullValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}

RECORDS = "file string, value string, error string"
DECLARED = re.compile(r"^\ufeff?<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9._\-]+)")


def award_files(folder: str, pattern: str = FILE_PATTERN) -> str:
    """The award files of one folder; other record files beside them do not match."""
    return f"{folder.rstrip('/')}/{pattern}"


def with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_awards(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    mode: str = "files",
    row_tag: str = ROW_TAG,
    infer_types: bool = False,
    encoding: str = "utf-8",
    source: str | None = None,
) -> DataFrame:
    """One row per ``row_tag`` element; attributes left out, empty text null, leaves as text.

    Without a ``schema`` a first pass over all files finds the elements. ``infer_types`` also
    guesses types and then loses leading zeros. The ``_corrupt_record`` column is null for a
    record that was read. ``mode`` is ``files`` or ``records``; ``encoding`` is that of the files
    in the latter, the XML source goes by their declaration. ``source`` names a last column for the
    file of a record; many compressed files are read in shares, of which ``_metadata`` is not known.
    """
    if mode == "records":
        records = award_records(spark, path, row_tag, encoding)
        awards = parse_records(records, schema or discover_schema(records))
        if source is None:
            return awards.drop("file")
        return awards.select(*[F.col(f"`{name}`") for name in awards.columns if name != "file"], F.col("file").alias(source))
    if mode != "files":
        raise ValueError(f"unknown mode {mode!r}")
    reader = spark.read.format("xml").options(**XML_OPTIONS).option("rowTag", row_tag)
    if infer_types:
        reader = reader.option("inferSchema", "true")
    shares = file_shares(spark, path)
    if schema is None:
        schema = _found_schema(reader, shares)
    reader = reader.schema(with_corrupt(schema))
    file = [F.col("_metadata.file_path").alias(source)] if source else []
    return reduce(DataFrame.union, [reader.load(share).select("*", *file) for share in shares])


def _found_schema(reader: DataFrameReader, shares: list[str | list[str]]) -> T.StructType:
    """Element tree of all files; the trees of shares are found at the same time and put together.

    Where one share has an element of another type than another share, a pass over all files decides.
    """
    with ThreadPoolExecutor(len(shares)) as pool:
        found = list(pool.map(lambda share: reader.load(share).schema, shares))
    whole: T.DataType | None = found[0]
    for other in found[1:]:
        whole = None if whole is None else _joined(whole, other)
    return reader.load([path for share in shares for path in share]).schema if whole is None else whole


def _joined(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type of an element that has both types, None if they do not tell it."""
    if isinstance(one, T.ArrayType) or isinstance(other, T.ArrayType):
        element = _joined(*(t.elementType if isinstance(t, T.ArrayType) else t for t in (one, other)))
        return None if element is None else T.ArrayType(element)
    if not (isinstance(one, T.StructType) and isinstance(other, T.StructType)):
        return one if one == other else None
    types = {field.name: field.dataType for field in one.fields}
    for field in other.fields:
        types[field.name] = _joined(types[field.name], field.dataType) if field.name in types else field.dataType
    if None in types.values() or len({name.lower() for name in types}) < len(types):
        return None
    return T.StructType([T.StructField(name, types[name]) for name in sorted(types)])


UNENDED = "a comment or section does not end"
DECLARES = "the file declares"


def part_lost(error: Column) -> Column:
    """Whether the error of a record says that more of its file than this record was not read."""
    return F.coalesce(error.startswith(DECLARES) | (error == UNENDED), F.lit(False))


class RecordCutter:
    """Takes the pieces of a text between literal end tags, in order, and gives whole records.

    ``take`` returns ``(record, error)`` pairs; ``error`` says why a record is none. What is no
    record (prolog, root element, blanks, comments) gives nothing. Of a section that never ends the
    text up to the next end tag is given, with the record it lies in.
    """

    def __init__(self, row_tag: str, closing: str | None = None, in_record: bool = False) -> None:
        tag = re.escape(row_tag)
        self.end_tag = f"</{row_tag}>"
        attributes = r"""(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*)?"""
        # In sections and comments tags are text; all else that looks like one is one.
        self.token = re.compile(rf"(?s)<!--|<!\[CDATA\[|<{tag}{attributes}/?>|</{tag}\s*>")
        self.start = re.compile(rf"<{tag}[\s/>]")
        # The section that the next piece begins in: what ends it, the text of the record around it
        # so far, and the text to show and whether there is a start tag in it if it never ends.
        self.closing, self.in_record = closing, in_record
        self.parts: list[str] = [""] if in_record else []
        self.excerpt, self.seen = "", False
        # Whether the record that was open at the beginning still is, and the section never ended.
        self.head, self.untouched = in_record, closing is not None

    def take(self, piece: str, ended: bool = True) -> Iterator[tuple[str, str | None]]:
        """One more piece; ``ended`` tells that an end tag followed it."""
        text = piece + self.end_tag if ended else piece
        if self.closing is None:
            yield from self._scan(text, 0, None, last=not ended)
            return
        found = text.find(self.closing)
        if found < 0:
            if self.in_record:
                self.parts.append(text)
            self.seen = self.seen or bool(self.start.search(text))
            return
        self.untouched = False
        before = "".join(self.parts) if self.in_record else ""
        open_at = 0 if self.in_record else None
        yield from self._scan(before + text, len(before) + found + 3, open_at, last=not ended)

    def finish(self, seen_later: bool = False) -> Iterator[tuple[str, str | None]]:
        """What is left when the text is over."""
        if self.closing is not None and (self.in_record or self.seen or seen_later):
            yield self.excerpt, UNENDED
        self.closing, self.parts = None, []

    def _scan(
        self, text: str, place: int, open_at: int | None, last: bool
    ) -> Iterator[tuple[str, str | None]]:
        self.closing, self.parts, self.in_record = None, [], False
        while match := self.token.search(text, place):
            place = match.end()
            if match[0].startswith("<!"):
                closing = "-->" if match[0] == "<!--" else "]]>"
                end = text.find(closing, place)
                if end < 0:
                    wait = match.start() if open_at is None else open_at
                    self.closing, self.in_record = closing, open_at is not None
                    self.parts = [text[wait:]] if self.in_record else []
                    stop = text.find(self.end_tag, place)
                    self.excerpt = text[wait : stop + len(self.end_tag) if stop >= 0 else len(text)]
                    self.seen = bool(self.start.search(text, place))
                    return
                place = end + 3
            elif match[0].startswith("</"):
                if open_at is not None:
                    yield text[open_at:place], None
                open_at = None
            else:
                if open_at is not None:
                    yield text[open_at : match.start()], "no end tag"
                open_at = None if match[0].endswith("/>") else match.start()
                if open_at is None:
                    yield match[0], None
        if last and open_at is not None:
            yield text[open_at:], "no end tag"


def cut_pieces(
    pieces: Iterable[tuple[str, bool]], row_tag: str = ROW_TAG, seen_later: bool = False
) -> Iterator[tuple[str, str | None]]:
    """Records of one text given as ``(piece, ended)``."""
    cutter = RecordCutter(row_tag)
    for piece, ended in pieces:
        yield from cutter.take(piece, ended)
    yield from cutter.finish(seen_later)


def award_records(
    spark: SparkSession, path: str | list[str], row_tag: str = ROW_TAG, encoding: str = "utf-8"
) -> DataFrame:
    """``(file, value, error)``: every record of the files, read in splits of any size.

    A record that is none has its text and an ``error``. So has a text that is not in
    ``encoding``, and the records of a file that declares another one. Where the borders of splits
    lie makes no difference. Calling this scans the files once, to find those that are not tidy.
    """
    pieces = _pieces(spark, path, row_tag, encoding)
    untidy = _untidy_files(pieces, row_tag, encoding)
    declared = _declarations(pieces, [row.file for row in untidy if row.declares], encoding)
    ended = {row.file for row in untidy if row.ended}
    file = F.col("file")
    tidy = pieces.where(~file.isin([row.file for row in untidy])) if untidy else pieces
    parts = [_tidy_records(tidy, row_tag)]
    if plain := [row.file for row in untidy if not (row.carries or row.torn)]:
        parts.append(_cut(pieces.where(file.isin(plain)), row_tag, encoding, declared))
    if across := [row.file for row in untidy if row.carries or row.torn]:
        parts.append(_records_across(pieces.where(file.isin(across)), row_tag, encoding, declared, ended))
    return reduce(DataFrame.unionByName, parts)


def _pieces(spark: SparkSession, path: str | list[str], row_tag: str, encoding: str) -> DataFrame:
    """The text between end tags, with its file, split and place in the order of a task."""
    start = F.col("_metadata.file_block_start")
    reader = spark.read.option("lineSep", f"</{row_tag}>").option("encoding", encoding)
    columns = [
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        start.alias("start"),
        (start + F.col("_metadata.file_block_length")).alias("stop"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("id"),
    ]
    return reduce(DataFrame.union, [reader.text(share).select(*columns) for share in file_shares(spark, path)])


def _quoted(tag: str) -> str:
    """A tag as a pattern of the JVM."""
    return rf"\Q{tag}\E"


# Fixed values, patterns of the JVM: whole sections, and what begins one.
SECTIONS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
OPENINGS = r"<!--|<!\[CDATA\["


def _begun(row_tag: str) -> str:
    """Pattern of the beginning of a start tag."""
    return rf"<{_quoted(row_tag)}(?=[\s/>])"


def _spaced_end(row_tag: str) -> str:
    """Pattern of an end tag with blanks, at which the text is not cut."""
    return rf"</{_quoted(row_tag)}\s+>"


# Pattern of the rest of a start tag: attributes may hold any quoted text.
TAG_REST = r"""(?:\s(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)?/?>"""


def _untidy_files(pieces: DataFrame, row_tag: str, encoding: str) -> list:
    """A row per file that is not tidy: whether a section ``carries`` on behind an end tag, the file
    ends with an end tag (``ended``) or else with what may be a record (``torn``), or it ``declares``
    an encoding other than the given one.

    One scan in column expressions; tasks send a row per split. A file is tidy if no section goes
    over an end tag or holds tags of records, and its last piece, which no end tag follows, holds no record.
    """
    try:
        plain = "<!->[]/".encode(encoding) == b"<!->[]/"
    except LookupError as unknown:
        raise ValueError(f"unknown encoding {encoding!r}") from unknown
    text = F.col("value") if plain else F.decode(F.col("value").cast("binary"), encoding)
    tag = F.lit(rf"{_begun(row_tag)}|{_spaced_end(row_tag)}")
    rest = F.regexp_replace(text, SECTIONS, "")
    sections = F.struct(
        F.regexp_like(rest, F.lit(OPENINGS)).alias("open"),
        (F.regexp_count(text, tag) != F.regexp_count(rest, tag)).alias("tags"),
    )
    name = F.regexp_extract(text, r"""^\uFEFF?<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._\-]+)""", 1)
    spelt = F.regexp_replace(F.lower(name), "[^a-z0-9.]+", "_")
    looked = pieces.select(
        "file", "start", "size", "id",
        F.octet_length("value").alias("bytes"),
        F.when(F.contains(text, F.lit("<!")), sections).alias("sections"),
        F.when(F.contains(text, F.lit(row_tag)), F.regexp_like(text, tag)).otherwise(F.lit(False)).alias("tag"),
        F.when(F.col("start") == 0, (name != "") & ~spelt.isin(_spellings(encoding))).alias("declares"),
    )
    separator = len(f"</{row_tag}>".encode(encoding))
    splits = looked.groupBy("file", "start").agg(
        F.max("size").alias("size"),
        (F.sum("bytes") + separator * F.count(F.lit(1))).alias("bytes"),
        F.coalesce(F.bool_or("sections.open"), F.lit(False)).alias("carries"),
        F.coalesce(F.bool_or("sections.tags"), F.lit(False)).alias("hidden"),
        F.coalesce(F.bool_or("declares"), F.lit(False)).alias("declares"),
        # The last piece of the split and whether there is a tag in it, in one number.
        F.max(F.col("id") * 2 + F.col("tag").cast("long")).alias("last"),
    )
    files = splits.groupBy("file").agg(
        F.bool_or("carries").alias("carries"),
        F.bool_or("hidden").alias("hidden"),
        F.bool_or("declares").alias("declares"),
        (F.sum("bytes") <= F.max("size")).alias("ended"),
        ((F.max_by("last", "start") % 2 == 1) & (F.sum("bytes") > F.max("size"))).alias("torn"),
    )
    untidy = F.col("carries") | F.col("hidden") | F.col("torn") | F.col("declares")
    if not _same_encoding("utf-8", encoding):
        untidy = F.lit(True)
    return files.where(untidy).orderBy("file").collect()


def _spellings(encoding: str) -> list[str]:
    """Names under which a file may declare this encoding, or plain ASCII."""
    same = [a for a, codec in aliases.items() if _same_encoding(codec, encoding)]
    return sorted({*same, *(aliases[a] for a in same)})


def _declarations(pieces: DataFrame, files: list[str], encoding: str) -> dict[str, str]:
    """What is wrong with files that declare another encoding."""
    if not files:
        return {}
    first = pieces.where(F.col("file").isin(files) & (F.col("start") == 0))
    heads = first.select("file", F.substring(F.col("value").cast("binary"), 1, 400).alias("head"))
    found: dict[str, str] = {}
    for row in heads.where(F.contains("head", F.lit("<?xml".encode(encoding)))).collect():
        match = DECLARED.match(bytes(row.head).decode(encoding, "replace"))
        if match and not _same_encoding(match[1], encoding):
            found[row.file] = f"{DECLARES} {match[1]}"
    return found


def _tidy_records(pieces: DataFrame, row_tag: str) -> DataFrame:
    """Records of tidy files, piece by piece: no tag is in a section, and an end tag follows each
    piece with a record in it.

    Nearly all pieces hold one start tag and are a record from there. The others are taken apart
    at their start tags: such a part is a record up to an end tag with blanks, or the start tag
    alone if that is a whole element; the last part ends with the piece, and any other has no end.
    """
    end, begun = f"</{row_tag}>", _begun(row_tag)
    start = rf"^<{_quoted(row_tag)}{TAG_REST}"
    none = F.lit(None).cast("string")

    def record(value: Column, error: Column = none) -> Column:
        return F.struct(value.alias("value"), error.alias("error"))

    def taken_apart(text: Column) -> Column:
        # A lookahead keeps the tag; what stands before the first one is no part. Tags with
        # something else than attributes in them are none, and belong to the part before.
        parts = F.filter(F.split(text, rf"(?=<{_quoted(row_tag)}{TAG_REST})"), lambda part: part.rlike(start))

        def one(part: Column, i: Column) -> Column:
            tag = F.regexp_extract(part, start, 0)
            spaced = F.regexp_extract(part, rf"(?s)^.*?{_spaced_end(row_tag)}", 0)
            return (
                F.when(tag.endswith("/>"), record(tag))
                .when(spaced != "", record(spaced))
                .when(i + 1 == F.size(parts), record(F.concat(part, F.lit(end))))
                .otherwise(record(part, F.lit("no end tag")))
            )

        return F.transform(parts, one)

    text = F.col("text")
    valid = F.is_valid_utf8("value")
    read = pieces.select("file", F.when(valid, F.col("value")).otherwise(F.make_valid_utf8("value")).alias("text"), valid.alias("valid"))
    placed = read.select("*", F.regexp_instr(text, F.lit(begun)).alias("place")).where("place > 0")
    record_text = F.substr(text, F.col("place"))
    plain = (
        ~F.regexp_like(F.substr(record_text, F.lit(2)), F.lit(begun))
        & ~F.regexp_like(record_text, F.lit(_spaced_end(row_tag)))
        & F.regexp_like(record_text, F.lit(rf"{start}(?<!/>)"))
    )
    found = F.when(plain, F.array(record(F.concat(record_text, F.lit(end))))).otherwise(taken_apart(text))
    each = placed.select("file", "valid", F.inline(found))
    wrong = F.coalesce("error", F.when(~F.col("valid"), "not utf-8"))
    return each.select("file", "value", wrong.alias("error"))


# How a split may begin: in text, in a comment, in a CDATA section.
BEGINNINGS = (None, "-->", "]]>")


def _raw(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("value", F.col("value").cast("binary"))


def _decoded(row, encoding: str, declared: Mapping[str, str]) -> tuple[str, str | None]:
    """Text of a piece and what is wrong with it."""
    wrong = declared.get(row.file)
    try:
        return row.value.decode(encoding), wrong
    except UnicodeDecodeError:
        return row.value.decode(encoding, "replace"), wrong or f"not {encoding}"


def _cut(pieces: DataFrame, row_tag: str, encoding: str, declared: Mapping[str, str]) -> DataFrame:
    """Records of files in which every piece stands for itself: no section goes over an end tag,
    and an end tag follows every piece with a record in it."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = RecordCutter(row_tag)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                text, wrong = _decoded(row, encoding, declared)
                rows += [(row.file, value, error or wrong) for value, error in cutter.take(text)]
            yield pd.DataFrame(rows, columns=["file", "value", "error"])

    return _raw(pieces).mapInPandas(work, RECORDS)


def _by_split(batches: Iterator[pd.DataFrame]) -> Iterator[Iterator[tuple]]:
    """The pieces of each split in order, a batch of them at a time, with whether it is the last one."""
    rows = (row for batch in batches for row in batch.itertuples(index=False))
    waiting = next(rows, None)
    while waiting is not None:

        def split() -> Iterator[tuple]:
            nonlocal waiting
            last = False
            while not last:
                row, waiting = waiting, next(rows, None)
                last = waiting is None or (waiting.file, waiting.start) != (row.file, row.start)
                yield row, last

        found = split()
        yield found
        for _ in found:  # what the caller left
            pass


def _records_across(
    pieces: DataFrame, row_tag: str, encoding: str, declared: Mapping[str, str], ended: set[str]
) -> DataFrame:
    """Records of files with sections that go over end tags, and so perhaps over the borders of
    splits, or with a record that the file ends in.

    The pieces are written once, so that all steps see the same splits. Each split is cut for
    every way in which it may begin, which gives a few flags; a file's flags in order tell how each of
    its splits does begin. Then the splits are cut, and what belongs to a record over a
    border is gathered by record.
    """
    spark = pieces.sparkSession
    path = scratch_dir(spark, "pieces")
    _raw(pieces).write.parquet(path)
    place = ["file", "start", "id"]
    staged = spark.read.parquet(path)

    def effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for split in _by_split(batches):
            cutters = [RecordCutter(row_tag, closing, in_record=closing is not None) for closing in BEGINNINGS]
            for row, _ in split:
                text, _ = _decoded(row, encoding, declared)
                for cutter in cutters:
                    for _ in cutter.take(text):
                        cutter.head = False
            yield _frame([(row.file, row.start, *[x for c in cutters for x in _effect(c)])], EFFECTS)

    in_order = staged.repartition("file", "start").sortWithinPartitions(*place)
    states = in_order.mapInPandas(effects, EFFECTS).groupBy("file").applyInPandas(_states, STATES)
    begun = staged.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions(*place)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for split in _by_split(batches):
            texts = (
                (row, *_decoded(row, encoding, declared), not (last and row.last_split and row.file not in ended))
                for row, last in split
            )
            yield _frame(_cut_split(texts, row_tag), FRAGMENTS)

    cut_path = scratch_dir(spark, "fragments")
    begun.mapInPandas(cut, FRAGMENTS).write.parquet(cut_path)
    rows = spark.read.schema(FRAGMENTS).parquet(cut_path)
    whole = rows.where("chain IS NULL").select("file", "value", "error")
    values = F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda part: part["value"])
    chains = rows.where("chain IS NOT NULL").groupBy("file", "chain").agg(
        F.array_join(values, "").alias("text"), F.max("error").alias("wrong"), F.bool_or("seen").alias("seen")
    )

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                texts = row.text.split(f"</{row_tag}>")
                texts = [(t, True) for t in texts[:-1]] + ([(texts[-1], False)] if texts[-1] else [])
                found += [(row.file, v, e or row.wrong) for v, e in cut_pieces(texts, row_tag, bool(row.seen))]
            yield pd.DataFrame(found, columns=["file", "value", "error"])

    return whole.unionByName(chains.mapInPandas(stitch, RECORDS))


# Of a split, for each way it may begin: the way it ends (its place in BEGINNINGS); whether a record
# is open around the section it ends in (2: if one was at the beginning); whether that section
# began here; whether a start tag is seen in it.
EFFECTS = "file string, start long, " + ", ".join(
    f"end{i} int, record{i} int, here{i} boolean, seen{i} boolean" for i in range(len(BEGINNINGS))
)
# How a split begins, and what is to be done with its first and last record. ``chain`` is the split in which the record
# open at the beginning (the end) began; null where there is none or it is not wanted.
STATES = "file string, start long, begin int, in_record boolean, chain long, last_chain long, last_split boolean, skipped boolean, seen boolean"
FRAGMENTS = "file string, value string, error string, chain long, start long, seen boolean"


def _frame(rows: Iterable[tuple], fields: str) -> pd.DataFrame:
    """Rows of a schema as text, numbers that may be absent as such."""
    kinds = dict(field.split(" ") for field in fields.split(", "))
    frame = pd.DataFrame(list(rows), columns=list(kinds))
    return frame.astype({name: "Int64" for name, kind in kinds.items() if kind in ("int", "long")})


def _effect(cutter: RecordCutter) -> tuple[int, int, bool, bool]:
    record = 0 if cutter.closing is None or not cutter.in_record else 2 if cutter.head else 1
    return BEGINNINGS.index(cutter.closing), record, not cutter.untouched, cutter.seen


def _states(effects: pd.DataFrame) -> pd.DataFrame:
    """How every split of a file begins: its flags, a few bytes per split, in order."""
    begin, in_record, chain, opened, seen = 0, False, None, None, False
    rows = []
    for i, effect in enumerate(effects.sort_values("start").itertuples(index=False)):
        end, record, here, saw = (getattr(effect, f"{name}{begin}") for name in ("end", "record", "here", "seen"))
        row = {"file": effect.file, "start": effect.start, "begin": begin, "in_record": in_record, "chain": chain}
        if end == 0:
            begin, in_record, chain, opened, seen = 0, False, None, None, False
        elif begin == 0 or here:
            in_record = record == 1 or (record == 2 and in_record)
            chain = chain if record == 2 and in_record else effect.start
            begin, opened, seen = end, i, saw
        else:
            seen = seen or saw
        last = i + 1 == len(effects)
        rows.append({**row, "last_chain": chain if in_record else None, "last_split": last, "skipped": False, "seen": False})
    if opened is not None:  # the last section never ends: it is told where it began, and the rest is in it
        rows[opened] |= {"last_chain": chain, "seen": seen}
        for row in rows[opened + 1 :]:
            row["skipped"] = True
    return _frame([tuple(row.values()) for row in rows], STATES)


def _cut_split(pieces: Iterable[tuple], row_tag: str) -> Iterator[tuple]:
    """Rows of FRAGMENTS: the records of a split, and its parts of records over a border; from its
    pieces with their text, what is wrong with it, and whether an end tag followed."""
    cutter, head, trouble = None, False, None
    for row, text, wrong, ended in pieces:
        if row.skipped:
            return
        if cutter is None:
            cutter = RecordCutter(row_tag, BEGINNINGS[int(row.begin)], bool(row.in_record))
            head = cutter.in_record
        trouble = trouble or wrong
        for value, error in cutter.take(text, ended):
            if head:
                yield row.file, value, wrong, int(row.chain), row.start, False
            else:
                yield row.file, value, error or wrong, None, row.start, False
            head = False
    if cutter.closing is not None and head:
        yield row.file, "".join(cutter.parts), trouble, int(row.chain), row.start, bool(row.seen)
    elif cutter.closing is not None and not pd.isna(row.last_chain):
        rest = "".join(cutter.parts) if cutter.in_record else cutter.excerpt
        yield row.file, rest, trouble, int(row.last_chain), row.start, bool(row.seen)


def _same_encoding(one: str, other: str) -> bool:
    try:
        return codecs.lookup(one) == codecs.lookup(other) or codecs.lookup(one).name == "ascii"
    except LookupError:
        return False


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of the ``value`` column, other columns but ``error`` kept in front.

    Records with an ``error`` are not parsed: their text is in the corrupt column.
    """
    others = [F.col(name) for name in records.columns if name not in ("value", "error")]
    fields = with_corrupt(schema)
    error = F.col("error") if "error" in records.columns else F.lit(None).cast("string")
    parsed = records.select(
        *others, F.col("value"), error.alias("error"),
        F.from_xml(F.when(error.isNull(), F.col("value")), fields, XML_OPTIONS).alias("_record"),
    )
    bad = F.coalesce(F.when(F.col("error").isNotNull(), F.col("value")), F.col(f"_record.{CORRUPT}"))
    columns = [F.col(f"_record.`{f.name}`") for f in fields.fields if f.name != CORRUPT]
    return parsed.select(*others, *columns, bad.alias(CORRUPT))


# Fixed values, patterns of the JVM: attributes of a tag, text between tags, and the element that stands for it.
ATTRIBUTES = r"""(<[^\s/>!?"']++)(?:\s++[^\s=>/]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'))++\s*+(/?>)"""
TEXT = r">\s*+[^<\s][^<]*+<"
# An attribute that holds what ends a tag.
CONFUSING = r"""=\s*(?:"[^"<]*>|'[^'<]*>)"""
TEXT_ELEMENT = "_text"


def discover_schema(records: DataFrame) -> T.StructType:
    """Element tree of all records, every leaf text: a distributed first pass in the JVM.

    Spark's XML source infers the tree. It would take an element that holds text in one record
    and elements in another for text, so text is replaced by an element of its own first; that also
    tells where text stands beside elements (``_VALUE``). What reaches the driver is as large as
    the schema. Records that are not well-formed add nothing.
    """
    spark = records.sparkSession
    if "error" in records.columns:
        records = records.where(F.col("error").isNull())
    text = F.col("value")
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", ""), r"(?s)<!\[CDATA\[(?:.*?\S.*?)\]\]>", "x")
    plain = F.regexp_replace(plain, r"(?s)<!\[CDATA\[.*?\]\]>", "")
    text = F.when(F.contains(text, F.lit("<!")), plain).otherwise(text)
    text = F.when(F.regexp_like(text, F.lit(CONFUSING)), F.regexp_replace(text, ATTRIBUTES, "$1$2")).otherwise(text)
    marked = F.regexp_replace(text, TEXT, f"><{TEXT_ELEMENT}/><")
    # The name of the row element does not matter to a reader of records.
    reader = spark.read.options(**XML_OPTIONS).option("rowTag", "record")
    strings = getattr(records.select(marked.alias("value"))._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = reader._df(reader._jreader.xml(strings)).schema
    return T.StructType([_with_text(f) for f in found.fields if f.name not in (CORRUPT, TEXT_ELEMENT)])


def _with_text(field: T.StructField) -> T.StructField:
    """An element as it is read, from one whose text is an element."""
    repeated = isinstance(field.dataType, T.ArrayType)
    inner = field.dataType.elementType if repeated else field.dataType
    dtype: T.DataType = T.StringType()
    if isinstance(inner, T.StructType):
        children = [_with_text(f) for f in inner.fields if f.name != TEXT_ELEMENT]
        if children:
            text = [T.StructField("_VALUE", T.StringType())] if TEXT_ELEMENT in inner.names else []
            dtype = T.StructType(text + children)
    return T.StructField(field.name, T.ArrayType(dtype) if repeated else dtype)
