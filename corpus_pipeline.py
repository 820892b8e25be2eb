"""From raw documents to packed training sequences: five stages, each read from the last one's table.

1. quality: the discriminant fitted on the labels scores every text; rejected documents go.
2. simhash: one document of each group of near-duplicates stays, the one with the least doc_id.
3. suffix: later copies of 200-byte strings are cut out, the first copy stays.
4. mix: sources are read by weight, up to three times, in training order.
5. pack: token pieces in sequences of at most 1024.

Rows are known by a hash of all their columns inside a stage, and rows that are equal are counted,
so null and repeated doc_ids, and columns named like those of an operator, do no harm. All stages
but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contractlake.llm.common import row_hashes, staged, table, word_count
from contractlake.llm.curriculum import in_training_order, mix_sources
from contractlake.llm.packing import pack_documents
from contractlake.llm.qda import fit_quality, held_out, score_column
from contractlake.llm.settings import (
    MAX_BITS,
    MIX_WEIGHTS,
    PATTERN,
    QUALITY_THRESHOLD,
    SHINGLE,
    VOCABULARY,
)
from contractlake.llm.simhash import simhash_classes
from contractlake.llm.suffix import remove_repeats


def _rows(docs: DataFrame) -> DataFrame:
    """``h1`` and ``h2``, by which a row is known, and all columns as ``row``."""
    h1, h2 = row_hashes(docs)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(h1.alias("h1"), h2.alias("h2"), whole.alias("row"))


def _with_text(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, with another text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return [
        (new[c] if c in new else F.col(f"{row}.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns
    ]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; empty and null texts are scored as well.

    Rows that are equal stay or go together, an empty table gives an empty one, and columns of any
    name are kept. Without labelled documents of both classes there is no model: an error, if there are documents.
    """
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = fit_quality(docs.select("doc_id", "text"), labels)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scored = whole.withColumn("score", score_column(model, F.col("row.text")))
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select("row.*")


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id (null last, then by its hash) of each group; of equal
    rows one. Texts without a word, null ones too, are a group; an empty table gives an empty one."""
    h1, h2 = row_hashes(docs)
    texts = docs.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"))
    classes = simhash_classes(texts, "doc_id", SHINGLE, MAX_BITS, carry=("h1", "h2"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h1", "h2")
    least = classes.groupBy("class").agg(F.min(order).alias("least")).select("least.h1", "least.h2")
    # Equal rows are made one among those that stay: most texts are gone by then.
    stay = _rows(docs).join(least, ["h1", "h2"], "left_semi")
    return stay.dropDuplicates(["h1", "h2"]).select("row.*")


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of 200-byte strings; a text that is all copies becomes empty.

    Rows stay one to one, null texts stay null; of equal rows one keeps its text.
    """
    left = remove_repeats(docs, "doc_id", length=200, first_stays=True)
    return left.select(*_with_text(docs, "row", F.col("text")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per time a document is read, in training order; the last of a source is cut.

    Documents without a word are never read; rows with a null source are one source; equal rows are
    read each; an empty table gives an empty one.
    """
    h1, h2 = row_hashes(docs)
    key = F.struct(h1.alias("h1"), h2.alias("h2")).alias("key")
    sized = docs.select(key, "source", word_count(F.col("text")).alias("size"))
    read = mix_sources(sized, MIX_WEIGHTS).select("key.*", "size", F.inline("placements"))
    both = read.join(_rows(docs).dropDuplicates(["h1", "h2"]), ["h1", "h2"])
    ordered = in_training_order(both, "h1", "h2")
    # A word with the white space after it; the words wanted are the begin of the text.
    words = F.regexp_extract_all("row.text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    begin = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), begin).otherwise(F.col("row.text"))
    return ordered.select(*_with_text(docs, "row", text))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place.

    Null and empty texts are one piece, the end mark; null and repeated ids and equal rows are packed like any
    other; an empty table gives an empty one.
    """
    return pack_documents(docs.select("doc_id", "text"), VOCABULARY, PATTERN)


STAGES = [
    ("quality", quality),
    ("simhash", simhash),
    ("suffix", suffix),
    ("mix", mix),
    ("pack", pack),
]

# SQL has neither the fitted model nor the tokenizer; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
