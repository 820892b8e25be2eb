"""Ranked lexical search with sketches of the largest impacts.

The impact of a term on a document's score is known once the corpus has been counted. Each
document's impacts are folded into a short sketch: every coordinate holds the largest impact of
the terms that hash to it. Looking an item's terms up in the sketch and adding gives a bound that
the score cannot exceed; documents are scored exactly from the highest bound down until no bound
reaches the lowest score that is still in the list.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contractlake.llm.common import drop_staged, map_batches, staged
from contractlake.session import scratch_dir

# What a term is, and the letters that are lower-cased.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOP = 50
# Coordinates of a sketch; more make the bounds sharper and the sketches larger.
COORDINATES = 2048
# Different terms that items of one block have together, unless one item has more by itself.
BLOCK_TERMS = 100_000
# Documents that are bounded together, and scored together.
DOCUMENTS, SCORED = 1024, 64


def terms(text: str | None) -> list[str]:
    """The terms of a text in order; none for null."""
    return TERM.findall((text or "").translate(LOWER))


@dataclass(frozen=True)
class Items:
    """A block of items: the terms any of them has, in order, and each item's among them."""

    words: list[str]
    numbers: list[int]
    wanted: list[np.ndarray]


def item_blocks(items: DataFrame, limit: int = BLOCK_TERMS) -> Iterator[Items]:
    """Items (``item`` number, ``text``) in blocks of bounded size, as they come to the driver."""

    def made(block: list[tuple[int, list[str]]]) -> Items:
        words = sorted({word for _, own in block for word in own})
        place = {word: i for i, word in enumerate(words)}
        return Items(words, [n for n, _ in block], [np.array(sorted(place[w] for w in own), np.int64) for _, own in block])

    block: list[tuple[int, list[str]]] = []
    size = 0
    for item in items.select("item", "text").toLocalIterator():
        own = sorted(set(terms(item.text)))
        if not own:
            continue
        if block and size + len(own) > limit:
            yield made(block)
            block, size = [], 0
        block.append((item["item"], own))
        size += len(own)
    if block:
        yield made(block)


def term_counts(documents: DataFrame, words: Sequence[str]) -> DataFrame:
    """``doc``, ``n`` (terms of the document) and what it has of ``words``: ``ids`` (places among
    them) and ``counts``; documents without any term are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = {word: i for i, word in enumerate(words)}
        for batch in batches:
            rows, sizes, ids, counts, stops = [], [], [], [], [0]
            for row, text in enumerate(batch.column("text")):
                found = terms(text.as_py())
                if not found:
                    continue
                rows.append(row)
                sizes.append(len(found))
                for word, count in Counter(found).items():
                    if word in place:
                        ids.append(place[word])
                        counts.append(count)
                stops.append(len(ids))
            yield {
                "doc": batch.column("doc").take(pa.array(rows, pa.int64())),
                "n": np.array(sizes, np.int64),
                "ids": pa.ListArray.from_arrays(np.array(stops, np.int32), pa.array(ids, pa.int32())),
                "counts": pa.ListArray.from_arrays(np.array(stops, np.int32), pa.array(counts, pa.int32())),
            }

    kind = dict(documents.dtypes)["doc"]
    return map_batches(documents.select("doc", "text"), work, f"doc {kind}, n long, ids array<int>, counts array<int>")


def weights(counted: DataFrame, size: int, documents: int) -> np.ndarray:
    """Weight of each of the ``size`` terms, from the number of documents that hold it."""
    held = counted.select(F.explode("ids").alias("id")).groupBy("id").count()
    found = np.zeros(size, np.int64)
    for row in held.collect():  # as many rows as the block has terms
        found[row["id"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))
    return found


def impacts(weight: np.ndarray, count: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each posting adds to its document's score: whole numbers, divisions rounded down."""
    if 50 * int(n.max(initial=0)) * documents >= 2**63:
        n = n.astype(object)
    m = 100 - 50 + ((50 * n * documents) // total).astype(np.int64)
    return weight * ((1_000_000_000 * count) // (1000 * count + 20 * m))


def sketches(rows: np.ndarray, coordinates: np.ndarray, impact: np.ndarray, documents: int, width: int) -> np.ndarray:
    """Per coordinate of each document the largest impact of its terms there."""
    found = np.zeros((documents, width), np.int64)
    if len(rows):
        place = rows * width + coordinates
        order = np.argsort(place, kind="stable")
        first = np.flatnonzero(np.diff(place[order], prepend=-1))
        found.reshape(-1)[place[order][first]] = np.maximum.reduceat(impact[order], first)
    return found


class Ranking:
    """The best documents met so far for each item of a block."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, total: int, top: int, width: int) -> None:
        self.items, self.weight, self.documents, self.total = items, weight, documents, total
        self.top, self.width = top, width
        self.coordinate = np.array([zlib.crc32(word.encode()) % width for word in items.words], np.int64)
        self.asked = [self.coordinate[own] for own in items.wanted]
        # Per item rows of (score, document key as it sorts, what stands for the document).
        self.best: list[list[tuple]] = [[] for _ in items.wanted]

    def add(self, keys: list, n: np.ndarray, stops: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> int:
        """Some documents; returns how many were scored for an item, all items together."""
        sizes = np.diff(stops)
        rows = np.repeat(np.arange(len(keys)), sizes)
        impact = impacts(self.weight[ids], counts, n[rows], self.documents, self.total)
        sketch = sketches(rows, self.coordinate[ids], impact, len(keys), self.width)
        sketch = np.ascontiguousarray(sketch.T)
        scored, mine = 0, np.zeros(len(self.weight), bool)
        for item, (own, asked) in enumerate(zip(self.items.wanted, self.asked)):
            bound = sketch[asked].sum(axis=0)
            candidates = np.flatnonzero(bound >= max(1, self.least(item)))
            if not len(candidates):
                continue
            candidates = candidates[np.argsort(-bound[candidates], kind="stable")]
            mine[own] = True
            for first in range(0, len(candidates), SCORED):
                some = candidates[first : first + SCORED]
                # An equal score may still come first by its key, so an equal bound is looked at.
                if bound[some[0]] < self.least(item):
                    break
                scored += len(some)
                self._take(item, some, [self._score(doc, stops, ids, impact, mine) for doc in some], keys)
            mine[own] = False
        return scored

    @staticmethod
    def _score(doc: int, stops: np.ndarray, ids: np.ndarray, impact: np.ndarray, mine: np.ndarray) -> int:
        own = slice(stops[doc], stops[doc + 1])
        return int(impact[own][mine[ids[own]]].sum())

    def least(self, item: int) -> int:
        best = self.best[item]
        return -best[-1][0] if len(best) == self.top else 0

    def _take(self, item: int, docs: np.ndarray, scores: list[int], keys: list) -> None:
        found = [(-s, keys[d] is None, keys[d]) for d, s in zip(docs, scores) if s > 0]
        # A null key comes last among equal scores, and only the first two parts compare then.
        ranked = sorted(self.best[item] + found, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
        self.best[item] = ranked[: self.top]


def rank_block(
    counted: DataFrame, items: Items, documents: int, total: int, top: int = TOP, width: int = COORDINATES
) -> DataFrame:
    """``item``, ``doc``, ``score``: at most ``top`` rows per item and task, the best ones of all among them."""
    weight = weights(counted, len(items.words), documents)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ranking = Ranking(items, weight, documents, total, top, width)
        for batch in batches:
            for first in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(first, DOCUMENTS)
                ids, counts = part.column("ids"), part.column("counts")
                offsets = ids.offsets.to_numpy()
                ranking.add(
                    part.column("doc").to_pylist(), part.column("n").to_numpy(), (offsets - offsets[0]).astype(np.int64),
                    ids.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64),
                )
        found = [(number, key, -score) for number, best in zip(items.numbers, ranking.best) for score, _, key in best]
        numbers, keys, scores = zip(*found) if found else ((), (), ())
        yield {"item": np.array(numbers, np.int64), "doc": list(keys), "score": np.array(scores, np.int64)}

    kind = dict(counted.dtypes)["doc"]
    return map_batches(counted, work, f"item long, doc {kind}, score long")


def search(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item_key: str = "item_id",
    top: int = TOP,
    width: int = COORDINATES,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_key``, ``rank`` from 1, ``key``, ``score``: the best ``top`` documents for each row of ``items``.

    Documents are ordered by falling score, then by key, null keys last; those without a score
    above 0 are left out. Null and empty texts have no term: such a document is in no list and
    does not count, such an item has no row. Repeated documents are ranked each by itself, and
    repeated items and null item keys have a list each. An empty table gives an empty
    result; further columns, whatever their names, are not read.

    Items go to tasks in blocks of at most ``block_terms`` terms (one item, if it has more), and
    each block reads the documents once. A task scores its own documents and hands on at most
    ``top`` rows per item, which are cut down in two steps, so no item's rows meet in one task
    unless they are few.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{key}`").alias("doc"), F.col("text").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").alias("item_key"), F.col("text").alias("text"))
    # A row's number is fixed once it is written: item keys may repeat or be null.
    asked = staged(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    ranked = scratch_dir(spark, "ranked")
    kind = dict(docs.dtypes)["doc"]
    spark.createDataFrame([], f"item long, doc {kind}, score long").write.parquet(ranked)
    sizes = None
    for block in item_blocks(asked, block_terms):
        made: list[str] = []
        counted = staged(term_counts(docs, block.words), "counted", made)
        if sizes is None:
            sizes = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
        if sizes.documents:
            best = rank_block(counted, block, sizes.documents, sizes.total, top, width)
            best.write.mode("append").parquet(ranked)
        drop_staged(spark, made)
    result = spark.read.schema(f"item long, doc {kind}, score long").parquet(ranked)
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    spread = Window.partitionBy("item", "_part").orderBy(*order)
    few = result.withColumn("_part", F.pmod(F.xxhash64("doc"), F.lit(64)))
    few = few.withColumn("_rank", F.row_number().over(spread)).where(F.col("_rank") <= top)
    final = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return final.where(F.col("rank") <= top).join(asked.select("item", "item_key"), "item").select(
        F.col("item_key").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score"
    )
