"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contractlake.llm.common import (
    every_copy,
    in_chunks,
    key_digest,
    map_batches,
    no_such_columns,
    per_process,
    prefix_digits,
    running_total,
    staged,
)

EOS = 2
CAPACITY = 1024


@dataclass(frozen=True)
class Slots:
    """``count`` pieces of one length, by rank from ``rank`` on, go to sequences from
    ``sequence`` on, one each, all at the same ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan_slots(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts: which slots the pieces of each length take.

    Lengths come from the longest down. Sequences with the same space left are runs of sequence
    numbers; a length goes to the run with the least space that holds it, to as many sequences
    as there are pieces left, then to the next run, then to new sequences. A run is filled with as many of
    the length as fit before the next one is taken, which is where best fit would put them. Each
    step ends a length, a run or a level of it, so the plan has a few entries per length however
    many pieces there are.
    """
    slots: list[Slots] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # space left -> [(first sequence, count)]
    spaces: list[int] = []
    used = 0

    def add(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                bisect.insort(spaces, space)
            runs.setdefault(space, []).append((first, count))

    def fill(length: int, rank: int, left: int, space: int, first: int, count: int) -> tuple[int, int]:
        """Put up to ``left`` pieces into a run, one sequence full of them after the other."""
        each = space // length
        whole, part = min(count, left // each), 0
        if whole < count:
            part = left - whole * each
        for level in range(each):
            if whole:
                slots.append(Slots(length, rank, whole, first, capacity - space + level * length))
                rank += whole
        add(space - each * length, first, whole)
        if part:
            for level in range(part):
                slots.append(Slots(length, rank, 1, first + whole, capacity - space + level * length))
                rank += 1
            add(space - part * length, first + whole, 1)
        rest = count - whole - bool(part)
        add(space, first + whole + bool(part), rest)
        return rank, left - whole * each - part

    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no piece of length {length} fits {capacity}")
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                count = -(-left // (capacity // length))
                rank, left = fill(length, rank, left, capacity, used, count)
                used += count
                continue
            space = spaces[at]
            first, count = runs[space].pop()
            if not runs[space]:
                del runs[space]
                spaces.pop(at)
            rank, left = fill(length, rank, left, space, first, count)
    return slots


def _encoding(vocabulary: str, pattern: str):
    """The vocabulary file read with the library that encodes it fastest; ids are the same. Read once per process."""
    return per_process(("encoding", vocabulary, pattern), lambda: _read_encoding(vocabulary, pattern))


def _read_encoding(vocabulary: str, pattern: str):
    import json

    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    ids = content["model"]["vocab"]
    added = content.get("added_tokens") or []
    for token in added:
        # These make the tokenizer match a token otherwise than by its plain string.
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for
    # characters from 256 on, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in ids.items() if set(token) <= set(byte_of)}
    special = {token["content"]: token["id"] for token in added}
    for token in special:
        ranks.pop(token.encode(), None)
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def token_ids(
    text: str | None, vocabulary: str, pattern: str, eos: int = EOS, added: bool = False
) -> np.ndarray:
    """Ids of a whole text, then ``eos``; null is empty. Strings of added tokens give these tokens with
    ``added``, as the tokenizer has it when it is read, else what ordinary text gives, as with its
    ``encode_special_tokens``."""
    encoding = _encoding(vocabulary, pattern)
    ids = encoding.encode(text or "", allowed_special="all") if added else encoding.encode_ordinary(text or "")
    return np.array([*ids, eos], "<u4")


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but the first."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def token_pieces(
    documents: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY, eos: int = EOS
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` per piece of ``text``; added tokens count."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            index = []
            for i, text in enumerate(batch.column("text")):
                ids = token_ids(text.as_py(), vocabulary, pattern, eos, added=True)
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                    index.append(i)
            table = np.array(rows, np.int64).reshape(-1, 4)
            yield {
                "key": batch.column("key").take(pa.array(index, pa.int64())),
                "piece": table[:, 0].astype(np.int32),
                **{n: table[:, i] for i, n in ((1, "start"), (2, "length"), (3, "ids_crc32"))},
            }

    head = dict(documents.dtypes)["key"]
    schema = f"key {head}, piece int, start long, length long, ids_crc32 long"
    return map_batches(documents.select("key", "text"), work, schema)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged; with ``key`` and ``length``) plus ``sequence_id`` and ``offset``.

    The histogram has one row per length up to the capacity, whatever the number of pieces; the
    plan made from it is of that order. Pieces get a rank within their length, over buckets of
    their digest so that no length is gathered in one task, and join the plan on length and rank.
    Equal pieces are counted and told apart by rank only; however many there are, all tasks deal them out.
    Null keys and equal pieces stay pieces, an empty table gives an empty one. Columns named
    ``sequence_id``, ``offset`` or with a leading underscore are an error.
    """
    no_such_columns(pieces, "sequence_id", "offset")
    columns = pieces.columns
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = [
        (s.length, s.rank, s.rank + s.count, s.sequence - s.rank, s.offset)
        for s in plan_slots(histogram, capacity)
    ]
    planned = pieces.sparkSession.createDataFrame(
        plan, "length long, _from long, _to long, _shift long, offset long"
    )
    digits = prefix_digits(sum(histogram.values()))
    equal = pieces.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    equal = in_chunks(equal, "_rows")
    equal = staged(equal.withColumn("_digest", key_digest(F.concat_ws(" ", "key", *columns))), "pieces")
    ranked = running_total(
        equal, ["length"], F.substring("_digest", 1, digits), ["_digest", *columns, "_part"], "_rows", "_first"
    )
    each = every_copy(ranked, columns, F.col("_first"), "_rows", "_rank").select(*columns, "_rank")
    # Bounded by the capacity: at most a few rows per length.
    found = each.join(F.broadcast(planned), "length")
    return found.where("_rank >= _from AND _rank < _to").select(
        *columns, (F.col("_shift") + F.col("_rank")).alias("sequence_id"), "offset"
    )


def pack_documents(
    documents: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``.

    Documents longer than the capacity are cut; the first piece takes the rest of the division.
    Null texts count as empty and have the end mark only; repeated rows and null keys are packed
    like any other; an empty table gives an empty one; other columns are not read.
    """
    named = documents.select(F.col(f"`{key}`").alias("key"), F.col("text").alias("text"))
    pieces = staged(token_pieces(named, vocabulary, pattern, capacity), "tokens")
    return pack_pieces(pieces, capacity).withColumnRenamed("key", key)
