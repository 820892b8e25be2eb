"""SimHash near-duplicates: candidates by the pigeonring, then the full Hamming distance.

The 64 bits are four segments in a ring. If two fingerprints differ in at most three bits, there
is a segment to start from such that the first k segments from there differ in at most 3k/4 bits
for every k: 0 in the first, 1 in the first two, 2 in three, 3 in all four. The first two
conditions are an equi-join: a key is the first segment with the second, and the side with a 0
where the other has a 1 also comes under the key with that bit set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from contractlake.llm.common import drop_staged, give_back, map_batches, staged
from contractlake.llm.components import components, with_group_min

SEGMENTS = 4
WIDTH = 16
MAX_BITS = 3
# Fingerprints of one key that a task holds at most; a larger key is taken apart.
MAX_GROUP = 1 << 16
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits: the majority over the hashes of the word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    shingles = words if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(n))))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle: int = 3):
    """Fingerprint of each text as a signed long."""

    @pandas_udf("long")
    def of(texts):
        import pandas as pd

        prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        give_back()
        return pd.Series(prints.view(np.int64))

    return of(text)


def _segments(prints: np.ndarray, start: int) -> list[np.ndarray]:
    """The segments of uint64 fingerprints from ``start`` on around the ring."""
    return [
        (prints >> np.uint64(WIDTH * ((start + i) % SEGMENTS))) & np.uint64(0xFFFF)
        for i in range(SEGMENTS)
    ]


def _set_one_zero(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value with each of its 0 bits set in turn: (index, new value)."""
    index, out = [], []
    for bit in range(WIDTH):
        mask = np.uint64(1 << bit)
        rows = np.flatnonzero((values & mask) == 0)
        index.append(rows)
        out.append(values[rows] | mask)
    return np.concatenate(index), np.concatenate(out)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows (start, key, print, exact): a print under its own key, and under those of a print that
    has one more bit in the second segment."""
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        for start in range(SEGMENTS):
            first, second = _segments(prints, start)[:2]
            index, changed = _set_one_zero(second)
            index = np.concatenate([np.arange(len(prints)), index])
            key = (first[index] << np.uint64(WIDTH)) | np.concatenate([second, changed])
            yield {
                "key": (key | np.uint64(start) << np.uint64(2 * WIDTH)).view(np.int64),
                "print": prints[index].view(np.int64),
                "exact": np.arange(len(index)) < len(prints),
            }


def _deep_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """For prints of keys with too many rows: the third segment joins the key. A print under its
    own key stays at its own third segment, where prints differ in the last segment only (65,536
    at most), and visits every value within two bits of it; other prints only visit."""
    flips = [1 << i for i in range(WIDTH)]
    flips += [(1 << i) | (1 << j) for i in range(WIDTH) for j in range(i)]
    for batch in batches:
        keys = batch.column("key").to_numpy()
        prints = batch.column("print").to_numpy().view(np.uint64)
        exact = batch.column("exact").to_numpy(zero_copy_only=False)
        for start in range(SEGMENTS):
            here = (keys >> (2 * WIDTH)) == start
            third = _segments(prints[here], start)[2]
            for flip in [0, *flips] if here.any() else []:
                yield {
                    "key": keys[here],
                    "third": (third ^ np.uint64(flip)).astype(np.int64),
                    "print": prints[here].view(np.int64),
                    "exact": exact[here] if flip == 0 else np.zeros(len(third), bool),
                }


def _within(one: np.ndarray, many: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Which pairs one x many pass the chain from ``start`` and the full distance."""
    away = one[:, None] ^ many[None, :]
    segments = _segments(away, start)
    so_far = np.zeros(away.shape, np.uint8)
    passed = np.ones(away.shape, bool)
    for i, segment in enumerate(segments):
        so_far += np.bitwise_count(segment)
        passed &= so_far * SEGMENTS <= max_bits * (i + 1)
    return passed


def _forest(one: np.ndarray, many: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what the passing pairs join: less than one per print, however many pairs.

    A breadth-first walk from each print not yet reached; every print is compared in blocks with
    those not reached so far, so a tight group costs one row of comparisons.
    """
    prints = np.unique(np.concatenate([one, many]))
    is_one = np.isin(prints, one)
    reached = np.zeros(len(prints), bool)
    links = []
    for root in np.flatnonzero(is_one):
        if reached[root]:
            continue
        reached[root] = True
        edge = np.array([root])
        while len(edge):
            found = []
            for at in range(0, len(edge), 64):
                block = edge[at : at + 64]
                left = np.flatnonzero(~reached)
                if not len(left):
                    break
                near = _within(prints[block], prints[left], start, max_bits)
                # A link needs a print that stands under its own key.
                near &= is_one[block][:, None] | is_one[left][None, :]
                hit = near.any(axis=0)
                froms = block[near[:, hit].argmax(axis=0)]
                links += zip(prints[froms].view(np.int64).tolist(), prints[left[hit]].view(np.int64).tolist())
                reached[left[hit]] = True
                found.append(left[hit])
            edge = np.concatenate(found) if found else np.array([], np.int64)
    return links


def _link_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], max_bits: int, max_group: int, last: bool
) -> Iterator[dict]:
    """Links of each run of equal keys in sorted rows, ``exact`` ones first in a run.

    Of a run over ``max_group``, all rows are passed on; in the ``last`` pass its exact rows,
    which are few, stay and the others are compared with them part by part.
    """

    def out(links: list, passed: tuple | None = None) -> dict:
        u, v = zip(*links) if links else ((), ())
        key, prints, exact = (passed[0], passed[-2].view(np.int64), passed[-1]) if passed else ([], [], [])
        return {
            "u": np.array([*u, *prints], np.int64),
            "v": pa.array([*v, *[None] * len(prints)], pa.int64()),
            "key": pa.array([*[None] * len(u), *key], pa.int64()),
            "exact": pa.array([*[None] * len(u), *exact], pa.bool_()),
        }

    def solve(rows: tuple) -> list:
        prints, exact = rows[-2], rows[-1]
        if len(prints) < 2 or not exact.any():
            return []
        start = int(rows[0][0] >> (2 * WIDTH))
        return _forest(prints[exact], prints[~exact], start, max_bits)

    held: tuple | None = None
    large = None  # name of a run whose first rows are passed on already
    for batch in batches:
        rows = (
            *[batch.column(k).to_numpy() for k in keys],
            batch.column("print").to_numpy().view(np.uint64),
            batch.column("exact").to_numpy(zero_copy_only=False),
        )
        if held is not None:
            rows = tuple(np.concatenate(pair) for pair in zip(held, rows))
        if not len(rows[0]):
            continue
        change = np.ones(len(rows[0]), bool)
        change[1:] = np.any([ids[1:] != ids[:-1] for ids in rows[: len(keys)]], axis=0)
        starts = np.flatnonzero(change)
        links: list = []
        for begin, end in zip(starts, np.append(starts[1:], len(change))):
            ended = end < len(change)
            if ended and end - begin == 1 and large is None:
                continue
            run = tuple(x[begin:end] for x in rows)
            name = tuple(x[0] for x in run[: len(keys)])
            if large == name or (not last and end - begin > max_group):
                yield out([], run)
                large = None if ended else name
                held = None
            elif ended:
                links += solve(run)
                large = None
            elif last and end - begin > max_group:
                links += solve(run)
                held = tuple(x[run[-1]] for x in run)
            else:
                held = run
        yield out(links)
    if held is not None:
        yield out(solve(held))


def similar_prints(
    prints: DataFrame,
    max_bits: int = MAX_BITS,
    max_group: int = MAX_GROUP,
    made: list[str] | None = None,
) -> DataFrame:
    """``u``, ``v``: links between distinct fingerprints (column ``print``) that join exactly those
    that chains of pairs at ``max_bits`` or fewer bits join. Every link is such a pair."""
    if max_bits >= SEGMENTS:
        raise ValueError(f"this ring is for fewer than {SEGMENTS} bits")
    schema = "u long, v long, key long, exact boolean"

    def linked(rows: DataFrame, keys: list[str], last: bool) -> DataFrame:
        runs = rows.repartition(*keys).sortWithinPartitions(*keys, F.desc("exact"))
        return map_batches(runs, lambda b: _link_groups(b, keys, max_bits, max_group, last), schema)

    keyed = map_batches(prints.select("print"), _keys, "key long, print long, exact boolean")
    found = staged(linked(keyed, ["key"], False), "pairs", made)
    deep = map_batches(
        found.where("v IS NULL").select("key", F.col("u").alias("print"), "exact"),
        _deep_keys,
        "key long, third long, print long, exact boolean",
    )
    rest = linked(deep, ["key", "third"], True)
    return found.where("v IS NOT NULL").select("u", "v").union(rest.select("u", "v"))


def simhash_classes(
    documents: DataFrame,
    key: str = "doc_id",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
    max_group: int = MAX_GROUP,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (the least key that links reach),
    ``class`` (the least fingerprint, as a number) and the columns named in ``carry``.

    Fingerprints are made once per row and grouped before anything is compared, so exact copies
    cost one fingerprint. Null and empty texts have fingerprint 0 and link like any other; rows
    with equal keys each stay, and where two components share a key ``class`` tells them apart; a
    null key counts as no number: a component of nulls only has a null id. An empty table gives
    an empty one, other columns are not read.
    """
    made: list[str] = []
    carried = [F.col(f"`{name}`").alias(f"carry{i}") for i, name in enumerate(carry)]
    prints = staged(
        documents.select(
            F.col(f"`{key}`").cast("long").alias("key"),
            *carried,
            fingerprint_column(F.col("text"), shingle).alias("print"),
        ),
        "prints",
    )
    distinct = prints.groupBy("print").agg(F.min("key").alias("least"))
    links = similar_prints(distinct.select("print"), max_bits, max_group, made)
    found = staged(components(links), "components", made)
    # Prints by component, those without links by themselves.
    placed = distinct.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    classes = with_group_min(placed, "component", "least", "component_id")
    named = staged(classes.select("print", "component_id", F.col("component").alias("class")), "classes")
    drop_staged(documents.sparkSession, made)
    return prints.join(named, "print").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "class",
        *[F.col(f"carry{i}").alias(name) for i, name in enumerate(carry)],
    )
