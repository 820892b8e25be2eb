"""Suffix-array dedup: text that repeats anywhere in the corpus, by longest previous factors.

A factor is the string of ``length`` bytes that starts at a position. A position repeats an
earlier one if its longest previous factor has that length. The nearest suffixes before and after
it in suffix order that lie earlier (the previous and next smaller positions) share most with it
of all that do, and what they share is that factor; lengths are told up to ``length``.

Suffixes of the whole corpus are too many to sort at once and most meet no other. So each factor
is first put under its anchor, the gram with the least hash inside it: equal factors have equal
anchors, so factors under an anchor that occurs once are unique. Neighbouring factors with one
anchor are a stretch; stretches that are equal as a whole are settled by counting. Only different
stretches under one anchor go to suffix arrays, a bounded block of whole anchors at a time. An
anchor with too many different stretches for a block is dealt to several; of its factors, each
block then hands on one per kind, and those are counted by a hash of their bytes, which gives the
same answer.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from contractlake.llm.common import drop_staged, map_batches, staged
from contractlake.session import scratch_dir

LENGTH = 200
GRAM = 64
# Different stretches of one anchor that go to one suffix array at most.
MAX_STRETCHES = 2000
# Bytes of one suffix array, and factors of a document that are hashed at once.
BLOCK = 1 << 20
CHUNK = 1 << 19
# Documents that a task turns into rows at once.
SLICE = 1000

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_TWO = np.uint64(0xBF58476D1CE4E5B9)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) at each position, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    factor, size = MIX, 1
    while size < gram:
        h = h[:-size] * factor + h[size:]
        factor = factor * factor
        size *= 2
    h ^= h >> np.uint64(31)
    h *= MIX_TWO
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Stretches of factors with one anchor: (hash of the anchor, first factor, number of factors).

    The anchor is the gram with the least hash in the factor, the leftmost of equal ones, so it
    depends on the factor's bytes only.
    """
    with np.errstate(over="ignore"):
        h = _gram_hashes(data, gram)
    places = np.uint64(31)
    least = (h >> places << places) | np.arange(len(h), dtype=np.uint64)
    window, size = length - gram + 1, 1
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    at = (least[first] & np.uint64((1 << 31) - 1)).astype(np.int64)
    return h[at].view(np.int64), first, np.diff(np.append(first, len(least)))


def stretches(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, hash of all its bytes, first factor, factors) of a whole text, part by part."""
    found = []
    data = np.frombuffer(text, np.uint8)
    for start in range(0, max(len(data) - length + 1, 0), CHUNK):
        anchor, first, count = anchors(data[start : start + CHUNK + length - 1], length, gram)
        first = first + start
        ends = first + count + (length - 1)
        whole = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(first.tolist(), ends.tolist())]
        found.append((anchor, np.array(whole, np.uint64).view(np.int64), first, count))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _runs(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches in order, with those that adjoin made one."""
    new = np.append(True, first[1:] != (first + count)[:-1])
    begin = np.flatnonzero(new)
    return first[begin], np.add.reduceat(count, begin)


def _stretch_rows(
    batches: Iterator[pa.RecordBatch], length: int, gram: int, first_stays: bool
) -> Iterator[dict]:
    """One row per kind of stretch of a document with how often it is there (``times``), and what
    is settled by the document alone as rows with ``times`` 0: a stretch that comes again, as in
    a text that says the same word all over."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, len(b), SLICE)):
        ids, orders = batch.column("_rid").to_numpy(), batch.column("_ord").to_numpy()
        rows = []
        for text in batch.column("_text"):
            anchor, whole, first, count = stretches((text.as_py() or "").encode(), length, gram)
            times = np.ones(len(whole), np.int64)
            _, place, kind, n = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            if len(place) < len(whole):
                head = np.zeros(len(whole), bool)
                head[place] = True
                again = ~head if first_stays else n[kind] > 1
                times[place] = n
                done = _runs(first[again], count[again])
                zero = np.zeros(len(done[0]), np.int64)
                kept = (anchor[head], whole[head], first[head], count[head], times[head])
                rows.append(tuple(map(np.append, kept, (zero, zero, *done, zero))))
            else:
                rows.append((anchor, whole, first, count, times))
        per = np.array([len(r[0]) for r in rows], np.int64)
        anchor, whole, first, count, times = (np.concatenate(c) for c in zip(*rows)) if rows else [[]] * 5
        yield {
            "anchor": anchor, "whole": whole, "rid": np.repeat(ids, per), "ord": np.repeat(orders, per),
            "first": first, "factors": np.asarray(count, np.int32), "times": times,
        }


def _bytes_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[dict]:
    """The bytes of the stretches that a document is asked for."""
    names = ("anchor", "part", "crowded", "first")
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("_rid", "_ord")), batch.column("_text"), batch.column("asked"))
        for rid, order, text, asked in rows:
            data = (text.as_py() or "").encode()
            parts = asked.values
            first, count = (parts.field(n).to_pylist() for n in ("first", "factors"))
            for name in names:
                held.setdefault(name, []).extend(parts.field(name).to_pylist())
            held.setdefault("rid", []).extend([rid] * len(first))
            held.setdefault("ord", []).extend([order] * len(first))
            found = [data[a : a + n + length - 1] for a, n in zip(first, count)]
            held.setdefault("data", []).extend(found)
            size += sum(map(len, found))
            if size > BLOCK:
                yield held
                held, size = {}, 0
    if held:
        yield held


def suffix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """The rank of each suffix among all by its first bytes; equal ones share a rank. For 7, 14, 28
    and so on bytes, and last for ``length``.

    Ranks by 7 bytes, then by twice as many from two ranks at a time. Beyond the end there is
    nothing, which ranks lowest.
    """
    n = len(data)
    known = min(7, length)
    padded = np.append(data.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64))
    key = np.zeros(n, np.uint64)
    for i in range(known):  # 9 bits each: 256 bytes and the end
        key = (key << np.uint64(9)) | padded[i : i + n]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int32)
    levels = [(known, rank)]
    while known < length:
        ahead = min(known, length - known)
        later = np.zeros(n, np.int64)
        later[: n - ahead] = rank[ahead:].astype(np.int64) + 1
        rank = np.unique(rank * np.int64(n + 1) + later, return_inverse=True)[1].astype(np.int32)
        known += ahead
        levels.append((known, rank))
    return levels


def shared_length(levels: list[tuple[int, np.ndarray]], data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first bytes the suffixes at ``a`` and at ``b`` share, at most as many as are ranked."""
    length = levels[-1][0]
    found = np.zeros(len(a), np.int64)
    for known, rank in [*levels[::-1], *[(1, data)] * 6]:
        ahead = np.minimum(np.stack([a, b]) + found, len(data) - 1)
        same = (found + known <= length) & (rank[ahead[0]] == rank[ahead[1]])
        found += np.where(same, known, 0)
    return found


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each value the nearest place before it with a smaller one, -1 where there is none.

    By a tree of least values: up from each place until a left neighbour's is smaller, then down
    to the right-most place in it; all places at once, a step per level.
    """
    most = np.iinfo(values.dtype).max
    levels = [values]
    while len(levels[-1]) > 1:
        if len(levels[-1]) % 2:
            levels[-1] = np.append(levels[-1], most)
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    place = np.arange(len(values), dtype=np.int32)
    node, value = place, values
    turns = []
    for least in levels[:-1]:
        ok = (node & 1).astype(bool)
        ok[ok] = least[node[ok] - 1] < value[ok]
        turns.append((place[ok], node[ok] - 1))
        place, node, value = place[~ok], node[~ok] >> 1, value[~ok]
    found = np.full(len(values), -1, np.int32)
    who, at = np.zeros(0, np.int32), np.zeros(0, np.int32)
    for level in range(len(turns) - 1, -1, -1):
        who, at = np.append(who, turns[level][0]), np.append(at, turns[level][1])
        if level:
            right = 2 * at + 1
            at = np.where(levels[level - 1][right] < values[who], right, right - 1).astype(np.int32)
    found[who] = at
    return found


def longest_previous_factors(
    levels: list[tuple[int, np.ndarray]], data: np.ndarray, at: np.ndarray, when: np.ndarray
) -> np.ndarray:
    """Per suffix, in suffix order, the length of its longest factor that an earlier one begins with,
    at most as many bytes as are ranked.

    ``at`` is where a suffix lies in ``data``, ``when`` its place in the order that says what is
    earlier. Of all earlier suffixes, those before and after it in suffix order that are nearest
    share most with it.
    """
    found = np.zeros(len(at), np.int64)
    for near in (smaller_before(when), len(when) - 1 - smaller_before(when[::-1])[::-1]):
        has = (near >= 0) & (near < len(when))
        found[has] = np.maximum(found[has], shared_length(levels, data, at[has], at[near[has]]))
    return found


def _solve_block(rows: list[tuple], length: int, first_stays: bool) -> tuple[list, list]:
    """Rows (ord, rid, first, crowded, data) to the runs (rid, first, factors) that another stretch
    of the block repeats, and of crowded anchors one of each kind of factor as (h1, h2, ord, rid,
    first, alone).

    With ``first_stays`` a factor counts if its longest previous factor has the length, else
    also if a later one repeats it.
    """
    sizes = np.array([len(r[-1]) for r in rows])
    offsets = np.cumsum([0, *(sizes + 1)])
    data = np.zeros(offsets[-1], np.int64)
    for offset, row in zip(offsets, rows):
        data[offset : offset + len(row[-1])] = np.frombuffer(row[-1], np.uint8).astype(np.int64) + 1
    levels = suffix_ranks(data, length)
    counts = sizes - (length - 1)
    owner = np.repeat(np.arange(len(rows)), counts)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = offsets[:-1][owner] + shift
    order, rid, first = (np.array([r[i] for r in rows]) for i in range(3))
    place = first[owner] + shift
    when = np.empty(len(owner), np.int32)
    when[np.lexsort((place, rid[owner], order[owner]))] = np.arange(len(owner), dtype=np.int32)
    by = np.lexsort((when, levels[-1][1][at]))
    earlier = longest_previous_factors(levels, data, at[by], when[by]) == length
    later = np.zeros(len(by), bool)
    if not first_stays:  # the same read backwards
        later = longest_previous_factors(levels, data, at[by], -when[by]) == length
    hit = np.zeros(len(by), bool)
    hit[by] = earlier | later
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8)))
    found = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        while a < b:  # a run may go on into the next stretch
            own = owner[a]
            end = min(b, int(np.searchsorted(owner, own, "right")))
            found.append((int(rid[own]), int(place[a]), end - a))
            a = end
    crowded = np.array([r[3] for r in rows])
    kinds = []
    first_of_kind = ~earlier & crowded[owner[by]]
    heads = by[first_of_kind]
    alone = dict(zip(heads.tolist(), (~later[first_of_kind]).tolist()))
    for i in heads.tolist():
        own, at = owner[i], int(shift[i])
        digest = xxhash.xxh3_128_digest(rows[own][-1][at : at + length])
        halves = np.frombuffer(digest, np.int64).tolist()
        kinds.append((*halves, int(order[own]), int(rid[own]), int(place[i]), alone[i]))
    return found, kinds


def _solve(batches: Iterator[pa.RecordBatch], length: int, first_stays: bool) -> Iterator[dict]:
    """Stretches sorted by anchor and part to repeated runs, in blocks of whole parts."""

    def out(rows: list[tuple]) -> dict:
        found, kinds = _solve_block(rows, length, first_stays)
        rid, first, factors = zip(*found) if found else ((), (), ())
        h1, h2, order, own, place, alone = zip(*kinds) if kinds else ((),) * 6
        none = [None] * len(found)
        return {
            "rid": [*rid, *own], "first": [*first, *place], "factors": [*factors, *[1] * len(kinds)],
            "h1": [*none, *h1], "h2": [*none, *h2], "ord": [*none, *order], "alone": [*none, *alone],
        }

    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("anchor", "part", "ord", "rid", "first", "crowded", "data"))
        for anchor, part, *row in zip(*columns):
            if held and (anchor, part) != last and size > BLOCK:
                yield out(held)
                held, size = [], 0
            held.append(tuple(row))
            size += len(row[-1])
            last = (anchor, part)
    if held:
        yield out(held)


def _not_alone(rows: DataFrame, keys: list[str], first_stays: bool, asking: str = "true") -> DataFrame:
    """Rows (of those ``asking``) whose keys occur ``times`` more than once in all, with
    ``first_stays`` but for the first of each. The join is on another spelling of the keys, so
    that it has shuffles of its own, which adaptive execution can split."""
    place = F.struct("ord", "rid", "first")
    known = rows.groupBy(*keys).agg(F.sum("times").alias("_n"), F.min(place).alias("_head"))
    known = known.where("_n > 1").select(*[F.bitwise_not(k).alias(f"_{k}") for k in keys], "_head")
    spelt = rows.where(asking).withColumns({f"_{k}": F.bitwise_not(k) for k in keys})
    found = spelt.join(known, [f"_{k}" for k in keys])
    return found.where(place != F.col("_head")) if first_stays else found


def repeated_factors(
    documents: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    first_stays: bool = False,
    max_stretches: int = MAX_STRETCHES,
) -> DataFrame:
    """``rid``, ``first``, ``factors``: runs of positions whose factor starts elsewhere too, or
    with ``first_stays`` earlier too, by ``_ord``, ``_rid`` and position.

    ``documents`` has ``_rid`` (unique), ``_ord`` and ``_text`` and must read the same each time.
    """
    span = ["rid", "first", "factors"]
    made: list[str] = []
    every = map_batches(
        documents.select("_rid", "_ord", "_text"),
        lambda b: _stretch_rows(b, length, gram, first_stays),
        "anchor long, whole long, rid long, ord long, first long, factors int, times long",
    )
    every = staged(every, "stretches", made)
    own = every.where("times = 0").select(*span)
    kinds = every.where("times > 0")
    twice = kinds.groupBy("anchor").agg(F.sum("times").alias("_n")).where("_n > 1")
    twice = twice.select(F.bitwise_not("anchor").alias("_anchor"))
    shared = kinds.withColumn("_anchor", F.bitwise_not("anchor")).join(twice, "_anchor").drop("_anchor")
    shared = staged(shared, "shared", made)
    whole = _not_alone(shared, ["anchor", "whole"], first_stays).select(*span)

    # One of each kind of stretch, where an anchor has several kinds.
    head = F.min(F.struct("ord", "rid", "first", "factors")).alias("head")
    heads = staged(shared.groupBy("anchor", "whole").agg(head).select("anchor", "whole", "head.*"), "kinds", made)
    several = heads.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = several.select(
        F.bitwise_not("anchor").alias("_anchor"), F.ceil(F.col("_n") / max_stretches).alias("_parts")
    )
    asked = heads.withColumn("_anchor", F.bitwise_not("anchor")).join(several, "_anchor")
    part = F.pmod("whole", "_parts").cast("int").alias("part")
    crowded = (F.col("_parts") > 1).alias("crowded")
    asked = asked.groupBy(F.col("rid").alias("_rid")).agg(
        F.collect_list(F.struct("anchor", part, crowded, "first", "factors")).alias("asked")
    )
    texts = documents.select("_rid", "_ord", "_text").join(asked.hint("shuffle_hash"), "_rid")
    parts = map_batches(
        texts,
        lambda b: _bytes_of(b, length),
        "anchor long, part int, crowded boolean, ord long, rid long, first long, data binary",
    )
    in_order = parts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    solved = map_batches(
        in_order,
        lambda b: _solve(b, length, first_stays),
        "rid long, first long, factors int, h1 long, h2 long, ord long, alone boolean",
    )
    solved = staged(solved, "solved", made)
    factors = solved.where("h1 IS NOT NULL").withColumn("times", F.lit(1))
    # What a block repeats by itself is known; the others may be repeated by another block.
    late = _not_alone(factors, ["h1", "h2"], first_stays, "true" if first_stays else "alone")
    runs = own.union(whole).union(solved.where("h1 IS NULL").select(*span)).union(late.select(*span))
    runs = staged(runs, "runs")
    drop_staged(documents.sparkSession, made)
    return runs


def merged(first: np.ndarray, factors: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs of bytes (start, end) that the factors cover."""
    if not len(first):
        return np.zeros((0, 2), np.int64)
    by = np.argsort(first, kind="stable")
    start, end = first[by], np.maximum.accumulate((first + factors + (length - 1))[by])
    new = np.append(True, start[1:] > end[:-1])
    return np.stack([start[new], np.append(end[:-1][new[1:]], end[-1])], axis=1)


def whole_characters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans drawn in to whole characters of UTF-8: a character that is cut stays."""
    found = []
    for start, end in spans.tolist():
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            found.append((start, end))
    return np.array(found, np.int64).reshape(-1, 2)


def _apply(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[dict]:
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, len(b), SLICE)):
        rows = []
        for text, found in zip(batch.column("_text"), batch.column("_found")):
            data = (text.as_py() or "").encode()
            spans = np.zeros((0, 2), np.int64)
            if found.is_valid:
                parts = found.values
                spans = merged(
                    parts.field("first").to_numpy(), parts.field("factors").to_numpy().astype(np.int64), length
                )
            edges = [0, *spans.ravel().tolist(), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            drawn = [0, *whole_characters(data, spans).ravel().tolist(), len(data)]
            new = b"".join(data[a:b] for a, b in zip(drawn[::2], drawn[1::2])).decode()
            rows.append((
                new if text.is_valid else None, len(data), len(data) - len(kept),
                [{"start": a, "end": b} for a, b in spans.tolist()], hashlib.sha256(kept).hexdigest(),
            ))
        columns = zip(*rows) if rows else [[]] * 5
        names = ("text", "n_bytes", "n_removed", "spans", "kept_sha256")
        yield {"_row": batch.column("_row")} | dict(zip(names, map(list, columns)))


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    first_stays: bool = True,
    max_stretches: int = MAX_STRETCHES,
) -> DataFrame:
    """All columns of ``documents`` as the struct ``row``, and what is left of ``text``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the same
    document or another, is removed; with ``first_stays`` if it also starts earlier, so that the
    first copy of everything stays. First goes by ``key`` as a number (null and others last), then
    by row. Strings are judged on the input. Columns: ``row``, ``text`` (what is left, with
    characters that a cut would halve left in), ``n_bytes``, ``n_removed``, ``spans`` (removed runs
    of bytes), ``kept_sha256`` (of exactly the bytes left).

    Null texts count as empty and stay null; repeated rows are copies of each other, ties of the
    key are broken by row; an empty table gives an empty one. The documents are written once to a
    table bucketed by row, so that their texts are not moved again; what moves are hashes.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"contractlake_texts_{uuid.uuid4().hex}"
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("_row"),
        F.coalesce(F.col(f"`{key}`").try_cast("long"), F.lit((1 << 63) - 1)).alias("_ord"),
        F.col("text").alias("_text"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    rows.repartition(parts, "_rid").write.bucketBy(parts, "_rid").option(
        "path", scratch_dir(spark, "texts")
    ).saveAsTable(name)
    texts = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and with them what has been read from the name
    runs = repeated_factors(texts, length, gram, first_stays, max_stretches)
    found = runs.groupBy(F.col("rid").alias("_rid")).agg(
        F.collect_list(F.struct("first", "factors")).alias("_found")
    )
    both = texts.join(found.hint("shuffle_hash"), "_rid", "left").select("_row", "_text", "_found")
    row = both.schema["_row"].dataType.simpleString()
    return map_batches(
        both,
        lambda b: _apply(b, length),
        f"_row {row}, text string, n_bytes long, n_removed long, "
        "spans array<struct<start:long,end:long>>, kept_sha256 string",
    ).withColumnRenamed("_row", "row")
