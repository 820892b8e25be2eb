"""Embedding near-duplicates by an epsilon grid order join.

Vectors of length one are within an angle of each other exactly if they are within a distance of
epsilon. They are sorted by grid cells of that width on the leading principal directions; intervals
of the sequence carry their bounds on these directions, and two intervals whose bounds are more
than epsilon apart hold no pair. Intervals are joined from the top down: pairs that may hold
something are split into pairs of their parts until they are blocks, and only blocks meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contractlake.llm.common import map_batches, staged
from contractlake.llm.components import components, with_group_min

THRESHOLD = 0.98
DIRECTIONS = 8
BLOCK_ROWS = 512
FANOUT = 64
# Tasks that add up what all tasks have found.
SUMS = 16
# Added to a distance bound before anything is skipped: more than rounding can take away.
SLACK = 1e-7


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key``, ``vec`` and ``class``: which vectors may link with which.

    Vectors of floats stay floats on their way, all others are doubles; sums are taken in doubles.
    The class is the label with the number of components; it is null for vectors that link with
    nothing: null or empty ones, zero ones, and those with a null or non-finite component, as
    well as rows without a label.
    """
    given = dict(vectors.dtypes)[vector]
    vec = F.col(f"`{vector}`").cast(given if given == "array<float>" else "array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    ok = F.coalesce(fine & some, F.lit(False)) & F.col(f"`{label}`").isNotNull()
    name = F.concat_ws("/", F.col(f"`{label}`").cast("string"), F.size(vec).cast("string"))
    return vectors.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.when(ok, vec).alias("vec"), F.when(ok, name).alias("class")
    )


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; each is scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per task and dimension: number, sum and products of the unit vectors."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes = np.diff(batch.column("vec").offsets.to_numpy())
        for d in np.unique(sizes):
            x = _unit(_matrix(batch.column("vec").filter(pa.array(sizes == d))))
            x = np.hstack([x, np.ones((len(x), 1))])
            sums[int(d)] = sums.get(int(d), 0) + x.T @ x
    yield {"d": list(sums), "products": [m.ravel() for m in sums.values()]}


def _add_scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, products in zip(batch.column("d").to_pylist(), batch.column("products")):
            sums[d] = sums.get(d, 0) + products.values.to_numpy()
    yield {"d": list(sums), "products": list(sums.values())}


def principal_directions(distinct: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """Per number of components the leading eigenvectors of the covariance, as columns.

    The driver gets ``SUMS`` d x d matrices per dimension, no vector. Any orthonormal
    directions give right results; these separate best.
    """
    products = "d int, products array<double>"
    parts = map_batches(distinct.select("vec"), _scatter, products)
    added = map_batches(parts.repartition(SUMS), _add_scatter, products)
    sums: dict[int, np.ndarray] = {}
    for row in added.collect():
        sums[row.d] = sums.get(row.d, 0) + np.array(row.products)
    directions: dict[int, np.ndarray] = {}
    for d, flat in sums.items():
        m = flat.reshape(d + 1, d + 1)
        mean = m[-1, :-1] / m[-1, -1]
        _, vectors = np.linalg.eigh(m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean))
        directions[d] = np.ascontiguousarray(vectors[:, ::-1][:, :leading])
    return directions


def _project(batches: Iterator[pa.RecordBatch], directions: dict, epsilon: float, leading: int) -> Iterator[dict]:
    for batch in batches:
        sizes = np.diff(batch.column("vec").offsets.to_numpy())
        for d in np.unique(sizes):
            rows = batch.filter(pa.array(sizes == d))
            away = np.zeros((len(rows), leading))
            y = _unit(_matrix(rows.column("vec"))) @ directions[int(d)]
            away[:, : y.shape[1]] = y
            cells = np.floor(away / epsilon).astype(np.int64)
            yield {n: rows.column(n) for n in ("class", "vec", "least", "copies")} | {
                "near": list(away),
                **{f"c{i}": cells[:, i] for i in range(leading)},
            }


def _blocks(batches: Iterator[pa.RecordBatch], rows_per_block: int) -> Iterator[dict]:
    """Runs of sorted rows of one class as one row each."""

    def block(name: str, rows: list[tuple]) -> dict:
        vecs, near, least, copies = zip(*rows)
        near = np.array(near)
        return {
            "class": [name], "lo": [near.min(axis=0)], "hi": [near.max(axis=0)],
            "vecs": [np.concatenate(vecs)], "least": [np.array(least)], "copies": [np.array(copies)],
        }

    held: list[tuple] = []
    name = None
    for batch in batches:
        columns = [batch.column(n) for n in ("class", "vec", "near", "least", "copies")]
        for row_name, vec, near, least, copies in zip(
            columns[0].to_pylist(), _rows_of(columns[1]), _rows_of(columns[2]), *[c.to_pylist() for c in columns[3:]]
        ):
            if held and (row_name != name or len(held) == rows_per_block):
                yield block(name, held)
                held = []
            name = row_name
            held.append((vec, near, least, copies))
    if held:
        yield block(name, held)


def _rows_of(column) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _apart(a: str, b: str):
    """Squared distance of two boxes, from columns ``lo`` and ``hi`` of each."""
    gaps = F.zip_with(
        F.zip_with(f"{a}.lo", f"{b}.hi", lambda x, y: x - y),
        F.zip_with(f"{b}.lo", f"{a}.hi", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)


def near_blocks(blocks: DataFrame, epsilon: float, fanout: int = FANOUT) -> DataFrame:
    """``i`` <= ``j``: places of blocks of one class whose bounds are within epsilon.

    ``blocks`` has ``class``, ``block`` (gapless from 0 in a class in sequence order), ``place``,
    ``lo``, ``hi``.
    ``fanout`` intervals in sequence make one interval of the next level, up to a level with one
    per class. From there down, each pair of intervals is joined to the pairs of its parts by
    equality of the parent, and pairs too far apart end there.
    """
    levels = [blocks.select("class", F.col("block").alias("id"), "lo", "hi", "place")]
    most = levels[0].agg(F.max("id").alias("m")).first().m
    size = blocks.select(F.size("lo").alias("n")).first()
    count = size.n if size else 0
    while most:
        up = levels[-1].groupBy("class", F.floor(F.col("id") / fanout).cast("long").alias("id")).agg(
            F.array(*[F.min(F.get("lo", F.lit(k))) for k in range(count)]).alias("lo"),
            F.array(*[F.max(F.get("hi", F.lit(k))) for k in range(count)]).alias("hi"),
        )
        levels.append(staged(up, "intervals"))
        most //= fanout
    top = levels[-1]
    name = "place" if len(levels) == 1 else "id"
    pairs = top.select("class", F.col(name).alias("i"), F.col(name).alias("j"))
    limit = epsilon * epsilon + SLACK
    for n, level in reversed([*enumerate(levels[:-1])]):
        name = "id" if n else "place"
        parts = level.withColumn("parent", F.floor(F.col("id") / fanout).cast("long"))
        left = parts.select("class", F.col("parent").alias("i"), F.struct(*dict.fromkeys(["id", "lo", "hi", name])).alias("a"))
        right = parts.select("class", F.col("parent").alias("j"), F.struct(*dict.fromkeys(["id", "lo", "hi", name])).alias("b"))
        met = pairs.join(left, ["class", "i"]).join(right, ["class", "j"])
        near = met.where("a.id <= b.id").where(_apart("a", "b") <= limit)
        pairs = near.select("class", F.col(f"a.{name}").alias("i"), F.col(f"b.{name}").alias("j"))
        pairs = staged(pairs, "near")
    return pairs


def _exact(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine in double precision."""
    return float((x * y).sum() / (math.sqrt((x * x).sum()) * math.sqrt((y * y).sum())))


def _meet(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[dict]:
    """Pairs of blocks to links: per vector the number of copies it links, and links that join
    what the pairs join."""
    for batch in batches:
        least, links, u, v = [], [], [], []
        for row in range(len(batch)):
            side = {}
            for s in ("i", "j"):
                ids = batch.column(f"{s}_least")[row].values.to_numpy()
                vecs = batch.column(f"{s}_vecs")[row].values.to_numpy().astype(np.float64).reshape(len(ids), -1)
                side[s] = (ids, batch.column(f"{s}_copies")[row].values.to_numpy(), vecs, _unit(vecs))
            same = batch.column("same")[row].as_py()
            (ids_i, copies_i, vec_i, unit_i), (ids_j, copies_j, vec_j, unit_j) = side["i"], side["j"]
            cos = unit_i @ unit_j.T
            near = cos >= threshold
            # Within rounding of the threshold the plain formula decides.
            for a, b in np.argwhere(np.abs(cos - threshold) < 1e-9):
                near[a, b] = _exact(vec_i[a], vec_j[b]) >= threshold
            if same:
                np.fill_diagonal(near, False)
            from_i = near @ copies_j
            hit = np.flatnonzero(from_i)
            least += ids_i[hit].tolist()
            links += from_i[hit].tolist()
            if not same:
                from_j = copies_i @ near
                hit = np.flatnonzero(from_j)
                least += ids_j[hit].tolist()
                links += from_j[hit].tolist()
            for a, b in _forest(near, same):
                u.append(int(ids_i[a]))
                v.append(int(ids_j[b]))
        empty = [None] * len(u)
        yield {
            "least": least + empty, "links": links + empty,
            "u": [None] * len(least) + u, "v": [None] * len(least) + v,
        }


def _forest(near: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Fewer links than vectors that join what the pairs in the matrix join."""
    rows, columns = near.shape
    free_rows, free_columns = near.any(axis=1), near.any(axis=0)
    links = []
    while free_rows.any():
        edge = [int(np.flatnonzero(free_rows)[0])]
        free_rows[edge[0]] = False
        if same:
            free_columns[edge[0]] = False
        while edge:
            a = edge.pop()
            found = np.flatnonzero(near[a] & free_columns)
            links += [(a, int(b)) for b in found]
            free_columns[found] = False
            if same:
                free_rows[found] = False
                edge += found.tolist()
                continue
            for b in found.tolist():
                more = np.flatnonzero(near[:, b] & free_rows)
                links += [(int(c), b) for c in more]
                free_rows[more] = False
                edge += more.tolist()
    return links


def embedding_classes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    leading: int = DIRECTIONS,
    block_rows: int = BLOCK_ROWS,
    fanout: int = FANOUT,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id``, ``kept`` for each row.

    Vectors link when their labels are equal and their cosine, in double precision, is
    ``threshold`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is
    the least key that links reach, and the row with that key is kept. Equal vectors of a class
    are one vector with a number of copies, so a group of copies of any size is one row in the
    join. Rows that link with nothing (see ``usable``) are components of their own; a null
    key is no number, so it is no component's least unless there is no other; several rows with one key are as many vectors. Blocks hold a
    fixed number of vectors; what reaches the driver are the principal directions and the number
    of blocks. An empty table gives an empty one.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    epsilon = math.sqrt(2 - 2 * threshold) + SLACK
    rows = usable(vectors, key, vector, label)
    rows = staged(rows.select("*", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")), "vectors")
    same = ["class", "h1", "h2"]  # 128 bits of the vector
    distinct = rows.where("class IS NOT NULL").groupBy(*same).agg(
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.first("vec").alias("vec")
    )
    distinct = staged(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct")
    linked, parts = _linked(distinct, threshold, epsilon, leading, block_rows, fanout)
    placed = distinct.select(*same, "copies", "least", "id")
    placed = placed.join(linked, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    named = with_group_min(placed, "component", "least", "component_id").select(
        *same, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    found = rows.select("key", *same).join(staged(named, "named"), same, "left")
    component = F.coalesce("component_id", "key")
    return found.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _linked(
    distinct: DataFrame, threshold: float, epsilon: float, leading: int, block_rows: int, fanout: int
) -> tuple[DataFrame, DataFrame]:
    """Per vector id the copies it links, and the components of the ids."""
    ready = distinct.select("class", "vec", F.col("id").alias("least"), "copies")
    numbers = dict(ready.dtypes)["vec"]
    directions = principal_directions(ready, leading)
    cells = [f"c{i}" for i in range(leading)]
    near = ", ".join(f"{c} long" for c in cells)
    projected = map_batches(
        ready,
        lambda b: _project(b, directions, epsilon, leading),
        f"class string, vec {numbers}, least long, copies long, near array<double>, {near}",
    )
    order = ["class", *cells, "least"]
    in_order = projected.repartitionByRange(*order).sortWithinPartitions(*order)
    made = map_batches(
        in_order,
        lambda b: _blocks(b, block_rows),
        f"class string, lo array<double>, hi array<double>, vecs {numbers}, least array<long>, copies array<long>",
    )
    blocks = staged(made.withColumn("place", F.monotonically_increasing_id()), "blocks")
    # One row per block, numbered in sequence order within the class.
    number = F.row_number().over(Window.partitionBy("class").orderBy("place")) - 1
    summary = staged(
        blocks.select("class", "lo", "hi", "place").withColumn("block", number.cast("long")), "bounds"
    )
    pairs = near_blocks(summary, epsilon, fanout)
    bodies = blocks.select("place", "vecs", "least", "copies")

    def body(df: DataFrame, name: str) -> DataFrame:
        own = bodies.select(F.col("place").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("vecs", "least", "copies")])
        return df.join(own, name)

    both = pairs.select("i", "j", (F.col("i") == F.col("j")).alias("same"))
    met = body(body(both, "i"), "j").drop("i", "j")
    links = staged(
        map_batches(met, lambda b: _meet(b, threshold), "least long, links long, u long, v long"), "links"
    )
    counts = links.where("least IS NOT NULL").groupBy(F.col("least").alias("id")).agg(F.sum("links").alias("links"))
    parts = components(links.where("u IS NOT NULL").select("u", "v"))
    return counts, staged(parts, "components")
