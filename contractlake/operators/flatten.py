"""Nested schema to flat columns, with renaming and array policies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

Path = tuple[str, ...]


def as_path(path: str | Path) -> Path:
    """Dotted text to a tuple; give a tuple when an element name itself holds a dot."""
    return tuple(path.split(".")) if isinstance(path, str) else tuple(path)


def column(path: str | Path) -> Column:
    """Column at a nested path, each segment quoted (names hold ``:`` and may hold dots)."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in as_path(path)))


def named(name: str) -> Column:
    """Top-level column of exactly this name."""
    return column((name,))


def as_before(value: Column, field: T.StructField) -> Column:
    """A new value for a column that keeps its name and metadata, which expressions lose."""
    return value.alias(field.name, metadata=field.metadata)


def type_at(schema: T.StructType, path: str | Path) -> T.DataType | None:
    """Type at a nested path, None when the path is absent."""
    here: T.DataType = schema
    for part in as_path(path):
        if not isinstance(here, T.StructType) or part not in here.names:
            return None
        here = here[part].dataType
    return here


def column_or_null(schema: T.StructType, path: str | Path, dtype: str = "string") -> Column:
    """Column at the path, or a typed null where no file of this run has the element."""
    found = type_at(schema, path)
    return F.lit(None).cast(dtype) if found is None else column(path)


def leaf_paths(schema: T.StructType, above: Path = ()) -> list[Path]:
    """Paths of everything that is not a struct, depth first, in schema order."""
    found: list[Path] = []
    for field in schema.fields:
        here = above + (field.name,)
        inner = field.dataType
        found += leaf_paths(inner, here) if isinstance(inner, T.StructType) else [here]
    return found


def select_paths(
    paths: Iterable[Path],
    include: Iterable[str | Path] = (),
    exclude: Iterable[str | Path] = (),
) -> list[Path]:
    """Paths under one of ``include`` (all when empty) and under none of ``exclude``.

    Prefixes match whole segments: ``ns1:vendor`` does not take ``ns1:vendorX`` along.
    """

    def under(path: Path, prefixes: list[Path]) -> bool:
        return any(path[: len(prefix)] == prefix for prefix in prefixes)

    wanted = [as_path(prefix) for prefix in include]
    unwanted = [as_path(prefix) for prefix in exclude]
    return [p for p in paths if (not wanted or under(p, wanted)) and not under(p, unwanted)]


def local_name(path: str | Path) -> str:
    """Last segment without its namespace prefix."""
    return as_path(path)[-1].rsplit(":", 1)[-1]


def rename_paths(paths: Iterable[Path], mapping: Mapping[str, str] | None = None) -> dict[Path, str]:
    """Output name per path: the mapped name as given, else the local name.

    Two paths with one name (Spark ignores case) raise an error that names both.
    """
    mapping = mapping or {}
    names: dict[Path, str] = {}
    taken: dict[str, Path] = {}
    for path in paths:
        name = mapping.get(".".join(path), local_name(path))
        other = taken.setdefault(name.lower(), path)
        if other != path:
            raise ValueError(
                f"column name {name!r} stands for both {'.'.join(other)} and {'.'.join(path)}; "
                "rename one of them"
            )
        names[path] = name
    return names


def _joined_array(value: Column, dtype: T.ArrayType, sep: str) -> Column:
    if isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return F.array_join(value, sep)


def flatten(
    df: DataFrame,
    include: Iterable[str | Path] = (),
    exclude: Iterable[str | Path] = (),
    carry: Iterable[str | Path] = (),
    rename: Mapping[str, str] | None = None,
    arrays: str = "keep",
    array_sep: str = ",",
) -> DataFrame:
    """One flat column per leaf of the nested schema, in one projection.

    ``carry`` adds leaves (keys) after the selected ones; a carried path that is absent becomes
    a null text column. ``arrays``: ``keep`` leaves repeated elements as arrays, ``join`` makes
    text of them (JSON when the elements are nested), ``child`` leaves them out, to be read
    with :func:`array_child`. The path a column came from is kept in its metadata.
    """
    if arrays not in ("keep", "join", "child"):
        raise ValueError(f"unknown array policy {arrays!r}")
    paths = select_paths(leaf_paths(df.schema), include, exclude)
    paths += [p for p in map(as_path, carry) if p not in paths]
    columns = []
    for path, name in rename_paths(paths, rename).items():
        dtype = type_at(df.schema, path)
        value = column_or_null(df.schema, path)
        if isinstance(dtype, T.ArrayType) and arrays != "keep":
            if arrays == "child":
                continue
            value = _joined_array(value, dtype, array_sep)
        columns.append(value.alias(name, metadata={"path": ".".join(path)}))
    return df.select(*columns)


def array_child(
    df: DataFrame,
    path: str | Path,
    keys: Mapping[str, str | Path],
    outer: bool = False,
) -> DataFrame:
    """Child table of a repeated element: the keys, ``position`` (from 0) and its value.

    Elements that are structs are flattened; ``outer`` keeps parents without any element.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    item = local_name(path)
    rows = df.select(
        *[column(source).alias(name) for name, source in keys.items()],
        explode(column(path)).alias("position", item),
    )
    if isinstance(rows.schema[item].dataType, T.StructType):
        rows = flatten(rows)
    return rows


def position_name(depth: int) -> str:
    """Column of a child table that counts a repeated element inside the ``depth - 1`` around it."""
    return f"position_{depth}"


def child_tables(
    df: DataFrame,
    keys: Mapping[str, str | Path],
    include: Iterable[str | Path] = (),
    exclude: Iterable[str | Path] = (),
    rename: Mapping[str, str] | None = None,
) -> dict[Path, DataFrame]:
    """A child table for every repeated element, at whatever depth, by its path.

    A row is one occurrence: the keys, its place (from 0) in each repeated element around it and in its own,
    ``position_1`` and so on, and its own leaves, flattened and named as by :func:`flatten`. Elements repeated inside it
    are in tables of their own, whose rows begin with the same keys and positions. An element
    that does not occur, or is null at its place, has no row. Each table is one pass over ``df`` and nothing is shuffled.
    """
    tables: dict[Path, DataFrame] = {}

    def below(rows: DataFrame, head: list[str], fields: T.StructType, above: Path, at: Path, depth: int) -> None:
        """``rows`` has the columns ``head`` and, at path ``at``, a struct of ``fields``."""
        for path in leaf_paths(fields):
            dtype, whole = type_at(fields, path), above + path
            if not isinstance(dtype, T.ArrayType) or (depth == 1 and not select_paths([whole], include, exclude)):
                continue
            place = position_name(depth)
            each = rows.select(*map(named, head), F.posexplode(column(at + path)).alias(place, "_item")).where("_item IS NOT NULL")
            inner, own = dtype.elementType, [*head, place]
            if isinstance(inner, T.StructType):
                leaves = [p for p in leaf_paths(inner) if not isinstance(type_at(inner, p), T.ArrayType)]
                names = rename_paths([whole + p for p in leaves], rename)
                columns = [column(("_item", *p)).alias(names[whole + p], metadata={"path": ".".join(whole + p)}) for p in leaves]
            else:
                name = (rename or {}).get(".".join(whole), local_name(whole))
                columns = [named("_item").alias(name, metadata={"path": ".".join(whole)})]
            taken = {c.lower() for c in own}
            found = each.select(*map(named, own), *columns)
            if clash := [c for c in found.columns[len(own) :] if c.lower() in taken]:
                raise ValueError(f"{clash} of {'.'.join(whole)} are names of keys or positions; rename them")
            tables[whole] = found
            if isinstance(inner, T.StructType):
                below(each, own, inner, whole, ("_item",), depth + 1)

    table = df.select(*[column(path).alias(name) for name, path in keys.items()], F.struct(*map(named, df.columns)).alias("_row"))
    below(table, list(keys), df.schema, (), ("_row",), 1)
    return tables


def gathered(tables: Mapping[Path, DataFrame], path: Path, keys: Iterable[str]) -> DataFrame:
    """The occurrences of a repeated element put together again: the keys and one array of structs (or of
    values), with the elements repeated inside, in order, under their local names.

    What :func:`child_tables` took apart, from the deepest up: each group is what one parent
    holds, so it is no larger than a record. An occurrence of which nothing is known is left out.
    """
    keys = list(keys)
    depth = sum(path[: len(other)] == other for other in tables)
    rows = tables[path]
    places = [*keys, *map(position_name, range(1, depth + 1))]
    leaves = [c for c in rows.columns if c not in places]
    scalar = len(leaves) == 1 and rows.schema[leaves[0]].metadata.get("path") == ".".join(path)
    inner = [p for p in tables if p != path and p[: len(path)] == path and not any(
        q != path and q != p and q[: len(path)] == path and p[: len(q)] == q for q in tables)]
    for child in inner:
        rows = rows.join(gathered(tables, child, places), places, "left")
    held = named(leaves[0]) if scalar else F.struct(*map(named, leaves), *[named(local_name(p)) for p in inner])
    one = rows.groupBy(*map(named, places[:-1])).agg(F.sort_array(F.collect_list(F.struct(named(places[-1]).alias("at"), held.alias("it")))).alias("all"))
    return one.select(*map(named, places[:-1]), F.col("all.it").alias(local_name(path)))
