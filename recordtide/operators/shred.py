"""Nested records of any depth as flat tables with stable keys, and back.

``plan_tables`` walks a schema: structs become columns of their table, every array and map becomes a child table, to any depth.
A row's key is the text of its parent's key with its position behind it (``17/0/2``), the same on every run. Beside the values
a table holds what flat rows would lose: which optional structs are there (``_there``), and the length of each array and map,
null where it is null (``_size``). So the records can be put together again exactly.

The source is read once: it is written to the shared folder, and each table reads from there only the nested columns it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.session import cut_lineage

KEY, PARENT, POSITION = "_key", "_parent", "_pos"
_ELEMENT = "_element"
Path = tuple[str, ...]


@dataclass
class Shape:
    """One flat table. ``path`` leads to its array or map inside the parent's element, ``kind`` is the type of an element."""

    name: str
    path: Path
    kind: T.DataType
    is_map: bool = False
    #: Column name -> what it holds (``value``, ``there`` or ``size``) and the path to it.
    columns: dict[str, tuple[str, Path]] = field(default_factory=dict)
    children: list[Shape] = field(default_factory=list)

    def walk(self) -> Iterator[Shape]:
        yield self
        for child in self.children:
            yield from child.walk()

    def column(self, what: str, path: Path) -> str:
        return next(name for name, held in self.columns.items() if held == (what, path))

    @property
    def is_junction(self) -> bool:
        """Whether the elements are entities of their own, to be referred to by id."""
        return isinstance(self.kind, T.StructType) and "ID" in self.kind.names


def _unique(wanted: str, taken) -> str:
    name, n = wanted, 2
    while name in taken:
        name, n = f"{wanted}_{n}", n + 1
    return name


def _fields(kind: T.DataType) -> T.StructType:
    """The fields of an element; one that is no struct is the field ``value``."""
    return kind if isinstance(kind, T.StructType) else T.StructType([T.StructField("value", kind)])


def _fill(shape: Shape, kind: T.StructType, path: Path, names: set[str]) -> None:
    def add(what: str, at: Path) -> None:
        wanted = "_".join(at) + ("" if what == "value" else f"_{what}")
        shape.columns[_unique(wanted, {KEY, PARENT, POSITION, *shape.columns})] = (what, at)

    for item in kind.fields:
        at, own = (*path, item.name), item.dataType
        if isinstance(own, T.StructType):
            add("there", at)
            _fill(shape, own, at, names)
        elif isinstance(own, (T.ArrayType, T.MapType)):
            add("size", at)
            is_map = isinstance(own, T.MapType)
            element = T.StructType([T.StructField("key", own.keyType), T.StructField("value", own.valueType)]) if is_map else own.elementType
            name = _unique("_".join((shape.name, *at)), names)
            names.add(name)
            child = Shape(name, at, element, is_map)
            if isinstance(element, T.StructType) and not is_map:
                child.columns["_there"] = ("there", ())
            _fill(child, _fields(element), (), names)
            shape.children.append(child)
        else:
            add("value", at)


def plan_tables(schema: T.StructType, name: str) -> Shape:
    """The tables of a record type, as a tree."""
    root = Shape(name, (), schema)
    _fill(root, schema, (), {name})
    return root


def _at(element: Column | None, path: Path) -> Column:
    if element is None:
        element, path = F.col(f"`{path[0]}`"), path[1:]
    for name in path:
        element = element[name]
    return element


def _flat(shape: Shape, rows: DataFrame, keys: list[str], element: Column | None) -> DataFrame:
    parts = {
        "value": lambda path: _at(element, path),
        "there": lambda path: _at(element, path).isNotNull(),
        "size": lambda path: F.when(_at(element, path).isNotNull(), F.size(_at(element, path))),
    }
    return rows.select(*keys, *[parts[what](path).alias(name) for name, (what, path) in shape.columns.items()])


def shred(records: DataFrame, name: str, key: str = "ID") -> tuple[Shape, dict[str, DataFrame]]:
    """The tables of ``records`` by name, and their plan. ``key`` is a column of unique, non-null values."""
    shape = plan_tables(records.schema, name)
    source = cut_lineage(records)
    keyed = source.withColumn(KEY, F.col(f"`{key}`").cast("string"))
    tables = {name: _flat(shape, keyed, [KEY], None)}

    def below(parent: Shape, rows: DataFrame, element: Column | None) -> None:
        for child in parent.children:
            items = _at(element, child.path)
            if child.is_map:
                items = F.map_entries(items)
            # Null and empty ones have no rows; their sizes stand in the parent.
            exploded = rows.select(F.col(KEY).alias(PARENT), F.posexplode(items).alias(POSITION, _ELEMENT))
            own = F.col(_ELEMENT)
            if not isinstance(child.kind, T.StructType):
                exploded = exploded.withColumn(_ELEMENT, F.struct(own.alias("value")))
            exploded = exploded.withColumn(KEY, F.concat_ws("/", PARENT, POSITION))
            tables[child.name] = _flat(child, exploded, [KEY, PARENT, POSITION], own)
            below(child, exploded, own)

    below(shape, keyed, None)
    return shape, tables


def _lists(shape: Shape, tables: dict[str, DataFrame]) -> DataFrame:
    """The elements of each parent as an array in order: ``(_parent, _items)``."""
    rows = _with_lists(shape, tables)
    element = _rebuilt(shape, _fields(shape.kind), ())
    if "_there" in shape.columns:
        element = F.when(F.col("_there"), element)
    if not isinstance(shape.kind, T.StructType):
        element = element["value"]
    pairs = rows.select(PARENT, F.struct(POSITION, element.alias("item")).alias("_pair")).groupBy(PARENT).agg(F.collect_list("_pair").alias("_pairs"))
    # By position alone: elements may hold maps, which have no order.
    ordered = F.array_sort("_pairs", lambda x, y: x[POSITION] - y[POSITION])
    return pairs.select(PARENT, F.transform(ordered, lambda pair: pair["item"]).alias("_items"))


def _with_lists(shape: Shape, tables: dict[str, DataFrame]) -> DataFrame:
    """The table's rows with the arrays of its children, each in a column named after the child."""
    rows = tables[shape.name]
    for child in shape.children:
        lists = _lists(child, tables).select(F.col(PARENT).alias("_owner"), F.col("_items").alias(f"_list {child.name}"))
        rows = rows.join(lists, F.col(KEY) == F.col("_owner"), "left").drop("_owner")
    return rows


def _rebuilt(shape: Shape, kind: T.StructType, path: Path) -> Column:
    parts = []
    for item in kind.fields:
        at, own = (*path, item.name), item.dataType
        if isinstance(own, T.StructType):
            value = F.when(F.col(f"`{shape.column('there', at)}`"), _rebuilt(shape, own, at))
        elif isinstance(own, (T.ArrayType, T.MapType)):
            child = next(c for c in shape.children if c.path == at)
            size, items = F.col(f"`{shape.column('size', at)}`"), F.col(f"`_list {child.name}`")
            whole = F.map_from_entries(items) if child.is_map else items
            empty = F.from_json(F.lit("{}" if child.is_map else "[]"), own)
            value = F.when(size == 0, empty).when(size > 0, whole).cast(own)
        else:
            value = F.col(f"`{shape.column('value', at)}`")
        parts.append(value.alias(item.name))
    return F.struct(*parts)


def assemble(shape: Shape, tables: dict[str, DataFrame]) -> DataFrame:
    """The nested records again, equal to those that were shredded."""
    rows = _with_lists(shape, tables).select(_rebuilt(shape, shape.kind, ()).alias("_record"))
    return rows.select("_record.*")


def junction(shape: Shape, tables: dict[str, DataFrame]) -> DataFrame:
    """For an array of entities: which row refers to which, ``(_parent, _pos, ID)``. The entities are the table's distinct rows."""
    if not shape.is_junction:
        raise ValueError(f"{shape.name} holds no entities")
    found = tables[shape.name].select(PARENT, POSITION, F.col(f"`{shape.column('value', ('ID',))}`").alias("ID"))
    return found.where(F.col("ID").isNotNull())


def entities(shape: Shape, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per id of an array of entities, its plain columns from the greatest mention as a whole."""
    if not shape.is_junction:
        raise ValueError(f"{shape.name} holds no entities")
    key = shape.column("value", ("ID",))
    rest = [name for name, (what, path) in shape.columns.items() if name != key and path]
    mentions = tables[shape.name].where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("ID"))
    if not rest:
        return mentions.agg(F.lit(1)).select("ID")
    return mentions.agg(F.max(F.struct(*[F.col(f"`{name}`") for name in rest])).alias("_mention")).select("ID", *[F.col("_mention")[name].alias(name) for name in rest])
