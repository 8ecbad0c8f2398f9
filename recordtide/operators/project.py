"""Projections that turn nested records into flat, typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.functions.names import column_name, snake_case, spelling_key
from recordtide.functions.scalars import parse_id, parse_rfc3339_utc
from recordtide.schemas import ENTITY_TABLES, EXCLUDED_COLUMNS, FIELD_ALLOWLIST, RESOURCE_COLUMNS

_IDENTITY = ("ID", "id")
_COMPLEX = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def columns_to_include(records: DataFrame, resource: str) -> DataFrame:
    """The fixed column list of a resource, as far as the records have them."""
    return records.select(*[name for name in RESOURCE_COLUMNS[resource] if name in records.columns])


def select_columns(df: DataFrame, columns: str | Iterable[str] | None) -> DataFrame:
    """Caller-chosen columns, as a list or comma-separated text; all when empty."""
    names = columns.split(",") if isinstance(columns, str) else list(columns or [])
    names = [name.strip() for name in names if name.strip()]
    return df.select(*names) if names else df


def field_allowlist(records: DataFrame, entity: str, allowed: Mapping[str, Iterable[str]] = FIELD_ALLOWLIST) -> DataFrame:
    """Keep only the listed fields of the entity and of the entities nested in it.

    Entities without a list keep all fields.
    """

    def keep(kind: T.StructType, name: str) -> list[T.StructField]:
        listed = allowed.get(name)
        return [field for field in kind if listed is None or field.name in listed]

    def prune(value: Column, kind: T.DataType, name: str) -> Column:
        if isinstance(kind, T.StructType):
            kept = [prune(value[f.name], f.dataType, f.name).alias(f.name) for f in keep(kind, name)]
            return F.when(value.isNotNull(), F.struct(*kept)) if kept else F.lit(None)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.transform(value, lambda item: prune(item, kind.elementType, name))
        return value

    return records.select(
        *[prune(F.col(f.name), f.dataType, f.name).alias(f.name) for f in keep(records.schema, entity)]
    )


def exclude_columns(
    records: DataFrame, entity: str, excluded: Mapping[str, Iterable[str]] = EXCLUDED_COLUMNS
) -> DataFrame:
    """Drop the columns excluded everywhere (``*``) and those excluded for the entity."""
    return records.drop(*excluded.get("*", ()), *excluded.get(entity, ()))


def json_fallback(df: DataFrame, *columns: str) -> DataFrame:
    """Shapeless values stay JSON: text and nested columns become variants, bad JSON null."""

    def as_variant(name: str) -> Column:
        kind = df.schema[name].dataType
        return F.try_parse_json(F.to_json(name) if isinstance(kind, _COMPLEX) else F.col(name))

    return df.withColumns({name: as_variant(name) for name in columns})


def flatten_struct(df: DataFrame, column: str, taken: Iterable[str] = ()) -> DataFrame:
    """Inline a sub-object as ``<prefix>_<child>`` columns in its place.

    Its id is left out, children spelled alike up to ``iz`` / ``is`` yield the first
    one, and a nested child stays JSON text.
    """
    prefix = column_name(column)
    seen = {spelling_key(name) for name in taken}
    inlined = []
    for field in df.schema[column].dataType:
        name = f"{prefix}_{snake_case(field.name)}"
        if field.name in _IDENTITY or spelling_key(name) in seen:
            continue
        seen.add(spelling_key(name))
        child = F.col(f"{column}.{field.name}")
        inlined.append((F.to_json(child) if isinstance(field.dataType, _COMPLEX) else child).alias(name))
    at = df.columns.index(column)
    return df.select(*df.columns[:at], *inlined, *df.columns[at + 1 :])


def struct_to_fk(df: DataFrame, column: str) -> DataFrame:
    """Replace a sub-object that names an entity by ``<name>_id``."""
    target = column_name(column if column.endswith(("ID", "Id")) else column + "Id")
    at = df.columns.index(column)
    key = parse_id(F.col(f"{column}.ID")).alias(target)
    return df.select(*df.columns[:at], key, *df.columns[at + 1 :])


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename every column to its cache spelling."""
    return df.toDF(*[column_name(name) for name in df.columns])


def promote_temporal(df: DataFrame) -> DataFrame:
    """Text columns with ``date`` or ``iso8601`` in their name become instants."""
    dated = {
        field.name: parse_rfc3339_utc(F.col(field.name))
        for field in df.schema
        if isinstance(field.dataType, T.StringType) and ("date" in field.name or "iso8601" in field.name)
    }
    return df.withColumns(dated) if dated else df


def fill_default(value: Column, default: str = "") -> Column:
    """Missing text becomes the default."""
    return F.coalesce(value, F.lit(default))


def to_columns(
    records: DataFrame, entity: str, entities: Mapping[str, str] = ENTITY_TABLES, skip_arrays: Iterable[str] = ()
) -> DataFrame:
    """All projection rules together: one flat, typed row per nested record.

    Ids become integers, entities (as objects or as ``<entity>ID`` text) foreign keys,
    other objects are inlined, arrays stay JSON unless listed in ``skip_arrays`` (they
    become tables of their own).
    """
    flat = exclude_columns(records, entity).drop(*skip_arrays)
    for field in flat.schema.fields:
        names_entity = field.name.endswith(("ID", "Id")) and field.name[:-2] in entities
        if field.name in _IDENTITY or (isinstance(field.dataType, T.StringType) and names_entity):
            flat = flat.withColumn(field.name, parse_id(F.col(field.name)))
        elif isinstance(field.dataType, T.StructType):
            flat = struct_to_fk(flat, field.name) if field.name in entities else flatten_struct(flat, field.name, [name for name in flat.columns if name != field.name])
        elif isinstance(field.dataType, T.ArrayType):
            flat = json_fallback(flat, field.name)
    return promote_temporal(normalise_names(flat))
