"""The list-read surface: filter, sort, page, project over any DataFrame."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.operators.project import select_columns
from recordtide.operators.sketch import id_sketch, may_be_among, worthwhile

#: So many ids are no longer broadcast, and a sketch of them is worth its making.
SKETCH_FROM = 500_000


def id_in_list(df: DataFrame, ids: DataFrame, key: str = "id", unique: bool = False, sketch_from: int | None = None) -> DataFrame:
    """Rows whose key is among ``ids``, a DataFrame with the same key column.

    The id set may be large, so it is a semi join and not an IN list, broadcast only
    when its size is small. Repeated ids go away before the shuffle. Say ``unique``
    when they cannot repeat: then both sides are plain shuffles, and the adaptive
    skew join can split a key that fills a large part of ``df``.

    With ``sketch_from``, that many integer ids or more thin out ``df`` by a bit sketch
    before it is shuffled, as long as a sketch of bounded size can tell them apart. It
    pays where few rows of a large ``df`` match ids that lie scattered. ``ids`` should
    be a written table then, as it is read for its count and its bits too.
    """
    ids = ids.select(key)
    if sketch_from is not None:
        n_ids = ids.count()
        if n_ids >= sketch_from and worthwhile(n_ids):
            df = may_be_among(df, id_sketch(ids, key, n_ids), key)
    return df.join(ids if unique else ids.distinct(), key, "left_semi")


def within_range(df: DataFrame, column: str, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows between the least and the greatest id: a cheap cut before an exact semi join.

    The two bounds are read first and stand in the plan as literals, by which Parquet
    scans skip row groups. That pays where the data is sorted by the column.
    """
    low, high = ids.agg(F.min(key), F.max(key)).first()
    return df.where(F.lit(False) if low is None else F.col(column).between(low, high))


_COMPARE = {
    "lt": lambda c, v: c < v,
    "le": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "ge": lambda c, v: c >= v,
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "between": lambda c, low, high: c.between(low, high),
    "in": lambda c, *values: c.isin(*values),
    "!in": lambda c, *values: ~c.isin(*values),
}


def op_filter(column: Column, operator: str, *values) -> Column:
    """Predicate for one of ``lt le gt ge eq ne between in !in``."""
    if operator not in _COMPARE:
        raise ValueError(f"unknown operator {operator!r}, use one of {', '.join(_COMPARE)}")
    return _COMPARE[operator](column, *values)


_CALL = re.compile(r"\s*(!?\w+)\s*\((.*)\)\s*", re.DOTALL)


def parse_search(text: str) -> tuple:
    """The text form of a condition: ``"between(2,5)"`` becomes ``("between", "2", "5")``.

    Values are parted by commas and stay text, which comparisons turn into the column's type. Text without an operator is
    a value to equal.
    """
    call = _CALL.fullmatch(text)
    if not call:
        return "eq", text
    operator, values = call[1], tuple(value.strip() for value in call[2].split(","))
    if operator not in _COMPARE:
        raise ValueError(f"unknown operator {operator!r}, use one of {', '.join(_COMPARE)}")
    wanted = 2 if operator == "between" else None if operator in ("in", "!in") else 1
    if "" in values or wanted not in (None, len(values)):
        raise ValueError(f"wrong number of values: {text!r}")
    return operator, *values


def search_match(conditions: Mapping[str, tuple | str] | Iterable[tuple], match: str = "all") -> Column:
    """Combine conditions: a row must match all, or any, of them.

    Conditions are ``{column: (operator, values...)}`` or, for several on one column, ``(column, operator, values...)``.
    In place of operator and values a text such as ``"in(1,2,3)"`` may stand.
    """
    if match not in ("all", "any"):
        raise ValueError("match must be 'all' or 'any'")
    if isinstance(conditions, Mapping):
        conditions = [(name, *([how] if isinstance(how, str) else how)) for name, how in conditions.items()]
    predicates = [
        op_filter(F.col(name), *(parse_search(how[0]) if len(how) == 1 else how)) for name, *how in conditions
    ]
    if not predicates:
        return F.lit(True)
    return reduce(and_ if match == "all" else or_, predicates)


def sort_columns(orderby: str | Iterable[str], key: str) -> list[Column]:
    """``"-a,b"`` -> a descending, b ascending, then the key so that the order is total."""
    names = orderby.split(",") if isinstance(orderby, str) else list(orderby or [])
    names = [name.strip() for name in names if name.strip()]
    if key not in [name.lstrip("-") for name in names]:
        names.append(key)
    return [F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc() for name in names]


def order_by(df: DataFrame, orderby: str | Iterable[str] = "", key: str = "id") -> DataFrame:
    """Sort by a comma list of columns; ``-`` in front means descending."""
    return df.orderBy(*sort_columns(orderby, key))


def limit(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` records. After ``order_by`` this is a per-partition top-n, not a full sort."""
    return df.limit(n)


def paginate(
    df: DataFrame, page: int, page_size: int, orderby: str | Iterable[str] = "", key: str = "id", after=None
) -> DataFrame:
    """One page, counted from 1.

    A page number costs ``page * page_size`` rows on the way. To walk deep, sort by
    the key alone and pass the last key seen as ``after``: then every page costs one page.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    columns = sort_columns(orderby, key)
    if after is not None:
        if len(columns) > 1:
            raise ValueError("after= needs an order by the key alone")
        names = orderby.split(",") if isinstance(orderby, str) else list(orderby or [])
        descending = any(name.strip() == f"-{key}" for name in names)
        df = df.where(F.col(key) < after if descending else F.col(key) > after)
    return df.orderBy(*columns).offset((page - 1) * page_size).limit(page_size)


def list_records(
    df: DataFrame,
    search: Mapping[str, tuple | str] | Iterable[tuple] | None = None,
    match: str = "all",
    orderby: str | Iterable[str] = "",
    page: int | None = None,
    page_size: int | None = None,
    limit: int | None = None,
    columns: str | Iterable[str] | None = None,
    key: str = "id",
    after=None,
) -> DataFrame:
    """Filter, then sort, then page or limit, then project. ``page`` and ``after`` need a ``page_size``."""
    found = df.where(search_match(search or {}, match))
    if page_size is None and (page is not None or after is not None):
        raise ValueError("page and after need a page_size")
    if page_size is not None:
        found = paginate(found, 1 if page is None else page, page_size, orderby, key, after)
        if limit is not None:
            found = found.limit(limit)
    else:
        found = order_by(found, orderby, key)
        if limit is not None:
            found = found.limit(limit)
    return select_columns(found, columns)
