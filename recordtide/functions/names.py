"""Column names: record spelling -> cache spelling."""

from __future__ import annotations

import re

# Names that may not be used bare as a column.
RESERVED_WORDS = frozenset(
    """
    all analyse analyze and any array as asc asymmetric both case cast check collate column constraint create
    current_catalog current_date current_role current_schema current_time current_timestamp current_user default
    deferrable desc distinct do else end except false fetch for foreign from grant group having in initially
    intersect into lateral leading limit localtime localtimestamp not null offset on only or order placing primary
    references returning select session_user some symmetric table then to trailing true union unique user using
    variadic when where window with
    date time timestamp interval type format value key index schema data start end
    """.split()
)

_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    """``WorkOrder`` -> ``work_order``; a trailing ``ID`` counts as one word."""
    if name.endswith("ID"):
        name = name[:-2] + "Id"
    return _WORD_START.sub("_", name).lower()


def column_name(name: str) -> str:
    """Snake case, with a leading underscore where the result is a reserved word."""
    snake = snake_case(name)
    return f"_{snake}" if snake in RESERVED_WORDS else snake


def spelling_key(name: str) -> str:
    """Names that differ only in ``iz`` / ``is`` spelling share a key."""
    return name.replace("iz", "is")
