"""Quoting for the SQL expressions that contracts and checks are made of.

Rules and checks are stated as SQL text: plain data that needs no running
session, and that Spark parses once into the same expressions the column API
would build call by call.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"{float(value)!r}D"


def strings(values: Sequence[str]) -> str:
    """An array literal, typed even if empty."""
    return "cast(array(" + ", ".join(text(v) for v in values) + ") AS ARRAY<STRING>)"


def map_value(mapping: Mapping[str, str | int], key: str) -> str:
    """Value for the key, NULL when the mapping has none. For maps held in a contract."""
    pairs = ", ".join(
        f"{text(k)}, {text(v) if isinstance(v, str) else v}" for k, v in mapping.items()
    )
    return f"map({pairs})[cast({key} AS STRING)]"


def message(template: str, **fields: str) -> str:
    """A text with ``{field}`` places. A field's value is SQL; the default is the column
    of that name. Literal braces are doubled, as in ``str.format``."""
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(text(literal))
        if field is not None:
            parts.append(f"cast({fields.get(field, name(field))} AS STRING)")
    return "concat(" + ", ".join(parts) + ")"


def plain(value: str) -> str:
    """Keep braces of a value that is put into a message template."""
    return value.replace("{", "{{").replace("}", "}}")
