"""Row predicates used by the intake rules and by the checks, as SQL text.

They describe the *bad* side and are never NULL for a NULL input, so a row is
either bad or good, never lost between the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from siltgate.functions import sql

# Fixed value: the address pattern that defines a well-formed email.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def blank(column: str) -> str:
    """NULL, empty, or only spaces (a tab is not a space)."""
    c = sql.name(column)
    return f"({c} IS NULL OR trim(cast({c} AS STRING)) = '')"


def any_blank(columns: Sequence[str]) -> str:
    return "(" + " OR ".join(blank(c) for c in columns) + ")"


def malformed(column: str, pattern: str = EMAIL_PATTERN) -> str:
    """NULL or not matching the pattern."""
    c = sql.name(column)
    return f"({c} IS NULL OR NOT {c} RLIKE {sql.text(pattern)})"


def as_double(column: str) -> str:
    """Number or NULL; text that is no number becomes NULL instead of an error."""
    return f"try_cast({sql.name(column)} AS DOUBLE)"


def not_positive(column: str) -> str:
    """NULL, not a number, or at most zero. NaN sorts above all numbers and passes."""
    value = as_double(column)
    return f"({value} IS NULL OR {value} <= 0)"


def negative_or_missing(column: str) -> str:
    """NULL, not a number, or below zero; zero passes."""
    value = as_double(column)
    return f"({value} IS NULL OR {value} < 0)"


def not_in(column: str, allowed: Sequence[str]) -> str:
    """NULL or outside the set."""
    return f"coalesce(NOT {_member(column, allowed)}, true)"


def present_but_not_in(column: str, allowed: Sequence[str]) -> str:
    """Outside the set; NULL does not count."""
    return f"coalesce(NOT {_member(column, allowed)}, false)"


def _member(column: str, allowed: Sequence[str]) -> str:
    return f"{sql.name(column)} IN ({', '.join(sql.text(v) for v in allowed)})"
