"""Small builders of SQL expression text.

Wide rows with dozens of generated columns are written as SQL expressions: one parsed expression is one driver
call, where the same thing as chained Column calls is hundreds.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: Iterable[str]) -> str:
    return ", ".join(text(v) for v in values)


def struct(fields: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"{expression} AS {name}" for name, expression in fields.items()) + ")"


def case(*branches: tuple[str, str], otherwise: str = "NULL") -> str:
    """The first branch whose condition holds."""
    if not branches:
        return otherwise
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in branches) + f" ELSE {otherwise} END"


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def all_of(conditions: Iterable[str]) -> str:
    return "(" + " AND ".join(conditions) + ")"


def agree(a: str, b: str, rel: float, floor: float) -> str:
    """Two amounts are equal up to a share of the larger one, but never less than the floor."""
    return f"abs(({a}) - ({b})) <= greatest({rel}D * greatest(abs({a}), abs({b})), {floor}D)"
