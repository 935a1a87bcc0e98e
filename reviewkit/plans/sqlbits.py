"""Small helpers that render library constants into DuckDB SQL for the oracle."""

from __future__ import annotations

from collections.abc import Iterable


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(items: Iterable[str]) -> str:
    return "[" + ", ".join(sql_str(s) for s in items) + "]"


def sql_id_list(expr: str) -> str:
    """Render a list of numbers as comma-joined text (arrays are compared as text)."""
    return f"array_to_string({expr}, ',')"
