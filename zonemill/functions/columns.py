"""Finding and quoting column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str, side: str | None = None) -> Column:
    """Column by its literal name, optionally of an aliased DataFrame."""
    return F.col(f"{side}.{quoted(name)}" if side else quoted(name))


def find(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` with this name in any case, or ``None``."""
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if len(matches) > 1:
        raise ValueError(f"column {name!r} is ambiguous: {matches}")
    return matches[0] if matches else None


def require(df: DataFrame, names: Iterable[str], what: str) -> list[str]:
    """The columns of ``df`` with these names in any case; unknown names raise."""
    found = {name: find(df, name) for name in names}
    missing = [name for name, match in found.items() if match is None]
    if missing:
        raise ValueError(f"{what} has no column {missing}; it has {df.columns}")
    return [match for match in found.values() if match is not None]
