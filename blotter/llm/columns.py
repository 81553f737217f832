"""Names of columns: those an operator makes replace those of its input."""

from __future__ import annotations

from collections.abc import Iterable


def others(columns: Iterable[str], made: Iterable[str]) -> list[str]:
    """The columns whose names are not among ``made``; case does not count, as in Spark."""
    taken = {name.lower() for name in made}
    return [name for name in columns if name.lower() not in taken]
