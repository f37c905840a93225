"""Column names that no column of a user's table has."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores added until neither case nor spelling clashes with a taken one."""
    held = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out
