"""Names for helper columns that the input does not have."""

from __future__ import annotations

from collections.abc import Iterable


def free(base: str, taken: Iterable[str]) -> str:
    """``base``, with underscores put behind it until no column is called so in any case."""
    known = {c.lower() for c in taken}
    while base.lower() in known:
        base += "_"
    return base
