"""Every registered query with the SQL that gives the same rows."""

from __future__ import annotations

from checks.registry import ORACLES, QUERIES

from checks import (  # noqa: F401  (each module registers its queries)
    cleaning,
    content,
    control,
    flows,
    loads,
    sources,
    state,
    windows,
)

__all__ = ["ORACLES", "QUERIES"]
