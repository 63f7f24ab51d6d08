"""Named queries over the star tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from lakejobs.registry import (  # noqa: F401
    columns, flows, gold, governance, monitoring, quality, tables,
)
from lakejobs.registry.case import CASES


def queries() -> dict:
    return {name: case.run for name, case in CASES.items()}


def oracles() -> dict[str, str]:
    return {name: case.sql for name, case in CASES.items() if case.sql}
