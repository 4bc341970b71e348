"""Names for helper columns beside columns that are not an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(rows: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of rows has it (in any case)."""
    taken = {c.lower() for c in rows.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
