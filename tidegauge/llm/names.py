"""Names of columns that an operator adds to a table for its own use."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``rows`` has that name in any case."""
    taken = {c.lower() for c in rows.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
