"""Fit a frame to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ringtally.schema import TABLES


def conform(frame: DataFrame, table: str) -> DataFrame:
    """The table's columns in its order and types; decimals are rounded half up, a missing
    ``created_at`` is the load time, any other missing column is NULL. A value that does not
    fit its type is an error: ``split_by_rules`` keeps such events out."""
    present = set(frame.columns)

    def source(name: str) -> str:
        if name in present:
            return f"`{name}`"
        return "current_timestamp()" if name == "created_at" else "NULL"

    return frame.selectExpr(
        *[f"CAST({source(n)} AS {kind}) AS `{n}`" for n, kind in TABLES[table].columns.items()]
    )
