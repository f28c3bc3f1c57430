"""Checked broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a row takes beside the bytes of its strings.
ROW_BYTES = 32


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about how many bytes they take; one job, with plain aggregates.

    A limit would send that many rows of every partition to one task.
    """
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    width = reduce(lambda total, one: total + one, texts, F.lit(ROW_BYTES)).cast("bigint")
    row = df.select(width.alias("width")).agg(F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes")).first()
    return row["rows"], row["bytes"] or 0


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, and these at most ``max_bytes``. Runs a job."""
    if max_bytes is None:
        return df.count() <= max_rows
    rows, size = size_of(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side already checked to be small, else leave the join to Catalyst."""
    return F.broadcast(df) if small else df
