"""Dropping repeated deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_deliveries(
    deliveries: DataFrame,
    keys: Sequence[str] = ("poll_seq", "batch_id"),
    ts: str = "landed_at",
    horizon: str = "7 days",
    salts: int = 16,
) -> DataFrame:
    """Handle the same delivery once; which copy survives is not defined.

    The key must not be ``batch_id`` alone: a batch that comes back in a later
    poll is a retry and has to run. Repeats are looked for within ``horizon``.

    Streaming deduplication has no partial step before its exchange, so all
    copies of one key would meet in one task. A first round with the source
    partition in the key spreads them over ``salts`` tasks and leaves at most
    that many copies for the second round.
    """
    marked = deliveries.withWatermark(ts, horizon)
    if salts > 1:
        marked = (
            marked.withColumn("_salt", F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark(list(keys))
