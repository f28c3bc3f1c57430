"""Looking up requested entities, reducing requests, and the resume point."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbsync.functions.order import packed
from ebbsync.functions.sizes import broadcast_if

ENTITY = ["wiki_id", "entity_id"]


def lookup_state(requests: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Add the snapshot's columns and ``fetched``, false where it has no row.

    A missing row stands for a failed fetch. A request without a wiki never
    matches. An entity asked for in very many requests makes one hot key on the
    request side only; the adaptive skew join splits it.
    """
    marked = snapshot.withColumn("found", F.lit(True))
    return (
        requests.join(marked, ENTITY, "left")
        .withColumn("fetched", F.col("found").isNotNull())
        .drop("found")
    )


def latest_per_entity(requests: DataFrame) -> DataFrame:
    """The last request per entity in feed order, with the number it supersedes."""
    order = packed("poll_seq", "batch_pos", "id_pos")
    last = [F.max_by(c, "order").alias(c) for c in ("poll_seq", "batch_pos", "id_pos", "batch_id")]
    return (
        requests.withColumn("order", order)
        .groupBy(*ENTITY)
        .agg(*last, (F.count(F.lit(1)) - 1).alias("superseded"))
    )


def resume_point(
    changes: DataFrame,
    applied: DataFrame,
    start: datetime | None = None,
    days_back: int = 90,
    broadcast_starts: bool = False,
) -> DataFrame:
    """Changes to run again, with the ``start_ts`` of their wiki.

    The start is ``start`` if given, else the wiki's last applied change, else
    ``days_back`` days before the newest change of the whole feed. A change at
    the start itself is included; running it again is harmless. Pass
    ``broadcast_starts`` when the number of wikis was checked to be small.
    """
    if start is not None:
        kind = changes.schema["ts"].dataType
        return changes.withColumn("start_ts", F.lit(start).cast(kind)).filter("ts >= start_ts")
    floor = changes.select(F.max("ts") - F.expr(f"INTERVAL {int(days_back)} DAYS")).scalar()
    starts = applied.groupBy("wiki_id").agg(F.max("ts").alias("last_ts"))
    return (
        changes.join(broadcast_if(starts, broadcast_starts), "wiki_id", "left")
        .withColumn("start_ts", F.coalesce("last_ts", floor))
        .drop("last_ts")
        .filter("ts >= start_ts")
    )
