"""Batch outcomes and acknowledgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbsync.functions.json import array_items, strict_document
from ebbsync.functions.order import packed
from ebbsync.operators.feed import batch_json

# What a delivery is known by. Batch ids come back: as retries, and for other
# work once the feed's counter starts anew.
DELIVERY = ["poll_seq", "batch_pos"]
# What makes two deliveries the same work: one that the feed sends again has all of it.
WORK = ["batch_id", "entity_ids", "domain", "backend", "namespace"]


def outcomes(batches: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Per delivery of a batch: ``total``, ``failed`` and ``success``, all or nothing.

    A batch without a request left is done: it has nothing that could fail.
    """
    counted = looked_up.groupBy("batch_id", *DELIVERY).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("fetched")).alias("failed"),
        F.bool_and("fetched").alias("success"),
    )
    return batches.join(counted, ["batch_id", *DELIVERY], "left").withColumns(
        {
            "total": F.coalesce("total", F.lit(0)),
            "failed": F.coalesce("failed", F.lit(0)),
            "success": F.coalesce("success", F.lit(True)),
        }
    )


def acks(outcome: DataFrame) -> DataFrame:
    """One acknowledgement per delivery: ``status`` and the message body. Neither status is left out."""
    carried = [c for c in (*DELIVERY, "total", "failed") if c in outcome.columns]
    return outcome.select(
        "batch_id",
        *carried,
        F.when(F.col("success"), "done").otherwise("not_done").alias("status"),
        F.to_json(F.struct(F.array("batch_id").alias("batches"))).alias("body"),
    )


def validate_acks(messages: DataFrame) -> DataFrame:
    """Add ``http_status`` and ``batch_ids`` of an acknowledgement in ``body``.

    200 iff the text is one JSON document whose ``batches`` is a non-empty array,
    else 500. ``batch_ids`` is NULL for a refused message.
    """
    items = array_items(F.col("ack_doc"), "$.batches")
    checked = messages.withColumn("ack_doc", strict_document(F.col("body"))).withColumn("ack_items", items)
    valid = F.coalesce(F.size("ack_items") > 0, F.lit(False))
    ids = F.transform("ack_items", lambda v: F.try_variant_get(v, "$", "bigint"))
    return checked.withColumns(
        {"http_status": F.when(valid, 200).otherwise(500), "batch_ids": F.when(valid, ids)}
    ).drop("ack_doc", "ack_items")


def ack_batch_ids(validated: DataFrame) -> DataFrame:
    """One row per batch id of the accepted messages."""
    carried = [c for c in validated.columns if c not in ("batch_ids", "http_status", "body")]
    return (
        validated.filter("http_status = 200")
        .select(*carried, F.posexplode("batch_ids").alias("ack_pos", "batch_id"))
    )


def tries_of(acked: DataFrame) -> DataFrame:
    """Per delivery ``tries``, how often it was answered, and ``done``, whether its last answer was."""
    epoch = F.col("epoch") if "epoch" in acked.columns else F.lit(0).cast("bigint")
    # Grows with the epoch and is odd where that was done, so a maximum is the last outcome.
    answer = epoch * 2 + F.when(F.col("status") == "done", 1).otherwise(0)
    return (
        acked.select(*DELIVERY, answer.alias("answer"))
        .groupBy(*DELIVERY)
        .agg(F.count(F.lit(1)).alias("tries"), F.max("answer").alias("answer"))
        .select(*DELIVERY, "tries", (F.col("answer") % 2 == 1).alias("done"))
    )


def delivery_states(batches: DataFrame, acked: DataFrame, max_tries: int = 0) -> DataFrame:
    """Every delivery with its ``tries`` and ``state``.

    ``done``: its last answer was, or the same work was done by a later delivery, which is how a feed repeats what was
    not done. ``unanswered``: no answer and no such delivery. Else it is ``not_done``, or ``given_up`` after
    ``max_tries`` answers; 0 never gives up. Another batch that comes under the same id settles nothing: ids start anew
    when the feed's counter does.
    """
    place = packed("poll_seq", "batch_pos")
    own = deliveries(batches).join(tries_of(acked), DELIVERY, "left")
    # Null fields do not occur in good batches.
    settled = own.filter("done").groupBy(*WORK).agg(F.max(place).alias("done_at"))
    settled_later = F.coalesce(F.col("done_at") > place, F.lit(False))
    tries = F.coalesce("tries", F.lit(0)).cast("bigint")
    given_up = (tries >= max_tries) if max_tries > 0 else F.lit(False)
    state = (
        F.when(F.coalesce("done", F.lit(False)) | settled_later, "done")
        .when(F.col("tries").isNull(), "unanswered")
        .when(given_up, "given_up")
        .otherwise("not_done")
    )
    return own.join(settled, WORK, "left").withColumns({"state": state, "tries": tries}).drop("done", "done_at")


def pending(batches: DataFrame, acked: DataFrame, max_tries: int = 0) -> DataFrame:
    """Deliveries to run again: never answered, or not done and not given up."""
    states = delivery_states(batches, acked, max_tries).filter("state IN ('unanswered', 'not_done')")
    return states.select(*batches.columns)


def given_up(batches: DataFrame, acked: DataFrame, max_tries: int) -> DataFrame:
    """Deliveries that were tried too often, in the shape of the quarantine, with their text in the feed's shape."""
    text = F.to_json(batch_json(*[F.col(c) for c in WORK]))
    states = delivery_states(batches, acked, max_tries).filter("state = 'given_up'")
    return states.select(*DELIVERY, F.lit("given_up").alias("reason"), text.alias("payload"))


def unanswered(batches: DataFrame, acked: DataFrame) -> DataFrame:
    """Deliveries without an acknowledgement, done or not.

    A batch id that was done before and comes back is a delivery of its own.
    """
    return batches.join(acked.select(*DELIVERY), DELIVERY, "left_anti")


def deliveries(batches: DataFrame) -> DataFrame:
    """Each delivery once. Copies of one are the same batch, landed again."""
    return batches.dropDuplicates(DELIVERY)
