"""From poll responses to batches and entity requests, and back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbsync.functions.json import array_items, integer, is_blank, scalar_text
from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.session import Scratch
from ebbsync.sources.parts import list_numbers

# Where a batch of the feed holds each field.
ID_PATH = "$.id"
ENTITY_IDS_PATH = "$.entityIds"
DOMAIN_PATH = "$.wiki.domain"
BACKEND_PATH = "$.wiki.wiki_queryservice_namespace.backend"
NAMESPACE_PATH = "$.wiki.wiki_queryservice_namespace.namespace"

BATCH_COLUMNS = ("poll_seq", "batch_pos", "batch_id", "entity_ids", "domain", "backend", "namespace")


def classify_polls(polls: DataFrame) -> DataFrame:
    """Add ``poll_class`` and ``items``, the array elements of an ``ok`` poll.

    ``empty`` is a blank body, ``invalid_json`` a syntax error, ``not_array``
    any other document whose top level is not an array.
    """
    return (
        polls.withColumn("doc", F.try_parse_json("body"))
        .withColumn("items", array_items(F.col("doc")))
        .withColumn(
            "poll_class",
            F.when(F.col("body").isNull() | is_blank(F.col("body")), "empty")
            .when(F.col("doc").isNull(), "invalid_json")
            .when(F.col("items").isNull(), "not_array")
            .otherwise("ok"),
        )
        .drop("doc")
    )


def land_polls(polls: DataFrame) -> DataFrame:
    """One row per element of a poll, or one row for a poll without elements.

    ``batch_class`` is ``ok`` or ``malformed_batch`` (no integer id, or one of
    entity ids, domain, backend, namespace missing). Rows that are not ``ok``
    keep their text in ``payload``: they are set aside and stop nothing else.
    """
    keep = [c for c in polls.columns if c != "body"]
    item = F.col("item")
    fields = F.struct(
        integer(item, ID_PATH).alias("batch_id"),
        scalar_text(item, ENTITY_IDS_PATH).alias("entity_ids"),
        scalar_text(item, DOMAIN_PATH).alias("domain"),
        scalar_text(item, BACKEND_PATH).alias("backend"),
        scalar_text(item, NAMESPACE_PATH).alias("namespace"),
    )
    complete = F.lit(True)
    for name in BATCH_COLUMNS[2:]:
        complete = complete & F.col(f"fields.{name}").isNotNull()
    batch_class = F.when(complete, "ok").when(F.col("batch_pos").isNotNull(), "malformed_batch")
    payload = F.when(F.col("poll_class") != "ok", F.col("body")).when(~complete, F.to_json("item"))
    return (
        classify_polls(polls)
        .select(*keep, "body", "poll_class", F.posexplode_outer("items").alias("batch_pos", "item"))
        # Exploding one struct computes the fields once; as plain expressions
        # they would be computed again in every filter on them.
        .withColumn("fields", F.explode(F.array(fields)))
        .select(
            "poll_seq",
            "batch_pos",
            "fields.*",
            "poll_class",
            batch_class.alias("batch_class"),
            payload.alias("payload"),
            *[c for c in keep if c != "poll_seq"],
        )
    )


def quarantine(landed: DataFrame) -> DataFrame:
    """Polls and batches that were set aside, with the reason and their text."""
    reason = F.when(F.col("poll_class") != "ok", F.col("poll_class")).otherwise(F.col("batch_class"))
    return landed.select("poll_seq", "batch_pos", reason.alias("reason"), "payload").filter(
        F.col("reason") != "ok"
    )


def good_batches(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col("batch_class") == "ok").select(*BATCH_COLUMNS)


def flatten_batches(polls: DataFrame) -> DataFrame:
    """One row per well-formed batch, in feed order ``(poll_seq, batch_pos)``."""
    return good_batches(land_polls(polls))


def explode_ids(batches: DataFrame) -> DataFrame:
    """One row per requested id. Positions and repeats are kept, blank ids are not."""
    carried = [c for c in batches.columns if c != "entity_ids"]
    return (
        batches.select(*carried, F.posexplode(F.split("entity_ids", ",")).alias("id_pos", "entity_id"))
        .withColumn("entity_id", F.trim("entity_id"))
        .filter(F.col("entity_id") != "")
    )


def feed_positions(
    changes: DataFrame, order: list[str], max_broadcast_rows: int = 200_000, scratch: Scratch | None = None
) -> DataFrame:
    """Add ``pos``, the 0-based position of a change in its wiki's history.

    A ranking window would sort one wiki's whole history in one task. Here the
    rows are range-partitioned on ``(wiki_id, *order)``, which cuts a wiki of
    any size into even pieces. A row's position is its index in its piece plus
    the length of the wiki's earlier pieces; that table has one row per wiki and
    piece. ``order`` must be unique within a wiki.

    The ranged rows and the pieces are written to tables in the shared folder,
    since both uses of the rows have to see the same pieces. The range exchange
    therefore runs when this function is called. With a ``scratch`` scope the
    tables go when it ends; without, they stay.
    """
    scratch = scratch or Scratch(changes.sparkSession)
    keys = ["wiki_id", *order]
    numbered = (
        changes.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("row_no", F.monotonically_increasing_id())
    )
    # The upper 31 bits of the generated id are the partition.
    ranged = scratch.table(numbered, "ranged").withColumn("piece", F.shiftright("row_no", 33))
    lengths = ranged.groupBy("wiki_id", "piece").agg(
        F.min("row_no").alias("first_row"), F.count(F.lit(1)).alias("length")
    )
    pieces = scratch.table(lengths, "pieces")
    earlier = Window.partitionBy("wiki_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "wiki_id",
        "piece",
        (F.coalesce(F.sum("length").over(earlier), F.lit(0)) - F.col("first_row")).alias("shift"),
    )
    small = fits(pieces, max_broadcast_rows)
    return (
        ranged.join(broadcast_if(offsets, small), ["wiki_id", "piece"])
        .withColumn("pos", F.col("row_no") + F.col("shift"))
        .drop("piece", "row_no", "shift")
    )


def _members(changes: DataFrame, size: int, order: Sequence[str], scratch: Scratch | None) -> DataFrame:
    """Changes in groups of ``size`` by position: ``(wiki_id, seq, members)``, the members in order."""
    placed = feed_positions(changes.select("wiki_id", *order, "entity_id"), list(order), scratch=scratch)
    member = F.struct("pos", "entity_id", *order)
    return (
        placed.withColumn("seq", F.floor(F.col("pos") / size).cast("bigint"))
        .groupBy("wiki_id", "seq")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
    )


def _as_batches(members: DataFrame, order: Sequence[str]) -> DataFrame:
    return members.select(
        "wiki_id",
        "seq",
        F.concat_ws(",", F.col("members.entity_id")).alias("entity_ids"),
        F.size("members").alias("n"),
        F.try_element_at("members", F.lit(-1))[order[0]].alias("until"),
    )


def pack_batches(
    changes: DataFrame, size: int = 20, order: Sequence[str] = ("ts", "change_id"), scratch: Scratch | None = None
) -> DataFrame:
    """Group each wiki's ordered changes into batches of ``size`` ids.

    Returns ``(wiki_id, seq, entity_ids, n, until)``; ``seq`` counts a wiki's batches
    from 0, and ``until`` is the first order column of its last change. No group
    is larger than ``size``. ``Packer`` numbers on from call to call.
    """
    return _as_batches(_members(changes, size, order, scratch), order)


@dataclass(frozen=True)
class Packer:
    """Packs a feed that goes on: numbers rise from call to call, and no batch is cut short by the end of a call.

    Each call's batches are a table below ``root``, beside what the next call
    starts from: per wiki the next number and the changes, fewer than ``size``,
    that do not fill a batch yet. A call that was lost leaves nothing that is read.
    """

    spark: SparkSession
    root: str
    size: int = 20
    order: tuple[str, ...] = ("ts", "change_id")

    def _calls(self) -> list[int]:
        return list_numbers(self.spark, f"{self.root}/carried", "call")

    def batches(self, call: int | None = None) -> DataFrame:
        """The batches of one call, or of all that were finished."""
        calls = self._calls() if call is None else [call]
        return self.spark.read.parquet(*[f"{self.root}/batches/call={n}" for n in calls])

    def pack(self, changes: DataFrame, flush: bool = False) -> DataFrame:
        """Pack changes that all come after those of earlier calls, wiki by wiki; returns this call's batches.

        With ``flush`` the last changes of each wiki are packed too, though they do not fill a batch.
        """
        done = self._calls()
        call = done[-1] + 1 if done else 0
        columns = ["wiki_id", *self.order, "entity_id"]
        changes = changes.select(*columns)
        with Scratch(self.spark) as scratch:
            carried = None
            if done:
                carried = self.spark.read.parquet(f"{self.root}/carried/call={done[-1]}")
                waiting = carried.select("wiki_id", F.explode("waiting").alias("change")).select("wiki_id", "change.*")
                changes = changes.unionByName(waiting.select(*columns))
            grouped = _members(changes, self.size, self.order, scratch)
            first = F.lit(0).cast("bigint")
            if carried is not None:
                starts = carried.select("wiki_id", F.col("next_seq").alias("first_seq"))
                grouped = grouped.join(starts, "wiki_id", "left")
                first = F.coalesce("first_seq", first)
            grouped = scratch.table(grouped.withColumn("seq", F.col("seq") + first).select("wiki_id", "seq", "members"), "grouped")
            closed = F.lit(True) if flush else F.size("members") == self.size
            _as_batches(grouped.filter(closed), self.order).write.mode("overwrite").parquet(
                f"{self.root}/batches/call={call}"
            )
            change = [*self.order, "entity_id"]
            rows = grouped.select(
                "wiki_id",
                (F.col("seq") + F.when(closed, 1).otherwise(0)).alias("next_seq"),
                F.when(~closed, F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in change]))).alias("waiting"),
            )
            if carried is not None:
                # Wikis without a change in this call keep their number.
                rows = rows.unionByName(carried.withColumn("waiting", F.lit(None).cast(rows.schema["waiting"].dataType)))
            # At most one group of a wiki is open, so the maximum is that one.
            after = rows.groupBy("wiki_id").agg(F.max("next_seq").alias("next_seq"), F.max("waiting").alias("waiting"))
            none = F.array().cast(rows.schema["waiting"].dataType)
            # Written last: it makes the call count.
            after.withColumn("waiting", F.coalesce("waiting", none)).write.mode("overwrite").parquet(
                f"{self.root}/carried/call={call}"
            )
        return self.batches(call)


def batch_json(batch_id: Column, entity_ids: Column, domain: Column, backend: Column, namespace: Column) -> Column:
    """A batch as the struct that ``to_json`` renders in the feed's shape."""
    store = F.struct(backend.alias("backend"), namespace.alias("namespace"))
    wiki = F.struct(domain.alias("domain"), store.alias("wiki_queryservice_namespace"))
    return F.struct(batch_id.alias("id"), entity_ids.alias("entityIds"), wiki.alias("wiki"))
