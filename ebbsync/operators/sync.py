"""Comparing what is true with what is stored, triple by triple.

Triples are sets: every operator here treats repeated rows as one. The
comparisons tag both sides, union them and aggregate on the whole triple. That
takes one exchange, on a key no tenant or subject can make hot, and it removes
repeats on the way; a pair of anti joins would take more exchanges and an extra
distinct on each side.

With ``route`` columns a subject is touched in the stores that its requests name,
and each store is compared for itself: ``current``, ``log`` and ``touched`` all
carry these columns, and so does the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbsync.functions.buckets import bucket
from ebbsync.functions.sizes import broadcast_if
from ebbsync.functions.urls import entity_uri

TRIPLE = ["wiki_id", "s", "p", "o"]
SUBJECT = ["wiki_id", "s"]
ROUTE = ["backend", "namespace"]


def touched_subjects(entities: DataFrame, wikis: DataFrame) -> DataFrame:
    """Distinct subjects ``(wiki_id, s)`` of the given ``(wiki_id, entity_id)`` rows, per route where these have one."""
    subject = entity_uri(F.col("domain"), F.col("entity_id"))
    route = [c for c in ROUTE if c in entities.columns]
    return (
        entities.select("wiki_id", "entity_id", *route).distinct()
        .join(wikis.select("wiki_id", "domain"), "wiki_id")
        .select("wiki_id", subject.alias("s"), *route)
    )


def touched_buckets(touched: DataFrame) -> DataFrame:
    """The distinct buckets of subjects: whole numbers below ``BUCKETS``, however many subjects and however long."""
    return touched.select(bucket(F.col("wiki_id"), F.col("s")).alias("bucket")).distinct()


def in_buckets(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows whose subject is in one of the buckets: all of the touched subjects, and of others a share.

    With n touched subjects that share is at most n / ``BUCKETS``. The buckets are
    broadcast; their number and size are bounded by ``BUCKETS`` alone.
    """
    own = bucket(F.col("wiki_id"), F.col("s"))
    return rows.withColumn("bucket", own).join(F.broadcast(numbers), "bucket", "left_semi").drop("bucket")


def _compare(
    current: DataFrame,
    log: DataFrame,
    touched: DataFrame,
    touched_small: bool,
    route: Sequence[str] = (),
    buckets: DataFrame | None = None,
) -> DataFrame:
    """Triples of touched subjects on which ``current`` and ``log`` differ, as ``op`` and triple.

    ``log`` has ``version``, even for a delete and odd for an insert, so that the
    largest version of a triple tells whether it is stored. With a small
    ``touched`` both inputs are cut down before the exchange; otherwise the
    comparison goes first, on the even key, and only differences meet ``touched``.
    ``buckets`` are the buckets of a larger ``touched``, which cut most of the other
    subjects off before the exchange.
    """
    none = F.lit(None)
    triple, subject = [*route, *TRIPLE], [*route, *SUBJECT]
    tagged = current.select(*triple, F.lit(True).alias("wanted"), none.cast("bigint").alias("version")).unionByName(
        log.select(*triple, none.cast("boolean").alias("wanted"), "version")
    )
    keys = broadcast_if(touched.select(*subject), touched_small)
    if touched_small:
        tagged = tagged.join(keys, subject, "left_semi")
    elif buckets is not None:
        tagged = in_buckets(tagged, buckets)
    wanted = F.coalesce("wanted", F.lit(False))
    stored = F.coalesce(F.col("version") % 2 == 1, F.lit(False))
    differing = (
        tagged.groupBy(*triple)
        .agg(F.max("wanted").alias("wanted"), F.max("version").alias("version"))
        .select(F.when(wanted & ~stored, "I").when(~wanted & stored, "D").alias("op"), *triple)
        .filter("op IS NOT NULL")
    )
    if not touched_small:
        differing = differing.join(keys, subject, "left_semi")
    return differing.select("op", *triple)


def log_versions(log: DataFrame) -> DataFrame:
    """Add ``version``: grows with the epoch, odd for inserts, even for deletes."""
    return log.withColumn("version", F.col("epoch") * 2 + F.when(F.col("op") == "I", 1).otherwise(0))


def diff_log(
    current: DataFrame,
    log: DataFrame,
    touched: DataFrame,
    touched_small: bool = False,
    route: Sequence[str] = (),
    buckets: DataFrame | None = None,
) -> DataFrame:
    """Inserts and deletes that make the log's live triples equal ``current`` for touched subjects."""
    return _compare(current, log_versions(log), touched, touched_small, route, buckets)


def number_stores(routes: DataFrame) -> DataFrame:
    """Add ``no`` to ``(wiki_id, backend, namespace)``: the store's number among those of its wiki, from 0."""
    own = Window.partitionBy("wiki_id").orderBy(*ROUTE)
    return routes.withColumn("no", F.row_number().over(own) - 1)


def diff_stores(
    current: DataFrame,
    log: DataFrame,
    touched: DataFrame,
    routes: DataFrame,
    stores: int,
    touched_small: bool = False,
    buckets: DataFrame | None = None,
) -> DataFrame:
    """What ``diff_log`` gives by route, for wikis with up to ``stores`` stores each; ``current`` has no route.

    ``routes`` are the numbered stores to compare, few enough to be broadcast. A triple goes through the exchange as
    one row, with a version for each store of its wiki, and not once for every store that should have it; the stores'
    names come back when only differences are left.
    """
    routes = F.broadcast(routes)
    none = F.lit(None)
    held = [f"held_{n}" for n in range(stores)]
    here = log_versions(log).join(routes, ["wiki_id", *ROUTE])
    tagged = (
        current.select(*TRIPLE, F.lit(True).alias("wanted"), *[none.cast("bigint").alias(h) for h in held])
        .join(routes.select("wiki_id"), "wiki_id", "left_semi")
        .unionByName(
            here.select(
                *TRIPLE,
                none.cast("boolean").alias("wanted"),
                *[F.when(F.col("no") == n, F.col("version")).alias(h) for n, h in enumerate(held)],
            )
        )
    )
    # One row per subject, with a bit for each store it is touched in.
    bit = F.call_function("shiftleft", F.lit(1), F.col("no"))
    keys = touched.join(routes, ["wiki_id", *ROUTE]).groupBy(*SUBJECT).agg(F.bit_or(bit).alias("mask"))
    keys = broadcast_if(keys, touched_small)
    if touched_small:
        tagged = tagged.join(keys, SUBJECT, "left_semi")
    elif buckets is not None:
        tagged = in_buckets(tagged, buckets)
    bits = [F.when(F.col(h) % 2 == 1, 1 << n).otherwise(0) for n, h in enumerate(held)]
    stored = reduce(lambda total, one: total + one, bits)
    differing = (
        tagged.groupBy(*TRIPLE)
        .agg(F.max("wanted").alias("wanted"), *[F.max(h).alias(h) for h in held])
        .select(*TRIPLE, F.coalesce("wanted", F.lit(False)).alias("wanted"), stored.alias("stored"))
        # The stores that should hold the triple and do not, or else those that should not and do.
        .withColumn("stores", F.when(F.col("wanted"), F.bitwise_not("stored")).otherwise(F.col("stored")))
        .withColumn("stores", F.col("stores").bitwiseAND((1 << stores) - 1))
        .filter("stores <> 0")
        .select(*TRIPLE, "wanted", "stores")
        .join(keys, SUBJECT)
        .withColumn("stores", F.col("stores").bitwiseAND(F.col("mask")))
        .filter("stores <> 0")
    )
    op = F.when(F.col("wanted"), "I").otherwise("D")
    return (
        differing.join(routes, "wiki_id")
        .filter(F.col("stores").bitwiseAND(bit) != 0)
        .select(op.alias("op"), *ROUTE, *TRIPLE)
    )


def diff_triples(current: DataFrame, stored: DataFrame, touched: DataFrame, touched_small: bool = False) -> DataFrame:
    """Inserts and deletes that make ``stored`` equal ``current`` for touched subjects."""
    return _compare(current, stored.withColumn("version", F.lit(1).cast("bigint")), touched, touched_small)


def diff_inserts(current: DataFrame, stored: DataFrame, touched: DataFrame, touched_small: bool = False) -> DataFrame:
    """Triples of touched subjects that are true and not stored."""
    return diff_triples(current, stored, touched, touched_small).filter("op = 'I'").select(*TRIPLE)


def diff_deletes(current: DataFrame, stored: DataFrame, touched: DataFrame, touched_small: bool = False) -> DataFrame:
    """Stored triples of touched subjects that are no longer true.

    A touched subject without any current triple loses all of its triples.
    """
    return diff_triples(current, stored, touched, touched_small).filter("op = 'D'").select(*TRIPLE)


def verify_applied(
    expected: DataFrame, stored: DataFrame, touched: DataFrame, touched_small: bool = False
) -> DataFrame:
    """Missing and extra triples per touched subject; no rows when the store is right."""
    return (
        diff_triples(expected, stored, touched, touched_small)
        .groupBy(*SUBJECT)
        .agg(F.count_if(F.col("op") == "I").alias("missing"), F.count_if(F.col("op") == "D").alias("extra"))
    )


def _last_versions(log: DataFrame) -> DataFrame:
    route = [c for c in ROUTE if c in log.columns]
    return log_versions(log).groupBy(*TRIPLE, *route).agg(F.max("version").alias("version"))


def current_triples(log: DataFrame) -> DataFrame:
    """Live triples of a change log: those whose latest operation is an insert."""
    return _last_versions(log).filter(F.col("version") % 2 == 1).drop("version")


def last_operations(log: DataFrame) -> DataFrame:
    """The last operation on each triple of a change log, with its epoch."""
    inserted = F.col("version") % 2 == 1
    return _last_versions(log).withColumns(
        {"op": F.when(inserted, "I").otherwise("D"), "epoch": F.shiftright("version", 1)}
    ).drop("version")
