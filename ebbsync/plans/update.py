"""One pass of the updater: from batches to store changes and acknowledgements."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbsync import schemas
from ebbsync.config import UpdaterConfig
from ebbsync.functions.buckets import BUCKETS, bucket
from ebbsync.functions.sizes import broadcast_if, fits, size_of
from ebbsync.operators.acks import DELIVERY, acks, deliveries, outcomes, unanswered
from ebbsync.operators.feed import explode_ids, pack_batches
from ebbsync.operators.metrics import answer_counts
from ebbsync.operators.munge import entity_facts, facts_to_triples, filter_langs, single_label
from ebbsync.operators.requests import ENTITY, lookup_state, resume_point
from ebbsync.operators.routing import derive_targets, filter_namespaces, namespace_table, resolve_wikis
from ebbsync.operators.sync import ROUTE, TRIPLE, diff_log, diff_stores, number_stores, touched_buckets, touched_subjects
from ebbsync.session import Scratch, scratch_table
from ebbsync.sources.parts import Part
from ebbsync.sources.store import Store, dump

Result = TypeVar("Result")

#: Stores that a pass may name for a wiki and still compare in one row per triple.
STORES_IN_A_ROW = 8


@dataclass(frozen=True)
class Sources:
    """Tables a pass reads.

    ``wikis(wiki_id, domain, ...)`` with one row per wiki, ``snapshot(wiki_id, entity_id, ...)`` of the
    entities that can be fetched, and ``current(wiki_id, s, p, o)``, the triples
    that are true now. With ``entity_types(wiki_id, entity_id, entity_type)``
    requests are filtered by namespace.
    """

    wikis: DataFrame
    snapshot: DataFrame
    current: DataFrame
    entity_types: DataFrame | None = None

    @classmethod
    def from_facts(
        cls,
        wikis: DataFrame,
        snapshot: DataFrame,
        terms: DataFrame,
        statements: DataFrame,
        links: DataFrame,
        cfg: UpdaterConfig = UpdaterConfig(),
        entity_types: DataFrame | None = None,
    ) -> "Sources":
        """Clean raw facts, keyed by ``(wiki_id, entity_id)``, into current triples."""
        if cfg.langs:
            terms = single_label(terms, cfg.langs, ENTITY) if cfg.single_label else filter_langs(terms, cfg.langs)
        facts = entity_facts(terms, statements, links, cfg.skip_links, ENTITY)
        return cls(wikis, snapshot, facts_to_triples(facts, wikis), entity_types)


    def only(self, wiki_ids: Sequence[int]) -> "Sources":
        """Without the entities of other wikis. Tables partitioned by ``wiki_id`` are read in part."""
        wanted = F.col("wiki_id").isin(list(wiki_ids))
        types = self.entity_types
        return replace(
            self,
            snapshot=self.snapshot.filter(wanted),
            current=self.current.filter(wanted),
            entity_types=None if types is None else types.filter(wanted),
        )


class VerifyError(Exception):
    """The store differs from the sources after a pass."""


def allowed_requests(
    requests: DataFrame, sources: Sources, cfg: UpdaterConfig, few: bool = False
) -> DataFrame:
    """Requests with their wiki and targets, without those of namespaces that are not allowed."""
    routed = resolve_wikis(derive_targets(requests, cfg), sources.wikis)
    if sources.entity_types is None:
        return routed
    types = _narrowed(sources.entity_types.select(*ENTITY, "entity_type"), routed, ENTITY, few)
    return filter_namespaces(
        routed.join(types, ENTITY, "left"),
        namespace_table(requests.sparkSession, cfg),
        cfg.namespaces,
        keep_untyped=True,
    )


def failed_batches(looked_up: DataFrame) -> DataFrame:
    return looked_up.filter(~F.col("fetched")).select("batch_id", *DELIVERY).distinct()


def touched_entities(looked_up: DataFrame, failed: DataFrame, failed_small: bool = False) -> DataFrame:
    """Distinct entities of done batches, per store that a batch names; one with a failed request touches nothing."""
    route = [c for c in ROUTE if c in looked_up.columns]
    return (
        looked_up.filter(F.col("fetched"))
        .join(broadcast_if(failed, failed_small), ["batch_id", *DELIVERY], "left_anti")
        .select(*ENTITY, *route)
        .distinct()
    )


def pass_routes(batches: DataFrame) -> DataFrame:
    """The stores that the pass's batches name for each wiki: one, or more where a wiki moves."""
    return batches.filter("wiki_id IS NOT NULL").select("wiki_id", *ROUTE).distinct()


def _narrowed(table: DataFrame, keys: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Rows of a large table that match a small key set, without moving the table."""
    if not small:
        return table
    return table.join(F.broadcast(keys.select(*on).distinct()), list(on), "left_semi")


def _small(df: DataFrame, cfg: UpdaterConfig) -> bool:
    return fits(df, cfg.broadcast_rows, cfg.broadcast_bytes)


@dataclass(frozen=True)
class _Touched:
    """The subjects a pass syncs, and how the tables are cut down to them."""

    subjects: DataFrame
    small: bool
    # The subjects and their buckets where they are few enough to be listed in a filter.
    names: list[str] | None
    numbers: list[int] | None
    # The buckets of subjects that are too many to broadcast and few enough for buckets to tell most others apart.
    buckets: DataFrame | None

    @classmethod
    def of(cls, subjects: DataFrame, cfg: UpdaterConfig) -> "_Touched":
        rows, size = size_of(subjects)
        small = rows <= cfg.broadcast_rows and size <= cfg.broadcast_bytes
        if small and rows <= cfg.prune_subjects:
            listed = subjects.select("s", bucket(F.col("wiki_id"), F.col("s")).alias("bucket")).distinct().collect()
            return cls(subjects, True, sorted({row["s"] for row in listed}), sorted({row["bucket"] for row in listed}), None)
        buckets = touched_buckets(subjects) if not small and rows <= BUCKETS // 2 else None
        return cls(subjects, small, None, None, buckets)

    def cut(self, current: DataFrame) -> DataFrame:
        return current if self.names is None else current.filter(F.col("s").isin(self.names))


def _apply(
    batches: DataFrame,
    requests: DataFrame,
    sources: Sources,
    store: Store,
    cfg: UpdaterConfig,
    epoch: int,
    finish: Callable[[DataFrame], Result],
) -> Result:
    """Sync the requested entities as one epoch, then give the outcome per batch to ``finish``.

    Every entity is synced in the stores that its own batches name, so it does not matter to a store how deliveries
    fall into passes.
    """
    read = store.triple_parts.cover(epoch)
    routes = number_stores(pass_routes(resolve_wikis(batches, sources.wikis)))
    few = _small(requests.select("entity_id"), cfg)
    with scratch_table(routes, "routes") as routes:
        # A pass over few wikis reads only their part of the tables and the log.
        tenants = routes.limit(cfg.prune_tenants + 1).collect()
        pruned = len(tenants) <= cfg.prune_tenants
        if pruned:
            sources = sources.only(sorted({row["wiki_id"] for row in tenants}))
        few_routes = pruned or _small(routes, cfg)
        stores = 1 + (routes.agg(F.max("no")).first()[0] or 0)
        requests = allowed_requests(requests, sources, cfg, few)
        lookup = lookup_state(requests, _narrowed(sources.snapshot, requests, ENTITY, few))
        # Outcomes and touched subjects must rest on the same lookup.
        with scratch_table(lookup, "lookup") as looked_up:
            dump(looked_up, None if cfg.dump_dir is None else f"{cfg.dump_dir}/epoch={epoch}")
            # Few requests mean few failed batches.
            failed = failed_batches(looked_up)
            entities = touched_entities(looked_up, failed, few or _small(failed, cfg))
            with scratch_table(touched_subjects(entities, sources.wikis), "touched") as subjects:
                touched = _Touched.of(subjects, cfg)
                current = touched.cut(sources.current.select(*TRIPLE))

                def changes(parts: Sequence[Part]) -> DataFrame:
                    listed = [tuple(row[c] for c in ROUTE) for row in tenants] if pruned else None
                    log = store.log(routes=listed, numbers=touched.numbers, parts=parts)
                    if few_routes and stores <= STORES_IN_A_ROW:
                        return diff_stores(current, log, subjects, routes, stores, touched.small, touched.buckets)
                    # What is true now, once for each store that the pass names for a wiki.
                    named = current.join(broadcast_if(routes, few_routes), "wiki_id")
                    log = log.join(broadcast_if(routes, few_routes), ["wiki_id", *ROUTE], "left_semi")
                    return diff_log(named, log, subjects, touched.small, ROUTE, touched.buckets)

                store.apply_epoch(changes(read), epoch)
                if cfg.verify and not changes(store.triple_parts.cover(epoch + 1)).isEmpty():
                    raise VerifyError(f"epoch {epoch} left subjects that differ from the sources")
            store.check_unchanged(read, epoch)
            return finish(outcomes(batches, looked_up))


def update_pass(
    batches: DataFrame,
    sources: Sources,
    store: Store,
    cfg: UpdaterConfig,
    epoch: int,
    again: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """Work one pass of batches and return its acknowledgements, one per delivery.

    ``batches`` should be a table: several jobs read it. Every delivery is run,
    whatever became of its batch id before; only one that has an acknowledgement
    itself is passed over, and with ``again`` not even that. Only epochs before
    this one are read, for the store and for the acks, and the acks are written
    last, so running a pass again, as the same epoch or as a new one, changes
    nothing. ``counts`` observes the answers as they are written: batches done
    and not done, and the entities asked for.
    """
    todo = deliveries(batches)
    if not again:
        # Acks are looked up among the polls of this pass, which the files' statistics narrow down.
        polls = batches.agg(F.min("poll_seq").alias("low"), F.max("poll_seq").alias("high")).first()
        answered = store.acks(before=epoch).filter(F.col("poll_seq").between(polls["low"], polls["high"]))
        few = _small(batches, cfg)
        todo = unanswered(todo, _narrowed(answered, batches, DELIVERY, few))

    def answer(outcome: DataFrame) -> None:
        acked = acks(outcome)
        store.write_acks(acked if counts is None else acked.observe(counts, *answer_counts()), epoch)

    with scratch_table(todo, "todo") as todo:
        _apply(todo, explode_ids(todo), sources, store, cfg, epoch, finish=answer)
    return store.acks_of(epoch)


def run_once(requests: DataFrame, sources: Sources, store: Store, cfg: UpdaterConfig = UpdaterConfig()) -> bool:
    """The same update for ids given directly: no feed, no acknowledgement.

    ``requests`` has one row ``(batch_id, entity_id, domain, backend, namespace)``
    per id. The ids of one ``batch_id`` are one run, for one wiki, and succeed or
    fail as a whole. Returns whether all runs succeeded. Must not be called while
    a service updates the same store.
    """
    ordered = requests.withColumns({"poll_seq": F.lit(0).cast("bigint"), "batch_pos": F.lit(0)})
    with scratch_table(ordered, "requests") as ordered:
        runs = ordered.select("batch_id", "poll_seq", "batch_pos", "domain", *ROUTE).distinct()
        return _apply(
            runs, ordered, sources, store, cfg, store.claim_epoch(),
            finish=lambda outcome: outcome.filter(~F.col("success")).isEmpty(),
        )


def applied_until(batches: DataFrame, outcome: DataFrame) -> DataFrame:
    """Per wiki the time up to which every change was applied, as ``(wiki_id, ts)``.

    That ends before a wiki's first batch that failed, whatever became of later
    ones. A wiki whose first batch failed has no row.
    """
    ended = batches.select("batch_id", "wiki_id", "seq", "until").join(outcome.select("batch_id", "success"), "batch_id")
    first_failed = ended.groupBy("wiki_id").agg(F.min(F.when(~F.col("success"), F.col("seq"))).alias("failed_seq"))
    before = F.col("failed_seq").isNull() | (F.col("seq") < F.col("failed_seq"))
    return ended.join(first_failed, "wiki_id").filter(before).groupBy("wiki_id").agg(F.max("until").alias("ts"))


def catch_up(
    changes: DataFrame,
    applied: DataFrame | None,
    sources: Sources,
    store: Store,
    cfg: UpdaterConfig = UpdaterConfig(),
    start: datetime | None = None,
) -> bool:
    """Run the changes since each wiki's resume point, in batches, without a feed.

    ``changes`` has ``(wiki_id, change_id, ts, entity_id)`` and ``applied`` the
    ``(wiki_id, ts)`` of applied changes, by default those that earlier calls left
    with the store; ``sources.wikis`` must carry the routes. How far each wiki
    was brought is written with the epoch, so a later call goes on from there.
    """
    if applied is None:
        applied = store.applied(changes.schema["ts"].dataType.simpleString())
    few_wikis = _small(applied.select("wiki_id").distinct(), cfg)
    again = resume_point(changes, applied, start, cfg.days_back, few_wikis)
    with Scratch(changes.sparkSession) as scratch:
        packed = pack_batches(again, cfg.batch_size, scratch=scratch)
        # A wiki's number and its batch's, side by side in one id.
        batch_id = F.shiftleft(F.col("wiki_id").cast("bigint"), 32) + F.col("seq")
        batches = scratch.table(packed.withColumn("batch_id", batch_id).join(sources.wikis, "wiki_id"), "batches")
        columns = ["batch_id", "entity_ids", "domain", *ROUTE]
        ordered = batches.select(*columns, F.lit(0).cast("bigint").alias("poll_seq"), F.lit(0).alias("batch_pos"))
        requests = explode_ids(ordered).drop("id_pos")
        epoch = store.claim_epoch()

        def finish(outcome: DataFrame) -> bool:
            result = scratch.table(outcome.select("batch_id", "success"), "outcome")
            store.write_applied(applied_until(batches, result), epoch)
            return result.filter(~F.col("success")).isEmpty()

        return _apply(ordered.drop("entity_ids"), requests, sources, store, cfg, epoch, finish)


def one_run(spark: SparkSession, domain: str, backend: str, namespace: str, ids: str) -> DataFrame:
    """The requests of a single run for a CSV of ids."""
    batch = spark.createDataFrame([(0, 0, 0, ids, domain, backend, namespace)], schemas.BATCH)
    return explode_ids(batch).drop("poll_seq", "batch_pos", "id_pos")
