"""One query per operator. Each takes the session and the table folder."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbsync.config import UpdaterConfig
from ebbsync.functions.sizes import fits
from ebbsync.operators import acks, feed, metrics, munge, requests, routing, sync
from ebbsync.plans.update import Sources, catch_up, failed_batches, run_once, touched_entities
from ebbsync.session import configure, work_dir, written
from ebbsync.sources.feed import write_poll_files
from ebbsync.sources.store import Store, dump
from ebbsync.streaming.dedup import dedup_deliveries
from ebbsync.streaming.updater import Updater
from workload import tables

CFG = UpdaterConfig(ingress="ingress.test:8080")
LANGS = ("en", "de", "fr", "es")
PASS_LIMITS = (-1, 0, -2, 3, 100)
QUERIES = {}


def query(fn):
    """Register a query under its function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), str(sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _sources(spark, sf_dir, typed=False, passes=1):
    """The tables of a service; what more than one pass reads is joined together once, as a table."""
    current = tables.current(spark, sf_dir).select(*sync.TRIPLE)
    return Sources(
        tables.wikis(spark, sf_dir),
        tables.snapshot(spark, sf_dir),
        current if passes == 1 else written(current, work_dir(spark, "current")),
        tables.entity_types(spark, sf_dir) if typed else None,
    )


def _outcome(spark, sf_dir):
    batches = tables.feed_batches(spark, sf_dir)
    looked_up = requests.lookup_state(feed.explode_ids(batches), tables.snapshot(spark, sf_dir))
    return looked_up, acks.outcomes(batches, looked_up)


def _touched(spark, sf_dir):
    """Subjects of every done batch, as a table, and whether they are few enough to broadcast."""
    path = work_dir(spark, "touched")
    looked_up = requests.lookup_state(tables.feed_requests(spark, sf_dir), tables.snapshot(spark, sf_dir))
    entities = touched_entities(looked_up, failed_batches(looked_up))
    sync.touched_subjects(entities, tables.wikis(spark, sf_dir)).write.parquet(path)
    touched = spark.read.parquet(path)
    return touched, fits(touched, CFG.broadcast_rows)


def _applied_store(spark, sf_dir):
    """A store loaded with what was stored, and one pass applied to it."""
    store = Store(spark, work_dir(spark, "store"))
    store.load(tables.stored(spark, sf_dir), epoch=0)
    touched, small = _touched(spark, sf_dir)
    changes = sync.diff_log(tables.current(spark, sf_dir), store.log(before=1), touched, small)
    store.apply_epoch(changes.join(tables.wikis(spark, sf_dir), "wiki_id"), 1)
    return store


@query
def feed_scan(spark, sf_dir):
    polls = feed.classify_polls(tables.feed(spark, sf_dir))
    return polls.select("poll_seq", "poll_class", F.size("items").cast("bigint").alias("batches"))


@query
def feed_classify(spark, sf_dir):
    landed = feed.land_polls(tables.poll_messages(spark, sf_dir))
    return landed.groupBy("poll_seq", "poll_class").agg(
        F.count_if(F.col("batch_class") == "ok").alias("good_batches"),
        F.count_if(F.col("batch_class") == "malformed_batch").alias("malformed_batches"),
    )


@query
def feed_quarantine(spark, sf_dir):
    return feed.quarantine(feed.land_polls(tables.poll_messages(spark, sf_dir)))


@query
def batch_pack(spark, sf_dir):
    packed = tables.batches(spark, sf_dir)
    return packed.select("batch_id", "wiki_id", "seq", "entity_ids", F.col("n").cast("bigint").alias("n"))


@query
def batch_flatten(spark, sf_dir):
    return feed.flatten_batches(tables.feed(spark, sf_dir))


@query
def target_urls(spark, sf_dir):
    targets = routing.derive_targets(feed.flatten_batches(tables.feed(spark, sf_dir)), CFG)
    return targets.select("batch_id", "sparql_url", "concept_uri", "wiki_url", "namespaces", "proxy_map")


@query
def entity_requests(spark, sf_dir):
    rows = tables.feed_requests(spark, sf_dir)
    return rows.select("poll_seq", "batch_pos", "id_pos", "batch_id", "wiki_id", "entity_id")


@query
def namespace_filter(spark, sf_dir):
    kept = routing.filter_namespaces(
        tables.typed_changes(spark, sf_dir), routing.namespace_table(spark, CFG), CFG.namespaces
    )
    return kept.select("change_id", "wiki_id", "entity_id", "entity_type", "ns", "slot")


@query
def state_lookup(spark, sf_dir):
    rows = requests.lookup_state(tables.feed_requests(spark, sf_dir), tables.snapshot(spark, sf_dir))
    return rows.select("batch_id", "id_pos", "wiki_id", "entity_id", "segment", "fetched")


@query
def payload_dump(spark, sf_dir):
    path = work_dir(spark, "dump")
    rows = requests.lookup_state(tables.feed_requests(spark, sf_dir), tables.snapshot(spark, sf_dir))
    dump(rows.select("batch_id", "id_pos", "entity_id", "segment"), path)
    return spark.read.parquet(path)


@query
def batch_outcome(spark, sf_dir):
    _, outcome = _outcome(spark, sf_dir)
    return outcome.select("batch_id", "total", "failed", "success")


@query
def ack_payloads(spark, sf_dir):
    _, outcome = _outcome(spark, sf_dir)
    return acks.acks(outcome).select("batch_id", "status", "body")


@query
def ack_validate(spark, sf_dir):
    checked = acks.validate_acks(tables.ack_messages(spark, sf_dir))
    ids = F.explode_outer("batch_ids").alias("batch_id")
    return checked.select("event_id", "http_status", ids)


@query
def pending_batches(spark, sf_dir):
    looked_up, outcome = _outcome(spark, sf_dir)
    return acks.pending(tables.feed_batches(spark, sf_dir), acks.acks(outcome)).select("batch_id", "poll_seq")


@query
def sync_inserts(spark, sf_dir):
    touched, small = _touched(spark, sf_dir)
    return sync.diff_inserts(tables.current(spark, sf_dir), tables.stored(spark, sf_dir), touched, small)


@query
def sync_deletes(spark, sf_dir):
    touched, small = _touched(spark, sf_dir)
    return sync.diff_deletes(tables.current(spark, sf_dir), tables.stored(spark, sf_dir), touched, small)


@query
def sync_verify(spark, sf_dir):
    touched, small = _touched(spark, sf_dir)
    return sync.verify_applied(tables.current(spark, sf_dir), tables.stored(spark, sf_dir), touched, small)


@query
def store_apply(spark, sf_dir):
    log = _applied_store(spark, sf_dir).log()
    return log.filter("epoch = 1").select("op", "backend", "namespace", "wiki_id", "s", "p", "o")


@query
def store_current(spark, sf_dir):
    return _applied_store(spark, sf_dir).current()


@query
def store_compact(spark, sf_dir):
    store = _applied_store(spark, sf_dir)
    store.compact(upto=1)
    return store.log().select("op", "epoch", "wiki_id", "s", "p", "o")


@query
def munge_lang_filter(spark, sf_dir):
    return munge.filter_langs(tables.terms(spark, sf_dir), ("en", "de"))


@query
def munge_single_label(spark, sf_dir):
    return munge.single_label(tables.terms(spark, sf_dir), LANGS)


@query
def munge_facts(spark, sf_dir):
    parts = (tables.terms(spark, sf_dir), tables.statements(spark, sf_dir), tables.links(spark, sf_dir))
    with_links = munge.entity_facts(*parts).withColumn("skip_links", F.lit(False))
    without = munge.entity_facts(*parts, skip_links=True).withColumn("skip_links", F.lit(True))
    return with_links.unionByName(without).groupBy("skip_links", "kind", "p").agg(
        F.count(F.lit(1)).alias("facts"),
        F.sum(F.length("o")).alias("chars"),
    )


@query
def latest_change(spark, sf_dir):
    return requests.latest_per_entity(tables.feed_requests(spark, sf_dir))


@query
def resume_point(spark, sf_dir):
    applied = tables.applied(spark, sf_dir)
    few = fits(applied.select("wiki_id").distinct(), CFG.broadcast_rows)
    again = requests.resume_point(tables.changes(spark, sf_dir), applied, broadcast_starts=few)
    return again.select("wiki_id", "change_id", "entity_id", "ts", "start_ts")


@query
def pass_metrics(spark, sf_dir):
    landed = feed.land_polls(tables.feed(spark, sf_dir))
    _, outcome = _outcome(spark, sf_dir)
    return metrics.pass_metrics(landed, outcome)


@query
def pass_limit(spark, sf_dir):
    polls = feed.classify_polls(tables.feed(spark, sf_dir)).select("poll_seq", F.size("items").alias("batches"))
    tried = polls.select("*", F.explode(F.array(*[F.lit(n) for n in PASS_LIMITS])).alias("pass_limit"))
    kept = metrics.limit_passes(tried, F.col("pass_limit"))
    return kept.groupBy("pass_limit").agg(
        F.count(F.lit(1)).alias("polls"),
        F.sum("batches").alias("batches"),
        F.max("poll_seq").alias("last_poll"),
    )


@query
def run_once_sync(spark, sf_dir):
    """A one-off run for the customers of each segment of each wiki; returns its changes."""
    store = Store(spark, work_dir(spark, "store"))
    store.load(tables.stored(spark, sf_dir), epoch=0)
    run_once(tables.one_off_requests(spark, sf_dir), _sources(spark, sf_dir), store, CFG)
    return store.log().filter("epoch = 1").select("op", "wiki_id", "s", "p", "o")


@query
def catch_up_sync(spark, sf_dir):
    """The changes since each wiki's resume point, run in batches; returns the store's changes."""
    store = Store(spark, work_dir(spark, "store"))
    store.load(tables.stored(spark, sf_dir), epoch=0)
    catch_up(tables.changes(spark, sf_dir), tables.applied(spark, sf_dir), _sources(spark, sf_dir), store, CFG)
    return store.log().filter("epoch = 1").select("op", "wiki_id", "s", "p", "o")


@query
def batch_pack_calls(spark, sf_dir):
    """The changes packed in three calls, year by year, with numbers that go on; as many batches as in one."""
    packer = feed.Packer(spark, work_dir(spark, "packer"))
    changes, year = tables.changes(spark, sf_dir), F.year("ts")
    packer.pack(changes.filter(year < 1994))
    packer.pack(changes.filter(year == 1994))
    packer.pack(changes.filter(year > 1994), flush=True)
    packed = packer.batches()
    batch_id = F.col("wiki_id").cast("bigint") * tables.BATCH_ID_STEP + F.col("seq")
    return packed.select(batch_id.alias("batch_id"), "wiki_id", "seq", "entity_ids", F.col("n").cast("bigint").alias("n"))


@query
def catch_up_resumed(spark, sf_dir):
    """Two catch-ups, the second from the resume points that the first left; returns the store.

    The first ends where the changes of 1996 do, and not all it asks for can be fetched.
    """
    store = Store(spark, work_dir(spark, "store"))
    store.load(tables.stored(spark, sf_dir), epoch=0)
    changes, sources = tables.changes(spark, sf_dir), _sources(spark, sf_dir, passes=2)
    catch_up(changes.filter(F.year("ts") < 1997), None, sources, store, CFG, start=datetime(1970, 1, 1))
    whole = replace(sources, snapshot=tables.snapshot(spark, sf_dir, None))
    never = replace(CFG, days_back=100_000)
    catch_up(changes, None, whole, store, never)
    return store.current()


@query
def store_merge(spark, sf_dir):
    """The pass applied poll by poll of eight, merged as they come; returns what the store holds then."""
    store = Store(spark, work_dir(spark, "store"), tier_bytes=100_000)
    store.load(tables.stored(spark, sf_dir), epoch=0)
    touched, _ = _touched(spark, sf_dir)
    changes = work_dir(spark, "changes")
    diff = sync.diff_log(tables.current(spark, sf_dir), store.log(before=1), touched)
    diff.join(tables.wikis(spark, sf_dir), "wiki_id").write.parquet(changes)
    for part in range(8):
        mine = spark.read.parquet(changes).filter(F.pmod(F.xxhash64("s"), F.lit(8)) == part)
        store.apply_epoch(mine, 1 + part)
        store.merge(fan_out=3)
    return store.current()


@query
def stream_update(spark, sf_dir):
    state = work_dir(spark, "service")
    store = Store(spark, f"{state}/store")
    store.load(tables.stored(spark, sf_dir), epoch=0)
    cfg = replace(CFG, feed_format="parquet")
    sources = _sources(spark, sf_dir, typed=True)
    Updater(spark, tables.feed_path(spark, sf_dir), state, sources, store, cfg).run_available()
    return store.current()


@query
def stream_redelivery(spark, sf_dir):
    """The service over a feed whose batch ids start anew in every poll, in several passes."""
    state = work_dir(spark, "service")
    tables.recounted_polls(spark, sf_dir).repartition(4, "poll_seq").write.parquet(f"{state}/feed")
    store = Store(spark, f"{state}/store")
    store.load(tables.stored(spark, sf_dir), epoch=0)
    cfg = replace(CFG, feed_format="parquet", max_files_per_trigger=1)
    sources = _sources(spark, sf_dir, typed=True, passes=4)
    Updater(spark, f"{state}/feed", state, sources, store, cfg).run_available()
    return store.current()


@query
def stream_late(spark, sf_dir):
    """The service over poll files; every other one arrives after the rest, dated a year before them."""
    state = work_dir(spark, "service")
    store = Store(spark, f"{state}/store")
    store.load(tables.stored(spark, sf_dir), epoch=0)
    updater = Updater(spark, f"{state}/feed", state, _sources(spark, sf_dir, typed=True, passes=2), store, CFG)
    polls = tables.feed(spark, sf_dir)
    write_poll_files(polls.filter("poll_seq % 2 = 1"), f"{state}/feed/first")
    updater.run_available()
    write_poll_files(polls.filter("poll_seq % 2 = 0"), f"{state}/feed/late")
    tables.date_back(spark, f"{state}/feed/late", days=365)
    updater.run_available()
    return store.current()


def _moving(spark, sf_dir, files, **options):
    """The service over a feed whose wikis move between stores, cut into passes as told; returns the store."""
    state = work_dir(spark, "service")
    tables.moving_polls(spark, sf_dir).repartition(files, "poll_seq").write.parquet(f"{state}/feed")
    store = Store(spark, f"{state}/store")
    store.load(tables.stored(spark, sf_dir), epoch=0)
    cfg = replace(CFG, feed_format="parquet", **options)
    sources = _sources(spark, sf_dir, typed=True, passes=files if cfg.max_files_per_trigger else 1)
    Updater(spark, f"{state}/feed", state, sources, store, cfg).run_available()
    return store.current()


@query
def stream_moving(spark, sf_dir):
    """Moving wikis, in several passes, each a mix of polls from before and after a move."""
    return _moving(spark, sf_dir, 3, max_files_per_trigger=1)


@query
def stream_moving_backlog(spark, sf_dir):
    """The same feed as one pass: every batch still goes to the store it names."""
    return _moving(spark, sf_dir, 3)


@query
def delivery_states(spark, sf_dir):
    """Deliveries under ids that start anew in every poll, after two answers to all but every seventh poll.

    What can be fetched grows in between; what is not done twice is given up.
    """
    batches = feed.flatten_batches(tables.recounted_polls(spark, sf_dir))
    asked = feed.explode_ids(routing.resolve_wikis(batches.filter("poll_seq % 7 <> 6"), tables.wikis(spark, sf_dir)))
    answers = []
    for epoch, least_balance in enumerate((-800, -900)):
        looked_up = requests.lookup_state(asked, tables.snapshot(spark, sf_dir, least_balance))
        outcome = acks.outcomes(batches.filter("poll_seq % 7 <> 6"), looked_up)
        answers.append(acks.acks(outcome).withColumn("epoch", F.lit(epoch).cast("bigint")))
    # A batch that is done is not tried again.
    done = answers[0].filter("status = 'done'").select(*acks.DELIVERY)
    log = answers[0].unionByName(answers[1].join(done, acks.DELIVERY, "left_anti"))
    states = acks.delivery_states(batches, log, max_tries=2)
    return states.select("poll_seq", "batch_pos", "batch_id", "tries", "state")


@query
def stream_requeue(spark, sf_dir):
    """What was not done is queued again under ids that other batches have used, once all can be fetched."""
    state = work_dir(spark, "service")
    tables.recounted_polls(spark, sf_dir).repartition(2, "poll_seq").write.parquet(f"{state}/feed")
    store = Store(spark, f"{state}/store")
    store.load(tables.stored(spark, sf_dir), epoch=0)
    cfg = replace(CFG, feed_format="parquet")
    sources = _sources(spark, sf_dir, passes=2)
    updater = Updater(spark, f"{state}/feed", state, sources, store, cfg)
    updater.run_available()
    whole = replace(sources, snapshot=tables.snapshot(spark, sf_dir, None))
    replace(updater, sources=whole).requeue()
    return store.current()


@query
def stream_dedup(spark, sf_dir):
    path = work_dir(spark, "dedup")
    events = tables.table(spark, sf_dir, "events")
    # The pattern lets the table be one file or a folder of files.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*").select(
        F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"
    )
    # The whole table repeats each key over its full time span.
    fresh = dedup_deliveries(stream, ("user_id", "event_type"), ts="ts", horizon="3650 days")
    (
        fresh.select("user_id", "event_type").writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema("user_id BIGINT, event_type STRING").parquet(path)
