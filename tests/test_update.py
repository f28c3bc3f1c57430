import json
import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import batch, polls, tuples
from ebbsync.__main__ import main
from ebbsync.config import UpdaterConfig
from ebbsync.operators.feed import flatten_batches
from ebbsync.plans.update import Sources, VerifyError, catch_up, one_run, run_once, update_pass
from ebbsync.sources.feed import write_poll_files
from ebbsync.sources.store import Store, StoreChanged, list_numbers
from ebbsync.streaming.dedup import dedup_deliveries
from ebbsync.streaming.updater import Updater, run_until_one_stops, start_updater, trigger_for

TRIPLE = "wiki_id INT, s STRING, p STRING, o STRING"
SUBJECT = "https://{}/entity/{}".format
A, B = "a.test", "b.test"


@pytest.fixture
def sources(spark):
    wikis = spark.createDataFrame([(1, A), (2, B)], "wiki_id INT, domain STRING")
    snapshot = spark.createDataFrame(
        [(w, f"Q{n}") for w in (1, 2) for n in range(1, 9)], "wiki_id INT, entity_id STRING"
    )
    current = spark.createDataFrame(
        [(w, SUBJECT(d, f"Q{n}"), "P1", "new") for w, d in ((1, A), (2, B)) for n in range(1, 8)], TRIPLE
    )
    return Sources(wikis, snapshot, current)


@pytest.fixture
def store(spark, folder):
    store = Store(spark, f"{folder}/store")
    rows = [(w, SUBJECT(d, f"Q{n}"), "P1", "old", "b.test:1", "n") for w, d in ((1, A), (2, B)) for n in (1, 2, 8)]
    store.load(spark.createDataFrame(rows, TRIPLE + ", backend STRING, namespace STRING"))
    return store


def live(store):
    rows = store.current().select("wiki_id", "s", "o").collect()
    return {(w, s.rsplit("/", 1)[1], o) for w, s, o in rows}


OLD = {(w, q, "old") for w in (1, 2) for q in ("Q1", "Q2", "Q8")}
CFG = UpdaterConfig(verify=True)


@pytest.mark.parametrize("broadcast_rows, prune_tenants", [(0, 0), (1000, 0), (1000, 1000)])
def test_pass_applies_done_batches_only(spark, sources, store, broadcast_rows, prune_tenants):
    cfg = UpdaterConfig(verify=True, broadcast_rows=broadcast_rows, prune_tenants=prune_tenants)
    feed = polls(spark, [batch(1, "Q1,Q8,Q3", A), batch(2, "Q2,Q99", A), batch(3, "Q2", B), batch(4, "Q1", "c.test"), batch(5, "")])
    batches = flatten_batches(feed)
    got = update_pass(batches, sources, store, cfg, 1)
    assert tuples(got.select("batch_id", "status", "total", "failed")) == [
        (1, "done", 3, 0), (2, "not_done", 2, 1), (3, "done", 1, 0), (4, "not_done", 1, 1), (5, "done", 0, 0),
    ]
    # Q8 has no current triple and is emptied; batch 2 left Q2 of the first wiki alone.
    expected = OLD - {(1, "Q1", "old"), (1, "Q8", "old"), (2, "Q2", "old")}
    expected |= {(1, "Q1", "new"), (1, "Q3", "new"), (2, "Q2", "new")}
    assert live(store) == expected

    # The same epoch again, and the same deliveries as a later epoch, change nothing.
    assert update_pass(batches, sources, store, cfg, 1).count() == 5
    assert live(store) == expected
    assert update_pass(batches, sources, store, cfg, 2).isEmpty()
    assert live(store) == expected and store.acks().count() == 5

    # In a later poll batch 2 comes back and works, and batch 1 is run again too.
    later = flatten_batches(polls(spark, "[]", [batch(2, "Q2", A), batch(1, "Q1", A)])).persist()
    assert tuples(update_pass(later, sources, store, cfg, 3).select("batch_id", "status")) == [(1, "done"), (2, "done")]
    assert (1, "Q2", "new") in live(store)
    assert store.acks().filter("batch_id = 1").count() == 2


def test_reused_ids_are_work_of_their_own(spark, sources, store):
    """A feed that starts counting anew sends other entities under a known id."""
    feed = [[batch(1, "Q1", A), batch(1, "Q2", A)], [batch(1, "Q3", A)]]
    got = update_pass(flatten_batches(polls(spark, *feed)), sources, store, CFG, 1)
    assert tuples(got.select("poll_seq", "batch_pos", "batch_id", "status")) == [
        (0, 0, 1, "done"), (0, 1, 1, "done"), (1, 0, 1, "done"),
    ]
    assert {(1, "Q1", "new"), (1, "Q2", "new"), (1, "Q3", "new")} <= live(store)
    later = flatten_batches(polls(spark, "[]", "[]", [batch(1, "Q2", B)]))
    assert update_pass(later, sources, store, CFG, 2).count() == 1
    assert (2, "Q2", "new") in live(store)


def test_pass_filters_by_namespace(spark, sources, store):
    types = spark.createDataFrame(
        [(1, "Q1", "item"), (1, "Q2", "other"), (1, "Q99", "other")], "wiki_id INT, entity_id STRING, entity_type STRING"
    )
    typed = Sources(sources.wikis, sources.snapshot, sources.current, types)
    # Q2 is filtered out, Q99 too, and Q3 has no known type and is looked up.
    feed = polls(spark, [batch(1, "Q1,Q2,Q99,Q3", A), batch(2, "Q2", A)])
    got = update_pass(flatten_batches(feed), typed, store, CFG, 1)
    assert tuples(got.select("batch_id", "status", "total")) == [(1, "done", 2), (2, "done", 0)]
    assert live(store) == (OLD - {(1, "Q1", "old")}) | {(1, "Q1", "new"), (1, "Q3", "new")}


def test_a_moved_wiki_is_filled_in_its_new_store(spark, sources, store):
    feed = polls(spark, [batch(1, "Q1,Q3", A, "moved:1", "m")])
    update_pass(flatten_batches(feed), sources, store, CFG, 1)
    got = store.current().filter("wiki_id = 1").select("backend", F.substring_index("s", "/", -1), "o")
    assert ("moved:1", "Q1", "new") in tuples(got) and ("b.test:1", "Q1", "old") in tuples(got)


def test_verify_stops_before_the_acks(spark, sources, store, monkeypatch):
    apply_epoch = Store.apply_epoch
    monkeypatch.setattr(Store, "apply_epoch", lambda self, changes, epoch: apply_epoch(self, changes.limit(3), epoch))
    with pytest.raises(VerifyError):
        update_pass(flatten_batches(polls(spark, [batch(1, "Q1,Q2", A)])), sources, store, CFG, 1)
    assert store.acks().isEmpty()


def test_run_once(spark, sources, store, folder):
    cfg = UpdaterConfig(dump_dir=f"{folder}/dump")
    assert run_once(one_run(spark, A, "b.test:1", "n", "Q1,,Q1"), sources, store, cfg)
    assert (1, "Q1", "new") in live(store) and (1, "Q1", "old") not in live(store)
    assert spark.read.parquet(f"{folder}/dump").count() == 2
    assert not run_once(one_run(spark, A, "b.test:1", "n", "Q2,Q99"), sources, store, cfg)
    assert (1, "Q2", "old") in live(store)
    assert run_once(one_run(spark, A, "b.test:1", "n", ""), sources, store)
    assert store.acks().isEmpty()


FEED = [
    [batch(1, "Q1,Q1", A), batch(2, "Q2,Q99", A)],
    "{bad",
    [batch(3, "Q2", B), {"id": 9}, 5],
    "",
    [batch(2, "Q2", A), batch(1, "Q1", A), batch(4, "Q8", B)],
    '{"id":1}',
]


def service(spark, folder, sources, store, **options):
    options = {"max_files_per_trigger": 2, **options}
    cfg = UpdaterConfig(verify=True, **options)
    return Updater(spark, f"{folder}/feed", f"{folder}/state", sources, store, cfg)


def test_service_works_like_the_batch_passes(spark, sources, store, folder):
    write_poll_files(polls(spark, *FEED), f"{folder}/feed")
    updater = service(spark, folder, sources, store, compact_every=1)
    updater.run_available()
    expected = (OLD - {(1, "Q1", "old"), (1, "Q2", "old"), (2, "Q2", "old"), (2, "Q8", "old")}) | {
        (1, "Q1", "new"), (1, "Q2", "new"), (2, "Q2", "new"),
    }
    assert live(store) == expected
    done = store.acks().filter("status = 'done'").select("batch_id")
    assert tuples(done.distinct()) == [(1,), (2,), (3,), (4,)]
    # Batch 2 of the first poll asked for Q99 too, so the later one under its id is other work.
    assert tuples(updater.pending().select("poll_seq", "batch_id")) == [(0, 2)]
    assert tuples(updater.requeue().select("batch_id", "status")) == [(2, "not_done")]
    assert live(store) == expected
    assert tuples(updater.deliveries().select("poll_seq", "batch_id", "tries", "state").filter("state <> 'done'")) == [
        (0, 2, 2, "not_done"),
    ]
    assert tuples(updater.quarantine().select("poll_seq", "reason")) == [
        (1, "invalid_json"), (2, "malformed_batch"), (2, "malformed_batch"), (3, "empty"), (5, "not_array"),
    ]
    assert updater.metrics().count() == len(FEED)

    # Starting again finds nothing to do; a new poll is worked from the checkpoint.
    acked = store.acks().count()
    updater.run_available()
    assert store.acks().count() == acked and live(store) == expected
    more = spark.createDataFrame([(6, '[' + str(batch(5, "Q3", B)).replace("'", '"') + ']')], "poll_seq BIGINT, body STRING")
    write_poll_files(more, f"{folder}/feed/more")
    updater.run_available()
    assert live(store) == expected | {(2, "Q3", "new")}


def test_a_backlog_in_a_table_is_one_pass(spark, sources, store, folder):
    polls(spark, *FEED).write.parquet(f"{folder}/feed")
    service(spark, folder, sources, store, feed_format="parquet", max_files_per_trigger=None).run_available()
    # Every delivery is answered; batch 2 fails in the first and works in the second.
    assert store.acks().select("epoch").distinct().count() == 1
    assert tuples(store.acks().select("batch_id", "status")) == [
        (1, "done"), (1, "done"), (2, "done"), (2, "not_done"), (3, "done"), (4, "done"),
    ]
    assert {(1, "Q1", "new"), (1, "Q2", "new"), (2, "Q2", "new")} <= live(store)


def test_lost_pass_is_replayed(spark, sources, store, folder, monkeypatch):
    write_poll_files(polls(spark, *FEED), f"{folder}/feed")
    updater = service(spark, folder, sources, store)
    broken = {"on": True}
    write_acks = Store.write_acks

    def fail_once(self, acked, epoch):
        if broken.pop("on", False):
            raise RuntimeError("lost before the acks")
        write_acks(self, acked, epoch)

    monkeypatch.setattr(Store, "write_acks", fail_once)
    with pytest.raises(Exception, match="lost before the acks"):
        updater.run_available()
    assert store.acks().isEmpty()
    # A one-off run in between takes its own epoch, which the replay leaves alone.
    assert run_once(one_run(spark, A, "b.test:1", "n", "Q5"), sources, store, CFG)
    updater.run_available()
    assert (1, "Q5", "new") in live(store) and (1, "Q2", "new") in live(store)
    done = store.acks().filter("status = 'done'").select("batch_id")
    assert tuples(done.distinct()) == [(1,), (2,), (3,), (4,)]


def put_poll(spark, folder, number, *batches, age_days=0):
    """One poll file, dated ``age_days`` back."""
    path = Path(f"{folder}/feed/poll-{number}.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(batches))
    then = time.time() - age_days * 86_400
    os.utime(path, (then, then))


def test_a_limit_counts_passes_and_loses_no_poll(spark, sources, store, folder):
    updater = service(spark, folder, sources, store, max_files_per_trigger=None)
    for number in range(2):
        put_poll(spark, folder, number, batch(number, "Q1", A))
    updater.run_passes(0)
    updater.run_passes(-2)
    assert not Path(f"{folder}/state").exists()
    updater.run_passes(1)
    for number in range(2, 5):
        put_poll(spark, folder, number, batch(number, "Q2", A))
    assert store.acks().count() == 2
    updater.run_passes(2)
    assert tuples(store.acks().select("poll_seq", "status")) == [(n, "done") for n in range(5)]


def test_late_polls_are_worked(spark, sources, store, folder):
    """A poll file far older than those before it, as after a backfill or a copy that keeps times."""
    updater = service(spark, folder, sources, store)
    put_poll(spark, folder, 1, batch(1, "Q1", A))
    updater.run_available()
    put_poll(spark, folder, 0, batch(0, "Q2", A), age_days=400)
    put_poll(spark, folder, 2, batch(2, "Q3", A), age_days=30)
    updater.run_available()
    assert tuples(store.acks().select("poll_seq", "status")) == [(0, "done"), (1, "done"), (2, "done")]
    assert {(1, "Q1", "new"), (1, "Q2", "new"), (1, "Q3", "new")} <= live(store)


def test_pending_batches_are_run_again(spark, sources, store, folder):
    put_poll(spark, folder, 0, batch(1, "Q2,Q99", A))
    updater = service(spark, folder, sources, store)
    updater.run_available()
    assert tuples(updater.pending().select("batch_id")) == [(1,)] and (1, "Q2", "old") in live(store)
    known = sources.snapshot.unionByName(spark.createDataFrame([(1, "Q99")], "wiki_id INT, entity_id STRING"), allowMissingColumns=True)
    updater.sources = Sources(sources.wikis, known, sources.current)
    assert tuples(updater.requeue().select("batch_id", "status")) == [(1, "done")]
    assert (1, "Q2", "new") in live(store) and updater.pending().isEmpty()


def test_work_that_failed_is_run_again_though_its_id_was_done_since(spark, sources, store, folder):
    """The feed's counter started anew: id 1 is other work by now."""
    put_poll(spark, folder, 0, batch(1, "Q2,Q99", A))
    put_poll(spark, folder, 1, batch(1, "Q1", A))
    updater = service(spark, folder, sources, store, max_tries=3)
    updater.run_available()
    assert tuples(store.acks().select("batch_id", "status")) == [(1, "done"), (1, "not_done")]
    assert tuples(updater.pending().select("poll_seq", "batch_id")) == [(0, 1)]
    assert tuples(updater.requeue().select("poll_seq", "status")) == [(0, "not_done")]
    # The third answer is its last; then it is set aside with its text.
    assert updater.quarantine().isEmpty()
    assert tuples(updater.requeue().select("poll_seq", "status")) == [(0, "not_done")]
    assert updater.requeue() is None and updater.pending().isEmpty()
    (aside,) = updater.quarantine().collect()
    assert (aside.poll_seq, aside.batch_pos, aside.reason) == (0, 0, "given_up")
    assert json.loads(aside.payload) == batch(1, "Q2,Q99", A)
    # States rest on the answers alone, so they are the same from a base of them.
    store.compact(store.next_epoch() - 1)
    store.expire()
    assert tuples(updater.deliveries().select("poll_seq", "tries", "state")) == [(0, 3, "given_up"), (1, 1, "done")]


MOVES = [[batch(1, "Q1", A, "a:1", "x")], [batch(2, "Q2", A, "b:1", "y")], [batch(3, "Q1,Q99", A, "b:1", "y")],
         [batch(4, "Q3", A, "a:1", "x"), batch(5, "Q3", A, "b:1", "y")]]


@pytest.mark.parametrize("broadcast_rows, prune_tenants", [(0, 0), (0, 1000), (1000, 1000)])
@pytest.mark.parametrize("cuts", [[4], [1, 1, 1, 1], [1, 3], [3, 1]])
def test_each_batch_is_written_to_the_store_it_names(spark, sources, folder, cuts, broadcast_rows, prune_tenants):
    """However the polls fall into passes; a wiki may be in two stores within one."""
    cfg = UpdaterConfig(verify=True, broadcast_rows=broadcast_rows, prune_tenants=prune_tenants)
    store = Store(spark, f"{folder}/stores")
    batches = flatten_batches(polls(spark, *MOVES))
    start = 0
    for epoch, n in enumerate(cuts):
        update_pass(batches.filter(F.col("poll_seq").between(start, start + n - 1)), sources, store, cfg, epoch)
        start += n
    got = store.current().select("backend", "namespace", F.substring_index("s", "/", -1))
    assert tuples(got) == [("a:1", "x", "Q1"), ("a:1", "x", "Q3"), ("b:1", "y", "Q2"), ("b:1", "y", "Q3")]


def test_a_failed_query_stops_the_other(spark, store, folder):
    put_poll(spark, folder, 0, batch(1, "Q1", A))

    def broken():
        raise RuntimeError("the sources are gone")

    queries = start_updater(spark, f"{folder}/feed", f"{folder}/state", broken, store, CFG)
    with pytest.raises(Exception, match="the sources are gone"):
        run_until_one_stops(queries, 0.2)
    assert not any(query.isActive for query in queries)


def test_long_runs_keep_their_books_short(spark, sources, store, folder):
    updater = service(spark, folder, sources, store, compact_every=2, keep_epochs=1)
    for number in range(5):
        put_poll(spark, folder, number, batch(number, "Q1", A))
        updater.run_available()
    assert len(list_numbers(spark, store.log_dir, "epoch", finished=False)) <= 4
    assert len(list_numbers(spark, store.base_dir, "upto", finished=False)) <= 2
    assert tuples(store.acks().select("poll_seq")) == [(n,) for n in range(5)]
    assert not Path(f"{folder}/state/passes").exists()


def test_running_service_sees_new_polls_and_rewritten_tables(spark, sources, store, folder):
    def publish(value):
        rows = sources.current.withColumn("o", F.lit(value)).collect()
        spark.createDataFrame(rows, TRIPLE).write.mode("overwrite").partitionBy("wiki_id").parquet(f"{folder}/current")

    def read():
        table = spark.read.schema("s STRING, p STRING, o STRING, wiki_id INT").parquet(f"{folder}/current")
        return Sources(sources.wikis, sources.snapshot, table)

    def poll(number, *batches):
        body = spark.createDataFrame([(number, json.dumps(batches))], "poll_seq BIGINT, body STRING")
        write_poll_files(body, f"{folder}/feed/{number}")

    publish("v1")
    poll(0, batch(1, "Q1", A))
    landing, updating = start_updater(spark, f"{folder}/feed", f"{folder}/state", read, store, CFG)
    try:
        landing.processAllAvailable()
        updating.processAllAvailable()
        assert (1, "Q1", "v1") in live(store)
        assert landing.lastProgress["sink"]["description"].startswith("FileSink")
        publish("v2")
        poll(1, batch(2, "Q1,Q3", A), {"id": 3})
        landing.processAllAvailable()
        updating.processAllAvailable()
        assert {(1, "Q1", "v2"), (1, "Q3", "v2")} <= live(store) and (1, "Q1", "v1") not in live(store)
        counts = [p.observedMetrics["landing"].asDict() for p in landing.recentProgress if p.observedMetrics]
        assert {"rows": 2, "batches": 1, "set_aside": 1} in counts
    finally:
        landing.stop()
        updating.stop()


def test_triggers():
    assert trigger_for(UpdaterConfig(interval_s=3)) == {"processingTime": "3 seconds"}
    assert trigger_for(UpdaterConfig(interval_s=0)) == {"processingTime": "0 seconds"}
    assert trigger_for(UpdaterConfig(), drain=True) == {"availableNow": True}


@pytest.mark.parametrize("salts", [1, 3])
def test_dedup_of_a_hot_key_over_many_files(spark, folder, salts):
    rows = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("ts"),
    )
    rows.repartition(12).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
    fresh = dedup_deliveries(stream, ["k"], ts="ts", horizon="1 day", salts=salts)
    fresh.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    assert tuples(spark.read.parquet(f"{folder}/out").select("k")) == tuples(rows.select("k").distinct())


def test_command_line(spark, sources, store, folder):
    for name in ("wikis", "snapshot", "current"):
        getattr(sources, name).write.parquet(f"{folder}/tables/{name}")
    common = ["--tables", f"{folder}/tables", "--store", store.root]
    once = ["once", *common, "--domain", A, "--backend", "b.test:1", "--namespace", "n", "--ids"]
    assert main([*once, "Q1"]) == 0
    assert main([*once, "Q1,Q99"]) == 1
    facts = spark.createDataFrame([(1, "Q2", "en", 1, "two"), (1, "Q2", "de", 2, "zwei")], "wiki_id INT, entity_id STRING, lang STRING, doc_id BIGINT, text STRING")
    facts.write.parquet(f"{folder}/tables/terms")
    facts.selectExpr("wiki_id", "entity_id", "'P9' AS p", "text AS o").write.parquet(f"{folder}/tables/statements")
    facts.selectExpr("wiki_id", "entity_id", "text AS url").write.parquet(f"{folder}/tables/links")
    assert main([*once, "Q2", "--facts", "--langs", "de,en", "--single-label", "--skip-links"]) == 0
    assert {o for w, q, o in live(store) if (w, q) == (1, "Q2")} == {"two", "zwei"}
    assert tuples(store.current().filter("p LIKE 'label%'").select("p", "o")) == [("label@de", "zwei")]
    for option in (["--langs", "de"], ["--single-label"], ["--skip-links"]):
        with pytest.raises(SystemExit):
            main([*once, "Q1", *option])
    write_poll_files(polls(spark, [batch(3, "Q2", B)]), f"{folder}/feed")
    assert main(["service", *common, "--feed", f"{folder}/feed", "--state", f"{folder}/state", "--pass-limit", "1"]) == 0
    assert {(1, "Q1", "new"), (2, "Q2", "new")} <= live(store)
    assert main(["requeue", *common, "--state", f"{folder}/state"]) == 0
    assert main(["compact", "--store", store.root]) == 0
    assert len(list_numbers(spark, store.log_dir, "epoch")) == 0 and (2, "Q2", "new") in live(store)


def change_rows(spark, rows):
    return spark.createDataFrame([(w, n, datetime(2024, 1, day), q) for w, n, day, q in rows], "wiki_id INT, change_id BIGINT, ts TIMESTAMP, entity_id STRING")


def routed_sources(spark, sources, more=()):
    wikis = sources.wikis.withColumns({"backend": F.lit("b.test:1"), "namespace": F.lit("n")})
    known = sources.snapshot.unionByName(spark.createDataFrame(list(more), "wiki_id INT, entity_id STRING")) if more else sources.snapshot
    return Sources(wikis, known, sources.current)


def test_catching_up_goes_on_where_it_ended(spark, sources, store):
    cfg = UpdaterConfig(batch_size=1, days_back=1)
    first = [(1, 1, 1, "Q1"), (1, 2, 2, "Q99"), (1, 3, 3, "Q2"), (2, 4, 3, "Q1"), (2, 5, 4, "Q2")]
    assert not catch_up(change_rows(spark, first), None, routed_sources(spark, sources), store, cfg, start=datetime(2023, 1, 1))
    # The first wiki was brought up to the change before the one that failed.
    reached = {(r.wiki_id, r.ts.day) for r in store.applied().collect()}
    assert reached == {(1, 1), (2, 4)}
    # Stopped; the store is all that is left. A new wiki has no point and goes back a day.
    store = Store(spark, store.root)
    more = [*first, (1, 6, 20, "Q3"), (2, 7, 21, "Q3"), (1, 8, 22, "Q4")]
    again = routed_sources(spark, sources, [(1, "Q99")])
    assert catch_up(change_rows(spark, more), None, again, store, cfg)
    assert {(1, "Q3", "new"), (1, "Q4", "new"), (2, "Q3", "new"), (1, "Q2", "new")} <= live(store)
    assert {(r.wiki_id, r.ts.day) for r in store.applied().collect()} == {(1, 22), (2, 21)}
    # Nothing new: the last change is run again, which changes nothing.
    now, epoch = live(store), store.next_epoch()
    assert catch_up(change_rows(spark, more), None, again, store, cfg)
    assert live(store) == now and store.log().filter(F.col("epoch") >= epoch).isEmpty()


def test_catch_up_on_the_command_line(spark, sources, store, folder):
    routed = routed_sources(spark, sources)
    for name in ("wikis", "snapshot", "current"):
        getattr(routed, name).write.parquet(f"{folder}/tables/{name}")
    change_rows(spark, [(1, 1, 1, "Q1"), (1, 2, 28, "Q2"), (2, 3, 29, "Q99")]).write.parquet(f"{folder}/tables/changes")
    common = ["catch-up", "--tables", f"{folder}/tables", "--store", store.root]
    assert main([*common, "--days-back", "5"]) == 1
    # The first change is older than five days before the newest.
    assert (1, "Q1", "old") in live(store) and (1, "Q2", "new") in live(store)
    assert main([*common, "--start", "2024-01-01"]) == 1
    assert (1, "Q1", "new") in live(store)
    change_rows(spark, [(1, 1, 1, "Q3"), (1, 9, 30, "Q4")]).write.parquet(f"{folder}/tables/later")
    assert main([*common, "--changes", "later"]) == 0
    assert (1, "Q4", "new") in live(store) and (1, "Q3", "new") not in live(store)


def test_every_pass_reports(spark, sources, store, folder):
    write_poll_files(polls(spark, *FEED), f"{folder}/feed")
    reports = []
    updater = service(spark, folder, sources, store, max_files_per_trigger=2)
    updater.on_pass = reports.append
    updater.run_available()
    assert sorted(map(tuple, updater.passes().collect())) == sorted((r["epoch"], r["done"], r["not_done"], r["entities"]) for r in reports)
    metrics = updater.metrics().agg(F.sum("done"), F.sum("not_done"), F.sum("entities")).first()
    assert tuple(metrics) == tuple(sum(r[name] for r in reports) for name in ("done", "not_done", "entities"))
    assert len(reports) >= 2 and metrics[1] == 1


def test_two_writers_do_not_overlap(spark, sources, store, monkeypatch):
    """A one-off run that starts while a pass is under way makes the pass run again."""
    epoch, apply_epoch = store.claim_epoch(), Store.apply_epoch
    batches = flatten_batches(polls(spark, [batch(1, "Q1", A)]))

    def meanwhile(self, changes, number):
        apply_epoch(self, changes, number)
        if number == epoch:
            assert run_once(one_run(spark, A, "b.test:1", "n", "Q2"), sources, store, CFG)

    monkeypatch.setattr(Store, "apply_epoch", meanwhile)
    with pytest.raises(StoreChanged):
        update_pass(batches, sources, store, CFG, epoch)
    assert store.acks().isEmpty()
    assert update_pass(batches, sources, store, CFG, store.claim_epoch()).count() == 1
    assert {(1, "Q1", "new"), (1, "Q2", "new")} <= live(store)


@pytest.mark.parametrize("prune_subjects", [0, 1000])
def test_a_pass_reads_what_it_touches(spark, sources, store, prune_subjects):
    cfg = UpdaterConfig(verify=True, prune_subjects=prune_subjects)
    store.compact(0)
    update_pass(flatten_batches(polls(spark, [batch(1, "Q1,Q8", A)])), sources, store, cfg, store.claim_epoch())
    assert live(store) == (OLD - {(1, "Q1", "old"), (1, "Q8", "old")}) | {(1, "Q1", "new")}
