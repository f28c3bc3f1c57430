"""Plans and skew: no Python in a plan, bounded tasks for hot keys, both join strategies."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ebbsync.operators.feed import feed_positions
from ebbsync.operators.requests import latest_per_entity, lookup_state
from ebbsync.operators.sync import diff_log, diff_triples
from ebbsync.plans.update import Sources
from ebbsync.sources.store import Store
from workload import tables
from workload.queries import QUERIES, _sources

# Queries whose result is read from what a job wrote; their plan is a scan.
WRITERS = {"batch_pack_calls", "catch_up_resumed", "catch_up_sync", "payload_dump", "run_once_sync", "store_apply",
           "stream_dedup", "stream_late", "stream_moving", "stream_moving_backlog", "stream_redelivery",
           "stream_requeue", "stream_update"}


def final_plan(df):
    """The executed plan after all adaptive changes."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    df.collect()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_plans_stay_in_the_jvm_and_gather_nothing(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate(keys=[]"):
        assert word not in plan, word
    # The only window runs over one total per wiki and piece.
    assert plan.count("Window [") == (1 if name == "batch_pack" else 0)
    # The only single-partition exchange carries one row per map task: a global maximum.
    expected = 1 if name == "resume_point" else 0
    assert plan.count("Exchange SinglePartition") <= 2 * expected


@pytest.fixture
def skew(conf):
    """Thresholds at which a few thousand rows count as a skewed partition, and no broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def hot(spark, rows=60000):
    """Rows of which a third belong to one entity."""
    n = F.col("id")
    return spark.range(0, rows, 1, 16).select(
        F.lit(1).alias("wiki_id"),
        F.when(n % 3 == 0, "Q0").otherwise(F.concat(F.lit("Q"), (n % 5000).cast("string"))).alias("entity_id"),
        n.alias("batch_id"),
        F.floor(n / 100).alias("poll_seq"),
        (n % 100).cast("int").alias("batch_pos"),
        F.lit(0).alias("id_pos"),
        F.md5(n.cast("string")).alias("payload"),
    )


def test_lookup_splits_a_hot_entity(spark, skew):
    snapshot = spark.range(0, 5000, 1, 8).select(
        F.lit(1).alias("wiki_id"), F.concat(F.lit("Q"), F.col("id").cast("string")).alias("entity_id"), F.col("id").alias("state")
    ).filter("state % 10 <> 7")
    looked_up = lookup_state(hot(spark), snapshot)
    assert "skew=true" in final_plan(looked_up)
    expected = hot(spark).filter("NOT (entity_id <> 'Q0' AND substr(entity_id, -1) = '7')").count()
    assert looked_up.count() == 60000
    assert looked_up.filter("fetched").count() == expected


def test_latest_request_of_a_hot_entity_is_reduced_before_the_exchange(spark):
    got = latest_per_entity(hot(spark))
    assert "partial_max" in got._jdf.queryExecution().executedPlan().toString()
    last = got.filter("entity_id = 'Q0'").first()
    assert (last["batch_id"], last["superseded"]) == (59997, hot(spark).filter("entity_id = 'Q0'").count() - 1)


def test_the_latest_request_is_a_hash_aggregate(spark):
    """Its order is one number, so the aggregate does not sort."""
    plan = QUERIES["latest_change"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_positions_cut_a_hot_wiki_into_pieces(spark):
    changes = hot(spark).select("wiki_id", F.lit(0).alias("ts"), F.col("batch_id").alias("change_id"))
    placed = feed_positions(changes, ["ts", "change_id"])
    assert placed.filter("pos <> change_id").isEmpty()
    assert placed.count() == 60000


def hot_triples(spark, rows, step):
    """Triples of which a third belong to one subject."""
    n = F.col("id")
    return spark.range(0, rows, step, 8).select(
        F.lit(1).alias("wiki_id"),
        F.when(n % 3 == 0, "s0").otherwise(F.concat(F.lit("s"), (n % 2000).cast("string"))).alias("s"),
        F.lit("p").alias("p"),
        F.md5(n.cast("string")).alias("o"),
    )


def test_diff_spreads_a_hot_subject(spark, skew):
    current, stored = hot_triples(spark, 60000, 2), hot_triples(spark, 60000, 5)
    touched = current.select("wiki_id", "s").distinct().filter("s = 's0' OR substr(s, -1) = '4'")
    large = diff_triples(current, stored, touched, touched_small=False)
    plan = final_plan(large)
    # One exchange compares both sides on the whole triple, and the differences
    # of the hot subject are split when they meet the touched subjects.
    assert plan.count("hashpartitioning(wiki_id") >= 2 and "skew=true" in plan
    small = diff_triples(current, stored, touched, touched_small=True)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(large) == key(small)


def test_small_touched_set_reaches_the_log_scan(spark, folder):
    store = Store(spark, folder)
    rows = hot_triples(spark, 3000, 1).withColumns({"backend": F.lit("b"), "namespace": F.lit("n")})
    store.load(rows)
    touched = spark.createDataFrame([(1, "s5")], "wiki_id INT, s STRING")
    diff = diff_log(hot_triples(spark, 3000, 2), store.log(), touched, touched_small=True)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    # Both inputs meet the broadcast keys below the only exchange.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")
    assert plan.count("LeftSemi") == 2
    assert diff.select("s").distinct().count() == 1


def test_reading_before_an_epoch_lists_no_later_one(spark, folder):
    store = Store(spark, folder)
    rows = hot_triples(spark, 30, 1).withColumns({"backend": F.lit("b"), "namespace": F.lit("n")})
    for epoch in range(3):
        store.load(rows, epoch)
    files = store.log(before=2).inputFiles()
    assert files and not any("epoch=2" in f for f in files)


def test_log_of_few_routes_reads_only_their_directories(spark, folder):
    store = Store(spark, folder)
    n = (F.col("s") == "s4").cast("string")
    rows = hot_triples(spark, 3000, 1).withColumns({"backend": F.concat(F.lit("b:"), n), "namespace": F.lit("n")})
    store.load(rows)
    store.compact(0)
    store.load(rows, 1)
    log = store.log(routes=[("b:true", "n")])
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(backend") == 2
    assert {r["s"] for r in log.collect()} == {"s4"}


def test_a_hot_tenant_is_written_by_several_tasks(spark, folder, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    rows = hot_triples(spark, 30000, 1).withColumns(
        {"backend": F.lit("b"), "namespace": F.when(F.col("s") == "s4", "small").otherwise("hot")}
    )
    store = Store(spark, folder)
    store.load(rows)
    files = store.log().select("namespace", F.input_file_name().alias("file")).distinct()
    got = {r["namespace"]: r["count"] for r in files.groupBy("namespace").count().collect()}
    assert got["small"] == 1 and got["hot"] > 3


def test_sources_of_few_wikis_are_read_in_part(spark, folder):
    table = hot_triples(spark, 300, 1).withColumn("wiki_id", (F.length("o") + F.length("s")).cast("int"))
    table.write.partitionBy("wiki_id").parquet(folder)
    table = spark.read.parquet(folder)
    wikis = spark.createDataFrame([(34, "a.test")], "wiki_id INT, domain STRING")
    sources = Sources(wikis, table.withColumnRenamed("s", "entity_id"), table).only([34])
    plan = sources.current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(wiki_id" in plan
    assert [r[0] for r in sources.current.select("wiki_id").distinct().collect()] == [34]


def test_what_several_passes_read_is_joined_once(spark):
    """The current triples of a service with several passes are a table, not joins that every pass runs again."""
    once, kept = (_sources(spark, SF_DIR, passes=n).current for n in (1, 2))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert "Join" in once._jdf.queryExecution().executedPlan().toString()
    rows = tables.current(spark, SF_DIR).select(*kept.columns)
    assert kept.exceptAll(rows).isEmpty() and rows.exceptAll(kept).isEmpty()
