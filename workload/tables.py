"""The updater's inputs, derived from the given tables.

Only ``feed_path`` writes: the feed is landed data to the updater, so it is
packed and written once per application and table folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbsync.functions.urls import entity_uri
from ebbsync.operators.feed import batch_json, flatten_batches, explode_ids, pack_batches
from ebbsync.operators.routing import resolve_wikis
from ebbsync.session import configure, work_dir
from ebbsync.sources.feed import read_polls

# Batch ids are wiki_id * BATCH_ID_STEP + seq, unique up to this many batches a wiki.
BATCH_ID_STEP = 10_000_000_000

_feeds: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wikis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("wiki_id"),
        F.concat(F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(".wiki.test")).alias("domain"),
        F.concat(F.lit("qs-"), F.col("n_regionkey").cast("string"), F.lit(".test:9999")).alias("backend"),
        F.concat(F.lit("ns_"), F.col("n_nationkey").cast("string")).alias("namespace"),
    )


def entity_id(column: str):
    return F.concat(F.lit("Q"), F.col(column).cast("string"))


def entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_custkey") % 4
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("wiki_id"),
        entity_id("c_custkey").alias("entity_id"),
        F.when(kind < 2, "item").when(kind == 2, "property").otherwise("other").alias("entity_type"),
    )


def snapshot(spark: SparkSession, sf_dir: str, least_balance: int | None = -800) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    if least_balance is not None:
        customers = customers.filter(F.col("c_acctbal") >= least_balance)
    return customers.select(
        F.col("c_nationkey").alias("wiki_id"),
        entity_id("c_custkey").alias("entity_id"),
        F.col("c_mktsegment").alias("segment"),
    )


def one_off_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an id of a one-off run; a run covers one segment of one wiki.

    The segments differ in their first letter, which numbers the run.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("wiki_id"),
        (F.col("c_nationkey").cast("bigint") * 1000 + F.ascii("c_mktsegment")).alias("batch_id"),
        entity_id("c_custkey").alias("entity_id"),
    )
    return customers.join(wikis(spark, sf_dir), "wiki_id").drop("wiki_id")


def _changes(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", *extra)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("wiki_id"),
        F.col("o_orderkey").alias("change_id"),
        F.col("o_orderdate").alias("ts"),
        entity_id("c_custkey").alias("entity_id"),
        *extra,
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir)


def typed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = entity_types(spark, sf_dir)
    return changes(spark, sf_dir).join(types, ["wiki_id", "entity_id"])


def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes already applied; every fifth wiki is new and has none."""
    done = _changes(spark, sf_dir, "o_orderstatus").filter("o_orderstatus = 'F' AND wiki_id % 5 <> 0")
    return done.select("wiki_id", "ts")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_batches(changes(spark, sf_dir))
    return packed.withColumn("batch_id", F.col("wiki_id").cast("bigint") * BATCH_ID_STEP + F.col("seq"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed: poll ``n`` has the n-th batch of every wiki, so at most one per nation."""
    batch = batch_json(*[F.col(c) for c in ("batch_id", "entity_ids", "domain", "backend", "namespace")])
    members = F.array_sort(F.collect_list(F.struct("wiki_id", batch.alias("batch"))))
    return (
        batches(spark, sf_dir)
        .join(wikis(spark, sf_dir), "wiki_id")
        .groupBy(F.col("seq").alias("poll_seq"))
        .agg(F.to_json(F.transform(members, lambda m: m["batch"])).alias("body"))
    )


def feed_path(spark: SparkSession, sf_dir: str) -> str:
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _feeds:
        path = work_dir(spark, "feed")
        polls(spark, sf_dir).write.parquet(path)
        _feeds[key] = path
    return _feeds[key]


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_polls(spark, feed_path(spark, sf_dir), fmt="parquet")


def recounted_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with batch ids that start at 1 in every poll, as after a restart of the feed's counter."""
    number = (F.col("batch_pos") + 1).cast("bigint")
    batch = batch_json(number, *[F.col(c) for c in ("entity_ids", "domain", "backend", "namespace")])
    members = F.array_sort(F.collect_list(F.struct("batch_pos", batch.alias("batch"))))
    flat = flatten_batches(feed(spark, sf_dir))
    return flat.groupBy("poll_seq").agg(F.to_json(F.transform(members, lambda m: m["batch"])).alias("body"))


def moving_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with wikis that move to another store and back: every third poll names it, for two wikis of three."""
    moved = (F.col("poll_seq") % 3 == 1) & (F.floor(F.col("batch_id") / BATCH_ID_STEP) % 3 < 2)
    namespace = F.when(moved, F.concat(F.col("namespace"), F.lit("_new"))).otherwise(F.col("namespace"))
    batch = batch_json(F.col("batch_id"), F.col("entity_ids"), F.col("domain"), F.col("backend"), namespace)
    members = F.array_sort(F.collect_list(F.struct("batch_pos", batch.alias("batch"))))
    flat = flatten_batches(feed(spark, sf_dir))
    return flat.groupBy("poll_seq").agg(F.to_json(F.transform(members, lambda m: m["batch"])).alias("body"))


def date_back(spark: SparkSession, path: str, days: int) -> None:
    """Set the modification time of every file below ``path`` back."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(folder, True)
    while files.hasNext():
        status = files.next()
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def feed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_wikis(flatten_batches(feed(spark, sf_dir)), wikis(spark, sf_dir))


def feed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_ids(feed_batches(spark, sf_dir))


def triples(spark: SparkSession, sf_dir: str, flags: tuple[str, ...]) -> DataFrame:
    """Line items with the given return flags as triples; rows may repeat."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin(*flags))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = (
        lines.select("l_orderkey", "l_linenumber", "l_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(wikis(spark, sf_dir), F.col("c_nationkey") == F.col("wiki_id"))
    )
    return joined.select(
        "wiki_id",
        entity_uri(F.col("domain"), entity_id("c_custkey")).alias("s"),
        F.concat(F.lit("P"), F.col("l_linenumber").cast("string")).alias("p"),
        F.col("l_partkey").cast("string").alias("o"),
        "backend",
        "namespace",
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir, ("A", "N"))


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir, ("N", "R"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("Q"), F.floor(F.col("doc_id") / 4).cast("string")).alias("entity_id"),
        "lang",
        "doc_id",
        "text",
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(entity_id("page_id").alias("entity_id"), "url")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        entity_id("o_custkey").alias("entity_id"),
        F.concat(F.lit("P"), F.col("l_linenumber").cast("string")).alias("p"),
        F.col("l_partkey").cast("string").alias("o"),
    )


def poll_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as poll bodies of every class; cheap purchases add a batch without a wiki."""
    event = F.col("event_id").cast("string")
    good = F.concat(
        F.lit('{"id":'), event, F.lit(',"entityIds":"Q'), F.col("user_id").cast("string"),
        F.lit('","wiki":{"domain":"d.test","wiki_queryservice_namespace":{"backend":"b.test:9999","namespace":"n"}}}'),
    )
    bad = F.when(F.col("value") < 50, F.concat(F.lit(',{"id":'), event, F.lit("},5"))).otherwise("")
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", "[]")
        .when(kind == "view", F.concat(F.lit('{"id":'), event, F.lit("}")))
        .when(kind == "error", "{bad")
        .when(kind == "signup", "")
        .otherwise(F.concat(F.lit("["), good, bad, F.lit("]")))
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("poll_seq"), body.alias("body"))


def ack_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id").cast("string")
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", F.concat(F.lit('{"batches":['), event, F.lit("]}")))
        .when(kind == "view", '{"batches":[]}')
        .when(kind == "error", "{bad")
        .when(kind == "signup", F.col("props"))
        .otherwise('{"batches":"x"}')
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("body"))
