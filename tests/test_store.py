import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from ebbsync.functions import buckets
from ebbsync.functions.sizes import fits, size_of
from ebbsync.operators.sync import (
    ROUTE,
    diff_deletes,
    diff_inserts,
    diff_log,
    diff_stores,
    diff_triples,
    in_buckets,
    number_stores,
    touched_buckets,
    touched_subjects,
    verify_applied,
)
from ebbsync.session import LEAST_PIECES, OPEN_COST, PIECES, TASK_BYTES, TASK_SETTINGS, configure
from ebbsync.sources.parts import Parts, create_file
from ebbsync.sources.store import Store, StoreChanged, dump, list_numbers, make_dirs

TRIPLE = "wiki_id INT, s STRING, p STRING, o STRING"
ROUTES = {1: ("b:1", "n1"), 2: ("b:1", "n2"), 3: ("c:1", "n3")}


def triples(spark, rows):
    return spark.createDataFrame(rows, TRIPLE)


def routed(spark, rows):
    return spark.createDataFrame(
        [(*row, *ROUTES[row[0]]) for row in rows], TRIPLE + ", backend STRING, namespace STRING"
    )


def ops(spark, rows):
    return routed(spark, [r[1:] for r in rows]).limit(0).withColumn("op", F.lit("I")) if not rows else (
        spark.createDataFrame([(*r, *ROUTES[r[1]]) for r in rows], "op STRING, " + TRIPLE + ", backend STRING, namespace STRING")
    )


def random_triples(seed, n=400):
    rng = random.Random(seed)
    return [(rng.randint(1, 3), f"s{rng.randint(0, 20)}", f"p{rng.randint(0, 3)}", str(rng.randint(0, 5))) for _ in range(n)]


def live(store, before=None):
    return {tuple(r) for r in store.current(before).select("wiki_id", "s", "p", "o").collect()}


@pytest.mark.parametrize("small", [False, True])
def test_diff_makes_touched_subjects_equal_and_leaves_the_others(spark, folder, small):
    stored, wanted = random_triples(1), random_triples(2)
    subjects = sorted({(w, s) for w, s, _, _ in stored + wanted if int(s[1:]) % 3})
    touched = spark.createDataFrame(subjects, "wiki_id INT, s STRING")
    args = (triples(spark, wanted), triples(spark, stored), touched, small)
    inserts = {tuple(r) for r in diff_inserts(*args).collect()}
    deletes = {tuple(r) for r in diff_deletes(*args).collect()}
    is_touched = lambda t: (t[0], t[1]) in set(subjects)
    assert inserts == {t for t in set(wanted) - set(stored) if is_touched(t)}
    assert deletes == {t for t in set(stored) - set(wanted) if is_touched(t)}

    store = Store(spark, folder)
    store.load(routed(spark, stored))
    changes = diff_log(triples(spark, wanted), store.log(), touched, small)
    assert {tuple(r) for r in changes.collect()} == {("I", *t) for t in inserts} | {("D", *t) for t in deletes}
    store.apply_epoch(ops(spark, [tuple(r) for r in changes.collect()]), 1)
    expected = {t for t in wanted if is_touched(t)} | {t for t in stored if not is_touched(t)}
    assert live(store) == expected
    assert verify_applied(triples(spark, wanted), store.current(), touched, small).isEmpty()
    assert diff_log(triples(spark, wanted), store.log(), touched, small).isEmpty()


def test_verify_counts_missing_and_extra(spark):
    touched = spark.createDataFrame([(1, "s")], "wiki_id INT, s STRING")
    expected = triples(spark, [(1, "s", "p", "1"), (1, "s", "p", "2"), (1, "t", "p", "1")])
    stored = triples(spark, [(1, "s", "p", "2"), (1, "s", "p", "3"), (1, "s", "p", "3")])
    assert tuples(verify_applied(expected, stored, touched)) == [(1, "s", 1, 1)]


def test_subject_without_current_triples_is_emptied(spark):
    touched = spark.createDataFrame([(1, "s")], "wiki_id INT, s STRING")
    stored = triples(spark, [(1, "s", "p", "1"), (1, "s", "q", "1"), (1, "t", "p", "1"), (2, "s", "p", "1")])
    got = diff_triples(triples(spark, []), stored, touched)
    assert tuples(got) == [("D", 1, "s", "p", "1"), ("D", 1, "s", "q", "1")]


def test_writing_an_epoch_again_replaces_all_of_it(spark, folder, conf):
    conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    store = Store(spark, folder)
    store.load(routed(spark, [(1, "s", "p", "1"), (2, "s", "p", "1"), (3, "s", "p", "1")]))
    store.apply_epoch(ops(spark, [("D", 1, "s", "p", "1"), ("I", 3, "s", "p", "2")]), 1)
    store.apply_epoch(ops(spark, [("D", 1, "s", "p", "1")]), 1)
    assert live(store) == {(2, "s", "p", "1"), (3, "s", "p", "1")}
    assert live(store, before=1) == {(1, "s", "p", "1"), (2, "s", "p", "1"), (3, "s", "p", "1")}
    store.apply_epoch(ops(spark, []), 1)
    assert live(store) == live(store, before=1)


def test_deleted_triple_can_come_back(spark, folder):
    store = Store(spark, folder)
    for epoch, op in enumerate("IDID"):
        store.apply_epoch(ops(spark, [(op, 1, "s", "p", "1")]), epoch)
    assert live(store, before=1) and not live(store, before=2) and live(store, before=3) and not live(store)


def test_compaction_changes_nothing_that_is_read(spark, folder):
    store = Store(spark, folder)
    store.load(routed(spark, random_triples(3)))
    for epoch in (1, 2, 3):
        rows = sorted(set(random_triples(epoch + 10, 60)))
        store.apply_epoch(ops(spark, [("ID"[i % 2], *row) for i, row in enumerate(rows)]), epoch)
    before = [live(store, before=n) for n in (1, 2, 3, 4)]
    store.compact(upto=2)
    assert [live(store, before=n) for n in (1, 2, 3, 4)] == before
    assert store.log().filter("epoch <= 2 AND op = 'D'").isEmpty()
    assert store.epochs_since_base() == 1
    store.compact(upto=3)
    assert live(store) == before[3] and store.log().filter("epoch <> 3").isEmpty()


def test_empty_store_reads_as_empty(spark, folder):
    store = Store(spark, folder)
    assert store.next_epoch() == 0
    assert store.log().isEmpty() and store.current().isEmpty() and store.acks().isEmpty()
    store.apply_epoch(ops(spark, []), 0)
    assert store.log().isEmpty() and store.current().isEmpty()
    assert store.next_epoch() == 1


def test_unfinished_epochs_are_not_read_and_not_reused(spark, folder):
    store = Store(spark, folder)
    store.load(routed(spark, [(1, "s", "p", "1")]))
    make_dirs(spark, f"{store.log_dir}/epoch=5")
    assert list_numbers(spark, store.log_dir, "epoch") == [0]
    assert store.next_epoch() == 6


def test_a_hot_tenant_is_written_as_several_bounded_files(spark, folder):
    store = Store(spark, folder, max_records_per_file=100)
    store.load(routed(spark, [(1, f"s{n}", "p", "1") for n in range(950)] + [(2, "s", "p", "1")]))
    files = spark.read.parquet(store.log_dir).groupBy(F.input_file_name()).count().collect()
    assert max(r[1] for r in files) <= 100
    assert sum(r[1] for r in files) == 951


def test_dump_needs_a_path(spark, folder):
    df = triples(spark, [(1, "s", "p", "o")])
    dump(df)
    dump(df, folder)
    assert tuples(spark.read.parquet(folder)) == tuples(df)


def test_acks_are_compacted_and_covered_epochs_expire(spark, folder):
    store = Store(spark, folder)
    columns = "batch_id BIGINT, poll_seq BIGINT, batch_pos INT, total BIGINT, failed BIGINT, body STRING, status STRING"
    for epoch in range(4):
        store.load(routed(spark, [(1, f"s{epoch}", "p", "1")]), epoch)
        status = "done" if epoch % 2 else "not_done"
        store.write_acks(spark.createDataFrame([(epoch, epoch, 0, 1, 0, "{}", status)], columns), epoch)
    acked, now = tuples(store.acks()), live(store)
    store.compact(upto=1)
    store.compact(upto=2)
    assert tuples(store.acks()) == acked and live(store) == now
    assert [tuples(store.acks(before=n)) for n in range(5)] == [acked[:n] for n in range(5)]
    store.expire()
    assert tuples(store.acks()) == acked and live(store) == now and store.next_epoch() == 4
    assert list_numbers(spark, store.log_dir, "epoch") == [3]
    assert list_numbers(spark, store.ack_base_dir, "upto") == [2]


def test_expire_needs_a_base(spark, folder):
    store = Store(spark, folder)
    store.load(routed(spark, [(1, "s", "p", "1")]))
    store.expire()
    assert live(store) == {(1, "s", "p", "1")}


def finished(spark, path):
    make_dirs(spark, path)
    create_file(spark, f"{path}/_SUCCESS")


def test_cover_takes_the_widest_parts_that_join(spark, folder):
    parts = Parts(spark, f"{folder}/log", f"{folder}/runs", f"{folder}/base")
    cover = lambda before=None: [(p.kind, p.low, p.high) for p in parts.cover(before)]
    assert cover() == [] and parts.used() == []
    for n in (0, 1, 2, 4, 5, 6, 7):
        finished(spark, f"{folder}/log/epoch={n}")
    make_dirs(spark, f"{folder}/log/epoch=3")  # lost
    for low, high in ((1, 4), (1, 2), (5, 6)):
        finished(spark, f"{folder}/runs/run={low}-{high}")
    make_dirs(spark, f"{folder}/runs/run=0-7")  # lost
    assert cover() == [("epoch", 0, 0), ("run", 1, 4), ("run", 5, 6), ("epoch", 7, 7)]
    # Before a number that a run spans, its epochs are read.
    assert cover(6) == [("epoch", 0, 0), ("run", 1, 4), ("epoch", 5, 5)]
    assert cover(4) == [("epoch", 0, 0), ("run", 1, 2)]
    finished(spark, f"{folder}/base/upto=2")
    assert cover() == [("base", 0, 2), ("epoch", 4, 4), ("run", 5, 6), ("epoch", 7, 7)]
    assert cover(2) == [("epoch", 0, 0), ("epoch", 1, 1)] and max(parts.used()) == 7
    parts.expire(keep=1)
    assert cover() == [("base", 0, 2), ("epoch", 4, 4), ("run", 5, 6), ("epoch", 7, 7)]
    assert list_numbers(spark, f"{folder}/log", "epoch", finished=False) == [4, 6, 7]


def counted(spark, path):
    return spark.read.option("recursiveFileLookup", "true").parquet(path).count()


def test_merging_changes_nothing_that_is_read(spark, folder):
    """Random epochs, merged as they come, against a store that never merges."""
    store, plain = Store(spark, f"{folder}/a", slice_rows=20, tier_bytes=4000), Store(spark, f"{folder}/b")
    rng = random.Random(5)
    for epoch in range(8):
        rows = sorted(set(random_triples(epoch, 30 if epoch else 300)))
        changes = ops(spark, [("I" if epoch == 0 or rng.random() < 0.5 else "D", *row) for row in rows])
        store.apply_epoch(changes, epoch)
        plain.apply_epoch(changes, epoch)
        store.merge(3)
    assert {"epoch", "run"} <= {part.kind for part in store.triple_parts.cover()}
    for before in (3, 6, 8):
        assert live(store, before) == live(plain, before)
    store.expire()
    assert len(list_numbers(spark, store.log_dir, "epoch")) < 8
    assert live(store) == live(plain)
    # A run keeps deletes, as what they take away lies in an older part; a base does not.
    assert not store.log().filter("op = 'D'").isEmpty()
    store.compact(7)
    assert live(store) == live(plain) and store.log().filter("op = 'D'").isEmpty()


def test_what_merging_writes_grows_with_the_logarithm(spark, folder):
    store = Store(spark, folder, tier_bytes=12_000)
    written, n_epochs, rows = 0, 24, 40
    old = F.concat(F.lit("old"), F.md5(F.col("id").cast("string")))
    store.load(spark.range(200_000).select(
        F.lit(1).alias("wiki_id"), old.alias("s"), F.lit("p").alias("p"), F.lit("1").alias("o"),
        F.lit("b:1").alias("backend"), F.lit("n1").alias("namespace"),
    ))
    for epoch in range(1, n_epochs + 1):
        store.load(routed(spark, [(1, f"s{epoch}-{n}", "p", "1") for n in range(rows)]), epoch)
        before = {part.path for part in store.triple_parts.runs()}
        store.merge(4)
        written += sum(counted(spark, part.path) for part in store.triple_parts.runs() if part.path not in before)
    # The large first epoch is never written again, and a change a few times.
    assert store.triple_parts.cover()[0].kind == "epoch"
    assert written <= 5 * n_epochs * rows
    assert len(store.triple_parts.cover()) <= 12
    assert store.current().count() == 200_000 + n_epochs * rows


def test_acks_are_merged(spark, folder):
    store = Store(spark, folder)
    columns = "batch_id BIGINT, poll_seq BIGINT, batch_pos INT, total BIGINT, failed BIGINT, body STRING, status STRING"
    for epoch in range(7):
        store.load(routed(spark, [(1, f"s{epoch}", "p", "1")]), epoch)
        store.write_acks(spark.createDataFrame([(epoch, epoch, 0, 1, 0, "{}", "done")], columns), epoch)
        if store.merge(3):
            store.expire()
    assert [r.epoch for r in store.acks().orderBy("epoch").collect()] == list(range(7))
    assert store.next_epoch() == 7 and len(store.ack_parts.cover()) <= 3
    assert [r.batch_id for r in store.acks_of(6).collect()] in ([6], [])
    with pytest.raises(ValueError):
        store.merge(1)


def scanned(df):
    """Rows that the file scans of a plan without exchanges gave."""
    result = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(metric.get().value() for metric in metrics if metric.isDefined()), result


@pytest.mark.parametrize("merged", [False, True])
def test_few_subjects_of_a_large_tenant_are_read_alone(spark, folder, merged):
    """Sorted files skip pages, and merged ones are in slices besides."""
    n = 1_000_000
    store = Store(spark, folder, slice_rows=100_000)
    rows = spark.range(0, n, 1, 4).select(
        F.lit(1).alias("wiki_id"), F.concat(F.lit("https://a.test/entity/Q"), F.floor(F.col("id") / 10).cast("string")).alias("s"),
        F.concat(F.lit("P"), (F.col("id") % 10).cast("string")).alias("p"), F.md5(F.col("id").cast("string")).alias("o"),
        F.lit("b:1").alias("backend"), F.lit("n").alias("namespace"),
    )
    store.load(rows)
    if merged:
        store.compact(0)
        slices = {r.slice for r in spark.read.parquet(f"{store.base_dir}/upto=0").select("slice").distinct().collect()}
        assert slices == {f"16-{k}" for k in range(16)}
    subject = "https://a.test/entity/Q777"
    number = spark.range(1).select(buckets.bucket(F.lit(1), F.lit(subject)).alias("number")).first().number
    read, result = scanned(store.log(routes=[("b:1", "n")], numbers=[number]))
    assert sum(r.s == subject for r in result) == 10
    assert read < 0.05 * n or not merged and read < 0.1 * n
    # All of the tenant is there without the numbers.
    assert store.log(routes=[("b:1", "n")]).count() == n


def test_labels_of_a_bucket(spark):
    numbers = [0, 1, 511, 512, buckets.BUCKETS - 1, 777_777]
    df = spark.createDataFrame([(n, 1 << k) for n in numbers for k in range(13)], "n INT, slices INT")
    for row in df.withColumn("label", buckets.label(F.col("n"), F.col("slices"))).collect():
        assert row.label in buckets.labels([row.n])
        assert row.label.startswith(f"{row.slices}-") and int(row.label.split("-")[1]) < row.slices
    got = spark.createDataFrame([(n,) for n in (0, 10, 11, 25, 10**9)], "n BIGINT").select(buckets.slices_for(F.col("n"), 10))
    assert [r[0] for r in got.collect()] == [1, 1, 2, 4, buckets.MAX_SLICES]


def test_many_long_subjects_are_cut_by_bucket(spark, folder):
    """300,000 touched subjects of 2,000,000, too many and too long to broadcast."""
    n, touched_n = 2_000_000, 300_000
    subject = F.concat(F.lit("https://a.test/" + "x" * 200 + "/Q"), F.col("id").cast("string"))
    rows = spark.range(0, n, 1, 8).select(F.lit(1).alias("wiki_id"), subject.alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o"))
    touched = rows.filter(F.substring_index("s", "/Q", -1).cast("int") < touched_n).select("wiki_id", "s")
    count, size = size_of(touched)
    assert count == touched_n and size > 200 * touched_n
    assert not fits(touched, 1_000_000, 64_000_000) and fits(touched, 1_000_000, 128_000_000)
    numbers = touched_buckets(touched)
    assert numbers.count() <= touched_n
    left = in_buckets(rows, numbers)
    # All touched ones, and of the others no more than the buckets' share.
    others = left.filter(F.substring_index("s", "/Q", -1).cast("int") >= touched_n).count()
    assert left.count() - others == touched_n
    assert others < 1.1 * (n - touched_n) * touched_n / buckets.BUCKETS
    log = rows.sample(0.5, seed=1).withColumns({"epoch": F.lit(0).cast("bigint"), "op": F.lit("I")})
    cut = diff_log(rows, log, touched, False, buckets=numbers)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin [bucket") == 2
    assert cut.count() == diff_log(rows, log, touched).count()


def test_routes_are_compared_apart(spark):
    route = ", backend STRING, namespace STRING"
    current = spark.createDataFrame([(1, "s", "p", "new", b, "n") for b in ("a", "b")], TRIPLE + route)
    log = spark.createDataFrame([(1, "s", "p", "old", "a", "n"), (1, "s", "p", "new", "b", "n"), (1, "s", "p", "x", "b", "n")], TRIPLE + route)
    log = log.withColumns({"epoch": F.lit(0).cast("bigint"), "op": F.lit("I")})
    touched = spark.createDataFrame([(1, "s", "a", "n")], "wiki_id INT, s STRING" + route)
    for small in (False, True):
        got = diff_log(current, log, touched, small, ROUTE).select("op", "backend", "o")
        assert tuples(got) == [("D", "a", "old"), ("I", "a", "new")]
    wikis = spark.createDataFrame([(1, "a.test")], "wiki_id INT, domain STRING")
    entities = spark.createDataFrame([(1, "Q1", "a", "n"), (1, "Q1", "b", "n"), (1, "Q1", "a", "n")], "wiki_id INT, entity_id STRING" + route)
    assert touched_subjects(entities, wikis).count() == 2
    assert touched_subjects(entities.drop(*ROUTE), wikis).count() == 1


def test_every_writer_gets_its_own_number(spark, folder):
    one, other = Store(spark, folder), Store(spark, folder)
    assert [one.claim_epoch(), other.claim_epoch(), one.claim_epoch()] == [0, 1, 2]
    # One claim is kept; a number that was claimed and lost is not given again.
    assert list_numbers(spark, f"{folder}/claims", "epoch", finished=False) == [2]
    one.load(routed(spark, [(1, "s", "p", "1")]), 7)
    assert other.claim_epoch() == 8


def test_another_writer_is_noticed(spark, folder):
    store, other = Store(spark, folder), Store(spark, folder)
    store.load(routed(spark, [(1, "s", "p", "1")]), store.claim_epoch())
    first = store.claim_epoch()
    read = store.triple_parts.cover(first)
    store.check_unchanged(read, first)
    # A later one began meanwhile; the earlier one has to run again.
    second = other.claim_epoch()
    late = other.triple_parts.cover(second)
    with pytest.raises(StoreChanged):
        store.check_unchanged(read, first)
    # The earlier one had written its epoch, which the later one has not read.
    store.load(routed(spark, [(1, "t", "p", "1")]), first)
    with pytest.raises(StoreChanged):
        other.check_unchanged(late, second)
    # Merging is no other writer's work.
    third = store.claim_epoch()
    read = store.triple_parts.cover(third)
    store.compact(first)
    store.expire()
    store.check_unchanged(read, third)


def test_stores_are_compared_in_one_row(spark):
    """Triples of a wiki with several stores pass the exchange once, and come out as the comparison by route has them."""
    named = [(1, f"b{n}", f"n{n}") for n in range(3)] + [(2, "b0", "other")]
    routes = spark.createDataFrame(named, "wiki_id INT, backend STRING, namespace STRING")
    triple = "wiki_id INT, s STRING, p STRING, o STRING"
    true = [(w, s, p, o) for w in (1, 2, 3) for s in ("s1", "s2", "s3") for p in ("p1", None) for o in ("o1", "o2")]
    current = spark.createDataFrame([*true, *true, (None, "s1", "p1", "o1"), (1, None, "p1", "o1")], triple)
    log = [(1, "s1", "p1", "o1", 0, "I", "b0", "n0"), (1, "s1", "p1", "o1", 1, "D", "b0", "n0"),
           (1, "s1", "p1", "gone", 0, "I", "b1", "n1"), (1, "s1", "p1", "gone", 0, "I", "b1", "n1"),
           (1, "s2", None, "o2", 2, "I", "b2", "n2"), (1, "s2", "p1", "gone", 0, "I", "b2", "n2"),
           (1, "s3", "p1", "gone", 0, "I", "b0", "n0"), (2, "s1", "p1", "gone", 0, "I", "b0", "other"),
           (2, "s1", "p1", "o1", 0, "I", "b9", "unnamed"), (3, "s1", "p1", "gone", 0, "I", "b0", "n0")]
    log = spark.createDataFrame(log, f"{triple}, epoch BIGINT, op STRING, backend STRING, namespace STRING")
    touched = [(1, "s1", "b0", "n0"), (1, "s1", "b1", "n1"), (1, "s2", "b2", "n2"), (2, "s1", "b0", "other"), (3, "s1", "b0", "n0")]
    touched = spark.createDataFrame(touched, "wiki_id INT, s STRING, backend STRING, namespace STRING")
    here = log.join(routes, ["wiki_id", *ROUTE], "left_semi")
    expected = tuples(diff_log(current.join(routes, "wiki_id"), here, touched, False, ROUTE))
    assert {row[0] for row in expected} == {"I", "D"} and {row[1] for row in expected} == {"b0", "b1", "b2"}
    numbered = number_stores(routes)
    assert sorted(row["no"] for row in numbered.collect()) == [0, 0, 1, 2]
    for small in (True, False):
        for numbers in (None, touched_buckets(touched)):
            got = diff_stores(current, log, touched, numbered, 3, small, numbers)
            assert got.columns == ["op", *ROUTE, "wiki_id", "s", "p", "o"]
            assert tuples(got) == expected
    # Before the exchange a triple has no store's name, so it is not repeated for each.
    plan = diff_stores(current, log, touched, numbered, 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(wiki_id" in plan and "hashpartitioning(backend" not in plan


def test_a_task_gets_bounded_bytes(spark, conf, folder):
    """What a task gets of an exchange and of a file does not grow with the session's settings or the table."""
    names = {key: key.replace(".", "__") for key in (*TASK_SETTINGS, PIECES, "spark.sql.shuffle.partitions")}
    conf(**{names[key]: "64m" for key in TASK_SETTINGS}, **{names[PIECES]: "8", "spark__sql__shuffle__partitions": "12"})
    configure(spark)
    assert [spark.conf.get(key) for key in TASK_SETTINGS] == [str(TASK_BYTES)] * len(TASK_SETTINGS)
    assert int(spark.conf.get(PIECES)) == LEAST_PIECES
    # As many small files as before: 32 polls are one task's, and one file's when they are landed.
    assert int(spark.conf.get(OPEN_COST)) * 32 == TASK_BYTES
    conf(**{names[key]: "1m" for key in TASK_SETTINGS}, **{names[PIECES]: "1000"})
    configure(spark)
    assert [spark.conf.get(key) for key in TASK_SETTINGS] == ["1m"] * len(TASK_SETTINGS)
    assert spark.conf.get(PIECES) == "1000"
    # One route's rows: a single file, of which no task has to read the whole.
    rows = spark.range(0, 3_000_000, 1, 4).select(
        F.lit(1).alias("wiki_id"), F.concat(F.lit("s"), F.xxhash64("id").cast("string")).alias("s"), F.lit("p").alias("p"),
        F.xxhash64("id", "id").cast("string").alias("o"), F.lit("b").alias("backend"), F.lit("n").alias("namespace"))
    conf(**{names[key]: "512m" for key in TASK_SETTINGS[:1]})
    store = Store(spark, folder)
    store.load(rows, epoch=0)
    files = store.log().groupBy(F.input_file_name().alias("f")).count().collect()
    # Row groups of a file begin where its tasks do, so more tasks than files have rows.
    conf(**{names[TASK_SETTINGS[1]]: str(TASK_BYTES)})
    tasks = store.log().groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert len(tasks) > len(files) and max(row["count"] for row in tasks) < 1_500_000
