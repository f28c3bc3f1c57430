import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import batch, polls, tuples
from ebbsync.config import UpdaterConfig
from ebbsync.functions.json import strict_document
from ebbsync.operators.feed import (
    Packer,
    classify_polls,
    explode_ids,
    flatten_batches,
    land_polls,
    pack_batches,
    quarantine,
)
from ebbsync.operators.metrics import limit_passes
from ebbsync.operators.routing import derive_targets, filter_namespaces, namespace_table
from ebbsync.session import Scratch, shared_root
from ebbsync.sources.feed import read_polls, write_poll_files


def test_poll_classes(spark):
    bodies = ["[]", "", " \n\t", "{bad", "null", "5", '{"id":1}', '"x"', [batch(1, "Q1")], "['a']"]
    got = classify_polls(polls(spark, *bodies)).orderBy("poll_seq").select("poll_class").collect()
    assert [r[0] for r in got] == [
        "ok", "empty", "empty", "invalid_json", "not_array", "not_array", "not_array", "not_array", "ok",
        "invalid_json",
    ]


def test_bad_neighbors_do_not_stop_good_batches(spark):
    feed = polls(
        spark,
        [batch(1, "Q1"), {"id": 2}],
        [batch(3, "Q1"), 5, None],
        "{bad",
        [batch(4, "Q1")],
    )
    assert [r[0] for r in tuples(flatten_batches(feed).select("batch_id"))] == [1, 3, 4]
    reasons = tuples(quarantine(land_polls(feed)).select("poll_seq", "batch_pos", "reason"))
    assert reasons == [
        (0, 1, "malformed_batch"), (1, 1, "malformed_batch"), (1, 2, "malformed_batch"), (2, None, "invalid_json"),
    ]


def test_every_missing_or_nested_field_is_malformed(spark):
    def without(path):
        row = batch(1, "Q1")
        holder = row
        for key in path[:-1]:
            holder = holder[key]
        del holder[path[-1]]
        return row

    store = ("wiki", "wiki_queryservice_namespace")
    bad = [without(p) for p in (("id",), ("entityIds",), ("wiki",), ("wiki", "domain"), store, (*store, "backend"), (*store, "namespace"))]
    bad += [batch(1, {"x": 1}), batch(1, ["Q1"]), batch(1, None), batch("x", "Q1"), batch(True, "Q1"), batch(None, "Q1")]
    bad += [batch(1, "Q1", domain={"x": 1}), batch(1, "Q1", backend=None)]
    landed = land_polls(polls(spark, bad))
    assert flatten_batches(polls(spark, bad)).isEmpty()
    assert landed.filter("batch_class = 'malformed_batch' AND payload IS NOT NULL").count() == len(bad)


def test_ids_are_read_as_numbers_and_repeated_keys_keep_the_last(spark):
    feed = polls(spark, [batch("7", "Q1"), batch(1.5, "Q1"), batch(2**40, "Q1")])
    assert tuples(flatten_batches(feed).select("batch_id")) == [(1,), (1099511627776,), (7,)]
    repeated = json.dumps([batch(1, "Q1")]).replace('"id": 1', '"id": 1, "id": 2')
    assert tuples(flatten_batches(polls(spark, repeated)).select("batch_id")) == [(2,)]


def test_explode_keeps_positions_and_repeats_and_drops_blanks(spark):
    feed = polls(spark, [batch(1, "Q1,,Q2,"), batch(2, "Q1,Q1"), batch(3, " "), batch(4, " Q9 ")])
    rows = explode_ids(flatten_batches(feed)).select("batch_id", "id_pos", "entity_id")
    assert tuples(rows) == [(1, 0, "Q1"), (1, 2, "Q2"), (2, 0, "Q1"), (2, 1, "Q1"), (4, 0, "Q9")]


@pytest.mark.parametrize("limit, kept", [(-1, 5), (0, 0), (-2, 0), (3, 3), (9, 5)])
def test_pass_limit(spark, limit, kept):
    assert limit_passes(polls(spark, *["[]"] * 5), limit).count() == kept


def test_targets_follow_scheme_and_ingress(spark):
    batches = flatten_batches(polls(spark, [batch(1, "Q1", "w.test", "h:9", "ns")]))
    columns = ["sparql_url", "concept_uri", "wiki_url", "namespaces", "proxy_map"]
    assert tuples(derive_targets(batches).select(columns)) == [
        ("http://h:9/bigdata/namespace/ns/sparql", "https://w.test", "https://w.test", "120,122,146", None)
    ]
    cfg = UpdaterConfig(scheme="http", ingress="in:80", namespaces="1")
    assert tuples(derive_targets(batches, cfg).select(columns)) == [
        ("http://h:9/bigdata/namespace/ns/sparql", "https://w.test", "http://w.test", "1", "w.test=in:80")
    ]


def test_namespace_filter(spark):
    rows = spark.createDataFrame([("Q1", "item"), ("P1", "property"), ("X", "other"), ("U", None)], "e STRING, entity_type STRING")
    ns = namespace_table(spark)
    assert tuples(filter_namespaces(rows, ns, "120,122,146").select("e", "ns", "slot")) == [
        ("P1", 122, "main"), ("Q1", 120, "main"),
    ]
    assert tuples(filter_namespaces(rows, ns, "x, 122").select("e")) == [("P1",)]
    assert tuples(filter_namespaces(rows, ns, "120", keep_untyped=True).select("e")) == [("Q1",), ("U",)]


def test_poll_files_round_trip(spark, folder):
    feed = polls(spark, [batch(1, "Q1")], "", "{bad", "[]")
    write_poll_files(feed, folder)
    got = read_polls(spark, folder)
    assert "landed_at" in read_polls(spark, folder, streaming=True).columns
    assert tuples(classify_polls(got).select("poll_seq", "poll_class")) == [
        (0, "ok"), (1, "empty"), (2, "invalid_json"), (3, "ok"),
    ]


def test_poll_files_need_a_number(spark, folder):
    spark.createDataFrame([("[]",)], "value STRING").write.text(folder)
    with pytest.raises(Exception, match="no poll number"):
        read_polls(spark, folder).select("poll_seq").collect()
    with pytest.raises(ValueError):
        read_polls(spark, folder, fmt="csv")


def changes(spark, rows):
    return spark.createDataFrame(rows, "wiki_id INT, ts INT, change_id BIGINT, entity_id STRING")


def packed_by_hand(rows, size):
    expected = []
    for wiki in {r[0] for r in rows}:
        ids = [r[3] for r in sorted(r for r in rows if r[0] == wiki)]
        for seq in range(0, len(ids), size):
            part = ids[seq:seq + size]
            expected.append((wiki, seq // size, ",".join(part), len(part)))
    return sorted(expected, key=repr)


@pytest.mark.parametrize("size", [1, 7, 20])
def test_pack_with_one_hot_wiki(spark, size):
    # Wiki 0 has most rows, all at one time stamp; wiki 5 has a single row.
    rows = [(0, 1, n, f"Q{n % 13}") for n in range(3000)]
    rows += [(n % 4 + 1, n // 7, n, f"Q{n}") for n in range(1000)] + [(5, 0, 0, "Q0")]
    packed = pack_batches(changes(spark, rows).repartition(5), size)
    assert tuples(packed.drop("until")) == packed_by_hand(rows, size)


def test_flatten_of_pack_gives_the_changes_in_order(spark):
    rows = [(1, n // 3, n, f"Q{(n * 7) % 50}") for n in range(101)]
    packed = pack_batches(changes(spark, rows), 20)
    exploded = explode_ids(packed).orderBy("seq", "id_pos").select("entity_id").collect()
    assert [r[0] for r in exploded] == [r[3] for r in rows]


def test_strict_document_accepts_what_one_json_value_is(spark):
    texts = [
        '{"batches":[1]}', ' {"batches":[1]}\n', '{"batches":[1]} x', '{"batches":[1]}]', '{"batches":[1]}}',
        '{"batches":[1]},{"a":1}', '{"batches":[1]},"k":1', '{"a":1}{"b":2}', "[1,2]", "1,2", "", "null", "{bad",
        '"x"', '1', '1] [', '1} {', '{"a":"}]"}', '{"a":1},', '[1]]', 'true', '{"v":1}, "w":[2]', '],[', '},{',
    ]

    def valid(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = {r.t: r.ok for r in df.select("t", strict_document(F.col("t")).isNotNull().alias("ok")).collect()}
    assert got == {t: valid(t) for t in texts}


def history(n, wikis=3, start=0):
    """Changes of some wikis in turn, as ``(wiki_id, ts, change_id, entity_id)``."""
    return [(k % wikis, k // 7, k, f"Q{k % 11}") for k in range(start, start + n)]


CHANGE = "wiki_id INT, ts BIGINT, change_id BIGINT, entity_id STRING"


@pytest.mark.parametrize("cuts", [[100], [40, 1, 0, 59], [7, 93], [50, 50, 0]])
def test_packing_in_calls_equals_packing_in_one(spark, folder, cuts):
    rows = history(100)
    rows += [(9, 1000, 1000, "only")]
    packer = Packer(spark, folder, size=8)
    start = 0
    for call, n in enumerate(cuts):
        # A wiki that comes last, and others without a change in the last call.
        part = rows[start : start + n] + (rows[100:] if call == 0 else [])
        got = packer.pack(spark.createDataFrame(part, CHANGE), flush=call == len(cuts) - 1)
        assert all(row.n == 8 for row in got.collect()) or call == len(cuts) - 1
        start += n
    one = pack_batches(spark.createDataFrame(rows, CHANGE), 8)
    assert tuples(packer.batches()) == tuples(one)
    # The next call goes on from there.
    more = packer.pack(spark.createDataFrame([(0, 2000, 2000, "Qx")], CHANGE), flush=True).collect()
    highest = max(r.seq for r in one.collect() if r.wiki_id == 0)
    assert [(r.wiki_id, r.seq, r.entity_ids, r.n, r.until) for r in more] == [(0, highest + 1, "Qx", 1, 2000)]


def test_a_lost_call_of_packing_is_done_again(spark, folder):
    packer = Packer(spark, folder, size=4)
    packer.pack(spark.createDataFrame(history(30), CHANGE))
    # Lost before what is carried was written.
    spark.createDataFrame([(0, 99)], "wiki_id INT, seq BIGINT").write.parquet(f"{folder}/batches/call=1")
    packer.pack(spark.createDataFrame(history(30, start=30), CHANGE), flush=True)
    assert tuples(packer.batches()) == tuples(pack_batches(spark.createDataFrame(history(60), CHANGE), 4))


def test_packing_leaves_no_scratch(spark, folder):
    root = Path(shared_root(spark)) / "ebbsync"
    before = {p.name for p in root.iterdir()}
    Packer(spark, folder).pack(spark.createDataFrame(history(30), CHANGE))
    with Scratch(spark) as scratch:
        assert pack_batches(spark.createDataFrame(history(30), CHANGE), scratch=scratch).count() == 3
    assert {p.name for p in root.iterdir()} - before <= {Path(folder).name}
