import json
from datetime import datetime

import pytest

from conftest import batch, polls, tuples
from ebbsync.config import UpdaterConfig
from ebbsync.functions.order import packed
from ebbsync.operators.acks import (
    ack_batch_ids,
    acks,
    deliveries,
    delivery_states,
    given_up,
    outcomes,
    pending,
    unanswered,
    validate_acks,
)
from ebbsync.operators.feed import explode_ids, flatten_batches, land_polls
from ebbsync.operators.metrics import pass_metrics
from ebbsync.operators.munge import entity_facts, facts_to_triples, filter_langs, single_label
from ebbsync.operators.requests import latest_per_entity, lookup_state, resume_point
from ebbsync.operators.routing import resolve_wikis
from ebbsync.plans.update import Sources


@pytest.fixture
def wikis(spark):
    return spark.createDataFrame([(1, "a.test"), (2, "b.test")], "wiki_id INT, domain STRING")


def looked_up(spark, wikis, feed, known):
    batches = resolve_wikis(flatten_batches(feed), wikis)
    snapshot = spark.createDataFrame(known, "wiki_id INT, entity_id STRING, segment STRING")
    return batches, lookup_state(explode_ids(batches), snapshot)


def test_batches_succeed_or_fail_as_a_whole(spark, wikis):
    feed = polls(spark, [batch(1, "Q1,Q2"), batch(2, "Q1,Q3"), batch(3, " ,"), batch(4, "Q1", "nowhere.test")])
    batches, found = looked_up(spark, wikis, feed, [(1, "Q1", "x"), (1, "Q2", "y"), (2, "Q3", "z")])
    result = outcomes(batches, found)
    assert tuples(result.select("batch_id", "total", "failed", "success")) == [
        (1, 2, 0, True), (2, 2, 1, False), (3, 0, 0, True), (4, 1, 1, False),
    ]
    assert tuples(acks(result).select("batch_id", "status", "body")) == [
        (1, "done", '{"batches":[1]}'), (2, "not_done", '{"batches":[2]}'),
        (3, "done", '{"batches":[3]}'), (4, "not_done", '{"batches":[4]}'),
    ]
    assert tuples(pending(batches, acks(result)).select("batch_id")) == [(2,), (4,)]


def test_metrics_count_every_poll(spark, wikis):
    feed = polls(spark, [batch(1, "Q1"), batch(2, "Q9,Q1"), 5], "{bad", "[]")
    batches, found = looked_up(spark, wikis, feed, [(1, "Q1", "x")])
    got = pass_metrics(land_polls(feed), outcomes(batches, found))
    assert tuples(got.select("poll_seq", "poll_class", "batches", "malformed", "done", "not_done", "entities")) == [
        (0, "ok", 3, 1, 1, 1, 3), (1, "invalid_json", 0, 0, 0, 0, 0), (2, "ok", 0, 0, 0, 0, 0),
    ]


def test_ack_validation(spark):
    bodies = [
        '{"batches":[1]}', '{"batches":[]}', "{bad", '{"k":1}', '{"batches":"x"}', '{"batches":[1,2],"x":0}',
        '{"batches":[1]} tail', "[1]", "", '{"batches":null}', '{"batches":{"0":1}}', '{"batches":["7"]}',
    ]
    checked = validate_acks(spark.createDataFrame(list(enumerate(bodies)), "n INT, body STRING"))
    status = [r[0] for r in checked.orderBy("n").select("http_status").collect()]
    assert status == [200, 500, 500, 500, 500, 200, 500, 500, 500, 500, 500, 200]
    assert tuples(ack_batch_ids(checked).select("n", "ack_pos", "batch_id")) == [
        (0, 0, 1), (11, 0, 7), (5, 0, 1), (5, 1, 2),
    ]


ACK = "poll_seq BIGINT, batch_pos INT, status STRING, epoch BIGINT"


def test_answers_are_per_delivery(spark):
    batches = flatten_batches(polls(spark, [batch(1, "Q1"), batch(2, "Q2")], [batch(2, "Q2"), batch(3, "Q3"), batch(1, "Q9")]))
    acked = spark.createDataFrame([(0, 0, "done", 1), (0, 1, "not_done", 1)], ACK)
    # Id 1 comes again with other work, id 2 with the same, which is not done yet.
    assert tuples(pending(batches, acked).select("batch_id", "poll_seq")) == [(1, 1), (2, 0), (2, 1), (3, 1)]
    assert tuples(unanswered(batches, acked).select("batch_id", "poll_seq")) == [(1, 1), (2, 1), (3, 1)]


def test_states_of_deliveries(spark):
    feed = polls(
        spark,
        [batch(1, "Q1"), batch(2, "Q2"), batch(3, "Q3"), batch(4, "Q4"), batch(5, "Q5")],
        [batch(1, "Q1"), batch(2, "other work"), batch(3, "Q3", "b.test"), batch(5, "Q5")],
        [batch(4, "Q4"), batch(4, "Q4")],
    )
    batches = flatten_batches(feed)
    acked = spark.createDataFrame(
        [
            (0, 0, "not_done", 1), (1, 0, "done", 2),  # done when it came again
            (0, 1, "not_done", 1), (0, 1, "not_done", 2), (1, 1, "done", 2),  # other work under its id
            (0, 2, "not_done", 1), (1, 2, "done", 1),  # the same ids of another wiki
            (0, 3, "done", 1), (2, 1, "not_done", 3),  # an earlier success settles nothing later
            (0, 4, "not_done", 4), (0, 4, "done", 1), (1, 3, "not_done", 4), (1, 3, "done", 9),  # the last answer counts
        ],
        ACK,
    )
    batches = batches.unionByName(batches.limit(2))
    got = delivery_states(batches, acked, max_tries=2).select("poll_seq", "batch_pos", "tries", "state")
    assert tuples(got) == [
        (0, 0, 1, "done"), (0, 1, 2, "given_up"), (0, 2, 1, "not_done"), (0, 3, 1, "done"), (0, 4, 2, "done"),
        (1, 0, 1, "done"), (1, 1, 1, "done"), (1, 2, 1, "done"), (1, 3, 2, "done"), (2, 0, 0, "unanswered"),
        (2, 1, 1, "not_done"),
    ]
    assert tuples(pending(batches, acked, 2).select("poll_seq", "batch_pos")) == [(0, 2), (2, 0), (2, 1)]
    assert tuples(pending(batches, acked).select("poll_seq", "batch_pos")) == [(0, 1), (0, 2), (2, 0), (2, 1)]
    (aside,) = given_up(batches, acked, 2).collect()
    assert (aside.poll_seq, aside.batch_pos, aside.reason) == (0, 1, "given_up")
    assert json.loads(aside.payload) == batch(2, "Q2")


def test_packed_orders(spark):
    rows = [(5, 1, 0), (5, 0, 2**31 - 1), (10**18 - 1, 2, 7), (0, 0, 0), (5, 1, 1)]
    df = spark.createDataFrame(rows, "a BIGINT, b INT, c INT")
    assert [tuple(r) for r in df.orderBy(packed("a", "b", "c")).collect()] == sorted(rows)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        spark.createDataFrame([(10**18, 0)], "a BIGINT, b INT").select(packed("a", "b")).collect()
    with pytest.raises(ValueError):
        packed("a", "b", "c", "d")


def test_deliveries(spark):
    feed = polls(spark, [batch(1, "Q1"), batch(2, "Q2")], [batch(3, "Q3"), batch(1, "Q9")])
    landed_twice = flatten_batches(feed).unionByName(flatten_batches(feed))
    got = deliveries(landed_twice).select("batch_id", "poll_seq", "batch_pos", "entity_ids")
    assert tuples(got) == [(1, 0, 0, "Q1"), (1, 1, 1, "Q9"), (2, 0, 1, "Q2"), (3, 1, 0, "Q3")]


def test_latest_request_wins(spark, wikis):
    feed = polls(spark, [batch(1, "Q1,Q2,Q1"), batch(2, "Q2")], [batch(3, "Q2")])
    rows = explode_ids(resolve_wikis(flatten_batches(feed), wikis))
    got = latest_per_entity(rows)
    assert tuples(got) == [(1, "Q1", 0, 0, 2, 1, 1), (1, "Q2", 1, 0, 0, 3, 2)]


@pytest.mark.parametrize("broadcast_starts", [False, True])
def test_resume_point(spark, broadcast_starts):
    day = lambda d: datetime(2024, 1, d)
    changes = spark.createDataFrame(
        [(1, 1, day(1)), (1, 2, day(5)), (1, 3, day(9)), (2, 4, day(2)), (2, 5, day(28)), (2, 6, day(30))],
        "wiki_id INT, change_id BIGINT, ts TIMESTAMP_NTZ",
    )
    applied = spark.createDataFrame([(1, day(1)), (1, day(5))], "wiki_id INT, ts TIMESTAMP_NTZ")
    ids = lambda df: [r[0] for r in tuples(df.select("change_id"))]
    # Wiki 1 resumes at its last applied change, wiki 2 two days before the newest of all.
    assert ids(resume_point(changes, applied, days_back=2, broadcast_starts=broadcast_starts)) == [2, 3, 5, 6]
    assert ids(resume_point(changes, applied, start=day(9))) == [3, 5, 6]


TERMS = [("Q1", "fr", 1, "un"), ("Q1", "en", 3, "one"), ("Q1", "en", 2, "uno"), ("Q2", "xx", 4, "?"), ("Q3", "de", 5, "drei")]


def test_languages_and_single_label(spark):
    terms = spark.createDataFrame(TERMS, "entity_id STRING, lang STRING, doc_id BIGINT, text STRING")
    assert filter_langs(terms, ["en", "xx"]).count() == 3
    # Q2 has only an unlisted language, and a tie goes to the smaller source key.
    assert tuples(single_label(terms, ["en", "de", "fr"])) == [("Q1", "en", 2, "uno"), ("Q3", "de", 5, "drei")]
    assert tuples(single_label(terms, ["fr", "en"])) == [("Q1", "fr", 1, "un")]


def test_facts_become_triples(spark, wikis):
    terms = spark.createDataFrame([(1, *TERMS[0]), (1, *TERMS[1])], "wiki_id INT, entity_id STRING, lang STRING, doc_id BIGINT, text STRING")
    statements = spark.createDataFrame([(1, "Q1", "P1", "v")], "wiki_id INT, entity_id STRING, p STRING, o STRING")
    links = spark.createDataFrame([(2, "Q1", "http://x")], "wiki_id INT, entity_id STRING, url STRING")
    keys = ["wiki_id", "entity_id"]
    facts = entity_facts(terms, statements, links, keys=keys)
    assert tuples(facts_to_triples(facts, wikis)) == [
        (1, "https://a.test/entity/Q1", "P1", "v"),
        (1, "https://a.test/entity/Q1", "label@en", "one"),
        (1, "https://a.test/entity/Q1", "label@fr", "un"),
        (2, "https://b.test/entity/Q1", "sitelink", "http://x"),
    ]
    assert entity_facts(terms, statements, links, skip_links=True, keys=keys).filter("kind = 'sitelink'").isEmpty()
    cfg = UpdaterConfig(langs=("en", "fr"), single_label=True, skip_links=True)
    cleaned = Sources.from_facts(wikis, statements, terms, statements, links, cfg).current
    assert [(r[2], r[3]) for r in tuples(cleaned)] == [("P1", "v"), ("label@en", "one")]


def test_config_is_checked():
    for wrong in ({"interval_s": -1}, {"max_tries": -1}, {"batch_size": 0}, {"single_label": True}):
        with pytest.raises(ValueError):
            UpdaterConfig(**wrong)
