"""Random feeds: the passes must do what a plain simulation of the service does."""

import random

import pytest

from conftest import batch, polls, tuples
from ebbsync.config import UpdaterConfig
from ebbsync.operators.feed import flatten_batches
from ebbsync.plans.update import Sources, update_pass
from ebbsync.sources.store import Store

DOMAINS = {1: "a.test", 2: "b.test", 3: "c.test"}
TRIPLE = "wiki_id INT, s STRING, p STRING, o STRING"


def subject(wiki, entity):
    return f"https://{DOMAINS[wiki]}/entity/{entity}"


def random_state(rng):
    """Triples that are true now, and the entities that can be fetched."""
    triples, known = set(), set()
    for wiki in DOMAINS:
        for n in range(12):
            if rng.random() < 0.9:
                known.add((wiki, f"Q{n}"))
            for _ in range(rng.randint(0, 3)):
                triples.add((wiki, subject(wiki, f"Q{n}"), f"P{rng.randint(0, 2)}", str(rng.randint(0, 3))))
    return triples, known


def random_poll(rng, numbers, old):
    rows = []
    for _ in range(rng.randint(1, 5)):
        again = old and rng.random() < 0.4
        number = rng.choice(old) if again else next(numbers)
        old.append(number)
        wiki = rng.choice(sorted(DOMAINS))
        ids = [f"Q{rng.randint(0, 12)}" for _ in range(rng.randint(0, 4))] + [""] * rng.randint(0, 1)
        rows.append((number, wiki, ids))
    return rows


@pytest.mark.parametrize("seed, broadcast_rows", [(1, 200_000), (2, 0), (3, 200_000)])
def test_passes_agree_with_a_simulation(spark, folder, seed, broadcast_rows):
    rng = random.Random(seed)
    cfg = UpdaterConfig(verify=True, broadcast_rows=broadcast_rows, prune_tenants=rng.choice([0, 1000]))
    store = Store(spark, folder)
    routes = {wiki: (f"b{wiki % 2}:1", f"n{wiki}") for wiki in DOMAINS}
    stored, _ = random_state(rng)
    store.load(
        spark.createDataFrame(
            [(*t, *routes[t[0]]) for t in stored], TRIPLE + ", backend STRING, namespace STRING"
        )
    )
    wikis = spark.createDataFrame(list(DOMAINS.items()), "wiki_id INT, domain STRING")
    numbers, old, poll_no = iter(range(1000)), [], 0
    for epoch in range(1, 4):
        current, known = random_state(rng)
        sources = Sources(
            wikis,
            spark.createDataFrame(sorted(known), "wiki_id INT, entity_id STRING"),
            spark.createDataFrame(sorted(current), TRIPLE),
        )
        feed = [random_poll(rng, numbers, old) for _ in range(rng.randint(1, 3))]
        bodies = ["[]"] * poll_no + [
            [batch(n, ",".join(ids), DOMAINS[wiki], *routes[wiki]) for n, wiki, ids in rows] for rows in feed
        ]
        poll_no += len(feed)
        acked = update_pass(flatten_batches(polls(spark, *bodies)), sources, store, cfg, epoch)

        # The simulation: every delivery in turn, all or nothing, whatever its id did before.
        expected, touched = [], set()
        for poll, rows in enumerate(feed, poll_no - len(feed)):
            for pos, (number, wiki, ids) in enumerate(rows):
                wanted = [i for i in ids if i]
                good = all((wiki, i) in known for i in wanted)
                expected.append((poll, pos, number, "done" if good else "not_done"))
                if good:
                    touched |= {(wiki, subject(wiki, i)) for i in wanted}
        stored = {t for t in stored if t[:2] not in touched} | {t for t in current if t[:2] in touched}

        assert tuples(acked.select("poll_seq", "batch_pos", "batch_id", "status")) == sorted(expected, key=repr)
        live = store.current().select("wiki_id", "s", "p", "o").collect()
        assert len(live) == len(stored) and {tuple(r) for r in live} == stored
        if rng.random() < 0.5:
            store.compact(epoch)
            store.expire()
