"""Fingerprints, their neighbors and edits against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pytest

from conftest import SF_DIR
from ebbsync.llm import simhash
from ebbsync.llm.hashing import WordHashes, run_hashes
from ebbsync.llm.queries import QUERIES


def plain_fingerprint(text):
    """Votes of every term, one by one."""
    terms = Counter(run_hashes(WordHashes().of((text or "").encode().split()), simhash.TERM_WORDS).tolist())
    votes = [0] * 64
    for term, times in terms.items():
        weight = round(16 * math.log2(1 + times))
        for place in range(64):
            votes[place] += weight if term >> place & 1 else -weight
    return sum(1 << place for place in range(64) if votes[place] > 0)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def apart(a, b):
    return ((a ^ b) & simhash._ALL).bit_count()


def check_edits(rows, ordered):
    """``ordered`` are the ids and texts as they follow each other."""
    prints = [plain_fingerprint(text) for _, text in ordered]
    expected = []
    for place, (doc_id, text) in enumerate(ordered):
        after = (place + 1) % len(ordered)
        text, follower = text or "", ordered[after][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        own = prints[place]
        expected.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{own:016x}",
            f"{plain_fingerprint(edited):016x}", 1 - apart(own, plain_fingerprint(edited)) / 64,
            1 - apart(own, prints[after]) / 64, sum(apart(own, other) <= simhash.RADIUS for other in prints) - 1,
        ))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_whole_table(spark):
    table = Path(SF_DIR) / "documents.parquet"
    ordered = duckdb.sql(f"SELECT doc_id, text FROM '{table}' ORDER BY doc_id DESC").fetchall()
    rows = QUERIES["op12_fingerprints"](spark, SF_DIR).collect()
    check_edits(rows, ordered)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (5, "a b c d e f"), (4, None), (3, ""), (2, "only"), (1, "é語🎉 " * 9), (0, "x" * 30_000), (-1, "long words " * 20_000),
        (None, "a b c d e f"),
    ]
    clash = [(*row, "own", "own", "own") for row in random.Random(1).sample(rows, len(rows))]
    docs = spark.createDataFrame(clash, "doc_id BIGINT, text STRING, piece STRING, side STRING, fingerprint STRING")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check_edits(QUERIES["op12_fingerprints"](spark, str(tmp_path)).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(7, "the only text there is")], [(1, "same text"), (1, "same text"), (1, "same text")]])
def test_few_rows(spark, rows):
    edited = simhash.edited_by_next(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert [(r.doc_id, r.fingerprint == r.next_fingerprint) for r in edited] == [(d, True) for d, _ in rows]


def values(seed, n, centers, flips):
    """``n`` fingerprints in clusters around ``centers`` values, some repeated."""
    rng = random.Random(seed)
    middles = [rng.getrandbits(64) for _ in range(centers)]
    made = []
    for _ in range(n):
        value = rng.choice(middles)
        for _ in range(rng.randrange(flips)):
            value ^= 1 << rng.randrange(64)
        made.append(value)
    return made + made[: n // 10]


@pytest.mark.parametrize("radius, held, batch", [(3, 4096, "10000"), (3, 20, "7"), (2, 5, "3"), (4, 30, "50")])
def test_all_within_the_radius_are_found(spark, conf, radius, held, batch):
    """Also with buckets over the limit, cut by batches, and dealt again."""
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=batch)
    made = values(radius, 400, 4, 2 * radius)
    df = spark.createDataFrame([(signed(v),) for v in made], "fingerprint BIGINT")
    times = Counter(map(signed, made))
    near = [(a, b) for a, b in combinations(sorted(times), 2) if apart(a, b) <= radius]
    assert len(near) > 500
    pairs = [tuple(r) for r in simhash.near_pairs(df, radius, held).collect()]
    assert sorted(pairs) == near
    counts = {v: n - 1 for v, n in times.items()}
    for a, b in near:
        counts[a] += times[b]
        counts[b] += times[a]
    assert {r.fingerprint: r.n_near for r in simhash.near_counts(df, radius, held).collect()} == counts


def test_tables_leave_no_pair_out():
    for radius in (1, 2, 3, 4):
        firsts, seconds = simhash._first_tables(radius), simhash._second_tables(radius)
        assert len(firsts) == math.comb(radius + 3, 3) and len(seconds) == len(firsts) ** 2
        rng = np.random.default_rng(radius)
        for _ in range(200):
            differing = sum(1 << int(place) for place in rng.choice(64, radius, replace=False))
            for tables in (firsts, seconds):
                met = [n for n, (mask, _) in tables.items() if not differing & mask]
                own = [n for n in met if all(differing & earlier for earlier in tables[n][1])]
                assert met and len(own) == 1


def test_a_bucket_of_the_second_dealing_is_bounded():
    assert all(64 - mask.bit_count() <= 18 for mask, _ in simhash._second_tables(simhash.RADIUS).values())
