"""Jobs done whole, on small tables made for it."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from ebbsync.llm import order_minhash
from ebbsync.llm.hashing import WordHashes, run_hashes
from ebbsync.llm.order_minhash import NearDuplicates, similarity, sketch


def shingles(text):
    return run_hashes(WordHashes().of(text.encode().split()))


def classes(pairs, ids):
    """The least id of each one's class."""
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {d: root(d) for d in ids}


def found(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    return {r.doc_id: r.class_id for r in NearDuplicates(docs).members().collect()}


def edited(words, at, mark):
    return [f"{mark}{n}" if n in at else word for n, word in enumerate(words)]


@pytest.fixture(scope="module")
def hidden_pairs():
    """Pairs of similarity 0.8 among many texts that are half like each other, so that they share buckets with all."""
    draw = random.Random(5)
    base, texts = [f"w{n}" for n in range(95)], {}
    for n in range(0, 1400, 2):
        at = [6 * k for k in draw.sample(range(1, 15), 5)]
        one = edited(base, at[:3], f"a{n}x")
        texts[n], texts[n + 1] = " ".join(one), " ".join(edited(one, at[3:], f"b{n}x"))
    return texts


@pytest.mark.parametrize("block", [None, 20_000])
def test_no_similar_texts_of_a_bucket_end_apart(spark, hidden_pairs, monkeypatch, block):
    if block:
        monkeypatch.setattr(order_minhash, "BLOCK_SHINGLES", block)
    runs = {d: shingles(t) for d, t in hidden_pairs.items()}
    bands = {d: sketch(r) for d, r in runs.items()}
    pairs = [(d, d + 1) for d in range(0, len(runs), 2)]
    assert all(similarity(runs[a], runs[b]) >= 0.8 for a, b in pairs)
    assert all(similarity(runs[a], runs[b]) < 0.8 for a, b in combinations(range(0, 100, 2), 2))
    want = classes([(a, b) for a, b in pairs if (bands[a] == bands[b]).any()], runs)
    assert found(spark, hidden_pairs) == want


def test_short_copies_are_all_found(spark):
    """Of every length up to 50 shingles, a text and the longest that is similar, and two that are less."""
    texts, pairs = {}, []
    for n in range(4, 51):
        for kind, more in enumerate((max(n // 4, 1), n // 4 + 1)):
            words = [f"t{n}k{kind}w{i}" for i in range(n + 4)]
            one, two = 2 * len(texts), 2 * len(texts) + 1
            texts[one], texts[two] = " ".join(words), " ".join([*words, *(f"t{n}k{kind}m{i}" for i in range(more))])
            if 4 * more <= n:
                pairs.append((one, two))
    runs = {d: shingles(t) for d, t in texts.items()}
    assert all(similarity(runs[a], runs[b]) >= 0.8 for a, b in pairs)
    assert len(pairs) == 47
    assert found(spark, texts) == classes(pairs, texts)
