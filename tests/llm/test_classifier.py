"""Buckets, context sums and pooling beside plain loops."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ebbsync.llm import classifier
from ebbsync.llm.classifier import BUCKETS, DIM

TEXTS = [b"", b"  ", b"The THE the, the", b"a\x0bB AB\tAB. 4,2\n\xc3\x89t\xc3\xa9 \xff!", b"x", b"\x1c \x00A"]


def plain_buckets(text):
    ids = []
    for word in re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+", text):
        ids.append(1 + xxhash.xxh3_64_intdigest(word.lower()) % (BUCKETS - 1))
        ids += [0] if len(word) > 1 and word.isupper() else []
    return ids


def plain_sums(texts):
    index, sums = classifier.index_vectors(), np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    for ids in map(plain_buckets, texts):
        for at, own in enumerate(ids):
            sums[own, DIM] += 1
            for near in ids[max(at - 2, 0) : at] + ids[at + 1 : at + 3]:
                sums[own, :DIM] += index[near]
    return sums


def draw_texts(n):
    draw = random.Random(n)
    return [b" ".join(draw.choices(TEXTS, k=draw.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize(("texts", "most"), [(TEXTS, 8_000), (draw_texts(200), 3), ([b"of the " * 9_000, b"of"], 8_000)])
def test_context_sums_of_packed_vectors(monkeypatch, texts, most):
    monkeypatch.setattr(classifier, "_MOST", most)
    ids, sizes = classifier.Buckets().of(pa.array(texts, pa.binary()))
    assert ids.tolist() == [own for text in texts for own in plain_buckets(text)]
    assert sizes.tolist() == [len(plain_buckets(text)) for text in texts]
    sums = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    classifier._context_sums(classifier.packed_index(), ids, sizes, sums)
    assert (sums == plain_sums(texts)).all()


def test_a_piece_is_looked_up_once_for_a_slice(monkeypatch):
    asked = []
    monkeypatch.setattr(classifier.Buckets, "__getitem__", lambda self, p: asked.append(p) or self.__missing__(p))
    classifier.Buckets().of(pa.array([b"the cat, the", b"the dog"], pa.binary()))
    assert sorted(asked) == [b"cat,", b"dog", b"the"]


def test_pooling_by_table():
    random_ = np.random.default_rng(1)
    vectors = random_.normal(size=(BUCKETS, DIM)).astype(np.float32)
    weights = random_.random(BUCKETS).astype(np.float32)
    texts = draw_texts(50)
    pooled = classifier.pool(
        classifier.pooling_table(vectors, weights), *classifier.Buckets().of(pa.array(texts, pa.binary()))
    )
    for row, ids in zip(pooled, map(plain_buckets, texts), strict=True):
        own, weight = vectors[ids].astype(float), weights[ids].astype(float)
        mean = np.average(own, axis=0, weights=weight) if ids else np.zeros(DIM)
        square = np.average(own * own, axis=0, weights=weight) if ids else np.zeros(DIM)
        assert np.allclose(row[:DIM], mean, atol=1e-5)
        assert np.allclose(row[DIM:] ** 2, square - mean * mean, atol=1e-5)
