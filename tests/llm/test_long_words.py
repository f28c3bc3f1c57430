"""Token counts of texts without spaces: right, and in time that grows with their length."""

from __future__ import annotations

import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbsync.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    return token_counts.merge_table(PATH)


@given(text=st.text(st.sampled_from("aabetns=-./01ſé語🎉\n"), min_size=1, max_size=80))
@settings(max_examples=300, deadline=None)
def test_the_index_gives_what_the_rounds_give(table, text):
    pre_token = token_counts.SPACE + text
    expected = len(LIBRARY.encode(text))
    assert token_counts.count_long(table, pre_token) == expected
    assert token_counts.count_symbols(table, [pre_token]).tolist() == [expected]


@pytest.mark.parametrize("letters", ["ab", "the", "0123456789", "etaoinshrdlu", "é語🎉", "ABCDabcd0123+/"])
def test_a_million_characters(table, letters):
    rng = random.Random(3)
    short, long = ("".join(rng.choices(letters, k=n)) for n in (100_000, 1_000_000))
    counter = token_counts.TokenCounter(table)
    counter.count(["x" * token_counts.LONG])
    assert counter.count([short, long, "x" * 300]) == [len(LIBRARY.encode(text)) for text in (short, long, "x" * 300)]


def test_time_grows_with_the_length(table):
    text = "".join(random.Random(4).choices("etaoinshrdlu", k=800_000))
    counter = token_counts.TokenCounter(table)
    counter.count(["x" * token_counts.LONG])
    seconds = []
    for n in (100_000, 800_000):
        start = time.process_time()
        counter.count([text[:n]])
        seconds.append(time.process_time() - start)
    # Eight times the length; a quadratic count would take 64 times as long.
    assert seconds[1] < 24 * max(seconds[0], 0.05)
