"""Word ids as a worker remembers them, beside the library's on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from ebbsync.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "b", "É", "é", "é", "ß", "İ", "Σ", " ", "　", " ", "'", "'s", "'LL", "<|", "<|endoftext|>", "1",
    "42", ".", ",", "!", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "한", "中", "😀", "Zz", "ﬁ", "½",
]


def encoded(words, texts):
    return [ids.tolist() for ids in words.encode([t.encode() for t in texts])]


@pytest.mark.parametrize("remembered", [4, 600_000])
def test_ids_are_the_librarys_whatever_is_remembered(monkeypatch, remembered):
    monkeypatch.setattr(token_store, "_CACHED_WORDS", remembered)
    draw = random.Random(3)
    texts = ["", " ", "a", "\n a, b. "] + ["".join(draw.choices(PIECES, k=draw.randint(0, 30))) for _ in range(2000)]
    words = token_store.WordIds(PATH)
    expected = [[*words.tokenizer.encode(t, add_special_tokens=False).ids, token_store.END_ID] for t in texts]
    assert [row for at in range(0, len(texts), 50) for row in encoded(words, texts[at : at + 50])] == expected


def test_the_tasks_of_a_worker_learn_a_word_once(monkeypatch):
    learned, ids = [], token_store.WordIds._ids
    monkeypatch.setattr(token_store.WordIds, "_ids", lambda self, word: learned.append(word) or ids(self, word))
    token_store.word_ids.cache_clear()
    first = encoded(token_store.word_ids(PATH), ["Alpha beta, alpha", "beta. alpha,"])
    assert first == encoded(token_store.word_ids(PATH), ["Alpha beta, alpha", "beta. alpha,"])
    assert sorted(learned) == [b",", b".", b"alpha", b"beta"]
    token_store.word_ids.cache_clear()
