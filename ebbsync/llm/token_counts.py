"""Token counts by rank-synchronous merging.

A batch's new pre-tokens are held as one ragged array of symbols. In every round
each of them finds the pair of neighbors of lowest rank it has and merges it, all
at the same time; those without such a pair are done, and their surviving symbols
are counted. A pre-token is a run of spaces and the characters after it; no piece
of the vocabulary spans two, so their counts add up. Counts are remembered for a
bounded number of pre-tokens.

A long pre-token, as a text without spaces is, would take a round over all of it for
every rank it has. It has an index instead, from a rank to the places of its pairs: a
round takes the lowest rank's places, merges them from the left, and ranks only the
pairs that this makes. So it costs its merges and not its length times its ranks.

Where a merged symbol could form a pair of lower rank than its own, merging the
further occurrences at once would jump the queue; then only the first is merged.
Characters that are no piece count as their bytes.

Defined results: null and empty texts have no bytes and no tokens. Repeated rows
are counted alike. Special strings inside a text are ordinary text, as in the
library. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN_LIMIT = 4096
SPACE = "▁"
_CACHED = 500_000
#: Characters of text whose pre-tokens are held at once.
_SLICE_CHARS = 2_000_000
#: Characters from which a pre-token has an index of its own.
LONG = 256
_NO_RANK = np.int32(2**31 - 1)
_PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}]*").findall


@dataclass(frozen=True)
class MergeTable:
    """Symbols and mergeable pairs of a vocabulary. ``pairs`` is sorted: left symbol, then right."""

    chars: np.ndarray
    char_ids: np.ndarray
    is_piece: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    one_at_a_time: np.ndarray

    @cached_property
    def by_pair(self) -> dict[int, tuple[int, int]]:
        """Rank and merged symbol of each pair."""
        return dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.merged.tolist()), strict=True))


def merge_table(model_path: str) -> MergeTable:
    """The merge table of a sentencepiece BPE model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rank = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rank[model.id_to_piece(i)] = int(-model.get_score(i))
    if any(SPACE in piece.lstrip(SPACE) for piece in rank):
        raise ValueError("a piece spans a space; its texts do not split into pre-tokens")
    symbols = {piece: n for n, piece in enumerate(rank)}
    for piece in rank:
        for char in piece:
            symbols.setdefault(char, len(symbols))
    rows = []
    for piece, order in rank.items():
        for cut in range(1, len(piece)):
            left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
            if left is not None and right is not None:
                rows.append((left << 32 | right, order, symbols[piece]))
    rows.sort()
    pairs = np.array([r[0] for r in rows], dtype=np.int64)
    ranks = np.array([r[1] for r in rows], dtype=np.int32)
    merged = np.array([r[2] for r in rows], dtype=np.int32)
    own = np.full(len(symbols), -1, dtype=np.int64)
    own[: len(rank)] = list(rank.values())
    best = np.full(len(symbols), _NO_RANK, dtype=np.int64)
    np.minimum.at(best, pairs >> 32, ranks)
    np.minimum.at(best, pairs & 0xFFFFFFFF, ranks)
    singles = sorted((ord(s), n) for s, n in symbols.items() if len(s) == 1)
    return MergeTable(
        np.array([c for c, _ in singles], dtype=np.uint32),
        np.array([n for _, n in singles], dtype=np.int32),
        np.arange(len(symbols)) < len(rank),
        pairs,
        ranks,
        merged,
        best < own,
    )


def _symbols(table: MergeTable, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each character, and as how many tokens it counts while it is not merged."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    place = np.minimum(np.searchsorted(table.chars, codes), len(table.chars) - 1)
    known = table.chars[place] == codes
    symbol = np.where(known, table.char_ids[place], -1).astype(np.int64)
    n_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    return symbol, np.where(known & table.is_piece[symbol], 1, n_bytes).astype(np.int64)


def count_long(table: MergeTable, pre_token: str) -> int:
    """How many tokens one long pre-token has."""
    symbols, weights = _symbols(table, pre_token)
    first_ranks, _ = _ranks(table, symbols, np.zeros(len(symbols), dtype=np.int64))
    # The index of the first round, by one stable sort: places of a rank are in order.
    order = np.argsort(first_ranks, kind="stable")
    order = order[first_ranks[order] != _NO_RANK]
    ranks, starts = np.unique(first_ranks[order], return_index=True)
    places = {rank: part.tolist() for rank, part in zip(ranks.tolist(), np.split(order, starts[1:]))}
    waiting = list(places)
    heapify(waiting)
    symbol, weight, by_pair = symbols.tolist(), weights.tolist(), table.by_pair
    n = len(symbol)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    while waiting:
        rank = heappop(waiting)
        todo = sorted(places.pop(rank))
        for done, at in enumerate(todo):
            after = right[at]
            if weight[at] == 0 or after == n or symbol[at] < 0 or symbol[after] < 0:
                continue
            found = by_pair.get(symbol[at] << 32 | symbol[after])
            if found is None or found[0] != rank:
                continue
            symbol[at], weight[at], weight[after] = found[1], 1, 0
            right[at] = right[after]
            if right[at] < n:
                left[right[at]] = at
            lower = False
            for one, two in ((left[at], at), (at, right[at])):
                if one < 0 or two == n or symbol[one] < 0 or symbol[two] < 0:
                    continue
                made = by_pair.get(symbol[one] << 32 | symbol[two])
                if made is not None:
                    if made[0] not in places:
                        places[made[0]] = []
                        heappush(waiting, made[0])
                    places[made[0]].append(one)
                    lower |= made[0] < rank
            if lower and done + 1 < len(todo):
                # What was made goes first; the rest of the round waits its turn.
                if rank not in places:
                    places[rank] = []
                    heappush(waiting, rank)
                places[rank] += todo[done + 1 :]
                break
    return sum(weight)


def count_symbols(table: MergeTable, pre_tokens: list[str]) -> np.ndarray:
    """How many tokens each non-empty pre-token has."""
    lengths = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=len(pre_tokens))
    symbol, weight = _symbols(table, "".join(pre_tokens))
    owner = np.repeat(np.arange(len(pre_tokens)), lengths)
    counts = np.zeros(len(pre_tokens), dtype=np.int64)
    while len(symbol):
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        rank, at = _ranks(table, symbol, owner)
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbol)))
        done = np.repeat(lowest == _NO_RANK, sizes)
        np.add.at(counts, owner[done], weight[done])
        chosen = _disjoint((rank == np.repeat(lowest, sizes)) & ~done, table.one_at_a_time[table.merged[at]], owner)
        symbol[chosen] = table.merged[at[chosen]]
        weight[chosen] = 1
        live = ~done
        live[chosen + 1] = False
        symbol, weight, owner = symbol[live], weight[live], owner[live]
    return counts


def _ranks(table: MergeTable, symbol: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of every symbol's pair with its right neighbor, and the pair's place in the table."""
    rank = np.full(len(symbol), _NO_RANK, dtype=np.int32)
    at = np.zeros(len(symbol), dtype=np.int64)
    together = np.flatnonzero((owner[1:] == owner[:-1]) & (symbol[1:] >= 0) & (symbol[:-1] >= 0))
    key = symbol[together] << 32 | symbol[together + 1]
    place = np.minimum(np.searchsorted(table.pairs, key), len(table.pairs) - 1)
    hit = table.pairs[place] == key
    at[together[hit]] = place[hit]
    rank[together[hit]] = table.ranks[place[hit]]
    return rank, at


def _disjoint(wanted: np.ndarray, first_only: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of the wanted pairs those that are merged now: from the left, none overlapping another."""
    places = np.flatnonzero(wanted)
    if len(places) == 0:
        return places
    new_run = np.concatenate(([True], (np.diff(places) != 1)))
    run_start = places[np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))]
    keep = (places - run_start) % 2 == 0
    new_owner = np.concatenate(([True], owner[places[1:]] != owner[places[:-1]]))
    return places[keep & (new_owner | ~first_only[places])]


class TokenCounter(dict):
    """The token count of each pre-token seen, remembered up to a bounded number."""

    def __init__(self, table: MergeTable):
        super().__init__()
        self.table = table

    def count(self, texts: list[str]) -> list[int]:
        split = [_PRE_TOKEN(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        new = list(set().union(*split).difference(self))
        if len(self) + len(new) > _CACHED:
            self.clear()
            new = list(set().union(*split))
        short = [pre_token for pre_token in new if len(pre_token) < LONG]
        if short:
            self.update(zip(short, count_symbols(self.table, short).tolist(), strict=True))
        self.update((pre_token, count_long(self.table, pre_token)) for pre_token in new if len(pre_token) >= LONG)
        return [sum(map(self.__getitem__, pre_tokens)) for pre_tokens in split]


def _counter(table: MergeTable):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(table)
        for batch in batches:
            counts, waiting, chars = [], [], 0
            for text in batch.column("text"):
                waiting.append(text.as_py())
                chars += len(waiting[-1])
                if chars >= _SLICE_CHARS:
                    counts += counter.count(waiting)
                    waiting, chars = [], 0
            counts += counter.count(waiting)
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    counted = rows.mapInArrow(_counter(merge_table(model_path)), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
