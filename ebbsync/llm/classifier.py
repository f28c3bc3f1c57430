"""Quality classifier on random-indexing word vectors.

Words are hashed to ``BUCKETS`` rows. Each row has a fixed sparse random index
vector; a row's word vector is the sum of the index vectors of the words around
all its occurrences in the whole corpus. Sums are whole numbers, so they do not
depend on the order of tasks. A document is pooled to the mean and the spread of
its words' vectors, frequent words weighing less, and goes through a network of
two layers, written in numpy, whose probabilities are calibrated by a temperature
on rows that it was not fitted on.

What reaches the driver is bounded by parameters: ``BUCKETS * (DIM + 1)`` sums, and
the vectors of at most ``MAX_LABELLED`` labelled rows, those of least hash, which is
a documented bound on the sample that the network is fitted on. The vectors
themselves come from all documents.

Words are runs of letters and digits or runs of other characters, in lower case
for ASCII; a word in capitals is followed by a mark.

Defined results: a null or empty text pools to zeros and is scored as such. A
document with several labels takes the least. Without labels, or with one class
alone, every score is 0.5. A null ``doc_id`` has no label and counts as empty in
the hash. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbsync.llm.batches import distinct_words, slices, spread

BUCKETS = 32_768
DIM = 32
MAX_LABELLED = 20_000
PREDICT_FROM = 0.3
_NONZERO = 4
_REACH = 2
_BLOCK = 512
_SLICE_BYTES = 4_000_000
_CACHED_WORDS = 500_000
_MARK = 0
_COMMON = 1e-3
#: Places of 16 bits in a packed number, and words whose contexts add up in it: each has at most ``2 * _REACH`` in a place.
_LANES = 4
_MOST = 8_000
HIDDEN = 32
_FIND = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+").findall


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def index_vectors() -> np.ndarray:
    """A fixed row of ``_NONZERO`` ones of random place and sign for every bucket."""
    random = np.random.Generator(np.random.PCG64(20_011))
    table = np.zeros((BUCKETS, DIM), dtype=np.int16)
    places = random.permuted(np.tile(np.arange(DIM), (BUCKETS, 1)), axis=1)[:, :_NONZERO]
    signs = random.choice(np.array([-1, 1], dtype=np.int16), size=places.shape)
    np.put_along_axis(table, places, signs, axis=1)
    return table


class Buckets(dict):
    """The buckets of what stands between white space, packed, and remembered for a bounded number of such pieces."""

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        codes = []
        for word in (piece,) if piece.isalnum() else _FIND(piece):
            codes.append(1 + xxhash.xxh3_64_intdigest(word.lower()) % (BUCKETS - 1))
            if len(word) > 1 and word.isupper():
                codes.append(_MARK)
        self[piece] = packed = array("H", codes).tobytes()
        return packed

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words of the texts, and how many words each text has."""
        pieces, codes, ends = distinct_words(texts)
        packed = list(map(self.__getitem__, pieces))
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 2
        ids, own = spread(np.frombuffer(b"".join(packed), dtype=np.uint16), sizes, codes)
        after = np.concatenate(([0], np.cumsum(own)))[ends]
        return ids, np.diff(after, prepend=0)


def packed_index() -> np.ndarray:
    """The index vectors with ``_LANES`` places of 16 bits in each whole number, one row of numbers after the other;
    behind them a bucket of zeros."""
    index = np.vstack([index_vectors(), np.zeros((1, DIM), dtype=np.int16)]).astype(np.int64)
    return sum(index[:, lane::_LANES].T << (16 * lane) for lane in range(_LANES)).copy()


def _context_sums(packed: np.ndarray, ids: np.ndarray, sizes: np.ndarray, sums: np.ndarray) -> None:
    """Add the index vectors around every word to its row of ``sums``; the last column counts the words.

    ``packed`` are those of ``packed_index``: sums of numbers add all their places at once, and since no place leaves
    16 bits within ``_MOST`` words, they can be told apart again.
    """
    # Between texts stand as many zeros as a word reaches.
    at = np.arange(len(ids)) + _REACH * np.repeat(np.arange(len(sizes)), sizes)
    apart = np.full(len(ids) + _REACH * len(sizes), BUCKETS, dtype=np.intp)
    apart[at] = ids
    order = np.argsort(ids, kind="stable")
    ordered, at = ids[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(first, append=len(ids))
    # Pieces of a bucket's words that are few enough, and the first piece of every bucket.
    n_pieces = -(-counts // _MOST)
    piece = np.cumsum(n_pieces) - n_pieces
    starts = np.repeat(first - _MOST * piece, n_pieces) + _MOST * np.arange(n_pieces.sum())
    rows = ordered[first].astype(np.intp)
    sums[rows, DIM] += counts
    for row, numbers in enumerate(packed):
        own = numbers[apart]
        around = np.zeros(len(apart), dtype=np.int64)
        for step in range(1, _REACH + 1):
            around[:-step] += own[step:]
            around[step:] += own[:-step]
        rest = np.add.reduceat(around[at], starts)
        for lane in range(_LANES):
            place = (rest & 0xFFFF).astype(np.uint16).view(np.int16).astype(np.int64)
            rest = (rest - place) >> 16
            sums[rows, row * _LANES + lane] += np.add.reduceat(place, piece)


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed, buckets = packed_index(), Buckets()
    sums = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text", _SLICE_BYTES):
            ids, sizes = buckets.of(part.column("text"))
            if len(ids):
                _context_sums(packed, ids, sizes, sums)
    if sums[:, DIM].any():
        yield _blocks({n: sums[n * _BLOCK : (n + 1) * _BLOCK] for n in range(BUCKETS // _BLOCK)})


def _blocks(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    packed = [block.astype("<i8").tobytes() for block in blocks.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(blocks), pa.int32()), pa.array(packed, pa.binary())], names=["block", "sums"]
    )


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column("block"), batch.column("sums"), strict=True):
            sums = np.frombuffer(packed.as_py(), "<i8").reshape(_BLOCK, DIM + 1)
            total[block.as_py()] = sums + total.get(block.as_py(), 0)
    if total:
        yield _blocks(total)


def word_vectors(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The unit word vector and the pooling weight of every bucket, from all ``texts`` (column ``text``, binary).

    Partial sums are blocks of rows; a task adds up one block after the other as
    they come and holds one sum per block.
    """
    schema = "block int, sums binary"
    partial = texts.select("text").mapInArrow(_sum_batches, schema)
    blocks = partial.repartition(BUCKETS // _BLOCK, "block").mapInArrow(_add_blocks, schema).collect()
    sums = np.zeros((BUCKETS, DIM + 1))
    for block, packed in blocks:
        sums[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(packed, "<i8").reshape(_BLOCK, DIM + 1)
    counts = sums[:, DIM]
    vectors = sums[:, :DIM] / np.maximum(np.linalg.norm(sums[:, :DIM], axis=1, keepdims=True), 1e-9)
    weights = _COMMON / (_COMMON + counts / max(counts.sum(), 1))
    return vectors.astype(np.float32), weights.astype(np.float32)


def pooling_table(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What a word of each bucket adds to a text's sums: its weight, its weighted vector, and the squares of that."""
    weight = weights[:, None]
    return np.hstack([weight, vectors * weight, vectors * vectors * weight]).T.astype(np.float64, order="C")


def pool(table: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of the word vectors of each text; zeros for a text without words."""
    pooled = np.zeros((len(sizes), 2 * DIM))
    some = np.flatnonzero(sizes)
    if len(some) == 0:
        return pooled
    starts = (np.cumsum(sizes) - sizes)[some]
    ids, own = ids.astype(np.intp), np.empty(len(ids))
    sums = np.empty((len(table), len(some)))
    for row, adds in enumerate(table):
        np.add.reduceat(np.take(adds, ids, out=own, mode="clip"), starts, out=sums[row])
    mean, square = np.split((sums[1:] / sums[0]).T, 2, axis=1)
    pooled[some] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0))])
    return pooled


@dataclass(frozen=True)
class Network:
    """Two layers over standardized inputs; ``temperature`` divides the logit."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum((pooled - self.center) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -40, 40)))


def train(pooled: np.ndarray, labels: np.ndarray, epochs: int = 60, rate: float = 3e-3) -> Network:
    """Fit by Adam on shuffled batches, in an order fixed by a seed."""
    random = np.random.Generator(np.random.PCG64(7))
    center, scale = pooled.mean(axis=0), pooled.std(axis=0) + 1e-6
    x = (pooled - center) / scale
    shape = [(2 * DIM, HIDDEN), (HIDDEN,), (HIDDEN,), (1,)]
    weights = [
        random.normal(0, (2 / (2 * DIM)) ** 0.5, shape[0]),
        np.zeros(shape[1]),
        random.normal(0, (1 / HIDDEN) ** 0.5, shape[2]),
        np.zeros(shape[3]),
    ]
    first, second = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            hidden = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            logit = hidden @ weights[2] + weights[3][0]
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (hidden > 0)
            slopes = [x[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                mean, spread = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                weights[i] = weights[i] - rate * mean / (np.sqrt(spread) + 1e-8)
    return Network(center, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def calibrate(network: Network, pooled: np.ndarray, labels: np.ndarray) -> Network:
    """The temperature of least log loss on rows that the network was not fitted on."""
    logits = network.logits(pooled)
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    signed = np.where(labels == 1, logits, -logits)
    losses = [np.logaddexp(0, -signed / t).mean() for t in choices]
    return Network(**{**vars(network), "temperature": float(choices[int(np.argmin(losses))])})


def _pooler(vectors: np.ndarray, weights: np.ndarray):
    def vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, buckets = pooling_table(vectors, weights), Buckets()
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                pooled = pool(table, *buckets.of(part.column("text")))
                columns = [part.column("quality"), part.column("calibrates"), pa.array(list(pooled), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["quality", "calibrates", "pooled"])

    return vectors_of


def _scorer(vectors: np.ndarray, weights: np.ndarray, network: Network | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, buckets = pooling_table(vectors, weights), Buckets()
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                if network is None:
                    scores = np.full(part.num_rows, 0.5)
                else:
                    scores = network.probability(pool(table, *buckets.of(part.column("text"))))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    return score


def labelled_sample(labels: DataFrame, hold_out: int) -> DataFrame:
    """``doc_id`` and ``quality`` of at most ``MAX_LABELLED`` rows outside the held-out fold, those of least hash."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(fold(F.col("doc_id"), hold_out) != 0)
    one_each = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, weights: np.ndarray, hold_out: int) -> Network | None:
    sample = labelled_sample(labels, hold_out).withColumnRenamed("doc_id", "labelled_id")
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id")).dropDuplicates(["labelled_id"])
    rows = rows.select(
        F.col("quality").cast("int").alias("quality"), (fold(F.col("doc_id"), hold_out) == 1).alias("calibrates"), "text"
    )
    got = rows.mapInArrow(_pooler(vectors, weights), "quality int, calibrates boolean, pooled array<double>").collect()
    got.sort()
    if len({row["quality"] for row in got}) < 2:
        return None
    pooled, quality = np.array([row["pooled"] for row in got]), np.array([row["quality"] for row in got])
    apart = np.array([row["calibrates"] for row in got])
    if len(set(quality[~apart])) < 2 or not apart.any():
        return train(pooled, quality)
    return calibrate(train(pooled[~apart], quality[~apart]), pooled[apart], quality[apart])


def score_quality(docs: DataFrame, labels: DataFrame, hold_out: int = 5) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted``; fits on the labels outside the held-out fold."""
    texts = docs.select(
        "doc_id",
        (fold(F.col("doc_id"), hold_out) == 0).alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    vectors, weights = word_vectors(texts)
    network = fit(texts.select("doc_id", "text"), labels, vectors, weights, hold_out)
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    scored = texts.mapInArrow(_scorer(vectors, weights, network), schema)
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
