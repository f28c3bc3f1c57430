"""Language-model scores by context-tree weighting.

A text is its tokens, ASCII letters in lower case, with a space after each and an
end mark for the last space. Each byte is eight binary decisions, and each decision
has a context tree over the ``DEPTH`` bytes before it. A node counts zeros and ones
in the training texts; its Krichevsky-Trofimov estimate is mixed half and half
with the product of its children's, from the deepest contexts up. The mixture's
posterior weight of stopping at a node, given all training data, then says how
much each depth counts for a prediction. A path ends at the deepest context that
training has seen. Contexts do not cross from one text to the next.

Everything that the trees need is how often each run of ``DEPTH + 1`` bytes occurs.
Tasks count runs and words over their own documents first, so an exchange carries
a key once per task and none is hot. Trees are weighed in groups that share their
last two bytes; above that are at most 256 contexts of 255 decisions, which the
driver holds. Documents are then dealt into chunks, the keys of each chunk are
joined with their values, and a chunk and its values meet in one task. No table
of words or contexts is broadcast.

Words are counted by a 64-bit hash. Defined results: null and empty texts consist
of the end mark. A null ``doc_id`` counts as empty in the hash that picks training
rows. Repeated rows train and are scored each. Without training rows every bit has
probability one half, and every word a count of zero. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbsync.llm.batches import slices
from ebbsync.llm.hashing import WordHashes
from ebbsync.session import work_dir, written

DEPTH = 5
CHUNK_BYTES = 24_000_000
_SLICE_BYTES = 1_000_000
#: Distinct keys that a task holds before it passes their counts on.
_HELD_KEYS = 2_500_000
_PENDING_KEYS = 1_000_000
END = b"\n"
_PAD = END * DEPTH
_TOKEN_BIT = np.uint64(1 << 63)
_PACKED_TEXTS = 1 << 16
_CONTEXT = np.uint64((1 << 8 * DEPTH) - 1)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps further up where it is exact to double precision."""
    shift = np.ones_like(x)
    for i in range(8):
        shift = shift * (x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * log(2 * pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives a sequence of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - log(pi)


def normalized(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + END


class Coder:
    """The keys of texts: byte runs (from 0 up) and word hashes (below 0)."""

    def __init__(self):
        self.hashes = WordHashes()
        self.end = self.hashes[END]

    def runs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Every byte with the bytes before it, nearest first, as one integer; and each text's number of bytes."""
        clean = [normalized(t) for t in texts]
        sizes = np.array([len(t) for t in clean], dtype=np.int64)
        data = b"".join(_PAD + t for t in clean)
        n = len(data) - DEPTH
        # Eight bytes from every byte on, the first of them lowest: the context, then the symbol.
        eight = np.ndarray((n,), dtype="<u8", buffer=data + b"\0\0", strides=(1,))
        keys = ((eight & _CONTEXT) << np.uint64(8)) | ((eight >> np.uint64(8 * DEPTH)) & np.uint64(255))
        real = np.ones(len(keys), dtype=bool)
        starts = np.cumsum(sizes + DEPTH)[:-1] - DEPTH
        real[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
        return keys[real].view(np.int64), sizes

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every token, end mark included, and each text's number of tokens."""
        hashed = []
        for text in texts:
            words = text.lower().split()
            words.append(END)
            hashed.append(self.hashes.of(words))
        sizes = np.array([len(h) for h in hashed], dtype=np.int64)
        return (np.concatenate(hashed) | _TOKEN_BIT).view(np.int64), sizes


class Tally:
    """Counts by key: sorted arrays, and some more that are merged in when they add up."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        found, times = np.unique(keys, return_counts=True)
        self.pending.append((found, times if counted else np.zeros(len(found), np.int64)))
        self.waiting += len(found)
        if self.waiting > _PENDING_KEYS:
            self.merge()

    def merge(self) -> int:
        """Merge what is pending; the number of distinct keys."""
        keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
        counts = np.concatenate([self.counts, *(c for _, c in self.pending)])
        self.pending, self.waiting = [], 0
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.keys, self.counts = keys[starts], np.add.reduceat(counts[order], starts)
        return len(self.keys)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder, tally = Coder(), Tally()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(tally.keys), pa.array(tally.counts)], names=["key", "n"])

    for batch in batches:
        for part in slices(batch, "text", _SLICE_BYTES):
            texts, trains = part.column("text").to_pylist(), part.column("trains").to_pylist()
            for counted in (True, False):
                own = [t for t, train in zip(texts, trains, strict=True) if train == counted]
                if own:
                    tally.add(coder.runs(own)[0], counted)
                    tally.add(coder.words(own)[0], counted)
            if len(tally.keys) > _HELD_KEYS:
                yield flush()
                tally = Tally()
    if tally.merge():
        yield flush()


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct keys of each chunk."""
    coder, tallies = Coder(), {}
    for batch in batches:
        for part in slices(batch, "text", _SLICE_BYTES):
            chunks = np.array(part.column("chunk").to_pylist())
            texts = part.column("text").to_pylist()
            for chunk in np.unique(chunks).tolist():
                own = [texts[i] for i in np.flatnonzero(chunks == chunk)]
                tally = tallies.setdefault(chunk, Tally())
                tally.add(coder.runs(own)[0], False)
                tally.add(coder.words(own)[0], False)
                if len(tally.keys) > _HELD_KEYS:
                    yield _chunk_keys(chunk, tallies.pop(chunk))
    for chunk, tally in tallies.items():
        yield _chunk_keys(chunk, tally)


def _chunk_keys(chunk: int, tally: Tally) -> pa.RecordBatch:
    tally.merge()
    chunks = pa.array(np.full(len(tally.keys), chunk, np.int64))
    return pa.RecordBatch.from_arrays([chunks, pa.array(tally.keys)], names=["chunk", "key"])


def _decision(symbols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k``-th decision on each symbol: which one it is, given the decisions before, and how it goes."""
    return (1 << k) | (symbols >> (8 - k)), (symbols >> (7 - k)) & 1


def predicted(bit: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def mixed(deeper: np.ndarray, here: np.ndarray, stop: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """A node's prediction: its own, mixed with that of the deeper context if training has seen it."""
    both = np.where(np.isnan(deeper), here, stop * here + (1 - stop) * deeper)
    return np.where(seen, both, np.nan)


def weigh_group(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Predictions from depth two down for each byte run of a group, by decision, and the sums of its nodes there."""
    symbols, contexts = keys & 255, keys >> 8
    bits = np.empty((8, len(keys)))
    sums = []
    for k in range(8):
        which, bit = _decision(symbols, k)
        nodes, node_of = np.unique(contexts << 8 | which, return_inverse=True)
        ones = np.bincount(node_of, n * bit, len(nodes))
        zeros = np.bincount(node_of, n * (1 - bit), len(nodes))
        weight = log_kt(zeros, ones)
        seen = (zeros + ones)[node_of] > 0
        p = np.where(seen, predicted(bit, zeros[node_of], ones[node_of]), np.nan)
        for _ in range(DEPTH - 2):
            nodes, parent = np.unique((nodes >> 16) << 8 | nodes & 255, return_inverse=True)
            ones, zeros = np.bincount(parent, ones, len(nodes)), np.bincount(parent, zeros, len(nodes))
            own, below = log_kt(zeros, ones), np.bincount(parent, weight, len(nodes))
            weight = np.logaddexp(own, below) - log(2)
            stop = np.exp(own - log(2) - weight)
            node_of = parent[node_of]
            here = predicted(bit, zeros[node_of], ones[node_of])
            p = mixed(p, here, stop[node_of], (zeros + ones)[node_of] > 0)
        bits[k] = p
        last = (nodes >> 16 & 255).tolist()
        sums += zip(last, (nodes & 255).tolist(), zeros.tolist(), ones.tolist(), weight.tolist(), strict=True)
    return bits, sums


def _weigh(table: pa.Table) -> pa.Table:
    keys, n = table.column("key").to_numpy(), table.column("n").to_numpy().astype(np.float64)
    bits, sums = weigh_group(keys, n)
    nodes = [-(last << 8 | which) - 1 for last, which, *_ in sums]
    empty = [None] * len(sums)
    return pa.table(
        {
            "key": pa.array(keys.tolist() + nodes, pa.int64()),
            "bits": pa.array(list(bits.T) + empty, pa.list_(pa.float64())),
            "zeros": pa.array([None] * len(keys) + [s[2] for s in sums], pa.float64()),
            "ones": pa.array([None] * len(keys) + [s[3] for s in sums], pa.float64()),
            "weight": pa.array([None] * len(keys) + [s[4] for s in sums], pa.float64()),
        }
    )


class Upper:
    """The nodes above the groups: one context byte (``[1]``) and none (``[0]``), as fixed-size arrays."""

    def __init__(self, rows: list):
        zeros, ones, below = (np.zeros(65_536) for _ in range(3))
        for key, a, b, weight in rows:
            at = -key - 1
            zeros[at], ones[at], below[at] = a, b, weight
        self.zeros, self.ones, self.stop = [None, zeros], [None, ones], [None, None]
        own = log_kt(zeros, ones)
        weight = np.logaddexp(own, below) - log(2)
        self.stop[1] = np.exp(own - log(2) - weight)
        weight[zeros + ones == 0] = 0
        self.zeros[0], self.ones[0], below = (v.reshape(256, 256).sum(axis=0) for v in (zeros, ones, weight))
        own = log_kt(self.zeros[0], self.ones[0])
        self.stop[0] = np.exp(own - np.logaddexp(own, below))

    def log10_probability(self, keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
        symbols, last = keys & 255, keys >> 40 & 255
        total = np.zeros(len(keys))
        for k in range(8):
            which, bit = _decision(symbols, k)
            p = bits[:, k]
            for depth, at in ((1, last << 8 | which), (0, which)):
                zeros, ones = self.zeros[depth][at], self.ones[depth][at]
                p = mixed(p, predicted(bit, zeros, ones), self.stop[depth][at], zeros + ones > 0)
            total += np.log10(np.where(np.isnan(p), 0.5, p))
        return total


def _run_values(upper: Upper):
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False).reshape(len(keys), 8)
            scores = pa.array(upper.log10_probability(keys, bits))
            yield pa.RecordBatch.from_arrays([batch.column("key"), scores], names=["key", "value"])

    return values


def looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The values of sorted ``keys``, all of which the sorted table has."""
    return table[1][np.searchsorted(table[0], keys)]


def summed(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of the values of each text's byte runs.

    Keys leave 16 bits free, which hold the text's number while they are sorted:
    the table is then read in order, once per distinct key.
    """
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    packed = np.sort(keys.view(np.uint64) << np.uint64(16) | owner)
    ordered = (packed >> np.uint64(16)).view(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    values = np.repeat(looked_up(table, ordered[starts]), np.diff(np.append(starts, len(ordered))))
    return np.bincount((packed & np.uint64(0xFFFF)).astype(np.int64), values, len(sizes))


def _scorer(n_train: int, n_words: int):
    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        coder = Coder()
        order = np.argsort(values.column("key").to_numpy())
        table = values.column("key").to_numpy()[order], values.column("value").to_numpy()[order]
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        for part in slices(docs.combine_chunks(), "text", _SLICE_BYTES):
            texts = part.column("text").to_pylist()
            keys, sizes = coder.words(texts)
            words, which = np.unique(keys, return_inverse=True)
            counts = looked_up(table, words)[which]
            starts = np.cumsum(sizes) - sizes
            out["n_tokens"].append(sizes)
            out["n_known"].append(np.add.reduceat((counts > 0).astype(np.int64), starts))
            out["base_score"].append(np.add.reduceat(np.log10((counts + 1) / (n_train + n_words + 1)), starts))
            for at in range(0, len(texts), _PACKED_TEXTS):
                out["score"].append(summed(table, *coder.runs(texts[at : at + _PACKED_TEXTS])))
        columns = {name: pa.array(np.concatenate(parts)) for name, parts in out.items()}
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), **columns})

    return score


def score_documents(docs: DataFrame, hold_out_of: int = 7, hold_out: int = 2) -> DataFrame:
    """Per document the base columns and ``score``, the log10 probability of its text; learns from the other folds."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % hold_out_of
    texts = docs.select(
        "doc_id",
        (fold == hold_out).alias("held_out"),
        (fold != hold_out).alias("trains"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    partial = texts.select("trains", "text").mapInArrow(_count_batches, "key bigint, n bigint")
    counts = written(partial.groupBy("key").agg(F.sum("n").alias("n")), work_dir(spark, "counts"))
    words = counts.filter("key < 0")
    totals = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_train, n_words = totals["n"] or 0, totals["v"] or 0

    group = F.shiftright("key", 32)
    schema = "key bigint, bits array<double>, zeros double, ones double, weight double"
    weighed = counts.filter("key >= 0").groupBy(group.alias("group")).applyInArrow(_weigh, schema)
    weighed = written(weighed, work_dir(spark, "contexts"))
    nodes = weighed.filter("key < 0").groupBy("key").agg(F.sum("zeros"), F.sum("ones"), F.sum("weight"))
    upper = Upper([tuple(row) for row in nodes.collect()])
    runs = weighed.filter("key >= 0").select("key", "bits").mapInArrow(_run_values(upper), "key bigint, value double")
    values = runs.unionByName(words.select("key", F.col("n").cast("double").alias("value")))

    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = max(1, -(-size // CHUNK_BYTES))
    # The input split takes part, so that rows equal in everything do not fall into one chunk.
    chunk = F.pmod(F.xxhash64("doc_id", F.spark_partition_id(), F.length("text")), F.lit(n_chunks)).cast("bigint")
    dealt = texts.select("doc_id", "held_out", "text", chunk.alias("chunk")).repartition("chunk")
    # All columns, as below, so that both uses read one exchange.
    wanted = dealt.mapInArrow(_key_batches, "chunk bigint, key bigint")
    needed = wanted.join(values, "key").select("chunk", "key", "value")
    doc_id = texts.schema["doc_id"].dataType.simpleString()
    scored = (
        dealt.groupBy("chunk")
        .cogroup(needed.groupBy("chunk"))
        .applyInArrow(
            _scorer(n_train, n_words),
            f"doc_id {doc_id}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(n_train).cast("bigint"))
