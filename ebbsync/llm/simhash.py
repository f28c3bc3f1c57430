"""SimHash fingerprints, and all fingerprints within a Hamming radius of each other.

A term is a pair of neighboring words, or the only word of a text. Each different
term votes with the bits of its 64-bit hash, a one for and a zero against, weighted
by the logarithm of how often the text has it; the fingerprint has the bits with
more weight for than against. Weights are whole numbers, so votes add up exactly
and equal texts have equal fingerprints anywhere.

Fingerprints within ``radius`` bits differ in at most ``radius`` of ``radius + 3``
blocks, so they agree in three blocks at least. There is a table for every choice of
three, in which fingerprints meet that agree in its blocks; each task streams its
share of the tables in order, compares the rows of a bucket and counts or passes on
those within the radius, each pair in the first table where it meets only. Copies are
one fingerprint with a number. A bucket of over ``HELD`` fingerprints is not
compared but dealt again, by the same rule on the bits in which it may differ. For a
radius of 3 a bucket then holds at most 2**16 different fingerprints. Nothing is left
out: what meets in no bucket of the second dealing is farther apart than ``radius``.

Neighbors in the order of ids are found without a sort in one place: rows are
range-partitioned, each task looks one row ahead, and the two rows at the ends of a
partition go to a small table, with one row per partition and end.

Defined results: null texts are empty; a text without a word has the fingerprint 0.
Null ids come last. Rows that share an id follow each other by a hash of their text
and the text. A row alone is its own next row. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ebbsync.llm.batches import slices
from ebbsync.llm.hashing import WordHashes, run_hashes
from ebbsync.session import work_dir, written

BITS = 64
RADIUS = 3
TERM_WORDS = 2
#: Blocks beyond the radius, which two near fingerprints have in common at least.
KEY_BLOCKS = 3
#: Fingerprints of a bucket that are compared in the first dealing.
HELD = 4096
_WEIGHT_STEPS = 16
_SLICE_BYTES = 1_000_000
_TERMS_AT_ONCE = 65_536


def fingerprint(hashes: WordHashes, text: bytes) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit integer."""
    terms, times = np.unique(run_hashes(hashes.of(text.split()), TERM_WORDS), return_counts=True)
    weights = np.round(_WEIGHT_STEPS * np.log2(1 + times))
    votes = np.full(BITS, -weights.sum())
    for at in range(0, len(terms), _TERMS_AT_ONCE):
        some = slice(at, at + _TERMS_AT_ONCE)
        bits = np.unpackbits(terms[some].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += 2 * (weights[some] @ bits.astype(np.float64))
    return int(np.packbits(votes > 0).view(">i8")[0])


def likeness(a: Column, b: Column) -> Column:
    """The share of bits that two fingerprints have in common."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(BITS)


def as_text(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), BITS // 4, "0")


# ---- neighbors in the order of ids ----

_EDITED = "doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint bigint, edited_fingerprint bigint, next_fingerprint bigint"
_ENDS = ", piece int, side string, text string"


class _Edits:
    """Rows of ``_EDITED`` from texts and the texts that follow them."""

    def __init__(self, kind: pa.DataType):
        self.hashes = WordHashes()
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        self.plain = pa.schema(list(zip(names, types, strict=True)))
        ends = [("piece", pa.int32()), ("side", pa.string()), ("text", pa.string())]
        self.schema = pa.schema([*self.plain, *(pa.field(n, t) for n, t in ends)])

    def row(self, doc_id, text: str, own: int, next_text: str, next_own: int) -> dict:
        half = len(text) // 2
        edited = (text[: len(text) - half] + next_text[:half]).encode()
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited).hexdigest(),
            "fingerprint": own,
            "edited_fingerprint": fingerprint(self.hashes, edited),
            "next_fingerprint": next_own,
        }


def _edit_rows(kind: pa.DataType):
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, piece, last = _Edits(kind), TaskContext.get().partitionId(), None
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = fingerprint(edits.hashes, text.encode())
                    if last is None:
                        rows.append({"fingerprint": own, "piece": piece, "side": "first", "text": text})
                    else:
                        rows.append(edits.row(*last, text, own))
                    last = (doc_id, text, own)
                yield pa.RecordBatch.from_pylist(rows, schema=edits.schema)
        if last is not None:
            doc_id, text, own = last
            end = {"doc_id": doc_id, "fingerprint": own, "piece": piece, "side": "last", "text": text}
            yield pa.RecordBatch.from_pylist([end], schema=edits.schema)

    return edit


def _edit_ends(kind: pa.DataType):
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits = _Edits(kind)
        names = ("doc_id", "text", "fingerprint", "next_text", "next_own")
        for batch in batches:
            rows = [edits.row(*row) for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=edits.plain)

    return edit


def edited_by_next(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, the next one's, and that of its text with the next one's start in its last half.

    Next is the document with the next smaller ``doc_id``; after the last comes the first. Runs when called.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    down = F.col("doc_id").desc_nulls_last()
    ordered = rows.repartitionByRange(down, "tie").sortWithinPartitions(down, "tie", "text").select("doc_id", "text")
    field = rows.schema["doc_id"]
    kind = to_arrow_type(field.dataType)
    schema = _EDITED.format(kind=field.dataType.simpleString())
    done = written(ordered.mapInArrow(_edit_rows(kind), schema + _ENDS), work_dir(spark, "edited"))
    plain = [column.split()[0] for column in schema.split(", ")]
    first = done.filter("side = 'first'").select("piece", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_own"))
    # One row per partition of the range exchange.
    pieces = first.select("piece")
    after = F.lead("piece").over(Window.orderBy("piece"))
    start = F.min("piece").over(Window.partitionBy())
    follows = pieces.select(F.col("piece").alias("last_piece"), F.coalesce(after, start).alias("piece"))
    last = done.filter("side = 'last'").select("doc_id", "text", "fingerprint", F.col("piece").alias("last_piece"))
    ends = last.join(follows, "last_piece").join(first, "piece")
    ends = ends.select("doc_id", "text", "fingerprint", "next_text", "next_own").mapInArrow(_edit_ends(kind), schema)
    return done.filter("side IS NULL").select(*plain).unionByName(ends)


# ---- block tables ----


@dataclass(frozen=True)
class BlockTables:
    """The tables of a set of bits: for each choice of ``KEY_BLOCKS`` blocks the bits of these."""

    masks: tuple[int, ...]

    @classmethod
    def over(cls, bits: int, radius: int) -> "BlockTables":
        places = [place for place in range(BITS) if bits >> place & 1]
        n = radius + KEY_BLOCKS
        blocks = [sum(1 << place for place in places[i * len(places) // n : (i + 1) * len(places) // n]) for i in range(n)]
        return cls(tuple(sum(chosen) for chosen in combinations(blocks, KEY_BLOCKS)))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


_ALL = (1 << BITS) - 1


def _first_tables(radius: int) -> dict[int, tuple[int, tuple[int, ...]]]:
    """Per number of a table its bits, and those of the tables before it."""
    masks = BlockTables.over(_ALL, radius).masks
    return {n: (mask, masks[:n]) for n, mask in enumerate(masks)}


def _second_tables(radius: int) -> dict[int, tuple[int, tuple[int, ...]]]:
    """The tables that a bucket of each first table is dealt to again, numbered on from it."""
    tables = {}
    firsts = BlockTables.over(_ALL, radius).masks
    for n, first in enumerate(firsts):
        own = BlockTables.over(_ALL & ~first, radius).masks
        for m, mask in enumerate(own):
            tables[n * len(firsts) + m] = (first | mask, (*firsts[:n], *own[:m]))
    return tables


def _dealt(rows: DataFrame, numbers: Column) -> DataFrame:
    """Rows ``(table, masked, fingerprint, copies)`` of every table, each bucket in one task and in order."""
    dealt = rows.select("fingerprint", "copies", F.explode(numbers).alias("place")).select(
        F.col("place.number").alias("number"),
        F.col("fingerprint").bitwiseAND(F.col("place.mask")).alias("masked"),
        "fingerprint",
        "copies",
    )
    return dealt.repartition("number", "masked").sortWithinPartitions("number", "masked", "fingerprint")


def _places(tables: dict[int, tuple[int, tuple[int, ...]]], numbers: list[int]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("number"), F.lit(_signed(tables[n][0])).cast("bigint").alias("mask")) for n in numbers]
    )


def _near(fingerprints: np.ndarray, bucket: np.ndarray, number: np.ndarray, tables, radius: int):
    """Index pairs of one bucket within the radius that meet in no earlier table."""
    n = len(fingerprints)
    left = np.arange(n)
    for shift in range(1, n):
        left = left[left < n - shift]
        left = left[bucket[left] == bucket[left + shift]]
        if len(left) == 0:
            return
        apart = fingerprints[left] ^ fingerprints[left + shift]
        close = np.flatnonzero(np.bitwise_count(apart) <= radius)
        if len(close) == 0:
            continue
        found, apart = left[close], apart[close]
        first = np.ones(len(found), dtype=bool)
        for table in np.unique(number[found]):
            here = np.flatnonzero(number[found] == table)
            for mask in tables[int(table)][1]:
                first[here] &= (apart[here] & np.uint64(mask)) != 0
        yield found[first], found[first] + shift


_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("number", pa.int32())])


def _meet(tables, radius: int, held: int, pairs: bool):
    """Compares the buckets of ordered rows.

    Yields ``(a, b)`` for every pair, or ``(a, n)`` with the copies near ``a``; rows of buckets that are too large come
    as ``(a, n, number)`` with their own copies, to be dealt again.
    """

    def batch_of(a, b=None, n=None, number=None) -> pa.RecordBatch:
        def column(values, kind):
            return pa.nulls(len(a), kind) if values is None else pa.array(values, kind)

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        columns = [column(v, kind) for v, kind in zip((a, b, n, number), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_MET)

    def compare(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        number, masked, own, copies = rows
        new = np.concatenate(([True], (number[1:] != number[:-1]) | (masked[1:] != masked[:-1])))
        bucket = np.cumsum(new)
        size = np.bincount(bucket)[bucket]
        large = size > held
        if large.any():
            yield batch_of(own[large], n=copies[large], number=number[large])
        some = (size > 1) & ~large
        number, own, copies, bucket = number[some], own[some], copies[some], bucket[some]
        near = np.zeros(len(own), dtype=np.int64)
        for a, b in _near(own.view(np.uint64), bucket, number, tables, radius):
            if pairs:
                if len(a):
                    yield batch_of(own[a], own[b])
            else:
                np.add.at(near, a, copies[b])
                np.add.at(near, b, copies[a])
        if near.any():
            yield batch_of(own[near > 0], n=near[near > 0])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, passing = None, None
        for batch in batches:
            rows = [batch.column(name).to_numpy() for name in ("number", "masked", "fingerprint", "copies")]
            if waiting is not None:
                rows = [np.concatenate(both) for both in zip(waiting, rows, strict=True)]
            if len(rows[0]) == 0:
                continue
            if passing is not None:
                # The bucket that went over the limit in an earlier batch goes on.
                more = (rows[0] == passing[0]) & (rows[1] == passing[1])
                if more.any():
                    yield batch_of(rows[2][more], n=rows[3][more], number=rows[0][more])
                rows = [values[~more] for values in rows]
                if len(rows[0]) == 0:
                    waiting = None
                    continue
            # The last bucket may go on in the next batch.
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            waiting = [values[last] for values in rows]
            done = [values[~last] for values in rows]
            passing = None
            if last.sum() > held:
                passing = (waiting[0][0], waiting[1][0])
                yield batch_of(waiting[2], n=waiting[3], number=waiting[0])
                waiting = None
            if len(done[0]):
                yield from compare(done)
        if waiting is not None and len(waiting[0]):
            yield from compare(waiting)

    return meet


def _search(distinct: DataFrame, radius: int, held: int, pairs: bool) -> DataFrame:
    spark = distinct.sparkSession
    schema = "a bigint, b bigint, n bigint, number int"
    firsts, seconds = _first_tables(radius), _second_tables(radius)
    dealt = _dealt(distinct, _places(firsts, list(firsts)))
    met = written(dealt.mapInArrow(_meet(firsts, radius, held, pairs), schema), work_dir(spark, "met"))
    found = met.filter("number IS NULL")
    large = met.filter("number IS NOT NULL")
    again = large.select(F.col("a").alias("fingerprint"), F.col("n").alias("copies"), "number")
    per_first = len(firsts)
    places = reduce(
        lambda otherwise, n: F.when(
            F.col("number") == n, _places(seconds, [n * per_first + m for m in range(per_first)])
        ).otherwise(otherwise),
        range(per_first),
        F.lit(None),
    )
    if large.isEmpty():
        return found
    rest = _dealt(again, places).mapInArrow(_meet(seconds, radius, 1 << BITS, pairs), schema)
    return found.unionByName(rest)


def _distinct(fingerprints: DataFrame) -> DataFrame:
    return fingerprints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"))


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS, held: int = HELD) -> DataFrame:
    """Every pair ``(a, b)`` of different values of ``fingerprint`` within ``radius`` bits, once. Runs when called."""
    found = _search(_distinct(fingerprints), radius, held, pairs=True)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_counts(fingerprints: DataFrame, radius: int = RADIUS, held: int = HELD) -> DataFrame:
    """Per different ``fingerprint`` how many other rows are within ``radius`` bits, as ``n_near``. Runs when called."""
    distinct = written(_distinct(fingerprints), work_dir(fingerprints.sparkSession, "fingerprints"))
    found = _search(distinct, radius, held, pairs=False).select(F.col("a").alias("fingerprint"), "n")
    own = distinct.select("fingerprint", (F.col("copies") - 1).alias("n"))
    return found.unionByName(own).groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
