"""Token ids as binary segments, and back.

A token store is a folder of Parquet files whose rows are segments: whole
documents in ascending ``doc_id`` order, their lengths, and their ids as one
Simple-8b stream (``simple8b``) with an offset per block. A range shuffle on
``doc_id`` puts the documents in order; each task writes the segments of its range
through Spark's committer, so a lost executor leaves no half-written file and any
file system that Spark writes to will do. Segments say how many ids stand before
them in their range; the ranges' totals, one row each, make that absolute.

Words are encoded by the library and remembered, since with this vocabulary a
text's ids are those of its words: the pre-tokenizer drops white space, no token
spans it, and neither normalization nor added tokens reach across it. For the same
reason ASCII case and marks after a letter make no new word.

Defined results: a null or empty text has the end id alone. Rows are ordered by
``doc_id``, nulls first, then by a hash of the text and the text; repeated rows
are all written. An empty table gives an empty store. Extra columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.llm import simple8b
from ebbsync.llm.batches import distinct_words, slices, spread

END_ID = 1
_END = np.array([END_ID], dtype="<u4").tobytes()
#: Ids after which a segment is closed; a longer document is a segment of its own.
SEGMENT_IDS = 65_536
#: Words whose ids a Python worker remembers, looked at before every slice.
_CACHED_WORDS = 600_000
_SLICE_BYTES = 4_000_000
_MARKS = string.punctuation.encode()
#: The letter that stands for each byte in a byte-level vocabulary. Printable bytes
#: of Latin-1 stand for themselves, the others for the letters from 256 on, in order.
_PLAIN_BYTES = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHER_BYTES = sorted(set(range(256)) - _PLAIN_BYTES)
_BYTE_LETTERS = "".join(chr(b if b in _PLAIN_BYTES else 256 + _OTHER_BYTES.index(b)) for b in range(256))
#: Ranges up to which their totals are broadcast.
BROADCAST_ROWS = 200_000

SEGMENT_SCHEMA = (
    "shard int, segment int, ids_before bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"
)


class WordIds:
    """The ids of words as the tokenizers library gives them, remembered as packed integers.

    Words are kept in two generations: when the newer is full the older goes, but for words met since.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}

    def _ids(self, word: bytes) -> bytes:
        plain = word.isalpha() and word.islower()
        text = word.decode()
        if plain or (text.isalpha() and text == text.lower() and is_normalized("NFC", text)):
            # One pre-token that the normalizer leaves as it is: the model alone decides.
            letters = text if plain else charmap_decode(word, "strict", _BYTE_LETTERS)[0]
            return array("I", [token.id for token in self.pieces(letters)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, word: bytes) -> bytes:
        """The ids of a word, or of a part that has its own."""
        own = self.known.get(word)
        if own is None:
            own = self.former.get(word)
            self.known[word] = own = self._ids(word) if own is None else own
        return own

    def _learn(self, word: bytes) -> bytes:
        """The ids of a new word, the marks after a letter apart from their word."""
        stem = word.rstrip(_MARKS)
        if len(stem) in (0, len(word)) or b"'" in word or b"<|" in word or not _ends_in_letter(stem):
            return self._ids(word)
        return self._part(stem) + self._part(word[len(stem) :])

    def _of(self, words: list[bytes]) -> list[bytes]:
        known, former = self.known, self.former
        ids = list(map(known.get, words))
        for at in [at for at, own in enumerate(ids) if own is None]:
            word = words[at]
            own = former.get(word)
            ids[at] = known[word] = self._learn(word) if own is None else own
        return ids

    def encode(self, texts: list[bytes] | pa.Array) -> list[np.ndarray]:
        """The ids of each text and the end id. A word is looked up once for all its occurrences in ``texts``."""
        if len(self.known) > _CACHED_WORDS // 2:
            self.known, self.former = {}, self.known
        words, codes, ends = distinct_words(_lower(pa.array(texts, pa.binary()).cast(pa.string())))
        ids = self._of(words)
        ids.append(_END)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // len(_END)
        codes = np.insert(codes, ends, len(words))
        spread_ids, own = spread(np.frombuffer(b"".join(ids), dtype="<u4"), sizes, codes)
        after = np.cumsum(own)[ends + np.arange(len(ends))].tolist()
        return [spread_ids[start:end] for start, end in zip([0, *after], after, strict=False)]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One ``WordIds`` of a Python worker for all its tasks, so that each does not learn the same words anew."""
    return WordIds(path)


def _ends_in_letter(word: bytes) -> bool:
    return word[-1:].isalpha() or (word[-1] > 127 and word.decode()[-1].lower().isalpha())


def _lower(texts: pa.Array) -> pa.Array:
    """ASCII letters in lower case, as the normalizer makes them; the strings of added tokens stay what they are."""
    return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))


def _segment_writer(tokenizer_path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words = TaskContext.get().partitionId(), word_ids(tokenizer_path)
        segment, before = 0, 0
        doc_ids, pieces, waiting = [], [], 0

        def close() -> pa.RecordBatch:
            lengths = [len(p) for p in pieces]
            payload = simple8b.encode(np.concatenate(pieces))
            row = [[shard], [segment], [before], [doc_ids], [lengths], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["shard", "segment", "ids_before", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                encoded = words.encode(part.column("text"))
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    if pieces and waiting + len(ids) > SEGMENT_IDS:
                        yield close()
                        segment, before = segment + 1, before + waiting
                        doc_ids, pieces, waiting = [], [], 0
                    doc_ids.append(doc_id)
                    pieces.append(ids)
                    waiting += len(ids)
        if pieces:
            yield close()

    return write


def write_store(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``) as a token store at ``path``."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    segments = ordered.select("doc_id", "text").mapInArrow(_segment_writer(tokenizer_path), SEGMENT_SCHEMA)
    segments.write.parquet(path)


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lengths = np.array(batch.column("lengths")[row].as_py(), dtype=np.int64)
            ids = simple8b.decode(batch.column("payload")[row].as_py()).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids")[row].values,
                    pa.array(starts + batch.column("start")[row].as_py(), pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store with ``start``, the ids of all segments before."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    n_ids = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = segments.groupBy("shard").agg(F.sum(n_ids).alias("ids"))
    # One row per range: a running sum over the ranges, not over documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    bases = broadcast_if(bases, fits(totals, BROADCAST_ROWS))
    return segments.join(bases, "shard").withColumn("start", F.col("base") + F.col("ids_before"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of its ids."""
    segments = read_segments(spark, path).select("doc_ids", "lengths", "payload", "start")
    return segments.mapInArrow(_read_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
