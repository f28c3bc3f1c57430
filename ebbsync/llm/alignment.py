"""Token ids of two tokenizers laid side by side over the same bytes.

A text's tokens are aligned where both tokenizers end one at the same byte offset.
Each list of cumulative ends becomes a dictionary from end to index; the common keys,
sorted, cut both lists of ids into groups, and every token of a group's one side is
linked with every token of its other. How many documents hold a pair of ids linked is
counted over the corpus, and each document's links are looked up in that.

Tokens of either kind never span the start of a run of white space that begins with
a space or a line break, nor a letter and a mark after it, so a text is aligned piece by piece and a task remembers the
pieces it has met, up to a bounded number. Its documents form chunks of bounded size;
a chunk's different pairs are numbered, and a document carries the numbers of its own.
Each chunk's pairs are counted before they are exchanged, the corpus's counts are
joined back to the chunks' pairs, and a chunk's documents meet its pairs' counts in
one task. The one table that is broadcast has a row per id of the first vocabulary.

Defined results: a text that is null or empty, or that a tokenizer does not give back
byte by byte, has no tokens: zeros, and an empty hash. Special tokens' strings are
ordinary text. Repeated rows count as documents each; ids may be null. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ebbsync.llm.batches import slices
from ebbsync.session import work_dir, written

CHUNK_BYTES = 16_000_000
_SLICE_BYTES = 500_000
_CACHED_PIECES = 400_000
#: Characters of one text that are aligned at once.
_SPAN_CHARS = 1_000_000
#: Characters of pieces that are encoded at once.
_BATCH_CHARS = 8_000
_LINKS_ONE_BY_ONE = 10_000
_SPACE_MARK = "▁"
_LINE = "\n"
#: Marks that a piece is cut before where they follow a letter, if the second vocabulary has none of them after one.
_MARKS = ".,;:!?*#$%&|<>()/"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_AFTER_LETTER = re.compile(f"[{_LETTER}][{_MARKS}]")
_PIECE = re.compile(
    rf"[ \n][{_LETTER}]+(?=[{_MARKS}])|[ \n]\s*\S*(?:(?![ \n])\s+\S*)*|[{_MARKS}]\S*(?:(?![ \n])\s+\S*)*"
)
_CUT = re.compile(r"(?<=\S)[ \n]")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by its rule: printable Latin-1 for itself."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + n): byte for n, byte in enumerate(others)}


class Misfit(Exception):
    """Tokens do not end where a piece does."""


@dataclass(frozen=True)
class Entries:
    """What each id of a vocabulary stands for: its bytes, how many they are, and the id as written."""

    raw: list[bytes]
    sizes: list[int]
    written: list[str]

    @classmethod
    def of(cls, raw: list[bytes]) -> "Entries":
        return cls(raw, list(map(len, raw)), list(map(str, range(len(raw)))))

    def gives(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.raw.__getitem__, ids)) == text

    def ends(self, ids: list[int]) -> dict[int, int]:
        """From the offset at which a token ends to its index."""
        return dict(zip(accumulate(map(self.sizes.__getitem__, ids)), range(len(ids))))

    def lists(self, ids: list[int], stops: list[int]) -> list[str]:
        """The ids between the stops, as written."""
        names, start = list(map(self.written.__getitem__, ids)), 0
        listed = []
        for stop in stops:
            listed.append(names[start] if stop - start == 1 else ",".join(names[start:stop]))
            start = stop
        return listed


class Tokenizers:
    """Ids of both tokenizers for pieces of a text that start with white space."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters, vocabulary = _byte_letters(), self.a.get_vocab(with_added_tokens=False)
        by_id = sorted((number, entry) for entry, number in vocabulary.items())
        a_raw = [b""] * (by_id[-1][0] + 1)
        for number, entry in by_id:
            a_raw[number] = bytes(map(letters.get, entry)) if all(c in letters for c in entry) else b""
        self.a_entries = Entries.of(a_raw)
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        merged = [piece for n, piece in enumerate(pieces) if not (self.b.is_byte(n) or self.b.is_control(n) or self.b.is_unknown(n))]
        if any(_LINE in p or _SPACE_MARK in p.lstrip(_SPACE_MARK) or _AFTER_LETTER.search(p) for p in merged):
            raise ValueError("a token spans the start of white space or marks; texts do not split into pieces")
        self.b_entries = Entries.of([
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(n) else piece.replace(_SPACE_MARK, " ").encode()
            for n, piece in enumerate(pieces)
        ])
        # What the second tokenizer puts before a text that follows a line break.
        self.before = len(self.b.encode(_LINE))

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of a text of one or more pieces."""
        return self.a.encode(text, add_special_tokens=False).ids, self.b.encode(_LINE + text)[self.before :]


@dataclass(frozen=True)
class Groups:
    """Two lists of ids cut where both end a token: the common ends, and where each group stops on either side."""

    ends: list[int]
    a_stops: list[int]
    b_stops: list[int]

    @classmethod
    def of(cls, a_ends: dict[int, int], b_ends: dict[int, int]) -> "Groups":
        common = sorted(a_ends.keys() & b_ends.keys())
        return cls(common, [a_ends[end] + 1 for end in common], [b_ends[end] + 1 for end in common])


def links(groups: Groups, a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per group how many links it has and how many rows of these follow; and the rows, ``a << 32 | b`` and times.

    A long group's links are rows of different ids with their number, others' one by one.
    """
    a_stops, b_stops = np.array(groups.a_stops), np.array(groups.b_stops)
    a_sizes, b_sizes = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
    n_links = a_sizes * b_sizes
    long = np.flatnonzero(n_links > _LINKS_ONE_BY_ONE)
    n_rows = n_links.copy()
    n_rows[long] = 0
    before = np.cumsum(n_rows) - n_rows
    place = np.arange(n_rows.sum()) - np.repeat(before, n_rows)
    width = np.repeat(b_sizes, n_rows)
    one = np.array(a, dtype=np.int64)[np.repeat(a_stops - a_sizes, n_rows) + place // width]
    two = np.array(b, dtype=np.int64)[np.repeat(b_stops - b_sizes, n_rows) + place % width]
    pairs, times = one << 32 | two, np.ones(len(one), dtype=np.int64)
    for group in long[::-1]:
        ours = Counter(a[a_stops[group] - a_sizes[group] : a_stops[group]])
        theirs = Counter(b[b_stops[group] - b_sizes[group] : b_stops[group]])
        both = list(product(ours.items(), theirs.items()))
        pairs = np.insert(pairs, before[group], [x << 32 | y for (x, _), (y, _) in both])
        times = np.insert(times, before[group], [n * m for (_, n), (_, m) in both])
        n_rows[group] = len(both)
    return n_links, n_rows, np.stack([pairs, times])


class Pieces:
    """What is known of the pieces met so far, each under a number.

    ``pairs`` and ``times`` are the rows of a piece's links, packed; ``sizes`` are four numbers a piece.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.sizes = array("q")
        self.written: list[bytes] = []
        self.pairs: list[bytes] = []
        self.times: list[bytes] = []
        self.broken: set[int] = set()

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces, many side by side where they are encoded as they would be each."""
        batch, chars = [], 0
        for piece in pieces:
            if piece[-1].isspace() or not piece[0].isspace() or len(piece) > _BATCH_CHARS:
                self._learn_batch([piece])
                continue
            batch.append(piece)
            chars += len(piece)
            if chars >= _BATCH_CHARS:
                self._learn_batch(batch)
                batch, chars = [], 0
        if batch:
            self._learn_batch(batch)

    def _learn_batch(self, pieces: list[str]) -> None:
        """Align pieces as one text; where one does not come back from its tokens, each goes alone."""
        try:
            self._align(pieces)
        except Misfit:
            if len(pieces) == 1:
                self.broken.add(len(self.written))
                self._add(pieces[0], (0, 0, 0, 0), "", b"", b"")
            else:
                for piece in pieces:
                    self._learn_batch([piece])

    def _align(self, pieces: list[str]) -> None:
        tok, text = self.tokenizers, "".join(pieces)
        a, b = tok.encode(text)
        raw = text.encode()
        if not (tok.a_entries.gives(a, raw) and tok.b_entries.gives(b, raw)):
            raise Misfit
        groups = Groups.of(tok.a_entries.ends(a), tok.b_entries.ends(b))
        places = {end: place for place, end in enumerate(groups.ends, 1)}
        piece_ends = accumulate(map(len, pieces if text.isascii() else [piece.encode() for piece in pieces]))
        try:
            stops = list(map(places.__getitem__, piece_ends))
        except KeyError:
            raise Misfit from None
        one, two = tok.a_entries.lists(a, groups.a_stops), tok.b_entries.lists(b, groups.b_stops)
        listed = list(map("{}|{}".format, one, two))
        n_links, n_rows, rows = links(groups, a, b)
        link_stops, row_stops = np.cumsum(n_links).tolist(), np.cumsum(n_rows).tolist()
        pairs, times = rows[0].tobytes(), rows[1].tobytes()
        first, a_from, b_from, link, row = 0, 0, 0, 0, 0
        for piece, stop in zip(pieces, stops, strict=True):
            last = stop - 1
            a_to, b_to, link_to, row_to = groups.a_stops[last], groups.b_stops[last], link_stops[last], row_stops[last]
            self._add(
                piece, (a_to - a_from, b_to - b_from, stop - first, link_to - link), ";".join(listed[first:stop]),
                pairs[8 * row : 8 * row_to], times[8 * row : 8 * row_to],
            )
            first, a_from, b_from, link, row = stop, a_to, b_to, link_to, row_to

    def _add(self, piece: str, sizes: tuple[int, int, int, int], text: str, pairs: bytes, times: bytes) -> None:
        self.numbers[piece] = len(self.written)
        self.sizes.extend(sizes)
        self.written.append(text.encode())
        self.pairs.append(pairs)
        self.times.append(times)

    def of(self, spans: list[list[str]]) -> list[list[int]]:
        """The numbers of the pieces of each span."""
        new = set().union(*spans).difference(self.numbers)
        if new:
            # In a defined order, so that a task that runs again does the same.
            self.learn(sorted(new))
        return [list(map(self.numbers.__getitem__, span)) for span in spans]


def spans(text: str) -> Iterator[list[str]]:
    """The pieces of a text after its leading space, in lists of bounded length where the text can be cut."""
    text = " " + text
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + _SPAN_CHARS) if len(text) - start > _SPAN_CHARS else None
        end = cut.start() if cut else len(text)
        yield _PIECE.findall(text, start, end)
        start = end


class Document:
    """The pieces of a document and the hash of its groups."""

    def __init__(self, doc_id):
        self.doc_id = doc_id
        self.digest = hashlib.sha256()
        self.pieces: list[np.ndarray] = []
        self.whole = True

    def add(self, numbers: list[int], known: Pieces) -> None:
        if known.broken and not known.broken.isdisjoint(numbers):
            self.whole = False
        if self.whole:
            joined = b";".join(map(known.written.__getitem__, numbers))
            self.digest.update(b";" + joined if self.pieces else joined)
            self.pieces.append(np.array(numbers, dtype=np.int32))


class Chunk:
    """Documents whose pairs are numbered together."""

    def __init__(self, number: int, known: Pieces, kind: pa.DataType):
        self.number, self.known = number, known
        self.documents: list[Document] = []
        self.bytes = 0
        self.kind = kind

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row per pair with the documents that have it, then a row per document with its pairs' places."""
        whole = [doc for doc in self.documents if doc.whole and doc.pieces]
        pieces = np.concatenate([np.concatenate(doc.pieces) for doc in whole]) if whole else np.empty(0, np.int32)
        met = np.flatnonzero(np.bincount(pieces)) if len(pieces) else np.empty(0, np.int64)
        known_pairs = [self.known.pairs[n] for n in met]
        lengths = np.fromiter(map(len, known_pairs), np.int64, len(met)) // 8
        codes = np.frombuffer(b"".join(known_pairs), dtype="<i8")
        times = np.frombuffer(b"".join([self.known.times[n] for n in met]), dtype="<i8")
        sizes = np.frombuffer(self.known.sizes, dtype=np.int64).reshape(-1, 4).copy()
        pairs, places = np.unique(codes, return_inverse=True)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        docs = np.zeros(len(pairs), dtype=np.int64)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for doc in self.documents:
            links, totals = b"", np.zeros(4, dtype=np.int64)
            if doc.whole and doc.pieces:
                own, own_times = np.unique(np.concatenate(doc.pieces), return_counts=True)
                totals = own_times @ sizes[own]
                at = np.searchsorted(met, own)
                n = lengths[at]
                links_at = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                place, inverse = np.unique(places[links_at], return_inverse=True)
                weight = np.bincount(inverse, times[links_at] * np.repeat(own_times, n), len(place)).astype("<i8")
                docs[place] += 1
                links = pack(np.diff(place, prepend=0).astype("<u4").tobytes() + weight.tobytes())
            rows.append((doc, totals, links))
        numbers = {"chunk": np.full(len(pairs), self.number), "place": np.arange(len(pairs))}
        yield _batch(self.kind, len(pairs), **numbers, pair=pairs, docs=docs)
        yield _batch(
            self.kind,
            len(rows),
            chunk=np.full(len(rows), self.number),
            doc_id=[doc.doc_id for doc, _, _ in rows],
            **{name: [int(totals[n]) for _, totals, _ in rows] for n, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            groups_sha256=[doc.digest.hexdigest() if links else "" for doc, _, links in rows],
            links=[links for _, _, links in rows],
        )


_FIELDS = [
    ("chunk", pa.int64()), ("place", pa.int32()), ("pair", pa.int64()), ("docs", pa.int64()), ("doc_id", None),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.binary()),
]
_ALIGNED = (
    "chunk bigint, place int, pair bigint, docs bigint, doc_id {kind}, "
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary"
)
_RESULT = (
    "doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "n_best bigint, count_sum bigint, groups_sha256 string"
)


def _batch(kind: pa.DataType, rows: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[name], own or kind) if name in columns else pa.nulls(rows, own or kind) for name, own in _FIELDS
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _FIELDS])


def _aligner(a_path: str, b_path: str, kind: pa.DataType):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Pieces(Tokenizers(a_path, b_path))
        first = TaskContext.get().partitionId() << 32
        chunk = Chunk(first, known, kind)
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                if chunk.bytes >= CHUNK_BYTES or len(known.written) > _CACHED_PIECES:
                    yield from chunk.rows()
                    chunk = Chunk(chunk.number + 1, known, kind)
                    if len(known.written) > _CACHED_PIECES:
                        known.clear()
                texts = part.column("text").to_pylist()
                docs = [Document(doc_id) for doc_id in part.column("doc_id").to_pylist()]
                chunk.documents += docs
                chunk.bytes += part.column("text").nbytes
                # A space mark in the text would come back as a space.
                whole = [(doc, text) for doc, text in zip(docs, texts, strict=True) if text and _SPACE_MARK not in text]
                short = [(doc, list(spans(text))) for doc, text in whole if len(text) <= _SPAN_CHARS]
                for (doc, _), numbers in zip(short, known.of([own[0] for _, own in short]), strict=True):
                    doc.add(numbers, known)
                for doc, text in whole:
                    if len(text) > _SPAN_CHARS:
                        for span in spans(text):
                            doc.add(known.of([span])[0], known)
                for doc, text in zip(docs, texts, strict=True):
                    doc.whole = doc.whole and bool(text) and _SPACE_MARK not in text
        if chunk.documents:
            yield from chunk.rows()

    return align


def _summed(kind: pa.DataType):
    def sums(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs.column("place").to_numpy()
        count = np.zeros(len(place), dtype=np.int64)
        best = np.zeros(len(place), dtype=np.int64)
        count[place] = pairs.column("count").to_numpy()
        best[place] = pairs.column("best").to_numpy()
        unpack = zstandard.ZstdDecompressor().decompress
        n_best, count_sum = [], []
        for packed in docs.column("links").to_pylist():
            raw = unpack(packed) if packed else b""
            n = len(raw) // 12
            at = np.cumsum(np.frombuffer(raw, dtype="<u4", count=n).astype(np.int64))
            weight = np.frombuffer(raw, dtype="<i8", offset=4 * n)
            n_best.append(int(best[at] @ weight))
            count_sum.append(int(count[at] @ weight))
        kept = {name: docs.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        kept |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table(kept | {"groups_sha256": docs.column("groups_sha256")})

    return sums


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of aligned documents and of their chunks' pairs, as a table in the shared folder. Runs when called."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    field = rows.schema["doc_id"].dataType
    schema = _ALIGNED.format(kind=field.simpleString())
    aligned = rows.mapInArrow(_aligner(a_path, b_path, to_arrow_type(field)), schema)
    path = work_dir(docs.sparkSession, "aligned")
    by_doc = written(aligned, path).filter("place IS NULL").drop("place", "pair", "docs")
    # Read apart, since both sides are grouped by the same column.
    pairs = docs.sparkSession.read.schema(schema).parquet(path).filter("place IS NOT NULL")
    return by_doc, pairs.select("chunk", "place", "pair", "docs")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per linked pair of ids ``count``, the documents that hold it, and ``best``, whether its first id has no higher one."""
    counted = written(
        pairs.groupBy("pair").agg(F.sum("docs").alias("count")), work_dir(pairs.sparkSession, "pair-counts")
    )
    a_id = F.shiftright("pair", 32)
    # One row per id of the first vocabulary.
    highest = counted.groupBy(a_id.alias("a")).agg(F.max("count").alias("highest"))
    return counted.withColumn("a", a_id).join(F.broadcast(highest), "a").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("bigint").alias("best")
    )


def link_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the sizes of its alignment and what its links' counts add up to."""
    by_doc, pairs = align(docs, a_path, b_path)
    known = pairs.drop("docs").join(pair_counts(pairs), "pair").select("chunk", "place", "count", "best")
    field = docs.schema["doc_id"].dataType
    return by_doc.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _summed(to_arrow_type(field)), _RESULT.format(kind=field.simpleString())
    )
