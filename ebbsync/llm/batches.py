"""Arrow batches cut by bytes, so that long texts do not add up in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch | pa.Table, text: str, max_bytes: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """``batch`` in order, cut where the bytes of column ``text`` exceed ``max_bytes``; one row at least."""
    start, held = 0, 0
    for row, size in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        if row > start and held + size > max_bytes:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def distinct_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words between ASCII white space, the number of each word of the texts in order, and the place
    after the last word of every text. White space at the ends of a text gives empty words."""
    split = pc.ascii_split_whitespace(texts.cast(pa.string(), safe=False))
    coded = split.flatten().dictionary_encode()
    # As one joined text: much faster than an object of Arrow for every word.
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.binary())), b" ")
    words = joined[0].as_py().split(b" ") if len(coded.dictionary) else []
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    return words, coded.indices.to_numpy(zero_copy_only=False), ends


def spread(pieces: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of every code in order, where code ``n`` has the next ``sizes[n]`` pieces; and how many each has."""
    starts = np.cumsum(sizes) - sizes
    own = sizes[codes]
    ends = np.cumsum(own)
    at = np.repeat(starts[codes] - ends + own, own) + np.arange(ends[-1] if len(ends) else 0)
    return pieces[at], own
