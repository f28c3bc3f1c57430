"""Simple-8b: many small integers in 64-bit words.

A word's top four bits are a selector that sets how many integers of how many bits
the other 60 hold. Selector 0 is an escape: the word holds a place in the list of
integers that need more than 60 bits. Integers are coded in blocks of ``BLOCK``;
each block starts with a fresh word whose offset is recorded, and the last word of
a block may be part empty.
"""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the format: integers per word and bits of each, by selector.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 0
BLOCK = 4096
_MAGIC = b"S8B1"
_HEAD = "<4sIQQI"
_HEAD_SIZE = struct.calcsize(_HEAD)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each integer needs. High halves apart, since a double holds 53 bits."""
    high = values >> np.uint64(32)
    bits = _exponents(values & np.uint64(0xFFFFFFFF))
    wide = np.flatnonzero(high)
    bits[wide] = 32 + _exponents(high[wide])
    return bits


def _exponents(halves: np.ndarray) -> np.ndarray:
    """Bits of integers below 2**32, from the exponent of the double; that of zero is below all others."""
    return np.maximum((halves.astype(np.float64).view(np.int64) >> 52) - 1022, 0).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """The densest selector at every place of the rows, which are blocks, or an escape where none has room.

    Where a selector fits, the next wider one does too, so those that fit are counted. Past the end of a row is zero.
    """
    fitting = np.zeros(bits.shape, dtype=np.uint8)
    most, reach = bits, 1
    for s in range(len(COUNTS) - 1, ESCAPE, -1):
        while reach < COUNTS[s]:
            step = min(reach, int(COUNTS[s]) - reach)
            ahead = np.zeros_like(most)
            ahead[:, :-step] = most[:, step:]
            most, reach = np.maximum(most, ahead), reach + step
        fits = most <= int(WIDTHS[s])
        if not fits.any():
            break
        fitting += fits
    return np.where(fitting > 0, len(COUNTS) - fitting, ESCAPE).astype(np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """The integers as head, word offset of each block, words, and escaped integers."""
    values = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(values)
    n_blocks = -(-n // BLOCK)
    bits = np.zeros((n_blocks, BLOCK), dtype=np.uint8)
    bits.ravel()[:n] = _bits(values)
    selector = _selectors(bits)
    room = np.minimum(BLOCK - np.arange(BLOCK), 255).astype(np.uint8)
    selector, step = selector.ravel()[:n], np.minimum(COUNTS.astype(np.uint8)[selector], room).ravel()[:n]
    steps = step.tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    first = np.array(starts, dtype=np.int64)
    chosen, size = selector[first], np.minimum(step[first], n - first)
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = chosen == ESCAPE
    live = np.flatnonzero(~escaped & (WIDTHS[chosen] > 0))
    shift = np.zeros(len(live), dtype=np.uint64)
    lane = 0
    while len(live):
        words[live] |= values[first[live] + lane] << shift
        lane += 1
        more = size[live] > lane
        live = live[more]
        shift = shift[more] + WIDTHS[chosen[live]].astype(np.uint64)
    words[escaped] |= np.arange(escaped.sum(), dtype=np.uint64)
    offsets = np.searchsorted(first, np.arange(0, n, BLOCK)).astype(np.uint32)
    head = struct.pack(_HEAD, _MAGIC, BLOCK, n, len(words), int(escaped.sum()))
    return head + offsets.tobytes() + words.astype("<u8").tobytes() + values[first[escaped]].astype("<u8").tobytes()


def decode(data: bytes) -> np.ndarray:
    """All integers of ``encode``, as unsigned 64-bit."""
    magic, block, n, n_words, n_escapes = struct.unpack_from(_HEAD, data)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b segment")
    n_blocks = -(-n // block)
    at = _HEAD_SIZE
    offsets = np.frombuffer(data, "<u4", n_blocks, at)
    words = np.frombuffer(data, "<u8", n_words, at + 4 * n_blocks)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 4 * n_blocks + 8 * n_words)
    return _unpack(words, offsets, escapes, block, n)


def decode_block(data: bytes, number: int) -> np.ndarray:
    """The integers of one block, found by its offset."""
    _, block, n, n_words, n_escapes = struct.unpack_from(_HEAD, data)
    n_blocks = -(-n // block)
    at = _HEAD_SIZE
    offsets = np.frombuffer(data, "<u4", n_blocks, at)
    words = np.frombuffer(data, "<u8", n_words, at + 4 * n_blocks)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 4 * n_blocks + 8 * n_words)
    stop = offsets[number + 1] if number + 1 < n_blocks else n_words
    size = min(block, n - number * block)
    return _unpack(words[offsets[number] : stop], np.zeros(1, "<u4"), escapes, block, size)


def _unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, block: int, n: int) -> np.ndarray:
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    first = ends - counts
    lane = np.arange(ends[-1]) - np.repeat(first, counts)
    width = np.repeat(WIDTHS[selectors], counts).astype(np.uint64)
    mask = (np.uint64(1) << width) - np.uint64(1)
    values = (np.repeat(words, counts) >> (lane.astype(np.uint64) * width)) & mask
    wide = np.repeat(selectors == ESCAPE, counts)
    values[wide] = escapes[values[wide].astype(np.int64)]
    # Lanes past a block's size are the empty rest of its last word.
    starts = first[offsets]
    sizes = np.diff(np.append(starts, ends[-1]))
    place = np.arange(ends[-1]) - np.repeat(starts, sizes)
    wanted = np.minimum(block, n - block * np.arange(len(offsets)))
    return values[place < np.repeat(wanted, sizes)]
