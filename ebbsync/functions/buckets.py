"""Buckets of subjects, and the slices of a tenant's buckets that directories hold.

A subject's bucket is a hash of wiki and subject. A tenant's rows are dealt to a
power of two of slices, as many as its size asks for, each a range of buckets. A
slice's label says of how many it is one, so the labels that a bucket may be
found under are known without knowing a tenant's size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: As many as a task can hold the numbers of, so that a set of buckets can be broadcast whatever it was made from.
BUCKETS = 1 << 21
MAX_SLICES = 1 << 12
ONE_SLICE = "1-0"


def bucket(wiki_id: Column, subject: Column) -> Column:
    return F.pmod(F.xxhash64(wiki_id.cast("int"), subject), F.lit(BUCKETS)).cast("int")


def slices_for(rows: Column, slice_rows: int) -> Column:
    """The least power of two of slices with at most ``slice_rows`` rows each, on average."""
    wanted = F.ceil(F.log2(F.greatest(rows / slice_rows, F.lit(1.0))))
    return F.least(F.pow(F.lit(2.0), wanted), F.lit(float(MAX_SLICES))).cast("int")


def label(number: Column, slices: Column) -> Column:
    """The slice of a bucket among ``slices``."""
    width = (F.lit(BUCKETS) / slices).cast("int")
    return F.concat_ws("-", slices.cast("string"), F.floor(number / width).cast("string"))


def labels(numbers: Iterable[int]) -> list[str]:
    """Every label under which one of the buckets can be."""
    numbers, found, slices = set(numbers), set(), 1
    while slices <= MAX_SLICES:
        width = BUCKETS // slices
        found |= {f"{slices}-{number // width}" for number in numbers}
        slices *= 2
    return sorted(found)
