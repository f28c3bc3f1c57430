"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space, and a word as a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8


def empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def words(text: Column) -> Column:
    """The words of a text in order; none of a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), empty("string"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    An expression used inside a lambda is computed again for every element, and
    the optimizer moves a column's definition there if it is used just once. The
    variable of a lambda over a list of one stays as it is.
    """
    return F.get(F.transform(F.array(value), lambda once: use(once)), F.lit(0))


def runs(hashed: Column, width: int) -> Column:
    """A hash of every run of ``width`` elements; of fewer elements, one hash of them all."""
    last = F.greatest(F.size(hashed) - width, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(hashed, i + 1, width)))


def word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda word: F.xxhash64(word))


def shingles(tokens: Column, width: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of every run of ``width`` words, repeats included.

    A text of fewer words has one shingle, all of its words; no words, no shingles.
    """
    hashes = let(word_hashes(tokens), lambda hashed: runs(hashed, width))
    return F.when(F.size(tokens) > 0, hashes).otherwise(empty("bigint"))


def as_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """Each input row as the struct ``row`` beside computed columns, whatever the input's columns are called."""
    return df.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in columns.items()))
