"""What each of five filters removes, alone and behind others, in every order of them.

A document fails ``A`` with under 200 words, ``B`` with under half of its words
distinct, ``C`` with more than 2 % capitals A-Z, ``D`` with a symbol of ``#$%&*|``,
and ``E`` if a smaller ``doc_id`` has the same text. Filters are applied from left
to right, and the first one that a document fails removes it.

``E`` is an existential self-join: a left-semi join on the text's hash, the exact
text and a smaller id. Its right side has one row per text, the least id, made with
a partial step in every task, so a group of copies meets one row however large it
is; and only rows whose hash occurs twice take part. Its ids are united with those
of the other failures, and the bits of an id make its combination, of which there
are at most 32 per part. All orders are worked out from their counts.

Defined results: a null text is empty and fails ``A`` alone, and ``E`` where a smaller
id is empty too. A null ``doc_id`` is neither smaller nor larger than others and fails
no ``E``. Rows that share id and text share their failures and count each. Null
sources make the part '', together with empty ones. Of several labels of an id the
greatest counts; without labels nothing is good or toxic. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbsync.llm.text import let, words
from ebbsync.session import scratch_table, work_dir, written

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = r"[#$%&*|]"


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column) -> Column:
    """The bits of the filters that need the text alone."""

    def when(failed: Column, letter: str) -> Column:
        return F.when(failed, bit(letter)).otherwise(0)

    by_words = let(
        words(text),
        lambda tokens: when(F.size(tokens) < MIN_WORDS, "A")
        + when(100 * F.size(F.array_distinct(tokens)) < MIN_DISTINCT_PERCENT * F.size(tokens), "B"),
    )
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("bigint")
    return (
        by_words
        + when(100 * capitals > MAX_CAPITALS_PERCENT * F.length(text), "C")
        + when(text.rlike(SYMBOLS), "D")
    )


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", part.alias("part"), text.alias("text"), F.xxhash64(text).alias("digest"))


def shared_texts(texts: DataFrame) -> DataFrame:
    """Rows whose hash another row has too."""
    shared = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("digest")
    return texts.join(shared, "digest", "left_semi").select("doc_id", "part", "text", "digest")


def later_copies(texts: DataFrame) -> DataFrame:
    """Rows with the text of a smaller id."""
    first = texts.groupBy("digest", "text").agg(F.min("doc_id").alias("doc_id"))
    row, other = texts.alias("row"), first.alias("other")
    same = (F.col("row.digest") == F.col("other.digest")) & (F.col("row.text") == F.col("other.text"))
    return row.join(other, same & (F.col("other.doc_id") < F.col("row.doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and combination of failed filters ``n`` documents, ``good`` and ``toxic`` ones.

    Runs when called: the rows that share their text are a table of their own, as both sides of the join read it.
    """
    key = ["doc_id", "part", "digest"]
    texts = _texts(docs)
    own = texts.select(*key, own_failures(F.col("text")).alias("failed"), F.lit(1).cast("bigint").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("bigint").alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("bigint").alias("toxic"),
    )
    with scratch_table(shared_texts(texts), "shared") as shared:
        copies = later_copies(shared).select(*key, F.lit(bit("E")).alias("failed"), F.lit(0).cast("bigint").alias("n"))
        per_id = own.unionByName(copies).groupBy(*key).agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
        counted = (
            per_id.join(marks, "doc_id", "left")
            .groupBy("part", "failed")
            .agg(
                F.sum("n").alias("n"),
                F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
            )
        )
        return written(counted, work_dir(docs.sparkSession, "combinations"))


def _total(rows: Column, value, wanted) -> Column:
    return F.aggregate(F.filter(rows, wanted), F.lit(0).cast("bigint"), lambda total, row: total + value(row))


def all_orders(counted: DataFrame) -> DataFrame:
    """Per part, order of the filters and step what the step's filter removes."""
    orders = " ".join(map("".join, permutations(FILTERS)))
    per_part = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("rows"))

    def place(letter: Column) -> Column:
        return F.instr(F.lit(FILTERS), letter) - 1

    def mask(letters: Column) -> Column:
        bits = F.transform(letters, lambda letter: F.call_function("shiftleft", F.lit(1), place(letter)))
        return F.aggregate(bits, F.lit(0), lambda all_bits, one: all_bits.bitwiseOR(one))

    letters = F.split("filter_order", "")
    steps = (
        per_part.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", mask(F.slice(letters, F.col("step"), F.lit(1))))
        .withColumn("prior", mask(F.slice(letters, F.lit(1), F.col("step") - 1)))
    )

    def fails(row: Column) -> Column:
        return row["failed"].bitwiseAND(F.col("own")) != 0

    def gone(row: Column) -> Column:
        return row["failed"].bitwiseAND(F.col("prior")) != 0

    def removed(name: str) -> Column:
        return _total(F.col("rows"), lambda row: row[name], lambda row: fails(row) & ~gone(row))

    # Of the orders of m failed filters, each comes first in the same share.
    share = F.lit(len(list(permutations(FILTERS)))).cast("bigint")
    return steps.select(
        "part",
        "filter_order",
        "step",
        _total(F.col("rows"), lambda row: row["n"], lambda row: ~fails(row) & ~gone(row)).alias("kept"),
        removed("n").alias("removed"),
        _total(F.col("rows"), lambda row: row["n"], lambda row: fails(row) & gone(row)).alias("redundant"),
        _total(F.col("rows"), lambda row: row["n"], lambda row: row["failed"] == F.col("own")).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        _total(
            F.col("rows"), lambda row: F.try_divide(row["n"] * share, F.bit_count(row["failed"])).cast("bigint"), fails
        ).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    return all_orders(combinations(docs, labels))
