"""Benchmark decontamination: short test items found inside long documents.

The search is for containment, the share of an item's distinct five-word shingles
that a document has, and not for similarity, which a long document around a short
item keeps near zero. Items are partitioned by their number of shingles ``n``.
The partition sets how many of an item's least shingle hashes, its MinHash
sketch, are searched: ``n - ceil(t * n) + 1`` for a containment of ``t``. A
document without any of those lacks too many shingles to reach ``t``, so the
sketch loses no match at any document length, where banding a document's own
MinHash values would: an item of 20 shingles in a text of 20,000 has a
similarity of 0.001. Documents with too few shingles for a partition are not
candidates of it.

Candidates are verified by the exact containment of shingles over the whole
document.

Defined results: null and empty texts match nothing. A text of one to four words
has one shingle of all its words, so such an item is found only as a whole text.
Repeated items and rows count once. Items of equal id and unequal text are
searched apart. Extra columns of any name are carried along by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.llm.text import MIN_SIMILARITY, as_rows, let, shingles, text_key, words
from ebbsync.session import work_dir, written

#: Sketch rows (16 bytes) or candidate rows (40 bytes) up to which a side is broadcast.
BROADCAST_ROWS = 500_000


def _hashes(text: Column) -> Column:
    return let(words(text), shingles)


def _items(benchmark: DataFrame) -> DataFrame:
    """One row per distinct item: its shingles, how many must be shared, and its sketch by partition."""
    plain = benchmark.select("item_id", text_key(F.col("text")).alias("item_key"), "text").distinct()
    distinct = F.array_sort(F.array_distinct(_hashes(F.col("text"))))
    sized = plain.select("item_id", "item_key", distinct.alias("hashes")).withColumn("n", F.size("hashes"))
    need = F.ceil(F.col("n") * MIN_SIMILARITY - 1e-9).cast("int")
    return (
        sized.filter("n > 0")
        .withColumn("need", need)
        .withColumn("sketch", F.slice("hashes", 1, F.col("n") - F.col("need") + 1))
    )


def _size_classes(items: DataFrame) -> DataFrame:
    """Sketches by size partition: powers of two of the shingles, and the fewest any item of one needs."""
    sized = items.withColumn("partition", F.floor(F.log2("n")).cast("int"))
    floors = sized.groupBy("partition").agg(F.min("need").alias("least"))
    return sized.join(floors, "partition")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document text and item that it holds: ``doc_id``, ``key``, ``item_id``, ``n_item``, ``n_shared``."""
    spark = docs.sparkSession
    items = written(_items(benchmark), work_dir(spark, "items"))
    sketches = _size_classes(items).select("item_id", "item_key", "least", F.explode("sketch").alias("hash"))
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    hashed = keyed.select("doc_id", "key", _hashes(F.col("text")).alias("hashes"))
    probes = hashed.select("doc_id", "key", F.size("hashes").alias("n_doc"), F.explode("hashes").alias("hash"))
    found = probes.join(broadcast_if(sketches, fits(sketches, BROADCAST_ROWS)), "hash").filter("n_doc >= least")
    found = found.select("doc_id", "key", "item_id", "item_key").distinct()
    found = written(found, work_dir(spark, "candidates"))
    small = fits(found, BROADCAST_ROWS)

    wanted = found.select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct()
    of_doc = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
    texts = keyed.join(broadcast_if(wanted, small), of_doc, "left_semi")
    texts = texts.select("doc_id", "key", _hashes(F.col("text")).alias("hashes")).dropDuplicates(["doc_id", "key"])
    pairs = texts.join(
        broadcast_if(found.withColumnsRenamed({"doc_id": "d", "key": "k"}), small), of_doc
    ).select("doc_id", "key", "hashes", "item_id", "item_key")
    item = items.select(
        F.col("item_id").alias("i"), F.col("item_key").alias("ik"), F.col("hashes").alias("item_hashes"), "n", "need"
    )
    of_item = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("ik"))
    shared = F.size(F.array_intersect("item_hashes", "hashes"))
    verified = pairs.join(item, of_item).withColumn("n_shared", shared).filter("n_shared >= need")
    return verified.select(
        "doc_id", "key", "item_id", F.col("n").cast("long").alias("n_item"), F.col("n_shared").cast("long")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, unchanged."""
    leaks = find_leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("key").alias("leak_key"))
    leaks = written(leaks.distinct(), work_dir(docs.sparkSession, "leaks"))
    keyed = as_rows(docs, key=text_key(docs["text"]))
    of_row = (F.col("key") == F.col("leak_key")) & F.col("row.doc_id").eqNullSafe(F.col("leak_id"))
    return keyed.join(broadcast_if(leaks, fits(leaks, BROADCAST_ROWS)), of_row, "left_anti").select("row.*")
