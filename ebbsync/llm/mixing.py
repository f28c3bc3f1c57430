"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words: a weighted share of the budget, at
most ``MAX_EPOCHS`` times what it has, where what one source cannot take goes to
the others by weight. A source's whole passes over its documents come first; the
remainder is a sample. Each document draws an exponential key divided by its
quality weight, and the documents of least key are taken as far as the remainder
goes: the running sum of words decides, to the nearer side at the last document.

The running sum is not taken by sorting a source, of which one may hold most
rows. Keys are first summed up in ``BUCKETS`` slices per source; the slice in
which the remainder ends is the only one whose documents are ordered.

The draw is a hash of document id and text, so a rerun or a lost task gives the
same mix.

Defined results: a null or empty text has size 0 and adds no words. Null sources
are a source of their own, after all others. Rows equal in id and text draw the
same key and are taken or left together. An empty table gives an empty result.
Input columns of any name are carried along by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.llm.text import as_rows, n_words
from ebbsync.session import work_dir, written

# Fixed values of the mix.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2

BUCKETS = 4096
#: Rows per source, or documents of a cut slice, up to which they are broadcast.
BROADCAST_ROWS = 200_000


def quality_weight(text: Column) -> Column:
    """From 0.05 to 1, less the more digits and symbols a text has."""
    body = F.coalesce(text, F.lit(""))
    junk = F.length(F.regexp_replace(body, r"[^0-9#*$%&|<>!?]+", ""))
    return F.greatest(F.lit(0.05), 1 - 4 * junk / F.greatest(F.length(body), F.lit(1)))


def sample_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """A digest of the row, and its exponential draw over the quality weight."""
    digest = F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / float(2**52)
    return digest, -F.log(uniform) / quality_weight(text)


def sized(docs: DataFrame) -> DataFrame:
    """Every row as ``row`` beside ``source``, ``size``, ``digest``, ``draw``, and the slice of its draw."""
    digest, draw = sample_key(docs["doc_id"], docs["text"])
    rows = as_rows(docs, source=docs["source"], size=n_words(docs["text"]), digest=digest, draw=draw)
    part = F.least(F.floor(BUCKETS * (1 - F.exp(-F.col("draw")))), F.lit(BUCKETS - 1)).cast("int")
    return rows.withColumn("part", part)


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source; one row per source.

    A source is full if its limit per weight is at most the level that the rest
    of the budget reaches once the sources of lower limit per weight are full.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*(F.lit(w) for w in WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS))
    everything = Window.partitionBy()
    weighed = totals.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (MAX_EPOCHS * F.col("source_size")).alias("limit"),
        (BUDGET * F.sum("source_size").over(everything)).alias("budget"),
    ).withColumn("fills_at", F.col("limit") / F.col("weight"))
    rising = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    full_before = F.coalesce(F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", (F.col("budget") - full_before) / sharing)
    open_level = F.first(F.when(F.col("fills_at") > F.col("level"), F.col("level")), ignorenulls=True)
    final = levelled.withColumn(
        "final", open_level.over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    share = F.least(F.col("limit").cast("double"), F.col("weight") * F.col("final"))
    return final.select(
        "source", "source_size", F.coalesce(share, F.col("limit").cast("double")).alias("target")
    )


def plan(sizes: DataFrame) -> DataFrame:
    """``targets`` with the whole ``epochs``, the ``rest`` to sample, and the slice where the sample ends."""
    aims = targets(sizes).withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    )
    aims = aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    slices = sizes.groupBy("source", "part").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.withColumn("upto", F.sum("words").over(upto)).withColumnRenamed("source", "s")
    ends = aims.select(F.col("source").alias("t"), "rest").join(slices, F.col("s").eqNullSafe(F.col("t")))
    ends = ends.filter(F.col("upto") > F.col("rest")).groupBy("t")
    cut = ends.agg(F.min(F.struct("part", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
    return aims.join(cut, F.col("source").eqNullSafe(F.col("t")), "left").select(
        "source",
        "source_size",
        "target",
        "epochs",
        "rest",
        F.coalesce("cut.part", F.lit(BUCKETS)).alias("cut_part"),
        F.coalesce("cut.before", F.lit(0)).alias("cut_before"),
    )


def _planned(rows: DataFrame, aims: DataFrame) -> DataFrame:
    named = aims.withColumnRenamed("source", "aim_source")
    named = broadcast_if(named, fits(named, BROADCAST_ROWS))
    return rows.join(named, F.col("source").eqNullSafe(F.col("aim_source"))).drop("aim_source")


def times(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` of ``sized`` with the columns of ``plan`` and how many ``times`` each is taken.

    ``sizes`` is the same table without ``row``, written once.
    """
    spark = rows.sparkSession
    aims = written(plan(sizes), work_dir(spark, "mix-plan"))
    cut = _planned(sizes, aims).filter("part = cut_part").groupBy(
        "source", "digest", "draw", "size", "rest", "cut_before"
    )
    order = Window.partitionBy("source").orderBy("draw", "digest").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.agg((F.count("*") * F.col("size")).alias("words"))
    before = F.col("cut_before") + F.coalesce(F.sum("words").over(order), F.lit(0))
    taken = cut.filter("words > 0").withColumn("before", before).filter(F.col("before") + F.col("words") / 2 <= F.col("rest"))
    taken = written(
        taken.select(F.col("source").alias("taken_source"), F.col("digest").alias("taken_digest")), work_dir(spark, "cut")
    )
    taken = broadcast_if(taken, fits(taken, BROADCAST_ROWS))
    drawn = _planned(rows, aims).join(
        taken,
        (F.col("digest") == F.col("taken_digest")) & F.col("source").eqNullSafe(F.col("taken_source")),
        "left",
    )
    before_cut = (F.col("size") > 0) & (F.col("part") < F.col("cut_part"))
    sampled = before_cut | F.col("taken_digest").isNotNull()
    return drawn.withColumn("times", F.col("epochs") + sampled.cast("long")).drop("taken_source", "taken_digest")


def sizes_of(docs: DataFrame) -> DataFrame:
    small = sized(docs).select("row.doc_id", "source", "size", "digest", "draw", "part")
    return written(small, work_dir(docs.sparkSession, "sizes"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    drawn = times(sized(docs), sizes_of(docs)).filter("times > 0 AND size > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("times")))
    return drawn.select("row", copies.alias("copy")).select("row.*")
