"""Chat formatting by perspective rotation.

A dialogue of several speakers becomes one training text per participant, in
which that participant is the assistant and every other is a user under their own
name. The mask of a text is the spans of the assistant's turns, end mark included.
A system turn stays a system turn in all of them and is no participant.

A rendering of more than ``PART_TURNS`` turns comes as several rows, cut after every
``PART_TURNS`` turns. They are parts of one text: the texts of a participant, one after
the other by ``part``, are the whole rendering; ``start`` is where a part begins in it,
and the mask's spans are places in the whole. ``whole`` puts the parts together. A turn's
place in a long dialogue is found by range partitioning, and a part's start by
running sums in two steps, so no task holds or sorts a whole dialogue.

Defined results: turns are ordered by ``turn`` (nulls after all numbers), then role, then
the MD5 of the text; repeated turns are all rendered. A null role speaks as
``unknown``, a null text is empty, and a null ``conv_id`` is a dialogue like any
other. Marks of the rendering inside a text or a name get a backslash, so none
of them begins or ends a turn. A dialogue of system turns alone gives its rows without
perspective and with an empty mask. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.llm.text import empty
from ebbsync.session import work_dir, written

PART_TURNS = 256
#: Parts whose lengths are summed in one task, in the first of the two steps.
SLAB_PARTS = 4096
#: Long dialogues, pieces of them, and speakers in them, up to which each of these is broadcast, and their bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

# Fixed values of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT, SYSTEM, UNKNOWN = "assistant", "system", "unknown"
USER = "user:"


def _plain(text: Column) -> Column:
    """``text`` with a backslash in the marks it holds."""
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit(mark.replace("<", "<\\")))
    return text


def _head(speaker: Column, perspective: Column) -> Column:
    shown = F.when(speaker == perspective, ASSISTANT).when(speaker == SYSTEM, SYSTEM)
    return F.concat(F.lit(OPEN), shown.otherwise(F.concat(F.lit(USER), speaker)), F.lit("\n"))


def _participants(turns: str) -> Column:
    speakers = F.array_distinct(F.transform(turns, lambda turn: turn["speaker"]))
    return F.array_sort(F.filter(speakers, lambda name: name != SYSTEM))


def _mask(turns: Column, perspective: Column, start: Column) -> Column:
    begin = F.struct(start.alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        body = state["at"] + F.length(_head(turn["speaker"], perspective))
        end = body + F.length(turn["body"]) + len(CLOSE)
        span = F.array(F.struct(body.alias("start"), end.alias("end")))
        spans = F.when(turn["speaker"] == perspective, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, begin, step, lambda state: state["spans"])


def _place() -> Column:
    """What turns are ordered by; equal for equal turns alone."""
    return F.struct(F.col("turn").isNull().alias("unplaced"), "turn", "speaker", F.md5(F.col("body").cast("binary")).alias("digest"))


def _running(rows: DataFrame, keys: list[str], order: str, value: str, slab: Column, name: str) -> DataFrame:
    """``rows`` with the sum ``name`` of ``value`` over the earlier rows of the same keys.

    Rows are summed up within slabs, then the slabs; each sum of slabs is one row
    for many of ``rows``.
    """
    spark = rows.sparkSession
    placed = written(rows.withColumn("slab", slab), work_dir(spark, "slabs"))
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy(*keys, "slab").orderBy(order).rowsBetween(*earlier)
    across = Window.partitionBy(*(f"{key}_" for key in keys)).orderBy("slab_").rowsBetween(*earlier)
    slabs = placed.groupBy(*(F.col(c).alias(f"{c}_") for c in (*keys, "slab"))).agg(F.sum(value).alias("sum_"))
    slabs = written(
        slabs.select("*", F.coalesce(F.sum("sum_").over(across), F.lit(0)).alias("before_")), work_dir(spark, "slab-sums")
    )
    summed = placed.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in (*keys, "slab")]
    joined = summed.join(broadcast_if(slabs, fits(slabs, BROADCAST_ROWS, BROADCAST_BYTES)), same)
    return joined.withColumn(name, F.col(name) + F.col("before_")).select(*rows.columns, name)


def _parts_of_long(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``place``, ``speaker``, ``body`` and ``copies`` of turns, copies in one part in one row."""
    spark = turns.sparkSession
    distinct = turns.groupBy("conv_id", "turn", "speaker", "body").agg(F.count("*").alias("copies"))
    distinct = distinct.withColumn("place", _place())
    # A range partition of unique keys; where a dialogue is cut, it is cut evenly.
    ranged = distinct.repartitionByRange("conv_id", "place").withColumn("piece", F.spark_partition_id())
    ranged = written(ranged, work_dir(spark, "turns"))
    at = _running(ranged, ["conv_id"], "place", "copies", F.col("piece"), "at")
    first, last = F.floor(F.col("at") / PART_TURNS), F.floor((F.col("at") + F.col("copies") - 1) / PART_TURNS)
    spread = at.withColumn("part", F.explode(F.sequence(first, last)))
    inside = F.least(F.col("at") + F.col("copies"), (F.col("part") + 1) * PART_TURNS)
    inside = inside - F.greatest(F.col("at"), F.col("part") * PART_TURNS)
    return spread.select("conv_id", "part", "place", "speaker", "body", inside.alias("copies"))


def _long_views(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``perspective`` and ``start`` of all parts of long dialogues."""
    spark = turns.sparkSession
    around = len(OPEN) + len("\n") + len(CLOSE) + len("\n")
    as_user = F.when(F.col("speaker") == SYSTEM, len(SYSTEM)).otherwise(len(USER) + F.length("speaker"))
    chars = F.col("copies") * (around + as_user + F.length("body"))
    spoken = turns.groupBy("conv_id", "part", "speaker").agg(F.sum("copies").alias("own"), F.sum(chars).alias("chars"))
    spoken = written(spoken, work_dir(spark, "spoken"))
    totals = spoken.groupBy("conv_id", "part").agg(F.sum("chars").alias("chars"))
    name = F.when(F.col("speaker") != SYSTEM, F.col("speaker"))
    named = spoken.select(F.col("conv_id").alias("of"), name.alias("perspective"))
    alone = named.groupBy("of").agg(F.max("perspective").alias("perspective")).filter("perspective IS NULL")
    people = named.filter("perspective IS NOT NULL").distinct().unionByName(alone)
    people = written(people, work_dir(spark, "people"))
    small = fits(people, BROADCAST_ROWS, BROADCAST_BYTES)
    views = totals.join(broadcast_if(people, small), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = spoken.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "speaker", "own")
    views = views.join(
        own,
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("perspective") == F.col("speaker")),
        "left",
    )
    # As the assistant a speaker's turns have another head.
    saved = F.coalesce(F.col("own") * (len(USER) + F.length("perspective") - len(ASSISTANT)), F.lit(0))
    views = views.select("conv_id", "part", "perspective", (F.col("chars") - saved).alias("chars"))
    slab = F.floor(F.col("part") / SLAB_PARTS)
    return _running(views, ["conv_id", "perspective"], "part", "chars", slab, "start").drop("chars")


def _gathered(turns: DataFrame, keys: list[str]) -> DataFrame:
    """The turns of each of ``keys`` in order, each as often as it has copies."""
    rows = F.array_sort(F.collect_list(F.struct("place", "speaker", "body", "copies")))
    turn = lambda t: F.array_repeat(F.struct(t["speaker"].alias("speaker"), t["body"].alias("body")), t["copies"].cast("int"))
    return turns.groupBy(*keys).agg(rows.alias("turns")).withColumn("turns", F.flatten(F.transform("turns", turn)))


def rotate(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``perspective``, ``part``, ``start``, ``n_turns``, ``text`` and ``mask`` of every participant's rendering."""
    spark = turns.sparkSession
    plain = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        _plain(F.coalesce("role", F.lit(UNKNOWN))).alias("speaker"),
        _plain(F.coalesce("text", F.lit(""))).alias("body"),
    )
    long = plain.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > PART_TURNS)
    long = written(long.select(F.col("conv_id").alias("of")), work_dir(spark, "long"))
    named = broadcast_if(long, fits(long, BROADCAST_ROWS, BROADCAST_BYTES))
    is_long = F.col("conv_id").eqNullSafe(F.col("of"))

    short = plain.join(named, is_long, "left_anti")
    short = short.select("conv_id", "speaker", "body", _place().alias("place"), F.lit(1).cast("bigint").alias("copies"))
    whole_ones = _gathered(short, ["conv_id"]).select(
        "conv_id",
        F.lit(0).cast("bigint").alias("part"),
        F.lit(0).cast("bigint").alias("start"),
        "turns",
        F.explode_outer(_participants("turns")).alias("perspective"),
    )
    cut = written(_parts_of_long(plain.join(named, is_long, "left_semi")), work_dir(spark, "cut-turns"))
    views = _long_views(cut).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "perspective", "start")
    parts = _gathered(cut, ["conv_id", "part"]).join(
        views, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    )
    rotated = whole_ones.unionByName(parts.select(*whole_ones.columns))
    seen_as = F.coalesce("perspective", F.lit(""))
    lines = F.transform(
        "turns",
        lambda turn: F.concat(_head(turn["speaker"], seen_as), turn["body"], F.lit(CLOSE + "\n")),
    )
    return rotated.select(
        "conv_id",
        "perspective",
        "part",
        "start",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(lines, "").alias("text"),
        F.when(F.col("perspective").isNull(), empty("struct<start:bigint,end:bigint>"))
        .otherwise(_mask(F.col("turns"), seen_as, F.col("start")))
        .alias("mask"),
    )


def whole(rotated: DataFrame) -> DataFrame:
    """One row per dialogue and perspective: ``n_turns``, ``text`` and ``mask`` of the whole rendering.

    For renderings that fit a row; what does not is read part by part.
    """
    parts = F.array_sort(F.collect_list(F.struct("part", "n_turns", "text", "mask")))
    joined = rotated.groupBy("conv_id", "perspective").agg(parts.alias("parts"))
    return joined.select(
        "conv_id",
        "perspective",
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, part: n + part["n_turns"]).alias("n_turns"),
        F.array_join(F.col("parts.text"), "").alias("text"),
        F.flatten(F.col("parts.mask")).alias("mask"),
    )
