"""Reading the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbsync import schemas

# Fixed value: where a poll file's path carries its number, as in
# poll-17.json or poll_seq=17/part-0.txt.
POLL_NUMBER = r"(?:poll-|poll_seq=)(\d+)"

#: A stream forgets no file for its age: one may arrive long after it was written.
ANY_AGE = {"maxFileAge": "1000000d"}


def read_polls(
    spark: SparkSession,
    path: str,
    fmt: str = "files",
    streaming: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Poll responses as ``(poll_seq, body)``, in a stream with ``landed_at``.

    ``files`` has one response per file, numbered by its path. ``parquet`` is a
    table of responses, the shape for feeds too long for one file per poll.
    ``landed_at`` is the modification time of the file a response came in.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming:
        reader = reader.options(**ANY_AGE)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed_at = [F.col("_metadata.file_modification_time").alias("landed_at")] if streaming else []
    if fmt == "parquet":
        return reader.schema(schemas.POLL).parquet(path).select("poll_seq", "body", *landed_at)
    if fmt != "files":
        raise ValueError(f"unknown feed format {fmt!r}")
    number = F.regexp_extract(F.col("_metadata.file_path"), POLL_NUMBER, 1)
    numbered = F.when(number != "", number.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("no poll number in "), F.col("_metadata.file_path"))).cast("bigint")
    )
    return reader.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        numbered.alias("poll_seq"), F.col("value").alias("body"), *landed_at
    )


def write_poll_files(polls: DataFrame, path: str) -> None:
    """Write a feed as one file per poll, the shape ``read_polls`` streams from."""
    polls.select("poll_seq", F.col("body").alias("value")).repartition("poll_seq").write.partitionBy(
        "poll_seq"
    ).text(path)
