"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbsync.llm import (
    alignment,
    classifier,
    ctw,
    decontaminate,
    filter_audit,
    mixing,
    perspectives,
    quality_rules,
    simhash,
    token_counts,
    token_store,
    warc,
)
from ebbsync.llm.order_minhash import NearDuplicates
from ebbsync.session import configure, work_dir, written

QUERIES = {}


def query(fn):
    """Register a query under its function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), str(sf_dir))

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_classifier(spark, sf_dir):
    return classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_mix_sources(spark, sf_dir):
    sizes = mixing.sizes_of(table(spark, sf_dir, "documents"))
    drawn = mixing.times(sizes, sizes)
    return drawn.select(
        "doc_id", "size", "source", "source_size", "target", (F.col("times") * F.col("size")).alias("taken")
    )


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def crawl_of(pages: DataFrame) -> DataFrame:
    """WARC records of two visits to every page: a full response, and a day later a 304.

    Every tenth page answers the second visit with another ETag, and addresses vary as crawls see them.
    """
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    other = F.when(F.col("page_id") % 10 == 3, F.lit('"changed"')).otherwise(etag)
    at = F.lit(1_700_000_000) + F.col("page_id") * 7

    def date(seconds):
        return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def head(*lines):
        return F.concat_ws(warc.CRLF, *lines)

    full = warc.render(
        F.lit("response"), F.concat(F.lit("r-"), "page_id"), F.col("url"), date(at),
        head(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html"), F.concat(F.lit("ETag: "), etag),
             F.concat(F.lit("Content-Length: "), F.octet_length("html")), F.lit("Cache-Control: no-cache")),
        F.col("html"),
    )
    again = warc.render(
        F.lit("revisit"), F.concat(F.lit("v-"), "page_id"),
        F.concat(F.regexp_replace("url", "^http:", "HTTPS:"), F.lit("#again")), date(at + 86_400),
        head(F.lit("HTTP/1.1 304 Not Modified"), F.lit("Content-Type: text/plain"), F.concat(F.lit("ETag: W/"), other),
             F.lit("Cache-Control: max-age=60"), F.concat(F.lit("Age: "), F.col("page_id") % 100)),
        F.lit(""),
    )
    return pages.select(F.explode(F.array(full, again)).alias("raw"))


@query
def op4_revisits(spark, sf_dir):
    records = warc.parse(crawl_of(table(spark, sf_dir, "pages")))
    resolved = warc.resolve(written(warc.keyed(records), work_dir(spark, "records")), has_keys=True)
    header = {n: F.try_element_at("headers", F.lit(n)) for n in ("etag", "content-type", "cache-control", "age")}
    return resolved.select(
        F.regexp_replace("record_id", "^v-", "").cast("bigint").alias("page_id"),
        "status",
        F.regexp_replace("refers_to", "^r-", "").cast("bigint").alias("refers_to"),
        *(value.alias(name.replace("-", "_")) for name, value in header.items()),
        F.size("headers").cast("bigint").alias("n_headers"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.md5(F.col("payload").cast("binary")).alias("payload_md5"),
    )


@query
def op5_token_store(spark, sf_dir):
    path = work_dir(spark, "tokens")
    token_store.write_store(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return token_store.read_index(spark, path)


@query
def op6_language_model(spark, sf_dir):
    return ctw.score_documents(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark, sf_dir):
    traits = quality_rules.measure(table(spark, sf_dir, "documents")).select("row.doc_id", "*").drop("row")
    measured = written(traits, work_dir(spark, "traits"))
    judged = quality_rules.judge(measured, quality_rules.fit(measured))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*base, "posterior", "kept")


@query
def op8_decontaminate(spark, sf_dir):
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_item", "n_shared").distinct()


@query
def op9_perspectives(spark, sf_dir):
    rotated = perspectives.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda span: F.concat_ws("-", span["start"], span["end"]))
    return rotated.withColumn("mask", F.array_join(spans, ","))


@query
def op10_near_duplicates(spark, sf_dir):
    return NearDuplicates(table(spark, sf_dir, "documents")).members().select("doc_id", "class_id")


@query
def op11_alignment(spark, sf_dir):
    return alignment.link_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op12_fingerprints(spark, sf_dir):
    edited = simhash.edited_by_next(table(spark, sf_dir, "documents"))
    near = simhash.near_counts(edited.select("fingerprint"))
    own, changed = F.col("fingerprint"), F.col("edited_fingerprint")
    return edited.join(near, "fingerprint").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.as_text(own).alias("fingerprint"),
        simhash.as_text(changed).alias("edited_fingerprint"),
        simhash.likeness(own, changed).alias("near_edited"),
        simhash.likeness(own, F.col("next_fingerprint")).alias("near_next"),
        "n_near",
    )


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
