"""Tenant targets and entity namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbsync.config import UpdaterConfig
from ebbsync.functions.urls import concept_uri, store_url


def derive_targets(batches: DataFrame, cfg: UpdaterConfig = UpdaterConfig()) -> DataFrame:
    """Add the addresses a batch is worked with.

    ``wiki_url`` composes scheme and domain; that composition is this
    package's own. ``proxy_map`` is NULL without an ingress.
    """
    domain = F.col("domain")
    if cfg.ingress is None:
        proxy_map = F.lit(None).cast("string")
    else:
        proxy_map = F.concat(domain, F.lit("="), F.lit(cfg.ingress))
    return batches.withColumns(
        {
            "sparql_url": store_url(F.col("backend"), F.col("namespace")),
            "concept_uri": concept_uri(domain),
            "wiki_url": F.concat(F.lit(f"{cfg.scheme}://"), domain),
            "namespaces": F.lit(cfg.namespaces),
            "proxy_map": proxy_map,
        }
    )


def resolve_wikis(batches: DataFrame, wikis: DataFrame) -> DataFrame:
    """Add ``wiki_id`` by domain; NULL for a domain that no wiki has.

    Requests of an unknown wiki find no state, so their batch is not done.
    """
    return batches.join(wikis.select("domain", "wiki_id"), "domain", "left")


def namespace_table(spark: SparkSession, cfg: UpdaterConfig = UpdaterConfig()) -> DataFrame:
    """``(entity_type, ns, slot)`` of the configured ``<namespace>/<slot>`` values."""
    rows = [
        F.struct(F.lit(kind).alias("entity_type"), F.lit(slot).alias("ns_slot"))
        for kind, slot in cfg.namespace_slots
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).select(
        "entity_type",
        F.split_part("ns_slot", F.lit("/"), F.lit(1)).try_cast("int").alias("ns"),
        F.split_part("ns_slot", F.lit("/"), F.lit(2)).alias("slot"),
    )


def filter_namespaces(
    requests: DataFrame, namespaces: DataFrame, allowed: str, keep_untyped: bool = False
) -> DataFrame:
    """Keep requests whose ``entity_type`` lies in an allowed namespace; add ``ns`` and ``slot``.

    ``namespaces`` holds one row per configured entity type, so its size is set
    by the configuration and it is broadcast. Parts of the ``allowed`` CSV that
    are not integers allow nothing. ``keep_untyped`` also lets requests of an
    unknown type through, so that their fetch decides.
    """
    allowed_ns = F.transform(F.split(F.lit(allowed), ","), lambda part: F.trim(part).try_cast("int"))
    permitted = namespaces.filter(F.array_contains(allowed_ns, F.col("ns")))
    if not keep_untyped:
        return requests.join(F.broadcast(permitted), "entity_type")
    return requests.join(F.broadcast(permitted), "entity_type", "left").filter(
        F.col("ns").isNotNull() | F.col("entity_type").isNull()
    )
