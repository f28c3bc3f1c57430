"""Addresses and identifiers of a tenant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of the addresses that stores and wikis are known by.
CONCEPT_SCHEME = "https://"
STORE_SCHEME = "http://"
STORE_PATH = "/bigdata/namespace/"
STORE_ENDPOINT = "/sparql"
ENTITY_PATH = "/entity/"


def concept_uri(domain: Column) -> Column:
    """Always https: it identifies the wiki and is not an address to call."""
    return F.concat(F.lit(CONCEPT_SCHEME), domain)


def entity_uri(domain: Column, entity_id: Column) -> Column:
    return F.concat(concept_uri(domain), F.lit(ENTITY_PATH), entity_id)


def store_url(backend: Column, namespace: Column) -> Column:
    """Always http: stores are reached inside the cluster."""
    return F.concat(
        F.lit(STORE_SCHEME), backend, F.lit(STORE_PATH), namespace, F.lit(STORE_ENDPOINT)
    )
