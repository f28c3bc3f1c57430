from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import SparkSession

from ebbsync.session import configure, work_dir

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ebbsync-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def batch(number, ids, domain="a.test", backend="b.test:1", namespace="n"):
    store = {"backend": backend, "namespace": namespace}
    return {"id": number, "entityIds": ids, "wiki": {"domain": domain, "wiki_queryservice_namespace": store}}


def polls(spark, *bodies):
    """A feed of the given bodies; anything but text is rendered as JSON."""
    rows = [(n, body if isinstance(body, str) else json.dumps(body)) for n, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "poll_seq BIGINT, body STRING")


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
