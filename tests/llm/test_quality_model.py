"""The estimated quality model: against a plain version of it, and with a rule that is mostly wrong."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ebbsync.llm import quality_rules as qr
from ebbsync.llm.queries import table

TRAITS = (
    "n_words", "word_chars", "n_symbols", "n_distinct", "n_shouts", "n_upper", "n_plain", "n_repeat_words", "n_lines",
    "n_dup_lines",
)
NOISY = 4


def planted(spark, noise):
    """4,000 texts, of which a tenth are junk; the rule of variety fires on a share of both."""
    rng = np.random.default_rng(7)
    junk = rng.random(4000) < 0.1
    fires = rng.random(4000) < noise
    rows = []
    for n in range(4000):
        good = (100, 500, 0, 90, 0, 10, 99, 0, 5, 0)
        bad = (100, 700, 80, 90, 0, 10, 20, 0, 5, 0)
        row = list(bad if junk[n] else good)
        row[3] = 10 if fires[n] else 90
        rows.append((n, bool(junk[n]), bool(fires[n]), *row))
    schema = "doc_id INT, junk BOOLEAN, fires BOOLEAN, " + ", ".join(f"{t} BIGINT" for t in TRAITS)
    return spark.createDataFrame(rows, schema)


def plain_fit(votes):
    weight = max(qr.PRIOR_WEIGHT * len(votes), qr.MIN_PRIOR_WEIGHT)
    prior = np.array([[qr.PRIOR_ON_GOOD] * qr.N_RULES, [qr.PRIOR_ON_BAD] * qr.N_RULES])
    shares, good = prior, qr.PRIOR_GOOD
    for _ in range(qr.ROUNDS):
        odds = np.log(good) - np.log(1 - good)
        odds = odds + sum(np.log(shares[0, j, votes[:, j]] / shares[1, j, votes[:, j]]) for j in range(qr.N_RULES))
        posterior = 1 / (1 + np.exp(-odds))
        weights = np.stack([posterior, 1 - posterior])
        hits = (votes[:, :, None] == np.arange(3)).astype(float)
        shares = (np.einsum("kn,njv->kjv", weights, hits) + weight * prior) / (
            weights.sum(axis=1)[:, None, None] + weight
        )
        good = (posterior.sum() + weight * qr.PRIOR_GOOD) / (len(votes) + weight)
    return good, shares


def votes_of(measured):
    rows = measured.filter(~qr.base_failed()).select(F.array(*qr.rules()).alias("votes")).collect()
    return np.array([r.votes for r in rows]).reshape(-1, qr.N_RULES)


@pytest.mark.parametrize("noise", [0.0, 0.05, 0.3, 0.5])
def test_a_noisy_rule_is_found_out(spark, noise):
    measured = planted(spark, noise)
    model = qr.fit(measured)
    assert abs(model.shares[0][NOISY][qr.BAD] - noise) < 0.05
    for row in qr.judge(measured, model).collect():
        assert row.kept != row.junk


def test_model_is_that_of_plain_rounds(spark):
    for measured in (planted(spark, 0.2), qr.measure(table(spark, SF_DIR, "documents"))):
        model = qr.fit(measured)
        good, shares = plain_fit(votes_of(measured))
        assert abs(model.good - good) < 1e-9
        assert np.allclose(model.shares, shares, atol=1e-9)


def test_no_rows_leave_the_prior(spark):
    model = qr.fit(planted(spark, 0.0).limit(0))
    assert model.good == pytest.approx(qr.PRIOR_GOOD)
    assert model.shares[0][0] == pytest.approx(qr.PRIOR_ON_GOOD)
    assert model.shares[1][0] == pytest.approx(qr.PRIOR_ON_BAD)


def test_plain_words(spark):
    texts = ["One two, (three) four's 55.", "a$ b## |", None, "THE!! end!", "x" * 300_000 + "$"]
    rows = qr.measure(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id INT, text STRING"))
    assert [r.n_plain for r in rows.orderBy("row.doc_id").select("row.doc_id", "n_plain").collect()] == [5, 0, 0, 1, 0]
