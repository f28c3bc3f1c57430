"""Quality rules as weak supervision.

Each rule looks at one trait of a text and votes good, votes bad, or abstains.
How often each vote falls on good and on bad documents is estimated from the
votes alone by expectation maximisation; a document's quality is its posterior
probability of being good under those estimates. Every rule knows both sides, and
several look at the same junk from different angles: what tells a defect from the
noise of a rule is that other rules see it too. A rule that fires on good and bad
documents alike is found out, and its votes then count for little.

The estimates start from, and lean on, a prior that weighs as much as
``PRIOR_WEIGHT`` of the documents (``MIN_PRIOR_WEIGHT`` of them at least): rules seldom
vote bad on good documents, and a bad document fails some of the rules, not most.

Only documents that pass the base rule take part in the estimation, since the others
are rejected whatever the votes. The votes are first counted by pattern. There are at
most ``3 ** N_RULES`` patterns however many documents there are, so the estimation
runs over one row of counts, as an expression.

Defined results: a null or empty text has no words, fails the base rule and is
not kept. A document's row is kept or dropped whole; repeated rows get the same
verdict. A table where no document passes the base rule, or a few do, is judged by the
prior: two votes for bad then outweigh up to five for good. An empty table gives an
empty result. Input columns of any name are carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbsync.llm.text import BLANKS, as_rows, let, runs, word_hashes, words

GOOD, BAD, ABSTAIN = 1, 2, 0
VOTES = 3
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
ROUNDS = 30
#: Documents that the prior on each rule's votes weighs as much as: a share of all, and at least so many.
PRIOR_WEIGHT = 0.02
MIN_PRIOR_WEIGHT = 10.0
#: What the prior expects of any rule: its shares of abstentions, votes for good and votes for bad.
PRIOR_ON_GOOD = (0.1, 0.88, 0.02)
PRIOR_ON_BAD = (0.2, 0.4, 0.4)
PRIOR_GOOD = 0.8
KEEP_FROM = 0.5
N_RULES = 7
#: A word of letters and digits alone, but for a mark before it and one after.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])\p{P}?+[\p{L}\p{M}\p{N}'’-]++[.,;:!?)\"]?+(?![^\x20\x09-\x0D])"


def _repeated_words(tokens: Column) -> Column:
    """Words covered by the runs of ``WINDOW`` words that occur more than once.

    Runs are sorted by hash, so equal ones are neighbors; a run's words count up
    to the start of the next repeated run. Texts without a repeat skip the sort.
    """

    def covered(placed: Column) -> Column:
        def among_equals(run: Column, at: Column) -> Column:
            before = F.get(placed, at - 1)["h"] == run["h"]
            after = F.get(placed, at + 1)["h"] == run["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        starts = F.array_sort(F.transform(F.filter(placed, among_equals), lambda run: run["i"]))
        return let(starts, words_from)

    def words_from(starts: Column) -> Column:
        reach = F.zip_with(
            starts,
            F.slice(starts, 2, F.size(starts)),
            lambda here, following: F.least(F.coalesce(following - here, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def in_repeats(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(placed, covered)).otherwise(0)

    hashes = let(word_hashes(tokens), lambda hashed: runs(hashed, WINDOW))
    return F.when(F.size(tokens) >= WINDOW, let(hashes, in_repeats)).otherwise(0).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row as the struct ``row``, and the traits that the rules look at."""
    body = F.coalesce(docs[text], F.lit(""))
    plain = as_rows(docs, body=body, tokens=words(docs[text]))
    lines = F.filter(F.split("body", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    traits = plain.select(
        "row",
        F.size("tokens").cast("long").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("body", r"[^!?]+", "")).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace("body", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.regexp_count("body", F.lit(PLAIN_WORD)).cast("long").alias("n_plain"),
        lines.alias("lines"),
        _repeated_words(F.col("tokens")).alias("n_repeat_words"),
    )
    return traits.select(
        *(c for c in traits.columns if c != "lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _two_sided(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rules() -> list[Column]:
    """One vote per rule, over the columns of ``measure``."""
    symbols = _share("n_symbols", "n_words")
    capitals = _share("n_upper", "word_chars")
    shouts = _share("n_shouts", "n_words")
    repeated = _share("n_dup_lines", "n_lines")
    variety = _share("n_distinct", "n_words")
    mean_length = _share("word_chars", "n_words")
    plain = _share("n_plain", "n_words")
    some_lines, some_words = F.col("n_lines") >= 3, F.col("n_words") >= 50
    return [
        _two_sided(symbols > 0.1, symbols <= 0.01),
        _two_sided(capitals > 0.3, capitals <= 0.1),
        _two_sided(shouts > 0.3, shouts <= 0.05),
        _two_sided(some_lines & (repeated > 0.35), some_lines & (repeated == 0)),
        _two_sided(some_words & (variety < 0.3), some_words & (variety >= 0.5)),
        _two_sided((mean_length < 2.5) | (mean_length > 12), mean_length.between(3.5, 8)),
        _two_sided(plain < 0.7, plain >= 0.9),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``good`` is the share of good documents; ``shares[k][j][v]`` how often rule ``j`` votes ``v`` on class ``k``."""

    good: float
    shares: tuple[tuple[tuple[float, ...], ...], ...]

    def log_odds(self, votes: Column) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for j in range(N_RULES):
            weights = F.array(*(F.lit(math.log(self.shares[0][j][v] / self.shares[1][j][v])) for v in range(VOTES)))
            total = total + F.get(weights, F.get(votes, F.lit(j)))
        return total


def _prior_shares() -> list[list[tuple[float, ...]]]:
    return [[shares for _ in range(N_RULES)] for shares in (PRIOR_ON_GOOD, PRIOR_ON_BAD)]


def fit(measured: DataFrame) -> VoteModel:
    """Estimate the model from the votes of all rows that pass the base rule. Runs one job that returns one row."""
    patterns = measured.filter(~base_failed()).groupBy(F.array(*rules()).alias("votes")).agg(F.count("*").cast("double").alias("n"))
    counts = patterns.agg(
        F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("p"), F.sum("n").alias("total")
    )
    cells = [(k, j, v) for k in range(2) for j in range(N_RULES) for v in range(VOTES)]
    prior = _prior_shares()
    flat = F.array(*(F.lit(prior[k][j][v]) for k, j, v in cells))
    total = F.coalesce("total", F.lit(0.0))

    def step(state: Column, _: Column) -> Column:
        def log_likelihood(k: int, votes: Column, start: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(0), F.lit(N_RULES - 1)),
                start,
                lambda acc, j: acc + F.log(F.get(state["t"], F.lit(k * N_RULES * VOTES) + j * VOTES + F.get(votes, j))),
            )

        def posterior(p: Column) -> Column:
            good = log_likelihood(0, p["votes"], F.log(state["good"]))
            bad = log_likelihood(1, p["votes"], F.log(1 - state["good"]))
            return F.struct(p["votes"].alias("votes"), p["n"].alias("n"), (1 / (1 + F.exp(bad - good))).alias("q"))

        judged = F.transform("p", posterior)

        def estimate(rows: Column) -> Column:
            weight = F.greatest(PRIOR_WEIGHT * total, F.lit(MIN_PRIOR_WEIGHT))
            good_rows = F.aggregate(rows, F.lit(0.0), lambda acc, p: acc + p["n"] * p["q"])
            return let(good_rows, lambda n_good: estimate_shares(rows, n_good, weight))

        def estimate_shares(rows: Column, n_good: Column, weight: Column) -> Column:
            def share(i: Column) -> Column:
                is_good = i < N_RULES * VOTES
                rule = F.floor(i / VOTES).cast("int") % N_RULES
                seen = F.aggregate(
                    rows,
                    F.lit(0.0),
                    lambda acc, p: acc
                    + F.when(
                        F.get(p["votes"], rule) == i % VOTES, p["n"] * F.when(is_good, p["q"]).otherwise(1 - p["q"])
                    ).otherwise(0.0),
                )
                return (seen + weight * F.get(flat, i)) / (F.when(is_good, n_good).otherwise(total - n_good) + weight)

            shares = F.transform(F.sequence(F.lit(0), F.lit(len(cells) - 1)), share)
            return F.struct(((n_good + weight * PRIOR_GOOD) / (total + weight)).alias("good"), shares.alias("t"))

        return let(judged, estimate)

    start = F.struct(F.lit(PRIOR_GOOD).alias("good"), flat.alias("t"))
    model = counts.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("m")).first()["m"]
    shares = [[[0.0] * VOTES for _ in range(N_RULES)] for _ in range(2)]
    for (k, j, v), value in zip(cells, model["t"], strict=True):
        shares[k][j][v] = value
    return VoteModel(model["good"], tuple(tuple(tuple(votes) for votes in rule) for rule in shares))


def judge(measured: DataFrame, model: VoteModel) -> DataFrame:
    """``measured`` with ``base_failed``, the ``posterior`` of being good, and ``kept``."""
    posterior = 1 / (1 + F.exp(-model.log_odds(F.array(*rules()))))
    judged = measured.withColumns({"base_failed": base_failed(), "posterior": posterior})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    measured = measure(docs)
    return judge(measured, fit(measured)).filter("kept").select("row.*")
