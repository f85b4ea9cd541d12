"""Weak supervision over quality rules, in DataFrame operations only.

Each rule votes good (1), votes bad (-1) or abstains (0) on a document.  The documents are counted by their pattern of
votes - at most 3 to the power of the number of rules, whatever the corpus size - and expectation-maximisation over
these counts estimates, for each class, how often each rule votes bad, good or not at all, so how accurate it is; rules that
tell the same share their weight.  A document is kept if the posterior probability of the good class is at least one half and no
base rule fails: a bad vote of a rule that is little corroborated is outvoted by the others.

Defined results: a null text counts as empty; a text without words has zero in every count, fails the base rules and
isn't kept; repeated rows count as often as they occur; a document whose classes are equally likely is kept; a table gives the
same estimates in any order of its rows; an empty table gives no rows; other columns aren't read, so
their names can't clash.  A text is one row in one task, whatever its length, and no stage groups texts by a key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import common

WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Rounds of expectation-maximisation at most, and the change of the class share at which it ends.
ROUNDS, SETTLED = 200, 1e-9
#: What is expected of any rule before the corpus is seen: the chances of the votes -1, 0, 1 on bad and on good documents, and the share
#: of good documents; and how much that counts beside what the corpus shows: rules are made so that false alarms are rare, while little
#: is known of how much of what is bad each finds.
EXPECTED, EXPECTED_SHARE = np.array([[0.30, 0.10, 0.60], [0.002, 0.03, 0.968]]), 0.9
TRUST, TRUST_SHARE = (0.5, 0.9), 0.1


def repeated_words(windows: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more; windows: the hash of the window at each word."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda all_, k, step: F.get(all_, k + step)["h"].eqNullSafe(F.get(all_, k)["h"])

    def covered(all_: Column) -> Column:
        twice = F.filter(F.sequence(F.lit(0), F.size(all_) - 1), lambda k: same(all_, k, -1) | same(all_, k, 1))
        return F.transform(F.array(F.sort_array(F.transform(twice, lambda k: F.get(all_, k)["i"]))), lambda at: F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x))[0]

    # an array of one element binds a value to a name, so that it is computed once
    return F.transform(F.array(placed), covered)[0]


def signals(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules use."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    count = lambda pattern: F.length(F.regexp_replace("text", pattern, "")).cast("long")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    df = df.select(
        "doc_id",
        (F.length("text") - count("[^ \\t-\\r]+")).alias("word_chars"),
        count("[^#*$%&|<>]+").alias("n_symbols"),
        count("[^!?]+").alias("n_shouts"),
        count("\\P{Lu}+").alias("n_upper"),
        lines.alias("lines"),
        F.transform(common.words(F.col("text")), lambda w: F.xxhash64(w)).alias("word_hashes"),
    )
    df = df.select(
        *["doc_id", "word_chars", "n_symbols", "n_shouts", "n_upper"],
        F.size("word_hashes").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("word_hashes") > WINDOW, F.transform(F.sequence(F.lit(1), F.size("word_hashes") - WINDOW + 1), lambda i: F.xxhash64(F.slice("word_hashes", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    df = df.withColumn("n_windows", F.size(F.array_distinct("windows")))
    return df.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"],
        F.when(F.col("n_windows") < F.size("windows"), repeated_words(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
        *["n_shouts", "n_upper", "n_lines"],
    )


def between(value: Column, over: Column, good: float, bad: float) -> Column:
    """A vote on the share value / over: good up to a share, bad above another, else none."""
    return F.when(over <= 0, 0).when(value <= over * good, 1).when(value > over * bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """Each rule's vote on the counts of signals()."""
    c = F.col
    length = c("word_chars") / F.greatest(c("n_words"), F.lit(1))
    return {
        "few_symbols": between(c("n_symbols"), c("word_chars"), 0.002, 0.02),
        "few_repeats": between(c("n_repeat_words"), c("n_words"), 0.10, 0.25),
        "few_dup_lines": between(c("n_dup_lines"), c("n_lines"), 0.10, 0.60),
        "usual_word_length": F.when(c("n_words") == 0, 0).when(length.between(3, 10), 1).when((length > 20) | (length < 2), -1).otherwise(0),
        "few_shouts": between(c("n_shouts"), c("n_words"), 0.05, 0.20),
        "few_capitals": between(c("n_upper"), c("word_chars"), 0.10, 0.40),
    }


@dataclass
class Fit:
    """What expectation-maximisation found: the share of good documents; by class (bad, good) and rule the chances of the votes -1, 0, 1;
    how many times each rule's evidence is told; the log odds of the good class and, for each rule and vote, what the vote adds to them."""

    share: float
    chances: np.ndarray
    told: np.ndarray
    base: float
    weights: list[dict[int, float]]

    def accuracies(self) -> list[float]:
        """Of each rule, the share of its votes, good or bad, that are right."""
        prior = np.array([1 - self.share, self.share])
        right = prior[0] * self.chances[0, :, 0] + prior[1] * self.chances[1, :, 2]
        return (right / (prior[:, None] * (self.chances[:, :, 0] + self.chances[:, :, 2])).sum(axis=0)).tolist()


def fitted(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> Fit:
    """Expectation-maximisation for two classes, within which each rule votes bad, good or not at all by chances of its own.

    patterns: (votes, number of documents).  The chances estimated from the counts are averaged with what is expected of any
    rule (EXPECTED, by TRUST), whatever the size of the corpus: without that, rules that tell the same would be taken for the
    classes.  Rules that vote bad together within a class tell the same thing: a rule's evidence is divided by one plus the sum of its
    positive correlations with the others, in both steps.  A document that a rule finds bad starts as likely bad.
    """
    if not patterns:
        return Fit(EXPECTED_SHARE, np.repeat(EXPECTED[:, None], n_rules, axis=1), np.ones(n_rules), 0.0, [dict.fromkeys((-1, 0, 1), 0.0) for _ in range(n_rules)])
    votes = np.array([v for v, _ in patterns]).reshape(len(patterns), n_rules)
    n = np.array([k for _, k in patterns], float)
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    good = np.where((votes == -1).any(axis=1), 0.1, 0.95)
    trust = np.array(TRUST)[:, None, None]
    share = -1.0
    for _ in range(ROUNDS):
        old, share = share, TRUST_SHARE * EXPECTED_SHARE + (1 - TRUST_SHARE) * float((n * good).sum() / n.sum())
        mass = np.stack([n * (1 - good), n * good])
        total = mass.sum(axis=1)
        own = np.einsum("cp,pjv->cjv", mass, cast) / np.maximum(total, 1e-9)[:, None, None]
        # A class without documents has what is expected of it.
        chances = np.where(total[:, None, None] > 0, trust * EXPECTED[:, None] + (1 - trust) * own, EXPECTED[:, None])
        apart = cast[None, :, :, 0] - own[:, None, :, 0]
        shared = np.einsum("cp,cpj,cpk->jk", mass, apart, apart)
        spread = np.sqrt(np.maximum(np.diag(shared), 1e-9))
        alike = np.clip(shared / np.outer(spread, spread), 0, 1)
        told = 1 + alike.sum(axis=1) - np.diag(alike)
        evidence = np.log(chances[1] / chances[0]) / told[:, None]
        base = math.log(share / (1 - share))
        odds = base + np.einsum("pjv,jv->p", cast, evidence)
        good = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if abs(share - old) < SETTLED:
            break
    return Fit(share, chances, told, base, [dict(zip((-1, 0, 1), map(float, row), strict=True)) for row in evidence])


def fit(counted: DataFrame) -> Fit:
    """The estimates from the votes on the counts of signals(); the vote patterns are gathered, 3 to the power of the rules at most."""
    votes = rules()
    by_votes = counted.select(*[v.cast("int").alias(k) for k, v in votes.items()])
    return fitted(sorted((tuple(r[k] for k in votes), r["count"]) for r in by_votes.groupBy(*votes).count().collect()), len(votes))


def report(docs: DataFrame) -> DataFrame:
    """rule, accuracy, its chances of a bad vote on a good and on a bad document, and how many times its evidence is told."""
    found = fit(signals(docs))
    rows = list(zip(rules(), found.accuracies(), found.chances[1, :, 0].tolist(), found.chances[0, :, 0].tolist(), found.told.tolist(), strict=True))
    return docs.sparkSession.createDataFrame(rows, "rule string, accuracy double, bad_if_good double, bad_if_bad double, told double")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, posterior and kept of every document."""
    counted = common.checkpointed(signals(docs))
    found = fit(counted)
    odds = F.lit(found.base)
    for v, w in zip(rules().values(), found.weights, strict=True):
        odds = odds + F.when(v == 1, w[1]).when(v == -1, w[-1]).otherwise(w[0])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        failed.alias("base_failed"),
        (1 / (1 + F.exp(-odds))).alias("posterior"),
        (~failed & (odds >= 0)).alias("kept"),
    )
