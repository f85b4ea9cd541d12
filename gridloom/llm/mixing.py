"""Mixing sources by temperature: weights are token shares to a power, realised as repeated passes over permuted documents.

A source's weight is its share of the tokens to the power of an exponent, normalised.  The exponent, of 0 to 1, is found by
bisection: the largest whose weights have the target entropy (a part of that of equal weights) and then, if a source would
be repeated more than max_repeats times, the least that keeps to the limit.  The budget is by default the least at which
no source is passed less than once, so no document is dropped; a given one may drop some.  A source's budget of tokens is
its weight times the whole; as many full passes as fit are made, and of one more pass the documents that come first in a
permutation by hash, as long as their tokens fit.  Where that pass is cut is found in blocks of the permutation: sums by
block and source, then by smaller block in the one that is cut, so no task orders a whole source.  Each copy is dealt to a
block of the mixture of about block_tokens tokens, where its pass and hash place it, so that each block has the weights.

Defined results: tokens are words; a null source counts as the empty one; a null text has no tokens; documents without
tokens are passed as often as their source is in full, at least once by the default budget; rows of equal source, doc_id
and text have equal hashes and are taken or left together; an empty table gives no rows; further columns are carried along
by mixed(), whatever their names.  Sources are collected to find the exponent: one row each of name and sum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import common

ENTROPY, MAX_REPEATS, BLOCK_TOKENS, SEED = 0.95, 4.0, 1_000_000, 42
#: Tables of a row for each source are broadcast up to so many sources.
BROADCAST_SOURCES = 10_000
#: Bits of a hash, and by how many each round narrows the block in which a pass is cut.
HASH_BITS, ROUND_BITS, ROUNDS = 63, 12, 2
SOURCE, PLACE, FULL, CUT, COPIES = "__mix_source", "__mix_place", "__mix_full", "__mix_cut", "__mix_copies"


def exponent(tokens: list[int], entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """The exponent for these sums of tokens by source."""
    total = sum(tokens)
    shares = [t / total for t in tokens if t > 0] if total else []
    if len(shares) < 2:
        return 1.0

    def has_entropy(a: float) -> bool:
        powers = [s**a for s in shares]
        z = math.fsum(powers)
        return -math.fsum(p / z * math.log(p / z) for p in powers) >= entropy * math.log(len(shares))

    def within_limit(a: float) -> bool:
        return (max(shares) / min(shares)) ** (1 - a) <= max_repeats

    low, high = 0.0, 1.0
    if not has_entropy(high):
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (middle, high) if has_entropy(middle) else (low, middle)
        high = low
    if not within_limit(high):
        low, high = high, 1.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (low, middle) if within_limit(middle) else (middle, high)
    return high


def targets(tokens: dict[str, int], entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS, budget: int | None = None) -> dict[str, int]:
    """The budget of tokens of each source."""
    total = sum(tokens.values())
    a = exponent([tokens[s] for s in sorted(tokens)], entropy, max_repeats)
    powers = {s: (tokens[s] / total) ** a if tokens[s] else 0.0 for s in sorted(tokens)}
    z = math.fsum(powers.values()) or 1.0
    if budget is None:
        # At the least budget the source with the most tokens for its weight, which is the largest, is passed once.
        largest = max(tokens, key=lambda s: (tokens[s], s))
        return {s: max(t, math.floor(powers[s] / (powers[largest] or 1.0) * tokens[largest])) for s, t in tokens.items()}
    return {s: math.floor(powers[s] / z * budget) for s in tokens}


def source_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["source"].cast("string"), F.lit(""))


def place_of(docs: DataFrame, salt: Column | None = None) -> Column:
    """A document's place in a permutation: a hash of HASH_BITS bits."""
    return F.xxhash64(F.lit(SEED) if salt is None else salt, docs["doc_id"].cast("long"), docs["text"].cast("string"), source_of(docs)).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def passes(slim: DataFrame, **limits) -> tuple[DataFrame, int, bool]:
    """Rows (source, full passes, last place that is taken once more), the tokens of the whole mixture, and whether such rows are few enough to be broadcast; slim: (source, place, tokens)."""
    spark = slim.sparkSession
    sums = {r[SOURCE]: r["tokens"] for r in slim.groupBy(SOURCE).agg(F.sum("tokens").alias("tokens")).collect()}
    want = targets(sums, **limits) if sums else {}
    few = len(sums) <= BROADCAST_SOURCES
    rows = [(s, want[s] // t if t else 1, want[s] % t if t else 0) for s, t in sorted(sums.items())]
    left = spark.createDataFrame(rows, f"{SOURCE} string, {FULL} long, rest long")
    found, within = left.withColumn(CUT, F.lit(-1).cast("long")).withColumn("low", F.lit(0).cast("long")), slim
    for k in range(1, ROUNDS + 1):
        # Sums by block; the blocks that fit as a whole are taken, and the next one is looked into.
        size = 1 << (HASH_BITS - k * ROUND_BITS)
        within = within.join(hinted(found.select(SOURCE, "low"), few), SOURCE).filter((F.col(PLACE) - F.col("low")).between(0, (size << ROUND_BITS) - 1)).drop("low")
        found = common.checkpointed(narrowed(found, within.groupBy(SOURCE, (F.col(PLACE) - F.pmod(F.col(PLACE), F.lit(size))).alias("start")).agg(F.sum("tokens").alias("tokens")), size))
    last = within.join(hinted(found.select(SOURCE, "low"), few), SOURCE).filter((F.col(PLACE) - F.col("low")).between(0, size - 1)).groupBy(SOURCE, F.col(PLACE).alias("start")).agg(F.sum("tokens").alias("tokens"))
    return hinted(common.checkpointed(narrowed(found, last, 1).select(SOURCE, FULL, CUT)), few), sum(want.values()), few


def narrowed(found: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """found with its rest, last place and low moved to the first block (start, tokens) that doesn't fit as a whole."""
    order = Window.partitionBy(SOURCE).orderBy("start")
    # Written by itself: else the partial sums of every task would meet where their source is.
    summed = common.checkpointed(blocks).withColumn("sum", F.sum("tokens").over(order)).join(found.select(SOURCE, "rest"), SOURCE)
    fits = F.col("sum") <= F.col("rest")
    by = summed.groupBy(SOURCE).agg(F.max(F.when(fits, F.col("sum"))).alias("taken"), F.max(F.when(fits, F.col("start") + (size - 1))).alias("end"), F.min(F.when(~fits, F.col("start"))).alias("next"))
    joined = found.join(by, SOURCE, "left")
    return joined.select(SOURCE, FULL, (F.col("rest") - F.coalesce("taken", F.lit(0))).alias("rest"), F.coalesce(F.greatest(CUT, "end"), CUT).alias(CUT), F.col("next").alias("low"))


def hinted(by_source: DataFrame, few: bool) -> DataFrame:
    """A table of a row for each source, to be broadcast if they're few: a large source then stays where it is."""
    return F.broadcast(by_source) if few else by_source


def slim_of(docs: DataFrame) -> DataFrame:
    tokens = F.size(common.words(docs["text"].cast("string"))).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), source_of(docs).alias(SOURCE), place_of(docs).alias(PLACE), tokens.alias("tokens"))


def with_copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (with SOURCE and PLACE) and the number of copies of each."""
    return rows.join(found, SOURCE).withColumn(COPIES, F.col(FULL) + (F.col(PLACE) <= F.col(CUT)).cast("long"))


def schedule(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, **limits) -> DataFrame:
    """A row for each copy: doc_id, source, epoch (the pass, from 0), block of the mixture, n_tokens."""
    slim = common.checkpointed(slim_of(docs))
    found, total, few = passes(slim, **limits)
    blocks = max(1, math.ceil(total / block_tokens))
    dealt = with_copies(slim, found).filter(f"{COPIES} > 0")
    of_source = dealt.groupBy(SOURCE).agg(F.sum(F.col(COPIES) * F.col("tokens")).alias("mixed"), F.sum("tokens").alias("own"))
    repeats = (F.greatest("mixed", F.lit(1)) / F.greatest("own", F.lit(1))).alias("repeats")
    dealt = dealt.join(hinted(of_source.select(SOURCE, repeats), few), SOURCE)
    rows = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col(COPIES) - 1)))
    # A full pass is permuted anew; the places of the last one are those that it was cut by.
    place = F.when(F.col("epoch") < F.col(FULL), F.xxhash64("epoch", PLACE).bitwiseAND(F.lit((1 << HASH_BITS) - 1))).otherwise(F.col(PLACE)) / F.lit(2.0**HASH_BITS)
    block = F.least(F.floor((F.col("epoch") + place) / F.col("repeats") * blocks), F.lit(blocks - 1))
    return rows.select("doc_id", F.col(SOURCE).alias("source"), "epoch", block.cast("long").alias("block"), F.col("tokens").alias("n_tokens"))


def mixed(docs: DataFrame, **limits) -> DataFrame:
    """docs with each row as often as the mixture has it."""
    found, _, _ = passes(common.checkpointed(slim_of(docs).drop("doc_id")), **limits)
    placed = with_copies(docs.withColumn(SOURCE, source_of(docs)).withColumn(PLACE, place_of(docs)), found).filter(f"{COPIES} > 0")
    copies = placed.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
