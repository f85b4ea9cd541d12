"""SimHash fingerprints and their groups, found by the generalised pigeonhole principle.

The 64 bits are dealt into parts, correlated bits together.  If part i is given a threshold t_i >= -1 and the thresholds
add up to MAX_BITS - (parts - 1), two fingerprints within MAX_BITS bits differ in at most t_i bits of some part i with
t_i >= 0.  Dynamic programming picks the thresholds, and a comparison the number of parts, that cost least by the counts
of signatures and of candidate pairs estimated from how often each bit is set among all fingerprints.  A signature of
part i keeps its bits but t_i of them; fingerprints probe the buckets of their signatures, and candidates are verified by
the bits of their exclusive or.  A bucket is verified in blocks of BLOCK fingerprints by BLOCK, each pair of blocks in a
task of its own choice, and gives a spanning forest of its links, not all pairs.  Components of the forests come from
alternating large-star and small-star rounds.

Defined results: a null or empty text and one without words has fingerprint zero, which links like any other; equal texts
have equal fingerprints and one row in the search, so copies are never paired; repeated rows each get a row; the component
of rows whose doc_ids are all null has a null id, and a null id is never the smallest; an empty table gives no rows; other
columns aren't read, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.operators.graph import components

SHINGLE, SEED, BITS, MAX_BITS = 4, 42, 64, 4
BLOCK = 512
#: What a signature row costs, in units of a verified pair.
SIGNATURE_COST = 300.0
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str) -> np.ndarray:
    data = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return np.empty(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    if len(gaps) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(data, SEED)], np.uint64)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist()[SHINGLE - 1 :], len(data)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(data[a:b], SEED) for a, b in zip(starts, ends, strict=False)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    out, cuts = 0, np.arange(0, len(hashes), 255)
    for j in range(8 if len(hashes) else 0):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & LANES, cuts)  # eight counts of a byte each
        for k, n in enumerate(lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64).tolist()):
            if 2 * n > len(hashes):
                out |= 1 << (8 * k + j)
    return out


def digest_of(text: F.Column) -> F.Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, fp: the fingerprint of every whole text as a signed long; with digest, also the digest of the text."""
    more = ["digest"] if digest else []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([majority(shingle_hashes(t or "")) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64)), *[batch.column(c) for c in more]], ["doc_id", "fp", *more])

    text = F.col("text").cast("string")
    return common.by_batch(docs.select(F.col("doc_id").cast("long"), text, *[digest_of(text).alias(c) for c in more]), run, "doc_id long, fp long" + "".join(f", {c} string" for c in more))


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and of those that have bits i and j set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        rows = [(i, j, int(both[i, j])) for i in range(BITS) for j in range(i, BITS)] + [(-1, -1, n)]
        yield pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)], ["i", "j", "n"])

    rows = nodes.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS, BITS))
    total = 0
    for r in rows:
        if r["i"] < 0:
            total = r["n"]
        else:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    return total, both


def parts_of(total: int, both: np.ndarray, count: int) -> list[list[int]]:
    """The bits in as many parts, each grown from the bit that is most correlated with the rest by those most correlated with it."""
    p = both.diagonal() / max(total, 1)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(total, 1) - np.outer(p, p)) / np.outer(deviation, deviation)
    free, out = set(range(BITS)), []
    for k in range(count):
        room = math.ceil(len(free) / (count - k))
        order = sorted(free)
        part = [max(order, key=lambda b: related[b, order].sum())]
        while len(part) < room:
            part.append(max((b for b in order if b not in part), key=lambda b: related[b, part].sum()))
        free -= set(part)
        out.append(sorted(part))
    return out


def estimated_costs(total: int, chances: list[float]) -> list[float]:
    """The cost of a part by its threshold, from 0 to MAX_BITS; chances: of two fingerprints to differ, by bit."""
    differ = np.array([1.0])
    for q in chances:
        differ = np.convolve(differ, [1 - q, q])
    w = len(chances)
    out = []
    for t in range(MAX_BITS + 1):
        if t > w:
            out.append(math.inf)
            continue
        pairs = total * (total - 1) / 2 * sum(differ[d] * math.comb(w - d, t - d) for d in range(t + 1))
        out.append(SIGNATURE_COST * total * math.comb(w, t) + pairs)
    return out


def allocated(total: int, both: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """Parts and their thresholds of least estimated cost."""
    p = both.diagonal() / max(total, 1)
    best = (math.inf, [], [])
    for count in range(2, MAX_BITS + 3):
        parts = parts_of(total, both, count)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by the sum of thresholds so far, each counted from -1
        for part in parts:
            costs = [0.0, *estimated_costs(total, [2 * p[b] * (1 - p[b]) for b in part])]
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in states.items():
                for t, c in enumerate(costs):
                    if used + t <= MAX_BITS + 1 and cost + c < new.get(used + t, (math.inf,))[0]:
                        new[used + t] = (cost + c, [*chosen, t - 1])
            states = new
        if MAX_BITS + 1 in states and states[MAX_BITS + 1][0] < best[0]:
            best = (states[MAX_BITS + 1][0], parts, states[MAX_BITS + 1][1])
    return best[1], best[2]


def signature_masks(parts: list[list[int]], thresholds: list[int]) -> list[int]:
    """For each signature, the bits that it keeps, as signed longs."""
    out = []
    for part, t in zip(parts, thresholds, strict=True):
        if t >= 0:
            out += [sum(1 << b for b in part) - sum(1 << b for b in left) for left in combinations(part, t)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def forest(values: np.ndarray, own: np.ndarray | None) -> list[tuple[int, int]]:
    """Edges that connect what links within MAX_BITS bits connect; own: which values are of the first block, if there are two: then only links between the blocks count."""
    linked = np.bitwise_count(values[:, None] ^ values[None, :]) <= MAX_BITS
    if own is not None:
        linked &= own[:, None] != own[None, :]
        np.fill_diagonal(linked, True)
    if linked.sum() == len(values):
        return []
    label = np.arange(len(values))
    while True:
        new = np.where(linked, label[None, :], len(values)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    signed = values.view(np.int64)
    return [(int(signed[i]), int(signed[label[i]])) for i in range(len(values)) if label[i] != i]


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the buckets in batches of rows sorted by bucket (signature, value, low, high)."""
    held: list[np.ndarray] = []

    def edges(rows: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        out = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)], strict=True):
            if b - a > 1:
                part = np.unique(rows[a:b, 4:], axis=0)
                values = np.ascontiguousarray(part[:, 0]).view(np.uint64)
                out += forest(values, None if rows[a, 2] == rows[a, 3] else part[:, 1] == rows[a, 2])
        return out

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(c).to_numpy() for c in ("signature", "value", "low", "high", "fp", "block")], axis=1)
        same = (rows[:, :4] == rows[-1, :4]).all(axis=1)
        last = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0  # where the last bucket of the batch starts
        if last:
            whole = np.concatenate([*held, rows[:last]])
            held = [rows[last:]]
            if found := edges(whole):
                yield batch_of(found)
        else:
            if held and (held[-1][-1, :4] != rows[0, :4]).any():
                if found := edges(np.concatenate(held)):
                    yield batch_of(found)
                held = []
            held.append(rows)
    if held and (found := edges(np.concatenate(held))):
        yield batch_of(found)


def links(nodes: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints, enough to connect all that links within MAX_BITS bits connect; nodes has a column fp of distinct ones."""
    common.ready_for_python(nodes.sparkSession)
    total, both = bit_counts(nodes)
    masks = signature_masks(*allocated(total, both))
    probes = nodes.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("signature", "mask")).select("fp", F.col("signature").cast("long").alias("signature"), F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    sizes = probes.groupBy("signature", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written before it's joined, so that the join can split a large bucket.
    sizes = common.checkpointed(sizes.select("signature", "value", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")))
    dealt = probes.join(sizes, ["signature", "value"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("signature", "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "fp", "block")
    bucket = ["signature", "value", "low", "high"]
    return dealt.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(verified, "a long, b long")


def by_print(prints: DataFrame) -> DataFrame:
    """fp, root, component_id of every distinct fingerprint: the fingerprint that names its group, and the group's smallest doc_id."""
    nodes = common.checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = common.checkpointed(components(links(nodes)).withColumnRenamed("node", "fp"))
    members = found.unionAll(found.select(F.col("root").alias("fp"), "root").distinct())
    least = common.checkpointed(members.join(nodes, "fp").groupBy("root").agg(F.min("least").alias("id")))
    grouped_ = members.join(least, "root").select("fp", "root", "id", F.lit(True).alias("linked"))
    # Written before it's joined, so that the join can split the rows of a fingerprint that very many have.
    return common.checkpointed(nodes.join(grouped_, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("linked"), F.col("id")).otherwise(F.col("least")).alias("component_id")))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    prints = common.checkpointed(fingerprints(docs))
    return prints.join(by_print(prints), "fp").select("doc_id", "fp", "component_id")


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id."""
    return grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """docs with one row of each group: the one of the smallest doc_id, null last, then of the least digest of its text.

    Rows are told apart by doc_id and text, so that rows of different groups that share a doc_id, or have none, each stay for their
    group.  Of rows equal in both, the one whose further columns are least, written as JSON, stays.
    """
    prints = common.checkpointed(fingerprints(docs, digest=True))
    texts = prints.groupBy("doc_id", "digest", "fp").agg(F.count(F.lit(1)).alias("n"))
    rows = texts.join(by_print(prints), "fp")
    least = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "n")).alias("of"))
    kept = common.checkpointed(least.select(F.col("of.doc_id").alias("__id"), F.col("of.digest").alias("__kept"), F.col("of.n").alias("__copies")))
    own = docs.withColumn("__digest", digest_of(F.col("text"))).join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept")))
    several = own.filter("__copies > 1")
    if several.isEmpty():
        return own.select(*[f"`{c}`" for c in docs.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    more = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    one = several.groupBy("__id", "__digest").agg(F.min_by(row, more).alias("row")).select("row.*")
    return own.filter("__copies = 1").select(*[f"`{c}`" for c in docs.columns]).unionByName(one)
