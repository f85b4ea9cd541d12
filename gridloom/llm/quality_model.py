"""A quality classifier: random-indexing word vectors pooled per document, then a small network with calibrated probabilities.

Words, and their shapes (letters told only by case), are hashed to ROWS rows.  Each row has a sparse ternary index vector of
SIZE entries; the context vector of a row is the sum of the index vectors of its neighbours in all texts, and its
word vector is the index vector plus the context vector at unit length.  A document is the mean vector of its words and of
their shapes, the share of words equal to the word before, and the logarithm of its length.  A network of two layers in
numpy is trained on them; a temperature, fitted on training rows held back from it, calibrates its probabilities.

Contexts are counted in every document; they need no labels.  The training set of the network and the temperature is bounded:
SAMPLE labelled documents at most, those of least hash among the ones whose doc_id the fold admits.  Index, context and network
are of fixed size; every document is scored whole.

Defined results: a null text counts as empty; an empty text is scored like any other; a doc_id with several labels has the
lowest; without labels of both classes the score is the share of label 1 in the training set, 0.5 if it's empty; a null
doc_id isn't held out and never trained on; repeated rows have equal scores; an empty table gives no rows; further columns
are carried along by scored(), whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common

ROWS, SIZE, SET_ENTRIES = 1 << 14, 48, 6
SAMPLE = 4000
#: Pairs of neighbours that are counted at once.
PAIRS = 1 << 18
HIDDEN, EPOCHS, BATCH, RATE, DECAY, HELD_BACK = 32, 40, 64, 3e-3, 1e-4, 5
#: Words whose rows a worker keeps.
KEPT_WORDS = 200_000
SCORE = "__quality_score"


def index_vectors() -> np.ndarray:
    """Sparse vectors of entries 1 and -1, the same wherever they're made."""
    random = np.random.default_rng(20)
    out = np.zeros((ROWS, SIZE), np.int32)
    where = random.random((ROWS, SIZE)).argsort(axis=1)[:, :SET_ENTRIES]
    np.put_along_axis(out, where, random.choice([-1, 1], where.shape).astype(np.int32), axis=1)
    return out


class Classes(dict):
    """For str.translate: the class of each character, found when it's first met."""

    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        self[code] = "X" if kind == "Lu" else "x" if kind[0] == "L" else "9" if kind[0] == "N" else chr(code)
        return self[code]


CLASSES, SEVERAL = Classes(), re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Runs of capitals become X, of other letters x, of numbers 9; a mark of several characters counts once."""
    return SEVERAL.sub(r"\1", word.translate(CLASSES))


_rows: dict[bytes, int] = {}


def rows_of(text: str | None) -> np.ndarray:
    """For each word its row plus ROWS times the row of its shape."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: at the characters 9 to 13 and the space
    known = _rows
    missing = set(words).difference(known)
    if missing:
        if len(known) + len(missing) > KEPT_WORDS:
            known.clear()
            missing = set(words)
        for w in missing:
            known[w] = zlib.crc32(w) % ROWS + ROWS * (zlib.crc32(b"shape " + shape(w.decode("utf-8", "surrogatepass")).encode("utf-8", "surrogatepass")) % ROWS)
    return np.array([known[w] for w in words], np.int64)


def features(text: str | None, vectors: np.ndarray) -> np.ndarray:
    packed = rows_of(text)
    n = len(packed)
    out = np.zeros(2 * SIZE + 2, np.float32)
    if n:
        for k, rows in enumerate((packed % ROWS, packed // ROWS)):
            total = np.zeros(SIZE, np.float64)
            for a in range(0, n, 100_000):  # bounds the memory that a long text takes
                total += vectors[rows[a : a + 100_000]].sum(axis=0, dtype=np.float64)
            out[k * SIZE : (k + 1) * SIZE] = total / n
        out[-2] = (packed[1:] == packed[:-1]).sum() / n
        out[-1] = np.log1p(n) / 10
    return out


@dataclass
class Model:
    """What scores a document: word vectors, the scale of features, two layers and a temperature."""

    vectors: np.ndarray
    constant: float | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    w1: np.ndarray | None = None
    b1: np.ndarray | None = None
    w2: np.ndarray | None = None
    b2: float = 0.0
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.array([features(t, self.vectors) for t in texts])
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def trained(vectors: np.ndarray, x: np.ndarray, y: np.ndarray) -> Model:
    """The network of least cross-entropy, by Adam, and its temperature."""
    if len(set(y.tolist())) < 2 or len(y) < 2 * HELD_BACK:
        return Model(vectors, constant=float(y.mean()) if len(y) else 0.5)
    random = np.random.default_rng(8)
    back = np.arange(len(y)) % HELD_BACK == 0
    fit, held = np.flatnonzero(~back), np.flatnonzero(back)
    model = Model(vectors, mean=x[fit].mean(axis=0), scale=x[fit].std(axis=0) + 1e-3)
    model.w1 = random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN))
    model.b1, model.w2 = np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), HIDDEN)
    moments = [[np.zeros_like(np.asarray(p, float)), np.zeros_like(np.asarray(p, float))] for p in (model.w1, model.b1, model.w2, model.b2)]
    scaled, step = (x - model.mean) / model.scale, 0
    for _ in range(EPOCHS):
        random.shuffle(fit)
        for a in range(0, len(fit), BATCH):
            xb, yb = scaled[fit[a : a + BATCH]], y[fit[a : a + BATCH]]
            inner = xb @ model.w1 + model.b1
            hidden = np.maximum(inner, 0)
            error = (sigmoid(hidden @ model.w2 + model.b2) - yb) / len(yb)
            back_ = np.outer(error, model.w2) * (inner > 0)
            step += 1
            new = []
            for p, g, m in zip((model.w1, model.b1, model.w2, model.b2), (xb.T @ back_ + DECAY * model.w1, back_.sum(axis=0), hidden.T @ error + DECAY * model.w2, error.sum()), moments, strict=True):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                new.append(p - RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8))
            model.w1, model.b1, model.w2, model.b2 = new
    z, t = model.logits(x[held]), y[held]
    loss = lambda temperature: np.logaddexp(0, np.where(t == 1, -z, z) / temperature).mean()
    model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return model


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the neighbours' index vectors by row, over the texts of a task."""
    index, total = index_vectors(), np.zeros(ROWS * SIZE)
    where = np.nonzero(index)[1].reshape(ROWS, SET_ENTRIES)
    sign = np.take_along_axis(index, where, axis=1).astype(float)

    def count(words: list[np.ndarray]) -> None:
        stream = np.concatenate(words)  # a negative word stands between texts
        for a in range(0, len(stream) - 1, PAIRS):
            left, right = stream[a : a + PAIRS], stream[a + 1 : a + PAIRS + 1]
            left = left[: len(right)]
            inside = (left >= 0) & (right >= 0)
            left, right = left[inside], right[inside]
            for x, y in ((left % ROWS, right % ROWS), (left // ROWS, right // ROWS)):
                for own, other in ((x, y), (y, x)):
                    total[:] += np.bincount((own[:, None] * SIZE + where[other]).ravel(), sign[other].ravel(), ROWS * SIZE)

    held, size = [], 0
    for b in batches:
        for text in b.column("text").to_pylist():
            held += [rows_of(text), np.array([-1])]
            size += len(held[-2]) + 1
            if size >= PAIRS:
                count(held)
                held, size = [], 0
    if held:
        count(held)
    sums = total.astype(np.int64).reshape(ROWS, SIZE)
    used = np.flatnonzero(sums.any(axis=1))
    yield pa.record_batch([pa.array(used), *[pa.array(sums[used, i]) for i in range(SIZE)]], ["row", *[f"d{i}" for i in range(SIZE)]])
    common.give_back()


def held_out(doc_id: F.Column) -> F.Column:
    """Whether the fold keeps a document from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the contexts in all documents and the labelled ones, sample of these at most; labels: (doc_id, quality)."""
    common.ready_for_python(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample is bounded, so it's broadcast; its texts are few, so a few tasks pool them.
    # Of a doc_id with several texts the one of the least hash is taken, so that the bound holds for rows too.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("rank", "doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = common.checkpointed(rows.repartition(8, "rank"))
    names = [f"d{i}" for i in range(SIZE)]
    sums = texts.select("text").mapInArrow(contexts, "row long, " + ", ".join(f"{n} long" for n in names)).groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    vectors = index_vectors().astype(np.float32)
    if len(sums):
        found = sums[names].to_numpy(np.float64)
        vectors[sums["row"].to_numpy()] += (found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t, shared.value).tolist() for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("rank"), batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.list_(pa.float32()))], ["rank", "doc_id", "quality", "x"])

    training = common.by_batch(rows.select("rank", "doc_id", "quality", "text"), pooled, "rank long, doc_id long, quality int, x array<float>").toPandas()
    training = training.assign(key=[tuple(v) for v in training["x"]]).sort_values(["rank", "doc_id", "key"])
    x = np.array(training["x"].tolist(), np.float64).reshape(len(training), 2 * SIZE + 2)
    return trained(vectors, x, training["quality"].to_numpy(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs and the column SCORE behind its own: the probability that quality is 1."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    plain = docs.withColumn(SCORE, F.col("text").cast("string"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.num_columns - 1
        return pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(shared.value.scores(batch.column(at).to_pylist()))], [*batch.schema.names[:at], SCORE])

    common.ready_for_python(spark)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield run(batch)
        common.give_back()

    return plain.mapInArrow(each, docs.withColumn(SCORE, F.lit(0.0)).schema)


def summary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    text_scores = scored(slim, fit(docs, labels))
    return text_scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(SCORE).alias("score"), (F.col(SCORE) >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier doesn't reject."""
    return scored(docs, fit(docs, labels)).filter(F.col(SCORE) >= 0.5).drop(SCORE)
