"""Toxicity scores of a factorization machine over hashed terms.

Terms are lower-cased words without their outer punctuation, hashed into a fixed
number of buckets. The machine has a bias, a weight for each bucket and a short
vector for each bucket; the product of two vectors is what a pair of terms adds
beyond its weights, for instance an insult beside the name of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import fold, record_batch, small_batches, unused

#: Stripped from both ends of a word.
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\`~+=^@"


@dataclass(frozen=True)
class FactorizationMachine:
    """A trained model: the buckets it uses, in order, and their parameters."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, owner: np.ndarray, term: np.ndarray, texts: int) -> np.ndarray:
        """Probability of label 1 for each text; owner and term are its distinct known terms."""
        if not len(self.weights):
            return np.full(texts, _sigmoid(np.array(self.bias)))
        linear = np.bincount(owner, self.weights[term], texts)
        pairs = np.zeros(texts)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[term, f]
            total = np.bincount(owner, v, texts)
            pairs += total * total - np.bincount(owner, v * v, texts)
        return _sigmoid(self.bias + linear + pairs / 2)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class TermBuckets(dict):
    """Bucket of each word, remembered up to a bound; -1 for words that are only punctuation."""

    def __init__(self, width: int, bound: int = 400_000) -> None:
        super().__init__()
        self.width, self.bound = width, bound

    def __missing__(self, word: bytes) -> int:
        term = word.strip(EDGES)
        bucket = crc32(term) % self.width if term else -1
        if len(self) >= self.bound:
            self.clear()
        self[word] = bucket
        return bucket

    def of(self, text: str | None) -> set[int]:
        """Distinct buckets of a whole text."""
        found = set(map(self.__getitem__, set((text or "").lower().encode("utf-8", "surrogatepass").split())))
        found.discard(-1)
        return found


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, width: int) -> DataFrame:
    """Label and distinct hashed terms of labelled texts outside the held-out fold, about `sample` of them at most.

    Rows are taken by a hash of their id, so a rerun learns from the same ones, and
    texts of other ids are not read into Python. The share follows from the number
    of labels; below the bound every label is used. Hashed terms, not texts, are
    shuffled to the labels.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_known"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & (fold(F.col("_known"), 5) != 0))
    known = known.groupBy("_known").agg(F.max("label").alias("label"))
    share = min(1.0, sample / max(1, known.count()))

    def taken(doc_id: Column) -> Column:
        return (fold(doc_id, 5) != 0) & (F.pmod(F.xxhash64(doc_id), F.lit(1_000_000)) < int(share * 1_000_000))

    narrow = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    terms = term_table(narrow.filter(taken(F.col("_id"))), width)
    return terms.join(known.filter(taken(F.col("_known"))), F.col("id") == F.col("_known")).select("label", "terms")


def term_table(texts: DataFrame, width: int) -> DataFrame:
    """Distinct hashed terms of each text."""
    schema = pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.int32()))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = TermBuckets(width)
        for batch in small_batches(batches, "text"):
            terms = [sorted(buckets.of(t)) for t in batch.column("text").to_pylist()]
            yield record_batch(schema, batch.column("_id"), terms)

    return texts.mapInArrow(hashed, "id long, terms array<int>")


def telling_buckets(terms: DataFrame, texts: int, positive: int, least: int, most: int) -> list[int]:
    """The buckets whose presence tells most about the label, by chi-square over all labelled texts."""
    seen = (
        terms.select("label", F.explode("terms").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").cast("double").alias("n"), F.sum("label").cast("double").alias("k"))
        .filter(F.col("n") >= least)
    )
    expected = F.col("n") * (positive / texts)
    spread = expected * (1 - positive / texts) * (1 - F.col("n") / texts)
    chi = (F.col("k") - expected) * (F.col("k") - expected) / F.greatest(spread, F.lit(1e-9))
    # a value that chance reaches once in a million terms carries no signal
    best = seen.select("bucket", chi.alias("chi")).filter("chi >= 24").orderBy(F.desc("chi"), "bucket").limit(most)
    return sorted(r.bucket for r in best.collect())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = 20_000,
    width: int = 1 << 20,
    terms: int = 2048,
    factors: int = 4,
    rounds: int = 300,
) -> FactorizationMachine:
    """Learn from labelled texts outside the held-out fold.

    `sample` bounds the labelled texts and `terms` the buckets used, so what comes to
    the driver is at most sample * terms bits, and far less in practice. Training is
    gradient descent over all of it at once with a fixed start, so the same rows
    give the same model. Without labels, or with one class only, the model is its
    bias.
    """
    found = learning_rows(docs, labels, label, sample, width).cache()
    try:
        size, positive = found.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        if not 0 < positive < size:
            bias = np.log((positive + 0.5) / (size - positive + 0.5))
            return FactorizationMachine(np.zeros(0, np.int64), float(bias), np.zeros(0), np.zeros((0, factors)))
        buckets = telling_buckets(found, size, positive, 5, terms)
        used = F.array_intersect("terms", F.array(*map(F.lit, buckets)).cast("array<int>"))
        rows = found.select("label", used.alias("terms")).groupBy("label", "terms").agg(F.count("*").alias("n"))
        rows = sorted((r.label, list(r.terms), r.n) for r in rows.collect())
    finally:
        found.unpersist()
    return _descend(np.array(buckets, np.int64), rows, factors, rounds)


def _descend(buckets: np.ndarray, rows: list[tuple], factors: int, rounds: int) -> FactorizationMachine:
    """Logistic loss with weight decay, all rows in each step (Adam)."""
    label = np.array([r[0] for r in rows], float)
    count = np.array([r[2] for r in rows], float)
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    term = np.searchsorted(buckets, np.concatenate([np.array(r[1], np.int64) for r in rows] + [np.zeros(0, np.int64)]))
    start = np.random.default_rng(7)
    k = len(buckets)
    values = np.concatenate([[np.log(label @ count / (count.sum() - label @ count))], np.zeros(k), start.normal(0, 0.05, k * factors)])
    decay = np.concatenate([[0.0], np.full(k, 0.3), np.full(k * factors, 1.0)])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        model = FactorizationMachine(buckets, values[0], values[1 : k + 1], values[k + 1 :].reshape(k, factors))
        error = (model.score(owner, term, len(rows)) - label) * count
        slope = np.empty_like(values)
        slope[0] = error.sum()
        slope[1 : k + 1] = np.bincount(term, error[owner], k)
        for f in range(factors):
            v = model.vectors[:, f]
            rest = np.bincount(owner, v[term], len(rows))[owner] - v[term]
            slope[k + 1 + f :: factors] = np.bincount(term, error[owner] * rest, k)
        slope += decay * values
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        values = values - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return FactorizationMachine(buckets, float(values[0]), values[1 : k + 1], values[k + 1 :].reshape(k, factors))


def scored(docs: DataFrame, model: FactorizationMachine, width: int = 1 << 20, into: str = "_score") -> DataFrame:
    """All columns of `docs` and `into`, the probability of label 1 of each whole text.

    A column of `docs` of that name is replaced.

    Only the text is an input. A null or empty text gets the score of no terms.
    The model has at most a few thousand buckets and travels with the function.
    """
    docs = docs.drop(into)
    fields = docs.schema
    names = [f"_c{i}" for i in range(len(fields))]
    plain = docs.toDF(*names)
    text = names[[f.name for f in fields].index("text")]
    place = {int(b): i for i, b in enumerate(model.buckets)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = TermBuckets(width)
        for batch in small_batches(batches, text):
            found = [[place[b] for b in buckets.of(t) if b in place] for t in batch.column(text).to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
            term = np.array([sorted(x) for x in found if x] and np.concatenate([sorted(x) for x in found if x]), np.int64)
            values = model.score(owner, term, len(found))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*names, "_score"])

    typed = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields, strict=True))
    return plain.mapInArrow(score, f"{typed}, _score double").toDF(*fields.names, into)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    Repeated rows are scored each; a null id is not held out. An empty table gives
    no rows; a table of labels without rows gives every text the score 0.5.
    Columns other than doc_id and text are not read, labels only for fitting.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored(narrow, fit(docs, labels)).select(
        "doc_id",
        held.alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns whatever their names, whose text is not predicted toxic."""
    (mark,) = unused(docs.columns, "_score")
    return scored(docs, fit(docs, labels), into=mark).filter(F.col(mark) < 0.5).drop(mark)
