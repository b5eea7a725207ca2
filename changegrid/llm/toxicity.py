"""Toxicity: a factorisation machine over hashed terms.

Terms are the lower-cased words of a text and their beginnings of 4 and 5 bytes (so that unseen endings
of a known stem still count), hashed into ``1 << BITS`` buckets.  Document frequencies by label pick the
``VOCABULARY`` buckets that differ most between the classes; presence x of those is scored by

    g = w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2],

whose factors v learn pairs of terms (an insult with the mention of a group), which weights alone miss.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.llm.langid import held_out
from changegrid.llm.quality import drawn
from changegrid.llm.words import U, Words, by_text, mix, powers, word_rounds

BITS, VOCABULARY, RANK = 20, 4096, 4
#: Standard errors by which a bucket of the vocabulary deviates at least.
LEAST_DEVIATION = 4.0
STEMS = (4, 5)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[48:58] = np.arange(48, 58)


def read(texts: pa.Array) -> Iterator[tuple[int, int, Words, int]]:
    """Words of whole texts, in lower case; a long text comes in pieces."""
    return word_rounds(texts, table=_FOLD, prepare=pc.utf8_lower)


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every term of lower-cased texts; repeats stay."""
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = len(words.data)
    p, inv = powers(0x9E3779B97F4A7C15, size + 1)
    total = np.zeros(size + 1, U)
    np.cumsum((words.data.astype(U) + U(1)) * p[:size], out=total[1:])
    text = words.text()
    texts, buckets = [], []
    for size in (0, *STEMS):
        ends = words.ends if not size else words.starts + size
        long = np.ones(len(ends), bool) if not size else words.ends - words.starts >= size
        a, b = words.starts[long], ends[long]
        h = mix((total[b] - total[a]) * inv[a] + U(size * 0x1000193 + 1))
        texts.append(text[long])
        buckets.append((h >> U(64 - BITS)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(buckets)


@dataclass
class Machine:
    """Buckets of the vocabulary (sorted), bias, weights and factors."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def sparse(self, texts: pa.Array, slot: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row from, row to, text, place in the vocabulary) of each text's different terms."""

        def find(words: Words) -> tuple[np.ndarray, np.ndarray]:
            text, bucket = terms(words)
            at = slot[bucket]
            return text[at >= 0], at[at >= 0]

        return by_text(read(texts), find)

    def slots(self) -> np.ndarray:
        slot = np.full(1 << BITS, -1, np.int32)
        slot[self.buckets] = np.arange(len(self.buckets))
        return slot

    def score(self, row: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        g, _ = _raw(self.bias, self.weights, self.factors, row, at, n)
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _raw(bias, weights, factors, row, at, n) -> tuple[np.ndarray, np.ndarray]:
    g = bias + np.bincount(row, weights[at], n)
    sums = np.stack([np.bincount(row, factors[at, f], n) for f in range(factors.shape[1])], 1)
    squares = np.bincount(row, (factors[at] ** 2).sum(1), n)
    return g + 0.5 * ((sums**2).sum(1) - squares), sums


def fit(rows: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, rank: int = RANK, epochs: int = 200, rate: float = 0.05, decay: float = 2e-4, seed: int = 7) -> Machine:
    """Adam on the mean logistic loss over all rows; ``rows`` hold positions in ``buckets``."""
    size, n = len(buckets), len(rows)
    if not n or not size or labels.min() == labels.max():
        p = float(np.clip(labels.mean(), 0.001, 0.999)) if n else 0.0005
        return Machine(np.zeros(0, np.int64), float(np.log(p / (1 - p))), np.zeros(0), np.zeros((0, rank)))
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    at = np.concatenate(rows).astype(np.int64)
    w, b = np.zeros(size), float(np.log(labels.mean() / (1 - labels.mean())))
    v = np.random.default_rng(seed).normal(0, 0.05, (size, rank))
    params = [w, v, np.array([b])]
    means = [np.zeros_like(x) for x in params]
    powers2 = [np.zeros_like(x) for x in params]
    for t in range(1, epochs + 1):
        g, sums = _raw(params[2][0], params[0], params[1], row, at, n)
        slope = (1 / (1 + np.exp(-np.clip(g, -30, 30))) - labels) / n
        each = slope[row]
        own = params[1][at]
        inner = sums[row] - own
        grads = [
            np.bincount(at, each, size) + decay * params[0] / size**0.5,
            np.stack([np.bincount(at, each * inner[:, f], size) for f in range(rank)], 1) + decay * params[1] / size**0.5,
            np.array([slope.sum()]),
        ]
        for x, m, s, d in zip(params, means, powers2, grads, strict=True):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return Machine(buckets, float(params[2][0]), params[0], params[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = 20000) -> Machine:
    """Fits on about ``sample_docs`` labelled documents at most, drawn by the hash of their id.

    Drawn ids and labels are few by construction and are sent to the tasks; no text is shuffled.  Of
    repeated or conflicting labels the largest counts; null labels are left out.  The driver receives
    the vocabulary's counts and, for each drawn document, its positions in the vocabulary.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("label"))
    sample = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(drawn(known, id_col, sample_docs)), id_col).select("text", F.col("label").cast("int").alias("label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for row, to, text, where in by_text(read(batch.column("text")), terms):
                toxic = label[row:to][text] > 0
                names = np.unique(where)
                at = np.searchsorted(names, where)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.bincount(at, minlength=len(names))), pa.array(np.bincount(at, toxic, len(names)).astype(np.int64))], names=["bucket", "n", "toxic"])

    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    share = max(totals.toxic, 0) / max(totals.n, 1)
    # deviation of a bucket's toxic documents from what its frequency lets expect, in standard errors
    expected = F.col("n") * F.lit(float(share))
    deviation = F.abs(F.col("toxic") - expected) / F.sqrt(expected * F.lit(1 - share) + 1)
    top = sample.mapInArrow(count, "bucket long, n long, toxic long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where("n >= 3")
    top = top.where(deviation >= LEAST_DEVIATION).orderBy(deviation.desc(), "bucket").limit(VOCABULARY).select("bucket").toArrow()
    machine = Machine(np.sort(top["bucket"].to_numpy()), 0.0, np.zeros(0), np.zeros((0, RANK)))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = machine.slots()
        for batch in batches:
            for row, to, texts, at in machine.sparse(batch.column("text"), slot):
                cuts = np.searchsorted(texts, np.arange(to - row + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(row, to - row), pa.ListArray.from_arrays(cuts, pa.array(at.astype(np.int32)))], names=["label", "at"])

    found = sample.mapInArrow(positions, "label int, at array<int>").toArrow()
    rows = found["at"].combine_chunks()
    flat, cuts = rows.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False)))) if len(rows) else np.zeros(1, int)
    return fit([flat[cuts[i] : cuts[i + 1]] for i in range(len(rows))], (found["label"].to_numpy() > 0).astype(np.float64), machine.buckets)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row, empty and null texts too (they have no terms).

    Whole texts are read, long ones in pieces; repeated rows and null ids get a row each, equal texts equal scores; an empty
    table gives no rows; extra columns, whatever their names, are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        slot = machine.slots()
        for batch in batches:
            for row, to, texts, at in machine.sparse(batch.column("text"), slot):
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, to - row), pa.array(machine.score(texts, at, to - row))], names=["id", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = train(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)))
    found = score(docs, machine)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
