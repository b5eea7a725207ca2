"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives P are labelled documents of quality 1; U is a draw of all documents, whatever their
label.  With class prior pi and logistic loss l, the model minimises

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)]),

stepping back along the negative part where it falls below zero.  Negative labels are never used.  pi is
the smallest ratio of U's to P's mass over upper score ranges of a first model: ranges where negatives
are rare have little but positives in them.

A document is described by shares of character classes, word-length and repetition statistics of its
whole text; each statistic is a one-hot of quantile bins, so the model is a sum of step functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changegrid.llm.langid import held_out
from changegrid.llm.words import Words, rounds

BINS = 12
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".,;", "shout": b"!?", "mark": b"%&$#*@^~=+<>", "bar": b"|", "quote": b"\"'`()[]{}", "rule": b"-_/\\:", "line": b"\n"}
FEATURES = [*_CLASSES, "wide", "space", "words", "length", "length_sd", "long", "repeat", "distinct", "shouted", "marked", "short_lines"]


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """FEATURES of each text, one row a text; empty texts have zeros."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    size = np.maximum(1, np.diff(offsets)).astype(np.float64)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
        return total[words.first[1:]] - total[words.first[:-1]]

    columns = [per_text(_table(c)[data]) / size for c in _CLASSES.values()]
    columns += [per_text(data >= 128) / size, per_text(_table(b" \t")[data]) / size]
    count = np.diff(words.first)
    some = np.maximum(1, count).astype(np.float64)
    length = (words.ends - words.starts).astype(np.float64)
    mean = per_word(length) / some
    hashes = words.hashes()
    text = np.repeat(np.arange(n), count)
    same = np.zeros(len(hashes), bool)
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((hashes, text))
    new = np.ones(len(hashes), bool)
    if len(hashes):
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[1:] != text[:-1])
    first, last = (data[words.starts], data[words.ends - 1]) if len(hashes) else (data[:0], data[:0])
    upper = _table(_CLASSES["upper"])
    lines = per_text(_table(b"\n")[data]) + 1
    distinct = np.bincount(text, new, n) if len(hashes) else np.zeros(n)
    columns += [np.log1p(count), mean, np.sqrt(np.maximum(0, per_word(length**2) / some - mean**2)), per_word(length > 20) / some, per_word(same) / some]
    # the share of distinct words falls with length; Heaps' exponent makes it comparable
    columns += [np.log1p(distinct) / np.maximum(1.0, np.log1p(count)), per_word(upper[first] & upper[last]) / some, per_word(_table(_CLASSES["mark"] + _CLASSES["shout"] + _CLASSES["bar"])[last]) / some, lines / some]
    return np.stack(columns, 1)


def _one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column numbers of the bins: (rows, features)."""
    at = np.stack([np.searchsorted(edges[j], x[:, j], "right") for j in range(x.shape[1])], 1)
    return at + np.arange(x.shape[1]) * (edges.shape[1] + 1)


@dataclass
class Model:
    edges: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        g = self.bias + self.weights[_one_hot(x, self.edges)].sum(1)
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _sum_rows(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at.ravel(), np.repeat(values, at.shape[1]), size)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 400, rate: float = 0.1, decay: float = 1e-4, slack: float = 0.97) -> Model:
    """Fits nnPU on feature rows; estimates the prior where it is not given.

    The estimate bounds the prior from above, and too high a prior leaves clear negatives among the
    positives, so it is lowered by ``slack``.  Without positives or unlabelled rows every score is the prior (1 if not given).
    """
    if not len(positive) or not len(unlabelled):
        p = 1.0 if prior is None else prior
        return Model(np.zeros((len(FEATURES), 1)), np.zeros(2 * len(FEATURES)), 30.0 if p >= 1 else float(np.log(p / (1 - p))), p)
    both = np.concatenate((positive, unlabelled))
    # quantiles resolve the bulk, equal widths the ends of the range, where junk lies
    low, high = np.quantile(both, [0.002, 0.998], axis=0)
    widths = low[:, None] + (high - low)[:, None] * np.linspace(0, 1, BINS + 1)[None, 1:-1]
    edges = np.sort(np.concatenate((np.quantile(both, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T, widths), 1), 1)
    ap, au = _one_hot(positive, edges), _one_hot(unlabelled, edges)
    if prior is None:
        # one half fits the first model, the other, whose scores carry no overfit, gives the masses
        first = _descend(ap[::2], au[::2], edges, 0.5, steps // 2, rate, decay)
        prior = slack * estimate_prior(first.score(positive[1::2]), first.score(unlabelled[1::2]))
    return _descend(ap, au, edges, prior, steps, rate, decay)


def _descend(ap: np.ndarray, au: np.ndarray, edges: np.ndarray, prior: float, steps: int, rate: float, decay: float) -> Model:
    size = edges.shape[0] * (edges.shape[1] + 1)
    w = np.zeros(size + 1)
    m, v = np.zeros(size + 1), np.zeros(size + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(at, slope):
        return np.append(_sum_rows(at, slope, size), slope.sum()) / len(at)

    for t in range(1, steps + 1):
        gp, gu = w[-1] + w[ap].sum(1), w[-1] + w[au].sum(1)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        down = gradient(au, sigmoid(gu)) - prior * gradient(ap, sigmoid(gp))
        grad = prior * gradient(ap, sigmoid(gp) - 1) + down if negative >= 0 else -down
        grad += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(edges, w[:-1], float(w[-1]), prior)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.5) -> float:
    """Smallest ratio of unlabelled to positive mass above a score, over scores with ``least`` of the positives above."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 60))
    ratios = [(unlabelled >= c).mean() / (positive >= c).mean() for c in cuts]
    return float(np.clip(min(ratios), 0.02, 0.98))


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, x array<double>)``: FEATURES of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in rounds(batch.column("text")):
                x = describe(data, offsets)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, to - row), lists], names=["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def drawn(ids: DataFrame, col: str, bound: int, salt: int = 0) -> DataFrame:
    """About ``bound`` of the rows at most, drawn by the hash of ``col``: the same ones in every run."""
    share = min(1.0, bound / max(1, ids.count()))
    return ids.where(F.pmod(F.xxhash64(F.col(col), F.lit(salt)), F.lit(1 << 24)) < int(share * (1 << 24)))


def train(docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 15000) -> Model:
    """Fits on about ``sample_docs`` trusted positives and as many documents drawn from all.

    ``positives`` holds ids under ``id_col``.  The drawn ids are few by construction, so they are sent to
    the tasks, and no text is shuffled; the driver receives their statistics only.
    """
    trusted = F.broadcast(drawn(positives.select(id_col).where(F.col(id_col).isNotNull()).distinct(), id_col, sample_docs))
    p = features(docs.join(trusted, id_col, "left_semi"), id_col, text_col).select("x").toArrow()
    u = features(drawn(docs, id_col, sample_docs, salt=1), id_col, text_col).select("x").toArrow()

    def matrix(t: pa.Table) -> np.ndarray:
        return t["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) if len(t) else np.zeros((0, len(FEATURES)))

    return fit(matrix(p), matrix(u))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(id, *keep, score)`` for every row, empty and null texts too; ties in the text have equal scores.

    Whole texts are read; repeated rows and null ids get a row each; an empty table gives no rows; extra columns but
    those in ``keep`` are ignored, whatever their names.
    """
    chosen = docs.select(F.col(id_col).alias("id"), *keep)
    out = T.StructType([*chosen.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in rounds(batch.column(batch.num_columns - 1)):
                kept = [c.slice(row, to - row) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.score(describe(data, offsets)))], names=out.names)

    return docs.select(F.col(id_col).alias("id"), *keep, F.col(text_col).alias("_text")).mapInArrow(run, out)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))))
    found = score(docs, model)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
