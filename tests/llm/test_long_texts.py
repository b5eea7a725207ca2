"""Long texts in pieces, with bounded memory; large components of vectors."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from changegrid.llm import langid, topk, toxicity, words

RNG = random.Random(11)
TEXT = " ".join(RNG.choice(["Der", "hund", "äpfel", "THE", "dog", "x" * 30, "les", "chats-noirs", "1234567", "\n"]) for _ in range(4000))


def model():
    table = np.random.default_rng(1).integers(0, 8, (1 << 12, 1)).astype(np.uint64)
    return langid.Filter(["a", "b", "c"], table, 0)


def machine():
    buckets = np.sort(np.random.default_rng(2).choice(1 << toxicity.BITS, 1 << (toxicity.BITS - 1), replace=False))
    return toxicity.Machine(buckets, 0.0, np.zeros(len(buckets)), np.zeros((len(buckets), 2)))


def counts(texts):
    return [model().scores(data, offsets) for _, _, data, offsets in words.rounds(pa.array(texts), prepare=langid._padded)]


def test_language_scores_of_pieces(monkeypatch):
    """A text alone, in pieces or not, scores as it does among others."""
    whole = counts([TEXT])[0][0]
    assert np.allclose(counts(["some other text", TEXT, ""])[0][1], whole)
    monkeypatch.setattr(langid, "ROUND_BYTES", 61)
    assert np.allclose(counts([TEXT])[0][0], whole)


def test_toxic_terms_of_pieces(monkeypatch):
    """Each text's different terms, whatever the pieces; a text that is white space for a long stretch too."""
    texts = pa.array(["short one", TEXT, None, " " * 5000 + "late word", TEXT[:700]])

    def found():
        out = {}
        for row, _, text, at in machine().sparse(texts, machine().slots()):
            for t, a in zip(text.tolist(), at.tolist(), strict=True):
                out.setdefault(row + t, set()).add(a)
        return out

    whole = found()
    monkeypatch.setattr(words, "ROUND_BYTES", 300)
    assert found() == whole and len(whole[1]) > 5


@pytest.mark.parametrize("read", [lambda t: counts(t), lambda t: [len(x[3]) for x in machine().sparse(pa.array(t), machine().slots())]])
def test_memory_of_a_long_text(read):
    """50 MB of text: some copies of the text, not some hundred bytes a character."""
    text = (TEXT + " ") * (50_000_000 // len(TEXT.encode()))
    tracemalloc.start()
    read([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 450e6


def exact(a, b):
    return [[max(1 - (1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(r, s, strict=True)))) for s in b] for r in a]


def test_products_of_large_components():
    """Every finite component: up to the largest double, outliers among small ones, sums that cancel beyond a long."""
    rng = np.random.default_rng(3)
    a, b = (np.floor(rng.normal(0, 300, (20, 16))) for _ in range(2))
    a[3, 5], a[4] = 1.7e308, np.floor(rng.normal(0, 1e9, 16))
    b[2, 5], b[7, 0], b[9] = -1e300, 2.0**45, np.floor(rng.normal(0, 1e12, 16))
    a[11, :2], b[13, :2] = (2.0**40, 2.0**40), (2.0**40, -(2.0**40))
    assert topk._product(a, b).tolist() == exact(a, b)
    moderate = np.floor(rng.normal(0, 2.0**30, (9, 16)))
    assert topk._product(moderate, b).tolist() == exact(moderate, b)


def test_one_outlier_leaves_the_tile_alone(monkeypatch):
    """Only the outlier's row is worked out by Python's integers."""
    seen, full = [], topk._in_full
    monkeypatch.setattr(topk, "_in_full", lambda a, b: seen.append(len(a) * len(b)) or full(a, b))
    rng = np.random.default_rng(4)
    a, b = (np.floor(rng.normal(0, 300, (256, 32))) for _ in range(2))
    a[7] = 2.0**60
    topk._product(a, b)
    assert sum(seen) <= 256


def test_top_k_of_extreme_vectors(spark):
    rows = [(1, [1e307, 1.0]), (2, [1.0, 2.0]), (3, [-1e307, 1.0]), (4, [0.5, 0.25]), (5, [float("inf"), 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(table.where("vec_id = 2"), table, 5, scale=256.0).select("query_id", "rank", "id", "score").orderBy("rank").collect()]
    assert got == [(2, 1, 1, (1 << 63) - 1), (2, 2, 4, 128 * 256 + 64 * 512), (2, 3, 3, 1 - (1 << 63))]
