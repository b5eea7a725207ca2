"""The latent basis of the decontamination, against plain loops over all passages."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from changegrid.llm import decontaminate as D


def prose(rnd, vocabulary, n):
    return " ".join(rnd.choice(vocabulary) for _ in range(n))


def texts_of(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(900)]
    return [None, "", "!?", *(prose(rnd, vocabulary, rnd.randrange(1, 90)) for _ in range(n - 4)), prose(rnd, vocabulary, 700)]


def weights(texts):
    rng = np.random.default_rng(1)
    idf = np.zeros(1 << D.BITS)
    for _, _, _, hashes in D._read(pa.array(texts)):
        idf[D._bucket(hashes)] = 1.0
    return idf * rng.uniform(0.5, 3, 1 << D.BITS) * (rng.random(1 << D.BITS) < 0.7)


def passages(texts, idf):
    """All passages as rows of weights, as long as the root of their words' summed squared weights."""
    out = []
    for text in texts:
        for _, _, _, hashes in D._read(pa.array([text or ""])):
            bucket = D._bucket(hashes)
            for at in range(0, max(1, len(bucket) - D.HALF), D.HALF):
                row, own = np.zeros(1 << D.BITS), bucket[at : at + 2 * D.HALF]
                np.add.at(row, own, idf[own])
                if idf[own].any():
                    out.append(row / np.sqrt((idf[own] ** 2).sum()))
    return np.array(out)


def omega(width, seed):
    return np.concatenate([part for _, part in D.omega(width, seed)])


def test_memory_of_sums():
    """A task holds its terms and its sums, 27 MB each, and little besides."""
    idf = weights(texts_of(50))
    tracemalloc.start()
    own = D.Sketch(idf, D.RANK + D.OVER, 3)
    for _, _, words, hashes in D._read(pa.array(texts_of(500))):
        own.add(words, hashes)
    own.rows(0, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


def test_sums_of_runs():
    rng = np.random.default_rng(2)
    rows = rng.random((50, 7)).astype(np.float32)
    for top in (1, D.HALF, 5 * D.HALF, 40 * D.HALF):
        n = rng.integers(0, top + 1, 1200)
        pick, cut = rng.integers(0, 50, n.sum()), np.append(0, np.cumsum(n))
        got = D._sums(rows, pick, cut)
        assert np.allclose(got, [rows[pick[a:b]].sum(0) for a, b in zip(cut[:-1], cut[1:], strict=True)], rtol=1e-5)
    assert D._sums(rows, np.zeros(0, int), np.zeros(1, int)).shape == (0, 7)


def test_sums_of_all_rows(spark):
    """Every passage of every row is in the sums; a sample would miss some."""
    texts = texts_of(700)
    idf = weights(texts)
    a = passages(texts, idf)
    used = np.flatnonzero(a.any(0))
    want = a[:, used].T @ (a[:, used] @ omega(24, 3)[used]) / len(a)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    got = D.sketched(df, idf, 24, 3)
    assert np.allclose(got[used], want, atol=1e-5) and not np.delete(got, used, 0).any()


def test_basis_is_of_all_documents(spark):
    """The basis is that of a plain randomised SVD of all passages, held whole."""
    texts, items = texts_of(700), [t for t in texts_of(24, 6) if t]
    idf = weights(texts + items)
    basis = D.latent_basis(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame([(t,) for t in items], "text string"), idf, rank=40)
    a, b = passages(texts, idf), passages(items, idf)
    a, b = a * np.sqrt((1 - D.ITEM_SHARE) / len(a)), b * np.sqrt(D.ITEM_SHARE / len(b))
    both = np.concatenate((a, b))[:, idf > 0]
    q = np.linalg.qr(both @ omega(40 + D.OVER, 11)[idf > 0])[0]
    want = np.linalg.svd(q.T @ both, full_matrices=False)[2][:40].T
    basis = basis[idf > 0].astype(float)
    assert np.allclose(basis.T @ basis, np.eye(40), atol=1e-4)
    assert np.allclose(np.linalg.svd(basis.T @ want, compute_uv=False)[:38], 1, atol=1e-3)  # one space, but for the last values' order


def test_a_word_of_one_document_counts(spark):
    """A document among thousands changes the basis's sums wherever it stands."""
    texts = [t for t in texts_of(1500, 7) if t]
    odd = "xylophone quartz " * 12
    idf = weights([*texts, odd])
    idf[D._bucket(next(D._read(pa.array([odd])))[3])] = 2.0
    for at in (0, len(texts)):
        df = spark.createDataFrame([(t,) for t in [*texts[:at], odd, *texts[at:]]], "text string")
        assert D.sketched(df, idf, 8, 3)[D._bucket(next(D._read(pa.array([odd])))[3][:2])].all()
