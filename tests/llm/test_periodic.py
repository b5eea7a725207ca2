"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from changegrid.llm import periodic, registry
from changegrid.llm.words import Words

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, exponent=4, least=6):
    """All runs as (start, length, period), period by period."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def nested(rng, depth, size, letters):
    if not depth:
        return [rng.choice(letters) for _ in range(rng.randint(1, size))]
    base, out = nested(rng, depth - 1, size, letters), []
    for _ in range(rng.randint(1, 3)):
        many = base * rng.randint(1, 9)
        out += many[: len(many) - rng.randint(0, min(len(many) - 1, len(base)))]
        if rng.random() < 0.5:
            out.append(rng.choice(letters))
        if rng.random() < 0.3:
            base = nested(rng, depth - 1, size, letters)
    return out[:400]


def of_texts(lists, **kwargs):
    raw = [" ".join(x).encode() for x in lists]
    words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw]))
    start, stop, q = periodic.runs_of_texts(words.hashes(), words.first, **kwargs)
    of = np.searchsorted(words.first, start, "right") - 1
    return [[(int(s - words.first[i]), int(e - s), int(p)) for s, e, p in zip(start[of == i], stop[of == i], q[of == i], strict=True)] for i in range(len(lists))]


@pytest.mark.parametrize("together", [50, 1 << 17])
def test_nested_runs(monkeypatch, together):
    monkeypatch.setattr(periodic, "TOGETHER", together)
    rng = random.Random(together)
    for _ in range(12):
        lists = [nested(rng, rng.randint(0, 3), rng.choice([1, 2, 3, 5, 9]), rng.choice(["a", "ab", "abc", "abcdefgh"])) for _ in range(40)] + [[]]
        assert of_texts(lists) == [brute(x) for x in lists]
    lists = [nested(rng, 2, 3, "ab") for _ in range(40)]
    assert of_texts(lists, exponent=6, least=20) == [brute(x, 6, 20) for x in lists]
    with pytest.raises(ValueError):
        of_texts([["a"] * 20], exponent=3)


def test_without_regions():
    """The matching itself finds the same runs when whole texts are searched."""
    rng = random.Random(4)
    for _ in range(60):
        w = nested(rng, 3, 4, "abc")
        codes = np.array([-1, *[ord(x) for x in w], -2])
        start, stop, q = periodic.runs_of(codes)
        assert [(int(s) - 1, int(e - s), int(p)) for s, e, p in zip(start, stop, q, strict=True)] == brute(w)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (1, 2, 255, 256, 257, 1000):
        values = rng.permutation(n)
        found = periodic.WaveletMatrix(values, n)
        lo = rng.integers(0, n, 200)
        hi = np.minimum(n, lo + rng.integers(1, n + 1, 200))
        x = rng.integers(0, n + 2, 200)
        below = found.below(lo, hi, x)
        assert below.tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(lo, hi, x, strict=True)]
        some = below < hi - lo
        successor = found.element(lo[some], hi[some], below[some])
        assert successor.tolist() == [int(min(v for v in values[a:b] if v >= y)) for a, b, y in zip(lo[some], hi[some], x[some], strict=True)]


def test_find_runs(spark):
    """Nulls, empty and very long texts, repeated and null ids, a clashing extra column."""
    rng = random.Random(8)
    long_words = [str(rng.randrange(10**6)) for _ in range(50_000)] * 5 + ["end"]
    texts = [None, "", "x", "a a\ta a  a a b", "a a a a a", "\n\n", "b " * 7 + "c d " * 6, "é è é è é è é è", " ".join(long_words)]
    rows = [(None if i == 3 else i, t, "r") for i, t in enumerate(texts)] + [(6, texts[6], "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {(r.id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic.find_runs(docs).collect()}
    want = set()
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        runs = brute(w) if len(w) < 1000 else [(0, 250_000, 50_000)]
        want.add((i, len(w), tuple(runs), collapse(w, runs)))
    assert got == want and periodic.find_runs(docs).count() == len(rows)
    assert periodic.find_runs(docs.where("doc_id > 99")).count() == 0


def test_op11(spark):
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op11_periodic_runs"](spark, DATA).collect()}
    want = {}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        w, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = brute(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        hashed = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(w, runs))]
        want[r.doc_id] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *hashed)
    assert got == want and any(v[0] for v in want.values())
