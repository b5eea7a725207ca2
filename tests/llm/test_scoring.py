"""Scores of op4 and op6 against plain loops over one text's n-grams and terms."""

import math
import random
import re

import numpy as np
import pyarrow as pa

from changegrid.llm import langid, toxicity, words

RNG = random.Random(21)
TEXTS = ["", "x", "Äpfel und Birnen!", "the dog, the DOG; the d0g", "1 2 3", None] + [" ".join(RNG.choice(["Idiot", "group", "les", "chats", "überall", "foo-bar", "zz9", "a"]) for _ in range(RNG.randint(1, 60))) for _ in range(30)]


def test_language_scores():
    """Every byte n-gram of the padded, lower-cased text is looked up by itself and corrected for false positives."""
    table = np.random.default_rng(5).integers(0, 16, (1 << 10, 1)).astype(np.uint64)
    model = langid.Filter(["a", "b", "c", "d"], table, 0)
    got = np.concatenate([model.scores(data, offsets) for _, _, data, offsets in words.rounds(pa.array(TEXTS), prepare=langid._padded)])
    for text, row in zip(TEXTS, got, strict=True):
        raw = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in f" {(text or '').lower()} ".encode())
        found, total = [0] * 4, 0
        for n in langid.SIZES:
            for i in range(len(raw) - n + 1):
                code = n
                for b in raw[i : i + n]:
                    code = (code << 8 | b) & ((1 << 64) - 1)
                first, second = (int(x[0]) for x in langid._places(np.array([code], np.uint64), 1 << 10))
                mask = int(table[first, 0]) & int(table[second, 0])
                total += 1
                for k in range(4):
                    found[k] += mask >> k & 1
        want = []
        for k in range(4):
            rate = (sum(int(v) >> k & 1 for v in table[:, 0]) / len(table)) ** 2
            want.append(max(0.0, (found[k] - rate * total) / (1 - rate)))
        assert np.allclose(row, want)


def one(term):
    """Buckets of a word and its beginnings, each hashed by itself."""
    data = np.frombuffer(term.encode(), np.uint8)
    return {int(b) for b in toxicity.terms(words.Words(toxicity._FOLD[data], np.array([0, len(data)])))[1]}


def test_toxicity_scores():
    """Bias, weights and every pair's inner product, over the different known terms of a text."""
    known = sorted({b for t in TEXTS for w in re.findall(r"[a-z0-9\x80-\U0010FFFF]+", (t or "").lower()) for b in one(w)})[::2]
    rng = np.random.default_rng(6)
    machine = toxicity.Machine(np.array(known), -0.3, rng.normal(0, 0.5, len(known)), rng.normal(0, 0.3, (len(known), 4)))
    got = np.full(len(TEXTS), np.nan)
    for row, to, text, at in machine.sparse(pa.array(TEXTS), machine.slots()):
        got[row:to] = machine.score(text, at, to - row)
    for text, score in zip(TEXTS, got, strict=True):
        held = sorted({known.index(b) for w in re.findall(r"[a-z0-9\x80-\U0010FFFF]+", (text or "").lower()) for b in one(w) if b in known})
        g = machine.bias + sum(machine.weights[i] for i in held) + sum(float(machine.factors[i] @ machine.factors[j]) for i in held for j in held if i < j)
        assert math.isclose(score, 1 / (1 + math.exp(-g)), rel_tol=1e-9)
