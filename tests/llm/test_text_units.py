"""Byte-level BPE and importance resampling against the public library and brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from changegrid.llm import bpe, registry, resample, words

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_all(vocabulary, texts):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw])
    ids, first = vocabulary.encode(data, offsets)
    assert vocabulary.decode(ids).tobytes() == data.tobytes()
    return [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]


def test_bpe_slices(vocabulary, library):
    """Contractions, apostrophes in runs, white space of every kind, scripts and unassigned codepoints."""
    rng = random.Random(5)
    units = ["'", "s", "t", "r", "e", "v", "l", "d", "m", " ", "  ", "\n", "\t", "1", "22", "é", "字", "،", "　", " ", "\x85", "\x1c", "S", "!", "-", "😀", "ß", "٣", "́"]
    texts = ["".join(rng.choice(units) for _ in range(rng.randint(0, n))) for n in (1, 3, 8, 40, 400) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(50)) for _ in range(300)]
    texts += ["<|endoftext|> x", "", "a"]
    assert encode_all(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


def test_bpe_long_slices(vocabulary, library):
    rng = random.Random(6)
    texts = ["a" * 3000, "ab" * 4000, "".join(rng.choice("abcdefgh") for _ in range(20000)), " " * 4000, "".join(rng.choice("字漢語文日本") for _ in range(4000))]
    assert encode_all(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


def test_bpe_pieces(spark, vocabulary, library, monkeypatch):
    """A text longer than a round is cut where a slice begins anyway, also without any space."""
    rng = random.Random(7)
    spaced = " ".join(rng.choice(["don't", "we're", "x1", "字，字", "...", "\n\n"]) for _ in range(9000))
    solid = "".join(rng.choice(["字漢", "，", "ab", "12", "'s", "é"]) for _ in range(9000))
    data = np.frombuffer(spaced.encode(), np.uint8)
    for text in (spaced, solid):
        data = np.frombuffer(text.encode(), np.uint8)
        at, got = 0, []
        while at < len(data):
            end = vocabulary.cut(data, at + 500)
            assert end == len(data) or end < at + 20000
            got += vocabulary.encode(data[at:end], np.array([0, end - at]))[0].tolist()
            at = end
        assert got == library.encode_ordinary(text)
    assert vocabulary.cut(np.frombuffer(b"a" * 10000, np.uint8), 100) == 10000


def test_bpe_table(spark, vocabulary, library):
    """Nulls, empty and very long texts, repeated rows, null ids and a clashing extra column; offsets and decoding."""
    long_text = "word's  out\n" * 300_000  # over three rounds
    rows = [(1, "it's 12 café", "x"), (1, "it's 12 café", "x"), (None, None, "y"), (3, "", "z"), (4, long_text, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(docs, vocabulary)
    got = sorted(((r.id, r.ids, r.ends) for r in coded.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    for (i, t, _), (j, ids, ends) in zip(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), got, strict=True):
        assert i == j and ids == library.encode_ordinary(t or "")
        data = (t or "").encode()
        if len(data) < 1000:
            assert [data[a:b] for a, b in zip([0, *ends], ends, strict=False)] == [library.decode_single_token_bytes(x) for x in ids]
        assert (ends[-1] if ends else 0) == len(data)
    back = {(r.id, bytes(r.data)) for r in bpe.decode(coded, vocabulary, ends_col="ends").collect()}
    assert back == {(i, (t or "").encode()) for i, t, _ in rows}
    part = bpe.decode(coded.where("id = 1").select("id", F.slice("ids", 2, 2).alias("ids")), vocabulary).first()
    assert bytes(part.data) == b"".join(library.decode_single_token_bytes(x) for x in library.encode_ordinary("it's 12 café")[1:3])
    assert bpe.encode(docs.where("doc_id > 9"), vocabulary).count() == 0
    with pytest.raises(ValueError):
        bpe.Vocabulary([b"a"], bpe.codepoint_classes())


def test_op12(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op12_byte_bpe"](spark, DATA).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = {}
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert got == want


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_resample(docs, target, per_cent, least, most, seed):
    def features(text):
        w = WORD.findall(fold(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    held = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in held for b in f), Counter(b for x in target for b in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000))))
    rows = []
    for i, n, f in held:
        weight = math.floor(sum(gain(b) for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = len(able) * per_cent // 100
    rank = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return sorted(((r[0], *r[2:], rank.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("most", [1, 3])
def test_resample(spark, most):
    """Nulls, empty and long texts, repeated and null ids, ties and clashing names, against brute force."""
    rng = random.Random(most)
    vocabulary = ["Alpha", "beta", "GAMMA1", "délta", "x" * 70, "0", "ε", "it's"]
    rows = [(rng.randrange(-40, 40) if k % 11 else None, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))), 1) for k in range(300)]
    rows += [(1, None, 2), (2, "", 3), (rows[5][0], rows[5][1], 1), (9, "long beta " * 400_000, 4)]
    target = [" ".join(rng.choice(vocabulary[:3]) for _ in range(50)) for _ in range(5)] + [None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(5)
    got = resample.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), per_cent=30, most=most)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample([r[:2] for r in rows], target, 30, 20, most, 2024)
    none = docs.where("doc_id > 99")
    assert resample.resample(none, none).count() == 0


def test_resample_pieces(monkeypatch):
    """Runs of words of a text in pieces are counted once each."""
    import pyarrow as pa

    text = pa.array([" ".join(f"w{i % 97}" for i in range(2000))])
    want = [x for _, _, _, found, _ in resample._features(text, 3) for x in found]
    monkeypatch.setattr(words, "ROUND_BYTES", 300)
    got = [x for _, _, _, found, _ in resample._features(text, 3) for x in found]
    assert Counter(got) == Counter(want) and len(want) == 2000 + 1999 + 1998


def test_radix_ranks(spark):
    rows = spark.range(0, 9000, 1, 7).selectExpr("pmod(xxhash64(id), 500) - 250 as a", "pmod(xxhash64(id, 1), 1000000) * 9000000000000 - 4500000000000000000 as b", "id")
    got = resample.radix_ranks(rows, [F.col("a"), F.col("b")], block_rows=700).orderBy("rank").collect()
    assert [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got) and [r["rank"] for r in got] == list(range(1, 9001))
    assert resample.radix_ranks(rows.where("id < 0"), [F.col("a")]).count() == 0
    assert sorted(r["rank"] for r in resample.radix_ranks(rows.limit(50), [F.lit(3)]).collect()) == list(range(1, 51))


def test_crc32():
    rng = random.Random(2)
    found = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 5, 9, 40, 64, 65, 200]))) for _ in range(2000)]
    for held in (found, [w for w in found if len(w) <= 40]):
        ends = np.cumsum([len(w) for w in held])
        starts = ends - np.array([len(w) for w in held])
        assert resample.crc32(np.frombuffer(b"".join(held), np.uint8), starts, ends).tolist() == [zlib.crc32(w) for w in held]
