"""The corpus pipeline, stage by stage, against a brute-force version of what each stage keeps."""

import itertools
import math
import random
import re
from collections import defaultdict

import corpus_pipeline as pipeline
import xxhash
from pyspark.sql import functions as F
from test_llm import fingerprint

from changegrid.llm import quality, secrets
from changegrid.llm.langid import held_out
from changegrid.sources.staging import stage

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def classes(texts):
    """Smallest id of each text's class: fingerprints at most two bits apart, or Jaccard 0.8 of five-word shingles."""
    prints = {i: fingerprint(t) for i, t in texts.items()}
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        alike = len(x & y) >= 0.8 * len(x | y) if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) else False
        if alike or (prints[a] ^ prints[b]).bit_count() <= 2:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in texts}


def pareto_mix(docs, share=1.5, cycle=(3, 1, 2)):
    """(id, source, size) -> copies: targets by water-filling, then the lowest ratios of random to inclusion odds."""
    by = defaultdict(list)
    for d in docs:
        by[d[1]].append(d)
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total = {s: sum(d[2] for d in by[s]) for s in names}
    goal, left, open_ = {}, share * sum(total.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * total[s]}
        for s in full or open_:
            goal[s] = 2 * total[s] if full else level * weight[s]
        left -= sum(goal[s] for s in full)
        open_ -= full or open_
    out = {}
    for s in names:
        expected = min(goal[s] / total[s] if total[s] else 0.0, 2.0)
        whole = math.floor(expected)
        p = min(max(expected - whole, 1e-12), 1 - 1e-12)
        ranked = []
        for i, _, size in by[s]:
            out[i, s, size] = whole
            if whole < 2 and size > 0:
                h = xxhash.xxh64_intdigest(bytes(4), xxhash.xxh64_intdigest(str(i).encode(), 42))
                u = ((h >> 11) + 0.5) / 2**53
                ranked.append(((u / (1 - u)) / (p / (1 - p)), i, size))
        room, seen = goal[s] - whole * total[s], 0
        for _, i, size in sorted(ranked):
            seen += size
            out[i, s, size] += seen - size / 2 < room
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.select(pipeline.COLUMNS).collect())


def test_run(spark):
    """Every stage's rows, on the input that the stage before left, and the last one's as run() gives them."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.train(docs, labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))))
    good = {r.id for r in quality.score(docs, model).collect() if r.score >= 0.5}
    want = [r for r in rows_of(docs) if r[0] in good]
    fold = lambda t: f" {' '.join(re.findall(r'[^\W_]+', (t or '').lower()))} "
    items = [fold(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]

    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, DATA), "test")
        got = rows_of(docs)
        if name == "SimHash near-dedup":
            first = classes({r[0]: r[1] for r in want})
            want = [r for r in want if first[r[0]] == r[0]]
        elif name == "benchmark decontamination":
            want = [r for r in want if not any(x in fold(r[1]) for x in items)]
        elif name == "secret scans":
            redacted = []
            for i, text, *rest in want:
                spans = [x.split(":") for x in secrets.brute_force(text)[1].split(",") if x]
                clean, at = "", 0
                for kind, start, end in sorted(spans, key=lambda x: int(x[1])):
                    assert int(start) >= at
                    clean, at = clean + text[at : int(start)] + f"<{kind}>", int(end)
                clean += text[at:]
                redacted.append((i, clean, rest[0], rest[1], len(clean) if spans else rest[2]))
            want = redacted
        elif name == "mixing sources":
            copies = pareto_mix([(r[0], r[3], len(WORD.findall(r[1]))) for r in want])
            want = [r for r in want if copies[r[0], r[3], len(WORD.findall(r[1]))] > 0]
            assert all(r.copies == copies[r.doc_id, r.source, r["size"]] and r.taken == r.copies * r["size"] for r in docs.collect())
        assert got == sorted(want) and got, name
    assert rows_of(pipeline.run(spark, DATA)) == got


def test_stages_take_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "a b", "en", "s", 3), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0), (3, "key password=abcdefghijklmnop", "en", "s", 28), (3, "other words", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd, DATA)
        assert out.columns[:5] == pipeline.COLUMNS, name
        assert out.count() <= odd.count(), name
        assert stage(spark, odd.limit(0), DATA).isEmpty(), name
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "mixing sources"]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(n))


def test_rows_of_one_id_are_judged_apart(spark):
    rnd = random.Random(4)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first().text
    a, b, c, d, e = (prose(rnd, 80) for _ in range(5))
    # two unlike texts under a null id and under id 7; b also under 3, which stands for its class
    texts = [(None, a), (None, c), (7, b), (7, d), (3, b), (9, e), (9, e)]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_near_duplicates(spark, odd, DATA).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, a), (0, c), (7, d), (3, b), (9, e)])
    leaking = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [(None, a), (None, f"{c} {item} {d}"), (7, b), (7, f"{item} {e}")]], odd.schema)
    assert {(r.doc_id, r.text) for r in pipeline.drop_contaminated(spark, leaking, DATA).collect()} == {(None, a), (7, b)}


def test_quality_is_judged_by_row(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    whole = {r.text for r in pipeline.classify_quality(spark, docs, DATA).collect()}
    # labels need ids, so only unlabelled rows lose theirs
    labelled = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id")
    some = docs.where("text <> ''").join(labelled, "doc_id", "left_anti").withColumn("doc_id", F.lit(None).cast("long"))
    mixed = docs.join(labelled, "doc_id", "left_semi").unionByName(some)
    gone = mixed.where("doc_id IS NULL").count()
    left = pipeline.classify_quality(spark, mixed, DATA).where("doc_id IS NULL").count()
    assert whole and 0 < left < gone


def test_near_copies_beyond_two_bits_go(spark):
    rnd = random.Random(6)
    words = prose(rnd, 400).split()
    # each of 40 copies changes 4 of 400 words (Jaccard about 0.9); some 100 share every long band
    copies = []
    for k in range(120):
        mine = list(words)
        for at in rnd.sample(range(400), 4 if k < 40 else 1):
            mine[at] = prose(rnd, 1)
        copies.append(" ".join(mine))
    # half of the words are others' (Jaccard about 0.3): not a copy
    apart = " ".join(words[:200]) + " " + prose(rnd, 200)
    alone = prose(rnd, 60)
    texts = [*copies, apart, alone, alone.split()[0]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, DATA).orderBy("doc_id").collect()] == [0, 120, 121, 122]


def test_large_groups_of_near_copies_lose_no_link(spark, monkeypatch):
    """Crowded bands take the tiles' way: its classes are those of all pairs."""
    from changegrid.llm import simhash

    rnd = random.Random(8)
    base = prose(rnd, 60).split()
    texts, at = {}, 0
    for chain in range(4):  # chains: each text changes the one before, so the ends are far apart
        words = list(base)
        for k in rnd.sample(range(60), 4 * chain):
            words[k] = prose(rnd, 1)
        for _ in range(45):
            words = list(words)
            words[rnd.randrange(60)] = prose(rnd, 1)
            texts[at] = " ".join(words)
            at += 1
    want = classes(texts)
    assert 1 < len(set(want.values())) < 100
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", 3)
    monkeypatch.setattr(simhash, "TILE", 16)
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r.id: r.component for r in simhash.near_copies(docs).collect()}
    together = lambda cls: {(a, b) for a, b in itertools.combinations(texts, 2) if cls[a] == cls[b]}
    assert together(got) <= together(want) and len(together(got)) >= 0.99 * len(together(want))


def test_recall_of_near_copies_on_real_rows(spark):
    """Pairs of different five-word sets at Jaccard 0.8 or more, found by an exact prefix join of all documents."""
    from changegrid.llm import simhash

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.id: r.component for r in simhash.near_copies(docs).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    seen = defaultdict(int)
    for x in sets.values():
        for g in x:
            seen[g] += 1
    filed = defaultdict(list)
    for i, x in sets.items():
        for g in sorted(x, key=lambda g: (seen[g], g))[: len(x) - math.ceil(0.8 * len(x)) + 1]:
            filed[g].append(i)
    pairs = {p for held in filed.values() for p in itertools.combinations(held, 2)}
    near = [(a, b) for a, b in pairs if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert near and all(got[a] == got[b] for a, b in near)


def test_workers_get_small_batches(spark):
    """A stage hands texts to Python in small batches, whatever the session had before."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 3 * pipeline.BATCH_BYTES >> 16, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a bc "), 1 << 14).alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))])

    def sizes(batches):
        for batch in batches:
            yield type(batch).from_pydict({"n": [batch.nbytes]})

    try:
        for stage_of in (pipeline.drop_near_duplicates, pipeline.redact_secrets):
            spark.conf.set(key, str(1 << 26))
            stage_of(spark, texts, "").count()
            assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) <= pipeline.BATCH_BYTES + (1 << 18)
    finally:
        spark.conf.set(key, before)
