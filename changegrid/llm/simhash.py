"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the Hamming distance.

1. ``fingerprints``: 64 bits a text, the bitwise majority over XXH64 of its word shingles.
2. ``close_links``: fingerprints are cut into ``blocks`` pieces.  Two that differ in at most ``radius``
   bits agree in at least ``blocks - radius`` pieces, so each fingerprint is filed under every choice of
   that many pieces, and only fingerprints filed together are compared.  Groups work on *distinct*
   fingerprints.  A file with more than ``PAIRS_UP_TO`` of them is not compared in pairs: there, every
   fingerprint is filed again under itself and each one-bit change of its free bits; two fingerprints
   at most two bits apart meet under the one between them, and no such file holds more than 65.
3. ``components`` joins links to classes.

``near_copies`` reaches further, for the pipeline: sets of five-word shingles of Jaccard similarity 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import Words, fold, mix, windows, word_rounds, xxh64
from changegrid.operators.components import connected_components
from changegrid.sources.staging import stage

#: Distinct fingerprints in one file that are still compared pair by pair.
PAIRS_UP_TO = 32

#: Bytes with A-Z in lower case, and eight bytes of 0 or 1 for the bits of a byte, lowest first.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _shingle_hashes(words: Words, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the space-joined shingles of each text (all its words, where it has fewer), and their texts."""
    data, starts, ends = words.joined()
    at = words.whole_windows(shingle)
    text = words.text()
    count = np.diff(words.first)
    few = np.flatnonzero((count > 0) & (count < shingle))
    first, last = np.concatenate((at, words.first[few])), np.concatenate((at + shingle, words.first[few + 1])) - 1
    return xxh64(data, starts[first], ends[last], seed), text[first]


def _bit_counts(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """How many of each text's hashes set each of the 64 bits, as (n, 64)."""
    out = np.zeros((n, 64), np.int64)
    if not len(hashes):
        return out
    order = np.argsort(text, kind="stable")
    hashes, text = hashes[order], text[order]
    new = np.append(0, np.flatnonzero(np.diff(text)) + 1)
    # eight counters share a word, so at most 255 hashes are summed at once
    within = np.arange(len(text)) - np.repeat(new, np.diff(np.append(new, len(text))))
    cut = np.flatnonzero(within % 255 == 0)
    sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8)].reshape(-1, 8), cut, axis=0)
    np.add.at(out, text[cut], sums.view(np.uint8).reshape(-1, 64))
    return out


def _fingerprint(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def text_fingerprints(texts: pa.Array, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Fingerprints of texts as unsigned integers; 0 where a text has no words (null too)."""
    counts, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    for row, to, words, _ in word_rounds(texts, shingle - 1, table=LOWER):
        hashes, text = _shingle_hashes(words, shingle, seed)
        counts[row:to] += _bit_counts(hashes, text, to - row)
        total[row:to] += np.bincount(text, minlength=to - row)
    return _fingerprint(counts, total)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)`` for every row, fp a signed long holding the 64 bits.

    Only A-Z are lower-cased.  Null texts count as empty; repeated rows stay; null ids pass through; extra
    columns are ignored.  Long texts are read in pieces, so memory holds the text and little more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_fingerprints(batch.column(1), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _masks(blocks: int, agree: int) -> list[int]:
    """The kept bits of every choice of ``agree`` blocks, as signed longs."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    pieces = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    kept = [sum(pieces[i] for i in c) for c in combinations(range(blocks), agree)]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_links(fps: DataFrame, radius: int = 2, blocks: int = 5) -> DataFrame:
    """Links ``(src, dst)`` between distinct fingerprints, enough to connect all at most ``radius`` bits apart.

    ``fps`` has one distinct, non-null ``fp`` a row.  Radius 0 to 2: beyond two bits a file that is too
    large for pairs has no exact linear route here.
    """
    if not 0 <= radius <= 2 or blocks <= radius:
        raise ValueError("radius must be 0, 1 or 2, and blocks more than that")
    masks = F.array(*[F.lit(m) for m in _masks(blocks, blocks - radius)])
    filed = fps.select("fp", F.posexplode(masks).alias("choice", "mask"))
    filed = filed.select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "mask")
    sizes = filed.groupBy("choice", "key").agg(F.count("*").alias("n"))
    sizes = stage(sizes.where("n > 1"), "simhash-files")
    small = stage(filed.join(sizes, ["choice", "key"]), "simhash-filed")

    inside = small.where(F.col("n") <= PAIRS_UP_TO).groupBy("choice", "key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    left = inside.select("fps", F.posexplode("fps").alias("at", "src"))
    pairs = left.select("src", F.explode(F.slice("fps", F.col("at") + 2, F.size("fps"))).alias("dst"))
    links = pairs.where(hamming(F.col("src"), F.col("dst")) <= radius)

    bits = F.array(*[F.lit(1 << i) if i < 63 else F.lit(-(1 << 63)) for i in range(64)])
    free = F.filter(bits, lambda bit: F.col("mask").bitwiseAND(bit) == 0)
    changed = F.concat(F.array("fp"), F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit))) if radius == 2 else F.array("fp")
    middle = small.where(F.col("n") > PAIRS_UP_TO).select("choice", "fp", F.explode(changed).alias("mid"))
    if radius == 1:  # neighbours are the one-bit changes themselves
        one = small.where(F.col("n") > PAIRS_UP_TO).select(F.col("fp").alias("src"), F.explode(F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("fp"))
        return links.unionByName(one.join(fps.select("fp"), "fp").select("src", F.col("fp").alias("dst"))).distinct()
    met = middle.groupBy("choice", "mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst")).where("src != dst")
    return links.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, blocks: int = 5, seed: int = 42) -> DataFrame:
    """``(id, fp, component)``: for every row its fingerprint and the smallest id its links reach.

    Ties, repeated rows and exact copies share a fingerprint and so a component; empty and null texts
    have fingerprint 0, linked like any other; a row with a null id gets a component like the others
    but never names one.  An empty table gives an empty result.
    """
    ids = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fps")
    distinct = stage(ids.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    links = close_links(distinct, radius, blocks)
    classes = connected_components(links)
    named = distinct.join(classes, distinct.fp == classes.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("class"))
    named = stage(named, "simhash-named")
    first = stage(named.groupBy("class").agg(F.min("least").alias("component")), "simhash-first")
    final = stage(named.join(first, "class").select("fp", "component"), "simhash-final")
    return ids.join(final, "fp").select("id", "fp", "component")


#: Near copies: words a shingle, least Jaccard similarity, bands of rows each in a signature, and agreeing rows from which a pair is verified.
SHINGLE, SIMILAR, BANDS, BAND_ROWS, AGREE = 5, 0.8, 16, 4, 38
#: Sets in one tile of a crowded band, and their shingles.
TILE, TILE_SHINGLES = 2048, 1 << 21
_MINIMA = np.random.default_rng(17)
_TIMES = _MINIMA.integers(0, 1 << 31, BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _MINIMA.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)


def _five_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of five words of each text (all its words, where it has fewer), and their texts."""
    values = words.hashes()
    at = words.whole_windows(SHINGLE)
    count = np.diff(words.first)
    hashes, text = [windows(values, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)], [words.text()[at]]
    for size in range(1, SHINGLE):
        few = np.flatnonzero(count == size)
        if len(few):
            hashes.append(fold(windows(values, size)[words.first[few]], np.full(len(few), np.uint64(size))))
            text.append(few)
    return np.concatenate(hashes), np.concatenate(text)


def _least(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The least of each hashing of each text's shingles, (n, hashings); all bits where there are none."""
    out = np.full((n, len(_TIMES)), np.uint32(0xFFFFFFFF))
    order = np.argsort(text, kind="stable")
    low, text = (hashes[order] >> np.uint64(32)).astype(np.uint32), text[order]
    for lo in range(0, len(low), 4096):
        x, t = low[lo : lo + 4096], text[lo : lo + 4096]
        h = x[:, None] * _TIMES + _PLUS
        h ^= h >> np.uint32(15)
        cut = np.append(0, np.flatnonzero(np.diff(t)) + 1)
        out[t[cut]] = np.minimum(out[t[cut]], np.minimum.reduceat(h, cut, axis=0))
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, fp, same, signature, bands)``: op8's fingerprint; a hash of the lower-cased sequence of words
    (0: none); one byte of each least hash; and a key for every band (none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            counts, total, same = np.zeros((n, 64), np.int64), np.zeros(n, np.int64), np.zeros(n, np.uint64)
            least = np.full((n, BANDS * BAND_ROWS), np.uint32(0xFFFFFFFF))
            for row, to, words, base in word_rounds(batch.column(1), SHINGLE - 1, table=LOWER):
                hashes, text = _shingle_hashes(words, 3, 42)
                if base:  # a later piece: its first shingles were in the one before
                    hashes, text = hashes[SHINGLE - 3 :], text[SHINGLE - 3 :]
                counts[row:to] += _bit_counts(hashes, text, to - row)
                total[row:to] += np.bincount(text, minlength=to - row)
                least[row:to] = np.minimum(least[row:to], _least(*_five_words(words), to - row))
                data, starts, ends = words.joined()
                held = np.flatnonzero(np.diff(words.first))
                own = xxh64(data, starts[words.first[held]], ends[words.first[held + 1] - 1], 7) | np.uint64(1)
                same[row + held] = own if not base else fold(same[row + held], own) | np.uint64(1)
            bands = np.zeros((n, BANDS), np.uint64)
            for k in range(BANDS):
                pair = np.ascontiguousarray(least[:, k * BAND_ROWS : (k + 1) * BAND_ROWS]).view(np.uint64)
                bands[:, k] = fold(mix(pair[:, 0] + np.uint64(k + 1)), pair[:, 1])
            full = total > 0
            offsets = np.append(0, np.cumsum(full * BANDS)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[full].ravel().view(np.int64)))
            signs = pa.array([x.tobytes() for x in (least & np.uint32(255)).astype(np.uint8)], pa.binary())
            longs = [pa.array(x.view(np.int64)) for x in (_fingerprint(counts, total), same)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, signs, lists], names=["id", "fp", "same", "signature", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long, same long, signature binary, bands array<long>")


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(src, dst)`` of ``(src, s, dst, t)`` whose signatures agree in AGREE rows."""
    for batch in batches:
        s, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BANDS * BAND_ROWS) for c in ("s", "t"))
        yield batch.select(["src", "dst"]).filter(pa.array((s == t).sum(1) >= AGREE))


def _held(wanted: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``(same, held)``: the shingles of the wanted sets.  ``rows``: ``(same, id)``, one text of each; ``docs``: ``(id, text)``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[np.ndarray]] = [[] for _ in range(len(batch))]
            for row, to, words, _ in word_rounds(batch.column("text"), SHINGLE - 1, table=LOWER):
                hashes, text = _five_words(words)
                order = np.argsort(text, kind="stable")
                for i, part in zip(range(row, to), np.split(hashes[order], np.cumsum(np.bincount(text, minlength=to - row))[:-1]), strict=True):
                    held[i].append(part)
            sets = [np.unique(np.concatenate(x)).view(np.int64) if x else np.zeros(0, np.int64) for x in held]
            yield pa.RecordBatch.from_arrays([batch.column("same"), pa.array(sets, pa.list_(pa.int64()))], names=["same", "held"])

    texts = docs.join(rows.join(wanted.distinct(), "same").select("same", "id"), "id").dropDuplicates(["same"]).select("same", "text")
    return stage(texts.mapInArrow(hashed, "same long, held array<long>"), "similar-sets")


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs ``(src, dst)`` whose whole sets have a Jaccard similarity of SIMILAR or more."""
    pairs = stage(pairs, "similar-pairs")
    held = _held(pairs.select(F.col("src").alias("same")).union(pairs.select("dst")), rows, docs)
    both = pairs.join(held.withColumnsRenamed({"same": "dst", "held": "y"}), "dst").join(held.withColumnsRenamed({"same": "src", "held": "x"}), "src")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= SIMILAR * (F.size("x") + F.size("y") - common)).select("src", "dst")


def _flat(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a.same").alias("src"), F.col("a.signature").alias("s"), F.col("b.same").alias("dst"), F.col("b.signature").alias("t"))


def _first_pairs(filed: DataFrame) -> DataFrame:
    """Each set of a band with the least set of that band."""
    least = filed.groupBy("key").agg(F.min(F.struct("same", "signature")).alias("a"), F.count("*").alias("n")).where("n > 1")
    found = filed.join(least, "key").where("same <> a.same").select("a", F.struct("same", "signature").alias("b"))
    return _flat(found).mapInArrow(_agreeing, "src long, dst long").distinct()


def _joining(a: list[np.ndarray], b: list[np.ndarray], same: bool, classes: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Pairs (place in a, place in b) of similar sets, enough to join all classes that similar sets of ``a`` and ``b`` join.

    One look-up of a set's shingles among all of ``b`` counts what it has in common with each of them.
    """
    size = np.array([len(x) for x in b], np.int64)
    values = np.concatenate([np.zeros(0, np.int64), *b])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(b)), size)[order]
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while root.setdefault(k, k) != k:
            root[k] = k = root[root[k]]
        return k

    out = []
    for i, x in enumerate(a):
        lo, n = np.searchsorted(values, x), np.searchsorted(values, x, "right")
        n -= lo
        common = np.bincount(owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=len(b))
        hits = np.flatnonzero((common >= SIMILAR * (len(x) + size - common)) & (classes[1] != classes[0][i]))
        for j in hits[hits > i] if same else hits:
            p, q = find(int(classes[0][i])), find(int(classes[1][j]))
            if p != q:
                root[p] = q
                out.append((i, int(j)))
    return out


def _open_links(filed: DataFrame, classes: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between sets of one band that are similar and not in one class yet, enough to join their classes.

    Bands whose sets are all in one class are done.  In the others, up to PAIRS_UP_TO sets make pairs;
    the sets of a larger band are dealt to tiles, and every two tiles are compared whole by one task.
    """
    classed = filed.join(classes.withColumnsRenamed({"node": "same", "component": "class"}), "same", "left").withColumn("class", F.coalesce("class", "same"))
    classed = stage(classed, "similar-filed")
    sizes = classed.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("key", "n")
    open_ = stage(classed.join(stage(sizes, "similar-open"), "key"), "similar-rows-open")
    few = open_.where(F.col("n") <= PAIRS_UP_TO).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("same", "class", "signature"))).alias("held"))
    left = few.select("held", F.posexplode("held").alias("at", "a"))
    pairs = _flat(left.select("a", F.explode(F.slice("held", F.col("at") + 2, F.size("held"))).alias("b")).where("a.class <> b.class"))
    links = _verified(pairs.mapInArrow(_agreeing, "src long, dst long").distinct(), rows, docs)

    crowded = stage(open_.where(F.col("n") > PAIRS_UP_TO).select("key", "same", "class", "n"), "similar-crowded")
    if crowded.isEmpty():
        return links
    whole = crowded.join(_held(crowded.select("same"), rows, docs), "same")
    whole = stage(whole, "similar-whole")
    tiles = whole.groupBy("key").agg(F.greatest(F.ceil(F.first("n") / TILE), F.ceil(F.sum(F.size("held")) / TILE_SHINGLES)).cast("int").alias("tiles"))
    dealt = whole.join(stage(tiles, "similar-tiles"), "key").withColumn("tile", F.pmod(F.xxhash64("same", F.lit(5)), F.col("tiles")).cast("int"))
    cell = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least("tile", o).alias("i"), F.greatest("tile", o).alias("j")))
    dealt = dealt.withColumn("cell", F.explode(cell)).select("key", "cell", "tile", "same", "class", "held")

    def compare(table: pa.Table) -> pa.Table:
        tile, same, cls = (table[c].to_numpy() for c in ("tile", "same", "class"))
        lists = table["held"].combine_chunks()
        cuts, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        cell = table["cell"][0].as_py()
        a, b = np.flatnonzero(tile == cell["i"]), np.flatnonzero(tile == cell["j"])
        found = _joining(*([flat[cuts[i] : cuts[i + 1]] for i in side] for side in (a, b)), cell["i"] == cell["j"], (cls[a], cls[b]))
        src, dst = same[a[[i for i, _ in found]]], same[b[[j for _, j in found]]]
        return pa.table({"src": src.astype(np.int64), "dst": dst.astype(np.int64)})

    return links.unionByName(dealt.groupBy("key", "cell").applyInArrow(compare, "src long, dst long"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, component)`` for every row: the smallest id that links reach from it.

    Linked are op8's pairs (fingerprints of three-word shingles at most two bits apart), equal sequences of
    words, and sets of five-word shingles with a Jaccard similarity of SIMILAR or more: candidates share a
    band of least hashes and are verified on their whole sets (pairs, where AGREE of all hashes agree).  First, each set
    meets the least set of each of its bands; then all sets of a band that are not in one class by then, in
    pairs or, in a crowded band, tile by tile, which gives on only links that join classes.
    So a large group of copies costs its rows, and no link between classes is lost.  Equal texts
    are compared once, however many rows have them.  ``id_col`` has to name a row's content: rows of one
    id have one text.  Null and empty texts are one class; an empty table gives no rows.
    """
    rows = stage(sketches(docs, id_col, text_col), "similar-rows")
    fps = stage(rows.select("fp").distinct(), "similar-fps")
    sets = stage(rows.groupBy("same").agg(F.min("id").alias("id"), F.min(F.struct("signature", "bands")).alias("s")).select("same", "id", "s.*"), "similar-distinct")
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    filed = sets.select("same", "signature", F.explode("bands").alias("key"))

    links = _verified(_first_pairs(filed), sets, whole)
    links = links.unionByName(close_links(fps)).unionByName(rows.select(F.col("fp").alias("src"), F.col("same").alias("dst")).distinct())
    links = stage(links, "similar-links")
    classes = stage(connected_components(links), "similar-classes")
    more = stage(_open_links(filed, classes, sets, whole), "similar-more")
    if not more.isEmpty():
        links = stage(links.unionByName(more), "similar-links")
        classes = stage(connected_components(links), "similar-classes")
    classed = rows.join(classes, rows.fp == classes.node, "left").select("id", F.coalesce("component", "fp").alias("class"))
    classed = stage(classed, "similar-classed")
    first = classed.groupBy("class").agg(F.min("id").alias("component"))
    return classed.join(stage(first, "similar-first"), "class").select("id", "component")


def op8_simhash_near_dup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
