"""Exact substring dedup: winnowed anchors, seed and extend, maximal repeats over a length threshold.

With windows of ``length`` words, k-word anchors and ``w = length - k + 1``, the lowest anchor hash (the
rightmost, if tied) among a window's w anchors is its seed.  The seed depends on the window's words only,
so equal windows have equal seeds at equal places, and windows with the same seed in a document are a
contiguous run.  A run's *span* is all the words that its windows cover: up to ``length - k`` words on
either side of the seed.

1. Documents meet on the hashes of their seeds; seeds that occur once are gone (most).
2. Spans that occur again whole, as all inside copies do, are repeats as they stand, however many there are.
3. Different spans of one seed are *extended* in pairs: from the seed, word by word to the left and to
   the right, as far as both agree.  Where ``length`` words or more agree, that stretch is a maximal repeat of
   the two spans.  A seed with more than ``PAIRS_UP_TO`` different spans is not paired: there, the windows of
   each span meet on their words' hash, which tells how far each span agrees with any other.
4. Overlapping repeats of a document merge into maximal ones; the words under them go.

Nothing pairs the members of a group of copies, so thousands of them cost as much as their rows.
Words and spans are equal where 128 bits of two independently seeded XXH64 agree; texts are told apart by their id
and 128 bits.  Positions of words, not texts, move between the steps; texts are shuffled twice, by
document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import ROUND_BYTES, SEEDS, U, Words, fold, windows, word_rounds, xxh64
from changegrid.sources.staging import stage

#: Different spans of one seed that are still extended pair by pair.
PAIRS_UP_TO = 32
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_DOC = ["id", "k1", "k2"]
_SPAN = ["ah", "s1", "s2"]


def _lowest(values: np.ndarray, w: int) -> np.ndarray:
    """For each i, the place of the lowest of ``values[i:i + w]``, the rightmost if tied."""
    at = np.arange(len(values))
    val, size = values, 1
    while size < w:
        step = min(size, w - size)
        right_val, right_at = val[step:], at[step:]
        n = len(right_val)
        take = right_val <= val[:n]
        val, at = np.where(take, right_val, val[:n]), np.where(take, right_at, at[:n])
        size += step
    return at


class Runs:
    """The seed runs of one round of texts: text, seed and window starts ``lo``..``hi`` of each, as word numbers."""

    def __init__(self, words: Words, length: int, anchor: int):
        first, second = (words.hashes(seed) for seed in SEEDS)
        starts = words.whole_windows(length)
        anchors = windows(first, anchor)
        at = _lowest(anchors, length - anchor + 1)[starts] if len(starts) else starts
        text = words.text()[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        cut = np.flatnonzero(new)
        self.seed, self.text, self.lo = at[cut], text[cut], starts[cut]
        self.hi = starts[np.append(cut[1:], len(starts)) - 1] if len(cut) else cut
        self.anchor = anchors[self.seed] if len(cut) else np.zeros(0, U)
        # a span of fewer than two windows' words is told by its first and last window and the seed's place
        shape = ((self.hi - self.lo) << 16 | (self.seed - self.lo)).astype(U)
        self.spans = []
        for values in (first, second):
            whole = windows(values, length)
            self.spans.append(fold(fold(whole[self.lo], whole[self.hi]), shape) if len(cut) else np.zeros(0, U))


def _merged(packed: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of ranges packed as ``from << 32 | to``."""
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.sort(np.asarray(packed, np.int64))
    start, end = x >> 32, np.maximum.accumulate(x & 0xFFFFFFFF)
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(x)) - 1]


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ROUND_BYTES, cut at separators."""
    at = 0
    while True:
        found = _SPACE.search(raw, at + ROUND_BYTES)
        yield raw[at : found.start()] if found else raw[at:]
        if found is None:
            return
        at = found.start()


def _without(raw: bytes, start: np.ndarray, end: np.ndarray, with_text: bool) -> tuple[int, int, str, str | None]:
    """(words, words under the ranges, SHA-256 of the others joined by one space, those as text)."""
    sha, n, gone, texts, begun = hashlib.sha256(), 0, 0, [], False
    for piece in _pieces(raw):
        words = piece.split()
        k = len(words)
        if len(start):
            d = np.bincount(np.clip(start - n, 0, k), minlength=k + 1) - np.bincount(np.clip(end - n, 0, k), minlength=k + 1)
            covered = np.cumsum(d[:-1]) > 0
            gone += int(covered.sum())
            words = [words[i] for i in np.flatnonzero(~covered)]
        n += k
        if words:
            kept = b" ".join(words)
            sha.update(b" " + kept if begun else kept)
            begun = True
            if with_text:
                texts.append(kept.decode())
    return n, gone, sha.hexdigest(), " ".join(texts) if with_text else None


def _spans_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``(ah, s1, s2, settled, d, left, right)``: word hashes of the wanted spans, outward from the seed.

    ``left`` and ``right`` hold 16 bytes a word; ``right`` begins with the seed's first word.
    """
    runs = wanted.groupBy(*_DOC).agg(F.collect_list(F.struct(*_SPAN, "settled", "d", "at", "n", "o")).alias("runs"))
    runs = runs.select(*[F.col(c).alias(f"r_{c}") for c in _DOC], "runs")
    met = docs.join(runs, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("k1") == F.col("r_k1")) & (F.col("k2") == F.col("r_k2"))).select("text", "runs")
    names = [*_SPAN, "settled", "d"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            runs = pa.RecordBatch.from_struct_array(lists.flatten())
            owner = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at, n, o = (runs.column(c).to_numpy().astype(np.int64) for c in ("at", "n", "o"))
            todo = np.ones(len(owner), bool)
            for row, to, words, base in word_rounds(batch.column("text"), 2 * length):
                ends = words.first[np.clip(owner - row, 0, to - row - 1) + 1]
                begin = words.first[np.clip(owner - row, 0, to - row - 1)] + at - base
                mine = np.flatnonzero(todo & (owner >= row) & (owner < to) & (at >= base) & (begin + n + length <= ends))
                if not len(mine):
                    continue
                todo[mine] = False
                size = n[mine] + length
                cut = np.cumsum(size)[:-1]
                place = np.repeat(begin[mine], size) + np.arange(size.sum()) - np.repeat(np.append(0, cut), size)
                need, back = np.unique(place, return_inverse=True)
                both = np.stack([xxh64(words.data, words.starts[need], words.ends[need], seed) for seed in SEEDS], 1)[back]
                left, right = [], []
                for part, seed in zip(np.split(both, cut), o[mine], strict=True):
                    left.append(part[:seed][::-1].tobytes())
                    right.append(part[seed:].tobytes())
                held = runs.take(pa.array(mine))
                yield pa.RecordBatch.from_arrays([*(held.column(c) for c in names), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=[*names, "left", "right"])

    return met.mapInArrow(read, "ah long, s1 long, s2 long, settled boolean, d long, left binary, right binary")


def _agreement(a: pa.Array, b: pa.Array, most: int) -> np.ndarray:
    """How many words (16 bytes each) two lists begin with in common, ``most`` at the most, for each pair."""

    def matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        held = lists.to_pylist()
        return np.frombuffer(b"".join(x[: 16 * most].ljust(16 * most, b"\0") for x in held), U).reshape(-1, most, 2), np.array([len(x) // 16 for x in held])

    (x, n), (y, m) = matrix(a), matrix(b)
    same = (x == y).all(2) & (np.arange(most) < np.minimum(n, m)[:, None])
    return np.logical_and.accumulate(same, axis=1).sum(1)


def _reach(spans: DataFrame, length: int) -> DataFrame:
    """``(ah, s1, s2, l, r)``: how many words left and right of its seed's start each span repeats in another."""
    schema = "ah long, s1 long, s2 long, l int, r int"

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                part = batch.slice(lo, 4096)
                a, b = (pa.RecordBatch.from_struct_array(part.column(c)) for c in "ab")
                left = _agreement(a.column("left"), b.column("left"), length)
                right = _agreement(a.column("right"), b.column("right"), 2 * length)
                hit = pa.array(np.flatnonzero(left + right >= length))
                reach = [pa.array(x.astype(np.int32)).take(hit) for x in (left, right)]
                for side in (a, b):
                    yield pa.RecordBatch.from_arrays([part.column("ah").take(hit), side.column("s1").take(hit), side.column("s2").take(hit), *reach], names=["ah", "s1", "s2", "l", "r"])

    one = F.struct("s1", "s2", "settled", "left", "right")
    few = spans.where(F.col("d") <= PAIRS_UP_TO).groupBy("ah").agg(F.collect_list(one).alias("held"))
    left = few.select("ah", "held", F.posexplode("held").alias("i", "a"))
    pairs = left.select("ah", "a", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("b"))
    paired = pairs.where("NOT (a.settled AND b.settled)").mapInArrow(extend, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (left, right) in enumerate(zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)):
                a, b = (np.frombuffer(x, U).reshape(-1, 2) for x in (left, right))
                words = np.concatenate((a[::-1], b))
                h1, h2 = (windows(np.ascontiguousarray(words[:, j]), length) for j in (0, 1))
                n = len(h1)
                same = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(same) for c in _SPAN), pa.array((len(a) - np.arange(n)).astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=[*_SPAN, "l", "h1", "h2"]
                )

    crowded = spans.where(F.col("d") > PAIRS_UP_TO).select(*_SPAN, "left", "right")
    met = stage(crowded.mapInArrow(cut, "ah long, s1 long, s2 long, l int, h1 long, h2 long"), "substring-windows")
    again = stage(met.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "substring-again")
    found = met.join(again, ["h1", "h2"]).select(*_SPAN, "l", (length - F.col("l")).cast("int").alias("r"))
    return paired.unionByName(found).groupBy(*_SPAN).agg(F.max("l").alias("l"), F.max("r").alias("r"))


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, anchor: int = 8, with_text: bool = True) -> DataFrame:
    """Every document without the words of its repeats of ``length`` or more words.

    Returns ``(id, n_words, n_removed, kept_sha256, kept_text, ranges)``: ``ranges`` are the maximal runs
    of removed words as ``[from, to)`` pairs, flattened; ``kept_text`` is the kept words joined by one
    space (null unless ``with_text``).  Judged on the input, all occurrences go, as do repeats inside one
    document.  Null and empty texts have no words; texts under ``length`` words stay.  Repeated rows, also with the same
    id, count as repeats of each other; a null id is a value like others.  Extra columns, whatever their names,
    are ignored.  Very long texts are read in pieces, so memory holds the text and little more.  An empty table gives no rows.
    """
    if not 1 <= anchor <= length < 1 << 15:
        raise ValueError("an anchor is 1 to `length` words")
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.col(text_col).alias("text"))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, words, first in word_rounds(batch.column("text"), length - 1):
                runs = Runs(words, length, anchor)
                if len(runs.seed):
                    pick = pa.array(runs.text + row)
                    hashes = [pa.array(x.view(np.int64)) for x in (runs.anchor, *runs.spans)]
                    at = runs.lo - words.first[runs.text] + first
                    places = [pa.array(at.astype(np.int32)), pa.array((runs.hi - runs.lo).astype(np.int16)), pa.array((runs.seed - runs.lo).astype(np.int16))]
                    yield pa.RecordBatch.from_arrays([*hashes, *(batch.column(c).take(pick) for c in _DOC), *places], names=[*_SPAN, *_DOC, "at", "n", "o"])

    occurring = base.mapInArrow(seeds, f"ah long, s1 long, s2 long, id {kind}, k1 long, k2 long, at int, n short, o short")
    known = stage(occurring.groupBy("ah").agg(F.count("*").alias("times")).where("times > 1").select("ah"), "substring-seeds")
    repeated = stage(occurring.join(known, "ah"), "substring-repeated")
    place = F.struct(*_DOC, "at", "n", "o")
    spans = stage(repeated.groupBy(*_SPAN).agg((F.count("*") > 1).alias("settled"), F.min(place).alias("one")), "substring-spans")
    mixed = spans.groupBy("ah").agg(F.count("*").alias("d"), F.bool_and("settled").alias("all")).where("d > 1 AND NOT all").select("ah", "d")
    wanted = stage(spans.join(mixed, "ah").select(*_SPAN, "settled", "d", "one.*"), "substring-wanted")
    reach = stage(_reach(stage(_spans_of(base, wanted, length), "substring-words"), length), "substring-reach")

    verdicts = spans.select(*_SPAN, "settled").join(reach, _SPAN, "left").where("settled OR l IS NOT NULL")
    start = F.when(F.col("settled"), F.col("at")).otherwise(F.col("at") + F.col("o") - F.col("l")).cast("long")
    end = F.when(F.col("settled"), F.col("at") + F.col("n") + length).otherwise(F.col("at") + F.col("o") + F.col("r")).cast("long")
    marks = repeated.join(stage(verdicts, "substring-verdicts"), _SPAN).select(*_DOC, F.shiftleft(start, 32).bitwiseOR(end).alias("mark"))
    marks = stage(marks.groupBy(*_DOC).agg(F.collect_set("mark").alias("marks")).select(*[F.col(c).alias(f"m_{c}") for c in _DOC], "marks"), "substring-marks")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                rows, ranges = [], []
                for text, packed in zip(part.column("text"), part.column("marks"), strict=True):
                    start, end = _merged(packed.as_py())
                    rows.append(_without(text.as_buffer().to_pybytes() if text.is_valid else b"", start, end, with_text))
                    ranges.append(np.stack((start, end), 1).ravel())
                n, gone, sha, kept = zip(*rows, strict=True)
                columns = [part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept, pa.string()), pa.array(ranges, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept_sha256", "kept_text", "ranges"])

    same = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("k1") == F.col("m_k1")) & (F.col("k2") == F.col("m_k2"))
    marked = base.join(marks, same, "left").select("id", "text", "marks")
    return marked.mapInArrow(finish, f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string, ranges array<int>")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = repeated_substrings(docs, with_text=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, list_transform(range(1, len(ws) - 33), lambda i: array_to_string(list_slice(ws, i, i + 34), ' ')) AS h FROM w WHERE len(ws) >= 35),
each AS (SELECT doc_id, unnest(h) AS s, generate_subscripts(h, 1) AS i FROM win),
again AS (SELECT s FROM each GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM each WHERE s IN (SELECT s FROM again)),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM hit, range(0, 35) t(k)),
one AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS j FROM w),
kept AS (SELECT one.doc_id, count(gone.j) AS n, string_agg(x, ' ' ORDER BY one.j) FILTER (gone.j IS NULL) AS rest FROM one LEFT JOIN gone ON gone.doc_id = one.doc_id AND gone.j = one.j GROUP BY one.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
