"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``exponent`` (4 or more) times q long, that no neighbouring
word extends.  For m = 2^k with m <= q < 2m, every such run holds an aligned *dyadic block* of m words, T[b:b + m], that
occurs again at b + q, in the neighbouring window of starts [b + m, b + 2m).

1. Suffix array by prefix doubling.  The names after k rounds give every block of 2^k words its range of the suffix array.
2. A wavelet matrix over the suffix array answers, for all blocks of a level at once: how many starts in the block's
   range lie below x, and which is the first at or after x (range successor: the count, then the element of that number).
3. Starts in one window form an arithmetic progression.  One or two are candidate periods as they are.  Of three or
   more the difference r is the block's own period; the block lies in an r-periodic stretch, and q is the distance between
   the ends of that stretch and of its next occurrence (none, if both are one stretch: then r itself is the period).
4. Candidates are verified: neighbouring blocks of one period are chained and extended word by word both ways; of equal
   stretches the smallest period stays.

Work is kept to where runs can be: within a run of period q all four-word windows but the first q occur at a
distance of at most q before.  A stretch of l consecutive such windows allows only q <= (l + 3) / 3, so it and (l + 3) / 3
words before it are a *region*; words outside regions lie in no run.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import U, Words, fold, mix, rounds, windows

EXPONENT, LEAST = 4, 6
#: Words of regions handled together, words compared in one step of an extension, and the filter's window.
TOGETHER, STEP_CELLS, GRAM = 1 << 17, 1 << 22, 4
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class WaveletMatrix:
    """Counts and order statistics over ranges of an array of whole numbers below ``top``.

    A level keeps, for every place, how many zero bits stand before it: a byte within blocks of 256 and a base by block.
    """

    def __init__(self, values: np.ndarray, top: int):
        self.depth = max(1, int(top - 1).bit_length())
        self.levels = []
        values = values.astype(np.int64)
        for bit in range(self.depth - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            upto = np.zeros(len(values) + 1, np.int64)
            np.cumsum(zero, out=upto[1:])
            base = upto[::256].copy()
            self.levels.append((base, (upto - base[np.arange(len(upto)) >> 8]).astype(np.uint8), int(upto[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    @staticmethod
    def _zeros(level: tuple, at: np.ndarray) -> np.ndarray:
        return level[0][at >> 8] + level[1][at]

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of ``values[lo:hi]`` are less than x."""
        count = np.zeros(len(lo), np.int64)
        over = x >= 1 << self.depth
        for k, level in enumerate(self.levels):
            a, b = self._zeros(level, lo), self._zeros(level, hi)
            one = (x >> (self.depth - 1 - k)) & 1 == 1
            count += np.where(one, b - a, 0)
            lo_next, hi_next = np.where(one, level[2] + lo - a, a), np.where(one, level[2] + hi - b, b)
            if k == 0:
                all_of = hi - lo
            lo, hi = lo_next, hi_next
        return np.where(over, all_of, count)

    def element(self, lo: np.ndarray, hi: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The element of ``values[lo:hi]`` with that number in ascending order, from 0."""
        out, number = np.zeros(len(lo), np.int64), number.copy()
        for k, level in enumerate(self.levels):
            a, b = self._zeros(level, lo), self._zeros(level, hi)
            one = number >= b - a
            number -= np.where(one, b - a, 0)
            out |= one.astype(np.int64) << (self.depth - 1 - k)
            lo, hi = np.where(one, level[2] + lo - a, a), np.where(one, level[2] + hi - b, b)
        return out


def _blocks(codes: np.ndarray, levels: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix order by the first 2^(levels - 1) words and, for every level, (start, range from, range to) of its blocks.

    Blocks that occur once, or that reach beyond the end, are left out.
    """
    n, out = len(codes), []
    order = np.argsort(codes, kind="stable")
    keys = codes[order]
    for k in range(levels):
        if k:
            second = np.zeros(n, np.int64)
            half = 1 << (k - 1)
            second[: n - half] = name[half:] + 1
            both = name * (n + 1) + second
            order = np.argsort(both, kind="stable")
            keys = both[order]
        fresh = np.ones(n, bool)
        fresh[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        name = np.empty(n, np.int64)
        name[order] = heads[group]
        ends = np.append(heads[1:], n)
        m = 1 << k
        start = np.arange(0, n - m + 1, m)
        lo = name[start]
        hi = np.empty(n, np.int64)
        hi[heads] = ends
        keep = hi[lo] - lo > 1
        out.append((start[keep], lo[keep], hi[lo[keep]]))
        if len(heads) == n:
            break
    return order, out


def _agree(codes: np.ndarray, i: np.ndarray, j: np.ndarray, step: int, back: bool = False, most: np.ndarray | None = None) -> np.ndarray:
    """How many words agree from places i and j on (``back``: before them), compared ``step`` at a time, at most ``most``.

    Codes end and begin with words that occur once, so no comparison leaves the array unequal.
    """
    n, total = len(codes), np.zeros(len(i), np.int64)
    active = np.arange(len(i))
    while len(active):
        held = []
        rows = max(1, STEP_CELLS // step)
        for at in range(0, len(active), rows):
            part = active[at : at + rows]
            reach = np.arange(step)
            a, b = (x[part] + (-1 - total[part] if back else total[part]) for x in (i, j))
            a, b = (np.clip(x[:, None] + (-reach if back else reach), 0, n - 1) for x in (a, b))
            differ = codes[a] != codes[b]
            if back:
                differ |= a == 0  # the first word is a guard
            else:
                differ |= b == n - 1
            some = differ.any(1)
            total[part] += np.where(some, differ.argmax(1), step)
            held.append(part[~some])
        active = np.concatenate(held)
        if most is not None and len(active):
            active = active[total[active] < most[active]]
    return total if most is None else np.minimum(total, most)


def _candidates(codes: np.ndarray, wavelet: WaveletMatrix, b: np.ndarray, lo: np.ndarray, hi: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) candidates of one level, m <= period < 2m."""
    below = wavelet.below(lo, hi, b + m)
    count = wavelet.below(lo, hi, b + 2 * m) - below
    some = count > 0
    b, lo, hi, below, count = (x[some] for x in (b, lo, hi, below, count))
    if not len(b):
        return b, b
    first = wavelet.element(lo, hi, below)  # the range successor of b + m
    few = count <= 2
    blocks, periods = [b[few]], [first[few] - b[few]]
    two = count >= 2
    second = np.zeros(len(b), np.int64)
    second[two] = wavelet.element(lo[two], hi[two], below[two] + 1)
    pair = count == 2
    blocks.append(b[pair])
    periods.append(second[pair] - b[pair])
    many = count > 2
    b, lo, hi, below, count, first, second = (x[many] for x in (b, lo, hi, below, count, first, second))
    if len(b):
        r = second - first
        # starts from b to the first, r apart: then block and occurrences are one stretch, whose period is r
        upto = wavelet.below(lo, hi, b)
        one = ((first - b) % r == 0) & (below - upto == (first - b) // r)
        b, r, first = b[~one], r[~one], first[~one]
        if len(b):
            end = b + _agree(codes, b, b + r, m) + r
            room = end + 2 * m - first
            other = first + _agree(codes, first, first + r, m, most=room) + r
            q = other - end
            right = (q >= m) & (q < 2 * m)
            blocks.append(b[right])
            periods.append(q[right])
    b, q = np.concatenate(blocks), np.concatenate(periods)
    right = b + q + m <= len(codes)
    return b[right], q[right]


def runs_of(codes: np.ndarray, exponent: int = EXPONENT, least: int = LEAST, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs in ``codes``, whose first and last words occur nowhere else.

    ``longest`` bounds the length of a run.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods need not hold a dyadic block with its next occurrence")
    empty = np.zeros(0, np.int64)
    longest = len(codes) if longest is None else longest
    levels = (longest // exponent).bit_length()
    if not levels:
        return empty, empty, empty
    codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order, by_level = _blocks(codes, levels)
    wavelet = WaveletMatrix(order, len(codes))
    found = []
    for k, (b, lo, hi) in enumerate(by_level):
        if not len(b):
            continue
        m = 1 << k
        b, q = _candidates(codes, wavelet, b, lo, hi, m)
        # a progression's candidate is not yet an occurrence
        same = _agree(codes, b, b + q, m, most=np.full(len(b), m)) == m
        b, q = b[same], q[same]
        if not len(b):
            continue
        sort = np.lexsort((b, q))
        b, q = b[sort], q[sort]
        fresh = np.ones(len(b), bool)
        fresh[1:] = (q[1:] != q[:-1]) | (b[1:] - b[:-1] > m)
        heads = np.flatnonzero(fresh)
        last = b[np.append(heads[1:], len(b)) - 1] + m
        first, q = b[heads], q[heads]
        start = first - _agree(codes, first, first + q, m, back=True)
        end = last + _agree(codes, last, last + q, m) + q
        keep = end - start >= np.maximum(least, exponent * q)
        found.append((start[keep], end[keep], q[keep]))
    if not found:
        return empty, empty, empty
    start, end, q = (np.concatenate(x) for x in zip(*found, strict=True))
    sort = np.lexsort((q, end, start))
    start, end, q = start[sort], end[sort], q[sort]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[keep], end[keep], q[keep]


def _stretches(flag: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of consecutive true places of one text: (from, to)."""
    edge = np.zeros(len(flag) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = (flag[1:] != flag[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(edge)
    lo, hi = at[:-1], at[1:]
    return lo[flag[lo]], hi[flag[lo]]


def regions(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(from, to)``: disjoint stretches of words, each in one text, outside which no run lies."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < GRAM:
        return none, none
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = windows(hashes, GRAM)
    at = np.arange(len(grams))
    inside = at + GRAM <= first[1:][text[: len(grams)]]
    key = mix(fold(grams, text[: len(grams)].astype(U)))
    order = np.argsort(key, kind="stable")
    back = np.full(len(grams), n, np.int64)
    same = key[order[1:]] == key[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    flag = inside & (back < n)
    for _ in range(2):  # once by any repeat, once by repeats near enough for the stretch
        lo, hi = _stretches(flag, text[: len(grams)])
        near = np.zeros(len(grams), np.int64)
        near[lo] = (hi - lo + GRAM - 1) // 3
        near = near[np.maximum.accumulate(np.where(np.isin(at, lo), at, 0))] if len(lo) else near
        flag = flag & (back <= near)
    lo, hi = _stretches(flag, text[: len(grams)])
    long = hi - lo >= 2
    lo, hi = lo[long], hi[long]
    if not len(lo):
        return none, none
    size = hi - lo
    begin, end = np.maximum(lo - (size + GRAM - 1) // 3 - 1, first[text[lo]]), np.minimum(hi + GRAM, first[1:][text[lo]])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    apart = np.ones(len(begin), bool)
    apart[1:] = (begin[1:] >= end[:-1]) | (text[begin[1:]] != text[begin[:-1]])
    return begin[apart], end[np.append(np.flatnonzero(apart)[1:], len(begin)) - 1]


def runs_of_texts(hashes: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs of the texts with words ``first[i]:first[i + 1]``; places count from the first text."""
    begin, end = regions(hashes, first)
    size = end - begin
    found, at = [], 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), TOGETHER, "right")) + at)
        # regions side by side, a word that occurs once before, between and after them
        places = np.concatenate([np.append(-1, np.arange(a, b)) for a, b in zip(begin[at:to], end[at:to], strict=True)] + [np.array([-1])])
        words = np.where(places < 0, U(0), hashes[places])
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
        guard = np.flatnonzero(places < 0)
        codes[guard] = len(words) + 1 + np.arange(len(guard))
        start, stop, q = runs_of(codes, exponent, least, int(size[at:to].max()))
        found.append((places[start], places[stop - 1] + 1, q))
        at = to
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, stop, q = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((q, start))
    return start[order], stop[order], q[order]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for every row of whole texts.

    ``runs``: array of (start, length, period) in words, by start, then period, with length at least ``least`` and
    ``exponent`` (4 or more) times the period.  ``collapsed``: the text's words, joined by one space, without those
    that stand in a run after its first period.  Words are compared by their XXH64.

    A null or empty text has no words and no runs; repeated rows and null ids get a row each; an empty table gives none;
    extra columns, whatever their names, are ignored.  A long text is one round: memory grows with its words (some
    40 bytes each, 150 in regions), never with the number of its repeats.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in rounds(batch.column("text")):
                words = Words(data, offsets)
                start, stop, q = runs_of_texts(words.hashes(), words.first, exponent, least)
                gone = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(gone, start + q, 1)
                np.add.at(gone, stop, -1)
                kept = np.cumsum(gone[:-1]) == 0
                yield _batch(batch.column("id").slice(row, to - row), words, kept, start, stop, q)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _batch(ids: pa.Array, words: Words, kept: np.ndarray, start: np.ndarray, stop: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
    """The result rows of one round of texts."""
    n = len(ids)
    of = np.searchsorted(words.first, start, "right") - 1
    places = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
    run = pa.StructArray.from_arrays([pa.array(start - words.first[of]), pa.array(stop - start), pa.array(q)], names=["start", "length", "period"])
    joined, lo, hi = words.joined()
    spaced = np.ones(len(lo), bool)
    spaced[words.first[1:][np.diff(words.first) > 0] - 1] = False
    size = hi - lo + spaced
    solid = np.repeat(kept, size)
    upto = np.concatenate([[0], np.cumsum(kept)])
    some = upto[words.first[1:]] > upto[words.first[:-1]]
    last = np.flatnonzero(kept)[upto[words.first[1:][some]] - 1]  # the last kept word of each text has no space after it
    solid[hi[last[spaced[last]]]] = False
    edges = np.concatenate([[0], np.cumsum(solid)])[np.concatenate([[0], np.cumsum(size)])[words.first]]
    collapsed = pa.LargeStringArray.from_buffers(n, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(joined[solid].tobytes())).cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(places), run), collapsed], names=["id", "n_words", "runs", "collapsed"])


def with_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the query's documents: some of them get a periodic tail, as its contract says (a null id: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for row, doc_id in enumerate(ids):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                held = texts.slice(row, 1)
                if h % 10 == 0 and texts[row].is_valid:
                    words, g = _WORD.findall(texts[row].as_py().encode()), h // 10
                    if words:
                        a = g % len(words)
                        p = 1 + (len(words) - a) // (3 + g % 8)
                        tail = words[a : a + p]
                        words[a:] = (tail * (-(-(len(words) - a) // p)))[: len(words) - a]
                        held = pa.array([b" ".join(words).decode()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, 1), held], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = find_runs(with_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
