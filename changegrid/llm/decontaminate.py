"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give IDF weights; words of more than STOP of
   all documents (runs of words from the benchmark not counted) weigh nothing, or every passage would be close to every other of its language.
2. A randomised SVD of the TF-IDF passages of all documents and of the benchmark gives a latent basis.  The
   passages' rows stay distributed: one pass sums A' * (A * Omega), by blocks of terms; only those sums reach
   the driver.
3. Every passage of every document is folded into the basis and compared with all passages of the
   benchmark, one matrix product a block.  The cosine's denominator holds the passage's whole TF-IDF
   norm, so a passage that lies mostly outside the basis is close to nothing.
4. A basis of fixed rank cannot hold many items.  Items with a passage of which it keeps too little are
   searched exactly instead, by enough of their rare words in one stretch of text.
5. Verbatim copies of items of any length and of any words are found without weights: each item's rarest
   run of words is looked up at every word, and the words around a hit are compared with the item's.
6. Other regions around close passages are checked word by word: the longest common subsequence with the item,
   its weighing words only, and the
   item's answer (its last sentence).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import U, Words, rounds, windows

#: Hashed terms (2**BITS), latent dimensions and oversampling, words of half a passage (passages overlap by it).
BITS, RANK, OVER, HALF = 16, 96, 8, 12
#: Bits that mark the runs of words of the benchmark.
RUN_BITS = 24
#: Bits of the table that tells which words of a text may begin an item's looked-up run.
FILTER_BITS = 22
#: Words of more than this part of the documents (and of more than STOP_LEAST) weigh nothing.
STOP, STOP_LEAST = 0.1, 20
#: Part of the weight that the benchmark's passages have in the decomposition, against the documents'.
ITEM_SHARE = 0.75
#: Cosine from which a passage is a candidate. Words of a run; an item of fewer counts where it stands verbatim.
CLOSE, LEAST_WORDS = 0.15, 5
#: Weighing words up to which an item is judged by its runs of words, as it has no vector to speak of.
HARDLY = 2
#: Verdict: VERBATIM of the item's words in order, and PARAPHRASE of its weighing ones; or PARAPHRASE of those, and ANSWER of the answer.
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
#: A passage whose copy is expected under SURE times CLOSE in the basis is searched by its rare words instead;
#: these are all its weighing words but one in COMMON, the most frequent ones.
SURE, COMMON = 2.0, 4
#: Benchmark items that one pass over the documents looks for; more take more passes.
ITEMS_A_PASS = 5000
#: Input partitions that a task of the decomposition sums, where there are more than tasks run at once.
INPUTS_A_TASK = 4
_TERM_BLOCK, _POSTINGS = 256, 1 << 18
#: Bytes of text in a round (each passage becomes RANK + 1 floats); sums taken side by side.
_ROUND, _RUNS = 1 << 18, 512

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[48:58] = np.arange(48, 58)


def _read(texts: pa.Array) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    """(row from, row to, words, word hashes) of lower-cased letters and digits, in rounds."""
    for row, to, data, offsets in rounds(texts, _ROUND, pc.utf8_lower):
        words = Words(_FOLD[data], offsets)
        yield row, to, words, words.hashes()


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - BITS)).astype(np.int64)


def _grams(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of LEAST_WORDS words."""
    return windows(hashes, LEAST_WORDS)


def benchmark_runs(items: DataFrame) -> np.ndarray:
    """Bits of 2**RUN_BITS, packed, set at every run of LEAST_WORDS words of ``items.text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << RUN_BITS, bool)
        for batch in batches:
            for _, _, _, hashes in _read(batch.column("text")):
                bits[_grams(hashes) >> U(64 - RUN_BITS)] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    found = np.zeros(1 << RUN_BITS >> 3, np.uint8)
    for part in items.select("text").mapInArrow(run, "bits binary").toLocalIterator():
        found |= np.frombuffer(part.bits, np.uint8)
    return found


def document_frequencies(docs: DataFrame, text_col: str = "text", own: np.ndarray | None = None) -> tuple[int, np.ndarray, int]:
    """Number of documents, for each hashed term how many contain it, and the number of tasks that read them; over all rows.

    Words in runs that ``own`` holds (``benchmark_runs``) are not counted there, so that a leak, however
    often it is repeated, does not make its own words common.
    """
    shared = None if own is None else docs.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        total = 0
        for batch in batches:
            total += len(batch)
            for _, to, words, hashes in _read(batch.column("text")):
                text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
                pairs = text << BITS | _bucket(hashes)
                if shared is not None:
                    runs = _grams(hashes) >> U(64 - RUN_BITS)
                    held = np.flatnonzero(shared.value[runs >> U(3)] >> (U(7) - (runs & U(7))).astype(np.uint8) & 1)
                    pairs = np.delete(pairs, (held[:, None] + np.arange(LEAST_WORDS)).ravel())
                pairs = np.unique(pairs)
                seen += np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(seen[at], [total, 1]))], names=["term", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    out = np.zeros(1 << BITS)
    out[term[term >= 0]] = n[term >= 0]
    return int(n[term == -1].sum()), out, int(n[term == -2].sum())


def _sums(rows: np.ndarray, pick: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sums of ``rows[pick[cut[i]:cut[i + 1]]]``, whole rows at a time; long runs by the sums of their pieces."""
    n = np.diff(cut)
    if n.max(initial=0) > HALF:
        pieces = -(-n // HALF)
        ends = np.cumsum(pieces)
        first = np.repeat(cut[:-1], pieces) + (np.arange(pieces.sum()) - np.repeat(ends - pieces, pieces)) * HALF
        held = _sums(rows, pick, np.append(first, cut[-1]))
        return _sums(held, np.arange(len(held)), np.append(0, ends))
    out = np.empty((len(n), rows.shape[1]), np.float32)
    order = np.argsort((HALF - n).astype(np.uint8), kind="stable")
    taken = np.empty((min(_RUNS, len(n)), rows.shape[1]), np.float32)
    for lo in range(0, len(n), _RUNS):  # the longest first, so those with a further row are the first ones
        own = order[lo : lo + _RUNS]
        start, total = cut[own], np.zeros((len(own), rows.shape[1]), np.float32)
        more = len(own) - np.searchsorted(n[own][::-1], np.arange(n[own[0]]), "right")
        for j, m in enumerate(more):
            total[:m] += np.take(rows, pick[start[:m] + j], 0, out=taken[:m], mode="clip")
        out[own] = total
    return out


def _passages(words: Words, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of terms' ``rows`` over passages of 2 * HALF words, HALF apart: (passages x dimensions, text, first word in it).

    Words whose last number is zero weigh nothing and are not looked up.
    """
    count = np.diff(words.first)
    halves = -(-count // HALF)
    text = np.repeat(np.arange(len(count)), halves)
    order = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves)
    bucket = _bucket(hashes)
    weighing = np.flatnonzero(np.take(rows[:, -1] != 0, bucket))
    sums = _sums(rows, bucket[weighing], np.append(np.searchsorted(weighing, words.first[text] + order * HALF), len(weighing)))
    joined = np.append(text[1:] == text[:-1], False)[: len(text)]
    keep = (order == 0) | joined  # a text's last half is in the passage before it
    more = np.flatnonzero(joined)
    sums[more] += sums[more + 1]  # the right side is made first, so no sum is added twice
    return sums[keep], text[keep], (order * HALF)[keep]


class Sketch:
    """Sums over passages x (TF-IDF, of length one) of x' * (x * omega), for a random ``omega`` of ``width`` columns.

    A passage's length is the root of its words' summed squared weights, as in the search.
    """

    def __init__(self, idf: np.ndarray, width: int, seed: int):
        self.idf, self.n = idf, 0
        self.terms = np.empty((1 << BITS, width + 1), np.float32)
        for at, part in omega(width, seed):
            np.multiply(part, idf[at : at + len(part), None], out=self.terms[at : at + len(part), :-1], casting="same_kind")
        self.terms[:, -1] = idf**2
        self.sums = np.zeros((1 << BITS, width + 1), np.float32)

    def add(self, words: Words, hashes: np.ndarray) -> None:
        vectors, text, start = _passages(words, hashes, self.terms)
        norm = vectors[:, -1:].copy()
        self.n += int(np.count_nonzero(norm > 0))
        vectors /= np.where(norm > 0, norm, np.float32(np.inf))
        count = np.diff(words.first)
        halves = -(-count // HALF)
        base = np.cumsum(halves) - halves
        at = base[text] + start // HALF
        held = np.zeros((int(halves.sum()), vectors.shape[1]), np.float32)  # of each half passage: those of the passages it is in
        held[at] = vectors
        two = halves[text] > 1
        held[at[two] + 1] += vectors[two]
        bucket = _bucket(hashes).astype(np.uint16)
        weighing = np.flatnonzero(np.take(self.idf > 0, bucket))
        weighing = weighing[np.argsort(bucket[weighing], kind="stable")]
        owner = words.text()[weighing]
        half = base[owner] + (weighing - words.first[owner]) // HALF
        term = bucket[weighing]
        cut = np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)])
        self.sums[term[cut]] += _sums(held, half, np.append(cut, len(term)))

    def rows(self, at: int, to: int) -> np.ndarray:
        """The sums of some terms: terms x width."""
        return self.sums[at:to, :-1] * self.idf[at:to, None].astype(np.float32)


def omega(width: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """Random numbers (terms x width), the same in every task, by blocks of terms: (first term, rows)."""
    rng = np.random.default_rng(seed)
    for at in range(0, 1 << BITS, _TERM_BLOCK):
        yield at, rng.standard_normal((_TERM_BLOCK, width), np.float32)


def sketched(texts: DataFrame, idf: np.ndarray, width: int, seed: int, tasks: int | None = None) -> np.ndarray:
    """``Sketch`` of all passages of all rows of ``text``, divided by the number of passages: one pass, by ``tasks`` tasks at most.

    Blocks of terms are added up by Spark.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(shared.value, width, seed)
        for batch in batches:
            for _, _, words, hashes in _read(batch.column("text")):
                own.add(words, hashes)
        part = TaskContext.get().partitionId()
        for block in range(0, 1 << BITS, _TERM_BLOCK):
            sums = own.rows(block, block + _TERM_BLOCK)
            if sums.any():
                n = own.n if not block else 0
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part]), pa.array([n]), pa.array([sums.tobytes()], pa.binary())], names=["block", "part", "n", "sums"])
            elif not block and own.n:
                yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([part]), pa.array([own.n]), pa.array([b""], pa.binary())], names=["block", "part", "n", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # one order, one result
        total = np.zeros(_TERM_BLOCK * width)
        for x in table["sums"]:
            if len(x.as_buffer()):
                total += np.frombuffer(x.as_buffer(), np.float32)
        return pa.table({"block": table["block"][:1], "n": pa.array([pc.sum(table["n"]).as_py()]), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    found = (texts if tasks is None else texts.coalesce(tasks)).select("text").mapInArrow(run, "block long, part long, n long, sums binary").groupBy("block").applyInArrow(add, "block long, n long, sums binary")
    out, n = np.zeros((1 << BITS, width), np.float32), 0
    for row in found.toLocalIterator():
        n += row.n
        out[row.block : row.block + _TERM_BLOCK] = np.frombuffer(row.sums, np.float32).reshape(-1, width)
    out /= max(1, n)
    return out


def latent_basis(docs: DataFrame, items: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11, tasks: int | None = None) -> np.ndarray:
    """Right singular vectors (terms x rank) of the TF-IDF passages of all rows of ``docs`` and ``items``, by randomised SVD.

    With A the passages and Y = A * omega, both Y' * Y = omega' * (A' * Y) and Q' * A, Q an orthonormal basis of
    Y's columns, follow from A' * Y, which one pass sums.  The items' passages have ITEM_SHARE of the weight, however
    many documents there are.
    """
    width = rank + OVER
    total = sketched(docs, idf, width, seed, tasks) * np.float32(1 - ITEM_SHARE)
    total += sketched(items, idf, width, seed, tasks) * np.float32(ITEM_SHARE)
    gram = sum(part.T.astype(np.float64) @ total[at : at + len(part)] for at, part in omega(width, seed))
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > max(values.max(initial=0), 1e-300) * 1e-5  # the sums have single precision
    b = total @ (vectors[:, keep] / np.sqrt(values[keep]))  # Y @ (vectors / sqrt(values)) has orthonormal columns
    values, vectors = np.linalg.eigh(b.T @ b)
    order = [i for i in np.argsort(-values)[:rank] if values[i] > 1e-12]
    return (b @ vectors[:, order] / np.sqrt(values[order])).astype(np.float32) if order else np.zeros((1 << BITS, 1), np.float32)


def common_subsequence(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence of two word lists (bit-parallel over the item)."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in region:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def in_runs(item: list[int], region: list[int]) -> float:
    """Part of the item's words that stand in runs of LEAST_WORDS words of the region."""
    held = set(zip(*[region[i:] for i in range(LEAST_WORDS)], strict=False))
    runs = zip(*[item[i:] for i in range(LEAST_WORDS)], strict=False)
    return len({i + j for i, r in enumerate(runs) if r in held for j in range(LEAST_WORDS)}) / len(item)


class Benchmark:
    """Items prepared for the search: ids, word hashes, answers, and passage vectors with their items.

    Items with a passage that the basis does not hold well are also cut into pieces, looked for exactly
    by their rare words: an item with PARAPHRASE of its weighing words in place has a piece with as many.
    """

    def __init__(self, ids: list, texts: list, rows: np.ndarray):
        posted, self.piece_owner, self.least_hits = [], [], []
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        grams, gram_owner = [np.zeros(0, U)], []
        self.ids, self.words, self.weighing, self.answers = [], [], [], []
        vectors, owner, unsure = [np.zeros((0, rows.shape[1]), np.float32)], [], set()
        for item, text in zip(ids, texts, strict=True):
            for _, _, words, hashes in _read(pa.array([text or ""])):
                if not len(hashes):
                    continue
                # the answer: the last sentence that has words, its last eight at most
                parts = [p for p in (text or "").replace("!", ".").replace("?", ".").split(".") if any(c.isalnum() for c in p)]
                last = next(_read(pa.array([parts[-1]])))[3][-8:] if parts else hashes[-8:]
                k = len(self.ids)
                self.ids.append(item)
                self.words.append(hashes.tolist())
                self.answers.append(last.tolist())
                term = rows[_bucket(hashes)]
                self.weighing.append(hashes[term[:, -1] > 0].tolist())
                size = min(LEAST_WORDS, len(hashes))
                rarest = int(np.argmax(np.convolve(term[:, -1], np.ones(size), "valid")))
                anchors.setdefault(size, []).append((int(windows(hashes, size)[rarest]), k, rarest))
                if len(hashes) < LEAST_WORDS:  # counts where it stands verbatim
                    continue
                if len(self.weighing[k]) <= HARDLY:
                    grams.append(np.unique(_grams(hashes)))
                    gram_owner += [k] * len(grams[-1])
                first = len(owner)
                for at in {*range(0, max(1, len(hashes) - 2 * HALF), HALF), max(0, len(hashes) - 2 * HALF)}:
                    vectors.append(term[at : at + 2 * HALF].sum(0, keepdims=True))
                    owner.append(k)
                if self._unsure(np.concatenate(vectors[1 + first :]), len(hashes)):
                    unsure.update(range(first, len(owner)))
                    for at in range(0, len(hashes), 2 * HALF):
                        self._post(hashes[at : at + 2 * HALF], term[at : at + 2 * HALF, -1], k, posted)
        self._index(posted)
        order = np.argsort(np.concatenate(grams), kind="stable")
        self.grams, self.gram_owner = np.concatenate(grams)[order], np.array(gram_owner, np.int64)[order]
        v = np.concatenate(vectors)[:, :-1]
        norm = np.sqrt((v**2).sum(1))
        self.vectors, self.owner = v / np.where(norm > 0, norm, 1)[:, None], np.array(owner, np.int64)
        sure = np.array([i not in unsure for i in range(len(owner))], bool) & (norm > 0)
        self.searched, self.searched_owner = np.ascontiguousarray(self.vectors[sure].T), self.owner[sure]
        self.flat = np.concatenate([np.zeros(0, U), *(np.array(w, U) for w in self.words)])
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.begins = np.cumsum(self.length) - self.length
        self.anchors = {}
        for size, held in anchors.items():
            held.sort()
            run, item, at = (np.array(x, t) for x, t in zip(zip(*held, strict=True), (U, np.int64, np.int64), strict=True))
            known = np.zeros(1 << FILTER_BITS, bool)
            known[run >> U(64 - FILTER_BITS)] = True
            self.anchors[size] = run, item, at, known

    @staticmethod
    def _unsure(sums: np.ndarray, n: int) -> bool:
        """Whether a copy of some passage of an item of ``n`` words may fall below CLOSE in the basis.

        Of a copy's passage, three quarters of the item's words at least are in one passage of the text.
        """
        whole = sums[:, -1]
        kept = np.sqrt((sums[:, :-1] ** 2).sum(1)[whole > 0] / whole[whole > 0])
        return bool((kept * np.sqrt(0.75 * min(1.0, n / (2 * HALF))) < SURE * CLOSE).any())

    def _post(self, hashes: np.ndarray, weight: np.ndarray, item: int, posted: list) -> None:
        """Files a piece under its rarest weighing words, all but one in COMMON of them."""
        m = int((weight > 0).sum())
        if not m:
            return
        rare = np.argsort(-weight, kind="stable")[: m - m // COMMON]
        terms = np.unique(_bucket(hashes[rare]))
        # at most m - PARAPHRASE * m words are missing
        self.least_hits.append(max(1, len(rare) - int((1 - PARAPHRASE) * m + 1e-9)))
        posted.append((terms, np.full(len(terms), len(self.piece_owner))))
        self.piece_owner.append(item)

    def _index(self, posted: list) -> None:
        """Postings of terms: pieces ``posting[begin[term]:begin[term + 1]]``."""
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in posted)])
        pieces = np.concatenate([np.zeros(0, np.int64), *(p for _, p in posted)])
        self.posting = pieces[np.argsort(terms, kind="stable")]
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=1 << BITS))))
        self.piece_owner, self.least_hits = np.array(self.piece_owner, np.int64), np.array(self.least_hits, np.int64)

    def verbatim(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """``(text, item, first word)`` of whole, verbatim copies of items."""
        out = [np.zeros((0, 3), np.int64)]
        for size, (run, item, at, known) in self.anchors.items():
            runs = windows(hashes, size)
            place = np.flatnonzero(known[runs >> U(64 - FILTER_BITS)])
            lo, hi = (np.searchsorted(run, runs[place], side) for side in ("left", "right"))
            n = hi - lo
            place = np.repeat(place, n)
            j = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start, k = place - at[j], item[j]
            text = np.searchsorted(words.first, place, "right") - 1
            whole = (start >= words.first[text]) & (start + self.length[k] <= words.first[text + 1])
            start, k, text = start[whole], k[whole], text[whole]
            for part in (0.0, 1.0, 0.5):  # most that differ do so at an end or in the middle
                off = ((self.length[k] - 1) * part).astype(np.int64)
                same = hashes[start + off] == self.flat[self.begins[k] + off]
                start, k, text = start[same], k[same], text[same]
            same = [np.array_equal(hashes[a : a + m], self.flat[b : b + m]) for a, b, m in zip(start, self.begins[k], self.length[k], strict=True)]
            out.append(np.stack((text, k, start - words.first[text]), 1)[np.array(same, bool)])
        return np.concatenate(out)

    def by_grams(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """``(text, item, first word)`` of half passages with a run of words of an item of hardly any weighing ones."""
        if not len(self.grams):
            return np.zeros((0, 3), np.int64)
        runs = _grams(hashes)
        lo = np.searchsorted(self.grams, runs)
        n = np.searchsorted(self.grams, runs, "right") - lo
        text = np.searchsorted(words.first, np.arange(len(runs)), "right") - 1
        n[np.arange(len(runs)) + LEAST_WORDS > words.first[text + 1]] = 0
        at = np.repeat(np.arange(len(runs)), n)
        item = self.gram_owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return np.unique(np.stack((text[at], item, (at - words.first[text[at]]) // HALF * HALF), 1), axis=0)

    def by_rare_words(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """``(text, item, first word)`` of stretches of four half passages with enough words of a piece."""
        if not len(self.posting):
            return np.zeros((0, 3), np.int64)
        bucket = _bucket(hashes)
        count = np.diff(words.first)
        halves = -(-count // HALF)
        base = np.cumsum(halves) - halves
        text = np.repeat(np.arange(len(count)), count)
        half = base[text] + (np.arange(len(bucket)) - words.first[text]) // HALF
        many = self.begin[bucket + 1] - self.begin[bucket]
        pieces, out = len(self.piece_owner), []
        ends = np.cumsum(many)
        lo = 0
        while lo < len(bucket):  # a bounded number of postings at a time, cut between texts' words with an overlap
            hi = max(lo + 8 * HALF, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _POSTINGS)))
            hi = min(len(bucket), hi)
            n = many[lo:hi]
            at = np.repeat(self.begin[bucket[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key, hits = np.unique(np.repeat(half[lo:hi], n) * pieces + self.posting[at], return_counts=True)
            starts = (key[:, None] - np.arange(4) * pieces).ravel()
            key, back = np.unique(starts, return_inverse=True)
            total = np.bincount(back.ravel(), np.repeat(hits, 4), len(key))
            piece = key % pieces
            enough = (total >= self.least_hits[piece]) & (key >= 0)
            out.append(np.stack((key[enough] // pieces, self.piece_owner[piece[enough]]), 1))
            if hi == len(bucket):
                break
            lo = max(lo + 1, hi - 5 * HALF)
        found = np.unique(np.concatenate(out), axis=0)
        # a stretch that begins in the text before belongs to no leak: its own text's first half begins one too
        owner = np.repeat(np.arange(len(count)), halves)[found[:, 0]]
        return np.stack((owner, found[:, 1], (found[:, 0] - base[owner]) * HALF), 1)


    def near(self, vectors: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(text, item, first word)`` of passages within CLOSE of an item's, and the cosines."""
        norm = np.sqrt(vectors[:, -1])
        norm[norm == 0] = np.inf
        hits, cosines = [np.zeros((0, 3), np.int64)], [np.zeros(0)]
        for at in range(0, len(vectors), 8192):
            dot = vectors[at : at + 8192, :-1] @ self.searched
            hit = np.flatnonzero((dot >= CLOSE * norm[at : at + 8192, None]).ravel())
            if len(hit):
                p, q = np.divmod(hit, dot.shape[1])
                hits.append(np.stack((text[at + p], self.searched_owner[q], start[at + p]), 1))
                cosines.append(dot.ravel()[hit] / norm[at + p])
        return np.concatenate(hits), np.concatenate(cosines)

    def leaks(self, words: Words, hashes: np.ndarray, rows: np.ndarray) -> dict[str, list]:
        """Text, item, cosine, lcs and answer of the leaks in a round of texts."""
        vectors, text, start = _passages(words, hashes, rows)
        near, cosine = self.near(vectors, text, start)
        copies = self.verbatim(words, hashes)
        exact = np.concatenate((copies, self.by_rare_words(words, hashes), self.by_grams(words, hashes)))
        out = {"at": [], "item": [], "cosine": [], "lcs": [], "answer": []}
        found = np.concatenate((near, exact))
        if not len(found):
            return out
        cosine = np.append(cosine, np.full(len(exact), np.nan))
        whole = {(int(t), int(k)) for t, k, _ in copies}
        key = found[:, 0] * len(self.ids) + found[:, 1]
        order = np.argsort(key, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            t, item = int(found[group[0], 0]), int(found[group[0], 1])
            if (t, item) in whole:
                leak = (True, 1.0, 1.0)
            else:
                a, total = words.first[t], words.first[t + 1] - words.first[t]
                regions = _regions(np.unique(found[group, 2]), len(self.words[item]), int(total))
                leak = max(_verdict(self.words[item], self.weighing[item], self.answers[item], hashes[a + lo : a + hi].tolist()) for lo, hi in regions)
            if leak[0]:
                near = cosine[group]
                if np.isnan(near).all():  # found by words: the cosine of its passages nearest the item's
                    own = np.flatnonzero(text == t)
                    own = own[np.isin(start[own] // HALF, _around(found[group, 2]))]
                    norm = np.sqrt(vectors[own, -1:])
                    near = ((vectors[own, :-1] / np.where(norm > 0, norm, 1)) @ self.vectors[self.owner == item].T).ravel()
                for n, v in zip(out, (t, item, float(np.nanmax(near)) if len(near) else None, *leak[1:]), strict=True):
                    out[n].append(v)
        return out


def _regions(starts: np.ndarray, n: int, total: int) -> list[tuple[int, int]]:
    """Stretches of words around candidate passages of one text and item of ``n`` words; overlapping ones joined."""
    out: list[list[int]] = []
    for s in np.sort(starts):
        a, b = max(0, int(s) - n), min(total, int(s) + 2 * HALF + n)
        if out and a <= out[-1][1] - n:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _around(starts: np.ndarray) -> np.ndarray:
    """Half passages of the stretches that begin at ``starts``, and the one before."""
    return (starts[:, None] // HALF + np.arange(-1, 4)).ravel()


def _verdict(item: list[int], weighing: list[int], answer: list[int], region: list[int]) -> tuple[bool, float, float]:
    """(leak, part of the item in order, part of its answer in order) of a region of words; zeros where its content is missing."""
    if len(weighing) > HARDLY and common_subsequence(weighing, region) / len(weighing) < PARAPHRASE:
        return False, 0.0, 0.0
    whole = common_subsequence(item, region) / len(item)
    told = common_subsequence(answer, region) / len(answer)
    if len(weighing) <= HARDLY:  # without weighing words a long item counts by its runs of words, a short one only as a whole
        content = in_runs(item, region) if len(item) >= 2 * HALF else float(whole == 1)
        return content >= PARAPHRASE and (whole >= VERBATIM or told >= ANSWER), whole, told
    return whole >= VERBATIM or told >= ANSWER, whole, told


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, item_id, cosine, lcs, answer)``: items that a document repeats or paraphrases.

    ``lcs``: part of the item's words found in order; ``answer``: part of its answer's.  A pair is
    returned once a document row, with its best region, where the item stands verbatim, or at least PARAPHRASE
    of its weighing words are there in order, and VERBATIM of all its words or ANSWER of its answer.  Words are
    runs of letters and digits, in lower case.  Whole texts are read.  Null and empty texts have no passages;
    items without a word are not looked for, those of fewer than LEAST_WORDS words count verbatim only, and those
    of hardly any weighing words verbatim or where a run of LEAST_WORDS of theirs stands in a text.
    Repeated items and rows, and equal scores, are reported each; null ids pass through; extra columns, whatever
    their names, are ignored.  Empty tables give no rows.  The benchmark is read ITEMS_A_PASS items at a time, so
    what is sent to tasks is bounded.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    out_schema = f"id {kind}, item_id {item_kind}, cosine double, lcs double, answer double"
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    n_docs, df, tasks = document_frequencies(docs, text_col, benchmark_runs(items))
    idf = np.where(df <= max(STOP * n_docs, STOP_LEAST), np.log((n_docs + 2) / (df + 1)), 0.0)
    # a task's sums have one size, so a task reads several input partitions where there are many
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, tasks // INPUTS_A_TASK)
    basis = latent_basis(docs.select(F.col(text_col).alias("text")), items, idf, tasks=tasks)
    # a word's part of a passage's vector and, last, of its squared norm
    rows = np.concatenate((idf[:, None] * basis, idf[:, None] ** 2), 1).astype(np.float32)
    sc = docs.sparkSession.sparkContext
    shared_rows = sc.broadcast(rows)
    n_items = items.count()
    passes = max(1, -(-n_items // ITEMS_A_PASS))
    out = None
    for k in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        held = part.orderBy("item", "text").collect()
        shared = sc.broadcast(Benchmark([r.item for r in held], [r.text for r in held], rows))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench, terms = shared.value, shared_rows.value
            for batch in batches:
                for row, to, words, hashes in _read(batch.column("text")):
                    if not len(hashes) or not bench.ids:
                        continue
                    found = bench.leaks(words, hashes, terms)
                    if found["at"]:
                        at = pa.array([row + t for t in found["at"]])
                        kept = [batch.column("id").take(at), pa.array([bench.ids[i] for i in found["item"]]), *(pa.array(found[n], pa.float64()) for n in ("cosine", "lcs", "answer"))]
                        yield pa.RecordBatch.from_arrays(kept, names=["id", "item_id", "cosine", "lcs", "answer"])

        pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(search, out_schema)
        out = pairs if out is None else out.unionByName(pairs)
    return out


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "cosine", "lcs", "answer")
