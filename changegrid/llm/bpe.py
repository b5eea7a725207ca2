"""Byte-level BPE: pre-tokenisation by array work, merges by a cache, decoding by token offsets.

Texts are split where the pattern of the rank files splits them, without a regular expression.  Every character gets a
symbol from its codepoint class and the next two characters; a symbol is a *transition function* on eight states (in
letters, in digits, after an optional space, inside a contraction, ...).  Functions compose associatively, so the states
are found by a scan: all blocks of characters compose theirs at once, the blocks' functions are scanned by doubling, and
one more pass with the right state at each block marks the characters that begin a slice.  A symbol that begins a text
maps every state to one, so one scan covers many texts.

A slice is a vocabulary entry or is merged, lowest rank first, leftmost of equals; the result is cached.  A long slice
is first cut between bytes that stand side by side in no vocabulary entry: no merge crosses there.

The codepoint classes are those of the tiktoken library's own Unicode tables, asked for once on the driver.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import ROUND_BYTES, rounds

LETTER, DIGIT, OTHER, SPACE, WHITE = range(5)
#: Symbols: classes with what follows folded in; SHORT and LONG are apostrophes before one or two letters of a
#: contraction, LAST_* white space before a character that is none.  FIRST is added at the start of a text.
_LETTER, _DIGIT, _OTHER, _SHORT, _LONG, _LAST_SPACE, _LAST_WHITE, _WHITE, FIRST = range(9)
_IDENTITY = 16
#: States: a slice has just ended, in letters, digits, others, after a space that belongs to the next slice, in white
#: space, one or two letters of a contraction to come.
ENDED, IN_LETTERS, IN_DIGITS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_MORE, TWO_MORE = range(8)
#: White space, and what follows an apostrophe in a contraction.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters of a block of the scan; slices up to SHORT_SLICE bytes are merged by looking at all pairs, and cached.
BLOCK, SHORT_SLICE, CACHE = 128, 64, 1 << 19


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "begins a slice" for every (symbol, state), flat."""
    step, begins = np.zeros((_IDENTITY + 1, 8), np.uint8), np.ones((_IDENTITY + 1, 8), bool)
    joins = {_LETTER: (IN_LETTERS, AFTER_SPACE, ONE_MORE, TWO_MORE), _DIGIT: (IN_DIGITS, AFTER_SPACE), _OTHER: (IN_OTHERS, AFTER_SPACE), _WHITE: (IN_WHITE,)}
    for symbol, to in ((_LETTER, IN_LETTERS), (_DIGIT, IN_DIGITS), (_OTHER, IN_OTHERS), (_LAST_SPACE, AFTER_SPACE), (_LAST_WHITE, ENDED), (_WHITE, IN_WHITE)):
        step[symbol] = to
        begins[symbol, list(joins.get(symbol, ()))] = False
    step[_LETTER, [ONE_MORE, TWO_MORE]] = ENDED, ONE_MORE
    for symbol, to in ((_SHORT, ONE_MORE), (_LONG, TWO_MORE)):  # inside other characters an apostrophe is one of them
        step[symbol], begins[symbol] = step[_OTHER], begins[_OTHER]
        step[symbol, begins[symbol]] = to
    step[FIRST:_IDENTITY] = step[:FIRST, [ENDED]]
    step[_IDENTITY], begins[_IDENTITY] = np.arange(8), False
    return step.ravel(), begins.ravel()


_STEP, _BEGINS = _automaton()


def scan(symbols: np.ndarray) -> np.ndarray:
    """Which characters begin a slice, given their symbols."""
    n = len(symbols)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, _IDENTITY, np.uint8)
    padded[:n] = symbols
    by_place = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) << np.uint8(3)
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))  # each block's function so far
    for place in by_place:
        whole = _STEP[place[:, None] | whole]
    far = 1
    while far < blocks:
        whole[far:] = np.take_along_axis(whole[far:], whole[:-far].copy(), 1)
        far *= 2
    state = np.full(blocks, ENDED, np.uint8)
    state[1:] = whole[:-1, ENDED]
    begins = np.empty((BLOCK, blocks), bool)
    for i, place in enumerate(by_place):
        both = place | state
        begins[i], state = _BEGINS[both], _STEP[both]
    return begins.T.ravel()[:n]


def codepoint_classes() -> np.ndarray:
    """Class of every codepoint: white space as fixed above, letters and digits as the tiktoken library takes them."""
    import tiktoken

    every = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], "<u4").tobytes().decode("utf-32-le")
    single = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
        found = bytes(tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    out[list(WHITE_SPACE)] = WHITE
    out[0x20] = SPACE
    return out


class _Cache(dict):
    """Ids of slices, as bytes; what is missing is merged, and kept unless it is long."""

    def __init__(self, merge: Callable[[bytes], bytes]):
        self.merge = merge

    def __missing__(self, part: bytes) -> bytes:
        out = self.merge(part)
        if len(part) <= SHORT_SLICE:
            if len(self) >= CACHE:
                self.clear()
            self[part] = out
        return out


class Vocabulary:
    """Tokens by id, and the classes of codepoints; what the tasks need of it is built where it is first used."""

    def __init__(self, tokens: list[bytes | None], classes: np.ndarray):
        self.tokens, self.classes = tokens, classes
        self.ranks = {t: i for i, t in enumerate(tokens) if t is not None}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every byte")
        self.length = np.array([len(t or b"") for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)
        self.at = np.cumsum(self.length) - self.length
        self.joined = np.zeros((256, 256), bool)  # pairs of bytes that stand side by side in some token
        inside = np.ones(max(0, len(self.bytes) - 1), bool)
        ends = self.at[1:] - 1
        inside[ends[(ends >= 0) & (ends < len(inside))]] = False
        pairs = np.flatnonzero(inside)
        self.joined[self.bytes[pairs], self.bytes[pairs + 1]] = True
        self._cache = _Cache(self._ids_of)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Reads a file of lines ``base64 rank``."""
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[int(rank)] = base64.b64decode(token)
        return cls([ranks.get(i) for i in range(max(ranks) + 1)], codepoint_classes())

    def __reduce__(self):
        return Vocabulary, (self.tokens, self.classes)

    # -- slices -----------------------------------------------------------------------------------

    def _characters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and class of every character of UTF-8 bytes."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[at]
        kind = self.classes[lead]  # right for ASCII
        for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
            pick = np.flatnonzero((lead >= low) & (lead < high)) if high < 0x100 else np.flatnonzero(lead >= low)
            if len(pick):
                code = (lead[pick] & ((0x40 >> more) - 1)).astype(np.int64)
                for k in range(1, more + 1):
                    code = (code << 6) | (data[np.minimum(at[pick] + k, len(data) - 1)] & 0x3F)
                kind[pick] = self.classes[np.minimum(code, 0x10FFFF)]
        return at, kind

    def slices(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First bytes of the slices of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        if not len(data):
            return np.zeros(0, np.int64)
        at, kind = self._characters(data)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        begins = first[at]
        solid = kind < SPACE
        before_solid = np.zeros(len(at), bool)
        before_solid[:-1] = solid[1:] & ~begins[1:]
        symbols = np.where(solid, kind, np.where(before_solid, np.where(kind == SPACE, _LAST_SPACE, _LAST_WHITE), _WHITE)).astype(np.uint8)
        marks = np.flatnonzero(data[at] == 0x27)
        if len(marks):
            place = at[marks]
            end = offsets[np.searchsorted(offsets, place, "right")]
            one = np.where(place + 1 < end, data[np.minimum(place + 1, len(data) - 1)], 0)
            two = np.where(place + 2 < end, data[np.minimum(place + 2, len(data) - 1)], 0)
            for text in CONTRACTIONS:
                hit = (one == ord(text[0])) & ((two == ord(text[1])) if len(text) > 1 else True)
                symbols[marks[hit]] = _LONG if len(text) > 1 else _SHORT
        symbols[begins] += FIRST
        return at[scan(symbols)]

    def cut(self, data: np.ndarray, at: int) -> int:
        """A place from ``at`` on where a slice begins whatever stands around it, or the end of the text.

        Such places lie between characters of two classes, the second no white space, and before a space
        after a character that is none; an apostrophe or white space before a character decides nothing.
        """
        wide = 1 << 12
        while at < len(data):
            lo = at
            while lo > 0 and data[lo] & 0xC0 == 0x80:
                lo -= 1
            hi = min(len(data), lo + wide)
            while hi < len(data) and data[hi] & 0xC0 == 0x80:
                hi += 1
            place, kind = self._characters(data[lo:hi])
            left, right = kind[:-1], kind[1:]
            sure = (left < SPACE) & ((right == SPACE) | ((right < SPACE) & (left != right) & (data[lo:hi][place[:-1]] != 0x27)))
            found = np.flatnonzero(sure)
            if len(found):
                return lo + int(place[found[0] + 1])
            if hi == len(data):
                break
            at, wide = max(at + 1, lo + int(place[-1])), wide * 2
        return len(data)

    # -- merging ----------------------------------------------------------------------------------

    def _merge(self, part: bytes) -> list[int]:
        """Ids of one slice, or of a part of one that no merge leaves."""
        ranks = self.ranks
        whole = ranks.get(part)
        if whole is not None:
            return [whole]
        if len(part) > SHORT_SLICE:
            return self._merge_long(part)
        ends = list(range(len(part) + 1))
        pairs = [ranks.get(part[i : i + 2], 1 << 40) for i in range(len(part) - 1)]
        while pairs:
            best = min(pairs)
            if best == 1 << 40:
                break
            i = pairs.index(best)
            del ends[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(part[ends[i] : ends[i + 2]], 1 << 40)
            if i:
                pairs[i - 1] = ranks.get(part[ends[i - 1] : ends[i + 1]], 1 << 40)
        return [ranks[part[a:b]] for a, b in zip(ends, ends[1:], strict=False)]

    def _merge_long(self, part: bytes) -> list[int]:
        """The same by a heap of (rank, place) over a linked list."""
        ranks, n = self.ranks, len(part)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        rank = array("q", [ranks.get(part[i : i + 2], -1) for i in range(n - 1)] + [-1])
        heap = [(r << 40) | i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i = top & ((1 << 40) - 1)
            if rank[i] != top >> 40:
                continue
            j = after[i]
            k = after[j]
            after[i], rank[j] = k, -1
            if k < n:
                before[k] = i
            rank[i] = ranks.get(part[i : after[k]], -1) if k < n else -1
            if rank[i] >= 0:
                heapq.heappush(heap, (rank[i] << 40) | i)
            h = before[i]
            if h >= 0:
                rank[h] = ranks.get(part[h:k], -1)
                if rank[h] >= 0:
                    heapq.heappush(heap, (rank[h] << 40) | h)
        out, i = [], 0
        while i < n:
            out.append(ranks[part[i : after[i]]])
            i = after[i]
        return out

    def _ids_of(self, part: bytes) -> bytes:
        whole = self.ranks.get(part)
        if whole is not None:
            found = array("i", [whole])
        elif len(part) <= SHORT_SLICE:
            found = array("i", self._merge(part))
        else:
            view = np.frombuffer(part, np.uint8)
            cuts = [0, *(np.flatnonzero(~self.joined[view[:-1], view[1:]]) + 1).tolist(), len(part)]
            found = array("i")
            for a, b in zip(cuts, cuts[1:], strict=False):
                found.extend(self._merge(part[a:b]))
        return found.tobytes()

    # -- whole texts ------------------------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids before each text (and in all)."""
        starts = self.slices(data, offsets)
        raw, edges = data.tobytes(), starts.tolist()
        edges.append(len(raw))
        coded = list(map(self._cache.__getitem__, map(raw.__getitem__, map(slice, edges, edges[1:]))))
        ids = np.frombuffer(b"".join(coded), np.int32)
        upto = np.zeros(len(coded) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4, out=upto[1:])
        return ids, upto[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
        """The bytes of the tokens, each put where its offset says; ``ends`` are the tokens' ends, if known."""
        size = self.length[ids]
        ends = np.cumsum(size) if ends is None else ends
        out = np.arange(int(ends[-1]) if len(ends) else 0)
        out += np.repeat(self.at[ids] - (ends - size), size)
        return self.bytes[out]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, ends)`` for every row: the token ids of the whole text and the byte at which each token ends.

    ``text[ends[i - 1]:ends[i]]``, in bytes, is token i, so any stretch of ids leads back to its place in the text.
    A null or empty text gives empty arrays; repeated rows and null ids get a row each; an empty table gives none;
    extra columns, whatever their names, are ignored.  A long text is encoded in pieces cut at sure places, so beyond
    its own ids memory holds one piece and the longest slice.  Strings of special tokens are ordinary text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for row, to, data, offsets in rounds(batch.column("text")):
                if to - row > 1 or len(data) <= 2 * ROUND_BYTES:
                    ids, first = vocabulary.encode(data, offsets)
                else:
                    parts, at = [], 0
                    while at < len(data):
                        end = vocabulary.cut(data, at + ROUND_BYTES)
                        parts.append(vocabulary.encode(data[at:end], np.array([0, end - at]))[0])
                        at = end
                    ids = np.concatenate(parts)
                    first = np.array([0, len(ids)])
                ends = np.cumsum(vocabulary.length[ids])
                ends -= np.repeat(offsets[:-1], np.diff(first))
                places = pa.array(first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(places, pa.array(a)) for a in (ids, ends.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, to - row), *lists], names=["id", "ids", "ends"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, ends array<int>")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """(row, ids, ends) of a batch; null counts as empty, ends may be missing."""
    ids, empty = batch.column("ids"), np.zeros(0, np.int32)
    flat, at, there = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
    with_ends = "ends" in batch.schema.names
    if with_ends:
        ends = batch.column("ends")
        places, held = ends.offsets.to_numpy(), ends.values.to_numpy(zero_copy_only=False)
    for row in range(len(ids)):
        if there[row]:
            yield row, flat[at[row] : at[row + 1]], held[places[row] : places[row + 1]] if with_ends else None
        else:
            yield row, empty, None


def _pieces(ids: np.ndarray, ends: np.ndarray | None, size: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    for lo in range(0, len(ids), size):
        before = 0 if ends is None or lo == 0 else ends[lo - 1]
        yield ids[lo : lo + size], None if ends is None else ends[lo : lo + size].astype(np.int64) - before


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "id", ids_col: str = "ids", ends_col: str | None = None) -> DataFrame:
    """``(id, data)``: the bytes that the ids stand for; null or empty ids give none.

    ``ends_col`` names the tokens' offsets, if they were kept.  Ids may be any stretch of a text's, so the bytes need not
    be whole characters.  An id outside the vocabulary is an error.
    """
    kind = encoded.schema[id_col].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for row, ids, ends in _rows(batch):
                data = b"".join(vocabulary.decode(*p).tobytes() for p in _pieces(ids, ends))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, 1), pa.array([data], pa.binary())], names=["id", "data"])

    columns = [F.col(id_col).alias("id"), F.col(ids_col).alias("ids"), *([F.col(ends_col).alias("ends")] if ends_col else [])]
    return encoded.select(*columns).mapInArrow(run, f"id {kind}, data binary")


def digests(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: digests of the ids, joined by commas, and of the decoded bytes."""
    kind = encoded.schema["id"].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        decimal = [b"%d" % i for i in range(len(vocabulary.tokens))].__getitem__
        for batch in batches:
            counts, of_ids, of_data = [], [], []
            for _, ids, ends in _rows(batch):
                by_id, by_data = hashlib.sha256(), hashlib.sha256()
                for k, piece in enumerate(_pieces(ids, ends)):
                    by_id.update(b"," * (k > 0) + b",".join(map(decimal, piece[0].tolist())))
                    by_data.update(vocabulary.decode(*piece).tobytes())
                counts.append(len(ids))
                of_ids.append(by_id.hexdigest())
                of_data.append(by_data.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_data)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("id", "ids", "ends").mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_byte_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = Vocabulary.load(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(encode(docs, vocabulary), vocabulary).select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
