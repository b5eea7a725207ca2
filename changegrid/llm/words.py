"""Vectorised word positions and hashes over Arrow batches of texts.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D``; every such separator is one
byte in UTF-8, so words can be found on the bytes.  A word's hash is its XXH64 under a seed; a run's hash
is folded from its words' by doubling, each fold a bijective mix of a non-linear kind, so no arrangement of two
words (Thue-Morse runs, say) cancels out.  Two seeds give two independent hashes, 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that one round of array work covers; a longer text is cut into pieces of about as many.
ROUND_BYTES = 1 << 20
#: Seeds of the two independent hashes.
SEEDS = (0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D)
_FOLD_P = U(0x9FB21C651E98DF25)
#: Byte strings of at least LONG bytes are hashed one by one; the others, CHUNK at a time, by array work.
_LONG, _CHUNK = 96, 1 << 17
#: The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (U(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, ROUND_BYTES + 1)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, U(b))
            p[0] = U(1)
            out.append(np.multiply.accumulate(p))
        held = (out[0], out[1])
        if size == ROUND_BYTES + 1:  # those of one long text are not worth keeping
            _powers[base] = held
    return held


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (in place)."""
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U(by)) | (x >> U(64 - by))


def _lane(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def _xxh64_of_length(data: np.ndarray, starts: np.ndarray, length: int, seed: int) -> np.ndarray:
    """XXH64 of the byte strings of one length that begin at ``starts``."""
    n = len(starts)
    wide = np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))
    at = starts
    if length >= 32:
        acc = [np.full(n, U((seed + p) & ((1 << 64) - 1))) for p in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
        for stripe in range(length // 32):
            acc = [_lane(a, wide[at + (32 * stripe + 8 * i)]) for i, a in enumerate(acc)]
        h = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
        for a in acc:
            h = (h ^ _lane(np.zeros(n, U), a)) * _P1 + _P4
    else:
        h = np.full(n, U((seed + int(_P5)) & ((1 << 64) - 1)))
    h += U(length)
    done = length // 32 * 32
    while length - done >= 8:
        h = _turn(h ^ _lane(np.zeros(n, U), wide[at + done]), 27) * _P1 + _P4
        done += 8
    if length - done >= 4:
        half = np.ndarray((len(data) - 3,), "<u4", data, strides=(1,))
        h = _turn(h ^ half[at + done].astype(U) * _P1, 23) * _P2 + _P3
        done += 4
    for i in range(done, length):
        h = _turn(h ^ data[at + i].astype(U) * _P5, 11) * _P1
    h ^= h >> U(33)
    h *= _P2
    h ^= h >> U(29)
    h *= _P3
    return h ^ (h >> U(32))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of the byte strings ``data[start:end]``; those of one length are hashed together."""
    out = np.empty(len(starts), U)
    for lo in range(0, len(starts), _CHUNK):
        s, e = starts[lo : lo + _CHUNK], ends[lo : lo + _CHUNK]
        part = out[lo : lo + _CHUNK]
        length = np.minimum(e - s, _LONG).astype(np.int16)
        order = np.argsort(length, kind="stable")
        cuts = np.searchsorted(length[order], np.arange(_LONG + 2))
        for k in np.flatnonzero(np.diff(cuts)):
            pick = order[cuts[k] : cuts[k + 1]]
            if k < _LONG:
                part[pick] = _xxh64_of_length(data, s[pick], int(k), seed)
            else:
                part[pick] = [xxhash.xxh64_intdigest(data[s[i] : e[i]], seed) for i in pick]
    return out


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in their order."""
    return mix(a * _FOLD_P + b)


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` values, also of those that cross texts; folded from runs of powers of two."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out, at, run, width = None, 0, values, 1
    while True:
        if size & width:
            part = run[at : at + n]
            out = part if out is None else fold(out, part)
            at += width
        if at == size:
            return out.copy() if out is values else out
        run = fold(run[:-width], run[width:])
        width *= 2


class Words:
    """Words of a run of texts: bytes ``data``, word ``starts``/``ends`` in it and, for text i, words ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        solid = ~SEPARATOR[data]
        before = np.empty_like(solid)
        after = np.empty_like(solid)
        if len(solid):
            before[0], before[1:] = False, solid[:-1]
            after[-1], after[:-1] = False, solid[1:]
            before[offsets[:-1][offsets[:-1] < len(solid)]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, seed: int = SEEDS[0]) -> np.ndarray:
        """One 64-bit hash for each word."""
        return xxh64(self.data, self.starts, self.ends, seed)

    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def whole_windows(self, size: int) -> np.ndarray:
        """First words of the windows of ``size`` words that lie in one text."""
        at = np.arange(max(0, len(self.starts) - size + 1))
        return at[at + size <= np.repeat(self.first[1:], np.diff(self.first))[: len(at)]]

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space between those of a text, as bytes, and their places: (bytes, starts, ends)."""
        last = np.zeros(len(self.starts) + 1, bool)
        last[self.first[1:]] = True  # the word before has no space after it
        spaced = ~last[1:]
        keep = ~SEPARATOR[self.data]
        keep[self.ends[spaced]] = True
        out = self.data[keep]
        out[SEPARATOR[out]] = 0x20
        ends = np.cumsum(self.ends - self.starts + spaced) - spaced
        return out, ends - (self.ends - self.starts), ends


def rounds(texts: pa.Array, size: int | None = None, prepare: Callable[[pa.Array], pa.Array] | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a string array into runs of about ``size`` bytes: (row from, row to, bytes, offsets); null counts as empty.

    ``prepare`` maps each piece (lower case, padding) before it is cut, so copies stay small too.
    """
    size = size or ROUND_BYTES
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    step = max(1, int(n * size // max(1, texts.nbytes)))
    for at in range(0, n, step):
        part = pc.fill_null(texts.slice(at, step).cast(pa.large_string()), "")
        if prepare is not None:
            part = prepare(part)
        buffers, rows = part.buffers(), len(part)
        offsets = np.frombuffer(buffers[1], np.int64)[part.offset : part.offset + rows + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        row = 0
        while row < rows:
            to = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
            to = min(rows, max(to, row + 1))
            lo, hi = int(offsets[row]), int(offsets[to])
            yield at + row, at + to, data[lo:hi], offsets[row : to + 1] - lo
            row = to


def _separator_from(data: np.ndarray, at: int) -> int:
    """Place of the first separator at or after ``at``, or the end."""
    while at < len(data):
        found = np.flatnonzero(SEPARATOR[data[at : at + 4096]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def word_rounds(texts: pa.Array, overlap: int = 0, size: int | None = None, table: np.ndarray | None = None, prepare: Callable[[pa.Array], pa.Array] | None = None) -> Iterator[tuple[int, int, Words, int]]:
    """``rounds`` as words: (row from, row to, words, number in its text of the first word).

    A text of more than twice ``size`` bytes comes in pieces, each beginning with the last ``overlap``
    words of the one before and holding more than twice as many, so windows of up to ``overlap + 1``
    words lie whole in exactly one piece, and memory does not grow with the text.  ``table`` maps bytes.
    """
    size = size or ROUND_BYTES
    for row, to, data, offsets in rounds(texts, size, prepare):
        if to - row > 1 or len(data) <= 2 * size:
            yield row, to, Words(data if table is None else table[data], offsets), 0
            continue
        at = first = 0
        while True:
            wide = size
            while True:
                end = _separator_from(data, at + wide) if table is None else _mapped_from(data, at + wide, table)
                piece = data[at:end] if table is None else table[data[at:end]]
                words = Words(piece, np.array([0, end - at]))
                if end == len(data) or len(words.starts) > 2 * overlap:
                    break
                wide *= 2
            yield row, to, words, first
            if end == len(data):
                break
            step = len(words.starts) - overlap
            first += step
            at = at + int(words.starts[step]) if overlap else end


def by_text(pieces: Iterator[tuple[int, int, Words, int]], find: Callable[[Words], tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row from, row to, text, value) of ``word_rounds``: different values of each text, in order; pieces of a long text together.

    ``find`` gives the texts and values (whole numbers below 2**32) of a piece.
    """
    held = None
    for row, to, words, _ in pieces:
        text, value = find(words)
        both = np.unique(text.astype(np.int64) << 32 | value.astype(np.int64))
        if held is not None and held[0] == row:
            both = np.union1d(held[2], both)
        elif held is not None:
            yield held[0], held[1], held[2] >> 32, held[2] & 0xFFFFFFFF
        held = row, to, both
    if held is not None:
        yield held[0], held[1], held[2] >> 32, held[2] & 0xFFFFFFFF


def _mapped_from(data: np.ndarray, at: int, table: np.ndarray) -> int:
    """``_separator_from`` on mapped bytes."""
    while at < len(data):
        found = np.flatnonzero(SEPARATOR[table[data[at : at + 4096]]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)
