"""Language ID by n-gram filters over a language bitmask.

Training counts byte n-grams (n = 3 and 5, over lower-cased letters, a word's borders being spaces) by
language.  An n-gram belongs to every language in which it is at least ``SHARE`` as frequent as in its
most frequent one.  Membership is kept in a bit-sliced Bloom filter: an array of words in which bit L of
a slot belongs to language L, so ANDing an n-gram's slots returns all languages that contain it at once.
A text's score for a language is the number of its n-grams found, corrected for false positives: with f
the language's false-positive rate and n n-grams, (found - f * n) / (1 - f).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.llm.words import ROUND_BYTES, U, mix, rounds
from changegrid.sources.staging import stage

SIZES = (3, 5)
SHARE = 0.5
#: ASCII: letters as they are, everything else a space; other bytes as they are.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


def held_out(id_col: Column, modulus: int = 3, remainder: int = 1) -> Column:
    """Whether crc32 of the id as text has that remainder; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _grams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of bytes, and which text each lies in (-1: across two)."""
    folded = _FOLD[data]
    size = max(0, len(folded) - n + 1)
    code = np.full(size, U(n))
    for i in range(n):
        code = (code << U(8)) | folded[i : i + size]
    return code, folded


def _padded(texts: pa.Array) -> pa.Array:
    """Texts in lower case between spaces."""
    space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    return pc.binary_join_element_wise(space, pc.utf8_lower(texts), space, none)


def _places(code: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(code.copy())
    return h & U(slots - 1), (h >> U(32)) & U(slots - 1)


class Filter:
    """The trained filter: ``table`` of ``slots`` bitmasks a word of 64 languages, false-positive rates, languages."""

    def __init__(self, langs: list[str], table: np.ndarray, fallback: int):
        self.langs, self.table, self.fallback = langs, table, fallback
        bits = [(table[:, k // 64] >> U(k % 64)) & U(1) for k in range(len(langs))]
        self.false = np.array([float(b.mean()) ** 2 for b in bits])

    def _count(self, data: np.ndarray, n: int, starts: np.ndarray, inside: np.ndarray | None, found: np.ndarray, total: np.ndarray) -> None:
        """Adds the n-grams of texts that begin at ``starts`` to ``total``, and those of each language to ``found``."""
        code, _ = _grams(data, starts, n)
        if not len(code):
            return
        a, b = _places(code, len(self.table))
        some, at = starts < len(code), np.minimum(starts, len(code) - 1)
        size = np.array([len(code)]) if inside is None else np.add.reduceat(inside, at, dtype=np.int64)
        total += np.where(some, size, 0)
        for word in range(self.table.shape[1]):
            mask = self.table[a, word] & self.table[b, word]
            if inside is not None:
                mask[~inside] = U(0)
            for k in range(word * 64, min(len(self.langs), word * 64 + 64)):
                bit = (mask >> U(k % 64)).astype(np.uint8) & np.uint8(1)
                found[:, k] += np.where(some, np.add.reduceat(bit, at, dtype=np.int64), 0)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected counts, one row a text and one column a language. Texts are padded, so none is empty."""
        n_texts = len(offsets) - 1
        found, total = np.zeros((n_texts, len(self.langs))), np.zeros(n_texts)
        if n_texts == 1:  # a long text in pieces: windows that begin in each
            for n in SIZES:
                for at in range(0, len(data), ROUND_BYTES):
                    self._count(data[at : at + ROUND_BYTES + n - 1], n, np.zeros(1, np.int64), None, found, total)
        else:
            for n in SIZES:
                if len(data) >= n:
                    # n-grams that cross into the next text count for neither
                    inside = np.ones(len(data) - n + 1, bool)
                    for end in offsets[1:-1]:
                        inside[max(0, end - n + 1) : end] = False
                    self._count(data, n, offsets[:-1], inside, found, total)
        return np.maximum(0.0, (found - self.false * total[:, None]) / (1 - self.false))


def train(labelled: DataFrame, text_col: str, lang_col: str, key: Column, sample_docs: int = 3000, slots: int = 1 << 19, least: int = 3) -> Filter:
    """Fits the filter on about ``sample_docs`` whole texts of each language, drawn by the hash of ``key``.

    The driver receives the language names and at most ``slots`` bitmasks for each 64 languages.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    langs = sorted(counts)
    if not langs:
        return Filter([], np.zeros((slots, 1), U), 0)
    index = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_docs / counts[lang]))])
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 20)) < F.element_at(share, F.col(lang_col)) * (1 << 20)
    sample = rows.where(draw).select(F.element_at(index, F.col(lang_col)).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            for k in np.unique(lang):
                for _, _, data, offsets in rounds(batch.column("text").take(pa.array(np.flatnonzero(lang == k))), prepare=_padded):
                    for n, at in ((n, at) for n in SIZES for at in range(0, len(data), ROUND_BYTES)):
                        codes, times = np.unique(_grams(data[at : at + ROUND_BYTES + n - 1], offsets, n)[0], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), k, np.int32)), pa.array(codes.view(np.int64)), pa.array(times.astype(np.int64))], names=["lang", "gram", "n"])

    grams = stage(sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    totals = {r[0]: r[1] for r in grams.groupBy("lang").agg(F.sum("n")).collect()}
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for k, v in totals.items() for x in (k, float(v))]), F.col("lang"))
    top = grams.groupBy("gram").agg(F.max(rate).alias("top"))
    kept = grams.where(F.col("n") >= least).join(top, "gram").where(rate >= SHARE * F.col("top")).select("lang", "gram")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            bit = (U(1) << (lang % 64).astype(U)).view(np.int64)
            for at in _places(batch.column("gram").to_numpy(zero_copy_only=False).view(U), slots):
                yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(lang // 64, pa.int32()), pa.array(bit)], names=["slot", "word", "bit"])

    placed = kept.mapInArrow(place, "slot long, word int, bit long").groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
    found = placed.toArrow()
    table = np.zeros((slots, -(-len(langs) // 64)), U)
    table[found["slot"].to_numpy(), found["word"].to_numpy()] = found["bits"].to_numpy().view(U)
    return Filter(langs, table, int(np.argmax([counts[x] for x in langs])))


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row: whole texts; ``und`` with score 0 if null or without a letter.

    ``score`` is the predicted language's part of the corrected counts.  A text in which no n-gram is
    known gets the language with most training texts, with score 1 / number of languages.  Of languages that tie, the
    first by name wins; a long text is read in pieces; repeated rows and null ids get a row each; an empty table gives none; extra columns,
    whatever their names, are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.fallback))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Filter(*shared.value)
        names = np.array([*model.langs, "und"], dtype=object)
        for batch in batches:
            for row, to, data, offsets in rounds(batch.column("text"), prepare=_padded):
                n = to - row
                known = batch.column("letters").slice(row, n).to_numpy(zero_copy_only=False).astype(bool)
                best, score = np.full(n, len(names) - 1), np.zeros(n)
                if model.langs:
                    counts = model.scores(data, offsets)
                    total = counts.sum(1)
                    best = np.where(total > 0, counts.argmax(1), model.fallback)
                    score = np.where(total > 0, counts.max(1) / np.where(total > 0, total, 1), 1 / len(model.langs))
                    best, score = np.where(known, best, len(names) - 1), np.where(known, score, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, n), pa.array(names[best], pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), letters.alias("letters")).mapInArrow(run, f"id {kind}, lang_pred string, score double")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))), "text", "lang", F.col("doc_id"))
    return predict(docs, model).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
