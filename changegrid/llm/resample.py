"""Target-distribution importance resampling: array-scored weights, then a distributed LSD radix sort.

Hashed n-gram features of all documents and of a target set give every bucket a gain, the log ratio of its smoothed
frequencies.  A document's weight is the mean gain of its features; weight plus Gumbel noise, drawn from a hash of its
id, is its score, and the highest scores are a sample without replacement in proportion to exp(weight).

Ranks come from a radix sort.  The composite key (score downwards, then id, then number of features) is cut into digits
of 11 bits; digits in which no two rows differ are left out.  A pass, from the least digit up:

1. rows lie in blocks by their place so far; (block, digit) pairs are counted, combined before the shuffle;
2. offsets: the sum over all smaller digits, and over the same digit in earlier blocks.  The sums by digit are a table
   of at most 2,048 rows, those by block a window in each digit, so no task sees all counts;
3. each block puts its rows into place order, takes a stable counting sort by digit and gives each row its
   destination, offset plus rank within (block, digit).

Rows are written after each pass under the shared folder, so places never change when an executor is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changegrid.llm.words import word_rounds
from changegrid.sources.staging import stage

BUCKETS, SCALE = 10_000, 1000
DIGIT_BITS = 11
#: Rows of one block of the sort.
BLOCK_ROWS = 1 << 18
#: ASCII letters in lower case, digits and bytes beyond ASCII are parts of words; other bytes separate.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_LONG = 64


def _crc_table() -> np.ndarray:
    """Step of the CRC for every low byte: the reflected polynomial 0xEDB88320, eight bits at a time."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    return step


_CRC = _crc_table()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings ``data[start:end]``, those still unfinished a byte at a time."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, _LONG + 1).astype(np.int8), kind="stable")
    begin, short = starts[order], size[order]
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    left = np.searchsorted(-short, -np.arange(1, _LONG + 1), "right") if len(short) and short[0] <= _LONG else np.array([np.count_nonzero(size >= k) for k in range(1, _LONG + 1)])
    for k, n in enumerate(left):
        if not n:
            break
        part = crc[:n]
        crc[:n] = _CRC[(part ^ data[begin[:n] + k]) & 0xFF] ^ (part >> 8)
    out = np.empty_like(crc)
    out[order] = ~crc
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    return out


def _features(texts: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(row from, row to, row of each feature counted from the first, bucket of each, how many are single words).

    Single words come first.
    """
    for row, to, words, first in word_rounds(texts, most - 1, table=_FOLD):
        data, starts, ends = words.joined() if most > 1 else (words.data, words.starts, words.ends)
        text = words.text()
        rows, found = [], []
        for size in range(1, most + 1):
            at = words.whole_windows(size)
            if first:  # a later piece of a long text: its first words have been counted
                at = at[at + size > most - 1]
            rows.append(text[at])
            found.append(crc32(data, starts[at], ends[at + size - 1]) % np.uint32(BUCKETS))
        yield row, to, np.concatenate(rows), np.concatenate(found), len(rows[0])


def bucket_counts(texts: DataFrame, text_col: str = "text", most: int = 1) -> DataFrame:
    """``(bucket, n)``: features of all whole texts; each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, found, _ in _features(batch.column(0), most):
                total += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket from the two tables of counts: at most ``BUCKETS`` rows each reach the driver."""
    held = []
    for table in (source, target):
        counts = np.zeros(BUCKETS, np.int64)
        found = table.toArrow()
        counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
        held.append(counts.tolist())
    s, t = held
    all_s, all_t = sum(s) + BUCKETS, sum(t) + BUCKETS
    return np.array([math.floor(SCALE * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t, strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = 1) -> DataFrame:
    """``(id, n_words, n_features, weight)`` for every row: the floored mean gain of its features, 0 without any."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            n = batch.num_rows
            words, sums, counts = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for row, to, rows, found, single in _features(batch.column("text"), most):
                words[row:to] += np.bincount(rows[:single], minlength=to - row)
                counts[row:to] += np.bincount(rows, minlength=to - row)
                np.add.at(sums[row:to], rows, gain[found])
            weight = np.where(counts > 0, sums // np.maximum(counts, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words), pa.array(counts), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in ``1 / SCALE`` from the SHA-256 of ``seed:id``; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def radix_ranks(rows: DataFrame, keys: list[Column], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3, ...) in ascending order of ``keys``, most significant first; ties arbitrary.

    Keys are longs without nulls.  An empty table gives an empty result.
    """
    names = [f"key{i}" for i in range(len(keys))]
    # unsigned order: the sign bit turned
    held = rows.select("*", *[k.cast("long").bitwiseXOR(F.lit(-(1 << 63))).alias(n) for k, n in zip(keys, names, strict=True)])
    # a first place: the partition is the block
    held = stage(held, "radix-rows")
    held = stage(held.withColumn("block", F.spark_partition_id().cast("long")).withColumn("place", F.monotonically_increasing_id()), "radix-start")
    differ = held.agg(*[F.bit_or(n).bitwiseXOR(F.bit_and(n)).alias(n) for n in names]).first()
    mask = (1 << DIGIT_BITS) - 1
    digits = [(n, shift) for n in reversed(names) for shift in range(0, 64, DIGIT_BITS) if ((differ[n] or 0) >> shift) & mask]
    first = True
    for name, shift in digits or [(names[0], 0)]:
        held = _pass(held, F.shiftrightunsigned(F.col(name), shift).bitwiseAND(mask).cast("int"), block_rows, first)
        first = False
    return held.withColumn("rank", F.col("place") + 1).drop(*names, "block", "place")


def _pass(held: DataFrame, digit: Column, block_rows: int, first: bool) -> DataFrame:
    """One stable counting-sort pass over all blocks."""
    held = held.withColumn("digit", digit)
    counts = stage(held.groupBy("digit", "block").agg(F.count("*").alias("n")), "radix-counts")
    by_digit = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    below = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # one row a digit: 2,048 at most
    bases = by_digit.select("digit", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("digit", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).join(bases, "digit")
    offsets = offsets.select("block", "digit", (F.col("before") + F.col("base")).alias("offset"))
    columns = [f for f in held.schema.fields if f.name != "digit"]
    out = T.StructType(columns)

    def send(rows: pa.Table, offsets: pa.Table) -> pa.Table:
        place = rows["place"].to_numpy()
        if first:  # places of the first pass have gaps
            order = np.argsort(place)
        else:  # places are whole: a scatter
            order = np.empty(len(place), np.int64)
            order[place - place.min()] = np.arange(len(place))
        digits = rows["digit"].to_numpy()[order].astype(np.int16)
        stable = np.argsort(digits, kind="stable")  # a counting sort for 16-bit values
        ordered = digits[stable]
        begins = np.searchsorted(ordered, ordered)  # first of each digit
        table = np.zeros(1 << DIGIT_BITS, np.int64)
        table[offsets["digit"].to_numpy()] = offsets["offset"].to_numpy()
        to = table[ordered] + np.arange(len(ordered)) - begins
        taken = rows.take(pa.array(order[stable]))
        taken = taken.set_column(taken.schema.get_field_index("place"), "place", pa.array(to))
        taken = taken.set_column(taken.schema.get_field_index("block"), "block", pa.array(to // block_rows))
        return taken.select([f.name for f in columns])

    moved = held.groupBy("block").cogroup(offsets.groupBy("block")).applyInArrow(send, out)
    return stage(moved, "radix-pass")


def resample(docs: DataFrame, target: DataFrame, per_cent: int = 10, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", most: int = 1, seed: int = 2024) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` for every row of ``docs``; ``rank`` is null where it is not drawn.

    Of the documents with ``least_words`` words or more, ``per_cent`` in a hundred are drawn, highest scores first, ties
    to the smaller id, then to the fewer features; rows equal in all these are ranked arbitrarily.  Ids are integers;
    a null id counts as empty for the noise and stands after all others.  Null and empty texts have no features, weight
    0 and are never drawn unless ``least_words`` is 0.  Long texts are read in pieces.  An empty table gives an empty
    result, an empty target is a target without features; extra columns, whatever their names, are ignored.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError("ids must be integers: they are a part of the sort key")
    gain = gains(bucket_counts(docs, text_col, most), bucket_counts(target, target_col, most))
    scored = weigh(docs, gain, id_col, text_col, most).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = stage(scored, "resample-scored")
    may = F.col("n_words") >= least_words
    n_drawn = scored.where(may).count() * per_cent // 100
    keys = [-F.col("score"), F.col("id").isNull().cast("long"), F.coalesce(F.col("id"), F.lit(0)), F.col("n_features")]
    ranked = radix_ranks(scored.where(may), keys).withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(docs, benchmark).withColumnRenamed("id", "doc_id")


#: CRC-32 by words: DuckDB has none, so a table of 256 steps and a fold over each distinct word's bytes.
OP13_SQL = r"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8
), steps AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
folded AS (
  SELECT doc_id, 0 AS kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT item_id, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), words AS (SELECT doc_id, kind, unnest(w) AS word FROM folded),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
crcs AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 1 + 2 * i, 2))::BIGINT)),
    lambda c, x: xor(t[1 + xor(c & 255, x)], c >> 8)), 4294967295) % 10000 AS bucket
  FROM hexed, steps
), hit AS (SELECT doc_id, kind, bucket FROM words JOIN crcs USING (word)),
counts AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM hit GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE)) AS gain FROM counts, totals),
weights AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(g.weight, 0)::BIGINT AS weight FROM folded d
  LEFT JOIN (SELECT doc_id, floor(sum(gain) / count(*)) AS weight FROM hit JOIN gains USING (bucket) WHERE kind = 0 GROUP BY doc_id) g USING (doc_id) WHERE d.kind = 0
), scored AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weights
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY (n_features >= 20) DESC, score DESC, doc_id) AS r, (count(*) FILTER (n_features >= 20) OVER ()) * 10 // 100 AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= n THEN r END AS rank FROM ranked
"""
