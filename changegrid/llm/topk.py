"""Exact top-k inner products: tiled matrix products, partial selection per tile, lists merged as a tree.

Vectors are packed into blocks of rows.  Candidate blocks are dealt to S shards and query blocks to B
groups; every (shard, group) cell gets its shard's blocks and its group's queries, so a cell is bounded
whatever the sizes, and all rows meet all queries once.  In a cell each tile is one matrix product,
of which only k columns a row survive; running lists merge across the cell's tiles.  The shards' lists
of a query then merge FAN at a time, level by level, so no task sees more than FAN lists of a query.

Components are split into limbs of LIMB bits where they are large, so that every partial product is exact in
float64; the limbs' products are put together in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a packed block; candidates of a shard; queries of a group; lists that one merge takes.
BLOCK, SHARD, GROUP, FAN = 1024, 8192, 8192, 16
#: Bits of a limb of a large component.
LIMB = 20
_EXACT, _LARGEST = float(1 << 53), float(np.finfo(np.float64).max)


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def pack(vectors: DataFrame, scale: float) -> DataFrame:
    """Blocks ``(dim, part, ids, matrix)`` of ``(id long, vector array)``, components floor(scale * x) as float64 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() * 1_000_003
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), BLOCK):
                    pick = rows[at : at + BLOCK]
                    flat = lists.take(pa.array(pick)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    with np.errstate(over="ignore"):
                        matrix = np.clip(np.floor(scale * flat), -_LARGEST, _LARGEST)
                    order = np.argsort(ids[pick], kind="stable")
                    matrix = matrix.reshape(len(pick), int(dim))[order]
                    part += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(dim)], pa.int32()), pa.array([part], pa.int64()), pa.array([ids[pick][order].astype(np.int64).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                        names=["dim", "part", "ids", "matrix"],
                    )

    return vectors.mapInArrow(run, "dim int, part long, ids binary, matrix binary")


def _limbs(m: np.ndarray) -> list[np.ndarray]:
    """Whole-valued float64 parts, each under 2**LIMB, that weigh 1, 2**LIMB, 2**(2 LIMB), ... and sum to ``m``."""
    out = []
    while True:
        high = np.trunc(m / (1 << LIMB))
        out.append(m - high * (1 << LIMB))
        if not high.any():
            return out
        m = high


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-valued rows, as int64: exact, and at the end of a long's range beyond it.

    Rows and columns with large components are worked out apart, so a few of them leave the others on the plain product.
    """
    dim = max(1, a.shape[1])
    top = np.abs(a).max(initial=0), np.abs(b).max(initial=0)
    if top[0] < _EXACT and top[1] < _EXACT and top[0] * top[1] * dim < _EXACT:
        return (a @ b.T).astype(np.int64)
    bound = (_EXACT / dim) ** 0.5 / 2
    large, wide = (np.flatnonzero(np.abs(x).max(1, initial=0) > bound) for x in (a, b))
    small, rest = np.setdiff1d(np.arange(len(a)), large), np.setdiff1d(np.arange(len(b)), wide)
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(small, rest)] = (a[small] @ b[rest].T).astype(np.int64)
    out[large] = _by_limbs(a[large], b)
    out[np.ix_(small, wide)] = _by_limbs(a[small], b[wide])
    return out


def _by_limbs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_product`` of large components by limbs; places where partial sums leave the range of a long by Python's integers."""
    step = 1 << (53 - 2 * LIMB)  # components whose limbs' products sum exactly
    total, beyond = np.zeros((len(a), len(b)), np.int64), np.zeros((len(a), len(b)), bool)
    if not total.size:
        return total
    for at in range(0, a.shape[1], step):
        for i, x in enumerate(_limbs(a[:, at : at + step])):
            for j, y in enumerate(_limbs(b[:, at : at + step])):
                part, up = (x @ y.T).astype(np.int64), LIMB * (i + j)
                if up >= 63:
                    beyond |= part != 0
                    continue
                beyond |= np.abs(part) >= 1 << (63 - up)
                part <<= up
                out = total + part
                beyond |= ((total ^ out) & (part ^ out)) < 0
                total = out
    rows = np.flatnonzero(beyond.mean(1) > 0.5)  # whole rows first, then what is left by columns
    total[rows] = _in_full(a[rows], b)
    beyond[rows] = False
    columns = np.flatnonzero(beyond.any(0))
    left = np.flatnonzero(beyond.any(1))
    total[np.ix_(left, columns)] = _in_full(a[left], b[columns])
    return total


def _in_full(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_product`` by Python's integers."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    whole = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
    return np.clip(whole, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best columns of each row, by score, then lower id: (scores, ids, out).

    ``scores`` are int64, columns are in order of id, and ``out`` marks places that take no part.
    """
    rows, n = scores.shape
    if n > k:
        # the k-th best score, then the first columns by id among those that reach it
        low = np.where(out, np.iinfo(np.int64).min, scores)
        at = np.argpartition(low, n - k, axis=1)[:, n - k :]
        floor = np.take_along_axis(low, at, 1).min(1, keepdims=True)
        above = low > floor
        level = (low == floor) & (np.cumsum(low == floor, axis=1) <= k - above.sum(1, keepdims=True))
        pick = np.nonzero(above | level)[1].reshape(rows, k)
    else:
        pick = np.broadcast_to(np.arange(n), scores.shape)
    found, gone = np.take_along_axis(scores, pick, 1), np.take_along_axis(out, pick, 1)
    return _ordered(found, ids[pick], gone, k)


def _ordered(scores: np.ndarray, ids: np.ndarray, out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~scores, out), axis=1)[:, :k]  # ~x falls as x rises, over the whole range
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, out))


def _merge_tree(lists: DataFrame, k: int, shards: int) -> DataFrame:
    """``(query_id, id, score, rank)`` of lists ``(query_id, s, id, score)``, FAN shards' lists a merge, level by level."""
    while True:
        shards = -(-shards // FAN)
        lists = lists.withColumn("s", F.floor(F.col("s") / FAN).cast("int"))
        rank = F.row_number().over(Window.partitionBy("query_id", "s").orderBy(F.desc("score"), "id"))
        lists = lists.withColumn("rank", rank).where(F.col("rank") <= k)
        if shards <= 1:
            return lists


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1.0) -> DataFrame:
    """``(query_id, rank, id, score)``: for each query its k best candidates by inner product of floor(scale * x).

    Exact over the range of a long; scores beyond it stand at its end, as do components that leave the range of a double
    when scaled.  Ties go to the smaller id; a
    candidate with the query's own id takes no part; fewer than k candidates: all.  Vectors that are null, or hold null or non-finite components, or whose id is null,
    are left out, and only vectors of equal length meet.  A query id given on several rows counts once
    (its least vector); candidates with a repeated id stay separate rows.  Extra columns, whatever their names,
    are ignored.  Empty inputs give no rows.
    """

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return df.where(F.col("id").isNotNull() & usable(F.col("vector")))

    base = clean(candidates)
    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-candidates.count() // SHARD))
    groups = max(1, -(-queries.count() // GROUP))
    left = pack(asked, scale).withColumn("b", F.pmod(F.xxhash64("part"), F.lit(groups)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = pack(base, scale).withColumn("s", F.pmod(F.xxhash64("part"), F.lit(shards)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def cell(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        blocks = []
        for r in held.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            blocks.append((r["dim"], ids, np.frombuffer(r["matrix"]).reshape(len(ids), r["dim"])))
        out = {"query_id": [], "id": [], "score": []}
        for r in asked.to_pylist():
            ask = np.frombuffer(r["ids"], np.int64)
            a = np.frombuffer(r["matrix"]).reshape(len(ask), r["dim"])
            lists = None
            for dim, ids, b in blocks:
                if dim != r["dim"]:
                    continue
                found = _best(_product(a, b), ids, ask[:, None] == ids[None, :], k)
                lists = found if lists is None else _ordered(*(np.concatenate((x, y), 1) for x, y in zip(lists, found, strict=True)), k)
            if lists is not None:
                keep = ~lists[2]
                out["query_id"].append(np.broadcast_to(ask[:, None], keep.shape)[keep])
                out["id"].append(lists[1][keep])
                out["score"].append(lists[0][keep])
        found = {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in out.items()}
        return pa.table({"s": np.full(len(found["id"]), key[0].as_py(), np.int32), **found})

    met = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(cell, "s int, query_id long, id long, score long")
    return _merge_tree(met, k, shards).select("query_id", "rank", "id", "score")


def op2_exact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5, scale=256.0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
) WHERE rank <= 5
"""
