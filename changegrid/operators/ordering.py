"""Consecutive numbers in an order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.sources.staging import stage


def number_rows(rows: DataFrame, order: list[str], by: list[str] | None = None, name: str = "number") -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3, ... in the order of the columns ``order``, beginning anew for each ``by``.

    Rows are range partitioned, sorted and numbered within their partition, and written.  A partition's offset is the
    number of rows in those before it: one count a partition on the driver.  Rows that tie are numbered arbitrarily.
    """
    by = by or []
    ordered = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    at = F.monotonically_increasing_id()
    held = stage(ordered.withColumns({"_part": F.shiftright(at, 33), "_at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    before, offsets = 0, []
    for part, n in sorted(tuple(r) for r in held.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += n
    known = rows.sparkSession.createDataFrame(offsets, "_part long, _before long")
    out = held.join(known, "_part").withColumn(name, F.col("_at") + F.col("_before") + 1).drop("_part", "_at", "_before")
    if not by:
        return out
    # null keys are a group of their own
    keys = [F.col(c).alias(f"_{c}") for c in by]
    firsts = out.groupBy(*keys).agg(F.min(name).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return out.join(firsts, same).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first", *[f"_{c}" for c in by])
