"""Cell hashing of boxes: equi-joins on cells of a box's own size with an exact test behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cells_of(lo: Column, hi: Column, size: Column) -> Column:
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def level_of(cell: float) -> Column:
    """Doublings of ``cell`` until a cell is no smaller than the rectangle, so that it lies in four cells at most."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return F.greatest(F.lit(0), F.least(F.lit(60), F.ceil(F.log2(side / cell)))).cast("int")


def levels_of(rects: DataFrame, cell: float) -> list[int]:
    """The levels that occur, 61 numbers at most."""
    return sorted(r[0] for r in rects.select(level_of(cell)).distinct().collect())


def near_pairs(left: DataFrame, right: DataFrame, cell: float = 500.0, by: list[str] | None = None, touch: bool = True) -> DataFrame:
    """Pairs of rows whose boxes ``(x0, y0, x1, y1)`` overlap or, with ``touch``, meet; columns prefixed p and q, but ``by``.

    Boxes are dealt to cells of their own size (``cell``, doubled), four at most, and to those of larger ones that
    occur; a pair meets in the first cell it shares, of the larger one's size.  ``by``: columns that must be equal.
    """
    by = by or []
    levels = sorted({*levels_of(left, cell), *levels_of(right, cell)}) or [0]
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))

    def dealt(df: DataFrame, p: str) -> DataFrame:
        """Each box's cells at its own level and at those above, where it meets larger ones."""
        own = df.select(*by, *[F.col(c).alias(f"{p}{c}") for c in df.columns if c not in by], level_of(cell).alias(f"{p}l"))
        out = own.withColumn("level", F.explode(F.array(*map(F.lit, levels)))).where(F.col("level") >= F.col(f"{p}l"))
        return out.withColumn("cx", F.explode(cells_of(F.col(f"{p}x0"), F.col(f"{p}x1"), size))).withColumn("cy", F.explode(cells_of(F.col(f"{p}y0"), F.col(f"{p}y1"), size)))

    low, high = [F.greatest(f"p{a}0", f"q{a}0") for a in "xy"], [F.least(f"p{a}1", f"q{a}1") for a in "xy"]
    first = (F.col("level") == F.greatest("pl", "ql")) & (F.col("cx") == F.floor(low[0] / size)) & (F.col("cy") == F.floor(low[1] / size))
    meet = [h >= n if touch else h > n for n, h in zip(low, high, strict=True)]
    return dealt(left, "p").join(dealt(right, "q"), [*by, "level", "cx", "cy"]).where(meet[0] & meet[1] & first).drop("level", "cx", "cy", "pl", "ql")
