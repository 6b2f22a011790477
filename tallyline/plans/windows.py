"""Window shapes that hold when one group owns a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One row in so many, by a hash of its place, may begin a piece of its cell; a cell has at most so many pieces.
EVERY, PIECES = 1024, 256


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality in all columns, NULL being equal to NULL; those of ``right`` are named with ``_r`` behind."""
    return reduce(and_, [left[c].eqNullSafe(right[f"{c}_r"]) for c in columns])


def piece_begins(df: DataFrame, keys: list[str], order: list[str], cell: Column, every: int = EVERY, pieces: int = PIECES) -> DataFrame:
    """Where the pieces of cells of very many rows begin: ``_begins`` by keys and cell, named with ``_r`` behind.

    Only a sample of the rows is looked at, drawn by a hash of their keys and order.
    """
    drawn = df.withColumn("_at", cell)
    drawn = drawn.select(*[F.col(c).alias(f"{c}_r") for c in [*keys, "_at"]], F.struct(*order).alias("_begin"), F.xxhash64(*keys, *order).alias("_draw"))
    mine = [f"{c}_r" for c in [*keys, "_at"]]
    few = Window.partitionBy(*mine).orderBy("_draw")
    drawn = drawn.where(F.pmod("_draw", F.lit(every)) == 0).withColumn("_rank", F.row_number().over(few)).where(F.col("_rank") <= pieces)
    return drawn.groupBy(*mine).agg(F.sort_array(F.collect_list("_begin")).alias("_begins")).where(F.size("_begins") > 1)


def in_pieces(
    df: DataFrame, keys: list[str], order: list[str], cell: Column, every: int = EVERY, pieces: int = PIECES, begins: DataFrame | None = None,
) -> DataFrame:
    """Add ``_cell``: the row's cell and, where one (keys, cell) has very many rows, its piece of it.

    ``_cell`` does not decrease along ``order`` within ``keys``, as ``cell`` must not. Pieces begin at rows picked by a hash of
    their keys and order, so they are the same in every evaluation. Cells of few rows have one piece; only a
    sample of the rows is looked at to find the others. ``begins`` are those of ``piece_begins``, where they are at hand.
    """
    begins = piece_begins(df, keys, order, cell, every, pieces) if begins is None else begins
    place = F.struct(*order)
    rows = df.withColumn("_at", cell)
    piece = F.size(F.filter("_begins", lambda begin: begin <= place))
    found = rows.join(begins, _same(rows, begins, [*keys, "_at"]), "left")
    split = F.col("_begins").isNotNull()
    return found.select(*df.columns, F.struct("_at", F.when(split, piece).otherwise(0).alias("_piece"), split.alias("_split")).alias("_cell"))


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], value: str, cell: Column | None, out: str, every: int = EVERY, pieces: int = PIECES,
    begins: DataFrame | None = None,
) -> DataFrame:
    """Add struct column ``out(value)`` holding the previous row's ``value`` within ``keys``.

    NULL struct means there is no previous row. ``order`` must be unique within ``keys`` and
    ``cell`` must not decrease along it (say, the day of the first order column). Each
    (keys, cell) group, or each piece of one with very many rows, is sorted on its own, so a hot key spreads over its cells and a hot
    cell over its pieces; only the first and last row of these are looked at across them. Without ``cell`` all rows of
    the keys are one cell, and those of one piece are done when it is sorted: what suits few rows a key.
    """
    one = cell is None
    placed = in_pieces(df, keys, order, F.lit(0) if one else cell, every, pieces, begins).withColumn("_value", F.struct(F.col(value).alias("value")))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order)
    rows = placed.select(
        "*",
        F.lag("_value").over(inside).alias("_before"),
        F.row_number().over(inside).alias("_n"),
        F.lead(F.lit(1)).over(inside).isNull().alias("_last_of"),
    )
    # Both branches start from the same shuffle, which Spark does once; without cells the second one takes the rows of split keys only.
    done = F.col("_n") > 1
    within_cell = rows.where(done | ~F.col("_cell._split") if one else done).withColumn(out, F.col("_before"))
    across = Window.partitionBy(*keys).orderBy(*order)
    edges = (rows.where("_cell._split") if one else rows).where((F.col("_n") == 1) | F.col("_last_of")).withColumn(
        out, F.lag("_value").over(across),
    )
    first_of_cell = edges.where(F.col("_n") == 1)
    return within_cell.unionByName(first_of_cell).drop("_cell", "_value", "_before", "_n", "_last_of")


def with_running_max(
    df: DataFrame, keys: list[str], order: list[str], value: str, cell: Column, out: str, every: int = EVERY, pieces: int = PIECES,
) -> DataFrame:
    """Add ``out``: the greatest ``value`` of the rows before within ``keys``, NULL where there is none.

    As in ``with_previous``, cells and pieces are sorted on their own. What they add up to, one row each, is carried over the later ones.
    """
    placed = in_pieces(df, keys, order, cell, every, pieces)
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("_inside", F.max(value).over(inside))
    totals = placed.groupBy(*keys, "_cell").agg(F.max(value).alias("_most"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*[F.col(c).alias(f"{c}_r") for c in [*keys, "_cell"]], F.max("_most").over(before).alias("_carried"))
    joined = rows.join(carried.where("_carried IS NOT NULL"), _same(rows, carried, [*keys, "_cell"]), "left")
    return joined.select(*df.columns, F.greatest("_inside", "_carried").alias(out))
