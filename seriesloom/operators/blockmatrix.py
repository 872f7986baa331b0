"""Matrices as tables of dense blocks: outer product, stacking, transpose, reshape, and products by a join on the inner block.

A matrix is a table of ``row_block, col_block, values`` with its sizes beside it; ``values`` are the elements of a block, row
by row.  All blocks have ``block`` rows and columns but the last ones, so a block is a row of bounded size
and no matrix has to fit anywhere.  Missing elements are NaN and spread through products as in numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.staging import stage

BLOCK = 128
MERGE_PARTS = 16
HELD_BYTES = 128 << 20
TILE = 16  # blocks on a side
GROUPS_PER_CORE = 4
HELD_TILES = 48  # of one factor in a task
GROUP_SPREAD = 4  # partitions for a group, so that few hold two
STACK = 4  # blocks of rows that are multiplied at once
FOLDED_ROWS = 1 << 13
#: Elements as numbers of their rows, numbers of their columns in order, and an array that holds until the next one is asked for.
Rectangle = tuple[np.ndarray, np.ndarray, np.ndarray]
_BLOCKS = T.StructType(
    [T.StructField("row_block", T.LongType()), T.StructField("col_block", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))]
)


@dataclass(frozen=True)
class BlockMatrix:
    """Blocks with the number of rows and columns of the whole matrix and of a block.

    ``made`` has the rows from which the tasks make the elements, and how, if these are not stored; ``turned`` is
    the matrix of which this is the transpose.
    """

    blocks: DataFrame
    rows: int
    columns: int
    block: int = BLOCK
    made: tuple[DataFrame, Callable[[Iterable[pa.RecordBatch]], Iterator[Rectangle]]] | None = None
    turned: BlockMatrix | None = None

    def _height(self, row_block: Column) -> Column:
        return F.least(F.lit(self.block), F.lit(self.rows) - row_block * self.block)

    def _width(self, col_block: Column) -> Column:
        return F.least(F.lit(self.block), F.lit(self.columns) - col_block * self.block)

    def transpose(self) -> BlockMatrix:
        """Blocks trade places, each is turned where it lies: no shuffle."""
        size = self.block
        rows, columns = self.rows, self.columns

        def turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    i, j, one = _block(batch, at, rows, columns, size)
                    yield _as_batch([(j, i, one.T)])

        return BlockMatrix(self.blocks.mapInArrow(turn, _BLOCKS), self.columns, self.rows, size, turned=self)

    def runs(self) -> DataFrame:
        """Stretches of a row inside a block: row, column of the first element, values."""
        height, width = self._height(F.col("row_block")), self._width(F.col("col_block"))
        cut = F.transform(F.sequence(F.lit(0).cast("long"), height - 1), lambda r: F.slice("values", (r * width + 1).cast("int"), width.cast("int")))
        inside = self.blocks.select("row_block", "col_block", F.posexplode(cut).alias("r", "values"))
        return inside.select((F.col("row_block") * self.block + F.col("r")).alias("row"), (F.col("col_block") * self.block).alias("column"), "values")

    def reshape(self, rows: int, columns: int, rest: float | None = None) -> BlockMatrix:
        """The elements in row order under other sizes, as stretches that are cut where the new blocks begin.

        With ``rest`` the new sizes may hold more elements; those behind the last one have this value.
        """
        held, wanted = self.rows * self.columns, rows * columns
        if wanted != held and (rest is None or wanted < held):
            raise ValueError(f"{self.rows} x {self.columns} elements do not fill {rows} x {columns}")
        runs = self.runs().select((F.col("row") * self.columns + F.col("column")).alias("first"), "values")
        if wanted > held:
            added = self.blocks.sparkSession.range(held, wanted, self.block).withColumnRenamed("id", "first")
            size = F.least(F.lit(self.block), F.lit(wanted) - F.col("first")).cast("int")
            runs = runs.unionByName(added.select("first", F.array_repeat(F.lit(float(rest)), size).alias("values")))
        return from_runs(runs, rows, columns, self.block)

    def below(self, other: BlockMatrix) -> BlockMatrix:
        """Both matrices as one, ``other`` under this one."""
        if self.columns != other.columns:
            raise ValueError(f"{self.columns} and {other.columns} columns cannot be stacked")
        lower = other.runs().withColumn("row", F.col("row") + self.rows)
        both = self.runs().unionByName(lower)
        runs = both.select((F.col("row") * self.columns + F.col("column")).alias("first"), "values")
        return from_runs(runs, self.rows + other.rows, self.columns, self.block)

    def beside(self, other: BlockMatrix) -> BlockMatrix:
        """Both matrices as one, ``other`` on the right of this one."""
        return self.transpose().below(other.transpose()).transpose()

    def __matmul__(self, other: BlockMatrix) -> BlockMatrix:
        """Product: blocks meet by the inner number, and products of one place are added per task, in salted parts, then as a whole.

        With a single inner block every place has one product, which is never shuffled.
        """
        if self.columns != other.rows or self.block != other.block:
            raise ValueError(f"{self.rows} x {self.columns} and {other.rows} x {other.columns} cannot be multiplied")
        if self.columns <= self.block:
            return self._times_in_tiles(other)
        left = self.blocks.select(F.col("row_block").alias("i"), F.col("col_block").alias("k"), F.col("values").alias("a"))
        right = other.blocks.select(F.col("row_block").alias("k"), F.col("col_block").alias("j"), F.col("values").alias("b"))
        met = left.join(right, "k").select("i", "j", "k", "a", "b")
        rows, inner, columns, size = self.rows, self.columns, other.columns, self.block

        def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                i, j, k = (batch.column(c).to_pylist() for c in ("i", "j", "k"))
                for at in range(batch.num_rows):
                    a = _elements(batch.column("a"), at).reshape(-1, min(size, inner - k[at] * size))
                    b = _elements(batch.column("b"), at).reshape(-1, min(size, columns - j[at] * size))
                    place = i[at], j[at]
                    held[place] = held[place] + a @ b if place in held else a @ b
                    if len(held) * 8 * size * size > HELD_BYTES:
                        yield from _batches(held)
                        held = {}
            yield from _batches(held)

        partial = met.mapInArrow(multiply, _BLOCKS)
        part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part")
        place = ["row_block", "col_block"]
        salted = partial.select("*", part).repartition(*place, "part").sortWithinPartitions(*place, "part").drop("part")
        merged = salted.mapInArrow(_add_up, _BLOCKS).repartition(*place).sortWithinPartitions(*place)
        return BlockMatrix(merged.mapInArrow(_add_up, _BLOCKS), rows, columns, size)

    def _times_in_tiles(self, other: BlockMatrix) -> BlockMatrix:
        """Product over a single inner block: nothing is left to add, so only the factors are shuffled.

        Blocks are dealt to a grid of about ``GROUPS_PER_CORE`` groups a core, so a factor is copied about as often
        as the root of that number, or as often as its parts have to be for ``HELD_TILES``.  A group holds its part
        of the left factor, which every tile of its part of the right one meets once.  With the own transpose the
        groups on one side of the diagonal give those on the other as well.
        """
        spark = self.blocks.sparkSession
        high, wide = (-(-n // (self.block * TILE)) for n in (self.rows, other.columns))
        groups = GROUPS_PER_CORE * spark.sparkContext.defaultParallelism
        down = max(1, min(high, ceil(groups**0.5)), -(-high // HELD_TILES))
        across = max(1, min(wide, ceil(groups / down)), -(-wide // HELD_TILES))
        mirrored = other.turned is self
        if mirrored:
            down = across = max(1, min(high, ceil((2 * groups) ** 0.5)), -(-high // HELD_TILES))
        inner, size, tile = self.columns, self.block, TILE

        def dealt(blocks: DataFrame, side: int, number: str, own: str, own_parts: int, others: str, other_parts: int) -> DataFrame:
            part = F.pmod(F.col(number), F.lit(own_parts)).cast("int")
            first, last = part if mirrored and not side else F.lit(0), part if mirrored and side else F.lit(other_parts - 1)
            return blocks.select(part.alias(own), F.explode(F.sequence(first, last)).alias(others), F.lit(side).alias("side"), F.col(number).alias("number"), "values")

        left = dealt(self.blocks, 0, "row_block", "down", down, "across", across)
        right = dealt(other.blocks, 1, "col_block", "across", across, "down", down)
        met = left.unionByName(right).repartition(GROUP_SPREAD * down * across, "down", "across").sortWithinPartitions("down", "across", "side", "number")

        def products(batches: Iterable[pa.RecordBatch]) -> Iterator[Rectangle]:
            group, held, waiting, aside = None, [], [], False
            for batch in batches:
                names = ("down", "across", "side", "number")
                for at, (*here, side, number) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                    if here != group or len(waiting) == tile:
                        yield from _stretches(held, waiting, size, aside)
                        waiting = []
                    if here != group:
                        group, held, aside = here, [], mirrored and here[0] != here[1]
                    values = _elements(batch.column("values"), at)
                    if side:
                        waiting.append((number, values.reshape(inner, -1)))
                    else:
                        held.append((number, values.reshape(-1, inner)))
            yield from _stretches(held, waiting, size, aside)

        def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, columns, values in products(batches):
                tops, starts = (np.flatnonzero(numbers % size == 0) for numbers in (rows, columns))
                for top, row in zip(tops, np.split(values, tops[1:]), strict=True):
                    parts = zip(starts, np.split(row, starts[1:], axis=1), strict=True)
                    yield _as_batch([(int(rows[top]) // size, int(columns[at]) // size, part) for at, part in parts])

        return BlockMatrix(met.mapInArrow(multiply, _BLOCKS), self.rows, other.columns, size, (met, products))

    def cells(self, fold: Callable[[np.ndarray, np.ndarray, np.ndarray], list[pa.Array]] | None = None, schema: str | None = None) -> DataFrame:
        """One row per element: row, column, value.

        With ``fold`` the task that holds or makes the elements hands them over in rectangles, as numbers of their rows, of their
        columns and an array, and what it returns, columns of ``schema``, takes their place: figures of a row that the caller merges.
        """
        if fold is not None:
            return self._folded(fold, schema)
        top, start = (F.col("row_block") * self.block).alias("top"), (F.col("col_block") * self.block).alias("start")
        inside = self.blocks.select(top, start, self._width(F.col("col_block")).alias("width"), F.posexplode_outer("values").alias("at", "value"))
        row, column = F.col("top") + F.call_function("div", F.col("at"), F.col("width")), F.col("start") + F.col("at") % F.col("width")
        return inside.select(row.alias("row"), column.alias("column"), "value")

    def _folded(self, fold: Callable[[np.ndarray, np.ndarray, np.ndarray], list[pa.Array]], schema: str) -> DataFrame:
        rows, columns, size = self.rows, self.columns, self.block

        def stored(batches: Iterable[pa.RecordBatch]) -> Iterator[Rectangle]:
            for batch in batches:
                for at in range(batch.num_rows):
                    i, j, one = _block(batch, at, rows, columns, size)
                    yield i * size + np.arange(one.shape[0]), j * size + np.arange(one.shape[1]), one

        source, rectangles = self.made or (self.blocks, stored)
        names = T.StructType.fromDDL(schema).names

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, many = [], 0
            for rectangle in rectangles(batches):
                held.append(pa.RecordBatch.from_arrays(fold(*rectangle), names=names))
                many += held[-1].num_rows
                if many >= FOLDED_ROWS:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, many = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

        return source.mapInArrow(run, schema)

    def staged(self) -> BlockMatrix:
        return BlockMatrix(stage(self.blocks, "blocks"), self.rows, self.columns, self.block)


def _elements(column: pa.ListArray, at: int) -> np.ndarray:
    return column[at].values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _stretches(held: list[tuple[int, np.ndarray]], waiting: list[tuple[int, np.ndarray]], size: int, mirrored: bool) -> Iterator[Rectangle]:
    """Products of the held blocks of rows, some at once, with the waiting blocks of columns beside each other; if mirrored also turned."""
    if not held or not waiting:
        return
    numbers = lambda blocks, axis: np.concatenate([number * size + np.arange(one.shape[axis]) for number, one in blocks])
    columns, beside = numbers(waiting, 1), np.concatenate([one for _, one in waiting], axis=1)
    place = np.empty((STACK * size, len(columns)))
    for at in range(0, len(held), STACK):
        rows, below = numbers(held[at : at + STACK], 0), np.concatenate([one for _, one in held[at : at + STACK]])
        values = np.matmul(below, beside, out=place[: len(below)])
        yield rows, columns, values
        if mirrored:
            yield columns, rows, values.T


def _block(batch: pa.RecordBatch, at: int, rows: int, columns: int, size: int) -> tuple[int, int, np.ndarray]:
    i, j = batch.column("row_block")[at].as_py(), batch.column("col_block")[at].as_py()
    return i, j, _elements(batch.column("values"), at).reshape(min(size, rows - i * size), min(size, columns - j * size))


def _as_batch(blocks: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    i, j, values = zip(*blocks, strict=True)
    ends = np.cumsum([0, *(one.size for one in values)]).astype(np.int32)
    flat = np.concatenate([one.ravel() for one in values])
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=_BLOCKS.names)


def _batches(held: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (i, j), values in held.items():
        yield _as_batch([(i, j, values)])


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one place added; the rows of a place follow each other, as their partition is sorted by it."""
    place, total = None, None
    for batch in batches:
        for at, here in enumerate(zip(batch.column("row_block").to_pylist(), batch.column("col_block").to_pylist(), strict=True)):
            values = _elements(batch.column("values"), at)
            if here == place:
                total = total + values
                continue
            if place is not None:
                yield _as_batch([(*place, total)])
            place, total = here, values
    if place is not None:
        yield _as_batch([(*place, total)])


def from_runs(runs: DataFrame, rows: int, columns: int, block: int = BLOCK) -> BlockMatrix:
    """A matrix from stretches of its elements in row order: first (number of the first element), values.

    A stretch is cut where a row or a block of columns begins; every element must be given once.
    """
    last = F.col("first") + F.size("values") - 1
    # Every place where a row or a block of columns begins, from the stretch's own start on.
    row = lambda at: F.floor(at / columns)
    rows_met = F.explode(F.sequence(row(F.col("first")), row(last)))
    by_row = runs.where(F.size("values") > 0).select("first", "values", last.alias("last"), rows_met.alias("row"))
    begin, end = F.greatest("first", F.col("row") * columns), F.least("last", (F.col("row") + 1) * columns - 1)
    pieces = by_row.select("first", "values", "row", (begin - F.col("row") * columns).alias("from"), (end - F.col("row") * columns).alias("to"))
    col_block = F.explode(F.sequence(F.floor(F.col("from") / block), F.floor(F.col("to") / block)))
    pieces = pieces.select("*", col_block.alias("col_block"))
    start, stop = F.greatest("from", F.col("col_block") * block), F.least("to", (F.col("col_block") + 1) * block - 1)
    piece = F.slice("values", (F.col("row") * columns + start - F.col("first") + 1).cast("int"), (stop - start + 1).cast("int"))
    placed = pieces.select(
        F.floor(F.col("row") / block).alias("row_block"), "col_block",
        F.struct((F.col("row") % block).alias("r"), (start - F.col("col_block") * block).alias("c"), piece.cast("array<double>").alias("values")).alias("piece"),
    )
    grouped = placed.groupBy("row_block", "col_block").agg(F.array_sort(F.collect_list("piece"), _by_place).alias("pieces"))
    values = F.flatten(F.transform("pieces", lambda piece: piece["values"]))
    return BlockMatrix(grouped.select("row_block", "col_block", values.alias("values")), rows, columns, block)


def _by_place(a: Column, b: Column) -> Column:
    """Order of pieces of a block, by row and column."""
    left, right = a["r"] * (1 << 31) + a["c"], b["r"] * (1 << 31) + b["c"]
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def from_rows(df: DataFrame, number: str, values: str, columns: int, block: int = BLOCK) -> BlockMatrix:
    """A matrix from one row per vector, numbered from 0 without gaps; vectors have ``columns`` elements, a NULL element is NaN."""
    filled = F.transform(values, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    runs = df.select((F.col(number).cast("long") * columns).alias("first"), filled.alias("values"))
    return from_runs(runs, df.count(), columns, block)


def outer(u: BlockMatrix, v: BlockMatrix) -> BlockMatrix:
    """u·vᵀ of two matrices of one column: every block of ``v`` is sent to all rows of blocks of the result, whose size that is."""
    if u.columns != 1 or v.columns != 1 or u.block != v.block:
        raise ValueError("an outer product needs two single columns in blocks of one size")
    high = -(-u.rows // u.block)
    left = u.blocks.select("row_block", F.col("values").alias("a"))
    right = v.blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(high - 1).cast("long"))).alias("row_block"), F.col("row_block").alias("col_block"), F.col("values").alias("b"))
    met = left.join(right, "row_block")
    products = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: x * y)))
    return BlockMatrix(met.select("row_block", "col_block", products.alias("values")), u.rows, v.rows, u.block)
