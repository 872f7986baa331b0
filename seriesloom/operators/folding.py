"""Folds by key with the caller's own functions, and samples of a given size.

A fold has three functions on column expressions: create a state from a value, merge a value into a state, and
merge two states.  Values are folded where they are read: each block of rows of a map task is put in the order of its keys
and becomes one list per key, which Spark folds to one state before any shuffle.  States are merged
in salted parts of a key first, so a key that holds half of the rows is no task of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesloom.operators.ordered import top_per_group

BLOCK_ROWS = 200_000  # rows that a task puts in the order of their keys at once
MERGE_PARTS = 64


def _key_codes(columns: list[pa.Array], rows: int) -> np.ndarray:
    """Equal numbers for rows with equal keys; NULLs are equal."""
    codes = np.zeros(rows, np.int64)
    for column in columns:
        encoded = column.dictionary_encode(null_encoding="encode")
        mixed = codes * max(len(encoded.dictionary), 1) + encoded.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(mixed, return_inverse=True)[1]  # numbers stay below the number of rows
    return codes


def _lists_per_key(schema: pa.Schema, keys: int, block_rows: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of keys and a value → per block one row per key with the list of its values."""

    def gathered(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        columns = [column.combine_chunks() for column in table.columns]
        codes = _key_codes(columns[:keys], table.num_rows)
        order = np.argsort(codes, kind="stable")
        ordered = codes[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        ends = np.append(first, table.num_rows).astype(np.int32)
        values = columns[keys].take(pa.array(order))
        lists = pa.ListArray.from_arrays(pa.array(ends), values)
        return pa.RecordBatch.from_arrays([*(c.take(pa.array(order[first])) for c in columns[:keys]), lists.cast(schema.field(keys).type)], schema=schema)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= block_rows:
                yield gathered(held)
                held, rows = [], 0
        if held:
            yield gathered(held)

    return gather


def fold_by_key(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    create: Callable[[Column], Column],
    merge_value: Callable[[Column, Column], Column],
    merge_states: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column] | None = None,
    name: str = "folded",
    parts: int = MERGE_PARTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One state per key: ``by…, name``.

    ``create(value)`` starts a state, ``merge_value(state, value)`` and ``merge_states(state, state)`` go on; all three give
    columns of one type, and the result must not depend on the order of the values, as with any distributed fold.
    Rows without a value take no part, a key of such rows only has no state and no row; a NULL key is a key.
    ``finish`` turns the last state into the result.
    """
    by = list(by)
    rows = df.select(*by, value.alias("value_")).where(F.col("value_").isNotNull())
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("values_", T.ArrayType(rows.schema["value_"].dataType))])
    gathered = rows.mapInArrow(_lists_per_key(to_arrow_schema(schema), len(by), block_rows), schema)
    folded = F.aggregate(F.slice("values_", F.lit(2), F.size("values_")), create(F.get("values_", F.lit(0))), merge_value)
    states = gathered.select(*by, folded.alias("state_"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).alias("part_"))

    def merged(frame: DataFrame, keys: list[str]) -> DataFrame:
        lists = frame.groupBy(*keys).agg(F.collect_list("state_").alias("states_"))
        whole = F.aggregate(F.slice("states_", F.lit(2), F.size("states_")), F.get("states_", F.lit(0)), merge_states)
        return lists.select(*keys, whole.alias("state_"))

    whole = merged(merged(states, [*by, "part_"]), by)
    state = F.col("state_")
    return whole.select(*by, (finish(state) if finish else state).alias(name))


def central_moments() -> tuple[Callable, Callable, Callable]:
    """Create and merge functions of a state with count, mean and the sums of squared and cubed deviations from it."""

    def state(n: Column, mean: Column, second: Column, third: Column) -> Column:
        return F.struct(n.alias("n"), mean.alias("mean"), second.alias("second"), third.alias("third"))

    def create(value: Column) -> Column:
        return state(F.lit(1).cast("double"), value.cast("double"), F.lit(0.0), F.lit(0.0))

    def merge_states(a: Column, b: Column) -> Column:
        n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
        both = a["n"] * b["n"] / n
        second = a["second"] + b["second"] + delta * delta * both
        third = (
            a["third"] + b["third"] + delta * delta * delta * both * (a["n"] - b["n"]) / n
            + F.lit(3.0) * delta * (a["n"] * b["second"] - b["n"] * a["second"]) / n
        )
        return state(n, a["mean"] + delta * b["n"] / n, second, third)

    def merge_value(a: Column, value: Column) -> Column:
        return merge_states(a, create(value))

    return create, merge_value, merge_states


def bounded_sample(df: DataFrame, by: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` rows of every group, all of a smaller one, with ``draw``, their place in the order they were drawn in.

    The rows with the smallest hashes of ``key`` and the seed; which these are depends on neither the partitions nor their order, and
    samples of parts can be merged by the same rule.  ``key`` names the columns that tell the rows of a group apart; rows that share a
    key are drawn one after the other.  Every map task sends at most ``k`` rows of a group.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in key))
    hashed = df.withColumn("hash_", F.md5(text.cast("binary")))
    drawn = top_per_group(hashed, list(by), [F.asc("hash_"), *(F.asc(c) for c in key)], k, "draw")
    return drawn.drop("hash_")
