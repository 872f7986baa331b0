"""Ordered analytics without a window over the whole table.

A total order is built with one range shuffle.  Each partition then numbers its
own rows, and one row per partition is enough to turn these local numbers into
global ones.  No partition, group or value has to fit into one task: equal
values are counted before they are sorted, so a value that holds a third of
the rows is one row of the sort.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesloom.staging import passing, stage

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below
STRETCH = 1 << 20  # places per stretch when values are looked up by place
SPAN = 4096
SKETCH = 2000  # accuracy of the sketch that brackets quantiles
HELD_ROWS = 200_000  # values inside brackets, of all groups, up to which one task may put a group's in order
SALTS = 64
SHORT_TOP = 1000  # up to here Spark prunes a per-group top-k before its shuffle


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys are equal; the keys are those of ``left``."""
    renamed = right.withColumnsRenamed({key: f"{key}_of_right" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"{key}_of_right"))
    return left.join(renamed, condition, how).drop(*[f"{key}_of_right" for key in keys])


def _running_weight(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId()
    upto = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        running = np.cumsum(batch.column("n").to_numpy()) + upto
        upto = int(running[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, block, dtype=np.int64)), pa.array(running)],
            names=[*batch.schema.names, "block_", "upto_"],
        )


def _ranked(df: DataFrame, order: Sequence[str], by: Sequence[str], weighted: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with ``before_``, their number of predecessors in the whole order, and the sort partitions' sizes."""
    ordered = df.orderBy(*by, *order)
    if weighted:
        schema = T.StructType(
            [*df.schema.fields, T.StructField("block_", T.LongType()), T.StructField("upto_", T.LongType())]
        )
        placed = stage(ordered.mapInArrow(_running_weight, schema), "placed")
        weight = F.col("n")
    else:
        place = F.monotonically_increasing_id()
        numbered = stage(ordered.withColumn("place_", place), "placed")
        placed = numbered.select(
            *df.columns,
            F.shiftright("place_", ROW_BITS).alias("block_"),
            (F.col("place_").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1).alias("upto_"),
        )
        weight = F.lit(1)
    blocks = placed.groupBy("block_").agg(F.max("upto_").alias("size_"))
    earlier = F.sum("size_").over(Window.orderBy("block_")) - F.col("size_")
    offsets = blocks.select("block_", earlier.alias("offset_"))  # one row per sort partition
    ranked = placed.join(F.broadcast(offsets), "block_").select(
        *df.columns, (F.col("offset_") + F.col("upto_") - weight).alias("before_")
    )
    return ranked, blocks


def _group_starts(ranked: DataFrame, by: Sequence[str], weighted: bool) -> DataFrame:
    """Per group its first place in the whole order and its number of rows."""
    weight = F.col("n") if weighted else F.lit(1)
    starts = ranked.groupBy(*by).agg(F.min("before_").alias("start_"), F.sum(weight).alias("total"))
    return stage(starts, "group-starts")


def place_rows(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), weighted: bool = False) -> DataFrame:
    """Add ``before`` (rows of the group ahead of this one) and ``total`` (rows of the group).

    With ``weighted`` each row stands for ``n`` equal rows.  The order should be
    total, so that no run of equal keys is too long for one sort partition.
    """
    ranked, blocks = _ranked(df, order, by, weighted)
    if not by:
        everything = blocks.agg(F.sum("size_")).scalar()
        return ranked.withColumnRenamed("before_", "before").withColumn("total", everything)
    starts = _group_starts(ranked, by, weighted)
    joined = ranked.join(starts, _same(ranked, starts, by))
    return joined.select(
        *[ranked[c] for c in df.columns], (F.col("before_") - F.col("start_")).alias("before"), starts["total"]
    )


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, without NULL and NaN: ``by…, value, n``."""
    return _present(df, value).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def running_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values in order: ``by…, value, n, before, total``.

    ``n`` rows carry the value, ``before`` rows of the group are smaller, and
    the group has ``total`` rows with a value.  NULL and NaN values are left out.
    """
    return place_rows(value_counts(df, value, by), [value], by, weighted=True)


def ecdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Empirical distribution, sorted values against rank / (rows + 1).

    One row per distinct value; its ``n`` copies take the ranks from ``first_rank``
    to ``last_rank`` and the probabilities from ``p_first`` to ``p_last``.
    """
    steps = running_counts(df, value, by)
    first, last = F.col("before") + 1, F.col("before") + F.col("n")
    return steps.select(
        *by,
        value,
        first.alias("first_rank"),
        last.alias("last_rank"),
        (first / (F.col("total") + 1)).alias("p_first"),
        (last / (F.col("total") + 1)).alias("p_last"),
    )


def ccdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """P(T > a) at every distinct value a."""
    steps = running_counts(df, value, by)
    above = F.col("total") - F.col("before") - F.col("n")
    return steps.select(*by, value, (above / F.col("total")).alias("p_above"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = SKETCH) -> DataFrame:
    """Interpolated quantiles in long form: ``by…, prob, quantile``.

    Selection instead of sorting: a sketch of every group brackets the wanted places, one aggregation counts the
    rows between the brackets, and only the distinct values inside are put in order, about 6 / ``accuracy`` of a group
    per quantile.  A group of at most ``10 * accuracy`` rows is one bracket.  No task holds the values of
    a group, and a value that holds a third of the rows is one row of the sort.
    """
    by, probs = list(by), [float(p) for p in probs]
    with passing() as keep:  # what lies inside the brackets goes when the few quantiles are known
        found = stage(_selected(df, value, probs, by, accuracy), "quantiles")
        lacking = found.where(F.col("low").isNull() | F.col("high").isNull())
        if not lacking.take(1):
            return keep(found).select(*by, "prob", _blend().alias("quantile"))
        kept, again = found.limit(0), df  # a sketch has promised more than it kept
        if by:
            missed = stage(lacking.select(*by).distinct(), "missed")
            kept, again = (join_groups(rows, missed, by, how) for rows, how in ((found, "left_anti"), (df, "left_semi")))
        whole = _by_sorting(again, value, probs, by)
        return keep(stage(kept.select(*by, "prob", _blend().alias("quantile")).unionByName(whole), "quantiles"))


def _blend() -> Column:
    return F.col("low") + (F.col("high") - F.col("low")) * (F.col("position") - F.floor("position"))


def _present(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is neither NULL nor NaN."""
    kept = df.where(F.col(value).isNotNull())
    return kept.where(~F.isnan(value)) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else kept


def _bracketed(rows: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame:
    """The rows with ``ends_``: lower, then upper ends of the brackets of their group; NULL in a small group."""
    margin = 3 / accuracy
    asked = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketch = F.percentile_approx(value, F.array(*map(F.lit, asked)), F.lit(accuracy))
    ends = F.when(F.count(F.lit(1)) > 10 * accuracy, sketch).alias("ends_")
    if not by:
        return rows.withColumn("ends_", stage(rows.agg(ends), "brackets").scalar())
    groups = stage(rows.groupBy(*by).agg(ends), "brackets")
    return join_groups(rows, groups, by)


def _selected(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame:
    """by…, prob, position, and the values at the places around it: low, high."""
    rows = _bracketed(_present(df, value).select(*by, F.col(value).alias("at_")), "at_", sorted(probs), by, accuracy)
    # Spelled as SQL, as there may be many of them: place i of ends_ is the lower end of bracket i, place k + i its upper end.
    k, asked = len(probs), sorted(probs)
    passed = " + ".join(f"if(at_ > ends_[{k + i}], 1, 0)" for i in range(k))
    inside = F.expr(" OR ".join(["ends_ IS NULL", *(f"coalesce(at_ BETWEEN ends_[{i}] AND ends_[{k + i}], false)" for i in range(k))]))
    # Between two brackets all rows are one line without a value, ahead of the values of the bracket above.
    slots = rows.select(*by, (2 * F.expr(passed) + inside.cast("int")).alias("slot_"), F.when(inside, F.col("at_")).alias("at_"))
    counted = stage(slots.groupBy(*by, "slot_", "at_").agg(F.count(F.lit(1)).alias("n")), "slots")
    if counted.count() <= HELD_ROWS:
        group = Window.partitionBy(*by)
        upto, total = F.sum("n").over(group.orderBy("slot_", "at_")), F.sum("n").over(group)
        placed = counted.select("*", (upto - F.col("n")).alias("before"), total.alias("total"))
    else:
        placed = place_rows(counted, ["slot_", "at_"], by, weighted=True)
    sides = [(p, side, f"{name}({p!r}D * (total - 1))") for p in asked for side, name in enumerate(("floor", "ceil"))]
    wanted = ", ".join(f"named_struct('prob', {p!r}D, 'position', {p!r}D * (total - 1), 'side', {side}, 'place', {place})" for p, side, place in sides)
    here = F.expr(f"filter(array({wanted}), w -> before <= w.place AND w.place < before + n)")
    met = placed.where("total > 0").select(*by, F.col("at_").cast("double").alias("at_"), F.explode(here).alias("w"))
    return met.groupBy(*by, F.col("w.prob").alias("prob"), F.col("w.position").alias("position")).agg(
        F.max(F.when(F.col("w.side") == 0, F.col("at_"))).alias("low"), F.max(F.when(F.col("w.side") == 1, F.col("at_"))).alias("high")
    )


def _by_sorting(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles from an order of all distinct values.

    The sizes of the groups tell which places of the whole order are wanted.
    Values and wanted places meet by stretches of ``STRETCH`` places, so a group
    of any size spreads over many tasks and no task holds the values of a group.
    """
    ranked, _ = _ranked(value_counts(df, value, by), [value], by, weighted=True)
    starts = _group_starts(ranked, by, weighted=True)
    position = F.col("prob") * (F.col("total") - 1)
    asked = starts.where(F.col("total") > 0).withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    asked = asked.select(*by, "prob", "start_", position.alias("position"))
    sides = F.array(F.floor("position"), F.ceil("position"))
    wanted = asked.select(*by, "prob", "position", "start_", F.posexplode(sides).alias("side", "rank"))
    wanted = wanted.withColumn("place", F.col("start_") + F.col("rank"))
    wanted = stage(wanted.withColumn("stretch", F.floor(F.col("place") / STRETCH)), "wanted")

    first, last = F.floor(F.col("before_") / STRETCH), F.floor((F.col("before_") + F.col("n") - 1) / STRETCH)
    steps = ranked.select(
        F.col(value).cast("double").alias("at"), "before_", "n", F.explode(F.sequence(first, last)).alias("stretch")
    )
    inside = (F.col("before_") <= F.col("place")) & (F.col("place") < F.col("before_") + F.col("n"))
    met = steps.join(wanted, "stretch").where(inside)
    ends = met.groupBy(*by, "prob", "position").agg(
        F.max(F.when(F.col("side") == 0, F.col("at"))).alias("low"),
        F.max(F.when(F.col("side") == 1, F.col("at"))).alias("high"),
    )
    return ends.select(*by, "prob", _blend().alias("quantile"))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group with their rank.

    Up to ``SHORT_TOP`` Spark itself keeps k rows per group and map task before
    the shuffle.  Beyond, a first round ranks within salted parts of a group, so
    that a group holding much of the table is not sorted in one task.
    """
    if k > SHORT_TOP:
        salted = df.withColumn("salt_", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        part = Window.partitionBy(*by, "salt_").orderBy(*order)
        df = salted.withColumn(name, F.row_number().over(part)).where(F.col(name) <= k).drop("salt_", name)
    if not by:
        df = df.orderBy(*order).limit(k)
    whole = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= k)


def rank_slices(
    df: DataFrame, order: Sequence[str], slices: Sequence[tuple[int, int | None]], by: Sequence[str] = ()
) -> DataFrame:
    """Pieces of every ordered group, given like list slices; negative ends count from the back.

    Returns the rows with ``piece`` (the number of the slice).  A slice that
    starts from the front must not end at the back.
    """
    def pieces(ends: dict[int, tuple[int, int]], directed: list[Column]) -> DataFrame:
        rows = top_per_group(df, by, directed, max(last for _, last in ends.values()), "rank_")
        marks = [F.when(F.col("rank_").between(first, last), F.lit(i)) for i, (first, last) in ends.items()]
        return rows.withColumn("piece", F.explode(F.array_compact(F.array(*marks)))).drop("rank_")

    front = {i: (start + 1, stop) for i, (start, stop) in enumerate(slices) if start >= 0}
    back = {i: (1 if stop is None else 1 - stop, -start) for i, (start, stop) in enumerate(slices) if start < 0}
    parts = []
    if front:
        parts.append(pieces(front, [F.col(c).asc() for c in order]))
    if back:
        parts.append(pieces(back, [F.col(c).desc() for c in order]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def chunked_lists(df: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """All values of every key as sorted lists of at most ``size`` elements.

    A key with more values spreads over several rows, numbered by ``chunk``.
    """
    steps = running_counts(df, value, [key])
    first = F.floor(F.col("before") / size)
    last = F.floor((F.col("before") + F.col("n") - 1) / size)
    # Chunks are numbered in two levels, so that the array of a very frequent value stays short.
    spans = steps.withColumn("span_", F.explode(F.sequence(first, last, F.lit(SPAN))))
    upto = F.least(F.col("span_") + SPAN - 1, last)
    spans = spans.withColumn("chunk", F.explode(F.sequence("span_", upto)))
    start = F.greatest(F.col("before"), F.col("chunk") * size)
    stop = F.least(F.col("before") + F.col("n"), (F.col("chunk") + 1) * size)
    copies = F.array_repeat(F.col(value), (stop - start).cast("int"))
    pieces = spans.select(key, "chunk", F.struct(start.alias("at"), copies.alias("vs")).alias("part"))
    # Given, because the chunks of a key would otherwise stay together after a join on the key.
    pieces = pieces.repartition(key, "chunk")
    lists = pieces.groupBy(key, "chunk").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return lists.select(key, "chunk", F.flatten(F.transform("parts", lambda p: p["vs"])).alias("values"))


def neighbour_diff(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Per group in key order: first key, rows, and the sum of |v[i+1] − v[i]|.

    Rows without a value are skipped.  A sort partition folds the rows of each of its groups to one line, whatever number of
    batches they come in, so a group has at most as many lines as there are sort partitions; these are
    chained in key order.  Groups with one row have no differences: NULL.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, key, value).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(group, key, value).select(
        F.col(group).alias("g"), F.col(key).alias("k"), F.col(value).cast("double").alias("v"), "n"
    )
    kinds = {f.name: f.dataType for f in ordered.schema.fields}
    schema = T.StructType(
        [T.StructField(c, kinds[s]) for c, s in (("g", "g"), ("k_first", "k"), ("v_first", "v"), ("v_last", "v"))]
        + [T.StructField("n", T.LongType()), T.StructField("walk", T.DoubleType())]
    )
    target = to_arrow_schema(schema)

    def lines_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        """One line per group of a batch."""
        values, sizes = batch.column("v").to_numpy(), batch.column("n").to_numpy()
        codes = batch.column("g").dictionary_encode(null_encoding="encode").indices.to_numpy()
        fresh = np.concatenate([[True], np.diff(codes) != 0])
        starts = np.flatnonzero(fresh)
        steps = np.where(fresh, 0.0, np.abs(np.diff(values, prepend=values[0])))
        ends = np.append(starts[1:], len(codes)) - 1
        firsts = [batch.column(c).take(pa.array(starts)) for c in ("g", "k")]
        numbers = [values[starts], values[ends], np.add.reduceat(sizes, starts), np.add.reduceat(steps, starts)]
        return pa.RecordBatch.from_arrays([*firsts, *map(pa.array, numbers)], schema=target)

    def chained(before: pa.RecordBatch, lines: pa.RecordBatch) -> pa.RecordBatch:
        """The line before and the first one as one line; they are of one group."""
        a, b = (one.slice(0, 1).to_pylist()[0] for one in (before, lines))
        walk = a["walk"] + abs(b["v_first"] - a["v_last"]) + b["walk"]
        whole = {**a, "v_last": b["v_last"], "n": a["n"] + b["n"], "walk": walk}
        return pa.RecordBatch.from_pylist([whole], schema=target)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = lines_of(batch)
            if kept is not None:
                if kept.column("g")[0] == lines.column("g")[0] or not (kept.column("g")[0].is_valid or lines.column("g")[0].is_valid):
                    joined = chained(kept, lines)
                    if lines.num_rows == 1:
                        kept = joined
                        continue
                    yield joined
                    lines = lines.slice(1)
                else:
                    yield kept
            kept = lines.slice(lines.num_rows - 1)
            if lines.num_rows > 1:
                yield lines.slice(0, lines.num_rows - 1)
        if kept is not None:
            yield kept

    lines = ordered.mapInArrow(fold, schema)
    chain = Window.partitionBy("g").orderBy("k_first", "v_first")
    jump = F.abs(F.col("v_first") - F.lag("v_last").over(chain))
    jumps = lines.withColumn("jump", F.coalesce(jump, F.lit(0.0)))
    result = jumps.groupBy("g").agg(
        F.min("k_first").alias("first_key"), F.sum("n").alias("n"), F.sum(F.col("walk") + F.col("jump")).alias("walk")
    )
    return result.select(
        F.col("g").alias(group),
        F.when(F.col("n") > 1, F.col("first_key")).alias("first_key"),
        "n",
        F.when(F.col("n") > 1, F.col("walk")).alias("sum_abs_diff"),
    )


def cumulative_share(df: DataFrame, weight: str, rank: str, by: Sequence[str]) -> DataFrame:
    """Share of the total up to each rank of a group, rank 0 standing for the empty sum."""
    order = Window.partitionBy(*by).orderBy(rank)
    whole = Window.partitionBy(*by)
    shares = df.select(
        *by, rank, F.try_divide(F.sum(weight).over(order), F.sum(weight).over(whole)).alias("share")
    )
    zero = df.select(*by).distinct().select(*by, F.lit(0).cast(df.schema[rank].dataType).alias(rank), F.lit(0.0).alias("share"))
    return zero.unionByName(shares)
