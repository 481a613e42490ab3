"""Equi-joins that stay balanced when one key holds a large share of the rows.

The model joins on a city name: a few cities can hold most temperature rows,
and every airport and demographics row of a city multiplies them.  One plan
serves every size (``grid_join``):

1. rows per key and side are counted by partial aggregates;
2. a key whose join output exceeds a cell (``rows_per_cell``, or if that is
   more, a ``CELLS_PER_TASK``-th of a task's share of the output) is cut into
   a grid over all its sides.  A side's rows take one of its own slices by row
   hash and are copied to every slice of the other sides, so a cell of the
   grid holds one slice of each side and its output is about that size,
   whichever side makes the key hot.  The cells' number is bounded by that of
   the tasks, so the rows copied grow with the input, not with the output;
3. identical rows are carried once with their multiplicity, cut into pieces
   that fit a slice, and written out again after the join: equal rows, which
   share a hash, cannot pile up in one cell;
4. every side is dealt by (key, cell) to a stated number of tasks, a layout
   that adaptive execution does not coalesce (it would go by the small input,
   not by the output).

Nothing runs while the plan is built and no side is broadcast by hint: Spark
broadcasts the small table of hot keys, or a small side, by its measured
bytes.  Slices come from row hashes, so a task retried after executor loss
rebuilds the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Least join output rows of one cell of a hot key's grid,
ROWS_PER_CELL = 50_000
# and cells of an even share of the output that a task is dealt, when that makes them larger.
CELLS_PER_TASK = 16


@dataclass(frozen=True)
class Side:
    """One relation of a grid join.  ``distinct`` says that its rows are
    known to differ, which saves counting identical ones."""

    df: DataFrame
    key: str
    distinct: bool = False


def key_counts(df: DataFrame, key: str, out: str = "rows", name: str = "key") -> DataFrame:
    """(``name``, ``out``): rows per non-NULL value of ``key``; at most one
    row per key and map task crosses the shuffle."""
    k = F.col(f"`{key}`")
    return df.where(k.isNotNull()).groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(out))


def _slices(counts: DataFrame, n: int) -> DataFrame:
    """Slice sizes ``s_i`` and numbers ``g_i`` of each side for hot keys, whose cells have ``cell`` output rows.

    The last sides get an equal share of the cell's output first (their rows
    are the ones copied most), the first side what is left."""
    out = counts
    budget = F.col("cell")
    for i in range(n - 1, 0, -1):
        size = F.greatest(F.lit(1.0), F.least(F.col(f"n_{i}").cast("double"), F.floor(F.pow(budget, F.lit(1.0 / (i + 1))))))
        out = out.withColumn(f"s_{i}", size)
        budget = budget / F.col(f"s_{i}")
    out = out.withColumn("s_0", F.greatest(F.lit(1.0), F.floor(budget)))
    return out.select("hot_key", *[F.col(f"s_{i}").cast("long").alias(f"s_{i}") for i in range(n)],
                      *[F.ceil(F.col(f"n_{i}") / F.col(f"s_{i}")).cast("int").alias(f"g_{i}") for i in range(n)])


def hot_keys(sides: Sequence[Side], rows_per_cell: int, tasks: int) -> DataFrame:
    """Keys whose join output exceeds a cell, with the slice sizes and numbers
    of every side.  There are at most (join output / rows_per_cell) and at
    most (tasks * CELLS_PER_TASK) of them."""
    counts = key_counts(sides[0].df, sides[0].key, "n_0", "hot_key")
    product = F.col("n_0").cast("double")
    for i, s in enumerate(sides[1:], 1):
        counts = counts.join(key_counts(s.df, s.key, f"n_{i}", f"k_{i}"), F.col("hot_key") == F.col(f"k_{i}")).drop(f"k_{i}")
        product = product * F.col(f"n_{i}")
    counts = counts.withColumn("output", product)
    cell = counts.agg(F.greatest(F.lit(float(rows_per_cell)), F.ceil(F.sum("output") / (tasks * CELLS_PER_TASK)).cast("double")).alias("cell"))
    return _slices(counts.crossJoin(cell).where(F.col("output") > F.col("cell")), len(sides))


def grid_join(sides: Sequence[Side], rows_per_cell: int | None = None, tasks: int | None = None, buckets: int | None = None) -> DataFrame:
    """Inner equi-join of two or more relations on one key each.

    Output: the columns of all sides in order, every row as often as the
    plain join gives it.  ``tasks`` is the number of tasks the cells are
    dealt to (the session's shuffle partitions by default).  With ``buckets``
    cells go by the bucket of their key in a table of so many: keys of one
    cell stay together by their bucket, so that a task has rows of about as
    many buckets as it has cells of hot keys.
    """
    spark = sides[0].df.sparkSession
    rows_per_cell = rows_per_cell or ROWS_PER_CELL
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = len(sides)
    hot = hot_keys(sides, rows_per_cell, tasks)
    parts = []
    for i, s in enumerate(sides):
        names = {c: f"c{i}_{j}" for j, c in enumerate(s.df.columns)}
        rows = s.df.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
        own, columns = names[s.key], list(names.values())
        rows = rows.where(F.col(own).isNotNull())
        if not s.distinct:
            rows = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(f"m{i}"))
        rows = rows.join(hot, F.col(own) == F.col("hot_key"), "left")
        piece = F.lit(0)
        if not s.distinct:
            rows = rows.withColumn("piece", F.explode(F.sequence(
                F.lit(0), F.coalesce(F.ceil(F.col(f"m{i}") / F.col(f"s_{i}")).cast("int"), F.lit(1)) - 1)))
            rows = rows.withColumn(f"m{i}", F.when(F.col(f"s_{i}").isNull(), F.col(f"m{i}")).otherwise(
                F.least(F.col(f"s_{i}"), F.col(f"m{i}") - F.col("piece") * F.col(f"s_{i}"))))
            piece = F.col("piece")
        for k in range(n):
            cell = (F.coalesce(F.pmod(F.xxhash64(*columns) + piece, F.col(f"g_{i}")).cast("int"), F.lit(0)) if k == i
                    else F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"g_{k}"), F.lit(1)) - 1)))
            rows = rows.withColumn(f"x{k}_{i}", cell)
        keep = columns + ([] if s.distinct else [f"m{i}"]) + [f"x{k}_{i}" for k in range(n)]
        if buckets:
            rows = rows.withColumn(f"b_{i}", F.pmod(F.hash(own), F.lit(buckets)))
            keep.append(f"b_{i}")
        parts.append(rows.select(*keep).repartition(tasks, f"b_{i}" if buckets else own, *[f"x{k}_{i}" for k in range(n)]))

    def keys(i: int) -> list[str]:
        return [*([f"b_{i}"] if buckets else []), f"c{i}_{sides[i].df.columns.index(sides[i].key)}", *[f"x{k}_{i}" for k in range(n)]]

    out = parts[0]
    for i in range(1, n):
        on = None
        for a, b in zip(keys(0), keys(i)):
            same = F.col(a) == F.col(b)
            on = same if on is None else on & same
        out = out.join(parts[i], on)
    repeated = [F.col(f"m{i}") for i, s in enumerate(sides) if not s.distinct]
    if repeated:
        times = repeated[0]
        for m in repeated[1:]:
            times = times * m
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return out.select(*[F.col(f"c{i}_{j}").alias(c) for i, s in enumerate(sides) for j, c in enumerate(s.df.columns)])


def fanout_join(big: DataFrame, other: DataFrame, big_key: str, other_key: str,
                rows_per_cell: int | None = None) -> DataFrame:
    """Inner equi-join of two relations; output: all of ``big`` then all of ``other``."""
    return grid_join([Side(big, big_key), Side(other, other_key)], rows_per_cell)
