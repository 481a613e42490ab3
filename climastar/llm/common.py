"""Helpers shared by the operators: staging, exact connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climastar.session import new_run_dir

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared root and read it back: later
    steps neither recompute it nor depend on executors that made it."""
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Exact components of the undirected graph in columns (a long, b long).

    Alternating large-star and small-star steps: every node links its larger
    neighbours, then its smaller ones, to its smallest neighbour, until each
    component is a star around its smallest node.  Minima are partial
    aggregates, so a hub with very many neighbours never gathers in one task.
    Returns (node, component) for every node of an edge; self-loops are ignored.
    Empty input gives an empty result.
    """
    cur = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "cc-edges")
    state = _state(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # large star: (u, v > u) -> (v, min of u)
        large = (both.where("b > a").join(low, F.col("a") == F.col("k"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: (u, v < u) -> (v, min of the smaller ones), (u, that min)
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = (large.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").union(least.select("k", "m")).distinct())
        cur = staged(small, "cc-edges")
        new = _state(cur)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(cur.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    """Fingerprint of an edge set: number of edges, and two sums of hashes."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)),
                           F.coalesce(F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")), F.lit(0))).first())
