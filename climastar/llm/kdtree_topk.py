"""Exact top-k search by inner product: one KD-tree a shard, best-first traversal, a propagated kth score.

Vectors are taken as integers, floor(1024 * x).  Equal vectors become one point with its k + 1 least ids, which is all of
them that a result can show, so a vector that very many rows share stays one point.  Points are dealt to cells by a few
median splits, fitted on a bounded sample, and cells that hold more than their share to several shards by hash.  In each shard
a KD-tree of median splits keeps the tight box of every node; the bound of a query and a box is the largest inner product that
a point in the box could have.  A query first searches the shard it would lie in itself; its kth score there goes with it to the
shards of the other cells whose box reaches that score, and every search starts from it.

Queries stream through a shard's tree in batches, so a task holds one shard and one batch.  Only the splits and the boxes of the
cells, at most ``CELLS``, are broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

SCALE = 1024
CELLS = 256                  # of the upper splits; their boxes are broadcast
SAMPLE = 8192                # vectors that fit them
LEAF = 64
SHARD_ROWS = 32_768          # points of a shard at most (on average, as hashes deal them)
LEAST_SHARD_ROWS = 1_024
ID = "struct<i: bigint>"     # a struct, so that a NULL id is kept in lists


def scaled(col: Column) -> Column:
    """Components as integers; NULL for a vector that is NULL or has NULL or non-finite components."""
    wide = col.cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * F.lit(float(SCALE)))))


def _pack(rows: DataFrame) -> DataFrame:
    """(id, ask, vec binary): components as 32-bit integers, trailing zeros cut, so that vectors which score alike are equal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("v").to_pylist():
                wide = np.array(v, np.int64)
                if len(wide) and np.abs(wide).max() >= 1 << 31:
                    raise ValueError("a component times 1024 must fit 32 bits")
                out.append(np.trim_zeros(wide, "b").astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("ask"), pa.array(out, pa.binary())], names=["id", "ask", "vec"])

    return rows.mapInArrow(run, "id long, ask boolean, vec binary")


def matrix(vecs: list[bytes], width: int) -> np.ndarray:
    """Rows of ``width`` components; missing ones are zero."""
    if all(len(v) == 4 * width for v in vecs):
        return np.frombuffer(b"".join(vecs), "<i4").reshape(len(vecs), width).astype(np.float64)
    out = np.zeros((len(vecs), width))
    for row, v in zip(out, vecs):
        row[:len(v) // 4] = np.frombuffer(v, "<i4")[:width]
    return out


# --- splits --------------------------------------------------------------------------------------

@dataclass
class Splits:
    """Upper median splits: inner nodes in an array, children by index; a leaf's value is its cell."""

    dim: list[int]
    at: list[float]
    child: list[tuple[int, int]]
    cells: int

    def cell(self, x: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))] if len(x) else []
        while todo:
            node, rows = todo.pop()
            if self.child[node] is None:
                out[rows] = self.dim[node]
                continue
            left = x[rows, self.dim[node]] <= self.at[node]
            for child, part in zip(self.child[node], (rows[left], rows[~left])):
                if len(part):
                    todo.append((child, part))
        return out


def median_split(x: np.ndarray) -> tuple[int, float] | None:
    """Widest dimension and a value with about half the rows at or below it; None if all rows are equal."""
    if not x.size:
        return None
    lo, hi = x.min(axis=0), x.max(axis=0)
    dim = int((hi - lo).argmax())
    if lo[dim] == hi[dim]:
        return None
    at = float(np.partition(x[:, dim], (len(x) - 1) // 2)[(len(x) - 1) // 2])
    return (dim, at) if at < hi[dim] else (dim, float(x[x[:, dim] < hi[dim], dim].max()))


def fit_splits(sample: np.ndarray, cells: int) -> Splits:
    out, parts = Splits([0], [0.0], [None], 1), [(0, sample)]
    while out.cells < cells and parts:
        parts.sort(key=lambda p: len(p[1]))
        node, x = parts.pop()                                # the cell with most of the sample
        cut = median_split(x)
        if cut is None or len(x) < 2:
            continue
        left = x[:, cut[0]] <= cut[1]
        kids = len(out.dim), len(out.dim) + 1
        out.dim += [out.dim[node], out.cells]
        out.at += [0.0, 0.0]
        out.child += [None, None]
        out.dim[node], out.at[node], out.child[node] = cut[0], cut[1], kids
        out.cells += 1
        parts += [(kids[0], x[left]), (kids[1], x[~left])]
    return out


# --- one shard -----------------------------------------------------------------------------------

class Tree:
    """KD-tree of median splits with the tight box of each node."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, k: int):
        self.k, self.order = k, np.arange(len(x))
        lo, hi, self.kids, self.span = [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            part = x[self.order[start:stop]]
            node = len(self.span)
            lo.append(part.min(axis=0))
            hi.append(part.max(axis=0))
            self.span.append((start, stop))
            self.kids.append([])
            if parent >= 0:
                self.kids[parent].append(node)
            cut = median_split(part) if stop - start > LEAF else None
            if cut:
                left = part[:, cut[0]] <= cut[1]
                mine = self.order[start:stop]
                self.order[start:stop] = np.concatenate([mine[left], mine[~left]])
                mid = start + int(left.sum())
                todo += [(start, mid, node, 0), (mid, stop, node, 1)]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.x, self.rows = np.ascontiguousarray(x[self.order]), rows[self.order]
        self.most = float(np.abs(x).max(initial=0))

    def search(self, queries: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query: points (their places in the order given) whose score is among the best k + 1 rows, ties included, and
        at least ``least``; and their scores."""
        exact = self.most * np.abs(queries).max(initial=0) * queries.shape[1] < 2 ** 53
        if not exact and self.most * np.abs(queries).max(initial=0) * queries.shape[1] >= 2 ** 63:
            raise ValueError("scores must fit 64 bits")
        kind = np.float64 if exact else np.int64
        q, x, lo, hi = (a.astype(kind, copy=False) for a in (queries, self.x, self.lo, self.hi))
        bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        for row, top, t in zip(q, bound, least.tolist()):
            top = top.tolist()
            heap = [(-top[0], 0)]
            at, scores = np.zeros(0, np.int64), np.zeros(0, kind)
            while heap and -heap[0][0] >= t:                 # the best box left may still hold a tie
                node = heapq.heappop(heap)[1]
                if self.kids[node]:
                    for c in self.kids[node]:
                        if top[c] >= t:
                            heapq.heappush(heap, (-top[c], c))
                    continue
                start, stop = self.span[node]
                s = x[start:stop] @ row
                good = np.flatnonzero(s >= t)
                if not len(good):
                    continue
                at, scores = np.concatenate([at, good + start]), np.concatenate([scores, s[good]])
                best = np.argsort(-scores, kind="stable")
                enough = np.searchsorted(np.cumsum(self.rows[at[best]]), self.k + 1)
                if enough < len(best):
                    t = max(t, int(scores[best[enough]]))
                    keep = scores >= t
                    at, scores = at[keep], scores[keep]
            yield self.order[at], scores.astype(np.int64)


_FOUND = f"key string, score long, same boolean, ids array<{ID}>, cell int, lo array<int>, hi array<int>"
_SCHEMA = pa.schema([("key", pa.string()), ("score", pa.int64()), ("same", pa.bool_()), ("ids", pa.list_(pa.struct([("i", pa.int64())]))),
                     ("cell", pa.int32()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32()))])
_QUERIES = 256               # searched at a time


def _searched(points: DataFrame, queries: DataFrame, k: int, shards: int, width: int) -> DataFrame:
    """Searches every query's shard for it.  ``points``: (shard, vec, ids, cell); ``queries``: (shard, key, vec, least).
    Rows (key, score, same vector, ids) of what is found; and for every shard one without a key, with its cell and box."""
    both = (points.select("shard", F.lit(False).alias("asks"), "vec", "ids", "cell", F.lit(None).cast("string").alias("key"),
                          F.lit(None).cast("long").alias("least"))
            .unionByName(queries.select("shard", F.lit(True).alias("asks"), "vec", "key", "least"), allowMissingColumns=True))

    def planted(held: list[pa.RecordBatch]) -> tuple[Tree, list[bytes], pa.Array, pa.RecordBatch]:
        part = pa.Table.from_batches(held).combine_chunks()
        vecs, ids = part.column("vec").to_pylist(), part.column("ids").combine_chunks()
        tree = Tree(matrix(vecs, width), np.diff(np.asarray(ids.offsets)), k)
        box = {"cell": [part.column("cell")[0].as_py()], "lo": [tree.lo[0].astype(int).tolist()], "hi": [tree.hi[0].astype(int).tolist()]}
        return tree, vecs, ids, pa.RecordBatch.from_pydict({f.name: box.get(f.name, [None]) for f in _SCHEMA}, schema=_SCHEMA)

    def answers(tree: Tree, vecs: list[bytes], ids: pa.Array, asked: pa.RecordBatch) -> pa.RecordBatch:
        mine = asked.column("vec").to_pylist()
        least = np.array([-2 ** 63 if t is None else t for t in asked.column("least").to_pylist()], np.int64)
        found = list(tree.search(matrix(mine, width), least))
        which = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
        at, scores = (np.concatenate(x).astype(np.int64) for x in zip(*found))
        same = [vecs[p] == mine[q] for p, q in zip(at.tolist(), which.tolist())]
        none = len(at)
        return pa.RecordBatch.from_arrays(
            [asked.column("key").take(pa.array(which)), pa.array(scores), pa.array(same, pa.bool_()), ids.take(pa.array(at)).cast(_SCHEMA.field("ids").type),
             *[pa.nulls(none, _SCHEMA.field(c).type) for c in ("cell", "lo", "hi")]], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, grown = None, [], None
        for b in batches:
            mark = 2 * np.asarray(b.column("shard")).astype(np.int64) + np.asarray(b.column("asks").cast(pa.int64()))
            cuts = [0, *(1 + np.flatnonzero(mark[1:] != mark[:-1])).tolist(), b.num_rows] if b.num_rows else []
            for at, end in zip(cuts, cuts[1:]):
                asks = mark[at] % 2
                if held and (asks or mark[at] // 2 != shard):
                    *grown, box = planted(held)
                    held = []
                    yield box
                if mark[at] // 2 != shard:
                    shard, grown = mark[at] // 2, None
                if not asks:
                    held.append(b.slice(at, end - at))
                elif grown:                                  # else no point lies there
                    for lo in range(at, end, _QUERIES):
                        yield answers(*grown, b.slice(lo, min(_QUERIES, end - lo)))
        if held:
            yield planted(held)[-1]

    return both.repartitionById(shards, "shard").sortWithinPartitions("shard", "asks").mapInArrow(run, _FOUND)


def _boxes(home: DataFrame, width: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes of the cells, at most CELLS, from those of their shards; an empty cell's is inside out."""
    each = home.where("key is null").select("cell", F.posexplode(F.arrays_zip("lo", "hi")).alias("dim", "box"))
    lo, hi = np.full((cells, width), np.inf), np.full((cells, width), -np.inf)
    for cell, dim, a, b in each.groupBy("cell", "dim").agg(F.min("box.lo"), F.max("box.hi")).collect():
        lo[cell, dim], hi[cell, dim] = a, b
    return lo, hi


def _routes(queries: DataFrame, boxes: tuple[np.ndarray, np.ndarray], first: list[int], width: int) -> DataFrame:
    """(shard, key, vec, least): every query with all shards but its home whose cell can hold a score of ``least``."""
    lo, hi = boxes
    there = np.isfinite(lo).all(axis=1)
    lo, hi = np.where(there[:, None], lo, 0), np.where(there[:, None], hi, 0)
    cell_of = np.repeat(np.arange(len(lo)), np.diff(first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _QUERIES):
                b = whole.slice(at, _QUERIES)
                q = matrix(b.column("vec").to_pylist(), width)
                least = np.array([-np.inf if t is None else t for t in b.column("least").to_pylist()], float)
                bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
                # Bounds beyond 2 ** 53 are rounded here: a little slack sends a query once too often, never too seldom.
                go = there & (bound + np.abs(bound) * 1e-12 >= least[:, None])
                which, shard = np.nonzero(go[:, cell_of] & (np.arange(len(cell_of)) != np.asarray(b.column("home"))[:, None]))
                some = b.select(["key", "vec", "least"]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *some.columns], names=["shard", "key", "vec", "least"])

    return queries.mapInArrow(run, "shard int, key string, vec binary, least long")


# --- search --------------------------------------------------------------------------------------

def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank int from 1, vec_id, score long): for every row of ``rows`` for which ``is_query`` holds, the k rows with the
    highest integer inner product, all if there are fewer, ties by the smaller id (NULL last).

    Vectors that are NULL or hold a NULL or non-finite component take no part; missing components of shorter vectors are zero.
    Rows equal in id and scaled vector count once; a query's own row is that with its id and vector, so another vector under the same
    id is a candidate.  A row without an id is a candidate and no query.  Other columns are ignored; an empty table gives an empty
    result.  A scaled component beyond 32 bits, or a possible score beyond 64 bits, raises an error."""
    spark = rows.sparkSession
    usable = rows.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("ask"), scaled(F.col(vec_col)).alias("v"))
    each = staged(_pack(usable.where("v is not null")).groupBy("id", "vec").agg(F.max("ask").alias("ask")), "topk-vectors")
    by_vec = Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last())
    points = (each.withColumn("r", F.row_number().over(by_vec)).where(F.col("r") <= k + 1)
              .groupBy("vec").agg(F.collect_list(F.struct(F.col("id").alias("i"))).alias("ids")))
    asked = each.where("ask and id is not null").select("id", F.md5("vec").alias("key"), "vec")

    size = each.agg(F.approx_count_distinct("vec").alias("n"), F.coalesce(F.max(F.length("vec")), F.lit(0)).alias("b")).first()
    width = max(size.b // 4, 1)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = max(-(-size.n // SHARD_ROWS), min(parallel, -(-size.n // LEAST_SHARD_ROWS)), 1)          # shards wanted
    sample = each.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()
    splits = fit_splits(matrix([bytes(r.vec) for r in sample], width), min(CELLS, deal))

    def celled(frame: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(splits.cell(matrix(b.column("vec").to_pylist(), width)), pa.int32())],
                                                 names=[*b.schema.names, "cell"])
        return frame.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema) + ", cell int")

    placed = staged(celled(points), "topk-points")
    count = dict(placed.groupBy("cell").count().collect())                                          # at most CELLS
    most = max(-(-size.n // deal), 1)
    parts = [max(1, round(count.get(c, 0) / most)) for c in range(splits.cells)]
    first = np.concatenate([[0], np.cumsum(parts)]).tolist()
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("cell"))                        # noqa: E731
    shard = pick(first[:-1]) + F.pmod(F.xxhash64("vec"), pick(parts)).cast("int")
    placed = placed.withColumn("shard", shard)
    wanted = staged(celled(asked.select("key", "vec").distinct()).select("key", "vec", shard.alias("home")), "topk-queries")

    blank = F.lit(None).cast("long").alias("least")
    home = staged(_searched(placed, wanted.select(F.col("home").alias("shard"), "key", "vec", blank), k, first[-1], width), "topk-home")
    near = home.where("key is not null").select("key", "score", "same", "ids")
    by_score = Window.partitionBy("key").orderBy(F.desc("score"))
    kth = (near.select("key", "score", F.explode("ids")).withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k + 1)
           .select(F.col("key").alias("k_"), F.col("score").alias("least")))
    far = wanted.join(kth, F.col("key") == F.col("k_"), "left").select("key", "vec", "home", "least")
    rest = _searched(placed, _routes(far, _boxes(home, width, splits.cells), first, width), k, first[-1], width)
    found = near.union(rest.where("key is not null").select("key", "score", "same", "ids")).select("key", "score", "same", F.explode("ids").alias("x"))
    ranked = [F.desc("score"), F.col("vec_id").asc_nulls_last()]
    best = (found.select(F.col("key").alias("k_"), "score", "same", F.col("x.i").alias("vec_id"))
            .withColumn("r", F.row_number().over(Window.partitionBy("k_").orderBy(*ranked, "same"))).where(F.col("r") <= k + 1))
    pairs = (asked.select(F.col("id").alias("query_id"), "key").join(best, F.col("key") == F.col("k_"))
             .where(~(F.col("same") & F.col("vec_id").eqNullSafe(F.col("query_id")))))
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(*ranked, "same"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
