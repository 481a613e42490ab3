"""Prefix trie of conversations from vertical bitmaps.

Conversations in ascending order of their id are cut into shards of a bounded number of turns.  A shard indexes every (position,
turn) to the bitset of the conversations that have that turn there, and every length to the bitset of those that end there.
Starting from the root with all conversations, a depth-first walk intersects a node's bitset with the postings of the next
position: each non-empty intersection is a child, its popcount the members, its lowest bit the smallest id, and its intersection with
the bitset of its depth the list of conversations that end there.

Nodes of several shards with equal prefixes are the same node.  They are joined by a digest of the prefix: the node belongs to the
shard that has its smallest member.  Counts over subtrees then are sums: a node counts as a child, as a leaf and with its words
in the shard it belongs to, members count where they are.  A shard's nodes lie in the order of the walk, in which a
subtree is a range, so that its sums are differences of running sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

SHARD_TURNS = 20_000         # a shard is closed at the end of the conversation that reaches it
ROOT = b"\0" * 16
WORD = r"[^\x20\x09-\x0D]+"
_CHUNK = 4096                # nodes of a batch


# --- rebuilt conversations -----------------------------------------------------------------------

def turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos from 1, code binary, words) of every turn, written.  NULL role and text are empty; turns ascend, NULL first, ties by the
    digest of role and text.  Rows without a conversation are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    code = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    rows = (conversations.where(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), code.alias("code"), words.alias("words")))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "code")
    return staged(rows.withColumn("pos", F.row_number().over(order)).select("conv", "pos", "code", "words"), "trie-turns")


def grafted(rows: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Every conversation with the first ``heads`` (at most ``most``) turns of conversation ``base`` in place of its own first ones:
    (conv, part, pos, code, words); a conversation without any turn left keeps one row with part -1 and no code, like all others."""
    convs = rows.where("pos = 1").select("conv", base.alias("base"), heads.alias("h"))
    anchor = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("code"), F.lit(0).cast("long").alias("words"))
    first = rows.where(F.col("pos") <= most).select(F.col("conv").alias("of"), "pos", "code", "words")
    taken = (convs.where("h > 0").join(first, (F.col("base") == F.col("of")) & (F.col("pos") <= F.col("h")))
             .select("conv", F.lit(0).alias("part"), "pos", "code", "words"))
    own = rows.where(F.col("pos") > heads).select("conv", F.lit(1).alias("part"), "pos", "code", "words")
    return anchor.union(taken).union(own)


# --- one shard -----------------------------------------------------------------------------------

def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def walk(ids: list[int], seqs: list[list[bytes]], words: dict[bytes, int]) -> Iterator[tuple]:
    """Nodes of a shard in depth-first order: (place of the parent, depth, prefix digest, smallest member, members, words of the last
    turn, ids that end there).  ``ids`` ascend."""
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    for i, s in enumerate(seqs):
        bit = 1 << i
        ends[len(s)] = ends.get(len(s), 0) | bit
        for at in enumerate(s):
            postings[at] = postings.get(at, 0) | bit

    # (bitset, depth, place of the parent, digest of the parent, turn)
    todo, place = [((1 << len(ids)) - 1, 0, -1, b"", b"")], 0
    while todo:
        bits, depth, parent, above, turn = todo.pop()
        key = hashlib.blake2b(above + turn, digest_size=16).digest() if depth else ROOT
        here = bits & ends.get(depth, 0)
        yield parent, depth, key, ids[lowest(bits)], bits.bit_count(), words[turn] if depth else 0, [ids[i] for i in members(here)]
        rest = bits ^ here
        while rest:
            code = seqs[lowest(rest)][depth]                 # turn at position depth of the least member not yet in a child
            child = rest & postings[depth, code]
            todo.append((child, depth + 1, place, key, code))
            rest ^= child
        place += 1


def _nodes(rows: DataFrame) -> DataFrame:
    """Nodes of every shard, from the rows of ``grafted``."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [("shard", pa.int64()), ("place", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("key", pa.binary()), ("low", pa.int64()),
              ("n", pa.int64()), ("words", pa.int64()), ("n_ends", pa.int64()), ("ends", pa.string())]
    schema = pa.schema(fields)

    def shard(ids: list[int], seqs: list[list[bytes]], words: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for place, (parent, depth, key, low, n, w, ends) in enumerate(walk(ids, seqs, words)):
            out.append((ids[0], place, parent, depth, key, low, n, w, len(ends), ",".join(map(str, ends)) if ends else None))
            if len(out) == _CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        seqs: list[list[bytes]] = []
        words: dict[bytes, int] = {}
        size = 0
        for b in batches:
            for conv, code, w in zip(b.column("conv").to_pylist(), b.column("code").to_pylist(), b.column("words").to_pylist()):
                if not ids or conv != ids[-1]:
                    if size >= SHARD_TURNS:
                        yield from shard(ids, seqs, words)
                        ids, seqs, words, size = [], [], {}, 0
                    ids.append(conv)
                    seqs.append([])
                if code is not None:
                    seqs[-1].append(code)
                    words[code] = w
                size += 1
        if ids:
            yield from shard(ids, seqs, words)

    ranged = rows.repartitionByRange(tasks, "conv").sortWithinPartitions("conv", "part", "pos").select("conv", "code", "words")
    return ranged.mapInArrow(run, "shard long, place int, parent int, depth int, key binary, low long, n long, words long, n_ends long, ends string")


# --- sums over subtrees --------------------------------------------------------------------------

def _subtrees(nodes: DataFrame) -> DataFrame:
    """Per node of a shard its part of the node's counts.  ``nodes`` also have the node's smallest member ``owner`` and ``childless``."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def solved(b: pa.Table) -> pa.RecordBatch:
        col = {c: b.column(c).to_numpy() for c in ("parent", "low", "n", "words", "owner", "childless")}
        count = len(col["parent"])
        parent, mine = col["parent"], col["low"] == col["owner"]                   # the node belongs to this shard
        last = np.arange(count)                              # place of the last node of the subtree
        for i, p in zip(range(count - 1, 0, -1), parent[:0:-1].tolist()):
            if last[i] > last[p]:
                last[p] = last[i]

        def below(x: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(x)])
            return total[last + 1] - total[np.arange(count)]

        children = np.zeros(count, np.int64)
        np.add.at(children, parent[1:], mine[1:].astype(np.int64))
        leaves = below((mine & col["childless"].astype(bool)).astype(np.int64))
        saved = below(col["words"] * (col["n"] - mine))
        above = np.where(parent >= 0, col["owner"][np.maximum(parent, 0)], 0)
        return pa.RecordBatch.from_arrays(
            [b.column("key").combine_chunks(), b.column("depth").combine_chunks(), b.column("owner").combine_chunks(), pa.array(above, pa.int64(), mask=parent < 0),
             *[pa.array(x, pa.int64()) for x in (col["n"], children, leaves, saved)]], names=["key", "depth", "owner", "above", "n", "children", "leaves", "saved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            shard = b.column("shard").to_numpy()
            cuts = [0, *(1 + np.flatnonzero(shard[1:] != shard[:-1])).tolist(), b.num_rows] if b.num_rows else []
            for at, end in zip(cuts, cuts[1:]):
                if held and shard[at] != now:
                    yield solved(pa.Table.from_batches(held))
                    held = []
                now = shard[at]
                held.append(b.slice(at, end - at))
        if held:
            yield solved(pa.Table.from_batches(held))

    by_shard = nodes.repartition(tasks, "shard").sortWithinPartitions("shard", "place")
    return by_shard.mapInArrow(run, "key binary, depth int, owner long, above long, n long, children long, leaves long, saved long")


def _end_digests(nodes: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end; a node's lists are hashed as they stream by, in ascending order."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for b in batches:
            keys, out = [], []
            for k, part in zip(b.column("key").to_pylist(), b.column("ends")):
                if k != key:
                    if digest is not None:
                        keys.append(key)
                        out.append(digest.hexdigest())
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(part.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], names=["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    lists = nodes.where("n_ends > 0").select("key", "shard", "ends").repartition(tasks, "key").sortWithinPartitions("key", "shard")
    return lists.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: Column, heads: Column, most: int, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256).

    ``base`` and ``heads`` are expressions of column ``conv``: a conversation's first ``heads`` (at most ``most``) turns are those of
    conversation ``base``.  Prefixes are equal if their turns' role and text are; NULLs are empty.  Rows without a conversation id
    take no part; equal rows are turns of their own; other columns are ignored; without conversations there is no node."""
    rows = turns(conversations, conv_col, turn_col, role_col, text_col)
    nodes = staged(_nodes(grafted(rows, base, heads, most)), "trie-nodes")
    # A prefix has a row per shard that has it.
    shared = nodes.groupBy(F.col("key").alias("k")).agg(F.min("low").alias("owner"), (F.max(F.col("n") - F.col("n_ends")) == 0).alias("childless"))
    parts = _subtrees(nodes.select("shard", "place", "parent", "key", "depth", "low", "n", "words").join(shared, F.col("key") == F.col("k")).drop("k"))
    whole = (parts.groupBy("key", "depth", "owner").agg(F.max("above").alias("above"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]))
    ends = _end_digests(nodes).withColumnRenamed("key", "k")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.join(ends, F.col("key") == F.col("k"), "left").select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("above").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
