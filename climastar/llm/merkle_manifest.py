"""Merkle manifest of a dataset: runs of eight nodes hash to their parent, per group and over the groups.

The tree is built level by level and every level is written: a row of the node table is one run, with the digests of its
members packed in order, its own digest, and a link to the run and slot that it fills itself.  A recursive
Spark query then climbs from every leaf: each step finds the leaf's run by that link, appends the run and slot, which are its siblings
there, to the path, puts the digest folded so far into the slot and hashes the run anew.  The siblings' digests are read from the path's
runs afterwards.  The climb through low runs, which hold few leaves each, is a shuffle join; from the few runs above, whose keys
would be hot, it goes on over a broadcast table of bounded size.

Positions of leaves are counted without a global window: rows are ranged by (group, order), numbered inside
their partition by the written table, and shifted by the number of rows of the group in earlier partitions.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, staged

WIDTH = 8                    # members of a run
DIGEST = 32                  # bytes
TOP = -1                     # group number of the tree over the groups
#: Repeats of one (group, order) are interchangeable and are spread over so many ranges.
SALTS = 64


def field(col: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*cols: Column) -> Column:
    return F.sha2(F.concat(*map(field, cols)).cast("binary"), 256)


# --- positions -----------------------------------------------------------------------------------

def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``ix`` long, the place from 0 of a row in its group (NULL is a group) in ascending order, NULLs first; written.
    And per group (group, n, g): its size and its own place among the groups, ascending, NULL first."""
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    # Equal rows stand in any order: a running number spreads them.
    salted = rows.withColumn("salt_", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = (salted.repartitionByRange(tasks, *keys, "salt_").sortWithinPartitions(*keys)
              .withColumn("at_", F.monotonically_increasing_id()))                  # partition << 33 | place
    kept = staged(ranged.drop("salt_"), label)
    part = F.shiftright("at_", 33)
    # A row for each partition and group in it: at most partitions + groups.
    firsts = staged(kept.groupBy(part.alias("p_"), F.col(group).alias("g_")).agg(F.min("at_").alias("from_"), F.count("*").alias("n_")), label + "-parts")
    before = F.coalesce(F.sum("n_").over(Window.partitionBy("g_").orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = firsts.select("p_", "g_", (before - F.col("from_")).alias("shift_"))
    out = (kept.withColumn("p_", part).join(shifts.withColumnRenamed("p_", "q_"), (F.col("p_") == F.col("q_")) & F.col(group).eqNullSafe(F.col("g_")))
           .withColumn("ix", F.col("at_") + F.col("shift_")).drop("p_", "q_", "g_", "at_", "shift_"))
    sizes = firsts.groupBy("g_").agg(F.sum("n_").alias("n")).withColumnRenamed("g_", group)
    return out, sizes


# --- tree ----------------------------------------------------------------------------------------

def _hash(packed: Column) -> Column:
    """SHA-256 of packed digests as hex text, again as bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(packed)).cast("binary"), 256))


def build_levels(nodes: DataFrame, largest: int, label: str) -> list[DataFrame]:
    """Levels of runs over ``nodes`` (g, n, ix, digest, weight), each written: (g, lv, ix, n, packed, digest, weight).  ``weight``: leaves
    below; ``largest``: the most nodes of a group."""
    out, lv = [], 0
    while largest > 1:
        lv, largest = lv + 1, -(-largest // WIDTH)
        runs = (nodes.where("n > 1").groupBy("g", F.floor(F.col("ix") / WIDTH).alias("run"))
                .agg(F.sort_array(F.collect_list(F.struct("ix", "digest"))).alias("m"), F.sum("weight").alias("weight"), F.first("n").alias("was"))
                .select("g", F.lit(lv).alias("lv"), F.col("run").alias("ix"), F.ceil(F.col("was") / WIDTH).alias("n"),
                        F.unhex(F.array_join(F.transform("m", lambda x: F.hex(x.digest)), "")).alias("packed"), "weight"))
        nodes = staged(runs.withColumn("digest", _hash(F.col("packed"))), f"{label}-level")
        out.append(nodes)
    return out


@contextmanager
def _no_row_limit(spark: SparkSession):
    """Recursive queries return as many rows as they find while this is open."""
    key = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, was) if was is not None else spark.conf.unset(key)


#: Runs that hold more than one in so many of all leaves: at most SHARE on a level of the tree, about 3 MB in all, which are
#: broadcast.  The others hold few leaves each, so that no key of their join is hot.
SHARE = 8192


def _holds(lv: Column, ix: Column, leaves: Column) -> Column:
    """Leaves below place ``ix`` of level ``lv`` in a group of ``leaves``."""
    width = F.pow(F.lit(float(WIDTH)), lv)
    return F.least(width, leaves - ix * width)


def _linked(nodes: DataFrame, groups: DataFrame, over: DataFrame | None, rows: int) -> DataFrame:
    """``nodes`` (g, lv, ix, n and more) with the run they fill: (up_g, up_lv, up_ix, slot), NULL for the root, and ``low``: whether
    that run is a low one.  ``n``: nodes of the group on that level; ``groups``: (of, leaves); ``over``: runs of the tree over the groups.  A
    group's last node is a member of that tree, if there is one."""
    inside = F.col("n") > 1
    leaves = nodes.join(groups, F.col("g") == F.col("of"), "left").drop("of")
    light = F.when(inside & (F.col("g") != TOP), _holds(F.col("lv") + 1, F.floor(F.col("ix") / WIDTH), F.col("leaves")) * SHARE <= rows)
    if over is None:
        up = {c: F.when(inside, v) for c, v in (("up_g", F.col("g")), ("up_lv", F.col("lv") + 1), ("up_ix", F.floor(F.col("ix") / WIDTH)), ("slot", F.col("ix") % WIDTH))}
        return leaves.withColumns({**up, "slot": up["slot"].cast("int"), "low": F.coalesce(light, F.lit(False))}).drop("leaves")
    at_top = F.col("g") == TOP
    place = F.when(at_top, F.col("ix")).otherwise(F.col("g"))
    level = F.when(at_top, F.col("lv") + 1).otherwise(F.lit(1))
    joins = inside == at_top                                 # of the tree over the groups, or a group's last node
    tops = over.select(F.col("lv").alias("t_lv"), F.col("ix").alias("t_ix"), (F.col("weight") * SHARE <= rows).alias("t_low"))
    both = leaves.join(tops, joins & (level == F.col("t_lv")) & (F.floor(place / WIDTH) == F.col("t_ix")), "left")
    top = F.col("t_lv").isNotNull()
    up = {"up_g": F.when(top, F.lit(TOP).cast("long")).when(inside, F.col("g")), "up_lv": F.when(top, F.col("t_lv")).when(inside, F.col("lv") + 1),
          "up_ix": F.when(top, F.col("t_ix")).when(inside, F.floor(F.col("ix") / WIDTH)),
          "slot": F.when(top, place % WIDTH).when(inside, F.col("ix") % WIDTH).cast("int"), "low": F.coalesce("t_low", light, F.lit(False))}
    return both.withColumns(up).drop("leaves", "t_lv", "t_ix", "t_low")


# A step's element of the path: number of the run, a bit for low ones, the slot.
_CLIMB = f"""
WITH RECURSIVE climb (g, doc_id, up_g, up_lv, up_ix, slot, low, folded, path) AS (
  SELECT g, doc_id, up_g, up_lv, up_ix, slot, low, folded, path FROM {{start}}
  UNION ALL
  SELECT {{hint}} c.g, c.doc_id, r.up_g, r.up_lv, r.up_ix, r.slot, r.low,
         unhex(sha2(CAST(lower(hex(concat(substring(r.packed, 1, c.slot * {DIGEST}), c.folded,
                                          substring(r.packed, c.slot * {DIGEST} + {DIGEST + 1})))) AS BINARY), 256)),
         concat(c.path, array(r.run * 16 + int(c.low) * 8 + c.slot))
  FROM climb c JOIN {{runs}} r ON c.up_g = r.of_g AND c.up_lv = r.of_lv AND c.up_ix = r.of_ix)
SELECT * FROM climb"""


def _climb(start: DataFrame, runs: DataFrame, few: bool) -> DataFrame:
    """The recursive query: a row for every leaf of ``start`` and every step up through ``runs``, with the digest folded and the path so
    far, whose siblings the runs of the path hold.  Spark shuffles the rows of every step, so they carry no digests but the folded one."""
    hint = "/*+ BROADCAST(r) */" if few else ""
    return start.sparkSession.sql(_CLIMB.replace("{hint}", hint), start=start, runs=runs)


def _siblings(climbed: DataFrame, runs: DataFrame, steps: int, low_levels: list[int]) -> DataFrame:
    """``climbed`` with ``proof`` binary, the siblings on its path in order, and ``member`` binary, the leaf itself (NULL without a path)."""
    few = F.broadcast(runs.where("not light").select(F.col("run").alias("h_run"), F.col("packed").alias("h_packed")))
    rows = climbed.withColumns({"proof": F.lit(b""), "member": F.lit(None).cast("binary")})
    for k in range(steps):
        rows = rows.withColumn("step", F.get("path", F.lit(k)))
        low = F.col("step").bitwiseAND(F.lit(8)) != 0
        number = F.shiftright("step", 4)
        rows = rows.join(few, ~low & (number == F.col("h_run")), "left").withColumn("packed", F.col("h_packed")).drop("h_run", "h_packed")
        if k + 1 in low_levels or TOP in low_levels:
            # Rows that are elsewhere match nothing and are spread.
            rows = rows.withColumn("find", F.when(low, number).otherwise(-1 - F.pmod(F.xxhash64("doc_id", "folded"), F.lit(1 << 20))))
            some = runs.where(F.col("light") & ((F.col("of_lv") == k + 1) | (F.col("of_g") == TOP))).select(F.col("run").alias("l_run"), F.col("packed").alias("l_packed"))
            rows = (rows.join(some, F.col("find") == F.col("l_run"), "left").withColumn("packed", F.coalesce("packed", "l_packed"))
                    .drop("find", "l_run", "l_packed"))
        at = (F.col("step").bitwiseAND(F.lit(7)) * DIGEST).cast("int")
        others = F.concat(F.substring(F.col("packed"), F.lit(1), at), F.substring(F.col("packed"), at + DIGEST + 1, F.lit(WIDTH * DIGEST)))
        new = {"proof": F.concat("proof", F.coalesce(others, F.lit(b"")))}
        if k == 0:
            new["member"] = F.substring(F.col("packed"), at + 1, F.lit(DIGEST))
        rows = rows.withColumns(new).drop("step", "packed")
    return rows


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", group_col: str = "lang", chars_col: str = "n_chars",
             text_col: str = "text", tampered: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; digests in lower-case hex.

    Per group (NULL is one) leaves ascend by id, NULL first, ties by their digest; equal rows are leaves of their own.
    ``tampered`` says whose text has A-Z lower-cased before the climb from its leaf; a row verifies if the folded digest equals the root.
    A lone leaf is its group's subroot, and a lone subroot the root; their proof is the hash of nothing.  NULL and empty fields
    differ.  Other columns are ignored; an empty table gives an empty result."""
    fields = [F.col(c) for c in (id_col, source_col, group_col, chars_col)]
    leaf = leaf_digest(*fields, F.col(text_col))
    changed = leaf_digest(*fields, ascii_lower(F.col(text_col)))
    spark = docs.sparkSession
    bad = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("grp"), F.unhex(leaf).alias("leaf"),
                       F.unhex(F.when(bad, changed).otherwise(leaf)).alias("folded"))
    rows = staged(rows, "merkle-digests")                    # ranging reads them twice
    placed, sizes = numbered(rows, "grp", ["doc_id", "leaf"], "merkle-leaves")
    named, _ = numbered(sizes.withColumn("all", F.lit(0)), "all", ["grp"], "merkle-groups")
    named = staged(named.select(F.col("grp").alias("of"), "n", F.col("ix").alias("g")), "merkle-groups")
    total = named.agg(F.count("*").alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    leaves = staged(placed.join(named, F.col("grp").eqNullSafe(F.col("of"))).select("g", "ix", "n", "doc_id", "leaf", "folded"), "merkle-leaves")

    nodes = leaves.select("g", "n", "ix", F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("weight"))
    levels = build_levels(nodes, total.largest, "merkle")
    last = [x.where("n = 1").select("g", "digest", "weight") for x in (nodes, *levels)]
    subroots = last[0]
    for x in last[1:]:
        subroots = subroots.union(x)
    subroots = staged(subroots, "merkle-subroots")
    over = build_levels(subroots.select(F.lit(TOP).cast("long").alias("g"), F.lit(total.groups).cast("long").alias("n"), F.col("g").alias("ix"), "digest", "weight"),
                        total.groups, "merkle-top")
    root = (over[-1] if over else subroots).select(F.lower(F.hex("digest"))).first()

    root = F.lit(root[0] if root else None).cast("string")
    top = None
    for x in over:
        top = x if top is None else top.union(x)
    sizes = named.select(F.col("g").alias("of"), F.col("n").alias("leaves"))
    start = (_linked(leaves.withColumn("lv", F.lit(0)), sizes, top, total.rows)
             .select("g", "doc_id", "up_g", "up_lv", "up_ix", "slot", "low", "folded", F.array().cast("array<bigint>").alias("path"), "leaf"))
    runs = None
    for x in (*levels, *over):
        runs = x if runs is None else runs.union(x)
    if runs is None:                                         # one leaf at most
        done = start.select("g", "doc_id", "leaf", "folded", F.lit(b"").alias("proof"))
    else:
        light = F.when(F.col("g") == TOP, F.col("weight") * SHARE <= total.rows).otherwise(
            _holds(F.col("lv"), F.col("ix"), F.col("leaves_")) * SHARE <= total.rows)
        named_ = sizes.select(F.col("of").alias("of_"), F.col("leaves").alias("leaves_"))
        runs = runs.join(named_, F.col("g") == F.col("of_"), "left").withColumn("light", light)
        runs = staged(_linked(runs, sizes, top, total.rows).select(
            F.monotonically_increasing_id().alias("run"), F.col("g").alias("of_g"), F.col("lv").alias("of_lv"), F.col("ix").alias("of_ix"),
            "up_g", "up_lv", "up_ix", "slot", "low", "packed", "light"), "merkle-runs")
        # Levels with low runs, TOP for those of the tree over the groups.
        low_levels = [r[0] for r in runs.where("light").select(F.when(F.col("of_g") == TOP, TOP).otherwise(F.col("of_lv"))).distinct().collect()]
        with _no_row_limit(spark):
            climb = start.drop("leaf")
            if low_levels:
                climb = staged(_climb(climb, runs.where("light"), False).where("not low"), "merkle-climb")
            climb = staged(_climb(climb, runs.where("not light"), True).where("up_g is null"), "merkle-climb")
        steps = climb.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
        done = _siblings(climb, runs, steps, low_levels).withColumn("leaf", F.col("member"))
    out = done.join(subroots.select(F.col("g").alias("of"), F.lower(F.hex("digest")).alias("subroot")), F.col("g") == F.col("of"))
    folded = F.lower(F.hex("folded"))
    return out.select(F.col("doc_id").alias(id_col), F.lower(F.hex("leaf")).alias("leaf"), "subroot", root.alias("root"),
                      F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"),
                      (folded == root).alias("verified"))


def every_third(id_col: str = "doc_id") -> Column:
    """Unsigned crc32 of the decimal id is divisible by 3; false for NULL."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))
