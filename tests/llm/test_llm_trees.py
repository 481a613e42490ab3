"""Top-k search, Merkle manifest and prefix trie against brute force, with NULLs, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from climastar.llm import kdtree_topk, merkle_manifest, prefix_trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def more_columns(df):
    """Columns with names that the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in ("id", "key", "vec", "v", "ask", "cell", "shard", "ids", "score", "rank", "g", "ix", "n", "digest", "leaf", "root",
                                                   "grp", "conv", "pos", "code", "words", "depth", "base", "place") if c not in df.columns})


# --- top-k

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top_k(rows, k, is_query):
    """Distinct rows (id, scaled vector); a query is not its own candidate."""
    seen = {}
    for i, v in rows:
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(1024 * float(np.float32(c)))) for c in v]
        while x and x[-1] == 0:
            x.pop()
        seen[i, tuple(x)] = None
    out = []
    for q, a in seen:
        if q is not None and is_query(q):
            best = sorted((-sum(s * t for s, t in zip(a, b)), i is None, i or 0, i) for i, b in seen if (i, b) != (q, a))[:k]
            out += [(q, r + 1, b[3], -b[0]) for r, b in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("leaf,rows_of_shard", [(64, 1024), (2, 8)])
def test_top_k_equals_brute_force(spark, monkeypatch, leaf, rows_of_shard):
    monkeypatch.setattr(kdtree_topk, "LEAF", leaf)
    monkeypatch.setattr(kdtree_topk, "LEAST_SHARD_ROWS", rows_of_shard)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]                          # a vector that very many rows share
    rows += [(2000 + i, [1.0, 0.0, 0.0, 0.0, float(i // 4)]) for i in range(40)]  # ties
    rows += [(3000, None), (3010, [1.0, None]), (3020, [float("nan")]), (3030, [float("inf"), 1.0]), (3040, []), (3050, [2.0]), (3060, [0.5] * 7),
             (None, [3.0] * 5), (-10, [-2.0] * 5), rows[20], rows[20], (30, [9.0] * 5)]
    df = more_columns(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4))
    got = kdtree_topk.top_k(df, F.col("vec_id") % 10 == 0, k=5)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_top_k(rows, 5, lambda i: i % 10 == 0)


def test_top_k_with_few_or_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0), (2, [-1.0], 0)], VECTORS)
    assert sorted(map(tuple, kdtree_topk.top_k(few, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 2048 * 1024), (0, 2, 2, -1024 * 1024)]
    assert kdtree_topk.top_k(few.where("vec_id = 0"), F.lit(True)).count() == 0
    assert kdtree_topk.top_k(few.where("false"), F.lit(True)).count() == 0
    assert kdtree_topk.top_k(few, F.lit(None).cast("boolean")).count() == 0


def test_traversal_skips_boxes_below_the_kth_score():
    rng = np.random.default_rng(1)
    x = np.floor(np.concatenate([rng.normal(c, 1, size=(200, 3)) for c in (-400, 0, 400)]))
    tree = kdtree_topk.Tree(x, np.ones(len(x), int), 3)
    boxes = np.maximum(x[-1], 0) @ tree.hi.T + np.minimum(x[-1], 0) @ tree.lo.T
    assert (boxes[:, None].max(axis=1) >= np.array([(x[tree.order[a:b]] @ x[-1]).max() for a, b in tree.span])).all()
    (at, scores), = tree.search(x[-1:], np.array([-2 ** 63]))
    assert sorted(scores.tolist()) == sorted((x @ x[-1]).astype(int).tolist())[-len(at):] and len(at) >= 4
    assert sum(b > scores.min() for b, k in zip(boxes, tree.kids) if not k) < sum(not k for k in tree.kids) / 2
    (at, _), = tree.search(x[-1:], np.array([10 ** 9]))                              # a propagated score nobody reaches
    assert len(at) == 0


# --- Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r, text):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def tree(level):
        path, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            runs = [level[i:i + 8] for i in range(0, len(level), 8)]
            for j in range(len(at)):
                path[j].append((runs[at[j] // 8], at[j] % 8))
                at[j] //= 8
            level = [H(*r) for r in runs]
        return level[0], path

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {}
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        done[g] = (mine, *tree([leaf(r, r[1]) for r in mine]))
    root, over = tree([done[g][1] for g in order])
    out = []
    for g, above in zip(order, over):
        for r, path in zip(done[g][0], done[g][2]):
            folded = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                folded = leaf(r, None if r[1] is None else r[1].translate(LOWER))
            proof = []
            for run, slot in path + above:
                proof += run[:slot] + run[slot + 1:]
                folded = H(*run[:slot], folded, *run[slot + 1:])
            out.append((r[0], leaf(r, r[1]), done[g][1], root, H(*proof), folded, folded == root))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def manifest_rows(spark, rows):
    df = more_columns(spark.createDataFrame(rows, DOCS).repartition(3))
    return sorted(map(tuple, merkle_manifest.manifest(df, tampered=merkle_manifest.every_third()).collect()), key=str)


def test_manifest_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["Ab", "cd", "", None, "É" * 3000]), "de" if i % 3 else rng.choice(["en", None, "Z", "é", ""]), rng.choice(["s", None]), rng.choice([i, None]))
            for i in range(150)]
    rows += [(7, "Equal", "de", "s", 5)] * 70 + [(7, "Other", "de", "s", 5), (None, "No id", "de", None, 1), (None, "No id", None, None, 1), (-3, "Lone", "xx", "s", 4)]
    got = manifest_rows(spark, rows)
    assert got == brute_manifest(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9])
def test_small_manifests(spark, n):
    rows = [(i, "Text", "en", "s", 4) for i in range(n)]
    assert manifest_rows(spark, rows) == (brute_manifest(rows) if n else [])
    lone = [(i, "Text", f"l{i}", "s", 4) for i in range(n)]
    assert manifest_rows(spark, lone) == (brute_manifest(lone) if n else [])


def test_climb_in_two_parts(spark, monkeypatch):
    """Low runs are joined, heavy ones broadcast; whichever way, the digests are the same."""
    rows = [(i, f"T{i}", "en" if i % 5 else "de", "s", i) for i in range(600)]
    want = brute_manifest(rows)
    for share in (0, 1, 9, 100):
        monkeypatch.setattr(merkle_manifest, "SHARE", share)
        assert manifest_rows(spark, rows) == want


# --- prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(c, []).append((t is not None, t or 0, code, role, text))
    own = {c: [x[3:] for x in sorted(s)] for c, s in own.items()}
    nodes = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + s[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), ([], []))[0].append(c)
        nodes[tuple(whole)][1].append(c)
    kids = {}
    for k in nodes:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, (m, _) in nodes.items():
        w = (len(m) - 1) * len(re.findall(rb"[^\x20\x09-\x0D]+", k[-1][1].encode())) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += w
            leaves[k[:d]] += k not in kids
    return sorted(((min(m), len(k), min(nodes[k[:-1]][0]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest()) for k, (m, e) in nodes.items()), key=str)


def trie(spark, rows, parts=3):
    df = more_columns(spark.createDataFrame(rows, TURNS).repartition(parts))
    conv = F.col("conv")
    out = prefix_trie.prefix_trie(df, base=conv - conv % 20, heads=F.crc32(conv.cast("string").cast("binary")) % 4, most=3)
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("shard_turns", [1, 60, 20_000])
def test_trie_equals_brute_force(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 90), -3, -20, -25, 10 ** 12]:
        start = rng.choice([["a", "b"], ["a"], [], ["a", "b", "c d  e\x0bf"]])
        for t, text in enumerate(start + [rng.choice("xyz") for _ in range(rng.randrange(4))]):
            rows.append((c, t, rng.choice(["user", "user", "bot"]), text))
    rows += [(200 + i, t, "user", "same words here") for i in range(60) for t in range(3)]       # copies
    rows += [(300, t, "user", f"turn {t % 7}") for t in range(150)]                               # a long one
    rows += [(301, None, None, None), (301, None, "", ""), (301, 5, "r", "b"), (301, 5, "r", "a"), (302, 0, "user", "w " * 5000), (None, 0, "user", "a"),
             (303, 0, "user", "a"), (303, 0, "user", "a")]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 0, "a", "b")]) == []
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 == 3)     # loses its turns, and its base is absent
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    empty = hashlib.sha256(str(c).encode()).hexdigest()
    assert trie(spark, rows) == brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, empty)]
