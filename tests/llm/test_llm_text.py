"""Operators on documents against brute force, with NULLs, empty and repeated rows, ties and clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from climastar.llm import bpe, common, decontaminate, fingerprints, langid, maxent_lm, simhash_dedup, suffix_dedup
from climastar.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, parts=3):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clashing(df):
    """Columns with names that the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in ("id", "key", "row", "fingerprint_", "salt", "did", "digest", "h", "n", "c", "token")})


def prose(rng, n, words=("the", "of", "and", "a", "zebra", "Über", "niño", "été", "rain,", "stone.")):
    return " ".join(rng.choice(words) + (str(rng.randrange(50)) if rng.random() < 0.3 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 150)) for _ in range(40)]
    out = list(enumerate(base))
    out += [(100 + i, base[i] + " end") for i in range(10)] + [(200 + i, base[3]) for i in range(4)]
    return out + [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "One  two"), (305, base[5]), (305, base[5]), (None, base[6]),
                  (None, None), (-7, base[7].upper()), (306, "\u0130 \u00a0x" + "é" * 300)]


# --- SimHash near-dedup

def brute_simhash(text, size):
    w = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + size]), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints):
    """{index: smallest id reachable} by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
            parent[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(prints):
        ids[find(i)].append(d)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(prints))]


def test_simhash_groups(spark, texts):
    got = simhash_dedup.near_duplicates(clashing(frame(spark, texts))).collect()
    prints = [(d, brute_simhash(t, 3)) for d, t in texts]
    want = sorted((str(d), p, str(c)) for (d, p), c in zip(prints, brute_components(prints)))
    assert sorted((str(r.doc_id), r.fingerprint & (1 << 64) - 1, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("bucket", [1, 4, 32])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_keep_components_of_dense_groups(spark, bucket, distance, monkeypatch):
    """Many fingerprints around a few centres: small and hot buckets give the components of all pairs."""
    monkeypatch.setattr(simhash_dedup, "BUCKET", bucket)
    rng = random.Random(distance)
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in (0, (1 << 64) - 1, rng.getrandbits(64)) for _ in range(60)}
    signed = {f - (1 << 64 if f >> 63 else 0) for f in fps}
    edges = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance)
    parts = {r.node: r.component for r in common.connected_components(edges).collect()}
    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
            assert parts.get(a, a) == parts.get(b, b)
    for r in edges.collect():
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= distance


def test_keep_one(spark, texts):
    docs = frame(spark, texts)
    got = simhash_dedup.keep_one(docs)
    assert got.columns == docs.columns
    prints = [(d, brute_simhash(t, 3)) for d, t in texts if d is not None]
    kept = {d for (d, _), c in zip(prints, brute_components(prints)) if d == c}
    ids = [r.doc_id for r in got.where("doc_id is not null").collect()]
    assert len(ids) == len(set(ids)) and kept - set(ids) <= {d for d, _ in prints} and set(ids) <= kept


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5), (7, 6), (-3, 200), (200, 201)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(50)}, -3: -3, 200: -3, 201: -3}


# --- BPE

def test_bpe_is_the_library(spark, texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_path())
    more = texts + [(400, "<|endoftext|> a<|endoftext|>b <|endoftext"), (401, "don't I'LL we'd  \n\n x\t"), (402, "a" * 3000),
                    (403, "日本語 🎉🎉 \x00\x85"), (404, "   lead and trail   ")]
    got = bpe.round_trip(clashing(frame(spark, more)), tokenizer_path()).collect()
    want = []
    for d, t in more:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((str(d), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(want)


def test_bpe_columns_and_null_ids(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    out = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path(), out="back").orderBy("doc_id").collect()
    assert [r.back for r in out] == ["a b", ""] and list(out[1].ids) == []
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), tokenizer_path()).first().text is None


@pytest.mark.parametrize("many,block", [(48, 1 << 20), (1, 7), (3, 1 << 20)])
def test_merges_by_rank_and_place(monkeypatch, many, block):
    """Against merging one pair at a time, lowest rank first, leftmost first; one by one, and all of a block at once."""
    monkeypatch.setattr(bpe, "_MANY", many)
    monkeypatch.setattr(bpe, "_BLOCK", block)
    ids = {bytes([b]): b for b in range(256)}
    rank, made = {}, {}
    for r, (a, b) in enumerate([(b"a", b"a"), (b"a", b"b"), (b"aa", b"aa"), (b"ab", b"ab"), (b"aa", b"b")]):
        ids[a + b] = made[a + b] = 256 + r
        rank[ids[a], ids[b]] = (r, 256 + r)
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 20))) for _ in range(200)]
    got = bpe.merge_words(words, np.arange(256), {(a << 32) + b: r for (a, b), r in rank.items()})
    for w, ids_ in zip(words, got):
        s = list(w.encode())
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
            if best is None:
                break
            s[best[1]:best[1] + 2] = [best[0][1]]
        assert np.frombuffer(ids_, "<u4").tolist() == s


def test_one_word_of_twenty_million_letters():
    """Its memory stays within a few dozen bytes a letter, and the ids are those of the library on a part cut where no merge can cross."""
    import resource

    from tokenizers import Tokenizer

    rng = random.Random(3)
    part = "".join(rng.choice("abcdefghijklmnop") for _ in range(100_000)) + "a" * 100_000 + "ÿþ"
    tok = bpe.Tokenizer(tokenizer_path())
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids, = tok.encode_batch([part * 100])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_500_000       # kilobytes
    assert tok.decode_bytes(ids).decode() == part * 100
    one, = tok.encode_batch([part])
    assert one.tolist() == Tokenizer.from_file(tokenizer_path()).encode(part, add_special_tokens=False).ids


def test_cache_generations(monkeypatch):
    """Words come and go; ids stay right."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    monkeypatch.setattr(bpe, "LEARN_WORDS", 3)
    tok, fresh = bpe.Tokenizer(tokenizer_path()), bpe.Tokenizer(tokenizer_path())
    rng = random.Random(2)
    for _ in range(30):
        texts = [prose(rng, 12) for _ in range(3)]
        got = [x.tolist() for x in tok.encode_batch(texts)]
        assert got == [next(iter(fresh.encode_batch([t]))).tolist() for t in texts]
        assert len(tok.cache) + len(tok.older) < 90


# --- suffix arrays

def brute_removal(rows, length=200):
    seen = collections.Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(d), len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("per_shard", [1, 500])
def test_suffix_removal(spark, per_shard, monkeypatch):
    """per_shard 1 cuts nearly every key into sub-shards, which are merged."""
    monkeypatch.setattr(suffix_dedup, "KEY_SEGMENTS", per_shard)
    rng = random.Random(2)
    noise = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 700))) for _ in range(20)]
    passage = "".join(rng.choice("abcdefgh ") for _ in range(450))
    rows = list(enumerate(noise)) + [(100 + i, noise[i][:50] + passage[i:300 + i] + "é" * i + noise[i + 1][:99]) for i in range(15)]
    rows += [(200, "a" * 900), (201, "a" * 150), (202, None), (203, ""), (204, passage), (204, passage), (None, noise[3] + "x"), (None, "zz"),
             (205, "abcabc" * 100), (206, "\0" * 250 + "q"), (207, "\0" * 200)]
    got = suffix_dedup.removal_digests(clashing(frame(spark, rows))).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == brute_removal([(d, (t or "").encode()) for d, t in rows])


def test_suffix_places_stream(spark, monkeypatch):
    """A segment that very many texts have: its places go out while they come, in small batches, and none is kept."""
    monkeypatch.setattr(suffix_dedup, "PLACES", 100)
    ctx, other = bytes(range(1, 251)), bytes(range(250, 0, -1))
    taken = []

    def batches():
        names = ["key", "salt", "cuts", "ctx", "refs"]
        for i in range(50):
            taken.append(i)
            refs = np.array([(1000 * i + j, j) for j in range(70)], "<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([5]), pa.array([0], pa.int32()), pa.array([1], pa.int32()), pa.array([ctx]), pa.array([refs])], names)
        same = np.array([(9, 9)], "<i8").tobytes()                # a repeated row's place, twice
        yield pa.RecordBatch.from_arrays([pa.array([6, 6]), pa.array([0, 0], pa.int32()), pa.array([1, 1], pa.int32()),
                                          pa.array([other, other]), pa.array([same, same])], names)
    got, first = [], None
    for b in suffix_dedup.solve(batches(), 200):
        first = first or len(taken)
        assert b.num_rows <= 2 * 100
        got += zip(*(b.column(i).to_pylist() for i in range(3)))
    assert first < 5
    assert set(got) == {(1000 * i + j, j, j + 250) for i in range(50) for j in range(70)}


def test_suffix_shard_takes_little_memory():
    rng = random.Random(5)
    texts = [prose(rng, 400).encode() for _ in range(400)]
    texts += texts[:20]
    n = sum(map(len, texts))
    tracemalloc.start()
    try:
        hit = suffix_dedup.repeated_windows(texts, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(h.all() for t, h in zip(texts[:20], hit) if len(t) >= 200)
    assert peak < 70 * n and suffix_dedup.SHARD_BYTES <= 1 << 20             # bytes of arrays for a byte of text


def test_suffix_array_and_prefixes():
    rng = random.Random(4)
    for n in (0, 1, 2, 50, 700):
        s = np.array([rng.choice((1, 1, 2)) for _ in range(n)], np.uint16)
        sa, rank = suffix_dedup.suffix_array(s)
        want = sorted(range(n), key=lambda i: s[i:].tolist())
        assert sa.tolist() == want and all(rank[sa[i]] == i for i in range(n))
        if n:
            lcp = suffix_dedup.common_prefixes(s, sa, rank, 40)
            for k in range(1, n):
                a, b = s[sa[k - 1]:].tolist(), s[sa[k]:].tolist()
                assert lcp[sa[k]] == min(40, next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))


def test_windows_are_sorted_no_deeper_than_their_length(monkeypatch):
    """Ranks tell apart the first symbols only, and long repeats take no further rounds of sorting."""
    rng = random.Random(6)
    for n in (0, 1, 40, 700):
        s = np.array([rng.choice((1, 1, 2)) for _ in range(n)], np.uint16)
        for depth in (1, 16, 50, 200):
            sa, rank = suffix_dedup.suffix_array(s, depth)
            heads = [s[i:i + depth].tolist() for i in range(n)]
            assert sorted(sa.tolist()) == list(range(n)) and [heads[i] for i in sa] == sorted(heads)
            assert rank.tolist() == [sorted(heads).index(h) for h in heads] if n < 100 else len(set(rank.tolist())) == len(set(map(tuple, heads)))
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a: sorts.append(len(a)) or argsort(a))
    text = bytes(rng.choice(b"abcdefgh") for _ in range(20_000))
    hit = suffix_dedup.repeated_windows([text, b"x" + text, text[:199]], 200)
    assert [int(h.sum()) for h in hit] == [len(text) - 199] * 2 + [0] and len(sorts) <= 6


def test_segments_cover_all_windows():
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcd") for _ in range(3000)) + b"z" * 500
    key, lo, hi = suffix_dedup.segments(text)
    hi, twice = hi >> 1, hi & 1
    assert lo[0] == 0 and hi[-1] == len(text) - 200 and (lo[1:] == hi[:-1] + 1).all()
    h = suffix_dedup.gram_hashes(np.frombuffer(text, np.uint8)).view(np.uint64)
    for k, a, b, more in zip(key.view(np.uint64), lo, hi, twice):
        assert h[a:a + 169].min() == k == h[b:b + 169].min()
        assert bool(more) == ((h[a:b + 169] == k).sum() > 1)


def test_segments_of_many_texts_at_once(monkeypatch):
    """Short texts are cut together, with the segments that each has alone."""
    rng = random.Random(9)
    texts = [b"", b"a" * 199, b"a" * 200, b"a" * 500] + [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 900))) for _ in range(150)]
    texts[60] = b"ab" * 20_000                                    # in pieces
    monkeypatch.setattr(suffix_dedup, "BLOCK", 10_000)
    want = [suffix_dedup.segments(t) for t in texts]
    hashed, gram_hashes = [], suffix_dedup.gram_hashes
    monkeypatch.setattr(suffix_dedup, "gram_hashes", lambda data, size: hashed.append(len(data)) or gram_hashes(data, size))
    got = suffix_dedup.segments_of(texts)
    assert all(x.tolist() == y.tolist() for g, w in zip(got, want) for x, y in zip(g, w))
    assert len(hashed) <= 6 and max(hashed) <= suffix_dedup.TOGETHER


# --- decontamination

def test_contaminated(spark, texts):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(8, 40))) for i in range(12)] + [(50, "one two"), (51, "one"), (52, None), (53, "  "), (3, "short other text with six words")]
    docs = texts + [(500 + i, "before it " + t.upper().replace("Ü", "ü") + " after") for i, (_, t) in enumerate(items[:12])]
    docs += [(600, " ".join(items[4][1].split()[2:])), (600, items[5][1]), (601, "ONE  two")]

    def shingles(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    want = set()
    for (d, t), (i, u) in itertools.product(docs, items):
        s, q = shingles(t), shingles(u)
        if q and len(s & q) * 5 >= len(q) * 4:
            want.add((str(d), i, len(q), len(s & q)))
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.contaminated(clashing(frame(spark, docs)), df).collect()
    assert {(str(r.doc_id), r.item_id, r.n_shingles, r.n_shared) for r in got} == want
    assert decontaminate.contaminated(frame(spark, docs), df.limit(0)).count() == 0


def test_contaminated_search_by_sketch(spark):
    """Only a hash of an item's sketch makes a document a candidate, and only with room for enough shingles; two
    texts of one item, of equal size, are counted by themselves."""
    words = [f"w{i}" for i in range(44)]
    one, two = " ".join(words[:14]), " ".join(words[30:])
    items = spark.createDataFrame([(7, one), (7, two)], "item_id long, text string")
    index = decontaminate.item_shingles(items, "item_id", "text", 5)
    row = index.where(F.array_contains("shingles", F.lit(" ".join(words[:5]).encode()))).first()
    assert (row.n, row.k) == (10, decontaminate.sketch_size(10)) and row.hashes == sorted(row.hashes)
    docs = [(1, 10, row.hashes[:1]), (2, 10, row.hashes[row.k:]), (3, 7, row.hashes), (None, 8, row.hashes)]
    found = spark.createDataFrame([(i, 0, m, h) for i, m, h in docs], "id long, text_hash long, m int, probes array<bigint>")
    got = [(r.id, r.item_id, r.item_hash) for r in decontaminate.search(found, index).collect()]
    assert sorted(got, key=str) == [(1, 7, row.item_hash), (None, 7, row.item_hash)]
    # Five shingles of each text: ten of ten together, but half of either.
    docs = frame(spark, [(1, " ".join(words[:9] + words[30:39])), (2, "x " + two)])
    assert [(r.doc_id, r.n_shared) for r in decontaminate.contaminated(docs, items).collect()] == [(2, 10)]


def test_sketches_miss_nothing():
    """Every size up to 300: a document that misses a fifth of the shingles still has one of the sketch."""
    for n in range(1, 300):
        assert decontaminate.sketch_size(n) >= n - math.ceil(0.8 * n - 1e-9) + 1


# --- language ID

def test_language_id_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).collect()
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(spark, texts):
    docs = frame(spark, texts)
    got = langid.identify(clashing(docs).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 5 > 0, "fr")))
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and (r.lang_pred in ("en", "fr", "und")) and (r.doc_id is not None or r.held_out)
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_ngrams_ignore_block_ends(monkeypatch):
    text = "Le chat, est SUR la table 12 où il dort " * 20
    whole = langid.ngram_counts(text)
    assert langid.ngram_counts("123 !?") is None and langid.ngram_counts(None) is None
    assert whole.sum() > 0 and (langid.ngram_counts(text.upper()) == whole).all()
    for size in (1, 7, 50):
        monkeypatch.setattr(langid, "BLOCK", size)
        assert (langid.ngram_counts(text) == whole).all()


# --- language model

@pytest.mark.parametrize("top", [30, 1 << 17])
def test_lm_base_score(spark, texts, top, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP_WORDS", top)
    tokens = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in texts]
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for d, ws in tokens)
    got = maxent_lm.score(clashing(frame(spark, texts))).collect()
    assert sorted((str(r.doc_id), *r[1:5], round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_lm_learns_context(spark):
    """Words that follow each other score better than by counts alone, on rows that were held out."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        x = rng.choice("abc")
        rows.append((i, " ".join(f"{x}{'xyz'[j % 3]}{'en' if x == 'a' else 'os'}" for j in range(60))))
    got = [r for r in maxent_lm.score(frame(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


@pytest.fixture(scope="module")
def lm(spark):
    """A small corpus, its vocabulary and model."""
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 40)) if i % 9 else prose(rng, 30) + " rare" + str(i)) for i in range(300)]
    learn = frame(spark, rows).select("text")
    counts, follow = maxent_lm.count_words(learn)
    voc = maxent_lm.vocabulary(counts, follow)
    return rows, learn, voc, maxent_lm.train(learn, voc)


def brute_rows(history, cls, bits):
    """Rows of the table for one token: history has the hashes of the three words before, nearest first."""
    mask = (1 << 64) - 1
    p1, p2, p3 = history
    keys = [p1 + 1, p1 * 31 + p2 * 0xC2B2AE3D + 2, p2 + (3 << 40), p3 + (5 << 40)]
    one = (1 << bits) + 24 * (1 << bits - 4)
    out = []
    for j, k in enumerate(keys):
        h = (k & mask) * 0x9E3779B97F4A7C15 & mask
        out.append(j * one + ((h >> 64 - bits) if cls is None else (1 << bits) + (cls << bits - 4) + (h >> 64 - bits + 4)))
    return out


def brute_tokens(text, voc):
    """(history, class, outcome in it or None) of every token."""
    words = text.encode().lower().split() + [b"\n"]
    hashes = [0x5EED + 3, 0x5EED + 2, 0x5EED + 1]
    for i, w in enumerate(words):
        before = [xxhash.xxh32_intdigest(words[i - k]) if i >= k else 0x5EED + k for k in (1, 2, 3)]
        cls, member = voc.place.get(w) or (int(voc.shared[maxent_lm.ending(w)]), 0)
        yield w, before, cls, (member if cls >= 40 else None)


def brute_probability(model, history, cls, member):
    out = 0.0
    for kind, row_class, choice in [(0, None, cls)] + ([(cls - 39, cls - 40, member)] if member is not None else []):
        s = np.log(model.vocabulary.prior[kind])
        for r in brute_rows(history, row_class, model.bits):
            s = s + model.size[model.place[r]] * model.steps[r]
        out += s[choice] - np.log(np.exp(s - s.max()).sum()) - s.max()
    return out


def test_lm_feature_counts_and_weights_against_brute_force(spark, lm):
    rows, learn, voc, model = lm
    want = collections.Counter()
    for _, t in rows:
        for _, before, cls, member in brute_tokens(t, voc):
            want.update((r, cls) for r in brute_rows(before, None, model.bits))
            if member is not None:
                want.update((r, member) for r in brute_rows(before, cls - 40, model.bits))
    got = maxent_lm.feature_counts(learn, voc, model.bits)
    assert {(r, o): got[r, o] for r, o in zip(*np.nonzero(got))} == want
    assert np.allclose(maxent_lm.Model(voc, model.bits, got, model.size).steps, model.steps)
    kinds, _ = maxent_lm.row_kinds(model.bits)
    (r, o), n = want.most_common(1)[0]
    prior = voc.prior[kinds[r], o]
    assert math.isclose(model.steps[r, o], math.log((n + 4 * prior) / ((got[r].sum() + 4) * prior)), rel_tol=1e-4)


def test_lm_endings_of_words_by_their_last_bytes():
    words = [b"", maxent_lm.END, b"a", b".", b"ab.", b"abc", b"abcd", b"xabc,", b"xab.,", b"xa.,;", b"word....", b"longword!!!!!!!!!", b"o.k.", "ni\u00f1o?".encode()] * 2
    codes = maxent_lm._Endings()
    assert codes.of(words) == [maxent_lm.ending(w) for w in words]
    assert all(len(w) <= 4 for w in codes)


def test_lm_feature_counts_in_several_tables(spark, lm, monkeypatch):
    _, learn, voc, _ = lm
    want = maxent_lm.feature_counts(learn, voc, 10)
    monkeypatch.setattr(maxent_lm, "BATCH", 50)
    monkeypatch.setattr(maxent_lm, "COUNTED", 120)
    monkeypatch.setattr(maxent_lm, "MOST_COUNTED", 400)
    assert want.sum() > 0 and (maxent_lm.feature_counts(learn, voc, 10) == want).all()


def test_lm_scores_against_brute_force(spark, lm):
    """Probabilities of held-out texts, token by token; those of all words and an unknown one sum to one at most."""
    rows, learn, voc, model = lm
    scorer = model.scorer()
    layout = maxent_lm._Layout()
    texts = ["the zebra of a zebra", "", "unseen WORDS rain, niño the of 7", "été"]
    for i, c, context, _ in maxent_lm._pieces(iter(texts), maxent_lm._Codes(voc)):
        layout.add(i, c, context)
    d = layout.decisions(model.bits)
    got = np.bincount(np.concatenate(layout.doc)[d.token], scorer(d), minlength=len(texts))
    want = [sum(brute_probability(model, h, c, m) for _, h, c, m in brute_tokens(t, voc)) for t in texts]
    assert np.allclose(got, want, atol=1e-3)
    counts = collections.Counter(w for _, t in rows for w, *_ in brute_tokens(t, voc))
    history = [xxhash.xxh32_intdigest(w) for w in (b"the", b"of", b"rain,")]
    total, rest = 0.0, collections.defaultdict(float)
    for w, c in counts.items():
        cls, member = voc.place.get(w) or (int(voc.shared[maxent_lm.ending(w)]), 0)
        if cls >= 40 and member == 0:
            rest[cls] += c + 0.1
        else:
            total += math.exp(brute_probability(model, history, cls, member if cls >= 40 else None))
    for cls in rest:
        total += math.exp(brute_probability(model, history, cls, 0))
    assert 0.9 < total < 1 + 1e-6


def test_lm_slopes_are_those_of_the_likelihood(lm):
    _, _, voc, model = lm
    layout = maxent_lm._Layout()
    for i, c, context, _ in maxent_lm._pieces(iter(["the of a zebra", "of the rain, zebra niño"]), maxent_lm._Codes(voc)):
        layout.add(i, c, context)
    d = layout.decisions(model.bits)
    small = maxent_lm.Model(voc, model.bits, np.exp(model.steps).astype(int) % 7, model.size.copy())
    grad, curve, value = small.slopes(d)
    assert math.isclose(value, small.scorer()(d).sum(), rel_tol=1e-5)
    curve = curve.reshape(len(grad), len(grad))
    for at in np.argsort(-np.abs(grad))[:3]:
        ends = []
        for e in (0.01, -0.01):
            other = maxent_lm.Model(voc, model.bits, np.exp(model.steps).astype(int) % 7, model.size.copy())
            other.size[at] += e
            ends.append(other.slopes(d))
        assert math.isclose((ends[0][2] - ends[1][2]) / 0.02, grad[at], rel_tol=0.02, abs_tol=1e-3)
        assert math.isclose((ends[1][0][at] - ends[0][0][at]) / 0.02, curve[at, at], rel_tol=0.02, abs_tol=1e-3)


def test_lm_fits_steps_and_their_sizes_on_all_training_texts(spark, lm, monkeypatch):
    _, learn, voc, model = lm
    counted, fitted = [], []
    feature_counts, newton_round = maxent_lm.feature_counts, maxent_lm.newton_round

    def texts_of(df):
        return [r.text for r in df.select("text").collect()]

    monkeypatch.setattr(maxent_lm, "feature_counts", lambda docs, *a: counted.extend(texts_of(docs)) or feature_counts(docs, *a))
    monkeypatch.setattr(maxent_lm, "newton_round", lambda docs, m: fitted.extend(texts_of(docs)) or newton_round(docs, m))
    again = maxent_lm.train(learn, voc)
    assert sorted(counted) == sorted(fitted) == sorted(texts_of(learn))
    assert np.allclose(again.size, model.size, atol=1e-6) and np.ptp(again.size) > 0.01


def test_lm_slopes_with_each_decision_left_out(lm):
    rows, _, voc, model = lm
    layout = maxent_lm._Layout()
    for i, c, context, _ in maxent_lm._pieces(iter([t for _, t in rows[:3]]), maxent_lm._Codes(voc)):
        layout.add(i, c, context)
    d = layout.decisions(model.bits)
    counts = np.zeros(model.steps.shape)
    for r in d.rows:
        np.add.at(counts, (r, d.out), 1)
    small = maxent_lm.Model(voc, model.bits, counts, model.size.copy())
    grad, outer, likelihood = small.slopes_left_out(d, small.weights())
    want, value, squares = np.zeros(len(grad)), 0.0, np.zeros((len(grad), len(grad)))
    for at in range(len(d.out)):
        steps = small.steps[d.rows[:, at]].astype(float)
        prior = voc.prior[d.kind[at], d.out[at]]
        for j, r in enumerate(d.rows[:, at]):
            steps[j, d.out[at]] = np.log((counts[r, d.out[at]] - 1 + 4 * prior) / ((counts[r].sum() + 4) * prior)).clip(-12, 12)
        place = small.place[d.rows[:, at]]
        s = np.log(voc.prior[d.kind[at]]) + small.size[place] @ steps
        p = np.exp(s - s.max())
        p /= p.sum()
        slope = steps[:, d.out[at]] - steps @ p
        np.add.at(want, place, slope)
        np.add.at(squares, (place[:, None], place[None]), np.outer(slope, slope))
        value += np.log(p[d.out[at]])
    assert np.allclose(grad, want, rtol=1e-3, atol=1e-2) and np.allclose(outer.reshape(squares.shape), squares, rtol=1e-2, atol=0.1)
    assert math.isclose(likelihood, value, rel_tol=1e-4)


def test_lm_packed_texts_are_laid_out_as_texts(lm, monkeypatch):
    """Words in the vocabulary and others, in pieces of any size."""
    rows, _, voc, model = lm
    small = maxent_lm.replace(voc, top={w: i for w, i in voc.top.items() if i < 20}, logp=voc.logp[:20])
    texts = [t for _, t in rows[:40]] + [""]
    want, packed = maxent_lm._Layout(), []
    for i, c, context, _ in maxent_lm._pieces(iter(texts), maxent_lm._Codes(small)):
        want.add(i, c, context)
        packed.append(maxent_lm._packed(c))
    want, docs = want.decisions(10), np.concatenate(want.doc)
    b = pa.RecordBatch.from_arrays([pa.array([x[j] for x in packed], pa.binary()) for j in range(2)], names=["code", "kind"])
    for size in (1, 2, 7, 100, 1 << 16):
        got = [(now.decisions(10), np.concatenate(now.doc)) for now in maxent_lm._unpacked(b, small.slim().codes, size)]
        assert np.concatenate([x for _, x in got]).tolist() == docs.tolist()
        def flat(d, doc):
            return sorted(zip(doc[d.token].tolist(), d.kind.tolist(), d.out.tolist(), *d.rows.tolist()))
        assert sorted(x for g in got for x in flat(*g)) == flat(want, docs)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_lm_words_are_numbered_as_they_are_split(texts, size):
    column = pa.array([None, *[t for _, t in texts], "", "A\x0bb\x1cC\u00a0d\x85 \0e", "x" * 300, "long " * 90 + "É" * 200, "f", "g", ""])
    for part in (column, column.slice(2, len(column) - 3), column.slice(0, 1), column.slice(0, 0)):
        got: list[list[bytes]] = [[]]
        for piece in maxent_lm._numbered(part, size):
            assert len(set(piece.distinct.to_pylist())) == len(piece.distinct)
            words, at = piece.distinct.take(pa.array(piece.index)).to_pylist(), 0
            for end in piece.ends.tolist():
                got[-1] += words[at:end]
                got.append([])
                at = end
            got[-1] += words[at:]
        assert got == [[w for ws in simhash_dedup.word_blocks(t or "") for w in ws] for t in part.to_pylist()] + [[]]


def test_lm_codes_of_a_column_of_words(lm):
    _, _, voc, _ = lm
    small = maxent_lm.replace(voc, top={w: i for w, i in voc.top.items() if i < 60})
    words = [b"", maxent_lm.END, b".", b"ab.", b"xabc,", b"xa.,;", b"word....", b"\0a", b"\0\0", b"longword!!!!!!!!!", "ni\u00f1o?".encode(), *voc.top]
    column = pa.array([b"before", *words], pa.binary())[1:]
    assert maxent_lm._Endings().of_array(column).tolist() == [maxent_lm.ending(w) for w in words]
    codes = maxent_lm._Codes(small)
    got = codes.of_array(column, pa.array(small.top, pa.binary()), small.slim().codes)
    assert got.tolist() == [maxent_lm._Codes(small)[w] for w in words] and not codes


def test_lm_odds_are_products_of_the_rows(lm):
    """Without an exponential for each outcome of a decision."""
    _, _, voc, model = lm
    weights = model.weights()
    odds, per = model.odds(weights), len(weights) // maxent_lm.FEATURES
    for at, kind in ((0, 0), (1 << model.bits, 1), (per - 1, maxent_lm.SHARED)):
        assert np.allclose(odds[at], voc.prior[kind] * np.exp(weights[at]), rtol=1e-5)
        assert np.allclose(odds[at + per], np.exp(weights[at + per]), rtol=1e-5)
    assert np.isfinite(odds).all()


def test_lm_does_not_depend_on_tasks_or_blocks(spark, texts, monkeypatch):
    rows = texts + [(400 + i, prose(random.Random(i), 60)) for i in range(60)]

    def scores(parts):
        return sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in maxent_lm.score(frame(spark, rows, parts)).collect())

    want = scores(1)
    assert scores(16) == want
    monkeypatch.setattr(simhash_dedup, "_BLOCK", 64)                                # of a text: the context goes on over its ends
    codes = maxent_lm._Codes(maxent_lm.Vocabulary(1, 1, {}, np.zeros(1), {}, np.full(256, 40), np.ones((25, 64))))
    pieces = list(maxent_lm._pieces(iter([prose(random.Random(1), 100)]), codes))
    assert len(pieces) > 3 and [context for _, _, context, _ in pieces] == [0] + [3] * (len(pieces) - 1)
    assert all((b[:3] == a[-3:]).all() for (_, a, _, _), (_, b, _, _) in zip(pieces, pieces[1:]))


# --- fingerprints

def brute_fingerprint(text):
    words = (text or "").lower().replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", words) if x]
    votes = [0] * 64
    for i, x in enumerate(w):
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        weight = len(x)
        if i + 1 < len(w):
            h = xxhash.xxh64_intdigest(w[i + 1].encode(), h)
            weight += len(w[i + 1])
        for b in range(64):
            votes[b] += min(weight, 32) * (1 if h >> b & 1 else -1)
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_edited_fingerprints(spark, texts):
    rows = [(d, (t or "").replace("\u0130", "i")) for d, t in texts]        # lower-casing of this letter differs
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    nulls = {t for d, t in rows if d is None}
    got = fingerprints.edited_fingerprints(clashing(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    firsts = {t for d, t in ordered if d is None} or {ordered[0][1]}
    for k, (d, t) in enumerate(ordered):
        if d is None:
            continue
        cut = len(t) // 4
        same = [j for j, (i, _) in enumerate(ordered) if i == d]         # repeated rows follow each other
        nexts = set().union(*({ordered[j + 1][1]} if j + 1 < len(ordered) else firsts for j in same))
        edits = {t[:len(t) - cut] + nx[:cut]: nx for nx in nexts}
        shas = {hashlib.sha256(e.encode()).hexdigest(): e for e in edits}
        r = by_id[d]
        assert r.n_chars == len(t) and r.edited_sha256 in shas, d
        e = shas[r.edited_sha256]
        f, g = brute_fingerprint(t), brute_fingerprint(e)
        assert (r.fingerprint, r.edited_fingerprint) == (f"{f:016x}", f"{g:016x}")
        assert r.near_edited == 1 - (f ^ g).bit_count() / 64
        assert r.near_next in {1 - (f ^ brute_fingerprint(n)).bit_count() / 64 for n in nexts}
    assert nulls


@pytest.mark.parametrize("rows", [[(5, "only one row here")], [(1, "a b c d"), (10**17, "c d e f g h"), (-4, None)]])
def test_edited_fingerprints_few_rows(spark, rows):
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(frame(spark, rows, 1)).collect()}
    ordered = sorted(rows)
    for (d, t), (_, nx) in zip(ordered, ordered[1:] + ordered[:1]):
        t, nx = t or "", nx or ""
        cut = len(t) // 4
        assert got[d].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + nx[:cut]).encode()).hexdigest()


def test_range_buckets_do_not_change_neighbours(spark, texts, monkeypatch):
    rows = [(d, t) for d, t in texts if d is not None]
    want = sorted(map(tuple, fingerprints.edited_fingerprints(frame(spark, rows)).collect()))
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 1)
    monkeypatch.setattr(fingerprints, "OUTER_BUCKETS", 4)
    assert sorted(map(tuple, fingerprints.edited_fingerprints(frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_block_tables_find_all(spark, radius):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for f in fps]
    sign = lambda f: f - (1 << 64 if f >> 63 else 0)
    index = spark.createDataFrame([(sign(f),) for f in fps] + [(None,)], "fingerprint long")
    got = {(r.query_fp, r.fp, r.distance) for r in fingerprints.within_radius(index.limit(30), index, radius).collect()}
    queries = {r.fingerprint for r in index.limit(30).collect()}
    want = {(q, sign(f), ((q ^ sign(f)) & (1 << 64) - 1).bit_count()) for q in queries if q is not None for f in fps}
    assert got == {x for x in want if x[2] <= radius}


def test_neighbours_are_counted(spark):
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(30)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps] + fps[:5]
    prints = spark.createDataFrame([(i if i != 7 else None, f"{f:016x}") for i, f in enumerate(fps)], "doc_id long, fingerprint string")
    got = fingerprints.count_neighbours(prints, F.col("doc_id") % 4 == 0, 3).collect()
    assert len(got) == len(fps)
    for r in got:
        near = sum((int(r.fingerprint, 16) ^ f).bit_count() <= 3 for f in set(fps))
        assert r.n_within == (near if r.doc_id is not None and r.doc_id % 4 == 0 else None)


# --- empty tables

@pytest.mark.parametrize("run", [
    simhash_dedup.near_duplicates, simhash_dedup.keep_one, suffix_dedup.removal_digests, langid.identify, maxent_lm.score,
    fingerprints.edited_fingerprints, lambda d: bpe.round_trip(d, tokenizer_path()), lambda d: bpe.encode(d, tokenizer_path()),
    lambda d: decontaminate.contaminated(d, d.withColumn("item_id", F.lit(1)))])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
