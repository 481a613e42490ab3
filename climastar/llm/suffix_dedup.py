"""Exact removal of repeated passages by suffix arrays.

A window is a run of ``length`` bytes; it is repeated if it also starts somewhere else.
Windows are routed so that equal ones meet in one shard: each window's key is the least
hash of the 32-byte strings inside it, and a maximal run of windows with one key is a
segment.  Only segments whose key occurs elsewhere leave their document, as their bytes.
A shard is a megabyte or two of segments, whole keys at a time; its suffix array
is refined as Larsson and Sadakane do (only groups not yet sorted, by the rank ``h`` symbols on,
``h`` doubling) up to the length of a window: places that then are in one group have the same window.

A segment that two places have is repeated from end to end: its places become spans as they
stream by, and a shard holds the distinct bytes and one place of each.  A key with very many segments, or long ones,
is cut into sub-shards.  Each sends its distinct windows' digests,
sorted and cut into ranges, and each range is merged by binary search, so no
task sees a whole hot key.  Equal segments are collapsed before the shuffle and again in the
shard; documents with equal texts are compared once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import quoted, staged

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1 << 20
#: Segments of one key in a (sub-)shard, about.
KEY_SEGMENTS = 500
SALTS = 8
BLOCK = 1 << 20
#: Texts cut at a time,
ROWS = 2048
#: and bytes of theirs laid end to end.
TOGETHER = 1 << 16
#: Places of repeated segments in a batch of spans.
PLACES = 1 << 15
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]


# --- suffix arrays -----------------------------------------------------------------------------

def suffix_array(sym: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of an array of uint16 symbols.  With ``depth``, suffixes are only told apart by so many
    symbols: those that share them stay in any order, and have one rank, the place of the first."""
    n = len(sym)
    kind = np.int32 if n < 1 << 31 else np.int64                # half the memory
    if n == 0:
        return np.zeros(0, kind), np.zeros(0, kind)
    # So many symbols as fit into 63 bits, numbered as far as they occur; 0: past the end.
    there = np.bincount(sym) > 0
    dense = np.cumsum(there).astype(np.uint16)[sym]
    bits = int(there.sum()).bit_length()
    h = min(63 // bits, depth or n)
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= bits
        if j < n:
            key[:n - j] += dense[j:]
    del dense
    sa = np.argsort(key).astype(kind)
    key = key[sa]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    heads = np.flatnonzero(first).astype(kind)
    rank = np.empty(n, kind)
    rank[sa] = heads[np.cumsum(first, dtype=kind) - 1]
    sizes = np.diff(heads, append=kind(n))
    idx = np.flatnonzero(np.repeat(sizes > 1, sizes)).astype(kind)
    while len(idx) and (depth is None or h < depth):
        # The rank of the next h symbols; of those that end at the depth, in the last round.
        step = h if depth is None else min(h, depth - h)
        s = sa[idx]
        pair = s.astype(np.int64) + step
        pair = np.where(pair < n, rank[np.minimum(pair, n - 1)] + 1, 0).astype(np.int64)
        pair += rank[s] * np.int64(n + 1)
        order = np.argsort(pair)
        s, pair = s[order], pair[order]
        del order
        sa[idx] = s
        first = np.concatenate([[True], pair[1:] != pair[:-1]])
        del pair
        heads = np.flatnonzero(first)
        rank[s] = idx[heads][np.cumsum(first, dtype=kind) - 1]
        sizes = np.diff(np.append(heads, len(s)))
        idx = idx[np.repeat(sizes > 1, sizes)]
        h += step
    return sa, rank


def common_prefixes(sym: np.ndarray, sa: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """For each position, the length (at most ``most``) of the prefix that its suffix shares with
    the suffix before it in the whole array (``repeated_windows`` asks for one length only, and does without).

    Kasai's bound: the next position shares at least one symbol less.  Positions are taken in
    passes, at distance 64, then half of it, and so on; each starts from the bound
    that the known position to its left gives."""
    n = len(sym)
    before = np.where(rank > 0, sa[np.maximum(rank - 1, 0)], -1)
    pad = np.concatenate([sym, np.zeros(most + 4, sym.dtype)])
    out = np.zeros(n, np.int16 if most < 1 << 15 else np.int64)
    step = 64
    while True:
        # Positions at this distance that no pass has had, so many at a time.
        gap = step if step == 64 else 2 * step
        for lo in range(gap - step, n, PLACES * gap):
            _extend(out, np.arange(lo, min(n, lo + PLACES * gap), gap), step, before, pad, most)
        if step == 1:
            return out
        step //= 2


def _extend(out: np.ndarray, at: np.ndarray, step: int, before: np.ndarray, pad: np.ndarray, most: int) -> None:
    """Common prefixes of the positions ``at``, from the bounds that those known give."""
    n = len(out)
    have = np.maximum(out[at - at % (2 * step)] - at % (2 * step), 0) if step < 64 else np.zeros(len(at), np.int64)
    live = np.flatnonzero(before[at] >= 0)
    have[before[at] < 0] = 0
    while len(live):
        i, j, l = at[live], before[at[live]], have[live]
        room = np.minimum(most, n - np.maximum(i, j))
        same = (pad[np.minimum(i + l, n)] == pad[np.minimum(j + l, n)]) & (l < room)
        wide = same.copy()
        for k in range(1, 8):
            wide &= (pad[np.minimum(i + l + k, n + k)] == pad[np.minimum(j + l + k, n + k)])
        wide &= l + 8 <= room
        have[live] += np.where(wide, 8, same)
        live = live[same]
    out[at] = have


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, whether the window at each start occurs twice in the texts."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    sym = np.zeros(int(ends[-1]), np.uint16)
    body = np.ones(len(sym), bool)
    body[ends - 1] = False
    sym[body] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1     # 0 ends a text: no window holds it
    rank = suffix_array(sym, length)[1]
    hit = np.bincount(rank)[rank] > 1
    hit &= np.repeat(ends - 1, sizes) - np.arange(len(sym)) >= length
    return [hit[e - n:max(e - length, e - n)] for e, n in zip(ends.tolist(), sizes.tolist())]


# --- segments ----------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes (a multiple of 8) at each position."""
    n = len(data) - size + 1
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view(np.uint64).ravel()
    h = np.zeros(n, np.uint64)
    for j in range(size // 8):
        m = _MIX[j % 4]
        x = words[8 * j:8 * j + n] * m
        x ^= x >> np.uint64(29)
        h = (h + x) * m
    return h ^ (h >> np.uint64(32))


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, last start << 1 | whether the key's string is there twice) of the maximal runs of windows with one key."""
    return segments_of([text], length)[0]


def segments_of(texts: list[bytes], length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``segments`` of each text.  Texts are cut some at a time, laid end to end; very long ones in pieces of ``BLOCK`` windows."""
    out: list[list] = [[] for _ in texts]
    laid: list[tuple[int, int, bytes]] = []                      # text, place of the piece in it, piece
    size = 0

    def settle() -> None:
        counts = np.array([len(x) - length + 1 for _, _, x in laid])
        begins = np.cumsum([0, *(len(x) for _, _, x in laid[:-1])])
        data = np.frombuffer(laid[0][2] if len(laid) == 1 else b"".join(x for _, _, x in laid), np.uint8)
        key, first, last, twice = _runs(data, begins, counts, length)
        edges = np.append(np.searchsorted(first, begins), len(first)).tolist()
        for (i, at, _), begin, a, b in zip(laid, begins.tolist(), edges, edges[1:]):
            out[i].append((key[a:b].view(np.int64), first[a:b] - begin + at, (last[a:b] - begin + at) << 1 | twice[a:b]))

    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, BLOCK):
            piece = text if len(text) < BLOCK + length else text[at:at + BLOCK + length - 1]
            if laid and size + len(piece) > TOGETHER:
                settle()
                laid, size = [], 0
            laid.append((i, at, piece))
            size += len(piece)
    if laid:
        settle()
    return [tuple(np.concatenate(c) for c in zip(*x)) if x else (np.zeros(0, np.int64),) * 3 for x in out]


def _runs(data: np.ndarray, begins: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, last start, whether the key's string is there twice) of the maximal runs of windows with one key, among the
    ``counts`` windows from each of ``begins`` on: a run never leaves its text."""
    gram = min(GRAM, length // 8 * 8)
    w = length - gram + 1
    h = gram_hashes(data, gram)
    table, span = [h], 1
    while 2 * span <= w:
        table.append(np.minimum(table[-1][:-span], table[-1][span:]))
        span *= 2

    def least(a, b):                                             # minimum of h[a .. b], element-wise
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        res = np.empty(len(a), np.uint64)
        for k in np.unique(level):
            q = level == k
            res[q] = np.minimum(table[k][a[q]], table[k][b[q] - (1 << k) + 1])
        return res

    t = table[-1]
    low = np.minimum(t[:len(h) - w + 1], t[w - span:w - span + len(h) - w + 1])
    new = np.concatenate([[True], low[1:] != low[:-1]])
    new[begins] = True
    first = np.flatnonzero(new)
    stop = (begins + counts)[np.searchsorted(begins, first, side="right") - 1]
    first, last = first[first < stop], np.minimum(np.append(first[1:], len(low)), stop)[first < stop] - 1
    key = low[first]
    # The leftmost place of the key in the first window, by halving; then whether it comes again.
    p, stop = first.copy(), first + w - 1
    while (open_ := p < stop).any():
        a, b = p[open_], stop[open_]
        mid = (a + b) // 2
        here = least(a, mid) == key[open_]
        stop[open_] = np.where(here, mid, b)
        p[open_] = np.where(here, a, mid + 1)
    more = p + 1 <= last + w - 1
    twice = np.zeros(len(p), bool)
    if more.any():
        a, b = p[more] + 1, (last + w - 1)[more]
        far = b - a + 1 >= 2 * span                              # beyond the table: surely more than one place
        twice[more] = np.where(far, True, least(a, np.where(far, a, b)) == key[more])
    return key, first, last, twice


# --- Spark -------------------------------------------------------------------------------------

def text_digest(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _digests(ctx: bytes, starts: np.ndarray, length: int) -> list[bytes]:
    return [xxhash.xxh3_128_digest(ctx[s:s + length]) for s in starts.tolist()]


_SOLVED = "did long, lo long, hi long, key long, part int, windows binary"


def _solved(did, lo, hi, windows: dict[tuple[int, int, int], bytes] | None = None) -> pa.RecordBatch:
    n, windows = len(did), windows or {}
    m = len(windows)
    longs = [pa.concat_arrays([pa.array(np.asarray(x, np.int64)), pa.nulls(m, pa.int64())]) for x in (did, lo, hi)]
    return pa.RecordBatch.from_arrays(
        [*longs, pa.array([None] * n + [k[0] for k in windows], pa.int64()), pa.array([None] * n + [k[2] for k in windows], pa.int32()),
         pa.array([None] * n + list(windows.values()), pa.binary())],
        names=[x.split(" ")[0] for x in _SOLVED.split(", ")])


class _Segment:
    """Distinct bytes of one key: the first place that has them, and whether another one does."""

    __slots__ = ("salt", "cuts", "first", "many")

    def __init__(self, salt: int, cuts: int, first: bytes):
        self.salt, self.cuts, self.first, self.many = salt, cuts, first, False


def shard(found: dict[tuple[int, bytes], _Segment], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of the segments that one place has; windows of those whose key is cut."""
    did, lo, hi = [], [], []
    rows: dict[tuple[int, int, int], list] = {}
    for ((key, ctx), seg), hit in zip(found.items(), repeated_windows([k[1] for k in found], length)):
        d, at = np.frombuffer(seg.first, "<i8").tolist()
        if seg.many:
            hit = np.ones_like(hit)                              # its places' spans are out already
        else:
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
            did += [d] * (len(edge) // 2)
            lo += (edge[::2] + at).tolist()
            hi += (edge[1::2] + at + length - 1).tolist()
        if seg.cuts > 1:
            for s, g in enumerate(_digests(ctx, np.arange(len(hit)), length)):
                part = int.from_bytes(g[:4], "big") * seg.cuts >> 32
                # A window known to be repeated is only told to others; one that is not waits for them.
                rows.setdefault((key, seg.salt, part), []).append((g, -1 if hit[s] else d, at + s))
    yield _solved(did, lo, hi, {k: np.array(sorted(set(v)), dtype=[("g", "S16"), ("d", "<i8"), ("s", "<i8")]).tobytes()
                                for k, v in rows.items()})


def solve(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, salt, cuts, ctx, refs) sorted by key and salt, to rows of ``_SOLVED``.

    Of the places (text, start) of a segment only the first is held.  As soon as another one comes, the segment is repeated
    from end to end, and its places go out as spans while they stream by."""
    found: dict[tuple[int, bytes], _Segment] = {}
    out: list[tuple[bytes, int]] = []                            # 16 bytes a place, length of the segment
    size, held, last = 0, 0, None

    def spans() -> pa.RecordBatch:
        places = np.frombuffer(b"".join(p for p, _ in out), "<i8").reshape(-1, 2)
        n = np.repeat([n for _, n in out], [len(p) // 16 for p, _ in out])
        return _solved(places[:, 0], places[:, 1], places[:, 1] + n)

    for b in batches:
        for key, salt, cuts, ctx, refs in zip(*(b.column(i).to_pylist() for i in range(5))):
            if (key, salt) != last:
                if size >= SHARD_BYTES:
                    yield from shard(found, length)
                    found, size = {}, 0
                last = (key, salt)
            seg = found.get((key, ctx))
            if seg is None:
                seg = found[key, ctx] = _Segment(salt, cuts, refs[:16])
                size += len(ctx)
            if not seg.many:
                # Repeated rows bring the same place again.
                seg.many = refs != seg.first * (len(refs) // 16)
                if not seg.many:
                    continue
                out.append((seg.first, len(ctx)))
                held += 1
            for at in range(0, len(refs), 16 * PLACES):
                out.append((refs[at:at + 16 * PLACES], len(ctx)))
                held += len(out[-1][0]) // 16
                if held >= PLACES:
                    yield spans()
                    out, held = [], 0
    if out:
        yield spans()
    if found:
        yield from shard(found, length)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row (id, digest, copies, spans) per distinct text: ``id`` is the least of its ids,
    ``spans`` (array<struct<lo bigint, hi bigint>>) cover all windows of it that other distinct
    texts, or other places of it, have too.  With copies > 1 the whole text is repeated if it has a window."""
    if length < 2 * 8:
        raise ValueError("length must be 16 or more")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("digest", text_digest(F.col("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            found = segments_of([t.as_py() for t in b.column("text")], length)
            # 16 bytes a segment; a segment has at most BLOCK windows
            found = [(k.astype("<i8"), lo.astype("<i4"), (((hi >> 1) - lo) << 1 | hi & 1).astype("<i4")) for k, lo, hi in found]
            packed = [pa.array([x[i].tobytes() for x in found], pa.binary()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), *packed], names=["id", "digest", "key", "lo", "more"])

    id_type = rows.schema["id"].dataType.simpleString()
    all_rows = rows.select("id", "digest", "text").mapInArrow(
        cut, f"id {id_type}, digest binary, key binary, lo binary, more binary")
    texts = staged(all_rows.groupBy("digest").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("key", "lo", "more")])
        .withColumn("did", F.monotonically_increasing_id()), "suffix-texts")    # a label, fixed by the written table

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[np.frombuffer(x, kind) for x in b.column(c).to_pylist()] for c, kind in (("key", "<i8"), ("lo", "<i4"), ("more", "<i4"))]
            for at in range(0, len(cols[0]), 500):
                key, lo, more = (np.concatenate(c[at:at + 500]).astype(np.int64) for c in cols)
                did = np.repeat(b.column("did").slice(at, 500).to_numpy(), [len(x) for x in cols[0][at:at + 500]])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (did, key, lo, lo + (more >> 1), (more & 1) + 1)],
                                                 names=["did", "key", "lo", "hi", "n"])

    segs = texts.select("did", "key", "lo", "more").mapInArrow(spread, "did long, key long, lo long, hi long, n long")
    # Bytes count with repetitions, so cuts are small enough.
    by_count, by_bytes = F.ceil(F.col("n") / KEY_SEGMENTS), F.ceil(F.col("bytes") / SHARD_BYTES)
    counts = segs.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("hi") - F.col("lo") + length).alias("bytes")).where("n > 1").select(
        F.col("key").alias("k"), F.greatest(by_count, by_bytes).cast("int").alias("cuts"),
        F.explode(F.array(*map(F.lit, range(SALTS)))).alias("j"))
    again = (segs.withColumn("i", F.pmod(F.xxhash64("did", "lo"), F.lit(SALTS)).cast("int"))
             .join(counts, (F.col("key") == F.col("k")) & (F.col("i") == F.col("j"))))
    wanted = (again.groupBy("did").agg(F.collect_list(F.struct("key", "lo", "hi", "cuts")).alias("wanted"))
              .join(texts.select("did", F.col("id").alias("rep"), F.col("digest").alias("d")), "did"))
    wanted = staged(wanted, "suffix-wanted")
    sources = rows.join(wanted.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("rep")) & (F.col("digest") == F.col("d")))

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments' bytes with the (text, start) pairs that have them; equal ones of a batch once."""
        def out(found: dict) -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([xxhash.xxh32_intdigest(k[1]) % found[k][0] for k in keys], pa.int32()),
                 pa.array([found[k][0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array([np.array(found[k][1], "<i8").tobytes() for k in keys], pa.binary())],
                names=["key", "salt", "cuts", "ctx", "refs"])
        for b in batches:
            found: dict[tuple[int, bytes], tuple[int, list]] = {}
            size = 0
            for text, did, want in zip(b.column("text"), b.column("did").to_pylist(), b.column("wanted")):
                data = text.as_py()
                for w in want.as_py():
                    for lo in range(w["lo"], w["hi"] + 1, BLOCK):       # very long runs in pieces
                        ctx = data[lo:min(lo + BLOCK - 1, w["hi"]) + length]
                        found.setdefault((w["key"], ctx), (w["cuts"], []))[1].extend((did, lo))
                        size += len(ctx)
                if size > 8 << 20:
                    yield out(found)
                    found, size = {}, 0
            if found:
                yield out(found)

    shipped = (sources.select("did", "text", "wanted").mapInArrow(ship, "key long, salt int, cuts int, ctx binary, refs binary")
               .repartition("key", "salt").sortWithinPartitions("key", "salt"))

    solved = staged(shipped.mapInArrow(lambda batches: solve(batches, length), _SOLVED), "suffix-spans")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of several sub-shards in one range of one key; a sorted run is searched for in the runs before it."""
        kind = np.dtype([("g", "S16"), ("d", "<i8"), ("s", "<i8")])
        def settle(runs: list[np.ndarray]) -> pa.RecordBatch:
            all_ = runs[0]
            seen = [np.zeros(0, "S16")]
            for new in runs[1:]:
                at = np.searchsorted(all_["g"], new["g"])
                same = (at < len(all_)) & (all_["g"][np.minimum(at, len(all_) - 1)] == new["g"])
                seen.append(new["g"][same])
                all_ = np.insert(all_, np.searchsorted(all_["g"], new["g"]), new)
            known = np.unique(np.concatenate(seen))
            at = np.searchsorted(known, all_["g"])
            hit = all_[(at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0))] == all_["g"])] if len(known) else all_[:0]
            hit = hit[hit["d"] >= 0]
            return pa.RecordBatch.from_arrays([pa.array(hit["d"]), pa.array(hit["s"]), pa.array(hit["s"] + length)],
                                              names=["did", "lo", "hi"])
        runs, last = [], None
        for b in batches:
            for key, part, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (key, part) != last:
                    if len(runs) > 1:
                        yield settle(runs)
                    runs, last = [], (key, part)
                runs.append(np.frombuffer(raw, kind))
        if len(runs) > 1:
            yield settle(runs)

    merged = (solved.where("key is not null").select("key", "part", "windows").repartition("key", "part")
              .sortWithinPartitions("key", "part").mapInArrow(merge, "did long, lo long, hi long"))
    spans = (solved.where("did is not null").select("did", "lo", "hi").union(merged)
             .groupBy("did").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    return texts.select("did", "id", "digest", "copies").join(spans, "did", "left").select("id", "digest", "copies", "spans")


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   as_text: bool = False, drop_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (with ``drop_text`` all but the text, which then is shuffled once) and ``__kept`` (binary, the bytes left), ``__n_bytes``, ``__n_removed``, ``__n_spans``.
    With ``as_text``, ``__kept`` is a string, without the bytes of characters that lost some of theirs.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the same
    row or another, is removed; strings are judged on the input.  NULL texts are empty.  Repeated
    rows are copies of each other, and lose everything if they are long enough.  Texts
    shorter than ``length`` stay.  An empty table gives an empty result."""
    spans = repeated_spans(docs, id_col, text_col, length).select(
        F.col("id").alias("__rep"), F.col("digest").alias("__d"), F.col("copies").alias("__copies"), F.col("spans").alias("__spans"))
    kept_fields = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    names = [f.name for f in kept_fields]
    rows = docs.select(*[F.col(quoted(c)) for c in names], F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))
    rows = rows.withColumn("__digest", text_digest(F.col("__text")))
    joined = rows.join(spans.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("__rep")) & (F.col("__digest") == F.col("__d")), "left")
    # Rows without a partner are copies of another row's text.
    joined = joined.withColumn("__whole", F.coalesce(F.col("__copies") > 1, F.lit(True))).drop("__rep", "__d", "__digest", "__copies")
    schema = StructType([*kept_fields, StructField("__kept", StringType() if as_text else BinaryType()),
                         *(StructField(c, LongType()) for c in ("__n_bytes", "__n_removed", "__n_spans"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            kept, total, removed, count = [], [], [], []
            for text, spans_, whole in zip(b.column("__text"), b.column("__spans"), b.column("__whole").to_pylist()):
                data = text.as_py()
                n = len(data)
                runs = ([(0, n)] if n >= length else []) if whole else merged_spans(spans_.as_py())
                at, parts = 0, []
                for lo, hi in runs:
                    parts.append(data[at:lo])
                    at = hi
                parts.append(data[at:])
                kept.append(b"".join(parts))
                total.append(n)
                removed.append(n - len(kept[-1]))
                count.append(len(runs))
            if as_text:
                left = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            else:
                left = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), left,
                                              *(pa.array(x, pa.int64()) for x in (total, removed, count))],
                                             names=[*names, "__kept", "__n_bytes", "__n_removed", "__n_spans"])

    return joined.mapInArrow(run, schema)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row; see ``remove_repeats``."""
    found = remove_repeats(docs.select(id_col, text_col), id_col, text_col, length, drop_text=True)
    return found.select(id_col, F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"),
                        F.col("__n_spans").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))
