"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by their number n of distinct shingles (powers of two).  An item's sketch is
its bottom-k MinHash: its k least shingle hashes, k being what the partition's largest size u
needs, u - ceil(t u) + 1.  A document that holds a share t of an item's shingles misses fewer than k
of them, so it holds at least one of the sketch, however long it is: the search, an equi-join of
documents' hashes with the sketches alone, finds every such document.  A candidate pair is
verified by counting the item's shingles that the document holds, as strings; no other pair is counted.

Documents' shingles are first tested against blocked Bloom filters of the items' shingles and of
their sketches; a document without a hit in the second leaves nothing.  The filters have a fixed greatest size; when
more items come, more passes them, and search and verification still decide alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .simhash_dedup import word_blocks

SHINGLE = 5
THRESHOLD = (4, 5)           # 0.8, as a fraction
FILTER_BLOCKS = 16_384       # of 64 bytes: 1 MB
SALTS = 8


def shingle_blocks(text: str | None, size: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of a text in blocks and a 64-bit hash for the run of ``size`` words that begins at each place;
    the whole sequence, as one run, if it is shorter."""
    last: list[bytes] = []
    found = False
    mult = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(size)]

    def runs(words: list[bytes], n: int) -> np.ndarray:
        h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        out = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            out += h[i:i + len(out)] * mult[i]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))

    for words in word_blocks(text or ""):
        words = last + words
        if len(words) >= size:
            found = True
            yield words, runs(words, size)
            last = words[len(words) - size + 1:] if size > 1 else []
        else:
            last = words
    if last and not found:
        yield last, runs(last, len(last))


def sketch_size(n: int) -> int:
    """Length of the sketches in the size partition of items with n shingles."""
    u = (1 << n.bit_length()) - 1
    return u - -(-u * THRESHOLD[0] // THRESHOLD[1]) + 1


_ITEM = "item_id long, item_hash long, n int, k int, hashes array<bigint>, shingles array<binary>"


def item_shingles(items: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """One row per distinct (id, text): its distinct shingles by hash, the first k of which are its sketch; items without words have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, key, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                seen: dict[bytes, int] = {}
                for words, h in shingle_blocks(text, shingle):
                    k = min(shingle, len(words))
                    seen.update((b" ".join(words[i:i + k]), x) for i, x in enumerate(h.view(np.int64).tolist()))
                if seen:
                    by_hash = sorted(seen, key=lambda s: (seen[s], s))
                    rows.append((item, key, len(seen), sketch_size(len(seen)), [seen[s] for s in by_hash], by_hash))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)],
                                             names=[x.split(" ")[0] for x in _ITEM.split(", ")])

    texts = items.select(F.col(id_col).cast("long").alias("item_id"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("item_hash"), F.col(text_col).alias("text"))
    return texts.distinct().mapInArrow(run, _ITEM)


def _filter(hashes: DataFrame) -> np.ndarray:
    """Blocked Bloom filter of column ``h``, FILTER_BLOCKS x 8 words of 64 bits."""
    words = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {6 * i}) & 63 as int))")).alias(f"w{i}") for i in range(8)]
    out = np.zeros((FILTER_BLOCKS, 8), np.int64)
    block = F.pmod(F.shiftrightunsigned("h", 48), F.lit(FILTER_BLOCKS)).alias("block")
    for r in hashes.groupBy(block).agg(*words).collect():              # at most FILTER_BLOCKS rows
        out[r.block] = r[1:]
    return out.view(np.uint64)


def passes(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that may be in the filter."""
    at = np.arange(len(h))
    for i in range(8):
        x = h[at]
        bit = np.uint64(1) << ((x >> np.uint64(6 * i)) & np.uint64(63))
        at = at[(bloom[(x >> np.uint64(48)) % np.uint64(len(bloom)), i] & bit) != 0]
    return at


def search(found: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct candidates (id, text_hash, item_id, item_hash): documents of ``found`` (id, text_hash, m, probes)
    with a hash of an item's sketch among their ``probes`` and, by their number m of shingles, room for 0.8 of the item's."""
    # A passage that very many documents hold: its hashes are spread over salts.
    probes = found.select("id", "text_hash", "m", F.explode("probes").alias("h"),
                          F.pmod(F.xxhash64("id", "text_hash"), F.lit(SALTS)).cast("int").alias("salt"))
    sketches = index.select("item_id", "item_hash", "n", F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("item_h")).withColumn(
        "item_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    room = F.col("m") * THRESHOLD[1] >= F.col("n") * THRESHOLD[0]
    return (probes.join(sketches, (F.col("h") == F.col("item_h")) & (F.col("salt") == F.col("item_salt")) & room)
            .select("id", "text_hash", "item_id", "item_hash").distinct())


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, item_id, n_shingles, n_shared, containment) for each document and item of
    whose distinct shingles (runs of five words, A-Z lower-cased) the document holds 0.8 or more.

    Texts with fewer words have one shingle, the whole sequence; NULL and blank texts
    have none and match nothing.  Of rows with the same id each distinct text is judged by itself
    (``text_hash`` tells them apart); items with the same id likewise, and the better match
    counts.  Other columns are ignored; if either table is empty, so is the result."""
    index = staged(item_shingles(items, item_id_col, item_text_col, shingle), "decontaminate-items")
    context = docs.sparkSession.sparkContext
    bloom = context.broadcast(_filter(index.select(F.explode("hashes").alias("h"))))
    sketches = context.broadcast(_filter(index.select(F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("h"))))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that may hold one of a sketch: those hashes, and all shingles that items may have."""
        for b in batches:
            at, number, probes, shingles = [], [], [], []
            for i, text in enumerate(b.column("text")):
                seen: dict[bytes, np.uint64] = {}
                for words, h in shingle_blocks(text.as_py(), shingle):
                    k = min(shingle, len(words))
                    for p in passes(bloom.value, h).tolist():
                        seen.setdefault(b" ".join(words[p:p + k]), h[p])
                h = np.unique(np.array(list(seen.values()), np.uint64))
                h = h[passes(sketches.value, h)]
                if len(h):
                    at.append(i)
                    number.append(len(seen))
                    probes.append(h.view(np.int64))
                    shingles.append(list(seen))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), b.column("text_hash").take(take), pa.array(number, pa.int32()),
                 pa.array(probes, pa.list_(pa.int64())), pa.array(shingles, pa.list_(pa.binary()))],
                names=["id", "text_hash", "m", "probes", "held"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = [len(set(x).intersection(y)) for x, y in zip(b.column("held").to_pylist(), b.column("shingles").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "text_hash", "item_id", "n")), pa.array(shared, pa.int64())],
                                             names=["id", "text_hash", "item_id", "n", "n_shared"])

    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {id_type}, text_hash long, m int, probes array<bigint>, held array<binary>")
    found = staged(found.dropDuplicates(["id", "text_hash"]), "decontaminate-found")      # copies of a row only repeat it
    candidates = search(found, index).withColumn("salt", F.pmod(F.xxhash64("id", "text_hash"), F.lit(SALTS)).cast("int"))
    pairs = candidates.join(
        found.select(F.col("id").alias("d"), F.col("text_hash").alias("t"), "held"),
        F.col("id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).drop("d", "t")
    # An item that very many documents hold is spread over salts.
    texts = index.select(F.col("item_id").alias("i"), F.col("item_hash").alias("u"), "n", "shingles",
                         F.explode(F.array(*map(F.lit, range(SALTS)))).alias("s"))
    pairs = pairs.join(texts, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_hash") == F.col("u")) & (F.col("salt") == F.col("s")))
    shared = (pairs.select("id", "text_hash", "item_id", "n", "held", "shingles")
              .mapInArrow(verify, f"id {id_type}, text_hash long, item_id long, n int, n_shared long"))
    enough = F.col("n_shared") * THRESHOLD[1] >= F.col("n") * THRESHOLD[0]
    shared = shared.where(enough).groupBy("id", "text_hash", "item_id", "n").agg(F.max("n_shared").alias("n_shared"))
    return shared.select(
        F.col("id").alias(id_col), "text_hash", F.col("item_id").alias(item_id_col), F.col("n").cast("long").alias("n_shingles"),
        "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))
