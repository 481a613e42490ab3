"""SimHash near-duplicates: deletion-variant signatures on fewer segments, joined and verified.

Fingerprints at most two bits apart have, of two 32-bit segments, one that
differs by at most one bit.  Each distinct fingerprint is therefore indexed
under the 64 variants "segment with one bit position deleted"; fingerprints
with an equal variant are candidates and verified by their distance.

A variant that very many fingerprints share is not expanded into pairs: beyond
``BUCKET`` members, all members take the exact way around.  Two fingerprints
are within two bits if and only if some value is within one bit of both, so
they are grouped under the 65 values of their ball; such a group has at most 65
members, all linked, and a star to its smallest member keeps its links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import connected_components, staged

SEED = 42
BUCKET = 32
_BLOCK = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: str) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, in lists of about a megabyte."""
    data = text.encode("utf-8", "surrogatepass").lower()      # bytes: only A-Z change, ASCII white space splits
    at = 0
    while at < len(data):
        end = _WHITE.search(data, at + _BLOCK) if len(data) - at > _BLOCK else None
        stop = end.start() if end else len(data)
        yield data[at:stop].split()
        at = stop


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``size`` words, repeats included; of the whole sequence if it is shorter."""
    last: list[bytes] = []
    found = False
    for words in word_blocks(text or ""):
        words = last + words
        if len(words) >= size:
            found = True
            runs = zip(*[words[i:] for i in range(size)])
            yield np.array([xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs], np.uint64)
            last = words[len(words) - size + 1:] if size > 1 else []
        else:
            last = words
    if last and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], np.uint64)


def simhash(text: str | None, size: int) -> int:
    """Bits set in over half of the shingles' hashes, as a signed 64-bit integer; no words: zero."""
    ones, total = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size):
        for at in range(0, len(h), 65_536):
            part = h[at:at + 65_536]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, text_hash long, fingerprint long) of every row; NULL texts have no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = pa.array([simhash(t.as_py(), shingle) for t in b.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), prints], names=["id", "text_hash", "fingerprint"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, text_hash long, fingerprint long"))


def _variants(max_distance: int) -> F.Column:
    segments = max_distance // 2 + 1
    width, out = 64 // segments, []
    for slot in range(64):
        lo = slot // width * width
        mask = ((1 << width) - 1) << lo & ~(1 << slot)
        mask -= (mask >> 63) << 64                          # as a signed long
        out.append(F.struct(F.lit(slot).alias("slot"), F.col("fp").bitwiseAND(F.lit(mask)).alias("part")))
    return F.explode(F.array(*out))


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp`` long) that give the
    same components as all pairs at most ``max_distance`` (0, 1 or 2) bits apart."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    bucket = max(BUCKET, 2)                                  # of one bit, a variant has at most two members
    index = fps.select("fp", _variants(max_distance).alias("v")).select("fp", "v.*")
    by_variant = Window.partitionBy("slot", "part").orderBy("fp")
    seen = index.select(
        "fp", "slot",
        F.collect_list("fp").over(by_variant.rowsBetween(1, bucket)).alias("after"),
        F.count("*").over(by_variant.rowsBetween(-bucket, bucket)).alias("around")).where("around > 1")
    # Verified before it is a row; a pair with an equal segment is in all variants of it and counts in the first.
    width = 64 // (max_distance // 2 + 1)
    first = F.col("slot") % width == 0

    def linked(other):
        d = F.col("fp").bitwiseXOR(other)
        inside = F.expr(f"shiftleft({(1 << width) - 1 if width < 64 else -1}L, slot - slot % {width})")
        return (F.bit_count(d) <= max_distance) & (first | (d.bitwiseAND(inside) != 0))

    pairs = F.when(F.col("around") > bucket, F.array(F.lit(None).cast("long"))).otherwise(F.filter("after", linked))
    found = staged(seen.select(F.col("fp").alias("a"), F.explode(pairs).alias("b")).distinct(), "simhash-links")
    hot = found.where("b is null").select(F.col("a").alias("fp"))
    flips = [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)]
    ball = hot.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("z"))
    # At most 65 values are within a bit of one value.
    stars = ball.groupBy("z").agg(F.min("fp").alias("b"), F.collect_list("fp").alias("m")).where(F.size("m") > 1)
    stars = stars.select(F.explode("m").alias("a"), "b").where("a <> b")
    return found.where("b is not null").union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """(id, text_hash long, fingerprint long, component_id, class long) of every row of ``docs``.

    Rows with equal fingerprints, or linked by a chain of fingerprints at most
    ``max_distance`` bits apart, have the same component_id, the smallest id among
    them (NULL if none has an id), and the same class, the smallest fingerprint.  NULL and blank texts have fingerprint zero and are
    linked like any other.  Repeated rows are returned each; other columns are
    ignored; an empty table gives an empty result.
    """
    prints = staged(fingerprint(docs, id_col, text_col, shingle), "simhash")
    firsts = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("first"))
    parts = connected_components(links(firsts.select("fp"), max_distance))
    classes = (firsts.join(parts, firsts["fp"] == parts["node"], "left")
               .select("fp", "first", F.coalesce("component", "fp").alias("class")))
    smallest = classes.groupBy(F.col("class").alias("c")).agg(F.min("first").alias("component_id"))
    named = classes.join(smallest, F.col("class") == F.col("c")).select("fp", "component_id", "class")
    return (prints.join(named, prints["fingerprint"] == named["fp"])
            .select(F.col("id").alias(id_col), "text_hash", "fingerprint", "component_id", "class"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: that with the smallest id.

    Among rows with that id it is one with the least hash of its text.  Rows without an id come after
    all others, by their text's hash.  An id with several texts has each of them in its own component.  Any
    column names may occur."""
    rows = docs.select(F.struct(F.col("*")).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("hash"))
    found = near_duplicates(rows, "id", "text", shingle, max_distance)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))
    kept = found.groupBy("class").agg(least.alias("m")).select(F.col("m.id").alias("kept"), F.col("m.text_hash").alias("kept_hash"))
    first = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    return (rows.join(kept.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("kept")) & (F.col("hash") == F.col("kept_hash")))
            .withColumn("first", first).where("first = 1").select("row.*"))
