"""Document fingerprints: SimHash by weighted term hashes, and search by permuted block tables.

Native DataFrame operations only.  Every occurrence of a term (a word with the
word after it; the last word alone) votes on all 64 bits of its hash with the weight
of its length in characters, so frequent and long terms count most.  Votes are
summed in 32 long columns, two 32-bit lanes each, by a hash aggregate.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE

MAX_WEIGHT = 32
LANES = 0x0000000100000001
#: Range buckets by approximate quantiles, each cut evenly so that a bucket has about this many rows.
OUTER_BUCKETS = 256
ROWS_PER_BUCKET = 50_000


def words_of(text: Column) -> Column:
    """Lower-cased words; NULL and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def votes_of(words: Column) -> Column:
    """array<struct<h bigint, w bigint>>: hash and weight of each term occurrence."""
    def vote(x: Column, i: Column) -> Column:
        after = F.get(words, i + 1)
        weight = F.least(F.length(x) + F.coalesce(F.length(after), F.lit(0)), F.lit(MAX_WEIGHT))
        return F.struct(F.xxhash64(x, after).alias("h"), weight.cast("long").alias("w"))
    return F.transform(words, vote)


def _vote_sums() -> list[Column]:
    sums = [F.sum(F.expr(f"(shiftrightunsigned(__t.h, {j}) & {LANES}L) * __t.w")).alias(f"__s{j}") for j in range(32)]
    return [*sums, F.sum("__t.w").alias("__w")]


def _fingerprint() -> Column:
    """A bit is 1 if the signed votes for it are positive; no terms: 0."""
    bits = [f"if(2 * (__s{j} & 4294967295L) > __w, {1 << j}L, 0L) | if(2 * shiftrightunsigned(__s{j}, 32) > __w, "
            f"shiftleft(1L, {j + 32}), 0L)" for j in range(32)]
    return F.coalesce(F.expr(" | ".join(bits)), F.lit(0).cast("long"))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row (keys.., fingerprint long) per distinct value of ``keys``, which must identify a text."""
    rows = docs.select(*keys, words_of(F.col(text)).alias("__words"))
    rows = rows.select(*keys, F.explode_outer(votes_of(F.col("__words"))).alias("__t"))
    return rows.groupBy(*keys).agg(*_vote_sums()).select(*keys, _fingerprint().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bucket_plan(docs: DataFrame, id_col: str) -> tuple[Column, list[int]]:
    """A range bucket for each id: bounds at approximate quantiles, as a balanced tree of comparisons."""
    s = docs.agg(F.count("*").alias("n"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi"),
                 F.percentile_approx(id_col, [i / OUTER_BUCKETS for i in range(1, OUTER_BUCKETS)], 10_000).alias("q")).first()
    if s.lo is None:
        return F.lit(0).cast("long"), [0]
    bounds = [s.lo, *sorted({q for q in s.q if s.lo < q}), s.hi + 1]
    inner = max(1, -(-s.n // (OUTER_BUCKETS * ROWS_PER_BUCKET)))
    c = F.coalesce(F.col(id_col), F.lit(s.lo)).cast("long")

    def tree(a: int, b: int) -> Column:
        if b - a == 1:
            lo, hi = bounds[a], bounds[b]
            width = max(1, -(-(hi - lo) // inner))
            return F.lit(a * inner).cast("long") + F.floor((c - F.lit(lo)) / F.lit(width)).cast("long")
        m = (a + b) // 2
        return F.when(c < bounds[m], tree(a, m)).otherwise(tree(m, b))

    return tree(0, len(bounds) - 1), bounds


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of the text with its last quarter replaced by the beginning of
    the next document's (ascending id, after the last the first), and their likeness.

    Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) per row of ``docs``; fingerprints are 16 hex digits.
    NULL texts count as empty; empty texts have fingerprint zero.  NULL ids come first;
    rows with the same id follow each other in the order of their text's hash.
    Other columns are ignored.  An empty table gives an empty result.

    Texts are shuffled once, to range buckets of ids, in which the next text is
    a window function.  The first row of each bucket also goes, as a guest, to
    the bucket before it, so no row needs another shuffle for its neighbour.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    bucket, _ = _bucket_plan(rows, "__id")
    ids = rows.select("__id").withColumn("__bucket", bucket)
    # One row per bucket: at most OUTER_BUCKETS x (rows / (OUTER_BUCKETS x ROWS_PER_BUCKET) + 1).
    first = ids.groupBy("__bucket").agg(F.min(F.struct(F.col("__id").isNotNull(), F.col("__id"))).alias("__f"))
    order = Window.orderBy("__bucket")
    guest = first.select(
        F.col("__bucket").alias("__target"),
        F.coalesce(F.lead("__f").over(order), F.first("__f").over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).getField("__id").alias("__guest_id"))
    guest = guest.groupBy("__guest_id").agg(F.collect_set("__target").alias("__targets"))
    spread = (rows.withColumn("__bucket", bucket)
              .join(F.broadcast(guest), F.col("__id").eqNullSafe(F.col("__guest_id")), "left")
              .select("__id", "__text", F.explode(F.concat(
                  F.array(F.struct(F.col("__bucket"), F.lit(False).alias("__guest"))),
                  F.coalesce(F.transform("__targets", lambda t: F.struct(t.alias("__bucket"), F.lit(True).alias("__guest"))),
                             F.expr("cast(array() as array<struct<__bucket:bigint,__guest:boolean>>)")))).alias("__to"))
              .select("__id", "__text", "__to.*"))
    w = Window.partitionBy("__bucket").orderBy("__guest", F.col("__id").asc_nulls_first(), F.xxhash64("__text"))
    n, cut = F.length("__text"), F.floor(F.length("__text") / 4).cast("int")
    lined = spread.withColumns({"__rn": F.row_number().over(w), "__next": F.lead("__text").over(w)})
    lined = lined.withColumns({"__n": n.cast("long"), "__edited": F.when(~F.col("__guest"), F.concat(
        F.substring("__text", F.lit(1), n - cut), F.substring("__next", F.lit(1), cut)))})
    lined = lined.withColumn("__sha", F.sha2(F.col("__edited"), 256))
    keys = ["__bucket", "__rn", "__id", "__guest", "__n", "__sha", "__edit"]
    sides = lined.select(*keys[:-1], F.explode(F.filter(F.array(
        F.struct(F.lit(False).alias("e"), F.col("__text").alias("__x")),
        F.struct(F.lit(True).alias("e"), F.col("__edited").alias("__x"))), lambda s: s["__x"].isNotNull())).alias("__side"))
    voted = (sides.select(*keys[:-1], F.col("__side.e").alias("__edit"), words_of(F.col("__side.__x")).alias("__words"))
             .select(*keys, F.explode_outer(votes_of(F.col("__words"))).alias("__t"))
             .groupBy(*keys).agg(*_vote_sums()).select(*keys, _fingerprint().alias("__fp")))
    both = voted.groupBy(*keys[:-1]).agg(F.max(F.when(~F.col("__edit"), F.col("__fp"))).alias("__fp"),
                                         F.max(F.when(F.col("__edit"), F.col("__fp"))).alias("__efp"))
    near = both.withColumn("__nfp", F.lead("__fp").over(Window.partitionBy("__bucket").orderBy("__rn")))
    return near.where(~F.col("__guest")).select(
        F.col("__id").alias(id_col), F.col("__n").alias("n_chars"), F.col("__sha").alias("edited_sha256"),
        hex_of(F.col("__fp")).alias("fingerprint"), hex_of(F.col("__efp")).alias("edited_fingerprint"),
        likeness(F.col("__fp"), F.col("__efp")).alias("near_edited"),
        likeness(F.col("__fp"), F.col("__nfp")).alias("near_next"))


def block_keys(fp: Column, radius: int, exact_blocks: int = 2) -> Column:
    """array<struct<t int, k bigint>>: one key per permuted table.

    64 bits are cut into radius + exact_blocks blocks; of two fingerprints within the
    radius at least exact_blocks blocks are equal, so one table that leads with
    those blocks has them under one key.
    """
    m = radius + exact_blocks
    edges = [64 * i // m for i in range(m + 1)]
    parts = [F.shiftrightunsigned(F.shiftleft(fp, 64 - hi), 64 - (hi - lo)) for lo, hi in zip(edges, edges[1:])]
    return F.array(*[F.struct(F.lit(t).alias("t"), F.xxhash64(*[parts[i] for i in c]).alias("k"))
                     for t, c in enumerate(combinations(range(m), exact_blocks))])


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """All (query_fp, fp, distance) with distance <= radius between the distinct long
    fingerprints of the two tables (column ``fingerprint``; NULLs are left out).

    Tables hold distinct fingerprints only, so copies cost nothing; members are
    had by joining on the fingerprint.  Use a bounded share of the rows as queries."""
    def keyed(df: DataFrame, name: str) -> DataFrame:
        return (df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
                .select(name, F.explode(block_keys(F.col(name), radius)).alias("__b")).select(name, "__b.*"))

    q, x = keyed(queries, "query_fp"), keyed(index, "fp")
    d = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    # Verified in the join itself: candidates are never rows.
    pairs = q.join(x, (q["t"] == x["t"]) & (q["k"] == x["k"]) & (d <= radius))
    return pairs.select("query_fp", "fp", d.alias("distance")).distinct()


def count_neighbours(prints: DataFrame, is_query: Column, radius: int = 3, fp_col: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``prints`` and ``n_within``: for the rows that ``is_query`` selects, the number of
    distinct fingerprints (16 hex digits in ``fp_col``) of all rows within ``radius`` bits of theirs, itself included;
    NULL for other rows.  ``prints`` is read three times and should be a written table."""
    value = F.conv(F.col(fp_col), 16, -10).cast("long")
    asked, rest = prints.where(is_query), prints.where(~F.coalesce(is_query, F.lit(False)))
    found = within_radius(asked.select(value.alias("fingerprint")), prints.select(value.alias("fingerprint")), radius)
    counts = found.groupBy("query_fp").agg(F.count("*").alias("n_within"))
    return (asked.join(counts, value == F.col("query_fp"), "left").drop("query_fp")
            .unionByName(rest.withColumn("n_within", F.lit(None).cast("long"))))
