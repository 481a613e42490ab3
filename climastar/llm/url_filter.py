"""URL filter: prefix rules, then a list of canonical URLs behind a blocked Bloom filter.

Native DataFrame operations only.  The listed URLs set one bit in each of the
eight 64-bit words of one block; the filter has at most ``MAX_BLOCKS`` blocks
(72 bytes each), so its broadcast has a fixed bound whatever the list's size: a longer list
only lets more URLs through to the exact join, which decides alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER

WORDS = 8
BITS_PER_KEY = 16
MAX_BLOCKS = 65_536          # 4.7 MB broadcast at most
HEAVY = 1024                 # a URL with over one in so many of the rows is dealt to several tasks

#: (host, path, verdict)
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, and the path without trailing slashes; scheme, query and fragment go."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, NULL without one.  A rule fits its host
    and all subdomains if the path starts with the rule's path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):   # the longest is tested first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(1))
    return [F.expr("shiftleft(1L, cast(%s as int))" % f"shiftrightunsigned(__h, {6 * i}) & 63") for i in range(WORDS)], h


def bloom_filter(keys: DataFrame, n_blocks: int) -> DataFrame:
    """Blocked Bloom filter of column ``key``: at most ``n_blocks`` rows (block, w0 .. w7)."""
    masks, h = _masks(F.col("key"))
    return (keys.where("key is not null").select(_block(F.col("key"), n_blocks).alias("block"), h.alias("__h"))
            .groupBy("block").agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(masks)]))


def may_contain(rows: DataFrame, key: str, bloom: DataFrame, n_blocks: int, out: str) -> DataFrame:
    """Add boolean ``out``: false only if ``key`` is surely not in the filter."""
    masks, h = _masks(F.col(key))
    probe = rows.withColumn("__b", _block(F.col(key), n_blocks)).withColumn("__h", h)
    hit = F.lit(True)
    for i, m in enumerate(masks):
        hit = hit & (F.col(f"__w{i}").bitwiseAND(m) == m)
    small = bloom.select(F.col("block").alias("__b"), *[F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)])
    return (probe.join(F.broadcast(small), "__b", "left").withColumn(out, F.coalesce(hit, F.lit(False)))
            .drop("__b", "__h", *[f"__w{i}" for i in range(WORDS)]))


def filter_size(n_keys: int) -> int:
    return max(1, min(MAX_BLOCKS, -(-n_keys * BITS_PER_KEY // (64 * WORDS))))


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule],
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row: (id, url, host, path, canonical_url, rule, listed boolean, verdict).

    ``listed`` has canonical URLs in column ``url`` (repeats and NULLs allowed).
    The longest fitting rule decides; without one a listed URL is blocked and
    any other allowed.  NULL URLs and URLs without ``://`` have empty host and
    path, fit no rule and are never listed.  Repeated rows are judged each; other
    columns are left out.
    """
    keys = listed.select(F.col("url").alias("key")).where("key is not null and key <> ''")
    n_blocks = filter_size(keys.agg(F.approx_count_distinct("key")).first()[0])
    bloom = bloom_filter(keys, n_blocks)
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    rows = rows.withColumn("canonical_url", canonical(F.col("host"), F.col("path")))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__v": verdict})
    rows = may_contain(rows, "canonical_url", bloom, n_blocks, "__hit")
    # Only possible hits are shuffled.  URLs with over a HEAVY-th of them, fewer than HEAVY, are dealt to as many tasks as they have
    # such parts; the list's row is copied to these.
    hit = rows.where("__hit")
    count = hit.groupBy(F.col("canonical_url").alias("__u")).agg(F.count("*").alias("__n"))
    part = F.greatest(F.lit(1), F.ceil(F.lit(hit.count()) / HEAVY))
    heavy = count.withColumn("__parts", F.ceil(F.col("__n") / part)).where("__parts > 1").select("__u", "__parts")
    salted = (hit.join(F.broadcast(heavy), F.col("canonical_url") == F.col("__u"), "left")
              .withColumn("__s", F.pmod(F.xxhash64(id_col, "url"), F.coalesce("__parts", F.lit(1)))).drop("__u", "__parts"))
    exact = (keys.distinct().join(F.broadcast(heavy), F.col("key") == F.col("__u"), "left")
             .select(F.col("key").alias("__k"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1)) - 1)).alias("__t"), F.lit(True).alias("__l")))
    hits = (salted.join(exact, (F.col("canonical_url") == F.col("__k")) & (F.col("__s") == F.col("__t")), "left")
            .withColumn("listed", F.coalesce("__l", F.lit(False))))
    misses = rows.where("not __hit").withColumn("listed", F.lit(False))
    cols = [id_col, "url", "host", "path", "canonical_url", "rule", "listed", "__v"]
    return (hits.select(cols).union(misses.select(cols))
            .withColumn("verdict", F.coalesce("__v", F.when(F.col("listed"), "block").otherwise("allow"))).drop("__v"))
