"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

_PARTS = r"""
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^(?:[\s\S]*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?:[\s\S]*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages"""

OP1 = rf"""
WITH p AS ({_PARTS}),
c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS canonical_url FROM p),
l AS (SELECT DISTINCT canonical_url FROM c WHERE regexp_matches(url, '^[^#]*[?&]utm_') AND canonical_url <> ''),
r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
      ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
j AS (SELECT c.*, c.canonical_url IN (SELECT canonical_url FROM l) AS listed,
        (SELECT max_by(rhost || rpath || ' ' || rverdict, length(rhost || rpath)) FROM r
         WHERE (c.host = rhost OR ends_with(c.host, '.' || rhost)) AND starts_with(c.path, rpath)) AS hit
      FROM c)
SELECT page_id, host, path, split_part(hit, ' ', 1) AS rule, canonical_url, listed,
       coalesce(split_part(hit, ' ', 2), CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""

# Base 32 of SHA-1: five hexadecimal digits are 20 bits, four letters.
OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS x FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5))::INT >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '') AS payload_digest
      FROM d),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k
"""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '')"""
_SHINGLES = """CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END"""

OP7 = f"""
WITH d AS (SELECT doc_id, unnest(list_distinct({_SHINGLES})) AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
i AS (SELECT item_id, list_distinct({_SHINGLES}) AS ss FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
e AS (SELECT item_id, len(ss) AS n, unnest(ss) AS s FROM i)
SELECT doc_id, item_id, n AS n_shingles, count(DISTINCT s) AS n_shared, count(DISTINCT s) / n AS containment
FROM d JOIN e USING (s) GROUP BY doc_id, item_id, n HAVING 5 * count(DISTINCT s) >= 4 * n
"""

OP11 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of ASCII text: two steps of four bits for each byte."""
    steps = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        steps.append(x)
    four = lambda c: f"xor({c} >> 4, list_extract({steps}, (({c}) & 15) + 1))"                 # noqa: E731
    return (f"xor(4294967295, list_reduce(list_transform(range(0, length({text}) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295 "
            f"ELSE CAST(ascii(substr({text}, CAST(i AS INT), 1)) AS BIGINT) END), lambda a, b: {four(four('xor(a, b)'))}))")


def _field(col: str) -> str:
    return f"coalesce(octet_length(encode(CAST({col} AS VARCHAR))) || ':' || CAST({col} AS VARCHAR), '-')"


def _merkle_sql(levels: int = 8) -> str:
    """Both trees for at most 8 ** levels leaves of a language and as many languages.  A node keeps its digest while it is alone."""
    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = "array_to_string(list_concat(p.run[:c.ix % 8], {}, p.run[c.ix % 8 + 2:]), '')"

    def tree(name: str, source: str) -> list[str]:
        """``source``: (g, ix, h).  name_n{k}: nodes of a level, name_r{k}: their runs."""
        out = [f"{name}_n0 AS (SELECT g, ix, h, count(*) OVER (PARTITION BY g) AS n FROM {source})"]
        for k in range(levels):
            out += [f"{name}_r{k} AS (SELECT g, ix // 8 AS ix, list(h ORDER BY ix) AS run, any_value((n + 7) // 8) AS n FROM {name}_n{k} WHERE n > 1 GROUP BY g, ix // 8)",
                    f"{name}_n{k + 1} AS (SELECT g, ix, h, n FROM {name}_n{k} WHERE n = 1 UNION ALL SELECT g, ix, sha256(array_to_string(run, '')), n FROM {name}_r{k})"]
        return out

    def climb(name: str, source: str, over: str) -> list[str]:
        """``source``: (doc, g, ix, f, proof)."""
        out = [f"{name}_c0 AS (SELECT * FROM {source})"]
        for k in range(levels):
            out.append(f"{name}_c{k + 1} AS (SELECT c.doc, c.g, CASE WHEN p.g IS NULL THEN c.ix ELSE c.ix // 8 END AS ix, "
                       f"CASE WHEN p.g IS NULL THEN c.f ELSE sha256({cut.format('[c.f]')}) END AS f, "
                       f"CASE WHEN p.g IS NULL THEN c.proof ELSE c.proof || {cut.format('[]::VARCHAR[]')} END AS proof "
                       f"FROM {name}_c{k} c LEFT JOIN {over}_r{k} p ON c.g = p.g AND c.ix // 8 = p.ix)")
        return out

    parts = [
        f"l AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f FROM documents)",
        "p0 AS (SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ix FROM l)",
        "leaves AS (SELECT row_number() OVER (ORDER BY g, ix) AS doc, * FROM p0)",
        *tree("a", "(SELECT g, ix, leaf AS h FROM leaves)"),
        f"subs AS (SELECT g, h AS subroot FROM a_n{levels})",
        *tree("b", "(SELECT 0 AS g, g AS ix, subroot AS h FROM subs)"),
        f"top AS (SELECT h AS root FROM b_n{levels})",
        *climb("x", "(SELECT doc, g, ix, f, '' AS proof FROM leaves)", "a"),
        *climb("y", f"(SELECT doc, 0 AS g, g AS ix, f, proof FROM x_c{levels})", "b")]
    return (f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, sha256(y.proof) AS proof_sha256, y.f AS folded_root, y.f = root AS verified "
            f"FROM leaves JOIN y_c{levels} y USING (doc) JOIN subs ON leaves.g = subs.g CROSS JOIN top")


OP12 = _merkle_sql()

# Nodes are prefixes, as lists of turns.
OP13 = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS heads FROM own),
s AS (SELECT h.conv_id, list_concat(coalesce(b.turns[:h.heads], []), coalesce(h.turns[h.heads + 1:], [])) AS turns
      FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, turns[:d] AS prefix, d, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM s)),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS e
      FROM m GROUP BY prefix, d),
k AS (SELECT n.*, p.conv_id AS parent_conv_id,
             CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(list_filter(string_split_regex(n.prefix[n.d].text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS saved,
             (SELECT count(*) FROM n c WHERE c.d = n.d + 1 AND c.prefix[:n.d] = n.prefix) AS n_children
      FROM n LEFT JOIN n p ON p.d = n.d - 1 AND n.prefix[:n.d - 1] = p.prefix)
SELECT a.conv_id, a.d AS depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
       CAST(sum(b.saved) AS BIGINT) AS saved_tokens, sha256(a.e) AS ends_sha256
FROM k a JOIN k b ON b.d >= a.d AND b.prefix[:a.d] = a.prefix GROUP BY ALL
"""

ORACLE = {"op1_url_filter": OP1, "op5_warc": OP5, "op7_decontaminate": OP7, "op11_exact_topk": OP11, "op12_merkle_manifest": OP12,
          "op13_prefix_trie": OP13}
