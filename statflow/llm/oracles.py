"""DuckDB SQL for the operator queries that SQL can express."""

from __future__ import annotations

_SIZE = "octet_length(encode(coalesce(text, '')))"


def _hash52(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


# ---- operator 1: the tree's draws, and crc32 as a fold over the bytes

_CRC_TABLE = """crc AS (SELECT list(v ORDER BY n) AS t FROM (
  SELECT n, list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0],
                        lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM (SELECT unnest(range(0, 256)) AS n)))"""


def _tree_sql(tree, key: str) -> str:
    """The shard of a key as nested CASEs over winning draws."""
    def draw(level, name, weight):
        u = f"({_hash52(f'''{key} || ':{level}:{name}' ''')} + 0.5) / {float(1 << 52)}::DOUBLE"
        return f"-ln({u}) / {float(weight)}::DOUBLE"

    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node

    def choose(level, nodes, value):
        items = [(k, v) for k, v in nodes.items() if weight(v) > 0]
        if len(items) == 1:
            return value(*items[0])
        least = "least(" + ", ".join(draw(level, k, weight(v)) for k, v in items) + ")"
        whens = " ".join(f"WHEN {draw(level, k, weight(v))} = {least} THEN {value(k, v)}"
                         for k, v in items)
        return f"CASE {whens} END"

    return choose("region", tree, lambda _, racks: choose(
        "rack", racks, lambda _, shards: choose("shard", shards, lambda s, _: str(s))))


def shards_sql(n_shards: int = 8, buckets: int = 4096) -> str:
    from statflow.llm.sharding import uniform_tree, with_shard
    key = "coalesce(CAST(doc_id AS VARCHAR), '~')"
    tree = uniform_tree(n_shards)
    return f"""
WITH {_CRC_TABLE},
b AS (SELECT doc_id, CAST({_SIZE} + 1 AS BIGINT) AS size,
             list_transform(range(0, {_SIZE}),
               lambda i: CAST('0x' || h[2 * i + 1] || h[2 * i + 2] AS BIGINT)) AS bytes
      FROM (SELECT doc_id, text, string_split(hex(encode(coalesce(text, ''))), '') AS h FROM documents)),
c AS (SELECT doc_id, size, xor(4294967295, list_reduce([4294967295::BIGINT] || bytes,
        lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1]))) AS text_crc32
      FROM b, crc),
p AS (SELECT *, {_tree_sql(tree, key)} AS shard, {_tree_sql(with_shard(tree, n_shards), key)} AS grown_shard,
             {_hash52(f"{key} || ':slot'")} AS h FROM c)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h // {(1 << 52) // buckets}, h, doc_id NULLS FIRST,
                          size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM p"""


# ---- operator 2

BM25 = r"""
WITH t AS (SELECT doc_id, unnest(w) AS w, len(w) AS n
           FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')),
                                                   '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents)),
g AS (SELECT count(*) AS n, (SELECT count(*) FROM t) / count(*) AS avg FROM documents),
f AS (SELECT doc_id, w, count(*) AS tf, any_value(n) AS len FROM t GROUP BY doc_id, w),
i AS (SELECT w, ln(1 + (g.n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf
      FROM f, g GROUP BY w, g.n),
s AS (SELECT q.doc_id AS query_id, d.doc_id,
             round(sum(q.tf * idf * d.tf * 2.2::DOUBLE
                       / (d.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.len / avg))), 6) AS score
      FROM f q JOIN f d USING (w) JOIN i USING (w), g
      WHERE q.doc_id % 20 = 0 AND q.doc_id <> d.doc_id GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
WHERE rank <= 10"""


# ---- operator 4

def _base32(hex_: str) -> str:
    five = f"CAST('0x' || substr({hex_}, 5 * g + 1, 5) AS BIGINT)"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    chars = " || ".join(f"substr('{letters}', CAST(({five} >> {k}) & 31 AS INTEGER) + 1, 1)"
                        for k in (15, 10, 5, 0))
    return f"array_to_string(list_transform(range(0, 8), lambda g: {chars}), '')"


ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first FROM p
      WINDOW w AS (PARTITION BY sha ORDER BY page_id NULLS LAST))
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       {_base32("sha")} AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first END AS refers_to
FROM r"""


# ---- operator 6

_MIX_HASH = _hash52("'1:' || e || ':' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || tokens"
                    " || ':' || coalesce(source, '~')")

MIX = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM documents),
s AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS n FROM d GROUP BY source),
a AS (SELECT CAST(sum(n) AS DOUBLE) AS total, sum(CASE WHEN n > 0 THEN n * ln(n) END) AS nl,
             count(*) FILTER (n > 0) AS k FROM s),
h AS (SELECT (ln(total) - nl / total) AS own, ln(k) AS even FROM a),
l AS (SELECT ln(n / total) AS l FROM s, a WHERE n > 0),
steps(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN low ELSE (low + high) / 2 END,
         CASE WHEN ok THEN (low + high) / 2 ELSE high END
  FROM (SELECT i, low, high,
               (SELECT ln(sum(exp(l * (low + high) / 2))) - (low + high) / 2
                       * sum(l * exp(l * (low + high) / 2)) / sum(exp(l * (low + high) / 2)) FROM l)
                 <= (SELECT own + 0.5 * (even - own) FROM h)
               AND (SELECT exp(((low + high) / 2 - 1) * min(l)) / sum(exp(l * (low + high) / 2)) FROM l)
                 <= 4.0 AS ok
        FROM steps WHERE i < 30)),
t AS (SELECT ceil(round(high * 1000000, 3)) / 1000000 AS t FROM steps WHERE i = 30),
w AS (SELECT source, n, total, CASE WHEN n > 0 THEN exp(ln(n / total) * t) ELSE 0.0 END AS raw, t
      FROM s, a, t),
b AS (SELECT source, n, t, raw / sum(raw) OVER () AS weight,
             CAST(floor(round(raw / sum(raw) OVER () * total, 6)) AS BIGINT) AS budget FROM w),
e AS (SELECT doc_id, d.source, tokens, n, t, weight, budget,
             unnest(range(0, CASE WHEN tokens > 0 THEN (budget - 1) // n ELSE 0 END + 1)) AS e
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
o AS (SELECT *, e * n + sum(tokens) OVER (
               PARTITION BY source, e ORDER BY {_MIX_HASH}, doc_id NULLS FIRST, tokens
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS start FROM e)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS tokens, CAST(e AS INTEGER) AS epoch,
       CAST(start AS BIGINT) AS start,
       CAST(CASE WHEN budget > 0 THEN least(floor(start * 64 / budget), 63) ELSE 0 END AS INTEGER) AS block,
       round(weight, 9) AS weight, CAST(t AS DOUBLE) AS exponent
FROM o WHERE start < budget OR tokens = 0 OR budget <= 0"""


# ---- operator 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 5 * c >= 4 * (x.n + y.n - c)
      UNION SELECT x.doc_id, y.doc_id FROM t x JOIN t y USING (text) WHERE x.doc_id <> y.doc_id),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM t
                     UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT r.doc_id, min(other) AS class_id, (SELECT count(*) FROM e WHERE e.a = r.doc_id) AS n_links
FROM r GROUP BY r.doc_id"""


# ---- operator 11: eight levels of 8 within a language, four over the subroots


def _leaf_sql(text: str) -> str:
    parts = " || ".join(
        f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({parts})"


def merkle_sql(levels: int = 8, tops: int = 4) -> str:
    ctes = []

    def climb(name: str, first: str, height: int) -> None:
        """Tables ``{name}{k}``: nodes of level k with the siblings to their left and right."""
        for k in range(height):
            src = first if k == 0 else (
                f"(SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) "
                f"ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (any_value(n) + 7) // 8 AS n "
                f"FROM {name}{k - 1} GROUP BY g, pos // 8)")
            w = "PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
            ctes.append(
                f"{name}{k} AS MATERIALIZED (SELECT g, pos, h, n, "
                f"coalesce(string_agg(h, '') OVER ({w} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') OVER ({w} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {src})")

    ctes.append(_CRC_TABLE)
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    ctes.append(f"""d0 AS (SELECT doc_id, lang, {_leaf_sql('text')} AS leaf, {_leaf_sql(lowered)} AS low,
  list_transform(range(0, length(CAST(doc_id AS VARCHAR))),
                 lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1)) AS BIGINT)) AS bytes
  FROM documents)""")
    ctes.append("""d AS MATERIALIZED (SELECT doc_id, leaf, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY lang) AS n,
  CASE WHEN xor(4294967295, list_reduce([4294967295::BIGINT] || bytes,
         lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1]))) % 3 = 0 THEN low ELSE leaf END AS shown
  FROM d0, crc)""")
    climb("a", "(SELECT g, pos, leaf AS h, n FROM d)", levels + 1)
    ctes.append(f"s AS (SELECT g, h, (SELECT count(*) FROM a{levels}) AS n FROM a{levels})")
    climb("b", "(SELECT 0 AS g, g AS pos, h, n FROM s)", tops + 1)
    joins, proof = [], []
    for k in range(levels + tops):
        name, at, low = (f"a{k}", "d.g", "d.pos") if k < levels else (f"b{k - levels}", "0", "d.g")
        step = 8 ** (k if k < levels else k - levels)
        joins.append(f"JOIN {name} ON {name}.g = {at} AND {name}.pos = {low} // {step}")
        proof.append(f"{name}.l || {name}.r")
    # The fold, one nested query a level.
    query = (f"SELECT d.doc_id, d.leaf, s.h AS subroot, sha256({' || '.join(proof)}) AS proof_sha256, d.shown AS f0, "
             + ", ".join(f"{j.split()[1]}.n AS n{k}, {j.split()[1]}.l AS l{k}, {j.split()[1]}.r AS r{k}"
                         for k, j in enumerate(joins))
             + f" FROM d JOIN s ON s.g = d.g {' '.join(joins)}")
    for k in range(levels + tops):
        query = (f"SELECT *, CASE WHEN n{k} = 1 THEN f{k} ELSE sha256(l{k} || f{k} || r{k}) END AS f{k + 1} "
                 f"FROM ({query})")
    return f"""WITH {', '.join(ctes)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f{levels + tops} AS folded_root, f{levels + tops} = root AS verified
FROM ({query}), (SELECT h AS root FROM b{tops})"""


# ---- operator 12

TRIE = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig
      FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT c, dig, octet_length(encode(text)) AS bytes,
             row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, dig) - 1 AS i FROM t),
h AS (SELECT c, c - c % 5 AS b, xor(4294967295, list_reduce([4294967295::BIGINT] || bytes,
               lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1]))) % 9 AS h
      FROM (SELECT DISTINCT c, list_transform(range(0, length(CAST(c AS VARCHAR))),
              lambda k: CAST(ascii(substr(CAST(c AS VARCHAR), CAST(k AS INTEGER) + 1, 1)) AS BIGINT)) AS bytes
            FROM i), crc),
r AS (SELECT h.c, 0 AS part, i.i, i.dig, i.bytes FROM h JOIN i ON i.c = h.b AND i.i < h.h
      UNION ALL SELECT h.c, 1, i.i, i.dig, i.bytes FROM h JOIN i ON i.c = h.c AND i.i >= h.h),
q AS MATERIALIZED (SELECT c, string_agg(dig, '' ORDER BY part, i) AS q, count(*) AS len FROM r GROUP BY c
                   UNION ALL SELECT c, '', 0 FROM h WHERE c NOT IN (SELECT c FROM r)),
p AS (SELECT c, unnest(range(0, len + 1)) AS d, q, len FROM q),
w AS (SELECT dig, any_value(bytes) AS bytes FROM i GROUP BY dig),
n AS MATERIALIZED (
  SELECT substr(q, 1, 32 * d) AS key, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = len), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
o AS MATERIALIZED (SELECT n.*, coalesce((n_convs - 1) * bytes, 0) AS own,
                          (SELECT count(*) FROM n k WHERE k.d = n.d + 1 AND starts_with(k.key, n.key)) AS n_children
                   FROM n LEFT JOIN w ON w.dig = right(n.key, 32)),
s AS (SELECT a.key, CAST(sum(b.own) AS BIGINT) AS saved, count(*) FILTER (b.n_children = 0) AS n_leaves
      FROM o a JOIN o b ON b.d >= a.d AND starts_with(b.key, a.key) GROUP BY a.key)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       s.n_leaves, s.saved AS saved_tokens, o.ends_sha256
FROM o JOIN s USING (key) LEFT JOIN o u ON o.d > 0 AND u.key = left(o.key, length(o.key) - 32)"""


def oracles() -> dict[str, str]:
    return {"op1_hash_tree_shards": shards_sql(), "op2_block_max_bm25": BM25,
            "op4_warc_archives": ARCHIVES, "op6_temperature_mix": MIX,
            "op8_lsh_forest_join": JACCARD, "op11_merkle_manifest": merkle_sql(),
            "op12_prefix_trie": TRIE}
