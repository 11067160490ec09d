"""DuckDB SQL for the corpus queries that SQL can express.

The others (learned rules and classifiers, sketches over xxHash64, tokenizers) are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from . import mixing, near_dup, prefix_free, secrets, shard, substring
from .common import WORD

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed: RFC 4648


def words(text: str = "text") -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


def op1() -> str:
    """Water filling and Efraimidis-Spirakis order as plain windows over whole sources."""
    weights = ", ".join(map(str, (3.0, 1.0, 2.0)))
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({words()}) AS BIGINT) AS size,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS symbols,
         (CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0 * source_size AS cap,
         ([{weights}])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM s),
l AS (
  SELECT *, (sum(cap) OVER later - 0.5 * sum(source_size) OVER ()) / sum(w) OVER later AS level,
         row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place
  FROM w WINDOW later AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT source, source_size,
         least(cap, w * (SELECT arg_min(level, place) FROM l WHERE level * w <= cap)) AS target
  FROM l),
e AS (SELECT *, floor(target / greatest(source_size, 1)) AS epochs FROM t),
k AS (
  SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         -ln(u) / greatest(coalesce(d.size / nullif(d.size + coalesce(d.symbols, 0), 0), 1e-6), 1e-6) AS key
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
         ROWS UNBOUNDED PRECEDING) - size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k"""


def op3() -> str:
    digit = lambda i, shift: f"substr('{BASE32}', 1 + CAST((CAST(('0x' || substr(h, {1 + 5 * i}, 5)) AS BIGINT) >> {shift}) & 31 AS INTEGER), 1)"
    base32 = " || ".join(digit(i, shift) for i in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {base32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM q"""


def op4() -> str:
    n = substring.WINDOW
    return f"""
WITH d AS (SELECT doc_id, {words()} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d)),
lowest AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT win.doc_id, unnest(range(i, i + {n})) AS p FROM win JOIN lowest USING (s) WHERE m < win.doc_id)),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""


def op8(threshold: int = 85) -> str:
    k = near_dup.SHINGLE
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    folded = f"translate(text, '{upper}', '{lower}')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words(folded)} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, s
  FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= {k}
                 THEN [array_to_string(w[i:i + {k - 1}], ' ') for i in range(1, len(w) - {k - 2})]
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {threshold} * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id, min(other) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""


def op10() -> str:
    def found(number: int, rule: secrets.Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        size = f"length(regexp_extract(m[i], '{pattern}', {rule.group}))"
        return f"""
  SELECT doc_id, {number} AS k, start, start + length(m[i]) AS stop
  FROM (SELECT *, list_sum([length(x) for x in parts[1:i]])
               + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) AS start
        FROM (SELECT doc_id, m, parts, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m,
                           string_split_regex(coalesce(text, ''), '{pattern}') AS parts FROM documents)))
  WHERE {size} >= {rule.least}"""

    kinds = ", ".join(f"'{r.kind}'" for r in secrets.RULES)
    base = len(secrets.BASE_RULES)
    said = f"(([{kinds}])[k + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT))"
    counts = ", ".join(
        f"CAST(count(k) FILTER (k = {i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(secrets.BASE_RULES)
    )
    union = "\n  UNION ALL".join(found(i, r) for i, r in enumerate(secrets.RULES))
    return f"""
WITH f AS ({union})
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg({said}, ',' ORDER BY start, k) FILTER (k < {base}), '')) AS base_sha256,
       coalesce(string_agg({said}, ',' ORDER BY start, k), '') AS spans
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id"""


def op11() -> str:
    n = prefix_free.WINDOW
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (
  SELECT doc_id, i, substr(x, 2 * i - 1, {2 * n}) AS s
  FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - {n - 2})) AS i FROM d)),
lowest AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT win.doc_id, unnest(range(i, i + {n})) AS p FROM win JOIN lowest USING (s) WHERE m < win.doc_id)),
runs AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (begins) AS spans
  FROM (SELECT doc_id, coalesce(p <> 1 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), true) AS begins FROM gone) GROUP BY doc_id),
placed AS (
  SELECT doc_id, p, substr(x, 2 * p - 1, 2) AS b
  FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 + 1)) AS p FROM d SEMI JOIN runs USING (doc_id))),
kept AS (SELECT doc_id, string_agg(b, '' ORDER BY p) AS t FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(runs.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN runs.n IS NULL THEN x ELSE coalesce(t, '') END)) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: eight shifts a byte."""
    shifts = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {shifts}), 4294967295)"


def op6(shards: int = 8, seed: int = 0) -> str:
    """Row numbers in the order of ids, walked through the Feistel network until below the number of rows."""
    left, right = "l", "r"
    for factor, addend in shard.ROUND_KEYS:
        left, right = right, f"(({left} + (({right} % {shard.PRIME}) * {factor} + {addend + seed}) % {shard.PRIME}) % side)"
    codes = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    table = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {codes} AS codes, {table} AS crcs,
         row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM documents),
rows AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, place, n, CAST(ceil(sqrt(n)) AS BIGINT) AS side,
         CAST(xor(list_reduce(list_concat([4294967295], codes), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM d),
walk AS (
  SELECT doc_id, n, side, place AS v, 0 AS step FROM rows
  UNION ALL
  SELECT doc_id, n, side, a * side + b, step + 1
  FROM (SELECT doc_id, n, side, step, {left} AS a, {right} AS b
        FROM (SELECT doc_id, n, side, step, v // side AS l, v % side AS r FROM walk WHERE step = 0 OR v >= n)))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(v % {shards} AS INTEGER) AS shard, CAST(v // {shards} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM rows JOIN walk USING (doc_id) WHERE step > 0 AND v < walk.n"""


def op12(levels: int = 10) -> str:
    """The trees level by level, as many as ``8 ** levels`` leaves need."""
    said = lambda c: f"coalesce(CAST(strlen({c}) AS VARCHAR) || ':' || {c}, '-')"
    values = lambda text: " || ".join(said(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", text))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ctes = [f"""
d AS (SELECT doc_id, lang, sha256({values("text")}) AS leaf,
             CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({values(f"translate(text, '{upper}', '{upper.lower()}')")}) END AS other
      FROM documents),
g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM (SELECT DISTINCT lang FROM documents)),
l AS (SELECT doc_id, leaf, coalesce(other, leaf) AS start, grp,
             row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
      FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang),
a0 AS (SELECT grp, place, leaf AS h, count(*) OVER (PARTITION BY grp) AS many FROM l)"""]

    def tree(name: str) -> None:
        for k in range(levels):
            ctes.append(f"""
{name}{k + 1} AS (
  SELECT grp, place // 8 AS place, sha256(string_agg(h, '' ORDER BY place)) AS h, (any_value(many) + 7) // 8 AS many
  FROM {name}{k} WHERE many > 1 GROUP BY grp, place // 8)""")

    tree("a")
    subroots = " UNION ALL ".join(f"SELECT grp, h FROM a{k} WHERE many = 1" for k in range(levels + 1))
    ctes.append(f"sub AS ({subroots})")
    ctes.append("b0 AS (SELECT 0 AS grp, grp AS place, h, count(*) OVER () AS many FROM sub)")
    tree("b")
    root = " UNION ALL ".join(f"SELECT h FROM b{k} WHERE many = 1" for k in range(levels + 1))
    ctes.append(f"root AS ({root})")
    ctes.append("f0 AS (SELECT doc_id, leaf, grp, place, start AS h, '' AS proof FROM l)")
    step, steps = 0, [("a", k) for k in range(levels)] + [("b", k) for k in range(levels)]
    for name, k in steps:
        if (name, k) == ("b", 0):  # a subroot's place in the top tree is its group's number
            ctes.append(f"f{step + 1} AS (SELECT doc_id, leaf, grp, grp AS place, h, proof FROM f{step})")
            step += 1
        same = "n.grp = f.grp" if name == "a" else "true"
        ctes.append(f"""
s{step} AS (
  SELECT f.doc_id, f.leaf, f.grp, f.place, string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < f.place) AS lefts,
         string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > f.place) AS rights, any_value(f.h) AS h, any_value(f.proof) AS proof,
         any_value(n.many) AS many
  FROM f{step} f LEFT JOIN {name}{k} n ON {same} AND n.place // 8 = f.place // 8 AND n.many > 1 GROUP BY ALL),
f{step + 1} AS (
  SELECT doc_id, leaf, grp, CASE WHEN many IS NULL THEN place ELSE place // 8 END AS place,
         CASE WHEN many IS NULL THEN h ELSE sha256(coalesce(lefts, '') || h || coalesce(rights, '')) END AS h,
         proof || coalesce(lefts, '') || coalesce(rights, '') AS proof FROM s{step})""")
        step += 1
    return "WITH " + ",".join(ctes) + f"""
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM f{step} f JOIN sub USING (grp) CROSS JOIN root"""


def op13() -> str:
    return f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
         {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY pos) AS turns, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h FROM t GROUP BY conv_id),
c AS (
  SELECT own.conv_id, list_concat(coalesce(f.turns[1:own.h], []), own.turns[own.h + 1:]) AS s
  FROM own LEFT JOIN own f ON f.conv_id = own.conv_id - ((own.conv_id % 5) + 5) % 5),
p AS (SELECT conv_id, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS depth FROM c),
k AS (SELECT conv_id, n, depth, CASE WHEN depth = 0 THEN 0 ELSE strlen(s[depth].t) END AS bytes, md5(CAST(s[1:depth] AS JSON)) AS key FROM p),
g AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, max(n) = depth AS leaf,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM k GROUP BY depth, key),
path AS (  -- every node with each of its ancestors and itself
  SELECT g.depth AS below, g.conv_id AS own, g.n_convs, g.bytes, g.leaf, k.depth, k.key
  FROM g JOIN k ON k.conv_id = g.conv_id AND k.depth <= g.depth),
sums AS (
  SELECT depth, key, count(*) FILTER (below = depth + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves,
         sum((n_convs - 1) * bytes) AS saved_tokens FROM path GROUP BY depth, key)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(g.n_convs AS BIGINT) AS n_convs,
       CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       g.ends_sha256
FROM g JOIN sums USING (depth, key)
LEFT JOIN k ON k.conv_id = g.conv_id AND k.depth = g.depth - 1
LEFT JOIN g up ON up.depth = k.depth AND up.key = k.key"""


ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": op1(),
    "op3_chunked_warc": op3(),
    "op4_seed_and_extend": op4(),
    "op6_feistel_shards": op6(),
    "op8_multi_index_near_dup": op8(),
    "op10_trigram_secrets": op10(),
    "op11_prefix_free_dedup": op11(),
    "op12_merkle_manifest": op12(),
    "op13_conversation_trie": op13(),
}
