"""The queries of this subpackage and, where SQL can express one, the SQL to check it by."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from . import (exact, impact, merkle, mixing, packing, prefix_trie, secret_scan, simhash, simple8b, spans, spotsigs,
               toolcalls, toxicity)
from .common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op3_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op4_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("row_no", "ids")


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf_dir, "documents"))


def op6_hash_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.conversation_calls(table(spark, sf_dir, "conversations"))
    return toolcalls.link_tool_calls(calls, results, toolcalls.SCHEMAS)


def op8_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_dir(spark, "token-shards")
    simple8b.write_shards(table(spark, sf_dir, "documents"), path,
                          public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_documents(spark, path)


def op9_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_classes(table(spark, sf_dir, "documents"))


def op11_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.top_k(table(spark, sf_dir, "embeddings"))


def op12_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_simhash_pivots, op2_secret_entropy, op3_digest_index, op4_lexical_packing, op5_sentence_spans, op6_hash_mix,
    op7_tool_calls, op8_simple8b, op9_toxicity_lexicon, op10_spot_signatures,
    op11_impact_topk, op12_merkle_climb, op13_prefix_trie)}

ORACLE: dict[str, str] = {}

ORACLE["op3_digest_index"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The definition itself: documents of a source in order of their hash, taken while words are left.
ORACLE["op6_hash_mix"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 10))::BIGINT AS h
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
-- Rounds of sharing: sources above their limit stop there, the others share what is left.
rounds AS (
  SELECT 0 AS round, source, source_size, w, false AS capped,
         sum(source_size) OVER () * 1.5 * w / sum(w) OVER () AS target
  FROM per_source
  UNION ALL
  SELECT round + 1, source, source_size, w, capped OR target > 2.0 * source_size,
         CASE WHEN capped OR target > 2.0 * source_size THEN 2.0 * source_size
         ELSE (sum(source_size) OVER () * 1.5
               - sum(CASE WHEN capped OR target > 2.0 * source_size THEN 2.0 * source_size ELSE 0 END) OVER ()) * w
              / sum(CASE WHEN capped OR target > 2.0 * source_size THEN 0 ELSE w END) OVER () END
  FROM rounds WHERE round < (SELECT count(*) FROM per_source)),
targets AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::BIGINT ELSE 0 END AS copies
  FROM rounds WHERE round = (SELECT count(*) FROM per_source)),
ordered AS (
  SELECT s.*, t.source_size, t.target, t.copies, floor(t.target - t.copies * t.source_size)::BIGINT AS budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY s.source, h) AS tied
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (copies * size + CASE WHEN upto <= budget THEN size WHEN upto - tied >= budget THEN 0
        ELSE ((budget - (upto - tied)) * size) // tied END)::BIGINT AS taken
FROM ordered
"""


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# Matches by their text and the parts between them; every window's entropy counted anew.
ORACLE["op2_secret_entropy"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, t, kind, name, least, f, v, b, unnest(range(1, len(f) + 1)) AS i
  FROM (
    SELECT r, t, 0 AS kind, 'assign' AS name, 6 AS least,
      regexp_extract_all(t, '(KEYWORDS)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS f,
      regexp_extract_all(t, '(KEYWORDS)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS v,
      string_split_regex(t, '(KEYWORDS)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS b FROM docs
    UNION ALL
    SELECT r, t, 1, 'access', 20, regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0),
      string_split_regex(t, 'AKIA[A-Z0-9]+') FROM docs
    UNION ALL
    SELECT r, t, 2, 'hex', 24, regexp_extract_all(t, '[0-9a-f]{24,}', 0), regexp_extract_all(t, '[0-9a-f]{24,}', 0),
      string_split_regex(t, '[0-9a-f]{24,}') FROM docs
    UNION ALL
    SELECT r, t, 3, 'entropy', 20, regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}', 0),
      regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}', 0), string_split_regex(t, '[A-Za-z0-9+/_=-]{20,}') FROM docs)),
placed AS (
  SELECT r, kind, name, f[i] AS found,
    list_sum(list_transform(b[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS start
  FROM parts WHERE length(v[i]) >= least),
candidates AS (
  SELECT r, start, found, list_aggregate(list_transform(regexp_extract_all(found, 'PARTS'), lambda p:
    CASE WHEN regexp_matches(p, 'KNOWN') THEN repeat(' ', length(p)) ELSE p END), 'string_agg', '') AS blanked
  FROM placed WHERE kind = 3 AND regexp_matches(found, '[0-9]') AND NOT (ALLOWED)),
windows AS (
  SELECT r, start, found, w, substr(blanked, w + 1, 20) AS piece,
    log2(20) - list_sum(list_transform(map_values(list_aggregate(
      list_transform(range(1, 21), lambda k: blanked[w + k]), 'histogram')), lambda n: n * log2(n))) / 20 AS bits
  FROM (SELECT *, unnest(range(0, length(found) - 19)) AS w FROM candidates)),
counted AS (
  SELECT *, length(regexp_replace(piece, '[^0-9]', '', 'g')) AS digits, length(regexp_replace(piece, '[^a-z]', '', 'g')) AS lows,
    length(regexp_replace(piece, '[^A-Z]', '', 'g')) AS ups, length(regexp_replace(piece, '[^+/=_-]', '', 'g')) AS signs,
    len(regexp_extract_all(piece, '[0-9]+|[^0-9]+')) - 1 AS changes
  FROM windows),
hot AS (
  SELECT r, 3 AS kind, 'entropy' AS name, start + min(w) AS first, start + max(w) + 20 AS last
  FROM counted
  WHERE bits >= CASE
    WHEN regexp_full_match(piece, '[0-9a-f]+|[0-9A-F]+') AND digits < 20 THEN HEXBITS
    WHEN digits + lows = 20 AND digits < 20 AND changes >= 3 THEN LOWERBITS
    WHEN digits + ups = 20 AND digits < 20 AND changes >= 3 THEN UPPERBITS
    WHEN digits + lows + ups = 20 AND lows >= 1 AND ups >= 1 AND changes >= 2 THEN MIXEDBITS
    WHEN digits + lows + ups + signs = 20 AND lows >= 1 AND ups >= 1 AND signs BETWEEN 1 AND 3 AND changes >= 2 THEN BASEBITS
    ELSE 99 END
  GROUP BY r, start, found),
every AS (
  SELECT r, kind, name, start::BIGINT AS first, (start + length(found))::BIGINT AS last FROM placed WHERE kind < 3
  UNION ALL SELECT r, kind, name, first::BIGINT, last::BIGINT FROM hot)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(concat(name, ':', first, ':', last), ',' ORDER BY first, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(concat(name, ':', first, ':', last), ',' ORDER BY first, kind) FILTER (kind IS NOT NULL), '') AS spans
FROM docs d LEFT JOIN every e ON e.r = d.r GROUP BY d.r, d.doc_id
""".replace("KEYWORDS", "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))) \
    .replace("PARTS", secret_scan.PART).replace("KNOWN", secret_scan.ALLOWED_PARTS) \
    .replace("HEXBITS", str(secret_scan.LEAST_BITS["hex"])).replace("LOWERBITS", str(secret_scan.LEAST_BITS["lower"])) \
    .replace("UPPERBITS", str(secret_scan.LEAST_BITS["upper"])).replace("MIXEDBITS", str(secret_scan.LEAST_BITS["mixed"])) \
    .replace("BASEBITS", str(secret_scan.LEAST_BITS["base64"])) \
    .replace("ALLOWED", " OR ".join(
        ["replace(found, left(found, 1), '') = ''" if r"\1" in p else f"regexp_matches(found, '{p}')"
         for p in secret_scan.ALLOWED]))

# What the stand-in calls, their schemas and their results must come to, case by case; levels by longest paths.
ORACLE["op7_tool_calls"] = r"""
WITH RECURSIVE rows AS (
  SELECT conv_id AS c, turn AS t, coalesce(role = 'assistant', false) AS asked, coalesce(text, '') AS text,
    length(coalesce(text, '')) AS n, (turn + conv_id) % 6 AS kind
  FROM conversations),
calls AS (
  SELECT *, CASE WHEN kind < 2 THEN 'search' WHEN kind < 4 THEN 'score' WHEN kind = 4 OR n % 2 = 0 THEN 'store'
      ELSE 'lookup' END AS name,
    CASE WHEN kind < 2 THEN concat('{"limit":', n % 50, CASE WHEN n % 13 = 0 THEN ',"order":"odd"' ELSE ',"order":"new"' END,
        CASE WHEN n % 11 = 0 THEN ',"page":2' END, ',"query":', to_json(text), '}')
      WHEN kind < 4 THEN concat('{"strict":', CASE WHEN n % 7 = 0 THEN '"yes"' ELSE 'true' END, ',"value":', n, '.5}')
      WHEN kind = 4 THEN concat('{"entry":{"a":', to_json(text), ',"z":', CASE WHEN n % 4 = 0 THEN '"1"' ELSE '1' END,
        '},"tags":["b",', CASE WHEN n % 3 = 0 THEN '1' ELSE '"a"' END, ']}')
      WHEN n % 5 = 0 THEN '"{broken"' ELSE '{}' END AS arguments,
    CASE WHEN kind < 2 THEN concat_ws('; ', CASE WHEN n % 13 = 0 THEN 'order: not one of new, old' END,
        CASE WHEN n % 11 = 0 THEN 'page: unknown' END)
      WHEN kind < 4 THEN CASE WHEN n % 7 = 0 THEN 'strict: boolean expected' ELSE '' END
      WHEN kind = 4 THEN concat_ws('; ', CASE WHEN n % 3 = 0 THEN 'tags: items of string expected' END,
        CASE WHEN n % 4 = 0 THEN 'entry.z: integer expected' END)
      WHEN n % 2 <> 0 THEN 'unknown tool'
      WHEN n % 5 = 0 THEN 'arguments are not a JSON object' ELSE 'tags: missing; entry: missing' END AS errors
  FROM rows WHERE asked),
paths AS (
  SELECT c, t, 0 AS d FROM calls
  UNION SELECT a.c, a.t, p.d + 1 FROM paths p JOIN calls a ON a.c = p.c AND a.t IN (p.t + 2, p.t + 4, p.t + 6)),
levels AS (SELECT c, t, max(d)::INTEGER AS level FROM paths GROUP BY c, t),
results AS (SELECT c, t - 1 AS t, text FROM rows WHERE NOT asked AND t > 0),
linked AS (
  SELECT coalesce(a.c, r.c) AS c, coalesce(a.t, r.t) AS id, a.t AS turn, r.t + 1 AS result_turn, a.name, a.arguments,
    a.errors, r.text AS result, (r.t IS NOT NULL)::BIGINT AS n_results
  FROM calls a FULL JOIN results r ON r.c = a.c AND r.t = a.t)
SELECT l.c AS conv_id, concat('call-', l.c, '-', id) AS call_id, v.level, turn, result_turn, n_results,
  CASE WHEN turn IS NULL THEN 'orphan' WHEN l.errors <> '' THEN 'invalid' WHEN n_results = 0 THEN 'no result'
    ELSE 'ok' END AS status,
  coalesce(l.errors, '') AS errors,
  concat('{"arguments":', coalesce(l.arguments, 'null'), ',"id":"call-', l.c, '-', id, '","name":',
    coalesce('"' || l.name || '"', 'null'), ',"result":', coalesce(to_json(result)::VARCHAR, 'null'), '}') AS json
FROM linked l LEFT JOIN levels v ON v.c = l.c AND v.t = turn
"""

ORACLE["op11_impact_topk"] = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS place
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.r <> q.r)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


def _crc32(value: str) -> str:
    """CRC-32 of a number's decimal digits, bit by bit."""
    step = "lambda c, b: xor(c // 2, 3988292384 * (c % 2))"
    return (f"xor(4294967295, list_reduce(list_transform(string_split({value}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT), "
            f"lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {step}, xor(crc, byte)), 4294967295::BIGINT))")


# Every level by grouping two nodes, every proof by one step a level.
ORACLE["op12_merkle_climb"] = """
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars, CRC % 7 = 0 AS chosen,
    concat(FIELD(doc_id), FIELD(source), FIELD(lang)) AS a, FIELD(n_chars) AS b, FIELD(n_chars + 1) AS c, FIELD(text) AS d
  FROM documents),
leaves AS (
  SELECT r, doc_id, sha256(concat(a, b, d)) AS leaf,
    CASE WHEN chosen AND n_chars IS NOT NULL THEN sha256(concat(a, c, d)) ELSE sha256(concat(a, b, d)) END AS claimed,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(concat(a, b, d)), r) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM fields),
lower_nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT -1::BIGINT AS tree, 0 AS level, tree AS pos, digest, n FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM upper_nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
nodes AS (SELECT * FROM lower_nodes UNION ALL SELECT * FROM upper_nodes),
climb AS (
  SELECT r, tree, 0 AS level, pos, n, claimed AS folded, '' AS siblings FROM leaves
  UNION ALL
  SELECT c.r, CASE WHEN c.n = 1 THEN -1 ELSE c.tree END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN c.tree ELSE c.pos // 2 END,
    CASE WHEN c.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 1) // 2 END,
    CASE WHEN c.n = 1 THEN folded WHEN c.pos % 2 = 0 THEN sha256(concat(folded, s.digest)) ELSE sha256(concat(s.digest, folded)) END,
    CASE WHEN c.n = 1 THEN siblings ELSE concat(siblings, s.digest) END
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1) AND c.n > 1
  WHERE NOT (c.tree = -1 AND c.n = 1))
SELECT l.doc_id, l.leaf, u.digest AS subroot, t.digest AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root,
  c.folded = t.digest AS verified
FROM climb c JOIN leaves l ON l.r = c.r JOIN subroots u ON u.tree = l.tree
JOIN upper_nodes t ON t.n = 1 WHERE c.tree = -1 AND c.n = 1
"""
for _name in ("doc_id", "source", "lang", "n_chars + 1", "n_chars", "text"):
    ORACLE["op12_merkle_climb"] = ORACLE["op12_merkle_climb"].replace(
        f"FIELD({_name})", f"coalesce(strlen(({_name})::VARCHAR) || ':' || ({_name})::VARCHAR, '-')")
ORACLE["op12_merkle_climb"] = ORACLE["op12_merkle_climb"].replace("CRC", f"coalesce({_crc32('doc_id')}, 1)")

# Every prefix of every rebuilt conversation as a list of turn numbers.
ORACLE["op13_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(
      length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT c, CRC % 6 AS h, c - c % 100 AS base FROM turns),
rebuilt AS (
  SELECT v.c, t.id, 0 AS part, t.p FROM convs v JOIN turns t ON t.c = v.base AND t.p < v.h
  UNION ALL SELECT v.c, t.id, 1, t.p FROM convs v JOIN turns t ON t.c = v.c AND t.p >= v.h),
sequences AS (
  SELECT v.c, coalesce(s.ids, []::BIGINT[]) AS ids
  FROM convs v LEFT JOIN (SELECT c, list(id ORDER BY part, p) AS ids FROM rebuilt GROUP BY c) s ON s.c = v.c),
members AS (SELECT c, d, list_slice(ids, 1, d) AS node, len(ids) = d AS at_end
  FROM (SELECT c, ids, unnest(range(0, len(ids) + 1)) AS d FROM sequences)),
nodes AS (
  SELECT node, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (at_end), '')) AS ends_sha256
  FROM members GROUP BY node, d),
children AS (SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
texts AS (SELECT DISTINCT id, length(text) AS chars FROM turns),
own AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, (k.n IS NULL)::BIGINT AS leaf,
    (n.n_convs - 1) * coalesce(t.chars, 0) AS saved
  FROM nodes n LEFT JOIN children k ON k.node = n.node LEFT JOIN texts t ON t.id = n.node[n.depth]),
sums AS (
  SELECT above AS node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT list_slice(node, 1, unnest(range(0, depth + 1))) AS above, leaf, saved FROM own) GROUP BY above)
SELECT o.conv_id, o.depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON s.node = o.node
LEFT JOIN own u ON o.depth > 0 AND u.node = list_slice(o.node, 1, o.depth - 1)
""".replace("CRC", _crc32("c"))
