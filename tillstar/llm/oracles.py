"""DuckDB SQL of those queries of this package that SQL can express."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URLS = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
"""

# The digest is five hex digits (four base-32 digits) at a time.
WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hexed,
         max(page_id) OVER (PARTITION BY payload) AS largest
  FROM payloads
), bits AS (
  SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', substr(hexed, i + 1, 1)) - 1) AS n FROM digests
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((n[1 + (k // 4) * 5] * 65536 + n[2 + (k // 4) * 5] * 4096 + n[3 + (k // 4) * 5] * 256
               + n[4 + (k // 4) * 5] * 16 + n[5 + (k // 4) * 5]) >> (15 - 5 * (k % 4))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM bits
"""


_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, coalesce({_WORDS.format(LOWER.format("text"))}, []) AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format(LOWER.format("text"))} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i + 1 : i + 13], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), runs AS (
  SELECT doc_id, size, i, array_to_string(w[i + 1 : i + size], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (
  SELECT DISTINCT r.doc_id, r.i, r.size, x.item_id FROM runs r JOIN windows x ON r.size = x.size AND r.phrase = x.phrase
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id
"""


EXACT_DUPLICATES = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""


def _leaf(*fields: str) -> str:
    held = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in fields]
    return f"sha256({' || '.join(held)})"


# CRC-32 bit by bit: each digit is xored in, then the register is shifted eight times.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(len({0})), lambda k:
    [ascii(substr({0}, k + 1, 1)), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[]))), lambda a, x:
    CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

_LEVELS = """
  SELECT tree, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {0}) WHERE n > 1 GROUP BY tree, level, i // 16
"""

MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
         {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 5 = 0
              THEN {_leaf("doc_id", "source", "lang", "n_chars", LOWER.format("text"))} END AS changed
  FROM documents
), nodes(tree, level, i, digest) AS (
  SELECT tree, 0, i, leaf FROM leaves UNION ALL {_LEVELS.format("nodes")}
), subroots AS (
  SELECT tree AS of_tree, digest FROM (SELECT *, count(*) OVER (PARTITION BY tree, level) AS n FROM nodes) WHERE n = 1
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY level) = 1
), top(tree, level, i, digest) AS (
  SELECT -1::BIGINT, 0, of_tree, digest FROM subroots UNION ALL {_LEVELS.format("top")}
), root AS (
  SELECT digest AS root FROM top ORDER BY level DESC LIMIT 1
), paths AS (
  SELECT doc_id, 0 AS part, n.level, l.i >> (4 * n.level) AS own, n.i, n.digest
  FROM leaves l JOIN nodes n ON l.tree = n.tree AND n.i >> 4 = l.i >> (4 * n.level + 4)
  UNION ALL
  SELECT doc_id, 1, n.level, l.tree >> (4 * n.level), n.i, n.digest
  FROM leaves l JOIN top n ON n.i >> 4 = l.tree >> (4 * n.level + 4)
), steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, level) AS step,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (WHERE i < own), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (WHERE i > own), '') AS behind
  FROM paths p
  WHERE level < (SELECT max(level) FROM top) AND part = 1
     OR part = 0 AND EXISTS (SELECT 1 FROM leaves l JOIN nodes n USING (tree) WHERE l.doc_id = p.doc_id AND n.level = p.level + 1)
  GROUP BY doc_id, part, level
), folds(doc_id, step, digest) AS (
  SELECT doc_id, 0::BIGINT, coalesce(changed, leaf) FROM leaves
  UNION ALL
  SELECT f.doc_id, s.step, sha256(before || digest || behind)
  FROM folds f JOIN steps s ON f.doc_id = s.doc_id AND s.step = f.step + 1
), proofs AS (
  SELECT doc_id, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY doc_id
), ends AS (
  SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM leaves l JOIN subroots s ON l.tree = s.of_tree JOIN ends e ON l.doc_id = e.doc_id
     LEFT JOIN proofs p ON l.doc_id = p.doc_id, root
"""


_APART = "({0} - {1}) * ({0} - {1}) // ({0} + {1})"

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
  FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY lang, source, term
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, term HAVING sum(docs) >= 10
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total) AS n FROM kept GROUP BY lang
), sources AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT c.* FROM counts c SEMI JOIN kept USING (lang, term)) USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // (s.n + 2 * v) AS p,
         1 + 1000000000 * (total + 2) // (l.n + 2 * v) AS q
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
       LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum({_APART.format("a.p", "b.p")}) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, {_APART.format("p", "q")} FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": DECONTAMINATION, "op5_urls": URLS, "op6_warc": WARC, "op11_exactdup": EXACT_DUPLICATES, "op12_manifest": MANIFEST,
        "op13_divergence": DIVERGENCE,
    }
