"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

# CRC-32 of a blob: a table of 256 steps of the polynomial, then one step a byte
CRC = """
steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crcs AS (SELECT doc_id, source, text, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g')[:-2], ' '), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) END AS crc FROM documents, steps)
"""

OP3 = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(13, len(words)) AS width, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS i FROM b WHERE len(words) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
runs AS (SELECT doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') AS w
    FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM w, widths)),
hits AS (SELECT doc_id, item_id, i, r.width FROM runs r JOIN windows USING (w) WHERE r.width = windows.width),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hits GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH {CRC.strip()},
base AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, crc AS text_crc32,
    ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS shuffled FROM crcs),
f AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY shuffled, doc_id, size, text_crc32) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS fraction FROM base),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, shuffled, source, doc_id, size, text_crc32) - 1 AS place, count(*) OVER () AS total FROM f),
s AS (SELECT *, (place * 16) // total AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
    (place - (shard * total + 15) // 16)::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

# a mark of no text (a private character) behind each cut
OP9 = """
WITH l AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '(\\n|[.,;:!?] )', '\\1' || chr(57344), 'g'), chr(57344)), lambda x: x <> '') AS pieces FROM documents),
u AS (SELECT doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS n FROM l WHERE text IS NOT NULL),
k AS (SELECT doc_id, n, pieces[n] AS piece, sum(length(pieces[n])) OVER (PARTITION BY doc_id ORDER BY n) AS stop,
    regexp_extract_all(translate(pieces[n], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM u),
r AS (SELECT doc_id, n, len(words) AS w, stop - length(piece) AS start, stop,
    row_number() OVER (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, n) > 1 AS gone FROM k WHERE len(words) >= 3),
i AS (SELECT *, count(*) FILTER (WHERE NOT gone) OVER (PARTITION BY doc_id ORDER BY n) AS island FROM r),
runs AS (SELECT doc_id, min(n) AS first, max(n) AS last, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop FROM i WHERE gone GROUP BY doc_id, island HAVING sum(w) >= 25),
rest AS (SELECT k.doc_id, string_agg(piece, '' ORDER BY n) FILTER (WHERE runs.first IS NULL) AS rest, count(runs.first) AS n_removed
    FROM k LEFT JOIN runs ON runs.doc_id = k.doc_id AND n BETWEEN first AND last GROUP BY 1),
spans AS (SELECT doc_id, string_agg(start || '-' || stop, ',' ORDER BY start) AS removed FROM runs GROUP BY 1)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(rest, '') END AS text, coalesce(len(pieces), 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(removed, '') AS removed FROM l LEFT JOIN rest USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

# the same CRC-32 of a decimal number
CRC_STEPS = CRC.split("crcs AS")[0].strip().rstrip(",")


def crc_of(number: str) -> str:
    bytes_of = f"list_transform(string_split({number}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_LOWERED = _field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP12 = f"""
WITH RECURSIVE {CRC_STEPS},
hashed AS (SELECT doc_id, lang, sha256({_HEAD} || {_field("text")}) AS leaf,
    CASE WHEN {crc_of("doc_id::VARCHAR")} % 3 = 0 THEN sha256({_HEAD} || {_LOWERED}) END AS changed FROM documents, steps),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes AS (SELECT lang, 0 AS level, pos, n, leaf AS digest FROM leaves
    UNION ALL SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8, n),
subroots AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, pos, n, digest FROM subroots
    UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 8, n),
runs AS (SELECT lang, level, pos // 8 AS up, list(digest ORDER BY pos) AS m FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, pos // 8 AS up, list(digest ORDER BY pos) AS m FROM tops WHERE n > 1 GROUP BY ALL),
ways AS (SELECT l.lang, l.pos, list(array_to_string(list_slice(m, 1, k), '') || '|' || array_to_string(list_slice(m, k + 2, len(m)), '') ORDER BY level) AS s
    FROM (SELECT l.lang, l.pos, r.level, r.m, (l.pos >> (3 * r.level)) % 8 AS k FROM leaves l JOIN runs r
        ON l.lang IS NOT DISTINCT FROM r.lang AND r.up = (l.pos >> (3 * r.level + 3))) l GROUP BY 1, 2),
top_ways AS (SELECT pos, list(array_to_string(list_slice(m, 1, k), '') || '|' || array_to_string(list_slice(m, k + 2, len(m)), '') ORDER BY level) AS s
    FROM (SELECT l.pos, r.level, r.m, (l.pos >> (3 * r.level)) % 8 AS k FROM subroots l JOIN top_runs r ON r.up = (l.pos >> (3 * r.level + 3))) GROUP BY 1),
whole AS (SELECT doc_id, leaf, coalesce(changed, leaf) AS seen, s.digest AS subroot, list_concat(coalesce(w.s, []), coalesce(t.s, [])) AS steps
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN ways w ON l.lang IS NOT DISTINCT FROM w.lang AND l.pos = w.pos LEFT JOIN top_ways t ON s.pos = t.pos),
done AS (SELECT *, (SELECT digest FROM tops WHERE n = 1) AS root,
    list_reduce(list_prepend(seen, steps), lambda own, step: sha256(split_part(step, '|', 1) || own || split_part(step, '|', 2))) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM done
"""

OP11 = f"""
WITH {CRC_STEPS},
turns AS (SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(w ORDER BY turn NULLS FIRST, k) AS ws FROM turns GROUP BY 1),
heads AS (SELECT conv_id, conv_id - conv_id % 20 AS head_id, ks, ws, {crc_of("conv_id::VARCHAR")} % 4 AS h FROM own, steps),
rebuilt AS (SELECT c.conv_id, list_concat(list_slice(coalesce(o.ks, []), 1, h), list_slice(c.ks, h + 1, len(c.ks))) AS ks,
    list_concat(list_slice(coalesce(o.ws, []), 1, h), list_slice(c.ws, h + 1, len(c.ws))) AS ws FROM heads c LEFT JOIN own o ON o.conv_id = c.head_id),
visits AS (SELECT conv_id, d, len(ks) = d AS ends, array_to_string(list_slice(ks, 1, d), '') AS key, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w
    FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
    FROM visits GROUP BY key, d),
children AS (SELECT left(key, 32 * (d - 1)) AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (SELECT left(key, 32 * j) AS key, sum((n - 1) * w) AS tokens, count(*) FILTER (WHERE leaf) AS leaves
    FROM (SELECT n.key, n.n, n.w, c.n IS NULL AS leaf, unnest(range(0, d + 1)) AS j FROM nodes n LEFT JOIN children c USING (key)) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
    s.tokens::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM nodes n JOIN sums s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON n.d > 0 AND p.key = left(n.key, 32 * (n.d - 1))
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_wu_manber": OP3, "op5_interleave": OP5, "op9_unit_dedup": OP9, "op11_prefix_trie": OP11, "op12_merkle_proofs": OP12}
