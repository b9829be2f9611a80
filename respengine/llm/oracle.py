"""DuckDB statements for the queries that SQL can express."""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), seen AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prior,
         length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|\[NEXT\]')) AS text_chars,
         length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]|\[NEXT\]')) AS role_chars
  FROM turns
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
         sum(text_chars + CASE WHEN prior = role THEN 6 ELSE 20 + role_chars END) AS chars
  FROM seen GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM said
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, length(t) AS chars,
         len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
           / 281474976710656.0::DOUBLE AS u
  FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)
), mean AS (
  SELECT *, chars::DOUBLE / greatest(size, 1)::DOUBLE AS m FROM sized
), keyed AS (
  SELECT doc_id, source, size, -ln(u) / greatest(0.25::DOUBLE, 1.0::DOUBLE
           - greatest(4.0::DOUBLE - m, m - 7.0::DOUBLE, 0.0::DOUBLE) / 4.0::DOUBLE) AS key
  FROM mean
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source
), weighed AS (
  SELECT *, source_size * 3 AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sources
), levels AS (
  SELECT *, cap::DOUBLE / w AS ratio, (sum(source_size) OVER ()
         - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN ratio < share THEN cap::DOUBLE ELSE w * share END AS target
  FROM levels, (SELECT arg_min(level, ratio) AS share FROM levels WHERE ratio >= level)
), placed AS (
  SELECT k.*, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS e FROM placed
)
SELECT doc_id, size, source_size, target,
       (e * size + least(size, greatest(0, budget - e * source_size - before)))::BIGINT AS taken
FROM epochs
"""

def crc32(number: str) -> str:
    """SQL for the unsigned CRC-32 of the decimal text of ``number``."""
    byte = "ascii(x)"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform("
            f"string_split({number}::VARCHAR, ''), lambda x: {byte}::BIGINT)), lambda a, b: {bits}))")


def _encoded(*columns: str) -> str:
    return " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns)


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_encoded('doc_id', 'source', 'lang', 'n_chars', 'text')}) AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {crc32('doc_id')} % 7 = 0
              THEN sha256({_encoded('doc_id', 'source', 'lang', '(n_chars + 1)', 'text')}) END AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, count(*) OVER (PARTITION BY lang) AS n, leaf AS hash FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, level AS height, hash,
         row_number() OVER (ORDER BY lang IS NOT NULL, lang::BLOB) - 1 AS pos FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, count(*) OVER () AS n, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, pos // 2
), steps AS (
  SELECT p.doc_id, p.leaf, p.lang, n.level, s.hash AS sibling, (p.pos >> n.level) & 1 AS side
  FROM placed p JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.pos = p.pos >> n.level AND n.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = n.level AND s.pos = xor(n.pos, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.lang, r.height + n.level, s.hash, (r.pos >> n.level) & 1
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN top n ON n.pos = r.pos >> n.level AND n.n > 1
  LEFT JOIN top s ON s.level = n.level AND s.pos = xor(n.pos, 1)
), proofs AS (
  SELECT p.doc_id, p.leaf, r.hash AS subroot, (SELECT hash FROM top WHERE n = 1) AS root,
         coalesce(p.tampered, p.leaf) AS claimed,
         coalesce(list(struct_pack(h := s.sibling, side := s.side) ORDER BY s.level) FILTER (s.level IS NOT NULL), []) AS path
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN steps s ON s.doc_id = p.doc_id
  GROUP BY ALL
), folding AS (
  SELECT doc_id, leaf, subroot, root, path, 0 AS done, claimed AS node FROM proofs
  UNION ALL
  SELECT doc_id, leaf, subroot, root, path, done + 1,
         sha256(CASE path[done + 1].side WHEN 1 THEN coalesce(path[done + 1].h, '') || node
                ELSE node || coalesce(path[done + 1].h, '') END)
  FROM folding WHERE done < len(path)
)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string([s.h FOR s IN path IF s.h IS NOT NULL], '')) AS proof_sha256,
       node AS folded_root, node = root AS verified
FROM folding WHERE done = len(path)
"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, count(*) AS n, {crc32('c')} % 4 AS h, c - c % 20 AS base FROM turns GROUP BY c
), lengths AS (
  SELECT v.*, least(v.h, coalesce(b.n, 0)) AS taken FROM convs v LEFT JOIN convs b ON b.c = v.base
), rebuilt AS (
  SELECT v.c, t.i AS place, t.role, t.text FROM lengths v JOIN turns t ON t.c = v.base AND t.i < v.h
  UNION ALL
  SELECT v.c, t.i - v.h + v.taken, t.role, t.text FROM lengths v JOIN turns t ON t.c = v.c AND t.i >= v.h
), members AS (
  SELECT c, place + 1 AS d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY place)) AS key
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), ends AS (
  SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM members
), nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n, any_value(words) AS words,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM ends GROUP BY d, key
), linked AS (
  SELECT v.*, m.key AS parent FROM nodes v LEFT JOIN members m ON m.c = v.conv_id AND m.d = v.d - 1
), counted AS (
  SELECT v.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM linked k WHERE k.d = v.d + 1 AND k.parent = v.key) AS n_children
  FROM linked v LEFT JOIN nodes p ON p.d = v.d - 1 AND p.key = v.parent
), sums AS (
  SELECT m.d, m.key, sum((n_children = 0)::BIGINT) AS n_leaves, sum((v.n - 1) * v.words) AS saved
  FROM counted v JOIN members m ON m.c = v.conv_id AND m.d <= v.d GROUP BY m.d, m.key
)
SELECT conv_id, v.d::BIGINT AS depth, parent_conv_id, n AS n_convs, n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM counted v JOIN sums s ON s.d = v.d AND s.key = v.key
"""

SUFFIX_DEDUP = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT r, i, substr(h, 2 * i - 1, 2) AS byte,
         CASE WHEN 2 * (i + 199) <= length(h) THEN md5(substr(h, 2 * i - 1, 400)) END AS window_md5
  FROM (SELECT r, h, unnest(range(1, length(h) // 2 + 1)) AS i FROM docs)
), counted AS (
  SELECT r, i, byte, window_md5 IS NOT NULL AND count(*) OVER (PARTITION BY window_md5) > 1 AS again FROM places
), covered AS (
  SELECT r, i, byte, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY r ORDER BY i) > i - 200, false) AS gone
  FROM counted
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS edge FROM covered
), kept AS (
  SELECT r, sum(gone::BIGINT)::BIGINT AS n_removed, sum(edge::BIGINT)::BIGINT AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS rest
  FROM edged GROUP BY r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT r, i, w[i] AS word,
         CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS window_md5
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs)
), counted AS (
  SELECT r, i, word, window_md5 IS NOT NULL AND count(*) OVER (PARTITION BY window_md5) > 1 AS again FROM places
), covered AS (
  SELECT r, i, word, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY r ORDER BY i) > i - 35, false) AS gone
  FROM counted
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS edge FROM covered
), kept AS (
  SELECT r, sum(gone::BIGINT)::BIGINT AS n_removed, sum(edge::BIGINT)::BIGINT AS n_spans,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS rest
  FROM edged GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reached AS (
  SELECT r AS a, r AS b FROM docs
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM reached JOIN docs d ON d.r = reached.a JOIN docs e ON e.r = reached.b LEFT JOIN sizes ON sizes.r = d.r
GROUP BY d.r, d.doc_id
"""

ORACLE_SQL = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op5_chat_format": CHAT_FORMAT,
    "op6_mix_sources": MIX,
    "op7_ngram_jaccard_join": JACCARD_JOIN,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op10_exact_dedup": EXACT_DEDUP,
    "op11_merkle_manifest": MERKLE,
    "op12_conversation_trie": TRIE,
}
