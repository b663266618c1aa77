"""DuckDB SQL that says what the queries return that SQL can express."""

#: Bytewise CRC-32: ``crc_table(i, c)``, from the polynomial.
CRC_TABLE = """
crc_bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT i, c FROM crc_bits WHERE k = 8)"""


def crc_of(name: str, keys: str) -> str:
    """CTEs that give ``name(key, crc)`` for the distinct texts ``key`` of ``keys``."""
    return f"""
{name}_steps(key, rest, c) AS (
  SELECT key, hex(encode(key)), 4294967295::BIGINT FROM {keys}
  UNION ALL
  SELECT key, rest[3:], xor(s.c >> 8, t.c)
  FROM {name}_steps s JOIN crc_table t ON t.i = xor(s.c & 255, ('0x' || rest[1:2])::BIGINT)
  WHERE rest <> ''),
{name} AS (SELECT key, xor(c, 4294967295) AS crc FROM {name}_steps WHERE rest = '')"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str, leaves: str) -> str:
    """``name(tree, level, pos, total, digest)``: all nodes, ``name_runs``: the digests of each run."""
    return f"""
{name}(tree, level, pos, total, digest) AS (
  SELECT tree, 0, pos, total, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, (any_value(total) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE total > 1 GROUP BY tree, level, pos // 3),
{name}_runs AS (SELECT tree, level, pos // 3 AS run, any_value(total) AS total, list(digest ORDER BY pos) AS ds
               FROM {name} GROUP BY tree, level, pos // 3)"""


def _climb(name: str, start: str, tree: str) -> str:
    return f"""
{name}(id, tree, level, pos, proof, folded, done) AS (
  SELECT id, tree, 0, pos, proof, folded, total = 1 FROM {start}
  UNION ALL
  SELECT c.id, c.tree, c.level + 1, c.pos // 3,
         c.proof || array_to_string(r.ds[1:c.pos % 3], '') || array_to_string(r.ds[c.pos % 3 + 2:], ''),
         sha256(array_to_string(r.ds[1:c.pos % 3], '') || c.folded || array_to_string(r.ds[c.pos % 3 + 2:], '')),
         r.total <= 3
  FROM {name} c JOIN {tree}_runs r ON r.tree IS NOT DISTINCT FROM c.tree AND r.level = c.level AND r.run = c.pos // 3
  WHERE NOT c.done)"""


MANIFEST = f"""
WITH RECURSIVE {CRC_TABLE},
ids AS (SELECT DISTINCT doc_id::VARCHAR AS key FROM documents WHERE doc_id IS NOT NULL),
{crc_of("crcs", "ids")},
leaves AS (
  SELECT d.doc_id, source AS tree, {_leaf("text")} AS digest,
         CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS checked
  FROM documents d LEFT JOIN crcs ON key = d.doc_id::VARCHAR),
placed AS (
  SELECT *, row_number() OVER () AS id,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS total FROM leaves),
{_tree("low", "placed")},
roots AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS total,
                 digest, tree AS name FROM low WHERE total = 1),
{_tree("high", "roots")},
low_start AS (SELECT id, tree, pos, total, '' AS proof, checked AS folded FROM placed),
{_climb("low_path", "low_start", "low")},
high_start AS (SELECT p.id, r.tree, r.pos, r.total, p.proof, p.folded
               FROM low_path p JOIN roots r ON r.name IS NOT DISTINCT FROM p.tree WHERE p.done),
{_climb("high_path", "high_start", "high")},
top AS (SELECT digest AS root FROM high WHERE total = 1)
SELECT l.doc_id, l.digest AS leaf, r.digest AS subroot, root, sha256(p.proof) AS proof_sha256,
       p.folded AS folded_root, p.folded = root AS verified
FROM placed l JOIN high_path p ON p.id = l.id AND p.done
JOIN roots r ON r.name IS NOT DISTINCT FROM l.tree CROSS JOIN top
"""

NEAR_COPIES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

#: The 64 letters from U+00C0 as single bytes, so that an edit distance of bytes is one of letters.
_SINGLE = ("'" + "".join(map(chr, range(0xC0, 0x100))) + "', '"
           + "".join(map(chr, range(0x21, 0x61))).replace("'", "''") + "'")

VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, doc_id::VARCHAR || ':' || run AS key, count(*) AS n FROM runs
            WHERE length(run) >= 6 GROUP BY ALL),
keys AS (SELECT DISTINCT key FROM counted WHERE doc_id IS NOT NULL),
{crc_of("crcs", "keys")},
words AS (
  SELECT word, sum(n)::BIGINT AS n, translate(word, {_SINGLE}) AS w FROM (
    SELECT CASE WHEN crc % 199 = 0 THEN run[:crc % length(run)] || run[crc % length(run) + 2:] ELSE run END AS word, n
    FROM counted LEFT JOIN crcs USING (key))
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
near AS (
  SELECT a.word, a.n, b.word AS form, b.n AS form_n
  FROM words a JOIN words b ON abs(length(a.w) - length(b.w)) <= 1 AND levenshtein(a.w, b.w) = 1),
best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(f := form, n := form_n), struct_pack(a := -form_n, b := form)) AS x
         FROM near GROUP BY word),
named AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN x.n >= 5 * w.n THEN x.f END AS form,
         CASE WHEN x.n >= 5 * w.n THEN x.n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chase(word, root, form) AS (
  SELECT word, word, form FROM named
  UNION ALL SELECT c.word, n.word, n.form FROM chase c JOIN named n ON n.word = c.form)
SELECT word, named.form, c.root, n, n_near, form_n FROM named JOIN chase c USING (word) WHERE c.form IS NULL
"""

NEAR_DOCUMENTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 10 * count(*) >= 8 * (m.n + n.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = r),
copied AS (SELECT w, count(*) AS copies FROM words WHERE len(w) > 0 GROUP BY w)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(copies, 1) AS copies
FROM (SELECT doc_id, min(r) AS class_id FROM reach GROUP BY doc_id)
JOIN words USING (doc_id) LEFT JOIN copied USING (w)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x) USING (doc_id)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q) AS score,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) AS rank
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
WHERE rank <= 10
"""

#: Every string of 50 bytes (in hex) against the least document that holds it.
SUBSTRINGS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT doc_id, lo, substring(h, 2 * lo + 1, 2 * (500 + 49)) AS part
          FROM texts, unnest(range(0, strlen(h) // 2 - 49, 500)) AS u(lo)),
strings AS (SELECT doc_id, lo + i AS p, substring(part, 2 * i + 1, 100) AS w
            FROM parts, unnest(range(strlen(part) // 2 - 49)) AS u(i)),
least AS (SELECT w, min(doc_id) AS owner FROM strings GROUP BY w HAVING min(doc_id) < max(doc_id)),
marks AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS opens
          FROM strings JOIN least USING (w) WHERE doc_id > owner),
runs AS (SELECT doc_id, p, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marks),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM runs GROUP BY doc_id, run),
sums AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
cuts AS (SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS lo, a AS hi FROM spans
         UNION ALL
         SELECT doc_id, coalesce(max(z), 0), any_value(strlen(h) // 2)
         FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
rest AS (SELECT doc_id, string_agg(substring(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS kept
         FROM texts JOIN cuts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM texts JOIN rest USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
