"""SQL counterparts of the registered queries that SQL can express.

Fingerprints (XXH64), token ids, trained models and seeded shuffles are beyond it, and regular expressions there give no
positions; those queries are tested against plain Python.
"""

from __future__ import annotations

from .decontaminate import SHARE, WINDOW
from .line_dedup import LEAST_CHARS, LEAST_DOCS
from .quality import ALPHA, DELTA, MIN_WORDS
from .spelling import LEAST_LENGTH, LEAST_USES, STRUCK

QUALITY = rf"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
cut AS (
  SELECT *, [array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)] AS windows,
         list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM split
),
placed AS (SELECT doc_id, unnest(windows) AS w, generate_subscripts(windows, 1) AS i FROM cut WHERE len(windows) > len(list_distinct(windows))),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM placed),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY doc_id
),
counted AS (
  SELECT c.doc_id, stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM cut c LEFT JOIN repeats r ON r.doc_id = c.doc_id
),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         [coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0), coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0),
          coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0), coalesce(n_words * 1000 // nullif(word_chars, 0), 0)] AS vals
  FROM counted
),
holdout AS (
  SELECT stratum, vals, quality = 1 AS good
  FROM judged j JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l ON l.doc_id = j.doc_id
  WHERE NOT base_failed
),
cells AS (
  SELECT stratum, rule, vals[rule] AS v, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad
  FROM holdout, range(1, 5) AS rules(rule) GROUP BY ALL
),
reached AS (
  SELECT stratum, rule, v, sum(good) OVER down AS k, sum(bad) OVER down AS b,
         sum(good) OVER (PARTITION BY stratum, rule) AS goods, sum(bad) OVER (PARTITION BY stratum, rule) AS bads
  FROM cells WINDOW down AS (PARTITION BY stratum, rule ORDER BY v DESC)
),
terms AS (
  SELECT n, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA / 4}) + (n - i) * ln(1 - {ALPHA / 4})))
                 OVER (PARTITION BY n ORDER BY i) AS p
  FROM (SELECT DISTINCT goods AS n, unnest(range(0, CAST(least(goods, ceil(goods * {ALPHA / 4})) AS BIGINT) + 1)) AS i FROM reached)
),
most AS (SELECT n, max(i) AS k FROM terms WHERE p <= {DELTA} / (4 * (SELECT count(DISTINCT stratum) FROM holdout)) GROUP BY n),
cutoffs AS (
  SELECT stratum, rule, min(v) AS cutoff FROM reached r JOIN most m ON m.n = r.goods
  WHERE v > 0 AND r.k <= m.k AND b * goods > r.k * bads GROUP BY stratum, rule
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM cutoffs c WHERE c.stratum = j.stratum AND j.vals[c.rule] >= c.cutoff) AS kept
FROM judged j"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS words FROM benchmark),
sized AS (SELECT *, least(len(words), {WINDOW}) AS n FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(words[s : s + n - 1], ' ') AS w
  FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM sized)
),
places AS (
  SELECT doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows))
),
found AS (SELECT doc_id, n, s, item FROM places JOIN windows USING (n, w)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND {SHARE} * coalesce(h.n, 0) >= len(words) AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN held i ON i.doc_id = d.doc_id"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINES = rf"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS k FROM split
),
lost AS (
  SELECT k, max(doc_id) AS keeper FROM (SELECT DISTINCT doc_id, k FROM keyed WHERE length(k) >= {LEAST_CHARS})
  GROUP BY k HAVING count(*) >= {LEAST_DOCS}
)
SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (WHERE doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN lost USING (k) GROUP BY doc_id"""

#: The table of CRC-32 from its polynomial, and a checksum over a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: xor(c // 2, (c % 2) * 3988292384), i) ORDER BY i) AS t FROM range(256) AS r(i)
)"""


def _crc32(data: str) -> str:
    step = "lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce({data}, {step}, 4294967295), 4294967295)"


_BYTES = """flatten(list_transform(string_split({}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
  ELSE [192 + (unicode(c) // 64)::BIGINT, 128 + (unicode(c) % 64)::BIGINT] END))"""

SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {_LOWER}) AS run FROM documents
),
once AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32(_BYTES.format("doc_id || ':' || run"))} AS h FROM once, crc),
struck AS (
  SELECT CASE WHEN h % {STRUCK} = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed
),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM struck WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_USES}
),
cut AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
),
linked AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocabulary v ON v.word = c.rest
  UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocabulary v ON v.word = c.rest
),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS rank
  FROM linked
),
formed AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN (SELECT * FROM best WHERE rank = 1) b ON b.word = v.word
),
chains AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN formed f ON f.word = c.root AND f.form IS NOT NULL
)
SELECT f.word, form, c.root, n, n_near, form_n
FROM formed f JOIN (SELECT word, max_by(root, step) AS root FROM chains GROUP BY word) c ON c.word = f.word"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(f) for f in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _reduced(nodes: str, base: str) -> str:
    """Every level of the trees over ``base`` (g, i, h, n)."""
    return f"""{nodes} AS (
  SELECT g, 0 AS level, i, h, n FROM {base}
  UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8
  FROM {nodes} WHERE n > 1 GROUP BY g, level, i // 8
)"""


def _siblings(name: str, nodes: str) -> str:
    return f"""{name} AS (
  SELECT a.g, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
  FROM {nodes} a JOIN {nodes} b ON a.g = b.g AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL
)"""


MERKLE = rf"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT doc_id, coalesce(':' || lang, '-') AS g, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32(_BYTES.format("doc_id::VARCHAR"))} % 3 = 0 THEN {_leaf(f"translate(text, {_LOWER})")} ELSE {_leaf("text")} END AS copy
  FROM documents, crc
),
leaves AS (
  SELECT doc_id, g, copy, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM docs
),
{_reduced("nodes", "leaves")},
subroots AS (SELECT g AS of, '' AS g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_reduced("tops", "subroots")},
{_siblings("low", "nodes")},
{_siblings("high", "tops")},
climbed AS (
  SELECT doc_id, g, 0 AS level, i, '' AS proof, copy AS got FROM leaves
  UNION ALL
  SELECT c.doc_id, c.g, c.level + 1, c.i // 8, proof || before || after, sha256(before || got || after)
  FROM climbed c JOIN low s ON s.g = c.g AND s.level = c.level AND s.i = c.i
),
grouped AS (SELECT doc_id, g, max_by(proof, level) AS proof, max_by(got, level) AS got FROM climbed GROUP BY doc_id, g),
rooted AS (
  SELECT doc_id, s.of, s.h AS subroot, s.i, 0 AS level, proof, got FROM grouped d JOIN subroots s ON s.of = d.g
  UNION ALL
  SELECT c.doc_id, c.of, c.subroot, c.i // 8, c.level + 1, proof || before || after, sha256(before || got || after)
  FROM rooted c JOIN high s ON s.level = c.level AND s.i = c.i
),
proved AS (SELECT doc_id, subroot, max_by(proof, level) AS proof, max_by(got, level) AS got FROM rooted GROUP BY doc_id, subroot)
SELECT p.doc_id, l.h AS leaf, subroot, root, sha256(proof) AS proof_sha256, got AS folded_root, got = root AS verified
FROM proved p JOIN leaves l ON l.doc_id = p.doc_id, (SELECT h AS root FROM tops WHERE n = 1)"""

ORACLES: dict[str, str] = {
    "op4_quality": QUALITY,
    "op6_decontaminate": DECONTAMINATE,
    "op11_lines": LINES,
    "op12_spelling": SPELLING,
    "op13_merkle": MERKLE,
}
