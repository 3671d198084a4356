"""DuckDB SQL of the dealt operators that SQL can express, written apart from the Spark plans."""

from __future__ import annotations

from corpusmill.llm.licenses import BASE_PHRASES, THRESHOLD, template_words

#: ASCII lower case only, as the contract has it
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_SPACED.format('text')} AS w FROM d),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
ln AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY r),
s AS (SELECT w.r, w.doc_id, len(w.w) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(dup.n_lines, 0) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS capitals
      FROM w LEFT JOIN rep USING (r) LEFT JOIN dup USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, n_repeat_words::BIGINT AS n_repeat_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
       OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * capitals > 4 * word_chars) AS kept
FROM s
"""


def _op2() -> str:
    phrases = "VALUES " + ", ".join(f"({label!r}, {phrase.split()!r})" for phrase, label in BASE_PHRASES)
    templates = "VALUES " + ", ".join(f"({number}, {label!r}, {words!r})" for number, label, words in template_words())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format('t')} AS w FROM d),
p(label, pw) AS ({phrases}),
pl AS (SELECT r, i, label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w), p
       WHERE w[i] = pw[1] AND w[i:i + len(pw) - 1] = pw),
base AS (SELECT r, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS b, list(label) AS ls FROM pl GROUP BY r),
t(k, label, tw) AS ({templates}),
ln AS (SELECT r, list_distinct({_WORDS.format('line')}) AS lw FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM w)),
m AS (SELECT r, label, len(list_intersect(tw, lw)) / len(tw)::DOUBLE AS c FROM ln, t WHERE len(list_intersect(tw, lw)) >= ceil({THRESHOLD} * len(tw) - 1e-9)),
sim AS (SELECT r, max(c) AS c, list(label) AS ls FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(coalesce(base.ls, []))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(sim.ls, [])))), ',') AS labels,
  coalesce(c, 0.0) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN sim USING (r)
"""


OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS ww FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM d),
hit AS (SELECT DISTINCT r, i, item_id, len(ww) AS n FROM pos JOIN win ON w[i] = ww[1] AND w[i + len(ww) - 1] = ww[len(ww)] AND w[i:i + len(ww) - 1] = ww),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""

OP11 = rf"""
WITH p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece
           FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, k, g, count(*) AS n FROM g GROUP BY lang, k, g),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, n AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cut AS (SELECT lang, g, a, j, array_to_string(w[:j], ' ') AS gl, array_to_string(w[j + 1:], ' ') AS gr
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cut.lang, cut.g, a, j, x.n AS l, y.n AS r, ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.g = gl JOIN f y ON y.lang = cut.lang AND y.g = gr),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g, a FROM c WHERE k = 3),
out AS (SELECT DISTINCT low.lang, low.g FROM low JOIN inside i ON i.lang = low.lang AND i.g = low.g WHERE 100 * i.a >= 50 * low.a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank
      FROM low WHERE (lang, g) NOT IN (SELECT lang, g FROM out))
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""

OP12 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_SPACED.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_LOWER)} AS w FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_TERMS.format(_LOWER)} AS w FROM benchmark),
c AS (SELECT count(*) FILTER (len(w) > 0) AS nd, sum(len(w)) AS nl FROM d),
qt AS (SELECT q, t, count(*) AS k FROM (SELECT q, unnest(w) AS t FROM b) GROUP BY q, t),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY r, t),
wt AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
       FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), c),
m AS (SELECT r, doc_id, 25 + ((75 * len(w)::HUGEINT * nd) // nl)::BIGINT AS m FROM d, c WHERE len(w) > 0),
g AS (SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS g FROM tf JOIN wt USING (t) JOIN m USING (r)),
s AS (SELECT q, r, sum(k * g)::BIGINT AS score FROM qt JOIN g USING (t) GROUP BY q, r),
o AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o JOIN b USING (q) WHERE rank <= 10
"""

ORACLES = {"op1_quality_rules": OP1, "op2_license_scans": _op2(), "op8_decontamination": OP8, "op11_collocations": OP11, "op12_setsketch_dedup": OP12, "op13_lexical_search": OP13}
