"""DuckDB SQL with the same results as the queries of the catalog.

Written from the definitions (a position for every token, windows over whole
sources), not from the Spark plans.
"""

from __future__ import annotations

from corpusmill.functions import minhash as mh
from corpusmill.functions.segments import symbol_pattern, training_pattern
from corpusmill.functions.text import CONTROL_PIECES, EOS_ID, FIRST_BYTE_ID, FIRST_MERGE_ID, USER_SYMBOLS
from corpusmill.plans import catalog as c

_DOCS = "docs AS (SELECT lang AS source, doc_id, text FROM documents WHERE text IS NOT NULL AND text <> '')"
_HELD_OUT = f"('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 1000 < {c.EVAL_PER_MILLE}"


def _stream(docs: str = "docs") -> str:
    """Every token of every source with its position; EOS after each document."""
    return f"""
sized AS (SELECT source, doc_id, hex(encode(text)) AS hx, octet_length(encode(text)) AS n FROM {docs}),
placed AS (SELECT *, (sum(n + 1) OVER (PARTITION BY source ORDER BY doc_id) - (n + 1))::BIGINT AS start FROM sized),
spread AS (SELECT source, doc_id, start, unnest(range(n + 1)) AS i, unnest(list_append(regexp_extract_all(hx, '..'), NULL)) AS b FROM placed),
toks AS (SELECT source, doc_id, start + i AS pos, i,
  CASE WHEN b IS NULL THEN {EOS_ID} ELSE ('0x' || b)::INTEGER + {FIRST_BYTE_ID} END AS tok FROM spread)"""


def _blocks(size: int, cap: int | None = None) -> str:
    limit = "" if cap is None else f" WHERE block_id < greatest(1, {-(-cap // size)})"
    return f"""
full_only AS (SELECT source, pos // {size} AS block_id, string_agg(tok::VARCHAR, ',' ORDER BY pos) AS tokens
  FROM toks GROUP BY ALL HAVING count(*) = {size}),
blocks AS (SELECT * FROM full_only{limit})"""


def _numbered(size: int, shard: int = c.SHARD_TOKENS) -> str:
    return f"""
sharded AS (SELECT *, least(block_id, block_id * {size} // {shard}) AS shard_id FROM blocks),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY source, shard_id ORDER BY block_id) - 1)::BIGINT AS block_in_shard FROM sharded)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_BASE = (_DOCS, _stream())
_FEED = (*_BASE, _blocks(c.FEED_BLOCK), _numbered(c.FEED_BLOCK))
_SHARDS = f"""
shards AS (SELECT source, shard_id, count(*) AS n_blocks, (count(*) * {c.FEED_BLOCK})::BIGINT AS n_tokens FROM numbered GROUP BY ALL)"""
_WEIGHTS = "weights(source, weight) AS (VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in c.MIX_WEIGHTS.items()) + ")"
_REPEATS = ", ".join(f"('{k}', {max(1, round(v * 10))})" for k, v in c.MIX_WEIGHTS.items())
_MIX = f"""
reps(source, repeat) AS (VALUES {_REPEATS}),
mix AS (SELECT s.source, shard_id, n_tokens, unnest(range(1, repeat + 1))::INTEGER AS copy FROM shards s JOIN reps USING (source))"""
_EPOCH = f"""
keyed AS (SELECT *, md5('{c.SEED}:{c.EPOCH}:' || source || ':' || shard_id || ':' || copy) AS k FROM mix),
epoch AS (SELECT source, shard_id, copy, n_tokens,
  (row_number() OVER (ORDER BY k, source, shard_id, copy) - 1)::BIGINT AS place,
  (sum(n_tokens) OVER (ORDER BY k, source, shard_id, copy) - n_tokens)::BIGINT AS shard_start FROM keyed)"""

# --- near duplicates ---
_G = ", ".join(f"lead(tok, {i}) OVER w AS t{i}" for i in range(mh.SHINGLE))
_LINEAR = " + ".join(f"{a}::BIGINT * t{i}" for i, a in enumerate(mh.SHINGLE_COEFFICIENTS))
_DEDUP_BASE = (
    *_BASE,
    f"""
full_blocks AS (SELECT source, pos // {c.DEDUP_BLOCK} AS block_id FROM toks GROUP BY ALL HAVING count(*) = {c.DEDUP_BLOCK}),
grams AS (SELECT source, pos // {c.DEDUP_BLOCK} AS block_id, {_G} FROM toks
  WINDOW w AS (PARTITION BY source, pos // {c.DEDUP_BLOCK} ORDER BY pos)),
shingles AS (SELECT DISTINCT g.* FROM grams g SEMI JOIN full_blocks USING (source, block_id) WHERE t{mh.SHINGLE - 1} IS NOT NULL)""",
)
_SIGNATURES = f"""
h1 AS (SELECT source, block_id, ({_LINEAR}) % {mh.PRIME} AS x FROM shingles),
h2 AS (SELECT source, block_id, (xor(x, x >> 15) * {mh.SHINGLE_MIX}) % {mh.PRIME} AS x FROM h1),
h3 AS (SELECT source, block_id, xor(x, x >> 13) AS h FROM h2),
sigs AS (SELECT source, block_id, count(*) AS n_hashes, {", ".join(f"min(({a} * h + {b}) % {mh.PRIME}) AS m{i}" for i, (a, b) in enumerate(zip(mh.PERM_A, mh.PERM_B)))}
  FROM h3 GROUP BY ALL)"""
_RANK = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(sorted(c.SOURCES))) + " END"


def _band(i: int) -> str:
    rows = ", ".join(f"m{j}" for j in range(i * mh.BAND_ROWS, (i + 1) * mh.BAND_ROWS))
    return f"SELECT ord, {i} AS band, concat_ws(',', {rows}) AS k FROM usable"


def _band_rows(min_shingles: int = 1) -> str:
    return f"""
usable AS (SELECT s.*, ({_RANK})::BIGINT * {2**40} + s.block_id AS ord FROM sigs s
  JOIN (SELECT source, block_id, count(*) AS n FROM shingles GROUP BY ALL) USING (source, block_id) WHERE n >= {min_shingles}),
bands AS MATERIALIZED ({" UNION ALL ".join(_band(i) for i in range(mh.BANDS))})"""

# --- vocabulary ---
_LINES = f"""
cut AS (SELECT unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (SELECT '▁' || replace(line, ' ', '▁') AS m FROM cut WHERE line <> '')"""
_PATTERN = training_pattern("re2").replace("'", "''")
_WORDS = f"""
segs AS (SELECT unnest(regexp_extract_all(regexp_replace(m, '{symbol_pattern()}', chr(10), 'g'), '{_PATTERN}')) AS word FROM lines),
words AS (SELECT word, count(*) AS n FROM segs GROUP BY word)"""
_CHARS = f"""
chars AS (SELECT unnest(regexp_extract_all(m, '(?s).')) AS ch FROM lines),
counted AS (SELECT ch, count(*) AS n FROM chars GROUP BY ch),
ordered AS (SELECT ch, n, sum(n) OVER (ORDER BY n DESC, ch) - n AS before, sum(n) OVER () AS everything,
  (row_number() OVER (ORDER BY n DESC, ch) - 1)::BIGINT AS rank FROM counted),
covered AS (SELECT ch, n, rank FROM ordered WHERE before / everything < {c.COVERAGE})"""

# --- byte-pair training and encoding, one merge at a time ---
# A word is its symbols between chr(1) and chr(2); a merge is kept under a negative id.
_TRAINING = f"""
alphabet AS MATERIALIZED (SELECT ch, row_number() OVER (ORDER BY rank) - 1 AS place FROM covered WHERE ch NOT IN (chr(1), chr(2))),
letters AS (SELECT word, n, i, ch, ch IN (SELECT ch FROM alphabet) AS known
  FROM (SELECT word, n, unnest(regexp_extract_all(word, '(?s).')) AS ch, unnest(range(length(word))) AS i FROM words)),
numbered_runs AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY i) AS run FROM letters),
runs AS (SELECT string_agg(chr(1) || ch || chr(2), '' ORDER BY i) AS s, any_value(n) AS n FROM numbered_runs WHERE known GROUP BY word, run),
distinct_runs AS MATERIALIZED (SELECT row_number() OVER () AS id, s, sum(n)::BIGINT AS n FROM runs GROUP BY s),
size AS (SELECT {c.VOCAB_SIZE - FIRST_MERGE_ID} - count(*) AS n FROM alphabet),
training(id, s, n) USING KEY (id) AS (
  SELECT id, s, n FROM distinct_runs
  UNION
  (WITH w AS (SELECT n, string_split(s[2:-2], chr(2) || chr(1)) AS p FROM recurring.training WHERE id > 0),
  best AS (SELECT l, r FROM (SELECT n, p[i] AS l, p[i + 1] AS r FROM (SELECT n, p, unnest(range(1, len(p))) AS i FROM w))
    GROUP BY l, r ORDER BY sum(n) DESC, l || r, l LIMIT 1),
  so_far AS (SELECT count(*) AS steps, count(DISTINCT s) AS pieces FROM recurring.training WHERE id < 0),
  todo AS (SELECT l || r AS piece, steps, chr(1) || l || chr(2) || chr(1) || r || chr(2) AS apart FROM best, so_far
    WHERE pieces < (SELECT n FROM size))
  SELECT id, replace(s, apart, chr(1) || piece || chr(2)), n FROM recurring.training, todo WHERE id > 0 AND contains(s, apart)
  UNION ALL SELECT -1 - steps, piece, 0 FROM todo)),
merges AS MATERIALIZED (SELECT piece, row_number() OVER (ORDER BY step) - 1 AS rank
  FROM (SELECT s AS piece, min(-id) AS step FROM training WHERE id < 0 GROUP BY s)),
vocab AS MATERIALIZED (
  SELECT ({FIRST_MERGE_ID} + rank)::INTEGER AS id, piece, (-rank)::INTEGER AS score, 'merge' AS kind FROM merges
  UNION ALL SELECT ({FIRST_MERGE_ID} + m + place)::INTEGER, ch, (-m - place)::INTEGER, 'char' FROM alphabet, (SELECT count(*) AS m FROM merges))"""
_BPE = ("RECURSIVE " + _DOCS, _LINES, _WORDS, _CHARS, _TRAINING)
_HEAD = " UNION ALL ".join(
    [f"SELECT {i} AS id, '{piece}' AS piece, 0 AS score, 'control' AS kind" for i, piece in enumerate(CONTROL_PIECES)]
    + [f"SELECT {i}, '{piece}', 0, 'user'" for i, piece in enumerate(USER_SYMBOLS, start=len(CONTROL_PIECES))]
    + [f"SELECT ({FIRST_BYTE_ID} + b)::INTEGER, format('<0x{{:02X}}>', b), 0, 'byte' FROM (SELECT unnest(range(256)) AS b)"]
)
_VOCAB = f"SELECT id, piece, score, kind FROM vocab UNION ALL {_HEAD}"
# Every distinct segment by itself: the leftmost pair of lowest id, again and again.
_ENCODED = f"""
parts AS (SELECT source, doc_id, unnest(ps) AS part, unnest(range(len(ps))) AS i FROM (SELECT source, doc_id,
  string_split(regexp_replace('▁' || replace(text, ' ', '▁'), '({symbol_pattern()})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps FROM docs)),
pieces AS MATERIALIZED (SELECT source, doc_id, i, unnest(ss) AS seg, unnest(range(len(ss))) AS j FROM (SELECT source, doc_id, i,
  CASE WHEN part IN {USER_SYMBOLS} THEN [part] ELSE regexp_extract_all(part, '▁*[^▁]+|▁+') END AS ss FROM parts)),
merging(seg, p, step) AS (
  SELECT seg, CASE WHEN seg IN {USER_SYMBOLS} THEN [seg] ELSE regexp_extract_all(seg, '(?s).') END, 0 FROM (SELECT DISTINCT seg FROM pieces)
  UNION ALL
  SELECT seg, p[:k - 1] || [p[k] || p[k + 1]] || p[k + 2:], step + 1 FROM
    (SELECT seg, p, step, k, row_number() OVER (PARTITION BY seg ORDER BY id, k) AS choice FROM
      (SELECT seg, p, step, unnest(range(1, len(p))) AS k FROM merging) JOIN vocab ON piece = p[k] || p[k + 1]) WHERE choice = 1),
ended AS (SELECT seg, arg_max(p, step) AS p FROM merging GROUP BY seg),
symbols(piece, id) AS (VALUES {", ".join(f"('{piece}', {i})" for i, piece in enumerate(USER_SYMBOLS, start=len(CONTROL_PIECES)))}),
coded AS MATERIALIZED (SELECT seg, flatten(list(CASE WHEN coalesce(s.id, v.id) IS NOT NULL THEN [coalesce(s.id, v.id)]
    ELSE list_transform(regexp_extract_all(hex(encode(e.part)), '..'), lambda h: ('0x' || h)::INTEGER + {FIRST_BYTE_ID}) END ORDER BY k)) AS ids
  FROM (SELECT seg, unnest(p) AS part, unnest(range(len(p))) AS k FROM ended) e
  LEFT JOIN symbols s ON s.piece = e.part LEFT JOIN vocab v ON v.piece = e.part GROUP BY seg),
encoded AS MATERIALIZED (SELECT source, doc_id, flatten(list(ids ORDER BY i, j)) AS ids FROM pieces JOIN coded USING (seg) GROUP BY ALL)"""
_ENCODED_TOKENS = f"""
bpe_placed AS (SELECT *, (sum(len(ids) + 1) OVER (PARTITION BY source ORDER BY doc_id) - len(ids) - 1)::BIGINT AS start FROM encoded),
toks AS (SELECT source, start + unnest(range(len(ids) + 1)) AS pos, unnest(list_append(ids, {EOS_ID})) AS tok FROM bpe_placed)"""

# --- evaluation ---
_TRAIN = f"train_docs AS (SELECT * FROM docs WHERE NOT ({_HELD_OUT}))"
_EVAL = f"eval_docs AS (SELECT * FROM docs WHERE {_HELD_OUT})"


def _pairs(name: str, docs: str) -> str:
    body = _stream(docs)
    for cte in ("sized", "placed", "spread", "toks"):
        body = body.replace(f"{cte} AS", f"{cte}_{name} AS").replace(f"FROM {cte}", f"FROM {cte}_{name}")
    return f"""{body},
rows_{name} AS (SELECT source, pos // {c.SEQ_LEN} AS block_id FROM toks_{name} GROUP BY ALL HAVING count(*) = {c.SEQ_LEN}),
pairs_{name} AS (SELECT t.source, t.pos // {c.SEQ_LEN} AS block_id, tok AS prev,
  lead(tok) OVER (PARTITION BY t.source, t.pos // {c.SEQ_LEN} ORDER BY pos) AS next
  FROM toks_{name} t SEMI JOIN rows_{name} r ON r.source = t.source AND r.block_id = t.pos // {c.SEQ_LEN})"""


_EVAL_ROWS = f"""block_id < {c.EVAL_BATCHES * 4} AND least(block_id, block_id * {c.SEQ_LEN} // {c.EVAL_SHARD_TOKENS}) < 5"""
_STEPS = f"""
micro AS (SELECT event_id, event_id // {c.GRAD_ACCUM} + 1 AS step, value / 100 AS loss, ts, user_id / 1e6 AS lr FROM events),
steps AS (SELECT step, sum(loss) / {c.GRAD_ACCUM} AS loss, max(ts) AS ts, arg_max(lr, event_id) AS lr FROM micro
  GROUP BY step HAVING count(*) = {c.GRAD_ACCUM}),
groups AS (SELECT (step + {c.LOG_EVERY - 1}) // {c.LOG_EVERY} AS g, sum(loss) / {c.LOG_EVERY} AS loss, count(*) AS n,
  arg_max(lr, step) AS lr, arg_max(ts, step) AS ended, arg_min(ts, step) AS began FROM steps GROUP BY ALL),
timed AS (SELECT a.*, (epoch_us(a.ended) - epoch_us(coalesce(b.ended, a.began))) / 1e6 AS elapsed
  FROM groups a LEFT JOIN groups b ON b.g = a.g - 1 WHERE a.n = {c.LOG_EVERY})"""

_PACKED = "SELECT source, block_id, tokens FROM blocks"

# The serial rule in rounds over every block (no collapsing): the earliest
# undecided block of all its bands is kept, whoever meets a kept one is flagged.
_GREEDY = """
shared AS MATERIALIZED (SELECT ord, band || ':' || k AS key FROM bands
  SEMI JOIN (SELECT band, k FROM bands GROUP BY ALL HAVING count(*) > 1) s USING (band, k)),
rounds AS (
  SELECT ord, key, NULL::BIGINT AS kept_ord, true AS open FROM shared
  UNION ALL
  SELECT ord, key, kept_ord, kept_ord IS NULL FROM
    (SELECT *, min(key_kept) OVER (PARTITION BY ord) AS kept_ord FROM
      (SELECT *, min(CASE WHEN leads THEN ord END) OVER (PARTITION BY key) AS key_kept FROM
        (SELECT ord, key, bool_and(first) OVER (PARTITION BY ord) AS leads FROM
          (SELECT ord, key, ord = min(ord) OVER (PARTITION BY key) AS first FROM rounds WHERE open))))),
flags AS MATERIALIZED (SELECT DISTINCT ord, kept_ord FROM rounds WHERE NOT open AND kept_ord < ord)"""
_FLAGS = ("RECURSIVE " + _DEDUP_BASE[0], *_DEDUP_BASE[1:], _SIGNATURES, _band_rows(), _GREEDY)
_ORD = f"({_RANK})::BIGINT * {2**40} + block_id"

ORACLES = {
    "scan_source": "SELECT 'en' AS source, doc_id, text FROM documents WHERE lang = 'en' AND text <> ''",
    "scan_json": """
SELECT 'web' AS source, r AS doc_id, text FROM
  (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) WHERE lang <> 'de' AND text <> ''""",
    "corpus_text": _with(_DOCS)
    + "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM docs) GROUP BY line",
    "union_sources": _with(_DOCS) + "SELECT source, doc_id, text FROM docs",
    "non_empty_text": """
SELECT doc_id, (i - 1)::INTEGER AS line_no, parts[i] AS text
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
WHERE parts[i] <> ''""",
    "take_docs": f"""
SELECT source, doc_id, text FROM
  (SELECT lang AS source, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents)
WHERE r <= {c.TAKE_DOCS} AND text <> ''""",
    "split_train_eval": _with(_DOCS)
    + f"SELECT source, doc_id, CASE WHEN {_HELD_OUT} THEN 'eval' ELSE 'train' END AS split FROM docs",
    "tokenizer_sample": _with(_DOCS, "budgets(source, budget) AS (VALUES " + ", ".join(f"('{k}', {int(c.SAMPLE_BYTES * v)})" for k, v in c.WEIGHTS.items()) + ")")
    + """
SELECT source, doc_id, text, bytes_before FROM
  (SELECT *, (sum(octet_length(encode(text))) OVER (PARTITION BY source ORDER BY doc_id) - octet_length(encode(text)))::BIGINT AS bytes_before
   FROM docs) JOIN budgets USING (source)
WHERE bytes_before < greatest(1, budget)""",
    "byte_tokens": _with(*_BASE) + "SELECT doc_id, string_agg(tok::VARCHAR, ',' ORDER BY pos) AS tokens FROM toks WHERE tok <> 2 GROUP BY doc_id",
    "decode_tokens": _with(_DOCS) + "SELECT doc_id, text FROM docs",
    "token_offsets": _with(_DOCS)
    + """
SELECT source, doc_id, octet_length(encode(text))::INTEGER AS n_tokens,
  (sum(octet_length(encode(text)) + 1) OVER (PARTITION BY source ORDER BY doc_id) - octet_length(encode(text)) - 1)::BIGINT AS start FROM docs""",
    "pack_blocks": _with(*_BASE, _blocks(c.PACK_BLOCK)) + _PACKED,
    "cap_tokens": _with(*_BASE, _blocks(c.FEED_BLOCK, c.CAP_TOKENS)) + _PACKED,
    "chop_blocks": _with(*_BASE)
    + f"""
SELECT doc_id, i // {c.FEED_BLOCK} AS block_in_shard, string_agg(tok::VARCHAR, ',' ORDER BY i) AS tokens
FROM toks WHERE tok <> {EOS_ID} GROUP BY ALL HAVING count(*) = {c.FEED_BLOCK}""",
    "shard_index": _with(*_FEED) + "SELECT source, block_id, shard_id, block_in_shard FROM numbered",
    "block_keys": _with(*_FEED)
    + "SELECT source, block_id, source || '/train/shard_' || lpad(shard_id::VARCHAR, 5, '0') || '.bin:' || block_in_shard AS key FROM numbered",
    "tokenize_to_shards": _with(*_BASE, _blocks(c.FEED_BLOCK), _numbered(c.FEED_BLOCK))
    + "SELECT source, 'train' AS split, shard_id, block_in_shard, tokens FROM numbered",
    "shard_roundtrip": _with(*_FEED) + "SELECT source, 'train' AS split, shard_id, block_in_shard, tokens FROM numbered",
    "shard_manifest": _with(*_FEED, _SHARDS) + "SELECT source, 'train' AS split, shard_id, n_tokens FROM shards",
    "shard_report": _with(*_FEED, _SHARDS)
    + "SELECT source, sum(n_blocks)::BIGINT AS n_blocks, sum(n_tokens)::BIGINT AS n_tokens, count(*) AS n_shards FROM shards GROUP BY source",
    "weighted_mix": _with(*_FEED, _SHARDS, _MIX) + "SELECT source, shard_id, copy, n_tokens FROM mix",
    "missing_sources": _with(*_FEED, _WEIGHTS) + "SELECT source, weight FROM weights WHERE source NOT IN (SELECT source FROM numbered)",
    "mix_report": _with(*_FEED, _SHARDS, _MIX, _WEIGHTS)
    + """
SELECT source, weight, count(DISTINCT shard_id) AS n_shards, max(copy) AS repeat,
  round(count(*) / sum(count(*)) OVER (), 9) AS share_shards,
  round(sum(n_tokens) / sum(sum(n_tokens)) OVER (), 9) AS share_tokens
FROM mix JOIN weights USING (source) GROUP BY source, weight""",
    "budget_report": _with(*_FEED, _SHARDS, _WEIGHTS)
    + f"""
SELECT source, weight, {c.STEP_TOKENS}::BIGINT AS tokens_per_step, {c.RUN_TOKENS // c.STEP_TOKENS}::BIGINT AS total_steps,
  floor(weight * {c.RUN_TOKENS})::BIGINT AS needed_tokens, coalesce(have, 0)::BIGINT AS available_tokens,
  coalesce(have, 0) >= floor(weight * {c.RUN_TOKENS}) AS enough
FROM weights LEFT JOIN (SELECT source, sum(n_tokens) AS have FROM shards GROUP BY source) USING (source)""",
    "epoch_order": _with(*_FEED, _SHARDS, _MIX, _EPOCH)
    + f"SELECT {c.EPOCH} AS epoch, place, source, shard_id, copy, n_tokens, shard_start FROM epoch",
    "next_token_labels": _with(*_BASE)
    + f"""
SELECT source, pos // {c.FEED_BLOCK} AS block_id, string_agg(tok::VARCHAR, ',' ORDER BY pos) AS input_ids,
  string_agg(nxt::VARCHAR, ',' ORDER BY pos) AS labels
FROM (SELECT source, pos, tok, lead(tok) OVER (PARTITION BY source ORDER BY pos) AS nxt FROM toks)
GROUP BY ALL HAVING count(nxt) = {c.FEED_BLOCK}""",
    "batch_windows": _with(*_FEED, _SHARDS, _MIX, _EPOCH)
    + f"""
, flat AS (SELECT t.tok, e.shard_start + n.block_in_shard * {c.FEED_BLOCK} + t.pos % {c.FEED_BLOCK} AS pos
  FROM toks t JOIN numbered n ON n.source = t.source AND n.block_id = t.pos // {c.FEED_BLOCK}
  JOIN epoch e ON e.source = n.source AND e.shard_id = n.shard_id),
labelled AS (SELECT pos, tok, lead(tok) OVER (ORDER BY pos) AS nxt FROM flat),
batched AS (SELECT *, pos // {c.SEQ_LEN * c.MICRO_BATCH} AS batch_id FROM labelled),
full_batches AS (SELECT batch_id FROM batched GROUP BY batch_id HAVING count(nxt) = {c.SEQ_LEN * c.MICRO_BATCH})
SELECT batch_id, (pos % {c.SEQ_LEN * c.MICRO_BATCH} // {c.SEQ_LEN})::INTEGER AS row,
  string_agg(tok::VARCHAR, ',' ORDER BY pos) AS input_ids, string_agg(nxt::VARCHAR, ',' ORDER BY pos) AS labels
FROM batched SEMI JOIN full_batches USING (batch_id) GROUP BY ALL""",
    "shingle_counts": _with(*_DEDUP_BASE) + "SELECT source, block_id, count(*)::INTEGER AS n_shingles FROM shingles GROUP BY ALL",
    "minhash_signature": _with(*_DEDUP_BASE, _SIGNATURES)
    + f"SELECT source, block_id, concat_ws(',', {', '.join(f'm{i}' for i in range(mh.NUM_PERM))}) AS signature FROM sigs",
    "lsh_bands": _with(*_DEDUP_BASE, _SIGNATURES, _band_rows(c.MIN_SHINGLES))
    + "SELECT band, count(*) AS n_blocks, min(ord) AS first_ord FROM bands GROUP BY band, k HAVING count(*) > 1",
    "dedup_flags": _with(*_FLAGS) + "SELECT ord, kept_ord FROM flags",
    "dedup_report": _with(*_FLAGS)
    + """
SELECT (SELECT count(*) FROM full_blocks) AS n_blocks, count(*) AS n_duplicates,
  round(count(*) / greatest(1, (SELECT count(*) FROM full_blocks)), 9) AS rate FROM flags""",
    "drop_flagged": _with(*_FLAGS, _blocks(c.DEDUP_BLOCK))
    + f"SELECT source, block_id, tokens FROM blocks WHERE {_ORD} NOT IN (SELECT ord FROM flags)",
    "match_jaccard": _with(*_FLAGS)
    + f"""
, sets AS MATERIALIZED (SELECT {_ORD} AS ord, concat_ws(',', {", ".join(f"t{i}" for i in range(mh.SHINGLE))}) AS gram FROM shingles),
sizes AS (SELECT ord, count(*) AS n FROM sets GROUP BY ord),
common AS (SELECT f.ord, f.kept_ord, count(*) AS n FROM flags f JOIN sets a ON a.ord = f.ord
  JOIN sets b ON b.ord = f.kept_ord AND b.gram = a.gram GROUP BY ALL)
SELECT f.ord, f.kept_ord, round(coalesce(common.n, 0) / (a.n + b.n - coalesce(common.n, 0)), 9) AS jaccard
FROM flags f JOIN sizes a ON a.ord = f.ord JOIN sizes b ON b.ord = f.kept_ord
LEFT JOIN common ON common.ord = f.ord AND common.kept_ord = f.kept_ord""",
    "duplicate_keys": _with(*_FLAGS, _blocks(c.DEDUP_BLOCK), _numbered(c.DEDUP_BLOCK))
    + f"""
SELECT source || '/train/shard_' || lpad(shard_id::VARCHAR, 5, '0') || '.bin:' || block_in_shard AS key
FROM numbered WHERE {_ORD} IN (SELECT ord FROM flags)""",
    "stream_dedup": _with(*_FLAGS) + "SELECT ord, kept_ord FROM flags",
    "word_counts": _with(_DOCS, _LINES, _WORDS) + "SELECT word, n FROM words",
    "char_coverage": _with(_DOCS, _LINES, _CHARS) + "SELECT ch, n, rank FROM covered",
    "pair_counts": _with(_DOCS, _LINES, _WORDS, _CHARS)
    + """
, places AS (SELECT n, regexp_extract_all(word, '(?s).') AS cs, unnest(range(1, length(word))) AS i FROM words)
SELECT cs[i] AS left, cs[i + 1] AS right, sum(n)::BIGINT AS n FROM places
WHERE cs[i] IN (SELECT ch FROM covered) AND cs[i + 1] IN (SELECT ch FROM covered) GROUP BY ALL""",
    "best_pairs": _with(_DOCS, _LINES, _WORDS, _CHARS)
    + f"""
, places AS (SELECT n, regexp_extract_all(word, '(?s).') AS cs, unnest(range(1, length(word))) AS i FROM words),
pairs AS (SELECT cs[i] AS l, cs[i + 1] AS r, sum(n)::BIGINT AS n FROM places
  WHERE cs[i] IN (SELECT ch FROM covered) AND cs[i + 1] IN (SELECT ch FROM covered) GROUP BY ALL)
SELECT l AS left, r AS right, n FROM pairs ORDER BY n DESC, l || r, l LIMIT {c.BEST_PAIRS}""",
    "train_bpe": _with(*_BPE) + "SELECT rank::INTEGER AS rank, piece FROM merges",
    "vocab_table": _with(*_BPE) + _VOCAB,
    "vocab_file": _with(*_BPE) + _VOCAB,
    "bpe_encode": _with(*_BPE, _ENCODED)
    + "SELECT source, doc_id, len(ids)::INTEGER AS n_tokens, array_to_string(ids, ',') AS tokens FROM encoded",
    "bpe_blocks": _with(*_BPE, _ENCODED, _ENCODED_TOKENS, _blocks(c.FEED_BLOCK), _numbered(c.FEED_BLOCK))
    + "SELECT source, 'train' AS split, shard_id, block_in_shard, tokens FROM numbered",
    "bpe_roundtrip": _with(_DOCS) + "SELECT doc_id, text FROM docs",
    "tokenizer_stats": _with(_DOCS)
    + """
SELECT source, count(*) AS n_texts, count(*) AS n_equal, sum(octet_length(encode(text)))::BIGINT AS n_tokens,
  sum(octet_length(encode(text)))::BIGINT AS n_bytes FROM docs GROUP BY source""",
    "eval_limit": _with(_DOCS, _EVAL, _stream("eval_docs"), _blocks(c.SEQ_LEN))
    + f"""
SELECT source, least(block_id, block_id * {c.SEQ_LEN} // {c.EVAL_SHARD_TOKENS}) AS shard_id, block_id FROM blocks WHERE {_EVAL_ROWS}""",
    "bigram_perplexity": _with(_DOCS, _TRAIN, _EVAL, _pairs("t", "train_docs"), _pairs("e", "eval_docs"))
    + f"""
, seen AS (SELECT prev, next, count(*) AS n FROM pairs_t WHERE next IS NOT NULL GROUP BY ALL),
context AS (SELECT prev, sum(n) AS n FROM seen GROUP BY prev),
scored AS (SELECT e.source, -ln((coalesce(s.n, 0) + {c.SMOOTHING}) / (coalesce(x.n, 0) + {c.SMOOTHING * FIRST_MERGE_ID})) AS nll
  FROM pairs_e e LEFT JOIN seen s USING (prev, next) LEFT JOIN context x USING (prev) WHERE next IS NOT NULL)
SELECT source, round(sum(nll), 4) AS total_nll, count(*) AS n_tokens, round(exp(sum(nll) / greatest(1, count(*))), 6) AS perplexity
FROM scored GROUP BY source""",
    "perplexity": """
SELECT event_type, count(*) AS n_tokens, round(exp(sum(value / 100) / greatest(1, count(*))), 6) AS perplexity
FROM events GROUP BY event_type""",
    "eval_report": """
WITH scored AS (SELECT d.source AS task, round(avg(quality), 6) AS a,
  round(avg(1 - toxic), 6) AS b
  FROM documents d LEFT JOIN labels USING (doc_id) GROUP BY d.source)
SELECT task, coalesce(a, b) AS acc, coalesce(format('{:.4f}', coalesce(a, b)), 'N/A') AS shown FROM scored""",
    "metrics_rollup": _with(_STEPS)
    + f"""
SELECT g * {c.LOG_EVERY} AS step, round(loss, 9) AS loss, round(exp(least(loss, 20)), 6) AS ppl, lr,
  (g * {c.LOG_EVERY * c.TOKENS_PER_STEP})::BIGINT AS tokens_seen,
  round(CASE WHEN elapsed < 1e-6 THEN 0 ELSE {c.LOG_EVERY * c.TOKENS_PER_STEP} / elapsed END, 6) AS tok_per_sec FROM timed""",
    "stream_scan": _with(_DOCS) + "SELECT source, doc_id, text FROM docs",
    "stream_pack": _with(*_BASE, _blocks(c.FEED_BLOCK)) + _PACKED,
    "stream_cap": _with(*_BASE, _blocks(c.FEED_BLOCK, c.CAP_TOKENS)) + _PACKED,
    "quality_filter": """
SELECT d.doc_id, d.source, d.n_chars, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE l.quality >= 1""",
    "stream_windows": f"""
WITH n AS (SELECT count(*) AS n FROM events),
e AS (SELECT ts, value / 100 AS loss, least({c.ARRIVALS - 1},
    (event_id + CASE WHEN event_id % {c.LATE_EVERY} = 5 THEN n // 2 ELSE 0 END) * {c.ARRIVALS} // n) AS b FROM events, n),
w AS (SELECT DISTINCT b, max(ts) OVER (ORDER BY b) - INTERVAL '{c.WINDOW_DELAY}' AS mark FROM e),
d AS (SELECT date_trunc('day', ts) AS day, loss, mark FROM e LEFT JOIN w ON w.b = e.b - 2)
SELECT epoch(day)::BIGINT AS window_start, count(*) AS n_steps, round(avg(loss), 9) AS loss, round(exp(least(avg(loss), 20)), 6) AS ppl
FROM d WHERE (mark IS NULL OR day + INTERVAL '1 day' > mark) AND day + INTERVAL '1 day' <= (SELECT max(mark) FROM w) GROUP BY day""",
    "stream_metrics": f"""
SELECT g * {c.LOG_EVERY} AS step, count(*) AS n_steps, round(avg(loss), 9) AS loss, round(exp(least(avg(loss), 20)), 6) AS ppl,
  (g * {c.LOG_EVERY * c.TOKENS_PER_STEP})::BIGINT AS tokens_seen
FROM (SELECT (event_id + {c.LOG_EVERY}) // {c.LOG_EVERY} AS g, value / 100 AS loss FROM events) GROUP BY g""",
}
