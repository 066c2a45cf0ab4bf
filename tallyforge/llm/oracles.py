"""SQL counterparts of this subpackage's queries, for another engine."""

from __future__ import annotations

from tallyforge.llm import mixing, packing, quality, sharding

_SHARDS, _SIZE = len(sharding.SHARDS), sharding.TABLE_SIZE

# One row per claim of a slot; the state of the fill travels in two lists.
SHARDING = f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range({_SHARDS}) t(i)
), orders AS (
  SELECT list((('0x' || substr(md5('start:' || name), 1, 8))::BIGINT) % {_SIZE} ORDER BY i) AS start,
         list((('0x' || substr(md5('step:' || name), 1, 8))::BIGINT) % ({_SIZE} - 1) + 1 ORDER BY i) AS step
  FROM shards
), fill AS (
  SELECT 0 AS turn, list_transform(range({_SIZE}), lambda x: -1::BIGINT) AS owner, -1::BIGINT AS slot
  UNION ALL
  SELECT turn + 1,
         owner[:claimed] || [(turn % {_SHARDS})::BIGINT] || owner[claimed + 2:],
         claimed
  FROM (
    SELECT turn, owner,
           list_filter(list_transform(range({_SIZE}),
             lambda j: (start[turn % {_SHARDS} + 1] + j * step[turn % {_SHARDS} + 1]) % {_SIZE}),
             lambda s: owner[s + 1] < 0)[1] AS claimed
    FROM fill, orders WHERE turn < {_SIZE}
  )
), owned AS (
  SELECT unnest(range({_SIZE})) AS slot, unnest(owner) AS i FROM fill WHERE turn = {_SIZE}
)
SELECT doc_id, source, slot::INTEGER AS slot, name AS shard
FROM (SELECT doc_id, source,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {_SIZE} AS slot FROM documents)
JOIN owned USING (slot) JOIN shards USING (i)
"""

# Base32 takes five bits a character: four characters from every five hexadecimal digits.
_BASE32 = "\n    || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1, {at}, 5))::BIGINT >> {shift}) & 31)::INTEGER + 1, 1)"
    for at in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)
WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha1 FROM pages
), typed AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS response_id FROM payloads
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to
FROM typed
"""

_STOP = ", ".join("'" + word + "'" for word in dict.fromkeys(quality.STOP_WORDS))
QUALITY = f"""
WITH texts AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT nr, doc_id, text,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts
), starts AS (
  SELECT nr, unnest(range(1, len(words) - 1)) AS pos,
    unnest(list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS win
  FROM split WHERE len(words) >= 3
), repeated AS (
  SELECT nr, pos FROM starts QUALIFY count(*) OVER (PARTITION BY nr, win) > 1
), covered AS (
  SELECT nr, count(DISTINCT pos + k) AS n FROM repeated, range(3) t(k) GROUP BY nr
), counts AS (
  SELECT doc_id, len(words) AS n_words,
    length(list_aggregate(words, 'string_agg', '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    length(text) - length(replace(text, '!', '')) AS n_exclamations,
    len(list_filter(words, lambda w: lower(w) IN ({_STOP}))) AS n_stop_words,
    len(list_filter(lines, lambda l: l LIKE '%...' OR l LIKE '%…')) AS n_ellipsis_lines,
    len(list_filter(lines, lambda l: regexp_matches(l, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS n_bullet_lines
  FROM split LEFT JOIN covered USING (nr)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 3 AND 10 AND n_symbols / n_words <= 0.1
    AND n_exclamations / n_words <= 0.5 AND n_stop_words / n_words >= 0.05
    AND n_dup_lines / greatest(n_lines, 1) <= 0.4 AND n_ellipsis_lines / greatest(n_lines, 1) <= 0.5
    AND n_bullet_lines / greatest(n_lines, 1) <= 0.9 AS kept
FROM judged
"""

PACKING = f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '')) AS n FROM documents
), cut AS (
  SELECT doc_id, piece, least(n - piece * {packing.MAX_TOKENS}, {packing.MAX_TOKENS}) AS n_tokens
  FROM (SELECT doc_id, n, unnest(range(greatest(1, (n + {packing.MAX_TOKENS} - 1) // {packing.MAX_TOKENS}))) AS piece
        FROM counted)
), ends AS (
  SELECT row_number() OVER (ORDER BY len) AS j, len, sum(c) OVER (ORDER BY len) AS upto
  FROM (SELECT greatest(n_tokens, 1) AS len, count(*) AS c FROM cut GROUP BY 1)
), best AS (
  SELECT 1 AS k, j, (len * upto)::HUGEINT AS size, [len] AS path FROM ends
  UNION ALL
  SELECT k + 1, e.j, min(best.size + e.len * (e.upto - p.upto))::HUGEINT,
    arg_min(list_append(best.path, e.len), row(best.size + e.len * (e.upto - p.upto), p.j))
  FROM best JOIN ends p ON p.j = best.j JOIN ends e ON e.j > p.j
  WHERE k < {packing.BUCKETS} GROUP BY k, e.j
), buckets AS (
  SELECT unnest(path) AS bucket_length, unnest(range(len(path))) AS bucket
  FROM (SELECT path FROM best WHERE j = (SELECT max(j) FROM ends) ORDER BY k DESC LIMIT 1)
), placed AS (
  SELECT doc_id, piece, n_tokens, min(bucket) AS bucket, min(bucket_length) AS bucket_length
  FROM (SELECT row_number() OVER () AS nr, * FROM cut) JOIN buckets ON greatest(n_tokens, 1) <= bucket_length
  GROUP BY nr, doc_id, piece, n_tokens
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bucket
      ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, piece, n_tokens) - 1 AS rank,
    greatest(1, {packing.TOKEN_BUDGET} // bucket_length) AS rows
  FROM placed
)
SELECT doc_id, piece::BIGINT AS piece, n_tokens::BIGINT AS n_tokens, bucket::INTEGER AS bucket,
  bucket_length::BIGINT AS bucket_length, (rank // rows)::BIGINT AS batch, (rank % rows)::BIGINT AS position,
  (bucket_length - n_tokens)::BIGINT AS padding
FROM numbered
"""

_UNITS = [*mixing.TARGET_UNITS.values(), mixing.OTHER_UNITS]
_POOLS = ", ".join(f"'{name}'" for name in [*mixing.TARGET_UNITS, mixing.OTHER])
_EACH = f"range(1, {len(_UNITS) + 1})"
# One row per slot; the lists hold, per pool, the blocks had in this phase, still to come, and had in all.
MIXING = f"""
WITH RECURSIVE pooled AS (
  SELECT doc_id, source, coalesce(list_position([{_POOLS}], source), {len(_UNITS)}) AS pool FROM documents
), ranks AS (
  SELECT *, row_number() OVER (PARTITION BY pool
    ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, source) - 1 AS rank FROM pooled
), sizes AS (
  SELECT list(coalesce(n, 0)::BIGINT ORDER BY i) AS blocks
  FROM (SELECT unnest({_EACH}) AS i)
  LEFT JOIN (SELECT pool AS i, (count(*) + {mixing.BLOCK_ROWS - 1}) // {mixing.BLOCK_ROWS} AS n
             FROM pooled GROUP BY pool) USING (i)
), state AS (
  SELECT 0::BIGINT AS slot, 0::BIGINT AS slot0, list_transform({_EACH}, lambda i: 0::BIGINT) AS had, blocks AS todo,
    list_transform({_EACH}, lambda i: 0::BIGINT) AS done,
    NULL::BIGINT AS pool, NULL::BIGINT AS block, NULL::BIGINT AS release, NULL::BIGINT AS deadline
  FROM sizes
  UNION ALL
  SELECT slot + 1, CASE WHEN todo[pick] = 1 THEN slot + 1 ELSE slot0 END,
    CASE WHEN todo[pick] = 1 THEN list_transform({_EACH}, lambda i: 0::BIGINT)
         ELSE list_transform({_EACH}, lambda i: had[i] + (i = pick)::BIGINT) END,
    list_transform({_EACH}, lambda i: todo[i] - (i = pick)::BIGINT),
    list_transform({_EACH}, lambda i: done[i] + (i = pick)::BIGINT),
    pick, done[pick], slot0 + had[pick] * period // units[pick],
    slot0 + ((had[pick] + 1) * period + units[pick] - 1) // units[pick]
  FROM (
    SELECT *, list_min(list_transform(list_filter({_EACH},
        lambda i: todo[i] > 0 AND had[i] * period // units[i] <= slot - slot0),
        lambda i: ((had[i] + 1) * period + units[i] - 1) // units[i] * 1000 + i)) % 1000 AS pick
    FROM (
      SELECT *, list_sum(list_transform({_EACH}, lambda i: units[i] * (todo[i] > 0)::BIGINT))::BIGINT AS period
      FROM (SELECT slot, slot0, had, todo, done, {_UNITS}::BIGINT[] AS units FROM state WHERE list_max(todo) > 0)
    )
  )
)
SELECT doc_id, source, [{_POOLS}][r.pool] AS pool, s.block, s.release, s.deadline, s.slot - 1 AS slot,
  (rank % {mixing.BLOCK_ROWS})::INTEGER AS place
FROM ranks r JOIN state s ON s.pool = r.pool AND s.block = rank // {mixing.BLOCK_ROWS}
"""

# Exact: every pair that shares a shingle is counted on full sets; components by repeated minima.
NEAR_DUPLICATES = """
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS nr, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT nr, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
  FROM texts
), classes AS (
  SELECT list_sort(shingles) AS shingles, min(doc_id) AS node FROM sets WHERE len(shingles) > 0 GROUP BY 1
), items AS (
  SELECT node, len(shingles) AS n, unnest(shingles) AS s FROM classes
), pairs AS (
  SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.s = b.s AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT node, node AS other FROM classes
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
), component AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(component, s.doc_id) AS component_id,
  s.doc_id = coalesce(component, s.doc_id) AS kept
FROM sets s
LEFT JOIN classes c ON list_sort(s.shingles) = c.shingles
LEFT JOIN component USING (node)
"""

# A lane is the number of paragraphs whose digest has its bit, modulo 2^19; three lanes make a long.
_DOT = "list_sum(list_transform(range(1, 181), lambda i: {0}[i] * {1}[i]))::BIGINT"
_NEAR = (
    "CASE WHEN {0}.n = {1}.n AND {0}.lanes = {1}.lanes THEN 1.0 WHEN " + _DOT.format("{0}.signed", "{1}.signed")
    + " <= 0 THEN 0.0 ELSE round(least(" + _DOT.format("{0}.signed", "{1}.signed") + " / ("
    + _DOT.format("{0}.signed", "{0}.signed") + " + " + _DOT.format("{1}.signed", "{1}.signed") + " - "
    + _DOT.format("{0}.signed", "{1}.signed") + "), 1.0), 6) END::DOUBLE"
)
FINGERPRINTS = f"""
WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS nr, doc_id, text
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), paired AS (
  SELECT a.*, b.nr AS next_nr, b.text AS next_text
  FROM texts a JOIN texts b ON b.nr = a.nr % (SELECT count(*) FROM texts) + 1
), edits AS (
  SELECT nr, doc_id, text, next_nr,
    substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited
  FROM paired
), both_kinds AS (
  SELECT nr, 0 AS kind, text AS body FROM edits UNION ALL SELECT nr, 1, edited FROM edits
), units AS (
  SELECT nr, kind, sha256(unit) AS h
  FROM (SELECT nr, kind, unnest(string_split(regexp_replace(body, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))) AS unit
        FROM both_kinds)
  WHERE trim(unit, ' ') <> ''
), counts AS (
  SELECT nr, kind, g, count(*) AS n, [sum(('0x' || substr(h, (15 * (g // 20) + 1)::INTEGER, 15))::BIGINT >> (g % 20 + 20 * 0) & 1),
    sum(('0x' || substr(h, (15 * (g // 20) + 1)::INTEGER, 15))::BIGINT >> (g % 20 + 20 * 1) & 1),
    sum(('0x' || substr(h, (15 * (g // 20) + 1)::INTEGER, 15))::BIGINT >> (g % 20 + 20 * 2) & 1)] AS ones
  FROM units, range(60) t(g) GROUP BY nr, kind, g
), found AS (
  SELECT nr, kind, any_value(n) AS n, flatten(list(list_transform(ones, lambda c: c::BIGINT) ORDER BY g)) AS lanes
  FROM counts GROUP BY nr, kind
), prints AS (
  SELECT nr, kind, coalesce(n, 0) AS n, coalesce(lanes, list_transform(range(180), lambda i: 0::BIGINT)) AS lanes
  FROM both_kinds LEFT JOIN found USING (nr, kind)
), signed AS (
  SELECT *, list_transform(lanes, lambda c: 2 * c - n) AS signed,
    n::VARCHAR || ':' || array_to_string(list_transform(range(60), lambda g: to_hex((lanes[3 * g + 1] % 524288)
      + ((lanes[3 * g + 2] % 524288) << 20) + ((lanes[3 * g + 3] % 524288) << 40))), '.') AS print
  FROM prints
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
  own.print AS fingerprint, ed.print AS edited_fingerprint,
  {_NEAR.format("own", "ed")} AS near_edited, {_NEAR.format("own", "nxt")} AS near_next
FROM edits
JOIN signed own ON own.nr = edits.nr AND own.kind = 0
JOIN signed ed ON ed.nr = edits.nr AND ed.kind = 1
JOIN signed nxt ON nxt.nr = edits.next_nr AND nxt.kind = 0
"""

NEGATIVES = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), anchors AS (
  SELECT * FROM usable WHERE vec_id % 100 = 0
), products AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    list_dot_product(a.v, r.v)::BIGINT AS score
  FROM anchors a JOIN usable r ON r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM products WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.other_id))::INTEGER AS rank,
  n.other_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN products n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {
    "op1_sharding": SHARDING,
    "op2_warc": WARC,
    "op4_quality": QUALITY,
    "op7_packing": PACKING,
    "op8_mixing": MIXING,
    "op9_fingerprints": FINGERPRINTS,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_hard_negatives": NEGATIVES,
}
