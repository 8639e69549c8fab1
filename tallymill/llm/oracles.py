"""DuckDB SQL for the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

_LEAKS = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w FROM benchmark
), held AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), wanted AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT item_id, count(*) AS n_item FROM wanted GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_found
FROM held JOIN wanted USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 75
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS l FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(l[i:i + 2], chr(10))) AS h
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
), later AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1
), covered AS (
  SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest([0, 1, 2]) AS k)
), single AS (
  SELECT doc_id, l[i] AS line, i FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lines)
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n FROM single ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT lines.doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM lines LEFT JOIN kept USING (doc_id)
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) AS n_text,
    length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), chr(10), '')) AS n_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + n_role + 1 + n_text + 8)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

# The apportionment as it is defined: all quotients of all seats are ranked.
# Taken words follow from the choice of blocks that mixing.py documents: its numbers are stated again here.
_MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(text, '')) AS digest, coalesce(('0x' || substr(md5('7-' || doc_id), 1, 8))::BIGINT, -1) AS o
  FROM documents
), totals AS (
  SELECT source, source_size, rank, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, 3.0 * source_size AS cap
  FROM (SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source))
), rounds AS (
  -- What a source would get above its cap is shared again by weight among the others, until none is above.
  SELECT 0 AS round, rank, weight, cap, false AS full_, weight * ((SELECT sum(source_size) FROM totals) / sum(weight) OVER ()) AS target
  FROM totals
  UNION ALL
  SELECT round + 1, rank, weight, cap, full_ OR target > cap,
    CASE WHEN full_ OR target > cap THEN cap ELSE
      weight * (((SELECT sum(source_size) FROM totals) - coalesce(sum(cap) FILTER (full_ OR target > cap) OVER (), 0))
        / sum(weight) FILTER (NOT full_ AND target <= cap) OVER ()) END
  FROM (SELECT *, count_if(target > cap) OVER () AS above FROM rounds) WHERE above > 0
), aims AS (
  SELECT source, source_size, rank, target FROM totals JOIN
    (SELECT rank, target FROM rounds QUALIFY row_number() OVER (PARTITION BY rank ORDER BY round DESC) = 1) USING (rank)
), blocked AS (
  SELECT *, greatest(1, least(128, floor(least(source_size, target) / 128)))::BIGINT AS block,
    greatest(1, least(128, floor(coalesce(min(least(source_size, target)) FILTER (source_size > 0) OVER (), 0) / 128)))::BIGINT AS unit
  FROM aims
), seats AS (SELECT *, round(sum(source_size) OVER () / unit)::BIGINT AS seats FROM blocked),
source_ranked AS (
  SELECT rank, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, target DESC, rank, k) AS place
  FROM (SELECT *, unnest(range(0, (target / unit)::BIGINT + 64)) AS k FROM seats WHERE target > 0)
), source_quota AS (SELECT rank, count(*) FILTER (place <= seats) AS units FROM source_ranked GROUP BY rank),
planned AS (
  SELECT a.*, round(coalesce(units, 0) * unit / block)::BIGINT AS source_quota,
    greatest(1, least(4096, ceil(source_size / 65536)))::BIGINT AS shards
  FROM blocked a LEFT JOIN source_quota USING (rank)
), dealt AS (
  SELECT d.*, rank, source_size, target, source_quota, block, ((o % shards) + shards) % shards AS shard
  FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
), cells AS (
  SELECT rank, shard, sum(size)::BIGINT AS cell_size, first(source_quota) AS source_quota, first(block) AS block
  FROM dealt GROUP BY rank, shard
), cell_ranked AS (
  SELECT rank, shard, source_quota,
    row_number() OVER (PARTITION BY rank ORDER BY cell_size / (2 * k + 1) DESC, cell_size DESC, shard, k) AS place
  FROM (SELECT *, unnest(range(0, 3 * cell_size // block + 64)) AS k FROM cells WHERE cell_size > 0)
), cell_quota AS (SELECT rank, shard, count(*) FILTER (place <= source_quota) AS quota FROM cell_ranked GROUP BY rank, shard),
plan AS (
  SELECT *, quota // blocks AS passes, quota % blocks AS extra, ('0x' || substr(md5('7-' || rank || '-' || shard), 1, 8))::BIGINT % blocks AS start
  FROM (SELECT rank, shard, blocks, least(coalesce(quota, 0), 3 * blocks) AS quota
        FROM (SELECT c.rank, c.shard, quota, greatest(1, ceil(cell_size / block))::BIGINT AS blocks
              FROM cells c LEFT JOIN cell_quota q ON c.rank = q.rank AND c.shard = q.shard))
), spans AS (
  SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY o, doc_id NULLS FIRST, size, digest ROWS UNBOUNDED PRECEDING) AS stop FROM dealt
), parts AS (
  SELECT s.doc_id, s.source, s.size, s.o, source_size, target, passes, blocks, extra, start, stop, block,
    unnest(CASE WHEN size = 0 THEN [NULL] ELSE range(((stop - size) // block)::BIGINT, ((stop - 1) // block)::BIGINT + 1) END) AS b
  FROM spans s JOIN plan USING (rank, shard)
)
SELECT doc_id, size, source_size, target,
  (any_value(passes) * size + coalesce(sum(
    (((b + 1 + start) * extra) // blocks - ((b + start) * extra) // blocks)
    * (least(stop, (b + 1) * block) - greatest(stop - size, b * block))), 0))::BIGINT AS taken
FROM parts GROUP BY doc_id, size, source_size, target, stop
"""

_REPAIR = r"""
WITH RECURSIVE numbers AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
      range(1, 1 + length(hex(encode(name))) // 2), lambda i : ('0x' || substr(hex(encode(name)), 2 * i - 1, 2))::UBIGINT)),
      lambda x, b : list_reduce(list_prepend(xor(x, b), list_transform(range(8), lambda k : 0::UBIGINT)),
        lambda y, k : xor(y >> 1, (y & 1) * 3988292384::UBIGINT))) AS rest
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations)
), kinds AS (
  SELECT *, xor(rest, 4294967295::UBIGINT) % 20 AS kind FROM numbers
), left_over AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM kinds WHERE kind <> 0)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM left_over
), judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
    CASE WHEN bare = '' THEN 1 WHEN again THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following
  FROM ordered
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1) AS blank,
    count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated, max(i) AS n,
    count_if(following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), steps(before, initial, after) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), walks AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said, n FROM figures
  UNION ALL
  SELECT conv_id, i, state, cost, audit, said, n FROM (
    -- Up to two inserts, then the edit of the next row; at the end there is only the former.
    WITH once AS (
      SELECT w.conv_id, w.i, after AS state, cost + 2 AS cost, audit || 'I' AS audit, n,
        list_append(said, CASE s.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END) AS said
      FROM walks w JOIN steps s ON w.state = s.before WHERE s.initial <> 's' AND w.i <= n
    ), twice AS (
      SELECT w.conv_id, w.i, after AS state, cost + 2 AS cost, audit || 'I' AS audit, n,
        list_append(said, CASE s.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END) AS said
      FROM once w JOIN steps s ON w.state = s.before WHERE s.initial <> 's'
    ), ready AS (
      SELECT conv_id, i, state, cost, audit, n, said FROM walks WHERE i <= n
      UNION ALL SELECT conv_id, i, state, cost, audit, n, said FROM once UNION ALL SELECT conv_id, i, state, cost, audit, n, said FROM twice
    ), edited AS (
      SELECT w.conv_id, w.i + 1 AS i, w.state, cost + 3 AS cost, audit || 'D' AS audit, said, n
      FROM ready w WHERE w.i < n
      UNION ALL
      SELECT w.conv_id, w.i + 1, s.after, cost + (CASE WHEN fault = 3 THEN 1 ELSE 0 END), audit || 'K',
        list_append(said, j.role || ':' || j.text), n
      FROM ready w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
        JOIN steps s ON s.before = w.state AND s.initial = j.initial WHERE j.fault NOT IN (1, 2)
      UNION ALL
      SELECT w.conv_id, w.i + 1, s.after, cost + 2 + (CASE WHEN fault = 3 THEN 1 ELSE 0 END), audit || 'R',
        list_append(said, CASE s.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || j.text), n
      FROM ready w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
        JOIN steps s ON s.before = w.state AND s.initial <> 's' WHERE j.fault NOT IN (1, 2)
      UNION ALL
      SELECT conv_id, i + 1, state, cost, audit, said, n FROM ready WHERE i = n
    )
    SELECT * FROM edited QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1
  )
), best AS (
  SELECT conv_id, cost, audit, array_to_string(said, chr(10)) AS said FROM walks WHERE i = n + 1 AND state IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
  LEFT JOIN figures ON figures.conv_id IS NOT DISTINCT FROM every.conv_id
  LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
"""

_SEARCH = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), held AS (
  SELECT doc, doc_id, terms, len(terms)::BIGINT AS n FROM doc_terms WHERE len(terms) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS size FROM held
), counts AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM held) GROUP BY doc, term
), items AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), asked AS (
  SELECT item, item_id, term, count(*)::BIGINT AS times FROM items GROUP BY item, item_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, whole GROUP BY term, docs
), scores AS (
  SELECT item, item_id, doc, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // size))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN held USING (doc), whole
  GROUP BY item, item_id, doc, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_PAGES = r"""
-- The given pages have one article each, of these tags and character references.
WITH marked AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), bare AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') AS t FROM marked
), decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t
  FROM bare
), joined AS (
  SELECT page_id, url, trim(regexp_replace(t, '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""

_VECTORS = r"""
WITH RECURSIVE given AS (
  SELECT vec_id, list_transform(embedding, lambda x : x::DOUBLE) AS v FROM embeddings
), usable AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x : x * x))) AS length FROM given
  WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(v, lambda x : x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.length * b.length) >= 0.9
), reached AS (
  SELECT vec_id AS node, vec_id AS low FROM given WHERE vec_id IS NOT NULL
  UNION
  SELECT b, low FROM reached JOIN links ON a = node
), components AS (SELECT node, min(low) AS low FROM reached GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low AS component_id, coalesce(vec_id = low, false) AS kept
FROM given LEFT JOIN components ON node = vec_id LEFT JOIN counts ON a = vec_id
"""

_JACCARD = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)
), either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS low FROM documents
  UNION
  SELECT b, low FROM reached JOIN either ON a = node
), components AS (SELECT node, min(low) AS low FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN components ON node = d.doc_id
"""

_PASSAGES = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc_words WHERE len(w) >= 50)
), firsts AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h HAVING count(*) > 1),
later AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS previous FROM windows JOIN firsts USING (h) WHERE low < doc_id
), covered AS (
  -- Of each window the words that the one before it does not cover.
  SELECT doc_id, unnest(range(greatest(i, coalesce(previous + 50, i)), i + 50)) AS i FROM later
), words AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept USING (doc_id)
"""

_PERSONAL = r"""
-- Base spans; the contexts of the given texts are random and discover nothing.
WITH texts AS (
  SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents
), kinds(k, kind) AS (
  VALUES (0, 'email'), (1, 'ip'), (2, 'card'), (3, 'phone')
), matched AS (
  SELECT doc, doc_id, 0 AS k, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS found,
    regexp_split_to_array(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS between_ FROM texts
  UNION ALL
  SELECT doc, doc_id, 1, regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
    regexp_split_to_array(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM texts
  UNION ALL
  SELECT doc, doc_id, 2, regexp_extract_all(text, '[0-9](?:[\x20-]?[0-9])+'), regexp_split_to_array(text, '[0-9](?:[\x20-]?[0-9])+') FROM texts
  UNION ALL
  SELECT doc, doc_id, 3, regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), regexp_split_to_array(text, '\+[0-9][\x20().0-9-]+[0-9]') FROM texts
), placed AS (
  SELECT doc, k, found[i] AS match, (list_sum(list_transform(between_[1:i], lambda p : length(p)))
    + coalesce(list_sum(list_transform(found[1:i - 1], lambda p : length(p))), 0))::BIGINT AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matched WHERE len(found) > 0)
), digits AS (
  SELECT *, regexp_replace(match, '[^0-9]', '', 'g') AS d FROM placed
), good AS (
  SELECT doc, k, start, start + length(match) AS stop FROM digits
  WHERE CASE k WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(match, '.'), lambda p : coalesce(TRY_CAST(ltrim('0' || p, '0') AS BIGINT), CASE WHEN ltrim(p, '0') = '' THEN 0 ELSE 999 END) > 255)) = 0
    WHEN 2 THEN length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i :
      CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::BIGINT ELSE (2 * d[i]::BIGINT) % 10 + (2 * d[i]::BIGINT) // 10 END)) % 10 = 0
    ELSE length(d) BETWEEN 8 AND 15 END
), spans AS (
  SELECT doc, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS shown, count_if(k = 0) AS e, count_if(k = 1) AS i,
    count_if(k = 2) AS c, count_if(k = 3) AS p
  FROM good JOIN kinds USING (k) GROUP BY doc
)
SELECT doc_id, coalesce(e, 0)::BIGINT AS n_email, coalesce(i, 0)::BIGINT AS n_ip, coalesce(c, 0)::BIGINT AS n_card,
  coalesce(p, 0)::BIGINT AS n_phone, sha256(coalesce(shown, '')) AS base_sha256, coalesce(shown, '') AS spans, 0::BIGINT AS n_added
FROM texts LEFT JOIN spans USING (doc)
"""

ORACLES = {
    "op1_embedding_dedup": _VECTORS,
    "op2_personal_data": _PERSONAL,
    "op3_benchmark_leaks": _LEAKS,
    "op4_line_dedup": _LINES,
    "op5_jaccard_join": _JACCARD,
    "op6_chat_format": _CHAT,
    "op7_source_mix": _MIX,
    "op8_substring_dedup": _PASSAGES,
    "op9_main_text": _PAGES,
    "op11_conversation_repair": _REPAIR,
    "op12_lexical_search": _SEARCH,
}
