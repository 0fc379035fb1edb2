"""The queries that SQL can express, over the whole tables."""

from croptide.llm.licences import SEPARATORS, TEMPLATES, THRESHOLD

MIXING_SQL = r"""
WITH sized AS (
    SELECT doc_id, source,
           CASE WHEN text IS NULL THEN 0
                ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
    FROM documents),
totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (
        ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS weight FROM totals),
ordered AS (
    SELECT *, source_size / weight AS ratio,
           sum(source_size) OVER () AS everything, sum(weight) OVER () AS weights,
           coalesce(sum(source_size) OVER before, 0) AS size_before,
           coalesce(sum(weight) OVER before, 0) AS weight_before
    FROM weighed
    WINDOW before AS (ORDER BY source_size / weight, source IS NULL, encode(source)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
    SELECT *, (everything - 3 * size_before)::DOUBLE / (weights - weight_before) AS level
    FROM ordered),
targets AS (
    SELECT source, source_size,
           least((source_size * 3)::DOUBLE,
                 coalesce(max(CASE WHEN level * weight <= 3 * source_size THEN level END) OVER ()
                          * weight, (source_size * 3)::DOUBLE)) AS target
    FROM levels),
rated AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
           ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT
               / 4294967296.0::DOUBLE AS draw
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT
           AS taken
FROM rated
"""

EMBEDDING_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
    SELECT a AS vec_id, a AS other FROM pairs
    UNION
    SELECT r.vec_id, p.b FROM reach r JOIN pairs p ON p.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links,
       coalesce(l.component_id, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(l.component_id, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN least l ON l.vec_id = e.vec_id
LEFT JOIN counted c ON c.vec_id = e.vec_id
"""

SUBSTRING_SQL = r"""
WITH split AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
    FROM documents),
windows AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM split),
keyed AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS key FROM windows),
first AS (SELECT key, min(doc_id) AS least FROM keyed GROUP BY key),
gone AS (
    SELECT DISTINCT k.doc_id, k.pos + o AS place
    FROM keyed k JOIN first f ON f.key = k.key, (SELECT unnest(range(0, 13)) AS o)
    WHERE f.least < k.doc_id),
placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split),
marked AS (
    SELECT p.doc_id, p.place, p.word, g.place IS NOT NULL AS removed
    FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place),
counted AS (
    SELECT doc_id, count(*) FILTER (removed) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT removed), '') AS kept
    FROM marked GROUP BY doc_id)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(c.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(c.kept, '')) AS kept_sha256
FROM split s LEFT JOIN counted c ON c.doc_id = s.doc_id
"""

CHAT_SQL = r"""
WITH messages AS (
    SELECT conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') AS speaker,
           coalesce(text, '') AS text
    FROM conversations),
views AS (
    SELECT m.*, p.perspective
    FROM messages m
    JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM messages
          WHERE speaker <> 'system') p ON p.conv_id IS NOT DISTINCT FROM m.conv_id),
named AS (
    SELECT *, CASE WHEN speaker = perspective THEN 'assistant'
                   WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS chat_role,
           CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
    FROM views),
headed AS (
    SELECT *, '<|im_start|>' || chat_role || coalesce(' name=' || name, '') || chr(10) AS head
    FROM named),
shown AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM headed),
placed AS (
    SELECT *, row_number() OVER w - 1 AS position,
           (sum(length(segment)) OVER w)::BIGINT - length(segment) AS start
    FROM shown
    WINDOW w AS (PARTITION BY conv_id, perspective
                 ORDER BY turn NULLS LAST, encode(speaker), encode(text)
                 ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, turn, chat_role, name, segment, position, start,
       CASE WHEN chat_role = 'assistant' THEN start + length(head) END AS mask_start,
       CASE WHEN chat_role = 'assistant' THEN start + length(segment) - 1 END AS mask_end
FROM placed
"""

# The terms of a line, as the operator's docstring says.
_SEPARATORS = SEPARATORS.replace("'", "''")
_TERMS = f"""list_filter(string_split(replace(translate(lower(line), '{_SEPARATORS}',
    '{" " * len(SEPARATORS)}') || ' ', '. ', ' '), ' '), lambda x: x <> '')"""
_TEMPLATES = ", ".join(f"('{name}', {k}, '{line}')" for k, (name, line) in enumerate(TEMPLATES))

LICENCE_SQL = rf"""
WITH files AS (
    SELECT doc_id, text,
           concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'),
                     (doc_id // 100)::VARCHAR) || '/' || doc_id::VARCHAR || '.txt' AS path
    FROM documents),
tv AS (
    SELECT license, statement, term, count(*) AS tf
    FROM (SELECT license, statement, unnest({_TERMS}) AS term
          FROM (VALUES {_TEMPLATES}) AS t(license, statement, line))
    GROUP BY license, statement, term),
parts AS (
    SELECT path, str_split_regex(text, '\r\n|[\n\r]') AS parts FROM files
    WHERE path IS NOT NULL AND text IS NOT NULL),
line_terms AS (
    SELECT path, line_no, unnest(list_distinct({_TERMS})) AS term
    FROM (SELECT path, unnest(parts) AS line, unnest(range(0, len(parts))) AS line_no FROM parts)),
total AS (SELECT count(*) AS n FROM (SELECT DISTINCT path, line_no FROM line_terms)),
idf AS (
    SELECT term, 1 + ln((1.0 + (SELECT n FROM total)) / (1.0 + count(*))) AS idf
    FROM line_terms GROUP BY term),
unseen AS (SELECT 1 + ln(1.0 + (SELECT n FROM total)) AS idf),
side AS (
    SELECT license, statement, tv.term, tf * coalesce(i.idf, (SELECT idf FROM unseen)) AS w
    FROM tv LEFT JOIN idf i ON i.term = tv.term),
sizes AS (SELECT statement, sqrt(sum(w * w)) AS size FROM side GROUP BY statement),
blocks AS (
    SELECT path, line_no, n_lines,
           array_to_string(parts[line_no + 1:line_no + n_lines], ' ') AS line
    FROM (SELECT path, parts, n_lines, unnest(range(0, len(parts) - n_lines + 1)) AS line_no
          FROM parts, (SELECT unnest([1, 2, 3]) AS n_lines))),
tf AS (
    SELECT path, line_no, n_lines, term, count(*)::DOUBLE AS tf
    FROM (SELECT path, line_no, n_lines, unnest({_TERMS}) AS term FROM blocks) GROUP BY ALL),
weighted AS (SELECT tf.* EXCLUDE (tf), tf * idf AS w FROM tf JOIN idf USING (term)),
norms AS (
    SELECT path, line_no, n_lines, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY ALL),
scored AS (
    SELECT path, line_no, n_lines, license,
           sum(a.w * b.w) / any_value(norm) / any_value(size) AS score
    FROM weighted a JOIN side b ON b.term = a.term JOIN norms USING (path, line_no, n_lines)
    JOIN sizes USING (statement)
    GROUP BY path, line_no, n_lines, license, statement HAVING score >= {THRESHOLD}),
own AS (
    SELECT path, first(license ORDER BY round(score, 12) DESC, license, line_no, n_lines)
               AS license,
           max(score) AS score
    FROM scored GROUP BY path),
placed AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS place FROM files),
votes AS (
    SELECT place AS above, o.license, count(*) AS n FROM placed p JOIN own o ON o.path = p.path
    GROUP BY place, o.license),
granted AS (SELECT above, first(license ORDER BY n DESC, license) AS license FROM votes
            GROUP BY above),
above AS (
    SELECT place, array_to_string(string_split(place, '/')[1:k], '/') AS above
    FROM (SELECT DISTINCT place, unnest(range(0, len(string_split(place, '/')) + 1)) AS k
          FROM placed WHERE place IS NOT NULL)),
nearest AS (
    SELECT place, arg_max(g.above, length(g.above)) AS directory,
           arg_max(g.license, length(g.above)) AS license
    FROM above a JOIN granted g ON g.above = a.above GROUP BY place)
SELECT p.doc_id, p.path, coalesce(o.license, n.license) AS license, round(o.score, 9) AS score,
       CASE WHEN o.path IS NOT NULL THEN 'own' WHEN n.place IS NOT NULL THEN 'inherited'
            ELSE 'none' END AS origin,
       CASE WHEN o.path IS NULL THEN n.directory END AS directory
FROM placed p LEFT JOIN own o ON o.path = p.path LEFT JOIN nearest n ON n.place = p.place
"""

QUALITY_SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT id, words[pos:pos + 2] AS w, pos
    FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS pos FROM split)),
again AS (
    SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY id, w) AS n FROM windows)
    WHERE n > 1),
covered AS (
    SELECT id, count(DISTINCT pos + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k)
    GROUP BY id),
measured AS (
    SELECT s.*, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM split s LEFT JOIN covered c USING (id)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           word_chars < 2 * n_words OR word_chars > 15 * n_words
           OR 10 * n_symbols > n_words
           OR 10 * n_dup_lines > 3 * len(lines)
           OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > len(regexp_extract_all(text, '\p{L}'))
           OR 5 * len(list_filter(words, lambda x: NOT regexp_matches(x, '\p{L}'))) > n_words
           OR 10 * len(regexp_extract_all(text, '\p{N}')) > 3 * word_chars
           OR len(list_filter(words, lambda x: length(x) > 200)) > 0
           OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•‣◦]')))
              > 9 * len(lines)
           OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$')))
              > 3 * len(lines) AS rejected
    FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged
"""

#: CRC-32 by its definition, bit by bit, over the characters of the decimal id.
TRIE_SQL = r"""
WITH convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda s, b: list_reduce(
                   list_prepend(xor(s, b), list_transform(range(8), lambda i: 0::BIGINT)),
                   lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT)
                                     ELSE x // 2 END)),
               4294967295::BIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, coalesce(role, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
    SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
prefixed AS (
    SELECT conv_id, row_number() OVER w AS depth, text,
           list({'role': role, 'text': text}) OVER w AS prefix
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL
    SELECT conv_id, 0, '', [] FROM convs),
passed AS (
    SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           min(conv_id) OVER (PARTITION BY depth, prefix) AS rep,
           count(*) OVER (PARTITION BY depth, prefix) AS n_convs,
           max(depth) OVER (PARTITION BY conv_id) AS last
    FROM prefixed),
nodes AS (
    SELECT p.conv_id, p.depth, q.rep AS parent_conv_id, p.n_convs,
           (p.n_convs - 1) * p.words AS saved
    FROM passed p LEFT JOIN passed q ON q.conv_id = p.conv_id AND q.depth = p.depth - 1
    WHERE p.rep = p.conv_id),
children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM nodes
    WHERE parent_conv_id IS NOT NULL GROUP BY ALL),
weighed AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children
    FROM nodes n LEFT JOIN children c USING (conv_id, depth)),
totals AS (
    SELECT a.rep AS conv_id, a.depth, sum((w.n_children = 0)::BIGINT) AS n_leaves,
           sum(w.saved) AS saved_tokens
    FROM weighed w JOIN passed a ON a.conv_id = w.conv_id AND a.depth <= w.depth GROUP BY ALL),
ends AS (
    SELECT rep AS conv_id, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM passed WHERE depth = last GROUP BY ALL)
SELECT w.conv_id, w.depth::BIGINT AS depth, w.parent_conv_id, w.n_convs::BIGINT AS n_convs,
       w.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM weighed w JOIN totals t USING (conv_id, depth) LEFT JOIN ends e USING (conv_id, depth)
"""
