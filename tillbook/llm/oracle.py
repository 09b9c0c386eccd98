"""DuckDB SQL for those queries that SQL can express."""

_OP1 = r"""
WITH word_lists AS (
    SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS row_no,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
    UNION ALL
    SELECT 'b', item_id, row_number() OVER (),
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark),
windows AS (
    SELECT DISTINCT CAST(id AS VARCHAR) AS item, n,
           array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS piece
    FROM (SELECT id, words, least(13, len(words)) AS n,
                 unnest(range(1, len(words) - least(13, len(words)) + 2)) AS pos
          FROM word_lists WHERE kind = 'b' AND len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT row_no, n, pos, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS piece
    FROM (SELECT row_no, words, n, unnest(range(1, len(words) - n + 2)) AS pos
          FROM word_lists JOIN lengths ON len(words) >= n WHERE kind = 'd')),
hits AS (SELECT row_no, n, pos, item FROM places JOIN windows USING (n, piece)),
words_hit AS (
    SELECT row_no, count(DISTINCT word) AS n_hit
    FROM (SELECT row_no, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY row_no),
items_hit AS (
    SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_no, item FROM hits) GROUP BY row_no)
SELECT d.id AS doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM word_lists d LEFT JOIN words_hit USING (row_no) LEFT JOIN items_hit USING (row_no)
WHERE d.kind = 'd'
"""

_OP9 = r"""
WITH sized AS (
    SELECT doc_id, source, text,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source),
weighted AS (
    SELECT source, source_size, CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight,
           CAST(2 * source_size AS DOUBLE) AS cap
    FROM sources),
filled AS (
    SELECT *, sum(cap) OVER up - cap AS clamped, sum(weight) OVER down AS free, row_number() OVER up AS step
    FROM weighted
    WINDOW up AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING),
           down AS (ORDER BY cap / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING)),
water AS (
    SELECT arg_min(level, step) AS level
    FROM (SELECT step, cap / weight AS most,
                 (1.5 * (SELECT sum(source_size) FROM sources) - clamped) / free AS level
          FROM filled)
    WHERE level <= most),
targets AS (
    SELECT source, source_size, least(cap, coalesce(weight * level, cap)) AS target
    FROM weighted, water),
parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
    FROM targets),
ordered AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, size, md5(text), text IS NULL
                              ROWS UNBOUNDED PRECEDING) - size AS before
    FROM sized)
SELECT doc_id, size, source_size, target,
       CAST(size * whole + greatest(0, least(size, floor(target) - whole * source_size - before)) AS BIGINT) AS taken
FROM ordered JOIN parts ON ordered.source IS NOT DISTINCT FROM parts.source
"""

_OP10 = """
WITH vectors AS (
    SELECT row_number() OVER () AS row_no, vec_id, CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
    SELECT q.row_no, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.row_no <> c.row_no
    WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

_OP11 = r"""
WITH doc_terms AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
item_terms AS (
    SELECT row_number() OVER () AS item_no, item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark),
held AS (SELECT row_no, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM doc_terms WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM held),
counted AS (
    SELECT row_no, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT row_no, unnest(terms) AS term FROM held) GROUP BY row_no, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), corpus),
lengths AS (SELECT row_no, doc_id, 75 + (25 * n * big_n) // big_l AS m FROM held, corpus),
asked AS (
    SELECT item_no, term, CAST(count(*) AS BIGINT) AS times
    FROM (SELECT item_no, unnest(terms) AS term FROM item_terms) GROUP BY item_no, term),
scored AS (
    SELECT item_no, row_no, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (row_no)
    GROUP BY item_no, row_no),
ranked AS (
    SELECT item_no, doc_id, score, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scored JOIN lengths USING (row_no) WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM ranked JOIN item_terms USING (item_no) WHERE place <= 20
"""

_OP12 = r"""
WITH RECURSIVE listed AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           CAST(doc_id AS VARCHAR) AS id
    FROM documents),
seeded AS (
    SELECT row_no, doc_id, words, CAST(len(words) AS BIGINT) AS n,
           xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id, ''),
               lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
                                      WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END), 4294967295) AS h
    FROM listed),
shaped AS (
    SELECT row_no, doc_id, words, n, coalesce(h % 10 = 0, false) AND n > 0 AS planted,
           CASE WHEN n > 0 THEN (h // 10) % n END AS a,
           CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p
    FROM seeded),
changed AS (
    SELECT row_no, doc_id, n,
           CASE WHEN planted THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                ELSE words END AS words
    FROM shaped),
placed AS (SELECT row_no, n, unnest(words) AS word, unnest(range(n)) AS place FROM changed),
equal AS (
    SELECT l.row_no, l.place, r.place - l.place AS period
    FROM placed l JOIN placed r ON l.row_no = r.row_no AND l.word = r.word AND r.place > l.place AND 4 * (r.place - l.place) <= l.n),
stretches AS (
    SELECT row_no, period, min(place) AS start, count(*) + period AS length
    FROM (SELECT *, place - row_number() OVER (PARTITION BY row_no, period ORDER BY place) AS island FROM equal)
    GROUP BY row_no, period, island
    HAVING count(*) + period >= greatest(6, 4 * period)),
runs AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        SELECT 1 FROM stretches o WHERE o.row_no = s.row_no AND o.period < s.period AND o.start <= s.start
                                    AND o.start + o.length >= s.start + s.length)),
per_doc AS (
    SELECT row_no, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing,
           arg_min({'start': start, 'length': length, 'period': period}, [-length, start, period]) AS longest
    FROM runs GROUP BY row_no),
dropped AS (
    SELECT DISTINCT row_no, place FROM (SELECT row_no, unnest(range(start + period, start + length)) AS place FROM runs)),
kept AS (
    SELECT row_no, string_agg(word, ' ' ORDER BY place) AS collapsed
    FROM placed ANTI JOIN dropped USING (row_no, place) GROUP BY row_no)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(longest.start AS BIGINT) AS start, CAST(longest.length AS BIGINT) AS length,
       CAST(longest.period AS BIGINT) AS period, CAST(1000 * longest.length // longest.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM changed LEFT JOIN per_doc USING (row_no) LEFT JOIN kept USING (row_no)
"""

ORACLE_SQL: dict[str, str] = {"op1_decontaminate": _OP1, "op9_mix": _OP9, "op10_nearest": _OP10, "op11_ranked_search": _OP11, "op12_runs": _OP12}
