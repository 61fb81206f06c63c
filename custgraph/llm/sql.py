"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP6 = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':17'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
    FROM documents
), sources AS (
    SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 3.0 END::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, 3 * source_size / weight AS cap,
           (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(weight) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), final AS (
    SELECT arg_min(level, cap) AS level FROM levels WHERE NOT 3 * source_size < level * weight
), targets AS (
    SELECT source, n, source_size, CASE WHEN 3 * source_size < l.level * weight THEN (3 * source_size)::DOUBLE ELSE weight * f.level END AS target
    FROM levels l LEFT JOIN final f ON true
), shares AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM targets
), rests AS (
    SELECT *, target - copies * source_size AS rest,
           CASE WHEN source_size > 0 THEN (target - copies * source_size) / source_size ELSE 0.0 END AS share FROM shares
), ranked AS (
    SELECT s.doc_id, s.size, r.*, CASE WHEN share > 0 THEN (u / (1 - u)) / (share / (1 - share)) END AS rank
    FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
), placed AS (
    SELECT *, floor(ceil(n / 1000) * (rank * (share / (1 - share))) / (1 + rank * (share / (1 - share)))) AS slice FROM ranked
), running AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
           sum(size) OVER (PARTITION BY source, slice) AS words,
           sum(size) OVER (PARTITION BY source ORDER BY slice RANGE UNBOUNDED PRECEDING) AS slice_upto
    FROM placed
), first_pass AS (
    SELECT *, rank IS NOT NULL AND upto <= rest AS fits,
           rank IS NOT NULL AND rest - (slice_upto - words) > 0 AND rest - (slice_upto - words) < words AS at_edge FROM running
), gaps AS (
    SELECT *, rest - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM first_pass
), fills AS (
    SELECT *, sum(CASE WHEN at_edge AND NOT fits AND size <= gap THEN size ELSE 0 END)
        OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) AS filled FROM gaps
)
SELECT doc_id, size, source_size, target,
       ((copies + CASE WHEN fits OR (at_edge AND size <= gap AND filled <= gap) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM fills
"""

OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), texts AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM texts GROUP BY lang
), sized AS (
    SELECT lang, w, unnest(range(1, 5)) AS k FROM texts
), placed AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized
), frequent AS (
    SELECT lang, w[i : i + k - 1] AS p, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, p, f AS a FROM frequent WHERE len(p) > 1
), cuts AS (
    SELECT *, unnest(range(1, len(p))) AS cut FROM candidates
), scored AS (
    SELECT c.lang, c.p, c.a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.p = c.p[1 : cut] JOIN frequent y ON y.lang = c.lang AND y.p = c.p[cut + 1 : len(c.p)]
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), shorter AS (
    SELECT lang, p, a, unnest(range(2, len(p))) AS k FROM candidates
), within AS (
    SELECT lang, p, a, k, unnest(range(1, len(p) - k + 2)) AS i FROM shorter
), longer AS (
    SELECT lang, p[i : i + k - 1] AS p, max(a) AS longest FROM within GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, array_to_string(s.p, ' ')) AS rank
    FROM lowest s LEFT JOIN longer o ON o.lang = s.lang AND o.p = s.p
    WHERE o.longest IS NULL OR 100::HUGEINT * o.longest < 80::HUGEINT * s.a
)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH RECURSIVE table256 AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
        lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS raw FROM documents
), counted AS (
    SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
), coded AS (
    SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM counted
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1 : 2 * i])::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h
    FROM coded, table256
), made AS (
    SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % len(run)] || run[h % len(run) + 2 : len(run)] ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM made WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
    SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words
), cuts AS (
    SELECT word, n, word[1 : i - 1] || word[i + 1 : len(word)] AS less, word[1 : i - 1] || '*' || word[i + 1 : len(word)] AS mask FROM places
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.mask = b.mask AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.less = b.word
), near AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM pairs GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN near USING (word)
), steps AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
), roots AS (
    SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

SQL = {"op6_mix": OP6, "op12_collocations": OP12, "op13_variants": OP13}
