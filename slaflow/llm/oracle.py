"""DuckDB SQL for the queries that SQL can express."""


def _url_filter(order: int = 4) -> str:
    """Probabilities by recursion over the length of the context."""
    marked = "[chr(2)] || list_filter(string_split(text, ''), lambda x: x <> '') || [chr(3)]"
    grams = f"""
    SELECT *, array_to_string(c[i:i + k - 1], '') AS gram FROM (
        SELECT *, unnest(generate_series(1, least({order + 1}, len(c) - i + 1))) AS k FROM (
            SELECT *, unnest(generate_series(1, len(c))) AS i FROM (SELECT *, {marked} AS c FROM {{}})))"""
    first = """p1 AS (
    SELECT gram, na, nr, 1::DOUBLE / 1114113 AS qa, 1::DOUBLE / 1114113 AS qr,
           (a + 2::DOUBLE * (1::DOUBLE / 1114113)) / (na + 2) AS pa, (r + 2::DOUBLE * (1::DOUBLE / 1114113)) / (nr + 2) AS pr
    FROM predicted JOIN after USING (context) WHERE length(gram) = 1
)"""
    longer = """p{k} AS (
    SELECT s.gram, after.na, after.nr, q.pa AS qa, q.pr AS qr,
           (s.a + 2 * q.pa) / (after.na + 2) AS pa, (s.r + 2 * q.pr) / (after.nr + 2) AS pr
    FROM predicted s JOIN after USING (context) JOIN p{j} q ON q.gram = substr(s.gram, 2) WHERE length(s.gram) = {k}
)"""
    levels = ", ".join([first, *[longer.format(k=k, j=k - 1) for k in range(2, order + 2)]])
    every = " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(1, order + 2))
    fits = "WHEN (host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}') THEN '{0}{1}'"
    rules = [("example.org", "/en/1"), ("example.org", "/es/"), ("com", "/fr/"), ("com", "/de/"), ("org", "/")]
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return rf"""
WITH page AS MATERIALIZED (
    SELECT row_number() OVER () AS row, page_id, translate(coalesce(url, ''), {upper}) AS text,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {upper}) AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), parsed AS MATERIALIZED (
    SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS action
    FROM (SELECT *, CASE {" ".join(fits.format(*r) for r in rules)} END AS rule FROM page)
), judged AS MATERIALIZED (
    SELECT row_number() OVER () AS row, text, accepted, substr(md5(text), 1, 1) < '4' AS held_out FROM (
        SELECT DISTINCT text, action = 'allow' AS accepted FROM parsed WHERE action IS NOT NULL)
), counted AS MATERIALIZED (
    SELECT gram, context, k, count(*) FILTER (WHERE accepted) AS a, count(*) FILTER (WHERE NOT accepted) AS r
    FROM (SELECT *, gram[1:k - 1] AS context FROM ({grams.format("(SELECT * FROM judged WHERE NOT held_out)")})) GROUP BY gram, context, k
), predicted AS MATERIALIZED (
    SELECT * FROM counted WHERE (a + r) * 40000 >= (SELECT sum(a + r) FROM counted WHERE k = 1) AND gram <> chr(2)
), after AS MATERIALIZED (SELECT context, sum(a) AS na, sum(r) AS nr FROM predicted GROUP BY context
), {levels}
, weight AS MATERIALIZED (
    SELECT gram, sum(CAST(round(1000000 * w) AS BIGINT)) AS weight FROM (
        SELECT gram, (ln(pa) - ln(qa) - ln(2::DOUBLE / (na + 2))) - (ln(pr) - ln(qr) - ln(2::DOUBLE / (nr + 2))) AS w FROM ({every})
        UNION ALL
        SELECT context, ln(2::DOUBLE / (na + 2)) - ln(2::DOUBLE / (nr + 2)) FROM after WHERE context <> '') GROUP BY gram
), base AS (
    SELECT CAST(round(1000000 * ln((coalesce(sum(r), 0) + 2::DOUBLE) / (coalesce(sum(a), 0) + 2))) AS BIGINT) AS base FROM predicted WHERE k = 1
), rated AS MATERIALIZED (
    SELECT row, open, CAST(floor(CAST(coalesce(sum(weight), 0) + (len(c) - 1) * (SELECT base FROM base) AS DOUBLE) / (len(c) - 1)) AS BIGINT) AS score
    FROM ({grams.format("(SELECT row, text, false AS open FROM judged WHERE held_out UNION ALL SELECT row, text, true FROM parsed WHERE action IS NULL)")})
    LEFT JOIN weight USING (gram) GROUP BY row, open, c
), step AS (
    SELECT floor(score / 10000) AS step, count(*) FILTER (WHERE accepted) AS a, count(*) FILTER (WHERE NOT accepted) AS r
    FROM rated JOIN judged USING (row) WHERE NOT open GROUP BY step
), best AS (
    SELECT arg_max(t, (share, -abs(t), t)) AS step FROM (
        SELECT CASE WHEN step <= 0 THEN step WHEN coalesce(lead(step) OVER down < 0, true) THEN 0 ELSE lead(step) OVER down + 1 END AS t, sum(a) OVER down::DOUBLE / sum(a) OVER () + (sum(r) OVER () - sum(r) OVER down)::DOUBLE / sum(r) OVER () AS share,
               sum(a) OVER () > 0 AND sum(r) OVER () > 0 AS two
        FROM step WINDOW down AS (ORDER BY step DESC)) WHERE two
), limits AS (SELECT coalesce(CAST(10000 * (SELECT step FROM best) AS BIGINT), 0) AS threshold
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict,
       score, CASE WHEN action IS NULL THEN threshold END AS threshold
FROM limits, parsed LEFT JOIN (SELECT row, score FROM rated WHERE open) USING (row)
"""


def _vector_codes(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Plain rounds with full scans; each round is an assignment ``a`` and
    the codebooks ``b`` that it leads to."""
    assign = """a{r} AS MATERIALIZED (
    SELECT vec_id, part, min(struct_pack(d := list_sum(list_transform(list_zip(s, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), k := entry)) AS best
    FROM piece JOIN b{r} USING (part) GROUP BY vec_id, part
)"""
    update = """b{n} AS MATERIALIZED (
    SELECT part, entry, coalesce(m, e) AS e FROM b{r} LEFT JOIN (
        SELECT part, entry, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY pos) AS m FROM (
            SELECT part, best.k AS entry, pos, sum(s[pos]) AS total, count(*) AS n
            FROM a{r} JOIN piece USING (vec_id, part), unnest(generate_series(1, len(s))) AS u(pos)
            GROUP BY part, best.k, pos) GROUP BY part, entry) USING (part, entry)
)"""
    steps = [x for r in range(rounds) for x in (assign.format(r=r), update.format(r=r, n=r + 1))] + [assign.format(r=rounds)]
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0
), piece AS MATERIALIZED (
    SELECT vec_id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS s
    FROM kept, range({parts}) AS r(part)
), b0 AS MATERIALIZED (
    SELECT part, entry, s AS e FROM piece JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id)
    WHERE entry < {entries}
), {", ".join(steps)}
, coded AS (
    SELECT vec_id, string_agg(printf('%02x', best.k), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""

ORACLE_SQL = {
    "op2_decontamination": r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 10) AS size,
                 unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p
          FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win
), run AS (
    SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p FROM doc, sizes WHERE len(w) >= size)
), hit AS (SELECT doc_id, p, size, item_id FROM run JOIN win USING (size, words)
), covered AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(generate_series(p, p + size - 1)) AS pos FROM hit) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op6_line_dedup": r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE top IS NOT NULL AND doc_id < top) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(doc_id < top, false)), ''))
           AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
""",
    "op11_url_filter": _url_filter(),
    "op12_importance_resampling": r"""
WITH tab AS (
    SELECT list_transform(range(256), lambda b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), doc AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), own AS MATERIALIZED (SELECT doc_id, unnest(w) AS f FROM doc
), aim AS MATERIALIZED (SELECT unnest(w) AS f FROM item
), hashed AS MATERIALIZED (
    SELECT f, xor(4294967295, list_reduce(
        list_transform(range(len(h) // 2), lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
    FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM own UNION SELECT f FROM aim)), tab
), s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (f) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS t FROM aim JOIN hashed USING (f) GROUP BY bucket
), gain AS MATERIALIZED (
    SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM own) + 10000)
        / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM aim) + 10000)))) AS BIGINT) AS gain
    FROM s FULL JOIN t USING (bucket)
), weighed AS (
    SELECT doc_id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
    FROM own JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id
), noisy AS (
    SELECT doc_id, (CAST(list_reduce(list_transform(string_split(substr(sha256('2024:' || doc_id), 1, 8), ''),
        lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT)), lambda a, b: 16 * a + b) AS BIGINT)) AS h FROM doc
), scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score,
           len(w) >= 20 AS fits
    FROM doc LEFT JOIN weighed USING (doc_id) JOIN noisy USING (doc_id)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN fits AND place <= 10 * (SELECT count(*) FROM scored WHERE fits) // 100 THEN place END AS rank
FROM placed
""",
    "op13_vector_codes": _vector_codes(),
}
