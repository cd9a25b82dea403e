"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
SHINGLES = """CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: hash(array_to_string(words[i:i+4], ' ')))
    WHEN len(words) > 0 THEN [hash(array_to_string(words, ' ') || ' (' || len(words) || ' words)')] ELSE [] END"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS words FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct({SHINGLES})) AS shingles FROM w),
sized AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n, shingles FROM s),
classes AS (SELECT min(doc_id) AS node, shingles, any_value(n) AS n FROM sized WHERE n > 0 GROUP BY shingles),
opened AS (SELECT node, n, unnest(shingles) AS shingle FROM classes),
alike AS (SELECT a.node AS u, b.node AS v FROM opened a JOIN opened b ON a.shingle = b.shingle AND a.node < b.node
          GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM alike UNION ALL SELECT v, u FROM alike),
reach AS (SELECT node AS a, node AS b FROM classes UNION SELECT r.a, l.v FROM reach r JOIN links l ON l.u = r.b),
named AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(m.component, d.doc_id) AS component_id,
       coalesce(m.component, d.doc_id) = d.doc_id AS kept
FROM sized d LEFT JOIN classes c ON d.n > 0 AND c.shingles = d.shingles LEFT JOIN named m ON m.node = c.node"""

URL_VERDICTS = r"""
WITH p AS (SELECT page_id, row_number() OVER () AS r,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^/?#]*(.*)', 1) AS after FROM p),
rules(verdict, h, t) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (SELECT r, arg_max(h || t, length(h || t)) AS rule, arg_max(verdict, length(h || t)) AS verdict
         FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
         WHEN regexp_matches(host, '(?s)(^|\.)m\..*\.example\.net$') THEN 'allow'
         WHEN regexp_matches(host, '(^|\.)example\.net$') AND (regexp_matches(after, '(?is)^/fr/.*\?page=')
              OR regexp_matches(after, '(?is)^[^a-z0-9_.%#-].*\?utm_source=feed$')) THEN 'block'
         WHEN regexp_matches(host || after, '(?is)-x\.example\..*[^a-z0-9_.%-]es/.*\.html$') THEN 'block'
         WHEN regexp_matches(host, '(^|[.-])(cheap-pills|free-bets|online-casino|adult-cams)([.-]|$)') THEN 'block'
         ELSE 'allow' END) AS verdict
FROM q LEFT JOIN best USING (r)"""

TOKEN_ROLLUP = r"""
SELECT source, lang, 'words-2' AS tokenizer, count(*) AS docs,
       CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]'))) AS BIGINT) AS tokens,
       CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars
FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
GROUP BY source, lang"""

BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    16 * CAST(bits[5*i+1] AS INT) + 8 * CAST(bits[5*i+2] AS INT) + 4 * CAST(bits[5*i+3] AS INT)
    + 2 * CAST(bits[5*i+4] AS INT) + CAST(bits[5*i+5] AS INT) AS INT), 1)), '')"""
WARC = f"""
WITH p AS (SELECT page_id, row_number() OVER () AS r, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, r, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS sha FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda j: substr(
        '0000000100100011010001010110011110001001101010111100110111101111',
        4 * (strpos('0123456789abcdef', substr(sha, j, 1)) - 1) + 1, 4)), '') AS bits,
        min(page_id) OVER (PARTITION BY sha) AS first FROM h)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM b"""

DECONTAMINATION = f"""
WITH dw AS (SELECT DISTINCT doc_id, text, {WORDS} AS words FROM documents),
ds AS (SELECT row_number() OVER () AS k, doc_id, len(words) AS n, {SHINGLES} AS shingles FROM dw WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, coalesce(text, '') AS text, {WORDS} AS words FROM benchmark),
bs AS (SELECT row_number() OVER () AS item, item_id, len(words) AS n, {SHINGLES} AS shingles FROM bw WHERE len(words) > 0),
held AS (SELECT item, n, unnest(shingles) AS h, unnest(range(len(shingles))) AS at FROM bs),
items AS (SELECT count(*) AS items, least(8, 1 + CAST(floor(log2(greatest(1, count(*)))) AS INT)) AS unknown FROM bs),
weights AS (SELECT h, greatest(1, least(8, 1 + CAST(floor(log2(any_value(items) / count(DISTINCT item))) AS INT))) AS w
            FROM held, items GROUP BY h),
places AS (SELECT k, n, unnest(shingles) AS h, unnest(range(len(shingles))) AS at FROM ds),
windows AS (SELECT DISTINCT k, greatest(0, least(p.at - b.at, p.n - b.n)) AS first, least(b.n, p.n) AS width
            FROM places p JOIN held b USING (h)),
inside AS (SELECT k, first, width, p.h, count(*) AS tf, coalesce(any_value(w), any_value(unknown)) AS w
           FROM windows JOIN places p USING (k) LEFT JOIN weights USING (h), items
           WHERE p.at >= first AND p.at < first + greatest(1, width - 4) GROUP BY k, first, width, p.h),
totals AS (SELECT k, first, width, sum(tf * w) AS total FROM inside GROUP BY ALL),
ih AS (SELECT item, h, count(*) AS tf, any_value(w) AS w FROM held JOIN weights USING (h) GROUP BY item, h),
it AS (SELECT item, sum(tf * w) AS total FROM ih GROUP BY item),
both_sums AS (SELECT k, first, width, item, sum(ih.w * least(inside.tf, ih.tf)) AS both_sum
              FROM inside JOIN ih USING (h) GROUP BY ALL),
alike AS (SELECT k, first, width, item, both_sum / (t.total + it.total - both_sum) AS similarity
          FROM both_sums JOIN totals t USING (k, first, width) JOIN it USING (item)),
best AS (SELECT *, row_number() OVER (PARTITION BY k, item ORDER BY similarity DESC, first, width DESC) AS place
         FROM alike WHERE similarity >= 0.8)
SELECT doc_id, item_id, CAST(first AS BIGINT) AS start_word, CAST(width AS BIGINT) AS n_words, round(similarity, 9) AS similarity
FROM best JOIN ds USING (k) JOIN bs USING (item) WHERE place = 1"""

# crc32 of the doc_id's digits, bit by bit; the words of planted texts; then pairs of equal
# six-word sequences at one distance, whose islands are the runs of any period.
PERIODIC_RUNS = r"""
WITH b AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
                  list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(CASE WHEN c = '' THEN 0 ELSE ascii(c) END AS BIGINT)) AS codes
           FROM documents),
c AS (SELECT *, xor(4294967295, CASE WHEN doc_id IS NULL THEN 4294967295 ELSE list_reduce(
             list_concat([CAST(4294967295 AS BIGINT)], codes), lambda crc, code: list_reduce(
                 list_concat([xor(crc, code)], CAST(range(8) AS BIGINT[])),
                 lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) END) AS h FROM b),
p AS (SELECT doc_id, r, w0, len(w0) AS n, h, h // 10 AS g FROM c),
e AS (SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w0[1 + CASE
             WHEN i < g % n THEN i ELSE g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) END]) ELSE w0 END AS w FROM p),
grams AS (SELECT r, unnest(range(greatest(n - 5, 0))) AS i,
                 unnest(list_transform(range(greatest(n - 5, 0)), lambda i: hash(array_to_string(w[i + 1 : i + 6], ' ')))) AS k FROM e),
pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.r = b.r AND a.k = b.k AND a.i < b.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 6 + q AS length FROM islands GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
listed AS (SELECT r, count(*) AS n_runs, max_by({'start': start, 'length': length, 'period': period}, [length, -start, -period]) AS best,
                  string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
                  list({'a': start + period, 'z': start + length}) AS dropped FROM runs GROUP BY r),
kept AS (SELECT r, list_transform(list_filter(range(n), lambda i: len(list_filter(dropped, lambda d: i >= d.a AND i < d.z)) = 0), lambda i: w[i + 1]) AS words
         FROM e JOIN listed USING (r))
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string(coalesce(words, w), ' ')) AS collapsed_sha256
FROM e LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""

EXACT_DEDUP = f"""
WITH t AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)"""

ORACLE_SQL = {
    "op2_near_duplicates": NEAR_DUPLICATES,
    "op5_url_verdicts": URL_VERDICTS,
    "op6_token_rollup": TOKEN_ROLLUP,
    "op7_warc_round_trip": WARC,
    "op9_decontamination": DECONTAMINATION,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op12_exact_dedup": EXACT_DEDUP,
}
