"""DuckDB statements for the queries that SQL can express."""

from tallyspark.llm.licenses import TEMPLATES

# Vector codes: rounds are the same statement over the codebook before.
_ROUNDS = 6
_NEAREST = """
  SELECT row, part, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d
  FROM (SELECT p.row, p.part, c.entry, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d
        FROM place p JOIN book{n} c USING (part, pos) GROUP BY p.row, p.part, c.entry)
  GROUP BY row, part"""
_LEARN = """, near{n} AS ({nearest}
), mean{n} AS (
  SELECT part, entry, pos, (s - ((s % n) + n) % n) // n AS x
  FROM (SELECT part, entry, pos, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n FROM near{n} JOIN place USING (row, part) GROUP BY part, entry, pos)
), book{next} AS (
  SELECT part, entry, pos, CAST(coalesce(m.x, b.x) AS BIGINT) AS x FROM book{n} b LEFT JOIN mean{n} m USING (part, entry, pos)
)"""

ORACLES = {
    "op2_decontaminate": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM benchmark
), phrase AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS width, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS phrase
  FROM item, LATERAL (SELECT unnest(range(1, greatest(len(words) - 10 + 1, 1) + 1)) AS i) WHERE len(words) > 0
), widths AS (SELECT DISTINCT width FROM phrase),
place AS (
  SELECT doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') AS phrase
  FROM doc, widths, LATERAL (SELECT unnest(range(1, len(words) - width + 2)) AS i)
), found AS (SELECT doc_id, item_id, width, i FROM place JOIN phrase USING (width, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit FROM found, LATERAL (SELECT unnest(range(i, i + width)) AS w) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_warc": r"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
coded AS (
  SELECT page_id, html, sha1(html) AS hex FROM page
), first AS (SELECT html, min(page_id) AS first FROM page GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST(concat('0x', substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5)) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded JOIN first USING (html)
""",
    "op8_url_filters": r"""
WITH page AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5('fetch' || page_id), 1, 7) AS BIGINT) % 365 AS INTEGER) AS fetched_at,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?', 1), '/'), lambda x: x <> '') AS parts
  FROM pages
), pattern AS (
  SELECT page_id, fetched_at, 'domain' AS kind, array_to_string(string_split(host, '.')[i:], '.') AS value
  FROM page, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i) WHERE host <> ''
  UNION
  SELECT page_id, fetched_at, 'prefix', host || '/' || array_to_string(parts[1:i], '/')
  FROM page, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) WHERE host <> ''
), listed AS (
  SELECT kind, value, CAST('0x' || substr(md5(kind || ':' || value), 1, 7) AS BIGINT) AS draw
  FROM (SELECT DISTINCT kind, value FROM pattern)
), dated AS (
  SELECT kind, value, DATE '2024-01-01' + CAST((draw // 7) % 365 AS INTEGER) AS added, CAST((draw // 131) % 90 + 1 AS INTEGER) AS stay
  FROM listed WHERE draw % (CASE kind WHEN 'domain' THEN 5 ELSE 17 END) = 0
), change AS (
  SELECT kind, value, added AS changed_at, true AS active FROM dated
  UNION ALL SELECT kind, value, added + stay, false FROM dated
  UNION ALL SELECT kind, value, added + 2 * stay, true FROM dated
), found AS (
  SELECT p.page_id, count(*) AS n_active, min(p.kind || ':' || p.value) AS first_match
  FROM pattern p ASOF JOIN change c ON p.kind = c.kind AND p.value = c.value AND p.fetched_at >= c.changed_at
  WHERE c.active GROUP BY p.page_id
)
SELECT page_id, CAST(fetched_at AS VARCHAR) AS fetched_at, coalesce(n_active, 0) AS n_active, first_match, n_active IS NOT NULL AS blocked
FROM page LEFT JOIN found USING (page_id)
""",
    "op6_licenses": r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), wording AS (
  SELECT number, license, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM (VALUES """
    + ",\n    ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
    + r""") AS t(number, license, text)
), template AS (
  SELECT number, license, list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
  FROM wording
), alike AS (
  -- Wordings of like length (up to the next power of two) are looked for in windows of one size.
  SELECT *, len(shingles) AS n, max(len(shingles)) OVER (PARTITION BY ceil(log2(len(shingles)))) AS longest FROM template
), sized AS (
  SELECT *, greatest(1, longest // 2) AS stride, longest + greatest(1, longest // 2) - 1 AS size FROM alike
), shingled AS (
  SELECT doc_id, list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' ')) AS s
  FROM doc WHERE len(words) > 0
), near AS (
  SELECT doc_id, number FROM (SELECT DISTINCT doc_id, unnest(s) AS x FROM shingled) JOIN (SELECT number, n, unnest(shingles) AS x FROM sized) USING (x)
  GROUP BY doc_id, number, n HAVING 100 * count(*) >= 80 * n
), windowed AS (
  SELECT doc_id, license, shingles, n, list_distinct(s[a + k + 1:a + k + size]) AS own
  FROM near JOIN sized USING (number) JOIN shingled USING (doc_id), LATERAL (SELECT unnest(range(0, len(s), 5040)) AS a),
       LATERAL (SELECT unnest(range(0, least(5040, len(s) - a), stride)) AS k)
)
SELECT doc_id, license, max(len(list_intersect(own, shingles)) / n) AS containment
FROM windowed WHERE 100 * len(list_intersect(own, shingles)) >= 80 * n GROUP BY ALL
""",
    "op7_suffix_array_dedup": r"""
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), place AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS g FROM doc, LATERAL (SELECT unnest(range(0, len(h) // 2 - 49)) AS i)
), hit AS (
  SELECT doc_id, i FROM place JOIN (SELECT g, min(doc_id) AS first FROM place GROUP BY g) USING (g) WHERE first < doc_id
), numbered AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM hit)
), span AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
gap AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM gap JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id)
""",
    "op9_near_duplicates": r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_sort(list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) END AS s
  FROM doc
), same AS (  -- documents of equal sets stand as one
  SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), item AS (SELECT id, n, unnest(s) AS x FROM same),
ranked AS (
  SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY often, x) AS place
  FROM item JOIN (SELECT x, count(*) AS often FROM item GROUP BY x) USING (x)
), first AS (  -- sets alike at 0.8 share one of their rarest n - ceil(0.8 n) + 1 members
  SELECT id, n, x FROM ranked WHERE place <= n - (8 * n + 9) // 10 + 1
), pair AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM first a JOIN first b ON a.x = b.x AND a.id < b.id AND 10 * a.n >= 8 * b.n AND 10 * b.n >= 8 * a.n
), link AS (
  SELECT a, b FROM pair JOIN same l ON l.id = a JOIN same r ON r.id = b
  WHERE 100 * len(list_intersect(l.s, r.s)) >= 80 * (l.n + r.n - len(list_intersect(l.s, r.s)))
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS id, a AS to_id FROM edge UNION SELECT r.id, e.b FROM reach r JOIN edge e ON e.a = r.to_id),
component AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, m.id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, m.id, d.doc_id) AS kept
FROM sets d LEFT JOIN same m ON len(d.s) > 0 AND d.s = m.s LEFT JOIN component c ON c.id = m.id
""",
    "op12_vector_codes": """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), place AS (
  SELECT row, vec_id, i // (n // 8) AS part, i % (n // 8) AS pos, x
  FROM (SELECT row, vec_id, len(v) AS n, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM kept)
), book0 AS (
  SELECT part, row - 1 AS entry, pos, x FROM place WHERE row <= 16
)"""
    + "".join(_LEARN.format(n=n, next=n + 1, nearest=_NEAREST.format(n=n)) for n in range(_ROUNDS))
    + ", last AS ("
    + _NEAREST.format(n=_ROUNDS)
    + """
), code AS (
  SELECT row, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book6) AS codebooks_sha256
FROM kept JOIN code USING (row)
""",
    "op13_fill_in_middle": r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || doc_id) AS hex FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (len(units) + 1) AS first, CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (len(units) + 1) AS second,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM doc
), cut AS (
  SELECT *, array_to_string(units[1:least(first, second)], '') AS prefix,
         array_to_string(units[least(first, second) + 1:greatest(first, second)], '') AS middle,
         array_to_string(units[greatest(first, second) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
""",
}
