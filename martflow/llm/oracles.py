"""SQL for those numbered queries that SQL can express, written for DuckDB."""

from martflow.llm.quality_rules import CHAR_CLASSES, COMMON_WORDS, Rules, vocabulary

SQL: dict[str, str] = {}

SQL["op6_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS h FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY h, n >= 1000) AS last FROM d
)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

SQL["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> first, false) AS lost FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL["op10_decontaminate"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
  FROM item WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS g FROM starts
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size
), met AS (
  SELECT doc_id, item_id, i, p.size
  FROM (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g FROM places) p
  JOIN windows USING (size, g)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL["op4_near_dup"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM starts
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * met >= 75 * (x.n + y.n - met)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(node, label) AS (
  SELECT doc_id, doc_id FROM size
  UNION
  SELECT b, label FROM reach JOIN edge ON a = node WHERE label < b
), least_id AS (
  SELECT node, min(label) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least_id ON node = doc_id
"""


def _rules() -> str:
    """The rules of ``quality_rules`` with its fixed lists and limits."""
    r = Rules()
    words = ", ".join(f"'{w}'" for w in vocabulary())
    langs = ", ".join(f"'{name}'" for name in COMMON_WORDS)
    chars = ", ".join(
        f"length(regexp_replace(j, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g'))" for pattern in CHAR_CLASSES.values()
    )
    return rf"""
WITH doc AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), joined AS (
  SELECT *, array_to_string(w, '') AS j, CAST(len(w) AS BIGINT) AS n,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM doc
), places AS (
  SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM joined WHERE len(w) >= 3)
), again AS (
  SELECT doc_id, g FROM places GROUP BY doc_id, g HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM places JOIN again USING (doc_id, g)) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, n AS n_words, CAST(length(j) AS BIGINT) AS word_chars, [{chars}] AS c,
         list_transform([{words}], lambda v: len(list_filter(w, lambda x: x = v))) AS k,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM joined LEFT JOIN repeated USING (doc_id)
), based AS (
  SELECT *, c[{list(CHAR_CLASSES).index("symbol") + 1}] AS n_symbols,
         n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed
  FROM counted
), share AS (
  SELECT doc_id, lang, base_failed, part, generate_subscripts(h, 1) AS i,
         round(CAST(unnest(h) AS DOUBLE) * 1000000 / greatest(total, 1)) AS x
  FROM (SELECT doc_id, lang, base_failed, 'chars' AS part, word_chars AS total,
               list_append(c, word_chars - list_sum(c)) AS h FROM based
        UNION ALL
        SELECT doc_id, lang, base_failed, 'words', n_words, list_append(k, n_words - list_sum(k)) FROM based)
), known AS (
  SELECT lang AS known_lang, part, i, sum(x) AS s FROM share
  WHERE lang IN ({langs}) AND NOT base_failed GROUP BY lang, part, i
), reference AS (
  SELECT known_lang, part, i, s / sum(s) OVER (PARTITION BY known_lang, part) AS q FROM known
), far AS (
  SELECT doc_id, part, known_lang, sqrt(greatest(sum(
           CASE WHEN x > 0 THEN x / 1e6 * log2(2 * (x / 1e6) / (x / 1e6 + q)) ELSE 0 END
           + CASE WHEN q > 0 THEN q * log2(2 * q / (x / 1e6 + q)) ELSE 0 END) / 2, 0)) AS d
  FROM share JOIN reference USING (part, i) GROUP BY doc_id, part, known_lang
), nearest AS (
  SELECT doc_id, coalesce(min(d) FILTER (part = 'chars'), 0) AS dc, coalesce(min(d) FILTER (part = 'words'), 0) AS dw
  FROM far GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         (word_chars >= {r.char_guard} AND coalesce(dc, 0) > {r.char_limit})
         OR (n_words >= {r.word_guard} AND coalesce(dw, 0) > {r.word_limit})
         OR (word_chars >= {r.char_guard} AND n_words >= {r.word_guard}
             AND coalesce(dc, 0) > {r.char_near} AND coalesce(dw, 0) > {r.word_near})) AS kept
FROM based LEFT JOIN nearest USING (doc_id)
"""


SQL["op3_quality_rules"] = _rules()

SQL["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS UBIGINT) FOR k IN range(4)] AS r FROM d
), cut AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR r[3] % 100 >= 90 THEN 'plain'
              WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(u[1 : a], ''), '') AS p, coalesce(array_to_string(u[a + 1 : b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1 :], ''), '') AS s
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# crc32 of each distinct word, byte by byte, with the table of its 256 remainders made first.
SQL["op13_resample"] = r"""
WITH remainders AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) x(i)
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), raw AS (
  SELECT doc_id, unnest(w) AS word FROM doc
), wanted AS (
  SELECT unnest(w) AS word FROM item
), word AS (
  SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM raw UNION SELECT word FROM wanted)
), bucketed AS (
  SELECT word, xor(list_reduce([CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT) FOR k IN range(length(x) // 2)],
         lambda c, v: xor(c >> 8, t[CAST(xor(c, v) & 255 AS INTEGER) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM word, remainders
), s AS (
  SELECT bucket, count(*) AS s FROM raw JOIN bucketed USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM wanted JOIN bucketed USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE)
         / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket), totals
), weighed AS (
  SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS total
  FROM raw JOIN bucketed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT)::DOUBLE
              + 0.5) / 4294967296))) AS BIGINT) AS noise
  FROM doc LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT doc_id, n_features, weight, weight + noise AS score,
         CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) END AS place,
         count(*) FILTER (n_features >= 20) OVER () AS eligible
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * eligible // 100 THEN place END AS rank FROM placed
"""
