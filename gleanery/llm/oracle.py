"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

from gleanery.llm.licenses import TEMPLATES, THRESHOLD, template_rows

#: Words of whole texts, as they are, and of texts with A-Z lower-cased.
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, source, len({_SPACED})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
w AS (SELECT *, CASE n % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
      FROM w WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(max(level) OVER () * weight, (3 * source_size)::DOUBLE) AS target FROM l),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d)
SELECT doc_id, size, source_size, target,
       (floor(least(size::DOUBLE, greatest(0.0, target - start)))
        + floor(least(size::DOUBLE, greatest(0.0, target - (start + source_size))))
        + floor(least(size::DOUBLE, greatest(0.0, target - (start + 2 * source_size)))))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SPACED} AS w FROM documents),
v AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
k AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM v),
n AS (SELECT r, i, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS LAST, r, i) AS n FROM k),
gone AS (SELECT r, j FROM (SELECT r, unnest(range(i, i + 20)) AS j FROM n WHERE n > 1) GROUP BY r, j),
every AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n FROM every ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_ALNUM} AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w
       FROM b WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS k FROM bw),
widths AS (SELECT DISTINCT size FROM item_windows),
dw AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, widths WHERE len(w) >= size),
hits AS (SELECT r, i, dw.size, item_id FROM dw JOIN item_windows v
         ON v.size = dw.size AND v.k = array_to_string(w[i:i + dw.size - 1], ' ')),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS j FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""



def _list(values, kind: str = "VARCHAR") -> str:
    return f"[{', '.join(repr(v) if isinstance(v, str) else _list(v) for v in values)}]::{kind}[]"


_TEMPLATES = ", ".join(
    f"({i}, '{label}', {_list(words)}, {need}, {span}, {_list(exact)}, {_list(own, 'VARCHAR[]')}, {_list(wider, 'VARCHAR[]')})"
    for i, label, words, need, span, exact, own, wider in template_rows(TEMPLATES, THRESHOLD)
)
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
t(template, label, words, need, span, exact, own, wider) AS (VALUES {_TEMPLATES}),
near AS (SELECT r, w, t.* FROM d, t WHERE len(list_intersect(w, words)) >= need),
runs AS (SELECT *, unnest(range(1, greatest(len(w) - span + 1, 1) + 1)) AS i FROM near),
x AS (SELECT r, label, words, need, exact, own, wider, w[i:i + span - 1] AS run FROM runs),
y AS (SELECT *, [run[j] || ' ' || run[j + 1] FOR j IN range(1, len(run))] AS pairs, len(list_intersect(run, words)) AS o FROM x),
c AS (SELECT r, label, o / len(words) AS containment FROM y
      WHERE o >= need AND CASE WHEN len(exact) > 0 THEN run = exact ELSE
        len([g FOR g IN own IF NOT list_has_any(g, pairs)]) = 0 AND len([g FOR g IN wider IF list_has_all(run, g)]) = 0 END),
m AS (SELECT r, list(DISTINCT label) AS alike, max(containment) AS containment FROM c GROUP BY r),
i AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT r, i - 1 AS i, CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit'
             WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
             WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END AS label FROM i),
b AS (SELECT r, count(*) AS n, min(i) AS f, max(i) AS l, list(DISTINCT label) AS labels
      FROM p WHERE label IS NOT NULL GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(labels, []::VARCHAR[])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []::VARCHAR[]), coalesce(alike, []::VARCHAR[])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""

OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, CASE WHEN len(w) = 1 THEN w
      ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM d),
n AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k, s FROM x),
first AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM n WHERE n > 0 GROUP BY k),
t AS (SELECT rep, n, unnest(s) AS token FROM first),
o AS (SELECT rep, n, token, row_number() OVER (PARTITION BY rep ORDER BY f, token) AS i
      FROM (SELECT *, count(*) OVER (PARTITION BY token) AS f FROM t)),
p AS (SELECT * FROM o WHERE i <= n - ceil(0.8 * n - 1e-9) + 1),
c AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b USING (token)
      WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM c JOIN first x ON x.rep = a JOIN first y ON y.rep = b
      WHERE 180 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n)),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
r(u, root) AS (SELECT rep, rep FROM first UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.u WHERE r.root < e.v),
g AS (SELECT u, min(root) AS component FROM r GROUP BY u)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(g.component, n.doc_id)::BIGINT AS component_id,
       n.doc_id = coalesce(g.component, n.doc_id) AS kept
FROM n LEFT JOIN first ON n.k = first.k AND n.n > 0 LEFT JOIN g ON g.u = first.rep
"""

OP7 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
h AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head
      FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM h
"""

_BITS = " ".join(f"WHEN '{f}' THEN {1 << i}" for i, f in enumerate("ABCDE"))
OP11 = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_SPACED} AS w FROM documents),
m AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
             + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(t.doc_id > least, false)::INT AS failed
      FROM t JOIN m USING (text) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x(a) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.a || q.a || r.a || s.a || u.a AS filter_order FROM x p, x q, x r, x s, x u
      WHERE len(list_distinct([p.a, q.a, r.a, s.a, u.a])) = 5),
e AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
b AS (SELECT filter_order, step, CASE substr(filter_order, step, 1) {_BITS} END AS bit,
             list_sum([CASE substr(filter_order, i, 1) {_BITS} END FOR i IN range(1, step)])::INT AS earlier FROM e),
k AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN failed & (bit | coalesce(earlier, 0)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN failed & bit <> 0 AND failed & coalesce(earlier, 0) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN failed & bit <> 0 AND failed & coalesce(earlier, 0) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN failed = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN failed & bit <> 0 AND failed & coalesce(earlier, 0) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN failed & bit <> 0 AND failed & coalesce(earlier, 0) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, b GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM k
"""

ORACLE = {"op1_mixing": OP1, "op2_substrings": OP2, "op5_decontaminate": OP5, "op6_near_dedup": OP6, "op7_warc": OP7, "op10_licenses": OP10, "op11_filter_audit": OP11}
