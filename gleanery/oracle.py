"""DuckDB twins of the registered queries, written against the raw tables."""

from __future__ import annotations

from gleanery.functions.sampling import hash_threshold
from gleanery.functions.text import STOP_WORDS
from gleanery.operators.lemmas import IRREGULAR, MIN_STEM, SUFFIX_RULES
from gleanery.queries import (
    CLUSTER_COUNTS,
    FIXED,
    FULL_RANK,
    LEADING,
    LLOYD_PASSES,
    SAMPLE_FRACTION,
    SAMPLE_SEED,
    VOCABULARY,
)

BLANK = r"[ \t\n\r\f]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def word_rows(words) -> str:
    return ", ".join(f"({quoted(w)})" for w in words)


STOP = f"stop(word) AS (VALUES {word_rows(STOP_WORDS)})"
DOCS = "docs AS (SELECT doc_id, source AS title, lang AS genre, text FROM documents)"
TOKENS = f"""
{STOP}, {DOCS},
pieces AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS term,
         generate_subscripts(regexp_split_to_array(lower(text), '{BLANK}'), 1) AS pos
  FROM docs),
tokens AS (
  SELECT doc_id, term, pos FROM pieces
  WHERE length(term) > 2 AND term NOT IN (SELECT word FROM stop)
    AND (regexp_full_match(term, '[a-z_\\-]{{6,24}}')
         OR regexp_full_match(term, '-?[0-9]+([.,][0-9]+)?')))"""
TF = f"""{TOKENS},
lens AS (SELECT doc_id, count(*) AS doc_len FROM tokens GROUP BY doc_id),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"""


def vocab(size: int) -> str:
    return f"""{TF},
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS term_id, term, df,
         ln((SELECT count(*) FROM docs) / CAST(df AS DOUBLE)) AS idf
  FROM df ORDER BY df DESC, term LIMIT {size}),
w AS (
  SELECT doc_id, term_id, term, idf, idf * tf / doc_len AS weight
  FROM tf JOIN vocab USING (term) JOIN lens USING (doc_id))"""


def hits(size: int) -> str:
    return f"""WITH {vocab(size)},
q AS (
  SELECT item_id AS query_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS term
  FROM benchmark),
qv AS (SELECT query_id, term_id, count(*) * any_value(idf) AS value
       FROM q JOIN vocab USING (term) GROUP BY query_id, term_id),
scores AS (SELECT query_id, doc_id, sum(value * weight) AS s
           FROM qv JOIN w USING (term_id) GROUP BY query_id, doc_id),
all_scores AS (
  SELECT b.item_id AS query_id, d.doc_id, d.title, d.genre,
         CASE WHEN coalesce(s, 0) = 0 THEN 0.0
              ELSE round(s, CAST(11 - floor(log10(abs(s))) AS INTEGER)) END AS score
  FROM benchmark b CROSS JOIN docs d
  LEFT JOIN scores ON scores.query_id = b.item_id AND scores.doc_id = d.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC) AS rank
  FROM all_scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, title, genre, score
FROM ranked WHERE rank <= 10"""


IRREGULAR_ROWS = ", ".join(f"({quoted(t)}, {quoted(l)})" for t, l in IRREGULAR.items())
RULES = ", ".join(f"({i}, {quoted(s)}, {quoted(r)})" for i, (s, r) in enumerate(SUFFIX_RULES))
SURFACE_WORDS = rf"""
raw AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text),
    '[\p{{L}}\p{{N}}]+(?:[-_.''’@][\p{{L}}\p{{N}}]+)*')) AS piece FROM docs),
surface AS (
  SELECT doc_id, regexp_replace(piece, '(n[''’]t|[''’](s|re|ve|ll|d|m))$', '') AS token FROM raw),
words AS (SELECT doc_id, token FROM surface WHERE regexp_full_match(token, '\p{{L}}+'))"""
SURFACE = f"""{SURFACE_WORDS},
lexicon AS (SELECT DISTINCT token FROM words),
irregular(token, lemma) AS (VALUES {IRREGULAR_ROWS}),
rules(rule, suffix, replacement) AS (VALUES {RULES}),
proposed AS (
  SELECT token, rule, left(token, length(token) - length(suffix)) || replacement AS lemma
  FROM lexicon JOIN rules ON ends_with(token, suffix)
   AND length(token) >= length(suffix) + {MIN_STEM}
  WHERE token NOT IN (SELECT token FROM irregular)),
regular AS (
  SELECT token, arg_min(lemma, rule) AS lemma FROM proposed
  WHERE lemma IN (SELECT token FROM lexicon) GROUP BY token),
lemmas AS (
  SELECT token, lemma FROM regular
  UNION ALL SELECT token, lemma FROM irregular WHERE token IN (SELECT token FROM lexicon))"""

#: Steps of the power iterations, enough for neighbouring singular values that differ by some per cent.
POWER_STEPS = 1500


def leading_concepts(size: int, count: int) -> str:
    """Rows concepts(concept, lambda, v) of the first eigenvectors of the Gram matrix, by power iteration on what
    the ones before leave, the largest entry of each positive; and us(doc_id, concept, x), the documents along them."""
    unit = "list_transform({0}, lambda x: x / sqrt(list_dot_product({0}, {0})))"
    parts = []
    for c in range(count):
        before = "".join(f", e{b}" for b in range(c))
        rest = "".join(
            f" - e{b}.lam * e{b}.v[r.i] * list_dot_product(e{b}.v, p.v)" for b in range(c)
        )
        parts.append(f"""
p{c}(n, v) AS (
  SELECT 0, list_transform(range({size}), lambda x: cos(x * {c + 1} + 0.5)::DOUBLE)
  UNION ALL
  SELECT n + 1, {unit.format("w")}
  FROM (SELECT p.n, list_transform(m, lambda r: list_dot_product(r.row, p.v){rest}) AS w
        FROM p{c} p, gram{before} WHERE p.n < {POWER_STEPS})),
t{c} AS (SELECT v FROM p{c} WHERE n = {POWER_STEPS}),
e{c} AS (
  SELECT CASE WHEN list_max(v) >= -list_min(v) THEN v ELSE list_transform(v, lambda x: -x) END AS v,
         list_dot_product(v, list_transform(m, lambda r: list_dot_product(r.row, v))) AS lam
  FROM t{c}, gram)""")
    every = " UNION ALL ".join(f"SELECT {c} AS concept, lam, v FROM e{c}" for c in range(count))
    return f"""WITH RECURSIVE {vocab(size)},
cells AS (
  SELECT a.term_id AS i, b.term_id AS j, sum(a.weight * b.weight) AS value
  FROM w a JOIN w b USING (doc_id) GROUP BY 1, 2),
gram AS MATERIALIZED (
  SELECT list({{'i': i + 1, 'row': row}} ORDER BY i) AS m
  FROM (SELECT x.i AS i, list(coalesce(value, 0.0)::DOUBLE ORDER BY y.j) AS row
        FROM range({size}) x(i), range({size}) y(j) LEFT JOIN cells ON cells.i = x.i AND cells.j = y.j
        GROUP BY x.i)),{",".join(parts)},
concepts AS MATERIALIZED ({every}),
us AS (
  SELECT docs.doc_id, concept, lam, coalesce(sum(weight * v[term_id + 1]), 0.0) AS x
  FROM docs CROSS JOIN concepts LEFT JOIN w USING (doc_id) GROUP BY ALL)"""


DIGITS = "CASE WHEN {0} = 0 THEN 0.0 ELSE round({0}, CAST(11 - floor(log10(abs({0}))) AS INTEGER)) END"
LEADING_TERMS = """top_terms AS (
  SELECT concept, row_number() OVER (PARTITION BY concept ORDER BY score DESC, term_id) AS rank, term, score
  FROM (SELECT concept, term_id, term, round(v[term_id + 1], 9) AS score FROM concepts, vocab))"""
LEADING_DOCS = f"""top_docs AS (
  SELECT concept, row_number() OVER (PARTITION BY concept ORDER BY score DESC, doc_id DESC) AS rank, doc_id, title, genre, score
  FROM (SELECT concept, doc_id, {DIGITS.format("(x / sqrt(lam))")} AS score FROM us) JOIN docs USING (doc_id))"""

POINTS = """
stats AS (
  SELECT avg(l_quantity) m1, avg(l_extendedprice) m2, avg(l_discount) m3,
         stddev_samp(l_quantity) s1, stddev_samp(l_extendedprice) s2, stddev_samp(l_discount) s3
  FROM lineitem),
points AS (
  SELECT l.*, (l_quantity - m1) / s1 AS z1, (l_extendedprice - m2) / s2 AS z2,
         (l_discount - m3) / s3 AS z3
  FROM lineitem l, stats)"""


def center_rows(ks) -> str:
    return ", ".join(
        f"({k}, {i}, {', '.join(repr(float(x)) + '::DOUBLE' for x in c)})"
        for k in ks
        for i, c in enumerate(FIXED[k])
    )


def assigned(ks) -> str:
    return f"""WITH {POINTS},
centers(k, cluster, c1, c2, c3) AS (VALUES {center_rows(ks)}),
keyed AS (SELECT *, row_number() OVER () AS rid FROM points),
pairs AS (
  SELECT rid, k, cluster,
         sqrt((z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2) + (z3 - c3) * (z3 - c3)) AS distance
  FROM keyed, centers),
near AS (
  SELECT rid, k, min(distance) AS distance, arg_min(cluster, (distance, cluster)) AS cluster
  FROM pairs GROUP BY rid, k),
assigned AS (SELECT * FROM near JOIN keyed USING (rid))"""


def lloyd_passes(count: int) -> str:
    """Centres c0 (the fixed starts) to c<count>; a centre without points stays."""
    steps = "".join(
        f""",
near{i} AS (
  SELECT rid, k, arg_min(cluster, (d, cluster)) AS cluster, any_value(z1) AS z1,
         any_value(z2) AS z2, any_value(z3) AS z3
  FROM (SELECT rid, k, cluster, z1, z2, z3,
               (z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2) + (z3 - c3) * (z3 - c3) AS d
        FROM keyed, c{i}) GROUP BY rid, k),
mean{i} AS (SELECT k, cluster, avg(z1) AS m1, avg(z2) AS m2, avg(z3) AS m3
            FROM near{i} GROUP BY k, cluster),
c{i + 1} AS (
  SELECT k, cluster, coalesce(m1, c1) AS c1, coalesce(m2, c2) AS c2, coalesce(m3, c3) AS c3
  FROM c{i} LEFT JOIN mean{i} USING (k, cluster))"""
        for i in range(count)
    )
    return f"""WITH {POINTS},
keyed AS (SELECT row_number() OVER () AS rid, z1, z2, z3 FROM points),
c0(k, cluster, c1, c2, c3) AS (VALUES {center_rows(CLUSTER_COUNTS)}){steps}"""


FITS = f"""WITH RECURSIVE {POINTS},
hashed AS (
  SELECT z1, z2, z3, md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS h FROM points),
drawn AS (
  SELECT z1, z2, z3, min((h, z1, z2, z3)) AS h
  FROM (SELECT * FROM hashed ORDER BY h, z1, z2, z3 LIMIT {8 * (CLUSTER_COUNTS.stop - 1)}) GROUP BY ALL),
starts AS (SELECT row_number() OVER (ORDER BY h) AS n, {{'a': z1, 'b': z2, 'c': z3}} AS p FROM drawn),
fits(k, pass, centers, moved) AS (
  SELECT k, 0, list(p ORDER BY n), 1e9::DOUBLE
  FROM starts, range({CLUSTER_COUNTS.start}, {CLUSTER_COUNTS.stop}) AS t(k) WHERE n <= k GROUP BY k
  UNION ALL
  SELECT k, any_value(pass) + 1, list(coalesce(m, p) ORDER BY n),
         max(sqrt((coalesce(m, p).a - p.a) ** 2 + (coalesce(m, p).b - p.b) ** 2 + (coalesce(m, p).c - p.c) ** 2))
  FROM (
    SELECT f.k, f.pass, c.n, f.centers[c.n] AS p, g.m
    FROM fits f, range(1, {CLUSTER_COUNTS.stop}) AS c(n)
    LEFT JOIN (
      SELECT k, near, {{'a': avg(z1), 'b': avg(z2), 'c': avg(z3)}} AS m
      FROM (
        SELECT k, z1, z2, z3, list_position(d, list_min(d)) AS near
        FROM (
          SELECT k, z1, z2, z3, list_transform(centers,
            lambda x: (z1 - x.a) * (z1 - x.a) + (z2 - x.b) * (z2 - x.b) + (z3 - x.c) * (z3 - x.c)) AS d
          FROM points, fits WHERE moved > 1e-6 AND pass < 100))
      GROUP BY k, near) g ON g.k = f.k AND g.near = c.n
    WHERE f.moved > 1e-6 AND f.pass < 100 AND c.n <= f.k)
  GROUP BY k),
fitted AS (SELECT k, arg_max(centers, pass) AS centers FROM fits GROUP BY k),
assigned AS (
  SELECT k, centers, z1, z2, z3, l_quantity, l_extendedprice, l_discount, list_position(d, list_min(d)) AS n, sqrt(list_min(d)) AS distance
  FROM (
    SELECT *, list_transform(centers,
      lambda x: (z1 - x.a) * (z1 - x.a) + (z2 - x.b) * (z2 - x.b) + (z3 - x.c) * (z3 - x.c)) AS d
    FROM points, fitted))"""

SAMPLED = f"""sampled AS (
  SELECT * FROM assigned
  WHERE md5(concat_ws(':', '{SAMPLE_SEED}', l_orderkey, l_partkey, l_suppkey, l_linenumber))[1:8]
        < '{hash_threshold(SAMPLE_FRACTION)}')"""

ORACLE: dict[str, str] = {
    "article_extract": """
SELECT doc_id AS wiki_id, 'http://x/' || doc_id AS url, source AS title,
       CAST(length(text) + 1 AS INTEGER) AS content_chars,
       md5(text || chr(10)) AS content_md5 FROM documents""",
    "article_files": """
SELECT doc_id AS wiki_id, 'http://x/' || doc_id AS url, source AS title,
       CAST(length(text) + 1 AS INTEGER) AS content_chars,
       md5(text || chr(10)) AS content_md5, (SELECT count(*) FROM documents) AS ids FROM documents""",
    "page_header": """
SELECT page_id, regexp_extract(html, '(?:^|[ \\t])lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '(?:^|[ \\t])charset="([^"]*)"', 1) AS charset,
       '' AS missing FROM pages""",
    "run_id_extract": """
SELECT page_id, try_cast(regexp_extract(url, 'page=(\\d+)', 1) AS INTEGER) AS run_id FROM pages""",
    "stop_word_list": f"""
WITH {STOP}, pieces AS (
  SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS word
  FROM documents)
SELECT word, count(*) AS docs FROM pieces JOIN stop USING (word) GROUP BY word""",
    "movie_scan": "SELECT source AS title, lang AS genre, md5(text) AS plot_md5 FROM documents",
    "movie_duplicates": f"""
WITH {TF}, n AS (SELECT doc_id, source AS title, lang AS genre, md5(text) AS md5, coalesce(doc_len, 0) AS doc_len
           FROM documents LEFT JOIN lens USING (doc_id))
SELECT title, genre, md5, 2 * count(*) AS rows, 2 * count(*) AS ids, CAST(max(doc_len) AS BIGINT) AS doc_len,
       CAST(2 * sum(doc_len) AS BIGINT) AS terms FROM n GROUP BY title, genre, md5""",
    "sensor_scan": """
SELECT l_linenumber AS "runId", l_quantity AS sensor1, l_extendedprice AS sensor2,
       l_discount AS sensor3 FROM lineitem""",
    "sample_key": f"""
SELECT doc_id, source AS title FROM documents
WHERE md5('{SAMPLE_SEED}:' || doc_id)[1:8] < '{hash_threshold(SAMPLE_FRACTION)}'""",
    "corpus_stats": f"""
WITH {TOKENS}
SELECT (SELECT count(*) FROM docs) AS documents, count(DISTINCT doc_id) AS documents_with_tokens,
       count(*) AS tokens FROM tokens""",
    "stopword_filter": f"""
WITH {STOP}, pieces AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS term,
         generate_subscripts(regexp_split_to_array(lower(text), '{BLANK}'), 1) AS pos
  FROM documents),
kept AS (
  SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS kept FROM pieces
  WHERE term NOT IN (SELECT word FROM stop) GROUP BY doc_id)
SELECT doc_id, coalesce(kept, '') AS kept FROM documents LEFT JOIN kept USING (doc_id)""",
    "tokenize_regex": f"""
WITH {TOKENS}, lines AS (
  SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS tokens FROM tokens GROUP BY doc_id)
SELECT doc_id, coalesce(lines.tokens, '') AS tokens FROM docs LEFT JOIN lines USING (doc_id)""",
    "tokenize_lemma": f"""
WITH {STOP}, {DOCS}, {SURFACE},
terms AS (
  SELECT doc_id, coalesce(lemma, w.token) AS term
  FROM words w LEFT JOIN lemmas ON lemmas.token = w.token),
lines AS (
  SELECT doc_id, string_agg(term, ' ' ORDER BY term) AS tokens FROM terms
  WHERE length(term) > 2 AND term NOT IN (SELECT word FROM stop) GROUP BY doc_id)
SELECT doc_id, coalesce(lines.tokens, '') AS tokens FROM docs LEFT JOIN lines USING (doc_id)""",
    "lemma_dictionary": f"""
WITH {DOCS}, {SURFACE_WORDS},
lexicon AS MATERIALIZED (SELECT DISTINCT token FROM words),
rules(rule, suffix, replacement) AS (VALUES {RULES}),
irregular(token, lemma) AS (VALUES {IRREGULAR_ROWS}),
sizes AS (SELECT DISTINCT length(suffix) AS cut FROM rules),
ends AS MATERIALIZED (
  SELECT token, left(token, length(token) - cut) AS stem, right(token, cut) AS suffix
  FROM lexicon, sizes WHERE length(token) >= cut + {MIN_STEM}),
proposed AS (SELECT token, rule, stem || replacement AS lemma FROM ends JOIN rules USING (suffix)),
regular AS (
  SELECT p.token, arg_min(lemma, rule) AS lemma FROM proposed p JOIN lexicon l ON l.token = p.lemma GROUP BY p.token)
SELECT token, lemma FROM regular ANTI JOIN irregular USING (token)
UNION ALL SELECT token, lemma FROM irregular SEMI JOIN lexicon USING (token)""",
    "sentence_counts": f"""
SELECT doc_id, CAST(len(list_filter(
  regexp_split_to_array(text, '[.!?]+([ \\t\\n\\r\\f]+|$)'),
  lambda s: trim(s, ' ') <> '')) AS INTEGER) AS sentences
FROM documents""",
    "term_freq": f"WITH {TF} SELECT doc_id, doc_len, term, tf FROM tf JOIN lens USING (doc_id)",
    "doc_length": f"""
WITH {TF} SELECT doc_id, coalesce(doc_len, 0) AS doc_len FROM docs LEFT JOIN lens USING (doc_id)""",
    "doc_freq": f"WITH {TF} SELECT term, df FROM df",
    "vocab_top": f"""
WITH {vocab(VOCABULARY)} SELECT term_id, term, df, round(idf, 8) AS idf FROM vocab""",
    "tfidf_weights": f"""
WITH {vocab(VOCABULARY)}
SELECT doc_id, term_id, round(weight, 8) AS weight FROM w WHERE weight <> 0""",
    "gram_matrix": f"""
WITH {vocab(FULL_RANK)}
SELECT a.term_id AS i, b.term_id AS j, round(sum(a.weight * b.weight), 8) AS value
FROM w a JOIN w b USING (doc_id) GROUP BY 1, 2""",
    "leading_values": f"""
{leading_concepts(FULL_RANK, LEADING)}
SELECT CAST(concept AS INTEGER) AS concept, round(sqrt(lam), 6) AS sigma, round(lam, 6) AS energy FROM concepts""",
    "leading_terms": f"""
{leading_concepts(FULL_RANK, LEADING)}, {LEADING_TERMS}
SELECT CAST(concept AS INTEGER) AS concept, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score
FROM top_terms WHERE rank <= 25""",
    "leading_docs": f"""
{leading_concepts(FULL_RANK, LEADING)}, {LEADING_DOCS}
SELECT CAST(concept AS INTEGER) AS concept, CAST(rank AS INTEGER) AS rank, doc_id, title, genre, round(score, 6) AS score
FROM top_docs WHERE rank <= 25""",
    "leading_report": f"""
{leading_concepts(FULL_RANK, LEADING)}, {LEADING_TERMS}, {LEADING_DOCS}
SELECT CAST(concept AS INTEGER) AS concept, 'term' AS kind, string_agg(term, ', ' ORDER BY rank) AS names
FROM top_terms WHERE rank <= 25 GROUP BY concept
UNION ALL
SELECT CAST(concept AS INTEGER) AS concept, 'doc' AS kind, string_agg(title, ', ' ORDER BY rank) AS names
FROM top_docs WHERE rank <= 25 GROUP BY concept""",
    "leading_search": f"""
{leading_concepts(FULL_RANK, LEADING)},
q AS (
  SELECT item_id AS query_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS term FROM benchmark),
qv AS (SELECT query_id, term_id, count(*) * any_value(idf) AS value FROM q JOIN vocab USING (term) GROUP BY query_id, term_id),
qc AS (
  SELECT b.item_id AS query_id, concept, coalesce(sum(value * v[term_id + 1]), 0.0) AS y
  FROM benchmark b CROSS JOIN concepts LEFT JOIN qv ON qv.query_id = b.item_id GROUP BY 1, 2),
scored AS (SELECT query_id, doc_id, sum(x * y) AS s FROM us JOIN qc USING (concept) GROUP BY query_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC) AS rank
  FROM (SELECT query_id, doc_id, {DIGITS.format("s")} AS score FROM scored))
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, title, genre, round(score, 6) AS score
FROM ranked JOIN docs USING (doc_id) WHERE rank <= 10""",
    "svd_energy": f"""
WITH {vocab(FULL_RANK)} SELECT round(sum(weight * weight), 6) AS energy FROM w""",
    "svd_invariants": f"""
WITH {vocab(FULL_RANK)}, g AS (
  SELECT a.term_id AS i, b.term_id AS j, sum(a.weight * b.weight) AS value
  FROM w a JOIN w b USING (doc_id) GROUP BY 1, 2)
SELECT round(sum(value * value), 5) AS sigma4, true AS orthogonal, true AS scaled, true AS u_orthogonal FROM g""",
    "lsa_sweep_full": f"""
SELECT 'pattern' AS variant, CAST(30 AS INTEGER) AS num_terms, round(e, 6) AS energy, 1.0::DOUBLE AS share
FROM (WITH {vocab(30)} SELECT sum(weight * weight) AS e FROM w)
UNION ALL
SELECT 'pattern', CAST({FULL_RANK} AS INTEGER), round(e, 6), 1.0::DOUBLE
FROM (WITH {vocab(FULL_RANK)} SELECT sum(weight * weight) AS e FROM w)""",
    "document_energy": f"""
WITH {vocab(FULL_RANK)}, e AS (SELECT doc_id, sum(weight * weight) AS e FROM w GROUP BY doc_id)
SELECT doc_id, round(coalesce(e, 0), 8) AS energy FROM docs LEFT JOIN e USING (doc_id)""",
    "term_energy": f"""
WITH {vocab(FULL_RANK)}
SELECT term, round(sum(weight * weight), 6) AS energy FROM w GROUP BY term""",
    "keyword_search_exact": hits(VOCABULARY),
    "keyword_search_lsa": hits(FULL_RANK),
    "model_roundtrip": hits(FULL_RANK),
    "query_terms": f"""
WITH {vocab(VOCABULARY)}, q AS (
  SELECT item_id AS query_id, unnest(regexp_split_to_array(lower(text), '{BLANK}')) AS term
  FROM benchmark)
SELECT query_id, term_id, round(count(*) * any_value(idf), 8) AS value
FROM q JOIN vocab USING (term) GROUP BY query_id, term_id""",
    "title_lookup": """
SELECT event_id, user_id AS doc_id, coalesce(d.source, 'unknown') AS title
FROM events e LEFT JOIN documents d ON d.doc_id = e.user_id""",
    "genre_lookup": """
WITH by_title AS (SELECT source AS title, arg_max(lang, doc_id) AS genre FROM documents GROUP BY source),
p AS (SELECT page_id AS doc_id, 'src' || (page_id % 25) AS title FROM pages)
SELECT doc_id, title, coalesce(genre, 'Unknown') AS genre FROM p LEFT JOIN by_title USING (title)""",
    "genre_top5": """
SELECT doc_id, array_to_string(
  list_transform(string_split(text, ',')[1:5], lambda s: trim(s, ' ')), '|') AS genres
FROM documents""",
    "column_stats": """
SELECT round(avg(l_quantity), 4) AS mean_l_quantity,
       round(avg(l_extendedprice), 4) AS mean_l_extendedprice,
       round(avg(l_discount), 4) AS mean_l_discount,
       round(stddev_samp(l_quantity), 4) AS std_l_quantity,
       round(stddev_samp(l_extendedprice), 4) AS std_l_extendedprice,
       round(stddev_samp(l_discount), 4) AS std_l_discount FROM lineitem""",
    "sensor_problems": """
SELECT CAST(l_linenumber AS INTEGER) AS runId,
       CASE l_orderkey % 9 WHEN 0 THEN 'too short' WHEN 1 THEN 'not a number' WHEN 2 THEN 'extra fields'
            ELSE 'missing value' END AS problem,
       count(*) AS lines, count(*) FILTER (l_orderkey % 9 = 2) AS usable
FROM lineitem WHERE l_orderkey % 9 < 4 GROUP BY 1, 2""",
    "zscore": f"""
WITH {POINTS}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(z1, 6) AS z_l_quantity,
       round(z2, 6) AS z_l_extendedprice, round(z3, 6) AS z_l_discount FROM points""",
    "assign_distance": f"""
{assigned([5])}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(cluster AS INTEGER) AS cluster,
       round(distance, 6) AS distance FROM assigned""",
    "lloyd_step": f"""
{assigned([5])}
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size, round(avg(z1), 6) AS z_l_quantity,
       round(avg(z2), 6) AS z_l_extendedprice, round(avg(z3), 6) AS z_l_discount
FROM assigned GROUP BY cluster""",
    "lloyd_sweep": f"""
{lloyd_passes(LLOYD_PASSES)}
SELECT CAST(k AS INTEGER) AS k, CAST(cluster AS INTEGER) AS cluster, round(c1, 6) AS z_l_quantity,
       round(c2, 6) AS z_l_extendedprice, round(c3, 6) AS z_l_discount FROM c{LLOYD_PASSES}""",
    "outliers_top25": f"""
{assigned(CLUSTER_COUNTS)}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k
    ORDER BY distance DESC, l_quantity, l_extendedprice, l_discount) AS place FROM assigned)
SELECT CAST(k AS INTEGER) AS k, l_quantity, l_extendedprice, l_discount,
       CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance
FROM ranked WHERE place <= 25""",
    "cluster_sizes": f"""
{assigned(CLUSTER_COUNTS)}
SELECT CAST(k AS INTEGER) AS k, CAST(cluster AS INTEGER) AS cluster, count(*) AS size
FROM assigned GROUP BY k, cluster""",
    "elbow": f"""
{assigned(CLUSTER_COUNTS)}
SELECT CAST(k AS INTEGER) AS k, round(avg(distance), 6) AS mean_distance
FROM assigned GROUP BY k""",
    "kmeans_sweep": f"""
{FITS}
SELECT CAST(k AS INTEGER) AS k, CAST(n - 1 AS INTEGER) AS cluster, round(any_value(centers[n].a), 5) AS z_l_quantity,
       round(any_value(centers[n].b), 5) AS z_l_extendedprice, round(any_value(centers[n].c), 5) AS z_l_discount,
       count(*) AS size, round(sum(distance), 3) AS total_distance
FROM assigned GROUP BY k, n""",
    "kmeans_outliers": f"""
{FITS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k
    ORDER BY distance DESC, l_quantity, l_extendedprice, l_discount) AS place FROM assigned)
SELECT CAST(k AS INTEGER) AS k, l_quantity, l_extendedprice, l_discount,
       CAST(n - 1 AS INTEGER) AS cluster, round(distance, 5) AS distance
FROM ranked WHERE place <= 25""",
    "kmeans_partition": f"""
{FITS}, means AS (
  SELECT k, n, count(*) AS held, any_value(centers[n]) AS p, avg(z1) AS a, avg(z2) AS b, avg(z3) AS c
  FROM assigned GROUP BY k, n)
SELECT CAST(k AS INTEGER) AS k, CAST(sum(held) AS BIGINT) AS readings, count(*) AS clusters,
       round(max(sqrt((p.a - a) ** 2 + (p.b - b) ** 2 + (p.c - c) ** 2)), 5) AS largest_gap
FROM means GROUP BY k""",
    "cluster_sample": f"""
{assigned(CLUSTER_COUNTS)}, {SAMPLED}
SELECT CAST(k AS INTEGER) AS k, round(avg(distance), 6) AS mean_distance
FROM sampled GROUP BY k""",
    "sample_outlier_rows": f"""
{assigned(CLUSTER_COUNTS)}, {SAMPLED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k
    ORDER BY distance DESC, l_quantity, l_extendedprice, l_discount) AS place FROM sampled)
SELECT l_quantity AS sensor1, l_extendedprice AS sensor2, l_discount AS sensor3,
       CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance,
       CAST(k AS INTEGER) AS k FROM ranked WHERE place <= 25""",
    "sample_cluster_rows": f"""
{assigned(CLUSTER_COUNTS)}, {SAMPLED}
SELECT l_quantity AS sensor1, l_extendedprice AS sensor2, l_discount AS sensor3,
       CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance,
       CAST(k AS INTEGER) AS k FROM sampled WHERE cluster = 1""",
}
ORACLE["tfidf_join"] = ORACLE["tfidf_weights"]
