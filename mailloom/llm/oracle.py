"""DuckDB SQL for the numbered queries that SQL can express, written from their contracts."""

from __future__ import annotations

from mailloom.llm.licenses import PHRASES, TEMPLATES, THRESHOLD
from mailloom.llm.url_reputation import BOUND, RULES, STRONGEST, WEAKEST
from mailloom.llm.url_reputation import THRESHOLD as BLOCKED

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = """
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS n FROM raw),
starts AS (SELECT r, i, md5(substr(h, 2 * i - 1, 400)) AS s FROM sized, unnest(generate_series(1, n - 199)) AS t(i)),
twice AS (SELECT s FROM starts GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM starts JOIN twice USING (s)),
opened AS (SELECT r, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM hits),
runs AS (SELECT r, min(i) AS a, max(i) + 199 AS b FROM opened GROUP BY r, k),
gaps AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
kept AS (SELECT r, sum(b - a + 1) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before - 1)), '' ORDER BY a) AS head
  FROM gaps JOIN sized USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(concat(coalesce(head, ''), substr(h, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
FROM sized LEFT JOIN kept USING (r)"""

OP5 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOW)} AS w FROM documents),
items AS (SELECT item_id, {_WORDS.format(_LOW)} AS w FROM benchmark),
parts AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + 9], ' ') AS s
  FROM items, unnest(generate_series(1, greatest(1, len(w) - 9))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM parts),
places AS (SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS s
  FROM docs, sizes, unnest(generate_series(1, len(w) - size + 1)) AS t(i)),
found AS (SELECT r, i, size, item_id FROM places JOIN parts USING (size, s)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, i, size FROM found), unnest(generate_series(i, i + size - 1)) AS t(k) GROUP BY r),
own AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN own USING (r)"""


def _op4() -> str:
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    templates = ", ".join("('%s', [%s], %d)" % (label, ", ".join(f"'{w}'" for w in sorted(set(text.split()))), len(text.split())) for label, text in TEMPLATES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_LOW} AS low, {_WORDS.format(_LOW)} AS w FROM documents),
phrases(p, label, k) AS (VALUES {phrases}), templates(label, t, size) AS (VALUES {templates}),
places AS (SELECT r, label, i FROM docs, phrases, unnest(generate_series(1, len(w) - k + 1)) AS x(i)
  WHERE contains(low, string_split(p, ' ')[1]) AND array_to_string(w[i : i + k - 1], ' ') = p),
base AS (SELECT r, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS b, list(DISTINCT label) AS labels FROM places GROUP BY r),
able AS (SELECT r, w, label, t, size FROM docs, templates WHERE len(list_intersect(t, w)) >= {THRESHOLD} * len(t) - 1e-9),
shared AS (SELECT r, label, len(t) AS n, len(list_intersect(t, w[i : i + 2 * size - 1])) AS k FROM able, unnest(generate_series(1, len(w), size)) AS x(i)),
alike AS (SELECT r, label, max(k / n) AS c FROM shared WHERE k >= {THRESHOLD} * n - 1e-9 GROUP BY r, label),
own AS (SELECT r, list(label) AS labels, max(c) AS best FROM alike GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, own.labels))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN own USING (r)"""


def _op10() -> str:
    rule, verdict = "NULL", "NULL"
    for text, said in sorted(RULES, key=lambda r: len(r[0])):
        host, _, path = text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{said}' ELSE {verdict} END"

    def level(name: str, counts: str) -> str:
        """Prior strength by moments, then the posterior mean."""
        return f"""{name}_n AS ({counts}),
{name}_s AS (SELECT (sum(n * pow(bad / n - prior, 2)) - sum(prior * (1 - prior))) / sum(prior * (1 - prior) * (n - 1)) AS share FROM {name}_n WHERE n > 1),
{name} AS (SELECT *, (bad + prior * s) / (n + s) AS mean FROM (SELECT *, (SELECT CASE WHEN share IS NULL OR share <= 1 / ({STRONGEST} + 1) THEN {STRONGEST}
  ELSE greatest({WEAKEST}, 1 / share - 1) END FROM {name}_s) AS s FROM {name}_n))"""

    return f"""
WITH urls AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
counted AS (SELECT host, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(quality) AS n, coalesce(sum(1 - quality), 0) AS bad
  FROM urls LEFT JOIN (SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL) ON page_id = doc_id GROUP BY 1, 2, 3),
{level('suffixes', 'SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM counted) AS prior FROM counted GROUP BY suffix')},
{level('domains', 'SELECT domain, sum(c.n) AS n, sum(c.bad) AS bad, any_value(mean) AS prior FROM counted c JOIN suffixes USING (suffix) GROUP BY domain')},
{level('hosts', 'SELECT host, c.n, c.bad, mean AS prior FROM counted c JOIN domains USING (domain)')},
blocked AS (SELECT host FROM hosts WHERE mean - {BOUND} * sqrt(mean * (1 - mean) / (n + s + 1)) > {BLOCKED})
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM urls"""


def _op11() -> str:
    steps = ["c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v AS t FROM kept QUALIFY c < 16)"]
    for k in range(4):
        steps.append(f"""far{k} AS (SELECT r, c, CAST(list_sum([(v[i] - t[i]) * (v[i] - t[i]) for i in range(1, 65)]) AS BIGINT) AS distance FROM kept, c{k}),
near{k} AS (SELECT r, c, distance FROM far{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1)""")
        if k < 3:
            steps.append(f"""sum{k} AS (SELECT c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM near{k} JOIN kept USING (r), range(1, 65) AS x(i) GROUP BY c, i),
mean{k} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM sum{k} GROUP BY c),
c{k + 1} AS (SELECT c, coalesce(m, t) AS t FROM c{k} LEFT JOIN mean{k} USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(t, ',')) AS centroid_sha256
FROM near3 JOIN kept USING (r) JOIN c3 USING (c)"""


OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS n, sum(len(w)) AS l FROM docs WHERE len(w) > 0),
own AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM docs),
counted AS (SELECT r, doc_id, n, term, count(*) AS tf FROM own GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * t.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counted, total t GROUP BY term, t.n),
asked AS (SELECT row_number() OVER () AS k, item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
scored AS (SELECT k, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * c.n * t.n) // CAST(t.l AS BIGINT))))) AS BIGINT) AS score
  FROM asked JOIN counted c USING (term) JOIN weights USING (term), total t GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored QUALIFY rank <= 50"""

OP13 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS s FROM docs, unnest(generate_series(1, len(w) - 12)) AS t(i)),
least AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, k FROM windows JOIN least USING (s), unnest(generate_series(i, i + 12)) AS x(k) WHERE doc_id > first),
flat AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM docs),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS words FROM flat ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""


def oracle_sql() -> dict[str, str]:
    own = {"op1_suffix_dedup": OP1, "op4_license_scan": _op4(), "op5_decontaminate": OP5, "op10_url_reputation": _op10()}
    return own | {"op11_centroids": _op11(), "op12_ranked_search": OP12, "op13_seed_extend": OP13}
