"""DuckDB SQL beside the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str, pattern: str) -> str:
    return f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}') AS w FROM {table}"


def _component(nodes: str, links: str) -> str:
    """``(node, component)`` by all that can be reached; for small components."""
    return (
        f"reach AS (SELECT node, node AS other FROM {nodes} UNION SELECT r.node, l.b FROM reach r JOIN {links} l ON r.other = l.a), "
        "components AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"
    )


def jaccard_sql(words: int = 4, percent: int = 85) -> str:
    return f"""
WITH RECURSIVE docs AS ({_words("documents", "doc_id", "[^\\x20\\x09-\\x0D]+")}),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < {words} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {words - 1}], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * k >= {percent} * (p.n + q.n - k)),
nodes AS (SELECT doc_id AS node FROM docs),
{_component("nodes", "links")}
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN components ON doc_id = node"""


def urls_sql(rules: tuple[tuple[str, str, str], ...], threshold: float = 0.02, majority: float = 0.5, damping: float = 0.85, tolerance: float = 1e-6, pages: str = "pages") -> str:
    """Each round passes on what the last one brought, until what is still to come is within the tolerance."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{0}}'".replace("{0}", f"{v} {h}{p}")
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    )
    lowered = f"translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    ctes = [
        f"cut AS (SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM {pages})",
        f"parsed AS (SELECT page_id, html, coalesce({lowered}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut)",
        f"ruled AS (SELECT *, CASE {fits} END AS hit FROM parsed)",
        "judged AS (SELECT page_id, html, host, path, split_part(hit, ' ', 2) AS rule, split_part(hit, ' ', 1) AS verdict FROM ruled)",
        "links AS (SELECT host AS s, unnest(list_distinct(regexp_extract_all(html, "
        "'(?i)\\b(?:href|src)\\s*=\\s*[\"'']?((?:[a-z][a-z0-9+.-]*:)?//[^\"''\\s<>]+)', 1))) AS link FROM judged)",
        f"targets AS (SELECT s, translate(regexp_extract(regexp_replace(link, '^[^/]*//', ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS t FROM links)",
        "edges AS (SELECT s, t, CAST(count(*) AS DOUBLE) AS n FROM targets WHERE s <> t AND s <> '' AND t <> '' GROUP BY s, t)",
        "shares AS (SELECT host, avg(CAST(coalesce(verdict = 'allow', FALSE) AS INT)) AS allow, avg(CAST(coalesce(verdict = 'block', FALSE) AS INT)) AS block FROM judged WHERE host <> '' GROUP BY host)",
    ]
    for name, source, target in (("allow", "s", "t"), ("block", "t", "s")):
        ctes += [
            f"{name}_parts AS (SELECT {source} AS x, {target} AS y, n / sum(n) OVER (PARTITION BY {source}) AS part FROM edges)",
            f"{name}_rounds AS (SELECT host, score, sum(score) OVER () AS brought, 0 AS round FROM "
            f"(SELECT host, {name} * (1 - {damping}) AS score FROM shares WHERE {name} > {majority}) "
            f"UNION ALL SELECT host, score, sum(score) OVER (), round FROM (SELECT y AS host, sum(score * part * {damping}) AS score, round + 1 AS round "
            f"FROM {name}_rounds JOIN {name}_parts ON x = host WHERE brought * {damping} / (1 - {damping}) > {tolerance} GROUP BY y, round))",
            f"{name}_scores AS (SELECT host, sum(score) AS score FROM {name}_rounds GROUP BY host)",
        ]
    return (
        "WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT page_id, j.host, path, nullif(rule, '') AS rule,
  CASE WHEN verdict <> '' THEN verdict WHEN coalesce(d.score, 0) >= {threshold} AND coalesce(d.score, 0) > coalesce(a.score, 0) THEN 'block' ELSE 'allow' END AS verdict
FROM judged j LEFT JOIN allow_scores a ON a.host = j.host LEFT JOIN block_scores d ON d.host = j.host"""
    )


def linked_urls_sql(rules: tuple[tuple[str, str, str], ...], damping: float, tolerance: float) -> str:
    """``urls_sql`` over pages that link to others by id."""
    linked = """(
  SELECT p.page_id, replace(p.url, '://', concat('://n', p.page_id, '.')) AS url,
    (SELECT string_agg(concat('<a href="//n', q.page_id, '.', regexp_extract(q.url, '://([^/?#]*)', 1), '/">x</a>'), '')
     FROM pages q WHERE q.page_id <> p.page_id AND (q.page_id = p.page_id + 1 OR q.page_id = p.page_id // 2)) AS html
  FROM pages p)"""
    return urls_sql(rules, damping=damping, tolerance=tolerance, pages=linked)


def embeddings_sql(threshold: float = 0.98) -> str:
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id AS node, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.node AS a, y.node AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.node <> y.node AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= {threshold}
),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_component("nodes", "links")},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component AS component_id, vec_id = component AS kept
FROM embeddings JOIN components ON vec_id = node LEFT JOIN counts ON vec_id = a"""


def contamination_sql(window: int = 10) -> str:
    pattern = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    return f"""
WITH docs AS ({_words("documents", "doc_id", pattern)}),
items AS ({_words("benchmark", "item_id", pattern)}),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {window}) AS size, array_to_string(w[i:i + least(len(w), {window}) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS i FROM items WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) s)
),
hits AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND p.g = v.g),
counts AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counts USING (doc_id) LEFT JOIN found USING (doc_id)"""


def spelling_sql(least_length: int = 6, least_count: int = 5, every: int = 199, times: int = 5) -> str:
    """Near words by joining words that lack one character; CRC-32 bit by bit, as there is no such function."""
    digit = "(position(substr(x, 2 * i + {0}, 1) IN '0123456789ABCDEF') - 1)"
    byte = f"({digit.format(1)} * 16 + {digit.format(2)})"
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(0, len(x) // 2), "
        f"lambda i: [{byte}::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda c, v: xor(xor(c, v) >> 1, 3988292384::BIGINT * (xor(c, v) & 1))), 4294967295::BIGINT)"
    )
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
),
cased AS (SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n FROM runs GROUP BY ALL HAVING length(run) >= {least_length}),
hexed AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM cased),
hashed AS (SELECT run, n, {crc} AS h FROM hexed),
spelt AS (SELECT CASE WHEN h % {every} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= {least_length} GROUP BY word HAVING sum(n) >= {least_count}),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word AS word, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON x.rest = y.word
),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, CASE WHEN near_n >= {times} * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {times} * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
),
walk AS (SELECT word, word AS stop, 0 AS step FROM forms UNION ALL SELECT k.word, f.form, step + 1 FROM walk k JOIN forms f ON k.stop = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(stop, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
