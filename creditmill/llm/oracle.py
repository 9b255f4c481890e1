"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

PLAIN = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op4_substring_dedup": f"""
        WITH split AS (SELECT doc_id, {WORDS.format(text="text")} AS w FROM documents),
        starts AS (
            SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS passage
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM split)),
        repeated AS (SELECT passage FROM starts GROUP BY passage HAVING count(*) > 1),
        hits AS (SELECT doc_id, i FROM starts JOIN repeated USING (passage)),
        single AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM split),
        marked AS (
            SELECT doc_id, i, word,
                   count(h.i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone
            FROM single s LEFT JOIN hits h USING (doc_id, i)),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(CASE WHEN gone THEN 1 END) AS n_removed,
                   coalesce(string_agg(CASE WHEN NOT gone THEN word END, ' ' ORDER BY i), '') AS kept
            FROM marked GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)
    """,
    "op5_minhash": f"""
        WITH RECURSIVE split AS (SELECT doc_id, {WORDS.format(text=LOWERED)} AS w FROM documents),
        sets AS (
            SELECT doc_id, list_sort(list_distinct(list_transform(
                range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) AS s
            FROM split WHERE len(w) > 0),
        classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets GROUP BY s),
        shingles AS (SELECT rep, n, unnest(s) AS x FROM classes),
        links AS (
            SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.rep <> b.rep
            GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
        reached AS (
            SELECT rep, rep AS other FROM classes
            UNION SELECT reached.rep, links.b FROM reached JOIN links ON reached.other = links.a),
        components AS (SELECT rep, min(other) AS component_id FROM reached GROUP BY rep),
        found AS (
            SELECT doc_id, len(sets.s) AS n_shingles, component_id
            FROM sets JOIN classes ON sets.s = classes.s JOIN components USING (rep))
        SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
               coalesce(component_id, doc_id) = doc_id AS kept
        FROM documents LEFT JOIN found USING (doc_id)
    """,
    "op1_exact_dedup": f"""
        WITH plain AS (SELECT doc_id, {PLAIN} AS plain FROM documents),
        grouped AS (
            SELECT doc_id, sha256(plain) AS text_sha256,
                   min(doc_id) OVER (PARTITION BY plain) AS keep_id,
                   count(*) OVER (PARTITION BY plain) AS group_size
            FROM plain)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
    """,
    "op9_url_filter": r"""
        WITH split AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        rules(verdict, rule_host, rule_path) AS (VALUES
            ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits AS (
            SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   max_by(verdict, length(rule_host || rule_path)) AS verdict
            FROM split JOIN rules
              ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM split LEFT JOIN fits USING (page_id)
    """,
}


def vector_codes_sql(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """k-means of integer parts, one CTE per round; distances and means in exact integers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        d{r} AS (
            SELECT rid, p, e, coalesce(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), 0) AS dist
            FROM parts JOIN cb{r} USING (p)),
        a{r} AS (SELECT rid, p, arg_min(e, dist * {entries} + e) AS e, min(dist) AS dist FROM d{r} GROUP BY rid, p)""")
        if r < rounds:
            steps.append(f"""
        s{r} AS (
            SELECT p, e, i, CAST(floor(sum(xi)::DOUBLE / count(*)) AS BIGINT) AS ci
            FROM (SELECT a.p, a.e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS xi FROM a{r} a JOIN parts USING (rid, p))
            GROUP BY p, e, i),
        u{r} AS (SELECT p, e, list(ci ORDER BY i) AS c FROM s{r} GROUP BY p, e),
        cb{r + 1} AS (SELECT cb.p, cb.e, coalesce(u.c, cb.c) AS c FROM cb{r} cb LEFT JOIN u{r} u USING (p, e))""")
    return f"""
        WITH clean AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        numbered AS (SELECT row_number() OVER (ORDER BY vec_id, v, label) AS rid, vec_id, label, v, len(v) // {parts} AS w FROM clean),
        parts AS (SELECT rid, p, list_slice(v, p * w + 1, (p + 1) * w) AS x FROM numbered, range({parts}) t(p)),
        seeds AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM numbered),
        cb0 AS (SELECT p, e, x AS c FROM parts JOIN seeds USING (rid) WHERE e < {entries}),{",".join(steps)},
        digest AS (
            SELECT sha256(coalesce(string_agg(CAST(ci AS VARCHAR), ',' ORDER BY p, e, i), '')) AS codebooks_sha256
            FROM (SELECT p, e, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS ci FROM cb{rounds})),
        coded AS (
            SELECT rid, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
            FROM a{rounds} GROUP BY rid)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               codebooks_sha256, label
        FROM numbered JOIN coded USING (rid), digest
    """


ORACLE["op11_vector_codes"] = vector_codes_sql()
