"""DuckDB SQL for lexical search, clustering and the secret scan."""

from __future__ import annotations

from tellerlake.llm import lexical, secrets

_WORDS = f"regexp_extract_all(translate(text, '{lexical.UPPER}', '{lexical.LOWER}'), '{lexical.TERM}')"

LEXICAL = f"""
    WITH d AS (SELECT *, len(terms)::BIGINT AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS terms FROM documents WHERE text IS NOT NULL) WHERE len(terms) > 0),
    c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS all_terms FROM d),
    i AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
    f AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term, n_docs),
    s AS (
        SELECT i.item_id, f.r, any_value(d.doc_id) AS doc_id,
               sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // all_terms)))))::BIGINT AS score
        FROM i JOIN f USING (term) JOIN w USING (term) JOIN d ON d.r = f.r, c GROUP BY i.item_id, f.r
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 50"""


def _round(n: int) -> str:
    """Centroids c<n+1> from the nearest of c<n>."""
    return f"""
    a{n} AS (SELECT v.r, arg_min(c.k, (list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.k)) AS k FROM v, c{n} AS c GROUP BY v.r),
    m{n} AS (SELECT k, list(x ORDER BY j) AS e FROM (
        SELECT k, j, floor(sum(e[j])::DOUBLE / count(*))::BIGINT AS x FROM v JOIN a{n} USING (r), range(1, 65) AS t(j) GROUP BY k, j) GROUP BY k),
    c{n + 1} AS (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{n} AS c LEFT JOIN m{n} AS m USING (k)),"""


CLUSTERS = f"""
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1)::INT AS k, e FROM v WHERE vec_id IS NOT NULL ORDER BY k LIMIT 16),
    {"".join(_round(n) for n in range(3))}
    d AS (SELECT v.vec_id, c.k, c.e, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance, v.r
          FROM v, c3 AS c QUALIFY row_number() OVER (PARTITION BY v.r ORDER BY distance, c.k) = 1)
    SELECT vec_id, k AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(e, ',')) AS centroid_sha256 FROM d"""


def _folded(word: str) -> str:
    """A word in either case, ASCII only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    named = []
    for n, rule in enumerate(secrets.NAMED):
        pattern = rule.pattern
        if "(?i:" in pattern:
            words = pattern.split("(?i:")[1].split(")")[0]
            pattern = pattern.replace(f"(?i:{words})", "|".join(map(_folded, words.split("|"))))
        named.append((n, rule.kind, pattern, rule.group, rule.least))
    first = len(named)
    runs = [(first + n, c.kind, c.pattern, 0, secrets.WINDOW, secrets.limit(c.bits, secrets.WINDOW)) for n, c in enumerate(secrets.CLASSES)]

    def found(n: int, kind: str, pattern: str, group: int) -> str:
        p = _quoted(pattern)
        return f"""SELECT r, {n} AS n, '{kind}' AS kind, unnest(regexp_extract_all(text, {p}, 0)) AS found, unnest(regexp_extract_all(text, {p}, {group})) AS part,
            unnest(string_split_regex(text, {p})) AS before, unnest(range(len(text) + 1)) AS j FROM t WHERE regexp_matches(text, {p})"""

    window = secrets.WINDOW
    least = " ".join(f"WHEN {n} THEN {least}" for n, _, _, _, least in named)
    limits = " ".join(f"WHEN {n} THEN {most}" for n, _, _, _, _, most in runs)
    allowed = " OR ".join(f"regexp_matches(found, {_quoted(p)})" for p in secrets.ALLOWED)
    return f"""
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    m AS ({" UNION ALL ".join(found(*x[:4]) for x in [*named, *runs])}),
    p AS (SELECT * REPLACE (right(coalesce(lag(found) OVER (PARTITION BY r, n ORDER BY j), '') || before, {secrets.CONTEXT}) AS before), (sum(len(before) + len(found)) OVER (PARTITION BY r, n ORDER BY j)) - len(found) AS s FROM m WHERE found IS NOT NULL),
    base AS (SELECT r, n, kind, s, s + len(found) AS e FROM p WHERE n < {first} AND len(part) >= CASE n {least} END),
    x AS (SELECT r, n, kind, s, found, before, unnest(range(0, len(found) - {window} + 1)) AS i FROM p WHERE n >= {first}),
    h AS (SELECT r, n, s, i, sum(round(k * log2(k) * {secrets.UNIT})) AS excess FROM (
        SELECT r, n, s, i, c, count(*) AS k FROM (SELECT r, n, s, i, unnest(string_split(substring(found, i + 1, {window}), '')) AS c FROM x) GROUP BY ALL) GROUP BY ALL),
    g AS (SELECT x.*, i - lag(i) OVER (PARTITION BY r, n, s ORDER BY i) AS gap FROM x JOIN h USING (r, n, s, i) WHERE excess <= CASE n {limits} END),
    u AS (SELECT *, sum(CASE WHEN gap <= {window} THEN 0 ELSE 1 END) OVER (PARTITION BY r, n, s ORDER BY i) AS island FROM g),
    w AS (SELECT r, n, kind, s + min(i) AS s, s + max(i) + {window} AS e, substring(any_value(found), min(i) + 1, max(i) - min(i) + {window}) AS found,
                 right(any_value(before) || left(any_value(found), min(i)), {secrets.CONTEXT}) AS before FROM u GROUP BY r, n, kind, u.s, island),
    a AS (SELECT *, {allowed} OR regexp_matches(before, {_quoted(secrets.ALLOWED_BEFORE)}) AS allowed FROM w),
    b AS (SELECT r, {", ".join(f"count_if(kind = '{k}')::BIGINT AS n_{k}" for _, k, *_ in named)}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) AS listed FROM base GROUP BY r),
    o AS (SELECT r, count_if(n >= {first})::BIGINT AS n_entropy, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) AS spans
          FROM (SELECT r, n, kind, s, e FROM base UNION ALL SELECT r, n, kind, s, e FROM a WHERE NOT allowed) GROUP BY r),
    z AS (SELECT r, count(*)::BIGINT AS n_allowed FROM a WHERE allowed GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for _, k, *_ in named)}, sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans,
           coalesce(n_entropy, 0) AS n_entropy, coalesce(n_allowed, 0) AS n_allowed
    FROM t LEFT JOIN b USING (r) LEFT JOIN o USING (r) LEFT JOIN z USING (r)"""


SQL = {"op11_aho_corasick_search": LEXICAL, "op12_va_file_clusters": CLUSTERS, "op13_entropy_secrets": _secrets()}
