"""DuckDB SQL for the secret scan, from the same fixed patterns and tables."""

from __future__ import annotations

from lakejobs.llm.secret_scan import (
    ACCESS, ACCESS_LENGTH, ALLOWED, ALLOWED_BEFORE, ASSIGN, ASSIGN_VALUE, BASE_KINDS, BEFORE,
    CLASSES, HEX_LENGTH, cost_table, most_cost,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _hits(kind: str, pattern: str, least: str) -> str:
    """Matches of a pattern with their first code point; ``least`` tells those that count."""
    p = _text(pattern)
    return f"""
        SELECT doc_id, '{kind}' AS kind, t, m[i] AS hit,
               CAST(list_sum(list_transform(s[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)
                    AS BIGINT) AS begin
        FROM (SELECT doc_id, t, m, s, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, t, regexp_extract_all(t, {p}) AS m,
                           regexp_split_to_array(t, {p}) AS s FROM docs))
        WHERE {least}"""


def _entropy(kind: str, characters: str, window: int, bits: float) -> str:
    hits = _hits(kind, f"[{characters}]{{{window},}}", "true")
    costs = cost_table(window)
    return f"""
        SELECT doc_id, '{kind}' AS kind, begin + min(w) AS begin,
               begin + max(w) + {window} AS stop
        FROM (SELECT *, sum(CAST(w - before > {window} AS INTEGER)) OVER (
                     PARTITION BY doc_id, begin ORDER BY w) AS island
              FROM (SELECT *, coalesce(lag(w) OVER (PARTITION BY doc_id, begin ORDER BY w), w)
                           AS before
                    FROM (SELECT doc_id, begin, hit, unnest(range(0, length(hit) - {window - 1}))
                                 AS w
                          FROM ({hits})
                          WHERE NOT regexp_matches(hit, {_text(ALLOWED)})
                            AND NOT regexp_matches(
                                right(left(t, begin), {BEFORE}), {_text(ALLOWED_BEFORE + "$")}))
                    WHERE list_sum(list_transform(
                        map_values(list_histogram(string_split(substr(hit, w + 1, {window}), ''))),
                        lambda c: {costs}[CAST(c AS BIGINT) + 1])) <= {most_cost(window, bits)}))
        GROUP BY doc_id, begin, island"""


def oracle() -> str:
    cased = ASSIGN
    for word in ("password", "passwd", "secret", "token", "api_?key"):
        cased = cased.replace(word, "".join(
            f"[{c}{c.upper()}]" if c.isalpha() else c for c in word), 1)
    value = f"length(regexp_extract(m[i], {_text(cased)}, 2)) >= {ASSIGN_VALUE}"
    base = [
        ("assign", cased, value),
        ("access", ACCESS, f"length(m[i]) >= {ACCESS_LENGTH}"),
        ("hex", f"[0-9a-f]{{{HEX_LENGTH},}}", "true"),
    ]
    parts = [f"SELECT doc_id, kind, begin, begin + length(hit) AS stop FROM ({_hits(*b)})"
             for b in base] + [_entropy(*c) for c in CLASSES]
    kinds = BASE_KINDS + [c[0] for c in CLASSES]
    of_base = f"kind IN ({', '.join(map(_text, BASE_KINDS))})"
    in_order = f"ORDER BY begin, list_position({kinds}, kind), stop"
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({' UNION ALL '.join(parts)}),
        told AS (
            SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
                   count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(kind || ':' || begin || ':' || stop, ',' {in_order})
                       FILTER ({of_base}) AS base,
                   string_agg(kind || ':' || begin || ':' || stop, ',' {in_order}) AS spans
            FROM spans GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(n_assign, 0) AS n_assign,
               coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN told ON documents.doc_id = told.doc_id"""
