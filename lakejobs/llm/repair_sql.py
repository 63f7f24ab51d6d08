"""DuckDB SQL for damage and repair of conversations: a DP over strings from the last turn on."""

from __future__ import annotations

# State reached by an inserted or reroled turn, from: nothing, s, u, a (1 to 4 in SQL).
FILLED = [3, 3, 4, 3]


def _edit(value: str, add: str, letter: str) -> str:
    """A cost of 12 digits and the letters behind it, with one more edit in front."""
    return (f"printf('%012d', CAST(left({value}, 12) AS BIGINT) + {add}) || '{letter}' "
            f"|| substr({value}, 13)")


def _turn(state: int) -> str:
    """The least of deleting, keeping and reroling a turn."""
    kept = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}[state]
    keeps = " ".join(f"WHEN initial = '{k}' THEN {_edit(f'v[{to}]', 'late', 'K')}"
                     for k, to in kept.items())
    return (f"least({_edit(f'v[{state}]', '4', 'D')}, CASE WHEN gone THEN NULL {keeps} END, "
            f"CASE WHEN NOT gone THEN {_edit(f'v[{FILLED[state - 1]}]', '3 + late', 'R')} END)")


def _place(state: int) -> str:
    """The least with up to two turns inserted before."""
    one = FILLED[state - 1]
    two = FILLED[one - 1]
    twice = _edit("(" + _edit(f"w[{two}]", "3", "I") + ")", "3", "I")
    return f"least(w[{state}], {_edit(f'w[{one}]', '3', 'I')}, {twice})"


def oracle() -> str:
    turns = ", ".join(_turn(q) for q in (1, 2, 3, 4))
    places = ", ".join(_place(q) for q in (1, 2, 3, 4))
    return rf"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                       list_prepend(i, range(8)), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
                   coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        marked AS (
            SELECT conv_id, turn, role, text,
                   xor(list_reduce(list_prepend(4294967295, list_transform(
                           string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
            FROM keyed CROSS JOIN crc),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '')
                        ELSE text END AS text,
                   unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
            FROM marked WHERE k <> 0),
        numbered AS (
            SELECT *, left(role, 1) AS initial, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
            FROM damaged),
        seen AS (
            SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
            FROM numbered),
        rows_ AS (
            SELECT conv_id, n, role, text, initial, turn, blank, again AND NOT blank AS again,
                   cut AND NOT blank AND NOT again AS cut, blank OR again AS gone, pair,
                   CASE WHEN cut THEN 3 ELSE 0 END AS late FROM seen),
        told AS (
            SELECT conv_id, count(*) AS many,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
                   count(*) FILTER (cut) AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows_ GROUP BY conv_id),
        dp AS (
            SELECT conv_id, many + 1 AS i, ['000000000000', '000000000006II', '000000000003I',
                                            '000000000000'] AS v FROM told
            UNION ALL
            SELECT conv_id, i, [{places}] FROM (
                SELECT dp.conv_id, rows_.n AS i, [{turns}] AS w
                FROM dp JOIN rows_ ON rows_.conv_id IS NOT DISTINCT FROM dp.conv_id
                                  AND rows_.n = dp.i - 1)),
        found AS (
            SELECT conv_id, CAST(left(v[1], 12) AS BIGINT) AS cost, substr(v[1], 13) AS audit
            FROM dp WHERE i = 1),
        edits AS (
            SELECT conv_id, p, audit[p] AS edit, length(replace(audit[1:p], 'I', '')) AS n
            FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM found)),
        placed AS (
            SELECT edits.conv_id, p, edit, role, text, initial, row_number() OVER (
                       PARTITION BY edits.conv_id ORDER BY p) AS e
            FROM edits LEFT JOIN rows_ ON rows_.conv_id IS NOT DISTINCT FROM edits.conv_id
                                      AND rows_.n = edits.n AND edit <> 'I'
            WHERE edit <> 'D'),
        lined AS (
            SELECT conv_id, p, CASE
                       WHEN edit = 'K' THEN role
                       WHEN (e - max(CASE WHEN e = 1 AND edit = 'K' AND initial = 's' THEN 1
                                          ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1
                       THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, '') AS line
            FROM placed),
        texts AS (
            SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS whole FROM lined
            GROUP BY conv_id)
        SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
               coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
               sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) every
        LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM every.conv_id
        LEFT JOIN found ON found.conv_id IS NOT DISTINCT FROM every.conv_id
        LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM every.conv_id"""
