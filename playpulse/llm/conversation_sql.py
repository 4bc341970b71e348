"""SQL for DuckDB of the two conversation queries, from their contracts alone."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string."""
    return f"""xor(4294967295, list_reduce(
        list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, b: list_reduce(
            range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
        4294967295::BIGINT))"""


def _then(path: str, cost: str, edit: str, line: str | None = None) -> str:
    """A path after one more edit: its cost c, audit a and lines t."""
    lines = f"{path}.t || [{line}]" if line else f"{path}.t"
    return f"{{'c': {path}.c + {cost}, 'a': {path}.a || '{edit}', 't': {lines}}}"


def _least(*paths: str) -> str:
    return f"list_sort([{', '.join(paths)}])[1]"


_NEVER = "1000000000"


def _kept(path: str, initial: str) -> str:
    may = f"NOT must_go AND left(role, 1) = '{initial}'"
    return _then(path, f"CASE WHEN {may} THEN extra ELSE {_NEVER} END", "K", "role || ':' || text")


def _renamed(path: str, role: str) -> str:
    cost = f"CASE WHEN must_go THEN {_NEVER} ELSE 3 + extra END"
    return _then(path, cost, "R", f"'{role}:' || text")


# The cheapest path to each state over one more row: start, after s, after u, after a.
_START = _then("s", "4", "D")
_SYSTEM = _least(_then("y", "4", "D"), _kept("s", "s"))
_USER = _least(
    _then("u", "4", "D"),
    *[_kept(path, "u") for path in "sya"],
    *[_renamed(path, "user") for path in "sya"],
)
_ASSISTANT = _least(_then("a", "4", "D"), _kept("u", "a"), _renamed("u", "assistant"))
# And with a turn inserted after it.
_USER_ALSO = _least("u", *[_then(path, "3", "I", "'user:'") for path in "sya"])
_ASSISTANT_ALSO = _least("a", _then("u", "3", "I", "'assistant:'"))

REPAIR = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
), drawn AS (
    SELECT conv_id, turn, role, text, {_crc32('k')} % 20 AS fault FROM given
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE fault <> 0
), digested AS (
    SELECT *, rtrim(text, E' \t\n\x0b\x0c\r') AS bare, sha256(upper(sha256(
        coalesce(length(conv_id::VARCHAR), -1) || ':' || coalesce(conv_id::VARCHAR, '') || ':'
        || sha256(text) || role)) || coalesce(length(turn::VARCHAR), -1) || ':'
        || coalesce(turn::VARCHAR, '')) AS row_key
    FROM damaged
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, row_key) AS i
    FROM digested
), faulty AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS role_before
    FROM placed
), ready AS (
    SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must_go,
           CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra,
           left(role_before, 1) || left(role, 1) AS pair
    FROM faulty
), figures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM ready GROUP BY conv_id
), paths AS (
    -- The cheapest edits of the rows so far for each state: start, after s, after u, after a.
    SELECT conv_id, 0 AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS s,
           {{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}} AS y,
           {{'c': 3, 'a': 'I', 't': ['user:']}} AS u,
           {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}} AS a
    FROM figures
    UNION ALL
    SELECT conv_id, i, s, y, u, {_ASSISTANT_ALSO} AS a FROM (
        SELECT conv_id, i, s, y, {_USER_ALSO} AS u, a FROM (
            SELECT r.conv_id, r.i, {_START} AS s, {_SYSTEM} AS y, {_USER} AS u, {_ASSISTANT} AS a
            FROM paths p JOIN ready r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
        )
    )
), cheapest AS (
    SELECT f.*, {_least('p.s', 'p.a')} AS best
    FROM figures f JOIN paths p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.n
)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN cheapest ON ids.conv_id IS NOT DISTINCT FROM cheapest.conv_id
"""

TRIE = rf"""
WITH coded AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
    SELECT *, dense_rank() OVER (ORDER BY role, text) AS id,
           sha256(length(role) || ':' || role || text) AS said
    FROM coded
), own AS (
    SELECT conv_id, list(id ORDER BY turn NULLS FIRST, said) AS ids,
           {_crc32('conv_id::VARCHAR')} % 4 AS h
    FROM numbered GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.ids[1:c.h], []), c.ids[c.h + 1:]) AS ids
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
    SELECT conv_id, ids[1:d] AS node, d, d = len(ids) AS at_end
    FROM (SELECT conv_id, ids, unnest(range(len(ids) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (at_end), '')) AS ends_sha256
    FROM prefixes GROUP BY node, d
), children AS (
    SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), own_figures AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, (c.n IS NULL)::BIGINT AS leaf,
           (n_convs - 1) * coalesce(t.words, 0) AS saved
    FROM nodes n LEFT JOIN children c ON n.node = c.node
    LEFT JOIN (SELECT DISTINCT id, words FROM numbered) t ON t.id = n.node[n.depth]
), subtrees AS (
    SELECT node[1:k] AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT node, leaf, saved, unnest(range(depth + 1)) AS k FROM own_figures)
    GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM own_figures n JOIN subtrees s ON n.node = s.node
LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""
