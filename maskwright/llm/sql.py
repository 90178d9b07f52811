"""DuckDB SQL for the queries of this subpackage that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWER} AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
                  max(page_id) OVER (PARTITION BY payload) AS first_id
           FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

DECONTAMINATE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
     win AS (SELECT DISTINCT item_id, least(13, len(words)) AS m,
                 array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS gram
             FROM b, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS t(i)
             WHERE len(words) > 0),
     sizes AS (SELECT DISTINCT m FROM win),
     grams AS (SELECT doc_id, i, m, array_to_string(words[i:i + m - 1], ' ') AS gram
               FROM w, sizes, unnest(range(1, len(words) - m + 2)) AS t(i)),
     hits AS (SELECT g.doc_id, g.i, g.m, win.item_id FROM grams g JOIN win USING (m, gram)),
     hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM hits, unnest(range(i, i + m)) AS t(k) GROUP BY doc_id),
     it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""

FILTER_AUDIT = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
    FROM w LEFT JOIN l USING (doc_id)),
cell AS (SELECT part, fails, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic FROM d GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT c AS p FROM letters
      UNION ALL SELECT p || c FROM o JOIN letters ON NOT contains(p, c)),
s AS (SELECT p AS filter_order, k::INT AS step, p[k] AS c, p[1:k - 1] AS earlier
      FROM (SELECT p FROM o WHERE length(p) = 5), range(1, 6) AS r(k)),
m AS (SELECT part, filter_order, step, c,
             sum(CASE WHEN NOT past AND NOT contains(fails, c) THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN NOT past AND contains(fails, c) THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN past AND contains(fails, c) THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN fails = c THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN NOT past AND contains(fails, c) THEN n_good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN NOT past AND contains(fails, c) THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM (SELECT *, length(translate(fails, earlier, '')) < length(fails) AS past FROM cell, s)
      GROUP BY part, filter_order, step, c)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, c)::BIGINT AS shapley
FROM m
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string; one step for each bit."""
    bit = "xor(x // 2, (x % 2) * 3988292384)"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: {bit})"
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda a, b: {byte}))"


def _plus(state: str, cost: str, edit: str, line: str) -> str:
    """A way to a state with one more edit: cost, audit, and the repaired text so far."""
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', "
        f"'t': {state}.t || {line}}} END"
    )


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _turn(*, to: str, keeps: list[str], initial: str, role: str) -> str:
    """The least way into a state: delete the turn there, or keep or rename it from others."""
    ways = [_plus(to, "4", "D", "''")]
    for state in keeps:
        kept = _plus(state, "3 * truncated", "K", "role || ':' || text || chr(10)")
        ways.append(f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {kept} END")
        if role:
            renamed = _plus(state, "3 + 3 * truncated", "R", f"'{role}:' || text || chr(10)")
            ways.append(f"CASE WHEN NOT must_go THEN {renamed} END")
    return _least(*ways)


# States: nothing yet (q0), after a system turn (q1), after a user's (q2), after a pair (q3).
_VALUE = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"


def _inserted(rows: str) -> str:
    """States after inserts: p2 and p3 beside the others."""
    users = [_plus(q, "3", "I", "'user:' || chr(10)") for q in ("q0", "q1", "q3")]
    pair = _plus("p2", "3", "I", "'assistant:' || chr(10)")
    return f"SELECT *, {_least('q3', pair)} AS p3 FROM (SELECT *, {_least('q2', *users)} AS p2 FROM {rows})"


_LAST = "(SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)"

ROLE_REPAIR = rf"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) WHERE k <> 0),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen
    FROM damaged),
turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i,
           left(role, 1) AS initial, lag(left(role, 1)) OVER
               (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS before,
           NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end
    FROM marked),
judged AS (
    SELECT *, blank OR seen AS must_go, (NOT blank AND NOT seen AND open_end)::INT AS truncated FROM turns),
steps AS (
    SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}}::{_VALUE} AS q0, NULL::{_VALUE} AS q1,
           NULL::{_VALUE} AS q2, NULL::{_VALUE} AS q3
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT s.conv_id, s.i + 1, {_plus("q0", "4", "D", "''")},
           {_turn(to="q1", keeps=["q0"], initial="s", role="")},
           {_turn(to="p2", keeps=["q0", "q1", "p3"], initial="u", role="user")},
           {_turn(to="p3", keeps=["p2"], initial="a", role="assistant")}
    FROM ({_inserted("steps")}) s
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1),
ended AS (
    SELECT conv_id, {_least("q0", "p3")} AS best
    FROM ({_inserted(_LAST)})),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
           sum(truncated)::BIGINT AS truncated,
           count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(CASE WHEN best.t = '' THEN '' ELSE left(best.t, -1) END) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
