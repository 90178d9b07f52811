"""The same results in DuckDB SQL, by a different route.

RE2 has no look-around. Instead of it, every maximal run of digits is wrapped in two marker
characters, so "no digit before" is an opening marker and "no digit after" a closing one.
Overlaps are resolved by a recursive walk over the ordered hits.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong weight in the operators cannot pass.
INN_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12_FIRST = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12_SECOND = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)

_OPEN, _CLOSE, _PLUS = r"\x{E000}", r"\x{E001}", "chr(57346)"
_BLANK = (
    r"\t\n\v\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)
_GAP = rf"(?:{_CLOSE}[{_BLANK}\-.()]+{_OPEN})?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

# category -> (reads marked text, pattern)
PATTERNS = {
    "EMAIL": (False, r"\b[0-9A-Za-z_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\b"),
    "PHONE": (
        True,
        rf"(?:\+{_OPEN}7|{_OPEN}7|{_OPEN}8){_GAP}[0-9]{{3}}{_GAP}[0-9]{{3}}{_GAP}[0-9]{{2}}"
        rf"{_GAP}[0-9]{{2}}{_CLOSE}",
    ),
    "INN": (True, rf"{_OPEN}(?:[0-9]{{10}}|[0-9]{{12}}){_CLOSE}"),
    "SNILS": (
        True,
        rf"{_OPEN}[0-9]{{3}}{_CLOSE}-{_OPEN}[0-9]{{3}}{_CLOSE}-{_OPEN}[0-9]{{3}}{_CLOSE}"
        rf"[{_BLANK}-]{_OPEN}[0-9]{{2}}{_CLOSE}",
    ),
    "CARD": (True, rf"{_OPEN}[0-9](?:(?:{_CLOSE}[ -]{_OPEN})?[0-9]){{12,18}}{_CLOSE}"),
    "IP": (False, rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b"),
    "URL": (False, rf"\bhttps?://[^{_BLANK}<>\"'']+"),
    "DATE": (
        False,
        r"\b(?:0?[1-9]|[12][0-9]|3[01])[./](?:0?[1-9]|1[012])[./](?:19|20)[0-9]{2}\b",
    ),
}
ORDER = list(PATTERNS)


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '', 'g')"


def _digit(d: str, i: str) -> str:
    return f"cast({d}[{i}] as integer)"


def _dot(d: str, weights: tuple[int, ...]) -> str:
    terms = " + ".join(f"{_digit(d, str(i))} * {w}" for i, w in enumerate(weights, start=1))
    return f"(({terms}) % 11 % 10 = {_digit(d, str(len(weights) + 1))})"


def inn_valid(value: str) -> str:
    d = digits(value)
    return (
        f"CASE length({d}) WHEN 10 THEN {_dot(d, INN_10)} "
        f"WHEN 12 THEN {_dot(d, INN_12_FIRST)} AND {_dot(d, INN_12_SECOND)} ELSE false END"
    )


def luhn_valid(value: str) -> str:
    d = digits(value)
    double = f"2 * {_digit(d, f'length({d}) - i')}"
    return (
        f"(length({d}) BETWEEN 13 AND 19 AND list_sum([CASE WHEN i % 2 = 0 "
        f"THEN {_digit(d, f'length({d}) - i')} "
        f"ELSE {double} - CASE WHEN {double} > 9 THEN 9 ELSE 0 END END "
        f"for i in range(length({d}))]) % 10 = 0)"
    )


def found(keys: str, source: str, categories: list[str] | None = None) -> str:
    """CTEs ending in ``hit``: keys, ord, category, start, stop, raw; valid hits only.

    ``source`` is a SELECT giving the keys and the text as ``t``.
    """
    strip = "replace(replace(replace({}, chr(57344), ''), chr(57345), ''), chr(57346), '+')"
    per = []
    for category in categories or ORDER:
        marked, pattern = PATTERNS[category]
        text = "m" if marked else "t"
        per.append(
            f"SELECT {keys}, {ORDER.index(category)} AS ord, '{category}' AS category, "
            f"regexp_extract_all({text}, '{pattern}') AS ms, "
            f"string_split_regex({text}, '{pattern}') AS gs FROM marked"
        )
    union = "\n  UNION ALL ".join(per)
    return f"""src AS ({source}),
marked AS (
  SELECT *, replace(regexp_replace(t, '([0-9]+)', chr(57344) || '\\1' || chr(57345), 'g'),
                    chr(57345) || '+', chr(57345) || {_PLUS}) AS m FROM src),
listed AS ({union}),
numbered_match AS (
  SELECT {keys}, ord, category, i, {strip.format('ms[i]')} AS raw, {strip.format('gs[i]')} AS gap
  FROM listed, unnest(range(1, len(ms) + 1)) AS n(i)),
placed AS (
  SELECT *, cast(sum(length(gap) + length(raw)) OVER (
      PARTITION BY {keys}, ord ORDER BY i) AS bigint) AS stop
  FROM numbered_match),
hit AS (
  SELECT {keys}, ord, category, stop - length(raw) AS start, stop, raw FROM placed
  WHERE CASE category WHEN 'INN' THEN {inn_valid('raw')}
                      WHEN 'CARD' THEN {luhn_valid('raw')} ELSE true END)"""


def spans(keys: str, source: str) -> str:
    """``found`` plus ``span``: keys, category, start, stop, raw, placeholder, without overlaps."""
    on_walk = " AND ".join(f"r.{k.strip()} = w.{k.strip()}" for k in keys.split(","))
    r_keys = ", ".join(f"r.{k.strip()}" for k in keys.split(","))
    return f"""{found(keys, source)},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY start, ord) AS rn FROM hit),
walk AS (
  SELECT {keys}, rn, stop AS reach, true AS kept FROM ranked WHERE rn = 1
  UNION ALL
  SELECT {r_keys}, r.rn, CASE WHEN r.start >= w.reach THEN r.stop ELSE w.reach END,
         r.start >= w.reach
  FROM walk w JOIN ranked r ON {on_walk} AND r.rn = w.rn + 1),
span AS (
  SELECT {keys}, category, start, stop, raw,
         '<' || category || '_' || CASE WHEN n < 1000 THEN lpad(cast(n AS varchar), 3, '0')
                                        ELSE cast(n AS varchar) END || '>' AS placeholder
  FROM (SELECT ranked.*, row_number() OVER (PARTITION BY {keys}, category ORDER BY start) AS n
        FROM ranked JOIN walk USING ({keys}, rn) WHERE kept))"""


def masked(keys: str, source: str) -> str:
    """``spans`` plus ``masked``: the columns of ``source`` and masked_text."""
    return f"""{spans(keys, source)},
piece AS (
  SELECT {keys}, start, stop, placeholder,
         coalesce(lag(stop) OVER (PARTITION BY {keys} ORDER BY start), 0) AS before
  FROM span),
spliced AS (
  SELECT {keys}, max(stop) AS last_stop,
         string_agg(substr(t, before + 1, start - before) || placeholder, '' ORDER BY start) AS head
  FROM piece JOIN src USING ({keys}) GROUP BY {keys}),
masked AS (
  SELECT src.*, CASE WHEN head IS NULL THEN t
                     ELSE head || substr(t, last_stop + 1) END AS masked_text
  FROM src LEFT JOIN spliced USING ({keys}))"""


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"
