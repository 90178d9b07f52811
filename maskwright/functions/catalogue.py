"""What counts as personal data: categories, their regular expressions, and cheap pre-tests.

The expressions are written for ``java.util.regex`` so that Spark evaluates them inside
generated code. Three rules keep them portable and safe on texts of any length:

* word and blank classes are spelled out, because Java's ``\\b`` and ``\\s`` do not follow the
  ASCII word / Unicode blank rules that the categories are defined with;
* every unbounded repetition is possessive, or repeats a one-character group, so the matcher
  never recurses once per repetition (a 100 kB domain name must not overflow a task's stack);
* an expression starts with the class of its first character, and looks behind only then, so
  most characters are refused by one test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions.checksums import card_match_valid, inn_digits_valid

# ---- fixed values -------------------------------------------------------------------------
# Category names, their order (it breaks ties between hits that start together), the shapes
# they match and the confidence given to a pattern hit are part of the result.

_WORD = "[0-9A-Za-z_]"
_BLANK = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
_SEP = rf"[{_BLANK}\-.()]"
_EDGE = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

EMAIL_RE = (
    rf"(?:{_WORD}(?<!{_WORD}{_WORD})|[.+-](?<={_WORD}[.+-]))[0-9A-Za-z_.+-]*+"
    r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
    rf"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*(?<!\.){_EDGE}"
)
PHONE_RE = (
    rf"(?=[+78])(?<![0-9])(?:\+7|7|8){_SEP}*+[0-9]{{3}}{_SEP}*+[0-9]{{3}}"
    rf"{_SEP}*+[0-9]{{2}}{_SEP}*+[0-9]{{2}}(?![0-9])"
)
INN_RE = r"(?=[0-9])(?<![0-9])(?:[0-9]{10}|[0-9]{12})(?![0-9])"
SNILS_RE = rf"(?=[0-9])(?<![0-9])[0-9]{{3}}-[0-9]{{3}}-[0-9]{{3}}[{_BLANK}-][0-9]{{2}}(?![0-9])"
CARD_RE = r"(?=[0-9])(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9])"
IP_RE = rf"(?=[0-9])(?<!{_WORD})(?:{_OCTET}\.){{3}}{_OCTET}(?!{_WORD})"
URL_RE = rf"h(?<!{_WORD}h)ttps?://[^{_BLANK}<>\"']++"
DATE_RE = (
    rf"(?=[0-9])(?<!{_WORD})(?:0?[1-9]|[12][0-9]|3[01])[./](?:0?[1-9]|1[012])[./]"
    rf"(?:19|20)[0-9]{{2}}(?!{_WORD})"
)

PLACEHOLDER_RE = r"<[A-Z]++_[0-9]{3}>"
PREEXISTING_RE = r"<[A-Z]++_[0-9]{3,}+>"
PATTERN_CONFIDENCE = 0.7
MAX_SAMPLES = 3
POLICIES = ("strict", "balanced", "permissive")

# Categories a caller may ask for. NAME and IBAN need a model and never hit offline.
REQUESTABLE = (
    "CARD", "DATE", "EMAIL", "IBAN", "INN", "IP", "NAME", "PHONE", "SNILS", "URL",
)
# ---- end of fixed values ------------------------------------------------------------------

# Where to look. A text that cannot match is told apart by a byte search, or by one pass shared
# by several categories.
#
# Numbers of ten and more digits are looked for in the text's digit chains only: maximal runs
# of ten or more digits with nothing but separators or plus signs between them. A chain has no
# digit on either side and every such number lies in one chain, so joining the chains with a
# character that no number may hold leaves all matches as they are in the text.
CHAIN = rf"\+?[0-9](?:[{_BLANK}\-.()+]*+[0-9]){{9,}}+"
CHAIN_BREAK = "|"
DOTTED = r"[0-9][./][0-9]{1,3}[./][0-9]"


@dataclass(frozen=True)
class Category:
    """One row of the catalogue. ``place`` names the part of a text that it is looked for in."""

    order: int
    name: str
    regex: str
    place: str
    check: object = None

    def matches(self, part: Column) -> Column:
        """Non-overlapping matches from left to right, before any checksum."""
        return F.regexp_extract_all(part, F.lit(self.regex), 0)

    def keep_valid(self, matches: Column) -> Column:
        return matches if self.check is None else F.filter(matches, self.check)


CATEGORIES = (
    Category(0, "EMAIL", EMAIL_RE, "around_at"),
    Category(1, "PHONE", PHONE_RE, "chains"),
    Category(2, "INN", INN_RE, "chains", inn_digits_valid),
    Category(3, "SNILS", SNILS_RE, "chains"),
    Category(4, "CARD", CARD_RE, "chains", card_match_valid),
    Category(5, "IP", IP_RE, "dotted"),
    Category(6, "URL", URL_RE, "scheme"),
    Category(7, "DATE", DATE_RE, "dotted"),
)

# Each gives the text to search, or null where there is nothing to find.
PLACES = {
    "around_at": lambda text: F.when(F.contains(text, F.lit("@")), text),
    "chains": lambda text: F.nullif(
        F.array_join(F.regexp_extract_all(text, F.lit(CHAIN), 0), CHAIN_BREAK), F.lit("")
    ),
    "dotted": lambda text: F.when(F.rlike(text, F.lit(DOTTED)), text),
    "scheme": lambda text: F.when(F.contains(text, F.lit("://")), text),
}


def wanted(categories=None) -> tuple[Category, ...]:
    """Catalogue rows for a list of names. Case does not matter; an empty list means all."""
    if not categories:
        return CATEGORIES
    names = {str(c).upper() for c in categories}
    return tuple(c for c in CATEGORIES if c.name in names)
