"""String functions over columns. Missing text is ''; white space is trimmed as a whole class, not blanks alone."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Look-alike letters and the digits they stand for, quotes and dashes that are folded, safe words, stop words.
LOOKALIKE_FROM = "OoQDIli|ZzSsGbTBgq"
LOOKALIKE_TO = "000011112255667899"
FOLD_FROM = "‘’´`“” –—"
FOLD_TO = "''''\"\" --"
SAFE_WORDS = (
    "health", "plan", "id", "claim", "status", "paid", "pat", "acct", "payee",
    "service", "date", "revenue", "code", "cpt", "billed", "amount", "not",
    "allowed", "contract", "adjust", "interest", "penalty", "deduct", "coin",
    "copay", "net", "amt", "user", "comments", "member", "totals", "line",
    "ver", "received", "from", "to", "proc", "mod", "qty", "patient", "name",
    "provider", "business", "medi", "cal", "no", "pcp", "network", "reason",
    "of", "by", "program", "all", "programs", "combined", "check", "vendor",
    "group", "community", "clinics", "connect", "e", "p", "s", "t", "ra",
)
STOP_WORDS = (
    "the", "and", "for", "of", "to", "in", "on", "is", "are", "or", "by",
    "with", "this", "that", "as", "be", "an", "at", "from", "your", "you",
    "will", "not", "may", "any", "all", "such", "into", "than", "then",
    "have", "has", "was", "were", "been", "each", "date", "page",
)


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def let(c: Column, use) -> Column:
    """``use(c)`` with ``c`` worked out once, for functions that name their argument many times."""
    return F.get(F.transform(F.array(c), lambda x: use(x)), F.lit(0))


def clean(c: Column) -> Column:
    """White space collapsed to single blanks and trimmed."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """Words between white space; none in an empty text."""
    return F.filter(F.split(clean(c), " "), lambda x: x != "")


def at(words: Column, n: int) -> Column:
    """The n-th word (negative: from the end), or ''."""
    return F.coalesce(F.try_element_at(words, F.lit(n)), F.lit(""))


def joined(words: Column, first: Column | int, count: Column, sep: str = " ") -> Column:
    """``count`` words from place ``first``; '' if there are none."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(count > 0, F.array_join(F.slice(words, first, F.greatest(count, F.lit(1))), sep)).otherwise(F.lit(""))


def fold(c: Column) -> Column:
    """Typographic quotes, dashes and hard blanks as plain ASCII, runs of blanks and tabs as one; compatibility forms only where a text isn't ASCII."""
    folded = F.translate(F.when(F.length(F.regexp_replace(text(c), r"[\x00-\x7F]", "")) > 0, _nfkc(text(c))).otherwise(text(c)), FOLD_FROM, FOLD_TO)
    return strip(F.regexp_replace(folded, "[ \\t]+", " "))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def fix_digits(c: Column) -> Column:
    """Letters that scanners mistake for digits, as digits."""
    return F.translate(text(c), LOOKALIKE_FROM, LOOKALIKE_TO)


def mask(c: Column) -> Column:
    """Digits as #, ASCII letters as X."""
    return F.regexp_replace(F.regexp_replace(text(c), r"[0-9]", "#"), r"[A-Za-z]", "X")


def redact_value(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text(c), r"\p{Nd}", "#"), r"\p{L}", "X")


def redact_words(c: Column) -> Column:
    """Words outside the safe list, masked; words are parted by single blanks."""
    safe = F.array(*[F.lit(w) for w in SAFE_WORDS])
    bare = lambda w: F.lower(F.btrim(w, F.lit(":#.,()/-'’")))
    return F.array_join(F.transform(F.split(text(c), " "), lambda w: F.when(F.array_contains(safe, bare(w)), w).otherwise(redact_value(w))), " ")


def column_key(c: Column) -> Column:
    """A header for lookups: runs of white space and dashes as one blank, lower case."""
    return F.trim(F.lower(F.regexp_replace(text(c), r"(?U)[\s–—-]+", " ")))


def title(c: Column) -> Column:
    """Every run of letters with a capital first: O'Brien, Smith-Jones."""
    runs = F.regexp_extract_all(F.lower(text(c)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1_000_000))), "")


def vocabulary(c: Column, least: int = 4) -> Column:
    """Sorted distinct letters-only words of ``least`` letters or more that aren't stop words."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    bare = F.transform(tokens(F.lower(text(c))), lambda w: F.regexp_replace(w, r"\P{L}", ""))
    return F.array_sort(F.array_distinct(F.filter(bare, lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w))))


def formula_safe(c: Column) -> Column:
    """An apostrophe before values that a spreadsheet would read as a formula."""
    return F.when(F.substring(text(c), 1, 1).isin("=", "+", "-", "@"), F.concat(F.lit("'"), text(c))).otherwise(text(c))


def printable(c: Column) -> Column:
    """Without the control characters that workbooks refuse."""
    return F.regexp_replace(text(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
