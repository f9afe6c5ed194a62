"""Filters and classifiers of lines, pages, rows and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, strip, text, tokens

# Words that are form labels rather than names.
LABEL_WORDS = (
    "EARNINGS", "SUMMARY", "WAGES", "TIPS", "COMPENSATION", "FEDERAL", "STATE", "LOCAL", "INCOME", "TAX", "WITHHELD", "SECURITY", "MEDICARE", "DEPENDENT", "CARE", "BENEFITS",
    "NONQUALIFIED", "PLANS", "ALLOCATED", "ADVANCE", "EIC", "PAYMENT", "SALARY", "BONUS", "TOTAL", "EMPLOYEE", "EMPLOYER", "GROSS", "NET", "PAY", "PERIOD", "YTD", "YEAR", "DATE",
    "AMOUNT", "COPY", "VOID", "CORRECTED", "DEPARTMENT", "TREASURY", "REVENUE", "SERVICE", "INTERNAL", "STATEMENT", "FORM", "WAGE", "AND",
)


def count_of(c: Column, pattern: str) -> Column:
    """Characters in the class ``pattern``."""
    return F.length(F.regexp_replace(text(c), f"[^{pattern}]", ""))


def usable_page(c: Column, least: int = 20) -> Column:
    return F.length(strip(c)) >= least


def garbled(c: Column, share: float = 0.3, single: float = 0.4) -> Column:
    """Too many private-use or control characters, or a line of six alphabetic words or more that are mostly single letters."""
    t = text(c)
    bad = count_of(t, r"\x{E000}-\x{F8FF}\x00-\x08\x0b\x0c\x0e-\x1f")

    def torn(line: Column) -> Column:
        words = F.filter(tokens(line), lambda w: w.rlike(r"^\p{L}+$"))
        ones = F.filter(words, lambda w: (F.length(w) == 1) & ~F.lower(w).isin("a", "i"))
        return (F.size(words) >= 6) & (F.size(ones) > single * F.size(words))

    return (strip(t) != "") & ((bad > share * F.length(t)) | F.exists(F.split(t, "\n"), torn))


def letterish(c: Column) -> Column:
    letters, digits = count_of(c, r"\p{L}"), count_of(c, r"\p{Nd}")
    return (letters >= 3) & (letters > digits)


def claims_readable(c: Column) -> Column:
    """One of the four anchors of a remittance page."""
    return text(c).rlike(r"Health\s*Plan\s*ID\s*:|Pat\.?\s*Acct\s*#|Patient\s+Acct\.?\s*#|Member Totals\s*[:;]")


def page_chrome(c: Column) -> Column:
    s = F.lower(text(c))
    return s.rlike(r"^page\s+\d+\s+of\s+\d+") | strip(s).isin("employee payroll changes", "payroll changes")


def line_kind(c: Column) -> Column:
    """chrome, table, employee, name or data, tried in that order."""
    n = F.lower(clean(c))
    has = lambda w: F.contains(n, F.lit(w))
    table = has("changed") & has("from") & (has("field") | has("to"))
    employee = has("associate id") | has("position id") | has("home department") | has("home cost number")
    return F.when(page_chrome(c), "chrome").when(table, "table").when(employee, "employee").when(text(c).rlike(r"[A-Za-z][A-Za-z'\-\.]*\s*,\s*[A-Za-z]"), "name").otherwise("data")


def pay_row(ee_id: Column, ssn: Column) -> Column:
    return text(ee_id).rlike(r"^[A-Za-z0-9-]{2,15}$") | text(ssn).rlike(r"\d{3}-\d{2}-\d{4}|[*Xx]{3}-[*Xx]{2}-\d{4}")


def mostly_upper(c: Column) -> Column:
    letters = count_of(c, r"\p{L}")
    return (letters >= 3) & (count_of(c, r"\p{Lu}") >= 0.75 * letters)


def looks_like_label(c: Column) -> Column:
    s = strip(c)
    bare = F.regexp_replace(s, ":+$", "")
    n = F.size(tokens(bare))
    return (n <= 8) & (F.endswith(s, F.lit(":")) | (mostly_upper(bare) & (n <= 5)))


def heading_share(cells: Column) -> Column:
    """The share of the filled cells that look like column headings; null without any."""
    own = F.filter(cells, lambda x: strip(x) != "")
    good = F.filter(own, lambda x: (F.size(tokens(x)) <= 5) & ~x.rlike(r"\d{4,}") & (x.rlike(r"^\p{Lu}") | mostly_upper(x)))
    return F.try_divide(F.size(good).cast("double"), F.size(own))


def header_row(cells: Column) -> Column:
    """Six in ten of the filled cells look like column headings."""
    return F.coalesce(heading_share(cells) >= 0.6, F.lit(False))


def form_label(c: Column) -> Column:
    return F.arrays_overlap(tokens(F.upper(text(c))), F.array(*[F.lit(w) for w in LABEL_WORDS]))


def page_type(chars: Column, rotation: Column, pages: Column, width: Column, height: Column, encrypted: Column) -> Column:
    """error, rotated, scanned or text, tried in that order."""
    return F.when(encrypted | (pages == 0) | (width <= 0) | (height <= 0), "error").when(rotation != 0, "rotated").when(chars < 15, "scanned").otherwise("text")
