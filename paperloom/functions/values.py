"""Identifiers, money, dates, addresses and form values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import at, clean, fix_digits, joined, let, strip, text, tokens

# Shapes of identifiers, amounts, dates and address lines; country names; values of an unset box.
SSN = r"\b(\d{3})[-\s]?(\d{2})[-\s]?(\d{4})\b"
SSN_FORM = r"(?:\d{3}-\d{2}-\d{4}|[Xx\*]{3}-[Xx\*]{2}-\d{4}|\d{9})"
SSN_PAY = r"\d{3}-\d{2}-\d{4}|[*Xx]{3}-[*Xx]{2}-\d{4}"
SSN_RUN = r"[\dXx\*\-]{9,}"
EIN = r"\d{2}-\d{7}"
TIN = f"(?:{EIN}|{SSN_FORM})"
MONEY = r"\(?-?\$?\s?\d[\d,]*(?:\.\d{2})?\)?"
AMOUNT = r"\$?\s*(\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?|\d+(?:\.\d{1,2})?)"
DATE = r"\d{1,2}/\d{1,2}/\d{2,4}"
PROCEDURE = r"[A-Za-z]?\d{3,5}"
CITY_STATE_ZIP = r"^(.+?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\b"
CITY_STATE_ZIP_COUNTRY = r"^(.+?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\b\s*(.*)$"
US_ZIP_END = r"\b([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
CANADA_END = r"\b([A-Z]{2})\s+([A-Z]\d[A-Z]\s*\d[A-Z]\d)\s*$"
COUNTRIES = (
    "canada", "mexico", "australia", "united kingdom", "uk", "england",
    "germany", "france", "italy", "spain", "japan", "china", "india",
)
UNSET = ("", "off", "/off", "no", "/no", "false", "/false")
NO_VALUE = ("", "no value", "n/a", "none", "null", "-", "–", "—")


def ssn(c: Column) -> Column:
    """The first nine-digit number with optional separators, dashed; ''."""
    a, b, d = (F.regexp_extract(text(c), SSN, i) for i in (1, 2, 3))
    return F.when(a != "", F.concat_ws("-", a, b, d)).otherwise(F.lit(""))


def ssn_repaired(c: Column) -> Column:
    """As ``ssn``; where there is none, once more with look-alike letters read as digits."""
    return F.coalesce(F.nullif(ssn(c), F.lit("")), ssn(fix_digits(c)))


def ssn_canonical(c: Column) -> Column:
    """Partial and masked numbers in the form ddd-dd-dddd with X for what is unknown; other text as it is."""
    return let(clean(c), _ssn_canonical)


def _ssn_canonical(s: Column) -> Column:
    g = lambda p, n: F.regexp_extract(s, p, n)
    short, front = r"^(\d{3})-(\d{2})-(\d{1,3})$", r"^(\d{3})-(\d{2})$"
    mid, head, both = r"^(\d{3})-[xX*]+-(\d{4})$", r"^[xX*]+-(\d{2})-(\d{4})$", r"^[xX*]+-[xX*]+-(\d{4})$"
    d = F.regexp_replace(s, r"\D", "")
    n = F.length(d)
    p = lambda a, k: F.substring(d, a, k)
    dash = lambda *x: F.concat_ws("-", *x)
    x = F.lit
    return (
        F.when(s == "", s)
        .when(s.rlike(r"(?i)^[\dX]{3}-[\dX]{2}-[\dX]{4}$"), F.upper(s))
        .when(s.rlike(short), dash(g(short, 1), g(short, 2), F.rpad(g(short, 3), 4, "X")))
        .when(s.rlike(front), dash(g(front, 1), g(front, 2), x("XXXX")))
        .when(s.rlike(mid), dash(g(mid, 1), x("XX"), g(mid, 2)))
        .when(s.rlike(head), dash(x("XXX"), g(head, 1), g(head, 2)))
        .when(s.rlike(both), dash(x("XXX"), x("XX"), g(both, 1)))
        .when(n >= 9, dash(p(1, 3), p(4, 2), p(6, 4)))
        .when((n >= 6) & (n <= 8), dash(p(1, 3), p(4, 2), F.rpad(p(6, 3), 4, "X")))
        .when(n == 5, dash(p(1, 3), p(4, 2), x("XXXX")))
        .when(n == 4, dash(p(1, 3), F.concat(p(4, 1), x("X")), x("XXXX")))
        .when(n == 3, dash(d, x("XX"), x("XXXX")))
        .otherwise(s)
    )


def ssn_in_cell(c: Column) -> Column:
    """The number in a table cell: whole, padded with X, or one of four partial forms in turn."""
    return let(clean(c), _ssn_in)


def _ssn_in(s: Column) -> Column:
    g = lambda p, n: F.regexp_extract(s, p, n)
    whole, padded = r"\b(\d{3}-\d{2}-\d{4})\b", r"(?i)(?<!\d)(\d{3}-\d{2}-[\dxX*]{1,4})(?![\dxX*])"
    short, front = r"\b(\d{3}-\d{2}-\d{1,3})\b(?!\d)", r"\b(\d{3}-\d{2})\b(?!\s*-?\s*\d)"
    last, mid = r"[xX*]{3}[- ][xX*]{2}[- ](\d{4})\b", r"\b(\d{3})[- ][xX*]{2}[- ](\d{4})\b"
    found = F.coalesce(*[F.nullif(g(p, 1), F.lit("")) for p in (whole, padded, short, front)])
    rest = F.when(g(last, 1) != "", F.concat(F.lit("XXX-XX-"), g(last, 1))).when(g(mid, 1) != "", F.concat(g(mid, 1), F.lit("-XX-"), g(mid, 2)))
    return F.coalesce(let(F.coalesce(found, rest), ssn_canonical), F.lit(""))


def ssn_pay(c: Column) -> Column:
    """A dashed or masked number; nine digits get dashes, other text keeps its digits."""
    s = strip(c)
    d = F.regexp_replace(s, r"\D", "")
    found = F.regexp_extract(s, f"({SSN_PAY})", 1)
    return F.when(found != "", found).when(F.length(d) == 9, F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 2), F.substring(d, 6, 4))).otherwise(d)


def plan_id(c: Column) -> Column:
    """The first word with a digit after the plan label."""
    tail = F.regexp_extract(text(c), r"(?s)Health\s*Plan\s*ID\s*:(.*)$", 1)
    return at(F.filter(tokens(tail), lambda w: w.rlike(r"\d")), 1)


def claim_number(c: Column) -> Column:
    """The word after the claim label, glued to a short continuation."""
    t = tokens(F.regexp_extract(text(c), r"(?s)Claim\s*:(.*)$", 1))
    return F.concat(at(t, 1), F.when(at(t, 2).rlike("^[A-Za-z0-9-]{1,3}\\d+$"), at(t, 2)).otherwise(F.lit("")))


def amount(c: Column) -> Column:
    """The first amount without commas, with two decimals; ''."""
    raw = F.regexp_replace(F.regexp_extract(text(c), AMOUNT, 1), ",", "")
    return F.coalesce(F.when(raw != "", raw.try_cast("decimal(38,2)").cast("string")), F.lit(""))


def plan_amount(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(clean(c), AMOUNT, 1), ",", "")


def money(c: Column) -> Column:
    return strip(F.regexp_extract(text(c), f"({MONEY})", 1))


def date(c: Column) -> Column:
    """M/D/YYYY, else M/D/YY where 69 to 99 are of the last century; null for other text."""
    s = text(c)
    m, d, y = (F.regexp_extract(s, r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$", i) for i in (1, 2, 3))
    two = y.try_cast("int")
    year = F.when(F.length(y) == 4, two).when(two >= 69, two + 1900).otherwise(two + 2000)
    return F.when(y != "", F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"))


def us_date(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "MM/dd/yyyy"), F.lit(""))


def pdf_date(c: Column) -> Column:
    """D:YYYYMMDDHHmmSS+hh'mm' as an ISO-like text; other text as it is."""
    raw = text(c)
    s = F.regexp_replace(raw, "^D:", "")
    part = lambda a, n: F.substring(s, a, n)
    digits = lambda a: F.when(part(a, 2).rlike(r"^\d+$"), part(a, 2))
    tz = F.regexp_replace(s.substr(F.lit(15), F.length(s)), "'", "")
    zone = F.when(tz.rlike("^[+-]") & (F.length(tz) >= 5), F.concat(F.substring(tz, 1, 3), F.lit(":"), F.substring(tz, 4, 2))).when(tz == "Z", F.lit("UTC")).otherwise(tz)
    day = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    return F.when(~s.rlike(r"^\d{8}"), raw).otherwise(F.concat_ws(" ", day, F.nullif(F.concat_ws(":", digits(9), digits(11), digits(13)), F.lit("")), F.nullif(zone, F.lit(""))))


def visible_date(c: Column) -> Column:
    s = clean(F.regexp_replace(text(c), "'", ""))
    s = F.regexp_replace(s, r"^(\d{4})[./](\d{2})[./](\d{2})", "$1-$2-$3")
    return F.regexp_replace(s, r"\s*([+-]\d{2})\s*(\d{2})$", " $1:$2")


def last_date_and_code(c: Column) -> Column:
    """date and code: the last date of a line and the first code token after it."""
    dates = F.regexp_extract_all(text(c), F.lit(f"({DATE})"), F.lit(1))
    tail = F.regexp_extract(text(c), rf"(?s)^.*{DATE_LAST}(.*)$", 1)
    return F.struct(at(dates, -1).alias("date"), F.when(F.size(dates) > 0, F.regexp_extract(tail, f"({PROCEDURE})", 1)).otherwise(F.lit("")).alias("code"))


#: The last of the dates in a line, after greedy text; its first digit must not belong to a longer number.
DATE_LAST = r"(?<!\d)\d{1,2}/\d{1,2}/\d{2,4}"


def city_state_zip(c: Column) -> Column:
    s = text(c)
    return F.struct(F.regexp_replace(F.regexp_extract(s, CITY_STATE_ZIP, 1), ",+$", "").alias("city"), F.regexp_extract(s, CITY_STATE_ZIP, 2).alias("state"), F.regexp_extract(s, CITY_STATE_ZIP, 3).alias("zip"))


def city_state_zip_country(c: Column) -> Column:
    s = text(c)
    g = lambda n: F.regexp_extract(s, CITY_STATE_ZIP_COUNTRY, n)
    return F.struct(F.regexp_replace(g(1), ",+$", "").alias("city"), g(2).alias("state"), g(3).alias("zip"), strip(g(4)).alias("country"))


def creditor_address(lines: Column) -> Column:
    """street, city, state, zip of address lines; a last line that names a country goes first."""
    with_size = lambda own: F.struct(own.alias("own"), (F.size(own) - F.lower(at(own, -1)).isin(*COUNTRIES).cast("int")).alias("n"))
    with_last = lambda x: F.struct(x["own"].alias("own"), x["n"].alias("n"), F.when(x["n"] > 0, F.get(x["own"], x["n"] - 1)).otherwise(F.lit("")).alias("last"))
    return let(F.filter(F.transform(lines, clean), lambda x: x != ""), lambda own: let(with_size(own), lambda x: let(with_last(x), _creditor_address)))


def _creditor_address(x: Column) -> Column:
    own, n, last = x["own"], x["n"], x["last"]
    us = last.rlike(US_ZIP_END)
    hit = us | last.rlike(CANADA_END)
    g = lambda k: F.when(us, F.regexp_extract(last, US_ZIP_END, k)).otherwise(F.regexp_extract(last, CANADA_END, k))
    head = F.when(us, F.regexp_replace(last, US_ZIP_END, "")).otherwise(F.regexp_replace(last, CANADA_END, ""))
    e = F.lit("")
    return F.struct(
        F.when(hit, joined(own, 1, n - 1, ", ")).otherwise(joined(own, 1, n, ", ")).alias("street"),
        F.when(hit, strip(F.regexp_replace(head, "[, ]+$", ""))).otherwise(e).alias("city"), F.when(hit, g(1)).otherwise(e).alias("state"), F.when(hit, F.regexp_replace(g(2), " ", "")).otherwise(e).alias("zip"),
    )


def comma_address(c: Column) -> Column:
    """street, city, state, zip of "street, city, ST zip" or "street, city ST zip"; else all is street."""
    raw = text(c)
    parts = F.filter(F.transform(F.split(raw, ","), strip), lambda x: x != "")
    last, n = at(parts, -1), F.size(parts)
    two, three = r"^([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$", r"^(.+?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
    a, b = last.rlike(two), last.rlike(three)
    g = F.regexp_extract
    return F.struct(
        F.when(n == 0, "").when(a, joined(parts, 1, n - 2, ", ")).when(b, joined(parts, 1, n - 1, ", ")).otherwise(raw).alias("street"),
        F.when(a, at(parts, -2)).when(b, strip(g(last, three, 1))).otherwise("").alias("city"),
        F.when(a, g(last, two, 1)).when(b, g(last, three, 2)).otherwise("").alias("state"), F.when(a, g(last, two, 2)).when(b, g(last, three, 3)).otherwise("").alias("zip"),
    )


def zip_country(c: Column) -> Column:
    """zip and country of a box whose caption may have left words in front."""
    s = strip(F.regexp_replace(text(c), r"(?i)^(?:\b(?:or|foreign|postal|code)\b\s*)+", ""))
    z = F.regexp_extract(s, r"(\d{5}(?:-\d{4})?)", 1)
    return F.struct(z.alias("zip"), F.when(z != "", strip(F.regexp_extract(s, r"(?s)^(.*?)\d{5}(?:-\d{4})?", 1))).otherwise(s).alias("country"))


def box_value(raw: Column, is_box: Column) -> Column:
    """Yes or No of a check box; other values without a leading slash, cleaned."""
    s = strip(raw)
    return F.when(is_box, F.when(F.lower(s).isin(*UNSET), "No").otherwise("Yes")).otherwise(clean(F.regexp_replace(s, "^/", "")))


def chosen_value(old: Column, new: Column) -> Column:
    """The new value, or the old one where the new says nothing."""
    n = strip(new)
    return F.when(F.lower(n).isin(*NO_VALUE), strip(old)).otherwise(n)


def eta(seconds: Column) -> Column:
    """Seconds left as "1h 04m 30s", "4m 30s" or "30s"; unknown and negative ones are being worked out."""
    n = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h, m, s = F.expr("1L") * F.floor(n / 3600), F.floor(n % 3600 / 60), n % 60
    long = F.concat(h.cast("string"), F.lit("h "), two(m), F.lit("m "), two(s), F.lit("s"))
    return F.when(seconds.isNull() | (seconds < 0), "calculating...").when(n >= 3600, long).when(n >= 60, F.concat(m.cast("string"), F.lit("m "), two(s), F.lit("s"))).otherwise(F.concat(s.cast("string"), F.lit("s")))
