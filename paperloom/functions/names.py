"""Personal names: splitting, normal forms, and finding them in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import at, clean, joined, let, strip, text, title, tokens

# Suffix lists of the form families, company tokens, words that stand before a surname, label words.
W2_SUFFIXES = ("JR", "SR", "II", "III", "IV", "V")
BLOCK_SUFFIXES = ("JR", "JR.", "SR", "SR.", "II", "III", "IV", "V", "ESQ", "ESQ.")
CREDITOR_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v", "esq", "md", "phd")
ENTITY_TOKENS = ("inc", "llc", "corp", "ltd", "co", "ag", "lp", "llp", "plc", "pc", "pa", "na", "nv", "sa", "gmbh")
COMPANY_FIRST_NAMES = ("inc", "inc.", "llc", "llc.")
CHANGE_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")
PLAN_SUFFIXES = ("jr", "jr.", "sr", "sr.", "ii", "iii", "iv", "v", "esq", "esq.", "phd", "md", "dds", "cpa", "rn")


def _struct(**parts: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in parts.items()])


def by_whitespace(c: Column) -> Column:
    """first, last, suffix of "First ... Last [Suffix]"."""
    return let(tokens(c), _by_whitespace)


def _by_whitespace(t: Column) -> Column:
    tail = F.upper(F.btrim(at(t, -1), F.lit("."))).isin(*W2_SUFFIXES)
    n = F.size(t) - tail.cast("int")
    return _struct(first=F.when(n == 1, at(t, 1)).otherwise(joined(t, 1, n - 1)), last=F.when(n >= 2, F.coalesce(F.get(t, n - 1), F.lit(""))).otherwise(F.lit("")), suffix=F.when(tail, at(t, -1)).otherwise(F.lit("")))


def first_middle_last(c: Column) -> Column:
    """first, middle, last, suffix of a name in that order."""
    return let(tokens(c), _in_order)


def _in_order(t: Column) -> Column:
    tail = F.upper(at(t, -1)).isin(*BLOCK_SUFFIXES)
    n = F.size(t) - tail.cast("int")
    return _struct(
        first=F.when(n >= 1, at(t, 1)).otherwise(F.lit("")), middle=F.when(n > 2, joined(t, 2, n - 2)).otherwise(F.lit("")),
        last=F.when(n >= 2, F.coalesce(F.get(t, n - 1), F.lit(""))).otherwise(F.lit("")), suffix=F.when(tail, at(t, -1)).otherwise(F.lit("")),
    )


def _comma_parts(s: Column) -> tuple[Column, Column]:
    place = F.locate(",", s)
    return tokens(F.substring_index(s, ",", 1)), tokens(F.when(place > 0, s.substr(place + 1, F.length(s))).otherwise(F.lit("")))


def last_first(c: Column, suffixes: tuple[str, ...] = CREDITOR_SUFFIXES, companies: bool = True) -> Column:
    """last, first, middle, suffix of "Last, First Middle", with the suffix on either side.

    With ``companies``, a name without a comma is all last name, as is one whose part before the comma ends with a
    company token; without, a name without a comma gives blanks.
    """
    return let(clean(c), lambda s: let(F.struct(s.alias("s"), *_named_parts(s)), lambda x: _last_first(x, suffixes, companies)))


def _named_parts(s: Column) -> list[Column]:
    return [c.alias(n) for c, n in zip(_comma_parts(s), ("left", "right"))]


def _last_first(x: Column, suffixes: tuple[str, ...], companies: bool) -> Column:
    s, left, right = x["s"], x["left"], x["right"]
    bare = lambda w: F.lower(F.btrim(w, F.lit(".")))
    on_right = bare(at(right, -1)).isin(*suffixes)
    on_left = ~on_right & bare(at(left, -1)).isin(*suffixes)
    nr, nl = F.size(right) - on_right.cast("int"), F.size(left) - on_left.cast("int")
    comma = F.contains(s, F.lit(","))
    company = comma & F.lower(F.btrim(at(left, -1), F.lit(".,"))).isin(*ENTITY_TOKENS) if companies else F.lit(False)
    plain = ~comma if companies else F.lit(False)
    person = comma & ~company
    blank = F.lit("")
    return _struct(
        last=F.when(plain, s).when(company, F.regexp_replace(s, ",+$", "")).when(person, joined(left, 1, nl)).otherwise(blank),
        first=F.when(person & (nr >= 1), at(right, 1)).otherwise(blank),
        middle=F.when(person & (nr > 1), joined(right, 2, nr - 1)).otherwise(blank),
        suffix=F.when(person & on_right, at(right, -1)).when(person & on_left, at(left, -1)).otherwise(blank),
    )


def plan_name(c: Column) -> Column:
    """first, middle, last, suffix in title case; without a comma all is last name."""
    return let(clean(c), lambda s: let(F.struct(s.alias("s"), *_named_parts(s)), _plan_name))


def _plan_name(x: Column) -> Column:
    s, right = x["s"], x["right"]
    tail = F.regexp_replace(F.lower(at(right, -1)), r"\.+$", "").isin(*PLAN_SUFFIXES)
    n, comma = F.size(right) - tail.cast("int"), F.contains(s, F.lit(","))
    return _struct(
        first=F.when(comma & (n >= 1), title(at(right, 1))).otherwise(F.lit("")), middle=F.when(comma & (n > 1), title(joined(right, 2, n - 1))).otherwise(F.lit("")),
        last=F.when(comma, title(F.trim(F.substring_index(s, ",", 1)))).otherwise(title(s)), suffix=F.when(comma & tail, title(at(right, -1))).otherwise(F.lit("")),
    )


def last_first_plain(c: Column) -> Column:
    """last, first, middle of "Last, First Middle"; without a comma all is last name."""
    s = strip(c)
    place = F.locate(",", s)
    right = tokens(F.when(place > 0, s.substr(place + 1, F.length(s))).otherwise(F.lit("")))
    return _struct(last=strip(F.substring_index(s, ",", 1)), first=at(right, 1), middle=F.when(F.size(right) > 1, joined(right, 2, F.size(right) - 1)).otherwise(F.lit("")))


def covered_name(c: Column) -> Column:
    """first, middle, last, and whether the name has neither one, two nor three words."""
    t = tokens(c)
    n = F.size(t)
    return _struct(first=at(t, 1), middle=F.when(n > 2, joined(t, 2, n - 2)).otherwise(F.lit("")), last=F.when(n >= 2, at(t, -1)).otherwise(F.lit("")), unusual=(n > 3))


# Shapes of names in free text.
SHAPE_LAST_FIRST = r"\b([A-Za-z]{2,}),[ \t]+([A-Za-z]{2,}(?:[ \t]+[A-Za-z]{1,}\.?)?)\b"
SHAPE_UPPER = r"\b([A-Z]{2,}(?:[ \t]+[A-Z]{2,}){1,4})\b"
SHAPE_CAPITALISED = r"\b([A-Z][a-z]+(?:[ \t]+[A-Z][a-z]*\.?){1,4})\b"


# Words that aren't part of a name in a plan report.
PLAN_LABELS = (
    "EMPLOYEE", "EMPLOYER", "PARTICIPANT", "MEMBER", "CLAIMANT", "SALARY", "COMPENSATION", "CONTRIBUTION", "DEFERRAL", "MATCH", "GROSS", "NET", "TOTAL", "AMOUNT",
    "NUMBER", "ID", "SSN", "TIN", "TAX", "PLAN", "COMPANY", "PAGE", "DATE", "ADDRESS", "STATE", "CITY", "ZIP", "PHONE", "EMAIL", "FAX", "FOR", "AND", "THE", "INC", "LLC", "CORP", "CO", "LTD",
)


def find_name(c: Column, labels: tuple[str, ...] = PLAN_LABELS) -> Column:
    """A name in free text: "Last, First" in title case, else capitals once labels and numbers are gone, else capitalised words."""
    return let(clean(c), lambda s: _find_name(s, labels))


def _find_name(s: Column, labels: tuple[str, ...]) -> Column:
    left, right = F.regexp_extract(s, SHAPE_LAST_FIRST, 1), F.regexp_extract(s, SHAPE_LAST_FIRST, 2)
    bare = clean(F.regexp_replace(F.regexp_replace(s, rf"(?i)\b(?:{'|'.join(labels)})\b", ""), r"\b\d[\d,.$%-]*\b", ""))
    upper, words = F.regexp_extract(bare, SHAPE_UPPER, 1), F.regexp_extract(s, SHAPE_CAPITALISED, 1)
    no = (s == "") | s.rlike(r"^(?:\$?\s*(?:\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?|\d+(?:\.\d{1,2})?))$") | s.rlike(r"\b\d{3}-\d{2}-\d{4}\b")
    return F.when(no, "").when(left != "", title(F.concat(left, F.lit(", "), right))).when(upper != "", title(upper)).otherwise(words)


def header_fields(c: Column) -> Column:
    """last, first, middle, associate, position, department, cost of a payroll-change header; short codes before the name go."""
    return let(clean(c), _header_fields)


def _header_fields(s: Column) -> Column:
    get = lambda p: F.regexp_extract(s, "(?i)" + p, 1)
    before = strip(F.regexp_replace(s, r"(?is)(?:Associate\s+ID|Position\s+ID|Home\s+Department|Home\s+Cost).*$", ""))
    search = let(before, lambda b: F.when(F.contains(b, F.lit(",")), b).otherwise(s))
    name = let(search, lambda x: let(F.struct(x.alias("s"), *_named_parts(x)), _after_codes))
    labelled = _struct(
        associate=get(r"Associate\s+ID\s*:\s*(\S+)"), position=get(r"Position\s+ID\s*:\s*(\S+)"),
        department=clean(get(r"Home\s+Department\s*:\s*(.+?)(?=\s{2,}Home\s+Cost|\s*Home\s+Cost|$)")), cost=get(r"Home\s+Cost\s+Number\s*:\s*(\S*)"),
    )
    return let(F.struct(name.alias("n"), labelled.alias("l")), lambda x: _struct(**{k: x["n"][k] for k in ("last", "first", "middle")}, **{k: x["l"][k] for k in ("associate", "position", "department", "cost")}))


def _after_codes(x: Column) -> Column:
    """last, first and middle of "CODE Last, First Middle"."""
    code = lambda w: w.rlike("^[A-Z0-9]{1,8}$")
    # Up to the first word that is no code.
    places = F.transform(x["left"], lambda w, i: F.when(code(w), F.lit(None)).otherwise(i))
    kept = let(F.coalesce(F.array_min(places), F.size(x["left"])), lambda n: F.filter(x["left"], lambda w, i: i >= n))
    right = x["right"]
    tail = F.lower(F.btrim(at(right, -1), F.lit("."))).isin(*CHANGE_SUFFIXES)
    own = F.struct(kept.alias("kept"), (F.size(right) - tail.cast("int")).alias("n"))

    def parts(o: Column) -> Column:
        ok = F.contains(x["s"], F.lit(",")) & (F.size(o["kept"]) > 0)
        return _struct(last=F.when(ok, F.array_join(o["kept"], " ")).otherwise(F.lit("")), first=F.when(ok & (o["n"] >= 1), at(right, 1)).otherwise(F.lit("")), middle=F.when(ok & (o["n"] > 1), joined(right, 2, o["n"] - 1)).otherwise(F.lit("")))

    return let(own, parts)


def prefix_match(a: Column, b: Column) -> Column:
    """Does one name begin with the other, whatever the case? Blank names match nothing."""
    x, y = F.lower(strip(a)), F.lower(strip(b))
    return (x != "") & (y != "") & (F.startswith(x, y) | F.startswith(y, x))


def is_person(first: Column) -> Column:
    f = F.lower(strip(first))
    return (f != "") & ~f.isin(*COMPANY_FIRST_NAMES)


def display_name(last: Column, first: Column, middle: Column) -> Column:
    """"Last, First Middle" of what there is."""
    given = F.concat_ws(" ", F.nullif(text(first), F.lit("")), F.nullif(text(middle), F.lit("")))
    return F.concat_ws(", ", F.nullif(text(last), F.lit("")), F.nullif(given, F.lit("")))
