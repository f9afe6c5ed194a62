"""Plan reports: employee records from form fields, tables and text lines, without repeats, as rows of the review template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..functions import values as V
from ..operators import records as R
from .templates import REVIEW, filled, plan_role

# Labels before a value in text, in order.
LABELS = (
    ("name", r"(?i)(?:employee|participant|emp(?:loyee)?)\s+name\s*[:\-]?\s*([A-Za-z][A-Za-z ,\.'\-]+)"),
    ("first_name", r"(?i)first\s+name\s*[:\-]?\s*(.+)"),
    ("last_name", r"(?i)last\s+name\s*[:\-]?\s*(.+)"),
    ("middle_name", r"(?i)middle\s+(?:name|initial)\s*[:\-]?\s*(.+)"),
    ("suffix", r"(?i)(?:name\s+)?suffix\s*[:\-]?\s*(.+)"),
    ("ssn", r"(?i)(?:ssn|ss#|social\s+security(?:\s+number)?|tax\s+id)\s*[:\-#]?\s*([\d\- ]+)"),
    ("gross_salary", r"(?i)(?:gross\s+(?:salary|pay|wages?|comp(?:ensation)?)|annual\s+salary|salary)\s*[:\-]?\s*([\$\d,\.]+)"),
    ("ee_contribution", r"(?i)(?:ee\s+(?:contribution|deferral)|employee\s+(?:contribution|deferral|401k)|elective\s+deferral)\s*[:\-]?\s*([\$\d,\.]+)"),
    ("er_match", r"(?i)(?:er\s+match|employer\s+(?:match|contribution)|company\s+match)\s*[:\-]?\s*([\$\d,\.]+)"),
    ("ytd_contribution", r"(?i)(?:ytd\s+(?:contribution|total|deferral)|year\s+to\s+date)\s*[:\-]?\s*([\$\d,\.]+)"),
    ("ee_id", r"(?i)(?:employee\s+(?:id|number|identification)|ee\s+id|emp\s+(?:id|number))\s*[:\-#]?\s*([A-Z0-9\-]+)"),
)
AMOUNTS = (("gross_salary", "Salary or Compensation Information"), ("ee_contribution", "Employee Contribution"), ("er_match", "Employer Match"), ("ytd_contribution", "YTD Contribution"))
# Whole numbers, those cut short or masked, and what goes from a cell before a name is looked for.
_SSN, _PADDED = r"\b(\d{3}-\d{2}-\d{4})\b", r"(?i)(?<!\d)(\d{3}-\d{2}-[\dxX*]{1,4})(?![\dxX*])"
_CUT = r"(?i)\d{3}-\d{2}-[\dxX*]{1,4}"
#: Where a record comes from: page, place of the table or line, place in it.
AT = ("method", "page", "tbl", "row", "k")
PARTS = ("first", "middle", "last", "suffix")


def _pair(role: Column, value: Column) -> Column:
    return F.struct(role.alias("role"), T.clean(value).alias("v"))


def with_parts(df: DataFrame, found: Column) -> DataFrame:
    """Adds the parts of a record from ``found``, (role, value) pairs in the order in which they were met.

    The first filled value of a role counts. A full name and the separate parts fill what is still blank, in that order.
    """
    d = df.withColumn("_f", F.transform(found, lambda x, i: F.struct(i.alias("i"), x["role"].alias("role"), x["v"].alias("v")))).withColumn("_f", F.filter("_f", lambda x: x["role"].isNotNull() & (x["v"] != "")))
    one = lambda role: F.try_element_at(F.filter("_f", lambda x: x["role"] == role), F.lit(1))
    # Functions read columns, not expressions, which they would repeat many times over.
    roles = ("name", "ssn", "ee_id", *(r for r, _ in AMOUNTS))
    d = d.select("*", *[one(r).alias(f"_{r}") for r in roles], *[one(p if p == "suffix" else f"{p}_name").alias(f"_{p}") for p in PARTS])
    d = d.select("*", F.col("_name.v").alias("_n"), F.col("_ssn.v").alias("_s"), *[F.col(f"_{r}.v").alias(f"_v_{r}") for r, _ in AMOUNTS])
    d = d.select("*", N.plan_name(F.col("_n")).alias("_whole"), V.ssn_canonical(F.col("_s")).alias("_number"))
    for part in PARTS:
        own, given = F.col(f"_{part}"), F.when(F.col("_n").isNotNull(), F.col("_whole")[part])
        both = F.array(F.struct(own["i"].alias("i"), own["v"].alias("v")), F.struct(F.col("_name")["i"].alias("i"), given.alias("v")))
        d = d.withColumn(f"_b_{part}", T.text(F.get(F.array_sort(F.filter(both, lambda x: x["i"].isNotNull() & (F.coalesce(x["v"], F.lit("")) != ""))), F.lit(0))["v"]))
    d = d.select("*", *[T.title(F.col(f"_b_{part}")).alias(part) for part in PARTS], *[F.coalesce(F.nullif(V.plan_amount(F.col(f"_v_{r}")), F.lit("")), F.col(f"_v_{r}"), F.lit("")).alias(r) for r, _ in AMOUNTS])
    return d.withColumn("ee_id", T.text(F.col("_ee_id.v"))).withColumn("number", T.text(F.col("_number"))).withColumn("full", T.text(F.col("_n")))


def _meaningful() -> Column:
    """Does a record show a number or a name?"""
    return F.expr("ssn <> '' or first <> '' or last <> '' or full <> ''")


def _found(df: DataFrame, method: int, found: Column, ssn: Column | None = None, beside: Column | None = None, **at: Column) -> DataFrame:
    """What a way of finding records gives of each: its place, the pairs, a number that is certain, and a name that stands near."""
    place = {"page": F.lit(1), "tbl": F.lit(0), "row": F.lit(0), "k": F.lit(0)} | at
    more = [(F.lit(None) if c is None else c).cast("string").alias(n) for n, c in (("given", ssn), ("beside", beside))]
    return df.select("doc_id", F.lit(method).alias("method"), *[place[c].cast("int").alias(c) for c in AT[1:]], found.alias("found"), *more)


def parsed(found: DataFrame) -> DataFrame:
    """Records of what was found: the number that is certain, else the one among the pairs; the name that stands near where they have none."""
    d = _name_if_none(with_parts(found, F.col("found")), F.col("beside")).withColumn("ssn", F.coalesce("given", "number"))
    return d.select("doc_id", *AT, "ssn", *PARTS, *[r for r, _ in AMOUNTS], "ee_id", "full")


def in_fields(fields: DataFrame) -> DataFrame:
    """One record (see ``_found``) for each document with filled form fields. fields: doc_id, ord, name, value.

    Fields whose name tells no role may still show a number.
    """
    role = plan_role(F.col("name"))
    number = F.coalesce(F.nullif(F.regexp_extract("value", _SSN, 1), F.lit("")), F.regexp_extract("value", _PADDED, 1))
    each = fields.filter((T.clean(F.col("value")) != "") & ~F.col("value").isin("/Off", "Off")).select("doc_id", "ord", _pair(F.coalesce(role, F.lit("ssn")), F.when(role.isNull(), number).otherwise(F.col("value"))).alias("p"))
    whole = each.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "p"))), lambda x: x["p"]).alias("found"))
    return _found(whole, 0, F.col("found"))


def _first_of(found: Column) -> Column:
    return F.try_element_at(F.filter(found, lambda x: x != ""), F.lit(1))


def in_tables(rows: DataFrame) -> DataFrame:
    """A record (see ``_found``) for each table row that shows a number. rows: doc_id, page, tbl, row, cells.

    The first row with two known headers names the columns. Without a name in these, one is looked for beside the number,
    in the row's other cells, and in the rows -1, -2, -3 and +1.
    """
    keys, order = ["doc_id", "page", "tbl", "row"], Window.partitionBy("doc_id", "page", "tbl").orderBy("row")
    cell = rows.select(*keys, F.posexplode("cells").alias("c", "raw")).withColumn("v", T.clean(F.col("raw")))
    cell = cell.select(*keys, "c", "v", F.trim(F.regexp_replace("v", _CUT, "")).alias("bare"), plan_role(F.col("v")).alias("role"), V.ssn_in_cell(F.col("v")).alias("n"))
    cell = cell.select("*", N.find_name(F.col("v")).alias("seen"), N.find_name(F.col("bare")).alias("beside"))
    parts = F.array_sort(F.collect_list(F.struct("c", "v", "role", "n", "seen", "beside")))
    d = cell.groupBy(*keys).agg(parts.alias("x")).select(*keys, *[F.expr(f"transform(x, y -> y.{c})").alias(c) for c in ("v", "role", "n", "seen", "beside")])
    d = d.withColumn("heads", F.when(F.size(F.array_compact("role")) >= 2, F.col("role"))).withColumn("any", F.coalesce(_first_of(F.col("seen")), F.lit("")))
    d = d.withColumn("roles", F.coalesce(F.first("heads", True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.array().cast("array<string>")))
    near = [F.lag("any", n).over(order) for n in (1, 2, 3)] + [F.lead("any", 1).over(order)]
    d = d.withColumn("near", F.coalesce(*[F.nullif(x, F.lit("")) for x in near])).withColumn("at", F.expr("array_position(transform(n, x -> x <> ''), true)")).filter("at > 0")
    d = d.withColumn("ssn", F.expr("n[at - 1]")).withColumn("name", F.coalesce(F.nullif(F.expr("beside[at - 1]"), F.lit("")), _first_of(F.expr("filter(seen, (x, i) -> i <> at - 1)")), F.col("near")))
    pairs = F.expr("transform(sequence(0, size(v) - 1), i -> struct(case when i <> at - 1 then get(roles, i) end as role, v[i] as v))")
    return _found(d, 1, pairs, F.col("ssn"), F.col("name"), page=F.col("page"), tbl=F.col("tbl"), row=F.col("row"))


def _name_if_none(d: DataFrame, found: Column) -> DataFrame:
    """Where a record has neither a full nor a first name, the blank parts of ``found``."""
    d = d.withColumn("_found", F.when(F.expr("full = '' and first = ''"), found)).withColumn("_p", N.plan_name(F.col("_found")))
    d = d.select(*[c for c in d.columns if c not in (*PARTS, "full")], *[F.when(F.col("_found").isNotNull() & (F.col(p) == ""), F.col("_p")[p]).otherwise(F.col(p)).alias(p) for p in PARTS], F.coalesce("_found", "full").alias("full"))
    return d


def in_lines(lines: DataFrame) -> DataFrame:
    """A record (see ``_found``) for each number in the text, or one for a page without any. lines: doc_id, page, ord, text.

    Values are looked for after their labels in the 20 lines before and the 19 after the number's own; a name beside the
    number comes first, one in the lines -1, +1, -2, ... +10 last.
    """
    page = Window.partitionBy("doc_id", "page").orderBy("ord")
    many = F.regexp_extract_all("text", F.lit(_SSN), F.lit(1))
    padded = F.regexp_extract_all("text", F.lit(_PADDED), F.lit(1))
    d = lines.select("doc_id", "page", "ord", "text", many.alias("many"), padded.alias("padded"), V.ssn_in_cell(F.col("text")).alias("part"), F.trim(F.regexp_replace("text", _CUT, "")).alias("bare"))
    d = d.withColumn("numbers", F.expr("case when size(many) > 0 then many when size(padded) > 0 then padded when part <> '' then array(part) else cast(array() as array<string>) end")).withColumn("seen", N.find_name(F.col("bare")))
    d = d.withColumn("any", F.max(F.size("numbers")).over(Window.partitionBy("doc_id", "page")))
    steps = [n for k in range(1, 11) for n in (-k, k)]
    near = F.coalesce(*[F.nullif(F.lag("seen", -n).over(page) if n < 0 else F.lead("seen", n).over(page), F.lit("")) for n in steps])
    d = d.withColumn("near", near).withColumn("around", F.array_join(F.collect_list("text").over(page.rowsBetween(-20, 19)), "\n")).withColumn("line", F.row_number().over(page) - 1)
    hit = d.filter("size(numbers) > 0").select("*", F.posexplode("numbers").alias("k", "raw")).withColumn("ssn", V.ssn_canonical(F.col("raw")))
    hit = hit.select("*", *[T.clean(F.regexp_extract("around", label, 1)).alias(f"l_{role}") for role, label in LABELS if role != "ssn"])
    found = []
    for role, _ in LABELS:
        if role == "ssn":
            continue
        v = F.col(f"l_{role}")
        usable = ~v.rlike(_SSN) if role in dict(AMOUNTS) else ~v.rlike(_SSN) & ~v.rlike(rf"^(?:{V.AMOUNT})$")
        found.append(_pair(F.lit(role), F.when(usable, F.substring(v, 1, 80))))
    hit = _found(hit, 2, F.array(_pair(F.lit("name"), F.col("seen")), *found), F.col("ssn"), F.col("near"), page=F.col("page"), row=F.col("line"), k=F.col("k"))
    first = lambda label: F.try_element_at(F.filter(F.transform("lines", lambda x: F.regexp_extract(x, label, 1)), lambda x: x != ""), F.lit(1))
    none = d.filter("any = 0").groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]).alias("lines"))
    return hit.unionByName(_found(none, 2, F.array(*[_pair(F.lit(role), first(label)) for role, label in LABELS]), page=F.col("page")))


def employees(fields: DataFrame, rows: DataFrame, lines: DataFrame) -> DataFrame:
    """The records of all documents without repeats, in order: of a document with usable form fields these alone, else those of its tables and its text.

    What all three ways find is parsed by one set of expressions, and a document's records are chosen where they meet.
    """
    every = parsed(in_fields(fields).unionByName(in_tables(rows)).unionByName(in_lines(lines)))
    # Filtered above windows: a filter below them would take the whole of the parsing into its condition.
    doc = Window.partitionBy("doc_id")
    every = every.withColumn("_shows", _meaningful()).withColumn("_form", F.max(F.expr("method = 0 and _shows")).over(doc)).withColumn("_gone", F.expr("if(method = 0, not _shows, _form)"))
    every = every.withColumn("ord", F.row_number().over(doc.orderBy("_gone", *AT))).filter("_shows and not _gone").drop("_shows", "_form", "_gone")
    every = R.drop_partial(every, "ssn", ["doc_id"])
    every = R.first_wins(every, [F.col("doc_id"), F.lower("first"), F.lower("last"), F.col("ssn")], ["ord"], F.expr("ssn = '' and (first = '' or last = '')"))
    return R.merge_prefixes(every)


def template(records: DataFrame) -> DataFrame:
    """Records as rows of the review template."""
    work = F.concat_ws(" | ", *[F.when(F.col(c) != "", F.concat(F.lit(f"{name}: "), c)) for c, name in AMOUNTS])
    return filled(records, REVIEW, {
        "DOCID": F.col("doc_id"), "Last Name": F.col("last"), "First Name": F.col("first"), "Middle Name": F.col("middle"), "Suffix": F.col("suffix"), "Data Subject Type": F.lit("Employee"),
        "Government- Issued Identification": F.when(F.col("ssn") != "", "Social Security Number (SSN)"), "Social Security Number": F.col("ssn"), "Work-Related Information": work, "Employee Identification Number": F.col("ee_id"),
    })
