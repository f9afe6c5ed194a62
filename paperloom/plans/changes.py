"""Payroll change logs: employee headers carried over the change rows below them, and their pivot to the review template."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import predicates as P
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import records as R
from .templates import CHANGES, REVIEW, filled

# The columns of a change log, where its columns begin on a page without a table header, and its warning.
COLUMNS = ("DOCID", "Name", "Associate ID", "Position ID", "Home Department", "Home Cost Number", "Changed Field", "Changed From", "Changed To")
STARTS = (0.38, 0.67)
NO_RECORDS = "No employee records found -- no 'Associate ID:' header rows detected in this PDF. Run --diagnose to inspect the raw text."
_NAME = r"[A-Za-z][A-Za-z'\-\.]*\s*,\s*[A-Za-z]"


def kinds(words: DataFrame, width: float = 612.0) -> DataFrame:
    """doc_id, page, line, text, words, c2, c3 and kind (chrome, table, employee, name, data) of each line; names count in the first column alone."""
    lines = L.with_starts(L.lines_anchor(words, 3.0, True), (width * STARTS[0], width * STARTS[1]))
    d = lines.withColumn("first", L.left_of(F.col("words"), F.col("c2"))).withColumn("kind", P.line_kind(F.col("text")))
    return d.withColumn("kind", F.when(F.col("kind").isin("name", "data"), F.when(F.col("first").rlike(_NAME), "name").otherwise("data")).otherwise(F.col("kind")))


def changes(words: DataFrame, width: float = 612.0) -> DataFrame:
    """One row for each change: doc_id, ord, the employee's parts, field, old and new.

    A name line opens an employee; the header lines after it belong to it until a data line or the page's end. Of headers
    without rows the last one counts.
    """
    order = Window.partitionBy("doc_id").orderBy("page", "line")
    d = kinds(words, width).filter("kind not in ('chrome', 'table')").withColumn("ord", F.row_number().over(order)).withColumn("head", F.col("kind") != "data")
    opens = F.col("head") & ((F.col("kind") == "name") | ~F.coalesce(F.lag("head").over(order), F.lit(False)) | (F.lag("page").over(order) != F.col("page")))
    d = d.withColumn("opens", opens).withColumn("segment", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("doc_id", "segment")
    heads = F.collect_list(F.when(F.col("head"), F.struct("ord", "text"))).over(own)
    d = d.withColumn("heads", heads).filter("not head and size(heads) > 0")
    rows = d.select("doc_id", "page", "ord", "segment", F.array_join(F.transform(F.array_sort("heads"), lambda x: x["text"]), "  ").alias("heads"), *[F.array_join(F.transform(F.filter("words", cut), lambda w: w["text"]), " ").alias(c) for c, cut in (
        ("field", lambda w: w["x0"] < F.col("c2")), ("old", lambda w: (w["x0"] >= F.col("c2")) & (w["x0"] < F.col("c3"))), ("new", lambda w: (w["x0"] >= F.col("c2")) & (w["x0"] >= F.col("c3"))))])
    # An employee's first row alone has its headers taken apart.
    first = F.when(F.row_number().over(own.orderBy("ord")) == 1, F.col("heads"))
    rows = rows.filter("field <> ''").withColumn("first", first).withColumn("e", F.when(F.col("first").isNotNull(), N.header_fields(F.col("first"))))
    return rows.withColumn("e", F.first("e", True).over(own)).select("doc_id", "page", "ord", "e.*", "field", "old", "new")


def log(found: DataFrame) -> DataFrame:
    """Change rows in the log's columns, in order; a blank name is that of the row above."""
    name = N.display_name(F.col("last"), F.col("first"), F.col("middle"))
    down = F.last(F.nullif("name", F.lit("")), True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    d = found.withColumn("name", T.formula_safe(name)).withColumn("name", T.text(down))
    parts = {"DOCID": F.col("doc_id"), "Name": F.col("name"), "Associate ID": F.col("associate"), "Position ID": F.col("position"), "Home Department": F.col("department"), "Home Cost Number": F.col("cost"), "Changed Field": F.col("field"), "Changed From": F.col("old"), "Changed To": F.col("new")}
    return d.select("ord", *[(parts[c] if c == "Name" else T.formula_safe(parts[c])).alias(c) for c in COLUMNS])


def report(words: DataFrame, found: DataFrame) -> DataFrame:
    """File, change rows, pages, whether there are records, and the warning, for each document."""
    pages = words.groupBy("doc_id").agg(F.max("page").cast("long").alias("pages"))
    rows = found.groupBy("doc_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return pages.join(rows, "doc_id", "left").select(F.col("doc_id").alias("File Name"), n.alias("Change Rows"), F.col("pages").alias("Pages"), F.when(n > 0, "Yes").otherwise("No").alias("Records Found"), F.when(n > 0, "").otherwise(NO_RECORDS).alias("Warnings"))


def pivoted(found: DataFrame, headers: DataFrame) -> DataFrame:
    """One template row for each employee (associate id and name) of a document.

    ``headers``: field, header, the known field of each changed field. Values of one column are appended unless they are in
    it already, notes of one category gathered by ';'.
    """
    d = found.join(headers, "field", "left").withColumn("value", V.chosen_value(F.col("old"), F.col("new")))
    known = F.create_map(*[F.lit(x) for h, v, c, n in CHANGES for x in (h, f"{v or ''}|{c or ''}|{n or ''}")])
    d = d.withColumn("m", F.split(F.try_element_at(known, F.col("header")), r"\|"))
    d = d.withColumn("column", F.get("m", F.lit(0))).withColumn("category", T.column_key(F.get("m", F.lit(1)))).withColumn("note", F.get("m", F.lit(2)))
    own = lambda c: F.col("column") == c
    ordered = lambda cond, value: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("ord", F.col(value).alias("v"))))), lambda x: x["v"])
    values = sorted({v for _, v, _, _ in CHANGES if v})
    notes = sorted({c for _, _, c, n in CHANGES if c and n})
    key = {lookup_key(c): c for c in REVIEW}
    aggs = [R.appended(ordered(own(v) & (F.col("value") != ""), "value"), "; ").alias(f"v_{v}") for v in values]
    aggs += [F.array_join(F.array_distinct(ordered((F.col("category") == lookup_key(c)) & (F.col("note") != ""), "note")), ";").alias(f"n_{c}") for c in notes]
    each = d.groupBy("doc_id", "associate", "last", "first").agg(F.min("ord").alias("ord"), F.min_by("middle", "ord").alias("middle"), *aggs)
    out = {"DOCID": F.col("doc_id"), "Last Name": F.col("last"), "First Name": F.col("first"), "Middle Name": F.col("middle"), "Data Subject Type": F.lit("Employee"), "Employee Identification Number": F.col("associate")}
    for v in values:
        c, new = key[lookup_key(v)], F.col(f"`v_{v}`")
        old = out.get(c)
        out[c] = new if old is None else F.when(old == "", new).when((new == "") | F.contains(old, new), old).otherwise(F.concat(old, F.lit("; "), new))
    for c in notes:
        out[key[lookup_key(c)]] = F.col(f"`n_{c}`")
    return filled(each, REVIEW, out)


def lookup_key(name: str) -> str:
    """A template column for look-ups, as ``text.column_key`` has it."""
    return " ".join(name.replace("-", " ").split()).lower()
