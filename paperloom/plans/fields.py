"""Form fields and signatures as long rows, one wide row for each document, or values beside printed labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import neighbourhood as A
from ..operators import records as R
from ..sources.fields import READ_ONLY

# Columns of long rows, shapes of visible signatures, points above and below a label that are searched.
COLUMNS = ("Page Number", "Field Name", "Field Label", "Field Type", "Value", "Read Only", "Signed", "Signer Name", "Signed Date", "Reason", "Location", "Contact Info", "Source")
SIGNED_BY = r"(?i)Digital+y\s+sign\w*\s+b[yv]\s*:?\s*(.*)"
SIGNED_DATE = r"(?i)Date\s*:?\s*(\d{4}[.\-/]\d{2}[.\-/]\d{2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?(?:\s*[+-]\d{2}'?\s*\d{2}'?)?)"
REACH = 40


def visible_signatures(lines: DataFrame) -> DataFrame:
    """Signatures in the page's text: the name on its line, the date in this line or the next three. lines: doc_id, page, ord, text."""
    d = lines.withColumn("ctx", A.around("text", ["doc_id", "page"], ["ord"], 0, 3)).filter(F.col("text").rlike(SIGNED_BY))
    name = F.btrim(F.split(F.regexp_extract("text", SIGNED_BY, 1), SIGNED_DATE)[0], F.lit(" :,"))
    date = F.regexp_extract("ctx", SIGNED_DATE, 1)
    return d.select("doc_id", "page", "ord", name.alias("name"), F.when(date == "", "").otherwise(V.visible_date(date)).alias("date"))


def long_rows(widgets: DataFrame, lines: DataFrame, empty: bool = False) -> DataFrame:
    """doc_id, ord and ``COLUMNS``: every filled field (with ``empty`` the others too), every signature field, and signatures that only the text shows.

    A name that a signature field of the page has isn't listed again from the text.
    """
    is_sig = F.col("kind") == "Signature"
    value = F.when(is_sig, F.when(F.col("signed"), F.col("sig_name"))).otherwise(T.strip(F.col("raw")))
    fields = widgets.select(
        "doc_id", F.col("page").alias("Page Number"), F.lit(0).alias("side"), F.col("ord").cast("string").alias("at"), F.col("name").alias("Field Name"), F.col("alt").alias("Field Label"), F.col("kind").alias("Field Type"), T.text(value).alias("Value"),
        F.when(F.col("flags").bitwiseAND(READ_ONLY) != 0, "Yes").otherwise("No").alias("Read Only"), F.when(is_sig, F.when(F.col("signed"), "Yes").otherwise("No")).alias("Signed"),
        *[F.when(is_sig & F.col("signed"), c).alias(n) for n, c in (("Signer Name", F.col("sig_name")), ("Signed Date", V.pdf_date(F.col("sig_date"))), ("Reason", F.col("sig_reason")), ("Location", F.col("sig_location")), ("Contact Info", F.col("sig_contact")))], F.when(is_sig, "signature field").alias("Source"),
    )
    fields = fields if empty else fields.filter("Value <> '' or Signed is not null")
    known = widgets.filter(is_sig & F.col("signed") & (F.col("sig_name") != "")).select("doc_id", "page", F.lower("sig_name").alias("who")).distinct()
    text = visible_signatures(lines).withColumn("who", F.lower("name")).join(known, ["doc_id", "page", "who"], "left_anti")
    blank = F.lit("")
    text = text.select("doc_id", F.col("page").alias("Page Number"), F.lit(1).alias("side"), F.lpad(F.col("ord").cast("string"), 9, "0").alias("at"), blank.alias("Field Name"), blank.alias("Field Label"), F.lit("Signature (flattened)").alias("Field Type"), F.col("name").alias("Value"), blank.alias("Read Only"),
        F.lit("Yes").alias("Signed"), F.col("name").alias("Signer Name"), F.col("date").alias("Signed Date"), blank.alias("Reason"), blank.alias("Location"), blank.alias("Contact Info"), F.lit("page text (flattened)").alias("Source"))
    both = fields.unionByName(text)
    order = Window.partitionBy("doc_id").orderBy("Page Number", "side", "at")
    return both.select("doc_id", F.row_number().over(order).alias("ord"), "Page Number", *[T.text(F.col(f"`{c}`")).alias(c) for c in COLUMNS[1:]])


def wide_rows(rows: DataFrame) -> DataFrame:
    """doc_id and a map of one document's fields by label, else name; repeated headers get " (2)", " (3)" ...; signatures their own four."""
    header = F.coalesce(F.nullif("Field Label", F.lit("")), F.nullif("Field Name", F.lit("")), F.concat(F.lit("Field (page "), "Page Number", F.lit(")")))
    d = rows.withColumn("sig", F.col("Signed") != "").withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "sig").orderBy("ord"))).withColumn("header", header)
    d = d.withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "sig", "header").orderBy("ord")))
    key = F.when(F.col("k") > 1, F.concat("header", F.lit(" ("), "k", F.lit(")"))).otherwise(F.col("header"))
    own = F.array(F.struct(key.alias("key"), F.col("Value").alias("value")))
    sig = F.array(*[F.struct(F.concat(F.lit("Signature "), "n", F.lit(f" {t}")).alias("key"), F.col(f"`{c}`").alias("value")) for t, c in (("Signed", "Signed"), ("Signer Name", "Signer Name"), ("Date", "Signed Date"), ("Source", "Source"))])
    each = d.select("doc_id", "ord", F.posexplode(F.when(F.col("sig"), sig).otherwise(own)).alias("i", "e"))
    return each.groupBy("doc_id").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("ord", "i", "e"))), lambda x: x["e"])).alias("row"))


def beside_labels(labels: DataFrame, widgets: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, label, value and source: the first value that the places of a printed label have, in their order.

    labels: doc_id, page, ord, label, x0, top, x1, bottom. At each place: the nearest filled field within 40 points above or
    below that overlaps it sideways, else the last line above, else the first line below, that doesn't hold the label.
    widgets and lines have their boxes as x0, top, x1, bottom.
    """
    place = labels.select("doc_id", "page", "ord", "label", F.col("x0").alias("lx0"), F.col("top").alias("ltop"), F.col("x1").alias("lx1"), F.col("bottom").alias("lbottom"))
    own = widgets.filter((F.col("kind") != "Signature") & (T.strip(F.col("raw")) != "")).select("doc_id", "page", F.col("ord").alias("fo"), T.strip(F.col("raw")).alias("value"), "x0", "top", "x1", "bottom")
    strip = f"x0 < lx1 + {REACH} and x1 > lx0 - {REACH}"
    above, below = f"({strip} and bottom > ltop - {REACH} and top < ltop)", f"({strip} and top < lbottom + {REACH} and bottom > lbottom)"
    near = place.join(own, ["doc_id", "page"]).filter(f"({above} or {below}) and least(x1, lx1) - greatest(x0, lx0) > 0")
    near = near.withColumn("gap", F.expr("least(abs(ltop - bottom), abs(top - lbottom))")).groupBy("doc_id", "page", "ord", "label").agg(F.min_by("value", F.struct("gap", "fo")).alias("field"))
    text = place.join(lines.select("doc_id", "page", "line_no", T.strip(F.col("text")).alias("text"), "x0", "top", "x1", "bottom").filter("text <> ''"), ["doc_id", "page"]).filter(~F.contains(F.lower("text"), F.lower("label")))
    up = text.filter(above).groupBy("doc_id", "page", "ord", "label").agg(F.max_by("text", F.struct("top", "line_no")).alias("up"))
    down = text.filter(below).groupBy("doc_id", "page", "ord", "label").agg(F.min_by("text", F.struct("top", "line_no")).alias("down"))
    key = ["doc_id", "page", "ord", "label"]
    d = place.select(*key).join(near, key, "left").join(up, key, "left").join(down, key, "left")
    d = d.withColumn("value", F.coalesce("field", "up", "down")).withColumn("source", F.when(F.col("field").isNotNull(), "form field").when(F.col("value").isNotNull(), "page text (flattened)"))
    best = F.min_by(F.struct("value", "source"), F.when(F.col("value").isNotNull(), F.struct("page", "ord")))
    return d.groupBy("doc_id", "label").agg(best.alias("b")).select("doc_id", "label", T.text(F.col("b.value")).alias("value"), T.text(F.col("b.source")).alias("source"))


def summary(found: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each document: a map of the labels' values, and its signatures."""
    values = found.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "value")))).alias("values"))
    signed = rows.filter("Signed = 'Yes'").groupBy("doc_id").agg(*[R.ordered_concat(c, ["ord"], "; ").alias(c) for c in ()], *[F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col(f"`{c}`").alias("v")))), lambda x: x["v"]), lambda x: x != ""), "; ").alias(c) for c in ("Signer Name", "Signed Date")], R.ordered_distinct("Source", ["ord"], "; ").alias("Signature Source"))
    return values.join(signed, "doc_id", "full").select("doc_id", "values", F.when(F.col("Signature Source").isNull(), "No").otherwise("Yes").alias("Signed"), *[T.text(F.col(f"`{c}`")).alias(c) for c in ("Signer Name", "Signed Date", "Signature Source")])
