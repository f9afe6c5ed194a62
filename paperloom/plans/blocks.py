"""Employees of W-2 pages by the blocks under their "e/f" labels, else by the page's text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..operators import layout as L

# Where labels stand, where what belongs to them is looked for (points), labels in text, shapes.
LABEL_TOP, LABEL_LEFT, LINES, NUMBER = 280, 60, (2, 35), (30, 80)
NAME_LABELS = ("e/f employee's name, address, and zip code", "e/f employee's name, address, zip code", "employee's name, address, and zip code", "employee's name, address, zip code", "employee's name, address")
NUMBER_LABELS = ("employee's social security number", "social security number", "ssn", "social security no")
SSN_LOOSE = r"\b(\d{3}[-\s]\d{2}[-\s]\d{4})\b"
SSN_WORD = r"\b(\d{3}-\d{2}-\d{4})\b"
ZIP = r"\b\d{5}(?:-\d{4})?\b"
CITY_LINE = r"^.+,?\s+[A-Z]{2}\s+\d{5}(?:-\d{4})?\s*$"
ROW = ["doc_id", "page"]


def from_blocks(words: DataFrame) -> DataFrame:
    """doc_id, page, ord, name, ssn and address of each block that has two lines or more; of one page, numbers and nameless repeats count once.

    The first line is the name, the first that looks like a city the address's end, what is between the street; without such
    a line the second and third are taken. The number stands 30 to 80 points below the label.
    """
    labels = words.filter((F.col("y0") <= LABEL_TOP) & (F.col("x0") <= LABEL_LEFT) & F.lower("text").startswith("e/f")).select(*ROW, F.col("ord").alias("b"), F.col("y0").alias("ly"), F.col("x0").alias("lx"))
    near = words.join(labels, ROW).withColumn("down", F.col("y0") - F.col("ly"))
    one = near.withColumn("page_", F.col("page")).withColumn("page", F.concat_ws("#", "page", "b"))
    lines = L.lines_anchor(one.filter(f"down > {LINES[0]} and down < {LINES[1]} and x0 < 200 and x0 > lx - 5").select("doc_id", "page", "ord", "x0", "y0", "text"), 4.0)
    block = lines.filter("length(trim(text)) > 1").groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: F.trim(x["text"])).alias("lines")).filter("size(lines) >= 2")
    low = one.filter(f"down > {NUMBER[0]} and down < {NUMBER[1]}")
    own = F.regexp_extract("text", SSN_WORD, 1)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("x0") < 250, F.struct("x0", "ord", "text")))), lambda w: w["text"]), " ")
    number = low.groupBy("doc_id", "page").agg(F.min_by(own, F.when((own != "") & (F.col("x0") < 200), F.col("ord"))).alias("word"), F.regexp_extract(whole, SSN_WORD, 1).alias("run"))
    d = block.join(number, ["doc_id", "page"], "left").withColumn("ssn", F.coalesce("word", "run", F.lit("")))
    d = d.withColumn("at", F.array_position(F.transform("lines", lambda x: x.rlike(CITY_LINE)), True))
    get = lambda i: F.coalesce(F.get("lines", F.lit(i)), F.lit(""))
    name = F.when(F.col("at") == 1, "").otherwise(get(0))
    street = F.when(F.col("at") == 0, get(1)).when(F.col("at") > 2, F.expr("array_join(slice(lines, 2, cast(at as int) - 2), ' ')")).otherwise("")
    city = F.when(F.col("at") == 0, get(2)).otherwise(F.expr("get(lines, cast(at as int) - 1)"))
    d = d.select("doc_id", F.substring_index("page", "#", 1).cast("int").alias("page"), F.substring_index("page", "#", -1).cast("int").alias("ord"), name.alias("name"), "ssn", street.alias("street"), city.alias("city"))
    d = d.filter("name <> '' or street <> '' or city <> ''").withColumn("n", F.row_number().over(Window.partitionBy(*ROW, "ssn").orderBy("ord"))).filter("ssn = '' or n = 1")
    d = d.withColumn("k", F.row_number().over(Window.partitionBy(*ROW, "name", "street", "city").orderBy("ord"))).filter("ssn <> '' or k = 1")
    return d.select(*ROW, "ord", "name", "ssn", F.concat_ws(", ", F.nullif("street", F.lit("")), F.nullif("city", F.lit(""))).alias("address"))


def from_text(pages: DataFrame) -> DataFrame:
    """doc_id, page, ord, name, ssn and address from a page's text, where there is a name or a number.

    The number after the last labelled line that has one, else the first in the page. The line after the first name label is
    the name unless it is a label too; the first later line with a ZIP code ends the address, the one before it is the street.
    """
    lines = pages.select(*ROW, "text", F.posexplode(F.filter(F.split("text", "\n"), lambda x: T.strip(x) != "")).alias("i", "line"))
    low = F.lower(T.strip(F.col("line")))
    after = F.coalesce(*[F.when(F.contains(low, F.lit(x)), T.strip(F.regexp_replace(F.expr(f"""substring(line, locate("{x}", lower(trim(line))) + {len(x)})"""), r"^[\s:\-]+", ""))) for x in NUMBER_LABELS])
    d = lines.withColumn("after", after)
    found = F.when(F.col("after").isNotNull(), F.regexp_extract(F.when(F.col("after") == "", F.col("text")).otherwise(F.col("after")), SSN_LOOSE, 1))
    is_name = F.lit(False)
    for x in NAME_LABELS:
        is_name = is_name | F.contains(low, F.lit(x))
    d = d.withColumn("found", found).withColumn("named", is_name).withColumn("line", T.strip(F.col("line")))
    own = d.groupBy(*ROW).agg(
        F.max_by("found", F.when(F.col("found") != "", F.col("i"))).alias("ssn"), F.first("text").alias("text"), F.min(F.when(F.col("named"), F.col("i"))).alias("at"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias("lines"),
    )
    d = own.withColumn("next", F.expr("case when at is not null then slice(lines, at + 2, size(lines)) else cast(array() as array<string>) end"))
    d = d.withColumn("ok", F.expr("size(next) > 0") & ~P.form_label(F.coalesce(F.get("next", F.lit(0)), F.lit(""))))
    d = d.withColumn("later", F.expr("slice(next, 2, greatest(size(next), 1))")).withColumn("zip", F.when(F.col("ok"), F.array_position(F.transform("later", lambda x: x.rlike(ZIP)), True)))
    d = d.withColumn("city", F.when(F.col("zip") > 0, F.expr("get(next, cast(zip as int))"))).withColumn("before", F.when(F.col("zip") > 1, F.expr("get(next, cast(zip as int) - 1)")))
    street = F.when(F.col("before").isNotNull() & ~P.form_label(F.coalesce("before", F.lit(""))), F.col("before"))
    d = d.select(*ROW, F.lit(0).alias("ord"), F.when(F.col("ok"), F.col("next")[0]).otherwise("").alias("name"), F.coalesce("ssn", F.regexp_extract("text", SSN_LOOSE, 1)).alias("ssn"), F.concat_ws(", ", street, F.col("city")).alias("address"))
    return d.withColumn("n", F.count("*").over(Window.partitionBy("doc_id"))).filter("name <> '' or ssn <> ''").drop("n")


def employees(words: DataFrame, pages: DataFrame) -> DataFrame:
    """The records of all pages; a page without any from its blocks gives those of its text."""
    found = from_blocks(words)
    return found.unionByName(from_text(pages.join(found.select(*ROW).distinct(), ROW, "left_anti")))

