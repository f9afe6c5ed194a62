"""Coverage statements: the employee of a page in either of two layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..functions import values as V

# Labels of both layouts, what ends the first one's blocks, and how many lines follow where nothing does.
NAME_A, NAME_END = r"EMPLOYEE.s name,\s*address,\s*ZIP/?postal code\s*&?\s*country", r"Do not attach to your tax return"
SSN_A, SSN_END = r"EMPLOYEE.s social security number\s*\(SSN\)", r"Department of the Treasury|Covered Individuals|APPLICABLE LARGE EMPLOYER"
FIELDS_B = (
    ("name", r"\s*1\s+Name of employee"), ("ssn", r"\s*2\s+Social security number\s*\(SSN\)"), ("street", r"\s*3\s+Street address(?:\s*\(including apartment no\.?\))?"), ("city", r"\s*4\s+City or town"),
    ("state", r"\s*5\s+State or province"), ("zip", r"\s*6\s+Country and ZIP(?:\s+or foreign postal code)?"), ("end", r"\s*7\s+Name of employer"),
)
NAME_LINES, SSN_LINES, VALUE_LINES = 5, 3, 2


LABELS = {"name_a": NAME_A, "name_end": NAME_END, "ssn_a": SSN_A, "ssn_end": SSN_END} | {f"b_{k}": p for k, p in FIELDS_B}


def labelled(lines: DataFrame) -> DataFrame:
    """A row for each page: its lines in order, and for each label of both layouts the places where it stands.

    A label begins one line, or that line joined with the next one or two; the fewest lines count. A place is a struct of i
    (its first line, from 0), after (the line behind it) and rest (what follows it in the joined lines).
    """
    order = Window.partitionBy("doc_id", "page").orderBy("ord")
    d = lines.select("doc_id", "page", "ord", F.col("text").alias("j1"), (F.row_number().over(order) - 1).alias("i"), *[F.lead("text", n).over(order).alias(f"t{n}") for n in (1, 2)])
    d = d.withColumn("j2", F.concat("j1", F.lit(" "), "t1")).withColumn("j3", F.concat("j2", F.lit(" "), "t2"))
    shape = {k: f"(?i)^(?:{p})" for k, p in LABELS.items()}
    size = {k: F.coalesce(*[F.when(F.col(f"j{n}").rlike(p), F.lit(n)) for n in (1, 2, 3)]) for k, p in shape.items()}
    d = d.select("doc_id", "page", "i", "j1", "j2", "j3", *[n.alias(f"n_{k}") for k, n in size.items()])
    rest = lambda k: F.trim(F.regexp_replace(F.expr(f"case n_{k} when 1 then j1 when 2 then j2 else j3 end"), shape[k], ""))
    place = lambda k: F.when(F.col(f"n_{k}").isNotNull(), F.struct("i", (F.col("i") + F.col(f"n_{k}")).alias("after"), rest(k).alias("rest")))
    own = F.transform(F.array_sort(F.collect_list(F.struct("i", "j1"))), lambda x: x["j1"])
    return d.groupBy("doc_id", "page").agg(own.alias("lines"), *[F.array_sort(F.collect_list(place(k))).alias(f"at_{k}") for k in LABELS])


def label(key: str, start: Column | int = 0) -> Column:
    """The first place of a label from line ``start`` on, or null."""
    return F.try_element_at(F.filter(f"at_{key}", lambda x: x["i"] >= start), F.lit(1))


def between(lines: Column, at: Column, stop: Column) -> Column:
    """The filled texts from behind a label up to the line ``stop``, the label's own rest first."""
    inner = F.transform(F.slice(lines, at["after"] + 1, F.greatest(stop - at["after"], F.lit(0))), lambda x: F.trim(x))
    return F.filter(F.concat(F.array(at["rest"]), inner), lambda x: x != "")


def employees(lines: DataFrame) -> DataFrame:
    """doc_id, page, format, name parts, address parts and ssn of each page that either layout fits, the first one tried first. lines: doc_id, page, ord, text."""
    pages = labelled(lines)
    size, own = F.size("lines"), F.col("lines")
    a = pages.withColumn("at", label("name_a")).withColumn("end", label("name_end", F.coalesce(F.col("at.after"), F.lit(0))))
    a = a.withColumn("stop", F.coalesce(F.col("end.i"), F.least(F.col("at.after") + NAME_LINES, size))).withColumn("block", F.when(F.col("at").isNotNull(), between(own, F.col("at"), F.col("stop"))))
    a = a.withColumn("num", label("ssn_a", F.coalesce("stop", F.lit(0)))).withColumn("num_end", label("ssn_end", F.coalesce(F.col("num.after"), F.lit(0))))
    a = a.withColumn("a_ssn", F.array_join(between(own, F.col("num"), F.coalesce(F.col("num_end.i"), F.least(F.col("num.after") + SSN_LINES, size))), " ")).withColumn("place", V.city_state_zip_country(F.get("block", F.lit(2))))
    at: Column | int = F.lit(0)
    for key, _ in FIELDS_B:
        a = a.withColumn(f"b_{key}", label(f"b_{key}", at))
        a = a.withColumn(f"from_{key}", F.coalesce(F.col(f"b_{key}.after"), at))
        at = F.col(f"from_{key}")
    keys = [k for k, _ in FIELDS_B]
    for n, key in enumerate(keys[:-1]):
        stop = F.coalesce(*[F.col(f"b_{k}.i") for k in keys[n + 1 :]], F.least(F.col(f"b_{key}.after") + VALUE_LINES, size))
        a = a.withColumn(f"v_{key}", F.coalesce(F.array_join(between(own, F.col(f"b_{key}"), stop), " "), F.lit("")))
    first = F.size(F.coalesce("block", F.array().cast("array<string>"))) > 0
    a = a.withColumn("format", F.when(first, "A").when(F.col("b_name").isNotNull(), "B")).withColumn("z", V.zip_country(F.col("v_zip")))
    pick = lambda x, y: T.text(F.when(F.col("format") == "A", x).otherwise(y))
    raw = F.get("block", F.lit(2))
    out = a.select(
        "doc_id", "page", "format", pick(F.get("block", F.lit(0)), F.col("v_name")).alias("full_name"), pick(F.get("block", F.lit(1)), F.col("v_street")).alias("street"), pick(F.coalesce(F.nullif("place.city", F.lit("")), raw), F.col("v_city")).alias("city"),
        pick(F.col("place.state"), F.col("v_state")).alias("state"), pick(F.col("place.zip"), F.col("z.zip")).alias("zip"), pick(F.col("place.country"), F.col("z.country")).alias("country"), F.regexp_extract(pick(F.col("a_ssn"), F.col("v_ssn")), f"({V.SSN_RUN})", 1).alias("ssn"),
    )
    out = out.withColumn("n", N.covered_name(F.col("full_name"))).filter("format is not null")
    return out.select("doc_id", "page", "format", "n.first", "n.middle", "n.last", "street", "city", "state", "zip", "country", "ssn")
