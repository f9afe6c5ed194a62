"""Forms as configuration: label/value specs, format routing, and the extraction pipelines composed from operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators.neighbourhood import label_value
from ..sinks import files as W
from ..sources import fields as S

# Per form the fields, the spellings of their labels and the shape of their values.
_TEXT = r"[A-Za-z0-9][A-Za-z0-9 ,.'&\-]*"
_ID = r"[A-Za-z0-9\-]+"
_HOURS = r"[\d,]+\.\d{2}"
W2_FIELDS = (
    ("tax_year", (r"Form\s+W-?2", r"Wage and Tax Statement"), r"20\d{2}"),
    ("employee_ssn", (r"[Ee]mployee'?s social security number", r"\ba\b\s*Employee"), V.SSN_FORM),
    ("employer_ein", (r"[Ee]mployer identification number", r"\bb\b\s*Employer"), V.EIN),
    ("employer_name_address", (r"[Ee]mployer'?s name, address",), _TEXT),
    ("control_number", (r"[Cc]ontrol number",), _ID),
    ("employee_name_address", (r"[Ee]mployee'?s (?:first name|name and address)",), _TEXT),
    ("box_1_wages", (r"\b1\b\s*Wages,?\s*tips",), V.MONEY),
    ("box_2_federal_tax", (r"\b2\b\s*Federal income tax withheld",), V.MONEY),
    ("box_3_ss_wages", (r"\b3\b\s*Social security wages",), V.MONEY),
    ("box_4_ss_tax", (r"\b4\b\s*Social security tax withheld",), V.MONEY),
    ("box_5_medicare_wages", (r"\b5\b\s*Medicare wages",), V.MONEY),
    ("box_6_medicare_tax", (r"\b6\b\s*Medicare tax withheld",), V.MONEY),
    ("box_15_state", (r"\b15\b\s*State\b",), r"\b[A-Z]{2}\b"),
    ("box_16_state_wages", (r"\b16\b\s*State wages",), V.MONEY),
    ("box_17_state_tax", (r"\b17\b\s*State income tax",), V.MONEY),
)
FORM_1099_FIELDS = (
    ("tax_year", (r"Form\s+1099-?(?:NEC|MISC)",), r"20\d{2}"),
    ("payer_tin", (r"PAYER'?S TIN",), V.TIN),
    ("payer_name_address", (r"PAYER'?S name, street address",), _TEXT),
    ("recipient_tin", (r"RECIPIENT'?S TIN",), V.TIN),
    ("recipient_name_address", (r"RECIPIENT'?S name",), _TEXT),
    ("account_number", (r"[Aa]ccount number",), _ID),
    ("box_1_compensation", (r"\b1\b\s*Nonemployee compensation",), V.MONEY),
    ("box_4_federal_tax", (r"\b4\b\s*Federal income tax withheld",), V.MONEY),
    ("box_5_state_tax", (r"\b5\b\s*State tax withheld",), V.MONEY),
    ("box_6_state_no", (r"\b6\b\s*State/Payer'?s state no",), _ID),
    ("box_7_state_income", (r"\b7\b\s*State income",), V.MONEY),
)
PAY_FIELDS = (
    ("employee_name", (r"Employee [Nn]ame", r"Name\s*:"), _TEXT),
    ("employee_id", (r"Employee (?:ID|Number|File\s*#)", r"File Number"), _ID),
    ("ssn", (r"SSN", r"Social Security"), V.SSN_FORM),
    ("company", (r"Company Code", r"Company Name", r"Client"), _TEXT),
    ("pay_date", (r"Pay Date",), V.DATE),
    ("period_begin", (r"Period Begin(?:ning)?",), V.DATE),
    ("period_end", (r"Period End(?:ing)?",), V.DATE),
    ("gross_pay", (r"Gross Pay",), V.MONEY),
    ("net_pay", (r"Net Pay",), V.MONEY),
    ("federal_tax", (r"Federal (?:Income Tax|Withholding|W/H)",), V.MONEY),
    ("state_tax", (r"State (?:Income Tax|Withholding|W/H)",), V.MONEY),
    ("social_security", (r"Social Security(?: Tax| EE)?\s*(?:Withheld)?",), V.MONEY),
    ("medicare", (r"Medicare(?: Tax| EE)?\s*(?:Withheld)?",), V.MONEY),
    ("regular_hours", (r"Regular Hours",), _HOURS),
    ("overtime_hours", (r"Overtime Hours", r"O/?T Hours"), _HOURS),
)


@dataclass(frozen=True)
class FormSpec:
    """A form whose values follow their labels."""

    name: str
    fields: tuple[tuple[str, tuple[str, ...], str], ...]
    reach: int = 120

    def extract(self, pages: DataFrame, text: str = "text") -> DataFrame:
        """doc_id, page and one column for each field; '' where a label or its value is missing."""
        return pages.select("doc_id", "page", *[label_value(F.col(text), list(labels), value, self.reach).alias(n) for n, labels, value in self.fields])


FORMS = {"w2": FormSpec("w2", W2_FIELDS), "1099": FormSpec("1099", FORM_1099_FIELDS), "pay": FormSpec("pay", PAY_FIELDS)}


@dataclass(frozen=True)
class FormatSpec:
    """A kind of document: how its sampled text (lower case) shows, and optionally what extracts it."""

    key: str
    sniff: Callable[[Column, Column], Column]
    extract: Callable[[DataFrame], DataFrame] | None = None


def _has(*words: str) -> Callable[[Column, Column], Column]:
    def test(t: Column, has_text: Column) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | F.contains(t, F.lit(w))
        return out

    return test


# The formats in order of priority and the words that show them.
FORMATS = (
    FormatSpec("w2", lambda t, h: _has("wage and tax statement", "wages, tips, other comp")(t, h) | t.rlike("employee.?s social security number")),
    FormatSpec("1095c", _has("1095-c", "1095c", "offer and coverage")),
    FormatSpec("bucket11", lambda t, h: _has("employee payroll changes", "associate id")(t, h) | (F.contains(t, F.lit("changed field")) & F.contains(t, F.lit("changed from")) & F.contains(t, F.lit("changed to")))),
    FormatSpec("401k", lambda t, h: t.rlike(r"401\s*\(?k\)?") | F.contains(t, F.lit("elective deferral"))),
    FormatSpec("gross-pay", lambda t, h: F.contains(t, F.lit("gross to net")) | (F.contains(t, F.lit("ee id")) & F.contains(t, F.lit("employee name")) & F.contains(t, F.lit("ssn")))),
    FormatSpec("claims", lambda t, h: h & _has("health plan id", "member totals")(t, h)),
    FormatSpec("patient-info", lambda t, h: ~h | _has("health plan id", "member totals", "patient acct")(t, h)),
    FormatSpec("creditor-list", lambda t, h: _has("mailing matrix", "mailing list")(t, h) | (F.contains(t, F.lit("creditor")) & F.contains(t, F.lit("case no")))),
    FormatSpec("generic", lambda t, h: F.lit(True)),
)


@dataclass(frozen=True)
class Extractor:
    """What reads the documents of a format: a function of their pages, words and the further tables (see ``FURTHER``) that it needs."""

    run: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()


#: Tables that documents may have beside pages and words: nodes of form fields, rows of tables with their table's box, and sizes of pages.
FURTHER = {
    "nodes": S.NODE,
    "tables": "doc_id long, page int, tbl int, row int, cells array<string>, x0 double, y0 double, x1 double, y1 double",
    "sizes": "doc_id long, page int, height double",
}


def route(samples: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """Adds format: the first selected one that shows in the sample, or null. samples: doc_id, text (lower case), has_text.

    Without a text layer, patient-info comes before claims (claims needs text, so the order of the rest stands).
    """
    chosen = [f for f in FORMATS if selected is None or f.key in selected]
    return samples.withColumn("format", F.coalesce(*[F.when(f.sniff(F.col("text"), F.col("has_text")), F.lit(f.key)) for f in chosen], F.lit(None).cast("string")))


def sample_pages(pages: DataFrame, most: int = 3, least: int = 40) -> DataFrame:
    """doc_id, the lower-cased text of the first pages, and whether they hold text at all."""
    first = pages.filter(F.col("page") <= most)
    return first.groupBy("doc_id").agg(F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n")).alias("text"), (F.sum(F.length(T.strip(F.col("text")))) >= least).alias("has_text"))


def dispatched(
    pages: DataFrame, words: DataFrame, extractors: dict[str, Callable | Extractor], selected: list[str] | None = None, folder: str | None = None, further: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of all documents, each by the extractor of its format, and the rejects.

    An extractor is a function of pages and words, or an ``Extractor`` that names what else it needs of ``further``, tables
    as in ``FURTHER``; those that aren't given count as empty. Words may have size and font beside their boxes.

    Rows: doc_id, format, n and fields (a map of the filled columns). Rejects: doc_id, format and why: no format shows, the
    format has no extractor, its extractor failed, or it found nothing. Routed pages and words are written once, by format,
    to ``folder`` (by default a new one in the shared folder); each extractor reads its own part and writes its rows as a job
    of its own, so that one which fails, while it is planned or in the midst of its data, rejects the documents of its own
    format only, and a run over the other formats is whole.
    """
    spark, at = pages.sparkSession, folder or W.work_folder(pages.sparkSession)

    def kept(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{at}/{name}") if by else df.write.mode("overwrite").parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    routed = kept(route(sample_pages(pages), selected).select("doc_id", "format"), "routed")
    # At most one row for each format.
    shown = {r.format for r in routed.select("format").distinct().collect()}
    id_type = pages.schema["doc_id"].dataType.simpleString()
    needed = {n for k, e in extractors.items() if k in shown and isinstance(e, Extractor) for n in e.needs}
    given = {"pages": pages, "words": words} | {n: df for n, df in (further or {}).items() if n in needed}
    own = {n: kept(df.join(routed, "doc_id"), n, "format") for n, df in given.items()}
    own |= {n: spark.createDataFrame([], FURTHER[n].replace("doc_id long", f"doc_id {id_type}")).withColumn("format", F.lit("")) for n in needed - set(own)}
    rows = routed.filter("false").select("doc_id", "format", F.create_map().cast("map<string,string>").alias("fields"))
    broken = []
    for key, extract in extractors.items():
        if key not in shown:
            continue
        try:
            reads = Extractor(extract) if not isinstance(extract, Extractor) else extract
            found = reads.run(*[own[n].filter(F.col("format") == key).drop("format") for n in ("pages", "words", *reads.needs)])
            names = [c for c in found.columns if c != "doc_id"]
            filled = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull() & (v != ""))
            rows = rows.unionByName(kept(found.select("doc_id", F.lit(key).alias("format"), filled.alias("fields")), f"rows/{key}"))
        except Exception as e:  # noqa: BLE001  one format's failure isn't the others'
            broken.append((key, f"{type(e).__name__}: {str(e)[:500]}"))
    why = F.when(F.col("format").isNull(), "no format")
    for key, error in broken:
        why = why.when(F.col("format") == key, error)
    why = why.when(~F.col("format").isin(*extractors), "no extractor")
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.to_json("fields"))))
    rejects = routed.join(rows.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "format", why.otherwise("nothing found").alias("why"))
    return rows.select("doc_id", "format", "n", "fields"), rejects
