"""Which extractor reads the documents of each of the nine formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as L
from ..sources import fields as FN
from . import blocks, changes, coverage, creditors, generic, pipelines, remittance, retirement
from .forms import Extractor


def _numbered(pages: DataFrame) -> DataFrame:
    """The lines of all pages: doc_id, page, ord (within the document, from 0) and text."""
    each = pages.select("doc_id", "page", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    return each.select("doc_id", "page", F.struct("page", "i").alias("ord"), "text")


def _plan(pages: DataFrame, words: DataFrame, nodes: DataFrame, tables: DataFrame) -> DataFrame:
    rows = tables.select("doc_id", "page", "tbl", "row", "cells")
    return retirement.employees(FN.leaf_values(nodes), rows, _numbered(pages)).select("doc_id", "page", "last", "first", "middle", "suffix", "ssn", "gross_salary", "ee_contribution", "er_match", "ytd_contribution", "ee_id")


def _generic(pages: DataFrame, words: DataFrame, nodes: DataFrame, tables: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sections outside the tables' boxes, table rows, and drawn fields under the printed labels nearest to them."""
    boxes = tables.filter("x0 is not null").selectExpr("doc_id", "page", "x0 as bx0", "y0 as btop", "x1 as bx1", "y1 as bbottom").distinct()
    sized = words.withColumns({c: F.lit(None).cast(t) for c, t in (("size", "double"), ("font", "string")) if c not in words.columns})
    lines = L.lines_fixed(words).withColumn("text", T.clean(F.col("text"))).withColumnRenamed("y", "line_no")
    fields = generic.form_fields(FN.widgets(nodes), lines, sizes)
    found = generic.document_rows(generic.sections(generic.section_lines(sized, boxes)), generic.table_rows(tables.select("doc_id", "page", "tbl", "row", "cells")), fields)
    return found.select("doc_id", "ord", "page", "category", "name", "value")


def _claims(pages: DataFrame, words: DataFrame) -> DataFrame:
    return remittance.claims(remittance.oriented(words)).drop("ord")


#: By format: (pages, words and what else is named) of its documents to rows that have doc_id.
EXTRACTORS = {
    "w2": lambda pages, words: blocks.employees(words, pages).drop("ord"),
    "1095c": lambda pages, words: coverage.employees(_numbered(pages)),
    "bucket11": lambda pages, words: changes.changes(words).drop("ord"),
    "401k": Extractor(_plan, ("nodes", "tables")),
    "gross-pay": lambda pages, words: pipelines.gross(words),
    "claims": _claims,
    "patient-info": lambda pages, words: remittance.patients(pages).drop("ord"),
    "creditor-list": lambda pages, words: creditors.sheets(creditors.entries(words))["parsed"].drop("ord"),
    "generic": Extractor(_generic, ("nodes", "tables", "sizes")),
}
