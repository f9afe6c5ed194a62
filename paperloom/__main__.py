"""Command line: ``python -m paperloom FORMAT IN OUT`` reads words or pages from Parquet and writes the rows of a format.

IN is a folder with ``words`` (doc_id, page, ord, x0, y0, x1, y1, text) or ``pages`` (doc_id, page, text); for ``auto`` both,
and ``nodes``, ``tables`` and ``sizes`` where there are any. FORMAT is a form, a composed extractor, or ``auto``, which routes
each document by its text and writes rejects beside the rows.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .plans import changes, forms, remittance
from .plans.registered import EXTRACTORS


def _is_there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def extract(spark: SparkSession, name: str, source: str) -> dict[str, DataFrame]:
    """The named outputs of a format."""
    read = lambda table: spark.read.parquet(f"{source}/{table}")
    if name in forms.FORMS:
        return {"rows": forms.FORMS[name].extract(read("pages"))}
    if name == "claims":
        return {"rows": remittance.claim_rows(remittance.claims(remittance.oriented(read("words"))))}
    if name == "patient-info":
        return {"rows": remittance.patient_rows(remittance.patients(read("pages")))}
    if name == "bucket11":
        found = changes.changes(read("words"))
        return {"rows": changes.log(found), "report": changes.report(read("words"), found)}
    there = [t for t in forms.FURTHER if _is_there(spark, f"{source}/{t}")]
    rows, rejects = forms.dispatched(read("pages"), read("words"), EXTRACTORS, further={t: read(t) for t in there})
    return {"rows": rows, "rejects": rejects}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="paperloom", description=__doc__.split("\n")[0])
    p.add_argument("format", choices=[*forms.FORMS, "claims", "patient-info", "bucket11", "auto"])
    p.add_argument("source")
    p.add_argument("target")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("paperloom").getOrCreate()
    for name, df in extract(spark, args.format, args.source).items():
        df.write.mode("overwrite").parquet(f"{args.target}/{name}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
