"""Registered queries: a rendered input, the operator over it, and the DuckDB SQL that states the same rule.

Inputs are SQL that both engines read: they render the test tables as words, lines, cells and records.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Tables of which documents are rendered, by the column that names a document, and those whose rows stand for themselves.
DEALT = {"customer": "c_custkey", "supplier": "s_suppkey"}
LARGE = ("orders", "lineitem", "events", "customer", "part")


@dataclass(frozen=True)
class Query:
    name: str
    source: str  # SQL with {table} marks
    run: Callable[[DataFrame], DataFrame]
    oracle: str | None  # SQL over t, the source

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(rendered(spark, sf_dir, self.source))

    @property
    def sql(self) -> str | None:
        """Lambdas are written x -> ... above; DuckDB wants them spelled out."""
        if self.oracle is None:
            return None
        source = re.sub(_EACH, lambda m: f"unnest([{m[1]}]::STRUCT({m[2]})[], recursive := true)", self.source, flags=re.S)
        rule = re.sub(r"\b([a-z]) -> ", r"lambda \1: ", self.oracle)
        return ("WITH RECURSIVE t AS (" if re.match(r"\s*WITH RECURSIVE ", rule) else "WITH t AS (") + re.sub(r"{(\w+)}", r"\1", source) + ")" + re.sub(r"^\s*WITH (RECURSIVE )?", ", ", " " + rule)


def rendered(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The source's rows; each table is read with the columns that the SQL names.

    A row of a table that is rendered into many is dealt out by its key before that, so that the tasks' number follows the
    rows that are made; other tables' rows say into how many partitions shuffles are dealt.
    """
    spread.measured(spark)
    used = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in TABLES if "{" + n + "}" in source}
    each = sum(m[1].count("), (") + 1 for m in re.finditer(_EACH, source, flags=re.S))
    for n, df in used.items():
        if each and n in DEALT:
            used[n] = spread.dealt(df.select(*[c for c in df.columns if re.search(rf"\b{c}\b", source)]), DEALT[n], each)
        elif n in LARGE:
            spread.enough(spark, df.count())
    fields = lambda m: ", ".join(f.split()[0] for f in m[2].split(","))
    return spark.sql(re.sub(_EACH, lambda m: f"inline(array({m[1]})) AS ({fields(m)})", source, flags=re.S), **used)


_EACH = r"<each>(.*?)<as>(.*?)</each>"


def each_row(rows: list[str], fields: str) -> str:
    """For a select list: a row for each of ``rows`` (SQL tuples), generated beside the table's own row, so that the table is read once. Both engines' spellings follow from it."""
    return f"<each>{', '.join(rows)}<as>{fields}</each>"


QUERIES: dict[str, Query] = {}


def query(name: str, source: str, oracle: str | None = None):
    """Registers a function of the rendered input."""

    def keep(run: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = Query(name, source, run, oracle)
        return run

    return keep


def scalar(name: str, source: str, out: dict[str, Callable[..., Column]] | Callable[..., Column], oracle: dict[str, str]) -> None:
    """Registers functions of the column s (and others by name), beside the key k. A single function may give a struct."""
    from pyspark.sql import functions as F

    def run(df: DataFrame) -> DataFrame:
        if callable(out):
            return df.select("k", out(F.col("s")).alias("o")).select("k", *[F.col(f"o.{c}").alias(c) for c in oracle])
        return df.select("k", *[f(F.col("s")).alias(c) for c, f in out.items()])

    cols = ", ".join(f"{e} AS {c}" for c, e in oracle.items())
    QUERIES[name] = Query(name, source, run, f"SELECT k, {cols} FROM t" if oracle else None)
