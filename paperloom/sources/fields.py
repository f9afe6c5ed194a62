"""Form fields from raw field nodes: the walk down the field tree, inherited attributes, widgets and signatures.

A node is a row (doc_id, node, parent, ord, listed, subtype, page, x0, y0, x1, y1, T, TU, FT, V, flags, signed, sig_name,
sig_date, sig_reason, sig_location, sig_contact); a PDF engine only has to dump its objects. ``listed`` marks the fields that
the form names at its top, ``ord`` a node's place among its siblings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.spread import measured
from ..sinks.files import work_folder

NODE = (
    "doc_id long, node int, parent int, ord int, listed boolean, subtype string, page int, x0 double, y0 double, x1 double, y1 double, T string, TU string, FT string, V string, flags int,"
    " signed boolean, sig_name string, sig_date string, sig_reason string, sig_location string, sig_contact string"
)
# Kinds of fields, and the flag of a field that can't be changed.
KINDS = {"/Tx": "Text", "/Ch": "Dropdown / List", "/Btn": "Checkbox / Radio", "/Sig": "Signature"}
READ_ONLY = 1
#: Levels that a field tree may have; deeper ones are broken, since a node that is its own ancestor has no end.
DEEPEST = 100


def walked(nodes: DataFrame) -> DataFrame:
    """doc_id, node, path (orders nodes as the tree is walked), name, alt, kind and raw, each the node's own or the nearest one above, up, and whether the top node is listed.

    A level of all documents at a time: its nodes are joined to their children, which are the next level, until there are
    none. Levels are written to the shared folder while the query is being built, so no level is worked out twice and a tree
    of many documents or one of very many nodes is spread over the cluster. Nodes that hang on no top node give nothing.
    """
    spark, at = nodes.sparkSession, work_folder(nodes.sparkSession)
    measured(spark)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    place = F.lpad(F.col("ord").cast("string"), 6, "0").alias("place")
    own = kept(nodes.select("doc_id", "node", "parent", place, F.col("T").alias("name"), F.col("TU").alias("alt"), F.col("FT").alias("kind"), F.col("V").alias("raw"), "listed"), "nodes")
    given = ("name", "alt", "kind", "raw")
    level = kept(own.filter("parent is null").select("doc_id", "node", F.col("place").alias("path"), *given, F.lit(None).cast("int").alias("up"), "listed"), "level0")
    below = own.filter("parent is not null").select("doc_id", F.col("node").alias("child"), F.col("parent").alias("node"), "place", *[F.col(c).alias(f"own_{c}") for c in given])
    every, n = level, 0
    while not level.isEmpty():
        if n == DEEPEST:
            raise ValueError(f"a field tree has more than {DEEPEST} levels")
        n += 1
        met = level.join(below, ["doc_id", "node"])
        level = kept(met.select("doc_id", F.col("child").alias("node"), F.concat_ws("/", "path", "place").alias("path"), *[F.coalesce(f"own_{c}", c).alias(c) for c in given], F.col("node").alias("up"), "listed"), f"level{n}")
        every = every.unionByName(level)
    return every


def walk(nodes: DataFrame, listed: bool = True) -> DataFrame:
    """The nodes of ``walked`` below top nodes that are listed, or below those that aren't."""
    return walked(nodes).filter(F.col("listed") == listed).drop("listed")


def leaf_values(nodes: DataFrame) -> DataFrame:
    """doc_id, ord, name and value of the nodes that hold a value of their own, in the walk's order; empty and off ones go."""
    own = nodes.select("doc_id", "node", T.clean(F.col("T")).alias("own_name"), T.clean(F.col("V")).alias("value"))
    found = walk(nodes).select("doc_id", "node", "path").join(own, ["doc_id", "node"]).filter("value <> '' and value not in ('/Off', 'Off')")
    return found.select("doc_id", F.col("path").alias("ord"), F.col("own_name").alias("name"), "value")


def widgets(nodes: DataFrame) -> DataFrame:
    """The drawn fields: doc_id, page, ord, name, alt, kind (see ``KINDS``), raw, box, flags and signature.

    A document whose listed fields are nowhere drawn gives its widget annotations instead.
    """
    drawn = nodes.filter("page is not null and x0 is not null")
    every = walked(nodes)
    drawn = drawn.drop("listed")
    seen = every.filter("listed").drop("listed").join(drawn.drop("T", "TU", "FT", "V"), ["doc_id", "node"])
    loose = every.filter("not listed").drop("listed").join(drawn.filter("subtype = '/Widget'").drop("T", "TU", "FT", "V"), ["doc_id", "node"]).join(seen.select("doc_id").distinct(), "doc_id", "left_anti")
    every = seen.unionByName(loose)
    above = nodes.select("doc_id", F.col("node").alias("up"), *[F.col(c).alias(f"up_{c}") for c in ("signed", "sig_name", "sig_date", "sig_reason", "sig_location", "sig_contact")])
    every = every.join(above, ["doc_id", "up"], "left")
    label = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), F.col("kind")), F.lit("Field"))
    # A widget's own signature, else that of the field right above it.
    mine = F.col("signed") | F.col("up_signed").isNull()
    sig = {c: F.when(F.coalesce(F.col("signed"), F.lit(False)), F.col(f"sig_{c}")).otherwise(F.col(f"up_sig_{c}")) for c in ("name", "date", "reason", "location", "contact")}
    signed = F.when(mine, F.coalesce("signed", F.lit(False))).otherwise(F.col("up_signed"))
    return every.select("doc_id", "page", F.col("path").alias("ord"), T.clean(F.col("name")).alias("name"), T.clean(F.col("alt")).alias("alt"), label.alias("kind"), "raw", "x0", "y0", "x1", "y1", F.coalesce("flags", F.lit(0)).alias("flags"), signed.alias("signed"), *[T.text(v).alias(f"sig_{c}") for c, v in sig.items()])
