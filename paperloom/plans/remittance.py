"""Claims and patient records of remittance pages: labelled records around a plan id, tabular records closed by member totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A
from ..operators import records as R

# Labels and shapes of remittance lines; columns of the two outputs; how far neighbours are looked at.
PLAN = r"Health\s*Plan\s*ID\s*:\s*(\S+)"
ACCOUNT, PATIENT_ACCOUNT, TOTALS = r"Pat\.?\s*Acct\s*#\s*(\S+)", r"Patient\s+Acct\.?\s*#\s*(\S+)", r"Member Totals\s*[:;]"
#: A surname may begin neither with a filler word nor inside one.
SURNAME = r"(?!(?i:(?<![A-Za-z'\-])(?:medi-cal|medicare|commercial|medi-medi|pat)(?![A-Za-z'\-])))(?<![A-Za-z'\-])[A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-]+)*"
GIVEN = r"[^A-Za-z]*([A-Za-z][A-Za-z'\-\. ]*)"
CLAIM_COLUMNS = ("Patient Name", "Health Plan ID", "Member #", "Claim #", "Pat. Acct #", "Service Date", "CPT Code", "Page")
PATIENT_COLUMNS = ("Format", "Patient Name", "Health Plan ID", "Claim #", "Member #", "Pat. Acct #", "Service Date", "Proc", "CPT", "Page")
NAME_LINES, ACCOUNT_LINES, HEADER_LINES, DATA_LINES = 2, 4, 8, 25
PATIENT_NAME = r"[A-Z][A-Za-z'\-]+,\s*[A-Z][A-Za-z'\-\.]*(?: [A-Za-z][A-Za-z'\-\.]*){0,4}"
BEFORE, AFTER = 200, 500
DOC = ["doc_id"]


def _first(found: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(found, lambda x: x != ""), F.lit(1)), F.lit(""))


def _name(text: Column, sep: str = "[,.]") -> Column:
    last, given = (F.trim(F.regexp_extract(text, f"({SURNAME}){sep}{GIVEN}", i)) for i in (1, 2))
    return F.when(last != "", F.concat(last, F.lit(", "), given)).otherwise(F.lit(""))


def _stops(line: Column) -> Column:
    return line["text"].rlike(PLAN) | F.contains(line["text"], F.lit("User Comments:"))


def _names(lines: Column) -> Column:
    """The first name in the lines before a stop, left of a payee."""
    return _first(F.transform(A.until_stop(F.slice(lines, 1, NAME_LINES), _stops), lambda x: _name(F.substring_index(x["text"], "Payee:", 1))))


def labelled(lines: DataFrame, by: list[str] = DOC) -> DataFrame:
    """A record for each line with a plan id. lines: by, idx (numbered from 1 without gaps), page, text, words.

    Name: left of the label, in the two lines above, in the two below. Account: in this line and the three below, else in the
    four above. Column header: in the eight lines above, else in this one and the seven below; its 25 rows below give the
    latest date and the first procedure. Neighbours beyond another plan id or a comment don't count.
    """
    d = A.lines_around(lines, F.col("text").rlike(PLAN), by, "idx", HEADER_LINES, HEADER_LINES + DATA_LINES, ["text", "words", "page"])
    return _read(d.withColumn("page", F.col("own.page")), *by, "idx", "page")


def _read(d: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the labelled record of each row's own line, between the lines above (nearest first) and below it."""
    acct = lambda x: F.regexp_extract(x["text"], ACCOUNT, 1)
    cpt = "filter(sequence(1, size(x.words)), i -> x.words[i - 1].text rlike '^CPT-?$')"
    # A header has a word "CPT" with another after it.
    header = lambda xs: F.expr(f"transform({xs}, (x, n) -> case when size(x.words) > 0 and try_element_at({cpt}, 1) < size(x.words) then struct(n, x.words as words, try_element_at({cpt}, 1) as i) end)")
    d = d.select(*keep, "own", "above", "below", A.until_stop(F.slice("above", 1, HEADER_LINES), _stops).alias("near"), F.concat(F.array("own"), F.slice("below", 1, HEADER_LINES - 1)).alias("next"))
    d = d.select("*", F.try_element_at(F.array_compact(header("near")), F.lit(1)).alias("up"), F.try_element_at(F.array_compact(header("next")), F.lit(1)).alias("down"))
    d = d.withColumn("head", F.coalesce("up", "down")).withColumn("skip", F.when(F.col("up").isNotNull(), 0).otherwise(F.col("down.n")))
    starts = F.expr("array_sort(array(struct(head.words[0].x0 as x, 1 as o, 'service' as name), struct(coalesce(try_element_at(filter(head.words, w -> w.text = 'Revenue'), 1).x0, head.words[head.i - 1].x0) as x, 2 as o, 'revenue' as name), struct(head.words[head.i - 1].x0 as x, 3 as o, 'cpt' as name), struct(head.words[head.i].x0 as x, 4 as o, 'amounts' as name)))")
    d = d.withColumn("starts", F.when(F.col("head").isNotNull(), starts))
    d = d.withColumn("data", F.when(F.col("head").isNotNull(), A.until_stop(F.slice("below", F.col("skip") + 1, F.lit(DATA_LINES)), lambda x: x["text"].rlike(PLAN))))
    cells = lambda name: F.transform("data", lambda x: F.array_join(F.transform(F.filter(x["words"], lambda w: L.last_start(w["x0"], F.col("starts"), 2.0) == name), lambda w: w["text"]), " "))
    d = d.select("*", cells("service").alias("services"), cells("cpt").alias("codes"))
    dates = F.transform("services", lambda x: V.date(F.regexp_extract(x, f"({V.DATE})", 1)))
    left = F.substring_index(F.substring_index("own.text", "Health Plan ID:", 1), "Payee:", 1)
    name = F.coalesce(*[F.nullif(x, F.lit("")) for x in (_name(left), _names(F.col("above")), _names(F.col("below")))], F.lit(""))
    account = F.coalesce(F.nullif(_first(F.transform(F.slice("next", 1, ACCOUNT_LINES), acct)), F.lit("")), _first(F.transform(A.until_stop(F.slice("above", 1, ACCOUNT_LINES), _stops), acct)))
    backward = F.coalesce(F.nullif(_name(left), F.lit("")), _names(F.col("above")))
    return d.select(
        *keep, name.alias("name"), V.plan_id(F.col("own.text")).alias("plan"), F.lit("").alias("member"), V.claim_number(F.col("own.text")).alias("claim"), account.alias("acct"),
        F.coalesce(V.us_date(F.array_max(dates)), F.lit("")).alias("service_date"), F.coalesce(_first(F.filter("codes", lambda x: x.rlike(r"\d"))), F.lit("")).alias("cpt"), (backward != "").alias("backward"),
    )


def tabular(lines: DataFrame, by: list[str] = DOC) -> DataFrame:
    """Records that a name after a number opens and member totals close.

    The last account and the latest date with a procedure count; records without either go (see ``incomplete``). Where a
    line names the provider's column, names are looked for left of it.
    """
    return tabular_states(lines, by).filter("state = 'closed'").drop("state", "missing")


def incomplete(lines: DataFrame, by: list[str] = DOC) -> DataFrame:
    """Closed tabular records that lack an account or a date, and what each lacks."""
    return tabular_states(lines, by).filter("state = 'incomplete'").select(*by, "page", "name", "missing")


def tabular_states(lines: DataFrame, by: list[str] = DOC) -> DataFrame:
    """All closed tabular records with their state (closed, incomplete) and what each lacks, in one pass."""
    d = _tabular(lines, by).filter("idx is not null")
    missing = F.array_compact(F.array(*[F.when(F.col(c) == "", name) for c, name in (("acct", "Pat. Acct #"), ("service_date", "Service Date"), ("member", "Member #"), ("claim", "Claim #"))]))
    return d.drop("segment").withColumn("state", F.when((F.col("acct") != "") & (F.col("service_date") != ""), "closed").otherwise("incomplete")).withColumn("missing", missing)


def _tabular(lines: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """A row for each run of lines that a name opens (0: those before the first one), its record, and ``more`` aggregates over all lines of the run. Runs that nothing closes have no idx."""
    order = Window.partitionBy(*by).orderBy("idx")
    provider = F.when(F.col("text").rlike(r"Provider\s*Name"), F.expr("try_element_at(filter(words, w -> w.text = 'Provider'), 1).x0"))
    d = lines.withColumn("limit", F.first(provider, True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - 2.0)
    d = d.withColumn("seen", F.when(F.col("limit").isNull(), F.col("text")).otherwise(L.left_of(F.col("words"), F.col("limit")))).withColumn("prev", F.trim(F.coalesce(F.lag("text").over(order), F.lit(""))))
    shape = rf"^(.*?)({SURNAME}),{GIVEN}"
    d = d.withColumn("prefix", F.trim(F.regexp_extract("seen", shape, 1))).withColumn("opens", F.col("seen").rlike(shape) & F.col("prefix").rlike(r"\d"))
    last = V.last_date_and_code(F.col("text"))
    d = d.withColumns({c: F.trim(F.regexp_extract("seen", shape, i)) for c, i in (("surname", 2), ("given", 3))} | {"a": F.regexp_extract("text", PATIENT_ACCOUNT, 1), "totals": F.col("text").rlike(TOTALS), "last": last})
    d = d.withColumn("segment", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("stop", F.min(F.when(F.col("totals") & (F.col("a") == ""), F.col("idx"))).over(Window.partitionBy(*by, "segment")))
    d = d.withColumn("at", F.expr("case when segment > 0 and idx < stop then idx end")).withColumn("day", F.when((F.col("a") == "") & (F.col("last")["code"] != ""), V.date(F.col("last")["date"])))
    before = F.substring_index("prev", " ", 1)
    member = F.when(before.rlike(r"\d") & ~F.contains("prev", F.lit("Totals")) & ~F.contains("prev", F.lit("Acct")), before).otherwise(F.lit(""))
    own = lambda c: F.min_by(c, "at")
    page = [own("page").alias("page")] if "page" not in by else []
    return d.groupBy(*by, "segment").agg(
        F.min("at").alias("idx"), *page, own(F.concat("surname", F.lit(", "), "given")).alias("name"), F.lit("").alias("plan"), own(member).alias("member"), own(F.substring_index("prefix", " ", 1)).alias("claim"),
        F.coalesce(F.max_by("a", F.when(F.col("a") != "", F.col("at"))), F.lit("")).alias("acct"), F.coalesce(V.us_date(F.max(F.when(F.col("at").isNotNull(), F.col("day")))), F.lit("")).alias("service_date"), F.lit("").alias("cpt"), *more,
    )


_FIELDS = ("name", "plan", "member", "claim", "acct", "service_date", "cpt")


def merged(rows: DataFrame) -> DataFrame:
    """Rows of one plan id and name as one: the latest date, all other distinct values joined by ';'. Rows without either stay.

    rows: doc_id, ord, page and the fields; the result is in the order of each row's first page.
    """
    d = rows.withColumn("page", F.col("page").cast("string")).withColumn("own", F.when((F.col("plan") == "") | (F.col("name") == ""), F.col("ord")))
    joined = [R.ordered_distinct(c, ["ord"], ";").alias(c) for c in (*_FIELDS, "page") if c != "service_date"]
    out = d.groupBy("doc_id", F.col("plan").alias("_p"), F.col("name").alias("_n"), "own").agg(F.min("ord").alias("ord"), F.coalesce(V.us_date(F.max(V.date(F.col("service_date")))), F.lit("")).alias("service_date"), *joined)
    place = Window.partitionBy("doc_id").orderBy(F.coalesce(F.split("page", ";")[0].try_cast("int"), F.lit(0)), "ord")
    return out.withColumn("ord", F.row_number().over(place)).select("doc_id", "ord", *_FIELDS, "page")


def oriented(words: DataFrame, width: float = 612.0) -> DataFrame:
    """The lines of all pages of a document in a row: doc_id, idx, page, text, words.

    A page that is readable only when mirrored is mirrored. Its lines run bottom up where that gives more plan ids a name
    above them, or, where neither way gives any, where only that way gives complete records. The words are read once: a line
    holds both of its readings, a page both of its directions, and all that compares them stays with the page.
    """
    key, way = ["doc_id", "page"], ["doc_id", "page", "way"]
    page, text = Window.partitionBy(*key), lambda c: F.array_join(F.transform(c, lambda w: w["text"]), " ")
    readable = lambda c: F.max(P.claims_readable(F.col(c))).over(page)
    d = L.lines_chain(words, 5.0, True, width).withColumn("turned", text("mirrored"))
    d = d.withColumn("flip", ~readable("text") & readable("turned")).select(*key, "line", *[F.when(F.col("flip"), F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("text", "turned"), ("words", "mirrored"))])
    down = F.row_number().over(page.orderBy("line"))
    d = d.withColumn("down", down).withColumn("up", F.count("*").over(page) - F.col("down") + 1).withColumn("way", F.explode(F.array(F.lit(0), F.lit(1))))
    d = d.withColumn("idx", F.when(F.col("way") == 0, F.col("down")).otherwise(F.col("up")))
    # Runs of tabular lines, with all their lines; then both directions of a page, each as a whole.
    runs = _tabular(d, way, F.collect_list(F.struct("idx", "text", "words")).alias("own"))
    closed = F.expr("idx is not null and acct <> '' and service_date <> '' and name <> ''")
    ways = runs.groupBy(*way).agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("own"), F.count_if(closed).alias("closed"))
    anchors = F.filter(F.transform("own", lambda x: F.when(x["text"].rlike(PLAN), x["idx"])), lambda i: i.isNotNull())
    near = ways.select(*way, F.col("own").alias("all"), "closed", F.explode_outer(anchors).alias("at"))
    near = near.withColumns({"own": F.expr("get(all, at - 1)"), "above": F.expr(f"reverse(slice(all, greatest(at - {HEADER_LINES}, 1), at - greatest(at - {HEADER_LINES}, 1)))"), "below": F.expr(f"slice(all, at + 1, {HEADER_LINES + DATA_LINES})")})
    found = _read(near, *way, "all", "closed", "at")
    complete = F.expr("at is not null and name <> '' and claim <> '' and acct <> '' and service_date <> '' and cpt <> ''")
    score = found.groupBy(*way).agg(F.first("all").alias("all"), F.count_if(F.col("backward") & F.col("at").isNotNull()).alias("strict"), (F.count_if(complete) + F.first("closed")).alias("done"))
    of = lambda c, w: F.max(F.when(F.col("way") == w, F.col(c)))
    best = score.groupBy(*key).agg(F.max_by("all", -F.col("way")).alias("straight"), F.max_by("all", "way").alias("reversed"), *[of(c, w).alias(f"{c}{w}") for c in ("strict", "done") for w in (0, 1)])
    turn = F.expr("case when strict0 = 0 and strict1 = 0 then done0 = 0 and done1 > 0 else strict1 > strict0 end")
    lines = best.select(*key, F.posexplode(F.when(turn, F.col("reversed")).otherwise(F.col("straight"))).alias("line", "x"))
    return lines.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line")).alias("idx"), "page", "x.text", "x.words")


def claims(lines: DataFrame) -> DataFrame:
    """Claim records of all documents, merged and by page. lines: doc_id, idx, page, text, words, of all pages in a row, so records may cross pages."""
    # Both kinds come from one pass: lines by runs, runs by documents, then a row for each plan id and for each closed run.
    runs = _tabular(lines, DOC, F.collect_list(F.struct("idx", "page", "text", "words")).alias("own"))
    closed = F.when(F.expr("idx is not null and acct <> '' and service_date <> ''"), F.struct("idx", "page", *_FIELDS))
    docs = runs.groupBy(*DOC).agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("all"), F.collect_list(closed).alias("closed"))
    docs = docs.withColumn("at", F.filter(F.transform("all", lambda x: F.when(x["text"].rlike(PLAN), x["idx"])), lambda i: i.isNotNull()))
    near = f"0 as side, i as idx, get(all, i - 1) as own, reverse(slice(all, greatest(i - {HEADER_LINES}, 1), i - greatest(i - {HEADER_LINES}, 1))) as above, slice(all, i + 1, {HEADER_LINES + DATA_LINES}) as below, get(closed, -1) as run"
    alone = "1 as side, r.idx as idx, get(all, -1) as own, slice(all, 1, 0) as above, slice(all, 1, 0) as below, r as run"
    rows = docs.select(*DOC, F.expr(f"inline(concat(transform(at, i -> struct({near})), transform(closed, r -> struct({alone}))))"))
    found = _read(rows.withColumn("page", F.col("own.page")), *DOC, "side", "idx", "page", "run")
    both = found.select(*DOC, "side", "idx", *[F.when(F.col("side") == 1, F.col(f"run.{c}")).otherwise(F.col(c)).alias(c) for c in ("page", *_FIELDS)])
    return merged(both.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("side", "idx"))))


def claim_rows(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "ord", *[F.col(c).alias(n) for c, n in zip((*_FIELDS, "page"), CLAIM_COLUMNS)])


def patients(pages: DataFrame) -> DataFrame:
    """Patient records of all documents, those without a plan id first. pages: doc_id, page, text.

    Pages are joined by line feeds; a record's page is the one on which it begins.
    """
    whole = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    whole = whole.select("doc_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), F.expr("aggregate(p, struct(array(0) as a, 0 as n), (s, x) -> struct(concat(s.a, array(s.n + length(x.text) + 1)) as a, s.n + length(x.text) + 1 as n), s -> slice(s.a, 1, size(p)))").alias("begins"))
    both = _windowed(whole).unionByName(_listed(whole))
    return _same_patient(both.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("side", "at"))).drop("side"))


def _page(at: str) -> Column:
    return F.expr(f"size(filter(begins, b -> b <= {at}))").alias("page")


_PATIENT = ("format", "name", "plan", "claim", "member", "acct", "service_date", "proc", "cpt")


def _windowed(whole: DataFrame) -> DataFrame:
    """A record for each plan id from the 200 characters before and the 500 after it; those that lack a part go."""
    label = r"Health Plan ID:\s*(\w+)"
    cut = F.split("text", r"(?=Health Plan ID:\s*\w)")
    part = whole.select("doc_id", "text", "begins", F.posexplode(cut).alias("n", "part"))
    # Each part but the first begins with its label; lengths before it give its place.
    d = part.withColumn("at", F.coalesce(F.sum(F.length("part")).over(Window.partitionBy("doc_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")).filter(F.col("part").rlike("^" + label))
    d = d.withColumn("hit", F.regexp_extract("part", "^" + label, 0)).withColumn("plan", F.regexp_extract("part", "^" + label, 1))
    d = d.withColumn("before", F.expr(f"substring(text, greatest(at - {BEFORE}, 0) + 1, least(at, {BEFORE}))")).withColumn("after", F.expr(f"substring(text, at + length(hit) + 1, {AFTER})"))
    line = F.substring_index(F.substring_index(F.regexp_replace("before", r"\n+$", ""), "\n", -1), "Payee:", 1)
    head = r"(?s)Service Date.{0,80}?CPT-?(.*)$"
    d = d.select("doc_id", "at", "begins", "plan", F.trim(F.regexp_extract(line, f"({PATIENT_NAME})", 1)).alias("name"), F.regexp_extract("after", r"Claim:\s*(\w+)", 1).alias("claim"), F.regexp_extract("after", r"Pat\.?\s*Acct\s*#\s*(\w+)", 1).alias("acct"), F.regexp_extract("after", head, 1).alias("rest"))
    d = d.withColumn("service_date", F.regexp_extract("rest", f"({V.DATE})", 1)).withColumn("tail", F.regexp_extract("rest", rf"(?s){V.DATE}(.*)$", 1))
    d = d.withColumn("cpt", F.trim(F.regexp_replace(F.when(F.contains("tail", F.lit("$")), F.substring_index("tail", "$", 1)).otherwise(F.substring("tail", 1, 40)), r"\s+", " ")))
    d = d.filter("name <> '' and claim <> '' and acct <> '' and service_date <> ''")
    return d.select("doc_id", F.lit(0).alias("side"), "at", F.lit("B").alias("format"), "name", "plan", "claim", F.lit("").alias("member"), "acct", "service_date", F.lit("").alias("proc"), "cpt", _page("at"))


def _listed(whole: DataFrame) -> DataFrame:
    """Records that a line with a name opens and member totals close; distinct accounts joined by ':', the latest date."""
    order = Window.partitionBy("doc_id").orderBy("n")
    d = whole.select("doc_id", "begins", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    d = d.withColumn("at", F.coalesce(F.sum(F.length("line") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    d = d.select("doc_id", "begins", "n", "at", "line", F.col("line").rlike(PATIENT_NAME).alias("opens"), F.regexp_extract("line", r"Patient Acct\.?\s*#\s*(\w+)", 1).alias("a"), F.col("line").rlike(r"Member Totals\s*:").alias("totals"), V.last_date_and_code(F.col("line")).alias("last"))
    d = d.withColumn("segment", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("stop", F.min(F.when(F.col("totals") & (F.col("a") == "") & ~F.col("opens"), F.col("n"))).over(Window.partitionBy("doc_id", "segment"))).filter("segment > 0 and n < stop")
    dated = F.when(F.col("opens") | (F.col("a") == ""), F.col("last")["date"])
    # The name line's date counts even if it can't be read; a later line's only if it is later.
    day = F.coalesce(V.date(dated), F.when(F.col("opens"), F.lit("0001-01-01").cast("date")))
    d = d.withColumn("dated", dated).withColumn("day", day)
    own = lambda c: F.min_by(c, "n")
    accounts = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(~F.col("opens") & (F.col("a") != ""), F.struct("n", "a")))), lambda x: x["a"]))
    r = d.groupBy("doc_id", "segment").agg(
        own("begins").alias("begins"), F.min("at").alias("at"), own(F.trim(F.regexp_extract("line", f"({PATIENT_NAME})", 1))).alias("name"), own(F.regexp_extract("line", r"(\d{6,})", 1)).alias("claim"), own(F.regexp_extract("line", r"(\d{9,})", 1)).alias("member"),
        F.array_join(accounts, ":").alias("acct"), F.coalesce(F.max_by("dated", F.when(F.col("dated") != "", F.struct("day", -F.col("n")))), F.lit("")).alias("service_date"), own(F.col("last")["code"]).alias("proc"),
    )
    r = r.filter("(member <> '' or claim <> '') and acct <> '' and service_date <> ''")
    return r.select("doc_id", F.lit(1).alias("side"), "at", F.lit("A").alias("format"), "name", F.lit("").alias("plan"), "claim", "member", "acct", "service_date", F.coalesce("proc", F.lit("")).alias("proc"), F.lit("").alias("cpt"), _page("at"))


def _same_patient(rows: DataFrame) -> DataFrame:
    """Rows of one name and plan id as the first of them, with all accounts and the latest date; rows without a plan id go first."""
    d = rows.withColumn("own", F.when(F.col("plan") == "", F.col("ord")))
    first = lambda c: F.min_by(c, "ord").alias(c)
    day = F.coalesce(V.date(F.col("service_date")), F.lit("0001-01-01").cast("date"))
    out = d.groupBy("doc_id", F.col("name").alias("_n"), F.col("plan").alias("_p"), "own").agg(F.min("ord").alias("ord"), *[first(c) for c in (*_PATIENT, "page") if c not in ("acct", "service_date")], R.ordered_distinct("acct", ["ord"], ":").alias("acct"), F.max_by("service_date", F.struct(day, -F.col("ord"))).alias("service_date"))
    place = Window.partitionBy("doc_id").orderBy((F.col("plan") != "").cast("int"), "ord")
    return out.withColumn("ord", F.row_number().over(place)).select("doc_id", "ord", *_PATIENT, "page")


def patient_rows(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "ord", *[F.col(c).alias(n) for c, n in zip((*_PATIENT, "page"), PATIENT_COLUMNS)])
