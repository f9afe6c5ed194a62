"""Queries over the scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import predicates as P
from ..functions import text as T
from ..functions import values as V
from ..sources.lines import layout_lines
from .registry import query, scalar

DOCS = "SELECT doc_id AS k, text AS s FROM {documents}"
CHATS = "SELECT conv_id * 100 + turn AS k, text AS s FROM {conversations}"
LAST = "CASE c_custkey % 6 WHEN 0 THEN 'Smith' WHEN 1 THEN 'O''Brien' WHEN 2 THEN 'de la Cruz' WHEN 3 THEN 'Smith-Jones' WHEN 4 THEN 'VALENCIA' ELSE 'Strunk' END"
FIRST = "CASE c_custkey % 7 WHEN 0 THEN 'Jonathan' WHEN 1 THEN 'Efrain' WHEN 2 THEN 'Mary Ann' WHEN 3 THEN 'Antione D.' WHEN 4 THEN 'William James Robert' WHEN 5 THEN 'anna' ELSE 'Lee' END"
SUFFIX = "CASE c_custkey % 5 WHEN 0 THEN ' Jr' WHEN 1 THEN ' III' WHEN 2 THEN ' SR.' ELSE '' END"
COMMA_NAMES = f"SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN {LAST} || ' ' || {FIRST} WHEN c_custkey % 13 = 0 THEN 'Acme Holdings Inc, ' || {FIRST} WHEN c_custkey % 17 = 0 THEN {LAST} || {SUFFIX} || ', ' || {FIRST} WHEN c_custkey % 19 = 0 THEN '' ELSE {LAST} || ',  ' || {FIRST} || {SUFFIX} END AS s FROM {{customer}}"
PLAIN_NAMES = f"SELECT c_custkey AS k, CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 23 = 0 THEN ' JR' ELSE '  ' || {FIRST} || ' ' || {LAST} || {SUFFIX} END AS s FROM {{customer}}"
AREA = "lpad(CAST(900 + c_custkey % 99 AS STRING), 3, '0')"
GROUP = "lpad(CAST(1 + c_custkey % 49 AS STRING), 2, '0')"
SERIAL = "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')"
SSNS = f"SELECT c_custkey AS k, CASE c_custkey % 14 WHEN 0 THEN {AREA} || '-' || {GROUP} || '-' || {SERIAL} WHEN 1 THEN {AREA} || ' ' || {GROUP} || ' ' || {SERIAL} WHEN 2 THEN {AREA} || {GROUP} || {SERIAL} WHEN 3 THEN {AREA} || '-' || {GROUP} WHEN 4 THEN {AREA} || '-' || {GROUP} || '-' || substr({SERIAL}, 1, 2) WHEN 5 THEN 'XXX-XX-' || {SERIAL} WHEN 6 THEN {AREA} || '-xx-' || {SERIAL} WHEN 7 THEN '***-' || {GROUP} || '-' || {SERIAL} WHEN 8 THEN '' WHEN 9 THEN substr({SERIAL}, 1, 3) WHEN 10 THEN {SERIAL} WHEN 11 THEN {GROUP} || {AREA} WHEN 12 THEN 'no number' ELSE {AREA} || '-' || {GROUP} || '-' || {SERIAL} || ' seen' END AS s FROM {{customer}}"
NOISY_SSNS = f"SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'No ' || {AREA} || '-' || {GROUP} || '-' || {SERIAL} WHEN 1 THEN 'No ' || translate({AREA} || '-' || {GROUP} || '-' || {SERIAL}, '015', 'OIS') WHEN 2 THEN 'none' ELSE {AREA} || {GROUP} || {SERIAL} END AS s FROM {{customer}}"
MONEYS = "SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 'Wages $' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) WHEN 2 THEN 'n/a' WHEN 3 THEN '(1,234.' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || ')' WHEN 4 THEN '-$ ' || CAST(o_orderkey % 1000 AS STRING) || ',111.5' ELSE '54321.00' END AS s FROM {orders}"
DATES = "SELECT l_orderkey * 10 + l_linenumber AS k, CASE l_orderkey % 5 WHEN 0 THEN CAST(1 + l_partkey % 12 AS STRING) || '/' || CAST(1 + l_suppkey % 28 AS STRING) || '/' || CAST(1950 + l_partkey % 100 AS STRING) WHEN 1 THEN lpad(CAST(1 + l_partkey % 12 AS STRING), 2, '0') || '/' || lpad(CAST(1 + l_suppkey % 28 AS STRING), 2, '0') || '/' || lpad(CAST(l_partkey % 100 AS STRING), 2, '0') WHEN 2 THEN '2/30/2020' WHEN 3 THEN 'soon' ELSE '12/31/68' END AS s FROM {lineitem}"
ADDRESSES = "SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'NATION ' || CAST(c_nationkey AS STRING) || ', WI ' || lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') WHEN 1 THEN 'San Jose CA ' || lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') || '-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') || ' United States' WHEN 2 THEN '801 W. Commerce St, Cambria, WI 53923' WHEN 3 THEN '519 Tradition Pkwy ' || CAST(c_custkey AS STRING) || ', Pleasanton CA 94566-4477' WHEN 4 THEN 'or foreign postal code Canada 12345' ELSE '' END AS s FROM {customer}"
HEADERS = f"SELECT c_custkey AS k, 'X' || CAST(c_custkey % 10 AS STRING) || 'T  ' || {LAST} || ', ' || {FIRST} || '  Associate ID: A' || CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 3 = 0 THEN '  Position ID: P' || CAST(c_nationkey AS STRING) ELSE '' END || '  Home Department: B04-LM  Bellingham Warehouse  Home Cost Number: ' || CAST(c_custkey % 99 AS STRING) AS s FROM {{customer}}"
SUFFIXES_DUCK = "['JR', 'SR', 'II', 'III', 'IV', 'V']"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def by_line(name: str, out: dict, oracle: dict[str, str]) -> None:
    """Registers functions of s, every line of the whole texts, beside the document k and line_no."""

    def run(df):
        lines = layout_lines(df).withColumnsRenamed({"doc_id": "k", "text": "s"})
        return lines.select("k", "line_no", *[f(F.col("s")).alias(c) for c, f in out.items()])

    cols = ", ".join(f"{e} AS {c}" for c, e in oracle.items())
    lines = "SELECT doc_id AS k, CAST(i AS BIGINT) AS line_no, rtrim(l[i]) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM t)"
    query(name, "SELECT doc_id, text FROM {documents}", f"SELECT k, line_no, {cols} FROM ({lines})")(run)


_CLEAN = r"trim(regexp_replace(s, '\s+', ' ', 'g'))"
_STRIP = r"regexp_replace(s, '^\s+|\s+$', '', 'g')"
_TOKENS = rf"list_filter(string_split({_CLEAN}, ' '), w -> w <> '')"
_JOIN = lambda x: f"coalesce(array_to_string({x}, ' '), '')"

scalar("fn_str_01", DOCS, {"v": T.clean, "n": lambda s: F.lower(T.clean(s))}, {"v": _CLEAN, "n": f"lower({_CLEAN})"})
scalar("fn_str_03", NOISY_SSNS, {"v": T.fix_digits}, {"v": f"translate(s, '{T.LOOKALIKE_FROM}', '{T.LOOKALIKE_TO}')"})
scalar("fn_str_04", DOCS, {"v": T.mask}, {"v": "regexp_replace(regexp_replace(s, '[0-9]', '#', 'g'), '[A-Za-z]', 'X', 'g')"})
_MASK = lambda w: rf"regexp_replace(regexp_replace({w}, '\p{{Nd}}', '#', 'g'), '\p{{L}}', 'X', 'g')"
scalar("fn_str_05", CHATS, {"v": T.redact_words, "w": T.redact_value}, {"v": rf"array_to_string(list_transform(string_split(s, ' '), w -> CASE WHEN list_contains({_list(T.SAFE_WORDS)}, lower(trim(w, ':#.,()/-''’'))) THEN w ELSE {_MASK('w')} END), ' ')", "w": _MASK("s")})
scalar("fn_str_06", HEADERS, {"v": T.column_key}, {"v": r"trim(lower(regexp_replace(s, '[\s–—-]+', ' ', 'g')))"})
scalar("fn_str_08", COMMA_NAMES, {"v": T.title}, {"v": r"coalesce(array_to_string(list_transform(regexp_extract_all(lower(s), '\p{L}+|\P{L}+'), w -> upper(w[1]) || w[2:]), ''), '')"})
scalar("fn_str_10", DOCS, {"v": lambda s: F.array_join(T.vocabulary(s), " ")}, {"v": _JOIN(rf"list_sort(list_distinct(list_filter(list_transform(string_split_regex(lower(s), '\s+'), w -> regexp_replace(w, '\P{{L}}', '', 'g')), w -> length(w) >= 4 AND NOT list_contains({_list(T.STOP_WORDS)}, w))))")})
query("fn_str_02", DOCS)(lambda df: df.select("k", T.fold(F.col("s")).alias("v")))
query("fn_str_07", "SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord, l_returnflag || CAST(l_partkey AS STRING) AS w FROM {lineitem}", "SELECT k, string_agg(w, ' ' ORDER BY ord) AS v FROM t GROUP BY k")(
    lambda df: df.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "w"))), lambda x: x["w"]), " ").alias("v"))
)

# Names. x: the words; h: the words without a suffix.
def _names(name, source, fn, cols, tokens, has_suffix):
    from .registry import QUERIES, Query

    parts = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    oracle = f"SELECT k, {parts} FROM (SELECT *, CASE WHEN sx THEN x[:-2] ELSE x END AS h FROM (SELECT *, coalesce({has_suffix}, false) AS sx FROM (SELECT *, {tokens} AS x FROM t)))"
    QUERIES[name] = Query(name, source, lambda df: df.select("k", fn(F.col("s")).alias("o")).select("k", *[F.col(f"o.{c}").alias(c) for c in cols]), oracle)


_BARE = "upper(trim(x[-1], '.'))"
_SUF = "CASE WHEN sx THEN x[-1] ELSE '' END"
_names("fn_name_01", PLAIN_NAMES, N.by_whitespace, {"first": f"CASE WHEN len(h) = 1 THEN h[1] WHEN len(h) > 1 THEN {_JOIN('h[:-2]')} ELSE '' END", "last": "CASE WHEN len(h) > 1 THEN h[-1] ELSE '' END", "suffix": _SUF}, _TOKENS, f"list_contains({SUFFIXES_DUCK}, {_BARE})")
_names("fn_name_02", PLAIN_NAMES, N.first_middle_last, {"first": "coalesce(h[1], '')", "middle": f"CASE WHEN len(h) > 2 THEN {_JOIN('h[2:-2]')} ELSE '' END", "last": "CASE WHEN len(h) > 1 THEN h[-1] ELSE '' END", "suffix": _SUF}, _TOKENS, f"list_contains({_list(N.BLOCK_SUFFIXES)}, upper(x[-1]))")


def _comma(name, fn, suffixes, companies):
    from .registry import QUERIES, Query

    words = lambda e: f"list_filter(string_split({e}, ' '), w -> w <> '')"
    ent = f"coalesce(list_contains({_list(N.ENTITY_TOKENS)}, lower(trim(l[-1], '.,'))), false)" if companies else "false"
    whole = "c" if companies else "''"
    oracle = f"""
    SELECT k, CASE WHEN NOT comma THEN {whole} WHEN ent THEN rtrim(c, ',') ELSE {_JOIN('CASE WHEN sl THEN l[:-2] ELSE l END')} END AS last,
      CASE WHEN comma AND NOT ent THEN coalesce((CASE WHEN sr THEN r[:-2] ELSE r END)[1], '') ELSE '' END AS first,
      CASE WHEN comma AND NOT ent THEN {_JOIN('(CASE WHEN sr THEN r[:-2] ELSE r END)[2:]')} ELSE '' END AS middle,
      CASE WHEN NOT comma OR ent THEN '' WHEN sr THEN r[-1] WHEN sl THEN l[-1] ELSE '' END AS suffix
    FROM (SELECT *, NOT sr AND coalesce(list_contains({_list(suffixes)}, lower(trim(l[-1], '.'))), false) AS sl, {ent} AS ent
      FROM (SELECT *, coalesce(list_contains({_list(suffixes)}, lower(trim(r[-1], '.'))), false) AS sr
        FROM (SELECT k, c, contains(c, ',') AS comma, {words("split_part(c, ',', 1)")} AS l, {words("CASE WHEN contains(c, ',') THEN substr(c, strpos(c, ',') + 1) ELSE '' END")} AS r FROM (SELECT k, {_CLEAN} AS c FROM t))))"""
    QUERIES[name] = Query(name, COMMA_NAMES, lambda df: df.select("k", fn(F.col("s")).alias("o")).select("k", "o.last", "o.first", "o.middle", "o.suffix"), oracle)


_comma("fn_name_03", N.last_first, N.CREDITOR_SUFFIXES, True)
_comma("fn_name_04", lambda s: N.last_first(s, N.CHANGE_SUFFIXES, False), N.CHANGE_SUFFIXES, False)
_TITLE = lambda e: rf"coalesce(array_to_string(list_transform(regexp_extract_all(lower({e}), '\p{{L}}+|\P{{L}}+'), w -> upper(w[1]) || w[2:]), ''), '')"
query("fn_name_05", COMMA_NAMES, f"""
    SELECT k, {_TITLE("CASE WHEN comma THEN coalesce(h[1], '') ELSE '' END")} AS first, {_TITLE(f"CASE WHEN comma THEN {_JOIN('h[2:]')} ELSE '' END")} AS middle,
      {_TITLE("CASE WHEN comma THEN trim(split_part(c, ',', 1)) ELSE c END")} AS last, {_TITLE("CASE WHEN comma AND sx THEN r[-1] ELSE '' END")} AS suffix
    FROM (SELECT *, CASE WHEN sx THEN r[:-2] ELSE r END AS h FROM (SELECT *, coalesce(list_contains({_list(N.PLAN_SUFFIXES)}, rtrim(lower(r[-1]), '.')), false) AS sx
      FROM (SELECT k, c, contains(c, ',') AS comma, list_filter(string_split(CASE WHEN contains(c, ',') THEN substr(c, strpos(c, ',') + 1) ELSE '' END, ' '), w -> w <> '') AS r FROM (SELECT k, {_CLEAN} AS c FROM t))))""")(
    lambda df: df.select("k", N.plan_name(F.col("s")).alias("o")).select("k", "o.first", "o.middle", "o.last", "o.suffix")
)
query("fn_name_06", COMMA_NAMES, rf"""
    SELECT k, regexp_replace(split_part(c, ',', 1), '^\s+|\s+$', '', 'g') AS last, coalesce(r[1], '') AS first, {_JOIN('r[2:]')} AS middle
    FROM (SELECT k, c, list_filter(string_split_regex(CASE WHEN contains(c, ',') THEN substr(c, strpos(c, ',') + 1) ELSE '' END, '\s+'), w -> w <> '') AS r FROM (SELECT k, {_STRIP} AS c FROM t))""")(
    lambda df: df.select("k", N.last_first_plain(F.col("s")).alias("o")).select("k", "o.last", "o.first", "o.middle")
)
_names("fn_name_07", PLAIN_NAMES, N.covered_name, {"first": "coalesce(h[1], '')", "middle": f"CASE WHEN len(h) > 2 THEN {_JOIN('h[2:-2]')} ELSE '' END", "last": "CASE WHEN len(h) > 1 THEN h[-1] ELSE '' END", "unusual": "len(h) > 3"}, _TOKENS, "false")
TEXT_NAMES = f"SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 4 THEN 'total net Amount JANE ROE' WHEN 5 THEN 'PARTICIPANT NAME JANE ROE' WHEN 6 THEN 'Plan company ltd' WHEN 0 THEN 'paid to Smith, Jonathan today' WHEN 1 THEN 'EMPLOYEE NAME: JANE ROE 123' WHEN 2 THEN 'sent by John Q. Public on time' ELSE '$1,200.00' END AS s FROM {{customer}}"
query("fn_name_08", TEXT_NAMES, "SELECT k, CASE k % 7 WHEN 0 THEN 'Smith, Jonathan Today' WHEN 1 THEN 'Jane Roe' WHEN 2 THEN 'John Q. Public' WHEN 4 THEN 'Jane Roe' WHEN 5 THEN 'Name Jane Roe' ELSE '' END AS v FROM t")(lambda df: df.select("k", N.find_name(F.col("s")).alias("v")))
query("fn_name_09", HEADERS, f"""
    SELECT k, CASE k % 6 WHEN 0 THEN 'Smith' WHEN 1 THEN 'O''Brien' WHEN 2 THEN 'de la Cruz' WHEN 3 THEN 'Smith-Jones' WHEN 4 THEN '' ELSE 'Strunk' END AS last,
      CASE WHEN k % 6 = 4 THEN '' ELSE CASE k % 7 WHEN 0 THEN 'Jonathan' WHEN 1 THEN 'Efrain' WHEN 2 THEN 'Mary' WHEN 3 THEN 'Antione' WHEN 4 THEN 'William' WHEN 5 THEN 'anna' ELSE 'Lee' END END AS first,
      CASE WHEN k % 6 = 4 THEN '' ELSE CASE k % 7 WHEN 2 THEN 'Ann' WHEN 3 THEN 'D.' WHEN 4 THEN 'James Robert' ELSE '' END END AS middle,
      'A' || k AS associate, regexp_extract(s, 'Position ID: (\\S+)', 1) AS position, 'B04-LM Bellingham Warehouse' AS department, CAST(k % 99 AS VARCHAR) AS cost FROM t""".replace("\\\\S", "\\S"))(
    lambda df: df.select("k", N.header_fields(F.col("s")).alias("o")).select("k", "o.last", "o.first", "o.middle", "o.associate", "o.position", "o.department", "o.cost")
)
query("fn_name_10", f"SELECT c_custkey AS k, {FIRST} AS a, substr({FIRST}, 1, CAST(c_custkey % 9 AS INT)) AS b FROM {{customer}}", "SELECT k, a <> '' AND b <> '' AND (starts_with(lower(trim(a)), lower(trim(b))) OR starts_with(lower(trim(b)), lower(trim(a)))) AS v FROM t")(
    lambda df: df.select("k", N.prefix_match(F.col("a"), F.col("b")).alias("v"))
)

# Identifiers, money, dates, addresses.
_SSN = lambda e: rf"CASE WHEN regexp_matches({e}, '\b\d{{3}}[-\s]?\d{{2}}[-\s]?\d{{4}}\b') THEN regexp_extract({e}, '\b(\d{{3}})[-\s]?(\d{{2}})[-\s]?(\d{{4}})\b', 1) || '-' || regexp_extract({e}, '\b(\d{{3}})[-\s]?(\d{{2}})[-\s]?(\d{{4}})\b', 2) || '-' || regexp_extract({e}, '\b(\d{{3}})[-\s]?(\d{{2}})[-\s]?(\d{{4}})\b', 3) ELSE '' END"
scalar("fn_id_01", SSNS, {"v": V.ssn}, {"v": _SSN("s")})
scalar("fn_id_02", NOISY_SSNS, {"v": V.ssn_repaired}, {"v": f"CASE WHEN ({_SSN('s')}) <> '' THEN ({_SSN('s')}) ELSE ({_SSN(f'''translate(s, '{T.LOOKALIKE_FROM}', '{T.LOOKALIKE_TO}')''')}) END"})
_D = r"regexp_replace(s, '\D', '', 'g')"
_CANON = rf"""CASE WHEN s = '' THEN '' WHEN regexp_matches(s, '(?i)^[\dX]{{3}}-[\dX]{{2}}-[\dX]{{4}}$') THEN upper(s)
    WHEN regexp_matches(s, '^\d{{3}}-\d{{2}}-\d{{1,3}}$') THEN rpad(s, 11, 'X') WHEN regexp_matches(s, '^\d{{3}}-\d{{2}}$') THEN s || '-XXXX'
    WHEN regexp_matches(s, '^\d{{3}}-[xX*]+-\d{{4}}$') THEN s[:3] || '-XX-' || s[-4:] WHEN regexp_matches(s, '^[xX*]+-\d{{2}}-\d{{4}}$') THEN 'XXX-' || s[-7:]
    WHEN regexp_matches(s, '^[xX*]+-[xX*]+-\d{{4}}$') THEN 'XXX-XX-' || s[-4:]
    WHEN length({_D}) >= 9 THEN {_D}[:3] || '-' || {_D}[4:5] || '-' || {_D}[6:9] WHEN length({_D}) BETWEEN 6 AND 8 THEN {_D}[:3] || '-' || {_D}[4:5] || '-' || rpad({_D}[6:], 4, 'X')
    WHEN length({_D}) = 5 THEN {_D}[:3] || '-' || {_D}[4:5] || '-XXXX' WHEN length({_D}) = 4 THEN {_D}[:3] || '-' || {_D}[4:4] || 'X-XXXX' WHEN length({_D}) = 3 THEN {_D} || '-XX-XXXX' ELSE s END"""
scalar("fn_id_03", SSNS, {"v": V.ssn_canonical}, {"v": _CANON})
_A, _G, _S = "lpad(CAST(900 + k % 99 AS VARCHAR), 3, '0')", "lpad(CAST(1 + k % 49 AS VARCHAR), 2, '0')", "lpad(CAST(k % 10000 AS VARCHAR), 4, '0')"
scalar("fn_id_04", SSNS, {"v": V.ssn_in_cell}, {"v": f"CASE k % 14 WHEN 0 THEN {_A} || '-' || {_G} || '-' || {_S} WHEN 3 THEN {_A} || '-' || {_G} || '-XXXX' WHEN 4 THEN {_A} || '-' || {_G} || '-' || {_S}[:2] || 'XX' WHEN 5 THEN 'XXX-XX-' || {_S} WHEN 6 THEN {_A} || '-XX-' || {_S} WHEN 13 THEN {_A} || '-' || {_G} || '-' || {_S} ELSE '' END"})
scalar("fn_id_05", SSNS, {"v": V.ssn_pay}, {"v": rf"CASE WHEN regexp_extract(s, '({V.SSN_PAY})', 1) <> '' THEN regexp_extract(s, '({V.SSN_PAY})', 1) WHEN length({_D}) = 9 THEN {_D}[:3] || '-' || {_D}[4:5] || '-' || {_D}[6:9] ELSE {_D} END"})
scalar("fn_id_06", MONEYS, {"e": lambda s: F.regexp_extract(s, f"({V.EIN})", 1), "t": lambda s: F.regexp_extract(s, f"({V.TIN})", 1), "i": lambda s: F.regexp_extract(s, r"([A-Za-z0-9\-]+)", 1)}, {"e": f"regexp_extract(s, '({V.EIN})', 1)", "t": f"regexp_extract(s, '({V.TIN})', 1)", "i": r"regexp_extract(s, '([A-Za-z0-9\-]+)', 1)"})
scalar("fn_id_07", SSNS, {"v": lambda s: F.regexp_extract(s, f"({V.SSN_RUN})", 1)}, {"v": f"regexp_extract(s, '({V.SSN_RUN})', 1)"})
PLANS = "SELECT o_orderkey AS k, 'Health Plan ID: ' || CASE WHEN o_orderkey % 3 = 0 THEN 'none ' ELSE '' END || 'H' || CAST(o_custkey AS STRING) || ' Claim: C' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 4 = 0 THEN ' A12' WHEN o_orderkey % 4 = 1 THEN ' Status' ELSE '' END AS s, o_custkey FROM {orders}"
scalar("fn_id_08", PLANS, {"v": V.plan_id}, {"v": "'H' || o_custkey"})
scalar("fn_id_09", PLANS, {"v": V.claim_number}, {"v": "'C' || k || CASE WHEN k % 4 = 0 THEN 'A12' ELSE '' END"})
scalar("fn_mon_01", MONEYS, {"v": V.amount}, {"v": rf"coalesce(CAST(TRY_CAST(nullif(replace(regexp_extract(s, '{V.AMOUNT}', 1), ',', ''), '') AS DECIMAL(38,2)) AS VARCHAR), '')"})
scalar("fn_mon_02", MONEYS, {"v": V.plan_amount}, {"v": f"replace(regexp_extract(s, '{V.AMOUNT}', 1), ',', '')"})
scalar("fn_mon_03", MONEYS, {"v": V.money}, {"v": rf"regexp_replace(regexp_extract(s, '({V.MONEY})', 1), '^\s+|\s+$', '', 'g')"})
_DATE = lambda e: f"CAST(CASE WHEN regexp_matches({e}, '/\\d{{4}}$') THEN try_strptime({e}, '%m/%d/%Y') ELSE try_strptime({e}, '%m/%d/%y') END AS DATE)"
scalar("fn_date_01", DATES, {"v": V.date, "u": lambda s: V.us_date(V.date(s))}, {"v": _DATE("s"), "u": f"coalesce(strftime({_DATE('s')}, '%m/%d/%Y'), '')"})
PDF_DATES = "SELECT l_orderkey * 10 + l_linenumber AS k, CASE l_orderkey % 4 WHEN 0 THEN 'D:2024' || lpad(CAST(1 + l_partkey % 12 AS STRING), 2, '0') || '15143000-05''00''' WHEN 1 THEN 'D:20240315' WHEN 2 THEN '2024031514Z' ELSE 'yesterday' END AS s FROM {lineitem}"
query("fn_date_02", PDF_DATES, "SELECT k, CASE (k // 10) % 4 WHEN 0 THEN '2024-' || s[7:8] || '-15 14:30:00 -05:00' WHEN 1 THEN '2024-03-15' WHEN 2 THEN '2024-03-15 14' ELSE 'yesterday' END AS v FROM t")(lambda df: df.select("k", V.pdf_date(F.col("s")).alias("v")))
SEEN_DATES = "SELECT l_orderkey * 10 + l_linenumber AS k, '2024.' || lpad(CAST(1 + l_partkey % 12 AS STRING), 2, '0') || '.09  08:36:48 -06''00''' AS s FROM {lineitem}"
query("fn_date_03", SEEN_DATES, "SELECT k, '2024-' || s[6:7] || '-09 08:36:48 -06:00' AS v FROM t")(lambda df: df.select("k", V.visible_date(F.col("s")).alias("v")))
DATED = "SELECT l_orderkey * 10 + l_linenumber AS k, l_partkey, 'on 1/2/2020 and ' || CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE CAST(1 + l_partkey % 12 AS STRING) || '/5/2021 code ' END || CASE WHEN l_orderkey % 4 = 0 THEN 'x' ELSE 'A' || CAST(100 + l_partkey % 9000 AS STRING) END AS s FROM {lineitem}"
query("fn_date_04", DATED, r"SELECT k, CASE WHEN (k // 10) % 3 = 0 THEN '1/2/2020' ELSE (1 + l_partkey % 12) || '/5/2021' END AS date, CASE WHEN (k // 10) % 4 = 0 THEN '' ELSE 'A' || (100 + l_partkey % 9000) END AS code FROM t")(
    lambda df: df.select("k", V.last_date_and_code(F.col("s")).alias("o")).select("k", "o.date", "o.code")
)
_CSZ = lambda n: f"regexp_extract(s, '{V.CITY_STATE_ZIP}', {n})"
scalar("fn_addr_01", ADDRESSES, V.city_state_zip, {"city": f"rtrim({_CSZ(1)}, ',')", "state": _CSZ(2), "zip": _CSZ(3)})
_CSZC = lambda n: f"regexp_extract(s, '{V.CITY_STATE_ZIP_COUNTRY}', {n})"
scalar("fn_addr_02", ADDRESSES, V.city_state_zip_country, {"city": f"rtrim({_CSZC(1)}, ',')", "state": _CSZC(2), "zip": _CSZC(3), "country": f"trim({_CSZC(4)})"})
CREDITORS = "SELECT s_suppkey AS k, s_nationkey, concat(s_name, '|', CAST(s_suppkey AS STRING), ' Main St|Suite  ', CAST(s_nationkey AS STRING), CASE s_suppkey % 4 WHEN 0 THEN '|Toronto, ON M5V 2T6|Canada' WHEN 1 THEN '|Reno, NV 89501-1234' WHEN 2 THEN '|Nowhere' ELSE '|United Kingdom' END) AS s FROM {supplier}"
query("fn_addr_03", CREDITORS, """
    SELECT k, 'Supplier' AS kind, k || ' Main St, Suite ' || s_nationkey || CASE WHEN k % 4 = 2 THEN ', Nowhere' ELSE '' END AS street, CASE k % 4 WHEN 0 THEN 'Toronto' WHEN 1 THEN 'Reno' ELSE '' END AS city,
    CASE k % 4 WHEN 0 THEN 'ON' WHEN 1 THEN 'NV' ELSE '' END AS state, CASE k % 4 WHEN 0 THEN 'M5V2T6' WHEN 1 THEN '89501-1234' ELSE '' END AS zip FROM t""")(
    lambda df: df.select("k", F.lit("Supplier").alias("kind"), V.creditor_address(F.slice(F.split("s", r"\|"), 2, 9)).alias("o")).select("k", "kind", "o.street", "o.city", "o.state", "o.zip")
)
query("fn_addr_04", ADDRESSES, r"""
    SELECT k, CASE WHEN len(p) = 0 THEN '' WHEN a THEN array_to_string(p[:-3], ', ') WHEN b THEN array_to_string(p[:-2], ', ') ELSE s END AS street, CASE WHEN a THEN coalesce(p[-2], '') WHEN b THEN trim(regexp_extract(l, '^(.+?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$', 1)) ELSE '' END AS city,
      CASE WHEN a THEN l[:2] WHEN b THEN regexp_extract(l, '^(.+?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$', 2) ELSE '' END AS state, CASE WHEN a OR b THEN regexp_extract(l, '(\d{5}(?:-\d{4})?)\s*$', 1) ELSE '' END AS zip
    FROM (SELECT *, coalesce(regexp_matches(l, '^[A-Z]{2}\s+\d{5}(-\d{4})?\s*$'), false) AS a, coalesce(regexp_matches(l, '^.+?,?\s+[A-Z]{2}\s+\d{5}(-\d{4})?\s*$'), false) AS b FROM (SELECT *, coalesce(p[-1], '') AS l FROM (SELECT k, s, list_filter(list_transform(string_split(s, ','), w -> trim(w)), w -> w <> '') AS p FROM t)))""")(
    lambda df: df.select("k", V.comma_address(F.col("s")).alias("o")).select("k", "o.street", "o.city", "o.state", "o.zip")
)
_LEFT = r"trim(regexp_replace(s, '(?i)^(?:\b(?:or|foreign|postal|code)\b\s*)+', ''))"
scalar("fn_addr_05", ADDRESSES, V.zip_country, {"zip": rf"regexp_extract({_LEFT}, '(\d{{5}}(?:-\d{{4}})?)', 1)", "country": rf"CASE WHEN regexp_matches({_LEFT}, '\d{{5}}') THEN trim(regexp_extract({_LEFT}, '^(.*?)\d{{5}}', 1)) ELSE {_LEFT} END"})
BOXES = "SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS box, CASE o_orderkey % 7 WHEN 0 THEN '/Off' WHEN 1 THEN '/Yes' WHEN 2 THEN 'no' WHEN 3 THEN '  /Some   value ' WHEN 4 THEN '' WHEN 5 THEN 'FALSE' ELSE o_orderpriority END AS s FROM {orders}"
query("fn_chk_01", BOXES, rf"SELECT k, CASE WHEN box THEN CASE WHEN lower(trim(s)) IN ('', 'off', '/off', 'no', '/no', 'false', '/false') THEN 'No' ELSE 'Yes' END ELSE trim(regexp_replace(regexp_replace(trim(s), '^/', ''), '\s+', ' ', 'g')) END AS v FROM t")(
    lambda df: df.select("k", V.box_value(F.col("s"), F.col("box")).alias("v"))
)
query("fn_math_01", "SELECT l_orderkey AS k, CAST(l_quantity AS INT) AS q FROM {lineitem}", "SELECT k, list_sort(list(q))[len(list(q)) // 2 + 1] AS v, greatest(0, least(11, CAST(sum(q) // 10 AS BIGINT))) AS clamp FROM t GROUP BY k")(
    lambda df: df.groupBy("k").agg(F.expr("element_at(array_sort(collect_list(q)), cast(count(q) div 2 as int) + 1)").alias("v"), F.expr("greatest(0, least(11, sum(q) div 10))").alias("clamp"))
)
query("fn_math_02", "SELECT o_custkey AS k, count(*) AS total FROM {orders} GROUP BY o_custkey", "SELECT k, i AS chunk, i * size AS first, least(i * size + size, total) AS last FROM (SELECT k, total, (total + least(4, total) - 1) // least(4, total) AS size, unnest(range(0, 4)) AS i FROM t) WHERE i * size < total")(
    lambda df: df.withColumn("size", F.expr("(total + least(4, total) - 1) div least(4, total)")).select("k", "total", "size", F.explode(F.expr("sequence(0L, 3L)")).alias("chunk")).filter("chunk * size < total").select("k", "chunk", F.expr("chunk * size").alias("first"), F.expr("least(chunk * size + size, total)").alias("last"))
)

# Predicates.
scalar("flt_01", CHATS, {"v": P.usable_page}, {"v": rf"length({_STRIP}) >= 20"})
scalar("flt_02", CHATS, {"v": lambda s: F.length(T.strip(s)) > 0}, {"v": f"length({_STRIP}) > 0"})
scalar("flt_04", DOCS, {"v": P.garbled}, {"v": r"""regexp_replace(s, '^\s+|\s+$', '', 'g') <> '' AND (length(regexp_replace(s, '[^\x{E000}-\x{F8FF}\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) > 0.3 * length(s)
    OR len(list_filter(string_split(s, chr(10)), l -> len(list_filter(string_split_regex(l, '\s+'), w -> regexp_full_match(w, '\p{L}+'))) >= 6 AND len(list_filter(string_split_regex(l, '\s+'), w -> regexp_full_match(w, '\p{L}') AND lower(w) NOT IN ('a', 'i'))) > 0.4 * len(list_filter(string_split_regex(l, '\s+'), w -> regexp_full_match(w, '\p{L}+'))))) > 0)"""})
_N = lambda p, e="s": rf"length(regexp_replace({e}, '[^{p}]', '', 'g'))"
by_line("flt_05", {"v": P.letterish}, {"v": rf"{_N(chr(92) + 'p{L}')} >= 3 AND {_N(chr(92) + 'p{L}')} > {_N(chr(92) + 'p{Nd}')}"})
scalar("flt_06", PLANS, {"v": P.claims_readable}, {"v": r"regexp_matches(s, 'Health\s*Plan\s*ID\s*:|Pat\.?\s*Acct\s*#|Patient\s+Acct\.?\s*#|Member Totals\s*[:;]')"})
CHROME = "SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'Page ' || CAST(o_orderkey AS STRING) || ' of 9' WHEN 1 THEN ' Payroll Changes' WHEN 2 THEN 'Changed Field Changed From Changed To' WHEN 3 THEN 'Smith, Jo  Associate ID: 4' ELSE 'Smith, Jo' || CAST(o_custkey AS STRING) END AS s FROM {orders}"
scalar("flt_08", CHROME, {"v": P.page_chrome}, {"v": r"regexp_matches(lower(s), '^page\s+\d+\s+of\s+\d+') OR trim(lower(s)) IN ('employee payroll changes', 'payroll changes')"})
scalar("flt_09", CHROME, {"v": P.line_kind}, {"v": "CASE k % 5 WHEN 0 THEN 'chrome' WHEN 1 THEN 'chrome' WHEN 2 THEN 'table' WHEN 3 THEN 'employee' ELSE 'name' END"})
query("flt_10", f"SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'E-' || CAST(c_custkey AS STRING) WHEN c_custkey % 3 = 1 THEN '' ELSE 'Total for all' END AS e, CASE WHEN c_custkey % 2 = 0 THEN {AREA} || '-' || {GROUP} || '-' || {SERIAL} ELSE 'xxx-xx' END AS s FROM {{customer}}", r"SELECT k, e, s FROM t WHERE regexp_matches(e, '^[A-Za-z0-9-]{2,15}$') OR regexp_matches(s, '\d{3}-\d{2}-\d{4}')")(
    lambda df: df.filter(P.pay_row(F.col("e"), F.col("s")))
)
scalar("flt_11", "SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'Inc.' WHEN 1 THEN '' WHEN 2 THEN ' LLC' ELSE 'Ann' END AS s FROM {supplier}", {"v": N.is_person}, {"v": "lower(trim(s)) NOT IN ('', 'inc', 'inc.', 'llc', 'llc.')"})
query("flt_12", f"SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN {FIRST} ELSE '' END AS f, CASE WHEN c_custkey % 3 = 0 THEN {LAST} ELSE '' END AS l, CASE WHEN c_custkey % 5 = 0 THEN {SERIAL} ELSE '' END AS s FROM {{customer}}", "SELECT k FROM t WHERE f <> '' OR l <> '' OR s <> ''")(lambda df: df.filter("f <> '' or l <> '' or s <> ''").select("k"))
by_line("flt_14", {"v": P.looks_like_label, "u": P.mostly_upper}, {"v": rf"""len(list_filter(string_split_regex(rtrim({_STRIP}, ':'), '\s+'), w -> w <> '')) <= 8 AND (({_STRIP}) LIKE '%:' OR (length(regexp_replace(s, '\P{{L}}', '', 'g')) >= 3 AND length(regexp_replace(s, '[^\p{{Lu}}]', '', 'g')) >= 0.75 * length(regexp_replace(s, '\P{{L}}', '', 'g')) AND len(list_filter(string_split_regex(rtrim({_STRIP}, ':'), '\s+'), w -> w <> '')) <= 5))""", "u": r"length(regexp_replace(s, '\P{L}', '', 'g')) >= 3 AND length(regexp_replace(s, '[^\p{Lu}]', '', 'g')) >= 0.75 * length(regexp_replace(s, '\P{L}', '', 'g'))"})
scalar("flt_16", TEXT_NAMES, {"v": P.form_label}, {"v": r"""list_has_any(string_split_regex(upper(s), '\s+'), ['EARNINGS', 'SUMMARY', 'WAGES', 'TIPS', 'COMPENSATION', 'FEDERAL', 'STATE', 'LOCAL', 'INCOME', 'TAX', 'WITHHELD', 'SECURITY', 'MEDICARE',
    'DEPENDENT', 'CARE', 'BENEFITS', 'NONQUALIFIED', 'PLANS', 'ALLOCATED', 'ADVANCE', 'EIC', 'PAYMENT', 'SALARY', 'BONUS', 'TOTAL', 'EMPLOYEE', 'EMPLOYER', 'GROSS', 'NET', 'PAY', 'PERIOD', 'YTD', 'YEAR', 'DATE', 'AMOUNT', 'COPY', 'VOID',
    'CORRECTED', 'DEPARTMENT', 'TREASURY', 'REVENUE', 'SERVICE', 'INTERNAL', 'STATEMENT', 'FORM', 'WAGE', 'AND'])"""})
scalar("flt_17", PLAIN_NAMES, {"v": lambda s: (F.size(T.tokens(s)) >= 2) & ~s.rlike(r"\d")}, {"v": rf"len({_TOKENS}) >= 2 AND NOT regexp_matches(s, '\d')"})
SURNAMES = "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'Medi-Cal VILLA, Daniel' WHEN 1 THEN 'VILLA, Daniel' WHEN 2 THEN 'Medicare Commercial ROE, Jane' ELSE 'no name' END AS s FROM {orders}"
#: A surname may begin neither with a filler word nor inside one.
_SURNAME = r"((?!(?i:(?<![A-Za-z'\-])(?:medi-cal|medicare|commercial|medi-medi|pat)(?![A-Za-z'\-])))(?<![A-Za-z'\-])[A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-]+)*),[^A-Za-z]*([A-Za-z][A-Za-z'\-\. ]*)"
query("flt_18", SURNAMES, "SELECT k, CASE k % 4 WHEN 3 THEN '' WHEN 2 THEN 'ROE' ELSE 'VILLA' END AS last, CASE k % 4 WHEN 3 THEN '' WHEN 2 THEN 'Jane' ELSE 'Daniel' END AS first FROM t")(
    lambda df: df.select("k", F.regexp_extract("s", _SURNAME, 1).alias("last"), F.regexp_extract("s", _SURNAME, 2).alias("first"))
)
query("flt_20", BOXES, "SELECT k, s FROM t WHERE trim(s) <> '' AND lower(ltrim(trim(s), '/')) <> 'off'")(lambda df: df.filter((F.trim("s") != "") & (F.lower(F.regexp_replace(F.trim("s"), "^/+", "")) != "off")).select("k", "s"))
query("flt_21", "SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) % 40 AS chars, CASE WHEN o_orderkey % 9 = 0 THEN 90 ELSE 0 END AS rotation, o_orderkey % 11 AS pages, CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 612 END AS DOUBLE) AS width, 792.0 AS height, o_orderkey % 17 = 0 AS locked FROM {orders}", "SELECT k, CASE WHEN locked OR pages = 0 OR width <= 0 THEN 'error' WHEN rotation <> 0 THEN 'rotated' WHEN chars < 15 THEN 'scanned' ELSE 'text' END AS v FROM t")(
    lambda df: df.select("k", P.page_type(*(F.col(c) for c in ("chars", "rotation", "pages", "width", "height", "locked"))).alias("v"))
)
scalar("snk_06", BOXES, {"v": T.formula_safe}, {"v": "CASE WHEN s[1] IN ('=', '+', '-', '@') THEN '''' || s ELSE s END"})
scalar("snk_07", DOCS, {"v": T.printable}, {"v": r"regexp_replace(s, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')"})
