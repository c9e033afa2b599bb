"""Survey-shaped inputs derived from the driver's star-schema tables.

Each function reads the given parquet tables and derives, with ordinary
joins and aggregates, a table shaped like one of the survey inputs, so the
operators run on data whose size grows with the scale factor. The DuckDB
twin of every definition lives in ``plans/oracle.py``; keep the two in step.

Mapping: a customer is a census tract (and its block group and ZIP area), a
(nation, market segment) pair is a county, a nation is a state, a region is
a metro area; the order year is the survey year. Three measure sequences
come from orders and line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.functions.columns import pad_left_keep


_MEMO: dict = {}


def _memo(kind: str, spark: SparkSession, d: str, make):
    """Per-session memo of a lazy DataFrame definition.

    DataFrames are immutable plan descriptions, so one definition serves
    every query of the session, as a registered table would; this saves the
    file listing and footer read of each ``spark.read`` and the Python-side
    construction of the shared dimension frames. No data is cached.
    """
    key = (id(spark), d, kind)
    hit = _MEMO.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    df = make()
    _MEMO[key] = (spark, df)
    return df


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return _memo(name, spark, d, lambda: spark.read.parquet(f"{d}/{name}.parquet"))


def nations(spark, d) -> DataFrame:
    return _memo("nations", spark, d, lambda: _nations(spark, d))


def _nations(spark, d) -> DataFrame:
    """Nation with its two-letter region code ``S`` + letter (upper case)."""
    n = table(spark, d, "nation")
    return n.select("n_nationkey", "n_name", "n_regionkey",
                    F.concat(F.lit("S"), F.expr("chr(65 + n_nationkey)")).alias("code"))


def customers(spark, d) -> DataFrame:
    return _memo("customers", spark, d, lambda: _customers(spark, d))


def _customers(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("seg"))
    # nation has 25 rows at every scale factor: a proven size bound
    return c.join(nations(spark, d), F.col("nationkey") == F.col("n_nationkey")).select(
        "custkey", "nationkey", "seg", "code", "n_name", "n_regionkey")


def customer_years(spark, d) -> DataFrame:
    """(year, customer) pairs with at least one order, with place fields."""
    o = table(spark, d, "orders").select(
        F.year("o_orderdate").cast("int").alias("year"), F.col("o_custkey").alias("custkey"))
    cy = o.distinct()
    return cy.join(customers(spark, d), "custkey")


def _pad(x: str, n: int) -> str:
    """SQL twin of ``pad_left_keep``: left-pad to ``n``, never cut."""
    v = f"CAST({x} AS STRING)"
    return f"(CASE WHEN length({v}) < {n} THEN lpad({v}, {n}, '0') ELSE {v} END)"


def _row(stusab: str, logrecno: str, geoid: str, name: str) -> str:
    return (f"named_struct('STATE', {stusab}, 'LOGRECNO', {logrecno}, 'GEOID', {geoid}, "
            f"'Name', {name}, 'SUMLEV', substr({geoid}, 1, 3))")


def geo_sheet(spark, d) -> DataFrame:
    """Stacked geo sheets of all years: STATE, LOGRECNO, GEOID, Name,
    SUMLEV (extra, dropped by the loader), year.

    One pass over the (year, customer) pairs emits the tract, block-group
    and ZIP rows of each customer (``inline``, no union of re-scans). County,
    state and metro rows come from one aggregate over grouping sets, whose
    output is bounded by years x nations x segments whatever the scale.
    Projections are SQL snippets (one call each, not one per function).
    """
    cy = customer_years(spark, d).selectExpr(
        "year", "custkey", "nationkey", "seg", "code", "n_name", "n_regionkey",
        "lpad(CAST(nationkey AS STRING), 2, '0') AS st2",
        "lpad(CAST(ascii(seg) AS STRING), 3, '0') AS cty3",
        f"{_pad('custkey', 6)} AS tract6", f"{_pad('custkey', 5)} AS zip5",
        "CASE WHEN custkey % 10 = 0 THEN concat('Census Tract ', custkey, ', ', n_name) "
        "ELSE concat('Census Tract ', custkey, ', ', seg, ' County, ', n_name) END AS tract_name")
    tract_id = "concat(st2, cty3, tract6)"
    per_customer = cy.selectExpr(
        "inline(array("
        + _row("code", "concat('1', tract6)", f"concat('14000US', {tract_id})", "tract_name") + ", "
        + _row("code", "concat('2', tract6)", f"concat('15000US', {tract_id}, '1')",
               "concat('Block Group 1, ', tract_name)") + ", "
        + _row("code", "concat('86', tract6)", "concat('86000US', zip5)", "concat('ZCTA5 ', zip5)")
        + "))", "year")
    sets = [["year", "n_regionkey", "nationkey", "seg"], ["year", "n_regionkey", "nationkey"],
            ["year", "n_regionkey"]]
    agg = (cy.groupingSets(sets, "year", "n_regionkey", "nationkey", "seg")
           .agg(F.expr("max(code) AS code"), F.expr("max(n_name) AS n_name"),
                F.expr("grouping_id() AS gid")))
    agg = agg.join(table(spark, d, "region"),
                   F.col("n_regionkey") == F.col("r_regionkey"))
    st2 = "lpad(CAST(nationkey AS STRING), 2, '0')"
    cty3 = "lpad(CAST(ascii(seg) AS STRING), 3, '0')"
    county = _row("code", f"concat('5', {_pad('ascii(seg)', 6)})",
                  f"concat('05000US', {st2}, {cty3})", "concat(seg, ' County, ', n_name)")
    state = _row("code", "CAST(nationkey AS STRING)", f"concat('04000US', {st2})", "n_name")
    metro = _row("'US'", f"concat('3', {_pad('r_regionkey', 6)})",
                 "concat('31000US', CAST(r_regionkey * 10 + 10000 AS STRING))",
                 "concat(r_name, ' Metro Area')")
    region = _row("'US'", f"concat('9', {_pad('r_regionkey', 6)})",
                  "concat('02000US', CAST(r_regionkey AS STRING))", "r_name")
    aggregated = agg.selectExpr(
        f"inline(CASE WHEN gid = 0 THEN array({county}) WHEN gid = 1 THEN array({state}) "
        f"ELSE array({metro}, {region}) END)", "year")
    return per_customer.unionByName(aggregated)


def _seq_frame(agg: DataFrame, spark, d, seqno: int, measures) -> DataFrame:
    """Attach region code and the six fixed columns to per-customer rows."""
    c = customers(spark, d).select("custkey", "code")
    return agg.join(c, "custkey").selectExpr(
        "'SUMFILE' AS fileid", "concat(CAST(year AS STRING), 'e5') AS filetype",
        "lower(code) AS stusab", "'000' AS chariter", f"'{seqno:04d}' AS sequence",
        f"concat('1', {_pad('custkey', 6)}) AS logrecno", "year",
        *[f"CAST({m} AS DECIMAL(16,2)) AS {m}" for m in measures])


SEQ1 = ["B10001_001", "B10001_002", "B10001_003", "B10001_004", "B10001_005"]
SEQ2 = ["B20001_001", "B20001_002", "B20001_003", "B20001_004", "B20001_005"]
SEQ3 = ["C30001_001", "C30001_002", "C30001_003", "C30001_004", "C30001_005"]


def _aggs(*exprs):
    return [F.expr(e) for e in exprs]


def seq1(spark, d) -> DataFrame:
    """Orders per customer and order year: count, by status, total price."""
    o = table(spark, d, "orders").selectExpr(
        "CAST(year(o_orderdate) AS INT) AS year", "o_custkey AS custkey", "o_orderstatus AS s",
        "CAST(o_totalprice AS DECIMAL(16,2)) AS p")
    agg = o.groupBy("year", "custkey").agg(*_aggs(
        f"count(1) AS {SEQ1[0]}", f"sum(CASE WHEN s = 'F' THEN 1 ELSE 0 END) AS {SEQ1[1]}",
        f"sum(CASE WHEN s = 'O' THEN 1 ELSE 0 END) AS {SEQ1[2]}",
        f"sum(CASE WHEN s = 'P' THEN 1 ELSE 0 END) AS {SEQ1[3]}", f"sum(p) AS {SEQ1[4]}"))
    return _seq_frame(agg, spark, d, 1, SEQ1)


def margin1(spark, d) -> DataFrame:
    """Margins twin of ``seq1``: a tenth of each estimate."""
    e = seq1(spark, d)
    keep = [c for c in e.columns if c not in SEQ1]
    return e.selectExpr(*keep, *[f"CAST({m} * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(16,2)) AS {m}"
                                 for m in SEQ1])


def _orders_key(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_custkey AS custkey", "CAST(year(o_orderdate) AS INT) AS oyear")


def seq2(spark, d) -> DataFrame:
    """Line items per customer and order year.

    Lines are first reduced to one row per order (shuffle on the order key),
    so the join with orders moves a quarter of the rows.
    """
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(*_aggs(
        "count(1) AS n", "sum(CAST(l_quantity AS DECIMAL(16,2))) AS q",
        "sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a",
        "sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS nn",
        "sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r"))
    j = per_order.join(_orders_key(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    agg = j.groupBy(F.col("oyear").alias("year"), "custkey").agg(*_aggs(
        f"sum(n) AS {SEQ2[0]}", f"sum(q) AS {SEQ2[1]}", f"sum(a) AS {SEQ2[2]}",
        f"sum(nn) AS {SEQ2[3]}", f"sum(r) AS {SEQ2[4]}"))
    return _seq_frame(agg, spark, d, 2, SEQ2)


def seq3(spark, d) -> DataFrame:
    """Line items per customer and ship year (years differ from seq 1/2)."""
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey", F.expr("CAST(year(l_shipdate) AS INT) AS syear")).agg(
        *_aggs("count(1) AS n", "sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS o",
               "sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f",
               "sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS p",
               "sum(CAST(l_discount AS DECIMAL(16,2))) AS dc"))
    j = per_order.join(_orders_key(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    agg = j.groupBy(F.col("syear").alias("year"), "custkey").agg(*_aggs(
        f"sum(n) AS {SEQ3[0]}", f"sum(o) AS {SEQ3[1]}", f"sum(f) AS {SEQ3[2]}",
        f"sum(p) AS {SEQ3[3]}", f"sum(dc) AS {SEQ3[4]}"))
    return _seq_frame(agg, spark, d, 3, SEQ3)


def sequences(spark, d) -> dict:
    return {1: seq1(spark, d), 2: seq2(spark, d), 3: seq3(spark, d)}


# Lookup rows of the three synthetic sequences
# (varid, seq, label, ordinal).
LOOKUP = [
    ("B10001_001", 1, "Orders", 1), ("B10001_002", 1, "Orders closed", 2),
    ("B10001_003", 1, "Orders open", 3), ("B10001_004", 1, "Orders pending", 4),
    ("B10001_005", 1, "Order value", 5),
    ("B20001_001", 2, "Lines", 1), ("B20001_002", 2, "Quantity", 2),
    ("B20001_003", 2, "Lines flag A", 3), ("B20001_004", 2, "Lines flag N", 4),
    ("B20001_005", 2, "Lines flag R", 5),
    ("C30001_001", 3, "Lines shipped", 1), ("C30001_002", 3, "Open lines", 2),
    ("C30001_003", 3, "Filled lines", 3), ("C30001_004", 3, "Extended price", 4),
    ("C30001_005", 3, "Discount", 5),
]


def lookup_rows():
    return [dict(varid=v, seq=s, label=lab, ordinal=o) for v, s, lab, o in LOOKUP]


# Metric catalog of the synthetic survey
# (group, metric, formula, statistic, start year, end year).
CATALOG = [
    ("orders_mix", "count_orders", "B10001_001", "count", 1995, 9999),
    ("orders_mix", "count_closed", "B10001_002", "count", 1995, 9999),
    ("orders_mix", "count_open_or_pending", "B10001_003 + B10001_004", "count", 1995, 9999),
    ("orders_mix", "share_closed", "count_closed / count_orders", "rate", 1995, 9999),
    ("orders_mix", "mean_order_value", "B10001_005 / B10001_001", "mean", 1995, 9999),
    ("lines", "count_lines", "B20001_001", "count", 1996, 9999),
    ("lines", "sum_quantity", "B20001_002", "sum", 1996, 9999),
    ("lines", "lines_per_order", "B20001_001 / B10001_001", "rate", 1996, 9999),
    ("lines", "count_orders", "B10001_003 + B10001_004", "count", 1996, 9999),
    ("legacy", "count_lines", "B20001_003 + B20001_004", "count", 1995, 1997),
    ("legacy", "count_orders", "B10001_002", "count", 1995, 1997),
    ("shipping", "shipped_lines", "C30001_001", "count", 1995, 9999),
    ("shipping", "open_line_share", "C30001_002 / (C30001_002 + C30001_003)", "rate", 1995, 9999),
    ("shipping", "net_price", "C30001_004 - C30001_005", "count", 1995, 9999),
    ("shipping", "discount_per_line", "C30001_005 / C30001_001", "rate", 1995, 9999),
]
LOAD_YEAR = 2001


def catalog_rows():
    return [dict(group_name=g, metric_name=m, formula=f, statistic=s, start_year=a,
                 end_year=b, ordinal=i) for i, (g, m, f, s, a, b) in enumerate(CATALOG, 1)]


def catalog_table(spark, d) -> DataFrame:
    """A catalog with one definition per part, for the catalog operators.

    Group = brand; name from the part key (some with a trailing blank and
    capitals); formula a sum, difference or ratio by size; statistic from
    the type; first year from the size; some closed in 2000.
    """
    p = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    sz = F.col("p_size")
    a = F.concat(F.lit("B"), F.lpad(sz.cast("string"), 5, "0"), F.lit("_001"))
    b = F.concat(F.lit("C"), F.lpad((sz + 1).cast("string"), 5, "0"), F.lit("_002"))
    c = F.concat(F.lit("B"), F.lpad((sz + 2).cast("string"), 5, "0"), F.lit("_003"))
    formula = (F.when(sz % 3 == 0, F.concat(a, F.lit(" + "), b))
               .when(sz % 3 == 1, F.concat(a, F.lit(" - "), c))
               .otherwise(F.concat(a, F.lit(" / ("), b, F.lit(" + "), c, F.lit(")"))))
    name = (F.when(sz % 5 == 0, F.concat(F.lit("Metric_"), k, F.lit(" ")))
            .otherwise(F.concat(F.lit("metric_"), k)))
    stat = (F.when(F.col("p_type") == "SMALL", F.lit("rate"))
            .when(F.col("p_type") == "ECONOMY", F.lit("count"))
            .otherwise(F.lit("median")))
    return p.select(
        F.col("p_brand").alias("group_name"), name.alias("metric_name"),
        formula.alias("formula"), stat.alias("statistic"),
        (F.lit(1990) + sz % 10).cast("int").alias("start_year"),
        F.when(sz % 4 == 0, F.lit(2000)).otherwise(F.lit(9999)).cast("int").alias("end_year"),
        F.col("p_name").alias("notes"), F.col("p_partkey").alias("ordinal"))


TEMPLATE_MEASURES = ["T00001_001", "T00001_002", "T00001_003", "T00001_004"]


def template_sheet(spark, d) -> DataFrame:
    """Template sheets, one per part: six leading columns, then one column
    per measure whose cell is its label (some empty)."""
    p = table(spark, d, "part")
    return p.select(
        F.lit("SUMFILE").alias("FILEID"), F.lit("tmpl").alias("FILETYPE"),
        F.lit("").alias("STUSAB"), F.lit("000").alias("CHARITER"),
        F.col("p_partkey").alias("SEQUENCE"), F.lit("").alias("LOGRECNO"),
        F.col("p_name").alias(TEMPLATE_MEASURES[0]),
        F.col("p_brand").alias(TEMPLATE_MEASURES[1]),
        F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias(TEMPLATE_MEASURES[2]),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))
        .alias(TEMPLATE_MEASURES[3]))


# ------------------------------------------------------------------ feeds

FEED_SENDER = "feeds@example.org"
OTHER_SENDER = "noreply@example.org"
FEED_PHRASE = "Feed Update"
LEDGER_UNTIL = "2024-01-15"
RETRIEVE_TS = "2024-02-01 00:00:00"
CLOSE_DAY = "2024-01-20"


def notices(spark, d) -> DataFrame:
    """Mailbox notices from events: sender by event type, feed subject for
    sign-ups, notice time = event time."""
    e = table(spark, d, "events")
    et = F.col("event_type")
    eid = F.col("event_id").cast("string")
    sender = F.when(et.isin("signup", "purchase", "error"), F.lit(FEED_SENDER)) \
        .otherwise(F.lit(OTHER_SENDER))
    subject = F.when(et == "signup", F.concat(F.lit(FEED_PHRASE + " "), eid)) \
        .otherwise(F.concat(F.upper(et), F.lit(" notice "), eid))
    return e.select(sender.alias("sender"), subject.alias("subject"),
                    F.col("ts").alias("email_ts"), F.col("event_id"))


def ledger(spark, d) -> DataFrame:
    """Ledger of the notices seen before ``LEDGER_UNTIL``; even ids done."""
    n = notices(spark, d).filter((F.col("sender") == FEED_SENDER)
                                 & (F.col("email_ts") < F.lit(LEDGER_UNTIL).cast("timestamp_ntz")))
    return n.select(
        (F.col("email_ts") + F.expr("INTERVAL 1 HOUR")).alias("retrieve_ts"),
        F.col("email_ts"), F.col("subject").alias("email_subject"),
        F.col("subject").contains(FEED_PHRASE).alias("is_feed_update"),
        (F.col("event_id") % 2 == 0).alias("updated"),
        F.concat(F.lit("landing/"), F.date_format("email_ts", "yyyyMMdd")).alias("stage_location"))


def supplier_codes(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.join(nations(spark, d).select("n_nationkey", "code"),
                  F.col("s_nationkey") == F.col("n_nationkey"))


def city_feed(spark, d) -> DataFrame:
    """All-text rows shaped like the city ratings feed, from suppliers."""
    s = supplier_codes(spark, d)
    sid = F.col("s_suppkey").cast("string")
    return s.select(
        sid.alias("id"), F.col("s_name").alias("name"), F.col("code").alias("state"),
        (F.col("s_suppkey") % 10 + 1).cast("string").alias("rating"),
        F.concat(F.lit("https://example.org/city/"), sid).alias("url"),
        (F.col("s_acctbal").cast("decimal(12,2)") * F.lit(0.01).cast("decimal(3,2)"))
        .cast("string").alias("lat"),
        (F.col("s_nationkey") * -1).cast("string").alias("lon"),
        F.when(F.col("s_acctbal") > 0, F.lit("1")).otherwise(F.lit("0")).alias("active"))


def feed_lines(spark, d) -> DataFrame:
    """Tab-separated feed lines, one file per supplier nation.

    Some lines carry a stray tab-blank-tab (their file needs repair); some
    have a blank name, i.e. a legal tab-blank-tab.
    """
    s = supplier_codes(spark, d)
    k = F.col("s_suppkey")
    name = F.when(k % 13 == 5, F.lit(" ")).otherwise(F.col("s_name"))
    sep2 = F.when(k % 11 == 3, F.lit("\t \t")).otherwise(F.lit("\t"))
    text = F.concat(k.cast("string"), F.lit("\t"), name, sep2,
                    F.col("s_nationkey").cast("string"), F.lit("\t"),
                    F.col("s_acctbal").cast("decimal(12,2)").cast("string"))
    return s.select(F.concat(F.lit("feed_"), F.lower("code"), F.lit(".txt")).alias("file"),
                    text.alias("value"))


FEED_LINE_COLUMNS = ["id", "name", "nationkey", "acctbal"]


# ----------------------------------------------------------------- listing

def page_listing(spark, d) -> DataFrame:
    """A listing of page addresses; the pages themselves are not read."""
    return table(spark, d, "pages").select("page_id", F.col("url").alias("path"))


def landed_listing(spark, d) -> DataFrame:
    """Addresses of one site's pages, as landed before."""
    return page_listing(spark, d).filter(F.col("path").contains(".org/"))


def survey_documents(spark, d) -> DataFrame:
    """Paths of documentation files in survey folders, one per part."""
    p = table(spark, d, "part")
    k, sz = F.col("p_partkey"), F.col("p_size")
    folder = (F.when(sz % 3 == 0, F.lit("5_year/")).when(sz % 3 == 1, F.lit("docs/")).otherwise(F.lit("1_year/")))
    names = ["Sequence_Number_and_Table_Number_Lookup.xls", "ACS_5yr_Seq_Table_Number_Lookup.xls",
             "ACS_5-Year_TableShells.xls", "ACS2014_Shells.xls", "ACS_2017_SF_5YR_Appendices.xls",
             "5_year_Mini_Geo.xlsx", "readme.txt"]
    name = F.element_at(F.array(*[F.lit(x) for x in names]), (k % len(names) + 1).cast("int"))
    return p.select(k.alias("file_id"), F.concat(F.lit("survey/"), k.cast("string"), F.lit("/"), folder, name).alias("path"))


def directory_feed(spark, d) -> DataFrame:
    """All-text rows shaped like the directory feed, from customers and their codes."""
    c = table(spark, d, "customer").join(nations(spark, d).select("n_nationkey", "code"),
                                         F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey").cast("string")
    at = {"entity": F.lit("school"), "gsid": k, "name": F.col("c_name"), "state": F.col("code"),
          "level": F.lower("c_mktsegment"), "zip": F.lpad(k, 5, "0"),
          "lat": (F.col("c_custkey") % 90).cast("string"), "lon": F.lit(" "), "website": F.lit("")}
    from tractlake.operators.feeds import DIRECTORY
    return c.select(*[at.get(n, F.lit(None).cast("string")).alias(n) for n, _, _ in DIRECTORY])


def dictionary_feed(spark, d) -> DataFrame:
    """All-text rows shaped like the dictionary feed, from parts."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("id"),
                    F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(
                        (F.col("p_size") + 1990).cast("string")).alias("year"),
                    F.col("p_name").alias("description"))


def template_listing(spark, d) -> DataFrame:
    """Template file paths named after the pages (some without a number)."""
    p = table(spark, d, "pages")
    u = F.col("url")
    num = F.regexp_extract(u, r"/(\d+)", 1)
    name = (F.when(u.contains("/en/"), F.concat(F.lit("Seq"), num))
            .when(u.contains("/fr/"), F.concat(F.lit("seq"), num))
            .when(u.contains("/es/"), F.lit("Seq"))
            .otherwise(F.concat(F.lit("notes"), num)))
    return p.select("page_id", F.concat(F.lit("data/templates/"), name, F.lit(".xls")).alias("path"))


def sequence_listing(spark, d, year: int) -> DataFrame:
    """Folder listing of the sequence files: one region folder per nation
    (and one national folder per world region), both level folders, a
    ``g{year}5{code}.txt`` file in each, and one estimate file per supplier
    in its nation's folders (so the listing grows with the data)."""
    from tractlake.operators.listing import LEVEL_FOLDERS
    levels = F.array(*[F.lit(x) for x in LEVEL_FOLDERS])
    n = nations(spark, d).select(F.col("n_nationkey"), F.col("n_name").alias("nm"),
                                 F.lower("code").alias("code"))
    r = table(spark, d, "region").select(F.col("r_name").alias("nm"), F.lit("us").alias("code"))
    roots = n.drop("n_nationkey").unionByName(r)
    g_files = roots.select(F.concat(F.lit("seq_by_state/"), "nm", F.lit("/")).alias("root"),
                           F.explode(levels).alias("level"),
                           F.concat(F.lit(f"g{year}5"), "code", F.lit(".txt")).alias("file"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    e_files = s.select(F.concat(F.lit("seq_by_state/"), "nm", F.lit("/")).alias("root"),
                       F.explode(levels).alias("level"),
                       F.concat(F.lit(f"e{year}5"), "code",
                                F.format_string("%04d", F.col("s_suppkey") % 10000),
                                F.lit("000.txt")).alias("file"))
    files = g_files.unionByName(e_files)
    return files.select(F.concat("root", "level", F.lit("/"), "file").alias("path"))


RATINGS_HEADER = "test-rating-id\tuniversal-id\trating\turl"


def ratings_lines(spark, d) -> DataFrame:
    """Ratings feed lines from suppliers, one feed file per nation.

    Every line of a nation whose key is 1 mod 4 carries a stray
    tab-blank-tab (the whole file needs repair); some ids are blank, which
    is a legal tab-blank-tab in the other files.
    """
    s = supplier_codes(spark, d)
    k = F.col("s_suppkey")
    uid = F.when(k % 13 == 5, F.lit(" ")).otherwise(F.concat(F.lit("U"), F.col("s_nationkey").cast("string")))
    sep = F.when(F.col("s_nationkey") % 4 == 1, F.lit("\t \t")).otherwise(F.lit("\t"))
    line = F.concat(k.cast("string"), F.lit("\t"), uid, sep, (k % 10 + 1).cast("string"),
                    F.lit("\thttps://example.org/r/"), k.cast("string"))
    return s.select(F.lower("code").alias("code"), k.alias("key"), line.alias("line"))
