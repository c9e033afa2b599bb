"""DuckDB twins of the synthetic inputs and of every registered query.

The driver runs these against the same parquet files to check the Spark
results. Base views (``region nation customer …``) are registered by the
driver; the CTEs below re-derive the survey-shaped inputs of
``plans/synth.py`` in SQL, and each query's SQL states the operator's
semantics independently of the Spark code.
"""

from __future__ import annotations


def pad(x: str, n: int) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < {n} THEN lpad({s}, {n}, '0') ELSE {s} END)"


def ratio(num: str, den: str, scale: int, typ: str) -> str:
    """Exact HALF_UP quotient of two non-negative decimal(·,2) values.

    DuckDB divides decimals as DOUBLE; rounding that to ``scale`` places
    disagrees with exact decimal division on ties, so the quotient is
    computed in integers: round(A/B) = (2A·10^k + B) div 2B, A and B in
    cents. A zero or NULL denominator gives NULL.
    """
    a = f"CAST(({num}) * 100 AS HUGEINT)"
    b = f"CAST(NULLIF(({den}), 0) * 100 AS HUGEINT)"
    q = f"(({a}) * {2 * 10 ** scale} + ({b})) // (2 * ({b}))"
    unit = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({q} AS DECIMAL(30,0)) * {unit} AS {typ})"


def level(g: str = "GEOID") -> str:
    return f"substr({g}, 1, 3)"


CTES = {}

CTES["nations"] = """
SELECT n_nationkey, n_name, n_regionkey, 'S' || chr(65 + n_nationkey) AS code FROM nation"""

CTES["customers"] = """
SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_mktsegment AS seg, code, n_name, n_regionkey
FROM customer JOIN nations ON c_nationkey = n_nationkey"""

CTES["cy"] = f"""
SELECT y.year, y.custkey, c.nationkey, c.seg, c.code, c.n_name, c.n_regionkey,
       lpad(CAST(c.nationkey AS VARCHAR), 2, '0') AS st2,
       lpad(CAST(ascii(c.seg) AS VARCHAR), 3, '0') AS cty3,
       {pad('y.custkey', 6)} AS tract6, {pad('y.custkey', 6)} AS cust6, {pad('y.custkey', 5)} AS zip5,
       CASE WHEN y.custkey % 10 = 0
            THEN 'Census Tract ' || CAST(y.custkey AS VARCHAR) || ', ' || c.n_name
            ELSE 'Census Tract ' || CAST(y.custkey AS VARCHAR) || ', ' || c.seg || ' County, ' || c.n_name
       END AS tract_name
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS custkey FROM orders) y
JOIN customers c ON y.custkey = c.custkey"""

CTES["rg"] = """
SELECT r.year, r.r_regionkey, region.r_name
FROM (SELECT DISTINCT year, n_regionkey AS r_regionkey FROM cy) r JOIN region USING (r_regionkey)"""

CTES["geo_sheet"] = f"""
SELECT code AS STATE, '1' || cust6 AS LOGRECNO, '14000US' || st2 || cty3 || tract6 AS GEOID,
       tract_name AS Name, year FROM cy
UNION ALL
SELECT code, '2' || cust6, '15000US' || st2 || cty3 || tract6 || '1', 'Block Group 1, ' || tract_name, year FROM cy
UNION ALL
SELECT code, '86' || cust6, '86000US' || zip5, 'ZCTA5 ' || zip5, year FROM cy
UNION ALL
SELECT code, '5' || {pad('ascii(seg)', 6)}, '05000US' || st2 || cty3, seg || ' County, ' || n_name, year
FROM (SELECT DISTINCT year, nationkey, code, n_name, seg, st2, cty3 FROM cy)
UNION ALL
SELECT code, CAST(nationkey AS VARCHAR), '04000US' || st2, n_name, year
FROM (SELECT DISTINCT year, nationkey, code, n_name, st2 FROM cy)
UNION ALL
SELECT 'US', '3' || {pad('r_regionkey', 6)}, '31000US' || CAST(r_regionkey * 10 + 10000 AS VARCHAR),
       r_name || ' Metro Area', year FROM rg
UNION ALL
SELECT 'US', '9' || {pad('r_regionkey', 6)}, '02000US' || CAST(r_regionkey AS VARCHAR), r_name, year FROM rg"""


def _part(k: int) -> str:
    return f"coalesce(string_split(Name, ',')[-{k}], 'NA')"


CTES["geo"] = f"""
SELECT year, STATE AS stusab, {pad('LOGRECNO', 7)} AS logrecno, GEOID AS geoid, Name AS place_name,
  nullif(CASE WHEN {level()} IN ('040','050','140','150') THEN {_part(1)} END, '') AS state,
  nullif(CASE WHEN {level()} IN ('050','140','150') THEN {_part(2)} END, '') AS county,
  nullif(CASE WHEN {level()} IN ('140','150') THEN {_part(3)} END, '') AS census_tract,
  nullif(CASE WHEN {level()} IN ('150') THEN {_part(4)} END, '') AS block_group,
  nullif(CASE WHEN {level()} = '310' THEN Name END, '') AS cbsa,
  nullif(CASE WHEN {level()} = '860' THEN right(Name, 5) END, '') AS zcta
FROM geo_sheet"""


def _code(levels: str, n: int) -> str:
    return f"CASE WHEN {level('geoid')} IN ({levels}) THEN substr(geoid, 8, {n}) ELSE 'NA' END"


CTES["spine"] = f"""
SELECT CAST(year AS INTEGER) AS year, geoid, place_name, stusab,
  coalesce(state, 'NA') AS state, coalesce(county, 'NA') AS county,
  coalesce(census_tract, 'NA') AS census_tract, coalesce(block_group, 'NA') AS block_group,
  coalesce(cbsa, 'NA') AS cbsa, coalesce(zcta, 'NA') AS zcta,
  {_code("'040','050','140','150'", 2)} AS state_fips,
  {_code("'050','140','150'", 5)} AS county_fips,
  {_code("'140','150'", 11)} AS census_tract_fips,
  {_code("'150'", 12)} AS block_group_fips,
  {_code("'310'", 5)} AS cbsa_code,
  CASE {level('geoid')} WHEN '040' THEN 'State' WHEN '050' THEN 'County'
       WHEN '140' THEN 'Census Tract' WHEN '150' THEN 'Block Group'
       WHEN '310' THEN 'CBSA' WHEN '860' THEN 'ZCTA' ELSE 'NA' END AS geo_level
FROM geo"""


def _seq(name: str, seqno: int, measures, inner: str) -> str:
    cols = ", ".join(f"CAST(a.{m} AS DECIMAL(16,2)) AS {m}" for m in measures)
    return f"""
SELECT 'SUMFILE' AS fileid, CAST(a.year AS VARCHAR) || 'e5' AS filetype, lower(c.code) AS stusab,
       '000' AS chariter, '{seqno:04d}' AS sequence, '1' || {pad('a.custkey', 6)} AS logrecno,
       a.year, {cols}
FROM ({inner}) a JOIN customers c ON a.custkey = c.custkey"""


SEQ1 = ["B10001_001", "B10001_002", "B10001_003", "B10001_004", "B10001_005"]
SEQ2 = ["B20001_001", "B20001_002", "B20001_003", "B20001_004", "B20001_005"]
SEQ3 = ["C30001_001", "C30001_002", "C30001_003", "C30001_004", "C30001_005"]

CTES["seq1"] = _seq("seq1", 1, SEQ1, """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS custkey, count(*) AS B10001_001,
       sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS B10001_002,
       sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS B10001_003,
       sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS B10001_004,
       sum(CAST(o_totalprice AS DECIMAL(16,2))) AS B10001_005
FROM orders GROUP BY 1, 2""")

CTES["margin1"] = "SELECT fileid, filetype, stusab, chariter, sequence, logrecno, year, " + ", ".join(
    f"CAST({m} * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(16,2)) AS {m}" for m in SEQ1) + " FROM seq1"

CTES["seq2"] = _seq("seq2", 2, SEQ2, """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS custkey, sum(n) AS B20001_001,
       sum(q) AS B20001_002, sum(a) AS B20001_003, sum(nn) AS B20001_004, sum(r) AS B20001_005
FROM (SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(16,2))) AS q,
             sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a,
             sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS nn,
             sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r
      FROM lineitem GROUP BY l_orderkey) li
JOIN orders ON li.l_orderkey = o_orderkey GROUP BY 1, 2""")

CTES["seq3"] = _seq("seq3", 3, SEQ3, """
SELECT syear AS year, o_custkey AS custkey, sum(n) AS C30001_001, sum(o) AS C30001_002,
       sum(f) AS C30001_003, sum(p) AS C30001_004, sum(dc) AS C30001_005
FROM (SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS syear, count(*) AS n,
             sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS o,
             sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f,
             sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS p,
             sum(CAST(l_discount AS DECIMAL(16,2))) AS dc
      FROM lineitem GROUP BY 1, 2) li
JOIN orders ON li.l_orderkey = o_orderkey GROUP BY 1, 2""")

CTES["catalog_table"] = """
SELECT p_brand AS group_name,
  CASE WHEN p_size % 5 = 0 THEN 'Metric_' || CAST(p_partkey AS VARCHAR) || ' '
       ELSE 'metric_' || CAST(p_partkey AS VARCHAR) END AS metric_name,
  CASE WHEN p_size % 3 = 0 THEN fa || ' + ' || fb
       WHEN p_size % 3 = 1 THEN fa || ' - ' || fc
       ELSE fa || ' / (' || fb || ' + ' || fc || ')' END AS formula,
  CASE WHEN p_type = 'SMALL' THEN 'rate' WHEN p_type = 'ECONOMY' THEN 'count' ELSE 'median' END AS statistic,
  CAST(1990 + p_size % 10 AS INTEGER) AS start_year,
  CAST(CASE WHEN p_size % 4 = 0 THEN 2000 ELSE 9999 END AS INTEGER) AS end_year,
  p_name AS notes, p_partkey AS ordinal
FROM (SELECT *, 'B' || lpad(CAST(p_size AS VARCHAR), 5, '0') || '_001' AS fa,
             'C' || lpad(CAST(p_size + 1 AS VARCHAR), 5, '0') || '_002' AS fb,
             'B' || lpad(CAST(p_size + 2 AS VARCHAR), 5, '0') || '_003' AS fc FROM part)"""

CTES["template_long"] = """
SELECT varid, seq, label, ordinal FROM (
  SELECT 'T00001_001' AS varid, CAST(p_partkey AS INTEGER) AS seq, p_name AS label, 1 AS ordinal FROM part
  UNION ALL SELECT 'T00001_002', CAST(p_partkey AS INTEGER), p_brand, 2 FROM part
  UNION ALL SELECT 'T00001_003', CAST(p_partkey AS INTEGER),
                   CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END, 3 FROM part
  UNION ALL SELECT 'T00001_004', CAST(p_partkey AS INTEGER),
                   p_name || ' (' || CAST(p_size AS VARCHAR) || ')', 4 FROM part)
WHERE label IS NOT NULL"""


def with_ctes(body: str) -> str:
    """Prefix the SQL body with every base CTE (DuckDB skips unused ones)."""
    parts = ",\n".join(f"{k} AS ({v}\n)" for k, v in CTES.items())
    return f"WITH {parts}\n{body}"

CTES["notices"] = """
SELECT CASE WHEN event_type IN ('signup', 'purchase', 'error') THEN 'feeds@example.org'
            ELSE 'noreply@example.org' END AS sender,
       CASE WHEN event_type = 'signup' THEN 'Feed Update ' || CAST(event_id AS VARCHAR)
            ELSE upper(event_type) || ' notice ' || CAST(event_id AS VARCHAR) END AS subject,
       ts AS email_ts, event_id
FROM events"""

CTES["ledger"] = """
SELECT email_ts + INTERVAL 1 HOUR AS retrieve_ts, email_ts, subject AS email_subject,
       contains(subject, 'Feed Update') AS is_feed_update, event_id % 2 = 0 AS updated,
       'landing/' || strftime(email_ts, '%Y%m%d') AS stage_location
FROM notices WHERE sender = 'feeds@example.org' AND email_ts < TIMESTAMP '2024-01-15 00:00:00'"""

CTES["sel"] = """
SELECT sender, subject, email_ts, event_id, contains(subject, 'Feed Update') AS is_feed_update
FROM notices WHERE sender = 'feeds@example.org'"""

CTES["pending"] = """
SELECT * FROM sel s
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.updated AND l.email_ts = s.email_ts)
  AND is_feed_update"""

CTES["appended"] = """
SELECT retrieve_ts, email_ts, email_subject, is_feed_update, updated, stage_location FROM ledger
UNION ALL
SELECT CAST(TIMESTAMP '2024-02-01 00:00:00' AS TIMESTAMP), email_ts, subject, is_feed_update, false,
       'landing/' || strftime(email_ts, '%Y%m%d')
FROM sel s WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.email_ts = s.email_ts)"""

CTES["supplier_codes"] = """
SELECT * FROM supplier JOIN nations ON s_nationkey = n_nationkey"""

CTES["feed_lines"] = """
SELECT 'feed_' || lower(code) || '.txt' AS file,
       CAST(s_suppkey AS VARCHAR) || chr(9) || (CASE WHEN s_suppkey % 13 = 5 THEN ' ' ELSE s_name END)
       || (CASE WHEN s_suppkey % 11 = 3 THEN chr(9) || ' ' || chr(9) ELSE chr(9) END)
       || CAST(s_nationkey AS VARCHAR) || chr(9) || CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR)
       AS value
FROM supplier_codes"""

CTES["page_listing"] = """
SELECT page_id, url AS path, string_split(url, '/')[-1] AS entry
FROM pages"""

CTES["template_listing"] = r"""
SELECT page_id, 'data/templates/' ||
  CASE WHEN contains(url, '/en/') THEN 'Seq' || regexp_extract(url, '/(\d+)', 1)
       WHEN contains(url, '/fr/') THEN 'seq' || regexp_extract(url, '/(\d+)', 1)
       WHEN contains(url, '/es/') THEN 'Seq'
       ELSE 'notes' || regexp_extract(url, '/(\d+)', 1) END || '.xls' AS path
FROM pages"""
