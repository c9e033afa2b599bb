"""Registered queries: name → (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the driver's tables and
returns a lazy DataFrame. Column names and types are the same on both sides.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.operators import catalog as cat
from tractlake.operators import facts, feeds, geo, ledger, listing, lookup
from tractlake.plans import books, loads, oracle as O
from tractlake.plans import synth as S
from tractlake.session import scratch_dir
from tractlake.sources import archives, files, workbooks
from tractlake.streaming import ingest

REGISTRY: dict = {}


def register(name, sql=None, raw=False):
    def deco(fn):
        REGISTRY[name] = (fn, sql if sql is None or raw else O.with_ctes(sql))
        return fn
    return deco


def _geo(spark, d):
    return geo.build_geo(S.geo_sheet(spark, d))


def _landed_inputs(spark, d):
    """The areas' keys and the sequences as stored tables, each built and written once, for
    jobs that read them several times."""
    root = scratch_dir(spark, "inputs")

    def landed(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")
    areas = landed(_geo(spark, d).select("year", "geoid", "stusab", "logrecno"), "areas")
    return areas, {s: landed(df, f"seq_{s}") for s, df in S.sequences(spark, d).items()}


def _spine(spark, d):
    return geo.build_spine(_geo(spark, d))


D16 = "decimal(16,2)"
R96 = "decimal(9,6)"

# --------------------------------------------------------------- flagship

_MBA = [("count_orders", "B10001_001"),
        ("count_units", "B10001_001 + B20001_001"),
        ("lines_per_order", "B20001_001 / B10001_001"),
        ("quantity_per_line", "B20001_002 / B20001_001")]
_MBA_STATS = {"count_orders": "count", "count_units": "count",
              "lines_per_order": "rate", "quantity_per_line": "mean"}


@register("metric_by_area", f"""
, data AS (
  SELECT * FROM (SELECT year, stusab, logrecno, B10001_001 FROM seq1) s1
  FULL JOIN (SELECT year, stusab, logrecno, B20001_001, B20001_002 FROM seq2) s2
  USING (year, stusab, logrecno))
SELECT g.year, g.geoid,
  CAST(d.B10001_001 AS {D16}) AS count_orders,
  CAST(d.B10001_001 + d.B20001_001 AS {D16}) AS count_units,
  {O.ratio('d.B20001_001', 'd.B10001_001', 6, R96)} AS lines_per_order,
  {O.ratio('d.B20001_002', 'd.B20001_001', 2, D16)} AS quantity_per_line
FROM data d RIGHT JOIN geo g
  ON d.year = g.year AND lower(d.stusab) = lower(g.stusab) AND d.logrecno = g.logrecno
WHERE g.year BETWEEN 1995 AND 2001""")
def metric_by_area(spark, d):
    rows = [dict(group_name="orders_and_lines", metric_name=n, formula=f,
                 statistic=_MBA_STATS[n], start_year=1995, end_year=9999) for n, f in _MBA]
    plan = cat.plan_groups(rows, S.LOAD_YEAR)[0]
    return facts.group_frame(plan, S.sequences(spark, d), S.lookup_rows(), _geo(spark, d))


# -------------------------------------------------------------- geography

@register("geo_levels", """
SELECT year, geoid, substr(geoid, 1, 3) AS level, substr(geoid, 4, 2) AS component FROM geo""")
def geo_levels(spark, d):
    g = _geo(spark, d)
    return g.select("year", "geoid", geo.geo_level("geoid").alias("level"),
                    geo.geo_component("geoid").alias("component"))


@register("geo_record_no", "SELECT year, stusab, geoid, logrecno FROM geo")
def geo_record_no(spark, d):
    return _geo(spark, d).select("year", "stusab", "geoid", "logrecno")


@register("geo_place_parts",
          "SELECT year, geoid, state, county, census_tract, block_group FROM geo")
def geo_place_parts(spark, d):
    return _geo(spark, d).select("year", "geoid", "state", "county", "census_tract", "block_group")


@register("geo_zcta_cbsa", "SELECT year, geoid, cbsa, zcta FROM geo")
def geo_zcta_cbsa(spark, d):
    return _geo(spark, d).select("year", "geoid", "cbsa", "zcta")


@register("geo_fips_codes", """
SELECT year, geoid, state_fips, county_fips, census_tract_fips, block_group_fips, cbsa_code FROM spine""")
def geo_fips_codes(spark, d):
    return _spine(spark, d).select("year", "geoid", "state_fips", "county_fips",
                                   "census_tract_fips", "block_group_fips", "cbsa_code")


@register("geo_level_label", "SELECT year, geoid, geo_level FROM spine")
def geo_level_label(spark, d):
    return _spine(spark, d).select("year", "geoid", "geo_level")


@register("geo_fill_na", """
SELECT year, geoid, state, county, census_tract, block_group, cbsa, zcta FROM spine""")
def geo_fill_na(spark, d):
    return _spine(spark, d).select("year", "geoid", *geo.PLACE_COLUMNS)


@register("spine_all_years", "SELECT * FROM spine")
def spine_all_years(spark, d):
    return _spine(spark, d)


# ------------------------------------------------------------------ lookup

def _template_lookup(spark, d):
    return lookup.unpivot_template(S.template_sheet(spark, d), seq="SEQUENCE")


@register("template_unpivot", "SELECT varid, seq, label, ordinal FROM template_long")
def template_unpivot(spark, d):
    return _template_lookup(spark, d)


@register("lookup_ordered", """
SELECT seq, string_agg(varid, ',' ORDER BY ordinal) AS header FROM template_long GROUP BY seq""")
def lookup_ordered(spark, d):
    lk = _template_lookup(spark, d)
    # One sequence holds at most a few hundred measures (its file width), so
    # gathering a sequence's ids in one row is bounded.
    return lk.groupBy("seq").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "varid"))),
                    lambda x: x["varid"]), ",").alias("header"))


@register("lookup_sequences_for", """
SELECT DISTINCT seq FROM template_long WHERE varid IN ('T00001_003')""")
def lookup_sequences_for(spark, d):
    return cat.group_sequences(_template_lookup(spark, d), ["T00001_003"])


@register("measures_long_em", """
SELECT year, stusab, logrecno, m.measure, m.estimate, m.margin FROM (
  SELECT year, stusab, logrecno, unnest([""" + ", ".join(
    f"{{'measure': '{m}', 'estimate': e.{m}, 'margin': mm.{m}}}" for m in S.SEQ1) + """]) AS m
  FROM seq1 e FULL JOIN (SELECT * FROM margin1) mm USING (year, stusab, logrecno))""")
def measures_long_em(spark, d):
    return lookup.measures_long(S.seq1(spark, d), S.margin1(spark, d), S.SEQ1)


@register("sequence_wide_typed", """
SELECT fileid, filetype, stusab, chariter, sequence, logrecno, """ + ", ".join(
    f"CAST({m} AS {D16}) AS {m}" for m in S.SEQ2) + " FROM seq2")
def sequence_wide_typed(spark, d):
    schema = lookup.sequence_wide(S.lookup_rows(), 2)
    return lookup.cast_sequence(S.seq2(spark, d), schema)


@register("sequence_full_outer", """
SELECT year, lower(stusab) AS stusab_key, logrecno, B10001_001, B20001_002, C30001_001, C30001_004
FROM (SELECT year, stusab, logrecno, B10001_001 FROM seq1)
FULL JOIN (SELECT year, stusab, logrecno, B20001_002 FROM seq2) USING (year, stusab, logrecno)
FULL JOIN (SELECT year, stusab, logrecno, C30001_001, C30001_004 FROM seq3) USING (year, stusab, logrecno)""")
def sequence_full_outer(spark, d):
    seqs = S.sequences(spark, d)
    frames = [facts.prune_measures(seqs[1], ["B10001_001"]),
              facts.prune_measures(seqs[2], ["B20001_002"]),
              facts.prune_measures(seqs[3], ["C30001_001", "C30001_004"])]
    return facts.join_sequences(frames)


@register("area_right_join", f"""
SELECT g.year, g.geoid, CAST(s.C30001_004 AS {D16}) AS shipped_value
FROM (SELECT year, stusab, logrecno, C30001_004 FROM seq3) s RIGHT JOIN geo g
  ON s.year = g.year AND lower(s.stusab) = lower(g.stusab) AND s.logrecno = g.logrecno""")
def area_right_join(spark, d):
    data = facts.prune_measures(S.seq3(spark, d), ["C30001_004"]).withColumnRenamed(
        "C30001_004", "shipped_value")
    return facts.attach_area(data, _geo(spark, d), ["shipped_value"])


# ----------------------------------------------------------------- catalog

@register("catalog_close_years", f"""
SELECT group_name, metric_name, formula, statistic, start_year,
  CAST(CASE WHEN end_year = 9999 THEN {S.LOAD_YEAR} ELSE end_year END AS INTEGER) AS end_year,
  notes, ordinal FROM catalog_table""")
def catalog_close_years(spark, d):
    return cat.close_open_years(S.catalog_table(spark, d), S.LOAD_YEAR)


@register("catalog_measures", r"""
SELECT DISTINCT group_name, unnest(regexp_extract_all(formula, '[BC]\w*_\w*')) AS measure
FROM catalog_table""")
def catalog_measures(spark, d):
    return cat.extract_measures(S.catalog_table(spark, d))


@register("catalog_guarded", r"""
SELECT ordinal, regexp_replace(formula, '/\s*(\([^()]*\)|[\w.]+)', '/ NULLIF(\1, 0)', 'g') AS guarded
FROM catalog_table""")
def catalog_guarded(spark, d):
    c = S.catalog_table(spark, d)
    return c.select("ordinal", cat.guard_division("formula").alias("guarded"))


@register("catalog_windows", f"""
SELECT group_name, CAST(max(start_year) AS INTEGER) AS first_year,
  CAST(least(max(end_year), {S.LOAD_YEAR}) AS INTEGER) AS last_year
FROM catalog_table GROUP BY group_name""")
def catalog_windows(spark, d):
    return cat.group_windows(S.catalog_table(spark, d), S.LOAD_YEAR)


@register("catalog_types", """
SELECT lower(trim(metric_name)) AS metric_name,
  min(CASE WHEN lower(trim(statistic)) IN ('rate', 'percentage') THEN 'decimal(9,6)'
           ELSE 'decimal(16,2)' END) AS col_type
FROM catalog_table GROUP BY 1""")
def catalog_types(spark, d):
    return cat.metric_types(S.catalog_table(spark, d))


@register("catalog_select_order", r"""
SELECT group_name, ordinal, lower(trim(metric_name)) AS metric_name,
  regexp_replace(formula, '/\s*(\([^()]*\)|[\w.]+)', '/ NULLIF(\1, 0)', 'g') || ' as '
    || lower(trim(metric_name)) AS select_item
FROM catalog_table""")
def catalog_select_order(spark, d):
    return cat.select_items(S.catalog_table(spark, d))


# ----------------------------------------------------------------- metrics

def _group(name):
    plans = cat.plan_groups(S.catalog_rows(), S.LOAD_YEAR)
    return next(p for p in plans if p.name == name)


def _frame(spark, d, name):
    return facts.group_frame(_group(name), S.sequences(spark, d), S.lookup_rows(), _geo(spark, d))


_OM = {
    "count_orders": f"CAST(B10001_001 AS {D16})",
    "count_closed": f"CAST(B10001_002 AS {D16})",
    "count_open_or_pending": f"CAST(B10001_003 + B10001_004 AS {D16})",
    "share_closed": O.ratio("B10001_002", "B10001_001", 6, R96),
    "mean_order_value": O.ratio("B10001_005", "B10001_001", 2, D16),
}
_LINES = {
    "count_lines": f"CAST(B20001_001 AS {D16})",
    "sum_quantity": f"CAST(B20001_002 AS {D16})",
    "lines_per_order": O.ratio("B20001_001", "B10001_001", 6, R96),
    "count_orders": f"CAST(B10001_003 + B10001_004 AS {D16})",
}
_LEGACY = {
    "count_lines": f"CAST(B20001_003 + B20001_004 AS {D16})",
    "count_orders": f"CAST(B10001_002 AS {D16})",
}
_SHIP = {
    "shipped_lines": f"CAST(C30001_001 AS {D16})",
    "open_line_share": O.ratio("C30001_002", "C30001_002 + C30001_003", 6, R96),
    "net_price": f"CAST(C30001_004 - C30001_005 AS {D16})",
    "discount_per_line": O.ratio("C30001_005", "C30001_001", 6, R96),
}
_WINDOWS = {"legacy": (1995, 1997), "lines": (1996, 2001), "orders_mix": (1995, 2001),
            "shipping": (1995, 2001)}
_GROUP_SQL = {"legacy": _LEGACY, "lines": _LINES, "orders_mix": _OM, "shipping": _SHIP}

_WIDE = """
, wide AS (
  SELECT * FROM (SELECT year, stusab, logrecno, B10001_001, B10001_002, B10001_003, B10001_004,
                        B10001_005 FROM seq1)
  FULL JOIN (SELECT year, stusab, logrecno, B20001_001, B20001_002, B20001_003, B20001_004 FROM seq2)
  USING (year, stusab, logrecno)
  FULL JOIN (SELECT year, stusab, logrecno, C30001_001, C30001_002, C30001_003, C30001_004,
                    C30001_005 FROM seq3)
  USING (year, stusab, logrecno))"""


def _group_sql(name):
    lo, hi = _WINDOWS[name]
    cols = ", ".join(f"{sql} AS {m}" for m, sql in _GROUP_SQL[name].items())
    return f"""{_WIDE}
SELECT g.year, g.geoid, {cols}
FROM wide w RIGHT JOIN geo g
  ON w.year = g.year AND w.stusab = lower(g.stusab) AND w.logrecno = g.logrecno
WHERE g.year BETWEEN {lo} AND {hi}"""


@register("metrics_chained_alias", _group_sql("orders_mix"))
def metrics_chained_alias(spark, d):
    return _frame(spark, d, "orders_mix")


@register("metrics_year_window", _group_sql("legacy"))
def metrics_year_window(spark, d):
    return _frame(spark, d, "legacy")


@register("metrics_safe_ratio", f"""
, data AS (SELECT year, stusab, logrecno, B20001_003, B20001_005 FROM seq2)
SELECT g.year, g.geoid,
  {O.ratio('d.B20001_005', 'd.B20001_003', 6, R96)} AS returned_per_flag_a,
  {O.ratio('d.B20001_005', '(d.B20001_003 - d.B20001_003)', 6, R96)} AS always_null
FROM data d RIGHT JOIN geo g
  ON d.year = g.year AND d.stusab = lower(g.stusab) AND d.logrecno = g.logrecno
WHERE g.year BETWEEN 1995 AND 2001""")
def metrics_safe_ratio(spark, d):
    rows = [dict(group_name="returns", metric_name="returned_per_flag_a",
                 formula="B20001_005 / B20001_003", statistic="rate",
                 start_year=1995, end_year=9999),
            dict(group_name="returns", metric_name="always_null",
                 formula="B20001_005 / (B20001_003 - B20001_003)", statistic="rate",
                 start_year=1995, end_year=9999)]
    plan = cat.plan_groups(rows, S.LOAD_YEAR)[0]
    return facts.group_frame(plan, S.sequences(spark, d), S.lookup_rows(), _geo(spark, d))


def _fact_sql(groups):
    names: list = []
    for g in groups:
        for m in _GROUP_SQL[g]:
            if m not in names:
                names.append(m)
    cols = []
    for m in names:
        parts = [f"CASE WHEN g.year BETWEEN {_WINDOWS[g][0]} AND {_WINDOWS[g][1]} "
                 f"THEN {_GROUP_SQL[g][m]} END" for g in reversed(groups) if m in _GROUP_SQL[g]]
        cols.append(f"coalesce({', '.join(parts)}) AS {m}")
    return f"""{_WIDE}
SELECT g.year, g.geoid, {', '.join(cols)}
FROM geo g LEFT JOIN wide w
  ON w.year = g.year AND w.stusab = lower(g.stusab) AND w.logrecno = g.logrecno"""


@register("fact_upsert_last_wins", _fact_sql(["legacy", "lines"]))
def fact_upsert_last_wins(spark, d):
    """Fact skeleton and the groups' upserts in order, folded into one."""
    plans = [_group("legacy"), _group("lines")]
    g = _geo(spark, d)
    stacked = facts.stacked_groups(plans, S.sequences(spark, d), S.lookup_rows(), g)
    return facts.upsert_ranked(facts.empty_fact(g, plans), stacked)


@register("fact_full", _fact_sql(["legacy", "lines", "orders_mix", "shipping"]))
def fact_full(spark, d):
    plans = cat.plan_groups(S.catalog_rows(), S.LOAD_YEAR)
    return facts.build_fact(_geo(spark, d), S.sequences(spark, d), S.lookup_rows(), plans)


# ------------------------------------------------------------------ ledger



def _selected(spark, d):
    return ledger.select_notices(S.notices(spark, d), S.FEED_SENDER, S.FEED_PHRASE)


def _pending(spark, d):
    return ledger.pending_notices(_selected(spark, d), S.ledger(spark, d))


def _appended(spark, d):
    return ledger.append_unseen(S.ledger(spark, d), _selected(spark, d), S.RETRIEVE_TS)


@register("ledger_pending", "SELECT sender, subject, email_ts, event_id, is_feed_update FROM pending")
def ledger_pending(spark, d):
    return _pending(spark, d)


@register("ledger_append", "SELECT * FROM appended")
def ledger_append(spark, d):
    return _appended(spark, d)


@register("ledger_close", f"""
SELECT retrieve_ts, email_ts, email_subject, is_feed_update,
  CASE WHEN CAST(email_ts AS DATE) <= DATE '{S.CLOSE_DAY}' THEN true ELSE updated END AS updated,
  stage_location FROM appended""")
def ledger_close(spark, d):
    return ledger.close_ledger(_appended(spark, d), S.CLOSE_DAY)


@register("ledger_current_batch", """
SELECT stage_location, CAST(strptime(right(stage_location, 8), '%Y%m%d') AS DATE) AS batch_date
FROM (SELECT arg_max('landing/' || strftime(email_ts, '%Y%m%d'), email_ts) AS stage_location
      FROM pending)""")
def ledger_current_batch(spark, d):
    return ledger.current_batch(_pending(spark, d))


# ------------------------------------------------------------------- feeds

@register("feed_scan_by_date", """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20'""")
def feed_scan_by_date(spark, d):
    e = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return feeds.scan_by_date(e, "ts", "2024-01-20")


@register("feed_drift_union", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, s_nationkey AS nationkey FROM supplier""")
def feed_drift_union(spark, d):
    a = S.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    b = S.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return feeds.union_drift([a, b])


@register("feed_clean_columns", """
SELECT s_suppkey AS ssuppkey, s_name AS suppliername, s_nationkey AS nationkey, s_acctbal AS acctbal
FROM supplier""")
def feed_clean_columns(spark, d):
    s = S.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return feeds.clean_columns(s.toDF("s-suppkey", "supplier-name", "nation-key", "acct-bal"))


@register("feed_typed_load", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, code AS state,
  CAST(s_suppkey % 10 + 1 AS DECIMAL(2,0)) AS rating,
  'https://example.org/city/' || CAST(s_suppkey AS VARCHAR) AS url,
  CAST(CAST(s_acctbal AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,6)) AS lat,
  CAST(s_nationkey * -1 AS DECIMAL(10,6)) AS lon,
  CAST(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS DECIMAL(1,0)) AS active
FROM supplier_codes""")
def feed_typed_load(spark, d):
    return feeds.typed_load(S.city_feed(spark, d), feeds.CITY_RATINGS)


@register("feed_directory_load", f"""
SELECT {', '.join({
    "entity": "'school' AS entity", "gsid": "CAST(c_custkey AS VARCHAR) AS gsid", "name": "c_name AS name",
    "state": "code AS state", "level": "lower(c_mktsegment) AS level",
    "zip": "substr(lpad(CAST(c_custkey AS VARCHAR), 5, '0'), 1, 5) AS zip",
    "lat": "CAST(c_custkey % 90 AS DECIMAL(10,6)) AS lat", "lon": "CAST(NULL AS DECIMAL(10,6)) AS lon",
}.get(n, f"CAST(NULL AS VARCHAR) AS {n}") for n, _, _ in feeds.DIRECTORY)}
FROM customer JOIN nations ON c_nationkey = n_nationkey""")
def feed_directory_load(spark, d):
    return feeds.typed_load(S.directory_feed(spark, d), feeds.DIRECTORY)


@register("feed_dictionary_load", """
SELECT CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_size % 4 <> 0 THEN CAST(p_size + 1990 AS DECIMAL(4,0)) END AS year, p_name AS description
FROM part""")
def feed_dictionary_load(spark, d):
    return feeds.typed_load(S.dictionary_feed(spark, d), feeds.DICTIONARY)


@register("feed_tsv_repair", """
, w AS (SELECT file, max(len(string_split(value, chr(9)))) AS w FROM feed_lines GROUP BY file)
, fixed AS (
  SELECT l.file, string_split(CASE WHEN w.w > 4 THEN replace(l.value, chr(9) || ' ' || chr(9), chr(9))
                                   ELSE l.value END, chr(9)) AS p
  FROM feed_lines l JOIN w USING (file))
SELECT file, p[1] AS id, p[2] AS name, p[3] AS nationkey, p[4] AS acctbal FROM fixed""")
def feed_tsv_repair(spark, d):
    return feeds.read_tsv_repaired(S.feed_lines(spark, d), S.FEED_LINE_COLUMNS)


# ----------------------------------------------------------------- listing

def page_rules(path, entry):
    return [
        ("paged_en", path.contains("/en/") & entry.contains("page=")),
        ("anchored", entry.contains("#")),
        ("org_plain", path.contains(".org/") & ~entry.contains("?")),
        ("french", path.contains("/fr/")),
    ]


@register("listing_classify", """
SELECT page_id, path, target FROM (
  SELECT page_id, path,
    CASE WHEN contains(path, '/en/') AND contains(entry, 'page=') THEN 'paged_en'
         WHEN contains(entry, '#') THEN 'anchored'
         WHEN contains(path, '.org/') AND NOT contains(entry, '?') THEN 'org_plain'
         WHEN contains(path, '/fr/') THEN 'french' END || '.' || string_split(entry, '.')[-1] AS target
  FROM page_listing) WHERE target IS NOT NULL""")
def listing_classify(spark, d):
    return listing.classify_files(S.page_listing(spark, d), page_rules)


@register("listing_sequence_no", r"""
SELECT page_id, path, CAST(regexp_extract(path, 'templates/(?:S|s)eq(\d*)\.xls', 1) AS INTEGER) AS seq
FROM template_listing
WHERE regexp_matches(path, 'templates/(?:S|s)eq(\d*)\.xls')
  AND regexp_extract(path, 'templates/(?:S|s)eq(\d*)\.xls', 1) <> ''""")
def listing_sequence_no(spark, d):
    return listing.extract_sequence_no(S.template_listing(spark, d))


@register("listing_new_files", """
, keyed AS (SELECT page_id, path,
   CASE WHEN starts_with(path, 'https://') THEN 'raw/' || substr(path, 9) ELSE path END AS key
   FROM page_listing)
SELECT * FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM keyed l WHERE contains(l.path, '.org/') AND l.key = k.key)""")
def listing_new_files(spark, d):
    def keyed(lst):
        return lst.withColumn("key", listing.map_path("path", "https://", "raw/"))
    return listing.new_files_only(keyed(S.page_listing(spark, d)), keyed(S.landed_listing(spark, d)))


@register("listing_landed_files", """
SELECT page_id, path FROM page_listing k
WHERE EXISTS (SELECT 1 FROM page_listing l WHERE contains(l.path, '.org/') AND l.path = k.path)""")
def listing_landed_files(spark, d):
    return listing.landed_only(S.page_listing(spark, d), S.landed_listing(spark, d), "path")


@register("listing_documents", """
, k AS (SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN '5_year/' WHEN 1 THEN 'docs/' ELSE '1_year/' END AS folder,
    ['Sequence_Number_and_Table_Number_Lookup.xls', 'ACS_5yr_Seq_Table_Number_Lookup.xls',
     'ACS_5-Year_TableShells.xls', 'ACS2014_Shells.xls', 'ACS_2017_SF_5YR_Appendices.xls',
     '5_year_Mini_Geo.xlsx', 'readme.txt'][p_partkey % 7 + 1] AS name FROM part)
SELECT id AS file_id, 'survey/' || CAST(id AS VARCHAR) || '/' || folder || name AS path,
  'docs/2017_' || CASE WHEN name LIKE '%Lookup.xls' THEN 'seq_table_lookup' WHEN name LIKE '%Shells.xls' THEN 'table_shells'
    WHEN name LIKE '%Appendices%' THEN 'appendices' ELSE 'mini_geo' END || '.' || string_split(name, '.')[-1] AS target
FROM k WHERE name LIKE 'ACS_5yr_Seq%' OR name LIKE '%Appendices%' OR name LIKE '%Mini_Geo%'
  OR (name LIKE 'Sequence%' AND folder = '5_year/') OR (name LIKE '%TableShells%' AND folder <> '1_year/')
  OR (name LIKE 'ACS2014%' AND folder = 'docs/')""")
def listing_documents(spark, d):
    return listing.classify_files(S.survey_documents(spark, d), listing.document_rules(2017), target_prefix="docs/")


@register("listing_sequence_paths", """
, roots AS (SELECT 'seq_by_state/' || n_name || '/' AS root, lower(code) AS code FROM nations
            UNION ALL SELECT 'seq_by_state/' || r_name || '/', 'us' FROM region)
, lv AS (SELECT root, code,
           unnest(['All_Geographies_Not_Tracts_Block_Groups', 'Tracts_Block_Groups_Only']) AS level
         FROM roots)
, kinds AS (SELECT *, unnest(['e', 'm']) AS kind FROM lv)
SELECT root, level, code AS region_code, kind,
       root || level || '/' || kind || '20175' || code || '0012000.txt' AS path
FROM kinds WHERE NOT (level = 'Tracts_Block_Groups_Only' AND code = 'us')""")
def listing_sequence_paths(spark, d):
    codes = listing.region_code_from_listing(S.sequence_listing(spark, d, 2017), 2017)
    folders = codes.select(F.regexp_extract("folder", r"^(.*/)", 1).alias("root"),
                           F.regexp_extract("folder", r"([^/]*)$", 1).alias("level"),
                           "region_code")
    return listing.sequence_paths(folders, 2017, 12)


# ----------------------------------------------------------------- sources




@register("archive_expand", "SELECT page_id, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def archive_expand(spark, d):
    p = S.table(spark, d, "pages").select(
        "page_id", "html", F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("name"))
    zips = archives.pack_archives(p, "landing/pages", "name", "html", "page_id")
    members = archives.expand_archives(zips, keep_dirs=False, flatten=True)
    return members.select(
        F.regexp_extract("member", r"(\d+)\.html$", 1).cast("long").alias("page_id"),
        F.length(F.decode("content", "UTF-8")).cast("long").alias("n_chars"))


_SHEET_HEADER = ["STATE", "LOGRECNO", "GEOID", "Name", "SUMLEV"]


def _geo_workbooks(batches):
    for pdf in batches:
        for year, by_year in pdf.groupby("year"):
            sheets = []
            for state, rows in by_year.groupby("STATE"):
                header = list(_SHEET_HEADER)
                vals = rows[_SHEET_HEADER].values.tolist()
                vals = [[int(v) if (i == 1 and v.isdigit() and not v.startswith("0")) else v
                         for i, v in enumerate(r)] for r in vals]
                if state == "SA":
                    header.append("NOTE")
                    vals = [r + ["extra column"] for r in vals]
                sheets.append((state, header, vals))
            # deterministic name: a retried task writes the same workbook path
            first = by_year.iloc[0]
            name = f"{first['STATE']}{first['LOGRECNO']}-{len(by_year)}"
            yield pd.DataFrame({"path": [f"geo/{int(year)}/mini_geo-{name}.xlsx"],
                                "content": [books.workbook_bytes(sheets)]})


@register("workbook_stack", "SELECT * FROM geo")
def workbook_stack(spark, d):
    # Spread the (synthetic) workbook writing over every core: AQE would
    # otherwise coalesce this small input into one Python task.
    sheet = S.geo_sheet(spark, d).repartition(spark.sparkContext.defaultParallelism)
    books = sheet.mapInPandas(_geo_workbooks, archives.PACK_SCHEMA)
    rows = workbooks.read_workbook_rows(books)
    stacked = workbooks.stack_sheets(rows, _SHEET_HEADER + ["NOTE"])
    stacked = stacked.withColumn("year", F.regexp_extract("path", r"geo/(\d{4})/", 1).cast("int"))
    return geo.build_geo(stacked)


_STAGED = T.StructType([T.StructField("supplier_id", T.LongType()),
                        T.StructField("supplier_name", T.StringType()),
                        T.StructField("nation_id", T.IntegerType()),
                        T.StructField("balance", T.DecimalType(12, 2))])


@register("positional_roundtrip", """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_id,
       CAST(s_acctbal AS DECIMAL(12,2)) AS balance FROM supplier""")
def positional_roundtrip(spark, d):
    s = S.table(spark, d, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("decimal(12,2)"))
    path = scratch_dir(spark, "staged")
    files.write_staged_csv(s, path)
    return files.read_positional(spark, path, _STAGED)


@register("sequence_file_load", "SELECT fileid, filetype, stusab, chariter, sequence, logrecno, "
          + ", ".join(S.SEQ3) + ", year FROM seq3")
def sequence_file_load(spark, d):
    path = scratch_dir(spark, "seqfiles")
    S.seq3(spark, d).write.mode("overwrite").partitionBy("year").option("nullValue", files.SEQUENCE_NULL).csv(path)
    schema = lookup.sequence_wide(S.lookup_rows(), 3)
    return files.read_sequence(spark, path, schema, base_path=path)


@register("yearly_read", """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE year(o_orderdate) IN (1995, 1997, 1998, 1999, 2000, 2001)""")
def yearly_read(spark, d):
    base = scratch_dir(spark, "yearly")
    o = S.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("oyear"))
    o.write.mode("overwrite").partitionBy("oyear").parquet(base)
    years = [1995] + list(range(1997, 2002))
    df = files.read_yearly(spark, years, lambda y: f"{base}/oyear={y}",
                           year_pattern=r"oyear=(\d{4})")
    return df.select("o_orderkey", "o_custkey", "year")


@register("stream_ingest_once", """
SELECT event_id, ts, user_id, event_type FROM events WHERE event_type = 'signup'""")
def stream_ingest_once(spark, d):
    ev = S.table(spark, d, "events")
    landing = scratch_dir(spark, "landing")
    ev.write.mode("overwrite").parquet(landing)
    out, ckpt = scratch_dir(spark, "ingested"), scratch_dir(spark, "stream-ckpt")

    def clean(s):
        return s.filter(F.col("event_type") == "signup").select("event_id", "ts", "user_id",
                                                                "event_type")

    ingest.stream_ingest(spark, landing, ev.schema, out, ckpt, clean)
    ingest.stream_ingest(spark, landing, ev.schema, out, ckpt, clean)  # second run: no-op
    return ingest.read_ingested(spark, out)


def _template_books(batches):
    cols = ["FILEID", "FILETYPE", "STUSAB", "CHARITER", "SEQUENCE", "LOGRECNO"] + S.TEMPLATE_MEASURES
    for pdf in batches:
        paths, bodies = [], []
        for rec in pdf.to_dict("records"):
            vals = [None if (isinstance(v, float) and v != v) else v for v in
                    (rec[c] for c in cols)]
            paths.append(f"templates/Seq{rec['SEQUENCE']}.xls")
            bodies.append(books.workbook_bytes([("Sheet1", cols, [vals])]))
        yield pd.DataFrame({"path": paths, "content": bodies})


@register("template_files_read", "SELECT varid, seq, label, ordinal FROM template_long")
def template_files_read(spark, d):
    """Template workbooks (one per part) read back into lookup rows."""
    sheet = S.template_sheet(spark, d).repartition(spark.sparkContext.defaultParallelism)
    books = sheet.mapInPandas(_template_books, archives.PACK_SCHEMA)
    rows = workbooks.read_workbook_rows(books)
    return workbooks.read_templates(rows, listing.TEMPLATE_FILE_PATTERN)


@register("listing_match_archives", """
SELECT page_id, path FROM page_listing WHERE regexp_matches(path, '[0-9]+[.]html$')""")
def listing_match_archives(spark, d):
    return listing.match_files(S.page_listing(spark, d), r"[0-9]+[.]html$")


@register("spine_year_range", "SELECT * FROM spine WHERE year BETWEEN 1996 AND 1999")
def spine_year_range(spark, d):
    return geo.build_spine(_geo(spark, d), 1996, 1999)


@register("fact_full_per_group", _fact_sql(["legacy", "lines", "orders_mix", "shipping"]))
def fact_full_per_group(spark, d):
    """The reference pattern for the whole catalog: one temporary table per
    group, then one upsert per group in ascending name order. Same result
    as ``fact_full``; kept as the before side of the before/after bench."""
    plans = cat.plan_groups(S.catalog_rows(), S.LOAD_YEAR)
    g, seqs = _landed_inputs(spark, d)
    fact = facts.empty_fact(g, plans)
    for p in plans:
        if not p.empty:
            fact = facts.upsert_fact(fact, facts.group_frame(p, seqs, S.lookup_rows(), g))
    return fact


def _ratings_zips(batches):
    import io as _io
    import zipfile as _zf
    for pdf in batches:
        if pdf.empty:
            continue
        key = int(pdf["key"].min())
        buf = _io.BytesIO()
        with _zf.ZipFile(buf, "w", _zf.ZIP_DEFLATED) as z:
            for code, grp in pdf.groupby("code"):
                lines = [S.RATINGS_HEADER] + grp["line"].tolist()
                rows = [x.split("\t") for x in lines]
                if all(len(r) == len(rows[0]) for r in rows):
                    # a member that parses: columns in another order, some fields quoted
                    lines = ["\t".join([f'"{r[3]}"', r[0], r[2], f'"{r[1]}"']) for r in rows]
                z.writestr(f"part{key}/ratings_{code}.txt", "\n".join(lines) + "\n")
        yield pd.DataFrame({"path": [f"landing/feeds/ratings-{key}.zip"],
                            "content": [buf.getvalue()]})


@register("feed_zip_load", """
SELECT CAST(s_suppkey AS VARCHAR) AS testratingid,
  CASE WHEN s_suppkey % 13 = 5 THEN ' ' ELSE 'U' || CAST(s_nationkey AS VARCHAR) END AS universalid,
  CAST(s_suppkey % 10 + 1 AS DECIMAL(2,0)) AS rating,
  'https://example.org/r/' || CAST(s_suppkey AS VARCHAR) AS url
FROM supplier""")
def feed_zip_load(spark, d):
    """Feed zips → members → files → Spark's reader → per-file repair → typed ratings table."""
    zips = S.ratings_lines(spark, d).mapInPandas(_ratings_zips, archives.PACK_SCHEMA)
    members = archives.expand_archives(zips, keep_dirs=False, flatten=False)
    return feeds.read_feed_members(members, feeds.RATINGS)


@register("catalog_csv_load", """
SELECT trim(group_name) AS group_name, trim(metric_name) AS metric_name, formula, statistic,
       start_year, end_year, notes, row_number() OVER (ORDER BY ordinal) - 1 AS ordinal FROM catalog_table""")
def catalog_csv_load(spark, d):
    """Catalog written as CSV files with headers, one after the other, read back by position
    and numbered over all files."""
    path = scratch_dir(spark, "catalog")
    c = S.catalog_table(spark, d).repartitionByRange(2, "ordinal").sortWithinPartitions("ordinal").drop("ordinal")
    files.write_staged_csv(c.toDF("group", "name", "formula", "stat", "first", "last", "notes"), path)
    return files.read_catalog(spark, path)


# Two measures that move to another sequence: sequence and first year of their new home.
_MOVED = {"B10001_001": (2, "B20001_001", 1998), "B20001_002": (3, "C30001_001", 1999)}


def _at(measure):
    _, column, year = _MOVED[measure]
    return f"CASE WHEN g.year >= {year} THEN {column} ELSE {measure} END"


@register("fact_multi_year_lookup", f"""{_WIDE}
SELECT g.year, g.geoid, CAST({_at('B10001_001')} AS {D16}) AS count_moved,
  CAST({_at('B20001_002')} AS {D16}) AS sum_moved, CAST(B10001_002 AS {D16}) AS count_kept,
  {O.ratio(_at('B20001_002'), f"({_at('B10001_001')} - (B10001_002 - B10001_002))", 6, R96)} AS moved_per_moved
FROM geo g LEFT JOIN wide w ON w.year = g.year AND w.stusab = lower(g.stusab) AND w.logrecno = g.logrecno""")
def fact_multi_year_lookup(spark, d):
    """Lookup with a year column, one row per order year and measure, two measures moving
    between sequences; catalog rows out of order; both reach the planner as tables."""
    seqs = S.sequences(spark, d)
    for measure, (seq, column, _) in _MOVED.items():
        seqs[seq] = seqs[seq].withColumn(measure, F.col(column))
    fixed = F.array(*[F.struct(F.lit(v).alias("varid"), F.lit(s).alias("seq"), F.lit(o).alias("ordinal"))
                      for v, s, _, o in S.LOOKUP])
    years = S.table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    home = F.col("seq")
    for measure, (seq, _, year) in _MOVED.items():
        home = F.when((F.col("varid") == measure) & (F.col("year") >= year), F.lit(seq)).otherwise(home)
    lookup_df = years.select("year", F.inline(fixed)).withColumn("seq", home)
    rows = [(4, "moved", "Moved_per_moved", "sum_moved / (Count_moved - (B10001_002 - B10001_002))", "rate"),
            (3, "moved", "count_kept", "B10001_002", "count"), (1, "moved", "Count_moved", "B10001_001", "count"),
            (2, "moved", "sum_moved", "B20001_002", "sum")]
    catalog_df = spark.createDataFrame(
        [(o, g, m, f, st, 1992, 9999) for o, g, m, f, st in rows],
        "ordinal int, group_name string, metric_name string, formula string, statistic string, "
        "start_year int, end_year int")
    return loads.build_fact_table(spark, _geo(spark, d), seqs, lookup_df, catalog_df, S.LOAD_YEAR)


# ------------------------------------------------ remaining table operators

@register("geo_filter_levels", """
SELECT year, stusab, logrecno, geoid FROM geo
WHERE substr(geoid, 1, 3) IN ('040', '050', '140', '150', '310', '860') AND substr(geoid, 4, 2) = '00'""")
def geo_filter_levels(spark, d):
    return geo.build_geo(S.geo_sheet(spark, d), level_filter=True).select("year", "stusab", "logrecno", "geoid")


@register("geo_take_columns", "SELECT year, stusab AS code, geoid AS area FROM geo")
def geo_take_columns(spark, d):
    areas = _geo(spark, d).select("stusab", "geoid", "place_name", "year")
    return geo.take_columns(areas, ["code", "area"], keep=("year",))


@register("lookup_build", """
SELECT varid, seq, label, ordinal FROM template_long WHERE seq % 2 = 0
UNION ALL SELECT varid, seq, label, ordinal FROM template_long WHERE seq % 2 = 1""")
def lookup_build(spark, d):
    """Templates of two folders (even and odd numbers) stacked into one lookup."""
    sheet = S.template_sheet(spark, d)
    return lookup.build_lookup([lookup.unpivot_template(sheet.filter(F.col("SEQUENCE") % 2 == r), "SEQUENCE")
                                for r in (0, 1)])


@register("catalog_sequence_measures", """
SELECT seq, varid, ordinal FROM template_long
WHERE varid IN (SELECT varid FROM template_long WHERE label LIKE '% (%')
   OR varid IN ('T00001_001', 'T00001_003')""")
def catalog_sequence_measures(spark, d):
    """The wanted measures, a table, of every sequence of the lookup."""
    lk = _template_lookup(spark, d)
    wanted = lk.filter(F.col("label").like("% (%") | F.col("varid").isin("T00001_001", "T00001_003"))
    return cat.sequence_measures(lk, wanted)


@register("table_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_scan(spark, d):
    return files.scan_table(spark, f"{d}/supplier.parquet")


@register("stream_dedupe_notices", "SELECT DISTINCT event_id, ts, user_id, event_type FROM events")
def stream_dedupe_notices(spark, d):
    """Events that arrive twice, in two files; the watermark spans all of their times."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    landing, out, ckpt = (scratch_dir(spark, n) for n in ("twice", "deduped", "dedupe-ckpt"))
    ev.unionAll(ev).write.parquet(landing)
    ingest.stream_ingest(spark, landing, ev.schema, out, ckpt,
                         lambda s: ingest.dedupe_notices(s, "ts", ["event_id"], "3650 days"))
    return ingest.read_ingested(spark, out, ev.schema)


@register("archive_chunks", """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n_bytes, md5(coalesce(html, '')) AS digest FROM pages""")
def archive_chunks(spark, d):
    """Members streamed out in pieces of 16 KiB and put together again."""
    p = S.table(spark, d, "pages").select(
        "page_id", F.coalesce("html", F.lit("")).alias("html"),
        F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("name"))
    zips = archives.pack_archives(p, "landing/pages", "name", "html", "page_id")
    parts = archives.expand_chunks(zips, chunk_bytes=1 << 14, keep_empty=True)
    whole = parts.groupBy("archive", "member").agg(
        F.sort_array(F.collect_list(F.struct("offset", "content"))).alias("parts"))
    body = F.aggregate("parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["content"]))
    return whole.select(F.regexp_extract("member", r"(\d+)\.html$", 1).cast("long").alias("page_id"),
                        F.octet_length(body).cast("long").alias("n_bytes"), F.md5(body).alias("digest"))
