"""Geography: area table of one or more years and the multi-year spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.functions.columns import (
    blank_to_null, col_of, last_chars, pad_left_keep, part_from_end,
)

# Summary-level codes (first three characters of an area id)
# and which place-name part or code each level carries.
LEVEL_STATE = "040"
LEVEL_COUNTY = "050"
LEVEL_TRACT = "140"
LEVEL_BLOCK_GROUP = "150"
LEVEL_CBSA = "310"
LEVEL_ZCTA = "860"
# Place-name parts, counted from the end of the comma list, and the levels
# that have them.
STATE_LEVELS = ["040", "050", "140", "150"]
COUNTY_LEVELS = ["050", "140", "150"]
TRACT_LEVELS = ["140", "150"]
BLOCK_GROUP_LEVELS = ["150"]
# Level labels of the spine.
LEVEL_LABELS = [("040", "State"), ("050", "County"), ("140", "Census Tract"),
                ("150", "Block Group"), ("310", "CBSA"), ("860", "ZCTA")]
# Levels and component of the optional (inactive by default) level filter.
FILTER_LEVELS = ["040", "050", "140", "150", "310", "860"]
FILTER_COMPONENT = "00"

GEO_COLUMNS = ["stusab", "logrecno", "geoid", "place_name", "state", "county",
               "census_tract", "block_group", "cbsa", "zcta"]
PLACE_COLUMNS = ["state", "county", "census_tract", "block_group", "cbsa", "zcta"]
SPINE_COLUMNS = ["year", "geoid", "place_name", "stusab", "state", "county",
                 "census_tract", "block_group", "cbsa", "zcta", "state_fips",
                 "county_fips", "census_tract_fips", "block_group_fips",
                 "cbsa_code", "geo_level"]


def geo_level(geoid) -> Column:
    return F.substring(col_of(geoid), 1, 3)


def geo_component(geoid) -> Column:
    return F.substring(col_of(geoid), 4, 2)


def take_columns(df: DataFrame, names, keep=()) -> DataFrame:
    """The first ``len(names)`` columns by position, renamed by position.

    Columns named in ``keep`` (for example a ``year`` partition column) are
    carried along after them.
    """
    n = len(names)
    head = [F.col(f"`{c}`").alias(t) for c, t in zip(df.columns[:n], names)]
    return df.select(*head, *[F.col(k) for k in keep])


def _when_level(level: Column, levels, value: Column) -> Column:
    return F.when(level.isin(levels), value)


def place_columns(name, geoid, trim: bool = False) -> dict:
    """Column expressions for state / county / census_tract / block_group /
    cbsa / zcta, given the place-name and area-id columns.

    Parts come from the comma list of the place name counted from the end;
    a level that needs more parts than the name has gets ``'NA'``. Levels a
    column does not apply to get NULL (the staged-file null model). With
    ``trim`` the blank after each comma is removed; by default it is kept.
    """
    lvl = geo_level(geoid)
    nm = col_of(name)

    def part(k):
        p = part_from_end(nm, k)
        return F.trim(p) if trim else p

    cols = {
        "state": _when_level(lvl, STATE_LEVELS, part(1)),
        "county": _when_level(lvl, COUNTY_LEVELS, part(2)),
        "census_tract": _when_level(lvl, TRACT_LEVELS, part(3)),
        "block_group": _when_level(lvl, BLOCK_GROUP_LEVELS, part(4)),
        "cbsa": F.when(lvl == LEVEL_CBSA, nm),
        "zcta": F.when(lvl == LEVEL_ZCTA, last_chars(nm, 5)),
    }
    return {k: blank_to_null(v) for k, v in cols.items()}


def place_parts(df: DataFrame, name="place_name", geoid="geoid",
                trim: bool = False) -> DataFrame:
    """Add the six place columns (see :func:`place_columns`)."""
    return df.withColumns(place_columns(name, geoid, trim))


def build_geo(raw: DataFrame, keep=("year",), level_filter: bool = False,
              trim: bool = False) -> DataFrame:
    """Area table from a stacked geo sheet.

    ``raw`` holds (region code, record no, area id, place name, ...) by
    position; later columns are dropped. Record numbers are padded to seven
    characters without cutting longer ones. ``keep`` names extra columns to
    carry (the ``year`` of each sheet). One projection: every output column
    is an expression over the four input columns.
    """
    keep = [k for k in keep if k in raw.columns]
    st, rec, gid, nm = [F.col(f"`{c}`") for c in raw.columns[:4]]
    if level_filter:
        raw = raw.filter(geo_level(gid).isin(FILTER_LEVELS)
                         & (geo_component(gid) == FILTER_COMPONENT))
    parts = place_columns(nm, gid, trim)
    return raw.select(*[F.col(k) for k in keep], st.alias("stusab"),
                      pad_left_keep(rec, 7).alias("logrecno"), gid.alias("geoid"),
                      nm.alias("place_name"), *[v.alias(k) for k, v in parts.items()])


def fips_columns(geoid="geoid") -> dict:
    """Codes cut from the area id from its eighth character on."""
    g = col_of(geoid)
    lvl = geo_level(g)

    def code(levels, n):
        return F.when(lvl.isin(levels), F.substring(g, 8, n)).otherwise(F.lit("NA"))

    return {
        "state_fips": code(STATE_LEVELS, 2),
        "county_fips": code(COUNTY_LEVELS, 5),
        "census_tract_fips": code(TRACT_LEVELS, 11),
        "block_group_fips": code(BLOCK_GROUP_LEVELS, 12),
        "cbsa_code": code([LEVEL_CBSA], 5),
    }


def fips_codes(df: DataFrame, geoid="geoid") -> DataFrame:
    return df.withColumns(fips_columns(geoid))


def geo_level_label(geoid="geoid") -> Column:
    lvl = geo_level(geoid)
    out = None
    for code, label in LEVEL_LABELS:
        out = (F.when(lvl == code, F.lit(label)) if out is None
               else out.when(lvl == code, F.lit(label)))
    return out.otherwise(F.lit("NA"))


def fill_na_text(df: DataFrame, cols=PLACE_COLUMNS) -> DataFrame:
    """NULL becomes the text ``'NA'`` in the given columns."""
    return df.fillna("NA", subset=list(cols))


def build_spine(geo: DataFrame, start_year: int | None = None,
                end_year: int | None = None) -> DataFrame:
    """All (year, area) rows with names, codes and level label.

    ``geo`` is the area table of every loaded year with a ``year`` column;
    years without a table are simply absent (no placeholder row). The year
    range, when given, is a filter on the partition column, so Spark reads
    only those year folders. One projection computes every spine column.
    """
    yr = F.col("year")
    if start_year is not None and end_year is not None:
        geo = geo.filter(yr.between(start_year, end_year))
    elif start_year is not None:
        geo = geo.filter(yr >= start_year)
    elif end_year is not None:
        geo = geo.filter(yr <= end_year)
    cols = {"year": yr.cast("int"), "geoid": F.col("geoid"), "place_name": F.col("place_name"),
            "stusab": F.col("stusab")}
    cols.update({c: F.coalesce(F.col(c), F.lit("NA")) for c in PLACE_COLUMNS})
    cols.update(fips_columns("geoid"))
    cols["geo_level"] = geo_level_label("geoid")
    return geo.select(*[cols[c].alias(c) for c in SPINE_COLUMNS])
