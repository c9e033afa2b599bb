"""File listings as tables: classify, match, extract, map, skip landed,
derive region codes and the sequence file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.functions.columns import base_name, col_of, file_suffix, zero_pad_int

# Template archive name pattern, template file pattern, the two
# geography-level folders of the sequence files, the region code that has no
# tract-level folder, and the documentation file names the rules look for.
TEMPLATE_ARCHIVE_PATTERN = r"_5yr_Summary_?FileTemplates.zip"
TEMPLATE_FILE_PATTERN = r"templates/(?:S|s)eq(\d*)\.xls"
LEVEL_FOLDERS = ["All_Geographies_Not_Tracts_Block_Groups", "Tracts_Block_Groups_Only"]
TRACT_LEVEL = "Tracts_Block_Groups_Only"
NATIONAL_CODE = "us"
DOC_LOOKUP_NAMES = ["Sequence_Number_and_Table_Number_Lookup.xls",
                    "ACS_5yr_Seq_Table_Number_Lookup.xls"]
DOC_SHELLS_NAMES = ["5-Year_TableShells.xls", "Shells.xls"]
DOC_APPENDICES_NAME = "SF_5YR_Appendices.xls"
DOC_GEO_NAME = "5_year_Mini_Geo.xlsx"
FIVE_YEAR_FOLDER = "5_year"


def document_rules(year: int):
    """The four documentation-file rules of a survey year.

    Each rule is (target name without suffix, predicate over ``path`` and
    ``entry``), in priority order.
    """
    def rules(path: Column, entry: Column):
        five = path.contains(FIVE_YEAR_FOLDER)
        return [
            (f"{year}_seq_table_lookup",
             (five & (entry == DOC_LOOKUP_NAMES[0])) | (entry == DOC_LOOKUP_NAMES[1])),
            (f"{year}_table_shells",
             (five & entry.contains(DOC_SHELLS_NAMES[0]))
             | (~path.contains("year") & entry.contains(DOC_SHELLS_NAMES[1]))),
            (f"{year}_appendices", entry.contains(DOC_APPENDICES_NAME)),
            (f"{year}_mini_geo", entry == DOC_GEO_NAME),
        ]
    return rules


def classify_files(listing: DataFrame, rules, path: str = "path",
                   target_prefix: str = "") -> DataFrame:
    """First matching rule names the target (suffix kept); others dropped.

    ``rules(path_col, entry_col)`` returns (target, predicate) pairs in
    priority order; the entry is the base name of the path.
    """
    p = F.col(path)
    entry = base_name(p)
    chosen = None
    for target, cond in rules(p, entry):
        chosen = (F.when(cond, F.lit(target)) if chosen is None
                  else chosen.when(cond, F.lit(target)))
    out = listing.withColumn(
        "target", F.concat(F.lit(target_prefix), chosen, F.lit("."), file_suffix(entry)))
    return out.filter(F.col("target").isNotNull())


def match_files(listing: DataFrame, pattern: str = TEMPLATE_ARCHIVE_PATTERN,
                path: str = "path") -> DataFrame:
    return listing.filter(F.col(path).rlike(pattern))


def extract_sequence_no(listing: DataFrame, path: str = "path",
                        pattern: str = TEMPLATE_FILE_PATTERN) -> DataFrame:
    """Sequence number of each template file; other files dropped.

    Entries whose number is empty (``Seq.xls``) are dropped before the cast,
    which would fail on empty text under ANSI mode.
    """
    m = F.col(path).rlike(pattern)
    digits = F.regexp_extract(F.col(path), pattern, 1)
    return (listing.filter(m & (digits != ""))
            .withColumn("seq", digits.cast("int")))


def map_path(path, old_prefix: str, new_prefix: str) -> Column:
    """Swap a key prefix (first occurrence)."""
    p = col_of(path)
    return F.when(p.startswith(old_prefix),
                  F.concat(F.lit(new_prefix), F.substr(p, F.lit(len(old_prefix) + 1)))
                  ).otherwise(p)


def new_files_only(listing: DataFrame, landed: DataFrame, key: str = "key") -> DataFrame:
    """Entries whose key is not landed yet; a rerun finds nothing new."""
    return listing.join(landed.select(key).distinct(), key, "left_anti")


def landed_only(listing: DataFrame, landed: DataFrame, key: str = "key") -> DataFrame:
    """Entries whose key has landed, each once however often it landed."""
    return listing.join(landed.select(key), key, "left_semi")


def region_code_from_listing(listing: DataFrame, year: int, path: str = "path") -> DataFrame:
    """Per folder: the region code = two characters before the four-char
    suffix of the first ``g{year}`` file (by name) in that folder."""
    name = base_name(F.col(path))
    folder = F.regexp_extract(F.col(path), r"^(.*)/[^/]*$", 1)
    g = listing.filter(name.startswith(f"g{year}")).select(folder.alias("folder"),
                                                            F.col(path).alias("p"))
    first = g.groupBy("folder").agg(F.min("p").alias("first_file"))
    return first.select("folder", F.substring("first_file", -6, 2).alias("region_code"))


def sequence_paths(folders: DataFrame, year: int, seq) -> DataFrame:
    """Estimate and margin file paths of one sequence in every folder.

    ``seq`` may be a list of sequences; the paths then carry a ``seq`` column.

    ``folders`` has (root, level, region_code): one row per region folder and
    geography level. The national folder has no tract-level files. Kinds
    are expanded with ``explode`` of a literal pair, no join.
    """
    keep = folders.filter(~((F.col("level") == TRACT_LEVEL)
                            & (F.col("region_code") == NATIONAL_CODE)))
    kinds = keep.withColumn("kind", F.explode(F.array(F.lit("e"), F.lit("m"))))
    many = isinstance(seq, (list, tuple))
    if many:
        kinds = kinds.withColumn("seq", F.explode(F.array(*[F.lit(int(s)) for s in seq]).cast("array<int>")))
    name = F.concat(F.col("kind"), F.lit(f"{year}5"), F.col("region_code"),
                    zero_pad_int(F.col("seq") if many else F.lit(seq), 4), F.lit("000.txt"))
    return kinds.select("root", "level", "region_code", "kind", *(["seq"] if many else []),
                        F.concat(F.col("root"), F.col("level"), F.lit("/"), name).alias("path"))
