"""Folded upserts, archives in pieces, several loaded years, shipping the package."""

import os
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from tractlake.operators import facts, listing
from tractlake.plans import loads
from tractlake.sources import archives


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_ranked_equals_upserts_in_order(spark):
    fact = spark.createDataFrame([(1, "a", None, 5), (1, "b", 7, None), (2, "a", 1, 1)],
                                 "year int, geoid string, x int, y int")
    first = spark.createDataFrame([(1, "a", 10, None), (1, "b", 20, 21)], fact.schema)
    second = spark.createDataFrame([(1, "a", None, 30), (1, "b", 40, None)], fact.schema)
    one_by_one = facts.upsert_fact(facts.upsert_fact(fact, first), second)
    stacked = first.withColumn("rank", F.lit(0)).unionByName(second.withColumn("rank", F.lit(1)))
    assert _rows(facts.upsert_ranked(fact, stacked), "year", "geoid") == _rows(one_by_one, "year", "geoid")


def test_upsert_ranked_refuses_repeated_key(spark):
    fact = spark.createDataFrame([(1, "a", 1)], "year int, geoid string, x int")
    twice = fact.unionAll(fact).withColumn("rank", F.lit(0))
    with pytest.raises(Exception, match="duplicate key"):
        facts.upsert_ranked(fact, twice).collect()


def test_archive_chunks_from_content_and_in_place(spark, tmp_path):
    body = os.urandom(1 << 20) * 3 + b"end"
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("dir/", b"")
        z.writestr("dir/big.bin", body)
        z.writestr("empty.txt", b"")
        z.writestr("small.txt", b"x")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    for src in (files, files.select("path")):
        rows = archives.expand_chunks(src, 1 << 18).orderBy("member", "offset").collect()
        assert max(len(r["content"]) for r in rows) <= 1 << 18
        big = [r for r in rows if r["member"] == "dir/big.bin"]
        assert len(big) > 12 and b"".join(bytes(r["content"]) for r in big) == body
        assert [bytes(r["content"]) for r in rows if r["member"] != "dir/big.bin"] == [b"x"]


def test_sequence_paths_of_many_sequences(spark):
    folders = spark.createDataFrame([("r/", listing.LEVEL_FOLDERS[0], "us"), ("r/", listing.TRACT_LEVEL, "us")],
                                    "root string, level string, region_code string")
    one = {r["path"] for s in (3, 4) for r in listing.sequence_paths(folders, 2017, s).collect()}
    many = listing.sequence_paths(folders, 2017, [3, 4]).collect()
    assert {r["path"] for r in many} == one and {r["seq"] for r in many} == {3, 4}


def test_loaded_years_are_stacked(spark, tmp_path):
    for year, columns in ((2009, "stusab string, a int"), (2010, "stusab string, a int, b int")):
        row = ("s1", 1) if year == 2009 else ("s1", 2, 3)
        spark.createDataFrame([row], columns).write.parquet(f"{tmp_path}/kind=e/year={year}/seq=1")
    got = loads.read_loaded_sequences(spark, str(tmp_path), [2009, 2010], [1])[1]
    assert _rows(got.select("year", "a", "b"), "year") == [(2009, 1, None), (2010, 2, 3)]


def test_landed_only_keeps_each_entry_once(spark):
    lst = spark.createDataFrame([("a",), ("b",)], "key string")
    landed = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert _rows(listing.landed_only(lst, landed), "key") == [("a",)]


def test_package_reaches_workers_from_another_folder(tmp_path):
    """A worker that can't import the package from its folder gets it by ``ship_package``."""
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from tractlake.session import build_session, ship_package
from tractlake.plans.registry import REGISTRY
spark = build_session("local[2]", shuffle_partitions=2)
ship_package(spark)
print("rows", REGISTRY["archive_expand"][0](spark, "/root/testdata/sf0.001").count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]
