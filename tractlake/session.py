"""Session defaults shared by the library, the tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI arithmetic (overflow and bad casts fail
# instead of turning into NULL), a fixed session zone so dates compare the
# same everywhere, and adaptive execution so shuffle sizes are re-planned at
# run time (partition coalescing and skew-join splitting).
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tractlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; locally
    tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (driver and executors in one process) gets a scratch
    folder of its own when the setting is missing; it is removed when the
    process ends. Any other master raises, because a folder on the driver's
    disk is invisible to the executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set: master {sc.master} needs a folder that the "
                "driver and every executor share")
        d = tempfile.mkdtemp(prefix="tractlake-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """Name of a fresh folder below the shared checkpoint folder.

    Nothing is created here: the job that writes the intermediate table (a
    round trip, staged files, stream checkpoints) creates it through Spark,
    whatever file system the folder is on.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers of a session, once.

    Workers import the modules that a ``mapInPandas`` function names. Where
    the package is neither installed on them nor on their path, this zips it
    and lets Spark distribute the zip.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tractlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tractlake-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/tractlake.zip"
    with zipfile.ZipFile(name, "w") as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(at, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(name)
    sc._tractlake_shipped = True
