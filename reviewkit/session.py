"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed join partitions (a hot
# token can hold a large share of all rows).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(
    master: str | None = None,
    app_name: str = "reviewkit",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the session's ``spark.checkpoint.dir``. When it is unset, a run on one
    machine (master ``local`` or ``local[...]``) gets a fresh local folder; on a
    cluster there is no folder that all executors share, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="reviewkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    base = work_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and collects inside go when each of them ends, not when the driver's JVM next collects garbage.

    For DataFrames that are run once. A result that is still being fetched (``toLocalIterator``) would lose its files.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reviewkit`` importable in the Python workers (once per application).

    Python UDFs that call library functions are pickled by reference, so every
    executor must be able to import the package. This zips the package next to
    the driver and hands it to ``SparkContext.addPyFile``, the programmatic form
    of ``spark-submit --py-files``; Spark copies it to each executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="reviewkit-pyfiles-"), "reviewkit.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
