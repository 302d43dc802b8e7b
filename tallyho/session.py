"""Spark session defaults shared by the library, tests and the benchmark.

The library never creates a session behind the caller's back: every operator takes
DataFrames in and returns DataFrames out.  ``get_spark`` is a convenience for scripts and
tests; on a cluster the session comes from the platform and only ``apply_defaults`` and
``checkpoint_dir`` are used.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package is written against.
SQL_DEFAULTS = {
    # dates and timestamps are compared with DuckDB, which is UTC-naive
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions at run time,
    # and turn sort-merge joins into broadcast joins only when the *measured* side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a grid position written twice must not fail the per-row cell map (last one wins)
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (``addPyFile`` of a zip).

    The few Python-side operators (``mapInPandas`` functions) are pickled by reference,
    so the workers need the package; on a cluster this is how it reaches every executor.
    Done once per SparkContext.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session manages its own artifacts
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tallyho-pkg-")
    archive = os.path.join(out_dir, "tallyho.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tallyho", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the platform put in ``spark.checkpoint.dir`` (a shared
    file system every executor can reach).  Only when nothing is configured -- local runs
    and tests -- a fresh scratch folder is created and registered.
    """
    context = getattr(spark, "sparkContext", None)
    known = context.getCheckpointDir() if context else None
    path = spark.conf.get("spark.checkpoint.dir", None) or known
    if path is None:
        if context is None or not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tallyho-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if context and known is None:
        context.setCheckpointDir(path)
    return path


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: lineage is cut, every use sees the same rows."""
    path = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 128 << 20,
                   expansion: float = 2.0, min_partitions: int = 200) -> int:
    """Set shuffle partitions so that a shuffle partition holds about ``target_partition_bytes``
    of the data after decoding (``expansion`` x the compressed input); also align file
    splits and AQE's advisory size.  Returns the partition count.

    100 TB of input gives ~1.6 million initial shuffle partitions, which AQE then coalesces
    to the measured sizes; skewed partitions are split by AQE's skew-join handling.
    """
    parts = max(min_partitions, int(input_bytes * expansion // target_partition_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    return parts
