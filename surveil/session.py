"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "surveil") -> SparkSession:
    """A local session configured the way tests and the bench expect (UTC, AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``surveil`` importable in Python workers (like ``--py-files``), once per SparkContext.

    Pandas UDFs and broadcast objects reference the package by name; workers
    started outside the repository could not import it otherwise.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="surveil-pyfiles-"), "surveil.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is configured by the operator and only read here.
    Only a single-process local session (as in tests) gets a scratch folder of
    its own when the setting is missing; elsewhere executors could not see it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if sc_dir:
        return sc_dir
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local_dir = tempfile.mkdtemp(prefix="surveil-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but computes ``df`` once, keeps the columns
    compressed and leaves their size known to the optimiser; a lost executor
    only costs the tasks it ran.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder (survives executor loss) and drop its lineage."""
    return stage_table(df, "stage")
