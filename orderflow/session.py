"""Where intermediate tables live, and how lineage is cut.

``stage`` writes a frame to the shared folder the cluster names in ``spark.checkpoint.dir`` and
reads it back.  It serves three ends: expensive parsing runs once although several outputs read
it; the work survives lost executors; and the optimizer then knows the true size of what it
joins, so a broadcast is chosen by a measured size and not by a guess.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_dirs: dict[str, str] = {}


# What the jobs gain from, on a cluster as in tests.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # re-plan at run time: coalesce small partitions, split skewed ones, broadcast what proves small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM never compiles methods above 8000 bytes; beyond it separate expressions run faster
    # than one fused stage, which the wide generators otherwise become
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own, with ``SETTINGS``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("orderflow")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
    }
    for key, value in {**local, **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode with none configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="orderflow-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing has used yet, in the folder of this application, which can be deleted with it."""
    return f"{shared_dir(spark)}/orderflow/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder once and return the frame that reads it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_watched(df: DataFrame, label: str, **watched: Column) -> tuple[DataFrame, dict[str, object]]:
    """``stage``, with aggregates of the rows taken while they are written, at no extra pass.

    Only minima and maxima belong here: a task that runs twice cannot change them.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *[c.alias(name) for name, c in watched.items()]), label)
    return staged, seen.get
