"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. AQE splits hot join partitions and
# sizes reducers at run time; the forced skew-join rule lets it do so even when
# the join feeds an aggregation on the same key.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A key twice in a JSON message: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int = 8, memory: str = "16g", app: str = "strata", scratch: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks, with a scratch folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", scratch or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a fresh folder of this machine; on a
    cluster a missing setting is an error, because executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_MADE: list[str] = []  # scratch folders of this process


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused folder below the shared scratch folder."""
    path = os.path.join(scratch_root(spark), f"strata-{label}-{uuid.uuid4().hex}")
    _MADE.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process made, once no frame reads them; their number.

    For the end of a job: frames that read an intermediate table can no longer be used.
    """
    jvm, count = spark.sparkContext._jvm, 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        count += bool(files.delete(path, True))
    return count


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Losing an executor later costs a re-read, not a re-run of everything above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
