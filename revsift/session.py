"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume.  UTC keeps epoch-ms -> timestamp/date
# identical on every executor; AQE re-plans joins from measured sizes and
# splits skewed partitions (a business or user may own a third of all rows).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "revsift", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    # checkpoints (stage outputs) are deleted once their DataFrames are gone
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("REVSIFT_DRIVER_MEMORY", "16g"))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (driver-made sessions)."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``.  Only in local mode, where
    driver and executors are one process, an unset folder is made in Spark's own
    scratch folder; on a cluster executors would write to their own disks, so
    there an unset folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or local_folder(sc.master, sc.getConf().get("spark.local.dir", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_folder(master: str, scratch: str) -> str:
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{scratch.split(',')[0]}/revsift-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Paths of the stage tables made inside each open :func:`passing_stages`.
_STAGES: list[list[str]] = []


def stage_table(df: DataFrame) -> DataFrame:
    """A wide table materialised as compressed Parquet in the shared checkpoint folder: far fewer bytes than a checkpoint,
    and later steps read only their columns.  It goes with the application, or with the :func:`passing_stages` around it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    folder, fs = _folder(spark, path)
    fs.deleteOnExit(folder)
    if _STAGES:
        _STAGES[-1].append(path)
    spark.sparkContext._jvm.System.gc()   # the shuffle files behind it go when their plan is collected
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_stages(spark: SparkSession):
    """Stage tables made inside go at the end: what reads them must be done by then."""
    _STAGES.append([])
    try:
        yield
    finally:
        for path in _STAGES.pop():
            folder, fs = _folder(spark, path)
            fs.delete(folder, True)


def restage(spark: SparkSession, make) -> DataFrame:
    """The table that ``make()`` plans, staged; stage tables made on the way go."""
    with passing_stages(spark):
        out = stage_table(make())
        kept = _STAGES[-1].pop()
    if _STAGES:
        _STAGES[-1].append(kept)
    return out


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

