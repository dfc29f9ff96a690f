"""Session helpers: a tuned builder and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "pagelode", **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow transfer and UTC time; ``conf`` overrides single settings."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in spark.checkpoint.dir; only where it is unset, as in tests, at a local one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="pagelode-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors don't cost a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; what stands there is removed when the driver's process ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/pagelode-{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_remove_written)
    _WRITTEN.append((spark, path))
    return path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table into the shared checkpoint folder and read it from there.

    Like :func:`cut_lineage` for wide tables: columns are compressed and later steps read only those they need. The table
    is removed when the driver's process ends.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone: nothing is left to do here
            return
