"""Session defaults and shared scratch locations.

Every path this library writes on its own (fixtures derived from tables, lineage cuts,
snapshot versions created by tests) lives under ``spark.checkpoint.dir``, the shared folder
the cluster names. We only pick a folder ourselves when the session has none, which is the
local-test case.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Python worker holds a batch or two: few bytes, whatever the rows are (chunks, texts)
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # single-byte fallback for CSV decoding may be windows-1252 (survey Q8)
    "spark.sql.legacy.javaCharsets": "true",
    # bytes without a character in the file's charset become U+FFFD instead of failing the job
    "spark.sql.legacy.codingErrorAction": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fileflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; shuffle partitions then
    stay at the cluster's setting (AQE coalesces them at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL defaults to an existing session (e.g. one the driver made)."""
    for k, v in _DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep what is there
            pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session (``spark.checkpoint.dir``, or the context's checkpoint dir);
    set our own only when neither is set, as in local tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="fileflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/fileflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def materialize(df, label: str = "cut"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder and reading
    it back. Unlike an eager ``checkpoint()`` (which computes the plan once to count and
    again to save), the plan runs once; the read-back is a columnar scan that survives the
    loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["get_session", "apply_defaults", "checkpoint_dir", "folders", "path_exists", "scratch_path",
           "materialize"]
