"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "folio", extra: dict | None = None) -> SparkSession:
    """A local session sized like the test machine.  On a cluster, use the
    cluster's own session; nothing here is needed there."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a cluster names it, we only read it.

    Where it is unset, a local master (``local[...]``: one machine, one process)
    gets a fresh scratch folder, recorded in the session; any other master is an
    error, since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share (master: {sc.master})")
        d = tempfile.mkdtemp(prefix="folio-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder, for tables written to cut lineage.

    All of an application's sub-folders lie in one folder of its own, which is
    deleted when the application ends, or before by ``clear_scratch``."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        root = f"{checkpoint_dir(spark).rstrip('/')}/folio-{app}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _roots[app] = root
    return f"{_roots[app]}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder: what several branches of a plan read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables now, in a session that lives long: only when no DataFrame that was made
    so far is still to be read."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
