"""Session settings the operators are designed around."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_local_roots: dict[str, str] = {}

# Settings that change results (time zone, repeated keys, state store) or protect memory
# (Arrow batch size) rather than settings that depend on the cluster's size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Model replies may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of a join's narrow side is small, hash it instead of
    # sorting whole articles on the other side. Spark checks the actual sizes.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    # Bodies and pages are large: bound a Python batch by bytes, not only rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    """Prepare an existing session: runtime settings, and our code for its workers."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    The archive is made on the driver, from where Spark serves it to the workers.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gazette-code-")) / "gazette.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def get_session(master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` overrides them."""
    builder = SparkSession.builder.appName("gazette").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a session inside one machine may go without: it gets a folder of its
    own. On a cluster a local folder would lose what other executors wrote.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.applicationId not in _local_roots:
        _local_roots[spark.sparkContext.applicationId] = tempfile.mkdtemp(
            prefix="gazette-checkpoint-"
        )
    return _local_roots[spark.sparkContext.applicationId]


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder if it is not there yet; otherwise do nothing."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        fs.mkdirs(target)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Unlike a local checkpoint the table survives the loss of executors, and
    unlike cached rows it is columnar and its size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
