"""Session settings every job here relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on the first two (dates are cut in UTC; bad casts must fail).
# The rest let AQE re-plan joins and split hot partitions, even where the split
# costs one more exchange (forceOptimizeSkewedJoin): one key may hold a third of
# the rows.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Given bytes for one shuffle partition. Rows take some thirty times as much in memory, once
#: documents are built and parsed, and a task holds and sorts its partition there.
PARTITION_BYTES = 4 << 20
#: What AQE puts together to one task, in moved bytes, unless the session says otherwise. A line
#: takes 66 bytes there and about a thousand in a sort: Spark's 64 MB would be a gigabyte.
TASK_BYTES = 16 << 20
#: What one task reads of a file, unless the session says otherwise. A typed line takes 18 bytes
#: in a file and some 300 as a row waiting for its partition: Spark's 128 MB would be 2 GB.
SPLIT_BYTES = 16 << 20

LIMITS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.files.maxPartitionBytes": SPLIT_BYTES,
}


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Let shuffles start with a partition for every ``PARTITION_BYTES`` of the input, and no
    fewer than the session has: partitions then stay small as the input grows, and none has to
    spill. AQE puts small ones together, up to ``TASK_BYTES``. Tasks that read files hold the
    rows they send to many partitions, so they read ``SPLIT_BYTES`` each. Returns the number."""
    for key, size_of_task in LIMITS.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, str(size_of_task))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return parts


def local_session(name: str = "tallyhouse", cores: str = "8", memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tallyhouse-wh-"))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediates: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster the
    executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local[app]


_local: dict[str, str] = {}
_settled: list[str] = []


def file_marks(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the Parquet files right under ``path``, and in folders there."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = []
    for depth in ("*.parquet", "*.parquet/*.parquet"):
        for entry in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{depth}")) or []:
            marks.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
    return tuple(sorted(marks))


def settle(df: DataFrame) -> DataFrame:
    """Write a result that several branches of a plan read, and read it back.

    The branches then share one computation, and its lineage ends here. The job that
    writes the final result owns these tables: ``drop_settled`` removes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    _settled.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_settled(spark: SparkSession) -> int:
    """Remove what this process has settled; results that still read it are void then."""
    paths, _settled[:] = list(_settled), []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


def pii_salt(spark: SparkSession, salt: str | None = None) -> str:
    """The e-mail salt, from ``PII_SALT`` unless given, hidden from plans and logs."""
    value = salt if salt is not None else os.environ["PII_SALT"]
    if not value:
        raise ValueError("PII_SALT is empty: e-mails would be hashed without a salt")
    spark.conf.set("spark.sql.redaction.string.regex", re.escape(value))
    return value
