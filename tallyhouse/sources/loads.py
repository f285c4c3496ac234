"""Idempotent loads into Parquet without a table format.

Two shapes are used:

* a **snapshot** is a folder of numbered versions; readers take the newest one
  that finished (Spark's ``_SUCCESS`` marker), so a failed write changes nothing;
* a **change log** is appended batch by batch, one folder per batch id. A retried
  batch overwrites only its own folder, and nothing written before is rewritten,
  so the cost of a batch does not grow with the table. The current rows are the
  last write per key; ``compact_log`` now and then keeps reads short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


# --- pure DataFrame forms ----------------------------------------------------
def last_write(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the one with the highest ``order``.

    An aggregate, not a window: it combines before the shuffle, so a key with
    very many copies costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*df.columns)


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order: Column | None = None
) -> DataFrame:
    """Incoming rows replace existing rows of the same key; others stay.

    With no columns beside the keys, incoming keys are added only where absent.
    """
    if not keys:
        raise ValueError("an upsert needs key columns")
    missing = [k for k in keys if k not in incoming.columns]
    if missing:
        raise ValueError(f"key columns not in the incoming rows: {missing}")
    if set(incoming.columns) == set(keys):
        added = incoming.distinct().join(existing, keys, "left_anti")
        return existing.unionByName(added, allowMissingColumns=True)
    fresh = last_write(incoming, keys, order if order is not None else F.col("extracted_at"))
    kept = existing.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


def replace_children(
    children: DataFrame, pulled: DataFrame, fresh: DataFrame, parent_keys: list[str]
) -> DataFrame:
    """All children of the pulled parents go; the fresh ones come in."""
    kept = children.join(pulled.select(*parent_keys), parent_keys, "left_anti")
    return kept.unionByName(fresh)


# --- change log --------------------------------------------------------------
def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch; writing it again gives the same log."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {BATCH} bigint").option("basePath", path).parquet(path)


def current_rows(log: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """Last write per key over a change log: later batch first, then ``order``."""
    rank = F.struct(F.col(BATCH), order if order is not None else F.col("extracted_at"))
    return last_write(log, keys, rank).drop(BATCH)


def compact_log(log: DataFrame, keys: list[str], target: str, order: Column | None = None) -> None:
    """Write the last write per key into a new log folder, under the batch it came in.

    Later batches are appended to ``target``; the old folder goes when its owner sees no
    more readers. Running it again writes the same rows.
    """
    rank = F.struct(F.col(BATCH), order if order is not None else F.col("extracted_at"))
    last_write(log, keys, rank).write.mode("overwrite").partitionBy(BATCH).parquet(target)


def current_children(
    children_log: DataFrame, parents_log: DataFrame, parent_keys: list[str], keys: list[str]
) -> DataFrame:
    """Children as of the last batch that pulled their parent."""
    last_pull = parents_log.groupBy(*parent_keys).agg(F.max(BATCH).alias("_last"))
    live = children_log.join(last_pull, parent_keys).filter(F.col(BATCH) == F.col("_last"))
    return current_rows(live.drop("_last"), keys)


# --- snapshots ---------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, path: str, finished: bool) -> list[int]:
    jvm, fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            done = fs.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
            if done or not finished:
                found.append(int(name[1:]))
    return sorted(found)


def snapshot_reload(df: DataFrame, path: str) -> str:
    """Replace the whole snapshot; an empty input leaves an empty table.

    Returns the folder of the new version. Earlier versions stay until removed by
    the owner of the folder, so running readers are not disturbed.
    """
    spark = df.sparkSession
    taken = _versions(spark, path, finished=False)
    target = f"{path}/v{(taken[-1] if taken else 0) + 1:09d}"
    df.write.mode("errorifexists").parquet(target)
    return target


def read_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame:
    done = _versions(spark, path, finished=True)
    if not done:
        raise FileNotFoundError(f"no finished snapshot under {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/v{done[-1]:09d}")
