"""Landed files to change logs, batch by batch, with Structured Streaming.

The file-source checkpoint plays the part of the stored pull position: it moves on
only after a batch is written. A retried batch overwrites its own folder of the
change log, so the result is the same however often it runs. No event-time
watermark is set: late documents are never dropped.

Documents are parsed once a batch and go two ways: rows to the change logs, what can't be
landed to a log of rejects. Both are counted while the rejects are written
(``Observation``); a batch with too large a share of them fails before its rows are
written, so the checkpoint stays where it was and the rejects tell why.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources import landing
from tallyhouse.sources.loads import append_batch

DOC_SCHEMA = "site_code string, extracted_at timestamp, _payload string"


def stream_documents(spark: SparkSession, source: str, files_per_batch: int = 64, schema: str = DOC_SCHEMA) -> DataFrame:
    """Documents as they land (Parquet files of ``schema``), a bounded number of files at a time."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def stream_entity(
    docs: DataFrame, checkpoint: str, targets: dict[str, Callable[[DataFrame], DataFrame]]
) -> None:
    """Run everything landed so far through each mapper into its change log.

    ``targets`` maps a log path to the mapper of its rows. One batch writes all of
    them; if any write fails the batch is repeated as a whole.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(targets) > 1:        # read the files once for all mappers
            batch = batch.persist()
        try:
            for path, mapper in targets.items():
                append_batch(mapper(batch), path, batch_id)
        finally:
            if len(targets) > 1:
                batch.unpersist()

    run_batches(docs, checkpoint, write)


def run_batches(docs: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Everything landed so far through ``write``, batch by batch."""
    query = (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Share of a batch's documents, or lines, that may be bad.
MOST_REJECTS = 0.01


def stream_judged(
    docs: DataFrame, checkpoint: str, judge: Callable[[DataFrame], dict[str, DataFrame]],
    logs: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]], rejects_log: str, most_rejects: float = MOST_REJECTS,
) -> None:
    """Judged documents to change logs, what they refuse to ``rejects_log``.

    ``judge`` gives the judged rows of a batch by entity;
    ``logs`` maps an entity to its log and the mapper of its accepted rows. Rejects carry
    the ``entity``. A repeated batch
    overwrites its own folders of all logs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        found = {entity: rows.persist() for entity, rows in judge(batch).items()}
        try:
            counts = {entity: Observation() for entity in found}
            bad = [
                landing.rejected(rows.observe(counts[entity], F.count(F.lit(1)).alias("seen"), F.count("reason").alias("bad")))
                .withColumn("entity", F.lit(entity))
                for entity, rows in found.items()
            ]
            append_batch(reduce(DataFrame.unionByName, bad), rejects_log, batch_id)
            for entity, seen in counts.items():
                n, refused = seen.get["seen"], seen.get["bad"]
                if refused > most_rejects * n:
                    raise ValueError(f"{refused} of {n} rows for {entity} are bad in batch {batch_id}: see {rejects_log}")
            for entity, (path, mapper) in logs.items():
                append_batch(mapper(found[entity]), path, batch_id)
        finally:
            for rows in reversed(found.values()):
                rows.unpersist()

    run_batches(docs, checkpoint, write)


REJECT_SCHEMA = "site_code string, extracted_at timestamp, woo_order_id bigint, _payload string, reason string, entity string"


def stream_rows(
    docs: DataFrame, checkpoint: str, log: str, id_column: str, rejects_log: str | None = None, most_rejects: float = MOST_REJECTS
) -> None:
    """Documents of products, customers or coupons to their log."""
    stream_judged(
        docs, checkpoint, lambda batch: {id_column: landing.judged(batch, landing.ENTITY_FIELDS)},
        {id_column: (log, lambda rows: landing.entity_rows(rows, id_column))}, rejects_log or f"{log}-rejects", most_rejects)


def _orders_and_lines(batch: DataFrame) -> dict[str, DataFrame]:
    orders = landing.judged(batch, f"{landing.ORDER_FIELDS}, line_items array<string>").persist()
    return {"order": orders, "line": landing.judged_lines(landing.accepted(orders))}


def stream_orders(
    docs: DataFrame, checkpoint: str, orders_log: str, items_log: str, rejects_log: str | None = None, most_rejects: float = MOST_REJECTS
) -> None:
    """Order documents to the order log and the line log; bad ones of both to the rejects."""
    logs = {"order": (orders_log, landing.order_rows), "line": (items_log, landing.line_rows)}
    stream_judged(docs, checkpoint, _orders_and_lines, logs, rejects_log or f"{orders_log}-rejects", most_rejects)
