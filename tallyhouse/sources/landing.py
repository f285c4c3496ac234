"""Shop payloads (one JSON document per row) to raw rows.

Input: a DataFrame ``(site_code, extracted_at, _payload STRING)`` as read from
landed JSON lines, all sites together. Raw rows promote a few fields and keep the
whole document as text. No step here shuffles.

A document that can't be read, or whose id is missing or no number, lands nowhere:
``rejects`` lists them all and ``assert_few_rejects`` stops a load with too many. Lines of
such orders are not landed either; their documents are in the list. An entry of
``line_items`` is judged the same way, by ``line_rejects``.

``judged`` parses a document once, for its rows and for the rejects: a stream writes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.clean import parse_gmt

# Re-read this much before the stored watermark: the filter is exclusive.
OVERLAP_SECONDS = 1


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines laid out as ``site_code=<code>/*.json`` under ``path``."""
    schema = "value string, site_code string"
    lines = spark.read.schema(schema).text(path)
    return lines.select(
        "site_code", F.current_timestamp().alias("extracted_at"), F.col("value").alias("_payload")
    )


CORRUPT = "_corrupt_record"


def _parsed(docs: DataFrame, fields: str) -> DataFrame:
    """The document's promoted fields as ``d``, all text, from one parse; bad documents too."""
    schema = ", ".join(f if " " in f else f"{f} string" for f in [*fields.split(", "), CORRUPT])
    return docs.withColumn("d", F.from_json("_payload", schema, {"columnNameOfCorruptRecord": CORRUPT}))


def _id() -> Column:
    """The document's id; text that is no whole number gives none, and stops nothing."""
    return F.expr("try_cast(d.id as bigint)")


def _good() -> Column:
    return F.col("d").isNotNull() & F.col(f"d.{CORRUPT}").isNull() & _id().isNotNull()


def _promoted(docs: DataFrame, fields: str) -> DataFrame:
    return _parsed(docs, fields).filter(_good())


def judged(docs: DataFrame, fields: str) -> DataFrame:
    """``docs`` with the parsed fields as ``d`` and ``reason``: NULL, or why it can't be landed."""
    unread = F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()
    reason = F.when(unread, "not a document").when(F.col("d.id").isNull(), "no id").when(_id().isNull(), "id is no number")
    return _parsed(docs, fields).withColumn("reason", reason)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull())


def rejected(rows: DataFrame) -> DataFrame:
    """What ``judged`` refuses, with the reason; lines with their order's id."""
    order = F.col("woo_order_id") if "woo_order_id" in rows.columns else F.lit(None).cast("bigint")
    bad = rows.filter(F.col("reason").isNotNull())
    return bad.select("site_code", "extracted_at", order.alias("woo_order_id"), "_payload", "reason")


def rejects(docs: DataFrame) -> DataFrame:
    """Documents that can't be landed, with the reason; keep them beside the raw tables."""
    return rejected(judged(docs, "id")).drop("woo_order_id")


def line_rejects(docs: DataFrame) -> DataFrame:
    """Entries of the orders' ``line_items`` that can't be landed, with the reason."""
    return rejected(judged_lines(accepted(judged(docs, LINE_FIELDS))))


def landed_counts(docs: DataFrame) -> DataFrame:
    """Good and rejected documents per site."""
    good = F.coalesce(_good(), F.lit(False))
    return _parsed(docs, "id").groupBy("site_code").agg(F.count_if(good).alias("landed"), F.count_if(~good).alias("rejected"))


def assert_few_rejects(docs: DataFrame, share: float = 0.01) -> None:
    """Fail where more than ``share`` of a site's documents are bad."""
    over = landed_counts(docs).filter(F.col("rejected") > F.lit(share) * (F.col("landed") + F.col("rejected")))
    worst = over.orderBy(F.desc("rejected"), "site_code").first()
    if worst is not None:
        raise ValueError(f"{worst['rejected']} of {worst['landed'] + worst['rejected']} documents of {worst['site_code']} are bad")


ORDER_FIELDS = "id, number, status, currency, date_created_gmt, date_modified_gmt"
LINE_FIELDS = "id, line_items array<string>"


def order_rows(rows: DataFrame) -> DataFrame:
    """Raw orders of judged documents."""
    return accepted(rows).select(
        "site_code",
        _id().alias("woo_order_id"),
        "d.number",
        "d.status",
        "d.currency",
        parse_gmt("d.date_created_gmt").alias("date_created_gmt"),
        parse_gmt("d.date_modified_gmt").alias("date_modified_gmt"),
        "extracted_at",
        "_payload",
    )


def land_orders(docs: DataFrame) -> DataFrame:
    return order_rows(judged(docs, ORDER_FIELDS))


def judged_lines(orders: DataFrame) -> DataFrame:
    """One judged row per entry of ``line_items``; a null or absent list gives none."""
    lines = orders.select(
        "site_code", _id().alias("woo_order_id"), "extracted_at", F.explode("d.line_items").alias("_payload")
    )
    return judged(lines, "id")


def line_rows(rows: DataFrame) -> DataFrame:
    """Raw lines of judged entries."""
    return accepted(rows).select(
        "site_code", "woo_order_id", _id().alias("woo_order_item_id"), "extracted_at", "_payload"
    )


def land_order_items(docs: DataFrame) -> DataFrame:
    """One row per good entry of ``line_items`` of a good order; see ``line_rejects``."""
    return line_rows(judged_lines(accepted(judged(docs, LINE_FIELDS))))


def entity_rows(rows: DataFrame, id_column: str) -> DataFrame:
    """Raw products, customers or coupons of judged documents."""
    return accepted(rows).select(
        "site_code",
        _id().alias(id_column),
        parse_gmt("d.date_modified_gmt").alias("date_modified_gmt"),
        "extracted_at",
        "_payload",
    )


ENTITY_FIELDS = "id, date_modified_gmt"


def land_entity(docs: DataFrame, id_column: str) -> DataFrame:
    """Products, customers or coupons."""
    return entity_rows(judged(docs, ENTITY_FIELDS), id_column)


def land_refunds(docs: DataFrame) -> DataFrame:
    """Refund documents, each row also carrying its parent ``woo_order_id``."""
    return _promoted(docs, "id, date_created_gmt").select(
        "site_code",
        _id().alias("woo_refund_id"),
        "woo_order_id",
        parse_gmt("d.date_created_gmt").alias("date_created_gmt"),
        "extracted_at",
        "_payload",
    )


def orders_with_refunds(orders: DataFrame) -> DataFrame:
    """Orders whose refund summary is not empty: the only ones to ask further about."""
    listed = F.size(F.col("d.refunds")) > 0
    return _promoted(orders, "id, refunds array<string>").filter(F.coalesce(listed, F.lit(False))).drop("d")


def incremental_slice(
    df: DataFrame,
    watermark: Column,
    modified: str = "date_modified_gmt",
    overlap_seconds: int = OVERLAP_SECONDS,
    full_refresh: bool = False,
) -> DataFrame:
    """Rows modified after the watermark less the overlap; all rows when there is none."""
    if full_refresh:
        return df
    start = watermark - F.expr(f"interval {overlap_seconds} second")
    return df.filter(watermark.isNull() | (F.col(modified) > start))


def next_watermark(df: DataFrame, by: list[str], modified: str = "date_modified_gmt") -> DataFrame:
    """Highest modified time per key; a key without any time gives no row."""
    top = df.filter(F.col(modified).isNotNull()).groupBy(*by)
    return top.agg(F.max(modified).alias("watermark"))


def for_sites(df: DataFrame, sites: DataFrame, only: str | None = None) -> DataFrame:
    """Rows of active sites, or of one active site."""
    active = sites.filter("is_active").select("site_code")
    if only is not None:
        active = active.filter(F.col("site_code") == only)
    return df.join(active, "site_code", "left_semi")
