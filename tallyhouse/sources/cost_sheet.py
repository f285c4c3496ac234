"""The hand-kept cost sheet: read, clean, forward-fill, one row per order."""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.clean import (
    CELL, clean_cell, drop_pii, fold_headers, parse_money, parse_order_code, parse_order_date, parse_percent,
)
from tallyhouse.operators.windows import ffill

ROW = "_row"

# The sheet's headers and the columns they land in.
ITEM_HEADERS = (
    "Date", "Day", "Month", "Year", "Status", "Project", "Order Code", "Product name", "Product URL", "Type",
)
ORDER_CURRENCY = {
    "Items Subtotal": "items_subtotal_src",
    "Shipping": "csv_shipping_charged_src",
    "Tips/Coupon": "tips_coupon_src",
    "Total": "order_total_src",
    "Fee": "fee_src",
    "Payout": "payout_src",
}
US_DOLLAR = {
    "CoGS": "cogs_usd",
    "Design fee": "design_fee_usd",
    "Revenue": "csv_revenue_observed_usd",
    "Profit": "csv_profit_observed_usd",
}
PERCENT = {"ROI": "csv_roi", "Profit Margin": "csv_profit_margin"}
CLASSES = ((ORDER_CURRENCY, parse_money), (US_DOLLAR, parse_money), (PERCENT, parse_percent))

SUB_HEADER_ROWS = 2
LINE_BITS = 33      # a row's number: file number, then line within the file


def read_cost_sheet(spark: SparkSession, path: str, headers: list[str]) -> DataFrame:
    """All-text rows in file order, without the two sub-header rows of each file.

    Columns are taken by each file's own header line, wherever they stand; a column
    that is missing is empty, one that is not in ``headers`` fails the read. Cells may
    hold line breaks, so a file is one task; a sheet export is bounded by what a
    spreadsheet holds, and many exports are read side by side. Files are numbered by
    path, from the file listing.
    """
    cells = [f"_c{i}" for i in range(len(headers) + 1)]     # one more, to see a file that is too wide
    reader = spark.read.schema(", ".join(f"{c} string" for c in cells))
    sheet = reader.options(header=False, multiLine=True, quote='"', escape='"', nullValue="\u0001", emptyValue="").csv(path)
    files = sorted(unquote(os.path.basename(f)) for f in sheet.inputFiles())
    if len(set(files)) < len(files):
        raise ValueError("files of one sheet need names of their own")
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_file string, _nr bigint")
    lines = sheet.select(
        F.array(*cells).alias("_cells"), F.url_decode(F.col("_metadata.file_name")).alias("_file"), F.monotonically_increasing_id().alias("_seq"))
    in_file = Window.partitionBy("_file").orderBy("_seq")
    whole = in_file.rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.select("*", F.row_number().over(in_file).alias("_line"), F.first("_cells").over(whole).alias("_head"))
    unknown = F.filter("_head", lambda c: c.isNotNull() & (c != "") & ~c.isin(*headers))
    checked = F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown columns in "), "_file", F.lit(": "), F.array_join(unknown, ", ")))).otherwise(F.col("_cells"))
    body = numbered.filter(F.col("_line") > 1 + SUB_HEADER_ROWS).withColumn("_cells", checked)

    def cell(header: str) -> Column:
        at = F.array_position("_head", header).cast("int")
        return F.coalesce(F.when(at > 0, F.element_at("_cells", at)), F.lit("")).alias(header)

    return body.join(numbers, "_file").select(
        *[cell(h) for h in headers], (F.shiftleft("_nr", LINE_BITS) + F.col("_line")).alias(ROW))


def classify_money(df: DataFrame) -> list:
    """The money and ratio columns of the sheet, each parsed by its class."""
    return [
        (parse(F.col(f"`{header}`")) if header in df.columns else F.lit(None).cast(CELL)).alias(name)
        for spec, parse in CLASSES
        for header, name in spec.items()
    ]


def _text(df: DataFrame, header: str):
    return clean_cell(F.col(f"`{header}`")) if header in df.columns else F.lit(None).cast("string")


def payload(df: DataFrame, headers: list[str]):
    """Cleaned cells as JSON; blank cells are left out."""
    return F.to_json(F.struct(*[clean_cell(F.col(f"`{h}`")).alias(h) for h in headers]))


def prepared(df: DataFrame) -> DataFrame:
    """Folded headers, no personal data."""
    return drop_pii(fold_headers(df))


def build_cost_rows(df: DataFrame, extracted_at=None) -> DataFrame:
    """Raw sheet rows (with a file-order number in ``_row``) to one row per order.

    Rows without a plain order code never reach the result and no other row is
    filled from them, so they are dropped before the fill: the blank code is the
    largest group of a sheet.
    """
    sheet = prepared(df)
    headers = [c for c in sheet.columns if c != ROW]
    coded = sheet.withColumn("woo_order_id", parse_order_code("`Order Code`")).filter(
        F.col("woo_order_id").isNotNull()
    )
    order_level = [h for h in headers if h not in ITEM_HEADERS]
    filled = ffill(coded, ["Order Code"], ROW, order_level, blank=r"^\s*$").fillna("", subset=order_level)
    with_site = filled.withColumn("site_code", _text(sheet, "Project")).filter(F.col("site_code").isNotNull())
    first = with_site.groupBy("site_code", "woo_order_id").agg(
        F.min_by(F.struct(*[F.col(f"`{h}`") for h in headers]), F.col(ROW)).alias("_first")
    )
    row = first.select("site_code", "woo_order_id", "_first.*")
    stamp = extracted_at if extracted_at is not None else F.current_timestamp()
    return row.select(
        "site_code",
        "woo_order_id",
        _text(row, "Status").alias("order_status"),
        (parse_order_date("Date") if "Date" in headers else F.lit(None).cast("date")).alias("order_date"),
        _text(row, "Currency").alias("currency"),
        _text(row, "Country").alias("country"),
        *classify_money(row),
        stamp.alias("extracted_at"),
        payload(row, headers).alias("_payload"),
    )


def off_platform_codes(df: DataFrame) -> DataFrame:
    """Codes that name no shop order though their row names a site, once each."""
    sheet = prepared(df)
    code, site = _text(sheet, "Order Code"), _text(sheet, "Project")
    kept = sheet.select(code.alias("order_code"), site.alias("site_code")).filter(
        F.col("order_code").isNotNull()
        & F.col("site_code").isNotNull()
        & parse_order_code("order_code").isNull()
    )
    return kept.select("order_code").distinct()
