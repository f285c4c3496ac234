"""Small lookup tables, read with fixed schemas."""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMAS = {
    "country_iso_map": "source_country string, country_code string, country_name string, "
                       "region string, currency string",
    "dim_site_seed": "site_code string, site_name string, domain string, default_currency string, "
                     "timezone string, reporting_timezone string, is_active boolean",
    "payment_fees": "payment_method string, country_code string, fee_percent decimal(18,6), "
                    "fixed_fee_usd decimal(18,6), source string, is_active boolean",
    "dim_supplier_seed": "supplier_code string, supplier_name string, supplier_store_id string, "
                         "sla_days int, is_active boolean",
    "product_cogs": "product_sku string, cogs_usd decimal(18,6), source string, is_active boolean",
    "utm_campaign_map": "site_code string, utm_campaign string, channel_grouping string, is_paid boolean",
    "fx_rates": "date date, currency string, usd_rate decimal(18,10), source string",
}


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A seed CSV with a header line, ``#`` comments allowed.

    Columns are taken by name, wherever they stand; a missing one fails, others are
    left out. All files of a seed have the header of the first.
    """
    rows = spark.read.options(header=True, comment="#", enforceSchema=False).csv(path)
    wanted = [c.strip().split(" ", 1) for c in re.split(r",(?![^(]*\))", SEED_SCHEMAS[name])]
    missing = [c for c, _ in wanted if c not in rows.columns]
    if missing:
        raise ValueError(f"seed {name} lacks the columns {missing}")
    return rows.select(*[rows[c].cast(kind).alias(c) for c, kind in wanted])


def country_map(spark: SparkSession) -> DataFrame:
    """The country table shipped with the package.

    It is a file of the installed package, read on the driver (some sixty lines)
    because executors need not have the package on disk.
    """
    text = files("tallyhouse").joinpath("seeds/country_iso_map.csv").read_text("utf-8")
    lines = [line for line in text.splitlines() if line and not line.startswith("#")][1:]
    return spark.createDataFrame([line.split(",") for line in lines], SEED_SCHEMAS["country_iso_map"])
