"""The given tables seen as a shop: raw order, line, product, refund and cost rows.

Every rule is row-local and deterministic. ``oracle_tables`` states the same rules
in SQL, straight from the tables and without the JSON round trip.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators.joins import spread
from tallyhouse.operators.joins import rates_by_currency
from tallyhouse.plans.staging import PAYPAL_CURRENCY, PAYPAL_FEE, STRIPE_CURRENCY, STRIPE_FEE
from tallyhouse.plans.warehouse import Inputs
from tallyhouse.session import settle

SALT = "pepper"
EXTRACTED = "2002-01-01 00:00:00"
CURRENCIES = ("USD", "EUR", "GBP", "CAD")
FX_FIRST = "1994-12-01"
SITES = 5
ID_BUCKETS = 4096


def pick(index: Column, *labels: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index % len(labels) + 1).cast("int"))


def cents(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def part_of(x: Column, share: str) -> Column:
    return F.round(x * F.lit(share).cast("decimal(6,4)"), 2).cast("decimal(18,2)")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def site_of(order_key: Column) -> Column:
    return F.concat(F.lit("S"), (order_key % SITES).cast("string"))


def payload(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.cast("string").alias(n) if not n.startswith("_") else c.alias(n[1:]) for n, c in fields.items()]))


def stamp() -> Column:
    return F.lit(EXTRACTED).cast("timestamp").alias("extracted_at")


def base_orders(orders: DataFrame) -> DataFrame:
    """Orders with the derived shop columns, without any join."""
    k = F.col("o_orderkey")
    created = F.expr("cast(o_orderdate as timestamp) + make_dt_interval(0, 0, 0, o_orderkey % 86400)")
    halted = pick(k, "refunded", "cancelled", "failed", "pending")
    return orders.select(
        "o_custkey",
        "o_orderpriority",
        site_of(k).alias("site_code"),
        k.alias("woo_order_id"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "processing")
        .otherwise(halted)
        .alias("status"),
        pick(F.col("o_custkey"), *CURRENCIES).alias("ccy"),
        cents(F.col("o_totalprice")).alias("total"),
        created.alias("created"),
        (created + F.expr("make_dt_interval(cast(o_orderkey % 40 as int))")).alias("modified"),
    )


def order_documents(tables) -> DataFrame:
    """One order document per order, as the shop would send it."""
    customer = tables("customer").select("c_custkey", "c_name", "c_nationkey")
    nation = tables("nation").select("n_nationkey", "n_name")
    o = base_orders(spread(tables("orders"), "o_orderkey"))
    o = o.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    o = o.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k, total, ccy = F.col("woo_order_id"), F.col("total"), F.col("ccy")
    plugin = k % 7 != 0
    stripe = plugin & ((k % 2 == 0) | (k % 17 == 0))
    paypal = plugin & ((k % 2 == 1) | (k % 17 == 0))
    entries = {
        "_order_note": F.lit("n/a"),
        STRIPE_FEE: F.when(stripe, part_of(total, "0.03")).cast("string"),
        STRIPE_CURRENCY: F.when(stripe, F.lower(ccy)),
        PAYPAL_FEE: F.when(paypal, part_of(total, "0.02")).cast("string"),
        PAYPAL_CURRENCY: F.when(paypal, F.lit("usd")),
    }
    meta = F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in entries.items()])
    country = F.when(k % 101 != 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
    email = F.when(k % 97 == 0, None).when(k % 103 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@X.test "))
    )
    refunds = F.when(F.col("status") == "refunded", F.array(F.struct((k * 10 + 1).cast("string").alias("id"))))
    return o.select(
        "site_code",
        stamp(),
        payload(
            id=k,
            number=k,
            status=F.col("status"),
            currency=F.when(k % 13 != 0, F.lower(ccy)),
            date_created_gmt=iso(F.col("created")),
            date_modified_gmt=F.concat(iso(F.col("modified")), F.lit("Z")),
            total=total,
            shipping_total=F.when(k % 11 == 0, F.lit("")).otherwise(part_of(total, "0.05").cast("string")),
            discount_total=part_of(total, "0.01"),
            total_tax=part_of(total, "0.02"),
            payment_method=F.when(k % 89 != 0, F.col("o_orderpriority")),
            payment_method_title=F.concat(F.lit("Pay by "), F.col("o_orderpriority")),
            _billing=F.struct(country.alias("country"), email.alias("email")),
            _meta_data=meta,
            _refunds=refunds,
        ).alias("_payload"),
        k.alias("woo_order_id"), "status", "ccy", "created", "modified",
    )


def raw_orders(tables) -> DataFrame:
    """Landed order rows; the promoted columns are taken beside the document."""
    k = F.col("woo_order_id")
    return order_documents(tables).select(
        "site_code",
        "woo_order_id",
        k.cast("string").alias("number"),
        "status",
        F.coalesce(F.when(k % 13 != 0, F.lower("ccy")), "ccy").alias("currency"),
        F.col("created").alias("date_created_gmt"),
        F.col("modified").alias("date_modified_gmt"),
        "extracted_at",
        "_payload",
    )


def line_total() -> Column:
    price = cents(F.col("l_extendedprice"))
    return (price * (F.lit(1) - F.col("l_discount").cast("decimal(6,2)"))).cast("decimal(18,4)")


def line_text() -> Column:
    return F.concat_ws(
        "|",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("int"),
        cents(F.col("l_extendedprice")),
        F.col("l_discount").cast("decimal(6,2)"),
        F.col("l_tax").cast("decimal(6,2)"),
        "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date"),
    )


def with_line_id(lines: DataFrame) -> DataFrame:
    """A line id unique within the order: the table has no such column.

    Lines of an order are spread over buckets by their content and numbered inside
    a bucket, so even an order with very many lines is numbered by many tasks. A line
    alone in its bucket is the first there, so lines of orders without a crowded bucket are
    not moved: only keys are shuffled to find the crowded ones, written once, and then the
    lines of their orders. Orders are told apart before texts are hashed.
    """
    bucket = F.conv(F.substring(F.md5(line_text()), 1, 3), 16, 10).cast("int") % ID_BUCKETS
    pairs = lines.select("l_orderkey", bucket.alias("_bucket")).groupBy("l_orderkey", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    crowded = settle(pairs.filter(F.col("_n") > 1).select(F.col("l_orderkey").alias("_order")))
    here = F.col("l_orderkey").eqNullSafe(F.col("_order"))
    alone = lines.join(crowded, here, "left_anti").withColumn("_bucket", bucket)
    alone = alone.withColumn("line_id", (F.lit(1) * ID_BUCKETS + F.col("_bucket")).cast("bigint"))
    marked = lines.join(crowded, here, "left_semi").withColumn("_bucket", bucket)
    dealt = marked.repartition("l_orderkey", "_bucket").withColumn("_text", line_text())
    within = Window.partitionBy("l_orderkey", "_bucket").orderBy("_text")
    number = F.row_number().over(within).cast("bigint") * ID_BUCKETS + F.col("_bucket")
    several = dealt.withColumn("line_id", number).drop("_text")
    return alone.unionByName(several).drop("_bucket")


def item_document() -> Column:
    price = cents(F.col("l_extendedprice"))
    labels = {
        "Size": F.concat(pick(F.col("l_partkey"), "S", "M", "L", "XL"), F.lit(" | x | #ffffff")),
        "Color": F.concat(pick(F.col("l_suppkey"), "Black", "White", "Navy"), F.lit("|1")),
        "Style": F.when(F.col("l_linenumber") % 2 == 1, F.lit("Classic ")),
        "Fit Type": F.lit(" | none"),
        "Print on the": pick(F.col("l_orderkey"), "Back ($0.00)", "Front", "Both side (£5.95) (£5.95)"),
    }
    meta = F.array(*[F.struct(F.lit(n).alias("display_key"), v.alias("value")) for n, v in labels.items()])
    fields = {
        "product_id": F.col("l_partkey"),
        "name": F.concat(F.lit("Part "), F.col("l_partkey").cast("string")),
        "sku": F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")),
        "quantity": F.col("l_quantity").cast("int"),
        "price": (price * (F.lit(1) + F.col("l_tax").cast("decimal(6,2)"))).cast("decimal(18,4)"),
        "subtotal": price,
        "total": line_total(),
        "_meta_data": meta,
    }
    return payload(**fields)


def raw_order_items(tables) -> DataFrame:
    return with_line_id(tables("lineitem")).select(
        site_of(F.col("l_orderkey")).alias("site_code"),
        F.col("l_orderkey").alias("woo_order_id"),
        F.col("line_id").alias("woo_order_item_id"),
        stamp(),
        item_document().alias("_payload"),
    )


def product_documents(tables) -> DataFrame:
    k = F.col("p_partkey")
    seen = F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int")).cast("timestamp")
    sites = F.array(*[F.lit(f"S{i}") for i in range(SITES)])
    listed = spread(tables("part"), "p_partkey").filter(k % 50 != 0).select("p_partkey", "p_name", F.explode(sites).alias("site_code"))
    # Spark takes the listing for the few bytes its key has in the files of parts, once, not by
    # site: whatever it is joined to, it is sorted and merged, not sent to the driver.
    return listed.hint("merge").select(
        "site_code",
        k.alias("woo_product_id"),
        F.lit("2001-01-01").cast("timestamp").alias("date_modified_gmt"),
        stamp(),
        payload(
            id=k,
            name=F.col("p_name"),
            permalink=F.concat(F.lit("https://shop.test/p/"), k.cast("string")),
            type=F.lit("simple"),
            sku=F.concat(F.lit("SKU-"), k.cast("string")),
            status=F.lit("publish"),
            date_created_gmt=iso(seen),
            date_modified_gmt=F.when(k % 3 != 0, F.concat(iso(seen), F.lit("Z"))),
        ).alias("_payload"),
    )


def refund_documents(tables) -> DataFrame:
    """One refund per refunded or cancelled order with returned lines."""
    lines = tables("lineitem").filter(F.col("l_returnflag") == "R")
    returned = lines.groupBy(F.col("l_orderkey").alias("woo_order_id")).agg(
        F.sum(line_total()).cast("decimal(18,4)").alias("amount"), F.max("l_shipdate").alias("day")
    )
    stopped = base_orders(tables("orders")).filter(F.col("status").isin("refunded", "cancelled"))
    both = stopped.select("woo_order_id", "site_code").join(returned, "woo_order_id")
    k = F.col("woo_order_id")
    amount = F.when(k % 8 == 0, F.col("amount") * 3).otherwise(F.col("amount")).cast("decimal(18,4)")
    return both.select(
        "site_code",
        "woo_order_id",
        (k * 10 + 1).alias("woo_refund_id"),
        F.col("day").cast("timestamp").alias("date_created_gmt"),
        stamp(),
        payload(
            id=k * 10 + 1,
            amount=F.concat(F.when(k % 3 == 0, F.lit("-")).otherwise(F.lit("")), amount.cast("string")),
            reason=F.when(k % 2 == 0, F.lit(" damaged ")).otherwise(F.lit("  ")),
            date_created_gmt=iso(F.col("day")),
        ).alias("_payload"),
    )


def raw_refunds(tables) -> DataFrame:
    return refund_documents(tables)


def raw_cost(tables) -> DataFrame:
    """Landed sheet rows: most orders, and some ids no order has."""
    k, total = F.col("woo_order_id"), F.col("total")
    o = base_orders(tables("orders")).filter(k % 20 != 0)
    ids = F.when(k % 50 == 1, F.array(k, -k - 1)).otherwise(F.array(k))
    money = "decimal(18,6)"
    rows = o.select(
        "site_code",
        F.explode(ids).alias("_id"),
        F.col("status").alias("order_status"),
        F.col("created").cast("date").alias("order_date"),
        F.lower("ccy").alias("currency"),
        F.when(k % 19 == 0, F.lit(0)).when(k % 23 != 0, part_of(total, "0.40")).cast(money).alias("cogs_usd"),
        F.when(k % 29 != 0, part_of(total, "0.02")).cast(money).alias("design_fee_usd"),
        F.when(k % 9 != 0, part_of(total, "0.025")).cast(money).alias("fee_src"),
        (part_of(total, "0.05") + F.when(k % 6 == 0, 1).otherwise(0)).cast(money).alias("csv_shipping_charged_src"),
        part_of(total, "0.95").cast(money).alias("csv_revenue_observed_usd"),
        part_of(total, "0.5").cast(money).alias("csv_profit_observed_usd"),
        stamp(),
    )
    return rows.withColumnRenamed("_id", "woo_order_id")


def customer_documents(tables) -> DataFrame:
    k = F.col("c_custkey")
    return tables("customer").join(tables("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        site_of(k).alias("site_code"),
        k.alias("woo_customer_id"),
        stamp(),
        payload(
            id=k,
            email=F.when(k % 9 == 0, F.lit(" ")).otherwise(F.concat("c_name", F.lit("@x.test"))),
            _billing=F.struct(F.when(k % 8 != 0, F.lower("n_name")).otherwise(F.lit("")).alias("country")),
            date_created_gmt=F.lit("1994-05-06T07:08:09"),
        ).alias("_payload"),
    )


def coupon_documents(tables) -> DataFrame:
    """Coupons made of suppliers: a small list of the shop."""
    k = F.col("s_suppkey")
    return tables("supplier").select(
        site_of(k).alias("site_code"),
        k.alias("woo_coupon_id"),
        F.lit("2000-02-03 04:05:06").cast("timestamp").alias("date_modified_gmt"),
        stamp(),
        payload(
            id=k,
            code=F.when(k % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "s_name", F.lit(" "))),
            discount_type=F.when(k % 2 == 0, F.lit("percent")).otherwise(F.lit("fixed_cart")),
            amount=F.when(k % 5 == 0, F.lit("")).otherwise(cents(F.col("s_acctbal")).cast("string")),
            date_created_gmt=F.lit("1999-01-02T03:04:05Z"),
            date_modified_gmt=F.when(k % 3 == 0, F.lit("2001-01-01T00:00:00")),
        ).alias("_payload"),
    )


def last_day(tables) -> date:
    """The last day a rate can be asked for: of an order or of a returned line."""
    ends = [tables(t).agg(F.max(c).cast("date")).first()[0] for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return max([e for e in ends if e is not None], default=date.fromisoformat(FX_FIRST))


def fx_quotes(spark: SparkSession, until: date) -> DataFrame:
    """Month-start quotes by formula; Canadian dollars start in 1996."""
    m = F.col("m")

    def step(first: str, by: str, n: int) -> Column:
        return (F.lit(first).cast("decimal(10,4)") + F.lit(by).cast("decimal(10,4)") * (m % n)).cast("decimal(18,10)")

    rates = {
        "usd": F.lit(1).cast("decimal(18,10)"),
        "eur": step("1.05", "0.003", 20),
        "gbp": step("1.40", "0.002", 30),
        "cad": F.when(m >= 13, step("0.70", "0.001", 25)),
    }
    quotes = F.explode(F.array(*[F.struct(F.lit(c).alias("currency"), r.alias("usd_rate")) for c, r in rates.items()]))
    return (
        spark.range(max(0, (until.year - 1994) * 12 + until.month - 11))
        .select(F.col("id").cast("int").alias("m"))
        .select(F.add_months(F.lit(FX_FIRST).cast("date"), m).alias("rate_date"), quotes.alias("q"))
        .select("rate_date", "q.currency", "q.usd_rate")
    )


FEES = [
    ("1-URGENT", None, "0.0290", "0.30", "contract", True),
    ("2-HIGH", None, "0.0190", "0.20", "contract", True),
    ("3-MEDIUM", None, "0.0100", "0.00", "contract", False),
]


def fee_seed(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(FEES, "payment_method string, country_code string, fee_percent string, fixed_fee_usd string, source string, is_active boolean")
    return rows.withColumns({c: F.col(c).cast("decimal(18,6)") for c in ("fee_percent", "fixed_fee_usd")})


def country_seed(tables) -> DataFrame:
    """Nations by region; every seventh is left out, every country has an alias."""
    nation, region = tables("nation"), tables("region")
    both = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter(F.col("n_nationkey") % 7 != 0)
    source = F.explode(F.array(F.col("n_name"), F.concat(F.lit("ALT_"), F.col("n_name"))))
    return both.select(
        source.alias("source_country"),
        F.col("n_name").alias("country_code"),
        F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")).alias("country_name"),
        F.col("r_name").alias("region"),
        F.lower(pick(F.col("n_nationkey"), *CURRENCIES)).alias("currency"),
    )


def site_seed(tables) -> DataFrame:
    return tables("region").select(
        F.concat(F.lit("S"), F.col("r_regionkey").cast("string")).alias("site_code"),
        F.col("r_name").alias("site_name"),
        F.lit(None).cast("string").alias("domain"),
        F.lit("gbp").alias("default_currency"),
        F.lit("UTC").alias("timezone"),
        F.lit("Asia/Bangkok").alias("reporting_timezone"),
        (F.col("r_regionkey") != 4).alias("is_active"),
    )


def inputs(spark: SparkSession, tables) -> Inputs:
    until = last_day(tables)
    return Inputs(
        orders=raw_orders(tables),
        lines=lambda: raw_order_items(tables),
        products=product_documents(tables),
        refunds=raw_refunds(tables),
        cost_sheet=raw_cost(tables),
        fx=rates_by_currency(fx_quotes(spark, until), F.lit(until)),
        fees=fee_seed(spark),
        country_seed=country_seed(tables),
        site_seed=site_seed(tables),
        salt=SALT,
        customers=customer_documents(tables),
        coupons=coupon_documents(tables),
    )
