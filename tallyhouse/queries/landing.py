"""Landing, loads, state, streaming (S and R rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import MONEY
from tallyhouse.operators.joins import covered
from tallyhouse.queries import adapter
from tallyhouse.queries.registry import query
from tallyhouse.sources import cost_sheet, landing, loads, state
from tallyhouse.streaming.ingest import REJECT_SCHEMA, stream_documents, stream_entity, stream_orders, stream_rows

ORDER_ROW = "site_code:s woo_order_id:i number:s status:s currency:s date_created_gmt:t date_modified_gmt:t"
ORDER_ROW_SQL = """select site_code, k as woo_order_id, k as number, status, case when k % 13 <> 0 then lower(ccy) end as currency,
created as date_created_gmt, modified as date_modified_gmt from base_order"""


def documents(r) -> DataFrame:
    return adapter.order_documents(r.table).select("site_code", "extracted_at", "_payload")


@query("s1_land_orders", ORDER_ROW, ORDER_ROW_SQL)
def _(r):
    return landing.land_orders(documents(r))


def broken_documents(r) -> DataFrame:
    """Order documents: every fiftieth cut off, every seventy-seventh without its id, every
    eighty-third with an id that is no number."""
    docs = adapter.order_documents(r.table)
    k, text = F.col("woo_order_id"), F.col("_payload")
    cut = F.substring(text, F.lit(1), (F.length(text) - 2).cast("int"))
    bare = F.regexp_replace(text, r'^\{"id":"\d+",', "{")
    named = F.regexp_replace(text, r'^\{"id":"(\d+)"', '{"id":"nr. $1"')
    broken = F.when(k % 50 == 0, cut).when(k % 77 == 0, bare).when(k % 83 == 0, named).otherwise(text)
    return docs.select("site_code", "extracted_at", broken.alias("_payload"))


@query(
    "s1_land_orders_rejects",
    "site_code:s landed:i orders:i not_a_document:i no_id:i no_number:i",
    """select site_code, count(*) filter (where k % 50 <> 0 and k % 77 <> 0 and k % 83 <> 0) as landed,
count(*) filter (where k % 50 <> 0 and k % 77 <> 0 and k % 83 <> 0) as orders,
count(*) filter (where k % 50 = 0) as not_a_document, count(*) filter (where k % 50 <> 0 and k % 77 = 0) as no_id,
count(*) filter (where k % 50 <> 0 and k % 77 <> 0 and k % 83 = 0) as no_number from base_order group by 1""",
)
def _(r):
    """What lands and what is rejected, by reason, add up to all documents."""
    docs = broken_documents(r)
    counts = landing.landed_counts(docs).select("site_code", "landed")
    orders = landing.land_orders(docs).groupBy("site_code").agg(F.count("woo_order_id").alias("orders"))
    bad = landing.rejects(docs).groupBy("site_code").agg(
        F.count_if(F.col("reason") == "not a document").alias("not_a_document"), F.count_if(F.col("reason") == "no id").alias("no_id"),
        F.count_if(F.col("reason") == "id is no number").alias("no_number"))
    return counts.join(orders, "site_code", "left").join(bad, "site_code", "left").fillna(0)


def line_documents(r) -> DataFrame:
    """Order documents of one line each, with the line twice, once, or a null or absent list."""
    n = F.col("l_linenumber")
    item = F.struct(
        (F.col("l_partkey") * 10 + n).alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    again = F.struct(
        (F.col("l_partkey") * 10 + n + 5_000_000_000).alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.lit(1).alias("quantity"),
    )
    lines = F.when(n == 1, F.array(item, again)).when(n < 6, F.array(item)).when(n == 6, F.array().cast("array<struct<id:bigint,product_id:bigint,quantity:int>>"))
    doc = F.to_json(F.struct(F.col("l_orderkey").alias("id"), lines.alias("line_items")))
    return r.table("lineitem").select(adapter.site_of(F.col("l_orderkey")).alias("site_code"), adapter.stamp(), doc.alias("_payload"))


@query(
    "s2_land_order_items",
    "site_code:s woo_order_id:i woo_order_item_id:i quantity:i n:i",
    """select site_code, woo_order_id, woo_order_item_id, quantity, count(*) as n from (
select 'S' || (l_orderkey % 5) as site_code, l_orderkey as woo_order_id, l_partkey * 10 + l_linenumber as woo_order_item_id,
cast(l_quantity as int) as quantity from lineitem where l_linenumber < 6
union all
select 'S' || (l_orderkey % 5), l_orderkey, l_partkey * 10 + l_linenumber + 5000000000, 1 from lineitem where l_linenumber = 1)
group by all""",
)
def _(r):
    lines = landing.land_order_items(line_documents(r))
    quantity = F.get_json_object("_payload", "$.quantity").cast("int").alias("quantity")
    return lines.groupBy("site_code", "woo_order_id", "woo_order_item_id", quantity).agg(F.count(F.lit(1)).alias("n"))


def broken_line_documents(r) -> DataFrame:
    """The same documents with one more entry, in lines 2 to 5, that is no line with an id."""
    docs = line_documents(r)
    entry = F.when(F.col("n") == 2, '{"name":"x"}').when(F.col("n") == 3, '"junk"').when(F.col("n") == 4, "7").when(F.col("n") == 5, '{"id":"a1"}')
    more = docs.withColumn("n", F.get_json_object("_payload", "$.line_items[0].id").cast("bigint") % 10)
    more = more.filter("n between 2 and 5")
    text = F.replace(F.col("_payload"), F.lit('"line_items":['), F.concat(F.lit('"line_items":['), entry, F.lit(",")))
    return more.select("site_code", "extracted_at", text.alias("_payload"))


@query(
    "s2_land_order_items_rejects",
    "site_code:s reason:s n:i",
    """select 'S' || (l_orderkey % 5) as site_code, case when n = 2 then 'no id' when n = 5 then 'id is no number' when n > 5 then 'landed'
else 'not a document' end as reason, count(*) as n
from (select l_orderkey, unnest([n, 9]) as n from (select l_orderkey, (l_partkey * 10 + l_linenumber) % 10 as n from lineitem where l_linenumber between 2 and 5)) group by 1, 2""",
)
def _(r):
    """Good lines land beside bad entries of the same order; all of those are told."""
    docs = broken_line_documents(r)
    landed = landing.land_order_items(docs).select("site_code", F.lit("landed").alias("reason"))
    told = landing.line_rejects(docs).select("site_code", "reason")
    return landed.unionByName(told).groupBy("site_code", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s3_land_products",
    "site_code:s woo_product_id:i date_modified_gmt:t",
    """select site_code, product_id as woo_product_id, case when product_id % 3 <> 0 then first_seen end as date_modified_gmt
from stg_p""",
)
def _(r):
    return landing.land_entity(adapter.product_documents(r.table).drop("date_modified_gmt"), "woo_product_id")


@query(
    "s3_land_customers",
    "site_code:s woo_customer_id:i date_modified_gmt:t",
    """select 'S' || (c_custkey % 5) as site_code, c_custkey as woo_customer_id,
case when c_custkey % 4 <> 0 then timestamp '1999-01-01' + to_days(cast(c_custkey % 700 as int)) end as date_modified_gmt from customer""",
)
def _(r):
    k = F.col("c_custkey")
    day = F.date_add(F.lit("1999-01-01").cast("date"), (k % 700).cast("int")).cast("timestamp")
    doc = adapter.payload(id=k, email=F.concat("c_name", F.lit("@x.test")), date_modified_gmt=F.when(k % 4 != 0, adapter.iso(day)))
    docs = r.table("customer").select(adapter.site_of(k).alias("site_code"), adapter.stamp(), doc.alias("_payload"))
    return landing.land_entity(docs, "woo_customer_id")


@query(
    "s3_land_coupons",
    "site_code:s woo_coupon_id:i date_modified_gmt:t code:s",
    """select 'S' || (s_suppkey % 5) as site_code, s_suppkey as woo_coupon_id, timestamp '1998-06-01' + to_days(cast(s_suppkey % 90 as int)) as date_modified_gmt,
'OFF' || s_suppkey as code from supplier""",
)
def _(r):
    """Coupons as JSON lines laid out by site, read back from the files."""
    k = F.col("s_suppkey")
    day = F.date_add(F.lit("1998-06-01").cast("date"), (k % 90).cast("int")).cast("timestamp")
    doc = adapter.payload(id=k, code=F.concat(F.lit("OFF"), k.cast("string")), date_modified_gmt=adapter.iso(day))
    path = r.folder("coupons")
    r.table("supplier").select(adapter.site_of(k).alias("site_code"), doc.alias("value")).write.partitionBy("site_code").text(path)
    coupons = landing.land_entity(landing.read_landed(r.spark, path), "woo_coupon_id")
    return coupons.withColumn("code", F.get_json_object("_payload", "$.code"))


@query(
    "s4_land_refunds",
    "site_code:s woo_refund_id:i woo_order_id:i date_created_gmt:t",
    "select site_code, refund_id as woo_refund_id, k as woo_order_id, refunded_at as date_created_gmt from stg_r",
)
def _(r):
    docs = adapter.refund_documents(r.table).select("site_code", "woo_order_id", "extracted_at", "_payload")
    return landing.land_refunds(docs)


@query(
    "s5_orders_with_refunds",
    "site_code:s woo_order_id:i",
    "select site_code, k as woo_order_id from base_order where status = 'refunded'",
)
def _(r):
    return landing.orders_with_refunds(landing.land_orders(documents(r)))


# --- cost sheet --------------------------------------------------------------
SHEET_HEADERS = [
    "Date", "Status", "Project", "Order Code", "Product name", "Currency", "Country", "Shipping", "Típs/Coupon",
    "Total", "Fee", "CoGS", "Profit Margin", "Name", "Ship to",
]


def sheet_rows(r) -> DataFrame:
    """Sheet text from orders: a parent row with totals, then a child row with blanks.

    The file-order number puts the child right after its parent. Every ninth
    order has its second row under another site.
    """
    k, total = F.col("woo_order_id"), F.col("total")
    child = F.col("part") == 1
    orders = adapter.spread(r.table("orders"), "o_orderkey")
    rows = adapter.base_orders(orders).select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("part")
    )
    blank = F.lit("")
    other = F.concat(F.lit("S"), ((k + 1) % 5).cast("string"))
    code = F.when(k % 6 == 0, F.concat(k.cast("string"), F.lit("_1"))).when(
        k % 6 == 1, F.concat(k.cast("string"), F.lit(".0"))
    ).when(k % 15 == 2, blank).otherwise(k.cast("string"))
    pounds = F.concat(F.lit("£"), total.cast("string"))

    def once(c):
        return F.when(child, blank).otherwise(c)

    cells = {
        "Date": F.date_format("created", "MM/dd/yyyy"),
        "Status": F.col("status"),
        "Project": F.when((k % 9 == 0) & child, other).otherwise(F.col("site_code")),
        "Order Code": code,
        "Product name": F.concat(F.lit("Item, no. "), F.col("part").cast("string")),
        "Currency": once(F.col("ccy")),
        "Country": once(F.when(k % 10 == 0, F.lit("  ")).otherwise(F.lit("US"))),
        "Shipping": once(F.when(k % 8 == 0, F.lit("nan")).otherwise(F.lit("$1,008.09"))),
        "Típs/Coupon": once(F.concat(F.lit("($"), total.cast("string"), F.lit(")"))),
        "Total": once(pounds),
        # only the child row knows the fee
        "Fee": F.when(child, F.lit("£1.80")).otherwise(blank),
        "CoGS": once(F.concat(F.lit("-$"), total.cast("string"))),
        "Profit Margin": once(F.lit("43.57%")),
        "Name": F.lit("Jane"),
        "Ship to": F.lit("1 Street\nTown"),
    }
    return rows.select(
        *[c.alias(h) for h, c in cells.items()], (k * 2 + F.col("part")).alias(cost_sheet.ROW)
    )


SHEET_SPEC = (
    "site_code:s woo_order_id:i order_status:s order_date:d currency:s country:s csv_shipping_charged_src:m tips_coupon_src:m "
    "order_total_src:m fee_src:m cogs_usd:m csv_profit_margin:r"
)
# The child row of an order under another site is the first of its own key, so it
# is filled from the parent and keeps its own fee.
SHEET_SQL = """select case when part = 0 then site_code else 'S' || ((k + 1) % 5) end as site_code, k as woo_order_id,
status as order_status, order_date, ccy as currency, case when k % 10 <> 0 then 'US' end as country,
case when k % 8 <> 0 then 1008.09 end as csv_shipping_charged_src, -total as tips_coupon_src, total as order_total_src,
case when part = 1 then 1.80 end as fee_src, -total as cogs_usd, 0.4357 as csv_profit_margin
from base_order, range(2) p(part)
where k % 6 <> 0 and not (k % 6 <> 1 and k % 15 = 2) and (part = 0 or k % 9 = 0)"""


def write_sheet(r, *orders: list[str]) -> str:
    """The sheet as CSV files with a header line and two sub-header lines, a file to each
    partition of the rows as they come; both rows of an order stay together. Orders are
    dealt to as many exports as column orders are given."""
    rows = sheet_rows(r)
    path = r.folder("sheet")
    for i, headers in enumerate(orders):
        mine = rows.filter(F.pmod(F.shiftright(cost_sheet.ROW, 1), F.lit(len(orders))) == i)
        opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0        # the first row of a partition
        led = mine.withColumn("_opens", opens).withColumn(
            "_lead", F.explode(F.when(F.col("_opens"), F.array(F.lit(True), F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
        cells = [F.when(F.col("_lead"), "Items Information" if h == "Order Code" else "x").otherwise(F.col(f"`{h}`")).alias(h) for h in headers]
        led.select(*cells).write.mode("append").options(header=True, quote='"', escape='"').csv(path)
    return path


@query("s7_build_cost_rows", SHEET_SPEC, SHEET_SQL)
def _(r):
    return cost_sheet.build_cost_rows(sheet_rows(r))


@query(
    "s8_off_platform_codes",
    "order_code:s",
    "select distinct k || '_1' as order_code from base_order where k % 6 = 0",
)
def _(r):
    return cost_sheet.off_platform_codes(sheet_rows(r))


# --- idempotent loads --------------------------------------------------------


def existing_orders(r) -> DataFrame:
    o = adapter.base_orders(r.table("orders")).filter(F.col("status") != "pending")
    return o.select("site_code", "woo_order_id", F.lit("old").alias("status"), F.lit("2001-01-01").cast("timestamp").alias("extracted_at"))


def incoming_orders(r) -> DataFrame:
    """Halted orders once more, each twice: the later one wins."""
    o = adapter.base_orders(r.table("orders")).filter(~F.col("status").isin("completed", "processing"))
    twice = o.select("site_code", "woo_order_id", "status", F.explode(F.array(F.lit(1), F.lit(2))).alias("d"))
    stamp = F.date_add(F.lit("2002-01-01").cast("date"), F.col("d")).cast("timestamp")
    return twice.select(
        "site_code", "woo_order_id", F.concat("status", F.lit("-"), F.col("d").cast("string")).alias("status"), stamp.alias("extracted_at")
    )


@query(
    "s9_upsert_latest",
    "site_code:s woo_order_id:i status:s extracted_at:t",
    """select site_code, k as woo_order_id, case when status in ('completed', 'processing') then 'old' else status || '-2' end as status,
case when status in ('completed', 'processing') then timestamp '2001-01-01' else timestamp '2002-01-03' end as extracted_at
from base_order""",
)
def _(r):
    return loads.upsert_latest(existing_orders(r), incoming_orders(r), ["site_code", "woo_order_id"])


@query(
    "s10_snapshot_reload",
    "site_code:s woo_order_id:i order_total_src:m",
    "select site_code, k as woo_order_id, total as order_total_src from base_order where k % 20 <> 0",
)
def _(r):
    """Load everything, then reload without some rows: those are gone."""
    path = r.folder("snapshot")
    rows = adapter.base_orders(r.table("orders")).select("site_code", "woo_order_id", F.col("total").cast(MONEY).alias("order_total_src"))
    loads.snapshot_reload(rows, path)
    loads.snapshot_reload(rows.filter(F.col("woo_order_id") % 20 != 0), path)
    return loads.read_snapshot(r.spark, path)


@query(
    "s11_replace_children",
    "site_code:s woo_order_id:i n_lines:i n_new:i",
    """select 'S' || (l_orderkey % 5) as site_code, l_orderkey as woo_order_id,
count(*) as n_lines, count(*) filter (where status = 'refunded') as n_new
from lineitem join base_order on k = l_orderkey
where not (status = 'refunded' and l_linenumber > 3) and status <> 'cancelled' group by all""",
)
def _(r):
    """Refunded orders are pulled again without their later lines, cancelled ones without any."""
    o = adapter.base_orders(r.table("orders")).select("site_code", "woo_order_id", "status")
    lines = r.table("lineitem").select(
        adapter.site_of(F.col("l_orderkey")).alias("site_code"), F.col("l_orderkey").alias("woo_order_id"), "l_linenumber", F.lit(0).alias("fresh")
    )
    pulled = o.filter(F.col("status").isin("refunded", "cancelled"))
    again = covered(lines, pulled.filter(F.col("status") == "refunded"), ["site_code", "woo_order_id"])
    fresh = again.filter(F.col("l_linenumber") <= 3).withColumn("fresh", F.lit(1))
    now = loads.replace_children(lines, pulled, fresh, ["site_code", "woo_order_id"])
    return now.groupBy("site_code", "woo_order_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("fresh").alias("n_new"))


def event_rows(r) -> DataFrame:
    return r.table("events").select(
        adapter.site_of(F.col("user_id")).alias("site_code"), "event_id", F.col("ts").cast("timestamp").alias("date_modified_gmt"), "value"
    )


@query(
    "s12_incremental_slice",
    "site_code:s event_id:i date_modified_gmt:t",
    """select 'S' || (user_id % 5) as site_code, event_id, ts as date_modified_gmt from events
where ts > timestamp '2024-01-15 12:00:00' - interval 1 second""",
)
def _(r):
    return landing.incremental_slice(event_rows(r), F.lit("2024-01-15 12:00:00").cast("timestamp"))


@query(
    "s13_next_watermark",
    "site_code:s watermark:t",
    "select 'S' || (user_id % 5) as site_code, max(ts) as watermark from events where event_type <> 'error' group by 1",
)
def _(r):
    known = F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp"))
    rows = r.table("events").select(adapter.site_of(F.col("user_id")).alias("site_code"), known.alias("date_modified_gmt"))
    path = r.folder("state")
    state.advance_watermark(landing.next_watermark(rows.filter("date_modified_gmt < timestamp'2024-01-10'"), ["site_code"]), path, "events")
    state.advance_watermark(landing.next_watermark(rows, ["site_code"]), path, "events")
    return state.read_watermarks(r.spark, path)


@query(
    "s14_run_log",
    "pipeline_name:s site_code:s status:s rows_out:i error_text:s started:b ended:b",
    """select 'orders' as pipeline_name, s as site_code, case when s = 'S4' then 'failed' else 'success' end as status,
case when s = 'S4' then 0 else n end as rows_out, case when s = 'S4' then 'ValueError(''S4'')' end as error_text, true as started, true as ended
from (select 'S' || r_regionkey as s from region) join (select site_code as s, count(*) as n from base_order group by 1) using (s)""",
)
def _(r):
    """One run per site, whatever their number; that of S4 fails."""
    path = r.folder("runs")
    counts = adapter.base_orders(r.table("orders")).groupBy("site_code").agg(F.count(F.lit(1)).alias("n"))
    failed = F.col("site_code") == "S4"
    runs = counts.select(
        F.concat(F.lit("orders-"), "site_code").alias("run_id"), F.lit("orders").alias("pipeline_name"), "site_code",
        F.when(failed, "failed").otherwise("success").alias("status"), F.when(failed, 0).otherwise(F.col("n")).alias("rows_out"),
        F.when(failed, F.concat(F.lit("ValueError('"), "site_code", F.lit("')"))).alias("error_text"))
    started = runs.withColumns({"status": F.lit("running"), "rows_out": F.lit(None), "error_text": F.lit(None)})
    state.log_runs(started, path)
    state.log_runs(runs, path)
    return state.read_runs(r.spark, path).select(
        "pipeline_name", "site_code", "status", "rows_out", "error_text",
        F.col("start_ts").isNotNull().alias("started"), F.col("end_ts").isNotNull().alias("ended"),
    )


@query(
    "s16_seed_lookup",
    "country_code:s country_name:s region:s orders:i",
    """select country_code, s.country_name, s.region, count(*) as orders from stg_o
left join (select n_name, 'Nation ' || n_nationkey as country_name, r_name as region from nation join region on n_regionkey = r_regionkey
where n_nationkey % 7 <> 0) s on s.n_name = country group by all""",
)
def _(r):
    """The country seed written as CSV, read back by its schema, joined to the orders."""
    from tallyhouse.sources.seeds import read_seed

    path = r.folder("seed")
    r.wh.inputs.country_seed.write.option("header", True).csv(path)
    seed = read_seed(r.spark, "country_iso_map", path).groupBy("country_code").agg(
        F.max("country_name").alias("country_name"), F.max("region").alias("region")
    )
    counted = r.wh.stg_orders.groupBy(F.coalesce("billing_country_code", F.lit("XX")).alias("country_code")).agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(seed, "country_code", "left")


def seed_round(r, name: str, rows: DataFrame) -> DataFrame:
    """A seed written as CSV with its columns in reverse, and read back."""
    from tallyhouse.sources.seeds import read_seed

    path = r.folder("seed")
    rows.select(*rows.columns[::-1]).write.option("header", True).csv(path)
    return read_seed(r.spark, name, path)


@query(
    "s16_payment_fees",
    "payment_method:s fee_percent:m fixed_fee_usd:m orders:i",
    """select o_orderpriority as payment_method, case o_orderpriority when '1-URGENT' then 0.029 when '2-HIGH' then 0.019 end as fee_percent,
case o_orderpriority when '1-URGENT' then 0.3 when '2-HIGH' then 0.2 end as fixed_fee_usd, count(*) as orders from orders group by all""",
)
def _(r):
    """Active fee rows joined to the orders' methods."""
    fees = seed_round(r, "payment_fees", r.wh.inputs.fees).filter("is_active").select("payment_method", "fee_percent", "fixed_fee_usd")
    orders = r.table("orders").groupBy(F.col("o_orderpriority").alias("payment_method")).agg(F.count(F.lit(1)).alias("orders"))
    return orders.join(fees, "payment_method", "left")


@query(
    "s16_site_seed",
    "site_code:s site_name:s is_active:b",
    "select 'S' || r_regionkey as site_code, r_name as site_name, r_regionkey <> 4 as is_active from region",
)
def _(r):
    return seed_round(r, "dim_site_seed", r.wh.inputs.site_seed)


@query(
    "s16_supplier_seed",
    "supplier_code:s supplier_name:s sla_days:i is_active:b lines:i",
    """select 'V' || s_suppkey as supplier_code, s_name as supplier_name, s_suppkey % 9 + 1 as sla_days, s_suppkey % 6 <> 0 as is_active,
(select count(*) from lineitem where l_suppkey = s_suppkey) as lines from supplier""",
)
def _(r):
    k = F.col("s_suppkey")
    rows = r.table("supplier").select(
        F.concat(F.lit("V"), k.cast("string")).alias("supplier_code"), F.col("s_name").alias("supplier_name"), k.cast("string").alias("supplier_store_id"),
        (k % 9 + 1).alias("sla_days"), (k % 6 != 0).alias("is_active"))
    lines = r.table("lineitem").groupBy(F.col("l_suppkey").cast("string").alias("supplier_store_id")).agg(F.count(F.lit(1)).alias("lines"))
    return seed_round(r, "dim_supplier_seed", rows).join(lines, "supplier_store_id", "left").fillna(0, ["lines"])


@query(
    "s16_product_cogs",
    "sku:s cogs_usd:m quantity:i",
    """select 'SKU-' || p_partkey as sku, cast(p_retailprice * 0.4 as decimal(18,2)) as cogs_usd,
(select sum(l_quantity) from lineitem where l_partkey = p_partkey) as quantity from part where p_partkey % 5 <> 0""",
)
def _(r):
    """Unit costs of the active products beside what was sold of them."""
    k = F.col("p_partkey")
    cost = (F.col("p_retailprice").cast("decimal(18,2)") * F.lit("0.4").cast("decimal(2,1)")).cast("decimal(18,2)")
    rows = r.table("part").select(
        F.concat(F.lit("SKU-"), k.cast("string")).alias("product_sku"), cost.alias("cogs_usd"), F.lit("list").alias("source"), (k % 5 != 0).alias("is_active"))
    sold = r.table("lineitem").groupBy(F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("product_sku")).agg(F.sum("l_quantity").alias("quantity"))
    kept = seed_round(r, "product_cogs", rows).filter("is_active").join(sold, "product_sku", "left")
    return kept.withColumnRenamed("product_sku", "sku")


@query(
    "s16_utm_campaign_map",
    "channel_grouping:s is_paid:b events:i",
    """select case event_type when 'purchase' then 'Direct' when 'click' then 'Ads' else 'Other' end as channel_grouping,
event_type = 'click' as is_paid, count(*) as events from events group by all""",
)
def _(r):
    """Event types as campaigns, mapped to channels."""
    kind = F.col("event_type")
    rows = r.table("events").select(kind).distinct().select(
        F.lit("S0").alias("site_code"), kind.alias("utm_campaign"),
        F.when(kind == "purchase", "Direct").when(kind == "click", "Ads").otherwise("Other").alias("channel_grouping"), (kind == "click").alias("is_paid"))
    seed = seed_round(r, "utm_campaign_map", rows)
    met = r.table("events").join(seed, F.col("event_type") == F.col("utm_campaign"))
    return met.groupBy("channel_grouping", "is_paid").agg(F.count(F.lit(1)).alias("events"))


@query("s16_fx_rates", "currency:s month:d rate:m", "select lower(ccy) as currency, month, rate from fx_quote")
def _(r):
    rows = adapter.fx_quotes(r.spark, adapter.last_day(r.table)).filter(F.col("usd_rate").isNotNull())
    rows = rows.select(F.col("rate_date").alias("date"), "currency", "usd_rate", F.lit("list").alias("source"))
    return seed_round(r, "fx_rates", rows).select("currency", F.col("date").alias("month"), F.col("usd_rate").alias("rate"))


@query(
    "s17_active_sites",
    "site_code:s orders:i",
    "select site_code, count(*) as orders from base_order where site_code <> 'S4' group by 1",
)
def _(r):
    rows = adapter.base_orders(r.table("orders")).select("site_code")
    return landing.for_sites(rows, r.wh.inputs.site_seed).groupBy("site_code").agg(F.count(F.lit(1)).alias("orders"))


# --- streams -----------------------------------------------------------------

#: Rows to a landed file, at most; the number of files follows the input.
LANDED_ROWS = 100_000


@query(
    "s15_stream_products",
    "site_code:s woo_product_id:i date_modified_gmt:t",
    """select site_code, product_id as woo_product_id, case when product_id % 3 <> 0 then first_seen end as date_modified_gmt
from stg_p""",
)
def _(r):
    """Landed product files, a few per micro-batch, into a change log."""
    landed, log = r.folder("landed"), r.folder("log")
    adapter.product_documents(r.table).select("site_code", "extracted_at", "_payload").write.option("maxRecordsPerFile", LANDED_ROWS).parquet(landed)
    stream_rows(stream_documents(r.spark, landed, 2), r.folder("cp"), log, "woo_product_id")
    rows = loads.read_log(r.spark, log, "site_code string, woo_product_id bigint, date_modified_gmt timestamp, extracted_at timestamp, _payload string")
    return loads.current_rows(rows, ["site_code", "woo_product_id"])


@query("r1_stream_orders_repulled", ORDER_ROW, ORDER_ROW_SQL)
def _(r):
    """Two pulls of the same orders in one stream: the result is as after one."""
    landed = r.folder("landed")
    docs = documents(r)
    for _ in range(2):
        docs.write.option("maxRecordsPerFile", LANDED_ROWS).mode("append").parquet(landed)
    orders, items = r.folder("orders_log"), r.folder("items_log")
    stream_orders(stream_documents(r.spark, landed, 2), r.folder("cp"), orders, items)
    rows = loads.read_log(
        r.spark, orders,
        "site_code string, woo_order_id bigint, number string, status string, currency string, date_created_gmt timestamp, "
        "date_modified_gmt timestamp, extracted_at timestamp, _payload string",
    )
    return loads.current_rows(rows, ["site_code", "woo_order_id"])


@query(
    "r1_stream_rejects",
    "entity:s reason:s rows:i",
    """select 'order' as entity, case when k % 50 = 0 then 'not a document' when k % 77 = 0 then 'no id' when k % 83 = 0 then 'id is no number' else 'landed' end as reason,
count(*) as rows from base_order group by 1, 2
union all
select 'line', case when n = 2 then 'no id' when n = 5 then 'id is no number' when n > 5 then 'landed' else 'not a document' end, count(*)
from (select unnest([n, 9]) as n from (select (l_partkey * 10 + l_linenumber) % 10 as n from lineitem where l_linenumber between 2 and 5)) group by 1, 2
union all
select 'order of lines', 'landed', count(*) from lineitem where l_linenumber between 2 and 5""",
)
def _(r):
    """Orders and lines of which some are broken: rows and rejects of both in their logs."""
    landed, orders, items, bad = (r.folder(n) for n in ("landed", "orders_log", "items_log", "rejects"))
    source = broken_documents(r).withColumn("part", F.lit("order")).unionByName(broken_line_documents(r).withColumn("part", F.lit("order of lines")))
    source.select(F.concat("site_code", F.lit("/"), "part").alias("site_code"), "extracted_at", "_payload").write.option("maxRecordsPerFile", LANDED_ROWS).parquet(landed)
    stream_orders(stream_documents(r.spark, landed, 16), r.folder("cp"), orders, items, bad, most_rejects=0.6)
    part = F.substring_index("site_code", "/", -1)
    rows = loads.read_log(r.spark, orders, "site_code string, woo_order_id bigint").select(part.alias("entity"), F.lit("landed").alias("reason"))
    lines = loads.read_log(r.spark, items, "site_code string, woo_order_item_id bigint").select(F.lit("line").alias("entity"), F.lit("landed").alias("reason"))
    told = loads.read_log(r.spark, bad, REJECT_SCHEMA).select("entity", "reason")
    return rows.unionByName(lines).unionByName(told).groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "r2_stream_resumes",
    "resumed:b rows:i",
    "select true as resumed, count(*) as rows from events",
)
def _(r):
    """A second run of the stream takes only what landed since the first: all files are
    taken once, in as many batches as either run's files need."""
    landed, log, checkpoint = r.folder("landed"), r.folder("log"), r.folder("cp")
    schema = "site_code string, event_id bigint, date_modified_gmt timestamp, value double"
    rows = event_rows(r)
    early = F.col("date_modified_gmt") < F.lit("2024-01-20").cast("timestamp")
    batches, before = 0, 0
    for part in (rows.filter(early), rows.filter(~early)):
        part.write.option("maxRecordsPerFile", LANDED_ROWS).mode("append").parquet(landed)
        files = len(r.spark.read.parquet(landed).inputFiles())
        batches, before = batches + -(-(files - before) // 16), files
        stream_entity(stream_documents(r.spark, landed, 16, schema), checkpoint, {log: lambda b: b})
    taken = F.count_distinct("batch_id") == batches
    return loads.read_log(r.spark, log, schema).agg(taken.alias("resumed"), F.count(F.lit(1)).alias("rows"))


@query(
    "r3_stream_bounded_batches",
    "bounded:b rows:i",
    "select true as bounded, count(*) as rows from events",
)
def _(r):
    """At two files per batch there are half as many batches as files."""
    landed, log = r.folder("landed"), r.folder("log")
    schema = "site_code string, event_id bigint, date_modified_gmt timestamp, value double"
    event_rows(r).write.option("maxRecordsPerFile", LANDED_ROWS).parquet(landed)
    batches = -(-len(r.spark.read.parquet(landed).inputFiles()) // 2)
    stream_entity(stream_documents(r.spark, landed, 2, schema), r.folder("cp"), {log: lambda b: b})
    return loads.read_log(r.spark, log, schema).agg((F.count_distinct("batch_id") == batches).alias("bounded"), F.count(F.lit(1)).alias("rows"))


@query("r4_compacted_log", ORDER_ROW, ORDER_ROW_SQL)
def _(r):
    """Two batches of stale states, compacted (twice), and a last batch of the true ones."""
    log, kept = r.folder("log"), r.folder("compacted")
    orders = landing.land_orders(documents(r))
    keys = ["site_code", "woo_order_id"]
    loads.append_batch(orders.withColumn("status", F.lit("draft")), log, 0)
    loads.append_batch(orders.filter("woo_order_id % 3 = 0"), log, 1)
    for _ in range(2):
        loads.compact_log(loads.read_log(r.spark, log, orders.schema.toDDL()), keys, kept)
    loads.append_batch(orders.filter("woo_order_id % 3 <> 0"), kept, 2)
    return loads.current_rows(loads.read_log(r.spark, kept, orders.schema.toDDL()), keys)


@query("s6_read_cost_sheet", SHEET_SPEC, SHEET_SQL)
def _(r):
    """The sheet written as CSV files with sub-header lines and line breaks in cells,
    read back and built to cost rows."""
    path = write_sheet(r, SHEET_HEADERS)
    return cost_sheet.build_cost_rows(cost_sheet.read_cost_sheet(r.spark, path, SHEET_HEADERS))


@query("s6_read_cost_sheet_reordered", SHEET_SPEC, SHEET_SQL)
def _(r):
    """Two exports of the sheet with their columns in different orders."""
    path = write_sheet(r, SHEET_HEADERS, SHEET_HEADERS[::-1])
    return cost_sheet.build_cost_rows(cost_sheet.read_cost_sheet(r.spark, path, SHEET_HEADERS))
