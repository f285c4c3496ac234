"""The star in DuckDB SQL, straight from the given tables.

Shared by the comparison statements of the registered queries. Written against the
source columns, not against the Spark plans: there is no JSON here, for instance.
"""

from __future__ import annotations

SALT = "pepper"
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def sk(*parts: str) -> str:
    texts = ", ".join(f"coalesce(cast({p} as varchar), '{NULL_KEY}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def usd(amount: str, rate: str) -> str:
    return f"cast(round(cast({amount} as decimal(28,6)) * cast({rate} as decimal(10,4)), 6) as decimal(18,6))"


def share(amount: str, s: str) -> str:
    return f"cast(round({amount} * cast({s} as decimal(6,4)), 2) as decimal(18,2))"


def date_sk(d: str) -> str:
    return f"cast(strftime({d}, '%Y%m%d') as int)"


def ratio(a: str, b: str, digits: int = 6) -> str:
    return f"round(cast({a} as double) / nullif(cast({b} as double), 0), {digits})"


def alloc(amount: str) -> str:
    """An order amount spread over its lines by revenue, rounded half away in whole millionths."""
    n = (
        f"(cast(cast({amount} as decimal(28,6)) * cast(1000000 as decimal(7,0)) as hugeint)"
        " * cast(cast(line_revenue_usd as decimal(28,6)) * cast(1000000 as decimal(7,0)) as hugeint))"
    )
    d = "cast(cast(gross_product_revenue_usd as decimal(28,6)) * cast(1000000 as decimal(7,0)) as hugeint)"
    return f"(cast(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) as decimal(24,0)) * cast(0.000001 as decimal(7,6)))"


REVENUE = "('completed', 'processing', 'refunded')"

TABLES = {
    "fx_quote": """
select cast(date '1994-12-01' + to_months(cast(m as int)) as date) as month, m, ccy,
  case ccy
    when 'USD' then cast(1 as decimal(10,4))
    when 'EUR' then cast(1.05 as decimal(10,4)) + cast(0.003 as decimal(10,4)) * cast(m % 20 as int)
    when 'GBP' then cast(1.40 as decimal(10,4)) + cast(0.002 as decimal(10,4)) * cast(m % 30 as int)
    when 'CAD' then cast(0.70 as decimal(10,4)) + cast(0.001 as decimal(10,4)) * cast(m % 25 as int)
  end as rate
from (select unnest(range(0, datediff('month', date '1994-12-01', (select greatest(max(cast(o_orderdate as date)),
    (select max(cast(l_shipdate as date)) from lineitem)) from orders)) + 1)) as m), (values ('USD'), ('EUR'), ('GBP'), ('CAD')) v(ccy)
where not (ccy = 'CAD' and m < 13)""",
    "base_order": """
select o_orderkey as k, o_custkey, o_orderpriority, 'S' || (o_orderkey % 5) as site_code,
  case o_orderstatus when 'F' then 'completed' when 'O' then 'processing'
    else ['refunded', 'cancelled', 'failed', 'pending'][cast(o_orderkey % 4 as int) + 1] end as status,
  ['USD', 'EUR', 'GBP', 'CAD'][cast(o_custkey % 4 as int) + 1] as ccy,
  cast(o_totalprice as decimal(18,2)) as total,
  o_orderdate + to_seconds(o_orderkey % 86400) as created,
  o_orderdate + to_seconds(o_orderkey % 86400) + to_days(cast(o_orderkey % 40 as int)) as modified,
  cast(o_orderdate as date) as order_date
from orders""",
    "stg_o": f"""
select b.*, n_name as nation_name, c_name,
  site_code || '-' || k as order_natural_key,
  case when k % 89 <> 0 then o_orderpriority end as payment_method,
  'Pay by ' || o_orderpriority as payment_method_title,
  case when k % 101 <> 0 then n_name end as country,
  coalesce(case when k % 101 <> 0 then n_name end, 'XX') as country_code,
  case when k % 11 <> 0 then {share('total', '0.05')} end as shipping_src,
  {share('total', '0.01')} as discount_src,
  {share('total', '0.02')} as tax_src,
  case when k % 97 <> 0 and k % 103 <> 0 then sha256(lower(c_name || '@x.test') || '{SALT}') end as email_hash,
  (k % 97 = 0 or k % 103 = 0 or c_name is null) as is_unknown_email,
  case when k % 7 <> 0 and (k % 2 = 0 or k % 17 = 0) then {share('total', '0.03')} end as stripe_fee,
  case when k % 7 <> 0 and (k % 2 = 1 or k % 17 = 0) then {share('total', '0.02')} end as paypal_fee,
  case when k % 97 <> 0 and k % 103 <> 0 and c_name is not null then sha256(lower(c_name || '@x.test') || '{SALT}')
    else 'unknown:' || site_code || ':' || k end as customer_hash
from base_order b
left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey""",
    "line_base": """
select *, md5(txt) as h, ('0x' || substr(md5(txt), 1, 3))::int as bucket from (
select *, cast(l_extendedprice as decimal(18,2)) as price, cast(l_discount as decimal(6,2)) as disc,
  cast(l_tax as decimal(6,2)) as tax,
  concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as int),
    cast(l_extendedprice as decimal(18,2)), cast(l_discount as decimal(6,2)), cast(l_tax as decimal(6,2)),
    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d')) as txt
from lineitem)""",
    "stg_i": """
select 'S' || (l_orderkey % 5) as site_code, l_orderkey as k,
  row_number() over (partition by l_orderkey, bucket order by txt) * 4096 + bucket as item_id,
  l_partkey as product_id, 'Part ' || l_partkey as name, 'SKU-' || l_partkey as sku,
  cast(l_quantity as int) as quantity,
  cast(price * (1 + tax) as decimal(18,4)) as unit_price, price as subtotal,
  cast(price * (1 - disc) as decimal(18,4)) as total,
  ['S', 'M', 'L', 'XL'][cast(l_partkey % 4 as int) + 1] as size,
  ['Black', 'White', 'Navy'][cast(l_suppkey % 3 as int) + 1] as color,
  case when l_linenumber % 2 = 1 then 'Classic' end as style,
  cast(null as varchar) as fit_type,
  ['Back', 'Front', 'Both side'][cast(l_orderkey % 3 as int) + 1] as print_location
from line_base""",
    "stg_p": """
select 'S' || s as site_code, p_partkey as product_id, p_name as name,
  'https://shop.test/p/' || p_partkey as url, 'SKU-' || p_partkey as sku,
  date '1994-01-01' + cast(p_partkey % 365 as int) as first_seen,
  case when p_partkey % 3 <> 0 then date '1994-01-01' + cast(p_partkey % 365 as int) else date '2001-01-01' end as last_seen
from part, range(5) t(s) where p_partkey % 50 <> 0""",
    "stg_r": """
select b.site_code, b.k, b.k * 10 + 1 as refund_id,
  cast(sum(cast(price * (1 - disc) as decimal(18,4))) * (case when b.k % 8 = 0 then 3 else 1 end) as decimal(18,4)) as amount,
  case when b.k % 2 = 0 then 'damaged' end as reason,
  cast(max(l_shipdate) as date) as refund_date, max(l_shipdate) as refunded_at
from base_order b join line_base on l_orderkey = b.k
where l_returnflag = 'R' and b.status in ('refunded', 'cancelled')
group by b.site_code, b.k""",
    "stg_c": f"""
select site_code, case when twin then -k - 1 else k end as k, status, order_date, lower(ccy) as ccy,
  case when k % 19 = 0 then 0 when k % 23 <> 0 then {share('total', '0.40')} end as cogs_usd,
  case when k % 29 <> 0 then {share('total', '0.02')} end as design_fee_usd,
  case when k % 9 <> 0 then {share('total', '0.025')} end as fee_src,
  {share('total', '0.05')} + (case when k % 6 = 0 then 1 else 0 end) as ship_src,
  {share('total', '0.95')} as revenue_observed,
  {share('total', '0.5')} as profit_observed
from base_order, (values (false), (true)) v(twin)
where k % 20 <> 0 and (not twin or k % 50 = 1)""",
    "f_order": f"""
select o.*, {sk('o.site_code', 'o.k')} as order_sk, {sk('o.site_code')} as site_sk,
  {date_sk('o.order_date')} as date_sk, {sk('o.customer_hash')} as customer_sk,
  {sk('o.country_code')} as country_sk, {sk("coalesce(o.payment_method, 'unknown')")} as payment_method_sk,
  coalesce(q.rate, 1) as fx_rate,
  {usd('o.total', 'coalesce(q.rate, 1)')} as order_total_usd,
  {usd('o.shipping_src', 'coalesce(q.rate, 1)')} as shipping_usd,
  {usd('o.discount_src', 'coalesce(q.rate, 1)')} as discount_usd,
  {usd('o.tax_src', 'coalesce(q.rate, 1)')} as tax_usd,
  case when o.stripe_fee is not null then {usd('o.stripe_fee', 'coalesce(q.rate, 1)')}
       when o.paypal_fee is not null then cast(o.paypal_fee as decimal(18,6))
       when o.payment_method = '1-URGENT' then
         cast(round(cast(o.total as decimal(18,2)) * cast(coalesce(q.rate, 1) as decimal(6,4)) * cast(0.029 as decimal(4,3)) + cast(0.30 as decimal(4,2)), 6) as decimal(18,6))
       when o.payment_method = '2-HIGH' then
         cast(round(cast(o.total as decimal(18,2)) * cast(coalesce(q.rate, 1) as decimal(6,4)) * cast(0.019 as decimal(4,3)) + cast(0.20 as decimal(4,2)), 6) as decimal(18,6))
  end as payment_fee_usd,
  case when o.stripe_fee is not null or o.paypal_fee is not null then 'plugin_parser'
       when o.payment_method in ('1-URGENT', '2-HIGH') then 'seed_estimate' else 'missing' end as fee_source
from stg_o o left join fx_quote q on q.ccy = o.ccy and q.month = date_trunc('month', o.order_date)""",
    "f_item": f"""
select i.*, {sk('i.site_code', 'i.k', 'i.item_id')} as order_item_sk, f.order_sk, f.site_sk, f.date_sk,
  {sk('i.site_code', 'i.product_id')} as product_sk, f.country_sk, f.customer_sk, f.payment_method_sk,
  f.fx_rate, {usd('i.total', 'f.fx_rate')} as line_revenue_usd, f.status,
  f.status in {REVENUE} as is_revenue_status
from stg_i i join f_order f on f.k = i.k""",
    "f_refund": f"""
select r.*, {sk('r.site_code', 'r.refund_id')} as refund_sk, f.order_sk, f.site_sk,
  f.country_sk, f.customer_sk, f.payment_method_sk, {date_sk('r.refund_date')} as date_sk,
  {usd('r.amount', 'coalesce(q.rate, 1)')} as refund_usd,
  case when f.status in ('cancelled', 'failed') then 'cancellation' else 'refund' end as event_type
from stg_r r join f_order f on f.k = r.k
left join fx_quote q on q.ccy = f.ccy and q.month = date_trunc('month', r.refund_date)""",
    "f_cost": f"""
select c.*, f.order_sk, f.site_sk, f.date_sk, f.country_sk, f.customer_sk, f.payment_method_sk,
  {usd('c.fee_src', 'coalesce(q.rate, 1)')} as fee_fallback_usd,
  {usd('c.ship_src', 'coalesce(q.rate, 1)')} as sheet_ship_usd
from stg_c c join f_order f on f.k = c.k and f.site_code = c.site_code
left join fx_quote q on q.ccy = upper(c.ccy) and q.month = date_trunc('month', f.order_date)""",
    "per_order_rev": """
select k, sum(line_revenue_usd) as product_usd from f_item where is_revenue_status group by k""",
    "per_order_refund": """
select k, sum(refund_usd) as refunds_usd from f_refund group by k""",
    "m_order": """
select *, case when net <> 0 then round(cast(profit as double) / cast(net as double), 6) end as margin from (
select *, net - coalesce(cogs_usd, 0) - coalesce(design_fee_usd, 0) - fee as profit from (
select *, gross - least(refunds, gross) as net, least(refunds, gross) as applied from (
select c.order_sk, c.site_sk, c.date_sk, c.country_sk, c.customer_sk, c.payment_method_sk, c.site_code, c.k,
  p.product_usd as gross_product_revenue_usd, coalesce(f.shipping_usd, 0) as shipping,
  p.product_usd + coalesce(f.shipping_usd, 0) as gross, coalesce(r.refunds_usd, 0) as refunds,
  c.cogs_usd, c.design_fee_usd, coalesce(f.payment_fee_usd, c.fee_fallback_usd, 0) as fee,
  f.fee_source, f.status, c.profit_observed, c.revenue_observed
from f_cost c join f_order f on f.k = c.k join per_order_rev p on p.k = c.k
left join per_order_refund r on r.k = c.k
where p.product_usd > 0)))""",
    "m_line": f"""
select i.*, m.gross_product_revenue_usd,
  {alloc('m.shipping')} as line_shipping, {alloc('m.applied')} as line_refund,
  line_revenue_usd + {alloc('m.shipping - m.applied')} as line_net,
  {alloc('coalesce(m.cogs_usd, 0)')} as line_cogs, {alloc('coalesce(m.design_fee_usd, 0)')} as line_design,
  {alloc('m.fee')} as line_fee,
  line_revenue_usd + {alloc('m.shipping - m.applied - coalesce(m.cogs_usd, 0) - coalesce(m.design_fee_usd, 0) - m.fee')} as line_profit
from f_item i join m_order m on m.k = i.k""",
    "cust_order": """
select f.k, f.customer_hash, f.customer_sk, f.site_code, f.country_code, f.order_date,
  greatest(coalesce(p.product_usd, 0) + (case when coalesce(p.product_usd, 0) > 0 then coalesce(f.shipping_usd, 0) else 0 end)
    - coalesce(r.refunds_usd, 0), 0) as order_revenue,
  m.profit as order_profit
from f_order f left join per_order_rev p on p.k = f.k left join per_order_refund r on r.k = f.k
left join m_order m on m.k = f.k""",
    "cust_site": """
select customer_hash, site_code from (
select customer_hash, site_code, row_number() over (partition by customer_hash order by count(*) desc, site_code) as rn
from cust_order group by customer_hash, site_code) where rn = 1""",
    "cust_country": """
select customer_hash, country_code from (
select customer_hash, country_code, row_number() over (partition by customer_hash order by count(*) desc, country_code) as rn
from cust_order group by customer_hash, country_code) where rn = 1""",
    "m_customer": f"""
select a.*, {sk('a.customer_hash')} as customer_sk, total_orders > 1 as is_repeat,
  cast(date_trunc('month', first_order_date) as date) as first_order_month,
  {sk('s.site_code')} as preferred_site_sk, {sk('t.country_code')} as preferred_country_sk,
  date_diff('day', last_order_date, (select max(order_date) from cust_order)) as days_since
from (select customer_hash, count(*) as total_orders, sum(order_revenue) as total_revenue, sum(order_profit) as total_profit,
  min(order_date) as first_order_date, max(order_date) as last_order_date from cust_order group by customer_hash) a
join cust_site s using (customer_hash) join cust_country t using (customer_hash)""",
    "m_people": """
select *, case when days_since < 90 then 'Active 0-3mo' when days_since < 180 then '3-6 mo'
    when days_since < 365 then '6-12 mo' else 'Lapsed 12+mo' end as recency_segment,
  case when total_revenue < 20 then '1. <$20' when total_revenue < 40 then '2. $20-40' when total_revenue < 75 then '3. $40-75'
    when total_revenue < 150 then '4. $75-150' else '5. $150+' end as clv_bucket,
  case when is_repeat then 'Repeat' else 'One-time' end as segment
from m_customer""",
    "d_country": f"""
select {sk('code')} as country_sk, code, coalesce(s.country_name, case when code = 'XX' then 'Unknown' else code end) as country_name,
  coalesce(s.region, 'Unknown') as region, s.currency
from (select country_code as code from stg_o union select n_name from nation where n_nationkey % 7 <> 0)
left join (select n_name, 'Nation ' || n_nationkey as country_name, r_name as region,
  ['USD', 'EUR', 'GBP', 'CAD'][n_nationkey % 4 + 1] as currency
  from nation join region on n_regionkey = r_regionkey where n_nationkey % 7 <> 0) s on s.n_name = code""",
    "d_product": f"""
select {sk('site_code', 'product_id')} as product_sk, {sk('site_code')} as site_sk, * from (
select site_code, product_id, name, url, 'simple' as product_type, sku, first_seen, last_seen from stg_p
union all
select site_code, product_id, case when product_id = 0 then '(deleted product)' else max(name) end, null, 'unknown', max(sku), null, null
from stg_i where product_id % 50 = 0 group by site_code, product_id)""",
    "prod_rev": """
select d.name as product_name, sum(line_revenue_usd) as revenue from f_item i join d_product d on d.product_sk = i.product_sk
where is_revenue_status group by d.name""",
    "prod_line": """
select d.name as product_name, sum(line_profit) as profit, sum(line_net) as net
from m_line i join d_product d on d.product_sk = i.product_sk group by d.name""",
    "country_rev": """
select d.country_name, sum(line_revenue_usd) as revenue from f_item i join d_country d on d.country_sk = i.country_sk
where is_revenue_status group by d.country_name""",
    "rev_set": """
select distinct k from f_item where is_revenue_status""",
    "sheet_text": """
select k, site_code, order_date, total, ccy, status,
  case when k % 4 = 0 then '$' || total when k % 4 = 1 then '($' || total || ')' when k % 4 = 2 then ' £-' || total || ' ' else 'nan' end as money_text,
  case when k % 5 = 0 then '' else cast(k % 200 - 100 as varchar) || '.25%' end as percent_text,
  case when k % 6 = 0 then k || '_1' when k % 6 = 1 then k || '.0' when k % 6 = 2 then k || '.5' when k % 6 = 3 then '1,' || k else cast(k as varchar) end as code_text,
  case when k % 7 = 0 then 'n/a' when k % 7 = 1 then '' else strftime(order_date, '%m/%d/%Y') end as date_text
from base_order""",
}
