"""Profit of orders with known figures, and conservation over lines."""

from decimal import Decimal as D

import pytest

from tallyhouse.plans import marts

# order, product, shipping, refunds, net, cogs, design, header fee, sheet fee, profit
GOLDEN = [
    (74030, "24.82", "8.09", None, "32.91", "15.21", "3.04", None, "1.80", "12.86"),
    (74062, "36.4283", "11.2814", None, "47.7097", "20.84", "6.09", None, "2.3571", "18.4226"),
    (73874, "6.12", "7.95", None, "14.07", "14.07", "0", None, "0.92", "-0.92"),
    (80673, "100.10", "21.29", "121.39", "0", "0", "0", "5.64", "9.99", "-5.64"),
    (137227, "48.08", "12.12", "62.60", "0", "21.98", "1.38", "2.305", None, "-25.665"),
]


def dec(x):
    return None if x is None else D(x)


@pytest.fixture
def tables(rows):
    key = "site_code string, woo_order_id bigint"
    m = "decimal(18,6)"
    fk = "order_sk string, site_sk string, date_sk int, country_sk string, customer_sk string, payment_method_sk string"
    cost = rows(
        [("S1", g[0], str(g[0]), "s", 20240101, "c", "u", "p", dec(g[5]), dec(g[6]), dec(g[8]), D(1), "order_only") for g in GOLDEN],
        f"{key}, {fk}, cogs_usd {m}, design_fee_usd {m}, payment_fee_fallback_usd {m}, cost_confidence {m}, cost_allocation_method string",
    )
    header = rows(
        [("S1", g[0], dec(g[2]), dec(g[7]), "missing", "completed") for g in GOLDEN],
        f"{key}, shipping_charged_usd {m}, payment_fee_usd {m}, payment_fee_source string, status string",
    )
    # two lines each, of one third and two thirds
    lines = []
    for g in GOLDEN:
        third = (D(g[1]) / 3).quantize(D("0.000001"))
        for i, part in enumerate((third, D(g[1]) - third)):
            lines.append(("S1", g[0], f"{g[0]}-{i}", str(g[0]), "s", 20240101, "prod", "c", "u", "p", "completed", i, 1, 1, part, True))
    items = rows(
        lines,
        f"{key}, order_item_sk string, order_sk string, site_sk string, date_sk int, product_sk string, country_sk string, customer_sk string, "
        f"payment_method_sk string, order_status string, woo_line_item_id bigint, woo_product_id bigint, quantity int, line_revenue_usd {m}, is_revenue_status boolean",
    )
    refunds = rows([("S1", g[0], dec(g[3])) for g in GOLDEN if g[3]], f"{key}, refund_amount_usd {m}")
    return cost, header, items, refunds


def test_golden_orders(tables):
    got = {r.woo_order_id: r for r in marts.mart_order_profit(*tables).collect()}
    for order, product, ship, refunds, net, cogs, design, _, _, profit in GOLDEN:
        r = got[order]
        assert (r.gross_product_revenue_usd, r.shipping_charged_usd) == (D(product), D(ship))
        assert (r.net_revenue_usd, r.contribution_profit_usd) == (D(net), D(profit))
        assert (r.profit_margin is None) == (D(net) == 0)


def test_lines_add_up_to_orders(tables):
    profit = marts.mart_order_profit(*tables)
    lines = marts.mart_product_profit(tables[2], profit).collect()
    for r in profit.collect():
        mine = [x for x in lines if x.woo_order_id == r.woo_order_id]
        assert abs(sum(x.line_profit_usd for x in mine) - r.contribution_profit_usd) <= D("0.000002")
        assert abs(sum(x.line_shipping_usd for x in mine) - r.shipping_charged_usd) <= D("0.000002")


def test_orders_without_revenue_are_out(tables, rows):
    from pyspark.sql import functions as F

    cost, header, items, refunds = tables
    none = items.withColumn("is_revenue_status", F.col("woo_order_id") != 74030)
    got = {r.woo_order_id for r in marts.mart_order_profit(cost, header, none, refunds).collect()}
    assert 74030 not in got and len(got) == 4
