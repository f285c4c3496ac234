from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.sources import cost_sheet
from tallyhouse.sources.cost_sheet import build_cost_rows, off_platform_codes, read_cost_sheet


def sheet(rows, data):
    headers = list(dict.fromkeys(k for d in data for k in d))
    schema = ", ".join(f"`{h}` string" for h in headers) + ", _row bigint"
    return rows([[*(d.get(h, "") for h in headers), i] for i, d in enumerate(data)], schema)


def built(rows, data):
    return build_cost_rows(sheet(rows, data)).collect()


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


HEADERS = ["Order Code", "Project", "Status", "Total"]


def test_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path, "april.csv", "Order Code,Project,Status,Total", "Items Information,,,", ",,,sum",
          '3310,KIEL,"Shi\npped",£7.25', "3311,KIEL,Shipped,£8.00")
    write(tmp_path, "may sheet.csv", "Total,Status,Order Code,Project", ",,Items Information,", "sum,,,", "£9.75,Packed,3312,OSLO")
    raw = read_cost_sheet(spark, str(tmp_path), HEADERS)
    assert raw.columns == [*HEADERS, cost_sheet.ROW]
    got = {r.woo_order_id: (r.site_code, r.order_status, r.order_total_src) for r in build_cost_rows(raw).collect()}
    assert got == {
        3310: ("KIEL", "Shi\npped", Decimal("7.25")), 3311: ("KIEL", "Shipped", Decimal("8")), 3312: ("OSLO", "Packed", Decimal("9.75")),
    }


def test_missing_column_is_empty_and_unknown_one_fails(spark, tmp_path):
    short, odd = tmp_path / "short", tmp_path / "odd"
    short.mkdir(), odd.mkdir()
    write(short, "a.csv", "Project,Order Code", "x,x", "x,x", "KIEL,3320")
    (row,) = read_cost_sheet(spark, str(short), HEADERS).collect()
    assert (row["Order Code"], row["Total"], row["Status"]) == ("3320", "", "")
    write(odd, "a.csv", "Project,Order Code,Surprise", "x,x,x", "x,x,x", "KIEL,3320,1")
    with pytest.raises(Exception, match="Surprise"):
        read_cost_sheet(spark, str(odd), HEADERS).collect()


def test_rows_keep_file_order(spark, tmp_path):
    for n, name in enumerate(("b.csv", "a.csv")):
        write(tmp_path, name, *[",".join(HEADERS)] * 3, *[f"{n}{i},KIEL,s,1" for i in range(4)])
    got = [r["Order Code"] for r in read_cost_sheet(spark, str(tmp_path), HEADERS).orderBy(cost_sheet.ROW).collect()]
    assert got == ["10", "11", "12", "13", "00", "01", "02", "03"]


def test_later_rows_of_an_order_inherit_nothing_back(rows):
    data = [
        {"Order Code": "5151", "Project": "OSLO", "Country": "NO", "Total": "€61.10", "Fee": "", "Date": "11/2/2021"},
        {"Order Code": "5152", "Project": "OSLO", "Country": "", "Total": "", "Fee": "", "Date": "11/3/2021"},
        {"Order Code": "5151", "Project": "OSLO", "Country": "SE", "Total": "€99.99", "Fee": "€2.02", "Date": "11/4/2021"},
    ]
    got = {r.woo_order_id: r for r in built(rows, data)}
    assert sorted(got) == [5151, 5152]
    first, other = got[5151], got[5152]
    assert (first.country, first.order_total_src, first.fee_src, first.order_date) == ("NO", Decimal("61.1"), None, date(2021, 11, 2))
    assert (other.country, other.order_total_src) == (None, None)


def test_only_plain_codes_build_rows(rows):
    data = [{"Project": p, "Order Code": c, "CoGS": "€1"} for p, c in (
        ("KIEL", "77-b"), ("KIEL", " 8080 "), ("", "sample/3"), ("KIEL", ""), ("OSLO", "Sum of page"), ("OSLO", "1" * 25))]
    assert [r.woo_order_id for r in built(rows, data)] == [8080]
    assert {r.order_code for r in off_platform_codes(sheet(rows, data)).collect()} == {"77-b", "Sum of page", "1" * 25}


def test_same_code_on_two_sites(rows):
    """The fill goes by code text alone; rows are kept per site."""
    data = [{"Project": p, "Order Code": "64", "Payout": v} for p, v in (("OSLO", "€3.30"), ("KIEL", ""), ("KIEL", "€4.40"))]
    assert {r.site_code: r.payout_src for r in built(rows, data)} == {"OSLO": Decimal("3.3"), "KIEL": Decimal("3.3")}


def test_each_column_is_parsed_by_its_class(rows):
    cells = {
        "Fee": ("€0.07", "fee_src", "0.07"), "Total": ("kr 1 204,5", None, None), "Design fee": ("($2.5)", "design_fee_usd", "-2.5"),
        "Profit": ("-$11", "csv_profit_observed_usd", "-11"), "ROI": ("-12.5%", "csv_roi", "-0.125"), "Profit Margin": ("8%", "csv_profit_margin", "0.08"),
        "Típs/Coupon": ("$0", "tips_coupon_src", "0"), "Revenue": ("$98,765,432,109,876.54", "csv_revenue_observed_usd", "98765432109876.54"),
        "Items Subtotal": ("0.00000049", "items_subtotal_src", "0.00000049"), "Shipping": ("free", "csv_shipping_charged_src", None),
    }
    (row,) = built(rows, [{"Project": "KIEL", "Order Code": "9", **{h: t for h, (t, *_) in cells.items()}}])
    for _, name, want in cells.values():
        if name:
            assert row[name] == (None if want is None else Decimal(want)), name
    assert row.order_total_src == Decimal("12045")      # blanks and commas are dropped


def test_amount_beyond_all_bounds_fails(rows):
    with pytest.raises(Exception):
        built(rows, [{"Project": "KIEL", "Order Code": "9", "Total": "9" * 40}])


def test_payload_has_no_personal_data(rows):
    data = [{"Phone": "+47 0", "Order Code": "12", "Ship to": "Pier 9", "Project": "OSLO", "Email": "q@q.test", "Fee": "€1", "Status": " ", "Name": "Q"}]
    assert [r._payload for r in built(rows, data)] == ['{"Order Code":"12","Project":"OSLO","Fee":"€1"}']
