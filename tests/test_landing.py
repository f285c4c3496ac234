import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import landing, loads, state
from tallyhouse.streaming.ingest import stream_documents, stream_entity, stream_orders, stream_rows

PARCEL = {
    "id": 31, "number": "N-31", "status": "processing", "currency": "NOK",
    "date_created_gmt": "2019-02-03T23:59:58", "date_modified_gmt": "2019-02-05T00:00:01Z",
    "line_items": [{"id": 310 + i, "product_id": 7 * i, "quantity": i} for i in (3, 1, 2)],
    "refunds": [{"id": 1, "total": "-0.40"}, {"id": 2, "total": "-1.60"}],
}
SCHEMA = "site_code string, extracted_at timestamp, _payload string"
PULLED = datetime(2019, 3, 1)


def docs(rows, *payloads, at=PULLED, site="OSLO"):
    return rows([(site, at, p if isinstance(p, str) else json.dumps(p)) for p in payloads], SCHEMA)


def test_promoted_fields(rows):
    (r,) = landing.land_orders(docs(rows, PARCEL)).collect()
    assert (r.site_code, r.woo_order_id, r.number, r.status, r.currency) == ("OSLO", 31, "N-31", "processing", "NOK")
    assert (r.date_created_gmt, r.date_modified_gmt) == (datetime(2019, 2, 3, 23, 59, 58), datetime(2019, 2, 5, 0, 0, 1))
    assert json.loads(r._payload) == PARCEL


def test_lines_are_exploded(rows):
    bare = [{"id": 40 + i, **x} for i, x in enumerate(({}, {"line_items": []}, {"line_items": None}))]
    got = landing.land_order_items(docs(rows, *bare, PARCEL)).collect()
    assert sorted((r.woo_order_id, r.woo_order_item_id) for r in got) == [(31, 311), (31, 312), (31, 313)]


def test_only_orders_with_refunds(rows):
    bare = [{"id": 40 + i, **x} for i, x in enumerate(({"refunds": None}, {}, {"refunds": []}))]
    raw = landing.land_orders(docs(rows, *bare, PARCEL))
    assert [r.woo_order_id for r in landing.orders_with_refunds(raw).collect()] == [31]


def test_bad_documents_are_told(rows):
    whole = json.dumps(PARCEL)
    mixed = docs(rows, PARCEL, whole[:-9], whole[:40], "", "[1]", '{"number": "no id"}', '{"id": null}', '{"id": "abc"}', '{"id": 1.5}', '{"id": "99999999999999999999"}')
    assert [r.woo_order_id for r in landing.land_orders(mixed).collect()] == [31]
    assert landing.land_order_items(mixed).count() == 3
    bad = {r._payload: r.reason for r in landing.rejects(mixed).collect()}
    assert len(bad) == 9 and {bad[x] for x in bad if '"id": ' in x and x != '{"id": null}' and len(x) < 40} == {"id is no number"}
    assert bad['{"id": null}'] == bad['{"number": "no id"}'] == "no id" and bad[whole[:40]] == "not a document"
    (n,) = landing.landed_counts(mixed).collect()
    assert (n.landed, n.rejected) == (1, 9)
    landing.assert_few_rejects(mixed, 0.9)
    with pytest.raises(ValueError, match="9 of 10"):
        landing.assert_few_rejects(mixed, 0.5)


def test_bad_lines_are_told(rows):
    good = {"id": 3, "quantity": 1}
    mixed = docs(rows, {"id": 1, "line_items": [{"name": "x"}, "junk", 7, good, None, {"id": "b"}, [1], {"id": 4}]}, {"id": 2, "line_items": "none"}, {"id": "x", "line_items": [good]})
    got = landing.land_order_items(mixed).collect()
    assert sorted((r.woo_order_id, r.woo_order_item_id) for r in got) == [(1, 3), (1, 4)]
    told = landing.line_rejects(mixed).collect()
    assert {r.woo_order_id for r in told} == {1}
    assert sorted(r.reason for r in told) == ["id is no number", "no id", "not a document", "not a document", "not a document", "not a document"]


def test_stream_tells_what_it_rejects(spark, rows, tmp_path):
    landed, olog, ilog, bad, cp = (str(tmp_path / n) for n in ("landed", "orders", "items", "bad", "cp"))
    whole = json.dumps(PARCEL)
    docs(rows, PARCEL, *[{**PARCEL, "id": 100 + i} for i in range(96)], whole[:50], '{"id": "x"}', {"id": 5, "line_items": [{"id": 1}, "junk"]}).write.parquet(landed)
    stream_orders(stream_documents(spark, landed), cp, olog, ilog, bad, most_rejects=0.02)
    told = sorted((r.entity, r.woo_order_id, r.reason) for r in spark.read.parquet(bad).collect())
    assert told == [("line", 5, "not a document"), ("order", None, "id is no number"), ("order", None, "not a document")]
    assert spark.read.parquet(olog).count() == 98 and spark.read.parquet(ilog).count() == 97 * 3 + 1


def test_batch_with_too_many_rejects_does_not_commit(spark, rows, tmp_path):
    landed, log, bad, cp = (str(tmp_path / n) for n in ("landed", "log", "bad", "cp"))
    docs(rows, PARCEL, "{", "{", '{"id": 4}').write.parquet(landed)
    with pytest.raises(Exception, match="2 of 4 rows"):
        stream_rows(stream_documents(spark, landed), cp, log, "k", bad)
    assert not (tmp_path / "log").exists() and spark.read.parquet(bad).count() == 2
    assert not list((tmp_path / "cp" / "commits").glob("[0-9]*"))
    stream_rows(stream_documents(spark, landed), cp, log, "k", bad, most_rejects=0.5)      # looked at, and let through
    assert spark.read.parquet(log).count() == 2 and spark.read.parquet(bad).count() == 2


def test_landed_lines_are_read_by_site(spark, tmp_path):
    for site in ("KIEL", "OSLO"):
        (tmp_path / f"site_code={site}").mkdir()
        (tmp_path / f"site_code={site}" / "x.json").write_text(json.dumps({"id": 5}) + "\n" + json.dumps({"id": 6}) + "\n")
    got = landing.land_entity(landing.read_landed(spark, str(tmp_path)), "k").collect()
    assert sorted((r.site_code, r.k) for r in got) == [(s, k) for s in ("KIEL", "OSLO") for k in (5, 6)]


def test_watermark(rows):
    stamps = [None, datetime(2018, 5, 6, 7, 8, 9), datetime(2018, 5, 6, 7, 8, 11), datetime(2017, 1, 1)]
    df = rows([("KIEL", s) for s in stamps], "site_code string, date_modified_gmt timestamp")
    assert [r.watermark for r in landing.next_watermark(df, ["site_code"]).collect()] == [max(s for s in stamps if s)]
    assert landing.next_watermark(df.filter("date_modified_gmt is null"), ["site_code"]).isEmpty()
    mark = F.lit("2018-05-06 07:08:10").cast("timestamp")
    assert landing.incremental_slice(df, mark).count() == 1              # exactly the overlap back is out
    assert landing.incremental_slice(df, mark, overlap_seconds=2).count() == 2
    assert landing.incremental_slice(df, mark, full_refresh=True).count() == landing.incremental_slice(df, F.lit(None).cast("timestamp")).count() == 4


def test_upsert(rows):
    at = [datetime(2026, 1, d) for d in (1, 2, 3)]
    schema = "k int, v string, extracted_at timestamp"
    old = rows([(1, "a", at[0]), (2, "b", at[0])], schema)
    new = rows([(2, "c", at[1]), (2, "d", at[2]), (3, "e", at[1])], schema)
    once = loads.upsert_latest(old, new, ["k"])
    want = {1: "a", 2: "d", 3: "e"}
    assert {r.k: r.v for r in once.collect()} == want
    assert {r.k: r.v for r in loads.upsert_latest(once, new, ["k"]).collect()} == want


def test_upsert_of_bare_keys_keeps_existing(rows):
    old = rows([(1, "a")], "k int, v string")
    got = loads.upsert_latest(old, rows([(1,), (2,), (2,)], "k int"), ["k"])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, None)]


def test_replaced_children(rows):
    old = rows([(1, 10), (1, 11), (2, 20), (3, 30)], "k int, item int")
    pulled = rows([(1,), (2,)], "k int")
    got = loads.replace_children(old, pulled, rows([(1, 10)], "k int, item int"), ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 10), (3, 30)]


def test_snapshots(spark, rows, tmp_path):
    path = str(tmp_path / "snap")
    loads.snapshot_reload(rows([(1,), (2,)], "k int"), path)
    loads.snapshot_reload(rows([(2,)], "k int"), path)
    assert [r.k for r in loads.read_snapshot(spark, path).collect()] == [2]
    (tmp_path / "snap" / "v000000003").mkdir()                       # a load that never finished
    assert [r.k for r in loads.read_snapshot(spark, path).collect()] == [2]
    loads.snapshot_reload(rows([], "k int"), path)
    assert loads.read_snapshot(spark, path, "k int").count() == 0


def test_many_runs_in_one_write(spark, rows, tmp_path):
    path = str(tmp_path / "runs")
    runs = rows([("a", "p", "KIEL", "success", 3, None), ("b", "p", "OSLO", "failed", 0, "down")],
                "run_id string, pipeline_name string, site_code string, status string, rows_out bigint, error_text string")
    state.log_runs(runs.withColumn("status", F.lit("running")), path)
    state.log_runs(runs, path)
    got = {r.site_code: (r.status, r.rows_out, r.error_text, r.start_ts <= r.end_ts) for r in state.read_runs(spark, path).collect()}
    assert got == {"KIEL": ("success", 3, None, True), "OSLO": ("failed", 0, "down", True)}


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    with state.logged_run(spark, path, "p", "S1") as run:
        run["rows"] = 5
    try:
        with state.logged_run(spark, path, "p", "S2"):
            raise RuntimeError("no")
    except RuntimeError:
        pass
    got = {r.site_code: (r.status, r.rows_out, r.error_text) for r in state.read_runs(spark, path).collect()}
    assert got == {"S1": ("success", 5, None), "S2": ("failed", 0, "RuntimeError('no')")}


def test_stream_replaces_removed_lines(spark, rows, tmp_path):
    landed, olog, ilog, cp = (str(tmp_path / n) for n in ("landed", "orders", "items", "cp"))
    emptied = {"id": 32, "line_items": [{"id": 320}]}
    again = {**PARCEL, "status": "refunded", "line_items": PARCEL["line_items"][1:2]}
    pulls = {datetime(2019, 3, 1): (emptied, PARCEL), datetime(2019, 3, 4): (again, {**emptied, "line_items": []})}
    for at, batch in pulls.items():
        docs(rows, *batch, at=at).write.mode("append").parquet(landed)
        stream_orders(stream_documents(spark, landed), cp, olog, ilog)
    orders = loads.read_log(
        spark, olog,
        "site_code string, woo_order_id bigint, number string, status string, currency string, date_created_gmt timestamp, date_modified_gmt timestamp, extracted_at timestamp, _payload string",
    )
    items = loads.read_log(spark, ilog, "site_code string, woo_order_id bigint, woo_order_item_id bigint, extracted_at timestamp, _payload string")
    now = loads.current_rows(orders, ["site_code", "woo_order_id"])
    assert {r.woo_order_id: r.status for r in now.collect()} == {31: "refunded", 32: None}
    live = loads.current_children(items, orders, ["site_code", "woo_order_id"], ["site_code", "woo_order_id", "woo_order_item_id"])
    assert [(r.woo_order_id, r.woo_order_item_id) for r in live.collect()] == [(31, 311)]


def test_failed_batch_is_repeated(spark, rows, tmp_path):
    landed, log, cp = (str(tmp_path / n) for n in ("landed", "log", "cp"))
    docs(rows, PARCEL).write.parquet(landed)

    def broken(batch):
        raise RuntimeError("down")

    try:
        stream_entity(stream_documents(spark, landed), cp, {log: broken})
    except Exception:
        pass
    stream_entity(stream_documents(spark, landed), cp, {log: landing.land_orders})
    stream_entity(stream_documents(spark, landed), cp, {log: landing.land_orders})
    assert spark.read.parquet(log).count() == 1


def test_seed_columns_are_found_by_name(spark, tmp_path):
    from tallyhouse.sources.seeds import read_seed

    (tmp_path / "fees.csv").write_text("# terms\nis_active,source,extra,payment_method,fixed_fee_usd,fee_percent,country_code\ntrue,x,1,card,0.10,0.015,\n")
    (row,) = read_seed(spark, "payment_fees", str(tmp_path)).collect()
    assert (row.payment_method, float(row.fee_percent), float(row.fixed_fee_usd), row.country_code, row.is_active) == ("card", 0.015, 0.1, None, True)
    with pytest.raises(ValueError, match="usd_rate"):
        read_seed(spark, "fx_rates", str(tmp_path))


def test_compacted_log_reads_alike(spark, rows, tmp_path):
    log, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    schema = "k int, v string, extracted_at timestamp"
    for batch, data in enumerate(([(1, "a", PULLED), (2, "b", PULLED)], [(2, "c", PULLED)])):
        loads.append_batch(rows(data, schema), log, batch)
    for _ in range(2):
        loads.compact_log(loads.read_log(spark, log, schema), ["k"], kept)
        assert sorted((r.k, r.v, r.batch_id) for r in loads.read_log(spark, kept, schema).collect()) == [(1, "a", 0), (2, "c", 1)]
    loads.append_batch(rows([(1, "d", PULLED)], schema), kept, 2)
    assert sorted((r.k, r.v) for r in loads.current_rows(loads.read_log(spark, kept, schema), ["k"]).collect()) == [(1, "d"), (2, "c")]
