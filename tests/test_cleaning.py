import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.operators import cleaning as C


def _orders(spark, rows):
    return spark.createDataFrame(rows, ", ".join(
        ["order_id string", "seller_id string", "status string", "customer_id string",
         "region string", "total_amount double", "order_ts timestamp_ntz", "order_date date",
         "data_source string"]))


def _row(oid, amt, ts, src="app", seller="S001", status="completed"):
    return (oid, seller, status, "C1", "north", amt, ts, ts.date(), src)


T0 = dt.datetime(2023, 5, 1, 10, 0, 0)
T1 = T0 + dt.timedelta(hours=1)


def test_dedup_prefers_amount_then_latest(spark):
    df = _orders(spark, [
        _row("a", 10.0, T0), _row("a", None, T1),          # null amount loses although later
        _row("b", 10.0, T0), _row("b", 11.0, T1),          # later copy wins
        _row("c", 5.0, T0, "app"), _row("c", 5.0, T0, "web"),  # exact tie -> deterministic (app)
    ])
    got = {r["order_id"]: r for r in C.dedup_orders(df).collect()}
    assert len(got) == 3
    assert got["a"]["total_amount"] == 10.0
    assert got["b"]["total_amount"] == 11.0
    assert got["c"]["data_source"] == "app"


def test_dedup_hot_key_uses_partial_window_limit(spark):
    rows = [_row("hot", float(i + 1), T0 + dt.timedelta(seconds=i)) for i in range(2000)]
    rows += [_row(f"o{i}", 1.0, T0) for i in range(100)]
    df = _orders(spark, rows).repartition(8)
    out = C.dedup_orders(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    got = {r["order_id"]: r["total_amount"] for r in out.collect()}
    assert got["hot"] == 2000.0 and len(got) == 101


def test_window_filter_boundaries_and_amounts(spark):
    d0, d1 = dt.datetime(2022, 1, 1), dt.datetime(2024, 12, 31, 23, 59)
    df = _orders(spark, [_row("lo", 1.0, d0), _row("hi", 1.0, d1),
                         _row("before", 1.0, d0 - dt.timedelta(days=1)),
                         _row("zero", 0.0, T0), _row("neg", -3.0, T0), _row("null", None, T0)])
    kept = {r["order_id"] for r in C.valid_window_filter(df, "2022-01-01", "2024-12-31").collect()}
    assert kept == {"lo", "hi"}


def test_outlier_filter_inclusive_bounds_and_nulls(spark):
    df = _orders(spark, [_row("at_lo", 1.0, T0), _row("at_hi", 9.0, T0), _row("out", 9.01, T0),
                         _row("null", None, T0)])
    kept = {r["order_id"] for r in C.outlier_filter(df, 1.0, 9.0).collect()}
    assert kept == {"at_lo", "at_hi", "null"}


def _write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_app_feed_without_dup_field_and_bad_lines(spark, tmp_dir):
    root = os.path.join(tmp_dir, "feeds")
    _write_lines(os.path.join(root, "source=app"), [
        json.dumps({"oid": "1", "ts": 1682935200, "slr": "S001", "st": "done",
                    "usr": {"uid": "C1", "rgn": "west"}, "tot": 12.5}),
        json.dumps({"oid": "2", "ts": 1682935200, "slr": "S002", "st": "PAID", "usr": None, "tot": 3.0}),
        '{"oid": "3", "ts": 16829',                                 # truncated line
    ])
    from ordermart.sources.feeds import read_app_feed
    raw = read_app_feed(spark, root)
    parsed = {r["order_id"]: r for r in C.parse_app(raw).collect()}
    assert set(parsed) == {"1", "2"}                                # the broken line is no record
    assert parsed["1"]["status"] == "completed"
    assert parsed["1"]["customer_id"] == "C1" and parsed["1"]["region"] == "west"
    assert str(parsed["1"]["order_ts"]) == "2023-05-01 10:00:00"
    assert parsed["2"]["status"] == "unknown"
    assert parsed["2"]["customer_id"] is None and parsed["2"]["region"] is None


def test_web_feed_retry_and_unknown_customer(spark, tmp_dir):
    root = os.path.join(tmp_dir, "feeds")
    _write_lines(os.path.join(root, "source=web"), [
        json.dumps({"order_id": "9", "order_date": "2023-05-01T10:00:00+07:00", "seller_id": "S003",
                    "status": "cancel", "customer_id": None, "region": "east", "total_amount": 4.0,
                    "metadata": {"source": "web", "version": "2", "_retry": False}}),
        json.dumps({"order_id": "9", "order_date": "2023-05-01T10:00:00Z", "seller_id": "S003",
                    "status": "cancel", "customer_id": "C9", "region": "east", "total_amount": 4.0,
                    "metadata": {"source": "web", "version": "2", "_retry": True}}),
    ])
    from ordermart.sources.feeds import read_web_feed
    rows = C.parse_web(read_web_feed(spark, root)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["customer_id"] == "UNKNOWN" and r["status"] == "cancelled"
    assert str(r["order_ts"]) == "2023-05-01 10:00:00" and str(r["order_date"]) == "2023-05-01"


def test_seller_dim_rule(spark):
    rows = {r["seller_id"]: r for r in C.seller_dim(spark, 200).collect()}
    assert len(rows) == 200
    assert rows["S001"]["seller_type"] == "high_performer" and rows["S001"]["seller_region"] == "north"
    assert rows["S060"]["seller_type"] == "high_performer"
    assert rows["S061"]["seller_type"] == "average_seller"
    assert rows["S160"]["seller_type"] == "average_seller"
    assert rows["S161"]["seller_type"] == "low_performer"
    assert rows["S200"]["seller_region"] == "east"
    assert rows["S007"]["seller_region"] == "south"


def test_enrich_unknown_seller_and_region_fill(spark):
    df = _orders(spark, [("1", "S999", "completed", "C1", None, 1.0, T0, T0.date(), "app"),
                         ("2", "S002", "completed", "C1", None, 1.0, T0, T0.date(), "app"),
                         ("3", "S002", "completed", "C1", "west", 1.0, T0, T0.date(), "app")])
    out = C.enrich_sellers(df, C.seller_dim(spark), dim_rows=200)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    got = {r["order_id"]: r for r in out.collect()}
    assert got["1"]["seller_type"] is None and got["1"]["region"] is None
    assert got["2"]["region"] == "south" and got["2"]["seller_type"] == "high_performer"
    assert got["3"]["region"] == "west"


def test_enrich_skips_broadcast_above_bound(spark):
    df = _orders(spark, [_row("1", 1.0, T0)])
    out = C.enrich_sellers(df, C.seller_dim(spark), dim_rows=200, max_broadcast_rows=10)
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()


def test_processed_schema_columns(spark):
    assert schemas.PROCESSED_COLUMNS[-1] == "data_source"
    assert len(schemas.PROCESSED_COLUMNS) == 13


def test_ids_are_padded_but_never_cut(spark):
    from ordermart.functions import padded
    got = [r.p for r in spark.createDataFrame([(7,), (999999,), (1234561,), (1234562,)], "n long").select(padded(F.col("n"), 6).alias("p")).collect()]
    assert got == ["000007", "999999", "1234561", "1234562"]
    dim = C.seller_dim(spark, 1005)
    assert dim.select("seller_id").distinct().count() == 1005
    orders = spark.createDataFrame([(i, 1234561 + i % 4, "O", 10.0, dt.date(1996, 5, 1), "1-URGENT") for i in range(1, 41)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string")
    from ordermart.sources.feeds import fixture_raw
    assert fixture_raw(orders).where("cust is not null").select("cust").distinct().count() == 4


def test_quoted_and_float_text_numbers_survive(spark, tmp_dir):
    import json
    import os

    from ordermart.sources.feeds import read_app_feed, read_web_feed
    app = [{"oid": "1", "ts": "1682935200", "tot": "12.5"}, {"oid": "2", "ts": 1682935200.0, "tot": 3}, {"oid": "3", "ts": 1682935200, "tot": "x"}]
    web = [{"order_id": "4", "order_date": "2023-05-01T10:00:00Z", "total_amount": " 7.25 ", "metadata": {"source": "web"}}]
    for name, rows in (("app", app), ("web", web)):
        os.makedirs(os.path.join(tmp_dir, f"source={name}"))
        with open(os.path.join(tmp_dir, f"source={name}", "a.json"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
    raw_app, raw_web = read_app_feed(spark, tmp_dir), read_web_feed(spark, tmp_dir)
    got = {r.order_id: (r.total_amount, str(r.order_date)) for r in C.parse_app(raw_app).collect()}
    assert got == {"1": (12.5, "2023-05-01"), "2": (3.0, "2023-05-01"), "3": (None, "2023-05-01")}
    assert C.parse_web(raw_web).first().total_amount == 7.25
    assert {(r.data_source, r.field): r.n_unparsed for r in C.unparsed_numbers(raw_app, raw_web).collect()} == {
        ("app", "ts"): 0, ("app", "tot"): 1, ("web", "total_amount"): 0}
