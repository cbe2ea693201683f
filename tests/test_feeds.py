"""The derived feeds have the reference's two JSON-lines layouts."""

import json

from ordermart.operators import cleaning as C
from ordermart.sources import feeds
from tests.conftest import SF_SMALL


def _lines(spark, path):
    out = []
    for r in spark.read.text(path).collect():
        try:
            out.append(json.loads(r[0]))
        except ValueError:
            out.append(r[0])
    return out


def test_feed_layouts(spark):
    root = feeds.ensure_fixture_feeds(spark, SF_SMALL)
    app = _lines(spark, f"{root}/source=app")
    web = _lines(spark, f"{root}/source=web")
    broken = [x for x in app + web if isinstance(x, str)]
    wrong = [x for x in app + web if x not in broken and "maybe" in (x.get("_dup"), x.get("metadata", {}).get("_retry"))]
    assert len(broken) == 4 and len(wrong) == 2               # one for each 250 orders, three kinds
    app, web = ([x for x in rows if x not in broken and x not in wrong] for rows in (app, web))
    assert len(app) + len(web) == 1545                       # FIXTURES.md: raw rows at sf0.001
    app_keys = {"oid", "ts", "slr", "st", "usr", "tot", "items", "_dup"}
    web_keys = {"order_id", "order_date", "seller_id", "status", "customer_id", "region",
                "total_amount", "metadata"}
    assert all(set(r) <= app_keys and {"oid", "ts", "slr", "items"} <= set(r) for r in app)
    assert all(set(r) <= web_keys and {"order_id", "order_date", "metadata"} <= set(r) for r in web)
    flagged = [r for r in app if "_dup" in r]
    assert flagged and all(r["_dup"] is True for r in flagged)           # present only on copies
    assert {r["order_date"][19:] for r in web} == {"+07:00", "+08:00", "Z"}
    retried = [r for r in web if r["metadata"].get("_retry")]
    assert len(flagged) + len(retried) == 15                 # one flagged copy per 100 orders


def test_a_line_is_parsed_once(spark, tmp_dir):
    """Filters on parsed fields must not parse the line anew; broken and blank lines read as ever."""
    lines = ['{"oid":"1","ts":"0","slr":"S001","st":"done","usr":{"uid":"C1","rgn":"N"},"tot":"5.5"}', "  ", "no record",
             '{"oid":"2","_dup":true}', '{"oid":"3","_dup":"maybe"}', '{"oid":"4","_dup":false}', '{"oid":"4","_dup":false}', "null"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/source=app")
    raw = feeds.read_app_feed(spark, tmp_dir)
    parsed = C.parse_app(raw)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert sorted(r.order_id for r in parsed.select("order_id").collect()) == ["1", "4", "4"]
    assert raw.count() == 7 and raw.where("_corrupt_record IS NOT NULL").count() == 3       # blank lines are none
