"""Files and copies that queries make on their way."""

import datetime as dt

from sluice.plans import catalog


def _events(spark, folder):
    rows = [(k, dt.datetime(2024, 1, 1 + k % 25, 10), k % 3, "view", 30.0 + k, None) for k in range(60)]
    rows.append(rows[7])
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")


def _orders(spark, folder):
    day = dt.datetime(1996, 3, 1)
    orders = [(k, k % 5, "OFP"[k % 3], 10.0 * k, day, "1-URGENT") for k in range(40)]
    lines = [(k // 3, k % 9, k % 4, k % 3, 2.0, 5.0, 0.03, 0.01, "NAR"[k % 3], "O", day + dt.timedelta(k)) for k in range(90)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")


def test_order_documents_are_compressed(spark, tmp_dir):
    _orders(spark, tmp_dir)
    got = catalog.q_orders_json_files(spark, tmp_dir)
    assert got.inputFiles() and all(f.endswith(".json.gz") for f in got.inputFiles())
    assert sorted(map(str, got.collect())) == sorted(map(str, catalog.q_order_headers(spark, tmp_dir).collect()))


def test_sessions_are_deduplicated_once_for_all_loads(spark, tmp_dir, monkeypatch):
    _events(spark, tmp_dir)
    sources = []
    add = catalog.add_sessions

    def spied(spark, batch, *paths):
        sources.append(batch.inputFiles())
        return add(spark, batch, *paths)

    monkeypatch.setattr(catalog, "add_sessions", spied)
    got = catalog.q_user_activity_refreshed(spark, tmp_dir)
    assert len(sources) == 3 and all(files and not any("events.parquet" in f for f in files) for files in sources)
    assert sorted(map(str, got.collect())) == sorted(map(str, catalog.q_user_activity(spark, tmp_dir).collect()))
