import json
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_build_reports_twice_with_ledger_snapshots(spark, tmp_path):
    from roamkit.config import Settings
    from roamkit.plans import catalog, daily
    from roamkit.sources.binding import inputs
    from roamkit.sources.tables import TableStore

    t = inputs(spark, SF)
    # Through the command-line path: a JSON map of input names to Parquet folders.
    from roamkit.sources.binding import input_paths
    needed = {i for _, ins in daily.REPORT_INPUTS.values() for i in ins} | {"crm_account", "operator", "country"}
    locations = {n: p for n, p in input_paths(spark, SF).items() if n in needed}
    spec = tmp_path / "tables.json"
    spec.write_text(json.dumps(locations))
    tables = daily.read_inputs(spark, json.loads(spec.read_text()))
    settings = Settings(alert=catalog.ALERT, valued=catalog.VALUED, steering=catalog.STEER,
                        deviation=catalog.DEV, monthly=catalog.MONTHLY, ledger_buckets=4)
    store = TableStore(spark, str(tmp_path / "out"))
    first = daily.build_reports(tables, store, settings, catalog.PREV_AS_OF)
    assert set(first) == set(daily.REPORT_INPUTS)
    n_first = first["c11"].count()
    second = daily.build_reports(tables, store, settings, catalog.AS_OF, only={"c11", "c04"})
    assert {"c11", "c04", "c01", "c02", "c03"} <= set(second)
    assert second["c11"].where(F.col("latest_flag") == "0").count() == n_first
    assert store.read("price_alert_prev").count() == n_first
    expected = catalog.QUERIES["c11_price_alert"](spark, SF)
    assert sorted(map(tuple, second["c11"].collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_settings_from_json():
    import datetime as dt

    from roamkit.config import Settings, settings_from
    got = settings_from(json.loads('{"alert": {"scan_days": 60, "excluded_home": ["A"]}, "valued": {"history_floor": "2020-01-02"}, "ledger_buckets": 7}'))
    assert (got.alert.scan_days, got.alert.excluded_home, got.valued.history_floor, got.ledger_buckets) == (60, ("A",), dt.date(2020, 1, 2), 7)
    assert got.steering == Settings().steering and settings_from({}) == Settings()
    with pytest.raises(ValueError):
        settings_from({"alert": {"scan_dayz": 1}})


def test_ledger_in_buckets_is_not_shuffled(spark, tmp_path):
    from roamkit.operators import sets as U
    from roamkit.sources.tables import TableStore
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = TableStore(spark, str(tmp_path / "s"))
        schema = "k int, d string, v int, latest_flag string"
        store.replace_bucketed(spark.createDataFrame([(k, "x", k, "1") for k in range(50)], schema), "ledger", ["k", "d"], 4)
        store.snapshot("ledger")
        spark.sql(f"drop table {store._ident(store.current_path('ledger'))}")  # as another session would find it
        prev = store.read_bucketed("ledger_prev", ["k", "d"], 4)
        new = spark.createDataFrame([(k, "x", -k) for k in range(45, 60)], "k int, d string, v int")
        merged = U.merge_ledger(new, prev, ["k", "d"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the new rows
        out = store.replace_bucketed(merged, "ledger", ["k", "d"], 4)
        assert out.count() == 60 and out.where("latest_flag = '1'").count() == 10
        store.replace(new, "plain")
        assert store.read_bucketed("plain", ["k"], 4).count() == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
