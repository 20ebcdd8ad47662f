"""Inputs are derived when asked for, from line rows joined once, with the rows of the plain joins."""
import datetime as dt
import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

TS = pa.timestamp("us")
DAYS = [dt.datetime(1996, 1, 31), dt.datetime(1999, 12, 31, 23, 59), dt.datetime(2000, 1, 1), None]


def _write(folder, name, columns, rows):
    table = pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(columns)})
    pq.write_table(table, f"{folder}/{name}.parquet")


@pytest.fixture
def sf(tmp_path):
    """Tables with NULL, missing and repeated keys."""
    L, I, S, D = pa.int64(), pa.int32(), pa.string(), pa.float64()
    _write(tmp_path, "region", [("r_regionkey", I), ("r_name", S)], [(0, "AFRICA"), (2, "ASIA"), (3, "EUROPE")])
    _write(tmp_path, "nation", [("n_nationkey", I), ("n_name", S), ("n_regionkey", I)],
           [(0, "ALGERIA", 0), (1, "INDIA", 2), (2, "FRANCE", 3), (2, "FRANCE", 3), (3, "NOWHERE", None)])
    _write(tmp_path, "customer", [("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)],
           [(1, "c#1", 0, 1.0, "MACHINERY"), (2, "c#2", 1, -5.0, None), (2, "c#2b", 2, 7.0, "BUILDING"), (None, "c", 0, 0.0, "FURNITURE"), (4, "c#4", 3, 0.0, "X")])
    _write(tmp_path, "supplier", [("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)],
           [(1, "s#1", 1, 1.0), (1, "s#1b", 2, 6000.0), (2, None, 0, -3.0), (None, "s", 0, 0.0)])
    _write(tmp_path, "part", [("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I), ("p_retailprice", D)], [])
    _write(tmp_path, "orders", [("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)],
           [(k, c, "F", 9.0, DAYS[(k or 0) % 4], p) for k, c, p in [(1, 1, "5-LOW"), (2, 2, None), (3, 2, "1-URGENT"), (3, 1, "5-LOW"), (4, 1, "2-HIGH"), (5, None, "5-LOW"), (None, 1, "5-LOW"), (7, 4, "5-LOW")]])
    lines = [(k, 1, s, n, 2.0 * n, 10.5, 0.1, 0.02, f, st, dt.datetime(2000, 2, 2))
             for n, (k, s, f, st) in enumerate([(1, 1, "N", "F"), (1, 2, "A", "F"), (2, 1, "A", "O"), (3, 1, "R", "F"), (3, 2, None, "O"), (4, 1, "R", None), (5, 1, "N", "F"), (None, 1, "N", "F"), (2, None, "N", "F"), (7, 1, "N", "F"), (9, 9, "N", "F")])]
    _write(tmp_path, "lineitem", [("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                                  ("l_discount", D), ("l_tax", D), ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)], lines)
    _write(tmp_path, "events", [("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)], [])
    return str(tmp_path)


@pytest.mark.parametrize("name", ["inbound_usage", "outbound_usage", "monthly_counts_history", "monthly_counts_live", "inbound_aggregate", "unique_roamers_daily"])
def test_rows_are_those_of_the_plain_joins(spark, sf, name):
    import compare
    from roamkit.sources import binding as B
    got = B.lazy_inputs(spark, sf)[name]
    cur = compare.duck(sf).execute("with " + ",\n".join(B.duck_ctes([name])) + f"\nselect * from {name}")
    want = compare.canon([d[0] for d in cur.description], cur.fetchall())
    assert want and compare.canon(got.columns, [tuple(r) for r in got.collect()]) == want


def test_a_query_derives_what_it_reads(spark, sf):
    from roamkit.plans import catalog
    from roamkit.sources import binding as B
    catalog.QUERIES["j07_snowflake_lookup"](spark, sf).collect()
    root = os.path.dirname(B.lazy_inputs(spark, sf).path("operator")).removeprefix("file:")
    assert sorted(os.listdir(root)) == ["country", "operator"]


def test_usage_tables_come_from_the_line_rows_without_a_shuffle(spark, sf):
    from roamkit.sources import binding as B
    t = B.lazy_inputs(spark, sf)
    for name in ("inbound_usage", "outbound_usage"):
        plan = t._derived(name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_shuffles_are_sized_by_the_source_files_and_set_back(spark, sf, monkeypatch):
    from roamkit.sources import binding as B
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(B, "_PARTITION_BYTES", 64)
    with B._sized_shuffles(spark, sf):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
