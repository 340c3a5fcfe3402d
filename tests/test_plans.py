"""Physical-plan checks: broadcasts, pushdown, pruning, no Python in SQL-checked queries."""

import pytest

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dimension_join_is_broadcast(spark, sf):
    p = _formatted(E.queries()["join_zone"](spark, sf))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_timestamp_range_pushed_to_parquet(spark, sf):
    p = _formatted(E.queries()["filter_year"](spark, sf))
    assert "PushedFilters" in p and "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


def test_projection_pruned_at_scan(spark, sf):
    p = _formatted(E.queries()["company_by_hour"](spark, sf))
    scan = [line for line in p.splitlines() if "ReadSchema" in line]
    assert scan and "props" not in scan[0] and "user_id" not in scan[0]


@pytest.mark.parametrize("key", ["hourly_stats", "context_features", "correlation_matrix", "zone_heat_table",
                                 "weekly_lags", "forecast_ar", "metrics_compare", "attach_context"])
def test_no_python_in_sql_checked_queries(spark, sf, key):
    p = _formatted(E.queries()[key](spark, sf))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "MapInPandas" not in p
    assert "CartesianProduct" not in p


def test_partitioned_trips_prune_folders(spark, sf, tmpdir_path):
    from farelane.sources import adapters as ad
    from farelane.sources import readers as rd

    path = rd.write_trips_partitioned(ad.trips_li(spark, sf), f"{tmpdir_path}/trips")
    df = rd.read_trips_partitioned(spark, path, "1998-01-01", "1998-03-01")
    p = _formatted(df)
    assert "PartitionFilters" in p and "pickup_year" in p
    full = ad.trips_li(spark, sf)
    want = full.where("pickup_datetime >= '1998-01-01' AND pickup_datetime < '1998-03-01'").count()
    assert df.count() == want


def test_shuffle_partitions_sizing():
    from farelane.session import shuffle_partitions_for

    assert shuffle_partitions_for(100 * 10**12) > 300_000
    assert shuffle_partitions_for(10) == 8


def test_broadcast_bound_shrinks_with_row_width(spark):
    from farelane.session import BROADCAST_MAX_BYTES, broadcast_row_bound, join_small, row_bytes

    narrow = spark.range(10).selectExpr("id AS k")
    wide = spark.range(10).selectExpr("id AS k", *[f"CAST(id AS double) AS c{i}" for i in range(60)])
    assert row_bytes(wide) > row_bytes(narrow)
    assert broadcast_row_bound(wide) == BROADCAST_MAX_BYTES // row_bytes(wide) < broadcast_row_bound(narrow)
    big = spark.range(1000).selectExpr("id % 10 AS k")
    assert "BroadcastHashJoin" in _formatted(join_small(big, wide, ["k"]))
    # past the bound: a shuffle join, never a broadcast
    p = _formatted(join_small(big, wide, ["k"], max_rows=5))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
