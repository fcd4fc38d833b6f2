"""Plan shape: the scale properties the README claims, checked on the executed plan."""

from conftest import SF_SMALL
import __spark_entry__ as ent
from metroflux.plans.catalog import pipeline


def plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_staging_pushes_window_into_scan_and_limits_map_side(spark):
    p = plan(ent.queries()["stg_trips"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(event_id), GreaterThanOrEqual(ts,2024-01-01T00:00)" in p
    assert "LessThan(ts,2024-02-01T00:00)" in p
    # partial group limit before the exchange: copies are reduced map-side
    assert "row_number(), 1, Partial" in p and "row_number(), 1, Final" in p
    assert p.index("row_number(), 1, Partial") < p.index("row_number(), 1, Final")


def test_fact_streams_trips_through_broadcast_joins(spark):
    p = plan(pipeline(spark, SF_SMALL, assert_unique=True).fact_trips)
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert p.count("BroadcastHashJoin") >= 5
    # the only trip-sized exchange is the staging dedupe; no trip_id reshuffle
    assert "hashpartitioning(trip_id" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(ent.queries()["kpi"](spark, SF_SMALL))
    # trips read three of the six event columns
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in p


def test_planning_runs_no_job(spark):
    """Building a query starts no job but the file-schema reads of its tables."""
    tracker = spark.sparkContext.statusTracker()
    for name in ("fact_trips", "subway_impact", "demand_zone_hour", "kpi", "orders_star"):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        ent.queries()[name](spark, SF_SMALL)
        assert len(tracker.getJobIdsForGroup(f"plan-{name}")) <= 5, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_accepted_values_expand_no_rows(spark):
    from metroflux.operators import quality as dq
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "k int, v string")
    tests = [dq.Test("a", "m", "accepted_values", "v", ["a"]), dq.Test("b", "m", "accepted_values", "k", [1, 2, 3])]
    out = dq.run_suite({"m": df}, tests)
    assert "Expand" not in plan(out) and {r.test_name: r.failures for r in out.collect()} == {"a": 1, "b": 0}


def test_tables_are_rebalanced_before_the_write(spark):
    p = pipeline(spark, SF_SMALL)
    lines = plan(p.trip_metrics.hint("rebalance", "pickup_date"))
    assert "REBALANCE_PARTITIONS_BY_COL" in lines
