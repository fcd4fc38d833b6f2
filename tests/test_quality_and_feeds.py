import datetime as dt
import json

import pytest

from metroflux.operators import quality as dq
from metroflux.sources import json_feeds as jf


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert dq.require_columns(df, ["a"]) is df
    with pytest.raises(dq.SchemaValidationError):
        dq.require_columns(df, ["a", "c"])


def test_unique_and_accepted_ignore_null(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",), ("y",), ("y",), ("bad",)], "c string")
    assert dq.dq_unique(df, "c").collect()[0].c == "y"
    assert [r.c for r in dq.dq_accepted(df, "c", ["x", "y"]).collect()] == ["bad"]


@pytest.mark.parametrize("days,status", [(7, "pass"), (8, "warn"), (30, "warn"), (31, "error")])
def test_freshness_thresholds(spark, days, status):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t,)], "ts timestamp_ntz")
    asof = (t + dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")
    assert dq.dq_freshness(df, "ts", asof).first().status == status


def test_suite_runner_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "zz")], "k int, v string")
    tests = [dq.Test("nn", "m", "not_null", "v"), dq.Test("uq", "m", "unique", "k"),
             dq.Test("acc", "m", "accepted_values", "v", ["a"]),
             dq.Test("expr", "m", "expression", where="k > 1", severity="warn")]
    rep = {r.test_name: (r.failures, r.status) for r in dq.run_suite({"m": df}, tests).collect()}
    assert rep == {"nn": (1, "ERROR"), "uq": (1, "ERROR"), "acc": (1, "ERROR"), "expr": (1, "WARN")}


def _entity(i, routes, periods="default", header="h", cause="MAINTENANCE"):
    a = {"informed_entity": [{"route_id": r} for r in routes], "header_text": {"translation": [{"text": header}]},
         "effect": "DETOUR"}
    if cause is not None:
        a["cause"] = cause
    if periods == "default":
        a["active_period"] = [{"start": "100", "end": "200"}]
    elif periods is not None:
        a["active_period"] = periods
    return json.dumps({"id": f"e{i}", "alert": a})


def test_alert_json_flatten(spark):
    docs = [_entity(1, ["A", "X9", "7"]), _entity(2, ["X1"]), _entity(3, ["Q"], periods=[]),
            _entity(4, ["Q"], periods=None, header="x" * 600, cause=None), '{"id": "broken', ]
    parsed = jf.parse_alert_entities(spark.createDataFrame([(d,) for d in docs], "value string"))
    rows = jf.flatten_alert_json(parsed, "2024-01-01T00:00:00").orderBy("alert_id", "subway_line").collect()
    assert [(r.alert_id, r.subway_line) for r in rows] == [("e1", "7"), ("e1", "A"), ("e4", "Q")]
    e4 = rows[2]
    assert (e4.start_time, e4.end_time, e4.cause, len(e4.header_text)) == ("", "", "UNKNOWN_CAUSE", 500)
    assert jf.alert_rejects(parsed).count() == 2   # empty period list + malformed text


def test_weather_json_flatten(spark):
    doc = json.dumps({"latitude": 40.7, "longitude": -74.0, "timezone": "America/New_York",
                      "hourly": {"time": ["2025-11-01T00:00", "2025-11-01T01:00"], "temperature_2m": [1.5, 2.0],
                                 "precipitation": [0.0, 0.2], "snowfall": [0.0, 0.0], "windspeed_10m": [3.0, 4.0],
                                 "weathercode": [1, 2], "visibility": [10000.0, 9000.0]}})
    out = jf.flatten_weather_json(spark.createDataFrame([(doc,)], "value string")).orderBy("datetime_hour").collect()
    assert [(r.datetime_hour, r.temperature_2m, r.timezone) for r in out] == [
        ("2025-11-01T00:00", 1.5, "America/New_York"), ("2025-11-01T01:00", 2.0, "America/New_York")]


def test_alert_feed_shapes(spark):
    one, two = json.loads(_entity(1, ["A"])), json.loads(_entity(2, ["7", "Q"]))
    flat = {"id": "e3", **json.loads(_entity(3, ["F"]))["alert"]}
    docs = [json.dumps({"header": {}, "entity": [one, two]}), json.dumps([one]), json.dumps(flat), json.dumps({"entity": []}),
            json.dumps({"id": "e9"}), "{", ""]
    parsed = jf.parse_alert_entities(spark.createDataFrame([(d,) for d in docs] + [(None,)], "value string"))
    rows = jf.flatten_alert_json(parsed).collect()
    assert sorted((r.alert_id, r.subway_line) for r in rows) == [("e1", "A"), ("e1", "A"), ("e2", "7"), ("e2", "Q"), ("e3", "F")]
    rejects = {r.raw_text for r in jf.alert_rejects(parsed).collect()}
    assert json.dumps({"id": "e9"}) in rejects and "{" in rejects


def test_weather_without_a_measure_keeps_its_hours(spark):
    doc = json.dumps({"latitude": 1.0, "longitude": 2.0, "timezone": "UTC",
                      "hourly": {"time": ["2025-11-01T00:00", "2025-11-01T01:00"], "temperature_2m": [1.5]}})
    docs = spark.createDataFrame([(doc,), ("{broken",), ("{}",)], "value string")
    out = jf.flatten_weather_json(docs).orderBy("datetime_hour").collect()
    assert [(r.temperature_2m, r.snowfall) for r in out] == [(1.5, None), (None, None)]
    assert {r.raw_text for r in jf.weather_rejects(docs).collect()} == {"{broken", "{}"}


def test_readers_refuse_files_without_a_required_column(spark, tmp_path):
    from metroflux.sources import readers
    from metroflux.sources.fixtures import Feeds
    f = Feeds(spark, "/root/testdata/sf0.001")
    f.trips_raw().drop("fare_amount").write.parquet(str(tmp_path / "t"))
    with pytest.raises(dq.SchemaValidationError, match="fare_amount"):
        readers.read_trips(spark, str(tmp_path / "t"))
    w = f.weather_raw()
    w.selectExpr("* except (datetime_hour)", "to_timestamp_ntz(datetime_hour, \"yyyy-MM-dd'T'HH:mm\") as datetime_hour").write.parquet(str(tmp_path / "w"))
    from metroflux.operators.staging import stage_weather
    typed = stage_weather(readers.read_weather(spark, str(tmp_path / "w")))
    assert typed.exceptAll(stage_weather(w).select(*typed.columns)).count() == 0 and typed.count() == w.count()


def test_scratch_folder_must_be_named_on_a_cluster(spark):
    from types import SimpleNamespace
    from metroflux.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: None)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_live_session_settings_stay(spark):
    from metroflux.session import build_session
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512m")
    try:
        assert build_session().conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "512m"
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")


def test_alert_zone_moves_alert_hours(spark):
    from metroflux.operators.staging import stage_alerts
    raw = spark.createDataFrame([("a", "7", "c", "NO_SERVICE", "1704085200", "1704088800", "x", True)],
                                "alert_id string, subway_line string, cause string, effect string, start_time string, "
                                "end_time string, ingested_at string, is_synthetic boolean")
    utc, local = stage_alerts(raw).first(), stage_alerts(raw, "America/New_York").first()
    assert (utc.alert_date, utc.alert_start_datetime.hour) == (dt.date(2024, 1, 1), 5)
    assert (local.alert_date, local.alert_start_datetime.hour) == (dt.date(2024, 1, 1), 0)
