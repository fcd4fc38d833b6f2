from conftest import SF_SMALL
from metroflux.plans.run import build_and_test
from metroflux.schemas import FIXTURE_BOUNDS
from metroflux.sources.fixtures import Feeds


def test_build_and_test_from_raw_paths(spark, tmp_path):
    f = Feeds(spark, SF_SMALL)
    raw = tmp_path / "raw"
    f.trips_raw().write.parquet(str(raw / "trips"))
    f.weather_raw().write.parquet(str(raw / "weather"))
    f.alerts_raw().write.parquet(str(raw / "alerts"))
    f.zones().write.option("header", True).option("quoteAll", True).csv(str(raw / "zones"))
    res = build_and_test(spark, str(raw / "trips"), str(raw / "weather"), str(raw / "alerts"),
                         str(raw / "zones"), out=str(tmp_path / "models"), bounds=FIXTURE_BOUNDS)
    assert res["dq_summary"]["TOTAL"] == 76
    assert spark.read.parquet(res["models"]["fact_trips"]).count() == 632
