import datetime as dt

from pyspark.sql import functions as F

from metroflux.schemas import TRIPS_RAW
from metroflux.sources.landing import append_alerts, load_all, load_month, load_summary
from metroflux.sources.readers import read_landed
from metroflux.streaming.incremental import refresh_new_batches
from test_units import trip


def _trips(spark, month, days, **kw):
    rows = [trip(tpep_pickup_datetime=dt.datetime(2025, month, d, 9), PULocationID=d, **kw) for d in days]
    return spark.createDataFrame(rows, TRIPS_RAW)


def _months(df):
    return {(int(r.month), r["count"]) for r in df.groupBy("month").count().collect()}


def test_incremental_landing_never_doubles_a_batch(spark, tmp_path):
    root = str(tmp_path)
    nov, dec = _trips(spark, 11, range(1, 6)), _trips(spark, 12, range(1, 4))
    args = (spark, f"{root}/landing/trips", f"{root}/raw", f"{root}/ckpt", TRIPS_RAW)
    load_month(nov, f"{root}/landing", "trips", 2025, 11)
    assert refresh_new_batches(*args)["num_input_rows"] == 5
    refresh_new_batches(*args)                       # nothing new arrived
    assert read_landed(spark, f"{root}/raw").count() == 5
    load_month(dec, f"{root}/landing", "trips", 2025, 12)
    refresh_new_batches(*args)                       # only December is new
    assert _months(read_landed(spark, f"{root}/raw")) == {(11, 5), (12, 3)}
    load_month(nov, f"{root}/landing", "trips", 2025, 11)
    refresh_new_batches(*args)                       # November again: its files are new, its rows are not
    assert _months(read_landed(spark, f"{root}/raw")) == {(11, 5), (12, 3)}


def test_a_stray_row_stays_in_its_batch(spark, tmp_path):
    root = str(tmp_path)
    load_month(_trips(spark, 12, range(1, 11)), root, "trips", 2025, 12, ts="tpep_pickup_datetime")
    january = spark.createDataFrame([trip(tpep_pickup_datetime=dt.datetime(2026, 1, 2, 9)),
                                     trip(tpep_pickup_datetime=dt.datetime(2025, 12, 31, 23))], TRIPS_RAW)
    for _ in range(2):
        load_month(january, root, "trips", 2026, 1, ts="tpep_pickup_datetime")
    assert _months(read_landed(spark, f"{root}/trips")) == {(12, 10), (1, 2)}


def test_one_hot_zone_pair_becomes_several_files(spark, tmp_path):
    one = spark.createDataFrame([trip()], TRIPS_RAW)
    many = spark.range(40_000, numPartitions=8).crossJoin(F.broadcast(one))
    df = many.withColumn("fare_amount", F.rand(1)).drop("id")
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = load_month(df, str(tmp_path), "trips", 2025, 11, ts="tpep_pickup_datetime", cluster_by=["PULocationID"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    assert len(spark.read.parquet(path).inputFiles()) > 1 and spark.read.parquet(path).count() == 40_000


def test_a_failing_batch_keeps_its_error_and_stops_no_other(spark, tmp_path):
    good = _trips(spark, 11, range(1, 6))
    bad = good.selectExpr("*", "raise_error('broken month') as e")
    out = load_all(spark, [("trips", 2025, 10, bad, {}), ("trips", 2025, 11, good, {"ts": "tpep_pickup_datetime"})],
                   str(tmp_path), "2026-01-01T00:00:00")
    rows = {r.data_month: r for r in out.collect()}
    assert rows["11"].status == "success" and rows["11"].row_count == 5 and rows["11"].error is None
    assert rows["10"].status == "failed" and "broken month" in rows["10"].error
    assert tuple(load_summary(out).first()) == (1, 2)
    landed = read_landed(spark, f"{tmp_path}/trips").where("month = 11").first()
    assert (landed["_source"], landed["_ingested_at"]) == ("trips", "2026-01-01T00:00:00")
    assert spark.read.parquet(f"{tmp_path}/_audit").count() == 2


def test_alert_batches_are_plain_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", "7")], "alert_id string, subway_line string")
    for _ in range(2):
        path = append_alerts(df, str(tmp_path), "alerts", "2025-11")
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 1 and len(spark.read.parquet(path).inputFiles()) == 1
