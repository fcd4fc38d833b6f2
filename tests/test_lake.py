"""Landing that loses nothing, replaces safely and clusters by zone."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from metroflux.functions.curve import curve_key
from metroflux.schemas import TRIPS_RAW
from metroflux.sources import json_feeds as jf
from metroflux.sources.lake import Lake, LandingError, footer_counts
from test_units import trip

AT = "2026-01-01T00:00:00"
PICKUP = "tpep_pickup_datetime"


def near():
    return [(F.col("PULocationID"), 9), (F.col("DOLocationID"), 9), (F.hour(PICKUP), 5)]


def trips(spark, *times, **kw):
    return spark.createDataFrame([trip(tpep_pickup_datetime=t, **kw) for t in times], TRIPS_RAW)


def day(month, d):
    return dt.datetime(2025, month, d, 9)


def months(df):
    return sorted((str(r.year), int(r.month), r["count"]) for r in df.groupBy("year", "month").count().collect())


def test_every_row_is_accepted_or_rejected_in_one_write(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = trips(spark, day(11, 1), day(11, 2), day(12, 1), None, None)
    audit = {(r.outcome, r.data_month): r for r in lake.land("trips", rows, PICKUP, AT, near=near()).collect()}
    assert {k: r.row_count for k, r in audit.items()} == {("accepted", "11"): 2, ("accepted", "12"): 1, ("rejected", None): 2}
    assert all(r.column_count == len(TRIPS_RAW.fields) and r.ingested_at == AT for r in audit.values())
    assert months(lake.read("trips")) == [("2025", 11, 2), ("2025", 12, 1)]
    assert [(r._reject, r.tpep_pickup_datetime) for r in lake.rejects("trips").collect()] == [("no time", None)] * 2
    assert "_reject" not in lake.read("trips").columns


def test_a_feed_landed_again_supersedes_itself_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    land = lambda feed, *times: lake.land("trips", trips(spark, *times), PICKUP, AT, feed=feed)
    land("november", day(11, 1), day(11, 2), day(12, 1), None)  # with a stray row of December
    land("december", day(12, 1), day(12, 2), day(11, 30), None, None)  # and one of November
    assert months(lake.read("trips")) == [("2025", 11, 3), ("2025", 12, 3)]
    assert lake.rejects("trips").count() == 3
    for _ in range(2):  # the feed was mended: its rejects are gone
        land("december", day(12, 1), day(12, 2), day(12, 3), day(11, 30))
        assert months(lake.read("trips")) == [("2025", 11, 3), ("2025", 12, 4)]
        assert lake.rejects("trips").count() == 1
    assert lake.audit().count() > lake.batches().count()
    lake.land("trips", trips(spark, day(11, 1)).limit(0), PICKUP, AT, feed="december")
    assert months(lake.read("trips")) == [("2025", 11, 2), ("2025", 12, 1)]


def test_a_landing_that_breaks_midway_leaves_the_old_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.land("trips", trips(spark, day(11, 1), day(12, 1)), PICKUP, AT)
    before = sorted(map(str, lake.read("trips").collect()))
    new = trips(spark, *[day(11, d) for d in range(1, 29)]).repartition(4)
    broken = new.withColumn("tip_amount", F.when(F.dayofmonth(PICKUP) == 20, F.raise_error("broken file").cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="broken file"):
        lake.land("trips", broken, PICKUP, AT)
    assert sorted(map(str, lake.read("trips").collect())) == before
    lake.land("trips", new, PICKUP, AT)  # and the next one takes over
    assert months(lake.read("trips")) == [("2025", 11, 28)]


def test_counts_that_disagree_do_not_switch(spark, tmp_path, monkeypatch):
    from metroflux.sources import lake as module
    lake = Lake(spark, str(tmp_path))
    lake.land("trips", trips(spark, day(11, 1)), PICKUP, AT)
    monkeypatch.setattr(module, "footer_counts", lambda s, p, f: footer_counts(s, p, f).withColumn("row_count", F.col("row_count") - 1))
    with pytest.raises(LandingError, match="what was there stays"):
        lake.land("trips", trips(spark, day(11, 2), day(11, 3)), PICKUP, AT)
    assert lake.read("trips").count() == 1


def test_written_rows_are_counted_from_footers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.land("trips", trips(spark, day(11, 1), day(12, 1)), PICKUP, AT)
    counts = footer_counts(spark, f"{tmp_path}/trips/version=1", ["outcome", "year", "month"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and sorted(r.row_count for r in counts.collect()) == [1, 1]


def test_empty_feed_and_nothing_landed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.audit().count() == 0
    with pytest.raises(LandingError):
        lake.read("trips")
    lake.land("trips", trips(spark, day(11, 1)).limit(0), PICKUP, AT)
    assert lake.batches().agg(F.sum("row_count")).first()[0] == 0


def test_unpartitioned_feeds_are_replaced_by_name(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    docs = ['{"id": "1", "alert": {"informed_entity": [{"route_id": "A"}, {"route_id": "BX1"}, {"route_id": "7"}]}}', "{broken",
            '{"id": "2", "alert": {"informed_entity": [{"route_id": "A"}], "active_period": []}}',
            '{"id": "3", "alert": {"informed_entity": [{"route_id": "BX1"}]}}']
    rows = jf.alert_rows(spark.createDataFrame([(d,) for d in docs], "value string"))
    for feed in ("nov", "nov", "dec"):
        lake.land("alerts", rows, None, AT, feed=feed, reject=F.col("reject"))
    assert sorted((r.alert_id, r.subway_line) for r in lake.read("alerts").collect()) == [("1", "7"), ("1", "7"), ("1", "A"), ("1", "A")]
    bad = sorted((r._reject, r.raw_text[:6]) for r in lake.rejects("alerts").collect())
    assert bad == [("empty period list", '{"id":')] * 2 + [("unreadable entity", "{broke")] * 2
    same = jf.flatten_alert_json(jf.parse_alert_entities(spark.createDataFrame([(d,) for d in docs], "value string")))
    assert sorted(map(str, rows.where("reject is null").select(*same.columns).collect())) == sorted(map(str, same.collect()))


def test_curve_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(x, y) for x in (None, -1, 0, 1, 2, 3, 9) for y in range(4)], "x long, y long")
    got = {(r.x, r.y): r.k for r in df.select("x", "y", curve_key([(F.col("x"), 2), (F.col("y"), 2)]).alias("k")).collect()}
    want = lambda x, y: sum(((x >> b & 1) << (2 * b + 1)) | ((y >> b & 1) << (2 * b)) for b in range(2))
    assert got == {(x, y): want(min(max(x or 0, 0), 3), y) for x, y in got}
    with pytest.raises(ValueError):
        curve_key([(F.col("x"), 40), (F.col("y"), 30)])


def _statistics(root):
    """Per file the ranges of both zones, from the footers."""
    out = []
    for path in glob.glob(f"{root}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        ranges = {}
        for zone in ("PULocationID", "DOLocationID"):
            stats = [meta.row_group(g).column(names.index(zone)).statistics for g in range(meta.num_row_groups)]
            ranges[zone] = (min(s.min for s in stats), max(s.max for s in stats))
        out.append((meta.num_rows, ranges))
    return out


def test_footers_rule_out_most_files_for_either_zone_and_a_hot_pair_is_split(spark, tmp_path):
    one = trips(spark, day(11, 1)).drop("PULocationID", "DOLocationID", "fare_amount")
    i = F.col("id")
    hot = i % 3 == 0  # a third of all trips is one pair of zones
    many = spark.range(60_000, numPartitions=6).crossJoin(F.broadcast(one)).select(
        "*", F.when(hot, 132).otherwise(1 + F.xxhash64("id") % 128 + 128).cast("bigint").alias("PULocationID"),
        F.when(hot, 77).otherwise(1 + F.xxhash64("id", F.lit(1)) % 128 + 128).cast("bigint").alias("DOLocationID"),
        (i % 97).cast("double").alias("fare_amount")).select(*[f.name for f in TRIPS_RAW.fields])
    lake = Lake(spark, str(tmp_path))
    lake.land("trips", many, PICKUP, AT, near=near(), files=48)
    files = _statistics(f"{tmp_path}/trips")
    assert 40 <= len(files) <= 60 and max(n for n, _ in files) < 3 * 60_000 / 48
    pair = [r for _, r in files if r["PULocationID"] == (132, 132) and r["DOLocationID"] == (77, 77)]
    assert len(pair) >= 8
    for zone in ("PULocationID", "DOLocationID"):
        shares = [sum(r[zone][0] <= z <= r[zone][1] for _, r in files) / len(files) for z in (20, 60, 111, 170, 201, 250)]
        assert max(shares) <= 0.35 and sum(shares) / len(shares) <= 0.25
    assert lake.read("trips").where("DOLocationID = 77").count() == many.where("DOLocationID = 77").count()
