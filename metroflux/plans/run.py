"""Build every model from raw paths, then run the data-quality suite on the written tables.

    python -m metroflux.plans.run --trips PATH --weather PATH --alerts PATH --zones CSV \
        [--out DIR] [--window-start 2025-11-01] [--window-end 2026-02-01]

The equivalent of seeding, running and testing the model project: models are
written (full refresh) under --out, default {spark.checkpoint.dir}/models; the
suite reads the written tables, so each model is computed once, and the
verdicts land next to them as `dq_report`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from metroflux.operators import quality as dq
from metroflux.plans.pipeline import Pipeline
from metroflux.plans.suite import models_of, suite
from metroflux.session import build_session, checkpoint_dir
from metroflux.sources import readers


def build_and_test(spark: SparkSession, trips: str, weather: str, alerts: str, zones: str,
                   out: str | None = None, bounds: dict | None = None) -> dict:
    p = Pipeline(spark, readers.read_trips(spark, trips), readers.read_weather(spark, weather),
                 readers.read_alerts(spark, alerts), readers.read_zones(spark, zones), bounds=bounds)
    root = (out or f"{checkpoint_dir(spark).rstrip('/')}/models").rstrip("/")
    paths = p.materialize(root)
    report = dq.run_suite(models_of(p), suite())
    report.write.mode("overwrite").parquet(f"{root}/dq_report")
    summary = {r.status: r.tests for r in dq.summarize(spark.read.parquet(f"{root}/dq_report")).collect()}
    return {"models": paths, "dq_summary": summary}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    for name in ("trips", "weather", "alerts", "zones"):
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--out")
    ap.add_argument("--window-start", default="2025-11-01")
    ap.add_argument("--window-end", default="2026-02-01")
    a = ap.parse_args(argv)
    spark = build_session()
    bounds = {"window_start": f"{a.window_start} 00:00:00", "window_end": f"{a.window_end} 00:00:00"}
    print(build_and_test(spark, a.trips, a.weather, a.alerts, a.zones, a.out, bounds))


if __name__ == "__main__":
    main()
