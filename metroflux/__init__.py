"""metroflux: trips, hourly weather and service alerts turned into a star schema,
data-quality checks and demand reports, as plain PySpark DataFrame functions.

Layers:
    sources/    raw readers, JSON feed flattening, lake landing, test-table adapters
    functions/  Column expressions (calendar, classification, exact numerics, keys)
    operators/  DataFrame -> DataFrame steps (staging, enrichment, roll-ups, star, quality, reports)
    plans/      the end-to-end pipeline and the named query catalogue
    streaming/  incremental landing of monthly batches with Structured Streaming
"""

from metroflux.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
