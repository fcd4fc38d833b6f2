"""SparkSession defaults used by tests, the bench and the pipeline runner.

On a cluster the session already exists and carries its own settings; the
helpers here only fill in what is unset, never override what the cluster set.
"""

from __future__ import annotations

import os
import tempfile
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# Settings the library relies on. None of the operators depend on the session
# time zone (all timestamps are TIMESTAMP_NTZ), but UTC keeps `show()` honest.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size shuffle partitions by bytes, not by a fixed count: AQE coalesces small
    # ones and splits skewed ones toward this size, so tasks fit executor memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # keep month='01' as text when discovering raw/{source}/year=/month= folders
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def fill_defaults(spark: SparkSession, extra: dict | None = None) -> SparkSession:
    """Set what the session leaves unset; whatever the cluster or the user has set stays."""
    own = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        if k not in own and k.startswith("spark.sql.") and k not in _FILLED.setdefault(spark, set()):
            if spark.conf.isModifiable(k) and spark.conf.get(k, None) == _BUILT_IN.get(k, spark.conf.get(k, None)):
                spark.conf.set(k, v)
            _FILLED[spark].add(k)
    return spark


# Spark's own defaults of the settings in DEFAULTS: a session that shows another value has been set by someone.
_BUILT_IN = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "67108864b",
    "spark.sql.files.maxPartitionBytes": "134217728b",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
}
_FILLED: "WeakKeyDictionary[SparkSession, set]" = WeakKeyDictionary()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "metroflux", extra: dict | None = None) -> SparkSession:
    """The live session with its unset settings filled, or a new one with the library defaults."""
    live = SparkSession.getActiveSession()
    if live is not None:
        fill_defaults(live, extra)
        checkpoint_dir(live)
        return live
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from `spark.checkpoint.dir` (set by the cluster). Only when it is
    unset on a local master, as in tests, a scratch folder is created and
    registered; on a cluster a machine-local folder would be another one on
    every executor, so an unset folder is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is unset on {master}: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="metroflux-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
