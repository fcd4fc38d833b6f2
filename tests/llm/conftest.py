import random

import pytest

@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def frame(spark, tmp_path):
    """Write a documents-like table in several files, with columns whose names clash with internal ones, and read it."""
    def build(rows, clash=True):
        from pyspark.sql import functions as F
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        for name in ("row", "ids", "node", "key", "score", "name", "digest", "runs", "d", "line") if clash else ():
            df = df.withColumn(name, F.lit("x"))
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)
    return build
