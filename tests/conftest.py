import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def clean(spark):
    """Runs payloads through a pipeline; rows as dictionaries in order of arrival."""
    from pyspark.sql import functions as F

    from siltstone.plans.pipeline import clean as run
    from siltstone.plans.record import adapted

    def go(rows, stage, category, profile=None, dataset="d", **config):
        df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "seq long, payload string")
        records = adapted(df, "payload", F.lit(dataset), F.col("seq"))
        out = run(records, stage, category, profile, config).drop("data")
        return [r.asDict(recursive=True) for r in out.orderBy("seq").collect()]

    return go
