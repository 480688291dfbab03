import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    """A session as a user brings it: nothing of the library is configured
    beforehand, ``prepare`` must do."""
    from pyspark.sql import SparkSession
    from tidewater.session import prepare
    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sensors(spark):
    """Seven sensor readings (id, time_stamp epoch seconds, temperature)
    with the event time as a timestamp and the arrival order as ``seq``."""
    from pyspark.sql import functions as F
    # The sensor resource file rows.
    rows = [
        ("sensor_1", 1612523073, 35.6),
        ("sensor_1", 1612523074, 39.6),
        ("sensor_1", 1612523075, 36.6),
        ("sensor_10", 1612523073, 36.6),
        ("sensor_2", 1612523091, 36.1),
        ("sensor_3", 1612523129, 37.6),
        ("sensor_4", 1612523135, 38.3),
    ]
    df = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)],
                               "seq long, id string, time_stamp long, temperature double")
    return df.withColumn("ts", F.timestamp_seconds("time_stamp"))
