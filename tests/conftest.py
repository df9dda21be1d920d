import os
import sys
import tempfile

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("cyclewise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cyclewise-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sensor_pdf():
    """5 units x 20 cycles x 26 columns, seed 42 (the reference's unit-test panel shape)."""
    rng = np.random.default_rng(42)
    n_units, n_cycles = 5, 20
    d = {"unit_number": np.repeat(np.arange(1, n_units + 1), n_cycles),
         "time_in_cycles": np.tile(np.arange(1, n_cycles + 1), n_units)}
    n = n_units * n_cycles
    d["op_setting_1"] = rng.uniform(-0.1, 0.1, n)
    d["op_setting_2"] = rng.uniform(-0.1, 0.1, n)
    d["op_setting_3"] = rng.uniform(99, 101, n)
    for i in range(1, 22):
        d[f"sensor_{i}"] = rng.uniform(0, 100, n)
    return pd.DataFrame(d)


@pytest.fixture(scope="session")
def sensor_df(spark, sensor_pdf):
    return spark.createDataFrame(sensor_pdf)
