import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{work}/shared")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(f"{work}/shared")
    return s
