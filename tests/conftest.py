import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from vectrove import attach

    session = (
        SparkSession.builder.master("local[8]")
        .appName("vectrove-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield attach(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def vectors(spark):
    """``vectors([[...], ...], labels=[...])`` -> row_id, features, label."""

    def build(rows, labels=None, partitions=2):
        data = [
            (i, [float(v) for v in row], None if labels is None else int(labels[i])) for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(data, "row_id bigint, features array<double>, label int").repartition(partitions)

    return build
