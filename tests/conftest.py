import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", 10000)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="narrascope-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    from narrascope.schema import NARRATIVE, PRODUCT

    return spark.createDataFrame(
        [
            ("Credit card or prepaid card", "valid narrative"),
            ("Checking or savings account", ""),
            ("Mortgage", "ignored"),
            ("Money transfer, virtual currency, or money service", "another one"),
        ],
        f"`{PRODUCT}` string, `{NARRATIVE}` string",
    )
