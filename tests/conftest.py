import pytest
from pyspark.sql import SparkSession

from gridlake.session import apply_settings


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("gridlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()
