import pytest
from pyspark.sql import SparkSession

from miasma.session import RECOMMENDED_CONF


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")
