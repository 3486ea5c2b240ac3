import pytest
from pyspark.sql import SparkSession

from fleetlens.streaming.stateful import ROCKSDB, STATE_STORE_SETTING


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fleet-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config(STATE_STORE_SETTING, ROCKSDB)
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collects a result as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [str(v) for v in r])

    return collect


@pytest.fixture
def one(spark):
    """Evaluates column expressions on one row of named texts."""

    def evaluate(column, schema="a string", values=(None,)):
        return spark.createDataFrame([tuple(values)], schema).select(column.alias("v")).first()["v"]

    return evaluate
