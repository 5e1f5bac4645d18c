import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def either_ansi(request, setting):
    """Run the test with ANSI mode on and off: results must be the same."""
    setting(spark__sql__ansi__enabled=request.param)


@pytest.fixture
def rows(spark):
    """A table from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def as_list(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
