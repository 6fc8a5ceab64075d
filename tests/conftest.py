import pytest
from pyspark.sql import SparkSession

from tillroll.schema import SOURCE_SCHEMA

HEADER = ",".join(SOURCE_SCHEMA.fieldNames())


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def source(tmp_path):
    """A source folder, and a function that puts a CSV file with the given lines into it."""
    folder = tmp_path / "source"
    folder.mkdir()

    def put(name, *lines, header=HEADER):
        (folder / name).write_text("".join(f"{line}\n" for line in (header, *lines)))
        return str(folder / name)

    put.folder = str(folder)
    return put


@pytest.fixture
def target(tmp_path):
    """Paths of a table and its ledger."""
    return str(tmp_path / "cleansed" / "sales"), str(tmp_path / "ledger")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
