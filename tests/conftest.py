import pytest

from postbud.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("postbud-tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Apply a column expression to values, in order."""

    def run(expression, values, schema="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {schema}")
        return [r["r"] for r in df.select("i", expression(df["v"]).alias("r")).orderBy("i").collect()]

    return run
