import pytest

from spendweave.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        # tiny inputs: compiling whole stages would take most of the time
        "spark.sql.codegen.wholeStage": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples, for a comparison in any order."""
    shown = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in shown.collect()), key=repr)
