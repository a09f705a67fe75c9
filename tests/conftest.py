import pytest

from seqtable import session


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
