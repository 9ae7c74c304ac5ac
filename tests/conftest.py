import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from windvane.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "3", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (order-free comparison)."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)
