import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import build_session, checkpoint_dir  # noqa: E402

SOURCE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


@pytest.fixture(scope="session")
def spark():
    session = build_session(app_name="tillroll-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def raw_frame(spark):
    """Build an all-text raw frame from rows of the eight source columns."""
    def make(rows, columns=SOURCE_COLUMNS):
        schema = ", ".join(f"`{c}` string" for c in columns)
        text = [tuple(None if v is None else str(v) for v in r) for r in rows]
        return spark.createDataFrame(text, schema)
    return make
