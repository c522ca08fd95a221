from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4", 4, "6g",
        spark_sql_warehouse_dir=str(root / "warehouse"),
        spark_checkpoint_dir=str(root / "shared"),
    )
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
