import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollfeat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "rollfeat-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.checkpoint.dir": str(scratch / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
