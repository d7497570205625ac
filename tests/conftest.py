import os

import pytest

from txnrisk.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", f"local[{os.environ.get('TEST_CPUS', '8')}]", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("FATAL")
    yield session
    session.stop()
