from __future__ import annotations

import pytest

from cartlayers.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
