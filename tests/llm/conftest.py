from __future__ import annotations

import pytest

from cartlayers.llm.common import prepared


@pytest.fixture(autouse=True)
def package_at_workers(spark):
    prepared(spark)
