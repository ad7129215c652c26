from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """Small tables from rows, dealt over a few partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
