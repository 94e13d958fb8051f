from __future__ import annotations

import json

import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Rows as a table that is not a local relation, so that optimizer shortcuts do not hide a fault."""

    def build(rows, schema):
        return spark.createDataFrame([tuple(r) for r in rows], schema).repartition(3)

    return build


@pytest.fixture
def plain():
    return lambda df: sorted((json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect()))
