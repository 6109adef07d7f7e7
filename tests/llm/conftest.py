"""Awkward tables, with extra columns whose names clash with the operators' own."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from awkward_docs import SCHEMA, documents  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(d, t, None if k % 4 == 0 else f"s{k % 3}", "k", None, "z", k, "t", *"abcd") for k, (d, t) in enumerate(documents())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def unique(spark):
    """The same with ids that occur once."""
    rows = [(d, t, f"s{k % 3}", "k", None, "z", k, "t", *"abcd") for k, (d, t) in enumerate(documents()) if k < 19]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
