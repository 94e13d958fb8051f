"""Intermediate tables that go with the block that wrote them."""

from __future__ import annotations

import os

import pytest

from shelfscout.session import passing_tables, spill


def folder_of(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_tables_of_a_block_go_and_named_ones_stay(spark):
    with passing_tables(spark) as lasting:
        gone = folder_of(spill(spark.range(3).toDF("x")))
        kept = lasting(spark.range(4).toDF("x"), "kept")
        with passing_tables(spark) as outside:
            inner = folder_of(spill(spark.range(2).toDF("x")))
            between = outside(spark.range(5).toDF("x"), "between")
        assert not os.path.exists(inner) and between.count() == 5
    assert not os.path.exists(gone) and not os.path.exists(folder_of(between)) and kept.count() == 4


def test_tables_go_when_the_block_fails(spark):
    with pytest.raises(ZeroDivisionError), passing_tables(spark):
        path = folder_of(spill(spark.range(3).toDF("x")))
        1 / 0
    assert not os.path.exists(path) and spill(spark.range(3).toDF("x")).count() == 3
