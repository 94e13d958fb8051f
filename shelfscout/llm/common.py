"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word of the contracts: a run of anything but space and the ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(column: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def others(df: DataFrame, added: Sequence[str]) -> list[Column]:
    """Columns of ``df`` but those whose name an operator gives to its own result; the operator's win."""
    taken = {a.lower() for a in added}
    return [named(c) for c in df.columns if c.lower() not in taken]


def packed(df: DataFrame, added: Sequence[str]) -> Column:
    """The carried columns as one struct, so that no name of the input can meet one of the operator's own."""
    return F.struct(*others(df, added))


def unpacked(row: str, df: DataFrame, added: Sequence[str]) -> list[Column]:
    taken = {a.lower() for a in added}
    return [F.col(row).getField(c).alias(c) for c in df.columns if c.lower() not in taken]


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A bounded object for the tasks: sent once per executor, by value, and unpacked once per task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get() -> Any:
        if not held:
            held.append(pickle.loads(sent.value))
        return held[0]

    return get
