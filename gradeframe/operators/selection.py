"""Picking and spreading samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_sample(df: DataFrame, sample_id: str) -> DataFrame:
    """The rows with this id; the filter reaches the scan."""
    return df.filter(F.col("id") == F.lit(sample_id))


def first_n(df: DataFrame, n: int, order_by: str | Sequence[str] = "id") -> DataFrame:
    """The first ``n`` rows by one or more keys (a per-task top-n, then one merge).

    Ties are settled by all other columns that can be ordered, so that the same rows come
    first however the table is cut; NULLs come first.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    ties = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType, T.DatetimeType))
    ]
    return df.orderBy(*keys, *ties).limit(n)


def spread(df: DataFrame) -> DataFrame:
    """Even out the partitions before scoring.

    Scoring happens where a row was read, so it is as uneven as the files are: few
    of them, or row groups in which many copies of a text take hardly any space.
    Every text is shuffled once for that: a few hundredths of scoring it, but all of the
    input, so it is for uneven inputs only. The number and size of partitions is adaptive.
    """
    return df.hint("rebalance")
