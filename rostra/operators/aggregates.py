"""Aggregates beyond the built-in ones (A1-A3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

SEPARATOR = " · "


def joined_distinct(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], separator: str = SEPARATOR
) -> DataFrame:
    """A2: per key, the sorted distinct values of each column as one text; '' where all are NULL (H5).

    Rows are made distinct first, on the map side and spread by key *and* value, so a
    key with very many rows reaches its task as its distinct values only.
    """
    distinct = df.select(*keys, *columns.values()).distinct()
    return distinct.groupBy(*keys).agg(
        *[
            F.array_join(F.array_sort(F.collect_set(source)), separator).alias(target)
            for target, source in columns.items()
        ]
    )
