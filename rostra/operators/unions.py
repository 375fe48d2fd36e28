"""UNION ALL of relations that lack some of each other's columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a missing one becomes a typed NULL."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def conform(schema: str, *parts: DataFrame) -> DataFrame:
    """Union of all parts after aligning each to one DDL schema."""
    target = StructType.fromDDL(schema)
    return reduce(DataFrame.unionByName, [align(p, target) for p in parts])
