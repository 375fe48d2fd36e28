"""Optional predicates, pages with totals, histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import first_by, leading


def equals_if_given(df: DataFrame, column: str, value) -> DataFrame:
    """No argument, no filter."""
    return df if value is None else df.where(F.col(column) == F.lit(value))


def contains_if_given(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Case-blind containment; wildcards in the argument stay live."""
    return df if value is None else df.where(F.col(column).ilike(f"%{value}%"))


def page(
    df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0, total: str | None = None
) -> DataFrame:
    """One page in order, with the row count before the limit.

    The count is a scalar subquery over a partial aggregate, not a window that
    would pull every row into one task. The page itself is a top-k.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be at least 1 and offset at least 0")
    rows = df.orderBy(*order).offset(offset).limit(limit)
    if total is None:
        return rows
    return rows.withColumn(total, df.agg(F.count("*").alias("_n")).scalar())


def top(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows in an explicit order (nulls placed by the caller, H10)."""
    return df.orderBy(*order).limit(limit)


def latest_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """T4: newest history row of each key."""
    return first_by(df, keys, order)


def current_else_first(
    rows: DataFrame,
    parents: DataFrame,
    key: str,
    period: str,
    latest: str,
    order: Sequence[Column],
    fallback: int = 10,
) -> DataFrame:
    """T5: each parent's rows of its latest period; a parent without any keeps its first rows.

    ``parents`` has one row per key with the column ``latest``.
    """
    wanted = parents.select(key, F.col(latest).alias("_latest"))
    current = (
        rows.join(wanted, key).where(F.col(period) == F.col("_latest")).select(*rows.columns)
    )
    served = current.select(key).distinct()
    others = rows.join(wanted.select(key), key, "left_semi").join(served, key, "left_anti")
    return current.unionByName(leading(others, [key], order, fallback))
