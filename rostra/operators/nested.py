"""Nested arrays to rows, fields of changing shape, and wide measures to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def flatten(df: DataFrame, array: str | Column, item: str, keep: Sequence[str | Column]) -> DataFrame:
    """One row per array element. Parents with a NULL or empty array vanish."""
    return df.select(*keep, F.explode(array).alias(item))


def flatten_twice(
    df: DataFrame,
    outer: str | Column,
    outer_item: str,
    inner: str,
    inner_item: str,
    keep: Sequence[str | Column],
) -> DataFrame:
    """Array of structs that hold an array themselves."""
    events = flatten(df, outer, outer_item, keep)
    parents = [c for c in events.columns]
    return flatten(events, F.col(f"{outer_item}.{inner}"), inner_item, parents)


def drifting(text: str | Column, path: str, kind: str) -> Column:
    """The value at a path of a JSON text; NULL where it is missing, of another shape, or the text is no JSON."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def one_or_many(text: str | Column, path: str, kind: str) -> Column:
    """The values at a path that holds a list or a single one, as an array; NULL where it holds neither.

    Elements of another shape are NULL, so the others keep their places.
    """
    held = F.try_variant_get(F.try_parse_json(text), path, "variant")
    many = F.try_variant_get(held, "$", "array<variant>")
    single = F.try_variant_get(held, "$", kind)
    return F.when(many.isNotNull(), F.transform(many, lambda v: F.try_variant_get(v, "$", kind))).when(
        single.isNotNull(), F.array(single)
    )


def breakdown(
    df: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    name: str = "source",
    value: str = "amount",
) -> DataFrame:
    """Q7: one row per measure that is neither NULL nor zero; ``measures`` maps column to label."""
    doubles = df.select(
        *ids, *[F.col(c).cast("double").alias(label) for c, label in measures.items()]
    )
    long = doubles.unpivot(list(ids), list(measures.values()), name, value)
    return long.where(F.col(value).isNotNull() & (F.col(value) != 0))
