"""Joins: broadcast behind a size check, keyword containment, presence flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Rows a lookup side may have to be sent to every executor.
BROADCAST_ROWS = 10_000
# Leading characters of a keyword that candidate names must contain.
ANCHOR_LENGTH = 8


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the relation has at most ``rows`` rows; reads no more than that many."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a lookup only after counting it; otherwise leave the choice to Spark."""
    return F.broadcast(df) if is_small(df, rows) else df


def lookup(
    df: DataFrame, seed: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """Left lookup of seed columns; ``on`` and ``take`` map df names to seed names."""
    renamed = seed.select(
        *[F.col(s).alias(f"_on_{d}") for d, s in on.items()],
        *[F.col(s).alias(d) for d, s in take.items()],
    )
    condition = reduce(lambda a, b: a & b, [df[d] == renamed[f"_on_{d}"] for d in on])
    joined = df.join(broadcast_if_small(renamed), condition, "left")
    return joined.drop(*[f"_on_{d}" for d in on])


def attach(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left equi-join to a dimension of any size.

    No hint: Spark broadcasts by measured size, else sort-merges, and splits hot keys.
    """
    renamed = dim.select(
        *[F.col(s).alias(f"_on_{d}") for d, s in on.items()],
        *[F.col(s).alias(d) for d, s in take.items()],
    )
    condition = reduce(lambda a, b: a & b, [df[d] == renamed[f"_on_{d}"] for d in on])
    return df.join(renamed, condition, "left").drop(*[f"_on_{d}" for d in on])


def without(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with no partner. Rows with a NULL key stay, as with NOT EXISTS."""
    keys = other.select(*[F.col(o).alias(f"_on_{d}") for d, o in on.items()])
    condition = reduce(lambda a, b: a & b, [df[d] == keys[f"_on_{d}"] for d in on])
    return df.join(keys, condition, "left_anti")


def with_flag(
    df: DataFrame,
    side: DataFrame,
    key: str,
    take: Sequence[str],
    flag: str,
    present: str = "ready",
    absent: str = "none",
) -> DataFrame:
    """Left join to a side table plus a column telling whether it had the key."""
    renamed = side.select(F.col(key).alias("_side_key"), *take)
    joined = df.join(renamed, df[key] == renamed["_side_key"], "left")
    return joined.withColumn(
        flag, F.when(F.col("_side_key").isNotNull(), present).otherwise(absent)
    ).drop("_side_key")


def _contains_keyword(name: Column, keyword: Column) -> Column:
    """Containment regardless of case; ``%`` and ``_`` in a keyword are wildcards.

    A keyword without wildcards is plain text, a backslash in it included.
    """
    lowered = F.lower(keyword)
    pattern = F.concat(F.lit("%"), F.replace(lowered, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    wild = F.contains(keyword, F.lit("%")) | F.contains(keyword, F.lit("_"))
    return F.when(wild, F.like(F.lower(name), pattern)).otherwise(F.contains(F.lower(name), lowered))


def keyword_pairs(
    df: DataFrame, name: str, keywords: DataFrame, keyword: str, small_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join of each row to every keyword its name contains.

    Distinct names are matched once, and rows then meet their names by an equi-join. A short
    keyword list is broadcast and tested against each name. A long one is matched through an
    equi-join: a name that contains a keyword contains the start of its longest literal piece,
    so names are joined on their substrings of that length and only those candidates are tested.
    """
    names = df.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    if is_small(keywords, small_rows):
        matched = names.join(F.broadcast(keywords), _contains_keyword(F.col("_name"), keywords[keyword]))
        return df.join(matched, df[name] == matched["_name"], "left").drop("_name")

    pieces = F.split(F.lower(keyword), "[%_]")
    longest = F.reduce(
        pieces, F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best)
    )
    anchored = keywords.where(F.col(keyword).isNotNull()).withColumn(
        "_anchor", F.left(longest, F.lit(ANCHOR_LENGTH))
    )
    lengths = F.sequence(F.lit(0), F.least(F.length("_name"), F.lit(ANCHOR_LENGTH)))
    grams = F.flatten(
        F.transform(
            lengths,
            lambda n: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length("_name") - n + 1, F.lit(1))),
                lambda at: F.substr(F.lower("_name"), at, n),
            ),
        )
    )
    candidates = names.withColumn("_anchor", F.explode(F.array_distinct(grams))).join(
        anchored, "_anchor"
    )
    matched = candidates.where(_contains_keyword(F.col("_name"), F.col(keyword))).drop("_anchor")
    return df.join(matched, df[name] == matched["_name"], "left").drop("_name")
