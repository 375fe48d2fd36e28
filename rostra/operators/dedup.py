"""Picking and numbering rows within a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged

# A key is cut into pieces once it has so many rows.
HOT_ROWS = 1_000_000
# Cuts along the order of a hot key, and pieces of the rows that share one value of the order.
CUTS, TIED_PIECES = 255, 256
# Hashes of keys are dealt into so many groups; only keys of groups with that many rows are counted themselves.
KEY_GROUPS = 1 << 14


def row_fingerprint(df: DataFrame) -> Column:
    """A hash over all columns: equal rows tie, different rows get a fixed order."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark keeps only the leading row of each key on the map side before the
    shuffle (WindowGroupLimit), so a hot key sends one row per task.
    """
    return leading(df, keys, order, 1)


def leading(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """The first ``rows`` rows per key, cut on the map side first."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= rows).drop("_rn")


def latest_wins(
    df: DataFrame, keys: Sequence[str], order: str = "load_at", tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """Newest row per key. A missing load time counts as newest, as in the source."""
    ties = list(tiebreak) or [row_fingerprint(df).desc()]
    return first_by(df, keys, [F.desc_nulls_first(order), *ties])


def one_to_one(
    pairs: DataFrame, left: str, right: str, score: str | None = None
) -> DataFrame:
    """Best partner per left, then best left per chosen partner; losers get nothing.

    Without a score the smaller id wins.
    """
    best = [F.desc(score)] if score else []
    per_left = first_by(pairs, [left], [*best, F.asc(right)])
    return first_by(per_left, [right], [*best, F.asc(left)])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys of at least ``hot_rows`` rows, written once; counted on the map side first.

    Groups of keys are counted before keys: a key with that many rows is in a group that has them too.
    """
    group = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(KEY_GROUPS)).cast("int")
    groups = df.groupBy(group.alias("_group")).agg(F.count("*").alias("_n")).where(F.col("_n") >= hot_rows)
    full = [r["_group"] for r in groups.collect()]
    sizes = df.where(group.isin(full) if full else F.lit(False)).groupBy(*keys).agg(F.count("*").alias("_n"))
    return staged(sizes.where(F.col("_n") >= hot_rows).drop("_n"), "hot-keys")


def cut_points(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """(keys, _cuts): points along the order of every hot key."""
    share = F.array(*[F.lit((i + 1) / (CUTS + 1)) for i in range(CUTS)])
    rows = df.alias("r").join(hot.alias("h"), _same_keys("r", "h", keys), "left_semi")
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(order, share, F.lit(1000)).alias("_cuts"))
    none = F.array().cast(cuts.schema["_cuts"].dataType)
    return staged(cuts.withColumn("_cuts", F.coalesce(F.array_distinct("_cuts"), none)), "cuts")


def _same_keys(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda x, y: x & y, [F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`")) for k in keys]
    )


def dedup_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "load_at",
    name: str = "dedup_seq",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the rows of each natural key 1..n in load order; no row is dropped or changed.

    Rows of one load have no order of their own, so they are ordered by a hash of the row. A key
    of ``hot_rows`` rows or more is cut into pieces that different tasks number at the same time:
    along the order column (a number, date or time) at approximate quantiles, and where a quantile
    is one value that many rows share, by ranges of the hash. A hot key has at most 511 + 255 * 255
    pieces whatever its size, so the table of piece offsets stays short. The cuts only decide
    who numbers a row; the numbers are those of the order (load time, hash). Exact copies of a row
    share their hash and stay in one piece.
    """
    columns = df.columns
    marked = df.withColumn("_hash", row_fingerprint(df))
    hot = hot_keys(df, keys, hot_rows)
    if hot.isEmpty():
        in_order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(order), "_hash")
        return marked.select(*columns, F.row_number().over(in_order).cast("bigint").alias(name))
    marked = (
        marked.alias("r")
        .join(cut_points(df, hot, keys, order).alias("h"), _same_keys("r", "h", keys), "left")
        .select("r.*", F.col("h._cuts").alias("_cuts"))
    )
    at = F.col(order)
    last = at.isNull()
    on_cut = F.coalesce(F.array_contains("_cuts", at), F.lit(False)) | last
    place = F.when(last, 2 * (CUTS + 1)).otherwise(
        2 * F.size(F.filter("_cuts", lambda cut: cut < at)) + on_cut.cast("int")
    )
    # Ranges of the hash in its own order; shifting keeps the sign, so low ranges come first.
    part = F.when(on_cut, F.shiftright("_hash", 64 - (TIED_PIECES.bit_length() - 1)).cast("int")).otherwise(0)
    split = F.col("_cuts").isNotNull()
    marked = marked.select(
        *columns,
        "_hash",
        F.when(split, place).otherwise(0).alias("_place"),
        F.when(split, part).otherwise(0).alias("_part"),
        split.alias("_split"),
    )
    piece = [*keys, "_place", "_part"]
    inside = Window.partitionBy(*piece).orderBy(F.asc_nulls_last(order), "_hash")
    numbered = marked.withColumn("_inside", F.row_number().over(inside).cast("bigint"))

    sizes = marked.where("_split").groupBy(*piece).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_place", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("_size").over(before)).drop("_size")
    return (
        numbered.alias("r")
        .join(offsets.alias("h"), _same_keys("r", "h", piece), "left")
        .select(
            *[F.col(f"r.`{c}`") for c in columns],
            (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(name),
        )
    )
