"""Search for a part of a name through an index of three-letter pieces.

The index has one row per distinct piece of a lower-case name and row key, in ranges of pieces, and a table of how many
rows a piece has. A pattern's literal stretches of three letters or more have pieces that every match
must hold; the rarest few choose candidates, which are then tested with the pattern itself. So wildcards
keep their meaning, and the result is that of a scan. A pattern without such a stretch is a scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PIECE, ASKED = 3, 4


def pieces(name: Column) -> Column:
    """The distinct pieces of a lower-case name."""
    low = F.lower(name)
    places = F.sequence(F.lit(1), F.greatest(F.length(low) - PIECE + 1, F.lit(0)))
    all_ = F.transform(F.when(F.length(low) >= PIECE, places).otherwise(F.array().cast("array<int>")), lambda i: F.substr(low, i, F.lit(PIECE)))
    return F.array_distinct(all_)


def build_index(df: DataFrame, key: str, name: str, path: str) -> None:
    """Write the index of ``name``; ``key`` names the rows. Rows without a name are not found by any pattern."""
    held = df.where(F.col(name).isNotNull()).select(F.col(key).alias("key"), F.explode(pieces(F.col(name))).alias("piece"))
    order = ["piece", "key"]
    held.distinct().repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option(
        "parquet.bloom.filter.enabled#piece", "true"
    ).parquet(f"{path}/pieces")
    counts = df.sparkSession.read.parquet(f"{path}/pieces").groupBy("piece").agg(F.count("*").alias("n"))
    counts.repartitionByRange("piece").sortWithinPartitions("piece").write.mode("overwrite").parquet(f"{path}/counts")


def needed(spark: SparkSession, pattern: str) -> list[str]:
    """Pieces that each name with the pattern in it must have."""
    low = spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
    found: dict[str, None] = {}
    for stretch in re.split(r"[%_\\]", low):
        for i in range(len(stretch) - PIECE + 1):
            found[stretch[i : i + PIECE]] = None
    return list(found)


def search(df: DataFrame, key: str, name: str, pattern: str, path: str) -> DataFrame:
    """Rows whose name has the pattern in it, regardless of case; ``df`` is what the index was built of."""
    spark = df.sparkSession
    wanted = needed(spark, pattern)
    matches = F.col(name).ilike(f"%{pattern}%")
    if not wanted:
        return df.where(matches)
    counts = spark.read.parquet(f"{path}/counts").where(F.col("piece").isin(wanted))
    # At most one row per piece of the pattern.
    rare = [r["piece"] for r in counts.orderBy("n", "piece").limit(ASKED + len(wanted)).collect()]
    if len(rare) < len(wanted):
        return df.limit(0)  # a piece that no name has
    chosen = rare[:ASKED]
    rows = spark.read.parquet(f"{path}/pieces").where(F.col("piece").isin(chosen))
    both = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(chosen)).select(F.col("key").alias("_key"))
    return df.join(both, df[key] == both["_key"], "left_semi").where(matches)
