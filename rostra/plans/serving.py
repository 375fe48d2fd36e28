"""Marts laid out for reads by key (K6 for Q1-Q6, Q8).

A mart that is read by one key is written in ranges of that key: a file holds neighbouring keys, so that the
least and greatest value of a row group tell almost always whether it can be skipped. Bloom
filters settle the rest. A key with very many rows runs over several files, cut by the second column.

Marts that are joined on the bill are written as tables of equally many buckets by it, so their joins
need no exchange. A bucket is written by as many tasks as its size asks for, and there are more buckets where there
are many bills, so that no task writes or reads a fixed share of a growing mart; their files are sorted by person and have a Bloom filter of it, so that the votes of one
person are read from the files that have some.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# mart -> columns it is ordered by; the first is the key it is read by.
CLUSTERED: dict[str, list[str]] = {
    "dim_members": ["member_key"],
    "fct_member_finance": ["member_key", "cycle"],
    "fct_committee_memberships": ["member_key", "congress"],
    "mart_conflict_of_interest": ["member_key", "cycle"],
    "mart_similar_legislators": ["person_key", "rank"],
}
# mart -> column that orders the files of a bucket; all buckets are by bill.
BUCKETED: dict[str, str] = {
    "dim_bills": "bill_key",
    "fct_bill_sponsorships": "person_key",
    "fct_votes": "person_key",
    "bill_summaries": "bill_key",
}
BUCKET_KEY, BUCKETS = "bill_key", 64
# Bills of a bucket, which one task reads.
BUCKET_BILLS = 1_000_000


def _with_blooms(writer, columns: Sequence[str]):
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer


def write_clustered(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> DataFrame:
    """Write in ranges of the columns and read back; ``files`` defaults to what Spark picks by size."""
    ranged = df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
    _with_blooms(ranged.write.mode("overwrite"), order[:1]).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, sort: str, buckets: int = BUCKETS) -> DataFrame:
    """Write as a table of the catalog whose files are buckets of the bill; a large bucket has several files."""
    # Partitions are the buckets, and AQE cuts the large ones.
    dealt = df.hint("rebalance", buckets, BUCKET_KEY)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    _with_blooms(writer, [sort]).bucketBy(buckets, BUCKET_KEY).sortBy(sort).saveAsTable(name)
    return df.sparkSession.table(name)


def publish(
    spark: SparkSession, marts: Mapping[str, DataFrame], root: str, prefix: str, buckets: int = BUCKETS
) -> dict[str, DataFrame]:
    """Write the marts that have a layout under ``root``; others pass as they are.

    ``buckets`` is doubled until a bucket has no more bills than one task should read.
    Bucketed ones are tables ``<prefix>_<mart>`` of the current database, since only a table remembers its buckets.
    """
    if "dim_bills" in marts:
        bills = marts["dim_bills"].count()
        while bills > buckets * BUCKET_BILLS:
            buckets *= 2
    found = {}
    for name, df in marts.items():
        path = f"{root.rstrip('/')}/{name}"
        if name in CLUSTERED:
            found[name] = write_clustered(df, path, CLUSTERED[name])
        elif name in BUCKETED:
            found[name] = write_bucketed(df, f"{prefix}_{name}", path, BUCKETED[name], buckets)
        else:
            found[name] = df
    return found
