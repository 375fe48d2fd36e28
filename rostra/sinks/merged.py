"""Aggregates that grow load by load instead of being counted anew.

A stored aggregate has one row per key and lies in folders by a hash of some of its key columns. A
delta is aggregated on its own and merged into the folders that hold its keys; no other
folder is read or written. Sums, least and greatest values and distinct-count sketches merge in any order.

Every folder also holds a marker row per batch that was merged into it, written together with the rows. A
batch that comes again is skipped folder by folder, so a repeat adds nothing, not even after a run
that broke off half-way. Spark writes all folders of a merge aside and then swaps them one by one; a
run that ends between deleting and moving one folder needs a rebuild from the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import staged

BUCKET, BATCH, MARK, BUCKETS, PIECE = "_bucket", "_batch", "_mark", "_buckets", "_piece"
# Rows of a folder that one task merges and writes.
PIECE_ROWS = 2_000_000
# Sketches of 2 ** 12 registers: an error of about 1.6 percent (one standard deviation).
SKETCH_LOG2, SKETCH_ERROR = 12, 0.016

# How a measure is made from rows, and from two of its own values.
FIRST: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "min": F.min, "max": F.max, "sketch": lambda c: F.hll_sketch_agg(c, SKETCH_LOG2),
}
AGAIN: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg}

Measures = Mapping[str, tuple[str, Column]]


def aggregated(rows: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """One row per key; ``measures`` maps a name to its kind and what it is taken of."""
    return rows.groupBy(*keys).agg(*[FIRST[kind](value).alias(name) for name, (kind, value) in measures.items()])


def fingerprint(rows: DataFrame) -> str:
    """A name for the rows themselves, whatever their order."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)")
    n, total = rows.agg(F.count("*"), F.sum(every)).first()
    return f"{n}:{total or 0}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def merge_into(
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    measures: Measures,
    by: Sequence[str],
    buckets: int = 64,
    batch: str | None = None,
    load_time: str | None = "load_at",
    sort: Sequence[str] = (),
) -> list[int]:
    """Merge the rows of ``delta`` into the aggregate at ``path``; returns the folders that were rewritten.

    ``by`` are the key columns that choose the folder, ``sort`` those by which rows lie in it. Without a name for
    the batch its rows give one, so two equal deltas count as one; name them where both are meant.
    """
    spark = delta.sparkSession
    batch = batch or fingerprint(delta)
    there = _exists(spark, path)
    if there and _merged_folders(spark.read.parquet(path), batch, buckets) == set(range(buckets)):
        return []  # every folder has it, whatever the rows
    timed = load_time is not None and load_time in delta.columns
    mark = delta.agg(F.max(load_time).cast("timestamp")).first()[0] if timed else None
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")
    fresh = staged(aggregated(delta, keys, measures).withColumn(BUCKET, bucket), "merge-delta")
    # At most one number per folder.
    touched = {r[0] for r in fresh.select(BUCKET).distinct().collect()}
    held = None
    if touched and there:
        held = spark.read.parquet(path).where(F.col(BUCKET).isin(*touched))
        touched -= _merged_folders(held, batch, buckets)
    if not touched:
        return []
    wanted = F.col(BUCKET).isin(*touched)
    names, notes = [*keys, *measures], [BUCKET, BATCH, MARK, BUCKETS]
    marker = spark.createDataFrame(
        [(b, batch, mark, buckets) for b in sorted(touched)], f"{BUCKET} int, {BATCH} string, {MARK} timestamp, {BUCKETS} int"
    )
    whole = fresh.where(wanted).select(*names, BUCKET).unionByName(marker, allowMissingColumns=True)
    if held is not None:
        whole = held.where(wanted).select(*names, *notes).unionByName(whole.select(*names, *notes))
    # One exchange brings a folder's rows together, in pieces by their key where there are many.
    pieces = max(1, -(-whole.count() // (len(touched) * PIECE_ROWS)))
    piece = F.when(F.col(BATCH).isNull(), F.pmod(F.xxhash64(*keys), F.lit(pieces))).otherwise(0).cast("int")
    dealt = whole.withColumn(PIECE, piece).repartition(*([2 * len(touched) * pieces] if pieces > 1 else []), BUCKET, PIECE)
    if held is not None:
        merged = [AGAIN[kind](F.col(n)).alias(n) for n, (kind, _) in measures.items()]
        dealt = dealt.groupBy(BUCKET, PIECE, BATCH, *keys).agg(*merged, F.max(MARK).alias(MARK), F.max(BUCKETS).alias(BUCKETS))
    # A sum of decimals gets wider each time it is added up.
    rows = dealt.select(*[F.col(n).cast(fresh.schema[n].dataType).alias(n) for n in names], *notes)
    rows.sortWithinPartitions(BUCKET, *sort, *[k for k in keys if k not in sort]).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return sorted(touched)


def _merged_folders(held: DataFrame, batch: str, buckets: int) -> set[int]:
    """Folders that have a batch, by their marker rows."""
    seen = held.where(F.col(BATCH).isNotNull()).groupBy(BUCKET).agg(
        F.max(BUCKETS).alias("n"), F.max((F.col(BATCH) == batch).cast("int")).alias("again")
    ).collect()
    if any(r["n"] != buckets for r in seen):
        raise ValueError("the aggregate was written with another number of buckets")
    return {r[BUCKET] for r in seen if r["again"]}


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored aggregate, with the folder each lies in (``_bucket``)."""
    return spark.read.parquet(path).where(F.col(BATCH).isNull()).drop(BATCH, MARK, BUCKETS)


def high_water(spark: SparkSession, path: str):
    """The newest load time that was merged, or None."""
    if not _exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max(MARK)).first()[0]


def not_merged(rows: DataFrame, path: str, load_time: str = "load_at") -> DataFrame:
    """Rows loaded after the newest merged ones. Rows without a load time belong to no delta: name a batch for them."""
    mark = high_water(rows.sparkSession, path)
    known = rows.where(F.col(load_time).isNotNull())
    return known if mark is None else known.where(F.col(load_time) > F.lit(mark))
