"""Writers (K1-K8)."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schemas import LOAD_KEYS, RAW

logger = logging.getLogger(__name__)

_PHANTOM = re.compile(r"^(_c\d+)?$")


def normalise_columns(df: DataFrame) -> DataFrame:
    """K3: upper-case names, blanks to underscores, and no columns from trailing commas."""
    kept = [c for c in df.columns if not _PHANTOM.match(c.strip())]
    return df.select(*[F.col(f"`{c}`").alias(c.upper().replace(" ", "_")) for c in kept])


def write_raw_file(df: DataFrame, path: str) -> str | None:
    """K1: overwrite one raw Parquet table; no rows, no file."""
    if df.isEmpty():
        logger.warning("no records for %s", path)
        return None
    df.write.mode("overwrite").parquet(path)
    return path


def load_table(df: DataFrame, root: str, name: str, overwrite: bool = False) -> bool:
    """K2: append to (or replace) a raw table, stamping the load time. Empty input is skipped."""
    if df.isEmpty():
        logger.warning("no records for %s, skipping", name)
        return False
    stamped = normalise_columns(df.withColumn("load_at", F.current_timestamp()))
    mode = "overwrite" if overwrite else "append"
    stamped.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
    return True


def load_tables(tables: Mapping[str, DataFrame], root: str, overwrite: bool = False) -> dict[str, bool]:
    """K4: all tables of one source."""
    return {name: load_table(df, root, name, overwrite) for name, df in tables.items()}


def load_sources(
    readers: Mapping[str, Callable[[], Mapping[str, DataFrame]]],
    root: str,
    source: str | None = None,
    full_refresh: bool = False,
) -> dict[str, dict[str, bool]]:
    """K4: every source, or the named one."""
    return {
        name: load_tables(read(), root, full_refresh)
        for name, read in readers.items()
        if source in (None, name)
    }


def backfill(
    read_period: Callable[[int], Mapping[str, DataFrame]], periods: Iterable[int], root: str
) -> None:
    """K5: append one period (a congress or a cycle) after the other.

    A period may be loaded twice: where the table has a load key, staging keeps the newest copy of each
    record. A declared table without one keeps every row it is given, so its periods go through the
    ledger, where a period that comes again takes the place of its earlier rows. Tables that are not
    declared are appended to.
    """
    from .ledger import load_period  # which uses this module

    for period in periods:
        tables = dict(read_period(period))
        for name in tables_without_key(tables):
            if name not in RAW:
                logger.warning("%s is not declared: loading a period twice doubles its rows", name)
                continue
            df = tables.pop(name)
            if df.isEmpty():
                logger.warning("no records for %s, skipping", name)
            else:
                load_period(df, root, name, period)
        load_tables(tables, root, overwrite=False)


def tables_without_key(names: Iterable[str]) -> list[str]:
    return [n for n in names if n not in LOAD_KEYS]


def materialise_view(df: DataFrame, name: str) -> None:
    """K6: staging and identity relations stay lazy."""
    df.createOrReplaceTempView(name)


def materialise_table(df: DataFrame, path: str) -> DataFrame:
    """K6: marts are rebuilt in full and read back, which also cuts their lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def new_rows(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """K7: one row per key that the table does not have yet."""
    return candidates.join(existing.select(key), key, "left_anti").dropDuplicates([key])


def insert_absent(candidates: DataFrame, path: str, key: str, stamp: str = "generated_at") -> None:
    """K7: append the new rows; ``stamp`` defaults to now where it is not given."""
    spark: SparkSession = candidates.sparkSession
    existing = spark.read.schema(StructType([candidates.schema[key]])).parquet(path)
    fresh = new_rows(candidates, existing, key)
    now = F.current_timestamp()
    value = F.coalesce(F.col(stamp), now) if stamp in candidates.columns else now
    fresh.withColumn(stamp, value).write.mode("append").parquet(path)


def document(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """K8: attach column descriptions; Parquet and the catalog keep them."""
    for name, comment in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": comment})
    return df
