"""Lookup tables that ship with the package."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_HERE = Path(__file__).parent

SCHEMAS = {
    # The FIPS code is text: it keeps its leading zero.
    "state_abbreviations": "state_name string, state_abbr string, state_fips string",
    "committee_industries": "committee_keyword string, industry_category string, chamber string",
}


def rows(name: str) -> list[tuple[str, ...]]:
    """The rows of a seed file."""
    with open(_HERE / f"{name}.csv", encoding="utf-8") as f:
        lines = list(csv.reader(line for line in f if not line.startswith("#")))
    return [tuple(line) for line in lines[1:]]


def load(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed with its declared types.

    The packaged files exist on the driver only, so their few rows travel with the
    plan; a seed of one's own is read from ``path``, which executors must reach.
    """
    if path is None:
        return spark.createDataFrame(rows(name), SCHEMAS[name])
    return spark.read.csv(path, header=True, schema=SCHEMAS[name], comment="#")
