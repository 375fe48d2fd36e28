"""Landed JSON pages, matrices and CSV files to rows."""

from __future__ import annotations

import csv
import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, ArrayType

from .. import schemas
from ..sinks import ledger

logger = logging.getLogger(__name__)


class SourceError(Exception):
    """A landed source is missing or a record was not found."""


# Where each paged source keeps its records.
RESULT_KEYS = {
    "candidates": "results",
    "committees": "results",
    "candidate_totals": "results",
    "people": "results",
    "bills": "results",
    "members": "members",
    "congress_bills": "bills",
    "house_committees": "committees",
    "senate_committees": "committees",
    "congress_member_sponsorships": "sponsoredLegislation",
}

# Survey variable codes and the names they get.
CENSUS_VARIABLES = {
    "B01003_001E": "total_population",
    "B19013_001E": "median_household_income",
    "B02001_002E": "pop_white_alone",
    "B02001_003E": "pop_black_alone",
    "B03001_003E": "pop_hispanic_latino",
    "B15003_022E": "pop_bachelors_degree",
    "B27001_001E": "pop_health_insurance",
}

# Covered bill types, congresses, election cycles and city cycles.
BILL_TYPES = ["hr", "s", "hjres", "sjres", "hres", "sres"]
CONGRESSES = list(range(111, 120))
FEC_CYCLES = list(range(2010, 2025, 2))
CITY_CYCLES = [2017, 2021, 2023, 2025]  # those published so far

# The header of the state activity files.
ACTIVITY_HEADER = [
    "Election Year",
    "Filer ID",
    "Committee Name",
    "Candidate Name",
    "Office",
    "District",
    "Public Funds Received",
    "Qualified Campaign Expenditures",
]


def table_schema(name: str, without: Sequence[str] = ()) -> StructType:
    full = StructType.fromDDL(schemas.RAW[name])
    return StructType([f for f in full.fields if f.name not in without])


def read_pages(
    spark: SparkSession,
    path: str,
    results_key: str,
    record: StructType,
    keep: Sequence[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Records of all landed pages ``{results_key: [...], pagination: {...}}``.

    ``keep`` names partition columns of the landing folder to carry along. A page that cannot
    be parsed, or has no list of records, is an error.
    """
    envelope = StructType([StructField(results_key, ArrayType(record))])
    pages = spark.read.schema(envelope).json(path, multiLine=multi_line, mode="FAILFAST")
    records = required(F.col(results_key), f"a landed page has no list {results_key!r}")
    return pages.select(F.explode(records).alias("r"), *keep).select("r.*", *keep)


def read_drifting_pages(
    spark: SparkSession, path: str, results_key: str, fields: Mapping[str, tuple[str, str]], multi_line: bool = True
) -> DataFrame:
    """Records of landed pages whose fields change shape, such as an object that becomes a list.

    ``fields`` maps a column to its path in a record and its type. Where a record holds something else at
    that path, the column is NULL and the other columns keep their values; a page that is no JSON, or has no list
    of records, is an error.
    """
    page = F.try_parse_json("value")
    records = required(F.try_variant_get(page, f"$.{results_key}", "array<variant>"), f"a landed page has no list {results_key!r}")
    rows = spark.read.text(path, wholetext=multi_line).select(F.explode(records).alias("r"))
    return rows.select(*[F.try_variant_get("r", at, kind).alias(name) for name, (at, kind) in fields.items()])


def required(value: Column, message: str) -> Column:
    """The value; where it is NULL, the query fails with the message."""
    return F.when(F.assert_true(value.isNotNull(), message).isNull(), value)


def read_table_pages(
    spark: SparkSession, path: str, table: str, tag: str | None = None, multi_line: bool = True
) -> DataFrame:
    """One paged table; ``tag`` is the column that comes from the folder name.

    A folder per member (``_bioguide_id=W000779/``) or state (``_state=ny/``) tags each
    record with its owner; records without an owner are skipped.
    """
    record = table_schema(table, [tag] if tag else [])
    df = read_pages(spark, path, RESULT_KEYS[table], record, [tag] if tag else [], multi_line)
    return df.where(F.col(tag).isNotNull()) if tag else df


def matrix_records(matrix: Column, variables: Mapping[str, str] = CENSUS_VARIABLES) -> Column:
    """Array of rows, the first being the header, to an array of name -> value maps."""
    names = F.transform(
        matrix[0],
        lambda h: reduce(
            lambda acc, kv: F.when(h == kv[0], kv[1]).otherwise(acc), variables.items(), h
        ),
    )
    rows = F.slice(matrix, F.lit(2), F.greatest(F.size(matrix) - 1, F.lit(0)))
    return F.transform(rows, lambda r: F.map_from_arrays(names, r))


def read_matrix(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    variables: Mapping[str, str] = CENSUS_VARIABLES,
    whole_file: bool = True,
) -> DataFrame:
    """Survey responses to rows; ``columns`` maps output names to record names."""
    text = spark.read.text(path, wholetext=whole_file)
    matrix = F.from_json("value", "array<array<string>>", {"mode": "FAILFAST"})
    matrix = required(matrix, "a survey response is empty")
    records = text.select(F.explode(matrix_records(matrix, variables)).alias("r"))
    return records.select(*[F.col("r")[source].alias(name) for name, source in columns.items()])


def read_districts(spark: SparkSession, path: str) -> DataFrame:
    return read_matrix(spark, path, _survey_columns(["state", "congressional_district"]))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_matrix(spark, path, _survey_columns(["state"]))


def _survey_columns(geography: Sequence[str]) -> dict[str, str]:
    places = {g: g.replace("_", " ") for g in geography}
    return {"name": "NAME", **places, **{v: v for v in CENSUS_VARIABLES.values()}}


def _files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Addresses of the landed files, folders inside included, on whichever file system the path is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        raise SourceError(f"no landing folder {path}")
    found, walk = [], fs.listFiles(folder, True)
    while walk.hasNext():
        file = walk.next().getPath()
        if file.getName().endswith(suffix):
            found.append(file.toString())
    return sorted(found)


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names in their first line.

    Spark reads the lines, so the driver opens no file; it gets one line per file. That is a second pass over
    the text, in which each task sends on one line per file.
    """
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("place"),
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("line"))
    jvm = spark.sparkContext._jvm
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        header = tuple(next(csv.reader([row["line"].removeprefix("\ufeff")]), ()))
        found.setdefault(header, []).append(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"])).toString())
    return found


def read_csv_by_name(
    spark: SparkSession, path: str, wanted: Sequence[str], tags: Sequence[str] = ()
) -> DataFrame:
    """The wanted columns of all CSV files under a folder, found by header name.

    Files may order their columns differently and have more of them; names match in any letter
    case. Files with the same header are read together. A file without a wanted column is an
    error, an empty file has no rows. ``tags`` are columns that come from folder names.
    """
    files = _files(spark, path, ".csv")
    if not files:
        raise SourceError(f"no CSV file under {path}")
    parts = []
    for header, group in _headers(spark, files).items():
        if not header:
            continue
        places = {name.strip().lower(): i for i, name in reversed(list(enumerate(header)))}
        missing = [w for w in wanted if w.lower() not in places]
        if missing:
            raise SourceError(f"{group[0]} has no column {missing[0]!r}")
        schema = ", ".join(f"_{i} string" for i in range(len(header)))
        reader = spark.read.option("basePath", path).schema(schema)
        df = reader.csv(group, header=True, enforceSchema=True)
        parts.append(df.select(*[F.col(f"_{places[w.lower()]}").alias(w) for w in wanted], *tags))
    if not parts:
        raise SourceError(f"no CSV file with a header under {path}")
    return reduce(DataFrame.unionByName, parts)


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """S3: all CSV files of a folder as one table; a leading byte order mark is accepted."""
    df = read_csv_by_name(spark, path, ACTIVITY_HEADER)
    return df.toDF(*[h.lower().replace(" ", "_") for h in ACTIVITY_HEADER])


def read_contributions(
    spark: SparkSession, path: str, cycles: Sequence[int] | None = None
) -> DataFrame:
    """Folders ``cycle_year=YYYY`` of CSV files: all of them, or the cycles asked for.

    A cycle that was asked for and is not landed is reported and has no rows.
    """
    fields = [f.name for f in table_schema("nyc_cfb_contributions", ["cycle_year"])]
    df = read_csv_by_name(spark, path, fields, ["cycle_year"])
    df = df.withColumn("cycle_year", F.col("cycle_year").cast("int"))
    if cycles is None:
        return df
    landed = {
        int(part.removeprefix("cycle_year="))
        for address in _files(spark, path, ".csv")
        for part in address.split("/")
        if part.startswith("cycle_year=")
    }
    for cycle in sorted(set(cycles) - landed):
        logger.warning("cycle %d is not landed, skipping", cycle)
    return df.where(F.col("cycle_year").isin(list(cycles)))


def tagged_union(parts: Mapping[object, DataFrame], tag: str) -> DataFrame:
    """Union of per-partition frames, each tagged with its partition value."""
    return reduce(
        DataFrame.unionByName, [df.withColumn(tag, F.lit(value)) for value, df in parts.items()]
    )


def congress_start_year(congress: Column) -> Column:
    """First of the two calendar years of a congress."""
    return (congress - 111) * 2 + 2009


def congress_years(spark: SparkSession, first: int = 111, last: int = 119) -> DataFrame:
    """(congress, first_year, second_year)."""
    start = congress_start_year(F.col("id"))
    return spark.range(first, last + 1).select(
        F.col("id").cast("int").alias("congress"),
        start.cast("int").alias("first_year"),
        (start + 1).cast("int").alias("second_year"),
    )


def raw_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A raw table by name, with its declared columns.

    Loads may differ in the optional columns; a load without one reads as NULL there. Of loads that
    are in a ledger only the committed ones count, and not those that were replaced.
    """
    return ledger.read(spark, f"{root.rstrip('/')}/{name}", raw_schema(name))


def raw_schema(name: str) -> StructType:
    optional = f", {schemas.OPTIONAL[name]}" if name in schemas.OPTIONAL else ""
    return StructType.fromDDL(f"{schemas.RAW[name]}{optional}, load_at timestamp")


def itemized(df: DataFrame, key: str, value: str, period: int, date: str) -> DataFrame:
    """Itemised receipts of a candidate, or disbursements of a committee, newest first."""
    return df.where(
        (F.col(key) == value) & (F.col("two_year_transaction_period") == period)
    ).orderBy(F.desc_nulls_last(date))


def find_one(df: DataFrame, key: str, value: str, what: str) -> DataFrame:
    """One record by id; an unknown id is an error."""
    found = df.where(F.col(key) == value).limit(1)
    if found.isEmpty():
        raise SourceError(f"{what} {value!r} not found")
    return found
