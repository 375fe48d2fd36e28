"""The given tables, and one SQL text that both engines can run over them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from rostra import seeds

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# What the two dialects spell differently.
SPARK = {
    "micros": "timestamp_micros",
    "epoch": lambda ts: f"unix_micros(cast({ts} as timestamp))",
    "fmt_mdy": lambda ts: f"date_format({ts}, 'MM/dd/yyyy')",
    "fmt_iso": lambda ts: f"date_format({ts}, 'yyyy-MM-dd')",
    "fmt_house": lambda ts: f"date_format({ts}, 'd-MMM-yyyy')",
    "fmt_senate": lambda ts: f"date_format({ts}, 'MMMM d, yyyy,  hh:mm a')",
}
DUCKDB = {
    "micros": "make_timestamp",
    "epoch": lambda ts: f"epoch_us({ts})",
    "fmt_mdy": lambda ts: f"strftime({ts}, '%m/%d/%Y')",
    "fmt_iso": lambda ts: f"strftime({ts}, '%Y-%m-%d')",
    "fmt_house": lambda ts: f"strftime({ts}, '%-d-%b-%Y')",
    "fmt_senate": lambda ts: f"strftime({ts}, '%B %-d, %Y,  %I:%M %p')",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_states(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(seeds.rows("state_abbreviations"))]
    return spark.createDataFrame(
        rows, "idx bigint, state_name string, state_abbr string, state_fips string"
    )


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values_sql(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"(select * from (values {body}) as t({columns}))"


STATES_SQL = values_sql(
    [(i, *r) for i, r in enumerate(seeds.rows("state_abbreviations"))],
    "idx, state_name, state_abbr, state_fips",
)
INDUSTRIES_SQL = values_sql(
    seeds.rows("committee_industries"), "committee_keyword, industry_category, chamber"
)


def render(template: str, dialect: dict) -> str:
    """Fill ``[[name]]`` and ``[[name:argument]]`` with what the dialect calls it."""
    def fill(match: re.Match) -> str:
        name, _, argument = match.group(1).partition(":")
        value = dialect[name]
        return value(argument) if callable(value) else value

    return re.sub(r"\[\[([^\]]+)\]\]", fill, template)


def spark_sql(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """Run a text whose ``{table}`` marks name the given tables."""
    used = {n for n in re.findall(r"\{(\w+)\}", template)}
    frames = {
        n: numbered_states(spark) if n == "states" else table(spark, sf_dir, n) for n in used
    }
    return spark.sql(render(template, SPARK), **frames)


def duck_sql(template: str) -> str:
    text = render(template, DUCKDB).replace("{states}", STATES_SQL)
    return re.sub(r"\{(\w+)\}", r"\1", text)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hash the same values."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return reduce(lambda d, c: d.withColumn(c, F.col(c).cast("double")), decimals, df)
