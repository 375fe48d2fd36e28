"""Registered queries against their check SQL on the smallest data."""

import math
import re

import duckdb
import pytest

import __spark_entry__
from catalog import basics, insights, models
from catalog.tables import NAMES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = __spark_entry__.queries(), __spark_entry__.oracle_sql()

# One query per kind here; the full set is compared outside the unit tests.
COMPARED = [
    "latest_wins_composite", "dedup_sequence", "composite_keys", "fuzzy_block_pairs",
    "keyword_theta_min", "listagg_distinct_ordered", "flatten_double", "paged_search_total",
    "dedup_sequence_hot", "raw_table", "bill_copies", "keyword_long_list",
    "current_else_first", "dq_report", "page_json", "census_matrix", "csv_union", "cycle_csv",
    "xml_votes", "committee_flatten", "int_persons_id_crosswalk", "fct_contributions",
    "mart_conflict_of_interest", *insights.QUERIES, "table_pages", "membership_files", "drifting_shapes",
    "load_sources", "period_replaced", "insert_absent", "column_comments", "dq_watched",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (float,)) or type(value).__name__ == "Decimal":
        return repr(round(float(value), 6) + 0.0)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_check(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    expected = sorted_rows([d[0] for d in result.description], result.fetchall())
    assert sorted_rows(df.columns, df.collect()) == expected


def test_every_query_has_a_check():
    own = set(basics.QUERIES) | set(models.QUERIES) | set(insights.QUERIES)
    assert own <= set(ORACLE) <= set(QUERIES)


def test_queries_run_over_whole_tables():
    for sql in ORACLE.values():
        for limit in re.findall(r"limit (\d+)", sql):
            assert int(limit) <= 100


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert "coi_score" in df.columns and df.count() > 0
