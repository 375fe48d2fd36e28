"""Layouts for reads by key, and the index of names (K6, Q1-Q6)."""

import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rostra.operators import name_index
from rostra.plans import reads, serving
from rostra.schemas import BILL_SUMMARIES


def scanned(df, table):
    """Rows that the scans of a folder handed on, after row groups were skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    leaves = (plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.getClass().getName() else plan).collectLeaves()
    total = 0
    for n in range(leaves.size()):
        leaf = leaves.apply(n)
        inner = leaf.plan().collectLeaves().apply(0) if "QueryStage" in leaf.getClass().getName() else leaf
        if table in inner.toString():
            total += inner.metrics().apply("numOutputRows").value()
    return total


def md5(prefix, n):
    return F.md5(F.concat(F.lit(prefix), n.cast("string")))


@pytest.fixture(scope="module")
def marts(spark):
    n = F.col("id")
    members = spark.range(2_000).select(md5("m", n).alias("member_key"), F.concat(F.lit("Name "), n).alias("name"))
    finance = spark.range(20_000).select(
        md5("m", n % 2_000).alias("member_key"), (2000 + 2 * F.floor(n / 2_000)).cast("int").alias("cycle"),
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in (
            "total_receipts", "total_disbursements", "cash_on_hand", *reads.FUNDING_PARTS, "pac_pct_of_total", "individual_pct_of_total")],
    )
    bills = spark.range(3_000).select(
        md5("b", n).alias("bill_key"), F.concat(F.lit("HB "), n).alias("identifier"), F.lit("t").alias("title"),
        F.lit(None).cast("string").alias("abstract"), F.lit("u").alias("url"),
    )
    votes = spark.range(60_000).select(
        md5("m", n % 2_000).alias("person_key"), md5("b", F.pmod(F.xxhash64(n), F.lit(3_000))).alias("bill_key"),
        F.concat(F.lit("v"), n).alias("vote_event_id"), F.date_add(F.lit("2024-01-01"), (n % 300).cast("int")).alias("vote_date"),
        F.lit("yes").alias("vote_option"), F.lit("pass").alias("vote_result"), F.lit("x").alias("motion_text"),
    )
    sponsored = spark.range(9_000).select(
        md5("m", n % 2_000).alias("person_key"), md5("b", n % 3_000).alias("bill_key"), (n % 2 == 0).alias("is_primary"),
        F.lit(None).cast("date").alias("introduced_date"),
    )
    summaries = spark.createDataFrame([], BILL_SUMMARIES)
    return {"dim_members": members, "fct_member_finance": finance, "dim_bills": bills, "fct_votes": votes,
            "fct_bill_sponsorships": sponsored, "bill_summaries": summaries}


def rows(df):
    return sorted(map(str, df.collect()))


def test_one_key_reads_one_range(spark, marts, tmp_path):
    path = str(tmp_path / "finance")
    table = serving.write_clustered(marts["fct_member_finance"], path, ["member_key", "cycle"], files=20)
    key = marts["dim_members"].first().member_key
    found = table.where(F.col("member_key") == key)
    assert rows(found) == rows(marts["fct_member_finance"].where(F.col("member_key") == key))
    assert 0 < scanned(found, "finance") <= 20_000 / 20 * 2
    assert scanned(table.where("member_key = 'no such key'"), "finance") == 0


def test_a_hot_key_runs_over_several_files(spark, tmp_path):
    df = spark.range(10_000).select(F.when(F.col("id") < 6_000, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    serving.write_clustered(df, str(tmp_path / "t"), ["k", "id"], files=10)
    files = [spark.read.parquet(str(f)).where("k = 'hot'").count() for f in Path(tmp_path / "t").glob("*.parquet")]
    assert sum(files) == 6_000 and sum(n > 0 for n in files) >= 5


def test_record_of_a_member_needs_no_exchange(spark, marts, tmp_path):
    r = serving.publish(spark, marts, str(tmp_path / "serving"), f"t{uuid.uuid4().hex}", buckets=32)
    key = marts["dim_members"].first().member_key
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = ("dim_members", "dim_bills", "fct_bill_sponsorships", "fct_votes", "bill_summaries")
        found = reads.member_record(*[r[a] for a in args], key)
        expected = reads.member_record(*[marts[a] for a in args], key)
        for name in ("sponsored", "votes"):
            assert rows(found[name]) == rows(expected[name]) and found[name].count() > 0
            plan = found[name]._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        # 30 votes of 60,000; buckets without a vote of this person are skipped by their Bloom filters.
        assert scanned(r["fct_votes"].where(F.col("person_key") == key), "fct_votes") < 60_000 * 0.75
        assert scanned(r["fct_votes"].where("person_key = 'nobody'"), "fct_votes") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    rnd = random.Random(2)
    names = ["".join(rnd.choice("aAbBcC, é%_\\") for _ in range(rnd.randint(0, 14))) for _ in range(3_000)]
    df = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(names)] + [("none", None)], "member_key string, name string").cache()
    path = str(tmp_path / "index")
    name_index.build_index(df, "member_key", "name", path)
    used = 0
    for _ in range(40):
        start = rnd.choice([n for n in names if len(n) > 8])
        at = rnd.randint(0, 5)
        q = start[at : at + rnd.randint(1, 7)].replace("\\", "")
        if rnd.random() < 0.5 and len(q) > 4:
            q = q[:4] + rnd.choice("%_") + q[5:]
        q = rnd.choice([q, q.upper()])
        found = name_index.search(df, "member_key", "name", q, path)
        assert rows(found) == rows(df.where(F.col("name").ilike(f"%{q}%")))
        used += bool(name_index.needed(spark, q))
    assert 10 < used < 40
    assert name_index.needed(spark, "ab%c_d") == [] and name_index.needed(spark, "ABcd%xyz") == ["abc", "bcd", "xyz"]
    assert name_index.search(df, "member_key", "name", "qqq", path).count() == 0
