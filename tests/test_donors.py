"""Aggregates that grow by loads, donor edges, shared donors, finance per candidacy."""

import itertools
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostra.plans import donors
from rostra.sinks import merged

SHAPE = (
    "transaction_ref string, recipient_id string, election_cycle int, office_code string, contributor_name string, "
    "zip string, employer_name string, amount decimal(18,0), matchable_amount decimal(18,0), contribution_date date, load_at timestamp"
)


def gifts(spark, seed=3, n=400, donors_=60, candidates=7):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        hub = rng.random() < 0.2  # one donor gives to everybody
        name = "Hub" if hub else f"Donor {rng.integers(donors_)}"
        day = None if i % 9 == 0 else date(2021, 1, 1 + int(rng.integers(28)))
        rows.append((f"t{i}", f"R{rng.integers(candidates)}", 2021, None if i % 50 == 0 else "IS" if i % 31 == 0 else "1", name, "1", "x",
                     Decimal(int(rng.integers(1, 400))), None if i % 5 == 0 else Decimal(1), day, datetime(2021, 1, 1 + i * 4 // n)))
    return spark.createDataFrame(rows, SHAPE)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_loads_in_any_order_and_again_equal_a_rebuild(spark, tmp_path):
    every = gifts(spark).cache()
    whole = rows_of(donors.fct_donor_candidate_edges(every))
    loads = [every.where(F.dayofmonth("load_at") == d) for d in (1, 2, 3, 4)]
    for n, order in enumerate([(0, 1, 2, 3), (3, 1, 0, 2), (2, 2, 0, 3, 1, 0)]):
        path = str(tmp_path / f"edges{n}")
        for at in order:
            donors.merge_edges(path, loads[at], buckets=8)
        assert rows_of(merged.read_merged(spark, path).drop("_bucket")) == whole
    assert donors.merge_edges(path, loads[3], buckets=8) == []
    assert donors.merge_edges(path, loads[3], buckets=8, batch="meant again") != []
    assert donors.merge_edges(path, loads[3].limit(0), buckets=8) == []


def test_only_folders_of_a_delta_are_rewritten(spark, tmp_path):
    path = tmp_path / "edges"
    every = gifts(spark)
    donors.merge_edges(str(path), every, buckets=32, batch="base")
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    one = every.where("contributor_name = 'Hub' and office_code = '1'").limit(1)
    touched = donors.merge_edges(str(path), one, buckets=32, batch="more")
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert len(touched) == 1
    changed = {f.parent.name for f in before.keys() ^ after.keys()}
    assert changed == {f"_bucket={touched[0]}"} and all(after[f] == t for f, t in before.items() if f in after)


def test_a_run_that_broke_off_is_completed(spark, tmp_path):
    path, every = str(tmp_path / "edges"), gifts(spark)
    base, delta = every.where("transaction_ref < 't2'"), every.where("transaction_ref >= 't2'")
    donors.merge_edges(path, base, buckets=4, batch="base")
    part = donors.attributed(delta).where(F.pmod(F.xxhash64("donor_key"), F.lit(4)).isin(0, 2))
    assert merged.merge_into(path, part, donors.EDGE_KEYS, donors.edge_measures(), ["donor_key"], 4, "delta") == [0, 2]
    assert donors.merge_edges(path, delta, buckets=4, batch="delta") == [1, 3]
    assert rows_of(merged.read_merged(spark, path).drop("_bucket")) == rows_of(donors.fct_donor_candidate_edges(every))


def test_high_water_mark(spark, tmp_path):
    path, every = str(tmp_path / "edges"), gifts(spark)
    assert merged.high_water(spark, path) is None
    assert merged.not_merged(every, path).count() == every.count()
    donors.merge_edges(path, every.where("dayofmonth(load_at) <= 2"), buckets=4)
    assert merged.high_water(spark, path) == datetime(2021, 1, 2)
    rest = merged.not_merged(every, path)
    assert {r[0].day for r in rest.select("load_at").distinct().collect()} == {3, 4}
    donors.merge_edges(path, rest, buckets=4)
    assert rows_of(merged.read_merged(spark, path).drop("_bucket")) == rows_of(donors.fct_donor_candidate_edges(every))
    with pytest.raises(ValueError):
        donors.merge_edges(path, every, buckets=5, batch="other layout")


def test_shared_donors(spark, tmp_path):
    path = str(tmp_path / "edges")
    every = gifts(spark)
    donors.merge_edges(path, every, buckets=16)
    edges = merged.read_merged(spark, path)
    held = {}
    for r in edges.collect():
        held.setdefault(r.candidacy_key, {})[r.donor_key] = r.total_amount
    for mine in held:
        expected = {
            (c, len(d.keys() & held[mine].keys()), sum(v for k, v in d.items() if k in held[mine]))
            for c, d in held.items() if c != mine and d.keys() & held[mine].keys()
        }
        found = donors.shared_donors(edges, mine)
        assert {tuple(r) for r in found.collect()} == expected
    assert donors.shared_donors(edges, "nobody").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "LeftSemi" in plan


def test_finance_from_merged_sums(spark, tmp_path):
    edges, sums, every = str(tmp_path / "edges"), str(tmp_path / "sums"), gifts(spark)
    for d in (2, 4, 1, 3, 2):
        load = every.where(F.dayofmonth("load_at") == d)
        donors.merge_edges(edges, load, buckets=4)
        donors.merge_finance(sums, load, buckets=2)
    found = {r.candidacy_key: r for r in donors.stored_finance(spark, sums, edges).collect()}
    rows = donors.attributed(every).collect()
    for key, own in itertools.groupby(sorted(rows, key=lambda r: r.candidacy_key), lambda r: r.candidacy_key):
        own, r = list(own), found.pop(key)
        total = sum(x.amount for x in own)
        assert (r.total_raised, r.contribution_count, r.unique_donor_count) == (total, len(own), len({x.donor_key for x in own}))
        assert abs(float(r.avg_contribution) - float(total) / len(own)) < 0.006
        assert r.pct_small_dollar == 100.0 * sum(x.amount < 200 for x in own) / len(own)
        assert r.total_spent is None and r.coverage == "nyc_cfb"
    assert not found


def test_sketches_of_loads_estimate_distinct_donors(spark, tmp_path):
    path = str(tmp_path / "sums")
    for part in range(3):  # overlapping thirds of 30,000 donors
        rows = spark.range(part * 7_500, part * 7_500 + 15_000).select(
            F.concat(F.lit("d"), "id").alias("donor_key"), F.lit("c").alias("candidacy_key"), F.lit(1).alias("amount"),
        )
        merged.merge_into(path, rows, ["candidacy_key"], {"donors": ("sketch", F.col("donor_key"))}, ["candidacy_key"], 2)
    estimate = merged.read_merged(spark, path).select(F.hll_sketch_estimate("donors")).first()[0]
    assert abs(estimate / 30_000 - 1) < 3 * merged.SKETCH_ERROR
