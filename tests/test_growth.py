"""Files, pairs and tasks that must not grow faster than the tables."""

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from pyspark.sql import functions as F

from catalog import derived, insights, landed, models
from rostra import session
from rostra.functions import numbers
from rostra.operators import dedup, similar_rows
from rostra.plans import build, donors, quality, serving
from rostra.sinks import merged

from test_donors import gifts, rows_of
from test_similar_rows import by_hand, run

SF = "/root/testdata/sf0.001"


def test_membership_files_hold_many_members(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "shared_dir", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(landed, "MEMBERS_A_FILE", 60)
    members = spark.read.parquet(f"{SF}/customer.parquet").count()
    found = landed.membership_files(spark, SF)
    assert found.count() == members
    assert len(list(Path(tmp_path).glob("committee-files/members/**/*.txt"))) == -(-members // 60)


def _never(*_):
    raise AssertionError("no blocks are needed")


def test_columns_of_few_entries_are_paired_directly(spark, monkeypatch):
    monkeypatch.setattr(similar_rows, "_products", _never)
    rng = np.random.default_rng(5)
    rows, held = [], {}
    for e in range(300):
        for p in rng.choice(40, 3, replace=False):
            v = int(rng.choice([-1, 1, 2]))
            rows.append((f"p{p:02}", f"b{e % 2}", f"e{e}", v))
            held.setdefault(f"p{p:02}", {})[(e % 2, e)] = v
    for e in range(50):  # roll calls of one voter count for its length only
        rows.append(("p00", "b0", f"own{e}", 1))
        held.setdefault("p00", {})[("own", e)] = 1
    assert run(spark, rows, 5) == by_hand(held, 5)


def test_similar_legislators_makes_no_blocks(spark, monkeypatch):
    """Roll calls of three voters: every block of rows was sent to every other, which grows with the square of the rows."""
    monkeypatch.setattr(similar_rows, "_products", _never)
    found = insights.QUERIES["similar_legislators"](spark, SF).collect()
    assert found and all(r["similarity"] > 0 and 1 <= r["rank"] <= 5 for r in found)


@pytest.mark.parametrize(("copies", "k"), [(7, 5), (3, 5), (1, 5), (4, 2)])
def test_equal_rows_are_multiplied_once(spark, monkeypatch, copies, k):
    monkeypatch.setattr(similar_rows, "CLASSES_FROM", 10)
    multiplied, whole = [], similar_rows._multiplied

    def counted(entries, *rest):
        multiplied.append(entries.select("r").distinct().count())
        return whole(entries, *rest)

    monkeypatch.setattr(similar_rows, "_multiplied", counted)
    rng = np.random.default_rng(6)
    rows, held = [], {}
    for p in range(24):
        own = {e: int(v) for e, v in enumerate(rng.integers(-2, 3, 30)) if v}
        many = copies if p % 3 else 1
        for n in range(many + (p % 4 == 1)):
            scale = 3 if n == many else 1  # the same direction, but another row
            name = f"p{(p * 7 + n * 11) % 100:02}-{p}-{n}"
            held[name] = {(0, e): scale * v for e, v in own.items()}
            rows += [(name, "b", f"e{e}", scale * v) for e, v in own.items()]
    assert run(spark, rows, k, block_rows=8) == by_hand(held, k)
    assert multiplied == [24 + 6] and (copies == 1 or len(held) > 30)


def test_rows_with_enough_equals_need_no_product(spark, monkeypatch):
    monkeypatch.setattr(similar_rows, "CLASSES_FROM", 10)
    monkeypatch.setattr(similar_rows, "_products", _never)
    rows = [(f"p{p:02}", "b", f"e{e}", 1 + (p % 2) * (e % 2)) for p in range(40) for e in range(9)]
    held = {}
    for p, _, e, v in rows:
        held.setdefault(p, {})[(0, e)] = v
    assert run(spark, rows, 5) == by_hand(held, 5)


@pytest.mark.parametrize(("narrow", "most", "k"), [(4096, 3, 5), (0, 3, 5), (4096, 200_000, 2), (0, 200_000, 2)])
def test_what_is_sent_does_not_grow_with_the_pairs_of_blocks(spark, monkeypatch, narrow, most, k):
    """Every block of rows was sent to each other, and every row came back with its best of each."""
    monkeypatch.setattr(similar_rows, "NARROW", narrow)
    sent, whole = [], similar_rows._products

    def counted(pairs, *rest):
        found = whole(pairs, *rest)
        many = found.groupBy("rid").count().agg(F.max("count")).first()[0]
        sent.append((pairs.count(), many, found._jdf.queryExecution().executedPlan().toString()))
        return found

    monkeypatch.setattr(similar_rows, "_products", counted)
    rng = np.random.default_rng(8)
    rows, held = [], {}
    for p in range(260):
        own = {e: int(v) for e, v in enumerate(rng.integers(-most // 3, most, 40)) if v and rng.random() < 0.7}
        if p % 10 == 9:  # nearly the same direction as the row before
            own = {e: v + (e == p % 40) for e, v in before.items() if v + (e == p % 40)}
        before = own
        held[f"p{p:03}"] = {("b", e): v for e, v in own.items()}
        rows += [(f"p{p:03}", "b", f"e{e}", v) for e, v in own.items()]
    assert run(spark, rows, k, block_rows=2) == by_hand(held, k)
    (own, few, _), (other, many, plan) = sent
    assert own >= 100 and other > own and few <= k and many <= k
    assert "vs" not in plan and "cids" not in plan


def test_layouts_that_cannot_fit_are_not_tried(spark):
    texts = ["2024-03-05", "03/05/2024", "5-Mar-2024", "2024-03-05T10:00:00", "2024-03-05 10:00", "March 5, 2024,  01:02 PM",
             "", "x", "5-3-2024", "2024/03/05", "Mar", "5-Mär-2024", "T", "March 5 2024", None, "13/40/2024", " 2024-03-05"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    squeezed = F.trim(F.regexp_replace("t", r"\s+", " "))
    iso = F.regexp_extract("t", r"^(\d{4}-\d{2}-\d{2})[T ]", 1)
    plain_day = F.coalesce(*[F.try_to_date("t", f) for f in numbers.DATE_FORMATS], F.try_to_date(iso, "yyyy-MM-dd"))
    plain_time = F.coalesce(
        squeezed.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(squeezed, F.lit(f)).cast("timestamp_ntz") for f in numbers.TIMESTAMP_FORMATS],
    )
    found = df.select(
        "t", numbers.try_date(F.col("t")).alias("a"), plain_day.alias("b"),
        numbers.try_timestamp(F.col("t")).alias("c"), plain_time.alias("d"),
    ).collect()
    assert [(r.t, r.a, r.c) for r in found] == [(r.t, r.b, r.d) for r in found]
    assert sum(r.a is not None for r in found) == 5


def test_many_short_rows_are_nested_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(derived, "ROWS_A_TASK", 50)
    parts = spark.read.parquet(f"{SF}/part.parquet").count()
    for name, rows in (("bills", parts), ("congress_bills", 1500), ("congress_house_votes", 1000)):
        made = derived.RAW[name](spark, SF)
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= rows / 50 / 2 and max(sizes) <= 4 * 50


def test_relations_of_the_checks_are_made_once(spark, monkeypatch):
    written, whole = [], build.staged
    monkeypatch.setattr(build, "staged", lambda df, name: written.append(name) or whole(df, name))
    models.dq(spark, SF)
    assert len(written) == len(set(written))
    assert {"dim_bills", "fct_votes", "stg_congress__house_votes"} <= set(written)


@pytest.mark.parametrize("query", [models.dq, models.dq_watched])
def test_what_no_check_and_no_model_reads_is_deleted(spark, monkeypatch, query):
    there, whole = {}, build.staged

    def looked(df, name):
        there[name] = [path.split("/")[-1] for path in session.scratch_since(mark)]
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
        assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
        return whole(df, name)

    monkeypatch.setattr(build, "staged", looked)
    before, mark = {k: spark.conf.get(k) for k in session.FRUGAL_SETTINGS}, session.scratch_mark()
    found = query(spark, SF)
    assert session.scratch_since(mark) == []
    assert {k: spark.conf.get(k) for k in session.FRUGAL_SETTINGS} == before
    at_votes = {name.rsplit("-", 1)[0] for name in there["fct_votes"]}
    assert {"dim_bills", "stg_congress__house_votes", "int_persons__federal"} <= at_votes
    assert not {"stg_nyc_cfb__contributions", "fct_contributions", "dim_candidates", "hot-keys", "newest-bills"} & at_votes
    assert [(r.check, r.relation, r.column) for r in found.collect()] == [(c.kind, c.relation, c.column) for c in quality.CHECKS]


def test_checks_are_run_by_hashes_and_packed_keys(spark, monkeypatch):
    key = lambda n: hashlib.md5(str(n).encode()).hexdigest()
    odd = ["", "x", key(1).upper(), key(2)[:31], key(3) + "0", key(4) + "\n", "\x00" * 16, "é", key(5)]
    rows = [(key(n % 70), n % 3, "a") for n in range(100)] + [(v, n % 2, "b") for n, v in enumerate(odd * 2)] + [(None, 1, "b"), (key(1), None, "b")]
    child = spark.createDataFrame(rows, "k string, n int, t string")
    parent = spark.createDataFrame([(key(n),) for n in range(3, 40)] + [("x",), ("",), (key(1).upper(),), (None,)], "k string")
    checks = [
        quality.unique("child", "k"), quality.unique("child", "k", "n"), quality.unique("child", "k", where="t = 'b'"),
        quality.unique("child", "n"), quality.unique("parent", "k"), quality.relates("child", "k", "parent"),
        *quality.not_null("child", "k", "n"), quality.accepted("child", "t", ["a"]),
    ]

    def repeated(values):
        return sum(n > 1 for n in Counter(v for v in values if None not in v).values())

    known = {r[0] for r in parent.collect()}
    wanted = [
        repeated((k,) for k, _, _ in rows), repeated((k, n) for k, n, _ in rows), repeated((k,) for k, _, t in rows if t == "b"),
        3, 0, sum(k is not None and k not in known for k, _, _ in rows), 1, 1, 20,
    ]

    def run():
        progress = quality.Progress(checks)
        progress.made({"parent": parent})
        assert progress.waits_for() == {"child", "parent"}
        progress.made({"parent": parent, "child": child})
        return [r.failures for r in progress.result(spark).collect()]

    assert run() == wanted
    monkeypatch.setattr(quality, "SHARED_HASHES", 2)  # all values are counted
    assert run() == wanted
    monkeypatch.undo()
    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.lit(7).cast("long"))  # every hash is shared
    assert run() == wanted


def test_watched_rows_are_not_read_again(spark, tmp_path, monkeypatch):
    checks = [*quality.not_null("r", "a", "b"), quality.accepted("r", "b", ["x", "y"], severity="warn")]
    watch, df = quality.Watch(checks), spark.createDataFrame([(1, "x"), (None, "z"), (None, None), (2, "w")], "a int, b string")
    watch.on("r", df).write.parquet(str(tmp_path / "r"))
    progress = quality.Progress(checks, watch)
    monkeypatch.setattr(quality, "_violates", _never)
    progress.made({"r": df})
    assert [(r.severity, r.failures, r.passed) for r in progress.result(spark).collect()] == [
        ("error", 2, False), ("error", 1, False), ("warn", 2, False),
    ]


def test_keys_are_counted_in_full_groups_only(spark, monkeypatch):
    df = spark.createDataFrame([(f"k{n % 50}" if n % 4 else None, n) for n in range(400)], "k string, n int")
    for groups in (1, 3, 1 << 14):
        monkeypatch.setattr(dedup, "KEY_GROUPS", groups)
        assert [r.k for r in dedup.hot_keys(df, ["k"], 100).collect()] == [None]
        assert dedup.hot_keys(df, ["k"], 101).isEmpty()


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(serving, "BUCKET_BILLS", 100)
    votes = spark.range(200_000).select(
        F.md5((F.col("id") % 1000).cast("string")).alias("bill_key"), F.md5(F.col("id").cast("string")).alias("person_key"))
    bills = votes.select("bill_key").distinct()
    for key in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"):
        spark.conf.set(f"spark.sql.adaptive.{key}", "200k")
    try:
        found = serving.publish(spark, {"dim_bills": bills, "fct_votes": votes}, str(tmp_path), "growth", buckets=4)
    finally:
        for key in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"):
            spark.conf.unset(f"spark.sql.adaptive.{key}")
    files = len(list((tmp_path / "fct_votes").glob("*.parquet")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = found["fct_votes"].join(found["dim_bills"], "bill_key")
    try:
        assert joined.count() == 200_000
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 16 out of 16" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("growth_dim_bills", "growth_fct_votes"):
            spark.sql(f"drop table {name}")
    assert files > 16


def test_a_repeat_is_known_before_its_rows_are_read(spark, tmp_path, monkeypatch):
    path, every = str(tmp_path / "edges"), gifts(spark)
    monkeypatch.setattr(merged, "PIECE_ROWS", 20)
    assert donors.merge_edges(path, every.where("day(load_at) < 3"), buckets=4, batch="a") == [0, 1, 2, 3]
    assert donors.merge_edges(path, every.where("day(load_at) >= 3"), buckets=4, batch="b") == [0, 1, 2, 3]
    assert rows_of(merged.read_merged(spark, path).drop("_bucket")) == rows_of(donors.fct_donor_candidate_edges(every))
    assert all(len(list(f.glob("*.parquet"))) > 1 for f in (tmp_path / "edges").glob("_bucket=*"))
    monkeypatch.setattr(merged, "aggregated", _never)
    assert donors.merge_edges(path, every, buckets=4, batch="a") == []
