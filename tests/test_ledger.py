"""Loads that are repeated, replaced or raced (K5, K7); headers and shapes that drift (S3, S4, N3); watched checks."""

import json

import pytest
from pyspark.sql import functions as F

from rostra import sinks
from rostra.operators import nested
from rostra.plans import quality
from rostra.session import staged
from rostra.sinks import ledger
from rostra.sources import landing

KIND = "recipid string, amnt string"


def gifts(spark, *rows):
    return spark.createDataFrame(list(rows), KIND)


def held(spark, root):
    return sorted((r.recipid, r.amnt) for r in landing.raw_table(spark, str(root), "nyc_cfb_contributions").collect())


def test_a_period_is_replaced_and_a_repeat_skipped(spark, tmp_path):
    name, root = "nyc_cfb_contributions", str(tmp_path)
    sinks.load_table(gifts(spark, ("old", "1")), root, name)  # without a ledger
    assert ledger.load_period(gifts(spark, ("a", "1"), ("a", "1")), root, name, 2021)
    assert not ledger.load_period(gifts(spark, ("a", "1"), ("a", "1")), root, name, 2021)
    assert ledger.load_period(gifts(spark, ("b", "2")), root, name, 2023)
    assert held(spark, root) == [("a", "1"), ("a", "1"), ("b", "2"), ("old", "1")]
    assert ledger.load_period(gifts(spark, ("a", "3")), root, name, 2021)
    assert held(spark, root) == [("a", "3"), ("b", "2"), ("old", "1")]
    assert ledger.load_period(gifts(spark, ("c", "9")), root, name, 2023, replace=False)
    assert not ledger.load_period(gifts(spark, ("b", "2")), root, name, 2023, replace=False)
    assert held(spark, root) == [("a", "3"), ("b", "2"), ("c", "9"), ("old", "1")]
    # A load that was written and never committed is not seen.
    ledger._write(gifts(spark, ("ghost", "0")).withColumn("LOAD_AT", F.current_timestamp()), f"{root}/{name}")
    assert held(spark, root) == [("a", "3"), ("b", "2"), ("c", "9"), ("old", "1")]


def test_an_entry_is_made_once(spark, tmp_path):
    path = str(tmp_path / "with blank")
    assert ledger.entries(spark, path) == []
    assert ledger.commit(spark, path, 0, {"n": 1}) and not ledger.commit(spark, path, 0, {"n": 2})
    assert ledger.commit(spark, path, 1, {"n": 3})
    assert ledger.entries(spark, path) == [{"n": 1}, {"n": 3}]
    assert [json.loads(f.read_text())["n"] for f in sorted((tmp_path / "with blank/_ledger").glob("*.json"))] == [1, 3]


def test_two_writers_do_not_both_add_a_key(spark, tmp_path):
    path, shape = str(tmp_path), "k string, who string"
    one = spark.createDataFrame([("x", "one"), ("y", "one"), ("y", "one"), (None, "one")], shape)
    two = spark.createDataFrame([("y", "two"), ("z", "two")], shape)
    added = []

    def other():
        if not added:
            added.append(ledger.insert_absent(two, path, "k"))

    assert ledger.insert_absent(one, path, "k", before_commit=other) == 1 and added == [2]
    rows = {(r.k, r.who) for r in ledger.read(spark, path, one.schema).collect()}
    assert rows == {("x", "one"), ("y", "two"), ("z", "two")}
    assert ledger.insert_absent(one, path, "k") == 0 and len(ledger.entries(spark, path)) == 2


def test_headers_come_from_a_scan(spark, tmp_path, monkeypatch):
    """Many files in two column orders; the driver lists them and opens none."""
    assert not hasattr(landing, "_header")
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(300):
        lines = ("a,b", f"{i},x{i}") if i % 2 else ("B, A,c", f"x{i},{i},more")
        (folder / f"f {i}%.csv").write_text("\n".join(lines) + "\n")
    (folder / "none.csv").write_text("")
    df = landing.read_csv_by_name(spark, str(folder), ["a", "b"])
    assert sorted((int(r.a), r.b) for r in df.collect()) == [(i, f"x{i}") for i in range(300)]
    headers = landing._headers(spark, landing._files(spark, str(folder), ".csv"))
    assert {h: len(f) for h, f in headers.items()} == {("a", "b"): 150, ("B", " A", "c"): 150}
    (folder / "bad.csv").write_text("a,c\n1,2\n")
    with pytest.raises(landing.SourceError, match="bad.csv"):
        landing.read_csv_by_name(spark, str(folder), ["a", "b"])


def test_headers_of_files_cut_into_blocks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "long.csv").write_text("a,b\n" + "".join(f"{i},{i}\n" for i in range(5_000)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        assert landing.read_csv_by_name(spark, str(tmp_path), ["b"]).count() == 5_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fields_that_change_their_shape(spark, tmp_path):
    pages = [
        {"members": [{"id": "a", "terms": {"item": [{"congress": 118}]}, "n": 1}, {"id": "b", "terms": [1, 2], "n": "many"}]},
        {"members": [{"id": {"x": 1}, "terms": None, "n": 2.5}]},
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    fields = {"id": ("$.id", "string"), "congress": ("$.terms.item[0].congress", "int"), "n": ("$.n", "int")}
    rows = {(r.id, r.congress, r.n) for r in landing.read_drifting_pages(spark, str(tmp_path), "members", fields).collect()}
    assert {r[1:] for r in rows if r[0] in ("a", "b")} == {(118, 1), (None, None)}
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception, match="no list"):
        landing.read_drifting_pages(spark, str(tmp_path), "members", fields).collect()
    texts = ['{"k": 1}', '{"k": [1, "x", 3]}', '{"k": {"v": 1}}', "{}", "not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [tuple(r) for r in df.select(nested.drifting("t", "$.k", "int"), nested.one_or_many("t", "$.k", "int")).collect()]
    assert found == [(1, [1]), (None, [1, None, 3]), (None, None), (None, None), (None, None), (None, None)]


def test_watched_checks_need_no_further_scan(spark):
    df = spark.createDataFrame([("a", "F"), (None, "O"), ("b", "X"), ("b", None)], "k string, s string")
    checks = [quality.unique("t", "k"), *quality.not_null("t", "k", "s"), quality.accepted("t", "s", ["F", "O"], severity="warn")]
    expected = sorted(map(tuple, quality.report({"t": df}, checks).collect()))
    watch = quality.Watch(checks)
    written = staged(watch.on("t", df), "watched")
    assert watch.counts("t") == [1, 1, 1] and watch.counts("other") is None
    report = quality.report({"t": written}, checks, watch)
    assert sorted(map(tuple, report.collect())) == expected
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1  # the unique check's
    assert watch.on("other", df) is df
