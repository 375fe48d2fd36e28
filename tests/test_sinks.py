from rostra import sinks
from rostra.operators.dedup import latest_wins


def frame(spark, rows):
    return spark.createDataFrame(rows, "`Candidate ID` string, name string")


def test_raw_file_is_replaced_and_empty_input_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_raw_file(frame(spark, []), path) is None
    assert not (tmp_path / "t").exists()
    sinks.write_raw_file(frame(spark, [("a", "x")]), path)
    sinks.write_raw_file(frame(spark, [("b", "y")]), path)
    assert [r.name for r in spark.read.parquet(path).collect()] == ["y"]


def test_load_appends_by_default(spark, tmp_path):
    root = str(tmp_path)
    assert not sinks.load_table(frame(spark, []), root, "t")
    sinks.load_table(frame(spark, [("a", "x")]), root, "t")
    sinks.load_table(frame(spark, [("a", "y")]), root, "t")
    df = spark.read.parquet(f"{root}/t")
    assert df.columns == ["CANDIDATE_ID", "NAME", "LOAD_AT"] and df.count() == 2
    assert df.where("load_at is null").isEmpty()
    sinks.load_table(frame(spark, [("a", "z")]), root, "t", overwrite=True)
    assert spark.read.parquet(f"{root}/t").count() == 1


def test_phantom_columns_are_dropped(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a b,c,\n1,2,\n")
    df = spark.read.csv(str(tmp_path), header=True)
    assert sinks.normalise_columns(df).columns == ["A_B", "C"]


def test_sources_can_be_chosen(spark, tmp_path):
    readers = {
        "fec": lambda: {"candidates": frame(spark, [("a", "x")])},
        "census": lambda: {"states": frame(spark, [("b", "y")])},
    }
    assert sinks.load_sources(readers, str(tmp_path), source="fec") == {"fec": {"candidates": True}}
    assert not (tmp_path / "states").exists()
    assert set(sinks.load_sources(readers, str(tmp_path))) == {"fec", "census"}


def test_backfill_can_run_twice(spark, tmp_path):
    def period(cycle):
        return {"t": frame(spark, [(f"c{cycle}", "x"), ("all", str(cycle))])}

    for _ in range(2):
        sinks.backfill(period, [2020, 2022], str(tmp_path))
    df = spark.read.parquet(f"{tmp_path}/t")
    assert df.count() == 8
    kept = latest_wins(df, ["CANDIDATE_ID"], "LOAD_AT").collect()
    assert sorted((r.CANDIDATE_ID, r.NAME) for r in kept) == [("all", "2022"), ("c2020", "x"), ("c2022", "x")]


def test_insert_absent(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("b1", "old", None)], "bill_key string, plain_summary string, generated_at timestamp").write.parquet(path)
    new = spark.createDataFrame([("b1", "new"), ("b2", "new"), ("b2", "new")], "bill_key string, plain_summary string")
    for _ in range(2):
        sinks.insert_absent(new, path, "bill_key")
    rows = {r.bill_key: r for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 2
    assert rows["b1"].plain_summary == "old" and rows["b2"].generated_at is not None


def test_tables_views_and_comments(spark, tmp_path):
    df = sinks.document(frame(spark, [("a", "x")]).withColumnRenamed("Candidate ID", "id"), {"id": "The ID.", "no": "-"})
    table = sinks.materialise_table(df, str(tmp_path / "m"))
    assert table.schema["id"].metadata["comment"] == "The ID."
    sinks.materialise_view(table, "a_view")
    assert spark.table("a_view").count() == 1
