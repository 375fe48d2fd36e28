import random
from datetime import datetime

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rostra.operators import aggregates, dedup, joins, matching, nested, paging, unions


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_latest_wins(spark):
    t = [datetime(2024, 1, d) for d in (1, 2)]
    df = spark.createDataFrame(
        [("a", 1, t[0]), ("a", 2, t[1]), ("b", 3, None), ("b", 4, t[1]), ("c", 5, t[0]), ("c", 5, t[0])],
        "k string, v int, load_at timestamp",
    )
    assert rows(dedup.latest_wins(df, ["k"]), "k", "v") == [("a", 2), ("b", 3), ("c", 5)]
    again = dedup.latest_wins(df.unionByName(df), ["k"])
    assert rows(again, "k", "v") == [("a", 2), ("b", 3), ("c", 5)]


def test_latest_wins_is_cut_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = dedup.latest_wins(df, ["o_custkey"], "o_orderdate")._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_one_to_one_losers_get_nothing(spark):
    df = spark.createDataFrame(
        [("m1", "c1", 90), ("m2", "c1", 95), ("m2", "c2", 88), ("m3", "c3", 91), ("m4", "c3", 91)],
        "m string, c string, score int",
    )
    # m1's only candidate goes to m2, m3 beats m4 by its id, and there is no second round.
    assert rows(dedup.one_to_one(df, "m", "c", "score")) == [("m2", "c1", 95), ("m3", "c3", 91)]


def _copies():
    rnd = random.Random(2)
    data = [("hot", rnd.randint(1, 3), rnd.randint(0, 9)) for _ in range(900)]
    data += [("hot", 1, 5)] * 700 + [(f"k{i % 50}", rnd.randint(1, 3), i) for i in range(400)]
    data += [(None, 1, 1)] * 30
    rnd.shuffle(data)
    return data


@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_dedup_sequence_numbers_every_row(spark, hot_rows):
    data = _copies()
    df = spark.createDataFrame(data, "k string, load_at int, v int")
    assert dedup.hot_keys(df, ["k"], hot_rows).count() == (2 if hot_rows == 20 else 0)
    got = dedup.dedup_sequence(df, ["k"], hot_rows=hot_rows).collect()
    assert sorted((r.k, r.load_at, r.v) for r in got if r.k) == sorted(d for d in data if d[0])
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, []).append((r.dedup_seq, r.load_at))
    for numbered in by_key.values():
        numbered.sort()
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [t for _, t in numbered] == sorted(t for _, t in numbered)


def test_dedup_sequence_changes_no_value(spark):
    df = spark.createDataFrame([("a", i % 7 if i % 5 else None, -0.0 if i % 2 else 0.0) for i in range(200)], "k string, load_at int, v double")
    for hot_rows in (10, 1000):
        got = dedup.dedup_sequence(df, ["k"], hot_rows=hot_rows).collect()
        assert sum(str(r.v) == "-0.0" for r in got) == 100
        assert sorted(r.dedup_seq for r in got) == list(range(1, 201))
        loads = [r.load_at for r in sorted(got, key=lambda r: r.dedup_seq)]
        assert loads == sorted(loads, key=lambda t: (t is None, t or 0))
    one = {(r.dedup_seq, r.load_at, str(r.v)) for r in dedup.dedup_sequence(df, ["k"], hot_rows=10).collect()}
    assert one == {(r.dedup_seq, r.load_at, str(r.v)) for r in dedup.dedup_sequence(df, ["k"]).collect()}


def _names(n, seed):
    rnd = random.Random(seed)
    base = ["SMITH", "SMYTHE", "JOHNSON", "O'NEIL", "MACDONALD", "FITZGERALD-WOLFE", "LI", "HERNANDEZ",
            "VANDERBILT-ROOSEVELT OF THE HUDSON"]
    out = []
    for _ in range(n):
        if rnd.random() < 0.7:
            name = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 4)):
                i = rnd.randrange(len(name) + 1)
                if rnd.random() < 0.5:
                    name.insert(i, rnd.choice("ABCDEHILMNORST"))
                elif len(name) > 1:
                    name.pop(min(i, len(name) - 1))
        else:
            name = [rnd.choice("AEIOULNRST") for _ in range(rnd.randint(0, 9))]
        out.append("".join(name))
    return out


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(9)
    a = pd.DataFrame({"lid": range(500), "block": [rnd.choice("xyz") for _ in range(500)], "lname": _names(500, 1)})
    b = pd.DataFrame({"rid": range(400), "block": [rnd.choice("xyw") for _ in range(400)], "rname": _names(400, 2)})
    a.loc[0, "block"] = None
    b.loc[0, "block"] = None
    a.loc[1, "lname"] = None
    return a, b, spark.createDataFrame(a), spark.createDataFrame(b)


SCORE = "cast(floor(round(100 * jaro_winkler_similarity(lname, rname), 6)) as int)"


@pytest.mark.parametrize("tile", [7, 4096])
def test_name_pairs_equal_brute_force(sides, tile):
    a, b, left, right = sides
    expected = duckdb.sql(
        f"select distinct a.block, lname, rname, {SCORE} from a join b using (block) where {SCORE} >= 85"
    ).fetchall()
    got = matching.name_pairs(left, right, "block", "lname", "rname", tile=tile)
    assert rows(got, "block", "l_name", "r_name", "score") == sorted(expected, key=repr)


@pytest.mark.parametrize("score", [1, 40, 70, 75, 80, 92])
def test_name_pairs_at_other_thresholds(sides, score):
    a, b, left, right = sides
    expected = duckdb.sql(
        f"select distinct a.block, lname, rname from a join b using (block) where {SCORE} >= {score}"
    ).fetchall()
    got = matching.name_pairs(left, right, "block", "lname", "rname", score, tile=50)
    assert rows(got, "block", "l_name", "r_name") == sorted(expected, key=repr)


@pytest.mark.parametrize("tile", [7, 4096])
def test_best_matches_equal_brute_force(sides, tile):
    a, b, left, right = sides
    expected = duckdb.sql(
        f"""with p as (select lid, rid, {SCORE} as s from a join b using (block) where {SCORE} >= 85),
        q as (select * from p qualify row_number() over (partition by lid order by s desc, rid) = 1)
        select * from q qualify row_number() over (partition by rid order by s desc, lid) = 1"""
    ).fetchall()
    got = matching.best_matches(
        left, right, "block", "lid", "lname", "rid", "rname", tile=tile
    )
    assert rows(got, "lid", "rid", "score") == sorted(expected, key=repr)


def test_fuzzy_left_join_keeps_every_left_row(sides):
    a, b, left, right = sides
    expected = duckdb.sql(
        f"select lid, rid from a left join b on a.block = b.block and {SCORE} >= 85"
    ).fetchall()
    got = matching.fuzzy_left_join(left, right, "block", "lname", "rname", tile=50)
    assert rows(got, "lid", "rid") == sorted(expected, key=repr)
    assert {r[0] for r in rows(got, "lid")} == set(a.lid)


def _spread(count, length, alphabet, start="", seed=4):
    rnd = random.Random(seed)
    return sorted({start + "".join(rnd.choice(alphabet) for _ in range(length - len(start))) for _ in range(count)})


@pytest.mark.parametrize(
    ("names", "score", "most"),
    [
        (_spread(20_000, 9, "abcdefghijklmnop", "smi"), 85, 0.13),
        (_spread(20_000, 40, "abcdefghijklmnopqrstuvwxyz"), 85, 0.12),
    ],
    ids=["one start", "long"],
)
def test_large_blocks_are_compared_tile_by_tile(spark, names, score, most):
    """20,000 names of one block: all matches of some names by brute force, and how many pairs are scored."""
    rnd = random.Random(1)
    near = [n[:-2] + rnd.choice("abc") + n[-1] for n in names[::400]] + names[:10]
    left = spark.createDataFrame([("b", n) for n in names[::2]], "block string, lname string")
    right = spark.createDataFrame([("b", n) for n in names[1::2] + near], "block string, rname string")
    got = matching.name_pairs(left, right, "block", "lname", "rname", score)
    asked = spark.createDataFrame([(n,) for n in names[::800]], "l_name string")
    found = {(r[0], r[1]) for r in got.join(asked, "l_name", "left_semi").select("l_name", "r_name").collect()}
    a, b = pd.DataFrame({"lname": names[::800]}), pd.DataFrame({"rname": names[1::2] + near})
    expected = duckdb.sql(f"select distinct lname, rname from a cross join b where {SCORE} >= {score}").fetchall()
    assert found == set(expected) and len(found) > 20
    one, other = matching.Names(names[:500], -1), matching.Names(names[500:4500], -2)
    scored = sum(len(i) for i, _ in matching.plausible(one, other, score / 100))
    assert scored <= most * 500 * 4000


def test_names_of_any_length_and_script(spark):
    odd = ["", "a", "ab" * 200, "ab" * 199 + "ac", "é" * 3, "éé", "日本語", "日本", "x" * 70_000, "x" * 69_999, "😀b", "😀c"]
    left = spark.createDataFrame([(1, n) for n in odd], "block int, lname string")
    right = left.withColumnRenamed("lname", "rname")
    got = matching.name_pairs(left, right, "block", "lname", "rname", 85, tile=3)
    found = {(r.l_name, r.r_name) for r in got.collect()}
    assert ("ab" * 200, "ab" * 199 + "ac") in found and ("日本語", "日本") in found and ("x" * 70_000, "x" * 69_999) in found
    assert all((n, n) in found for n in odd[1:]) and all("" not in pair for pair in found)


def test_keyword_pairs_same_with_and_without_broadcast(spark):
    names = ["Senate Finance", "House Ways and Means", "Rules", None, "", "x", "100% Club", "ab_c"]
    keywords = ["finance", "Way", "WAYS AND MEANS and more", "a", "e", "s%ance", "b_c", "", "%", None, "rules"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    kw = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    short = joins.keyword_pairs(df, "name", kw, "keyword")
    long = joins.keyword_pairs(df, "name", kw, "keyword", small_rows=1)
    assert rows(short, "id", "keyword") == rows(long, "id", "keyword")
    assert (3, None) in rows(short, "id", "keyword")


def test_without_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.without(df, other, {"k": "k"})) == [("b",), (None,)]


def test_lookup_and_flag_keep_unmatched_rows(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    seed = spark.createDataFrame([("a", "A")], "name string, abbr string")
    assert rows(joins.lookup(df, seed, {"k": "name"}, {"state": "abbr"})) == [("a", "A"), ("z", None)]
    side = seed.withColumnRenamed("name", "k")
    assert rows(joins.with_flag(df, side, "k", ["abbr"], "status"), "k", "status") == [
        ("a", "ready"), ("z", "none"),
    ]


def test_joined_distinct_is_empty_text_without_values(spark):
    df = spark.createDataFrame(
        [("m", "B", None), ("m", "A", None), ("m", "A", None), ("n", None, "x")], "k string, a string, b string"
    )
    got = rows(aggregates.joined_distinct(df, ["k"], {"x": "a", "y": "b"}))
    assert got == [("m", "A · B", ""), ("n", "", "x")]


def test_flatten_drops_parents_without_elements(spark):
    df = spark.createDataFrame(
        [(1, [("e", ["x", "y"]), ("f", None)]), (2, []), (3, None)],
        "id int, es array<struct<n:string,vs:array<string>>>",
    )
    assert rows(nested.flatten(df, "es", "e", ["id"]), "id", "e.n") == [(1, "e"), (1, "f")]
    twice = nested.flatten_twice(df, "es", "e", "vs", "v", ["id"])
    assert rows(twice, "id", "e.n", "v") == [(1, "e", "x"), (1, "e", "y")]


def test_breakdown_drops_missing_and_zero(spark):
    df = spark.createDataFrame([(1, 2.5, 0.0, None)], "id int, a double, b double, c double")
    got = nested.breakdown(df, ["id"], {"a": "A", "b": "B", "c": "C"})
    assert rows(got) == [(1, "A", 2.5)]


def test_conform_types_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([("x", 2)], "name string, id int")
    got = unions.conform("id bigint, name string, day date", a, b)
    assert got.schema.simpleString() == "struct<id:bigint,name:string,day:date>"
    assert rows(got) == [(1, None, None), (2, "x", None)]


def test_page_knows_the_total(spark):
    df = spark.range(10).select(F.col("id").alias("n"))
    got = paging.page(df, [F.asc("n")], 3, 4, "total")
    assert [tuple(r) for r in got.collect()] == [(4, 10), (5, 10), (6, 10)]
    assert paging.page(df, [F.asc("n")], 3, 99, "total").count() == 0
    with pytest.raises(ValueError):
        paging.page(df, [F.asc("n")], 0)


def test_optional_predicates(spark):
    df = spark.createDataFrame([("Ann", "x"), ("bob", "y"), (None, "x")], "n string, g string")
    assert paging.contains_if_given(df, "n", None).count() == 3
    assert rows(paging.contains_if_given(df, "n", "N"), "n") == [("Ann",)]
    assert rows(paging.contains_if_given(df, "n", "b_b"), "n") == [("bob",)]
    assert paging.equals_if_given(df, "g", "x").count() == 2


def test_current_else_first(spark):
    data = [("a", 118, i) for i in range(12)] + [("b", 119, 1), ("b", 118, 2)]
    df = spark.createDataFrame(data, "m string, congress int, rank int")
    parents = spark.createDataFrame([("a", 119), ("b", 119)], "m string, latest int")
    got = paging.current_else_first(
        df, parents, "m", "congress", "latest", [F.desc("congress"), F.asc("rank")]
    )
    assert rows(got) == sorted([("a", 118, i) for i in range(10)] + [("b", 119, 1)], key=repr)
