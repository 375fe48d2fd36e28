"""Merkle manifest against plain Python and against its check SQL."""

import hashlib
import zlib

import duckdb
import pytest

from fixtures_llm import counted
from rostra.llm import merkle
from rostra.llm.registry import ORACLE

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(hashes, arity):
    """Root, and per leaf the list of (hashes before, hashes after) up to it."""
    level, owners = list(hashes), [[i] for i in range(len(hashes))]
    steps = [[] for _ in hashes]
    while len(level) > 1:
        after, held = [], []
        for at in range(0, len(level), arity):
            run = level[at : at + arity]
            for j in range(len(run)):
                for leaf in owners[at + j]:
                    steps[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            after.append(H(*run))
            held.append([x for o in owners[at : at + arity] for x in o])
        level, owners = after, held
    return level[0], steps


def by_hand(rows, arity):
    """rows: (doc_id, source, lang, n_chars, text) -> (id, lang, leaf, subroot, root, steps)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], H(*map(field, r))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs[g] = tree([h for _, h in groups[g]], arity)
    root, upper = tree([subs[g][0] for g in order], arity)
    return [
        (i, g, h, subs[g][0], root, tuple(s + u))
        for g, u in zip(order, upper, strict=True)
        for (i, h), s in zip(groups[g], subs[g][1], strict=True)
    ]


SHAPE = "doc_id bigint, source string, lang string, n_chars bigint, text string, g int, h string, node int, steps string"


def frame(llm, rows):
    return llm.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SHAPE)


@pytest.mark.parametrize(("arity", "digits"), [(2, 10), (2, 1), (2, 2), (3, 2)])
def test_trees_equal_plain_python(llm, arity, digits):
    rows = [(i, f"s{i % 3}", ("en", "de", "é", "", None, "zh")[min(i % 7, 5)], i if i % 5 else None, f"text {i}") for i in range(61)]
    rows += [(None, None, None, None, None), (None, "a", None, 1, ""), (7, "s", "alone", 1, "日本語"), (3, "s0", "en", 1, "b")]
    rows += [(100, "same", "en", 9, "again")] * 9
    found = merkle.manifest(frame(llm, rows), arity=arity, digits=digits).collect()
    key = [(r["id"], r["grp"], r["leaf"], r["subroot"], r["root"], tuple((s["before"], s["after"]) for s in r["steps"])) for r in found]
    assert counted(key) == counted(by_hand(rows, arity))
    assert sorted(r["rank"] for r in found if r["grp"] == "en") == list(range(sum(r[2] == "en" for r in rows)))


def test_small_tables(llm):
    assert merkle.manifest(frame(llm, [])).count() == 0
    only = merkle.manifest(frame(llm, [(1, "s", None, 2, "t")])).first()
    assert only["leaf"] == only["subroot"] == only["root"] == H("1:1", "1:s", "-", "1:2", "1:t") and only["steps"] == []


def test_a_false_leaf_is_found(llm):
    rows = [(i, "s", "en" if i % 3 else "de", None if i % 11 == 0 else i, "t") for i in range(200)]
    path = f"{llm.conf.get('spark.checkpoint.dir')}/merkle-in"
    llm.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").write.parquet(
        f"{path}/documents.parquet"
    )
    found = {r["doc_id"]: r for r in merkle.op11_merkle_manifest(llm, path).collect()}
    for i, _, _, n, _ in rows:
        assert found[i]["verified"] == (zlib.crc32(str(i).encode()) % 7 != 0 or n is None)
        assert (found[i]["folded_root"] == found[i]["root"]) == found[i]["verified"]


def test_query_equals_its_check(llm):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = con.execute(ORACLE["op11_merkle_manifest"])
    names = [d[0] for d in result.description]
    found = merkle.op11_merkle_manifest(llm, SF).select(*names)
    assert counted(map(tuple, found.collect())) == counted(result.fetchall())
