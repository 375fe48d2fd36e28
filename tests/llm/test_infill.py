"""Fill-in-middle against plain Python and against its check SQL."""

import hashlib

import duckdb
import numpy as np

from fixtures_llm import EDGE, counted
from rostra.llm import infill
from rostra.llm.registry import ORACLE

SF = "/root/testdata/sf0.001"


def by_hand(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text.encode())
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}".encode())
    return (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}".encode())


def tuples(df):
    return counted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect())


def test_awkward_rows(llm, edge, nothing):
    assert tuples(infill.fill_in_middle(edge)) == counted(by_hand(i, t) for i, t in EDGE)
    found = infill.restore(infill.fill_in_middle(edge)).select("id", "restored")
    assert tuples(found) == counted((i, (t or "").encode()) for i, t in EDGE)
    assert infill.restore(infill.fill_in_middle(nothing)).count() == 0


def test_units_of_every_width(llm):
    rng = np.random.default_rng(1)
    letters = list("aé日😀\0\n<PSM>") + ["<P", "P>", "é"]
    rows = [(i, "".join(rng.choice(letters, int(k)))) for i, k in enumerate(rng.integers(0, 60, 1500))]
    rows += [(5000, "<<P"), (5001, "a<M>b"), (5002, "日" * 200_000)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    for seed in (1, 7):
        made = infill.fill_in_middle(docs, seed=seed)
        assert tuples(made) == counted(by_hand(i, t, seed) for i, t in rows)
        assert tuples(infill.restore(made).select("id", "restored")) == counted((i, t.encode()) for i, t in rows)


def test_places_without_valid_utf8():
    parts = [b"\x80\x80a", b"", b"\xff\xc3", b"\xa9", b"abcdefgh" * 3, b"\xe6\x97"]
    edges = np.cumsum([0, *map(len, parts)])
    units = infill.Units(np.frombuffer(b"".join(parts), np.uint8), edges)
    assert units.counts().tolist() == [2, 0, 2, 1, 24, 1]
    for text, n in enumerate(units.counts()):
        steps = np.arange(n + 1)
        found = units.places(np.full(n + 1, text), steps)
        assert found[0] == edges[text] and found[-1] == edges[text + 1] and (np.diff(found) > 0).all()


def test_outputs_that_are_none():
    assert infill.rebuilt("psm", b"<P>a<S>b") is None and infill.rebuilt("spm", b"<P>a<S>b<M>c") is None
    assert infill.rebuilt("other", b"x") is None and infill.rebuilt("plain", b"x") == b"x"


def test_query_equals_its_check(llm):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = con.execute(ORACLE["op12_fill_in_middle"])
    names = [d[0] for d in result.description]
    found = infill.op12_fill_in_middle(llm, SF).select(*names)
    assert counted(map(tuple, found.collect())) == counted(result.fetchall())
