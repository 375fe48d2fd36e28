"""Most similar rows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostra.operators import similar_rows


def by_hand(entries, k):
    """entries: {row: {(part, col): value}} -> {(row, rank, other, similarity)}"""
    norm = {r: sum(v * v for v in e.values()) for r, e in entries.items()}
    out = set()
    for r, e in entries.items():
        found = []
        for o, x in entries.items():
            dot = sum(v * x.get(c, 0) for c, v in e.items())
            if o != r and dot > 0:
                found.append((-(dot / np.sqrt(float(norm[r]) * norm[o])), o))
        out |= {(r, n, o, -s) for n, (s, o) in enumerate(sorted(found)[:k], 1)}
    return out


def run(spark, rows, k, **sizes):
    df = spark.createDataFrame(rows, "person string, body string, event string, vote int")
    found = similar_rows.most_similar(df, "person", "event", F.col("vote"), part="body", k=k, **sizes)
    return {tuple(r) for r in found.collect()}


@pytest.mark.parametrize(("k", "block_rows", "cell_entries"), [(5, 1024, 1 << 18), (3, 7, 50), (1, 4, 1 << 18)])
def test_equals_brute_force(spark, k, block_rows, cell_entries):
    rng = np.random.default_rng(4)
    rows, held = [], {}
    for p in range(90):
        body = f"b{p % 4}"
        for e in range(60):
            hot = e < 3  # roll calls that everybody takes part in
            if hot or rng.random() < 0.3:
                place = "all" if hot else body
                v = int(rng.integers(-1, 2))
                rows.append((f"p{p:03}", place, f"e{place}{e}", v))
                if v:
                    held.setdefault(f"p{p:03}", {})[(place, f"e{place}{e}")] = v
    rows += [("p000", "b0", "twice", 1), ("p000", "b0", "twice", 1), ("p001", "b0", "twice", 2), (None, "b0", "x", 1), ("p002", "b0", None, 1)]
    for p in ("p000", "p001"):
        held[p][("b0", "twice")] = 2
    for name in ("same1", "same2", "same3", "same4"):  # ties
        rows += [(name, "b9", f"t{n}", 1) for n in range(4)]
        held[name] = {("b9", f"t{n}"): 1 for n in range(4)}
    rows += [("alone", "b8", "only", 1), ("never", "b8", "only", 0)]
    held["alone"] = {("b8", "only"): 1}
    assert run(spark, rows, k, block_rows=block_rows, cell_entries=cell_entries) == by_hand(held, k)


def test_blocks_that_cannot_matter_are_not_multiplied(spark, monkeypatch):
    """Bodies without common columns are never compared."""
    rows = [(f"{b}{p}", b, f"{b}{e}", 1 if (p + e) % 3 else -1) for b in ("x", "y", "z") for p in range(12) for e in range(9)]
    tried, whole = [], similar_rows._products

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(similar_rows, "_products", counted)
    found = run(spark, rows, 2, block_rows=6)
    assert len(found) == 72 and all(r[0] == o[0] for r, _, o, _ in found)
    own, other = tried
    assert own >= 6 and other <= own * (own - 1) / 2 / 2
    assert run(spark, [], 2) == set()


def test_sparse_and_dense_products_agree():
    rng = np.random.default_rng(1)
    cells = []
    for _ in range(2):
        place = rng.choice(40 * 500, 900, replace=False)
        cells.append((place // 500, place % 500 * 7, rng.integers(-3, 4, 900).astype(float)))
    expected = np.zeros((40, 40))
    for r, c, v in zip(*cells[0], strict=True):
        same = cells[1][1] == c
        np.add.at(expected[r], cells[1][0][same], v * cells[1][2][same])
    for cost in (0, 10**9):
        similar_rows.SPARSE_COST, before = cost, similar_rows.SPARSE_COST
        total = np.zeros((40, 40))
        similar_rows._added(total, *cells)
        similar_rows.SPARSE_COST = before
        assert (total == expected).all()
