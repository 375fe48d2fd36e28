"""Jaccard join against brute force, and its signatures pair by pair."""

import itertools

import numpy as np
import pytest

from fixtures_llm import EDGE, counted
from rostra.llm import jaccard
from rostra.llm.common import table

SF = "/root/testdata/sf0.001"


def shingles(text, width=5):
    w = ((text or "").encode().lower()).split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def by_hand(rows, least=(4, 5), width=5):
    """(id, n, component) per row, all pairs compared."""
    num, den = least
    sets = [shingles(t, width) for _, t in rows]
    label, links = list(range(len(rows))), 0
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    met = {p for h in holders.values() for p in itertools.combinations(h, 2)} if len(rows) < 3000 else set()
    for a, b in sorted(met):
        if len(sets[a] & sets[b]) * den >= len(sets[a] | sets[b]) * num:
            links += sets[a] != sets[b]
            if label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    lowest = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            lowest[x] = min(lowest.get(x, i), i)
    return [
        (i, len(s), lowest.get(x) if s else i) for (i, _), s, x in zip(rows, sets, label, strict=True)
    ], links


def found(df):
    return counted(map(tuple, df.select("id", "n", "component").collect()))


def test_awkward_rows(llm, edge, nothing):
    assert found(jaccard.similar_documents(edge)) == counted(by_hand(EDGE)[0])
    assert jaccard.similar_documents(nothing).count() == 0


def edited(rng, base, share, serial):
    out = list(base)
    for place in rng.choice(len(out), max(0, int(share * len(out))), replace=False):
        out[place] = f"new{serial}_{place}"
    return out


@pytest.fixture(scope="module")
def rows():
    """Edits of every strength, repeats, short texts, shared passages, chains, a large group, copies."""
    rng = np.random.default_rng(11)
    words = [f"w{n}" for n in range(4000)]
    texts, serial = [], 0
    for length in (4, 5, 6, 8, 10, 13, 17, 24, 40, 80, 200, 900):
        for _ in range(5):
            base = list(rng.choice(words, length))
            texts.append(base)
            for share in (0.01, 0.02, 0.03, 0.04, 0.05, 0.08):
                serial += 1
                texts.append(edited(rng, base, share, serial))
            texts += [base + base[:3], base + base[-2:], base[: max(1, length - 2)]]
            texts.append(base + base[: length // 2] * 9)  # repeats change a set little
    passage = list(rng.choice(words, 60))
    texts += [[*rng.choice(words, n), *passage, *rng.choice(words, 7)] for n in range(3, 43)]
    chain = list(rng.choice(words, 100))
    for step in range(12):
        texts.append(chain[step * 8 :] + [f"c{k}" for k in range(step * 8)])
    hub = list(rng.choice(words, 120))
    texts += [edited(rng, hub, 0.025, 10_000 + n) for n in range(60)] + [hub]
    order = rng.permutation(len(texts)).tolist()
    out = [(1000 + 3 * place, " ".join(t)) for place, t in zip(order, texts, strict=True)]
    return out + [(i + 1, t) for i, t in out[:40]] + [(None, out[3][1]), (2, out[3][1].upper()), (7, None), (8, " ")]


@pytest.mark.parametrize(("least", "tile"), [((4, 5), 512), ((4, 5), 4), ((9, 10), 512)])
def test_components_equal_brute_force(llm, rows, least, tile):
    expected, links = by_hand(rows, least)
    assert links > 100
    docs = llm.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id bigint, text string, n int, node int, sig string")
    got = jaccard.similar_documents(docs.repartition(5), least=least, tile=tile)
    assert found(got) == counted(expected)


def test_ranges_and_hot_signatures(llm, rows, monkeypatch):
    """Many ranges, chunks of a few texts: signatures meet across chunks."""
    monkeypatch.setattr(jaccard, "RANGE_SIGNATURES", 1 << 9)
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    assert found(jaccard.similar_documents(docs)) == counted(by_hand(rows)[0])


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        common = int(np.ceil(n * 0.8)) + int(rng.integers(0, n // 5 + 1))
        pool = [f"x{k}" for k in rng.integers(0, 1 << 40, 2 * n)]
        a = pool[:n]
        b = pool[: min(common, n)] + pool[n : n + int(rng.integers(0, n // 5 + 1))]
        if 5 * len(set(a) & set(b)) < 4 * len(set(a) | set(b)):
            continue
        sets = jaccard.Sets([" ".join(a).encode(), " ".join(b).encode()], width=1)
        sigs, texts = sets.signatures(np.ones(2, bool))
        assert set(sigs[texts == 0].tolist()) & set(sigs[texts == 1].tolist())
        words = min(map(len, sets.sketches())) // 8
        x, y = jaccard._folded(sets.sketches(), words)
        assert np.bitwise_count(x ^ y).sum() <= len(set(a) ^ set(b))


def test_query_over_given_documents(llm):
    rows = [(r["doc_id"], r["text"]) for r in table(llm, SF, "documents").collect()]
    got = jaccard.op13_jaccard_join(llm, SF).collect()
    assert counted(map(tuple, got)) == counted(by_hand(rows)[0])
