"""Operators on documents against plain Python, awkward rows included."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures_llm import EDGE, counted
from rostra.llm import decontaminate, interpolation, quality, secrets, simhash, storage, tokenfiles
from rostra.session import shared_dir

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")

def words(text, lower=True):
    data = (text or "").encode()
    return WORDS.findall(data.lower() if lower else data)

def test_simhash_groups(edge):
    def fingerprint(text):
        w = words(text)
        shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fingerprint(t) for _, t in EDGE]
    label = list(range(len(EDGE)))
    for _ in EDGE:
        for a in range(len(EDGE)):
            for b in range(len(EDGE)):
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    label[a] = min(label[a], label[b])
    least = {}
    for (i, _), g in zip(EDGE, label, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = [(i, f, least.get(g)) for (i, _), f, g in zip(EDGE, fps, label, strict=True)]
    found = simhash.near_duplicates(edge).collect()
    assert counted((r["id"], r["fp"] % (1 << 64), r["component"]) for r in found) == counted(expected)
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(label)) and set(least.values()) <= set(ids)

def test_simhash_tiles_equal_brute_force(llm):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 64, (6, 2))]
    fps = np.array(sorted({*map(int, base), *near}), dtype=np.uint64)
    df = llm.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp bigint")
    for radius in (0, 2, 4):
        label = {int(x): int(x) for x in fps.view(np.int64)}
        close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        signed = fps.view(np.int64)
        for _ in range(20):
            for row, x in zip(close, signed, strict=True):
                label[int(x)] = min(label[int(y)] for y in signed[row])
        found = {r["node"]: r["label"] for r in simhash.components(simhash.links(df, radius, tile=16)).collect()}
        assert {x: found.get(x, x) for x in label} == label

def test_quality(edge):
    found = quality.with_measures(edge, "text").collect()
    expected = []
    for i, t in EDGE:
        t = t or ""
        w = words(t, lower=False)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        inside = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORDS.search(x.encode())]
        expected.append((
            i, len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside),
        ))
    assert counted(tuple(r[c] for c in ("doc_id", *quality.FEATURES[:-1])) for r in found) == counted(expected)
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns and {r["n_words"] for r in kept.collect()} <= {3}

def test_quality_learns_who_is_right():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    n = len(quality.RULES)
    votes = np.zeros(len(good), dtype=np.int64)
    for r in range(n):
        says = rng.random(len(good))
        right = 0.9 if r < 4 else 0.6
        vote = np.where(says < 0.5, 1, np.where((rng.random(len(good)) < right) == good, 2, 0))
        votes = votes * 3 + vote
    patterns, counts = np.unique(votes, return_counts=True)
    posterior = quality.estimate(patterns, counts.astype(float))
    judged = np.array([posterior[v] for v in votes.tolist()]) >= 0.5
    assert (judged == good).mean() > 0.9

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

def test_decontamination(llm, edge):
    items = [(1, "Beta, gamma! delta epsilon zeta eta theta iota kappa lambda MU"), (2, "f g h"), (3, None), (4, "..."), (2, "word word"), (None, "日本語")]
    benchmark = llm.createDataFrame(items, "item_id bigint, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add("" if i is None else str(i))
    expected = []
    for i, t in EDGE:
        w, hit, found = plain_words(t), set(), set()
        for g, owners in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= owners
        expected.append((i, len(w), len(hit), tuple(sorted(found))))
    assert any(e[2] for e in expected)
    found = decontaminate.contamination(edge, benchmark).collect()
    assert counted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found) == counted(expected)
    clean = decontaminate.drop_contaminated(edge, benchmark)
    assert clean.columns == edge.columns
    assert counted(r["doc_id"] for r in clean.collect()) == counted(e[0] for e in expected if not e[2])

def test_proximity(llm):
    docs = llm.createDataFrame([(1, "one x two three"), (2, "one two three"), (3, "one x x x two three")], "doc_id bigint, text string")
    items = llm.createDataFrame([(7, "one two three")], "item_id bigint, text string")
    index = decontaminate.build_index(docs)
    for slop, expected in ((0, 1), (1, 2), (3, 3)):
        assert decontaminate.search(index, items, "item_id", "text", slop=slop).count() == expected

def test_secrets(edge):
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ]
    expected = []
    for i, t in EDGE:
        spans = [(m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(kinds) for m in p.finditer(t or "") if len(m[g]) >= least]
        expected.append((i, tuple(sorted(spans))))
    assert any(e[1] for e in expected)
    found = secrets.with_spans(edge).collect()
    assert counted((r["doc_id"], tuple((s["start"], s["place"], s["kind"], s["end"]) for s in r["spans"])) for r in found) == counted(expected)
    masked = secrets.mask_secrets(edge, chars_col="n_words")
    assert masked.columns == edge.columns
    text = next(r for r in masked.collect() if r["doc_id"] == 10)
    assert text["text"].endswith("line one\n[SECRET] and [SECRET]") and text["n_words"] == len(text["text"])

@pytest.mark.parametrize(
    "pattern, text", [(r"ab+c(de|fgh)", "xabbcfgh"), ("(?i)key[0-9]{2}x", "KEY12X"), ("a?bcd[xyz]*end", "bcdend"), ("[a-z]+", "q")]
)
def test_trigram_queries_hold_for_matches(pattern, text):
    def holds(query):
        if query is True or isinstance(query, str):
            return query is True or query in text.lower()
        return (all if query[0] == "and" else any)(map(holds, query[1]))

    assert re.search(pattern, text) and holds(secrets.trigram_query(pattern))

def test_interpolation(edge):
    counts = Counter()
    for i, t in EDGE:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            counts.update([*words(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    found = interpolation.score(edge).collect()
    expected = []
    for i, t in EDGE:
        w = [*words(t), b"\n"]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        expected.append((i, held, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    assert counted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == counted(expected)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)

def test_interpolation_beats_the_base_on_held_out_texts(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    row = interpolation.score(docs).where("held_out").selectExpr("sum(score) as s", "sum(base_score) as b").first()
    assert row["s"] > row["b"]

def test_token_files(llm, edge):
    out = shared_dir(llm, "test-tokens")
    manifest = tokenfiles.write_files(edge, tokenfiles.tokenizer_path(), out)
    found = tokenfiles.read_files(manifest, out, with_ids=True).orderBy("start").collect()
    import tokenizers

    own = tokenizers.Tokenizer.from_file(tokenfiles.tokenizer_path())
    ids = {t: [*own.encode(t, add_special_tokens=False).ids, 0] for t in {t or "" for _, t in EDGE}}
    assert counted((r["doc_id"], tuple(r["ids"])) for r in found) == counted((i, tuple(ids[t or ""])) for i, t in EDGE)
    at, before = 0, None
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert before is None or (r["doc_id"] is not None and r["doc_id"] >= before)
        at, before = at + r["n_tokens"], r["doc_id"]

def test_empty_tables(llm, nothing):
    items = llm.createDataFrame([], "item_id bigint, text string")
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    assert quality.keep_good(nothing).count() == 0
    assert decontaminate.contamination(nothing, items).count() == 0
    some = llm.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert decontaminate.contamination(some, items).first()["n_hit"] == 0
    assert secrets.with_spans(nothing).count() == 0
    assert interpolation.score(nothing).count() == 0
    out = shared_dir(llm, "test-none")
    assert tokenfiles.read_files(tokenfiles.write_files(nothing, tokenfiles.tokenizer_path(), out), out).count() == 0

@pytest.mark.parametrize("text", ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>b é日", "<|endoftext| >", "word " * 60_000 + "<|endoftext|>z"])
def test_added_tokens_in_texts(text):
    import tokenizers

    own = tokenizers.Tokenizer.from_file(tokenfiles.tokenizer_path())
    with open(tokenfiles.tokenizer_path(), encoding="utf-8") as f:
        encoder = tokenfiles.Encoder(f.read())
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == own.encode(text, add_special_tokens=False).ids


def test_quality_keeps_columns_of_any_name(llm):
    """Columns named as verdicts and measures come back as they were."""
    text = "one two three four five six seven eight nine ten eleven twelve of the and to"
    rows = [(i, "own", i, 0.5, "x", text + f" number {i}") for i in range(30)] + [(99, "own", 9, 0.5, "x", "short")]
    shape = "doc_id bigint, kept string, base_failed int, posterior double, votes string, text string"
    docs = llm.createDataFrame(rows, shape)
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    found = kept.collect()
    assert set(map(tuple, found)) <= set(rows) and 99 not in {r["doc_id"] for r in found}
    plain_ids = {r["doc_id"] for r in quality.keep_good(docs.select("doc_id", "text")).collect()}
    assert {r["doc_id"] for r in found} == plain_ids


def test_addresses_of_stores():
    assert storage.arrow_uri("s3a://bucket/a b") == "s3://bucket/a b" and storage.arrow_uri("dbfs:/x/y") == "/dbfs/x/y"
    assert storage.arrow_uri("/local/path") == "/local/path" and storage.arrow_uri("hdfs://h:9000/p") == "hdfs://h:9000/p"
    assert storage.at("file:///tmp")[1] == storage.at("/tmp")[1] == "/tmp"


def test_every_rule_is_linear_in_long_runs(llm):
    """1 MB of what a rule starts with, and a URL: each takes a second at the most."""
    size = 1_000_000
    runs = ["a" * size, "eyJ" * (size // 3), "a1" * (size // 2), "ghp_" * (size // 4), "xoxb-" * (size // 5), "AKIA" * (size // 4),
            "-----BEGIN " + "A " * (size // 2), "password" + " " * size, "sk_live_" * (size // 8), "://" * (size // 3), "f" * size]
    for rule in secrets.RULES:
        texts = [(i, run + " https://user:word@host/ ") for i, run in enumerate(runs)]
        df = llm.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).cache()
        df.count()
        start = time.perf_counter()
        df.agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))))).collect()
        assert time.perf_counter() - start < len(runs), rule.kind
        df.unpersist()


def test_index_of_long_texts_holds_each_trigram(llm):
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abé日😀\n "), 3 * secrets.PIECE + 17))
    docs = llm.createDataFrame([(1, text), (2, "ab"), (3, "abé"), (4, "")], "doc_id bigint, text string")
    index = {r["trigram"] for r in secrets.build_index(docs).collect()}
    expected = {t[i : i + 3] for t in (text, "abé") for i in range(len(t) - 2)}
    # Java's matcher also starts at the second half of a character beyond 16 bits; that adds terms no query asks for.
    assert expected <= index and all(t.startswith("?") for t in index - expected)


def test_benchmark_in_many_blocks(llm, edge, monkeypatch):
    """The hits do not depend on how the items are dealt into blocks."""
    items = llm.createDataFrame(
        [(f"i{n}", f"alpha beta gamma delta epsilon zeta eta theta iota kappa lambda {n}") for n in range(9)]
        + [("short", "word word"), ("none", None), ("far", "x y z " * 20)], "item_id string, text string",
    )
    whole = counted((r["doc_id"], r["n_hit"], tuple(r["items"])) for r in decontaminate.contamination(edge, items).collect())
    assert any(n for _, n, _ in whole)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    found = counted((r["doc_id"], r["n_hit"], tuple(r["items"])) for r in decontaminate.contamination(edge, items).collect())
    assert found == whole
    assert "toLocalIterator" not in open(decontaminate.__file__).read()


def test_interpolated_scores_equal_plain_python(llm, edge, monkeypatch):
    """With given weights a score is the sum of the logarithms of the mixed estimates over all training documents."""
    rng = np.random.default_rng(12)
    weights = rng.dirichlet([1, 1, 1], interpolation.BANDS)
    monkeypatch.setattr(interpolation, "learn_weights", lambda held, n, v: weights)
    found = [(r["doc_id"], r["score"]) for r in interpolation.score(edge).collect()]
    end, start, train = object(), object(), []
    for i, t in EDGE:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            train.append([*words(t), end])
    single = Counter(w for t in train for w in t)
    contexts = Counter(w for t in train for w in [start, *t[:-1]])
    pairs = Counter(p for t in train for p in zip([start, *t], t))
    n, v, expected = sum(single.values()), len(single), []
    for i, t in EDGE:
        total, before = 0.0, start
        for w in [*words(t), end]:
            c = contexts[before]
            a, b, d = weights[min(math.ceil(math.log2(c + 1)), interpolation.BANDS - 1)]
            total += math.log10(a * pairs[before, w] / max(c, 1) + b * single[w] / n + d / (v + 1))
            before = w
        expected.append((i, total))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    for (i, x), (j, y) in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert i == j and x == pytest.approx(y, rel=1e-9)
