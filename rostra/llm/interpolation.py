"""Deleted interpolation: a bigram model mixed from maximum-likelihood estimates.

P(w | v) = a c(v w) / c(v) + b c(w) / N + d / (V + 1), where the weights a, b, d depend on how often
the context v was seen (one set for each power of two). The weights are learned by
expectation-maximisation: a tenth of the documents is left out of the counts, and the weights are
those under which that tenth is likeliest given the counts of the rest. The final estimates count
all training documents.

Counting and looking up are one exchange of packed arrays. Documents are read once into chunks of
word codes. Every chunk sends each of its distinct words and bigrams once, as a 64-bit hash with the
number of times it occurs there; the hash range decides who adds it up, so no word, however
frequent, makes one task larger than another. The sums go back to the chunks that asked. Two words
that share a hash would be counted as one, which with 10 ** 8 distinct words has a chance of 3 in
10,000.

A NULL or empty text is one end token. Documents with NULL identifiers are training documents that
count, and their ``held_out`` is false. Repeated rows keep their own rows. An empty table gives an
empty result; without any training document all probability is uniform.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rostra.llm.common import codes, fold, prepare, sums_by_text, table, utf8
from rostra.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from rostra.session import staged

FOLDS, HELD_OUT_FOLD, WEIGHTS_FOLD = 10, 0, 1
COUNTED, WEIGHING, SCORED = 0, 1, 2  # what a document is for; the last is held out altogether
CHUNK = 6 << 20  # bytes of text
ROUNDS = 12
BANDS = 48  # of context frequency: unseen, 1, 2-3, 4-7, ...
START, END = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"\n")


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _encoded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Chunks of documents of one role: identifiers, words per document, word codes, word hashes."""
    part = fold(id_col, FOLDS)
    role = F.when(part == HELD_OUT_FOLD, SCORED).when(part == WEIGHTS_FOLD, WEIGHING).otherwise(COUNTED)
    source = docs.select(F.col(id_col).alias("id"), role.alias("role"), utf8(text_col).alias("text"))
    kind = source.schema["id"].dataType
    names = ["chunk", "role", "ids", "sizes", "words", "hashes"]
    types = [pa.int64(), pa.int32(), pa.list_(to_arrow_type(kind)), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held = {r: ([], []) for r in (COUNTED, WEIGHING, SCORED)}
        bytes_held = dict.fromkeys(held, 0)

        def close(role: int) -> pa.RecordBatch:
            nonlocal number
            ids, texts = held[role]
            words, starts, vocabulary = codes([t.lower() for t in texts])
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
            row = [number, role, list(ids), pack(np.diff(starts)), pack(words), hashes.tobytes()]
            number += 1
            ids.clear()
            texts.clear()
            bytes_held[role] = 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for i, r, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[r][0].append(i)
                held[r][1].append(t)
                bytes_held[r] += len(t)
                if bytes_held[r] >= CHUNK:
                    yield close(r)
        for r in held:
            if held[r][0]:
                yield close(r)

    shape = f"chunk bigint, role int, ids array<{kind.simpleString()}>, sizes binary, words binary, hashes binary"
    return staged(source.mapInArrow(run, shape), "encoded")


class Tokens:
    """The tokens of a chunk and what it asks for: its distinct words and bigrams by hash."""

    def __init__(self, sizes: bytes, words: bytes, hashes: bytes):
        sizes = unpack(sizes).astype(np.int64)
        own = np.concatenate((np.frombuffer(hashes, np.uint64), np.array([END, START], np.uint64)))
        end, start = len(own) - 2, len(own) - 1
        ends = np.cumsum(sizes)
        self.token = np.insert(unpack(words).astype(np.int64), ends, end)
        self.starts = np.concatenate(([0], ends + np.arange(1, len(sizes) + 1)))
        self.before = np.concatenate(([start], self.token[:-1]))
        self.before[self.starts[:-1]] = start
        self.word_keys, place = np.unique(own, return_inverse=True)
        self.token, self.before = place[self.token], place[self.before]
        self.pair_keys, self.pair = np.unique(
            _mixed(self.word_keys[self.before], self.word_keys[self.token]), return_inverse=True
        )
        self.word_counts = np.bincount(self.token, minlength=len(self.word_keys))
        self.word_counts[np.searchsorted(self.word_keys, np.uint64(START))] = len(sizes)
        self.pair_counts = np.bincount(self.pair, minlength=len(self.pair_keys))


def _asked(encoded: DataFrame, bits: int) -> DataFrame:
    names = ["kind", "range", "chunk", "role", "keys", "counts"]
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(row["sizes"], row["words"], row["hashes"])
                out = []
                for kind, keys, counts in (
                    (0, tokens.word_keys, tokens.word_counts), (1, tokens.pair_keys, tokens.pair_counts)
                ):
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    for n, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        if e > s:
                            out.append((kind, n, row["chunk"], row["role"], pack_sorted(keys[s:e]), pack(counts[s:e])))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    lists = encoded.select("chunk", "role", "sizes", "words", "hashes")
    return lists.mapInArrow(run, "kind bigint, range bigint, chunk bigint, role bigint, keys binary, counts binary")


_ANSWER = "chunk bigint, kind bigint, range bigint, counted binary, total binary, tokens array<bigint>, types array<bigint>"


def _answer(rows: pa.Table) -> pa.Table:
    """Sums of a range of hashes: over the counted documents, and over all training documents."""
    keys = [unpack_sorted(k.as_py()) for k in rows["keys"]]
    role = rows["role"].to_numpy()
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpack(c.as_py()) for c in rows["counts"]]).astype(np.float64)
    by_role = np.repeat(role, [len(k) for k in keys])
    counted = np.bincount(place, counts * (by_role == COUNTED), len(every)).astype(np.int64)
    total = counted + np.bincount(place, counts * (by_role == WEIGHING), len(every)).astype(np.int64)
    kind, part = rows["kind"][0].as_py(), rows["range"][0].as_py()
    # The start of a text is a context but no token.
    real = every != np.uint64(START)
    known = kind == 0
    tokens = [int(counted[real].sum()), int(total[real].sum())] if known else [0, 0]
    types = [int((counted[real] > 0).sum()), int((total[real] > 0).sum())] if known else [0, 0]
    out, at = [(-1, kind, part, b"", b"", tokens, types)], 0
    for chunk, r, k in zip(rows["chunk"].to_pylist(), role.tolist(), keys, strict=True):
        own = place[at : at + len(k)]
        at += len(k)
        out.append((chunk, kind, part, pack(counted[own]) if r == WEIGHING else b"", pack(total[own]), [], []))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["chunk", "kind", "range", "counted", "total", "tokens", "types"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _told(answers: pa.Table, kind: int, column: str) -> np.ndarray:
    """The answers on words or bigrams, in the order they were asked for."""
    own = sorted(
        (part, blob)
        for k, part, blob in zip(
            answers["kind"].to_pylist(), answers["range"].to_pylist(), answers[column].to_pylist(), strict=True
        )
        if k == kind
    )
    return np.concatenate([unpack(blob) for _, blob in own]).astype(np.int64)


def _tokens(rows: pa.Table) -> Tokens:
    return Tokens(*(rows[c][0].as_py() for c in ("sizes", "words", "hashes")))


def band(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(counts + 1.0)).astype(np.int64), BANDS - 1)


def _weighing(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Held-out counts of a chunk by what the counted documents say: c(v), c(v w), c(w), times."""
    tokens = _tokens(rows)
    words, pairs = _told(answers, 0, "counted"), _told(answers, 1, "counted")
    first = np.unique(tokens.pair, return_index=True)[1]
    seen = np.stack([words[tokens.before[first]], pairs, words[tokens.token[first]]], axis=1)
    apart, place = np.unique(seen, axis=0, return_inverse=True)
    times = np.bincount(place.ravel(), tokens.pair_counts, len(apart)).astype(np.int64)
    return pa.table([*apart.T, times], ["context", "pair", "word", "times"])


def learn_weights(held: DataFrame, n: int, v: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (band, [bigram, unigram, uniform]) by expectation-maximisation over held-out counts."""
    weights = np.tile([0.4, 0.4, 0.2], (BANDS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    which = F.least(F.ceil(F.log2(F.col("context") + 1)).cast("int"), F.lit(BANDS - 1))
    parts = [
        F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0),
        F.col("word") / F.lit(float(max(n, 1))),
        F.lit(1.0 / (v + 1)),
    ]
    held = staged(held.select(which.alias("band"), "times", *[p.alias(f"p{k}") for k, p in enumerate(parts)]), "held")
    for _ in range(rounds):
        each = [F.element_at(F.lit(weights[:, k].tolist()), F.col("band") + 1) * F.col(f"p{k}") for k in range(3)]
        whole = each[0] + each[1] + each[2]
        sums = held.groupBy("band").agg(*[F.sum(F.col("times") * e / whole).alias(f"s{k}") for k, e in enumerate(each)])
        before = weights.copy()
        for row in sums.collect():  # one row per band
            found = np.array([row["s0"], row["s1"], row["s2"]])
            weights[row["band"]] = np.maximum(found / found.sum(), 1e-6)
        weights[0, 0] = 0.0
        weights /= weights.sum(axis=1, keepdims=True)
        if np.abs(weights - before).max() < 1e-4:
            break
    return weights


def _scored(n: int, v: int, weights: np.ndarray, id_type: pa.DataType):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = _tokens(rows)
        words, pairs = _told(answers, 0, "total"), _told(answers, 1, "total")
        context, word, pair = words[tokens.before], words[tokens.token], pairs[tokens.pair]
        mix = weights[band(context)]
        p = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(n, 1) + mix[:, 2] / (v + 1)
        base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
        size = np.diff(tokens.starts)
        return pa.table(
            [
                pa.array(rows["ids"][0].as_py(), id_type),
                pa.array(np.full(len(size), rows["role"][0].as_py() == SCORED)),
                pa.array(size),
                pa.array(sums_by_text((word > 0).astype(np.int64), tokens.starts)),
                pa.array(np.full(len(size), n)),
                pa.array(sums_by_text(base, tokens.starts)),
                pa.array(sums_by_text(np.log10(p), tokens.starts)),
            ],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: identifier, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    encoded = _encoded(docs, id_col, text_col)
    # A range of hashes holds about as many keys as a chunk.
    bits = max(4, math.ceil(math.log2(max(encoded.select("chunk").count(), 1))))
    answers = staged(_asked(encoded, bits).groupBy("kind", "range").applyInArrow(_answer, _ANSWER), "answers")
    got = answers.where("chunk < 0").agg(
        *[F.coalesce(F.sum(F.col(c)[k]), F.lit(0)) for c in ("tokens", "types") for k in range(2)]
    ).first()
    n_counted, n, v_counted, v = got
    own = answers.where("chunk >= 0").select("chunk", "kind", "range", "counted", "total")

    def with_answers(chunks: DataFrame, run, shape: str) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(own_of(chunks).groupBy("chunk")).applyInArrow(run, shape)

    def own_of(chunks: DataFrame) -> DataFrame:
        return own if chunks is encoded else own.where("length(counted) > 0")

    held = with_answers(
        encoded.where(F.col("role") == WEIGHING), _weighing, "context bigint, pair bigint, word bigint, times bigint"
    )
    held = held.groupBy("context", "pair", "word").agg(F.sum("times").alias("times"))
    weights = learn_weights(held, n_counted, v_counted)
    kind = docs.schema[id_col].dataType
    shape = (
        f"id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double"
    )
    return with_answers(encoded, _scored(n, v, weights, to_arrow_type(kind)), shape).withColumnRenamed("id", id_col)


def op1_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    """Score of every document under the model of the training documents."""
    return score(table(prepare(spark), sf_dir, "documents"))
