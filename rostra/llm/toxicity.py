"""Toxicity of texts after undoing disguise by a noisy-channel decoder.

A disguised word is read as a lattice: a run of equal signs may stand for one or two of a letter, a
digit or sign for the letters it resembles, a separator for nothing or for the border of a word. The path that is
likeliest under a character 4-gram model (counted over all texts) times the channel's costs is the restored
word, or words. Runs of single characters between spaces are one lattice, in which the spaces are such
separators. Plain words are left as they are.

Scores come from the restored words. Words and beginnings of words that labelled texts use
significantly more often when toxic get their smoothed log-odds as weight; a text's strongest weight
and its number of weighted words go through a logistic curve fitted on the same labelled rows. Labelled rows are a sample of at
most ``LABELLED`` rows by hash of the identifier; the lexicon has all entries that are significant in them.

Empty and NULL texts score like texts in which nothing was found. Labels of the held-out fold, NULL
labels and NULL identifiers teach nothing; if a document has several labels the highest counts.
Repeated rows keep their own rows. Without labels every score is 0. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rostra.llm.common import codes, fold, owners, prepare, sums_by_text, table, utf8
from rostra.session import staged

FOLDS, HELD_OUT_FOLD, THRESHOLD = 4, 2, 0.3
LABELLED = 20_000
ALPHABET = 28  # word border, a-z, any other letter
ORDER = 4
SIGNIFICANT = 20.0  # log-likelihood ratio
LEAST_TEXTS = 3
LEAST_PIECE = 3  # characters of a word that a separator cuts off
PREFIXES = (4, 5, 6, 7)
REMEMBERED = 1 << 19  # words kept in a task; memory only, no effect on results

# What digits and signs are read as.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
SEPARATORS = ".-_*~·/"
LOOK_COST, KEPT_COST, DROP_COST, COLLAPSE_COST, SPLIT_COST, BORDER_COST = 1.0, 6.0, 1.0, 0.5, 3.0, 1.0
_EDGES = "#*&%|.,;:?!\"'()[]<>{}«»“”…~-_"
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[0xC0:] = ALPHABET - 1
_ODD = re.compile(r"[0-9@$!|+(€*.\-_~·/ ]|([^\W\d_])\1\1")


def letter_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else ALPHABET - 1 if c.isalpha() else 0


def count_grams(data: np.ndarray) -> np.ndarray:
    """Counts of class 4-grams; each word has three borders before it."""
    data = data[(data & 0xC0) != 0x80]
    found = _CLASS[data]
    border = found == 0
    found = found[~(border & np.concatenate(([False], border[:-1])))]
    found = np.concatenate((np.zeros(3, np.int64), np.repeat(found, np.where(found == 0, ORDER - 1, 1)), np.zeros(1, np.int64)))
    n = len(found) - ORDER + 1
    gram = np.zeros(n, dtype=np.int64)
    for k in range(ORDER):
        gram = gram * ALPHABET + found[k : k + n]
    # A border inside the context that is not at its start belongs to the word before.
    return np.bincount(gram, minlength=ALPHABET**ORDER)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probability of a class after three others, from the counts over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ALPHABET**ORDER, dtype=np.int64)
        for batch in batches:
            counts += count_grams(np.frombuffer(b"\n".join(batch.column(0).to_pylist()), np.uint8))
        gram = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(counts[gram])], ["gram", "n"])

    found = docs.select(utf8(text_col)).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    # At most 28 ** 4 rows.
    rows = found.toPandas()
    counts = np.zeros(ALPHABET**ORDER)
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return log_model(counts.reshape((ALPHABET,) * ORDER))


def log_model(counts: np.ndarray) -> np.ndarray:
    """Each order's estimate leans on the next shorter one in proportion to what it has seen."""
    p = np.full(ALPHABET, 1 / ALPHABET)
    for order in range(1, ORDER + 1):
        c = counts.sum(axis=tuple(range(ORDER - order)))
        p = (c + 5 * p) / (c.sum(axis=-1, keepdims=True) + 5)
    return np.log(p).astype(np.float32).ravel()


class Restorer:
    """Restored form of single words."""

    def __init__(self, model: np.ndarray):
        self.model = model

    def readings(self, sign: str, n: int) -> list[tuple[str, float]]:
        """What a run of n equal signs may stand for, with costs."""
        out = []
        if sign.isalpha():
            out.append((sign * min(n, 2), 0.0 if n < 3 else COLLAPSE_COST))
            if n > 1:
                out.append((sign, COLLAPSE_COST if n > 2 else SPLIT_COST))
        for letter in LOOKS.get(sign, ""):
            cost = LOOK_COST if sign != "*" else 2 * LOOK_COST
            out.append((letter, cost + (COLLAPSE_COST if n > 2 else 0.0)))
            if n > 1:
                out.append((letter * 2, cost * 2))
        if sign in SEPARATORS or sign == " ":
            out.append(("", DROP_COST if sign != " " else 0.0))
            out.append((" ", BORDER_COST if sign != " " else -BORDER_COST))
        return out or [(sign * n, KEPT_COST)]

    def decode(self, word: str) -> str:
        best = {(0, 0, 0): (0.0, "")}
        for run in re.finditer(r"(.)\1*", word, re.DOTALL):
            ahead: dict[tuple, tuple[float, str]] = {}
            for context, (cost, text) in best.items():
                for letters, extra in self.readings(run[1], len(run[0])):
                    state, total = context, cost + extra
                    for c in letters:
                        k = letter_class(c)
                        total -= self.model[((state[0] * ALPHABET + state[1]) * ALPHABET + state[2]) * ALPHABET + k]
                        state = (state[1], state[2], k)
                    if state not in ahead or (total, text + letters) < ahead[state]:
                        ahead[state] = (total, text + letters)
            best = ahead
        return min(
            (cost - self.model[((s[0] * ALPHABET + s[1]) * ALPHABET + s[2]) * ALPHABET], text)
            for s, (cost, text) in best.items()
        )[1]

    def restore(self, word: str) -> str:
        """A word in lower case without marks around it, decoded if it looks disguised; that may be several words."""
        bare = word.lower().rstrip(_EDGES).lstrip(_EDGES.replace("!", ""))
        if bare.endswith("$$$"):
            bare = bare.rstrip("$")
        if not any(c.isalpha() for c in bare) and sum(c in LOOKS for c in bare) < 3:
            return bare
        return " ".join(self.decode(bare).split()) if _ODD.search(bare) else bare


    def readings_of(self, word: str) -> str:
        """The restored words to look up: the likeliest reading, and the words that separators cut out of it.

        A separator may be a border although the model finds a word across it likelier, and the first of some
        spelled letters may be a word of its own.
        """
        best = self.restore(word)
        pieces = [p for p in re.split(f"[{re.escape(SEPARATORS)}]", word.lower()) if len(p) >= LEAST_PIECE]
        if " " in word:
            pieces.append(word.lower().split(" ", 1)[1])
        return " ".join([best, *(self.restore(p) for p in pieces if p != word.lower())])


def spelled(words: np.ndarray, starts: np.ndarray, single: np.ndarray) -> list[tuple[int, int]]:
    """Runs (first, end) of three or more single characters within one text."""
    if not len(words):
        return []
    alone, owner = single[words], owners(starts)
    fresh = np.concatenate(([True], (alone[1:] != alone[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(fresh)
    end = np.append(first[1:], len(words))
    keep = alone[first] & (end - first >= 3)
    return list(zip(first[keep].tolist(), end[keep].tolist(), strict=True))


def parts_of(restored: str) -> list[str]:
    """What restored words are known by: themselves and their beginnings."""
    words = restored.split() or [""]
    return [part for word in words for part in (f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) >= k))]


class Words:
    """Restored words of the texts of a batch, with what each is worth."""

    def __init__(self, model: np.ndarray, value):
        self.restorer, self.value, self.known = Restorer(model), value, {}

    def __call__(self, word: bytes):
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = self.value(self.restorer, word.decode("utf-8", "replace"))
        return found

    def spelled_out(self, words: np.ndarray, starts: np.ndarray, vocabulary: list[bytes]):
        single = np.fromiter((len(w.decode("utf-8", "replace")) == 1 for w in vocabulary), bool, len(vocabulary))
        owner = owners(starts)
        for first, end in spelled(words, starts, single):
            yield int(owner[first]), self(b" ".join([vocabulary[w] for w in words[first:end]]))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic) of the labelled rows that may be learned from."""
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT_FOLD))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(LABELLED)
    )
    # LABELLED rows of two numbers.
    joined = docs.select(F.col(id_col).alias("__id"), utf8(text_col).alias("text")).join(F.broadcast(known), "__id")
    return joined.select("text", "toxic")


def learn_lexicon(labelled: DataFrame, model: np.ndarray) -> dict[str, float]:
    """Weights of words and beginnings that mark toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words(model, lambda restorer, word: parts_of(restorer.readings_of(word)))
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words, starts, vocabulary = codes(texts)
            counts = (Counter(), Counter())
            extra: dict[int, set] = {}
            for text, parts in reader.spelled_out(words, starts, vocabulary):
                extra.setdefault(text, set()).update(parts)
            for n, (s, e) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                parts = {p for w in np.unique(words[s:e]).tolist() for p in reader(vocabulary[w])}
                counts[toxic[n] > 0].update(parts | extra.get(n, set()))
            every = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string()), *(pa.array([c[p] for p in every], pa.int64()) for c in counts)],
                ["part", "clean", "toxic"],
            )

    totals = {r["toxic"] > 0: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(True, 0), totals.get(False, 0)
    if not n1 or not n0:
        return {}
    a, b = F.col("toxic"), F.col("clean")

    def term(seen, of, share):
        return F.when(seen > 0, seen * F.log(seen / (F.lit(float(of)) * share))).otherwise(0.0)

    share = (a + b) / F.lit(float(n1 + n0))
    ratio = 2 * (term(a, n1, share) + term(b, n0, share) + term(n1 - a, n1, 1 - share) + term(n0 - b, n0, 1 - share))
    weight = F.log((a + 0.5) / (n1 + 1.0)) - F.log((b + 0.5) / (n0 + 1.0))
    found = (
        labelled.mapInArrow(run, "part string, clean bigint, toxic bigint")
        .groupBy("part")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((a >= LEAST_TEXTS) & (a + b < n1 + n0))
        .select("part", ratio.alias("ratio"), weight.alias("weight"))
        .where((F.col("ratio") >= SIGNIFICANT) & (F.col("weight") > 1))
        .orderBy("part")
    )
    return {r["part"]: r["weight"] for r in found.collect()}


def with_strength(docs: DataFrame, model: np.ndarray, lexicon: dict[str, float], text_col: str = "text") -> DataFrame:
    """All columns, ``strength``, the largest weight among the restored words (0 for none), and ``hits``, how many have one."""
    kept = [c for c in docs.columns if c not in ("strength", "hits")]
    shape = T.StructType([
        *[docs.schema[c] for c in kept],
        T.StructField("strength", T.DoubleType(), False),
        T.StructField("hits", T.LongType(), False),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words(model, lambda restorer, word: max([lexicon.get(p, 0.0) for p in parts_of(restorer.readings_of(word))]))
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            words, starts, vocabulary = codes(texts)
            worth = np.fromiter(map(reader, vocabulary), np.float64, len(vocabulary))
            out, hits = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            if len(words):
                np.maximum.at(out, owners(starts), worth[words])
                hits += sums_by_text((worth[words] > 0).astype(np.int64), starts)
            for text, value in reader.spelled_out(words, starts, vocabulary):
                out[text] = max(out[text], value)
                hits[text] += value > 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(out), pa.array(hits)], [*kept, "strength", "hits"]
            )

    return docs.select(*kept, utf8(text_col).alias("__text")).mapInArrow(run, shape)


def fit_curve(x: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> list[float]:
    """Intercept and slopes of a logistic curve, by Newton's method with a little shrinkage."""
    x = np.concatenate((np.ones((1, x.shape[1])), x))
    beta = np.zeros(len(x))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        gradient = x @ (times * (toxic - p)) - 0.01 * beta
        hessian = (x * (times * p * (1 - p))) @ x.T + 0.01 * np.eye(len(x))
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return beta.tolist()


def restored(docs: DataFrame, model: np.ndarray, text_col: str = "text", to: str = "restored") -> DataFrame:
    """All columns, and the restored words of the text joined by spaces."""
    kept = [c for c in docs.columns if c != to]
    shape = T.StructType([*[docs.schema[c] for c in kept], T.StructField(to, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words(model, lambda restorer, word: restorer.restore(word))
        for batch in batches:
            words, starts, vocabulary = codes(batch.column(len(kept)).to_pylist())
            single = np.fromiter((len(w.decode("utf-8", "replace")) == 1 for w in vocabulary), bool, len(vocabulary))
            runs = dict(spelled(words, starts, single))
            out = []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                line, at = [], s
                while at < e:
                    end = runs.get(at, at + 1)
                    line.append(reader(b" ".join([vocabulary[w] for w in words[at:end]])))
                    at = end
                out.append(" ".join(line))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(out, pa.string())], [*kept, to])

    return docs.select(*kept, utf8(text_col).alias("__text")).mapInArrow(run, shape)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: identifier, ``score`` from 0 to 1, ``strength`` and ``hits``."""
    model = character_model(docs, text_col)
    labelled = staged(_labelled(docs, labels, id_col, text_col, label_col), "labelled")
    lexicon = learn_lexicon(labelled, model)
    # Strengths by tenths and hits by powers of two: a few hundred rows.
    shapes = [F.round("strength", 1), F.round(F.log2(F.col("hits") + 1))]
    seen = with_strength(labelled, model, lexicon).groupBy(*[c.alias(f"x{k}") for k, c in enumerate(shapes)], "toxic").count()
    rows = [(r["x0"], r["x1"], float(r["toxic"] > 0), r["count"]) for r in seen.collect()]
    found = with_strength(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, lexicon)
    if rows:
        table_ = np.array(sorted(rows), dtype=float).T
        a, b, c = fit_curve(table_[:2], table_[2], table_[3])
        value = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("strength") + F.lit(c) * F.log2(F.col("hits") + 1))))
    else:
        value = F.lit(0.0)
    return found.select(F.col("id").alias(id_col), value.alias("score"), "strength", "hits")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    prepare(spark)
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
