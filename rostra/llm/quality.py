"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule looks at one property of a text and votes good, votes bad, or abstains. Nothing is known
about how right a rule is; expectation-maximisation estimates, from how the rules agree over all
texts, the share of good texts and how each rule votes on good and on bad ones. The posterior
probability that a text is good then decides, instead of a demand that every rule be passed.

Texts that voted alike count together, so the estimation sees at most 3 ** 10 patterns whatever the
size of the input. NULL and empty texts have no words and fail the base rule. Repeated rows and
NULL identifiers keep their own rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rostra.llm.common import codes, owners, pair_ranks, prepare, sums_by_text, table
from rostra.session import staged

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
THRESHOLD = 0.5
ROUNDS = 50

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_MARKS = frozenset(b"#*$%&|<>")
_INSIDE = (np.arange(256) & 0xC0) == 0x80  # bytes of a character after its first

_NEVER = float("inf")

# (name, property, good if from .. to, bad if below, bad if above); anything else abstains.
# Most rules know one kind of fault and have nothing to say where they do not find it.
RULES = (
    ("length", "n_words", 50, _NEVER, MIN_WORDS, _NEVER),
    ("word_length", "word_length", _NEVER, _NEVER, 2.0, 12.0),
    ("symbols", "symbols_per_word", _NEVER, _NEVER, -1.0, 0.15),
    ("marked_words", "marked_share", 0.0, 0.02, -1.0, 0.1),
    ("repeated_lines", "dup_line_share", _NEVER, _NEVER, -1.0, 0.25),
    ("repeated_words", "repeat_share", _NEVER, _NEVER, -1.0, 0.2),
    ("doubled_words", "doubled_share", _NEVER, _NEVER, -1.0, 0.25),
    ("capitals", "capital_share", _NEVER, _NEVER, -1.0, 0.4),
    ("exclaiming", "exclaim_share", _NEVER, _NEVER, -1.0, 0.15),
    ("letters", "letter_share", _NEVER, _NEVER, 0.8, 1.0),
)
PATTERNS = 3 ** len(RULES)

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "votes")


def repeated_words(words: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each text, the words inside windows that occur twice or more in it."""
    n, owner = len(words), owners(starts)
    if n < width:
        return np.zeros(len(starts) - 1, dtype=np.int64)
    at = np.flatnonzero(owner[: n - width + 1] == owner[width - 1 :])
    keys = owner[at].astype(np.uint64)
    for k in range(width):
        keys = (keys ^ words[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    order = np.argsort(keys)
    twin = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    a, b = at[order[twin]], at[order[twin + 1]]
    if not all((words[a + k] == words[b + k]).all() for k in range(width)) or (owner[a] != owner[b]).any():
        # Two different windows share a key: number the windows without hashing.
        ranks = words[at]
        for k in range(1, width):
            ranks = pair_ranks(ranks, words[at + k])
        ranks = pair_ranks(owner[at], ranks)
        hit = at[np.bincount(ranks)[ranks] > 1]
    else:
        hit = np.unique(np.concatenate((a, b)))
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + width, -1)
    return sums_by_text((np.cumsum(edges[:-1]) > 0).astype(np.int64), starts)


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counted properties of each text and the pattern of votes on it."""
    words, starts, vocabulary = codes(texts)
    n_words = np.diff(starts)
    data = np.frombuffer(b"".join(texts), np.uint8)
    places = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    out = {
        "n_words": n_words,
        "word_chars": sums_by_text((~(_SPACE[data] | _INSIDE[data])).astype(np.int64), places),
        "n_symbols": sums_by_text(_SYMBOL[data].astype(np.int64), places),
        "n_repeat_words": repeated_words(words, starts),
    }
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, len(texts))
    out["n_dup_lines"] = n_lines - np.fromiter((len(set(x)) for x in lines), np.int64, len(texts))

    def share(of) -> np.ndarray:
        flags = np.fromiter(map(of, vocabulary), np.int64, len(vocabulary))
        return sums_by_text(flags[words] if len(words) else words, starts) / np.maximum(n_words, 1)

    some = np.maximum(n_words, 1)
    same = np.zeros(len(words), dtype=np.int64)
    owner = owners(starts)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    looks = {
        "n_words": n_words,
        "word_length": out["word_chars"] / some,
        "symbols_per_word": out["n_symbols"] / some,
        "dup_line_share": out["n_dup_lines"] / np.maximum(n_lines, 1),
        "repeat_share": out["n_repeat_words"] / some,
        "doubled_share": sums_by_text(same, starts) / some,
        "capital_share": share(lambda w: w.isupper() and len(w) > 1),
        "marked_share": share(lambda w: not _MARKS.isdisjoint(w)),
        "exclaim_share": share(lambda w: b"!" in w),
        "letter_share": share(lambda w: w.lower() != w.upper() or max(w) > 127),
    }
    votes = np.zeros(len(texts), dtype=np.int64)
    for _, of, good_from, good_to, low, high in RULES:
        x = looks[of]
        bad = (x < low) | (x > high)
        good = ~bad & (x >= good_from) & (x <= good_to)
        votes = votes * 3 + np.where(good, 2, np.where(bad, 0, 1))
    out["votes"] = votes
    return out


def with_measures(docs: DataFrame, text_col: str = "text", names: tuple[str, ...] = FEATURES) -> DataFrame:
    """All columns of ``docs`` and the named measures, which replace columns of the same name."""
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType(
        [docs.schema[c] for c in kept] + [T.StructField(n, T.LongType(), False) for n in names]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text")).to_pylist()
            found = measure(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept]
                + [pa.array(found[n], pa.int64()) for n in names],
                kept + list(names),
            )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(*kept, text.alias("__text")).mapInArrow(run, schema)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> dict[int, float]:
    """Posterior probability of "good" for every pattern of votes that was seen.

    A rule's votes are independent given the class. It starts with the assumption that a rule
    votes right nine times as often as wrong, and stays with rules that are right more often
    than not, so that "good" keeps its meaning.
    """
    n = len(RULES)
    votes = np.stack([(patterns // 3 ** (n - 1 - r)) % 3 for r in range(n)], axis=1)
    table_ = np.empty((2, n, 3))
    table_[1], table_[0] = (0.05, 0.5, 0.45), (0.45, 0.5, 0.05)
    prior, total = 0.5, counts.sum()
    posterior = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        each = np.log(table_[:, np.arange(n), votes]).sum(axis=2)  # class, pattern
        odds = each[1] - each[0] + np.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        weight = np.stack((counts * (1 - posterior), counts * posterior))
        prior = float(np.clip(weight[1].sum() / total, 0.01, 0.99))
        for v in range(3):
            table_[:, :, v] = weight @ (votes == v) + 0.1
        table_ /= table_.sum(axis=2, keepdims=True)
        # A rule may be useless but not the wrong way round: swap what it says if it is.
        wrong = table_[1, :, 2] * table_[0, :, 0] < table_[1, :, 0] * table_[0, :, 2]
        table_[:, wrong] = table_[:, wrong].mean(axis=0)
    return dict(zip(patterns.tolist(), posterior.tolist(), strict=True))


def learn(measured: DataFrame) -> dict[int, float]:
    """Estimate from the votes on all rows; at most 3 ** 10 counts come to the driver."""
    rows = measured.groupBy("votes").count().collect()
    if not rows:
        return {}
    rows = sorted((r["votes"], r["count"]) for r in rows)
    return estimate(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float))


def judged(measured: DataFrame, posterior: dict[int, float]) -> DataFrame:
    """Measures with ``posterior``, ``base_failed`` and ``kept``."""
    spark = measured.sparkSession
    known = spark.createDataFrame(list(posterior.items()), "votes bigint, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    # At most 3 ** 10 rows.
    return (
        measured.join(F.broadcast(known), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.coalesce("posterior", F.lit(0.0)) >= THRESHOLD))
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is judged good, with the columns of ``docs``.

    The votes are taken twice, once to learn and once to decide, so that no text is shuffled.
    """
    # Own names for the columns of ``docs``, so that none of them meets a measure or a verdict.
    held = docs.toDF(*[f"__own_{n}" for n in range(len(docs.columns))])
    text = f"__own_{docs.columns.index(text_col)}"
    posterior = learn(with_measures(held, text, FEATURES).select("votes"))
    good = judged(with_measures(held, text, FEATURES), posterior).where("kept")
    return good.select(*[F.col(o).alias(c) for o, c in zip(held.columns, docs.columns, strict=True)])


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    kept = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = staged(with_measures(docs).select("doc_id", *FEATURES), "measures")
    out = judged(measured, learn(measured))
    return out.select("doc_id", *kept, "base_failed", "kept", "posterior")

