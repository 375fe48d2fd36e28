"""What the text operators share: session settings, text chunks, words as integer codes.

Everywhere in this subpackage a NULL text counts as an empty one, an operator reads only the
columns it is told to use (others may be there under any name), and every input row keeps its
own result row, rows with equal or NULL identifiers included, unless a docstring says otherwise.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rostra.session import configure

CHUNK_BYTES = 4 << 20

# Arrow batches are cut by rows and by bytes, so that very long texts do not meet in one batch.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(CHUNK_BYTES),
}


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str | Column) -> Column:
    """A text as bytes, empty for NULL."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def fold(id_column: str | Column, modulus: int) -> Column:
    """crc32 of the identifier written as text, modulo ``modulus``; NULL for a NULL identifier."""
    value = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(value.cast("string").cast("binary")) % modulus


def chunks(batches: Iterable[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[dict]:
    """Gather rows until their texts hold ``size`` bytes: one list per column.

    A chunk holds one text at least, so memory is bounded by ``size`` and the longest text.
    """
    held, total = None, 0
    for batch in batches:
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        if held is None:
            held = {n: [] for n in columns}
        start = 0
        for i, value in enumerate(columns[text]):
            total += len(value)
            if total >= size:
                for n, values in columns.items():
                    held[n] += values[start : i + 1]
                yield held
                held, total, start = {n: [] for n in columns}, 0, i + 1
        for n, values in columns.items():
            held[n] += values[start:]
    if held is not None and held[text]:
        yield held


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words between ASCII white space, as codes into a list of distinct words.

    Returns the codes of all words in order, the place where each text starts among them (one
    place more than texts), and the distinct words in order of first appearance.
    """
    split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
    words, ends = split.flatten(), split.offsets.to_numpy()
    real = pc.not_equal(words, "")
    kept = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    encoded = words.filter(real).dictionary_encode()
    return (
        encoded.indices.to_numpy().astype(np.int64),
        kept[ends - ends[0]],
        encoded.dictionary.cast(pa.binary()).to_pylist(),
    )


def pair_ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One integer per distinct pair, from 0; ``left`` and ``right`` are such integers."""
    if not len(left):
        return left
    keys = left * (int(right.max()) + 1) + right
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate(([0], np.diff(keys[order]) != 0))
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(fresh)
    return ranks


def owners(starts: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def sums_by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; 0 for a text without any."""
    out = np.zeros(len(starts) - 1, dtype=values.dtype)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        out[full] = np.add.reduceat(values, starts[:-1][full])
    return out


def flat(lists: Iterable[list]) -> list:
    return list(itertools.chain.from_iterable(lists))
