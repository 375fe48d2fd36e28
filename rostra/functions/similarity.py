"""Jaro-Winkler similarity, vectorised over Arrow batches (F8).

Spark has no such function. The measure is computed for a whole batch of pairs
at once with numpy: one pass per character position instead of one Python loop
per pair.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# Ship this small module with the task, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX_WEIGHT = 0.1
PREFIX_MAX = 4
BOOST_ABOVE = 0.7

# Cells of one padded character matrix; bounds the memory of one chunk of pairs.
CHUNK_CELLS = 2_000_000


def _char_matrix(texts: np.ndarray, lengths: np.ndarray, pad: int) -> np.ndarray:
    width = int(lengths.max())
    matrix = np.full((len(texts), width), pad, dtype=np.int32)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    matrix[np.arange(width) < lengths[:, None]] = codes
    return matrix


def _chunk_scores(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    left = _char_matrix(a, la, -1)
    right = _char_matrix(b, lb, -2)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    columns = np.arange(right.shape[1])
    rows = np.arange(len(a))
    free = np.ones(right.shape, dtype=bool)
    hit = np.zeros(left.shape, dtype=bool)
    for i in range(left.shape[1]):
        usable = free & (right == left[:, i : i + 1]) & (np.abs(columns - i) <= window)
        first = usable.argmax(axis=1)
        found = usable[rows, first]
        free[rows[found], first[found]] = False
        hit[:, i] = found
    matches = hit.sum(axis=1)
    taken = ~free
    wrong = left[hit] != right[taken]
    transposed = np.bincount(np.repeat(rows, matches), weights=wrong, minlength=len(a)) // 2
    m = np.maximum(matches, 1)
    jaro = np.where(matches > 0, (matches / la + matches / lb + (matches - transposed) / m) / 3.0, 0.0)
    width = min(PREFIX_MAX, left.shape[1], right.shape[1])
    same = left[:, :width] == right[:, :width]
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def batch_scores(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity in [0, 1] per pair; NaN where a side is missing, 0 where one is empty."""
    missing = (a.isna() | b.isna()).to_numpy()
    left = a.fillna("").to_numpy(dtype=object)
    right = b.fillna("").to_numpy(dtype=object)
    la = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    lb = np.fromiter(map(len, right), dtype=np.int64, count=len(right))
    result = np.where(missing, np.nan, 0.0)
    todo = np.flatnonzero(~missing & (la > 0) & (lb > 0))
    # Similar lengths side by side keep the padding small.
    todo = todo[np.argsort(np.maximum(la[todo], lb[todo]), kind="stable")]
    start = 0
    while start < len(todo):
        stop = min(len(todo), start + 8192)
        width = max(la[todo[stop - 1]], lb[todo[stop - 1]])
        stop = min(stop, start + max(1, int(CHUNK_CELLS // width)))
        part = todo[start:stop]
        result[part] = _chunk_scores(left[part], right[part], la[part], lb[part])
        start = stop
    return pd.Series(result)


@pandas_udf(DoubleType())
def _similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return batch_scores(a, b)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Similarity in [0, 1] of two text columns."""
    return _similarity_udf(a, b)


def integer_score(similarity: Column) -> Column:
    """H3: the whole-number score 0-100 that ranks matches.

    Rounded at the sixth digit first, so that the last bit of a double never
    decides on which side of a whole number a score lies.
    """
    return F.floor(F.round(similarity * 100, 6)).cast("int")
