"""Blocked fuzzy name matching.

Everything is scored on *distinct* names of a block, never on rows: copies of a
name cost nothing. The names of a block are dealt into tiles, and a task compares
two tiles: memory and the work of a task are bounded by the tile, whatever the size of the block,
the length of the names or the score asked for. Of two tiles' names only those are scored that
can reach the score:

* A Jaro-Winkler score of at least ``t`` with ``q`` equal leading characters needs
  a Jaro score of at least ``j = (t - 0.1 q) / (1 - 0.1 q)``.
* A Jaro score ``j`` of names with lengths ``la`` and ``lb`` needs at least
  ``(3 j - 1) la lb / (la + lb)`` characters in common.
* Two names have at most as many characters in common as their vectors of character counts
  have, place by place the smaller one, also where several characters share a place.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..functions.similarity import PREFIX_MAX, PREFIX_WEIGHT, batch_scores, integer_score
from ..session import staged
from .dedup import first_by, one_to_one

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names of a tile, places of a vector of character counts, names compared at once with a tile,
# and pairs that are gathered before they are scored.
TILE, PLACES, AT_ONCE, SCORED_AT_ONCE = 4096, 32, 32, 1 << 16


class Names:
    """Lengths, leading characters and character counts of some names."""

    def __init__(self, names: list[str], pad: int):
        self.names = np.array(names, dtype=object)
        self.lengths = np.fromiter(map(len, names), np.int64, len(names))
        codes = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(names)), self.lengths)
        counts = np.bincount(owner * PLACES + codes % PLACES, minlength=len(names) * PLACES)
        kind = np.uint8 if self.lengths.max(initial=0) < 256 else np.uint16 if self.lengths.max() < 1 << 16 else np.int64
        self.counts = counts.reshape(-1, PLACES).astype(kind)
        # Padded with a value of its own side, which equals nothing of the other.
        self.start = np.full((len(names), PREFIX_MAX), pad, np.int64)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        early = place < PREFIX_MAX
        self.start[owner[early], place[early]] = codes[early]


def plausible(left: Names, right: Names, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of differing names that may reach the score, some names of the left at a time."""
    agreed = PREFIX_WEIGHT * np.arange(PREFIX_MAX + 1)
    jaro = (least - agreed) / (1 - agreed)  # needed, by equal leading characters
    for at in range(0, len(left.names), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        same = left.start[some, None, :] == right.start[None, :, :]
        needed = jaro[np.cumprod(same, axis=2).sum(axis=2)]
        la, lb = left.lengths[some, None], right.lengths[None, :]
        wanted = np.maximum(np.ceil((3 * needed - 1) * la * lb / (la + lb) - 1e-9), needed > 0)
        common = np.minimum(left.counts[some, None, :], right.counts[None, :, :]).sum(axis=2, dtype=np.int64)
        i, j = np.nonzero(common >= wanted)
        i += at
        differ = left.names[i] != right.names[j]
        yield i[differ], j[differ]


def _matched(least: float, min_score: int):
    """Scores the names of two tiles: (block, l_names, r_names) to (block, l_name, r_name, similarity)."""
    def scored(blocks: pa.Array, held: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        rows = np.repeat([n for n, _, _ in held], [len(a) for _, a, _ in held])
        a, b = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        similarity = batch_scores(pd.Series(a), pd.Series(b)).to_numpy()
        fine = np.floor(np.round(similarity * 100, 6)) >= min_score
        columns = [
            blocks.take(pa.array(rows[fine])), pa.array(a[fine], pa.string()), pa.array(b[fine], pa.string()),
            pa.array(similarity[fine]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "l_name", "r_name", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, pairs = [], 0
            for n in range(batch.num_rows):
                left, right = Names(batch.column(1)[n].as_py(), -1), Names(batch.column(2)[n].as_py(), -2)
                for i, j in plausible(left, right, least):
                    if len(i):
                        held.append((n, left.names[i], right.names[j]))
                        pairs += len(i)
                    if pairs >= SCORED_AT_ONCE:
                        yield scored(batch.column(0), held)
                        held, pairs = [], 0
            if held:
                yield scored(batch.column(0), held)

    return run


def _sizes(names: DataFrame, tile: int) -> DataFrame:
    """(block, tiles): into how many lists of about ``tile`` the names of a block are dealt."""
    return names.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))


def _tiles(names: DataFrame, sizes: DataFrame, name: str, to: str) -> DataFrame:
    """(block, sub, names): the distinct names of each block in their lists."""
    sub = F.pmod(F.xxhash64(name), F.col("tiles")).cast("int").alias("sub")
    return names.join(sizes, "block").select("block", sub, name).groupBy("block", "sub").agg(F.collect_list(name).alias(to))


def _named(df: DataFrame, block: str, name: str) -> DataFrame:
    """Rows that can match at all: a NULL block or an empty name never does."""
    return df.where(F.col(block).isNotNull() & (F.length(name) > 0))


def unequal_pairs(left: DataFrame, right: DataFrame, min_score: int, tile: int = TILE) -> DataFrame:
    """(block, l_name, r_name, similarity, score): all differing name pairs of a block that reach the score.

    ``left`` has distinct (block, l_name), ``right`` distinct (block, r_name). Both are read twice, so they
    should be staged.
    """
    width = _sizes(right, tile)
    ls = _tiles(left, _sizes(left, tile), "l_name", "l_names")
    rs = _tiles(right, width, "r_name", "r_names")
    # Each tile of the left goes to every tile of the right side's same block, one task row a pair.
    sent = ls.drop("sub").join(width, "block").withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = sent.drop("tiles").join(rs, ["block", "sub"]).select("block", "l_names", "r_names")
    kind = left.schema["block"].dataType.simpleString()
    found = met.mapInArrow(
        _matched(min_score / 100 - 1e-7, min_score), f"block {kind}, l_name string, r_name string, similarity double"
    )
    return found.withColumn("score", integer_score(F.col("similarity")))


def name_pairs(
    left: DataFrame,
    right: DataFrame,
    block: str,
    left_name: str,
    right_name: str,
    min_score: int = 85,
    **tuning,
) -> DataFrame:
    """(block, l_name, r_name, similarity, score) of all distinct name pairs that match."""
    ls = _named(left, block, left_name).select(
        F.col(block).alias("block"), F.col(left_name).alias("l_name")
    )
    rs = _named(right, block, right_name).select(
        F.col(block).alias("block"), F.col(right_name).alias("r_name")
    )
    ls, rs = staged(ls.distinct(), "left-names"), staged(rs.distinct(), "right-names")
    equal = ls.join(rs, (ls["block"] == rs["block"]) & (ls["l_name"] == rs["r_name"])).select(
        ls["block"], "l_name", "r_name", F.lit(1.0).alias("similarity"), F.lit(100).alias("score")
    )
    return equal.unionByName(unequal_pairs(ls, rs, min_score, **tuning))


def fuzzy_left_join(
    left: DataFrame,
    right: DataFrame,
    block: str,
    left_name: str,
    right_name: str,
    min_score: int = 85,
    **tuning,
) -> DataFrame:
    """Each left row with every matching right row of its block, or with NULLs.

    Names are matched once per distinct pair; rows then meet by plain equi-joins on
    (block, name), which Spark can split where a key is hot. ``block`` of the right
    side is not repeated.
    """
    pairs = name_pairs(left, right, block, left_name, right_name, min_score, **tuning)
    partners = right.join(
        pairs, (right[block] == pairs["block"]) & (right[right_name] == pairs["r_name"])
    ).select(
        pairs["block"].alias("_block"),
        F.col("l_name").alias("_l_name"),
        *[right[c] for c in right.columns if c != block],
    )
    return left.join(
        partners,
        (left[block] == partners["_block"]) & (left[left_name] == partners["_l_name"]),
        "left",
    ).drop("_block", "_l_name")


def best_matches(
    left: DataFrame,
    right: DataFrame,
    block: str,
    left_id: str,
    left_name: str,
    right_id: str,
    right_name: str,
    min_score: int = 85,
    **tuning,
) -> DataFrame:
    """J7 + W3: one-to-one assignment (left_id, right_id, score) within blocks.

    The best partner of a row depends on its (block, name) only, and among equal
    right names the smallest id wins. So the choice is made per distinct name. A
    name with an equal partner is done at score 100 and is never compared further.
    """
    lrows = _named(left, block, left_name).select(
        F.col(left_id), F.col(block).alias("block"), F.col(left_name).alias("l_name")
    )
    rnames = staged(
        _named(right, block, right_name)
        .groupBy(F.col(block).alias("block"), F.col(right_name).alias("r_name"))
        .agg(F.min(right_id).alias(right_id)),
        "right-names",
    )
    lnames = lrows.select("block", "l_name").distinct()
    same = (lnames["block"] == rnames["block"]) & (lnames["l_name"] == rnames["r_name"])
    tried = staged(
        lnames.join(rnames, same, "left").select(lnames["block"], "l_name", right_id), "equal-names"
    )
    equal = tried.where(F.col(right_id).isNotNull()).withColumn("score", F.lit(100))
    rest = tried.where(F.col(right_id).isNull()).select("block", "l_name")
    pairs = unequal_pairs(rest, rnames.select("block", "r_name"), min_score, **tuning)
    near = first_by(
        pairs.join(rnames, ["block", "r_name"]),
        ["block", "l_name"],
        [F.desc("score"), F.asc(right_id)],
    ).select("block", "l_name", right_id, "score")
    chosen = equal.unionByName(near)
    pairs = lrows.join(chosen, ["block", "l_name"]).select(left_id, right_id, "score")
    return one_to_one(pairs, left_id, right_id, "score")
