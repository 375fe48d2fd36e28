"""The most similar rows of a sparse matrix by cosine.

Rows are dealt into blocks of rows with their weight in the same part of the columns, and each block
into cells by part. The cells of a block are written to one file of the shared folder. A task holds a strip of
blocks, reads the files of the blocks it is to be compared with one after another, and every row of the strip
keeps its best partners only. So what is written and shuffled grows with the entries, the rows and, by a few bytes a pair,
the pairs of blocks, however many rows have to be compared; files are read once per strip. A column that
everybody has an entry in is cut by the blocks.

Matrices of few columns are multiplied with rounded numbers first. Only pairs that can still be among the best within
the error of that are multiplied exactly. Where columns are many, the product of two blocks is summed cell by cell.

Two bounds save products. The products of blocks with themselves come first and give each row a
similarity to beat. Two blocks are multiplied only if they can reach it: by Cauchy and Schwarz the cosine
of two rows is at most the sum over the parts of the products of their shares in them.

Rows that are equal are multiplied once, as the class of their smallest identifier. A row that has ``k`` others of its
direction needs no product at all: nothing is more similar than 1. Where columns have few entries, as
roll calls of a few voters, the pairs of entries are no more than a few times the entries. Then they are added up
directly, and blocks are not made.

Values should be whole numbers below 2 ** 26 where equal similarities matter: then products are exact, and
ties go to the smaller identifier. Otherwise the last bits of a similarity decide.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir, staged
from .dedup import leading

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = 64
BLOCK_ROWS, CELL_ENTRIES, BOUNDS_TILE = 1024, 1 << 18, 1024
# Columns of a dense product, and pairs of entries of a sparse one, that are held at once.
DENSE_COLUMNS, SPARSE_PAIRS = 1024, 1 << 20
# Sparse products cost about so many dense multiplications each.
SPARSE_COST = 100

# Matrices of at most so many columns are kept dense; blocks that a task holds, as many as fit so many bytes then.
NARROW, STRIP_BLOCKS, STRIP_BYTES = 4096, 8, 1 << 27
# Error of a rounded product per column, a little more than half a unit in the last place of a 32-bit number.
ROUNDED = 6.1e-8

# Columns are paired directly if they make at most so many pairs per entry, and none has more entries than this.
LIGHT_PAIRS, LIGHT_COLUMN = 8, 4096
# Equal rows are looked for in matrices of more rows than one block.
CLASSES_FROM = 1024

_FOUND = "rid long, other long, similarity double"


def _entries(df: DataFrame, row: str, col: str, value: Column, part: str | None) -> DataFrame:
    """One entry (r, c, p, v) per row and column, without zeros."""
    own = F.col(part) if part else F.col(col)
    return (
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.col(row).alias("r"), F.col(col).alias("c"), F.pmod(F.xxhash64(own), F.lit(PARTS)).cast("int").alias("p"))
        .agg(F.sum(value).cast("double").alias("v"))
        .where("v <> 0")
    )


def _light(entries: DataFrame) -> bool:
    """Whether pairing the entries of each column makes a few pairs per entry only."""
    n = F.col("n")
    sizes = entries.groupBy("p", "c").agg(F.count("*").alias("n"))
    total, pairs, most = sizes.agg(F.sum(n), F.sum(n.cast("double") * (n - 1)), F.max(n)).first()
    return total is not None and pairs <= LIGHT_PAIRS * total and most <= LIGHT_COLUMN


def _paired(entries: DataFrame, k: int) -> DataFrame:
    """(r, other, similarity): the best partners by adding up the pairs of entries of every column."""
    norms = entries.groupBy("r").agg(F.sum(F.col("v") * F.col("v")).alias("norm2"))
    rows = staged(norms.orderBy("r").withColumn("rid", F.monotonically_increasing_id()), "matrix-rows")
    placed = entries.join(rows.select("r", "rid"), "r")
    held = placed.groupBy("p", "c").agg(F.collect_list(F.struct("rid", "v")).alias("held")).where(F.size("held") > 1)
    pairs = held.select("held", F.explode("held").alias("a")).select("a", F.explode("held").alias("b")).where("a.rid < b.rid")
    dots = pairs.groupBy(F.col("a.rid").alias("a"), F.col("b.rid").alias("b")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("dot"))
    side = lambda x: rows.select(F.col("rid").alias(x), F.col("norm2").alias(f"{x}_norm2"))
    similarity = F.col("dot") / F.sqrt(F.col("a_norm2") * F.col("b_norm2"))
    scored = dots.where("dot > 0").join(side("a"), "a").join(side("b"), "b").select("a", "b", similarity.alias("similarity"))
    both = F.array(F.struct(F.col("a").alias("rid"), F.col("b").alias("other")), F.struct(F.col("b").alias("rid"), F.col("a").alias("other")))
    found = staged(scored.select(F.explode(both).alias("x"), "similarity").select("x.*", "similarity"), "matrix-found")
    best = leading(found, ["rid"], [F.desc("similarity"), F.asc("other")], k)
    return _by_name(best, rows)


def _by_name(found: DataFrame, rows: DataFrame) -> DataFrame:
    name = lambda x, y: rows.select(F.col("rid").alias(x), F.col("r").alias(y))
    return found.join(name("rid", "r"), "rid").join(name("other", "_other"), "other").select("r", F.col("_other").alias("other"), "similarity")


def _classes(entries: DataFrame, k: int) -> DataFrame:
    """(r, rep, way, settled): rows by the first of their equals, and by direction.

    Rows are told apart by two 64-bit hashes of their entries, their number and their length. Whole numbers
    divided by the greatest of their row are equal for equal directions only. A row is settled if ``k`` others share
    its direction and no other pair of rows is so long that its cosine could round to 1.
    """
    top = F.max(F.abs("v")).over(Window.partitionBy("r"))
    v, way = F.col("v"), F.col("v") / F.col("top")
    marks = entries.withColumn("top", top).groupBy("r").agg(
        F.count("*").alias("n"), F.sum(v * v).alias("norm2"),
        *[F.bit_xor(F.xxhash64(F.lit(seed), "p", "c", x)).alias(f"{name}{seed}") for name, x in (("e", v), ("d", way)) for seed in (1, 2)],
    )
    marks = staged(marks, "matrix-marks")
    longest = F.lit(marks.agg(F.max("norm2")).first()[0] or 0.0)
    own, line = ["n", "norm2", "e1", "e2"], ["n", "d1", "d2"]
    classes = marks.groupBy(*own).agg(F.min("r").alias("rep"))
    ways = marks.groupBy(*line).agg(F.min("r").alias("way"), F.count("*").alias("many"))
    settled = (F.col("many") > k) & (F.col("norm2") * longest < float(1 << 53))
    return staged(
        marks.join(classes, own).join(ways, line).select("r", "rep", "way", settled.alias("settled")), "matrix-classes"
    )


def _few(members: DataFrame, key: str, k: int) -> DataFrame:
    """(key, few): the first k + 1 members of each class, one more than a member needs."""
    first = leading(members.select(key, "r"), [key], [F.asc("r")], k + 1)
    return first.groupBy(key).agg(F.sort_array(F.collect_list("r")).alias("few"))


def _expanded(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(r, other, similarity) of all rows from (r, other, similarity) of the classes that are not settled."""
    one, few = F.lit(1.0).alias("similarity"), _few(members, "rep", k)
    partners = found.join(few, found["other"] == few["rep"]).select(found["r"].alias("rep"), "similarity", F.explode("few").alias("other"))
    open_ = members.where("not settled")
    own = few.join(open_.select("rep").distinct(), "rep", "left_semi").select("rep", one, F.explode("few").alias("other"))
    # One more than a member needs, for it may be among them.
    best = leading(partners.unionByName(own), ["rep"], [F.desc("similarity"), F.asc("other")], k + 1)
    unsettled = open_.select("r", "rep").join(best, "rep").where("r <> other").select("r", "other", "similarity")
    alike = _few(members.where("settled"), "way", k)
    settled = members.where("settled").select("r", "way").join(alike, "way").select("r", F.explode("few").alias("other"), one)
    return unsettled.unionByName(settled.where("r <> other").select("r", "other", "similarity"))


def _rows(entries: DataFrame, block_rows: int, settled: DataFrame | None = None) -> DataFrame:
    """(r, rid, block, norm2, shares, start): rid ascends with r; shares are squared lengths by part.

    ``start`` is the similarity a row has to reach from the beginning: none, or no number for a settled one.
    """
    by_part = entries.groupBy("r", "p").agg(F.sum(F.col("v") * F.col("v")).alias("s"))
    rows = by_part.groupBy("r").agg(
        F.sum("s").alias("norm2"), F.max_by("p", "s").alias("main"), F.collect_list(F.struct("p", "s")).alias("shares")
    )
    rows = rows.withColumn("settled", F.lit(False)) if settled is None else rows.join(settled, "r")
    rows = staged(rows.orderBy("r").withColumn("rid", F.monotonically_increasing_id()), "matrix-rows")
    # At most two rows per part.
    sizes = rows.groupBy("main", "settled").agg(F.ceil(F.count("*") / block_rows).alias("subs"))
    at = F.shiftleft(F.col("settled").cast("long"), 50) + F.shiftleft(F.col("main").cast("long"), 40)
    block, start = at + F.pmod(F.xxhash64("r"), F.col("subs")), F.when(F.col("settled"), float("inf")).otherwise(0.0)
    placed = rows.join(F.broadcast(sizes), ["main", "settled"])
    return staged(placed.select("r", "rid", block.alias("block"), "norm2", "shares", start.alias("start")), "matrix-rows")


class Cells(NamedTuple):
    """Files in a folder by block, each with its cells; ``columns`` is their number if they are few."""

    files: dict[int, str]
    root: str
    columns: int | None


_CELL = pa.schema([("p", pa.int32()), ("s", pa.int32()), ("places", pa.list_(pa.int32())), ("cids", pa.list_(pa.int64())), ("vs", pa.list_(pa.float64()))])


def _at(root: str, name: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file in the shared folder, whose address Arrow spells another way than Spark."""
    scheme, colon, rest = root.partition(":")
    if scheme == "dbfs" and colon:
        uri = "/dbfs/" + rest.lstrip("/")
    else:
        uri = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}.get(scheme, scheme) + colon + rest
    system, folder = fs.FileSystem.from_uri(uri)
    return system, f"{folder}/{name}"


def _cells(entries: DataFrame, rows: DataFrame, cell_entries: int) -> Cells:
    """The entries of a block in a slice of a part are one cell. Its rows come first in the file, as part -1."""
    distinct = staged(entries.select("p", "c").distinct(), "matrix-columns")
    columns = distinct.count()
    narrow = columns <= NARROW
    numbered = F.row_number().over(Window.orderBy("p", "c")).cast("long") - 1 if narrow else F.monotonically_increasing_id()
    distinct = staged(distinct.withColumn("cid", numbered), "matrix-columns")
    placed = staged(
        entries.join(rows.select("r", "rid", "block"), "r").join(distinct, ["p", "c"]).select("block", "p", "rid", "cid", "v"),
        "matrix-entries",
    )
    counts = placed.groupBy("block", "p").agg(F.count("*").alias("n")).groupBy("p").agg(F.max("n").alias("n"))
    slices = counts.select("p", F.ceil(F.col("n") / cell_entries).alias("slices"))
    sliced = placed.join(F.broadcast(slices), "p").withColumn("s", F.pmod(F.xxhash64("cid"), F.col("slices")).cast("int"))
    own = rows.select("block", F.lit(-1).alias("p"), F.lit(0).alias("s"), "rid", F.lit(0).cast("long").alias("cid"), F.col("norm2").alias("v"))
    every = sliced.select(*own.columns).unionByName(own).repartition("block")
    cells = every.groupBy("block", "p", "s").agg(F.sort_array(F.collect_list(F.struct("rid", "cid", "v"))).alias("held"))
    dealt = cells.select("block", "p", "s", *[F.col(f"held.{c}").alias(f"{c}s") for c in ("rid", "cid", "v")]).sortWithinPartitions("block", "p", "s")
    root = shared_dir(entries.sparkSession, "matrix-cells")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in groupby(((b, n) for b in batches for n in range(b.num_rows)), lambda x: x[0].column(0)[x[1]].as_py()):
            name, rids = f"{block}-{uuid.uuid4().hex}", None
            system, path = _at(root, name)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path) as out, pa.ipc.new_file(out, _CELL, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                for batch, n in held:
                    p, s, own, cids, vs = (batch.column(c)[n] for c in range(1, 6))
                    own = own.values.to_numpy()
                    rids = own if rids is None else rids  # of part -1
                    cids = own if p.as_py() < 0 else cids.values.to_numpy()
                    values = [p.as_py()], [s.as_py()], [np.searchsorted(rids, own)], [cids], [vs.values.to_numpy()]
                    to.write_batch(pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _CELL.types, strict=True)], schema=_CELL))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([name])], ["block", "name"])

    # Some hundred bytes for a thousand rows; a task that is run again writes files that are not listed.
    return Cells(dict(dealt.mapInArrow(write, "block long, name string").collect()), root, columns if narrow else None)


class _Block:
    """A block as its file has it: identifiers and squared lengths of its rows, and its cells one by one."""

    def __init__(self, root: str, name: str, columns: int | None):
        system, path = _at(root, name)
        self.name, self._file = name, pa.ipc.open_file(system.open_input_file(path))
        _, _, _, self.rids, self.norm2 = self._cell(0)
        if columns:
            self.exact = np.zeros((len(self.rids), columns))
            for _, (places, cids, vs) in self.cells():
                self.exact[places, cids] = vs
            self.rounded = (self.exact / np.sqrt(self.norm2)[:, None]).astype(np.float32)

    def _cell(self, n: int) -> tuple:
        batch = self._file.get_batch(n)
        lists = (batch.column(c)[0].values.to_numpy() for c in range(2, 5))
        return batch.column(0)[0].as_py(), batch.column(1)[0].as_py(), *lists

    def cells(self) -> Iterator[tuple[tuple[int, int], tuple]]:
        """((part, slice), (row places, columns, values)), ascending."""
        for n in range(1, self._file.num_record_batches):
            p, s, *held = self._cell(n)
            yield (p, s), tuple(held)


def _total(a: _Block, b: _Block) -> np.ndarray:
    """The product of two blocks, cell by cell."""
    total, left, right = np.zeros((len(a.rids), len(b.rids))), a.cells(), b.cells()
    x, y = next(left, None), next(right, None)
    while x and y:
        if x[0] == y[0]:
            _added(total, x[1], y[1])
        x, y = next(left, None) if x[0] <= y[0] else x, next(right, None) if y[0] <= x[0] else y
    return total


def _added(total: np.ndarray, a: tuple, b: tuple) -> None:
    """Add the product of two cells, given as (row place, column, value), to the sums."""
    (ra, ca, va), (rb, cb, vb) = a, b
    shared = np.intersect1d(ca, cb)
    if not len(shared):
        return
    keep_a, keep_b = np.isin(ca, shared), np.isin(cb, shared)
    ra, ca, va = ra[keep_a], np.searchsorted(shared, ca[keep_a]), va[keep_a]
    rb, cb, vb = rb[keep_b], np.searchsorted(shared, cb[keep_b]), vb[keep_b]
    order = np.argsort(cb, kind="stable")
    rb, cb, vb = rb[order], cb[order], vb[order]
    starts = np.searchsorted(cb, np.arange(len(shared) + 1))
    many = np.diff(starts)[ca]
    if int(many.sum()) * SPARSE_COST <= total.size * len(shared):
        ends = np.cumsum(many)
        at = 0
        while at < len(ca):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SPARSE_PAIRS)))
            some = many[at:stop]
            mine = np.repeat(np.arange(at, stop), some)
            theirs = np.arange(len(mine)) + np.repeat(starts[ca[at:stop]] - (np.cumsum(some) - some), some)
            np.add.at(total, (ra[mine], rb[theirs]), va[mine] * vb[theirs])
            at = stop
        return
    for low in range(0, len(shared), DENSE_COLUMNS):
        width = min(DENSE_COLUMNS, len(shared) - low)
        left, right = np.zeros((total.shape[0], width)), np.zeros((total.shape[1], width))
        some = (ca >= low) & (ca < low + width)
        left[ra[some], ca[some] - low] = va[some]
        some = (cb >= low) & (cb < low + width)
        right[rb[some], cb[some] - low] = vb[some]
        total += left @ right.T


class _Best:
    """The ``k`` best partners so far of the rows of a block that still look for some; equal ones by identifier."""

    def __init__(self, block: _Block, floors: np.ndarray, k: int):
        self.block, self.k = block, k
        self.open = np.flatnonzero(np.isfinite(floors))
        self.floors = floors[self.open]
        self.similar = np.full((len(self.open), k), -np.inf)
        self.others = np.full((len(self.open), k), np.iinfo(np.int64).max)

    def _candidates(self, b: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in b, product) of the pairs that may be among the best, by rounded numbers."""
        about = self.block.rounded[self.open] @ b.rounded.T
        if b.name == self.block.name:
            about[np.arange(len(self.open)), self.open] = 0
        error = ROUNDED * (self.block.exact.shape[1] + 8)
        fine = (about >= (self.floors - error).astype(np.float32)[:, None]) & (about != 0)
        if fine.sum() > 4 * self.k * len(fine) and about.shape[1] > self.k:
            # No row has more than k partners better than its k-th best here.
            kth = np.partition(about, about.shape[1] - self.k, axis=1)[:, -self.k]
            fine &= about >= (kth - np.float32(3 * error))[:, None]
        rows, places = np.nonzero(fine)
        dots = np.empty(len(rows))
        at_once = max(1, SPARSE_PAIRS // self.block.exact.shape[1])
        for at in range(0, len(rows), at_once):
            some = slice(at, at + at_once)
            dots[some] = np.einsum("ij,ij->i", self.block.exact[self.open[rows[some]]], b.exact[places[some]])
        return rows, places, dots

    def meet(self, b: _Block) -> None:
        """Compare the rows with those of another block, or of their own."""
        if not len(self.open):
            return
        if hasattr(b, "exact"):
            rows, places, dots = self._candidates(b)
        else:
            total = _total(self.block, b)
            if b.name == self.block.name:
                np.fill_diagonal(total, 0)
            rows, places = np.nonzero(total[self.open] > 0)
            dots = total[self.open[rows], places]
        similar = dots / np.sqrt(self.block.norm2[self.open[rows]] * b.norm2[places])
        fine = (dots > 0) & (similar >= self.floors[rows])
        rows, others, similar = rows[fine], b.rids[places[fine]], similar[fine]
        if not len(rows):
            return
        met = np.unique(rows)
        rows = np.concatenate([np.repeat(met, self.k), rows])
        others, similar = np.concatenate([self.others[met].ravel(), others]), np.concatenate([self.similar[met].ravel(), similar])
        order = np.lexsort((others, -similar, rows))
        rows, others, similar = rows[order], others[order], similar[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = place < self.k
        self.others[met], self.similar[met] = others[top].reshape(-1, self.k), similar[top].reshape(-1, self.k)
        self.floors[met] = np.maximum(self.floors[met], self.similar[met, -1])

    def found(self) -> pa.RecordBatch:
        rows, places = np.nonzero(self.similar > 0)
        arrays = [self.block.rids[self.open[rows]], self.others[rows, places], self.similar[rows, places]]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["rid", "other", "similarity"])


def _products(pairs: DataFrame, cells: Cells, blocks: DataFrame, k: int) -> DataFrame:
    """(rid, other, similarity): for the pairs (i, j) of blocks, the best partners of each row in the other blocks."""
    both = pairs.union(pairs.where("i <> j").select("j", "i"))
    met = both.groupBy("i").agg(F.sort_array(F.collect_list("j")).alias("others"))
    # Blocks next to each other are held by one task.
    most = blocks.agg(F.max(F.size("rows"))).first()[0] or 1
    strip = max(1, min(STRIP_BLOCKS, STRIP_BYTES // (most * (cells.columns or 1) * 12), len(cells.files) // 64))
    strips = blocks.select(F.col("block").alias("i"), F.floor((F.row_number().over(Window.orderBy("block")) - 1) / strip).alias("strip"))
    held = blocks.select(F.col("block").alias("i"), F.col("rows.floor").alias("floors")).join(strips, "i").join(met, "i")
    tasks = max(1, -(-len(cells.files) // strip))
    dealt = held.select("strip", "i", "floors", "others").repartitionByRange(tasks, "strip").sortWithinPartitions("strip")
    files = cells.files
    root, columns = cells.root, cells.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, n) for b in batches for n in range(b.num_rows))
        for _, some in groupby(rows, lambda x: x[0].column(0)[x[1]].as_py()):
            best, wanted = [], {}
            for batch, n in some:
                own, floors, others = (batch.column(c)[n] for c in range(1, 4))
                for other in others.as_py():
                    wanted.setdefault(other, []).append(len(best))
                best.append(_Best(_Block(root, files[own.as_py()], columns), floors.values.to_numpy(), k))
            for other, by in wanted.items():
                b = _Block(root, files[other], columns)
                for n in by:
                    best[n].meet(b)
            for one in best:
                yield one.found()

    return dealt.mapInArrow(run, _FOUND)


def _promising(bounds: DataFrame, tile: int) -> DataFrame:
    """Pairs (i, j), i < j, of blocks (block, floor, shares) whose rows may be similar enough."""
    tiles = max(1, -(-bounds.count() // tile))
    packed = staged(
        bounds.groupBy(F.pmod(F.xxhash64("block"), F.lit(tiles)).cast("int").alias("t")).agg(
            F.collect_list(F.struct("block", "floor", "shares")).alias("held")
        ),
        "matrix-bounds",
    )
    left = packed.select(
        F.col("t").alias("own"), F.col("held").alias("mine"), F.explode(F.sequence(F.col("t"), F.lit(tiles - 1))).alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = row["mine"], row["held"]
                share_a, share_b = (np.array([x["shares"] for x in s]) for s in (a, b))
                floor_a, floor_b = (np.array([x["floor"] for x in s]) for s in (a, b))
                block_a, block_b = (np.array([x["block"] for x in s], np.int64) for s in (a, b))
                most = share_a @ share_b.T
                fine = (most > 0) & (most + 1e-9 >= np.minimum(floor_a[:, None], floor_b[None, :]))
                fine &= block_a[:, None] < block_b[None, :] if row["own"] == row["t"] else True
                i, j = np.nonzero(fine)
                low, high = np.minimum(block_a[i], block_b[j]), np.maximum(block_a[i], block_b[j])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["i", "j"])

    return left.join(packed, "t").select("own", "t", "mine", "held").mapInArrow(run, "i long, j long")


def _best_schema(entries: DataFrame) -> str:
    kind = entries.schema["r"].dataType.simpleString()
    return f"r {kind}, other {kind}, similarity double"


def _multiplied(
    entries: DataFrame, k: int, block_rows: int, cell_entries: int, settled: DataFrame | None = None
) -> DataFrame:
    """(r, other, similarity): the best partners by products of blocks; none for rows that are ``settled``."""
    rows = _rows(entries, block_rows, settled)
    cells = _cells(entries, rows, cell_entries)
    plain = rows.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("rid", "norm2", F.col("start").alias("floor")))).alias("rows"), F.min("start").alias("start")
    )
    own = plain.where(F.col("start") == 0).select(F.col("block").alias("i"), F.col("block").alias("j"))
    first = staged(_products(own, cells, plain, k), "matrix-found")

    # What a row has to beat: its k-th best so far.
    kth = first.groupBy("rid").agg(F.count("*").alias("n"), F.min("similarity").alias("least"))
    floor = F.when(F.col("n") >= k, F.col("least")).otherwise(F.col("start"))
    floors = rows.join(kth, "rid", "left").withColumn("floor", floor)
    shares = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.coalesce(F.element_at("by_part", p), F.lit(0.0)))
    of_part = rows.select("block", "norm2", F.explode("shares").alias("x")).groupBy("block", F.col("x.p").alias("p")).agg(
        F.sqrt(F.max(F.col("x.s") / F.col("norm2"))).alias("m")
    )
    bounds = of_part.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("p", "m"))).alias("by_part"))
    blocks = staged(
        floors.groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("rid", "norm2", "floor"))).alias("rows"), F.min("floor").alias("floor")
        ).join(bounds, "block").select("block", "rows", "floor", shares.alias("shares")),
        "matrix-blocks",
    )
    pairs = staged(_promising(blocks.select("block", "floor", "shares"), BOUNDS_TILE), "matrix-pairs")
    found = first.union(_products(pairs, cells, blocks, k))
    return _by_name(leading(found, ["rid"], [F.desc("similarity"), F.asc("other")], k), rows)


def most_similar(
    df: DataFrame,
    row: str,
    col: str,
    value: Column,
    part: str | None = None,
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    cell_entries: int = CELL_ENTRIES,
) -> DataFrame:
    """(row, rank, other, similarity): each row's ``k`` best partners with a similarity above 0.

    Entries of one row and column are added up; ``part`` is a coarser name of the column, such as the body
    that holds a vote. Rows and columns without a name are left out.
    """
    entries = staged(_entries(df, row, col, value, part), "matrix-entries")
    if _light(entries):
        best = _paired(entries, k)
    elif entries.select("r").distinct().count() <= CLASSES_FROM:
        best = _multiplied(entries, k, block_rows, cell_entries)
    else:
        members = _classes(entries, k)
        reps = members.where("r = rep").select("r", "settled")
        if reps.where("not settled").isEmpty():
            best = _expanded(entries.sparkSession.createDataFrame([], _best_schema(entries)), members, k)
        else:
            own = staged(entries.join(reps.select("r"), "r", "left_semi"), "matrix-entries")
            best = _expanded(_multiplied(own, k, block_rows, cell_entries, reps), members, k)
    rank = F.row_number().over(Window.partitionBy("r").orderBy(F.desc("similarity"), "other"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("r").alias(row), "rank", "other", "similarity")
