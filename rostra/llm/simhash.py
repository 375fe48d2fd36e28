"""SimHash fingerprints of word shingles, and groups of texts whose fingerprints nearly agree.

The comparison is exact. Distinct fingerprints are dealt into tiles by the population counts of
their parts (four, or two for a larger radius, whose tiles have more neighbours). If two fingerprints differ in r bits, those counts differ by r in sum at
most, so only tiles within that distance meet; within a pair of tiles all fingerprints are compared
by exclusive-or and bit counts. A pair of tiles returns a spanning forest of the links it finds
rather than all of them, which loses no connection and keeps a group of n near copies at n rows.

A NULL or empty text has fingerprint 0, and such texts are linked like any others. Repeated rows
and rows with NULL identifiers keep their own result rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rostra.llm.common import prepare, table, utf8
from rostra.session import staged

SHINGLE, SEED, RADIUS = 3, 42, 2
TILE = 2048
_PIECE = 255  # so many single bits add up without carry in eight bits

# Each byte spread to eight lanes of eight bits.
_LANES = (
    ((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(1))
    << (np.arange(8, dtype=np.uint64) * np.uint64(8))
).sum(axis=1, dtype=np.uint64)


def shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    """Hashes of all shingles of a text, repeats included; of the whole sequence if it is short."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -width] + 1)).tolist()
    return [digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits set in over half of them; 0 for an empty run."""
    pieces = -(-sizes // _PIECE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    counts = np.zeros((len(sizes), 64), dtype=np.int64)
    if len(owner):
        first = np.cumsum(pieces) - pieces
        within = np.arange(len(owner)) - first[owner]
        starts = (np.cumsum(sizes) - sizes)[owner] + within * _PIECE
        planes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        lanes = np.stack([np.add.reduceat(_LANES[planes[:, b]], starts) for b in range(8)], axis=1)
        np.add.at(counts, owner, lanes.astype("<u8").view(np.uint8).reshape(-1, 64).astype(np.int64))
    bits = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprints(
    docs: DataFrame, text_col: str = "text", width: int = SHINGLE, seed: int = SEED, to: str = "fp"
) -> DataFrame:
    """All columns of ``docs``, and ``to``: the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != to]
    shape = T.StructType([*[docs.schema[c] for c in kept], T.StructField(to, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, width, seed) for t in batch.column(len(kept)).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            values = np.fromiter((h for hs in found for h in hs), np.uint64, int(sizes.sum()))
            fps = pa.array(majority(values, sizes).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], fps], [*kept, to])

    return docs.select(*kept, utf8(text_col).alias("__text")).mapInArrow(run, shape)


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that join whatever the close pairs of the two arrays join: n - 1 for a group of n."""
    nodes = np.unique(np.concatenate((left, right)))
    place_l, place_r = np.searchsorted(nodes, left), np.searchsorted(nodes, right)
    label = np.arange(len(nodes))
    a, b = [], []
    for at in range(0, len(left), 256):
        near = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= radius
        i, j = np.nonzero(near)
        a.append(place_l[at + i])
        b.append(place_r[j])
    a, b = np.concatenate(a), np.concatenate(b)
    apart = a != b
    a, b = a[apart], b[apart]
    while True:  # smallest label of the neighbours, then follow labels to their ends
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked].view(np.int64).tolist(), nodes[label[linked]].view(np.int64).tolist()


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                left = x.values.to_numpy().view(np.uint64)
                right = y.values.to_numpy().view(np.uint64)
                u, v = forest(left, right, radius)
                a += u
                b += v
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all pairs within ``radius`` bits."""
    distinct = fps.select("fp").where("fp is not null").distinct()
    parts = 4 if radius <= 2 else 2
    bits = 64 // parts
    counts = [
        F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(((1 << bits) - 1) << (bits * p))))) for p in range(parts)
    ]
    keyed = distinct.select("fp", F.array(*[c.cast("int") for c in counts]).alias("sig"))
    # One row per combination of counts: 17 ** 4 at the most, whatever the input.
    sizes = keyed.groupBy("sig").agg(F.count("*").alias("n"))
    tiles = (
        keyed.join(F.broadcast(sizes), "sig")
        .withColumn("sub", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile)).cast("int"))
        .groupBy("sig", "sub")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = staged(tiles, "tiles")
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    ahead = [d for d in near if d >= (0,) * parts]
    steps = F.array(*[F.array(*map(F.lit, d)) for d in ahead])
    left = tiles.select("sig", "sub", "fps", F.explode(steps).alias("d")).select(
        F.transform(F.arrays_zip("sig", "d"), lambda s: s["sig"] + s["d"]).alias("sig"),
        F.col("sub").alias("sub_l"),
        F.col("fps").alias("fps_l"),
        (F.array_max(F.transform("d", F.abs)) == 0).alias("same"),
    )
    met = left.join(tiles, "sig").where("not same or sub_l <= sub").select("fps_l", "fps")
    return met.mapInArrow(_compare(radius), "a bigint, b bigint").distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of an edge, the smallest node it is connected with.

    Each round takes the smallest label of the neighbours and then the label's own label, so the
    number of rounds grows with the logarithm of the longest chain in the usual case. Rounds are
    written to the shared folder; only a count comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    both = staged(both, "edges")
    label = staged(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("label")
        ),
        "labels",
    )
    while True:
        seen = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        low = label.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")
        )
        up = label.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(
            low.join(up, "label").select("node", "old", F.least("label", "further").alias("label")), "labels"
        )
        label = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return label


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per document: ``id``, ``fp`` (signed), ``component`` (smallest identifier)."""
    fps, groups = _groups(docs, id_col, text_col, width, seed, radius)
    least = groups.groupBy("label").agg(F.min("least").alias("component"))
    by_fp = groups.join(least, "label").select("fp", "component")
    return fps.join(by_fp, "fp", "left").select("id", "fp", "component")


def _groups(docs, id_col, text_col, width, seed, radius) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every document; (fp, least id, label) of every fingerprint."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fps = staged(with_fingerprints(texts, "text", width, seed).select("id", "fp"), "fingerprints")
    label = components(links(fps, radius))
    held = fps.groupBy("fp").agg(F.min("id").alias("least"))
    groups = held.join(label.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    return fps, staged(groups, "groups")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
) -> DataFrame:
    """The row with the smallest identifier of each group, with the columns of ``docs``.

    NULL identifiers come last, and of several rows with that identifier and fingerprint one stays.
    """
    _, groups = _groups(docs, id_col, text_col, width, seed, radius)
    first = F.min(F.struct(F.col("least").isNull().alias("unknown"), "least", "fp")).alias("first")
    stays = groups.groupBy("label").agg(first).select("first.fp", "first.least")
    key = lambda fp, own: F.xxhash64(fp, own, own.isNull())
    stays = stays.select(
        F.col("fp").alias("__fp2"), F.col("least").alias("__id"), key(F.col("fp"), F.col("least")).alias("__key")
    )
    marked = with_fingerprints(docs, text_col, width, seed, "__fp")
    marked = marked.withColumn("__key", key(F.col("__fp"), F.col(id_col)))
    same = (F.col("__fp") == F.col("__fp2")) & F.col(id_col).eqNullSafe(F.col("__id"))
    # The window uses the partitioning of the join, so texts are shuffled once.
    one = Window.partitionBy("__key").orderBy(F.xxhash64(text_col))
    return (
        marked.join(stays, "__key")
        .where(same)
        .withColumn("__n", F.row_number().over(one))
        .where("__n = 1")
        .select(*docs.columns)
    )


def op9_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(prepare(spark), sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
