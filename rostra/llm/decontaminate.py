"""Positional inverted index over documents, and exact or near phrase search of benchmark items.

The index is cut into segments by documents. A segment is one row: its documents, its terms and,
for every term, the ascending positions at which it stands. Segments are built where the texts are
read, without a shuffle, and written to the shared folder. A search takes the phrases in blocks of
bounded size, which a Spark job writes to the shared folder and each task reads one after another, to all
segments; the driver knows their folder only. Inside a segment every phrase starts from its rarest term: that term's
positions, shifted by its place in the phrase, are the candidate starts, and the position lists of
the other terms, rarest first, are intersected with them, each shifted by its own place.

Words are compared with A-Z in lower case; they consist of ASCII letters, digits and all characters
outside ASCII. NULL texts have no words. A benchmark item of fewer words than a window, but not
none, is one window; an item without words matches nothing; items with equal identifiers count as
one item, and NULL is the identifier ''. Repeated documents and documents with NULL identifiers keep
their own result rows. Empty tables give an empty result or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rostra.llm import storage
from rostra.llm.common import chunks, codes, prepare, table, utf8
from rostra.llm.packing import pack, unpack
from rostra.session import shared_dir, staged

WINDOW = 10
BLOCK_BYTES = 2 << 20  # benchmark text that a task holds at once
GAP = 64  # positions left free between documents; a search may be sloppy by less than half of it
CANDIDATES = 1 << 21

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))


def plain(text: bytes) -> bytes:
    """A-Z in lower case, and a space for every character that is not part of a word."""
    return text.translate(_TABLE)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the segments of an index and return them.

    Columns: ``segment``; per document ``ids``, ``marks`` (hash of the text) and ``sizes`` (words);
    ``terms``, ``lengths`` of the position lists, and ``positions``, all lists in a row.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), utf8(text_col).alias("text")
    )
    kind = source.schema["id"].dataType
    fields = [
        ("segment", pa.int64()),
        ("ids", pa.list_(to_arrow_type(kind))),
        ("marks", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("terms", pa.list_(pa.binary())),
        ("lengths", pa.binary()),
        ("positions", pa.binary()),
    ]
    names, types = zip(*fields, strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for n, chunk in enumerate(chunks(batches, "text")):
            words, starts, terms = codes([plain(t) for t in chunk["text"]])
            sizes = np.diff(starts)
            places = np.arange(len(words)) + GAP * np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(words, kind="stable")
            lengths = np.bincount(words, minlength=len(terms))
            listed = places[order]
            step = np.diff(listed, prepend=0)
            heads = (np.cumsum(lengths) - lengths)[lengths > 0]
            step[heads] = listed[heads]
            row = [
                (task.partitionId() << 32) + n,
                chunk["id"],
                chunk["mark"],
                pack(sizes),
                terms,
                pack(lengths),
                pack(step),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    schema = (
        f"segment bigint, ids array<{kind.simpleString()}>, marks array<bigint>, sizes binary, "
        "terms array<binary>, lengths binary, positions binary"
    )
    return staged(source.mapInArrow(run, schema), "positions")


class Segment:
    """The position lists of one segment, as one sorted array of (term, position)."""

    def __init__(self, sizes: bytes, terms: pa.Array, lengths: bytes, positions: bytes):
        self.sizes = unpack(sizes).astype(np.int64)
        self.terms = terms
        self.lengths = unpack(lengths).astype(np.int64) if len(terms) else np.zeros(0, np.int64)
        step = unpack(positions).astype(np.int64)
        total = np.cumsum(step)
        self.heads = np.cumsum(self.lengths) - self.lengths
        base = np.where(self.heads > 0, total[self.heads - 1], 0) if len(self.heads) else self.heads
        self.positions = total - np.repeat(base, self.lengths)
        self.keys = (np.repeat(np.arange(len(terms)), self.lengths) << 40) | self.positions
        self.doc_starts = np.cumsum(self.sizes + GAP) - (self.sizes + GAP)

    def find(self, phrases: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (phrase, position) of phrases of one length, given as own term numbers.

        With ``slop`` every term may stand up to so many words from its place, in either
        direction, in the same document; the position is where the rarest term puts the start.
        """
        width = phrases.shape[1]
        alive = np.flatnonzero((phrases >= 0).all(axis=1))
        if not len(alive):
            return alive, alive
        phrases = phrases[alive]
        rank = np.argsort(self.lengths[phrases], axis=1, kind="stable")
        rare = np.take_along_axis(phrases, rank, axis=1)
        sizes = self.lengths[rare[:, 0]]
        out = []
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // CANDIDATES)) + 1
        for rows in np.split(np.arange(len(alive)), cut):
            which = np.repeat(rows, sizes[rows])
            within = np.arange(len(which)) - np.repeat(np.cumsum(sizes[rows]) - sizes[rows], sizes[rows])
            start = self.positions[self.heads[rare[which, 0]] + within] - rank[which, 0]
            for k in range(1, width):
                wanted = (rare[which, k] << 40) + start + rank[which, k]
                at = np.searchsorted(self.keys, wanted - slop)
                near = self.keys[np.minimum(at, len(self.keys) - 1)]
                met = (at < len(self.keys)) & (near <= wanted + slop) & (near >= wanted - slop)
                which, start = which[met], start[met]
            out.append((alive[which], start))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def phrase_windows(items: list[tuple[str, bytes]], width: int) -> tuple[list[bytes], list]:
    """Distinct terms of some items, and their windows by length: (terms of each, item of each)."""
    words, starts, terms = codes([plain(t) for _, t in items])
    by_length: dict[int, tuple[list, list]] = {}
    for n, (s, e) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        if e > s:
            length = min(width, e - s)
            rows = np.lib.stride_tricks.sliding_window_view(words[s:e], length)
            held = by_length.setdefault(length, ([], []))
            held[0].append(rows)
            held[1].append(np.full(len(rows), n))
    return terms, [(np.concatenate(r), np.concatenate(i)) for r, i in by_length.values()]


def _written_blocks(items: DataFrame) -> str:
    """The items (item, text) in blocks of about ``BLOCK_BYTES``, one row each; returns the folder."""
    path = shared_dir(items.sparkSession, "benchmark-blocks")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text", BLOCK_BYTES):
            names, texts = pa.array([chunk["item"]], pa.list_(pa.string())), pa.array([chunk["text"]], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([names, texts], ["items", "texts"])

    dealt = items.repartition(max(1, -(-total // BLOCK_BYTES)))
    dealt.mapInArrow(run, "items array<string>, texts array<binary>").write.parquet(path)
    return path


def _blocks(path: str) -> Iterator[list[tuple[str, bytes]]]:
    """The blocks of a folder one after another, as a task reads them."""
    system, folder = storage.at(path)
    for info in system.get_file_info(fs.FileSelector(folder)):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=1):
                    for row in batch.to_pylist():
                        yield list(zip(row["items"], row["texts"], strict=True))


class _Windows:
    """Prepared blocks. A single block is prepared once for a task; of several, one is held at a time."""

    def __init__(self, path: str, width: int):
        self.path, self.width, self.only = path, width, None

    def __iter__(self):
        if self.only is not None:
            yield self.only
            return
        held, many = None, False
        for items in _blocks(self.path):
            many = held is not None
            terms, lengths = phrase_windows(items, self.width)
            held = [name for name, _ in items], pa.array(terms, pa.binary()), lengths
            yield held
        if held is not None and not many:
            self.only = held


def _search(path: str, width: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Windows(path, width)
        for batch in batches:
            for i in range(batch.num_rows):
                number, sizes, own, counts, positions = (batch.column(c)[i] for c in range(5))
                own = own.values
                if not len(own):
                    continue
                seg = Segment(sizes.as_py(), own, counts.as_py(), positions.as_py())
                for names, terms, lengths in blocks:
                    if lengths:
                        yield hits(number, own, seg, names, terms, lengths)

    def hits(number, own, seg, names, terms, lengths) -> pa.RecordBatch:
        rows, found = [], []
        own_number = pc.index_in(terms, value_set=own).fill_null(-1).to_numpy().astype(np.int64)
        for phrases, item in lengths:
            which, start = seg.find(own_number[phrases], slop)
            found.append((item[which], start, np.full(len(start), phrases.shape[1])))
        item, start, size = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = np.searchsorted(seg.doc_starts, start + slop, side="right") - 1
        order = np.lexsort((start, item, doc))
        item, start, size, doc = item[order], start[order], size[order], doc[order]
        for rows_of in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else []:
            d = int(doc[rows_of[0]])
            rows.append((
                number.as_py(), d, [names[j] for j in item[rows_of]],
                (start[rows_of] - seg.doc_starts[d]).tolist(), size[rows_of].tolist(),
            ))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["segment", "place", "items", "starts", "sizes"],
        )

    return run


def search(
    index: DataFrame, items: DataFrame, item_col: str, text_col: str, width: int = WINDOW, slop: int = 0
) -> DataFrame:
    """All occurrences of all windows of the items: one row per document with any, and per block.

    Columns: ``segment`` and ``place`` (the document's number in it), and in lists of equal length
    ``items``, ``starts`` (word number in the document) and ``sizes`` (words in the window).
    With ``slop`` 0 matches are exact phrases, otherwise proximity matches.
    """
    if not 0 <= 2 * slop < GAP:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    lists = index.select("segment", "sizes", "terms", "lengths", "positions")
    shape = "segment bigint, place bigint, items array<string>, starts array<bigint>, sizes array<bigint>"
    rows = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), utf8(text_col).alias("text")
    )
    return lists.mapInArrow(_search(_written_blocks(rows), width, slop), shape)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    slop: int = 0,
) -> DataFrame:
    """Per document: identifier, ``mark``, ``n_words``, ``n_hit``, ``items`` (sorted, distinct)."""
    index = build_index(docs, id_col, text_col)
    hits = search(index, items, item_col, item_text_col, width, slop)
    spans = F.flatten(
        F.transform(
            F.arrays_zip("starts", "sizes"),
            lambda s: F.sequence(s["starts"], s["starts"] + s["sizes"] - 1),
        )
    )
    # A document has one row per block of items; the blocks' words and items are joined here.
    hits = (
        hits.select("segment", "place", F.array_distinct(spans).alias("words"), F.array_distinct("items").alias("items"))
        .groupBy("segment", "place")
        .agg(F.flatten(F.collect_list("words")).alias("words"), F.flatten(F.collect_list("items")).alias("items"))
        .select(
            "segment",
            "place",
            F.size(F.array_distinct("words")).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct("items")).alias("items"),
        )
    )
    listed = index.select("segment", "ids", "marks", "sizes").mapInArrow(
        _directory(index), f"segment bigint, place bigint, id {_id_kind(index)}, mark bigint, n_words bigint"
    )
    return listed.join(hits, ["segment", "place"], "left").select(
        F.col("id").alias(id_col),
        "mark",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _id_kind(index: DataFrame) -> str:
    return index.schema["ids"].dataType.elementType.simpleString()


def _directory(index: DataFrame):
    kind = to_arrow_type(index.schema["ids"].dataType.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, marks, sizes in zip(*batch.columns, strict=True):
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number.as_py())),
                        pa.array(np.arange(n)),
                        ids.values.cast(kind),
                        marks.values,
                        pa.array(unpack(sizes.as_py()).astype(np.int64)),
                    ],
                    ["segment", "place", "id", "mark", "n_words"],
                )

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    bad = contamination(docs, items, id_col, text_col, **options).where("n_hit > 0")
    bad = bad.select(F.col(id_col).alias("__id"), F.col("mark").alias("__mark"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__mark"))
    return docs.join(bad, same, "left_anti")


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Hits of ten-word windows of the benchmark in every document."""
    prepare(spark)
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
