"""Join of texts whose sets of word shingles have a Jaccard similarity of ``LEAST`` or more.

Candidates come from PartEnum signatures. Sizes are dealt into bands so that similar sets lie in one
band or in neighbouring ones; within the sets of a band and the one below, similar sets differ in at most k elements.
The domain of elements is dealt into n1 parts of n2 cells; since k elements cannot spoil more than k2 cells in every part,
two similar sets agree on some n2 - k2 cells of some part. A signature is a part, a choice of that
many of its cells, and what a set has in them. Empty choices are left out where a set has
enough parts in which more than k2 cells hold something: then a shared choice that is not empty exists.

Signatures travel packed: each chunk of texts sends the distinct ones to ranges of their values,
and a range tells which occur in several chunks. Sets that share one form a bucket. A pair of sets is looked
at in three steps: a parity sketch, whose distance is a lower bound of the number of elements in
which they differ; the exact comparison of the shingles, from the texts; and links by components. First
each bucket's members meet its first member and the one before them. Only buckets that are not connected
by then are compared in full, tile by tile on sketches, and only pairs of different components go on: first each
member's nearest, then all that are left. So a group of near copies costs a few
rows per member, and no link between components is lost.

Copies of a set are one node throughout. Texts without words have empty sets and are linked with nothing,
not even with each other. NULL counts as an empty text; rows with NULL identifiers keep their rows, and a
component's identifier is the smallest that is known. An empty table gives an empty result. Memory is bounded by
the chunk size and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rostra.llm.common import chunks, codes, owners, prepare, sums_by_text, table, utf8
from rostra.llm.packing import pack_sorted, unpack_sorted
from rostra.llm.simhash import components
from rostra.operators.joins import is_small
from rostra.session import staged

WIDTH = 5
LEAST = (4, 5)
# Signatures of a range, and bits by which they are told apart within one; a false match costs a sketch comparison.
RANGE_SIGNATURES, RANGE_BITS = 1 << 21, 40
# Signatures for a byte of text: about one a word.
SIGNATURES_PER_BYTE = 0.15
SKETCH_BITS = 1 << 16
# Bytes of text that a task works on at once; their arrays take some fifty times as much.
TEXT_BYTES = 1 << 20
TILE = 512
# Wanted texts whose keys are sent to all executors at the most (some 60 bytes each).
BROADCAST_KEYS = 200_000

_U = np.uint64


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A random-looking permutation of 64-bit integers."""
    x = x + _U((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Bands:
    """Bands of set sizes, and how the domain is dealt for the sets of a band and the one below."""

    def __init__(self, most: int, least: tuple[int, int] = LEAST):
        num, den = least
        tops, low = [0], 1
        while tops[-1] < most or len(tops) < 3:
            tops.append(low * den // num)
            low = tops[-1] + 1
        tops.append(low * den // num)
        self.tops = np.array(tops)
        self.differ = 2 * self.tops * (den - num) // (den + num)
        wide = self.differ >= 5
        self.spoiled = np.where(wide, 1, 0)  # k2
        self.cells = np.where(wide, 3, 1)  # n2
        bad = self.differ // (self.spoiled + 1)  # parts with more than k2 differences, at the most
        spare = np.where(self.differ == 0, 0, np.where(wide, 3 + self.differ // 32, 2))
        self.bad, self.parts = bad, bad + 1 + spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, sizes)


class Sets:
    """The shingle sets of some texts: ``hashes`` by text and value, those of text i from ``starts[i]``."""

    def __init__(self, texts: list[bytes], width: int = WIDTH):
        word, first, distinct = codes([t.lower() for t in texts])
        own = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
        token = own[word] if len(own) else np.zeros(0, np.uint64)
        n_words = np.diff(first)
        factor = _mix(np.arange(1, width + 1, dtype=np.uint64), 1) | _U(1)
        long = np.maximum(n_words - width + 1, 0)
        text = np.repeat(np.arange(len(texts)), long)
        place = np.arange(len(text)) + np.repeat(first[:-1] - (np.cumsum(long) - long), long)
        found = np.zeros(len(text), np.uint64)
        for j in range(width):
            found += factor[j] * token[place + j]
        short = np.flatnonzero((n_words > 0) & (n_words < width))
        whole = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            there = n_words[short] > j
            whole[there] += factor[j] * token[first[short[there]] + j]
        whole = _mix(whole, 2) + _mix(n_words[short].astype(np.uint64), 3)
        text, found = np.concatenate((text, short)), _mix(np.concatenate((found, whole)), 4)
        order = np.lexsort((found, text))
        text, found = text[order], found[order]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
        self.text, self.hashes = text[fresh], found[fresh]
        self.sizes = np.bincount(self.text, minlength=len(texts))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each set."""
        return sums_by_text(_mix(self.hashes, 5), self.starts), sums_by_text(_mix(self.hashes, 6), self.starts)

    def sketches(self, most_bits: int = SKETCH_BITS) -> list[bytes]:
        """For each set the parity of its elements in twice as many places as it has elements, or up to four times."""
        wide = np.maximum(6, np.ceil(np.log2(np.maximum(self.sizes, 1))) + 1).astype(np.int64)
        bits = np.minimum(1 << wide, most_bits)
        edges = np.concatenate(([0], np.cumsum(bits)))
        place = edges[:-1][self.text] + (_mix(self.hashes, 7) & (bits - 1).astype(np.uint64)[self.text]).astype(np.int64)
        packed = np.packbits((np.bincount(place, minlength=edges[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
        return [packed[s // 8 : e // 8] for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def signatures(self, wanted: np.ndarray, least: tuple[int, int] = LEAST) -> tuple[np.ndarray, np.ndarray]:
        """(signature, text) of the sets of the wanted texts, for their own band and the one above."""
        bands = Bands(int(self.sizes.max(initial=1)), least)
        own = np.flatnonzero(wanted & (self.sizes > 0))
        where, what = _mix(self.hashes, 8), _mix(self.hashes, 9)
        sigs, texts = [], []
        for up in (0, 1):
            band = bands.of(self.sizes[own]) + up
            for n2 in np.unique(bands.cells[band]).tolist():
                chosen = own[bands.cells[band] == n2]
                inst = bands.of(self.sizes[chosen]) + up
                found = self._enumerate(chosen, inst, bands, n2, where, what)
                sigs.append(found[0])
                texts.append(found[1])
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate([empty[0], *sigs]), np.concatenate([empty[1], *texts])

    def _enumerate(self, chosen, inst, bands, n2, where, what):
        k2 = int(bands.spoiled[inst[0]])
        parts = bands.parts[inst]
        rows = np.cumsum(parts) - parts  # first part of each text
        of_text = np.full(len(self.sizes), -1)
        of_text[chosen] = np.arange(len(chosen))
        owner = of_text[self.text]
        held = owner >= 0
        owner, x = owner[held], where[held]
        part = ((x >> _U(32)) * parts[owner].astype(np.uint64)) >> _U(32)
        cell = ((x & _U(0xFFFFFFFF)) * _U(n2)) >> _U(32)
        place = (rows[owner] + part.astype(np.int64)) * n2 + cell.astype(np.int64)
        total = int(parts.sum())
        sums = np.zeros(total * n2, np.uint64)
        np.add.at(sums, place, what[held])
        sums = sums.reshape(total, n2)
        full = (np.bincount(place, minlength=total * n2) > 0).reshape(total, n2)
        by_part = np.repeat(np.arange(len(chosen)), parts)
        good = np.bincount(by_part, full.sum(axis=1) > k2, len(chosen))
        lacking = (good <= bands.bad[inst])[by_part]
        number = np.arange(total) - rows[by_part]
        salt = _mix(inst[by_part].astype(np.uint64) << _U(40) | number.astype(np.uint64), 10)
        sigs, texts = [], []
        for n, choice in enumerate(combinations(range(n2), n2 - k2)):
            some = full[:, choice].any(axis=1) | lacking
            value = sums[:, choice].sum(axis=1, dtype=np.uint64)
            sigs.append(_mix(value + salt, 11 + n)[some])
            texts.append(chosen[by_part[some]])
        return np.concatenate(sigs), np.concatenate(texts)


# ------------------------------------------------------------------ packed exchange of signatures

_DOC, _NODE, _SENT, _LOCAL, _MEMBER = range(5)


def _names(kind: str) -> str:
    return (
        f"grp long, kind int, ref long, id {kind}, n long, d1 long, d2 long, th1 long, th2 long, least {kind}, "
        "sketch binary, coarse binary, sigs binary, places binary"
    )


def _signed_rows(source: DataFrame, bits: int, width: int, least: tuple[int, int]) -> DataFrame:
    """Rows of documents, of the distinct sets of a chunk, and of its signatures by range."""
    kind = source.schema["id"].dataType.simpleString()
    schema = source.sparkSession.createDataFrame([], _names(kind)).schema
    id_type = pa.array([], type=_arrow(kind)).type
    keep = min(64, bits + RANGE_BITS)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        columns = []
        for f, t in zip(schema.names, types, strict=True):
            columns.append(pa.array([r.get(f) for r in rows], t))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    long, blob = pa.int64(), pa.binary()
    types = [long, pa.int32(), long, id_type, long, long, long, long, long, id_type, blob, blob, blob, blob]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 24
        for chunk in chunks(batches, "text", TEXT_BYTES):
            for at in range(0, len(chunk["text"]), 1 << 16):
                part = {k: v[at : at + (1 << 16)] for k, v in chunk.items()}
                yield batch(_rows_of(part, serial, bits, keep, width, least))
                serial += 1

    return source.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def _rows_of(chunk: dict, serial: int, bits: int, keep: int, width: int, least: tuple[int, int]) -> list[dict]:
    sets, base, ids = Sets(chunk["text"], width), serial << 16, chunk["id"]
    d1, d2 = (d.view(np.int64).tolist() for d in sets.digests())
    sizes, first, lowest = sets.sizes.tolist(), {}, {}
    own = []
    for i, key in enumerate(zip(sizes, d1, d2, strict=True)):
        own.append(first.setdefault(key, i))
        if ids[i] is not None:
            lowest[own[-1]] = min(lowest.get(own[-1], ids[i]), ids[i])
    deal = serial & ((1 << bits) - 1)
    rows = [
        {"grp": deal, "kind": _DOC, "ref": base + own[i], "id": ids[i], "n": sizes[i]} for i in range(len(ids))
    ]
    sketches = sets.sketches()
    wanted = np.zeros(len(ids), bool)
    for i in first.values():
        if sizes[i]:
            wanted[i] = True
            rows.append({
                "grp": deal, "kind": _NODE, "ref": base + i, "id": ids[i], "n": sizes[i], "d1": d1[i], "d2": d2[i],
                "th1": chunk["th1"][i], "th2": chunk["th2"][i], "least": lowest.get(i), "sketch": sketches[i], "coarse": _halved(sketches[i]),
            })
    sigs, texts = sets.signatures(wanted, least)
    sigs = sigs >> _U(64 - keep)
    order = np.lexsort((texts, sigs))
    sigs, texts = sigs[order], texts[order].astype("<u2")
    fresh = np.ones(len(sigs), bool)
    fresh[1:] = sigs[1:] != sigs[:-1]
    shared = ~fresh
    shared[:-1] |= ~fresh[1:]
    if shared.any():
        rows.append({
            "grp": deal, "kind": _LOCAL, "ref": base, "sigs": sigs[shared].tobytes(), "places": texts[shared].tobytes()
        })
    sigs, texts = sigs[fresh], texts[fresh]
    ranges = (sigs >> _U(keep - bits)).astype(np.int64) if bits else np.zeros(len(sigs), np.int64)
    cuts = np.flatnonzero(np.diff(ranges, prepend=-1)).tolist() + [len(sigs)]
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        rows.append({
            "grp": int(ranges[s]), "kind": _SENT, "ref": base,
            "sigs": pack_sorted(sigs[s:e] & _U((1 << (keep - bits)) - 1)), "places": texts[s:e].tobytes(),
        })
    return rows


def _gathered(bits: int):
    """Rows of documents and sets pass; of the signatures come those that several sets share, with the sets."""
    keep = min(64, bits + RANGE_BITS)

    def members(like: pa.Table, sigs: np.ndarray, refs: np.ndarray) -> pa.Table:
        held = {"kind": pa.array(np.full(len(sigs), _MEMBER, np.int32)), "ref": pa.array(refs), "sig": pa.array(sigs.view(np.int64))}
        return pa.table([
            held[f.name] if f.name in held else pa.nulls(len(sigs), f.type) for f in like.schema
        ], schema=like.schema)

    def run(rows: pa.Table) -> pa.Table:
        kinds = rows["kind"].to_numpy()
        out = rows.filter(pa.array(kinds <= _NODE)).drop_columns(["grp", "sigs", "places"])
        out = out.append_column("sig", pa.nulls(len(out), pa.int64()))
        parts = [out]
        for row in rows.filter(pa.array(kinds == _LOCAL)).select(["ref", "sigs", "places"]).to_pylist():
            places = np.frombuffer(row["places"], "<u2").astype(np.int64)
            parts.append(members(out, np.frombuffer(row["sigs"], np.uint64), row["ref"] + places))
        sent = rows.filter(pa.array(kinds == _SENT)).select(["grp", "ref", "sigs", "places"]).to_pylist()
        if sent:
            sigs = [unpack_sorted(r.pop("sigs")) for r in sent]
            refs = np.concatenate([r["ref"] + np.frombuffer(r.pop("places"), "<u2").astype(np.int64) for r in sent])
            sigs = np.concatenate(sigs) | _U(sent[0]["grp"] << (keep - bits))
            order = np.argsort(sigs, kind="stable")
            sigs, refs = sigs[order], refs[order]
            again = np.zeros(len(sigs), bool)
            again[1:] = sigs[1:] == sigs[:-1]
            shared = again.copy()
            shared[:-1] |= again[1:]
            parts.append(members(out, sigs[shared], refs[shared]))
        return pa.concat_tables(parts)

    return run


# ------------------------------------------------------------------ screening and comparing pairs


def _halved(sketch: bytes) -> bytes:
    """A sketch of half as many places, but of 64 at least."""
    return sketch if len(sketch) <= 8 else _folded([sketch], len(sketch) // 16)[0].tobytes()


def _folded(sketches: list[bytes], words: int) -> np.ndarray:
    """Sketches brought to so many words; the parity of a place is that of the places folded onto it."""
    out = np.zeros((len(sketches), words), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, "<u8").reshape(-1, words), axis=0)
    return out


def _near(sketch_a, n_a, sketch_b, n_b, least) -> tuple[np.ndarray, np.ndarray]:
    """Whether the sizes and sketches of two lists of sets allow them to be similar, pair by pair (broadcast), and
    how far apart their sketches are."""
    num, den = least
    fits = np.minimum(n_a, n_b) * den >= np.maximum(n_a, n_b) * num
    apart = np.bitwise_count(sketch_a ^ sketch_b).sum(axis=-1, dtype=np.int64)
    return fits & (apart * (den + num) <= (n_a + n_b) * (den - num)), apart


def _screened(pairs: DataFrame, nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of nodes that their sketches do not rule out."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            n_a, n_b = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            fine = np.zeros(len(a), bool)
            words = np.fromiter((min(len(x), len(y)) // 8 for x, y in zip(a, b, strict=True)), np.int64, len(a))
            for w in np.unique(words).tolist():
                at = np.flatnonzero(words == w)
                left, right = _folded([a[i] for i in at], w), _folded([b[i] for i in at], w)
                fine[at] = _near(left, n_a[at], right, n_b[at], least)[0]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(fine))

    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a long, b long")


def _alike(left: list[bytes], right: list[bytes], width: int, least: tuple[int, int]) -> np.ndarray:
    """Whether the shingle sets of the texts, pair by pair, are similar enough."""
    num, den = least
    sets, n = Sets(left + right, width), len(left)
    pair = sets.text % n
    order = np.lexsort((sets.hashes, pair))
    pair, hashes = pair[order], sets.hashes[order]
    same = (pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])
    common = np.bincount(pair[1:][same], minlength=n)
    every = sets.sizes[:n] + sets.sizes[n:] - common
    return (common * den >= every * num) & (every > 0)


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, least: tuple[int, int]) -> DataFrame:
    """Of the staged pairs (a, b) of nodes those whose texts are similar enough by exact count."""
    some = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = staged(_texts_of(nodes.join(some, "node", "left_semi"), docs), "jaccard-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "left", TEXT_BYTES // 2):
            fine = pa.array(_alike(chunk["left"], chunk["right"], width, least))
            yield pa.RecordBatch.from_arrays([pa.array(chunk["a"], pa.int64()), pa.array(chunk["b"], pa.int64())], ["a", "b"]).filter(fine)

    side = lambda x, name: texts.select(F.col("node").alias(x), F.col("text").alias(name))
    both = pairs.join(side("b", "right"), "b").join(side("a", "left"), "a")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) for nodes with the identifier and text hashes of one document that has the set."""
    keys = wanted.select("node", F.col("id").alias("__id"), F.col("th1").alias("__th1"), F.col("th2").alias("__th2"))
    keys = staged(keys, "jaccard-wanted")
    if is_small(keys, BROADCAST_KEYS):
        keys = F.broadcast(keys)
    # Not the identifier alone: rows may share one.
    same = (F.col("th1") == F.col("__th1")) & (F.col("th2") == F.col("__th2")) & F.col("id").eqNullSafe(F.col("__id"))
    return docs.join(keys, same).groupBy("node").agg(F.first("text").alias("text"))


def _tile_pairs(members: DataFrame, least: tuple[int, int], tile: int, nearest: int | None) -> DataFrame:
    """Pairs (a, b) of members (sig, node, label, n, sketch) of one bucket with different labels, by sketch.

    ``nearest``: of two tiles only so many pairs of each member, those whose sketches are the nearest. A row with
    ``sig`` alone names a bucket that has pairs; one without any has none that could be similar. Buckets share
    many pairs, so a batch of them sends each on once.
    """
    held = members.groupBy("sig").agg(F.ceil(F.count("*") / tile).cast("int").alias("subs"))
    dealt = members.join(held, "sig").withColumn("sub", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int"))
    packed = F.collect_list(F.struct("node", "label", "n", "sketch")).alias("sets")
    # Most buckets are one tile.
    whole = dealt.where("subs = 1").groupBy("sig").agg(packed).select("sig", F.lit(True).alias("same"), F.col("sets").alias("others"), "sets")
    tiles = staged(dealt.where("subs > 1").groupBy("sig", "subs", "sub").agg(packed), "jaccard-tiles")
    left = tiles.select(
        "sig", F.col("sub").alias("own"), F.explode(F.sequence(F.col("sub"), F.col("subs") - 1)).alias("sub"),
        F.col("sets").alias("others"),
    )
    met = left.join(tiles.select("sig", "sub", "sets"), ["sig", "sub"]).select(
        "sig", (F.col("own") == F.col("sub")).alias("same"), "others", "sets"
    ).union(whole)

    def parts(value: pa.Scalar):
        rows = value.values
        get = lambda f: rows.field(f).to_numpy(zero_copy_only=False)
        return get("node"), get("label"), get("n"), rows.field("sketch").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, having = [np.zeros((2, 0), np.int64)], []
            for sig, same, others, sets in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True
            ):
                a, la, na, sa = parts(others)
                b, lb, nb, sb = parts(sets)
                words = min(map(len, sa + sb)) // 8
                sa, sb = _folded(sa, words), _folded(sb, words)
                found = [np.zeros((2, 0), np.int64)]
                best, whose = np.full(len(b), np.iinfo(np.int64).max), np.zeros(len(b), np.int64)
                for i in range(len(a)):
                    fine, apart = _near(sa[i], na[i], sb, nb, least)
                    fine &= lb != la[i]
                    if same and not nearest:
                        fine[: i + 1] = False
                    chosen = np.flatnonzero(fine)
                    if nearest:
                        closer = chosen[apart[chosen] < best[chosen]]
                        best[closer], whose[closer] = apart[closer], i
                        chosen = chosen[np.argsort(apart[chosen], kind="stable")[:nearest]]
                    found.append(np.stack((np.full(len(chosen), a[i]), b[chosen])))
                if nearest:
                    met_one = np.flatnonzero(best < np.iinfo(np.int64).max)
                    found.append(np.stack((a[whose[met_one]], b[met_one])))
                found = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
                if found.size:
                    pairs.append(found)
                    having.append(sig)
            x, y = np.unique(np.concatenate(pairs, axis=1), axis=1)
            none = pa.nulls(len(having), pa.int64())
            columns = [
                pa.concat_arrays([pa.array(having, pa.int64()), pa.nulls(len(x), pa.int64())]),
                pa.concat_arrays([none, pa.array(x)]), pa.concat_arrays([none, pa.array(y)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["sig", "a", "b"])

    return met.mapInArrow(run, "sig long, a long, b long")


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    least: tuple[int, int] = LEAST,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: id, n (size of its set), component (smallest identifier it is linked with by chains)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("id"), utf8(text_col).alias("text"),
        F.xxhash64(body).alias("th1"), F.xxhash64(F.lit(1), body).alias("th2"),
    )
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    bits = max(0, int(total * SIGNATURES_PER_BYTE) // RANGE_SIGNATURES).bit_length()
    kind = source.schema["id"].dataType.simpleString()
    shape = _names(kind).removeprefix("grp long, ").removesuffix(", sigs binary, places binary") + ", sig long"
    found = staged(_signed_rows(source, bits, width, least).groupBy("grp").applyInArrow(_gathered(bits), shape), "jaccard-rows")

    keys = ["n", "d1", "d2"]
    sets = found.where(F.col("kind") == _NODE)
    first = F.struct("ref", "id", "th1", "th2", "sketch", "coarse")
    nodes = staged(
        sets.groupBy(*keys).agg(F.min_by(first, "ref").alias("f"), F.min("least").alias("least")).select(
            *keys, F.col("f.ref").alias("node"), "f.id", "f.th1", "f.th2", "f.sketch", "f.coarse", "least"
        ),
        "jaccard-nodes",
    )
    of_ref = staged(sets.select("ref", *keys).join(nodes.select(*keys, "node"), keys).select("ref", "node"), "jaccard-refs")

    members = found.where(F.col("kind") == _MEMBER).select("sig", "ref").join(of_ref, "ref").select("sig", "node")
    members = staged(members.repartition("sig").distinct(), "jaccard-members")
    # Buckets of the same members are one.
    bucket = [F.count("*").alias("size"), F.min("node").alias("hub"), F.max("node").alias("last"),
              F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x2")]
    kept = members.groupBy("sig").agg(*bucket).where("size > 1").groupBy("size", "hub", "last", "x1", "x2").agg(F.min("sig").alias("sig"))
    members = staged(members.join(kept.select("sig", "hub", "size"), "sig"), "jaccard-buckets")

    before = F.lag("node").over(Window.partitionBy("sig").orderBy("node"))
    tried = members.select("hub", "node", before.alias("before")).select(
        F.explode(F.array("hub", "before")).alias("a"), F.col("node").alias("b")
    ).where("a < b").distinct()
    tried = staged(_screened(staged(tried, "jaccard-pairs"), nodes, least), "jaccard-near")
    links = staged(_verified(tried, nodes, source, width, least), "jaccard-links")
    label = components(links)

    # Of up to three members all pairs have been tried. The others are tried twice: each member's nearest by short
    # sketches, and then, in the buckets that had any, by long ones all that are left between larger components.
    large = members.where("size > 3").select("sig", "node")
    for nearest, sketch in ((1, "coarse"), (None, "sketch")):
        of_node = nodes.select("node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labelled = staged(large.join(of_node, "node"), "jaccard-labelled")
        apart = labelled.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        open_ = labelled.join(apart.select("sig"), "sig", "left_semi").join(
            nodes.select("node", "n", F.col(sketch).alias("sketch")), "node"
        )
        near = staged(_tile_pairs(open_, least, tile, nearest), "jaccard-near")
        if near.isEmpty():
            break
        large = staged(large.join(near.where("sig is not null").select("sig"), "sig", "left_semi"), "jaccard-large")
        more = near.where("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        more = staged(_screened(staged(more, "jaccard-pairs"), nodes, least), "jaccard-more")
        if more.isEmpty():
            continue
        tried = tried.union(more)
        later = staged(_verified(more, nodes, source, width, least), "jaccard-links")
        if not later.isEmpty():
            links = links.union(later)
            label = components(links)

    named = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    by_ref = of_ref.join(named.select("node", "label"), "node").join(smallest, "label").select("ref", "component")
    own = found.where(F.col("kind") == _DOC).select("id", "n", "ref")
    linked = own.where("n > 0").join(by_ref, "ref").select("id", "n", "component")
    return linked.unionByName(own.where("n = 0").select("id", "n", F.col("id").alias("component")))


def op13_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Size of the set and component of every document."""
    found = similar_documents(table(prepare(spark), sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
