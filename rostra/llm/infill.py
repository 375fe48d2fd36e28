"""Fill-in-middle: texts cut at two places into prefix, middle and suffix and put in another order.

The places count units of text (code points of UTF-8). They are found without decoding: a batch of
texts is one run of 64-bit words, in which the bytes that end a unit are marked by arithmetic on
whole words, counted per word, and summed up. A place is then a search among the sums for its word
and a selection among the eight marks of that word.

Places and order of a document follow from its identifier alone, so they do not depend on
partitions or on other documents. A NULL text counts as an empty one, a NULL identifier as an empty
name. Texts that hold a marker stay plain, since they could not be told apart again. Bytes that are
no UTF-8 are kept: a unit ends before every byte that continues none, and with the text. Repeated
rows keep their own rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostra.llm.common import prepare, table, utf8

SEED, CUT_SHARE, SPM_SHARE = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_BYTE, _TOP = np.uint64(8), np.uint64(56)


class Units:
    """Ends of the units in texts that lie one after another: text i from ``edges[i]`` to ``edges[i + 1]``."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
        padded[: len(data)] = data
        x = padded.view("<u8")
        goes_on = (x >> np.uint64(7)) & ~(x >> np.uint64(6)) & _ONES  # bytes of the form 10xxxxxx
        starts = goes_on ^ _ONES
        after = np.append(starts[1:], _ONES)
        self.marks = (starts >> _BYTE) | (after << _TOP)
        last = edges[1:][np.diff(edges) > 0] - 1
        np.bitwise_or.at(self.marks, last // 8, np.uint64(1) << (8 * (last % 8)).astype(np.uint64))
        self.sums = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        self.edges = edges
        self.before = self._rank(edges)

    def _rank(self, places: np.ndarray) -> np.ndarray:
        """Units that end before each byte."""
        word, rest = places // 8, (8 * (places % 8)).astype(np.uint64)
        below = self.marks[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.sums[word] - np.bitwise_count(self.marks[word]) + np.bitwise_count(below)

    def counts(self) -> np.ndarray:
        return np.diff(self.before)

    def places(self, text: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The byte where so many units of a text have ended."""
        wanted = self.before[text] + units
        word = np.searchsorted(self.sums, wanted)
        word = np.minimum(word, len(self.marks) - 1)
        marks = self.marks[word]
        nth = (wanted - self.sums[word] + np.bitwise_count(marks)).astype(np.uint64)
        # Byte i of the product counts the marks up to i; those that reach the wanted one get their high bit.
        reached = (marks * _ONES + (np.uint64(128) - nth) * _ONES) & _HIGH
        inside = 8 - np.bitwise_count(reached).astype(np.int64)
        return np.where(units == 0, self.edges[:-1][text], 8 * word + inside + 1)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the place where each value starts."""
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        data, edges = _bytes_of(batch.column("text"))
        units, rows = Units(data, edges), np.arange(batch.num_rows)
        n = units.counts()
        forms = batch.column("form").to_pylist()
        first = batch.column("h1").to_numpy() % (n + 1)
        second = batch.column("h2").to_numpy() % (n + 1)
        first, second = np.minimum(first, second), np.maximum(first, second)
        low, high = units.places(rows, first).tolist(), units.places(rows, second).tolist()
        held, bounds, out = data.tobytes(), edges.tolist(), []
        for i, form in enumerate(forms):
            start, a, b, end = bounds[i], low[i], high[i], bounds[i + 1]
            if form == "psm":
                out.append(b"".join((PREFIX, held[start:a], SUFFIX, held[b:end], MIDDLE, held[a:b])))
            elif form == "spm":
                out.append(b"".join((SUFFIX, held[b:end], PREFIX, held[start:a], MIDDLE, held[a:b])))
            else:
                out.append(held[start:end])
        plain = np.array([f == "plain" for f in forms])
        columns = [
            batch.column("id"), pa.array(n), batch.column("form"), pa.array(first, mask=plain),
            pa.array(second - first, mask=plain), pa.array(out, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    cut_share: int = CUT_SHARE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """One row per document: id, n (units), form, prefix_chars, middle_chars, output (UTF-8 bytes).

    ``cut_share`` of a hundred documents are cut, ``spm_share`` of a hundred of those with the suffix first.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.contains(text, F.lit("<P>")) | F.contains(text, F.lit("<S>")) | F.contains(text, F.lit("<M>"))
    form = (
        F.when((F.octet_length(text) == 0) | marked | (h3 % 100 >= cut_share), "plain")
        .when(h4 % 100 < spm_share, "spm")
        .otherwise("psm")
    )
    source = docs.select(
        F.col(id_col).alias("id"), utf8(text_col).alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(
        _cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"
    )


def rebuilt(form: str | None, output: bytes | None) -> bytes | None:
    """The text of an output; None for an output that its form does not describe."""
    if form == "plain" or output is None:
        return output
    head, second = {"psm": (PREFIX, SUFFIX), "spm": (SUFFIX, PREFIX)}.get(form, (b"\0", b"\0"))
    first, found, rest = output.partition(second)
    other, last, middle = rest.partition(MIDDLE)
    if not (found and last and first.startswith(head)):
        return None
    first = first[len(head) :]
    return first + middle + other if form == "psm" else other + middle + first


def restore(outputs: DataFrame, form_col: str = "form", output_col: str = "output", to: str = "restored") -> DataFrame:
    """All columns of ``outputs`` (but an old ``to``), and ``to``: the bytes of the text each was made of."""
    kept = [c for c in outputs.columns if c != to]
    shape = outputs.select(*kept).withColumn(to, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(form_col).to_pylist(), batch.column(output_col).to_pylist(), strict=True)
            texts = pa.array([rebuilt(f, bytes(o) if o is not None else None) for f, o in pairs], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*kept, to])

    return outputs.select(*kept).mapInArrow(run, shape)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Form, places and digests of every document, and the digest of the text rebuilt from its output."""
    made = fill_in_middle(table(prepare(spark), sf_dir, "documents"))
    found = restore(made.withColumn("output_sha256", F.sha2("output", 256)))
    return found.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        F.sha2("restored", 256).alias("restored_sha256"),
    )
