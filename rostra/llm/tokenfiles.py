"""Token ids as flat files with document offsets, in order of the document identifiers.

Documents are dealt out by ranges of identifiers, so partition k holds smaller ones than partition
k + 1. Every task writes three files: ``.bin``, the ids of its documents as little-endian unsigned
integers of 16 or 32 bits (by the size of the vocabulary), an end id after each document; ``.idx``,
64-bit offsets of its documents, counted in ids, one more than documents; ``.doc``, their identifiers
as 64-bit integers. Only files named in the committed manifest belong to the result, so attempts
that were lost leave nothing that is read. A partition's base, the ids in all partitions before it,
is a prefix sum over the manifest. Readers map the files into memory where they are local.

NULL texts are empty. Identifiers must be integers; NULL ones come first and are counted in the
manifest. Rows with equal identifiers keep a place each, ordered by a hash of their text. An empty
table gives no files and an empty result.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rostra.llm import storage
from rostra.llm.common import prepare, table
from rostra.session import shared_dir, staged

END_ID = 0
REMEMBERED = 1 << 19  # words kept in a task; memory only, no effect on results
AT_ONCE = 1 << 18

# How the byte-level vocabulary cuts texts, for texts of the characters in SAFE. There, every
# character's class is beyond doubt; other texts go to the library whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
SAFE = re.compile(f"[\\t\\n\\r -~{_LETTERS}]*")
WORDS = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s0-9{_LETTERS}]+|\\s+(?!\\S)|\\s+"
)


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it prints, else one after 255."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + n) for n, b in enumerate(others)}


class KnownWords(dict):
    """Packed ids of words; a word that is asked for the first time is encoded by the library."""

    def __init__(self, model: tokenizers.models.Model, code: str):
        self.model, self.code, self.signs = model, code, byte_signs()

    def __missing__(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.signs))
        found = self[word] = array(self.code, [t.id for t in tokens]).tobytes()
        return found


class Encoder:
    """Ids of texts as packed integers; words that were met before are remembered.

    Texts are cut into words here only for byte-level BPE without further steps; for any other
    tokenizer the library gets them whole, and so it gets texts that hold an added token's content.
    """

    def __init__(self, tokenizer_json: str):
        # Spark runs a task on one core; the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.own = tokenizers.Tokenizer.from_str(tokenizer_json)
        self.code = "H" if self.own.get_vocab_size() <= 1 << 16 else "I"
        self.known = KnownWords(self.own.model, self.code)
        parts = json.loads(tokenizer_json)
        added = [t["content"] for t in parts.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        cut = parts.get("pre_tokenizer") or {}
        self.by_words = (
            parts["model"]["type"] == "BPE"
            and parts.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
        )

    @property
    def dtype(self) -> str:
        return "<u2" if self.code == "H" else "<u4"

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        if not self.by_words or not SAFE.fullmatch(text) or self.added.search(text):
            return self._library([text])[0]
        if len(text) <= AT_ONCE:
            return self._words(WORDS.findall(text))
        found, parts = (m.group() for m in WORDS.finditer(text)), []
        while words := list(itertools.islice(found, AT_ONCE)):
            parts.append(self._words(words))
        return b"".join(parts)


def write_files(
    docs: DataFrame, tokenizer_path: str, out_dir: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write the files and return the manifest: part, stem, dtype, n_docs, n_unknown, n_tokens, base."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"identifiers must be integers, not {kind.simpleString()}")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), "mark"]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    shape = "part long, stem string, dtype string, n_docs long, n_unknown long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        encoder = Encoder(tokenizer_json)
        part = TaskContext.get().partitionId()
        system, folder = storage.at(out_dir)
        system.create_dir(folder, recursive=True)
        stem = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        end = array(encoder.code, [end_id]).tobytes()
        sizes, ids = [np.zeros(1, np.uint64)], []
        with system.open_output_stream(f"{stem}.bin") as out:
            for batch in itertools.chain([first], batches):
                blobs = [encoder.encode(t) + end for t in batch.column(1).to_pylist()]
                out.write(b"".join(blobs))
                sizes.append(np.fromiter(map(len, blobs), np.uint64, len(blobs)) // len(end))
                ids.append(batch.column(0).fill_null(0).to_numpy())
                unknown = batch.column(0).null_count + (unknown if len(ids) > 1 else 0)
        offsets = np.cumsum(np.concatenate(sizes), dtype=np.uint64)
        with system.open_output_stream(f"{stem}.idx") as out:
            out.write(offsets.astype("<u8").tobytes())
        with system.open_output_stream(f"{stem}.doc") as out:
            out.write(np.concatenate(ids).astype("<i8").tobytes())
        row = [part, stem, encoder.dtype, len(offsets) - 1, unknown, int(offsets[-1])]
        names = ["part", "stem", "dtype", "n_docs", "n_unknown", "n_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)

    files = staged(ranged.select("id", "text").mapInArrow(run, shape), "token-manifest")
    # One row per file, so this window is short.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(system, path: str) -> pa.Buffer:
    if storage.is_local(system):
        return pa.memory_map(path).read_buffer()
    with system.open_input_file(path) as f:
        return f.read_buffer()


def read_files(manifest: DataFrame, out_dir: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and the ids if asked for."""
    shape = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = storage.at(out_dir)
        for batch in batches:
            for file in batch.to_pylist():
                offsets = np.frombuffer(_mapped(system, f"{file['stem']}.idx"), "<u8").astype(np.int64)
                owners = np.frombuffer(_mapped(system, f"{file['stem']}.doc"), "<i8")
                ids = np.frombuffer(_mapped(system, f"{file['stem']}.bin"), file["dtype"])
                for at in range(0, len(owners), 1000):
                    cut = offsets[at : at + 1001]
                    sums = [
                        zlib.crc32(ids[s:e].astype("<u4").tobytes())
                        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
                    ]
                    unknown = np.arange(at, at + len(sums)) < file["n_unknown"]
                    columns = [
                        pa.array(owners[at : at + 1000], mask=unknown),
                        pa.array(file["base"] + cut[:-1]),
                        pa.array(np.diff(cut)),
                        pa.array(sums, pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        values = pa.array(ids[cut[0] : cut[-1]].astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), values))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    return manifest.repartition("part").mapInArrow(run, shape)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_token_files(spark, sf_dir: str) -> DataFrame:
    """Place, number and checksum of the ids of every document, read back from the files."""
    out_dir = shared_dir(prepare(spark), "token-files")
    manifest = write_files(table(spark, sf_dir, "documents"), tokenizer_path(), out_dir)
    return read_files(manifest, out_dir)
