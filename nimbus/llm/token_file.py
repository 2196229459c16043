"""Operator 8: token ids as fixed-length sequences in Arrow stream files.

Documents are dealt out by ranges of ``doc_id`` and sorted, so that the files,
taken in order, hold all ids in ascending document order. Each file is an
Arrow IPC *file*: record batches of ``input_ids`` (fixed-size list of unsigned
integers, 16 bits wide if the vocabulary allows), ``attention_mask``
(fixed-size list of bits; 0 marks the padding at a file's end) and nothing of
variable length, so any sequence is found by its number and mapped without a
copy. The documents' places are in a
manifest table beside the files; ids run on from document to document, and
sequences are cut wherever they are full.

Recovery: a task writes its file under a name of its own attempt, and the
manifest (rows of successful tasks, written as a table) names the files that
count. A lost executor costs the running tasks; files of failed attempts are
never read.

Defined results: a null or empty text is the end id alone; a null ``doc_id``
comes first; repeated ids follow each other, ordered by their text; columns
beside ``doc_id`` and ``text`` are ignored; an empty table gives no file.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from nimbus.llm.bpe import Memo, lowered
from nimbus.llm.common import prepare, shuffle_parts, staged
from nimbus.session import work_dir

SEQUENCE = 1024   # ids of a sequence
BATCH = 64        # sequences of a record batch
END_ID = 1        # ends every document
# Pieces of a chunk of printable ASCII in lower case, as the pre-tokenizer cuts it.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
_PLAIN = re.compile(r"[!-~]+").fullmatch
MANIFEST = "part int, file string, offset long, n_tokens long, doc_id long"


def file_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(id_type, SEQUENCE)), ("attention_mask", pa.list_(pa.bool_(), SEQUENCE))])


class ChunkEncoder:
    """Ids of a text by the tokenizers library, with memos before it: no
    token spans white space, and within printable ASCII none spans two pieces
    of the pre-tokenizer, which the normalizer and the byte alphabet leave as
    they are. Other chunks are normalised and cut by the library. The library's
    model sees each new piece once. A worker's memos last from task to task,
    within ``MEMO_ENTRIES``."""

    def __init__(self, path: str):
        # Spark runs a task on every core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = np.uint16 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.code = "H" if self.width is np.uint16 else "I"
        self.model = self.library.model
        self.normalize, self.cut = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        self.chunks, self.pieces = Memo(self._chunk), Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _chunk(self, raw: bytes) -> bytes:
        chunk = raw.decode("utf-8")
        if "<|" in chunk:  # maybe a special token
            return array(self.code, self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
        if _PLAIN(chunk):
            return b"".join(map(self.pieces.__getitem__, _PIECES(chunk.lower())))
        return b"".join([self.pieces[p] for p, _ in self.cut(self.normalize(chunk))])

    def encode_bytes(self, raw: bytes) -> bytes:
        return b"".join(map(self.chunks.__getitem__, lowered(raw).split()))


_loaded: dict[str, ChunkEncoder] = {}


def load(path: str) -> ChunkEncoder:
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class SequenceWriter:
    """Cuts a run of ids into sequences and writes them batch by batch."""

    def __init__(self, folder: str, name: str, width: type):
        self.width, self.unit = width, np.dtype(width).itemsize * SEQUENCE * BATCH
        self.files, base = open_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(f"{base}/{name}")
        self.writer = pa.ipc.new_file(self.out, file_schema(pa.from_numpy_dtype(width)))
        self.waiting: list[bytes] = []
        self.n = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.n += len(ids)
        if self.n >= self.unit:
            whole = b"".join(self.waiting)
            full = len(whole) // self.unit * self.unit
            ids = np.frombuffer(whole[:full], self.width)
            self._write(ids, len(ids))
            self.waiting, self.n = [whole[full:]], len(whole) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        for at in range(0, len(ids), SEQUENCE * BATCH):
            part = slice(at, at + SEQUENCE * BATCH)
            self.writer.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(ids[part]), SEQUENCE),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask[part]), SEQUENCE)], ["input_ids", "attention_mask"]))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.waiting), self.width)
        if len(rest):
            padded = np.zeros(-(-len(rest) // SEQUENCE) * SEQUENCE, self.width)
            padded[:len(rest)] = rest
            self._write(padded, len(rest))
        self.writer.close()
        self.out.close()


class SequenceReader:
    """Random access to a file of sequences; memory-mapped where the file
    system is local, so reading copies nothing."""

    def __init__(self, folder: str, name: str):
        files, base = open_uri(folder)
        path = f"{base}/{name}"
        self.source = pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.last: tuple[int, pa.RecordBatch] | None = None

    def batch(self, i: int) -> pa.RecordBatch:
        """Documents follow each other: the batch read last is kept."""
        if self.last is None or self.last[0] != i:
            self.last = (i, self.file.get_batch(i))
        return self.last[1]

    def ids(self, offset: int, n: int) -> Iterator[np.ndarray]:
        """The ids at ``offset``, in pieces that lie within one batch."""
        unit = SEQUENCE * BATCH
        while n > 0:
            i, at = divmod(offset, unit)
            values = self.batch(i).column(0).flatten().to_numpy(zero_copy_only=True)[at:at + n]
            yield values
            offset, n = offset + len(values), n - len(values)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID,
                      partitions: int | None = None) -> DataFrame:
    """Write the files into ``folder`` (shared by all executors) and return
    the manifest: a row for each document (its file, the file's number, the
    offset within the file, its number of ids)."""
    spark = docs.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, at = load(tokenizer_path), None, 0
        end, size = array(encoder.code, [end_id]).tobytes(), np.dtype(encoder.width).itemsize
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                part = b.column(0)[0].as_py()
                name = f"tokens-{part:06d}-{uuid.uuid4().hex[:8]}.arrow"
                out = SequenceWriter(folder, name, encoder.width)
            offsets, lengths = [], []
            for raw in b.column(2).to_pylist():
                ids = encoder.encode_bytes(raw or b"") + end
                out.add(ids)
                offsets.append(at)
                lengths.append(len(ids) // size)
                at += lengths[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([name] * b.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), b.column(1)], ["part", "file", "offset", "n_tokens", "doc_id"])
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    dealt = (rows.repartitionByRange(partitions or shuffle_parts(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
             .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    return staged(dealt.mapInArrow(run, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files;
    ``start``: ids of all documents before it."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    # One row a file: the running total over files is small at any size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for b in batches:
            crcs, counts = [], []
            for file, offset, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if file != name:
                    name, reader = file, SequenceReader(folder, file)
                crc = count = 0
                for ids in reader.ids(offset, n):
                    crc, count = zlib.crc32(ids.astype("<u4"), crc), count + len(ids)
                crcs.append(crc)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([b.column(4), b.column(1), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = manifest.join(base, "part").select("file", (F.col("base") + F.col("offset")).alias("start"), "offset", "n_tokens", "doc_id")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the files to a fresh shared folder and read them back."""
    folder = work_dir(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer_path, folder), folder)
