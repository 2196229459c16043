"""Operator 13: alignment of two tokenizers over the same bytes.

Both tokenizers cut the bytes of " " + text; token j of A ends at byte ea[j],
token k of B at eb[k]. Offsets where tokens of both end cut the text into
groups, the smallest stretches that both write in whole tokens. The two
ascending end lists are intersected by galloping: the shorter list drives,
and each of its ends is looked for in the longer one by steps that double
and a binary search within the last step, from where the last one was found.
The common indices slice the groups; differences of their ranks give each
group's range of A tokens and of B tokens.

A *link* is a pair of an A token and a B token that end together. Counts of
links by id pair cover the corpus. To get them back to the documents without
moving a row for each link, documents are taken in blocks of bounded size: a
block counts its pairs once, keeps them as a sorted list, and its documents
refer to places of that list. Only the blocks' lists (a few per cent of the
links) are joined with the corpus counts, and each block then meets its own.

A is a byte-level BPE file of the tokenizers library; B a sentencepiece model
with byte fallback, which adds the leading space itself. A's merges are those of its
file in the order of their ids, as ranks: texts of ASCII and Latin letters go
through tiktoken with these ranks (the same ids, four times as fast), all
others, whose Unicode classes differ between versions, through the tokenizers
library. Special tokens' strings are plain text.

Defined results: a null or empty text, and one whose tokens of either side do
not join to the bytes of " " + text (sentencepiece normalises some), has no tokens: zeros
and an empty digest. Null ``doc_id`` is kept, repeated rows are documents of
their own, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from nimbus.llm.bpe import byte_alphabet
from nimbus.llm.common import prepare, staged

# A block ends after so many links or documents (a longer document is a block).
BLOCK_LINKS = 1_000_000
BLOCK_DOCS = 8_192
# Texts handed to a tokenizer at once.
PORTION = 64
_PLAIN = regex.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-ſ]*+")


def intersect(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places in ``a`` and in ``b`` (ascending) of their common values."""
    if len(a) > len(b):
        in_b, in_a = intersect(b, a)
        return in_a, in_b
    in_a, in_b, at, n = [], [], 0, len(b)
    b = [*b, a[-1] + 1 if a else 0]  # an end that stops every search
    for i, x in enumerate(a):
        if (y := b[at]) < x:
            at += 1
            if (y := b[at]) < x:  # gallop: b[at] < x all along
                step = 1
                while at + step < n and b[at + step] < x:
                    at += step
                    step += step
                at = bisect_left(b, x, at + 1, min(at + step, n))
                y = b[at]
        if y == x:
            in_a.append(i)
            in_b.append(at)
            at += 1
        elif at >= n:
            break
    return in_a, in_b


# ---------------------------------------------------------------- tokenizers

class ByteLevel:
    """A: byte-level BPE from a file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] is not None or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        special = {t["content"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        self.bytes = [b""] * (max(*vocab.values(), *(t["id"] for t in spec["added_tokens"])) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for t in spec["added_tokens"]:
            self.bytes[t["id"]] = t["content"].encode()
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocab[a + b] for a, b in merges]
        # Ranks may stand for merges only where ids follow the merges' order.
        self.ranked = None
        if ids == sorted(set(ids)) and len(ids) + 256 == len(vocab):
            cut = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the pattern of byte-level pre-tokenizers
            self.ranked = tiktoken.Encoding("ranked", pat_str=cut, mergeable_ranks={self.bytes[i]: i for i in vocab.values()}, special_tokens={})
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list:
        """Ids of each text, as a list or an array."""
        plain = [self.ranked is not None and _PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self.library.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.ranked.encode_to_numpy(t, disallowed_special=()) if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]


class Pieces:
    """B: a sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = regex.compile("<0x([0-9A-F]{2})>")
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(byte.fullmatch(piece)[1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_loaded: dict[tuple[type, str], object] = {}


def load(kind: type, path: str):
    """One tokenizer for each worker process and path."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


# ---------------------------------------------------------------- one text

_NONE = np.empty(0, np.int64)


def align(a: ByteLevel, b: Pieces, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its ids of A and of B, and the places of the tokens that
    end together in both; all empty where a side does not give the text back."""
    spaced = [" " + t for t in texts]
    for text, ia, ib in zip(spaced, a.encode(spaced), b.encode(texts), strict=True):
        raw = text.encode()
        if len(raw) == 1 or b"".join(map(b.bytes.__getitem__, ib)) != raw:
            yield _NONE, _NONE, _NONE, _NONE
            continue
        ia, ib = np.asarray(ia, np.int64), np.array(ib, np.int64)
        # A's tokens are bytes of the text by construction: only their number can differ.
        ends = np.cumsum(a.lengths[ia])
        if ends[-1] != len(raw):
            yield _NONE, _NONE, _NONE, _NONE
            continue
        in_a, in_b = intersect(ends.tolist(), np.cumsum(b.lengths[ib]).tolist())
        yield ia, ib, np.array(in_a, np.int64), np.array(in_b, np.int64)


def ranges(common: np.ndarray) -> list[tuple[int, int]]:
    """The tokens of each group, first to one past the last."""
    return list(zip([0, *(common[:-1] + 1).tolist()], (common + 1).tolist(), strict=True)) if len(common) else []


class GroupText:
    """The groups of a text as ``a1,a2|b1;a3|b2,b3``: each token is its number
    and what follows it, from a table of fixed width; the places follow from
    the ranks."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.words = np.array([f"{i}{after}".encode() for n, end in ((n_a, "|"), (n_b, ";")) for after in (",", end) for i in range(n)])

    def __call__(self, ia: np.ndarray, ib: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> bytes:
        out = np.empty(len(ia) + len(ib), np.int64)
        wide_a, wide_b = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
        # Before an A token stand the B tokens of the groups before, before a B token the A tokens up to its group's.
        at_a = np.arange(len(ia)) + np.repeat(in_b - wide_b + 1, wide_a)
        at_b = np.arange(len(ib)) + np.repeat(in_a + 1, wide_b)
        code = ia.copy()
        code[in_a] += self.n_a
        out[at_a] = code
        code = ib + 2 * self.n_a
        code[in_b] += self.n_b
        out[at_b] = code
        return self.words[out].tobytes().replace(b"\0", b"")[:-1]


# ---------------------------------------------------------------- documents

def groups_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, group, a_ids, b_ids, a_from, b_from``: every group of every
    document, the general output."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = load(ByteLevel, path_a), load(Pieces, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, PORTION):
                part = batch.slice(at, PORTION)
                for i, (ia, ib, in_a, in_b) in zip(part.column(0).to_pylist(), align(a, b, [t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ra, rb = ranges(in_a), ranges(in_b)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(ra), pa.int64()), pa.array(range(len(ra)), pa.int64()),
                         pa.array([ia[p:q] for p, q in ra], pa.list_(pa.int32())), pa.array([ib[p:q] for p, q in rb], pa.list_(pa.int32())),
                         pa.array([p for p, _ in ra], pa.int64()), pa.array([p for p, _ in rb], pa.int64())],
                        ["doc_id", "group", "a_ids", "b_ids", "a_from", "b_from"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, group long, a_ids array<int>, b_ids array<int>, a_from long, b_from long")


_ROWS = "block string, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, places binary, pairs binary, counts binary"


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each document (``places``: its links as places in the block's
    list of pairs) and one for each block (``pairs, counts``: that list, a
    pair being ``a << 32 | b``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = load(ByteLevel, path_a), load(Pieces, path_b)
        task, number = TaskContext.get().partitionId(), 0
        text = GroupText(len(a.bytes), len(b.bytes))
        rows, links, held = [], [], 0

        def block() -> pa.RecordBatch:
            pairs, place, count = np.unique(np.concatenate([*links, np.empty(0, np.int64)]), return_inverse=True, return_counts=True)
            place = np.split(place.astype(np.uint32), np.cumsum([len(x) for x in links])[:-1])
            out = [(f"{task}-{number}", *r, p.tobytes(), None, None) for r, p in zip(rows, place, strict=True)]
            out.append((f"{task}-{number}", None, None, None, None, None, None, pairs.tobytes(), count.astype(np.int64).tobytes()))
            types = [pa.string(), *[pa.int64()] * 4, pa.string(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], [x.split()[0] for x in _ROWS.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, PORTION):
                part = batch.slice(at, PORTION)
                for i, (ia, ib, in_a, in_b) in zip(part.column(0).to_pylist(), align(a, b, [t or "" for t in part.column(1).to_pylist()]), strict=True):
                    digest = hashlib.sha256(text(ia, ib, in_a, in_b)).hexdigest() if len(ia) else ""
                    rows.append((i, len(ia), len(ib), len(in_a), digest))
                    links.append(ia[in_a] << 32 | ib[in_b])
                    held += len(in_a)
                    if held >= BLOCK_LINKS or len(rows) >= BLOCK_DOCS:
                        yield block()
                        rows, links, held, number = [], [], 0, number + 1
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS)


def _pair_rows(blocks: DataFrame) -> DataFrame:
    """``block, place, pair, n``: the blocks' lists of pairs as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs = np.frombuffer(pairs, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(pairs), pa.string()), pa.array(np.arange(len(pairs)), pa.int64()), pa.array(pairs), pa.array(np.frombuffer(counts, np.int64))], ["block", "place", "pair", "n"])

    return blocks.where(F.col("pairs").isNotNull()).select("block", "pairs", "counts").mapInArrow(run, "block string, place long, pair long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, total, best``: how many links hold each id pair, and whether no
    other pair of its B id is held by more."""
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # A B id has at most as many pairs as A has ids.
    top = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return totals.select("pair", "total", (F.col("total") == top).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every document."""
    prepare(docs.sparkSession)
    blocks = staged(_blocks(docs, path_a, path_b), "align-blocks")
    pairs = staged(_pair_rows(blocks), "align-pairs")
    counts = staged(pair_counts(pairs), "align-counts")
    known = pairs.join(counts, "pair").select("block", "place", "total", "best")

    def run(key, rows: pa.Table, of: pa.Table) -> pa.Table:
        total, best = np.zeros(of.num_rows, np.int64), np.zeros(of.num_rows, bool)
        place = of["place"].to_numpy()
        total[place], best[place] = of["total"].to_numpy(), of["best"].to_numpy()
        links = [np.frombuffer(x, np.uint32) for x in rows["places"].to_pylist()]
        return pa.table([rows["doc_id"], rows["n_a"], rows["n_b"], rows["n_groups"], pa.array([len(x) for x in links], pa.int64()),
                         pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(total[x].sum()) for x in links], pa.int64()), rows["groups_sha256"]],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    of_docs = blocks.where(F.col("places").isNotNull()).drop("pairs", "counts")
    return of_docs.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
