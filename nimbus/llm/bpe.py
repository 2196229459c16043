"""Operator 1: BPE encoding and decoding.

Encoding merges the adjacent pair of lowest rank until none is left. The
symbols of a piece form a doubly linked list; candidate merges wait in a
priority queue of (rank, position). A merge makes its neighbours' queued
pairs wrong: such stale entries are recognised when they are popped (the
symbols at that place are no longer the pair that was queued) and skipped.
So a piece of n symbols costs O(n log n), however long it is.

Decoding joins the vocabulary strings of the ids, as a tokenizer file
without a decoder prescribes: with one space between them.

Defined results: a null or empty text has no ids and decodes to the empty
text; null ``doc_id`` is kept; repeated rows give repeated results; columns
beside ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
Special tokens written in a text are encoded as those tokens.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nimbus.llm.common import prepare

# Memory bound of a task's memos of encoded chunks and pieces.
MEMO_ENTRIES = 600_000
MEMO_KEY = 64
# The bytes-to-printable table of byte-level vocabularies: printable
# bytes stand for themselves, the others follow from code point 256 on.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> list[str]:
    out = {b: chr(b) for b in _KEPT}
    rest = [b for b in range(256) if b not in out]
    out.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return [out[b] for b in range(256)]


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge a piece's symbol ids by rank; ``ranks``: pair -> (rank, new id)."""
    n = len(symbols)
    if n < 2:
        return symbols
    sym = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for i in range(n - 1):
        found = ranks.get((sym[i], sym[i + 1]))
        if found:
            queue.append((found[0], i, sym[i], sym[i + 1], found[1]))
    heapq.heapify(queue)
    while queue:
        _, i, a, b, new = heapq.heappop(queue)
        j = right[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue  # stale: one of the two has been merged meanwhile
        sym[i], sym[j] = new, -1
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if found := ranks.get((new, sym[k])):
                heapq.heappush(queue, (found[0], i, new, sym[k], found[1]))
        h = left[i]
        if h >= 0 and (found := ranks.get((sym[h], new))):
            heapq.heappush(queue, (found[0], h, sym[h], new, found[1]))
    out, i = [], 0
    while i < n:
        out.append(sym[i])
        i = right[i]
    return out


def lowered(raw: bytes) -> bytes:
    """Lower case where that is sure to come to the same: special tokens are
    written as they are, and capitals compose with other marks than small
    letters do."""
    return raw.lower() if raw.isascii() and b"<|" not in raw else raw


class Memo(dict):
    """Results of ``compute`` by short key, forgotten when there are too many."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= MEMO_KEY:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[key] = value


class BPE:
    """A byte-level BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError(f"{path}: not a plain BPE file")
        vocab = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {}
        for rank, (a, b) in enumerate(merges):
            self.ranks.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        end = model["end_of_word_suffix"] or ""
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + end] for c in alphabet]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in {**vocab, **self.special}.items():
            self.strings[i] = token
        # Unicode tables differ between versions, so letters beyond ASCII are
        # normalised and cut by the tokenizer file's own steps.
        library = Tokenizer.from_file(path)
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.ascii_pieces = regex.compile(pattern).findall
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.memo, self.piece_memo = Memo(self._chunk), Memo(self._merged)

    def _merged(self, piece: str) -> bytes:
        raw = [self.byte_of[c] for c in piece]
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return array("I", merge_symbols(symbols, self.ranks)).tobytes()

    def _plain(self, text: str) -> bytes:
        if text.isascii() and text.isprintable():
            return b"".join(map(self.piece_memo.__getitem__, self.ascii_pieces(text.lower())))
        return b"".join([self.piece_memo[p] for p, _ in self.cut(self.normalize(text))])

    def _chunk(self, raw: bytes) -> bytes:
        """Ids of a stretch of text without ASCII white space."""
        chunk = raw.decode("utf-8")
        if self.at_special is None or "<" not in chunk:
            return self._plain(chunk)
        parts, at = [], 0
        for m in self.at_special.finditer(chunk):
            parts += [self._plain(chunk[at:m.start()]), array("I", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*parts, self._plain(chunk[at:])])

    def encode_bytes(self, raw: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers. No
        piece, special token or composed letter spans white space, so the
        stretches between white space are encoded on their own."""
        return b"".join(map(self.memo.__getitem__, lowered(raw).split()))

    def forget(self) -> None:
        self.memo.clear()
        self.piece_memo.clear()

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_bytes(text.encode("utf-8"))).tolist()

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


_loaded: dict[str, BPE] = {}


def load(path: str) -> BPE:
    """One tokenizer for each worker process and path."""
    if path not in _loaded:
        _loaded[path] = BPE(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids``: the ids of every whole text, packed as
    little-endian unsigned 32-bit integers."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer_path)
        for b in batches:
            ids = [bpe.encode_bytes(t or b"") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "token_ids"])
        bpe.forget()  # the worker process goes on to other work

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, token_ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids, decoded`` from ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer_path)
        for b in batches:
            text = [bpe.decode(array("I", x)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, token_ids binary, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
