"""Operator 9: repeated byte strings by prefix-free parsing.

A byte goes if some 200-byte string over it also starts anywhere else in the
corpus (same document or not), judged on the input.

``passages`` brings together the segments that may hold the same strings. A
shard's segments are a highly repetitive text, and its suffix array is built
by prefix-free parsing:

* *Triggers*: places where a hash of the next ``TRIGGER`` bytes leaves 0
  modulo ``MODULUS``. They cut the text into phrases, each reaching over the
  trigger that ends it, so no phrase suffix is a prefix of another one.
* *Dictionary*: the different phrases, in a suffix array of their own.
* *Parse*: the sequence of phrase numbers, in a suffix array of its own.
* A suffix of the text sorts by its phrase's suffix, then by the parse suffix
  behind it: two numbers, one sort, and the suffixes stand in corpus order.

Suffixes that share 200 bytes stand together in this order; a group with two
different places in the corpus is repeated. Both arrays are sorted by prefix
doubling, no deeper than 200 bytes ask for.

Defined results: null and empty texts have no bytes; texts of fewer than 200
bytes keep them all; matches never cross texts; rows given several times (same
id, same text) are one document and each of them gets its result; rows of one
id, or of none, with different texts are different documents; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import key_to_id
from nimbus.llm.passages import Scheme, merge_spans, place_parts, repeated_windows, rows_with_spans
from nimbus.llm.words import _BASE, _INVERSE, BYTE_VALUES, mix, powers

WINDOW = 200
BYTES = Scheme("byte", WINDOW, 32, 2048)
WINDOWS_AT_ONCE = 250_000
TRIGGER = 4
MODULUS = 24


def _first_equal(ordered: np.ndarray) -> np.ndarray:
    """For sorted keys: the place of the first one equal to each."""
    new = np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def dense(key: np.ndarray) -> np.ndarray:
    """Ranks of keys: 1 and the number of smaller ones, so that keys which
    share a rank can be told apart later without moving any other."""
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = _first_equal(key[order]) + 1
    return rank


def doubled(rank: np.ndarray, left: np.ndarray, depth: int, enough: int) -> np.ndarray:
    """Prefix doubling: ranks of suffixes by their first ``enough`` symbols
    from ranks by the first ``depth``. ``left``: symbols to the end, where a
    suffix stops (and sorts before its continuations). Only suffixes that
    still share their rank are sorted again."""
    n = len(rank)
    while depth < enough:
        count = np.bincount(rank, minlength=n + 2)
        open_ = np.bincount(rank[left > depth], minlength=n + 2)
        tied = np.flatnonzero((count > 1)[rank] & (open_ > 0)[rank])
        if not len(tied):
            break
        old = rank[tied]
        goes = left[tied] > depth
        nxt = np.zeros(len(tied), np.int64)
        nxt[goes] = rank[tied[goes] + depth]
        key = old * (n + 2) + nxt
        order = np.argsort(key)
        group = old[order]
        rank = rank.copy()
        rank[tied[order]] = group + _first_equal(key[order]) - _first_equal(group)
        depth *= 2
    return rank


def triggers(data: np.ndarray) -> np.ndarray:
    """Whether a trigger begins at each place."""
    out = np.zeros(len(data), bool)
    if len(data) >= TRIGGER:
        value = np.zeros(len(data) - TRIGGER + 1, np.uint64)
        for j in range(TRIGGER):
            value = value * np.uint64(256) + data[j:j + len(value)]
        out[:len(value)] = mix(value) % np.uint64(MODULUS) == 0
    return out


def corpus_order(segments: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts of the joined segments in suffix order (to ``window``
    bytes), and each one's segment and offset."""
    raw = b"".join(segments)
    data = np.frombuffer(raw, np.uint8)
    size = np.array([len(s) for s in segments], np.int64)
    base = np.cumsum(size) - size
    seg_end = np.repeat(base + size, size)
    place = np.arange(len(data))
    # A trigger must lie within its segment; a segment's start begins a phrase too.
    cut = triggers(data) & (place + TRIGGER <= seg_end)
    cut[base] = True
    begin = np.flatnonzero(cut)
    owner_end = seg_end[begin]
    nxt = np.append(begin[1:], len(data))
    final = nxt >= owner_end                       # last phrase of its segment
    end = np.where(final, owner_end, nxt + TRIGGER)
    # Dictionary.
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    phrase = np.array([number[raw[a:b]] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], np.int64)
    # A segment's last phrase stops there: a symbol of its own ends it.
    words = list(number)
    length = np.array([len(w) for w in words], np.int64)
    d_base = np.cumsum(length) - length
    d_data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) + 1
    d_left = np.repeat(d_base + length, length) - np.arange(len(d_data))
    key = np.zeros(len(d_data), np.int64)
    padded = np.concatenate([d_data, np.zeros(7, np.int64)])
    for j in range(7):
        key = key * 257 + np.where(d_left > j, padded[j:j + len(d_data)], 0)
    d_rank = doubled(dense(key), d_left, 7, window)
    # Parse.
    p_owner = np.repeat(np.arange(len(segments)), np.diff(np.append(np.searchsorted(begin, base), len(begin))))
    p_last = np.searchsorted(begin, base + size) - 1
    p_left = p_last[p_owner] - np.arange(len(begin)) + 1
    p_rank = doubled(dense(d_rank[d_base[phrase]]), p_left, 1, window)
    # Text suffixes: rank of the phrase's suffix, then of the parse behind it.
    of = np.cumsum(cut) - 1
    behind = np.where(final, 0, np.append(p_rank[1:], 0))
    start = place[place + window <= seg_end]
    q = of[start]
    alpha = d_rank[d_base[phrase[q]] + start - begin[q]]
    order = start[np.argsort(alpha * (len(begin) + 2) + behind[q])]
    owner = np.searchsorted(base, order, "right") - 1
    return order, owner, order - base[owner]


def string_hashes(data: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the ``window`` bytes at each start."""
    out = []
    for values in (BYTE_VALUES, mix(BYTE_VALUES)):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data] * powers(_BASE, len(data)), out=sums[1:])
        out.append((sums[starts + window] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts])
    return out[0], out[1]


def locate_strings(rows: list[tuple], scheme: Scheme = BYTES) -> list[tuple]:
    """Findings about the segments of some anchors; the places of ``first``
    are not needed here (0)."""
    segments = [r[1] for r in rows]
    order, owner, offset = corpus_order(segments, scheme.window)
    if not len(order):
        return []
    # Neighbours in corpus order with the same 200 bytes.
    a, b = string_hashes(np.frombuffer(b"".join(segments), np.uint8), order, scheme.window)
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    group = np.flatnonzero(new)
    lo = np.array([place_parts(int(r[2])) for r in rows], np.int64)
    hi = np.array([place_parts(int(r[3])) for r in rows], np.int64)
    spread = np.zeros(len(group), bool)
    for c, add in ((0, 0), (1, 0), (2, offset)):
        spread |= np.minimum.reduceat(lo[owner, c] + add, group) != np.maximum.reduceat(hi[owner, c] + add, group)
    repeated = spread[np.cumsum(new) - 1]
    at = np.sort(owner[repeated] * (1 << 32) + offset[repeated])
    if not len(at):
        return []
    head = np.flatnonzero(np.append(True, np.diff(at) != 1))
    count = np.diff(np.append(head, len(at)))
    return [(rows[x >> 32][0], rows[x >> 32][4], x & 0xFFFFFFFF, n, 0) for x, n in zip(at[head].tolist(), count.tolist(), strict=True)]


def removed_spans(docs: DataFrame, hot: int | None = None, made: list[str] | None = None) -> DataFrame:
    """``did, rk, a, b``: bytes a .. b-1 of a document are to be removed."""
    found = repeated_windows(docs, BYTES, locate_strings, WINDOWS_AT_ONCE, made=made, **({"hot": hot} if hot else {}))
    return found.select("did", "rk", F.col("start").alias("a"), (F.col("start") + F.col("n") + (WINDOW - 1)).alias("b"))


def deduplicate(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: a cut may fall
    inside a letter)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[], [], [], []]
            for raw, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                merged, at, left = merge_spans(spans), 0, []
                for a, e in merged:
                    left.append(raw[at:a])
                    at = e
                kept = b"".join([*left, raw[at:]])
                for col, x in zip(cols, (len(raw), len(raw) - len(kept), len(merged), kept), strict=True):
                    col.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    made: list[str] = []
    rows = rows_with_spans(docs, removed_spans(docs, hot, made), made).select(key_to_id(F.col("did")).alias("doc_id"), "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def report(docs: DataFrame, hot: int | None = None) -> DataFrame:
    return deduplicate(docs, hot).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
