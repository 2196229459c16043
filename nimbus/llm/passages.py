"""Repeated windows of a corpus: which stretches of ``window`` units (words or
bytes) occur more than once, found without an index of the whole corpus.

1. *Anchors.* The anchor of a window is the smallest hash of the ``k``-unit
   strings in it. Equal windows have equal anchors, and neighbours mostly
   share theirs, so a text is a short list of runs of windows. A window whose
   anchor has one place in the corpus occurs once itself; the count is an
   ordinary aggregation (hot anchors are combined before the shuffle).
2. *Segments.* Runs with a repeated anchor are cut out with their text.
   Equal segments become one row (``lo``, ``hi``: their first and last place).
3. *Shards.* Segments meet by anchor, in tasks that hold a bounded number of
   them at a time, and a function of the operator locates the repeated windows
   there. Segments of an anchor with more than ``HOT`` different ones are cut
   anew with longer anchors, which hold some of what stands around the string
   they share, and again if that does not tell them apart, until the whole
   window is the anchor: equal windows are then equal rows, so a passage that
   a third of all documents share never meets in one task.
4. The shards' findings go back to every occurrence of their segment by a
   join, and are gathered for each document.

Disk: a segment is its run and the rest of its last window, so segments take
several times the bytes of the text they stand for, and windows that are rows
of their own ``window`` times. Steps 2 to 4 therefore take the anchors in
rounds, each with about ``AT_ONCE`` times the bytes of all texts; longer
anchors grow by halves of what is left, so that only windows inside a long
shared passage become rows of their own; and tables of a round go with it.

A place is one number made of the document's key (``did``, and of documents
that share it, as those without an id do, part of the hash ``rk`` of its text) and ``start``, so that
places sort as (doc_id, text, start). Repeated rows (same id and text) are one document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import doc_rows, prepare, remove_staged, shuffle_parts, staged
from nimbus.llm.words import _BASE, _INVERSE, BYTE_VALUES, NON_SPACE, Words, groups, mix, powers, rolling

STRIDE = 10 ** 10      # more than the units of a text
TEXTS = 9 * 10 ** 8    # documents of one id are told apart by so much of their text's hash
HOT = 4096             # segments of an anchor before it is cut anew
SLICE = 1 << 18        # windows looked at together
AT_ONCE = 1.25         # bytes of a round's segments, times the bytes of the texts
TASK_ROWS = 4096       # segments of a task at least, else there are fewer tasks
# Findings about a segment: windows i .. i+n-1 recur; ``first``: place of the first occurrence of window i.
FOUND = "anchor long, sh long, i int, n int, first decimal(38,0)"


@dataclass(frozen=True)
class Scheme:
    """What a unit is, and the lengths of windows and anchors."""

    unit: str          # "word" or "byte"
    window: int
    k: int
    longest_run: int   # windows of a segment at most
    unit_bytes: int = 1    # of a unit and what parts it from the next, about

    def longer(self, k: int) -> int:
        """Length of the anchors after those of length ``k``."""
        k += (self.window - k + 1) // 2
        return k if self.window - k > self.window // 10 else self.window

    def units(self, texts: list[bytes]):
        return _WordUnits(texts) if self.unit == "word" else _ByteUnits(texts)

    def split(self, segment: bytes) -> int:
        """Windows of a segment."""
        return (len(segment) if self.unit == "byte" else segment.count(b" ") + 1) - self.window + 1


class _WordUnits:
    """Words between white space; cut texts are joined by one space."""

    def __init__(self, texts: list[bytes]):
        self.words = Words([b" ".join(t.split()) for t in texts], NON_SPACE)
        self.raw = self.words.data.tobytes()
        self.first = self.words.first

    def strings(self, a: int, b: int, k: int) -> np.ndarray:
        return rolling(self.words.hash[a:b], k)

    def cut(self, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw = self.raw
        return [raw[s:e] for s, e in zip(self.words.start[starts].tolist(), self.words.end[ends - 1].tolist(), strict=True)]


class _ByteUnits:
    def __init__(self, texts: list[bytes]):
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)

    def strings(self, a: int, b: int, k: int) -> np.ndarray:
        piece = self.data[a:b]
        if len(piece) < k:
            return np.empty(0, np.uint64)
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[piece] * powers(_BASE, len(piece)), out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * powers(_INVERSE, len(piece))[:len(piece) - k + 1])

    def cut(self, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw = self.raw
        return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n = len(a) - w + 1
    if n <= 0:
        return a[:0]
    blocks = np.full(-(-len(a) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(a)] = a
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def text_of(first: np.ndarray, p: int, q: int) -> np.ndarray:
    """Number of the text that holds each of the units p .. q-1."""
    a, b = np.searchsorted(first, [p, q - 1], "right") - 1
    return np.repeat(np.arange(a, b + 1), np.diff(np.clip(first[a:b + 2], p, q)))


def anchor_places(units, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every k-unit string that is the smallest of some
    window. Equal windows hold it at the same offset, hence at different
    places, also within one run of a text that repeats itself."""
    first, size, k = units.first, scheme.window, scheme.k
    w = size - k + 1
    none = np.iinfo(np.uint64).max
    out = []
    for p in range(0, int(first[-1]) - size + 1, SLICE):
        q = min(p + SLICE, int(first[-1]) - size + 1)
        strings = units.strings(p, q + size - 1, k)
        at = np.arange(p, q)
        ok = at + size <= first[text_of(first, p, q) + 1]
        # Largest anchor of the windows over a string, through its complement.
        over = np.full(len(strings) + w - 1, none)
        over[w - 1:w - 1 + len(at)] = np.where(ok, ~sliding_min(strings, w), none)
        place = np.flatnonzero(sliding_min(over, w) == ~strings)
        out.append((strings[place], np.searchsorted(first, place + p, "right") - 1))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def runs(units, scheme: Scheme, k: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor, text, first unit (of all the
    texts joined), number of windows. Windows never span texts."""
    k = k or scheme.k
    first, size = units.first, scheme.window
    out = []
    for p in range(0, int(first[-1]) - size + 1, SLICE):
        q = min(p + SLICE, int(first[-1]) - size + 1)
        anchor = sliding_min(units.strings(p, q + size - 1, k), size - k + 1)
        at = np.arange(p, q)
        doc = text_of(first, p, q)
        ok = at + size <= first[doc + 1]
        new = np.ones(q - p, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(ok & new)
        if not len(begin):
            continue
        # A text's windows are its first positions, so a run ends where the next begins or windows end.
        last = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
        n = last - begin + 1
        pieces = -(-n // scheme.longest_run)
        if (pieces > 1).any():
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            total = np.repeat(n, pieces)
            begin = np.repeat(begin, pieces) + step * scheme.longest_run
            n = np.minimum(scheme.longest_run, total - step * scheme.longest_run)
        out.append((anchor[begin], doc[begin], begin + p, n))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _anchors(docs: DataFrame, scheme: Scheme) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(_rows(batches), 2):
            anchor, doc = anchor_places(scheme.units([r[2] for r in part]), scheme)
            keys = np.array([[r[0], r[1]] for r in part], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(keys[doc, 0]), pa.array(keys[doc, 1])], ["anchor", "did", "rk"])

    return docs.mapInArrow(run, "anchor long, did long, rk long")


def _segments(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """``docs``: did, rk, text, anchors (the repeated ones of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(_rows(batches), 2):
            units = scheme.units([r[2] for r in part])
            anchor, doc, begin, n = runs(units, scheme)
            wanted = np.unique(np.array([a for r in part for a in r[3]], np.int64))
            kept = np.flatnonzero(np.isin(anchor.view(np.int64), wanted))
            anchor, doc, begin, n = anchor[kept], doc[kept], begin[kept], n[kept]
            cut = units.cut(begin, begin + n + scheme.window - 1)
            keys = np.array([[r[0], r[1]] for r in part], np.int64)
            for s in range(0, len(kept), 20_000):
                t = slice(s, s + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[t].view(np.int64)), pa.array(cut[t], pa.binary()), pa.array(keys[doc[t], 0]), pa.array(keys[doc[t], 1]),
                     pa.array(begin[t] - units.first[doc[t]])], ["anchor", "seg", "did", "rk", "start"])

    return docs.mapInArrow(run, "anchor long, seg binary, did long, rk long, start long")


def _recut(segments: DataFrame, scheme: Scheme, k: int) -> DataFrame:
    """Hot segments cut into pieces by anchors of ``k`` units. With the whole
    window as anchor each window is a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = scheme if k < scheme.window else replace(scheme, longest_run=1)
        for part in groups(_rows(batches), 1, 1 << 17):
            units = by.units([r[1] for r in part])
            anchor, doc, begin, n = runs(units, by, k)
            i = begin - units.first[doc]
            owner, offset = doc.tolist(), i.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[d][0] for d in owner], pa.int64()), pa.array([part[d][2] for d in owner], pa.int64()), pa.array(i, pa.int32()),
                 pa.array(anchor.view(np.int64)), pa.array(units.cut(begin, begin + n + by.window - 1), pa.binary()),
                 pa.array([int(part[d][3]) + x for d, x in zip(owner, offset, strict=True)], pa.decimal128(38, 0)),
                 pa.array([int(part[d][4]) + x for d, x in zip(owner, offset, strict=True)], pa.decimal128(38, 0))],
                ["anchor", "sh", "i", "piece_anchor", "seg", "lo", "hi"])

    return segments.select("anchor", "seg", "sh", "lo", "hi").mapInArrow(run, "anchor long, sh long, i int, piece_anchor long, seg binary, lo decimal(38,0), hi decimal(38,0)")


def _locate(segments: DataFrame, n: int, locate: Callable, scheme: Scheme, windows_at_once: int) -> DataFrame:
    """Apply ``locate(rows, scheme)`` to whole anchors, a bounded number of
    windows at a time; rows: (anchor, segment, lo, hi, sh). ``n``: number of
    segments, or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            got = locate(rows, scheme)
            cols = list(zip(*got, strict=True)) if got else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["anchor", "sh", "i", "n", "first"])

        held, windows = [], 0
        for r in _rows(batches):
            if windows >= windows_at_once and r[0] != held[-1][0]:
                yield out(held)
                held, windows = [], 0
            held.append(r)
            windows += scheme.split(r[1])
        if held:
            yield out(held)

    tasks = min(4 * shuffle_parts(segments.sparkSession), n // TASK_ROWS + 1)
    dealt = segments.select("anchor", "seg", "lo", "hi", F.xxhash64("seg").alias("sh")).repartition(tasks, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, FOUND)


def place() -> Column:
    """The place of ``did, rk, start``: 19 digits for the id, 9 for the text,
    10 for the start."""
    within = F.pmod(F.col("rk"), F.lit(TEXTS)).cast("long") * F.lit(STRIDE) + F.col("start")
    return (F.col("did").cast("decimal(19,0)") * F.lit(str(10 ** 19)).cast("decimal(20,0)") + within.cast("decimal(19,0)")).cast("decimal(38,0)")


def place_parts(place: int) -> tuple[int, int, int]:
    """Id, text and start of a place."""
    did, within = divmod(place, 10 ** 19)
    return did, *divmod(within, STRIDE)


def _grouped(segments: DataFrame, anchor: str, lo: Column, hi: Column) -> DataFrame:
    return segments.groupBy(F.col(anchor).alias("anchor"), "seg").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"))


def _rounds(texts: DataFrame, marked: DataFrame, scheme: Scheme) -> int:
    """Rounds in which segments take ``AT_ONCE`` times the texts' bytes each."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = marked.agg(F.sum(F.size("anchors"))).first()[0] or 0
    run = (scheme.window - scheme.k + 2) / 2
    return max(1, math.ceil(n * (scheme.window + run) * scheme.unit_bytes / (AT_ONCE * max(size, 1))))


def _found(segments: DataFrame, scheme: Scheme, k: int, locate: Callable, windows_at_once: int, hot: int, made: list[str]) -> DataFrame:
    """Findings about different segments (``anchor, seg, sh, lo, hi``) whose
    anchors have ``k`` units. Folders of the findings are appended to ``made``."""
    spark = segments.sparkSession
    own: list[str] = []
    total = segments.count()
    crowded = None
    if k < scheme.window:
        crowded = staged(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("anchor"), "hot-anchors", own)
    if crowded is None or crowded.isEmpty():
        found = staged(_locate(segments, total, locate, scheme, windows_at_once), "repeated-windows", made)
    else:
        k = scheme.longer(k)
        cool = staged(_locate(segments.join(crowded, "anchor", "left_anti"), total, locate, scheme, windows_at_once), "repeated-windows", made)
        pieces = staged(_recut(segments.join(crowded, "anchor", "left_semi"), scheme, k).withColumn("piece_sh", F.xxhash64("seg")), "hot-pieces", own)
        apart = staged(_grouped(pieces, "piece_anchor", F.col("lo"), F.col("hi")).withColumn("sh", F.xxhash64("seg")), "distinct-hot-pieces", own)
        of_pieces = _found(apart, scheme, k, locate, windows_at_once, hot, own).select(F.col("anchor").alias("piece_anchor"), F.col("sh").alias("piece_sh"), F.col("i").alias("j"), "n", "first")
        back = (pieces.select("anchor", "sh", "i", "piece_anchor", "piece_sh").join(of_pieces, ["piece_anchor", "piece_sh"])
                .select("anchor", "sh", (F.col("i") + F.col("j")).alias("i"), "n", "first"))
        found = cool.unionByName(staged(back, "repeated-hot-windows", made))
    remove_staged(spark, own)
    return found


def repeated_windows(docs: DataFrame, scheme: Scheme, locate: Callable, windows_at_once: int, hot: int = HOT, made: list[str] | None = None) -> DataFrame:
    """``did, rk, start, n, first``: windows start .. start+n-1 of a document
    are repeated; ``first`` is the place of the first occurrence of the first
    of them, and the next ones follow it one by one. The folders that hold
    these rows are appended to ``made``."""
    spark = docs.sparkSession
    prepare(spark)
    made = [] if made is None else made
    texts = doc_rows(docs).select("did", "rk", F.col("text").cast("binary").alias("text"))
    counted: list[str] = []
    kept: list[str] = []
    anchors = staged(_anchors(texts, scheme), "anchors", counted)
    # A table of its own, so that the join's hot anchors can be split.
    repeated = staged(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "repeated", counted)
    marked = staged(anchors.join(repeated, "anchor", "left_semi").groupBy("did", "rk").agg(F.collect_set("anchor").alias("anchors")), "repeated-anchors", kept)
    remove_staged(spark, counted)
    rounds = _rounds(texts, marked, scheme)
    out = []
    for r in range(rounds):
        own: list[str] = []
        wanted = marked
        if rounds > 1:
            of_round = F.filter("anchors", lambda a: F.pmod(a, F.lit(rounds)) == F.lit(r))  # noqa: B023 - called at once
            wanted = marked.withColumn("anchors", of_round).where(F.size("anchors") > 0)
        # Rows given several times are one document: each of them would yield the same segments.
        segments = staged(_segments(texts.join(wanted, ["did", "rk"]), scheme).withColumn("sh", F.xxhash64("seg")), "segments", own)
        distinct = staged(_grouped(segments, "anchor", place(), place()).withColumn("sh", F.xxhash64("seg")), "distinct-segments", own)
        found = _found(distinct, scheme, scheme.k, locate, windows_at_once, hot, own)
        out.append(staged(segments.select("anchor", "sh", "did", "rk", "start").join(found, ["anchor", "sh"])
                          .select("did", "rk", (F.col("start") + F.col("i")).alias("start"), "n", "first"), "repeated-places", made))
        remove_staged(spark, own)
    remove_staged(spark, kept)
    return reduce(DataFrame.unionByName, out)


def rows_with_spans(docs: DataFrame, spans: DataFrame, made: list[str]) -> DataFrame:
    """``did, rk, text, spans`` for every row; ``spans``: did, rk, a, b, read
    from the folders ``made``, which go."""
    gathered = staged(spans.groupBy("did", "rk").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans")), "spans")
    remove_staged(docs.sparkSession, made)
    return doc_rows(docs).select("did", "rk", F.col("text").cast("binary").alias("text")).join(gathered, ["did", "rk"], "left")


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted spans a .. b-1 as maximal runs."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        if out and s["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["b"]))
        else:
            out.append((s["a"], s["b"]))
    return out
