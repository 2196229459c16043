"""Operator 6: benchmark decontamination with training suffix arrays.

The training texts are cut into shards of about ``SHARD_BYTES``. Each shard
gets a suffix array over its words, sorted by prefix doubling to ``DEPTH``
words (a window is 13). Every suffix of every benchmark text is then searched
in it by binary search: the neighbours of its place give the longest verbatim
match, and for a window the range of suffixes that begin with it gives all
its places. Words inside any of these are hit.

Shards are independent, so the work is one pass over the documents without a
shuffle, and a lost task repeats its own shards only. The benchmark is a
stated query set, sent to the tasks in blocks of at most ``BLOCK_BYTES``: a
benchmark beyond one block takes one pass for each block and one grouping of
the (rare) hits by document.

Words are compared by 64-bit hashes.

Defined results: null and empty texts have no words, are not contaminated
and no window of theirs occurs; benchmark texts without words have no window;
benchmark rows without an id hit words but are not listed; repeated documents
give repeated rows; an empty benchmark hits nothing; extra columns are kept
out of the report.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import doc_rows, id_key, key_to_id, prepare, staged, unused
from nimbus.llm.words import ALNUM, Words, groups

WINDOW = 13
DEPTH = 16
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
_FOUND = "did long, rk long, n_words long, spans array<struct<a:long,b:long>>, items array<string>, longest int"


class SuffixArray:
    """Word suffixes of a shard in the order of their first ``DEPTH`` words.
    A zero stands after each text and matches no word."""

    def __init__(self, words: Words):
        n = len(words.hash)
        self.place = np.arange(n) + words.doc          # of word i in ``seq``
        self.seq = np.zeros(n + len(words.n) + DEPTH, np.uint64)
        self.seq[self.place] = words.hash | np.uint64(1)  # never zero
        self.word = np.full(len(self.seq), -1)
        self.word[self.place] = np.arange(n)
        rank = np.unique(self.seq, return_inverse=True)[1].astype(np.int64)
        size, depth, order = len(rank), 1, None
        while depth < DEPTH:
            nxt = np.zeros(size, np.int64)
            nxt[:-depth] = rank[depth:]
            key = rank * (size + 1) + nxt
            order = np.argsort(key)
            ordered = key[order]
            new = np.empty(size, np.int64)
            new[order] = np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64))))
            rank, depth = new, depth * 2
        self.sa = order
        self.leading = self.seq[order]  # first word of each suffix

    def compare(self, at: np.ndarray, queries: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign of (suffix - query) over the first ``depth`` words, and how
        many words are equal."""
        idx = self.sa[at][:, None] + np.arange(DEPTH)
        have = self.seq[np.minimum(idx, len(self.seq) - 1)]
        same = have == queries
        equal = np.where(same.all(1), DEPTH, np.argmin(same, 1))
        first = np.minimum(equal, DEPTH - 1)
        rows = np.arange(len(at))
        less = np.where(have[rows, first] < queries[rows, first], -1, 1)
        return np.where(equal >= depth, 0, less), np.minimum(equal, depth)

    def bound(self, queries: np.ndarray, depth: np.ndarray, upper: bool) -> np.ndarray:
        """First place whose suffix is not below (``upper``: above) the query."""
        lo = np.searchsorted(self.leading, queries[:, 0], "left")
        hi = np.searchsorted(self.leading, queries[:, 0], "right")
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            sign, _ = self.compare(mid, queries[open_], depth[open_])
            right = sign <= 0 if upper else sign < 0
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)
        return lo

    def longest(self, queries: np.ndarray, depth: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Words of the longest match of each query, up to its depth."""
        out = np.zeros(len(queries), np.int64)
        for at in (low - 1, low):
            ok = np.flatnonzero((at >= 0) & (at < len(self.sa)))
            out[ok] = np.maximum(out[ok], self.compare(at[ok], queries[ok], depth[ok])[1])
        return out


class Benchmark:
    """Suffixes of the benchmark texts: ``queries`` (the first words, zero
    after the end), their ``depth`` and ``need`` (words of the window that
    begins there, 0 if none does) and ``item`` (number in ``ids``)."""

    def __init__(self, rows: list[tuple[str | None, str | None]]):
        w = Words([(t or "").encode("utf-8") for _, t in rows], ALNUM, lower=True)
        left = w.first[1:][w.doc] - np.arange(len(w.hash))   # words to the text's end
        seq = np.concatenate([w.hash | np.uint64(1), np.zeros(DEPTH, np.uint64)])
        self.seq, self.left, self.item = seq, left, w.doc
        queries = seq[np.arange(len(left))[:, None] + np.arange(DEPTH)]
        queries[np.arange(DEPTH) >= left[:, None]] = 0
        self.queries, self.depth = queries, np.minimum(left, DEPTH)
        length = np.minimum(w.n, WINDOW)[w.doc]
        self.need = np.where(left >= length, length, 0)
        self.ids = [i for i, _ in rows]


def search(words: Words, bench: Benchmark) -> tuple[list[list[tuple[int, int]]], list[set], np.ndarray]:
    """For each text: hit spans of words, item ids, longest match in words."""
    n_docs = len(words.n)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
    items: list[set] = [set() for _ in range(n_docs)]
    longest = np.zeros(n_docs, np.int64)
    if not len(words.hash) or not len(bench.left):
        return spans, items, longest
    sa = SuffixArray(words)
    low = sa.bound(bench.queries, bench.depth, upper=False)
    match = sa.longest(bench.queries, bench.depth, low)
    found = np.flatnonzero((bench.need > 0) & (match >= bench.need))
    lo = sa.bound(bench.queries[found], bench.need[found], upper=False)
    hi = sa.bound(bench.queries[found], bench.need[found], upper=True)
    cover = np.zeros(len(words.hash) + 1, np.int64)
    for q, a, b in zip(found.tolist(), lo.tolist(), hi.tolist(), strict=True):
        places = sa.sa[a:b]
        at = sa.word[places]
        need, item = int(bench.need[q]), bench.ids[bench.item[q]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + need, -1)
        # How far each verbatim match goes on beyond the window.
        size, more, live = need, np.full(len(at), need), np.arange(len(at))
        while len(live) and size < bench.left[q]:
            live = live[sa.seq[np.minimum(places[live] + size, len(sa.seq) - 1)] == bench.seq[q + size]]
            size += 1
            more[live] = size
        docs = words.doc[at]
        np.maximum.at(longest, docs, more)
        if item is not None:
            for d in set(docs.tolist()):
                items[d].add(item)
    hit = np.cumsum(cover[:-1]) > 0
    # Spans end where a text ends.
    before = np.concatenate(([False], hit[:-1])) & ~np.isin(np.arange(len(hit)), words.first[:-1])
    starts = np.flatnonzero(hit & ~before)
    after = np.concatenate((hit[1:], [False])) & ~np.isin(np.arange(len(hit)) + 1, words.first[:-1])
    ends = np.flatnonzero(hit & ~after) + 1
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        d = int(words.doc[a])
        spans[d].append((a - int(words.first[d]), b - int(words.first[d])))
    return spans, items, longest


def _scan(docs: DataFrame, rows: list[tuple[str | None, str | None]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)  # at most BLOCK_BYTES of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(shared.value)
        span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part in groups(rows, 2, SHARD_BYTES):
            words = Words([r[2] for r in part], ALNUM, lower=True)
            spans, items, longest = search(words, bench)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array(words.n, pa.int64()),
                 pa.array([[{"a": a, "b": b} for a, b in s] for s in spans], span), pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                 pa.array(longest, pa.int32())], ["did", "rk", "n_words", "spans", "items", "longest"])

    return doc_rows(docs).select("did", "rk", F.col("text").cast("binary").alias("text")).mapInArrow(run, _FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``did, rk, n_words, n_hit, items, longest`` for every document: words,
    hit words, ids of items with occurring windows, words of the longest
    verbatim match of a window."""
    prepare(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    found = []
    for k in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found.append(_scan(docs, [(r["item_id"], r["text"]) for r in block.collect()]))
    if blocks == 1:
        rows = found[0]
    else:
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        rows = (every.groupBy("did", "rk").agg(F.max("n_words").alias("n_words"), F.max("longest").alias("longest"), (F.count(F.lit(1)) / blocks).cast("int").alias("copies"),
                                               F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
                .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))))
    # Spans of one block do not overlap; those of several may.
    merged = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                         lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["to"], x["a"]))).alias("n"), F.greatest(s["to"], x["b"]).alias("to")))
    return rows.select("did", "rk", "n_words", merged["n"].alias("n_hit"), F.array_sort("items").alias("items"), "longest")


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(docs, benchmark)
    return found.select(key_to_id(F.col("did")).alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"), "longest")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    c_did, c_rk, c_bad, c_text = unused(docs, "__did", "__rk", "__bad", "__text")
    bad = staged(contamination(docs, benchmark).where(is_contaminated()).select(F.col("did").alias(c_bad), F.col("rk").alias(c_text)).distinct(), "contaminated")
    key = docs.withColumn(c_did, id_key()).withColumn(c_rk, F.xxhash64(c_did, F.coalesce(F.col("text"), F.lit(""))))
    return key.join(bad, (F.col(c_did) == F.col(c_bad)) & (F.col(c_rk) == F.col(c_text)), "left_anti").select([F.col(c) for c in docs.columns])
