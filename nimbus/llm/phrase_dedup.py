"""Operator 2: substring deduplication with repeated-phrase automata.

A window is 20 consecutive words of a document. A word goes if a window over
it has the same word sequence as a window that starts earlier (smaller
``doc_id``, or same document and earlier start), judged on the input.

``passages`` brings the segments together that may hold the same windows. In
each shard the windows that recur are confirmed by comparing their words (a
shard numbers its words, so equal numbers are equal words); the confirmed
windows are compiled into an Aho-Corasick automaton over word numbers, and all
segments of the shard are streamed through it, which locates every occurrence
together with the place of the first one.

Defined results: null and empty texts have no words; texts of fewer than 20
words keep them all; rows given several times (same id, same text) are one
document and each of them gets its result; rows of one id, or of none, with
different texts are different documents, in the order of their texts' hash; a null ``doc_id`` comes before
every other; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import key_to_id
from nimbus.llm.passages import Scheme, merge_spans, place, repeated_windows, rows_with_spans

WINDOW = 20
WORDS = Scheme("word", WINDOW, 6, 256, 7)
WINDOWS_AT_ONCE = 20_000


def locate_phrases(rows: list[tuple], scheme: Scheme = WORDS) -> list[tuple]:
    """Findings about the segments of some anchors."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    size = scheme.window
    texts = [tuple(map(number.__getitem__, r[1].split(b" "))) for r in rows]
    first: dict[tuple, int] = {}
    last: dict[tuple, int] = {}
    for (_, _, lo, hi, _), words in zip(rows, texts, strict=True):
        lo, hi = int(lo), int(hi)
        for i in range(len(words) - size + 1):
            window = words[i:i + size]
            if (seen := first.get(window)) is None:
                first[window], last[window] = lo + i, hi + i
            else:
                if lo + i < seen:
                    first[window] = lo + i
                if hi + i > last[window]:
                    last[window] = hi + i
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, place in first.items():
        if place != last[window]:
            automaton.add_word(window, place)
    if not len(automaton):
        return []
    automaton.make_automaton()
    out = []
    for (anchor, _, _, _, sh), words in zip(rows, texts, strict=True):
        begin = n = place = 0
        for end, at in automaton.iter(words):
            i = end - size + 1
            if n and i == begin + n and at == place + n:
                n += 1
                continue
            if n:
                out.append((anchor, sh, begin, n, place))
            begin, n, place = i, 1, at
        if n:
            out.append((anchor, sh, begin, n, place))
    return out


def removed_spans(docs: DataFrame, hot: int | None = None, made: list[str] | None = None) -> DataFrame:
    """``did, rk, a, b``: words a .. b-1 of a document are to be removed."""
    found = repeated_windows(docs, WORDS, locate_phrases, WINDOWS_AT_ONCE, made=made, **({"hot": hot} if hot else {}))
    later = found.where(place() != F.col("first"))
    return later.select("did", "rk", F.col("start").alias("a"), (F.col("start") + F.col("n") + (WINDOW - 1)).alias("b"))


def deduplicate(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words, one space between)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words, at, left = text.split(), 0, []
                for a, e in merge_spans(spans):
                    left += words[at:a]
                    at = e
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    made: list[str] = []
    rows = rows_with_spans(docs, removed_spans(docs, hot, made), made).select(key_to_id(F.col("did")).alias("doc_id"), "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary").withColumn("kept", F.col("kept").cast("string"))


def report(docs: DataFrame, hot: int | None = None) -> DataFrame:
    return deduplicate(docs, hot).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
