"""Operator 12: how filters interact, by the potential of their removal game.

In the removal game of a part of the corpus a coalition S of filters is worth
v(S), the number of documents that fail at least one filter of S. Its
Hart-Mas-Colell potential is P({}) = 0 and

    P(S) = (v(S) + sum of P(S - i) over i in S) / |S|,

computed over the 32 coalitions, smaller ones first. The Shapley value of a
filter is P(all) - P(all without it); times 120 it is the number of
documents the filter removes, summed over all orders of the five. (P times
120 is whole, so the recursion runs on whole numbers.) What a step of an order
removes is the difference v(S + i) - v(S); the same game over the good and
the toxic documents alone gives what a step loses of them.

The corpus enters as counts: each document becomes a mask of the filters it
fails, copies are resolved by digest, and at most 32 masks a part are left.
Equal texts have equal masks but for E, which all of them fail but those of
the smallest ``doc_id``; so copies are summed by digest and part before they
meet (a text found in a third of all rows is a few rows a task), and no row
is ever joined back.

Filters fail a text (null: empty) that has A: under ``MIN_WORDS`` words, B:
under ``MIN_DISTINCT`` percent distinct words, C: over ``MAX_UPPER`` percent
capitals A-Z, D: any of ``#$%&*|``, E: the text of a smaller ``doc_id``.

Defined results: a null ``lang`` is the part '', together with an empty one; rows
without ``doc_id`` have no smaller one, so they pass E, and are no original of
others; a repeated row counts each time, and passes E each time if its
``doc_id`` is the smallest; several labels of one document count as their
maximum, null or missing ones as 0; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nimbus.llm.common import prepare

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
SPECIAL = "[#$%&*|]"
ORDERS = 120
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n", "good", "toxic")


# ---------------------------------------------------------------- the game

def worth(masks: dict[int, int], size: int = len(FILTERS)) -> list[int]:
    """v(S) for every coalition S; ``masks``: documents by failed filters."""
    return [sum(c for mask, c in masks.items() if mask & s) for s in range(1 << size)]


def potentials(v: list[int]) -> list[int]:
    """120 P(S) for every coalition S of at most five filters."""
    out = [0] * len(v)
    for s in range(1, len(v)):  # every S - i is smaller than S
        inside = [s ^ (1 << i) for i in range(s.bit_length()) if s >> i & 1]
        out[s], rest = divmod(ORDERS * v[s] + sum(out[x] for x in inside), len(inside))
        assert not rest
    return out


def steps(masks: dict[int, tuple[int, int, int]]) -> Iterator[tuple]:
    """The audit of one part: ``filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley`` for each order and step."""
    all_, good, toxic = (worth({m: c[k] for m, c in masks.items()}) for k in range(3))
    total = sum(c[0] for c in masks.values())
    p = potentials(all_)
    full = len(p) - 1
    for order in permutations(range(len(FILTERS))):
        before = 0
        name = "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = all_[after] - all_[before]
            yield (name, step, total - all_[after], removed, all_[1 << i] - removed, all_[full] - all_[full ^ 1 << i],
                   good[after] - good[before], toxic[after] - toxic[before], p[full] - p[full ^ 1 << i])
            before = after


# ---------------------------------------------------------------- the corpus

def failed(text: Column) -> Column:
    """The mask of the filters A to D that ``text`` (not null) fails."""
    inner = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.split(inner, "[ \\t\\n\\x0B\\f\\r]+")
    n = F.when(inner == "", 0).otherwise(F.size(words))
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words)))
    length = F.char_length(text)
    upper = length - F.char_length(F.translate(text, CAPITALS, ""))
    fails = (n < MIN_WORDS, 100 * distinct.cast("long") < MIN_DISTINCT * n.cast("long"),
             100 * upper.cast("long") > MAX_UPPER * length.cast("long"), text.rlike(SPECIAL))
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), failed(text).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").select(
        "part", "digest", "mask", "doc_id", F.lit(1).cast("long").alias("n"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long").alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long").alias("toxic"))
    # Counts by text and part: in all, of rows without an id, and of the smallest doc_id, which a null never is.
    of = F.struct(*COUNTS)
    by_id = marked.groupBy("digest", "mask", "part", "doc_id").agg(*(F.sum(c).alias(c) for c in COUNTS))
    none = F.col("doc_id").isNull()
    texts = by_id.groupBy("digest", "mask", "part").agg(
        F.min("doc_id").alias("least"), F.min_by(of, "doc_id").alias("first"),
        *(F.sum(c).alias(c) for c in COUNTS), *(F.sum(F.when(none, F.col(c)).otherwise(0)).alias(f"{c}_none") for c in COUNTS))
    # One row for each part that has the text.
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    passing = {c: F.col(f"{c}_none") + F.when(first, F.col(f"first.{c}")).otherwise(0) for c in COUNTS}
    split = texts.select("part", "mask", F.struct(*((passing[c]).alias(c) for c in COUNTS)).alias("originals"),
                         F.struct(*((F.col(c) - passing[c]).alias(c) for c in COUNTS)).alias("copies"))
    e = 1 << FILTERS.index("E")
    either = split.select("part", F.explode(F.array(F.struct(F.col("mask"), F.col("originals").alias("of")),
                                                    F.struct((F.col("mask") + e).alias("mask"), F.col("copies").alias("of")))).alias("x"))
    return either.select("part", "x.mask", "x.of.*").groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS))


def audit(masks: DataFrame) -> DataFrame:
    """One row for each part, order and step from ``document_masks``."""
    prepare(masks.sparkSession)

    def run(part: pa.Table) -> pa.Table:
        of = {m: c for m, *c in zip(*(part[c].to_pylist() for c in ("mask", *COUNTS)), strict=True)}
        cols = [pa.array(x) for x in zip(*steps(of), strict=True)]
        cols[1] = cols[1].cast(pa.int32())
        return pa.table([pa.array([part["part"][0].as_py()] * len(cols[0]), pa.string()), *cols],
                        names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])

    return masks.groupBy("part").applyInArrow(
        run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
