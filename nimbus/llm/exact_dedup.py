"""Operator 10: exact deduplication by skew-safe combining.

Three stages, each comparing full texts, never digests alone:

1. *local*: rows read together (``LOCAL_BYTES`` of text) are grouped by text;
   the best row of each group is the local winner, and only winners keep
   their text from here on. A group of copies that holds a third of the table
   shrinks to one row for each such block.
2. *salted*: winners whose digest occurs more than once are grouped by
   (digest, salt, text); the salt comes from the partition a row was read in
   and there are as many salts as the root of the number of partitions
   (``SALTS`` at least), so no task of this stage or the next gets more than
   its share of a large group.
3. *global*: the salt winners are grouped by (digest, text).

Digests only choose what need not be compared: a digest that occurs once has
no equal text. Each stage leaves links from row to winner; the links (numbers
only) are followed by joins, whose skew Spark splits at run time. The best
row is the one with the smallest ``doc_id``, then the row read first.

Defined results: null and empty texts are equal; a row with null ``doc_id``
stays only if no row with an id has its text; of repeated rows with the same
id and text exactly one stays; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nimbus.llm.common import prepare, staged, unused

LOCAL_BYTES = 8 << 20
SALTS = 16
_LAST = 2 ** 63 - 1  # a missing doc_id comes last
_LOCAL = "uid long, did long, digest string, local_uid long, local_did long, text string"


def normalised(col: str = "text") -> Column:
    """Each run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(col), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256_hex(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def _combine_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        best: dict[str, tuple[int, int]] = {}
        for uid, did, _, text in rows:
            if (seen := best.get(text)) is None or (did, uid) < seen:
                best[text] = (did, uid)
        cols = [[], [], [], [], [], []]
        for uid, did, digest, text in rows:
            w_did, w_uid = best[text]
            for col, x in zip(cols, (uid, did, digest, w_uid, w_did, text if uid == w_uid else None), strict=True):
                col.append(x)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["uid", "did", "digest", "local_uid", "local_did", "text"])

    rows, size = [], 0
    for b in batches:
        rows += zip(*(c.to_pylist() for c in b.columns), strict=True)
        size += b.nbytes
        if size >= LOCAL_BYTES:
            yield out(rows)
            rows, size = [], 0
    if rows:
        yield out(rows)


def _winners(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each row's winner among the rows of equal ``keys`` (text included)."""
    first = Window.partitionBy(*keys).orderBy("did", "uid")
    return (rows.withColumn("win_uid", F.first("uid").over(first)).withColumn("win_did", F.first("did").over(first)))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """``uid, did, digest, keep_uid, keep_did``: each row and the row that
    stays for its text. ``uid`` numbers the rows."""
    prepare(docs.sparkSession)
    text = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("did"), normalised().alias("text"))
    read = text.select(F.monotonically_increasing_id().alias("uid"), "did", digest(F.col("text")).alias("digest"), "text")
    salts = max(SALTS, math.isqrt(read.rdd.getNumPartitions()))
    local = staged(read.mapInArrow(_combine_local, _LOCAL), "exact-local")

    winners = local.where(F.col("text").isNotNull()).select("uid", "did", "digest", "text")
    again = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    met = winners.join(again, "digest", "left_semi").withColumn("salt", F.shiftright("uid", 33) % salts)
    salted = _winners(met, ["digest", "salt", "text"])
    salted = staged(salted.select("uid", "did", "digest", F.col("win_uid").alias("salt_uid"),
                                  F.when(F.col("uid") == F.col("win_uid"), F.col("text")).alias("text")), "exact-salted")
    final = _winners(salted.where(F.col("text").isNotNull()), ["digest", "text"]).select(F.col("uid").alias("salt_uid"), F.col("win_uid").alias("keep_uid"), F.col("win_did").alias("keep_did"))
    # Local winner -> row that stays, for the winners that met another.
    links = salted.select("uid", "salt_uid").join(final, "salt_uid").select(F.col("uid").alias("local_uid"), "keep_uid", "keep_did")
    return (local.select("uid", "did", "digest", "local_uid", "local_did").join(links, "local_uid", "left")
            .select("uid", "did", "digest", F.coalesce("keep_uid", "local_uid").alias("keep_uid"), F.coalesce("keep_did", "local_did").alias("keep_did")))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    groups = staged(exact_groups(docs), "exact-groups")
    # A table of its own, so that the join's large groups can be split.
    sizes = staged(groups.groupBy("keep_uid").agg(F.count(F.lit(1)).alias("group_size")), "exact-sizes")
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return groups.join(sizes, "keep_uid").select(
        real("did").alias("doc_id"), real("keep_did").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("digest").alias("text_sha256"))


def kept_documents(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """The rows that stay, with all their columns."""
    groups = staged(exact_groups(docs, digest), "exact-groups")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    stays = F.col("uid") == F.col("keep_uid")
    # Rows are told apart by id and text; only repeated rows share both.
    by_row = groups.groupBy("did", "keep_uid").agg(F.max(stays.cast("int")).alias("stays"), F.count(F.lit(1)).alias("n"), F.first("digest").alias("digest"))
    c_key, c_text, c_did, c_digest, c_read, c_n = unused(docs, "__key", "__text", "__did", "__digest", "__read", "__n")
    gone = staged(by_row.where("stays = 0").select(F.col("did").alias(c_did), F.col("digest").alias(c_digest)), "exact-gone")
    again = staged(by_row.where("stays = 1 and n > 1").select("did"), "exact-repeated")
    rows = docs.withColumns({c_key: key, c_text: digest(normalised())})
    left = rows.join(gone, (F.col(c_key) == F.col(c_did)) & (F.col(c_text) == F.col(c_digest)), "left_anti")
    if not again.isEmpty():
        # Of rows with the same id and text the first one stays.
        first = Window.partitionBy(c_key, c_text).orderBy(c_read)
        left = left.withColumn(c_read, F.monotonically_increasing_id()).withColumn(c_n, F.row_number().over(first)).where(F.col(c_n) == 1)
    return left.select([F.col(c) for c in docs.columns])
