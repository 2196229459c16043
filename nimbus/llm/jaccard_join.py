"""Operator 5: exact Jaccard self-join of word shingles in metric space.

d(x, y) = 1 - J(x, y) is a metric; two documents link within ``r`` = 1 - t.

1. Documents with the same shingle set become one set, numbered on its own:
   a ``doc_id`` only orders and names components.
2. *Regions.* In any common order (here: longest first, as long shingles are
   rare) the first ``n - ceil(t n) + m`` shingles of a set hold the m smallest
   ones it shares with a linked set. So with ``m = 1 + n // EXTRA`` two linked
   sets share several of theirs, and a set most of whose first shingles no
   other set has there has no links at all. The sets left that hold a shingle
   there form the region of the smallest of them: two linked sets always meet
   in one, and most regions are small families. A set that meets others in
   R regions keeps those in which it holds at least an Rth of the shingles a
   linked set must share with it: the shared ones lie in at most R regions, so
   one region of both sets has that many.
3. *Common shingles.* Where more than ``CAP`` sets hold a shingle, these sets
   (and only these) take part again, with such shingles last in the order.
   What remains common then belongs to sets made of common shingles.
4. *Pivots.* A region of more than ``CAP`` sets gets a few pivots, the densest
   of its sets. Each set goes to the Voronoi region of its nearest pivot and,
   by the triangle inequality, to every pivot not more than 2r farther (the
   boundary). A set within r of the pivot is linked to it. Sets nearer to the
   pivot than the nearest unlinked one by more than r need no look any more,
   and a region whose sets are all linked to its pivot is done. A few unlinked
   sets meet the linked ones portion by portion; else the rest is a smaller
   region, and the step is repeated. Where sets stay as close to the
   boundary as before, the region is cut into blocks and each pair of blocks
   is a region.
5. Regions of at most ``CAP`` sets are joined in one task each, recursively by
   the same rules, giving a spanning forest of their links, never all pairs.
6. The forest's connected components give the groups.

Nothing is capped: ``CAP`` says how a region is treated, not what is found.

Defined results: null and empty texts have no shingles and link with nothing,
as their own component; fewer words than a shingle's are one shingle; rows
without ``doc_id`` get no component and link with nothing; rows of the same
``doc_id`` are in one component, whatever their texts (each text has its own
links); extra columns are ignored; an empty table gives no rows. Sets are
compared by 64-bit hashes of their shingles, and equal sets found by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nimbus.llm.common import NO_ID, doc_rows, id_key, key_to_id, prepare, shuffle_parts, staged, unused
from nimbus.llm.components import components
from nimbus.llm.words import NON_SPACE, Words, groups, mix, rolling

SHINGLE = 4
PERCENT = 85           # links: 100 * intersection >= PERCENT * union
CAP = 800              # sets joined in one task
COMMON_KEYS = 200_000  # common shingles put last in the order, at most
PIVOTS = 4
SAMPLE = 48            # densest sets, among which pivots are chosen
ROUNDS = 3
EXTRA = 8              # prefixes hold one shared shingle more for so many in the set


# ---------------------------------------------------------------- shingles

def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its set (sorted hashes) and their keys of order: the
    longest shingles first, then by hash. The length is that of the words:
    white space between them must not tell equal shingles apart."""
    w = Words(texts, NON_SPACE, lower=True)
    whole = rolling(w.hash, size)
    upto = np.concatenate([[0], np.cumsum(w.end - w.start)])
    for i in range(len(texts)):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= size:
            h = whole[a:b - size + 1]
            length = upto[a + size:b + 1] - upto[a:b - size + 1]
        elif b > a:
            h = mix(rolling(w.hash[a:b], b - a) + np.uint64(b - a))
            length = upto[b:b + 1] - upto[a:a + 1]
        else:
            yield np.empty(0, np.uint64), np.empty(0, np.uint64)
            continue
        h, at = np.unique(h, return_index=True)
        rare = (255 - np.minimum(length[at], 255)).astype(np.uint64)
        yield h, (rare << np.uint64(56)) | (h >> np.uint64(8))


def prefix(keys: np.ndarray, percent: int, last: np.ndarray | None = None) -> np.ndarray:
    """The first keys of the order, as many as hold ``1 + n // EXTRA`` of those
    shared with any linked set; ``last``: sorted keys put at the order's end."""
    n = len(keys)
    take = n - -(-percent * n // 100) + 1 + n // EXTRA if n else 0
    if last is None or not len(last):
        return np.sort(np.partition(keys, take - 1)[:take]) if 0 < take < n else np.sort(keys)
    keys = np.sort(keys)
    behind = np.isin(keys, last)
    return np.concatenate([keys[~behind], keys[behind]])[:take]


def _describe(docs: DataFrame, percent: int) -> DataFrame:
    """``did, rk, n, set_id, prefix`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), 2):
            n, ids, first = [], [], []
            for h, keys in shingle_sets([r[2] for r in part]):
                n.append(len(h))
                ids.append(np.array([mix(h).sum(), mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64).tobytes())
                first.append(prefix(keys, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(first, pa.list_(pa.int64()))], ["did", "rk", "n", "set_id", "prefix"])

    return docs.mapInArrow(run, "did long, rk long, n long, set_id binary, prefix array<long>")


def _keys(sets: DataFrame, last: np.ndarray | None, percent: int) -> DataFrame:
    """``key, id, n`` of ``sets`` (id, text): their prefixes with ``last`` at
    the end of the order, or without ``last`` all their shingles."""
    # At most COMMON_KEYS numbers.
    shared = sets.sparkSession.sparkContext.broadcast(None if last is None else np.sort(last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), 1):
            found = [(keys if shared.value is None else prefix(keys, percent, shared.value), len(keys)) for _, keys in shingle_sets([r[1] for r in part])]
            many = [len(f) for f, _ in found]
            ids, n = np.repeat(np.array([r[0] for r in part], np.int64), many), np.repeat(np.array([n for _, n in found], np.int64), many)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f for f, _ in found]).view(np.int64)), pa.array(ids), pa.array(n)], ["key", "id", "n"])

    # Dealt out anew: the sets concerned may all stand in a few files.
    dealt = sets.select("id", "text").repartition(4 * shuffle_parts(sets.sparkSession), "id")
    return dealt.mapInArrow(run, "key long, id long, n long")


# ---------------------------------------------------------------- one region

def overlaps(mark: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(mark[codes].astype(np.int64), starts)


class Region:
    """Exact join of a region's sets: links of a spanning forest."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sets = sets
        self.parent = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def join(self) -> list[tuple[int, int]]:
        todo = [np.array([i for i, s in enumerate(self.sets) if len(s)])]
        while todo:
            todo += self._step(todo.pop())
        return self.links

    def _step(self, members: np.ndarray) -> list[np.ndarray]:
        """Link one pivot; what is left, in parts that have no links between them."""
        while True:
            if len(members) < 2 or len({self.find(i) for i in members.tolist()}) < 2:
                return []
            size = np.array([len(self.sets[i]) for i in members])
            starts = np.cumsum(size) - size
            _, codes, count = np.unique(np.concatenate([self.sets[i] for i in members]), return_inverse=True, return_counts=True)
            # A set needs percent of its shingles in other sets of the region.
            common = np.add.reduceat((count[codes] > 1).astype(np.int64), starts)
            able = 100 * common >= self.percent * size
            if able.all():
                break
            members = members[able]
        mark = np.zeros(len(count), bool)
        density = np.add.reduceat(count[codes], starts) / size
        rest = np.ones(len(members), bool)
        r = 1 - self.percent / 100
        while True:
            p = int(np.argmax(np.where(rest, density, -1)))
            mark[:] = False
            mark[codes[starts[p]:starts[p] + size[p]]] = True
            both = overlaps(mark, codes, starts)
            union = size + size[p] - both
            near = 100 * both >= self.percent * union
            rest[p] = False
            for i in np.flatnonzero(near & rest):
                self.link(int(members[p]), int(members[i]))
            left = np.flatnonzero(rest)
            if len(left) < 2 or len({self.find(i) for i in members[left].tolist()}) < 2:
                return []
            d = 1 - both / union
            # Sets closer to the pivot than any unlinked set by more than r have no open links.
            if (far := left[~near[left]]).size:
                left = left[d[left] >= d[far].min() - r - 1e-9]
            else:
                return []
            rest[:] = False
            rest[left] = True
            # No link crosses a gap wider than r in the distances to one pivot.
            order = left[np.argsort(d[left])]
            gaps = np.flatnonzero(np.diff(d[order]) > r + 1e-9)
            if len(gaps):
                return [members[part] for part in np.split(order, gaps + 1)]


def _join_regions(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links found in regions (``region, id``) of at most CAP sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids: dict[int, bytes]) -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            names = sorted(ids)
            sets = [h for part in groups(((ids[i],) for i in names), 0) for h, _ in shingle_sets([x[0] for x in part])]
            return [(names[i], names[j]) for i, j in Region(sets, percent).join()]

        at, held, links = None, {}, []
        for b in batches:
            for region, i, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if region != at:
                    links += out(held)
                    at, held = region, {}
                held[i] = text
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])
                links = []
        if links := out(held):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])

    dealt = members.join(sets, "id").select("region", "id", "text").repartition(4 * shuffle_parts(members.sparkSession), "region").sortWithinPartitions("region")
    return dealt.mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- large regions

def _pivots(big: DataFrame, sets: DataFrame) -> DataFrame:
    """``region, pivot, text``: the densest sets of each region, as far as
    their keys tell, and of these the densest by all their shingles."""
    order = Window.partitionBy("region").orderBy(F.desc_nulls_last("density"), F.xxhash64("id", "region"), "id")
    sample = big.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE).select("region", "id").join(sets, "id")

    def choose(region: pa.Table) -> pa.Table:
        ids, texts = region["id"].to_pylist(), region["text"].to_pylist()
        found = [h for h, _ in shingle_sets(texts)]
        _, codes, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        size = np.array([len(h) for h in found])
        density = np.add.reduceat(count[codes], np.cumsum(size) - size) / size
        best = sorted(range(len(ids)), key=lambda i: (-density[i], ids[i]))[:PIVOTS]
        return pa.table({"region": pa.array([region["region"][0].as_py()] * len(best), pa.string()), "pivot": pa.array([ids[i] for i in best], pa.int64()), "text": pa.array([texts[i] for i in best], pa.binary())})

    return sample.select("region", "id", "text").groupBy("region").applyInArrow(choose, "region string, pivot long, text binary")


def _distances(big: DataFrame, sets: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """``region, id, pivot, d, near`` of every member to its region's pivots.
    Members are dealt out by region and salt, and the pivots to every salt."""
    sizes = big.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / CAP).cast("int").alias("salts"))
    member = (big.join(sizes, "region").select("region", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), "id").join(sets, "id")
              .select("region", "salt", F.lit(1).alias("kind"), "id", "text"))
    centre = (pivots.join(sizes, "region").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .select("region", "salt", F.lit(0).alias("kind"), F.col("pivot").alias("id"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centres = None, []
        for b in batches:
            out = []
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for (region, salt, kind, i, _), (h, _) in zip(rows, (x for part in groups(((r[4],) for r in rows), 0) for x in shingle_sets([y[0] for y in part])), strict=True):
                if (region, salt) != at:
                    at, centres = (region, salt), []
                if kind == 0:
                    centres.append((i, h))
                    continue
                for pivot, c in centres:
                    both = int(np.isin(h, c, assume_unique=True).sum())
                    union = len(h) + len(c) - both
                    out.append((region, i, pivot, 1 - both / union, 100 * both >= percent * union))
            if out:
                cols, types = list(zip(*out, strict=True)), [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["region", "id", "pivot", "d", "near"])

    dealt = member.unionByName(centre).repartition(4 * shuffle_parts(big.sparkSession), "region", "salt").sortWithinPartitions("region", "salt", "kind")
    return dealt.mapInArrow(run, "region string, id long, pivot long, d double, near boolean")


def _split(big: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """One round for large regions: links to the pivots, and what is left as
    ``region, id`` of the pivots' regions."""
    r = 1 - percent / 100
    seen = staged(_distances(big, sets, _pivots(big, sets), percent), "pivot-distances")
    links = seen.where("near and id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    home = F.min("d").over(Window.partitionBy("region", "id"))
    dealt = seen.withColumn("home", home).where(F.col("id") != F.col("pivot")).where(F.col("d") <= F.col("home") + (2 * r + 1e-9))
    # Of each pivot's region: the sets that are not linked to it, and how near the nearest one is.
    open_ = dealt.where(~F.col("near")).groupBy("region", "pivot").agg(F.min("d").alias("open"), F.count(F.lit(1)).alias("n_open"))
    left = staged(dealt.join(open_, ["region", "pivot"]).where(F.col("d") >= F.col("open") - (r + 1e-9)), "pivot-left")
    # Sets linked to the pivot are in one group, so no two of them need a look: where few
    # are not, these meet the others portion by portion.
    half = CAP // 2
    portions = left.where(F.col("near") & (F.col("n_open") <= half)).groupBy("region", "pivot").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("portions"))
    cut = left.join(portions, ["region", "pivot"], "left").withColumn("portions", F.coalesce("portions", F.lit(1)))
    own = F.when(F.col("near"), F.array(F.pmod(F.xxhash64("id", F.lit(3)), F.col("portions")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("portions") - 1))
    parts = cut.select("region", "pivot", "id", F.explode(own).alias("portion"))
    return links, parts.select(F.concat_ws("/", "region", F.col("pivot").cast("string"), F.col("portion").cast("string")).alias("region"), "id")


def _blocks(big: DataFrame) -> DataFrame:
    """Regions that pivots do not divide: each pair of blocks is a region."""
    sizes = big.groupBy("region").agg(F.ceil(F.count(F.lit(1)) * 2 / CAP).cast("int").alias("blocks"))
    own = big.join(sizes, "region").withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(F.concat_ws("/", "region", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string")).alias("region"), "id")


# ---------------------------------------------------------------- the join

def _shared(rows: DataFrame) -> DataFrame:
    """``key, holders, leader`` of keys that several sets hold: a table of its
    own, so that the skewed keys of a join with it can be split."""
    return staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("holders"), F.min("id").alias("leader")).where("holders > 1"), "jaccard-shared")


def _need(percent: int) -> Column:
    """Prefix keys that a set shares with any linked set (which has at least
    ``t n`` shingles), at least."""
    return (1 + F.floor(F.ceil(F.lit(percent) * F.col("n") / 100) / EXTRA)).cast("long")


def _able(rows: DataFrame, need: Column) -> DataFrame:
    """Ids of the sets that hold ``need`` shared keys or more among ``rows``."""
    held = rows.join(_shared(rows).select("key"), "key", "left_semi")
    return staged(held.groupBy("id", "n").agg(F.count(F.lit(1)).alias("keys")).where(F.col("keys") >= need).select("id"), "jaccard-able")


def _met(rows: DataFrame, percent: int, cap: int) -> tuple[DataFrame, DataFrame]:
    """The prefix rows (``key, id, n``) whose key several sets hold (``key, id,
    common, leader``), and the regions that the sets are members of (``id,
    common, leader``), with the mean number of holders of a set's keys
    (``density``)."""
    met = staged(rows.join(_shared(rows), "key").select("key", "id", (F.col("holders") > cap).alias("common"), "leader", "holders", _need(percent).alias("need")), "jaccard-met")
    of = met.groupBy("id", "common", "leader").agg(F.count(F.lit(1)).alias("keys"), F.max("need").alias("need"), F.sum("holders").alias("holders"))
    one = Window.partitionBy("id")
    of = of.withColumns({"regions": F.count(F.lit(1)).over(one), "density": F.sum("holders").over(one) / F.sum("keys").over(one)})
    return met, staged(of.where(F.col("keys") * F.col("regions") >= F.col("need")).select("id", "common", "leader", "density"), "jaccard-members")


def links(docs: DataFrame, percent: int = PERCENT, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """The described rows (did, rk, n, id; id: the number of the row's set, NULL
    for rows that have none or no ``doc_id``) and the links ``a, b`` between
    sets."""
    spark = docs.sparkSession
    prepare(spark)
    texts = doc_rows(docs).select("did", "rk", F.col("text").cast("binary").alias("text"))
    rows = staged(_describe(texts, percent), "jaccard-rows")
    usable = rows.where((F.col("n") > 0) & (F.col("did") != NO_ID))
    reps = staged(usable.groupBy("set_id").agg(F.min(F.struct("did", "rk")).alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
                  .select("set_id", F.monotonically_increasing_id().alias("id"), F.col("rep.did").alias("did"), F.col("rep.rk").alias("rk"), "n", "prefix"), "jaccard-sets")
    prefixes = reps.select(F.explode("prefix").alias("key"), "id", "n")
    able = _able(prefixes, _need(percent))
    # The texts of the sets that may have links, written once.
    wanted = reps.select("id", "did", "rk").join(able, "id")
    # Repeated rows bring the same text again.
    sets = staged(texts.join(wanted, ["did", "rk"]).select("id", "text").dropDuplicates(["id"]), "jaccard-texts")
    # Of a linked set, t of all its shingles stand in other ones: few sets are left to look at.
    able = _able(_keys(sets, None, percent), F.ceil(F.lit(percent) * F.col("n") / 100))
    met, members = _met(prefixes.join(able, "id", "left_semi"), percent, cap)

    def crowded() -> DataFrame:
        return met.where("common").join(members.where("common").select("id").distinct(), "id", "left_semi")

    regions = [members.where("not common").select(F.col("leader").cast("string").alias("region"), "id", "density")]
    last = np.empty(0, np.int64)
    crowd = crowded()
    for round_ in range(ROUNDS):
        room = COMMON_KEYS - len(last)
        fresh = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(room)
        new = np.setdiff1d(np.array([k["key"] for k in fresh.select("key").collect()], np.int64), last) if room > 0 else last[:0]
        if not len(new):
            break
        last = np.concatenate([last, new])
        again = sets.join(crowd.select("id").distinct(), "id", "left_semi")
        keys = staged(_keys(again, last.view(np.uint64), percent), "jaccard-again")
        met, members = _met(keys, percent, cap)
        tag = F.concat_ws(".", F.lit(str(round_)), F.col("leader").cast("string"))
        regions.append(members.where("not common").select(tag.alias("region"), "id", "density"))
        crowd, size = crowded(), keys.select("id").distinct().count()
        if crowd.select("id").distinct().count() > 0.5 * size:
            break  # sets made of common shingles: no order helps further
    regions.append(members.where("common").select(F.concat_ws(".", F.lit("c"), F.col("leader").cast("string")).alias("region"), "id", "density"))

    every = regions[0]
    for x in regions[1:]:
        every = every.unionByName(x)
    open_ = staged(every, "jaccard-regions")
    found, small, before = [], [], None
    while True:
        sizes = open_.groupBy("region").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        sized = open_.join(sizes, "region")
        small.append(sized.where(F.col("members") <= cap).select("region", "id"))
        big = staged(sized.where(F.col("members") > cap).select("region", "id", "density"), "jaccard-big")
        n = big.count()
        if not n:
            break
        if before is not None and n > 0.75 * before:
            small.append(_blocks(big))
            break
        to_pivots, left = _split(big, sets, percent)
        found.append(to_pivots)
        open_, before = staged(left.withColumn("density", F.lit(None).cast("double")), "jaccard-regions"), n
    members = small[0]
    for x in small[1:]:
        members = members.unionByName(x)
    every = _join_regions(members, sets, percent)
    for x in found:
        every = every.unionByName(x)
    of = rows.join(reps.select("set_id", "id"), "set_id", "left")
    return of.select("did", "rk", "n", F.when((F.col("n") > 0) & (F.col("did") != NO_ID), F.col("id")).alias("id")), every


def near_duplicates(docs: DataFrame, percent: int = PERCENT, cap: int = CAP) -> DataFrame:
    """``did, rk, n, component``: every row, the size of its set and the
    smallest doc_id that its links reach."""
    rows, every = links(docs, percent, cap)
    rows = staged(rows, "jaccard-described")
    # Different texts of one id are one document: their sets are linked.
    held = rows.where(F.col("id").isNotNull()).groupBy("did", "id").agg(F.count(F.lit(1)).alias("rows"))
    first = staged(held.groupBy("did").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("sets")).where("sets > 1").select("did", "first"), "jaccard-first")
    own = held.join(first, "did").where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b"))
    graph = staged(components(every.unionByName(own)), "jaccard-graph")
    least = staged(rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("did").alias("least")), "jaccard-least")
    names = least.join(graph.withColumnRenamed("node", "id"), "id").groupBy("component").agg(F.min("least").alias("name"))
    named = least.join(graph.withColumnRenamed("node", "id").join(names, "component").select("id", "name"), "id", "left").select("id", F.coalesce("name", "least").alias("name"))
    return (rows.join(named, "id", "left")
            .select("did", "rk", "n", F.when(F.col("did") != NO_ID, F.coalesce("name", "did")).alias("component")))


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(key_to_id(F.col("did")).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay: of each group the one with the smallest
    ``doc_id``; rows without an id stay."""
    groups_ = near_duplicates(docs, percent)
    c_did, c_key = unused(docs, "__did", "__key")
    gone = staged(groups_.where(F.col("component") != F.col("did")).select(F.col("did").alias(c_did)).distinct(), "near-duplicates")
    return docs.withColumn(c_key, id_key()).join(gone, F.col(c_key) == F.col(c_did), "left_anti").select([F.col(c) for c in docs.columns])
