"""Operator 11: near duplicates by a chosen-path set similarity join.

Documents with equal shingle sets become one set. Each set gets ``TOKENS``
minwise tokens: two sets of similarity J share each with probability J.

1. *Branching.* A tree's root chooses ``BRANCHES`` of the tokens, and every set
   goes along the paths of its own values there: sets that agree in one meet
   in a node. Nodes of several sets choose further tokens and branch again.
   With two branches a linked pair (J >= 0.8) shares a path at every depth with
   probability 0.9375 or more, and ``TREES`` independent trees miss it with
   less than 2e-5 (3e-6 where its nodes of the first level are small, as nearly
   all are). Unrelated sets share no token and part at once. Nodes of up to
   ``NODE`` sets branch further within one task, larger ones across tasks.
2. *Dense nodes.* Sets that are all alike never part. Where many
   members of a node agree with one of them, that one is compared with
   the whole node: those that agree are one group, whose own pairs need no
   look any more. A node that is one group is done; few others are compared
   with all; else the node branches.
3. *Small nodes* (``SMALL`` sets) are compared exhaustively, by their
   tokens. The groups that agree well enough (5 standard deviations below the
   threshold) are confirmed on the full sets, exhaustively but for pairs
   already linked to one group. A group that several nodes and trees find is
   confirmed once.
4. Groups beyond ``CAP`` sets or ``WEIGHT`` shingles, and nodes beyond
   ``NODE`` sets, are taken apart across tasks in the same way: dense members
   are compared on full sets with all others, in salted portions; the few sets
   left meet the rest portion by portion; else the node branches. After
   ``LEVELS`` levels what is still large is compared block by block: nothing is
   capped, the sizes say how a node is treated, not what is found.
5. The links' connected components give the groups; no node emits all pairs.

Sets are compared by 64-bit hashes of their shingles. Defined results: null and
empty texts have no shingles and link with nothing; fewer words than a
shingle's are one shingle; rows of one ``doc_id`` with different texts are
documents of their own; rows without ``doc_id`` link like others but give no
name to a component (null if it has no other) and stay only there; repeated rows give repeated
results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nimbus.llm.common import NO_ID, doc_rows, key_to_id, prepare, shuffle_parts, staged
from nimbus.llm.components import components
from nimbus.llm.words import NON_SPACE, Words, groups, mix, rolling

SHINGLE = 4
PERCENT = 80         # links: 100 * intersection >= PERCENT * union
TREES = 4
BRANCHES = 2
TOKENS = 256
NODE = 20_000        # sets whose node branches within one task
SMALL = 300          # sets compared exhaustively
CAP = 5_000          # sets confirmed in one task, and their shingles
WEIGHT = 2_000_000
LEVELS = 6           # of nodes across tasks
DEPTH = 12           # of nodes within a task
SAMPLE = 48          # members of a large node among which dense ones are sought
PIVOTS = 2
_ODD = np.random.Generator(np.random.PCG64(7)).integers(1, 2 ** 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, BRANCHES + 1, dtype=np.uint64) * _STEP


# ---------------------------------------------------------------- sets and tokens

def shingles(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of each text's shingles."""
    w = Words(texts, NON_SPACE, lower=True)
    whole = rolling(w.hash, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        else:
            out.append(mix(rolling(w.hash[a:b], b - a) + np.uint64(b - a)) if b > a else whole[:0])
    return out


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens of each set (not empty): a row of ``TOKENS`` values."""
    out = np.empty((len(sets), TOKENS), np.uint64)
    if sets:
        every, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
        for t in range(TOKENS):
            out[:, t] = np.minimum.reduceat(every * _ODD[t], starts)
    return out


def least_agreement(percent: int) -> int:
    """Tokens that two linked sets share, but for 5 standard deviations."""
    j = percent / 100
    return int(TOKENS * j - 5 * (TOKENS * j * (1 - j)) ** 0.5)


def _describe(docs: DataFrame) -> DataFrame:
    """``did, rk, n, set_id, sketch, paths`` of every row: 8 bits of each
    minwise token, and the paths from the roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = np.arange(TREES * BRANCHES)
        for part in groups((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), 2):
            found = shingles([r[2] for r in part])
            some = [i for i, h in enumerate(found) if len(h)]
            tokens = minwise([found[i] for i in some])
            sketch, paths = [None] * len(part), [None] * len(part)
            low = mix(tokens).astype(np.uint8)
            node = mix(tokens[:, roots] ^ ((roots.astype(np.uint64) + np.uint64(1)) * _STEP)).view(np.int64)
            for k, i in enumerate(some):
                sketch[i], paths[i] = low[k].tobytes(), node[k]
            ids = [np.array([mix(h).sum(), mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64).tobytes() for h in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array([len(h) for h in found], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(sketch, pa.binary()), pa.array(paths, pa.list_(pa.int64()))], ["did", "rk", "n", "set_id", "sketch", "paths"])

    return docs.mapInArrow(run, "did long, rk long, n long, set_id binary, sketch binary, paths array<long>")


def _sketches(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, TOKENS)


# ---------------------------------------------------------------- nodes

def _nodes(entries: DataFrame) -> DataFrame:
    """``node, id, n, size, weight`` of the nodes of ``entries`` (node, id, n,
    label) that hold several labels; of nodes with the same sets one."""
    of = entries.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.bit_xor(F.xxhash64("id")).alias("same"),
                                     F.min("id").alias("least"), F.min("label").alias("low"), F.max("label").alias("high"))
    kept = of.where(F.col("low") != F.col("high")).groupBy("size", "weight", "same", "least").agg(F.min("node").alias("node"))
    # A table of its own, so that large nodes are split in the join.
    return staged(entries.select("node", "id", "n").join(staged(kept.select("node", "size", "weight"), "path-nodes"), "node"), "path-members")


def children(node: np.ndarray, tokens: np.ndarray) -> Iterator[np.ndarray]:
    """For each branch the nodes that the sets (rows of ``tokens``) go to. A
    node (64 bits) chooses tokens of its own, the branches different ones."""
    first, rows = TREES * BRANCHES, np.arange(len(tokens))
    for k in range(BRANCHES):
        at = first + ((mix(node) % np.uint64(TOKENS - first)).astype(np.int64) + k * ((TOKENS - first) // BRANCHES)) % (TOKENS - first)
        yield mix(mix(node + _STEPS[k]) ^ tokens[rows, at].astype(np.uint64))


def _branch(members: DataFrame) -> DataFrame:
    """``node, id, n, label`` one level down; ``members``: node, id, n, label, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            for child in children(b["node"].to_numpy().view(np.uint64), _sketches(b["sketch"].to_pylist())):
                child = child.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(child), b["id"], b["n"], b["label"]], ["node", "id", "n", "label"])

    return members.select("node", "id", "n", "label", "sketch").mapInArrow(run, "node long, id long, n long, label long")


def _blocks(members: DataFrame) -> DataFrame:
    """Nodes that stay large: each pair of blocks is a group to confirm."""
    half = CAP // 2
    blocks = F.greatest(F.ceil(F.col("size") / half), F.ceil(2 * F.col("weight") / WEIGHT)).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("leaf"), "id")


# ---------------------------------------------------------------- dense nodes

def _pivots(big: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, pivot``: members with which a quarter of a sample agrees."""
    order = Window.partitionBy("node").orderBy(F.xxhash64("id", "node"), "id")
    sample = big.select("node", "id").withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE).join(sets.select("id", "sketch"), "id").select("node", "id", "sketch")
    least = least_agreement(percent)

    def choose(node: pa.Table) -> pa.Table:
        ids, tokens = node["id"].to_numpy(), _sketches(node["sketch"].to_pylist())
        order = np.argsort(ids)
        ids, tokens = ids[order], tokens[order]
        near = (tokens[:, None, :] == tokens[None, :, :]).sum(axis=2) >= least
        out, free = [], np.ones(len(ids), bool)
        while len(out) < PIVOTS:
            many = (near & free[None, :]).sum(axis=1)
            best = int(np.argmax(many))
            if 4 * many[best] < len(ids) or many[best] < 2:
                break
            out.append(int(ids[best]))
            free &= ~near[best]
        return pa.table({"node": pa.array([node["node"][0].as_py()] * len(out), pa.int64()), "pivot": pa.array(out, pa.int64())})

    return sample.groupBy("node").applyInArrow(choose, "node long, pivot long")


def _agreeing(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``pivot, id``) whose tokens agree well enough."""
    least = least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = (_sketches(b["sketch"].to_pylist()) == _sketches(b["of_pivot"].to_pylist())).sum(axis=1) >= least
                yield b.select(["pivot", "id"]).filter(pa.array(near))

    of_pivot = sets.select(F.col("id").alias("pivot"), F.col("sketch").alias("of_pivot"))
    return pairs.join(sets.select("id", "sketch"), "id").join(of_pivot, "pivot").select("pivot", "id", "sketch", "of_pivot").mapInArrow(run, "pivot long, id long")


def _to_pivots(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` among ``pivot, id``, by the full sets. The sets are dealt
    out by pivot and salt, and the pivot to every salt."""
    salts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / CAP).cast("int").alias("salts"))
    member = (pairs.join(salts, "pivot").select("pivot", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), "id").join(texts, "id")
              .select("pivot", "salt", F.lit(1).alias("kind"), "id", "text"))
    centre = (salts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("id", F.col("pivot")).join(texts, "id")
              .select("pivot", "salt", F.lit(0).alias("kind"), "id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, np.empty(0, np.uint64)
        for part in groups((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), 4):
            a, b = [], []
            for (pivot, salt, kind, i, _), h in zip(part, shingles([r[4] for r in part]), strict=True):
                if kind == 0:
                    at, centre = (pivot, salt), h
                    continue
                assert at == (pivot, salt)
                both = int(np.isin(h, centre, assume_unique=True).sum())
                if 100 * both >= percent * (len(h) + len(centre) - both):
                    a.append(i)
                    b.append(pivot)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = member.unionByName(centre).repartition(4 * shuffle_parts(pairs.sparkSession), "pivot", "salt").sortWithinPartitions("pivot", "salt", "kind")
    return dealt.mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- small nodes

def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column (sorted by it)."""
    held = []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and held[0][0] != r[0]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


class Agreeing:
    """Groups of sets joined by good agreement of tokens and size: a node's
    further branching within one task."""

    def __init__(self, n: np.ndarray, tokens: np.ndarray, percent: int):
        self.n, self.tokens, self.percent, self.least = n, tokens, percent, least_agreement(percent)
        self.parent = list(range(len(n)))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def near(self, x: int, others: np.ndarray) -> np.ndarray:
        agree = (self.tokens[others] == self.tokens[x]).sum(axis=1) >= self.least
        return agree & (100 * self.n[others] >= self.percent * self.n[x]) & (100 * self.n[x] >= self.percent * self.n[others])

    def join(self, x: int, others: np.ndarray) -> None:
        a = self.find(x)
        for i in others.tolist():
            b = self.find(i)
            if a != b:
                a, b = min(a, b), max(a, b)
                self.parent[b] = a

    def small(self, members: np.ndarray) -> None:
        """Each set that is reached is compared with all not yet reached."""
        while len(members):
            todo, members = [members[0]], members[1:]
            while todo and len(members):
                x = todo.pop()
                near = self.near(x, members)
                self.join(x, members[near])
                todo += members[near].tolist()
                members = members[~near]

    def groups(self, node: int) -> list[np.ndarray]:
        """The groups (places) of all sets, which are those of ``node``."""
        stack = [(np.uint64(node), np.arange(len(self.n)), 0)]
        while stack:
            node, members, depth = stack.pop()
            if len(members) <= SMALL or depth == DEPTH:
                self.small(members)
                continue
            pivot = int(members[int(mix(np.array([node + np.uint64(depth)]))[0] % np.uint64(len(members)))])
            near = self.near(pivot, members)
            if 4 * near.sum() >= len(members):  # dense
                self.join(pivot, members[near])
                rest = members[~near]
                if len(rest) <= SMALL:
                    for x in rest.tolist():
                        self.join(x, members[self.near(x, members)])
                    continue
            for child in children(np.full(len(members), node), self.tokens[members]):
                order = np.argsort(child, kind="stable")
                ends = np.flatnonzero(np.diff(child[order])) + 1
                for part in np.split(order, ends):
                    if len(part) > 1 and len({self.find(i) for i in members[part].tolist()}) > 1:
                        stack.append((child[part[0]], members[part], depth + 1))
        root = np.array([self.find(i) for i in range(len(self.n))])
        order = np.argsort(root, kind="stable")
        return [g for g in np.split(order, np.flatnonzero(np.diff(root[order])) + 1) if len(g) > 1]


def _candidates(leaves: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``gid, id, n, size, weight``: the groups that agree within a node
    (``leaf, id``); a group found in several nodes has one gid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            rows = list({r[1]: r for r in rows}.values())
            ids, n, tokens = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), _sketches([r[3] for r in rows])
            for g in Agreeing(n, tokens, percent).groups(rows[0][0] % (1 << 64)):
                gid = mix(np.array([mix(ids[g].view(np.uint64)).sum()], np.uint64) + np.uint64(len(g)))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(gid.view(np.int64), len(g))), pa.array(ids[g]), pa.array(n[g]), pa.array(np.full(len(g), len(g))), pa.array(np.full(len(g), n[g].sum()))], ["gid", "id", "n", "size", "weight"])

    dealt = leaves.join(sets.select("id", "n", "sketch"), "id").select("leaf", "id", "n", "sketch").repartition(4 * shuffle_parts(leaves.sparkSession), "leaf").sortWithinPartitions("leaf")
    return dealt.mapInArrow(run, "gid long, id long, n long, size long, weight long").distinct()


def confirmed(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join ``sets`` (their places) to their groups: every pair is
    compared on the full sets, but for those already in one group."""
    size = np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mark, label, links = np.zeros(int(codes.max()) + 1, bool), np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        rest = label != label[i]
        rest[:i] = False
        if not rest.any():
            continue
        mark[codes[starts[i]:starts[i] + size[i]]] = True
        both = np.add.reduceat(mark[codes], starts, dtype=np.int64)
        mark[codes[starts[i]:starts[i] + size[i]]] = False
        near = np.flatnonzero(rest & (100 * both >= percent * (size + size[i] - both)))
        links += [(i, j) for j in near.tolist()]
        label[np.isin(label, label[near])] = label[i]
    return links


def _confirm(found: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of the candidate groups, by the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            sets = [h for part in groups(((r[2],) for r in rows), 0) for h in shingles([x[0] for x in part])]
            if links := confirmed(sets, percent):
                yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i, _ in links], pa.int64()), pa.array([rows[j][1] for _, j in links], pa.int64())], ["a", "b"])

    dealt = found.join(texts, "id").select("gid", "id", "text").repartition(4 * shuffle_parts(found.sparkSession), "gid").sortWithinPartitions("gid")
    return dealt.mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- the join

def _dense(big: DataFrame, sets: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One step for large nodes: links to their pivots, the leaves in which the
    few others meet the largest group, and the members of nodes that branch."""
    pairs = big.select("node", "id").join(_pivots(big, sets, percent), "node").where("id != pivot").select("pivot", "id").distinct()
    found = staged(_to_pivots(staged(_agreeing(pairs, sets, percent), "path-pairs"), texts, percent), "path-links")
    label = components(found).select(F.col("node").alias("id"), F.col("component").alias("label"))
    told = staged(big.join(label, "id", "left").withColumn("label", F.coalesce("label", "id")), "path-labels")
    of = told.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    top = of.groupBy("node").agg(F.max_by(F.struct("label", "c", "w"), F.struct("c", "label")).alias("top"), F.sum("c").alias("size"), F.sum("w").alias("weight"))
    few = F.col("size") - F.col("top.c"), F.col("weight") - F.col("top.w")
    half, half_weight = CAP // 2, WEIGHT // 2
    kind = F.when(few[0] == 0, "done").when((few[0] <= half) & (few[1] <= half_weight), "few").otherwise("many")
    portions = F.greatest(F.ceil(F.col("top.c") / half), F.ceil(F.col("top.w") / half_weight)).cast("int")
    plan = staged(top.select("node", F.col("top.label").alias("main"), portions.alias("portions"), kind.alias("kind")), "path-plan")
    cut = told.join(plan.where("kind = 'few'"), "node")
    own = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("id", F.lit(3)), F.col("portions")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("portions") - 1))
    leaves = cut.withColumn("portion", F.explode(own)).select(F.xxhash64("node", "portion").alias("leaf"), "id")
    return found, leaves, told.join(plan.where("kind = 'many'").select("node"), "node")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``did, rk, n, component``: every row, the size of its set and the
    smallest doc_id that its links reach."""
    spark = docs.sparkSession
    prepare(spark)
    rows = doc_rows(docs).select("did", "rk", F.col("text").cast("binary").alias("text"))
    described = staged(_describe(rows), "path-rows")
    least = F.min(F.when(F.col("did") != NO_ID, F.col("did")))
    sets = staged(described.where("n > 0").groupBy("set_id").agg(least.alias("least"), F.min(F.struct("did", "rk")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))
                  .select(F.monotonically_increasing_id().alias("id"), "set_id", "least", "rep", "n", "sketch", "paths"), "path-sets")
    open_ = _nodes(sets.select(F.explode("paths").alias("node"), "id", "n", F.col("id").alias("label")))
    near = (F.col("size") <= CAP) & ((F.col("weight") <= WEIGHT) | (F.col("size") <= 2))
    within = F.col("size") <= NODE
    found = staged(_candidates(open_.where(within).select(F.col("node").alias("leaf"), "id"), sets, percent), "path-groups")
    # Only sets in a group that agrees, or in a node too large for a task, need their text from here on.
    wide = staged(open_.where(~within).select("node", "id", "n", "size", "weight").unionByName(found.where(~near).withColumnRenamed("gid", "node")), "path-wide")
    wanted = found.select("id").unionByName(wide.select("id")).distinct().join(sets.select("id", "rep.did", "rep.rk"), "id")
    # Merged at every size: what is moved then grows with the input.
    texts = staged(rows.join(staged(wanted, "path-wanted").hint("merge"), ["did", "rk"]).select("id", "text").dropDuplicates(["id"]), "path-texts")
    ready, links = [found.where(near).select("gid", "id")], []
    if not wide.isEmpty():
        some = staged(sets.select("id", "n", "sketch").join(wide.select("id").distinct(), "id"), "path-wide-sets")
        for level in range(LEVELS + 1):
            if level == LEVELS:
                ready.append(_blocks(wide).withColumnRenamed("leaf", "gid"))
                break
            to_pivots, few, many = _dense(wide, some, texts, percent)
            links.append(to_pivots)
            ready.append(few.withColumnRenamed("leaf", "gid"))
            deeper = _nodes(_branch(many.join(some.select("id", "sketch"), "id")))
            found = staged(_candidates(deeper.where(within).select(F.col("node").alias("leaf"), "id"), some, percent), "path-groups")
            ready.append(found.where(near).select("gid", "id"))
            wide = staged(deeper.where(~within).select("node", "id", "n", "size", "weight").unionByName(found.where(~near).withColumnRenamed("gid", "node")), "path-wide")
            if wide.isEmpty():
                break
    every = ready[0]
    for x in ready[1:]:
        every = every.unionByName(x)
    pairs = staged(_confirm(every, texts, percent), "path-links")
    for x in links:
        pairs = pairs.unionByName(x)
    graph = staged(components(pairs).join(sets.select(F.col("id").alias("node"), "set_id", "least"), "node"), "path-graph")
    # The name of a component may be null: it has no doc_id.
    names = graph.groupBy("component").agg(F.min("least").alias("name"))
    linked = graph.join(names, "component").select("set_id", F.lit(True).alias("linked"), "name")
    own = sets.select("set_id", "least").join(linked, "set_id", "left").select("set_id", F.when(F.col("linked"), F.col("name")).otherwise(F.col("least")).alias("component"))
    return described.select("did", "rk", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(own, "set_id", "left").select(
        "did", "rk", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(key_to_id(F.col("did"))).alias("component"))


def report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    kept = F.coalesce(F.col("did") == F.col("component"), F.lit(False)) & (F.col("did") != NO_ID) | F.col("component").isNull()
    return found.select(key_to_id(F.col("did")).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))
