"""Operator 11 against all pairs, with the cases every text operator has to stand."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbus.llm import chosen_path

CLASHES = ["did", "rk", "id", "node", "label", "n", "size", "component", "set_id", "sketch", "kept"]


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def words_of(t):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower(t)).split(" ") if w]


def shingle_set(t):
    w = words_of(t)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def want(rows):
    """Every pair of rows compared."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]) and (len(sets[j]) > 0):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)), least.get(find(i)) in (d, None)) for i, (d, _) in enumerate(rows)), key=repr)


def corpus():
    rng = random.Random(21)
    prose = lambda n, k=400: [f"w{rng.randrange(k)}" for _ in range(n)]
    out = []

    def copies(base, count, changes):
        for _ in range(count):
            v = list(base)
            for _ in range(rng.randint(0, changes)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(999)}"
            out.append(" ".join(v))

    copies(prose(120), 70, 2)                         # one dense group, larger than a node
    copies(prose(60), 30, 4)                          # links at and around the threshold
    for _ in range(8):
        copies(prose(rng.randint(5, 90)), 4, 1)
    frame = prose(80)                                 # alike, but not linked
    out += [" ".join(frame + prose(30)) for _ in range(30)]
    other = list(frame)
    copies(other + ["y"] * 3, 6, 1)
    chain = prose(200)                                # each links with the next only
    for i in range(12):
        out.append(" ".join(chain))
        chain = chain[12:] + [f"c{i}_{k}" for k in range(12)]
    out += ["", None, " \n\t", "one", "ONE", "one two", "one two three four", "One  two\nthree four", "a b c", "le la " * 3000, "x" * 5000, "É ß 漢 字 👍", "é ß 漢 字 👍"]
    out += [out[3].replace(" ", "  \r\n"), out[5].upper(), out[0], out[0]]
    rows = [(i * 7 % 1009 - 3, t) for i, t in enumerate(out)]
    # No id: alone, with others without one, with ones that have one; one id with two texts; repeated rows.
    near = " ".join(prose(50))
    rows += [(None, near), (None, near + " end"), (None, out[2]), (None, None), (5000, out[1]), (5000, out[75]), (5001, "W " + out[75]), (5002, "X " + out[1]), rows[4], rows[4]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("node,cap,weight,levels", [(20_000, 5000, 2_000_000, 6), (20_000, 12, 2_000_000, 6), (12, 12, 1500, 2), (7, 7, 2_000_000, 0)])
def test_equals_all_pairs(spark, monkeypatch, node, cap, weight, levels):
    for name, value in (("NODE", node), ("CAP", cap), ("WEIGHT", weight), ("LEVELS", levels)):
        monkeypatch.setattr(chosen_path, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("clash") for c in CLASHES})
    assert sorted(map(tuple, chosen_path.report(docs).collect()), key=repr) == want(rows)


def test_of_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    assert chosen_path.report(docs.where("false")).count() == 0
    assert [tuple(r) for r in chosen_path.report(docs.select("doc_id", F.lit(None).cast("string").alias("text"))).collect()] == [(1, 0, 1, True)]


def test_tokens_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.8, 0.95):
        agree = []
        for _ in range(60):
            n = int(1000 * share)
            both, a, b = (rng.integers(0, 2 ** 63, k, dtype=np.uint64) for k in (n, (1000 - n) // 2, (1000 - n) // 2))
            x, y = chosen_path.minwise([np.concatenate([both, a]), np.concatenate([both, b])])
            agree.append((x == y).sum())
        assert abs(np.mean(agree) / chosen_path.TOKENS - share) < 0.03
        assert share < 0.8 or min(agree) >= chosen_path.least_agreement(80)


@pytest.mark.parametrize("small,depth", [(300, 12), (8, 12), (8, 1)])
def test_nodes_within_a_task_lose_no_group(monkeypatch, small, depth):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "DEPTH", depth)
    rng = np.random.default_rng(3)
    sets = []
    for size, copies in ((300, 60), (200, 25), (120, 6), (80, 1), (80, 1)):
        base = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
        for _ in range(copies):
            x = base.copy()
            x[rng.integers(0, size, size // 40)] = rng.integers(0, 2 ** 63, size // 40, dtype=np.uint64)
            sets.append(np.unique(x))
    frame = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)  # alike, not linked
    sets += [np.concatenate([frame, rng.integers(0, 2 ** 63, 60, dtype=np.uint64)]) for _ in range(40)]
    tokens = chosen_path.mix(chosen_path.minwise(sets)).astype(np.uint8)
    got = chosen_path.Agreeing(np.array([len(s) for s in sets]), tokens, 80).groups(5)
    assert sorted(sorted(g.tolist()) for g in got) == [list(range(60)), list(range(60, 85)), list(range(85, 91))]


def test_confirmed_links_join_groups():
    rng = random.Random(4)
    for _ in range(30):
        sets = [np.unique(np.array([rng.randrange(14) for _ in range(rng.randint(1, 16))], np.uint64)) for _ in range(15)]
        label = list(range(15))
        for i in range(15):
            for j in range(15):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = label[i], label[j]
                    label = [a if x == b else x for x in label]
        got = list(range(15))
        for i, j in chosen_path.confirmed(sets, 80):
            a, b = got[i], got[j]
            got = [a if x == b else x for x in got]
        assert all((got[i] == got[j]) == (label[i] == label[j]) for i in range(15) for j in range(15))
