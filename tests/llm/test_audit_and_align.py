"""Operators 12 and 13 against brute force, with the cases every text operator
has to stand."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nimbus.llm import align, filter_audit

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["digest", "mask", "part", "n", "good", "toxic", "least", "first", "block", "pair", "place", "total", "best"]


# ---------------------------------------------------------------- 12

def fails(rows):
    """The failed filters of each (doc_id, lang, text)."""
    out = []
    for i, _, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({f for f, x in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)),
                                   ("D", re.search(r"[#$%&*|]", t)), ("E", i is not None and any(j is not None and j < i and (u or "") == t for j, _, u in rows))) if x})
    return out


def walked(rows, labels):
    marks = {i: [max([x[k] or 0 for x in labels if x[0] == i], default=0) for k in (1, 2)] for i in {r[0] for r in rows}}
    bad, out = fails(rows), []
    for part in {r[1] or "" for r in rows}:
        own = [(bad[k], marks[r[0]] if r[0] is not None else (0, 0)) for k, r in enumerate(rows) if (r[1] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own),
                            sum(x[1][0] == 1 for x in gone), sum(x[1][1] == 1 for x in gone), f])
        out = [[*x[:9], shapley[x[9]]] if isinstance(x[-1], str) else x for x in out]
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(k)}" for _ in range(n)) for n in (10, 199, 200, 230) for k in (30, 900)]
    texts += [texts[3].upper(), texts[7] + " 50 %", texts[4] + " a|b", "Ab " * 300, "", None, " \n\t", "\x0b", "É" * 20 + "A", "A" + "é" * 33]
    rows = [(i, rng.choice(["en", "de", None, ""]), rng.choice(texts)) for i in range(120)]
    rows += [(None, "en", texts[0]), (None, None, texts[7]), (None, "xx", "of one")] + rows[:6] + [(-4, "de", texts[7]), (3, "en", texts[2])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 130, 2)] + [(4, 1, 1), (None, 1, 1)]
    return rows, labels


def test_filter_audit_walks_every_order(spark, audited):
    rows, labels = audited
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3).withColumns({c: F.lit("clash") for c in CLASHES})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = filter_audit.audit(filter_audit.document_masks(docs, marks))
    assert sorted(map(tuple, got.collect())) == walked(rows, labels)
    assert filter_audit.audit(filter_audit.document_masks(docs.where("false"), marks)).count() == 0
    alone = filter_audit.audit(filter_audit.document_masks(docs.where("lang = 'xx'"), marks.where("false"))).collect()
    assert len(alone) == 600 and {r.part for r in alone} == {"xx"}


def test_potential_gives_the_shapley_value():
    rng = random.Random(8)
    for _ in range(20):
        masks = {m: rng.randrange(40) for m in rng.sample(range(32), 12)}
        p = filter_audit.potentials(filter_audit.worth(masks))
        for i in range(5):
            by_orders = 0
            for order in itertools.permutations(range(5)):
                before = sum(1 << j for j in order[:order.index(i)])
                by_orders += sum(c for m, c in masks.items() if m >> i & 1 and not m & before)
            assert p[31] - p[31 ^ 1 << i] == by_orders


# ---------------------------------------------------------------- 13

def aligned(rows):
    """All pairs of tokens of a text, one against the other."""
    lib, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    lib.encode_special_tokens = True
    letters = align.byte_alphabet()
    docs, counts = [], Counter()
    for i, t in rows:
        raw = f" {t}".encode() if t else b""
        ia = lib.encode(f" {t}", add_special_tokens=False).ids if t else []
        ib = sp.encode(t) if t else []
        a = [bytes(letters.index(c) for c in lib.id_to_token(x)) for x in ia]
        b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, ib)]
        if b"".join(a) != raw or b"".join(b) != raw:
            ia, ib, a, b = [], [], [], []
        ends = [list(itertools.accumulate(map(len, x))) for x in (a, b)]
        links = [(ia[p], ib[q]) for p, x in enumerate(ends[0]) for q, y in enumerate(ends[1]) if x == y]
        said, at = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            said.append("|".join(",".join(str(x) for x, y in zip(ids, end, strict=True) if at < y <= e) for ids, end in zip((ia, ib), ends, strict=True)))
            at = e
        docs.append((i, len(ia), len(ib), len(said), links, sha256(";".join(said).encode()).hexdigest() if ia else ""))
        counts.update(links)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), d) for i, na, nb, g, x, d in docs), key=repr)


ODD = ["", None, " ", "a", "  two  spaces ", "tab\tand\nline", "<|endoftext|> <s> </s> <0x41> <unk>", "naïve Straße ÉCOLE", "漢字かな👍🏽", "ﬁ ½ ① ａｂ", "é ́", "\x00\x01\x1c\x85", "▁▁ x ▁",
       "don't we'll they've 123456 ...!!!", "x" * 3000, "ab " * 2000, "\n" * 50 + "end", "﻿bom ​ zero"]


@pytest.mark.parametrize("links,docs", [(1_000_000, 8192), (40, 5)])
def test_alignment_equals_all_pairs(spark, monkeypatch, links, docs):
    from pyspark import cloudpickle

    monkeypatch.setattr(align, "BLOCK_LINKS", links)
    monkeypatch.setattr(align, "BLOCK_DOCS", docs)
    cloudpickle.register_pickle_by_value(align)  # for the sizes set here
    try:
        rng = random.Random(2)
        words = ["the", "Then", "straße", "été", "running", "42", "don't", "x-y", "漢", "HTTP"]
        rows = list(enumerate([*ODD, *(" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(40))])) + [(None, "no id"), (None, "no id"), (3, "a"), (3, "other")]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("clash") for c in CLASHES})
        got = align.alignment(df, A, B)
        assert sorted(map(tuple, got.collect()), key=repr) == aligned(rows)
        assert align.alignment(df.where("false"), A, B).count() == 0
        of = align.groups_of(df.where("doc_id = 13"), A, B).orderBy("group").collect()
        assert b"".join(load_bytes(x) for r in of for x in r.a_ids) == b" " + ODD[13].encode()
    finally:
        cloudpickle.unregister_pickle_by_value(align)


def load_bytes(token):
    return align.load(align.ByteLevel, A).bytes[token]


def test_byte_level_ids_are_the_librarys():
    lib, own = Tokenizer.from_file(A), align.ByteLevel(A)
    lib.encode_special_tokens = True
    assert own.ranked is not None
    rng, letters = random.Random(3), "abTI'stre  ÉéßÑ\n\t\x0b\x0c\x1c\x85\xa0 123<|endoftext|>.,'ll漢👍ſ́\r\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert [list(x) for x in own.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_galloping_finds_all_common_values():
    rng = random.Random(6)
    for _ in range(2000):
        x, y = (sorted(rng.sample(range(90), rng.randint(0, 60))) for _ in range(2))
        p, q = align.intersect(x, y)
        assert [x[i] for i in p] == [y[i] for i in q] == sorted(set(x) & set(y))
    assert align.intersect([5, 10_000], list(range(20_000))) == ([0, 1], [5, 10_000])
